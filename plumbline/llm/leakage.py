"""Passages of test items in corpus documents, by a positional inverted index that is stored once.

Index: documents are cut into segments of neighbouring documents, a bounded number of characters each; a
segment has one row per token with its positions, and one row with its documents and their lengths. So
the index is partitioned by document, is made without a shuffle, and the postings of a token, however
frequent, are split by segment. The corpus is tokenised once, whatever the number of items.

Search: items are taken in blocks of a bounded number of tokens. Only postings of the block's tokens are
read from the index; they meet by segment. Every run of 4 tokens of an item (6 Chinese characters) is a
phrase, led by its token that is rarest in the corpus. The lists of the leading tokens are intersected
with those of the phrase's other tokens at their offsets, for all phrases of the block at once, so the
work per segment hardly depends on how many items there are.

A passage of the sought length always holds such a phrase unchanged. From the phrases found, the exact
match is extended to both sides over words that were replaced, left out or put in."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from plumbline.session import Scratch

MARKUP = re.compile(r"<[^<>]{0,200}>|&(?:[a-zA-Z]{2,10}|#x?[0-9a-fA-F]{1,6});")
INVISIBLE = re.compile("[­​-‏⁠﻿]")
LINK = re.compile(r"\]\([^()\s]*\)")
EMPHASIS = re.compile(r"(?<=\w)[*`~]{1,3}(?=\w)|(?<=\w)__(?=\w)")
TOKEN = re.compile(r"[㐀-䶿一-鿿豈-﫿]|[^\W_㐀-䶿一-鿿豈-﫿]+")
WIDE = re.compile(r"[㐀-䶿一-鿿豈-﫿]")
WIDTH = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20}
WORDS, CHARS = 14, 22
CHANGED = 2
WORD_CHARS = 3
#: Tokens of a phrase. Of 14 words with 2 changed, 4 in a row are unchanged, in 3 or more phrases; of 22
#: characters with 2 words of 3 changed, 6 in a row.
PHRASE, WIDE_PHRASE, LEAST_PHRASES = 4, 6, 3
#: Empty positions between documents, so that no phrase crosses their border.
GAP = 8
SEGMENT_CHARS = 4_000_000
#: Items longer than a piece are searched in pieces that overlap by more than a passage.
PIECE, OVERLAP = 20_000, 64
#: Rows of a block's vocabulary that are broadcast; a larger one is joined by a shuffle.
BROADCAST_TOKENS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[str]:
    """Words, and single Chinese characters, in lower case and half width, without markup."""
    text = INVISIBLE.sub("", MARKUP.sub(" ", text.translate(WIDTH)))
    return TOKEN.findall(EMPHASIS.sub("", LINK.sub(" ", text)).lower())


def segments(texts: list[str | None], most: int = SEGMENT_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``most`` characters together, so that long texts don't add up."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def positional_index(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(segment, token, n, gaps, docs): per segment and token the number of its positions and the distances
    between them; the row without a token has the segment's documents and their lengths in tokens.
    Documents with a NULL text have no tokens."""
    kind = documents.schema[doc_id].dataType
    arrow = to_arrow_type(kind)
    schema = T.StructType(
        [T.StructField("segment", T.LongType()), T.StructField("token", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("gaps", T.ArrayType(T.IntegerType())), T.StructField("docs", T.ArrayType(kind))]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in segments(texts):
                split = [tokens(t or "") for t in texts[a:b]]
                lengths = np.array([len(t) for t in split], np.int32)
                coded = pa.array([w for t in split for w in t], pa.string()).dictionary_encode()
                code = coded.indices.to_numpy()
                start = np.cumsum(lengths + GAP) - lengths - GAP
                place = np.arange(len(code)) + np.repeat(start - (np.cumsum(lengths) - lengths), lengths)
                order = np.argsort(code, kind="stable")
                n = np.bincount(code, minlength=len(coded.dictionary)).astype(np.int32)
                gaps = np.diff(place[order], prepend=0)
                first = np.cumsum(n) - n
                gaps[first] = place[order][first]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(code)].astype(np.int32)), pa.array(gaps.astype(np.int32)))
                names = ["segment", "token", "n", "gaps", "docs"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]), pa.array([None], pa.string()), pa.array([len(split)], pa.int32()), pa.array([lengths], pa.list_(pa.int32())),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a)),
                    ], names=names,
                )
                if len(n):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), number)), coded.dictionary, pa.array(n), lists, pa.nulls(len(n), pa.list_(arrow))], names=names)
                number += 1

    return documents.select(doc_id, text).mapInArrow(build, schema)


def _keys(stream: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key of the ``size`` tokens from each position of ``at``; 0 where one of them is no test token."""
    key, whole = np.full(len(at), np.uint64(size)), np.ones(len(at), bool)
    for k in range(size):
        word = stream[at + k]
        whole &= word > 0
        key = (key ^ word.astype(np.uint64)) * MIX
        key ^= key >> np.uint64(29)
    return np.where(whole, key, np.uint64(0))


class Block:
    """Items as arrays: tokens numbered from the rarest in the corpus, and phrases by key. ``lead`` tells
    for each token, as bits, at which offsets of phrases of both sizes it is the rarest."""

    def __init__(self, ids: list, own: np.ndarray, lengths: np.ndarray, wide: np.ndarray):
        self.ids, self.tokens, self.wide_token = ids, own, wide
        self.start = np.r_[0, np.cumsum(lengths)].astype(np.int64)
        is_wide = wide[own]
        item = np.repeat(np.arange(len(lengths)), lengths)
        has_wide = np.bincount(item, is_wide, len(lengths)) > 0
        self.least = np.where(has_wide, 1, LEAST_PHRASES)
        self.tables = []
        for size in (PHRASE, WIDE_PHRASE):
            at = np.arange(max(0, len(own) - size + 1))
            at = at[item[at] == item[np.minimum(at + size - 1, len(own) - 1)]] if len(at) else at
            chars = sum((is_wide[at + k].astype(int) for k in range(size)), np.zeros(len(at), int))
            at = at[chars <= 3] if size == PHRASE else at[chars >= 4]
            lead = np.argmin(np.stack([own[at + k] for k in range(size)]), 0) if len(at) else at
            bits = np.zeros(len(wide) + 1, np.int64)
            np.bitwise_or.at(bits, own[at + lead], 1 << lead)
            key = _keys(own, at, size)
            order = np.argsort(key, kind="stable")
            self.tables.append((size, bits, key[order], at[order].astype(np.int32), item[at[order]].astype(np.int32)))

    def hits(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, place in all items' tokens) of every phrase found in a stream of numbered tokens."""
        found = []
        for size, bits, keys, places, item in self.tables:
            if not len(keys):
                continue
            told = bits[stream]
            at = []
            for offset in range(size):
                lead = np.flatnonzero(told >> offset & 1) - offset
                at.append(lead[(lead >= 0) & (lead + size <= len(stream))])
            at = np.concatenate(at)
            key = _keys(stream, at, size)
            at, key = at[key > 0], key[key > 0]
            low = np.searchsorted(keys, key)
            times = np.searchsorted(keys, key, side="right") - low
            at, low, times = at[times > 0], low[times > 0], times[times > 0]
            use = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
            found.append((np.repeat(at, times), item[use], places[use]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))


#: Changes by (words of the item, words of the document): each is one changed word.
EDITS = ((1, 1), (0, 1), (1, 0), (1, 2), (0, 2))
WIDE_EDITS = tuple((a, b) for a in range(WORD_CHARS + 1) for b in range(WORD_CHARS + 2) if a + b)


def _reach(own: list[int], doc: list[int], i: int, j: int, wide: list[bool]) -> list[int]:
    """The furthest end in ``own`` with 0, 1, ... CHANGED changed words, going on from own[i] and doc[j].

    After a change that moves the two against each other, two equal tokens must follow."""
    best = [i] * (CHANGED + 1)
    front = {(i, j)}
    for changes in range(1, CHANGED + 1):
        following = set()
        for a, b in front:
            for da, db in WIDE_EDITS if a < len(own) and wide[a] else EDITS:
                x, y = a + da, b + db
                if x > len(own) or y > len(doc):
                    continue
                ran = 0
                while x + ran < len(own) and y + ran < len(doc) and own[x + ran] == doc[y + ran]:
                    ran += 1
                if ran > (da != db):
                    best[changes] = max(best[changes], x + ran)
                    following.add((x + ran, y + ran))
                elif da == db:
                    following.add((x, y))
        best[changes] = max(best[changes], best[changes - 1])
        front = following
    return best


def best_passage(own: list[int], doc: list[int], wide: list[bool], seeds: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(start, end, changed) in ``own`` of its longest passage in ``doc`` that holds one of the ``seeds``, pairs
    of places with equal tokens, and has at most CHANGED words changed."""
    best, seen = (0, 0, 0), set()
    for i, j in seeds:
        a, shift = i, j - i
        while a and a + shift and own[a - 1] == doc[a - 1 + shift]:
            a -= 1
        if (a, shift) in seen:
            continue
        seen.add((a, shift))
        b = i
        while b < len(own) and b + shift < len(doc) and own[b] == doc[b + shift]:
            b += 1
        right = _reach(own, doc, b, b + shift, wide)
        left = _reach(own[:a][::-1], doc[: a + shift][::-1], 0, 0, wide[:a][::-1])
        for total in range(CHANGED + 1):
            for k in range(total + 1):
                start, end = a - left[total - k], right[k]
                if end - start > best[1] - best[0]:
                    best = (start, end, total)
    return best


def search(block: Block, stream: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(document, item, length, changed, start in the item): the best match of each of a segment's documents and item."""
    at, item, place = block.hits(stream)
    if not len(at):
        return []
    begin = np.cumsum(lengths + GAP) - lengths - GAP
    doc = np.searchsorted(begin, at, side="right") - 1
    pair = doc * len(block.ids) + item
    order = np.lexsort((at, pair))
    pair, at, item, place, doc = (x[order] for x in (pair, at, item, place, doc))
    edges = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1], True])
    edges_of = np.diff(edges)
    found = []
    for first, n in zip(edges[:-1], edges_of):
        k, d = int(item[first]), int(doc[first])
        if n < block.least[k]:
            continue
        low, high = block.start[k], block.start[k + 1]
        own = block.tokens[low:high]
        text = stream[begin[d] : begin[d] + lengths[d]]
        wide = block.wide_token[own]
        seeds = list(zip((place[first : first + n] - low).tolist(), (at[first : first + n] - begin[d]).tolist()))
        start, end, changed = best_passage(own.tolist(), text.tolist(), wide.tolist(), seeds)
        needed = CHARS if end > start and wide[start:end].mean() > 0.5 else WORDS
        if end - start >= needed:
            found.append((d, k, end - start, changed, start))
    return found


def leaked_passages(
    documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, shared: int = 3, block_tokens: int = 8_000_000
) -> DataFrame:
    """(doc_id, item_id, length, changed, start, kind): one row per document and item of which it holds a
    passage: at least 14 consecutive words (22 Chinese characters) with at most two words changed, left
    out or put in. length counts the item's tokens of the longest such passage, kind is 'exact' or 'near'.

    An opening sentence that ``shared`` or more items have in common is an instruction, not item text; it
    is told from all items. NULL and empty texts match nothing; texts are searched whole, items of more
    than PIECE tokens in overlapping pieces (their length then counts within a piece). The index is
    stored once; it is read once per block of about ``block_tokens`` tokens of items, which bounds what
    is broadcast."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "leakage")
    pieces = scratch.save(_pieces(items, item_id, item_text, shared))
    whole = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    index = scratch.save(positional_index(documents.where(F.col(text).isNotNull()), doc_id, text), compression="zstd")
    blocks = max(1, -(-whole // block_tokens))
    found = None
    for k in range(blocks):
        hits = _search_block(scratch, index, pieces.where(F.pmod(F.xxhash64("item", "at"), F.lit(blocks)) == k), documents.schema[doc_id], items.schema[item_id])
        found = hits if found is None else found.unionByName(hits)
    if blocks > 1 or not pieces.where(F.col("at") > 0).isEmpty():
        best = F.max(F.struct("length", -F.col("changed"), "start", "kind")).alias("b")
        found = found.groupBy(doc_id, item_id).agg(best).select(doc_id, item_id, "b.length", (-F.col("b.col2")).alias("changed"), "b.start", "b.kind")
    return found


def _pieces(items: DataFrame, item_id: str, item_text: str, shared: int) -> DataFrame:
    """(item, at, words): the tokens of each item's own text, in pieces that begin at token ``at``."""
    opening = r"(?s)^\s*(.*?[.!?。！？:：])(?=\s|$|(?<=[。！？：]))"
    listed = items.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).alias("item"), F.col(item_text).alias("body"), F.regexp_extract(item_text, opening, 1).alias("head"), F.char_length(F.regexp_extract(item_text, opening, 0)).alias("cut")
    )
    common = listed.where("head != ''").groupBy("head").agg(F.countDistinct("body").alias("n")).where(F.col("n") >= shared).select("head", F.lit(True).alias("told"))
    own = F.when(F.col("told"), F.expr("substring(body, cut + 1)")).otherwise(F.col("body"))
    rows = listed.join(common, "head", "left").select("item", own.alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, words = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                all_words = tokens(text)
                for a in range(0, max(1, len(all_words) - OVERLAP), PIECE - OVERLAP):
                    rows.append(i)
                    at.append(a)
                    words.append(all_words[a : a + PIECE])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(at, pa.int32()), pa.array(words, pa.list_(pa.string()))], names=["item", "at", "words"])

    return rows.mapInArrow(cut, T.StructType([T.StructField("item", items.schema[item_id].dataType), T.StructField("at", T.IntegerType()), T.StructField("words", T.ArrayType(T.StringType()))]))


def _search_block(scratch: Scratch, index: DataFrame, pieces: DataFrame, doc: T.StructField, item: T.StructField) -> DataFrame:
    spark = scratch.spark
    kinds = T.StructType([T.StructField(doc.name, doc.dataType), T.StructField(item.name, item.dataType), *(T.StructField(c, T.IntegerType()) for c in ("length", "changed", "start")), T.StructField("kind", T.StringType())])
    held = pieces.toArrow().combine_chunks()
    lists = held.column("words").chunk(0) if held.num_rows else pa.array([], pa.list_(pa.string()))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    listed = spark.createDataFrame(pd.DataFrame({"token": pd.Series(words, dtype="str"), "code": np.arange(len(words))}), "token string, code int")
    listed = F.broadcast(listed) if len(words) <= BROADCAST_TOKENS else listed
    # How often each of the block's tokens stands in the corpus: at most one row per token of the block.
    counted = index.where("token is not null").select("token", "n").join(listed, "token").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(len(words), np.int64)
    often[counted["code"].to_numpy(int)] = counted["n"].to_numpy(np.int64)
    number = np.empty(len(words), np.int64)
    number[np.argsort(often, kind="stable")] = np.arange(1, len(words) + 1)  # 0 is no test token
    wide = np.zeros(len(words) + 1, bool)
    wide[number] = [bool(WIDE.match(w)) for w in words]
    own = number[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
    lengths = np.diff(lists.offsets.to_numpy()) if held.num_rows else np.zeros(0, np.int64)
    block = Block(held.column("item").to_pylist() if held.num_rows else [], own, lengths, wide)
    block.offset = held.column("at").to_numpy() if held.num_rows else np.zeros(0, np.int64)
    shipped = spark.sparkContext.broadcast(block)
    item_type = to_arrow_type(item.dataType)
    numbers = spark.createDataFrame(pd.DataFrame({"token": pd.Series(words, dtype="str"), "number": number}), "token string, number bigint")
    numbers = F.broadcast(numbers) if len(words) <= BROADCAST_TOKENS else numbers
    empty = F.lit(None).cast(index.schema["docs"].dataType)
    postings = index.where("token is not null").select("segment", "token", "gaps").join(numbers, "token").select("segment", "number", "gaps", empty.alias("docs"))
    papers = index.where("token is null").select("segment", F.lit(0).cast("bigint").alias("number"), "gaps", "docs")

    def seek(table: pa.Table) -> pa.Table:
        block, table = shipped.value, table.combine_chunks()
        number = table.column("number").to_numpy()
        gaps = table.column("gaps").chunk(0)
        flat, ends = gaps.flatten().to_numpy().astype(np.int64), gaps.offsets.to_numpy() - gaps.offsets[0].as_py()
        paper = int(np.flatnonzero(number == 0)[0])
        lengths = flat[ends[paper] : ends[paper + 1]]
        total = np.r_[0, np.cumsum(flat)]
        place = total[1:] - np.repeat(total[ends[:-1]], np.diff(ends))
        word = np.repeat(number, np.diff(ends))
        stream = np.zeros(int((lengths + GAP).sum()), np.int64)
        stream[place[word > 0]] = word[word > 0]
        hits = search(block, stream, lengths)
        docs = table.column("docs").slice(paper, 1).combine_chunks().flatten()
        return pa.table(
            [docs.take(pa.array([h[0] for h in hits], pa.int64())), pa.array([block.ids[h[1]] for h in hits], item_type)]
            + [pa.array([h[c] for h in hits], pa.int32()) for c in (2, 3)]
            + [pa.array([h[4] + int(block.offset[h[1]]) for h in hits], pa.int32()), pa.array(["near" if h[3] else "exact" for h in hits], pa.string())],
            names=kinds.names,
        )

    return postings.unionByName(papers).groupBy("segment").applyInArrow(seek, kinds)
