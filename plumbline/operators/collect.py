"""Operators of answer collection: fan-out to models, retries, cleaning, wide tables, golden items."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import CLEANING, answer_id, clean_answer, cleaning_counts, is_meaningful, rough_tokens
from plumbline.operators.numbering import numbered
from plumbline.sources.sinks import write_partitions

#: A responder makes the answer column of a (query, model) row; models of a service would be called here.
Responder = Callable[[Column, Column], Column]

# Fixed values of the retry policy, in seconds.
BASE_DELAY, SLOW_FACTOR, SLOW_CAP = 2.0, 5.0, 600.0
LONGEST_DELAY = {"default": 120.0, "slow": 240.0}
JITTER = (0.5, 3.0)
NEVER_RETRIED = (401, 403)
REFUSED_WORDS = ("invalid api key", "unauthorized", "forbidden", "authentication")
#: Concurrent calls per model where nothing else is said.
CONCURRENT_CALLS = 10
#: What golden items end with, by the side of the answer, and what of it a writer may have put there already.
HINTS = ("。如果本条表述正确，请全部选择**模型A**", "。如果本条表述正确，请全部选择**模型B**")
WRITTEN_HINT = r"(?s)(。)?\s*如果.*?表述正确.*?请全部选择\*\*[^*]+\*\*\s*$"


def stub_responder(query: Column, model: Column) -> Column:
    """A deterministic answer without any service: the query's words in the model's name; none for every 16th."""
    return F.when(~F.md5(F.concat(query, model)).startswith("0"), F.concat(model, F.lit(" answers: "), query))


def fan_out(queries: DataFrame, text: str, models: list[str], respond: Responder = stub_responder) -> DataFrame:
    """One row per query and model with the model's answer; the models are a list, not a table."""
    tasks = queries.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    return tasks.withColumn("answer", respond(F.col(text), F.col("model")))


def with_second_pass(answered: DataFrame, respond: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Failed rows (no answer) go through ``respond`` once more; ``attempts`` tells which were."""
    good = answered.where("answer is not null").withColumn("attempts", F.lit(1))
    again = respond(answered.where("answer is null").drop("answer")).withColumn("attempts", F.lit(2))
    return good.unionByName(again.select(good.columns))


@dataclass(frozen=True)
class Retry:
    """Whether a failed call is tried again, and after how many seconds before random jitter."""

    again: bool
    delay: float = 0.0


def retry_policy(status: int | None, attempt: int, slow_model: bool = False, retry_after: float | None = None, attempts: int = 5, message: str = "", jitter: float = 0.0) -> Retry:
    """Exponential delays, longer for throttling and server errors and for slow models; a server's wish comes
    before them; the jitter (drawn from JITTER by the caller) is added, and a longest delay kept. Refused keys never retry."""
    if status in NEVER_RETRIED or any(w in message.lower() for w in REFUSED_WORDS) or attempt >= attempts - 1:
        return Retry(False)
    factor = 1.0
    if status == 429:
        factor = 5.0
    elif status is not None and 500 <= status < 600:
        factor = 5.0 if slow_model else 2.0
    delay = BASE_DELAY * 2**attempt * factor
    if slow_model:
        delay = min(SLOW_CAP, SLOW_FACTOR * delay)
    delay = retry_after if retry_after and retry_after > 0 else delay
    return Retry(True, min(delay + jitter, LONGEST_DELAY["slow" if slow_model else "default"]))


def concurrency(model: dict, overrides: dict[str, str] | None = None) -> int:
    """Concurrent calls of a model: its own limit, else CONCURRENT_CALLS, overridden by settings for all models,
    then for its provider, then for its name; what isn't a number is passed over."""
    told = [model.get("concurrent_limit"), *((overrides or {}).get(k) for k in ("all", model.get("provider"), model.get("model_name")))]
    limit = CONCURRENT_CALLS
    for value in told:
        try:
            limit = int(value) if value is not None else limit
        except (TypeError, ValueError):
            continue
    return limit


def filter_models(models: DataFrame, names: list[str], name: str = "model_name", api_name: str | None = None) -> DataFrame:
    """The models named, by either of their names in any letter case; all if none is named."""
    if not names:
        return models
    low = [n.lower() for n in names]
    held = F.coalesce(F.lower(name).isin(low), F.lit(False))
    return models.where(held | F.coalesce(F.lower(api_name).isin(low), F.lit(False)) if api_name else held)


def limited(tasks: DataFrame, model: str, key: str, limits: dict[str, int]) -> DataFrame:
    """Tasks in as many partitions per model as it takes concurrent calls, as a partition makes one call at a time."""
    starts, total = {}, 0
    for name in sorted(limits):
        starts[name], total = total, total + max(1, limits[name])
    at = F.coalesce(*[F.when(F.col(model) == n, F.lit(starts[n]) + F.pmod(F.xxhash64(key), F.lit(max(1, limits[n])))) for n in starts], F.lit(0))
    return tasks.repartitionById(total, at.cast("int"))


def called(tasks: DataFrame, text: str, model: str, call: Callable[[str, str], str], attempts: int = 5, sleep: Callable[[float], None] = time.sleep, slow: tuple[str, ...] = (), seed: int = 1) -> DataFrame:
    """``tasks`` with answer, tries, error and duration_ms from ``call``(text, model), an injected client of a service.

    A call that raises is repeated as retry_policy says, by the exception's ``status`` and ``retry_after``;
    after the last try the answer is NULL and the error has the exception's text. Rows are called one by
    one within their partition; limited sets how many partitions a model has."""
    added = "answer string, tries int, error string, duration_ms bigint"
    schema = T.StructType([*tasks.drop("answer", "tries", "error", "duration_ms").schema.fields, *T._parse_datatype_string(added).fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = random.Random(seed)
        for frame in frames:
            out = []
            for t, m in zip(frame[text], frame[model]):
                began, answer, error, k = time.monotonic(), None, None, 0
                while True:
                    try:
                        answer, error = call(t, m), None
                        break
                    except Exception as failed:  # whatever a client raises is a failed call
                        error = str(failed) or type(failed).__name__
                        again = retry_policy(getattr(failed, "status", None), k, m in slow, getattr(failed, "retry_after", None), attempts, error, draw.uniform(*JITTER))
                        if not again.again:
                            break
                        sleep(again.delay)
                        k += 1
                out.append((answer, k + 1, error, int(1000 * (time.monotonic() - began))))
            yield frame.assign(**{n: pd.Series([x[i] for x in out], dtype=kind) for i, (n, kind) in enumerate((("answer", "object"), ("tries", "int32"), ("error", "object"), ("duration_ms", "int64")))})

    return tasks.drop("answer", "tries", "error", "duration_ms").mapInPandas(run, schema)


def error_class(answer: Column) -> Column:
    """'timeout', 'call', 'empty' or NULL for an answer that says something."""
    return F.when(answer.startswith("ERROR_TIMEOUT"), "timeout").when(answer.startswith("ERROR_"), "call").when(~is_meaningful(answer), "empty")


def cleaned(answers: DataFrame, text: str) -> DataFrame:
    """Answers with their cleaned text, whether no cleaning step changed them, whether they say something, and counts."""
    tidy, counts = clean_answer(F.col(text)), cleaning_counts(F.col(text))
    done = answers.withColumns({"clean_text": tidy, "cleaning": counts})
    found = sum((F.col(f"cleaning.{n}") for n, _, _ in CLEANING), F.lit(0))
    return done.withColumns({"unchanged": found == 0, "meaningful": is_meaningful(F.col("clean_text"))})


def with_metadata(answers: DataFrame, model: str, text: str = "clean_text") -> DataFrame:
    """Cleaned answers with their metadata as JSON: model, tries, duration, estimated tokens, what was cleaned and errors, as far as known."""
    known = [F.col(c) for c in ("tries", "duration_ms", "error") if c in answers.columns]
    cleaning = F.struct(F.col("unchanged").alias("raw_equals_clean"), "cleaning.*")
    return answers.withColumn("generation_metadata", F.to_json(F.struct(F.col(model).alias("model"), *known, rough_tokens(F.col(text)).alias("completion_tokens"), cleaning.alias("cleaning"))))


def store_answers(answers: DataFrame, path: str, overwrite: bool = True) -> bool:
    """Write the answers that say something to the partitions (dm, game_id, model_id) they belong to."""
    good = answers.where(F.col("answer_content").isNotNull() & (F.trim("answer_content") != ""))
    return write_partitions(good, path, ["dm", "game_id", "model_id"], overwrite)


def games_of(sets: DataFrame, newest: str) -> DataFrame:
    """(game_id, game_name, set_id): the newest row of each game and name; of equally new ones the greatest set."""
    best = sets.groupBy("game_id", "game_name").agg(F.max(F.struct(F.col(newest), F.col("set_id"))).alias("b"))
    return best.select("game_id", "game_name", "b.set_id")


def wide_by_model(answers: DataFrame, query: str, model: str, text: str, models: list[str]) -> DataFrame:
    """One row per query with a column per model: the answer, of several the smallest."""
    return answers.groupBy(query).pivot(model, models).agg(F.min(text))


def golden_items(raw: DataFrame, key: str, stem: str | None = None) -> DataFrame:
    """(key, question, good, bad) from items of a writer: ``question`` and ``answers`` (array of text and correct).

    An item needs exactly two answers of which one is correct, texts that aren't blank, and the ``stem`` as its
    question if one is given. A hint for the reader that the writer already put at an end is taken off."""
    tidy = lambda x: F.trim(F.regexp_replace(x, WRITTEN_HINT, ""))
    right = lambda ok: F.filter("answers", lambda a: F.coalesce(a["correct"], F.lit(False)) == ok)
    text = lambda ok: tidy(F.get(right(ok), F.lit(0))["text"])
    fine = (F.size("answers") == 2) & (F.size(right(True)) == 1) & (F.trim("question") == F.lit(stem) if stem else F.col("question").isNotNull())
    return raw.where(fine).select(key, "question", text(True).alias("good"), text(False).alias("bad")).where("good != '' and bad != ''")


def golden_rows(items: DataFrame, key: str, last_id: int, seconds: int, set_id: int, model_id: int, hints: tuple[str, str] | None = HINTS) -> DataFrame:
    """Golden items (question, good, bad; NULLs and equal answers are refused) as two answer rows each.

    Query ids follow ``last_id`` in the order of ``key``. The sides are drawn by a hash of the key, and each
    side's hint is put at its end. Answer ids are of fixed format and repeat their last digits after 100
    queries, so every 100 queries count as a second later than the ones before."""
    valid = items.where("question is not null and good is not null and bad is not null and trim(good) != trim(bad)")
    valid = numbered(valid.select(key, "question", "good", "bad"), key)
    valid = valid.withColumn("swapped", F.substring(F.md5(F.col(key).cast("string")), 1, 1) < "8")
    first = lambda good: F.struct(F.lit(good).cast("boolean").alias("correct"), F.col("good" if good else "bad").alias("answer"))
    pair = F.when(F.col("swapped"), F.array(first(True), first(False))).otherwise(F.array(first(False), first(True)))
    rows = valid.withColumn("query_id", F.lit(last_id) + F.col("number")).select("query_id", "number", "question", F.posexplode(pair).alias("side", "_a"))
    ids = answer_id(F.lit(seconds) + F.floor((F.col("number") - 1) / 100), F.lit(model_id), F.lit(set_id), F.col("query_id") * 100 + F.col("side") + 1)
    text = F.col("_a.answer")
    if hints:
        text = F.concat(F.regexp_replace(text, "[。，]+$", ""), F.when(F.col("side") == 0, hints[0]).otherwise(hints[1]))
    meta = F.to_json(F.struct(F.col("_a.correct").alias("correct"), F.when(F.col("side") == 0, "modelA").otherwise("modelB").alias("selection"), F.lit(True).alias("anti_cheat")))
    return rows.select("query_id", "question", "side", text.alias("answer"), ids.alias("answer_id"), meta.alias("generation_metadata"))
