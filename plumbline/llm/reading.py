"""Reading grades of documents from the grades at which their words are acquired.

From documents graded by readers each word gets an acquisition grade: the mean grade at which it occurs,
every grade's documents weighing the same. A document is described by the quantiles of its known words'
grades; a softmax of these, fitted on graded documents whose word grades were made without them,
gives its grade. Chinese runs count as overlapping pairs of characters."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import Scratch

WORD = re.compile(r"[㐀-鿿]+|[^\W\d_㐀-鿿]+")
MARKUP = re.compile(r"<[^<>]{0,200}>|&\w{2,10};")
QUANTILES = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
LEAST_WORDS = 5
FOLDS = 5
#: Words of the training sample that the driver and executors hold at most.
MOST_WORDS = 2_000_000


def words(text: str) -> list[str]:
    """Words in lower case; of Chinese runs the pairs of neighbouring characters."""
    out: list[str] = []
    for run in WORD.findall(MARKUP.sub(" ", text.lower())):
        if "㐀" <= run[0] <= "鿿":
            out += [run[i : i + 2] for i in range(len(run) - 1)] or [run]
        else:
            out.append(run)
    return out


def describe(grades: np.ndarray) -> np.ndarray:
    """Quantiles and mean of a document's known word grades."""
    return np.append(np.quantile(grades, QUANTILES), grades.mean())


@dataclass
class ReadingModel:
    """words: (word, grade) of the known words; weights of the softmax over the standardised description."""

    words: DataFrame
    grades: list[int]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def predict(self, described: np.ndarray) -> np.ndarray:
        x = np.c_[(described - self.centre) / self.scale, np.ones(len(described))]
        return np.array(self.grades)[np.argmax(x @ self.weights, 1)]


def _softmax_fit(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 3000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z, truth = np.c_[(x - centre) / scale, np.ones(len(x))], np.eye(classes)[y]
    weights = np.zeros((z.shape[1], classes))
    for _ in range(steps):
        score = z @ weights
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        weights -= 0.5 * (z.T @ (p - truth) / len(z) + 0.1 * weights / len(z))
    return centre, scale, weights


def fit_reading(documents: DataFrame, doc_id: str, text: str, labels: DataFrame, grade: str, least: int = 2, max_labelled: int = 50_000, seed: int = 7) -> ReadingModel:
    """Fit word grades and the softmax on labelled documents.

    A document's grade is the rounded median of its labels. Of more than ``max_labelled`` labelled
    documents, those with the smallest seeded hashes of their ids are used, a documented bound of
    the training sample. A word needs ``least`` graded documents. Labels of documents that don't exist,
    NULL grades and texts without words don't count. With fewer than two grades left nothing can be told
    apart: the model then knows no words, and no document gets a grade.

    Words are counted over the whole sample by a distributed aggregation; one row per word comes to the
    driver, at most MOST_WORDS, and one description per labelled document."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "reading")
    graded = labels.where(F.col(grade).isNotNull()).groupBy(doc_id).agg(F.floor(F.median(grade) + 0.5).cast("int").alias("grade"))
    h = F.xxhash64(doc_id, F.lit(seed))
    graded = graded.withColumn("h", h).orderBy("h", doc_id).limit(max_labelled).withColumn("fold", F.pmod("h", F.lit(FOLDS)).cast("int"))
    known = documents.select(doc_id, text).where(F.col(text).isNotNull()).join(F.broadcast(graded), doc_id)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [words(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), batch.column("grade"), batch.column("fold"), pa.array(lists, pa.list_(pa.string()))], names=["doc", "grade", "fold", "words"])

    kind = documents.schema[doc_id].dataType.simpleString()
    split = scratch.save(known.mapInArrow(occurrences, f"doc {kind}, grade int, fold int, words array<string>"))
    split = split.where(F.size("words") >= LEAST_WORDS)
    sizes = split.groupBy("fold", "grade").agg(F.count("*").alias("n")).collect()  # a row per fold and grade
    grades = sorted({r["grade"] for r in sizes})
    if len(grades) < 2:
        return ReadingModel(spark.createDataFrame([], "word string, grade double"), grades, np.zeros(0), np.ones(0), np.zeros((1, len(grades))))
    place = {g: i for i, g in enumerate(grades)}
    of_grade = np.zeros((FOLDS, len(grades)))
    for r in sizes:
        of_grade[r["fold"], place[r["grade"]]] = r["n"]
    # Documents with the word, by word, fold and grade: one row per word that enough documents hold.
    cells = [(f, g) for f in range(FOLDS) for g in grades]
    columns = [F.sum(F.when((F.col("fold") == f) & (F.col("grade") == g), 1).otherwise(0)).alias(f"n{i}") for i, (f, g) in enumerate(cells)]
    each = split.select("fold", "grade", F.explode(F.array_distinct("words")).alias("word"))
    table = each.groupBy("word").agg(F.count("*").alias("n"), *columns).where(F.col("n") >= least)
    table = scratch.save(table)
    if table.count() > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words in the training sample; lower max_labelled or raise least")
    seen = table.orderBy("word").toPandas()
    counts = seen[[f"n{i}" for i in range(len(cells))]].to_numpy(float).reshape(len(seen), FOLDS, len(grades))

    def acquired(count: np.ndarray, size: np.ndarray) -> np.ndarray:
        share = count / np.maximum(size, 1)
        total = share.sum(1)
        return np.where(count.sum(1) >= least, share @ np.array(grades, float) / np.where(total > 0, total, 1), np.nan)

    without = np.stack([acquired(counts.sum(1) - counts[:, f], of_grade.sum(0) - of_grade[f]) for f in range(FOLDS)], 1)
    shipped = spark.sparkContext.broadcast((dict(zip(seen["word"], range(len(seen)))), without))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, by_fold = shipped.value
        for batch in batches:
            rows, truth = [], []
            for ws, f, g in zip(batch.column("words").to_pylist(), batch.column("fold").to_pylist(), batch.column("grade").to_pylist()):
                x = by_fold[[index[w] for w in ws if w in index], f]
                x = x[~np.isnan(x)]
                if len(x) >= LEAST_WORDS:
                    rows.append(describe(x).tolist())
                    truth.append(g)
            yield pa.RecordBatch.from_arrays([pa.array(truth, pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["grade", "x"])

    sample = split.select("fold", "grade", "words").mapInArrow(described, "grade int, x array<double>").toPandas()
    sample = sample.iloc[np.lexsort(np.array(sample["x"].tolist()).T)] if len(sample) else sample
    if sample["grade"].nunique() < 2:
        return ReadingModel(spark.createDataFrame([], "word string, grade double"), grades, np.zeros(0), np.ones(0), np.zeros((1, len(grades))))
    centre, scale, weights = _softmax_fit(np.array(sample["x"].tolist()), sample["grade"].map(place).to_numpy(), len(grades))
    known_words = pd.DataFrame({"word": seen["word"], "grade": acquired(counts.sum(1), of_grade.sum(0))})
    return ReadingModel(spark.createDataFrame(known_words, "word string, grade double"), grades, centre, scale, weights)


def reading_grades(documents: DataFrame, doc_id: str, text: str, model: ReadingModel) -> DataFrame:
    """(doc_id, grade, known_share, median_word_grade): one row per document; grade is NULL for texts of fewer
    than LEAST_WORDS known words. known_share, the share of known words, tells how sure the grade is.
    Texts are read whole.

    The known words are broadcast; the model holds at most MOST_WORDS."""
    spark = documents.sparkSession
    table = model.words.toPandas()
    bare = replace(model, words=None)  # a DataFrame can't be shipped
    shipped = spark.sparkContext.broadcast((dict(zip(table["word"], table["grade"])), bare))

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = shipped.value
        for batch in batches:
            rows, shares, middles = [], [], []
            for t in batch.column(text).to_pylist():
                found = words(t or "")
                x = np.array([known[w] for w in found if w in known])
                shares.append(len(x) / len(found) if found else None)
                fit = len(x) >= LEAST_WORDS
                rows.append(describe(x) if fit else None)
                middles.append(float(np.median(x)) if fit else None)
            at = [i for i, r in enumerate(rows) if r is not None]
            out: list[int | None] = [None] * len(rows)
            if at:
                for i, g in zip(at, own.predict(np.array([rows[i] for i in at]))):
                    out[i] = int(g)
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), pa.array(out, pa.int32()), pa.array(shares, pa.float64()), pa.array(middles, pa.float64())], names=[doc_id, "grade", "known_share", "median_word_grade"])

    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(doc_id, text).mapInArrow(grade, f"`{doc_id}` {kind}, grade int, known_share double, median_word_grade double")
