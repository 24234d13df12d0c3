"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, its white space collapsed, and the presence of its 3- to 6-grams taken. On the
labelled sample every n-gram has a log-count ratio ``r``: how much more often toxic documents have it
than others. The n-grams with the surest ratios are the features, each with the value ``r`` where it
is present, and logistic regression learns their weights.

Only training is bounded: ``MOST_LABELLED`` documents, those with the smallest hash of their id, so the
sample does not depend on order or partitions. Every whole text is scored.

Labels that are null, or whose document is missing, teach nothing; several labels of a document count
by their mean. With labels of one class only, every score is the share of toxic labels (0 without
labels). A null text counts as empty; it gets the score of no n-gram at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import give_back, slices, staged

SIZES = (3, 4, 5, 6)
MOST_LABELLED, FEATURES, LEAST_DOCUMENTS, SMOOTHING = 12_000, 16_384, 3, 1.0
# Text and rows a task works on at a time: n-grams to sort take some 300 times their text, a row of features 16 KB.
WINDOW, COUNT_BYTES, BLOCK_BYTES, ROW_BYTES = 1 << 16, 1 << 17, 1 << 19, 2048
FOLDS, HELD_OUT = 5, 0
MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of training; a document without id is not."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(digest % FOLDS == HELD_OUT, F.lit(False))


def prepared(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other with a zero between them, and the text each is of."""
    plain = [" " + " ".join(text.lower().replace("\0", " ").split()) + " \0" for text in texts]
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4")
    return codes, np.repeat(np.arange(len(texts)), [len(text) for text in plain])


def grams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all n-grams inside a text, with their places, a window at a time."""
    for low in range(0, codes.size, WINDOW):
        part = codes[low:low + WINDOW + SIZES[-1] - 1].astype(np.uint64)
        # a gram is inside if no zero comes before its end
        left = np.where(part == 0, np.arange(part.size), part.size)
        left = np.minimum.accumulate(left[::-1])[::-1] - np.arange(part.size)
        value, size = part, 1
        for wanted in SIZES:
            while size < wanted:
                value = value[:-1] * MIX + part[size:]
                value ^= value >> np.uint64(29)
                size += 1
            at = np.flatnonzero(left[:value.size] >= wanted)
            at = at[at < WINDOW]
            hashed = value[at] * SPREAD + np.uint64(wanted)
            yield hashed ^ (hashed >> np.uint64(32)), low + at


def training_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Stored ``text, toxic`` of a bounded number of labelled documents that are not held out."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id") \
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")).filter(~held_out())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return staged(found.repartition(16, "doc_id").select("text", "toxic"), "labelled")


def block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``gram, n_toxic, n_clean`` of each block of texts on its own."""
    for batch in slices(batches, limit=COUNT_BYTES):
        codes, owner = prepared(batch.column("text").to_pylist())
        toxic = batch.column("toxic").to_numpy()
        every, where = (np.concatenate(x) for x in zip(*grams(codes), strict=True))
        order = np.lexsort((owner[where], every))
        gram, text = every[order], owner[where][order]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])])
        gram, is_toxic = gram[new], toxic[text[new]]
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        n_toxic = np.add.reduceat(is_toxic, first).astype(np.int64)
        n_all = np.diff(np.concatenate([first, [gram.size]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[first].view(np.int64)), pa.array(n_toxic), pa.array(n_all - n_toxic)],
            ["gram", "n_toxic", "n_clean"])


def gram_counts(sample: DataFrame) -> DataFrame:
    """``gram, n_toxic, n_clean``: documents of the sample that have each n-gram, by class."""
    return sample.mapInArrow(block_counts, "gram long, n_toxic long, n_clean long") \
        .groupBy("gram").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


@dataclass(frozen=True)
class Model:
    """Sorted n-gram hashes, the weight of each, and the intercept (in log-odds)."""

    grams: np.ndarray
    weights: np.ndarray
    intercept: float

    def present(self, texts: list[str]) -> np.ndarray:
        """Which features each text has: a row per text."""
        found = np.zeros((len(texts), self.grams.size), bool)
        if not self.grams.size:
            return found
        table = np.full(1 << 20, -1, np.int32)
        table[(self.grams >> np.uint64(44)).astype(np.int64)] = np.arange(self.grams.size)
        clashing = np.flatnonzero(table[(self.grams >> np.uint64(44)).astype(np.int64)] != np.arange(self.grams.size))
        codes, owner = prepared(texts)
        for every, where in grams(codes):
            place = table[(every >> np.uint64(44)).astype(np.int64)]
            hit = np.flatnonzero(place >= 0)
            place, every, where = place[hit], every[hit], where[hit]
            same = self.grams[place] == every
            found[owner[where[same]], place[same]] = True
            if clashing.size:
                other = np.flatnonzero(~same)
                at = np.searchsorted(self.grams, every[other]).clip(max=self.grams.size - 1)
                good = self.grams[at] == every[other]
                found[owner[where[other[good]]], at[good]] = True
        return found

    def scores(self, texts: list[str]) -> np.ndarray:
        odds = self.intercept + self.present(texts) @ self.weights
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = training_sample(docs, labels)
    total = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, n_toxic = int(total[0]), int(total[1])
    if n_toxic in (0, n):
        odds = -40.0 if not n_toxic else 40.0
        return Model(np.empty(0, np.uint64), np.empty(0, np.float32), odds)
    a = SMOOTHING
    toxic, clean = F.col("n_toxic") + a, F.col("n_clean") + a
    ratio = F.log(toxic / (n_toxic + 2 * a)) - F.log(clean / (n - n_toxic + 2 * a))
    sure = F.abs("ratio") / F.sqrt(1 / toxic + 1 / clean)
    kept = gram_counts(sample).filter(F.col("n_toxic") + F.col("n_clean") >= LEAST_DOCUMENTS) \
        .withColumn("ratio", ratio).withColumn("sure", sure) \
        .orderBy(F.desc("sure"), "gram").limit(FEATURES).select("gram", "ratio").toPandas()
    hashes = kept["gram"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    chosen = Model(hashes[order], np.zeros(order.size, np.float32), 0.0)
    ratios = kept["ratio"].to_numpy()[order]
    names = np.array([str(i) for i in range(order.size)], object)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BLOCK_BYTES, row_bytes=ROW_BYTES):
            found = chosen.present(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.float64()),
                 pa.array([names[np.flatnonzero(x)].tolist() for x in found], pa.list_(pa.string()))],
                ["label", "grams"])

    vectors = staged(sample.mapInArrow(rows, "label double, grams array<string>"), "vectors")
    counted = CountVectorizerModel.from_vocabulary(list(names), inputCol="grams", outputCol="present", minTF=0.0)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="present", outputCol="features")
    learner = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False, tol=1e-5)
    fitted = learner.fit(scaled.transform(counted.transform(vectors)))
    weights = (fitted.coefficients.toArray() * ratios).astype(np.float32)
    return Model(chosen.grams, weights, float(fitted.intercept))


def toxicity(model: Model, text: Column) -> Column:
    """Score of a text, 0 to 1."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        values = texts.to_numpy()
        step = np.cumsum([len(x or "") + ROW_BYTES for x in values]) // BLOCK_BYTES if len(values) else np.empty(0)
        edges = [0, *(np.flatnonzero(np.diff(step)) + 1), len(values)]
        parts = [model.scores([x or "" for x in values[a:b]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        give_back()
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score(text)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether it is held out of training, its score, and the prediction."""
    model = fit(docs, labels)
    return docs.select("doc_id", held_out().alias("held_out"), toxicity(model, F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below a half, columns as they were."""
    model = fit(docs, labels)
    return docs.select(F.struct("*").alias("row"), toxicity(model, F.col("text")).alias("score")) \
        .filter("score < 0.5").select("row.*")
