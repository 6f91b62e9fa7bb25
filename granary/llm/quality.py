"""Quality by compression: how much better a text compresses with a dictionary of good texts than with one of bad texts.

Two zstandard dictionaries are made of excerpts of labelled texts, one per class. A text is cut into chunks of ``CHUNK``
bytes, each compressed with both, so that a long text is judged by all of it and not by its first window. The feature is
the normalised difference of the summed sizes; the mean size per byte goes with it, since text that compresses with
anything is suspicious in itself. A logistic curve over both, fitted on labelled texts that are in no dictionary, turns
them into a probability of label 1.

Learning looks at ``SAMPLE`` labelled documents at most, those with the least hashes of their ids, and at
``EXCERPTS`` excerpts of ``EXCERPT`` characters per class: bounds that do not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from granary.llm.tables import bounded_sample, held_out
from granary.llm.words import forget
from granary.session import materialise

SAMPLE = 20_000
EXCERPTS = 1000
EXCERPT = 300
CHUNK = 1000
LEVEL = 3
LIMIT = 4.0  # features are held within so many standard deviations


@dataclass
class QualityModel:
    bad: bytes
    good: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        # Added term by term, so that a text's score does not depend on the batch it comes in.
        score = sum(t * w for t, w in zip(_terms(features, self.centre, self.spread).T, self.weights, strict=True))
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def _terms(features: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    a, b = np.clip((features - centre) / spread, -LIMIT, LIMIT).T
    return np.stack([np.ones(len(a)), a, b, a * a, a * b, b * b], axis=1)


class _Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, bad: bytes, good: bytes):
        self.compressors = []
        for content in (bad, good):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))

    def features(self, text: bytes) -> tuple[float, float]:
        bad = good = 0
        for a in range(0, max(1, len(text)), CHUNK):
            chunk = text[a : a + CHUNK]
            bad += len(self.compressors[0].compress(chunk))
            good += len(self.compressors[1].compress(chunk))
        return (bad - good) / (bad + good), np.log((bad + good) / 2 / max(1, len(text)))


def _featured(bad: bytes, good: bytes):
    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _Sizes(bad, good)
        for batch in batches:
            rows = [sizes.features((t.as_py() or "").encode()) for t in batch.column(1)]
            found = np.array(rows, np.float64).reshape(-1, 2)
            yield pa.record_batch([batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])], ["label", "difference", "size"])

    return feature


def _fit(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic curve by Newton steps with a slight pull to zero."""
    centre, spread = features.mean(0), features.std(0) + 1e-9
    terms = _terms(features, centre, spread)
    weights = np.zeros(terms.shape[1])
    pull = np.full(len(weights), 0.3)
    pull[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(terms @ weights, -30, 30)))
        slope = terms.T @ (terms * (p * (1 - p))[:, None]) + np.diag(pull)
        weights = weights + np.clip(np.linalg.solve(slope, terms.T @ (labels - p) - pull * weights), -2, 2)
    return centre, spread, weights


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None) -> QualityModel:
    """Learn from ``labels(doc_id, <label>)`` where ``learn`` holds (all rows if None).

    Rows with a null id, label or text are not learned from; an id with both labels counts with the larger one, repeated
    rows count once, and of an id on rows with different texts the least text is learned. An excerpt of a very long text is
    taken at any place of it. Without a text of each label there is nothing to tell apart: the score is then the share of
    label 1, or one half without labels.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known if learn is None else known.where(learn)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = bounded_sample(known, "doc_id", SAMPLE)
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    # At most SAMPLE ids: this side is bounded.
    texts = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = materialise(texts.withColumn("for_curve", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 1), "quality-sample")
    # Excerpts: one per text at a place given by its id; a class with few texts gives several of each.
    counts = {r[0]: r[1] for r in sample.where("not for_curve").groupBy("label").count().collect()}
    dictionaries = []
    for value in (0, 1):
        times = -(-EXCERPTS // counts[value]) if counts.get(value) else 1
        place = F.pmod(F.xxhash64("doc_id", "turn"), F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1)
        cut = F.substring("text", (place + 1).cast("int"), F.lit(EXCERPT))
        some = sample.where(~F.col("for_curve") & (F.col("label") == value)).withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(min(times, 50)))))
        # Only excerpts are sorted, not whole texts.
        cuts = some.select("turn", "doc_id", F.xxhash64("doc_id").alias("mark"), cut.alias("cut"))
        rows = cuts.orderBy("turn", "mark", "doc_id").limit(EXCERPTS).select("cut").collect()
        dictionaries.append("\n".join(r[0] for r in rows).encode())
    if min(map(len, dictionaries)) < 8:
        share = sample.agg(F.avg("label")).first()[0]
        share = 0.5 if share is None else min(0.99, max(0.01, share))
        return QualityModel(b" " * 8, b" " * 8, np.zeros(2), np.ones(2), np.array([np.log(share / (1 - share)), 0, 0, 0, 0, 0]))
    curve = sample.where("for_curve").select("label", "text").mapInArrow(_featured(*dictionaries), "label int, difference double, size double").toPandas()
    if curve["label"].nunique() < 2:
        # Too few texts to hold half of them back.
        curve = sample.select("label", "text").mapInArrow(_featured(*dictionaries), "label int, difference double, size double").toPandas()
    curve = curve.sort_values(["difference", "size", "label"])
    return QualityModel(*dictionaries, *_fit(curve[["difference", "size"]].to_numpy(), curve["label"].to_numpy(np.float64)))


def quality_score(text: Column, model: QualityModel) -> Column:
    """Probability of label 1 for each text; a null or empty text is scored as the empty text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        sizes = _Sizes(model.bad, model.good)
        for texts in batches:
            rows = [sizes.features((t or "").encode()) for t in texts]
            yield pd.Series(model.probability(np.array(rows, np.float64).reshape(-1, 2)))

    return score(text)


def scored(docs: DataFrame, model: QualityModel, modulus: int = 5, remainder: int = 0, least: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null id is never held out."""
    out = docs.select("doc_id", F.coalesce(held_out("doc_id", modulus, remainder), F.lit(False)).alias("held_out"), quality_score(F.col("text").cast("string"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier learned from ``labels`` does not reject; all columns stay.

    Empty and null texts are judged like other texts, repeated rows alike.
    """
    model = fit_quality(docs, labels, learn=~held_out("doc_id", 5, 0))
    return docs.where(quality_score(F.col("text").cast("string"), model) >= least)
