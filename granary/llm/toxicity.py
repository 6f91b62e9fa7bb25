"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Only documents are labelled. A sentence has the probability ``p = sigmoid(bias + sum of the weights of its distinct
features)``, a document ``1 - (1 - floor) * product(1 - p)`` (noisy-or). The likelihood of the document labels is climbed by
gradient steps with weights pulled to zero, so that the sentences which explain the label get the weight, and the
sentences above ``SENTENCE`` are reported as the offending ones.

Words and their beginnings are hashed into ``2 ** BITS`` cells; a cell is a feature if it occurs in ``LEAST_TEXTS`` learned texts at least, in
toxic ones ``TELLING`` times as often as in all. Learning
looks at ``SAMPLE`` labelled documents at most, those with the least hashes of their ids, and among them at as many as have
``CELLS`` features in their sentences together, so that what is learned from fits in the driver. Every learned document is
read whole, as in scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.llm.tables import bounded_sample, held_out
from granary.llm.decontamination import plain_words
from granary.llm.words import U, Words, lean, mixed, pieces
from granary.session import materialise

SAMPLE = 12_000
CELLS = 4_000_000
BITS = 20
#: Besides whole words their first bytes are features, for words that are made of others.
BEGINNINGS = (4, 6)
LEAST_TEXTS = 3
#: A feature's share of toxic texts, against the share among all texts.
TELLING = 1.5
#: Pull of the weights to zero, in units of the log-likelihood.
PULL = 0.3
#: A sentence at or above this probability is offending.
SENTENCE = 0.5
#: Sentences end with one of these bytes; longer runs of words are cut after ``LONGEST`` words.
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?;\n\r"]] = True
LONGEST = 40


@dataclass
class ToxicityModel:
    weights: np.ndarray  # float32 per cell
    bias: float
    floor: float


def sentences(words: Words) -> np.ndarray:
    """The first word of every sentence, with the number of words at the end."""
    n = len(words.start)
    if not n:
        return np.zeros(1, np.int64)
    ends = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_ENDS[words.data], out=ends[1:])
    fresh = np.ones(n, bool)
    fresh[1:] = ends[words.start[1:]] > ends[words.start[:-1]]
    first = words.first[:-1]
    fresh[first[first < n]] = True
    begin = np.flatnonzero(fresh)
    place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    return np.append(np.flatnonzero(place % LONGEST == 0), n)


def _cells(words: Words) -> np.ndarray:
    """Cells of every word, one row each for the word and its beginnings."""
    rows = [words.hash]
    for size in BEGINNINGS:
        rows.append(mixed(words.hashes(np.minimum(words.end, words.start + size)) + U(size)))
    return (np.stack(rows) >> U(64 - BITS)).astype(np.int64)


def _distinct(cells: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (owner, cell), each once."""
    pair = np.unique((owner.astype(np.int64) << BITS) | cells)
    return pair >> BITS, pair & ((1 << BITS) - 1)


@lean
def _learned_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, label, sizes, cells): the sentences of each text, with their numbers of cells."""
    for batch in batches:
        for part in pieces(batch):
            words = plain_words(part.column(1))
            begin = sentences(words)
            cells = _cells(words)
            owner = np.searchsorted(words.first, begin[:-1], "right") - 1
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            sizes, kept = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                found = [np.unique(cells[:, begin[s] : begin[s + 1]]).astype(np.int32) for s in range(a, b)]
                sizes.append(np.array([len(f) for f in found], np.int32).tobytes())
                kept.append(np.concatenate(found).tobytes() if found else b"")
            yield pa.record_batch([part.column(0), part.column(2), pa.array(sizes, pa.binary()), pa.array(kept, pa.binary())], ["doc_id", "label", "sizes", "cells"])


@lean
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, texts, toxic): in how many texts of the batch a cell stands, and in how many toxic ones."""
    for batch in batches:
        texts, toxic = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for label, cells in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
            own = np.unique(np.frombuffer(cells.as_buffer(), np.int32))
            texts[own] += 1
            toxic[own] += label
        here = np.flatnonzero(texts)
        yield pa.record_batch([pa.array(here), pa.array(texts[here]), pa.array(toxic[here])], ["cell", "texts", "toxic"])


def _screened(cells: np.ndarray):
    """Rows (doc_id, label, sizes, cells) with those cells only, sentences without any left out."""
    table = np.zeros(1 << BITS, bool)
    table[cells] = True

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept, empty = [], [], []
            for size, cell in zip(batch.column(2), batch.column(3), strict=True):
                size, cell = np.frombuffer(size.as_buffer(), np.int32), np.frombuffer(cell.as_buffer(), np.int32)
                good = table[cell]
                left = np.bincount(np.repeat(np.arange(len(size)), size)[good], minlength=len(size))
                empty.append(int((left == 0).sum()))
                sizes.append(left[left > 0].astype(np.int32).tobytes())
                kept.append(cell[good].tobytes())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(empty, pa.int32()), pa.array(sizes, pa.binary()), pa.array(kept, pa.binary())], ["doc_id", "label", "empty", "sizes", "cells"])

    return lean(screen)


def _climb(empty: np.ndarray, doc: np.ndarray, sizes: np.ndarray, flat: np.ndarray, label: np.ndarray) -> ToxicityModel:
    """Gradient steps (Adam) on the noisy-or likelihood.

    ``empty``: sentences without a feature per text; ``doc``: text of each other sentence, ``sizes``: its number of cells
    in ``flat``; ``label`` per text.
    """
    texts = len(label)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    features, flat = np.unique(flat, return_inverse=True)
    weights, bias, floor = np.zeros(len(features)), -4.0, 1e-3

    def rated():
        p = 1 / (1 + np.exp(-np.clip(np.bincount(sentence, weights[flat], len(sizes)) + bias, -30, 30)))
        plain = 1 / (1 + np.exp(-bias))
        return p, plain, np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), texts) + empty * np.log1p(-plain)

    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, 251):
        p, plain, safe = rated()
        clean = (1 - floor) * np.exp(safe)
        pressure = np.where(label == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        # Slope of the log-likelihood in each sentence's score.
        slope = pressure[doc] * p
        grad = np.append(np.bincount(flat, slope[sentence], len(features)) - PULL * np.sign(weights) - 0.02 * weights, slope.sum() + (pressure * empty).sum() * plain)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights = weights + move[:-1]
        bias = float(np.clip(bias + move[-1], -12, -2))
    # Texts without any offending sentence are toxic by label noise alone.
    quiet = rated()[2] > np.log(0.5)
    floor = float(np.clip(label[quiet].mean(), 1e-3, 0.2)) if quiet.any() else floor
    every = np.zeros(1 << BITS, np.float32)
    every[features] = weights
    return ToxicityModel(every, bias, floor)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None) -> ToxicityModel:
    """Learn from ``labels(doc_id, <label>)`` where ``learn`` holds (all rows if None).

    Rows with a null id or label or a null text are not learned from; an id with both labels counts as 1, repeated rows
    count once, and of an id on rows with different texts the least text is learned. Empty texts are bags without a sentence;
    very long ones are learned whole. With no label at all, or from an empty table, every text gets the same low score.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known if learn is None else known.where(learn)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = bounded_sample(known, "doc_id", SAMPLE)
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # at most SAMPLE ids
    rows = materialise(texts.select("doc_id", "text", "label").mapInArrow(_learned_texts, "doc_id bigint, label int, sizes binary, cells binary"), "toxicity-sample")
    share = rows.agg(F.avg("label")).first()[0]
    if share is None:
        return ToxicityModel(np.zeros(1 << BITS, np.float32), -30.0, 0.01)
    # Only features that stand in toxic texts more often than in others can explain a label; there are 2**BITS cells.
    counts = rows.mapInArrow(_counted, "cell bigint, texts bigint, toxic bigint").groupBy("cell").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
    telling = counts.where((F.col("texts") >= LEAST_TEXTS) & (F.col("toxic") >= F.col("texts") * min(0.9, TELLING * share))).select("cell").toPandas()
    screened = rows.mapInArrow(_screened(telling["cell"].to_numpy()), "doc_id bigint, label int, empty int, sizes binary, cells binary")
    screened = materialise(screened, "toxicity-cells")
    # A running sum over the sample, SAMPLE rows at most. The first document is taken whatever its length.
    so_far = F.sum(F.octet_length("cells") / 4).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    first = screened.select("doc_id", (so_far - F.octet_length("cells") / 4).alias("before")).where(F.col("before") <= CELLS)
    found = screened.join(F.broadcast(first), "doc_id", "left_semi").toPandas().sort_values("doc_id")
    sizes = [np.frombuffer(bytes(s), np.int32) for s in found["sizes"]]
    flat = [np.frombuffer(bytes(c), np.int32) for c in found["cells"]]
    doc = np.repeat(np.arange(len(found)), [len(s) for s in sizes])
    return _climb(found["empty"].to_numpy(), doc, np.concatenate(sizes), np.concatenate(flat), found["label"].to_numpy())


def _rated(words: Words, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentence starts (and the end), probability of each sentence, probability of each text."""
    begin = sentences(words)
    texts = len(words.first) - 1
    cells = _cells(words)
    kind, heavy = np.nonzero(model.weights[cells])
    sentence = np.searchsorted(begin, heavy, "right") - 1
    # Each feature of a sentence counts once; words without weight do not matter.
    s, c = _distinct(cells[kind, heavy], sentence)
    score = np.bincount(s, model.weights[c], max(1, len(begin) - 1))[: len(begin) - 1] + model.bias
    p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    owner = np.searchsorted(words.first, begin[:-1], "right") - 1
    safe = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), texts) if len(p) else np.zeros(texts)
    return begin, p, 1 - (1 - model.floor) * np.exp(safe)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Probability of label 1 for each text; a null or empty text has no sentence and gets the floor."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            batch = pa.record_batch([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
            yield pd.Series(np.concatenate([_rated(plain_words(part.column(0)), model)[2] for part in pieces(batch)] or [np.zeros(0)]))

    return score(text)


def scored(docs: DataFrame, model: ToxicityModel, modulus: int = 3, remainder: int = 1, least: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null id is never held out."""
    out = docs.select("doc_id", F.coalesce(held_out("doc_id", modulus, remainder), F.lit(False)).alias("held_out"), toxicity_score(F.col("text").cast("string"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def offending_sentences(docs: DataFrame, model: ToxicityModel, least: float = SENTENCE) -> DataFrame:
    """``doc_id, sentence, from_word, to_word, score``: the sentences of ``docs`` at or above ``least``, counted from 0."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = plain_words(part.column(1))
                begin, p, _ = _rated(words, model)
                hit = np.flatnonzero(p >= least)
                owner = np.searchsorted(words.first, begin[hit], "right") - 1
                number = hit - np.searchsorted(begin, words.first[owner])
                low = words.first[owner]
                yield pa.record_batch(
                    [part.column(0).take(pa.array(owner)), pa.array(number.astype(np.int32)), pa.array((begin[hit] - low).astype(np.int32)), pa.array((begin[hit + 1] - low).astype(np.int32)), pa.array(p[hit])],
                    ["doc_id", "sentence", "from_word", "to_word", "score"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(locate, "doc_id bigint, sentence int, from_word int, to_word int, score double")
