"""Token counts by a compiled finite-state transducer (:mod:`granary.llm.transducer`).

Long texts are read in chunks. A chunk's state map is open at its ends: up to the first place where a word surely begins it
depends on what stands before, from there on it does not. Maps compose associatively (:func:`composed`), so the maps of
all texts are composed side by side, neighbours first, in rounds that halve their number (the up-sweep of a parallel prefix
scan; the last map gives the count).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.llm.transducer import Transducer, transducer
from granary.llm.words import lean, pieces
from granary.session import materialise

#: Characters per chunk of a long text.
CHUNK = 1 << 14


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any state: ``count`` tokens lie between ``head`` and ``tail``, which meet the neighbours.

    ``tail`` is None while no place is known where a word surely begins; all text is in ``head`` then.
    """

    head: str
    count: int
    tail: str | None


def _seams(text: str) -> tuple[int, int]:
    """First and last place where a word surely begins: a blank between two characters that are not white space."""

    def good(i: int) -> bool:
        return 0 < i < len(text) - 1 and not text[i - 1].isspace() and not text[i + 1].isspace()

    first = text.find(" ")
    while first >= 0 and not good(first):
        first = text.find(" ", first + 1)
    last = text.rfind(" ") if first >= 0 else -1
    while last > first and not good(last):
        last = text.rfind(" ", 0, last)
    return first, last


def chunk_map(text: str, machine: Transducer) -> ChunkMap:
    first, last = _seams(text)
    if first < 0 or any(s in text for s in machine.special):
        return ChunkMap(text, 0, None)
    return ChunkMap(text[:first], int(machine.counts([text[first:last]])[0]), text[last:])


def composed(a: ChunkMap, b: ChunkMap, machine: Transducer) -> ChunkMap:
    """The map of two chunks in a row. Associative."""
    if a.tail is None:
        return ChunkMap(a.head + b.head, b.count, b.tail)
    if b.tail is None:
        return ChunkMap(a.head, a.count, a.tail + b.head)
    return ChunkMap(a.head, a.count + int(machine.counts([a.tail + b.head])[0]) + b.count, b.tail)


def total(whole: ChunkMap, machine: Transducer) -> int:
    return whole.count + int(machine.counts([whole.head, whole.tail or ""]).sum()) if whole.tail is not None else int(machine.counts([whole.head])[0])


MAP = "head string, count bigint, tail string"


def _read(path: str, chunk: int):
    """Rows (doc_id, n_bytes, chunks, maps): the count of a short text as its only map, the chunk maps of a longer one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        kind = pa.list_(pa.struct([("head", pa.string()), ("count", pa.int64()), ("tail", pa.string())]))
        for batch in batches:
            for part in pieces(batch, limit=1 << 20):
                texts = part.column(1).to_pylist()
                short = [k for k, t in enumerate(texts) if len(t) <= chunk]
                maps: list = [None] * len(texts)
                for k, n in zip(short, machine.counts([texts[k] for k in short]).tolist(), strict=True):
                    maps[k] = [{"head": None, "count": n, "tail": None}]
                for k, t in enumerate(texts):
                    if maps[k] is None:
                        found = (chunk_map(t[a : a + chunk], machine) for a in range(0, len(t), chunk))
                        maps[k] = [{"head": m.head, "count": m.count, "tail": m.tail} for m in found]
                chunks = pa.array([len(m) for m in maps], pa.int32())
                yield pa.record_batch([part.column(0), part.column(2), chunks, pa.array(maps, kind)], ["doc_id", "n_bytes", "chunks", "maps"])

    return lean(read, tokens=True)


def _paired(path: str):
    """Rows (row, place, head, count, tail): each map ``a`` composed with its right neighbour ``b``, where there is one."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            maps = [ChunkMap(**a) if b is None else composed(ChunkMap(**a), ChunkMap(**b), machine) for a, b in zip(left, right, strict=True)]
            columns = [pa.array([getattr(m, f) for m in maps], t) for f, t in (("head", pa.string()), ("count", pa.int64()), ("tail", pa.string()))]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], ["row", "place", "head", "count", "tail"])

    return lean(pair, tokens=True)


def _totals(path: str):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            found = [total(ChunkMap(*m), machine) for m in zip(*(batch.column(c).to_pylist() for c in ("head", "count", "tail")), strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], ["row", "n_tokens"])

    return lean(add, tokens=True)


def token_counts(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs(doc_id, text)``.

    The counts are those of the tokenizers file at ``path`` without added tokens; a special token's string in a text is
    that token. A null or empty text has none. Texts of more than ``chunk`` characters are read chunk by chunk, and the
    chunks' maps are composed pair by pair, in as many rounds as the longest text asks for; only a stretch without a place where
    a word surely begins is put together again. Repeated rows count each, a null ``doc_id`` stays null, an empty table gives no row. Other
    columns are not read. ``over_limit``: more than ``limit`` tokens.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    read = texts.mapInArrow(_read(path, chunk), "doc_id bigint, n_bytes bigint, chunks int, maps array<struct<head:string,count:bigint,tail:string>>")
    # The texts are read once; the numbers of the rows are written with the maps.
    read = materialise(read.withColumn("row", F.monotonically_increasing_id()), "chunk-maps")
    out = read.where("chunks = 1").select("doc_id", "n_bytes", F.element_at("maps", 1)["count"].alias("n_tokens"))
    most = read.agg(F.max("chunks")).first()[0] or 1
    if most > 1:
        maps = read.where("chunks > 1").select("row", F.posexplode("maps").alias("place", "map"))
        while most > 1:
            # One round of the scan: neighbours meet under half their place.
            halves = [F.max(F.when(F.col("place") % 2 == side, F.col("map"))).alias(name) for side, name in ((0, "a"), (1, "b"))]
            pairs = maps.groupBy("row", F.floor(F.col("place") / 2).cast("int").alias("place")).agg(*halves)
            maps = pairs.mapInArrow(_paired(path), f"row bigint, place int, {MAP}").select("row", "place", F.struct("head", "count", "tail").alias("map"))
            most = -(-most // 2)
        sums = maps.select("row", "map.*").mapInArrow(_totals(path), "row bigint, n_tokens bigint")
        out = out.unionAll(read.where("chunks > 1").select("row", "doc_id", "n_bytes").join(sums, "row").select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
