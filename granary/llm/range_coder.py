"""Token ids in a binary format: adaptive context mixing in front of a range coder, in sections of checksummed blocks.

A block holds the ids of a run of documents; its model starts empty. For each id, the tables of order 2 and order 1 propose
the id that last followed this context; three adaptive hit rates (order 2 by confidence, order 1 by confidence and agreement,
order 0 the block's own) are mixed in the logistic domain with weights that follow the coding error, and the mixed probability
codes whether the proposal holds. Tables learn from every id, rates and weights from runs of up to 128 ids. An id that is no
hit is coded with the order-0 frequencies of its section, which stand before the section's blocks. All of it is integer
arithmetic, so any machine decodes what any other has written.

The blocks of a section go through the coder side by side, one id of each per step, so a step is a handful of array operations.

Section layout, little-endian: ``CMS2``, crc32 of what follows up to the first block, then bytes of an id, number of blocks,
size of the packed frequencies; the frequencies (16 bits each, zlib), the sizes of the blocks; the blocks.
Block layout: ``CMR2``, crc32 of all that follows, then number of entries, number of ids, bytes of an id, number of code
words, place of the first id in the file (64 bits); per entry the document id, its place among the file's documents, flags
(1: id is null, 2: more follows in a later block), segment, number of ids; then code words as halves of 16 bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from granary.llm.tokens import encoder
from granary.llm.words import lean, pieces
from granary.session import materialise, new_path

BLOCK = 2048  # ids at most
LANES = 3072  # blocks coded side by side, a section
_MAGIC, _SECTION = b"CMR2", b"CMS2"
_HEAD = struct.Struct("<4sIIIIIq")
_SECTION_HEAD = struct.Struct("<4sIIII")
_ENTRY = np.dtype([("doc_id", "<i8"), ("place", "<i8"), ("flags", "<u4"), ("segment", "<u4"), ("ids", "<u4")])
_TOP, _LOW = np.uint64(1 << 32), np.uint64(1 << 30)
_BITS, _HALF, _WORD = np.uint64(12), np.uint64(16), np.uint64(32)
_ONE, _TWO = 9, 10  # bits of the slots of orders 1 and 2
#: Steps after which the hit rates and the weights learn from the ids since.
_REFRESH = {8, 16, 32, 48, 64, 96, 192}
_REFRESH_EVERY = 128

_x = np.arange(-2047, 2048)
_SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-_x / 256))), 24, 4072).astype(np.int32)
_p = np.clip(np.arange(4096), 1, 4095)
_STRETCH = np.clip(np.rint(256 * np.log(_p / (4096 - _p))), -2047, 2047).astype(np.int32)
_MOST = 1 << 18  # weights stay within
_SHIFT = np.uint32(6)
_MASKS = np.array([[(1 << _ONE) - 1], [(1 << _TWO) - 1]], np.uint32)


def frequencies(ids: np.ndarray, planes: int) -> list[np.ndarray]:
    """Order-0 frequencies of the 16-bit halves of ``ids``: 65,535 in all (65,536 if every value occurs), one at least for each that occurs."""
    out = []
    for k in range(planes // 2):
        count = np.zeros(1 << 16, np.int64)
        for a in range(0, len(ids), 1 << 20):
            count += np.bincount((ids[a : a + (1 << 20)] >> np.uint32(16 * k)) & np.uint32(0xFFFF), minlength=1 << 16)
        there = count > 0
        room = max((1 << 16) - 1, int(there.sum()))
        share = there + count * (room - int(there.sum())) // max(1, len(ids))
        share[count.argmax()] += room - share.sum()
        out.append(share.astype(np.uint16))
    return out


class _Model:
    """Predictions of ``lanes`` blocks. Arrays run over the lanes; the first ``n`` lanes are still at work.

    A state of 32 says how sure order 2 is (two bits), how sure order 1 is (two bits) and whether order 1 agrees with the
    proposal (one bit). Between two refreshes rates and weights stand still, so the mixture is worked out once for a state.
    """

    def __init__(self, lanes: int, planes: int, order0: list[np.ndarray] | None):
        self.lane = lane = np.arange(lanes)
        # Proposed id + 1 above, confidence in the two lowest bits; order 1 first, then order 2.
        self.table = np.zeros((lanes << _ONE) + (lanes << _TWO), np.int32 if planes == 2 else np.int64)
        self.base = np.stack([lane << _ONE, (lanes << _ONE) + (lane << _TWO)])
        self.state_base = 32 * lane
        # Ids and hits seen by each of 13 rates: 4 by confidence of order 2, 8 by confidence and agreement of order 1, 1 of order 0.
        self.seen, self.hits = np.zeros((lanes, 13), np.int32), np.zeros((lanes, 13), np.int32)
        self.weight = np.full((lanes, 3), 22_000, np.int32)
        self.p = np.empty((lanes, 32), np.int32)
        self._mix(lanes)
        self.log = np.empty((_REFRESH_EVERY, lanes), np.uint8)
        self.logged = 0
        self.key, self.before = np.zeros((2, lanes), np.uint32), np.zeros(lanes, np.uint32)
        order0 = order0 or [np.ones(1 << 16, np.uint16)] * (planes // 2)
        whole = [f.astype(np.uint32) for f in order0]
        self.share = [(np.cumsum(f, dtype=np.uint32) - f) << np.uint32(16) | f for f in whole]  # start above, frequency below
        self.symbol = [np.repeat(np.arange(1 << 16, dtype=np.uint16), f) for f in whole]

    def _mix(self, n: int) -> None:
        rate = (self.hits[:n] * 4096 + 2048) // (self.seen[:n] + 2)
        self.stretched = parts = _STRETCH[np.clip(rate, 1, 4095)]
        weight = self.weight[:n]
        two = weight[:, :1] * parts[:, :4]
        one = weight[:, 1:2] * parts[:, 4:12]
        zero = weight[:, 2:] * parts[:, 12:]
        mixed = ((one + zero)[:, :, None] >> 16) + (two[:, None, :] >> 16)
        self.p[:n] = _SQUASH[np.clip(mixed, -2047, 2047) + 2047].reshape(n, 32)
        self.odds = self.p[:n].astype(np.uint16).ravel()

    def refresh(self, n: int) -> None:
        """Hit rates and weights learn from the states and hits since the last time."""
        log = self.log[: self.logged, :n].astype(np.int32) + (self.lane[:n] << 6).astype(np.int32)
        self.logged = 0
        counts = np.bincount(log.ravel(), minlength=n << 6).reshape(n, 8, 4, 2).astype(np.int32)
        hits = counts[..., 1]
        seen = counts[..., 0] + hits
        error = hits * 4095 - seen * self.p[:n].reshape(n, 8, 4)
        stretched = self.stretched[:n].astype(np.int64)
        slope = np.stack([(stretched[:, :4] * error.sum(1)).sum(1), (stretched[:, 4:12] * error.sum(2)).sum(1), stretched[:, 12] * error.sum((1, 2))], axis=1)
        self.weight[:n] = np.clip(self.weight[:n] + np.clip(slope * 6 >> 16, -8192, 8192), -_MOST, _MOST)
        for kept, fresh in ((self.seen, seen), (self.hits, hits)):
            kept[:n, :4] += fresh.sum(1, dtype=np.int32)
            kept[:n, 4:12] += fresh.sum(2, dtype=np.int32)
            kept[:n, 12] += fresh.sum((1, 2), dtype=np.int32)
        many = self.seen[:n] > 255
        self.seen[:n] >>= many
        self.hits[:n] >>= many
        self._mix(n)

    def predict(self, n: int) -> np.ndarray:
        """Probability of a hit, of 4096. The proposed id + 1 is left in ``self.proposal``."""
        at = self.key[:, :n] >> _SHIFT
        at &= _MASKS
        self.at = at = at + self.base[:, :n]
        self.value = value = self.table.take(at)
        self.proposal = value[1] >> 2
        one = value[0] >> 2
        np.copyto(self.proposal, one, where=self.proposal == 0)
        self.sure = sure = value & 3
        state = (self.proposal == one).astype(np.int64)
        state <<= 2
        state += sure[0]
        state <<= 2
        state += sure[1]
        self.state = state
        return self.odds.take(state + self.state_base[:n]).astype(np.uint64)

    def learn(self, n: int, new: np.ndarray, hit: np.ndarray) -> None:
        """``new`` are the ids + 1."""
        state = self.state
        state <<= 1
        state += hit
        self.log[self.logged, :n] = state
        self.logged += 1
        value, sure = self.value, self.sure
        cell = (new << 2).astype(value.dtype)
        # A proposal that fails loses confidence and, without any left, its place.
        failed = np.where(sure, value - 1, cell)
        self.table[self.at] = np.where((value ^ cell) < 4, value + (sure < 3), failed)
        new = new.astype(np.uint32)
        mixed = np.multiply(new, np.uint32(2654435769), out=self.key[0, :n])
        np.add(mixed, self.before[:n], out=self.key[1, :n])
        np.multiply(new, np.uint32(2246822519), out=self.before[:n])


def _order(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Lanes by falling length, and how many of them are at work at each step."""
    order = np.argsort([-x for x in lengths], kind="stable")
    size = np.array(lengths)[order]
    return order, np.searchsorted(-size, -np.arange(int(size[0])) if len(size) else np.zeros(0), "left")


class _Coder:
    """Low ends and widths of the lanes' ranges, and the code words written or read: one column for each lane."""

    def __init__(self, words: np.ndarray, code: np.ndarray | None = None):
        self.lanes = words.shape[1]
        self.words = words.reshape(-1)
        self.at = np.arange(self.lanes)
        self.low, self.width = np.zeros(self.lanes, np.uint64), np.full(self.lanes, (1 << 64) - 1, np.uint64)
        self.code = code

    def settle(self, n: int) -> None:
        """Shift out what is certain; a range that stays too narrow is cut so that it becomes certain."""
        low, width, at, code = self.low, self.width, self.at, self.code
        # A range whose ends agree in their first word is below _TOP.
        out = (width[:n] < _TOP).nonzero()[0]
        while len(out):
            a, w = low.take(out), width.take(out)
            same = (a ^ (a + w)) < _TOP
            if not same.all():
                cut = ~same & (w < _LOW)
                w[cut] = (np.uint64(0) - a[cut]) & (_LOW - np.uint64(1))
                same |= cut
                out, a, w = out[same], a[same], w[same]
            place = at.take(out)
            if code is None:
                self.words[place] = a >> _WORD
            else:
                code[out] = code.take(out) << _WORD | self.words.take(place)
            place += self.lanes
            at[out] = place
            a <<= _WORD
            low[out] = a
            w <<= _WORD
            width[out] = w
            out = out[w < _TOP]


def _steps(model: _Model, working: np.ndarray) -> Iterator[tuple[int, int]]:
    """Steps and the lanes at work, with the model brought up to date before each."""
    for step, n in enumerate(working.tolist()):
        if step in _REFRESH or step and step % _REFRESH_EVERY == 0:
            model.refresh(n)
        yield step, n


def _columns(rows: list[np.ndarray], order: np.ndarray, height: int, kind: type) -> np.ndarray:
    out = np.zeros((len(rows), height), kind)
    for lane, b in enumerate(order.tolist()):
        out[lane, : len(rows[b])] = rows[b]
    return np.ascontiguousarray(out.T)


def encode_blocks(blocks: list[np.ndarray], planes: int, order0: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Code words of each block, in halves of 16 bits, for ids of ``planes`` bytes; without ``order0`` all ids that are no hit are alike."""
    order, working = _order([len(b) for b in blocks])
    steps = len(working)
    ids = _columns(blocks, order, steps, np.uint32)
    model = _Model(len(blocks), planes, order0)
    coder = _Coder(np.zeros((steps * (planes // 2) + 8, len(blocks)), np.uint32))
    low, width = coder.low, coder.width
    with np.errstate(over="ignore"):
        for step, n in _steps(model, working):
            new = ids[step, :n].astype(np.int64)
            new += 1
            bound = (width[:n] >> _BITS) * model.predict(n)
            failed = new != model.proposal
            miss = failed.nonzero()[0]
            room = bound.take(miss)
            a, w = low.take(miss) + room, width.take(miss) - room
            width[:n] = bound
            missed = new.take(miss) - 1
            for k in range(planes // 2):
                if k:
                    low[miss], width[miss] = a, w
                    coder.settle(n)
                    a, w = low[miss], width[miss]
                share = model.share[k].take(missed >> 16 * k & 0xFFFF if planes > 2 else missed)
                w >>= _HALF
                a += w * (share >> 16)
                w *= share & 0xFFFF
            low[miss], width[miss] = a, w
            coder.settle(n)
            model.learn(n, new, ~failed)
    result: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(blocks)
    tail = np.stack([(low >> np.uint64(s)).astype(np.uint32) for s in (32, 0)], axis=1)
    used = (coder.at // max(1, len(blocks))).tolist()
    words = np.ascontiguousarray(coder.words.reshape(-1, len(blocks))[: max(used, default=0)].T) if blocks else []
    for lane, b in enumerate(order.tolist()):
        result[b] = np.concatenate((words[lane, : used[lane]], tail[lane])).view(np.uint16)
    return result


def decode_blocks(codes: list[np.ndarray], lengths: list[int], planes: int, order0: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Ids of each block out of its code words."""
    order, working = _order(lengths)
    lanes, steps = len(codes), len(working)
    words = _columns([c.view(np.uint32) for c in codes], order, max(map(len, codes), default=0) // 2 + 8, np.uint32)
    model = _Model(lanes, planes, order0)
    ids = np.zeros((steps, lanes), np.uint32)
    code = words[0].astype(np.uint64) << _WORD | words[1]
    coder = _Coder(words, code)
    coder.at += 2 * lanes
    low, width = coder.low, coder.width
    last = [np.uint64(len(s) - 1) for s in model.symbol]
    with np.errstate(over="ignore"):
        for step, n in _steps(model, working):
            bound = (width[:n] >> _BITS) * model.predict(n)
            hit = code[:n] - low[:n] < bound
            miss = (~hit).nonzero()[0]
            room = bound.take(miss)
            a, w = low.take(miss) + room, width.take(miss) - room
            width[:n] = bound
            new = model.proposal.astype(np.int64)
            missed = np.ones(len(miss), np.int64)
            for k in range(planes // 2):
                if k:
                    low[miss], width[miss] = a, w
                    coder.settle(n)
                    a, w = low[miss], width[miss]
                w >>= _HALF
                target = np.minimum((code.take(miss) - a) // w, last[k]).astype(np.int64)
                half = model.symbol[k].take(target).astype(np.int64)
                share = model.share[k].take(half)
                a += w * (share >> 16)
                w *= share & 0xFFFF
                missed += half << 16 * k if k else half
            low[miss], width[miss] = a, w
            new[miss] = missed
            coder.settle(n)
            ids[step, :n] = new - 1
            model.learn(n, new, hit)
    result: list[np.ndarray] = [np.zeros(0, np.int64)] * lanes
    ids = np.ascontiguousarray(ids.T)
    for lane, b in enumerate(order.tolist()):
        result[b] = ids[lane, : lengths[b]]
    return result


class BlockError(ValueError):
    """A block is damaged."""


def sealed(entries: np.ndarray, n: int, planes: int, words: np.ndarray, start: int) -> bytes:
    body = struct.pack("<IIIIq", len(entries), n, planes, len(words), start) + entries.tobytes() + words.astype("<u2").tobytes()
    return _MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def opened(block: bytes) -> tuple[np.ndarray, int, int, np.ndarray, int]:
    """Entries, number of ids, planes, code words and place of the first id of a block."""
    if len(block) < _HEAD.size or block[:4] != _MAGIC or zlib.crc32(block[8:]) != struct.unpack_from("<I", block, 4)[0]:
        raise BlockError("not an undamaged block of token ids")
    _, _, count, n, planes, words, start = _HEAD.unpack_from(block)
    cut = _HEAD.size + count * _ENTRY.itemsize
    return np.frombuffer(block, _ENTRY, count, _HEAD.size), n, planes, np.frombuffer(block, "<u2", words, cut), start


def section(blocks: list[bytes], planes: int, order0: list[np.ndarray]) -> bytes:
    packed = zlib.compress(np.concatenate(order0).astype("<u2").tobytes())
    body = struct.pack("<III", planes, len(blocks), len(packed)) + packed + np.array([len(b) for b in blocks], "<u4").tobytes()
    return b"".join((_SECTION, struct.pack("<I", zlib.crc32(body)), body, *blocks))


def section_parts(data: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    """Order-0 frequencies and blocks of a section."""
    if len(data) < _SECTION_HEAD.size or data[:4] != _SECTION:
        raise BlockError("not a section of token ids")
    _, checksum, planes, count, packed = _SECTION_HEAD.unpack_from(data)
    at = _SECTION_HEAD.size + packed
    if len(data) < at + 4 * count or zlib.crc32(data[8 : at + 4 * count]) != checksum:
        raise BlockError("not an undamaged section of token ids")
    whole = np.frombuffer(zlib.decompress(data[_SECTION_HEAD.size : at]), "<u2")
    blocks = []
    sizes = np.frombuffer(data, "<u4", count, at).tolist()
    at += 4 * count
    for size in sizes:
        blocks.append(data[at : at + size])
        at += size
    return list(whole.reshape(planes // 2, 1 << 16)), blocks


def _written(path: str, end: int):
    """Rows (file, section, data) from documents in ascending order, one file per task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder = encoder(path)
        last = np.array([end], np.uint32).tobytes()
        number, place, start = 0, 0, 0
        waiting: list[tuple[list[tuple], np.ndarray]] = []  # closed blocks
        entries: list[tuple] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> None:
            nonlocal entries, held, size
            if entries:
                waiting.append((entries, np.concatenate(held)))
            entries, held, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, start
            if not waiting:
                return
            planes = 2 if max(int(ids.max()) for _, ids in waiting) < 1 << 16 else 4
            order0 = frequencies(np.concatenate([ids for _, ids in waiting]), planes)
            codes = encode_blocks([ids for _, ids in waiting], planes, order0)
            data = []
            for (rows, ids), words in zip(waiting, codes, strict=True):
                data.append(sealed(np.array(rows, _ENTRY), len(ids), planes, words, start))
                start += len(ids)
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([section(data, planes, order0)], pa.binary())], ["file", "block", "data"])
            number += 1
            waiting.clear()

        for batch in batches:
            for rows in pieces(batch, limit=1 << 20):
                names = rows.column(0).to_pylist()
                for doc, raw in zip(names, coder.encode([t or "" for t in rows.column(1).to_pylist()]), strict=True):
                    ids = np.frombuffer(raw + last, np.uint32)
                    if size and size + len(ids) > BLOCK:
                        close()
                    for segment, a in enumerate(range(0, len(ids), BLOCK)):
                        cut = ids[a : a + BLOCK]
                        flags = (doc is None) | (2 if a + BLOCK < len(ids) else 0)
                        entries.append((doc or 0, place, flags, segment, len(cut)))
                        held.append(cut)
                        size += len(cut)
                        if flags & 2:
                            close()
                    place += 1
                    if len(waiting) >= LANES:
                        yield from flush()
        close()
        yield from flush()

    return lean(write, tokens=True)


def write_ids(docs: DataFrame, path: str, target: str, end: int = 1) -> None:
    """Write the ids of ``docs(doc_id, text)`` in ascending order of ``doc_id`` as sections to the folder ``target``.

    The rows of ``target`` are ``file, block, data``, one for each section of up to ``LANES`` blocks; any store that Spark reaches will do. A null text is empty. Nulls of
    ``doc_id`` come first; rows with one id stand in the order of their texts' hashes.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    texts = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    texts.select("doc_id", "text").mapInArrow(_written(path, end), "file int, block int, data binary").write.parquet(target)


@lean
def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, doc_id, place, segment, more, start, n_tokens, ids_crc32): the segments of documents that blocks hold."""
    names = ["file", "doc_id", "place", "segment", "more", "start", "n_tokens", "ids_crc32"]

    def decoded(file: int, data: bytes) -> pa.RecordBatch:
        order0, blocks = section_parts(data)
        parts = [opened(b) for b in blocks]
        found = decode_blocks([p[3] for p in parts], [p[1] for p in parts], 2 * len(order0), order0)
        rows = []
        for (entries, _, _, _, start), ids in zip(parts, found, strict=True):
            raw = ids.astype("<u4").tobytes()
            a = 0
            for doc, place, flags, segment, n in entries.tolist():
                rows.append((file, None if flags & 1 else doc, place, segment, bool(flags & 2), start + a, n, zlib.crc32(raw[4 * a : 4 * (a + n)])))
                a += n
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        for row in range(batch.num_rows):
            yield decoded(batch.column(0)[row].as_py(), batch.column(2)[row].as_py())


@F.pandas_udf(T.LongType())
def _joined(sizes: pd.Series, checksums: pd.Series) -> pd.Series:
    """Checksums of whole documents out of those of their segments."""
    out = []
    for ns, crcs in zip(sizes, checksums, strict=True):
        whole = 0
        for n, crc in zip(ns, crcs, strict=True):
            zeros = bytes(4 * int(n))
            whole = zlib.crc32(zeros, whole) ^ zlib.crc32(zeros) ^ int(crc)
        out.append(whole)
    return pd.Series(out, dtype="int64")


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document that :func:`write_ids` wrote to ``target``.

    ``start`` counts the ids of all documents before it. A damaged section or block raises :class:`BlockError`.
    """
    segments = spark.read.schema("file int, block int, data binary").parquet(target)
    segments = materialise(segments.mapInArrow(_segments, "file int, doc_id bigint, place bigint, segment int, more boolean, start bigint, n_tokens bigint, ids_crc32 bigint"), "segments")
    # One row per file, as many as tasks wrote.
    sizes = segments.groupBy("file").agg(F.max(F.col("start") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    several = (F.col("segment") > 0) | F.col("more")
    whole = segments.where(~several).select("file", "doc_id", "start", "n_tokens", "ids_crc32")
    parts = F.sort_array(F.collect_list(F.struct("segment", "n_tokens", "ids_crc32"))).alias("parts")  # one document's
    cut = segments.where(several).groupBy("file", "place").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), parts)
    cut = cut.select("file", "doc_id", "start", "n_tokens", _joined(F.col("parts.n_tokens"), F.col("parts.ids_crc32")).alias("ids_crc32"))
    return whole.unionAll(cut).join(offsets, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, path: str, end: int = 1) -> DataFrame:
    """The documents read back from a fresh folder in the shared place. An empty table gives no row."""
    spark = docs.sparkSession
    target = new_path(spark, "token-ids")
    write_ids(docs, path, target, end)
    return read_documents(spark, target)
