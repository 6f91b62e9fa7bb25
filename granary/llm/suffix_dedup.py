"""Removal of long repeated strings by suffix arrays over shards that together cover every possible repeat.

Every window of ``WINDOW`` bytes belongs to its anchor, the string of ``GRAM`` bytes in it with the least hash (the leftmost of
equal ones), so equal windows have equal anchors wherever they stand. Neighbouring windows of one anchor are a unit, cut out with
the bytes they cover. Then:

1. Units that are equal as a whole are counted, with a combine before the shuffle: of copies of any number no text moves.
2. Of the units with one anchor that differ, one of each kind goes to the shard of the anchor. There an external induced sort
   (``induced_sort``) of all windows that may repeat gives suffix array and common prefixes; windows that share ``WINDOW`` bytes with a neighbour repeat.
3. An anchor with more than ``MOST`` different units is not gathered: its units are cut by the distance from window to anchor,
   ``WIDTHS`` windows to a piece, and dealt out by the bytes that all windows of the piece have in common, until single windows
   are left, which step 1 settles. So no shard grows with the number of documents that share a passage.

Defined results: null and empty texts and texts shorter than a window lose nothing; repeated rows repeat each other; a null id is
an id like others; texts of any length are whole (blocks of a bounded size, their windows meet again in steps 1 and 2); an empty
table gives no row; extra columns are not read. Equality of units is told by 64 bits of BLAKE2b beside 64 bits of the anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.llm.induced_sort import sorted_suffixes
from granary.llm.tables import whole_groups
from granary.llm.words import _BASE, _BYTE, _INVERSE, U, lean, mixed, pieces, powers, utf8_buffers
from granary.session import discard, materialise

#: Bytes of a string that is removed where it repeats.
WINDOW = 400
#: Bytes of an anchor.
GRAM = 64
#: Different units of an anchor in one shard, at most.
MOST = 4096
#: Windows to a piece of a unit of more frequent anchors, round by round.
WIDTHS = (42, 6, 1)
#: Bytes of text sorted at once; an anchor is never cut, so at most ``MOST`` units more.
SHARD = 8 << 20
#: Windows of a block of text.
BLOCK = 1 << 20
_PLACE = (1 << 21) - 1

UNITS = "key binary, id string, start int, windows int, lead int, gram long, region long, copies long"


def _grams(data: np.ndarray) -> np.ndarray:
    """64 bits for each string of ``GRAM`` bytes of ``data``."""
    count = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
        return mixed((sums[GRAM:] - sums[:-GRAM]) * powers(_INVERSE, count))


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` neighbours, the leftmost of equal ones."""
    packed = (hashes & ~U(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    count = len(packed) - width + 1
    full = np.full(-(-len(packed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(packed)] = packed
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & U(_PLACE)).astype(np.int64)


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


class Block:
    """Units of some whole texts or of a part of a long one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, low: int, high: int):
        part = data[low : high + WINDOW - 1]
        hashes = _grams(part)
        anchor = _least_places(hashes, WINDOW - GRAM + 1)
        at = np.arange(low, low + len(anchor))
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + WINDOW <= offsets[text + 1]
        new = np.empty(len(at), bool)
        new[:1] = True
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        good = inside[first]
        first, count = first[good], count[good]
        self.text = text[first]
        self.start = at[first] - offsets[self.text]
        self.windows = count
        self.lead = anchor[first] - first
        self.gram = hashes[anchor[first]].view(np.int64)
        raw = part.tobytes()
        self.region = np.fromiter((_hash(raw[a : a + n + WINDOW - 1]) for a, n in zip(first.tolist(), count.tolist(), strict=True)), np.int64, len(first))


def _emit(block: Block, keys: pa.Array, ids: pa.Array) -> pa.RecordBatch:
    """The units of a block. Units that repeat inside one text are told once, and the run of windows they cover as a row
    without anchor, so that a text of one line over and over is a few rows."""
    order = np.lexsort((np.arange(len(block.text)), block.region, block.gram, block.text))
    same = (np.diff(block.text[order]) == 0) & (np.diff(block.region[order]) == 0) & (np.diff(block.gram[order]) == 0)
    begin = np.flatnonzero(np.concatenate(([True], ~same))) if len(order) else np.zeros(0, np.int64)
    copies = np.diff(np.append(begin, len(order)))
    chosen = order[begin]
    many = np.zeros(len(order), bool)
    many[order] = np.repeat(copies > 1, copies)
    again = np.flatnonzero(many)
    joined = np.ones(len(again), bool)
    joined[1:] = (block.text[again[1:]] != block.text[again[:-1]]) | (block.start[again[1:]] > block.start[again[:-1]] + block.windows[again[:-1]])
    run = np.flatnonzero(joined)
    ends = np.append(run[1:], len(again)) - 1
    from_, to = again[run], again[ends] if len(run) else again
    text = np.concatenate((block.text[chosen], block.text[from_]))
    n, m = len(chosen), len(from_)
    nothing = np.concatenate((np.zeros(n, bool), np.ones(m, bool)))
    zeros = np.zeros(m, np.int64)
    take = pa.array(text, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            keys.take(take),
            ids.take(take),
            pa.array(np.concatenate((block.start[chosen], block.start[from_])).astype(np.int32)),
            pa.array(np.concatenate((block.windows[chosen], block.start[to] + block.windows[to] - block.start[from_])).astype(np.int32)),
            pa.array(np.concatenate((block.lead[chosen], zeros)).astype(np.int32)),
            pa.array(np.concatenate((block.gram[chosen], zeros)), mask=nothing),
            pa.array(np.concatenate((block.region[chosen], zeros)), mask=nothing),
            pa.array(np.concatenate((copies, zeros)).astype(np.int64)),
        ],
        names=["key", "id", "start", "windows", "lead", "gram", "region", "copies"],
    )


def _cut_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of ``key, id, text``."""
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = utf8_buffers(piece.column(2))
            for low in range(0, max(len(data) - WINDOW + 1, 0), BLOCK):
                block = Block(data, offsets, low, min(low + BLOCK, len(data) - WINDOW + 1))
                if len(block.text):
                    yield _emit(block, piece.column(0), piece.column(1))


_KINDS = "key binary, id string, start int, windows int, lead int, gram long, region long, copies long, kinds long"


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted units of each text: ``text, key, id, wanted`` to one row per unit."""
    for batch in batches:
        for piece in pieces(batch):
            names = piece.schema.names
            text, wanted = piece.column(names.index("text")), piece.column(names.index("wanted"))
            data, offsets = utf8_buffers(text)
            raw = memoryview(data)
            rows = wanted.flatten()
            counts = np.diff(wanted.offsets.to_numpy())
            of = np.repeat(np.arange(piece.num_rows), counts)
            start = offsets[of] + rows.field("start").to_numpy()
            stop = start + rows.field("windows").to_numpy() + WINDOW - 1
            fields = [rows.field(f) for f in ("start", "windows", "lead", "gram", "region", "copies", "kinds")]
            keys, ids = piece.column(names.index("key")).take(pa.array(of)), piece.column(names.index("id")).take(pa.array(of))
            for a in range(0, len(of), 4096):
                b = min(a + 4096, len(of))
                part = pa.array([raw[x:y].tobytes() for x, y in zip(start[a:b].tolist(), stop[a:b].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), ids.slice(a, b - a), *[f.slice(a, b - a) for f in fields], part],
                    names=["key", "id", "start", "windows", "lead", "gram", "region", "copies", "kinds", "bytes"],
                )


def repeated_windows(regions: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that start more than once in a shard: number of the region, first window, number of windows."""
    if not regions:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.array([len(r) + 1 for r in regions])
    text = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8).astype(np.int32) + 1
    ends = np.cumsum(lengths) - 1
    text[ends] = 0
    suffix, shared = sorted_suffixes(text, 257)
    far = shared >= window
    both = far.copy()
    both[:-1] |= far[1:]
    places = np.sort(suffix[both])
    if not len(places):
        return places, places, places
    region = np.searchsorted(ends, places, "right")
    new = np.concatenate(([True], (np.diff(places) > 1) | (np.diff(region) > 0)))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(places)))
    return region[first], places[first] - (ends - lengths + 1)[region[first]], count


def _sifted(data: np.ndarray, first: np.ndarray, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that may repeat: number of the unit, first and last window of each stretch.

    Windows at nearly the same distance from their anchor have most of their bytes in common; where no other unit of the
    anchor has these bytes, none of the windows can repeat and they are not sorted.
    """
    width = WIDTHS[0]
    lead, windows, gram = (rows.column(n).to_numpy().astype(np.int64) for n in ("lead", "windows", "gram"))
    low, high = (lead - windows + 1) // width, lead // width
    counts = high - low + 1
    unit = np.repeat(np.arange(len(lead)), counts)
    block = high[unit] - (np.arange(len(unit)) - np.repeat(np.cumsum(counts) - counts, counts))  # windows in order
    near = lead[unit] - block * width
    begin = first[unit] + near
    told = np.empty(len(unit), np.uint64)
    length, row = WINDOW - width + 1, 0
    while row < len(unit):  # a bounded piece of the bytes at a time
        stop = max(row + 1, int(np.searchsorted(begin, begin[row] + BLOCK)))
        at, low = begin[row:stop], int(begin[row:stop].min())
        part = data[low : int(at.max()) + length]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * powers(_BASE, len(part)), out=sums[1:])
            told[row:stop] = (sums[at - low + length] - sums[at - low]) * powers(_INVERSE, len(part))[at - low]
        row = stop
    with np.errstate(over="ignore"):
        told = mixed(told) ^ mixed(gram[unit].view(np.uint64) + block.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    _, which, often = np.unique(told, return_inverse=True, return_counts=True)
    kept = often[which] > 1
    unit, a, z = unit[kept], np.maximum(near - width + 1, 0)[kept], np.minimum(near, windows[unit] - 1)[kept]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (a[1:] > z[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(unit))[: len(begin)] - 1
    return unit[begin], a[begin], z[last]


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, start, windows`` of the runs that repeat, of whole anchors, some anchors at a time."""
    held: list[pa.Table] = []
    size = 0
    for group in whole_groups(batches, "gram"):
        held.append(group)
        size += group.column("bytes").nbytes
        if size >= SHARD:
            yield _sorted_shard(held)
            held, size = [], 0
    if held:
        yield _sorted_shard(held)


def _sorted_shard(held: list[pa.Table]) -> pa.RecordBatch:
    rows = pa.concat_tables(held).combine_chunks()
    chunk = rows.column("bytes").combine_chunks()
    raw, offsets = utf8_buffers(chunk.cast(pa.large_binary()).view(pa.large_string()))
    unit, a, z = _sifted(raw, offsets[:-1], rows)
    view = memoryview(np.ascontiguousarray(raw))
    stretch, first, count = repeated_windows([view[x:y].tobytes() for x, y in zip((offsets[unit] + a).tolist(), (offsets[unit] + z + WINDOW).tolist(), strict=True)])
    region, first = unit[stretch], a[stretch] + first
    # A unit with copies has been told as a whole.
    single = rows.column("copies").to_numpy()[region] == 1 if len(region) else np.zeros(0, bool)
    region, first, count = region[single], first[single], count[single]
    take = pa.array(region, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            rows.column("key").take(take).combine_chunks(),
            pa.array((rows.column("start").to_numpy()[region] + first).astype(np.int32)),
            pa.array(count.astype(np.int32)),
        ],
        names=["key", "start", "windows"],
    )


def _pieces_of(width: int):
    """Units with their bytes, cut by the distance from window to anchor; the common bytes of a piece are its new anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, id_, start, windows, lead, gram, copies, data in zip(
                *[batch.column(batch.schema.names.index(n)).to_pylist() for n in ("key", "id", "start", "windows", "lead", "gram", "copies", "bytes")], strict=True
            ):
                for block in range((lead - windows + 1) // width, lead // width + 1):
                    near, far = block * width, block * width + width - 1
                    a, b = max(0, lead - far), min(windows - 1, lead - near)
                    part = data[a : b + WINDOW]
                    common = data[lead - near : lead - far + WINDOW]
                    out.append((key, id_, start + a, b - a + 1, lead - a, _hash(b"%d %d " % (gram, block) + common), _hash(part), copies, part))
            columns = list(zip(*out, strict=True)) or [()] * 9
            types = [pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*UNITS.replace(",", "").split()[::2], "bytes"])

    return cut


def _kinds(units: DataFrame) -> DataFrame:
    """One row per anchor and unit: how often it occurs, where one of them lies, and how many kinds the anchor has."""
    one = F.min(F.struct("key", "id", "start", "windows", "lead")).alias("one")
    known = materialise(units.groupBy("gram", "region").agg(F.sum("copies").alias("copies"), one), "kinds")
    kinds = known.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    return known, known.join(kinds, "gram").select("one.*", "gram", "region", "copies", "kinds")


def _covered(units: DataFrame, known: DataFrame) -> DataFrame:
    """Windows of units that occur more than once."""
    again = known.where("copies > 1").select("gram", "region")
    return units.join(again, ["gram", "region"], "left_semi").select("key", "start", "windows")


def repeats(docs: DataFrame, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """``doc_id, key, id, text, n_bytes, sha`` of the rows, and ``key, spans`` of the texts with repeats.

    ``spans`` are sorted ``(start, stop)`` byte ranges, apart from each other.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("sha"))
    rows = rows.select("doc_id", F.substring(F.unhex("sha"), 1, 16).alias("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text", F.octet_length("text").cast("bigint").alias("n_bytes"), "sha")
    long = rows.where(F.col("n_bytes") >= WINDOW)
    units = materialise(long.select("key", "id", "text").mapInArrow(lean(_cut_units), UNITS), "units")
    known, differing = _kinds(units.where(F.col("gram").isNotNull()))
    found = [units.where(F.col("gram").isNull()).select("key", "start", "windows"), _covered(units, known)]
    # The bytes of one unit of each kind, for anchors with several.
    unit = F.struct("start", "windows", "lead", "gram", "region", "copies", "kinds")
    wanted = differing.groupBy("key", "id").agg(F.collect_list(unit).alias("wanted"))
    cut = long.select("key", "id", "text").join(wanted, ["key", "id"]).mapInArrow(lean(_with_text), f"{_KINDS}, bytes binary")
    cut = materialise(cut, "cut-units")
    for round_, width in enumerate([*WIDTHS, None]):
        # A repeated row gives its units again; anchors stay whole.
        few = cut.where(F.col("kinds") <= most).dropDuplicates(["gram", "region"])
        slim = few.select("key", "start", "windows", "lead", "copies", "gram", "bytes").repartition("gram").sortWithinPartitions("gram")
        found.append(materialise(slim.mapInArrow(lean(_sort_shards), "key binary, start int, windows int"), "repeats"))
        hot = cut.where(F.col("kinds") > most)
        if width is None or hot.isEmpty():
            break
        hot = hot.dropDuplicates(["gram", "region"])
        parts = materialise(hot.mapInArrow(_pieces_of(width), f"{UNITS}, bytes binary"), f"pieces-{round_}")
        known, differing = _kinds(parts)
        found.append(_covered(parts.where("copies = 1"), known))
        one = differing.select("gram", "region", F.struct("key", "id", "start").alias("_one"), F.col("copies").alias("_copies"), "kinds")
        chosen = parts.join(one, ["gram", "region"]).where(F.struct("key", "id", "start") == F.col("_one"))
        cut = materialise(chosen.select("key", "id", "start", "windows", "lead", "gram", "region", F.col("_copies").alias("copies"), "kinds", "bytes"), f"cut-{round_}")
    places = found[0]
    for more in found[1:]:
        places = places.unionAll(more)
    span = F.struct(F.col("start"), (F.col("start") + F.col("windows") + F.lit(WINDOW - 1)).alias("stop"))
    spans = places.groupBy("key").agg(F.sort_array(F.collect_set(span)).alias("all"))
    return rows, spans.select("key", _joined("all").alias("spans"))


def _joined(spans: str):
    """Sorted ranges with those that overlap or touch made one."""

    def add(done, span):
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        touches = (F.size(done) > 0) & (F.coalesce(last["stop"], F.lit(-1)) >= span["start"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.slice(F.col(spans), 1, 0), add)


_RESULT = "key binary, n_removed long, n_spans long, kept_sha256 string"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        out = []
        for key, text, spans in zip(*[batch.column(names.index(n)) for n in ("key", "text", "spans")], strict=True):
            raw = memoryview(text.as_buffer())
            digest, at, gone = hashlib.sha256(), 0, 0
            for start, stop in zip(spans.values.field("start").to_pylist(), spans.values.field("stop").to_pylist(), strict=True):
                digest.update(raw[at:start])
                gone += stop - start
                at = stop
            digest.update(raw[at:])
            out.append((key.as_py(), gone, len(spans), digest.hexdigest()))
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["key", "n_removed", "n_spans", "kept_sha256"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their repeats; a character cut in two loses its rest."""
    for batch in batches:
        names = batch.schema.names
        text, spans = batch.column(names.index("text")), batch.column(names.index("spans"))
        out = []
        for t, s in zip(text, spans, strict=True):
            if not s.is_valid:
                out.append(t.as_py())
                continue
            raw, at, kept = t.as_py().encode(), 0, []
            for span in s.as_py():
                kept.append(raw[at : span["start"]])
                at = span["stop"]
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([batch.column(names.index("doc_id")), pa.array(out, pa.string())], names=["doc_id", "text"])


def without_repeats(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``doc_id, text``: the texts without any string of ``WINDOW`` bytes that occurs elsewhere."""
    rows, spans = repeats(docs, most)
    joined = rows.join(materialise(spans, "spans"), "key", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(lean(_without), f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def removed_repeats(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; see the head of this module for the odd cases.

    Texts without repeats and texts that are repeats as a whole need no second look; only the others are read again.
    """
    rows, spans = repeats(docs, most)
    spans = materialise(spans, "spans")
    slim = rows.select("doc_id", "key", "n_bytes", "sha")
    whole = (F.size("spans") == 1) & (F.col("spans")[0]["start"] == 0)
    part = rows.select("key", "text", "n_bytes").join(spans, "key").where(~(whole & (F.col("spans")[0]["stop"] == F.col("n_bytes"))))
    partial = materialise(part.select("key", "text", "spans").mapInArrow(lean(_removed), _RESULT), "partly-removed")
    gone = spans.where(whole).select("key", F.col("spans")[0]["stop"].cast("bigint").alias("_whole"))
    out = slim.join(partial, "key", "left").join(gone, "key", "left")
    all_gone = F.col("_whole") == F.col("n_bytes")
    none = F.lit(0).cast("bigint")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(all_gone, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(all_gone, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
