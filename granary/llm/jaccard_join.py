"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti, Kaushik: Efficient exact set-similarity joins).

A document's set holds its distinct shingles as 64-bit hashes. Two sets with a similarity of at least ``share`` / 100
have sizes within that ratio, so they lie in one size band or in neighbouring ones, and differ in at most
``k = (100 - share) / (100 + share) * both sizes`` features. A set has signatures for three meetings: with sets of its
own band, of the next and of the one before; each has its own ``k``.

The feature domain is cut into ``k // 2 + 1 + m`` first-level partitions and each of those into ``SECOND`` of the second
level. Two sets differ by more than one feature in at most ``k // 2`` first-level partitions; in each of the other
``m + 1`` the one feature lies in one second-level partition, and the sets agree on the subset that leaves it out. So all
subsets that leave one second-level partition out are enumerated, and what the set holds there is a signature. Subsets
in which a set holds nothing are no signature: if at most ``m`` of its first-level partitions have such a subset, one
of the ``m + 1`` still gives a common signature. A set with more of them adds the signatures of another hashing of the
domain, until it has few; its partner, which has the same trouble or is found already, does the same.

Signatures only propose groups of sets. A group above ``GROUP`` sets, as a passage in very many texts makes it, is dealt
over blocks and worked off block against block. Inside a group sizes and 64 one-byte minima per set drop pairs that
cannot be similar (a pair at the threshold is dropped with a chance below 1e-7). What remains is cut into families, each family's texts are
brought together once, and the shingle sets themselves decide, pair by pair, until a family's links are known. Exact
copies count as one set throughout. Families above ``BLOCK`` sets are worked off block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from granary.llm.tables import free_name, maybe_with, whole_groups, without_ids
from granary.llm.words import U, Words, lean, mixed, pieces, powers, utf8_buffers
from granary.operators.components import component_roots
from granary.session import materialise

MINIMA = 64
#: Equal minima out of 64 below which a pair is not looked at: 48 are expected at a similarity of 0.75.
LEAST_EQUAL = 28
#: Signatures sorted at once in a map task, and aimed at per bucket of the shuffle.
BATCH = 1_000_000
#: Distinct sets of a family that one task compares with one another.
BLOCK = 3000
#: Sets of one signature that one task compares by their minima.
GROUP = 2000
#: Second-level partitions of each first-level partition.
SECOND = 3
_ODD = np.random.default_rng(7).integers(1, 1 << 63, MINIMA, dtype=np.uint64) * U(2) + U(1)
_STEP = [int(x) for x in np.random.default_rng(8).integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)]


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than ``n`` words make one shingle, none make none."""
    hashes = words.hash
    if len(hashes) >= n:
        rolled = np.zeros(len(hashes) - n + 1, np.uint64)
        for j in range(n):
            rolled += hashes[j : len(hashes) - n + 1 + j] * U(_STEP[j])
        rolled = mixed(rolled)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(rolled[a : b - n + 1])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            part = hashes[a:b] * np.array([_STEP[j % 64] for j in range(b - a)], np.uint64)
            sets.append(mixed(np.array([part.sum(dtype=np.uint64) + U(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_hash(s: np.ndarray) -> int:
    return int(mixed(np.array([mixed(s).sum(dtype=np.uint64) + U(len(s))], np.uint64)).view(np.int64)[0])


def minima(s: np.ndarray) -> bytes:
    """One byte of the least value under each of 64 hashings."""
    out = np.empty(MINIMA, np.uint64)
    for i in range(MINIMA):
        out[i] = (s * _ODD[i]).min()
    return (mixed(out) & U(255)).astype(np.uint8).tobytes()


def band_edges(share: int, largest: int) -> np.ndarray:
    """Upper ends of the size bands; sets of a similar pair are in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] < largest:
        edges.append(max(edges[-1] + 1, edges[-1] * 100 // share))
    return np.array(edges)


EDGES = {75: band_edges(75, 1 << 40)}


def _meetings(size: int, share: int) -> Iterator[tuple[int, int, int]]:
    """(key, first-level partitions, spare ones among them) for the sets that one of ``size`` shingles may be similar to."""
    if share not in EDGES:
        EDGES[share] = band_edges(share, 1 << 40)
    edges = EDGES[share]
    band = int(np.searchsorted(edges, size))
    for below in range(max(band - 1, 0), band + 1):
        least = int(edges[below])
        most = min(int(edges[below + 1]), least * 100 // share)
        # The sets of one band, then those of a band and the next; a smaller set needs more spare partitions.
        for key, sizes, eighths in ((2 * below, 2 * least, 2), (2 * below + 1, least + most, 3)):
            differing = (100 - share) * sizes // (100 + share)
            if differing and (below == band or key % 2):  # else only equal sets are similar
                needed = differing // 2 + 1
                spare = -(-needed * eighths // 8) if needed > 3 else 0
                yield key, needed + spare, spare


def signatures(s: np.ndarray, share: int) -> np.ndarray:
    """The set's signatures for its own band and its neighbours."""
    found = []
    hashings: list[tuple[np.ndarray, np.ndarray]] = []
    for key, ranges, spare in _meetings(len(s), share):
        parts = ranges * SECOND
        ends = np.arange(1, parts, dtype=np.uint64) * U((1 << 64) // parts)
        number = np.arange(parts, dtype=np.uint64).reshape(ranges, SECOND) * U(_STEP[0])
        for seed in range(50):
            if seed == len(hashings):
                ordered = np.sort(mixed(s + U(_STEP[seed]))) if seed else s
                total = np.zeros(len(s) + 1, np.uint64)
                np.cumsum(mixed(ordered), out=total[1:])
                hashings.append((ordered, total))
            ordered, total = hashings[seed]
            places = np.concatenate(([0], np.searchsorted(ordered, ends), [len(s)]))
            held = np.diff(places).reshape(ranges, SECOND)
            content = np.diff(total[places]).reshape(ranges, SECOND)
            left = held.sum(1, keepdims=True) > held  # something is left in the subset without this part
            chosen = left if seed < 49 else np.ones_like(left)  # not reached in practice; then empty subsets count as well
            subset = (content.sum(1, keepdims=True) - content + number)[chosen]
            found.append(mixed(subset + U(_STEP[1] * (key * 64 + seed) % (1 << 64))))
            if (~left).any(1).sum() <= spare:
                break
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _texts(batch: pa.RecordBatch, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in pieces(batch):
        yield part, shingle_sets(Words(*utf8_buffers(part.column(1))), n)


def _described(n: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, bytes] = {}
        for batch in batches:
            for part, sets in _texts(batch, n):
                hashes = [set_hash(s) if len(s) else None for s in sets]
                marks = []
                for h, s in zip(hashes, sets, strict=True):
                    if h is not None and h not in known:
                        if len(known) > 20_000:
                            known.clear()
                        known[h] = minima(s)
                    marks.append(known.get(h))
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.record_batch([part.column(0), sizes, pa.array(hashes, pa.int64()), pa.array(marks, pa.binary())], ["doc_id", "n_shingles", "set_id", "minima"])

    return lean(describe)


def _squeezed(values: np.ndarray) -> bytes:
    """``values`` byte plane by byte plane, compressed where that is shorter; the first byte tells which."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    short = zstandard.ZstdCompressor(level=1).compress(planes)
    return b"\1" + short if len(short) < len(planes) else b"\0" + planes


def _restored(blob: bytes, kind: type) -> np.ndarray:
    planes = zstandard.ZstdDecompressor().decompress(blob[1:]) if blob[0] else blob[1:]
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _proposed(n: int, share: int, bits: int):
    """Rows (bucket, signatures, sets): the sorted signatures of a run of documents, cut by their leading bits."""
    names = ["bucket", "signatures", "places", "sets"]

    def blobs(sigs: list[np.ndarray], sets: list[int]) -> Iterator[pa.RecordBatch]:
        lengths = [len(x) for x in sigs]
        if not sum(lengths):
            return
        every = np.concatenate(sigs)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), lengths)
        order = np.argsort(every)
        every, owner = every[order], owner[order]
        cuts = np.searchsorted(every, np.arange(1, 1 << bits, dtype=np.uint64) << U(64 - bits)) if bits else np.zeros(0, np.int64)
        cuts = np.concatenate(([0], cuts, [len(every)]))
        rest = (every >> U(32 - bits)).astype(np.uint32)
        ids = np.array(sets, np.int64)
        rows = []
        for bucket in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b = cuts[bucket], cuts[bucket + 1]
            used, place = np.unique(owner[a:b], return_inverse=True)
            steps = np.diff(rest[a:b], prepend=np.uint32(0))  # small, as the signatures are sorted
            place = place.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32)
            rows.append((bucket, _squeezed(steps), _squeezed(place), ids[used].tobytes()))
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        for a in range(0, len(rows), 64):
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 64], strict=True), types, strict=True)], names)

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, sets, seen, size = [], [], set(), 0
        for batch in batches:
            for _, found in _texts(batch, n):
                for s in found:
                    if not len(s):
                        continue
                    h = set_hash(s)
                    if h in seen:
                        continue
                    seen.add(h)
                    sigs.append(signatures(s, share))
                    sets.append(h)
                    size += len(sigs[-1])
                    if size > BATCH:
                        yield from blobs(sigs, sets)
                        sigs, sets, seen, size = [], [], set(), 0
        yield from blobs(sigs, sets)

    return lean(propose)


@lean
def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group_id, set_id, members) for the sets that share a signature; equal groups of a bucket once."""
    for rows in whole_groups(batches, "bucket"):
        buckets = rows.column("bucket").to_numpy()
        for bucket in np.unique(buckets):
            part = rows.filter(pa.array(buckets == bucket))
            sigs, sets = [], []
            for s, p, d in zip(part.column("signatures").to_pylist(), part.column("places").to_pylist(), part.column("sets").to_pylist(), strict=True):
                sigs.append(np.cumsum(_restored(s, np.uint32), dtype=np.uint32))
                ids = np.frombuffer(d, np.int64)
                sets.append(ids[_restored(p, np.uint16 if len(ids) <= 1 << 16 else np.uint32)])
            sigs, sets = np.concatenate(sigs), np.concatenate(sets)
            order = np.lexsort((sets, sigs))
            sigs, sets = sigs[order], sets[order]
            fresh = np.concatenate(([True], (sigs[1:] != sigs[:-1]) | (sets[1:] != sets[:-1])))
            sigs, sets = sigs[fresh], sets[fresh]
            begin = np.flatnonzero(np.concatenate(([True], sigs[1:] != sigs[:-1])))
            length = np.diff(np.concatenate((begin, [len(sigs)])))
            several = length > 1
            begin, length = begin[several], length[several]
            if not len(begin):
                continue
            sums = np.zeros(len(sets) + 1, np.uint64)
            np.cumsum(mixed(sets.view(np.uint64)), out=sums[1:])
            group = mixed(sums[begin + length] - sums[begin] + length.astype(np.uint64))
            _, once = np.unique(group, return_index=True)
            for a in range(0, len(once), 20_000):
                some = once[a : a + 20_000]
                l = length[some]
                at = np.repeat(begin[some] - np.concatenate(([0], np.cumsum(l)[:-1])), l) + np.arange(l.sum())
                yield pa.record_batch([pa.array(np.repeat(group[some].view(np.int64), l)), pa.array(sets[at]), pa.array(np.repeat(l, l))], ["group_id", "set_id", "members"])


def _near(share: int):
    """Edges (u, v) that span the sets of each group, or of two of its blocks, whose sizes and minima make a similar pair possible."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "task"):
            tasks = rows.column("task").to_numpy()
            ids = rows.column("set_id").to_numpy()
            size = rows.column("size").to_numpy()
            side = rows.column("side").to_numpy()
            sketch = np.frombuffer(b"".join(rows.column("minima").to_pylist()), np.uint8).reshape(-1, MINIMA)
            begin = np.flatnonzero(np.concatenate(([True], tasks[1:] != tasks[:-1])))
            length = np.diff(np.concatenate((begin, [len(tasks)])))

            def possible(x, others: np.ndarray) -> np.ndarray:
                fit = 100 * np.minimum(size[others], size[x]) >= share * np.maximum(size[others], size[x])
                return fit & ((sketch[others] == sketch[x]).sum(1) >= LEAST_EQUAL)

            two = begin[length == 2]
            good = two[possible(two, two + 1)]
            u, v = [ids[good]], [ids[good + 1]]
            for a, l in zip(begin[length > 2].tolist(), length[length > 2].tolist(), strict=True):
                every = np.arange(a, a + l)
                across = bool(side[every].any())
                left = [every[side[every] == k] for k in (0, 1)]
                while len(left[0]) and len(left[across]):
                    front, left[0] = [left[0][0]], left[0][1:]
                    while front:
                        x = front.pop()
                        other = 1 - int(side[x]) if across else 0
                        hit = possible(x, left[other])
                        if hit.any():
                            found = left[other][hit]
                            u.append(np.full(len(found), ids[x]))
                            v.append(ids[found])
                            front.extend(found.tolist())
                            left[other] = left[other][~hit]
            yield pa.record_batch([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return lean(near)


class _Union:
    def __init__(self, labels: np.ndarray):
        self.label = labels.copy()

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if a != b:
            self.label[self.label == max(a, b)] = min(a, b)


def _similar(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    if 100 * min(len(a), len(b)) < share * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= share * (len(a) + len(b) - common)


def _settle(sets: list[np.ndarray], sketch: np.ndarray, labels: np.ndarray, share: int, split: int = 0) -> np.ndarray:
    """Labels after all links; pairs that are joined already are not looked at. ``split``: only pairs across this place."""
    known = _Union(labels)
    sizes = np.array([len(s) for s in sets])
    for i in range(len(sets)):
        others = np.arange(max(i + 1, split), len(sets)) if i < split or not split else np.zeros(0, np.int64)
        others = others[(known.label[others] != known.label[i]) & (100 * np.minimum(sizes[others], sizes[i]) >= share * np.maximum(sizes[others], sizes[i]))]
        if len(others):
            equal = (sketch[others] == sketch[i]).sum(1)
            for j in others[equal >= LEAST_EQUAL][np.argsort(-equal[equal >= LEAST_EQUAL], kind="stable")].tolist():
                if known.label[i] != known.label[j] and _similar(sets[i], sets[j], share):
                    known.join(i, j)
    return known.label


def _linked(n: int, share: int):
    """Edges (u, v) that span the links among the sets of each block pair."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "task"):
            tasks = rows.column("task").to_numpy()
            for task in np.unique(tasks):
                part = rows.filter(pa.array(tasks == task)).combine_chunks()
                side = part.column("side").to_numpy()
                part = part.take(pa.array(np.argsort(side, kind="stable")))
                sets = shingle_sets(Words(*utf8_buffers(part.column("text").combine_chunks())), n)
                ids = part.column("set_id").to_numpy()
                sketch = np.frombuffer(b"".join(part.column("minima").to_pylist()), np.uint8).reshape(-1, MINIMA)
                labels = _settle(sets, sketch, np.arange(len(ids)), share, int((side == 0).sum()) if side.max() else 0)
                moved = labels != np.arange(len(ids))
                yield pa.record_batch([pa.array(ids[labels[moved]]), pa.array(ids[moved])], ["u", "v"])

    return lean(link)


def _blocks(families: DataFrame) -> DataFrame:
    """The sets of a family dealt over blocks of about ``BLOCK`` sets, one task for each block and pair of blocks."""
    sizes = families.groupBy("root").agg(F.count("*").alias("members"))
    return _paired(families.join(sizes, "root"), "root", BLOCK).select("set_id", "doc_id", "minima", "task", "side")


def _paired(rows: DataFrame, key: str, block: int) -> DataFrame:
    """``rows`` of groups of ``members`` sets with the ``task`` of each pair of blocks and the ``side`` of the set in it."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("set_id", key), blocks).cast("int"))
    both = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    lower, upper = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") <= F.col("other"), 0).otherwise(1).cast("int")
    return both.withColumns({"task": F.xxhash64(key, lower, upper), "side": side}).drop("block", "other", "members")


def jaccard_components(docs: DataFrame, n: int = 5, share: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of ``docs(doc_id, text)``, one row for each row of ``docs``.

    Words are what white space leaves of the text with A-Z in lower case. Documents link when
    ``100 * common shingles >= share * all shingles``; ``component_id`` is the least id that links lead to. A text that
    is null, empty or white space has no shingle and its own id. Rows that repeat an id are all returned and link like
    other rows; a null id stays null and is least in no component of other ids. Other columns are not read. An empty
    table gives no row. Equality rests on 64-bit hashes.
    """
    sets, labelled = _labelled(docs, n, share)
    return _components(sets, labelled)


def _components(sets: DataFrame, labelled: DataFrame) -> DataFrame:
    labelled = labelled.select("set_id", "component_id")
    return sets.join(labelled, "set_id", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _labelled(docs: DataFrame, n: int, share: int) -> tuple[DataFrame, DataFrame]:
    """The set of each row, and ``set_id, root, component_id`` of each distinct set; a component without an id has a null one."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = materialise(docs.mapInArrow(_described(n), "doc_id bigint, n_shingles bigint, set_id bigint, minima binary"), "sets")
    distinct = sets.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("minima").alias("minima"), F.first("n_shingles").alias("size"))
    distinct = materialise(distinct, "distinct-sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    bits = int(min(24, max(2, np.ceil(np.log2(1 + total / BATCH)))))
    blobs = docs.mapInArrow(_proposed(n, share, bits), "bucket int, signatures binary, places binary, sets binary")
    groups = blobs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_grouped, "group_id bigint, set_id bigint, members bigint")
    # Equal groups come from many buckets; they meet here, together with the minima of their sets.
    groups = materialise(groups.distinct().join(distinct.select("set_id", "minima", "size"), "set_id"), "groups")
    tasks = _paired(groups, "group_id", GROUP).drop("group_id")
    near = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_near(share), "u bigint, v bigint").distinct()
    families = materialise(component_roots(near).withColumnRenamed("vertex", "set_id"), "families")
    members = _blocks(families.join(distinct, "set_id"))
    # Copies of a set share its least id. Marks of the ids leave out nearly all other documents before the texts move; the
    # join on the set is exact. A set that only rows without an id have is looked for among those.
    holders = maybe_with(docs, families.join(distinct, "set_id").select("doc_id"))
    texts = holders.mapInArrow(_with_set(n), "doc_id bigint, set_id bigint, text string").dropDuplicates(["set_id"])
    work = members.join(texts.drop("doc_id"), "set_id").repartition("task").sortWithinPartitions("task")
    links = work.mapInArrow(_linked(n, share), "u bigint, v bigint")
    # An id that stands on several rows ties their sets together.
    ties = sets.where("set_id is not null and doc_id is not null").groupBy("doc_id").agg(F.min("set_id").alias("u"), F.max("set_id").alias("v")).where("u < v")
    links = links.unionAll(_ties(sets, ties))
    roots = component_roots(links).withColumnRenamed("vertex", "set_id")
    labelled = distinct.join(roots, "set_id", "left").select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return sets, labelled.join(least, "root").select("set_id", "root", "component_id")


def without_near_duplicates(docs: DataFrame, n: int = 5, share: int = 75) -> DataFrame:
    """The rows of ``docs`` with the least id of their component, all columns.

    Of rows that repeat such an id one stays, the one with the least columns. Rows with a null id
    go where a row with an id is in their component; of a component without ids one row stays. Those without a shingle stay.
    Columns of any name keep their values.
    """
    sets, labelled = _labelled(docs, n, share)
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return _least_ids(docs, sets, labelled)
    labelled = materialise(labelled, "labelled-sets")
    # The number of a row is written with it: it tells rows without an id apart.
    row = free_name(docs.columns, "_row")
    nameless = materialise(nameless.withColumn(row, F.monotonically_increasing_id()), "rows-without-id")
    numbered = nameless.select(F.col(row).alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = numbered.mapInArrow(_with_set(n), "doc_id bigint, set_id bigint, text string").where("set_id is not null").select(F.col("doc_id").alias(row), "set_id")
    own = materialise(own.join(labelled, "set_id").select(row, "root", "component_id"), "sets-without-id")
    one = own.where("component_id is null").groupBy("root").agg(F.min(row).alias(row)).select(row)
    gone = own.select(row).join(one, row, "left_anti")
    rest = nameless.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    return _least_ids(docs.where("doc_id is not null"), sets, labelled).unionAll(rest)


def _least_ids(docs: DataFrame, sets: DataFrame, labelled: DataFrame) -> DataFrame:
    found = materialise(_components(sets, labelled).select("doc_id", "component_id").where("doc_id is not null"), "components")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    rest = without_ids(docs, gone)
    repeated = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1").select("doc_id")
    repeated = materialise(repeated, "repeated")
    if repeated.isEmpty():
        return rest  # the usual case: an id stands on one row
    others = [F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]
    again = maybe_with(rest, repeated).join(repeated, "doc_id", "left_semi")
    again = again.groupBy("doc_id").agg(F.min(F.struct(*others)).alias("_row")).select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    return without_ids(rest, repeated).unionAll(again)


def _ties(sets: DataFrame, ties: DataFrame) -> DataFrame:
    repeated = sets.where("set_id is not null").join(ties, "doc_id")
    return repeated.where("set_id > u").select("u", F.col("set_id").alias("v"))


def _with_set(n: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _texts(batch, n):
                hashes = pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())
                yield pa.record_batch([part.column(0), hashes, part.column(1)], ["doc_id", "set_id", "text"])

    return lean(add)
