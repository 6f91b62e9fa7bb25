"""Near duplicates among embeddings: iterative quantisation, multi-index Hamming tables, reranking with the vectors.

ITQ (Gong, Lazebnik) learns a rotation of the centred principal axes that makes sign codes lose least; it looks at
``SAMPLE`` vectors at most. A code of 64 bits is cut into ``CHUNKS`` chunks, and a table for every choice of ``TOGETHER`` chunks
brings the vectors that agree in them into one bucket; every vector is in every table, at every size of the input.
Vectors at the threshold agree in two of eight chunks in 99 of 100 cases; ``tests/llm`` measures it.

Only ids and codes are dealt out to the buckets. Pairs whose codes differ in more than 14 of 64 bits are dropped there, a pair
counts in the first table that has both in one bucket, and only vectors with such a partner are fetched, once, and sent to
that bucket, where their cosine in double precision decides. So nothing below the threshold links.

Equal vectors of one label are one vector with a number of copies, told by 128 bits of hashes. Buckets are worked off in
blocks of about ``BLOCK`` vectors, block against block in tasks of their own; how many blocks a bucket has is estimated from a share of the
vectors, which bears on the sizes of tasks and not on the result. Only counts of links and one edge per vector and task leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from granary.llm.tables import bounded_sample, whole_groups
from granary.llm.words import lean
from granary.operators.components import component_roots
from granary.session import discard, materialise

SAMPLE = 5000
CHUNKS = 8
TOGETHER = 2
BLOCK = 2000
#: One class in so many tells the sizes of the buckets.
SHARE = 64
#: Groups up to this size are compared place by place, larger ones as matrices.
_SMALL = 32
_BITS = 64


def chunk_cuts(bits: int) -> np.ndarray:
    """Where the chunks of a code begin, and its end."""
    return np.linspace(0, bits, min(CHUNKS, bits) + 1).astype(int)


def choices(bits: int) -> list[tuple[int, ...]]:
    """The chunks of each table; short codes, whose chunks are a bit or so, have one chunk per table."""
    return list(combinations(range(len(chunk_cuts(bits)) - 1), TOGETHER if bits >= 2 * CHUNKS else 1))


def furthest(bits: int) -> int:
    """Bits in which the codes of a pair may differ; short codes tell too little to drop a pair."""
    return bits * 7 // 32 if bits >= 32 else bits


def itq(sample: np.ndarray, bits: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection (dimensions x bits) of the codes."""
    centre = sample.mean(0)
    x = sample - centre
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :bits]
    v = x @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((bits, bits)))
    for _ in range(rounds):
        a, _, b = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (a @ b).T
    return centre, axes @ turn


def plain_projection(size: int) -> tuple[np.ndarray, np.ndarray]:
    """For sizes of vectors that the sample hardly holds: a random rotation."""
    turn, _ = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return np.zeros(size), turn[:, : min(_BITS, size)]


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(models: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Rows (row, code, bits) for rows (row, embedding)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in vectors], np.int64)
            codes = np.zeros(len(vectors), np.uint64)
            for size in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == size)
                if size not in models:
                    models[size] = plain_projection(size)
                centre, projection = models[size]
                signs = (_unit([vectors[i] for i in here]) - centre) @ projection >= 0
                codes[here] = (signs.astype(np.uint64) << np.arange(signs.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)
            bits = np.minimum(sizes, _BITS).astype(np.int32)
            yield pa.record_batch([batch.column(0), pa.array(codes.view(np.int64)), pa.array(bits)], ["row", "code", "bits"])

    return lean(code)


def _widths(bits: int) -> tuple[np.ndarray, np.ndarray]:
    cuts = chunk_cuts(bits)
    return cuts[:-1].astype(np.uint64), ((1 << np.diff(cuts).astype(object)) - 1).astype(np.uint64)


@lean
def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lab, key, rep, code), one for each table; a key is the number of bits, the table, and the bits of its chunks."""
    for batch in batches:
        rep, lab, code, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "lab", "code", "bits"))
        for bits in np.unique(size).tolist():
            here = np.flatnonzero(size == bits)
            low, mask = _widths(bits)
            value = (code[here].view(np.uint64)[:, None] >> low) & mask
            keys = []
            for table, choice in enumerate(choices(bits)):
                entry = np.zeros(len(here), np.int64)
                for c in choice:
                    entry = entry << int(mask[c]).bit_length() | value[:, c].astype(np.int64)
                keys.append((bits << 22 | table << 16) | entry)
            times = len(keys)
            columns = [np.tile(lab[here], times), np.concatenate(keys).astype(np.int32), np.tile(rep[here], times), np.tile(code[here], times)]
            yield pa.record_batch([pa.array(c) for c in columns], ["lab", "key", "rep", "code"])


def _first_tables(bits: int) -> np.ndarray:
    """For every set of agreeing chunks, as bits of a number, the first table they have in common; -1 if none."""
    tables = choices(bits)
    first = np.full(1 << (len(chunk_cuts(bits)) - 1), -1)
    for agree in range(len(first)):
        first[agree] = next((t for t, choice in enumerate(tables) if all(agree >> c & 1 for c in choice)), -1)
    return first


def _meets(a: np.ndarray, b: np.ndarray, key: int | np.ndarray) -> np.ndarray:
    """Whether two codes are near, and the table of ``key`` is the first one that they share."""
    differ = a ^ b
    bits = np.broadcast_to(np.asarray(key) >> 22, differ.shape)
    table = np.broadcast_to(np.asarray(key) >> 16 & 63, differ.shape)
    good = np.zeros(differ.shape, bool)
    for size in np.unique(bits).tolist():
        here = np.nonzero((bits == size) & (np.bitwise_count(differ) <= furthest(size)))
        low, mask = _widths(size)
        agree = np.zeros(len(here[0]), np.int64)
        for c, (place, wide) in enumerate(zip(low, mask, strict=True)):
            agree |= (((differ[here] >> place) & wide) == 0).astype(np.int64) << c
        good[here] = _first_tables(size)[agree] == table[here]
    return good


def _partnered(lab: np.ndarray, key: np.ndarray, deal: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Which rows of whole, sorted groups have a partner in their group. Memory is bounded whatever the size of a group."""
    n = len(key)
    task = deal >> 1
    new = np.ones(n, bool)
    new[1:] = (lab[1:] != lab[:-1]) | (key[1:] != key[:-1]) | (task[1:] != task[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, n))
    group, long = np.repeat(np.arange(len(begin)), length), np.repeat(length, length)
    across = (task >> 20) != (task & ((1 << 20) - 1))  # two blocks: pairs inside a block have a task of their own
    met = np.zeros(n, bool)
    for step in range(1, _SMALL):
        i = np.flatnonzero((group[:-step] == group[step:]) & (long[:-step] <= _SMALL)) if step < n else np.zeros(0, np.int64)
        if not len(i):
            break
        j = i + step
        good = _meets(code[i], code[j], key[i]) & (~across[i] | ((deal[i] ^ deal[j]) & 1 == 1))
        met[i[good]] = True
        met[j[good]] = True
    for a, l in zip(begin[length > _SMALL].tolist(), length[length > _SMALL].tolist(), strict=True):
        own, side = code[a : a + l], deal[a : a + l] & 1
        for low in range(0, l, 256):
            rows = own[low : low + 256]
            good = _meets(rows[:, None], own[None, :], int(key[a]))
            if across[a]:
                good &= side[low : low + 256, None] != side[None, :]
            good[np.arange(len(rows)), low + np.arange(len(rows))] = False
            met[a + low : a + low + len(rows)] |= good.any(1)
    return met


@lean
def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (key, deal, rep) that have a partner in their group, out of batches sorted by group."""
    names = ("lab", "key", "deal", "rep", "code")
    kept = None

    def told(rows):
        lab, key, deal, rep, code = rows
        met = _partnered(lab, key, deal, code.view(np.uint64))
        return pa.record_batch([pa.array(key[met]), pa.array(deal[met]), pa.array(rep[met])], ["key", "deal", "rep"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if kept is not None:
            rows = [np.concatenate(pair) for pair in zip(kept, rows, strict=True)]
        lab, key, deal = rows[:3]
        last = np.flatnonzero((lab != lab[-1]) | (key != key[-1]) | (deal >> 1 != deal[-1] >> 1))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield told([c[:cut] for c in rows])
        kept = [c[cut:] for c in rows]
    if kept is not None:
        yield told(kept)


def _connected(near: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least label that each vector reaches over ``near``, a symmetric matrix."""
    while True:
        best = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
        new = np.minimum(label, best)
        if (new == label).all():
            return label
        label = new


def _linked(least: float):
    """Rows (rep, links, other): links counted in this task, and an edge to the least vector reached in it."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "task"):
            tasks = np.array(rows.column("task").to_pylist(), object)
            begin = np.flatnonzero(np.concatenate(([True], tasks[1:] != tasks[:-1])))
            end = np.append(begin[1:], len(tasks))
            begin, end = begin[end - begin > 1], end[end - begin > 1]
            out_rep, out_links, out_other = [], [], []
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                part = rows.slice(a, b - a)
                rep, copies, side, code = (part.column(c).to_numpy() for c in ("rep", "copies", "side", "code"))
                x = _unit(part.column("embedding").to_pylist())
                near = x @ x.T >= least
                np.fill_diagonal(near, False)
                if part.column("across")[0].as_py():
                    near &= side[:, None] != side[None, :]
                i, j = np.nonzero(near)
                good = _meets(code[i].view(np.uint64), code[j].view(np.uint64), part.column("key")[0].as_py())
                near[i[~good], j[~good]] = False
                i, j = i[good], j[good]
                if not len(i):
                    continue
                links = np.bincount(i, copies[j], len(rep)).astype(np.int64)
                told = links > 0
                out_rep.append(rep[told])
                out_links.append(links[told])
                out_other.append(_connected(near, rep.astype(np.int64))[told])
            if out_rep:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (out_rep, out_links, out_other)], ["rep", "links", "other"])

    return lean(link)


def _models(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A centre and a projection for each size of vectors that the sample holds often enough."""
    distinct = rows.where("h1 is not null").groupBy("h1").agg(F.min("row").alias("row"))
    sample = bounded_sample(materialise(distinct, "hashes"), "h1", SAMPLE).select("row")
    sizes: dict[int, list] = {}
    # At most SAMPLE row numbers.
    for (vector,) in rows.join(F.broadcast(sample), "row", "left_semi").orderBy("h1").select("embedding").collect():
        sizes.setdefault(len(vector), []).append(vector)
    return {size: itq(_unit(some), min(_BITS, size)) for size, some in sizes.items() if len(some) >= 4 * size}


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``.

    Vectors of equal, not null labels and equal size link at a cosine of ``least`` or more, copies included.
    ``component_id`` is the least id reached, ``kept`` marks it. Vectors that are null, empty, zero or hold a null or a
    component that is not finite link with nothing. A null ``vec_id`` stays null, links like others and names no
    component; rows that repeat an id count as vectors of their own. Other columns are not read. An empty table gives no row.
    """
    kind = vectors.schema["embedding"].dataType
    kind = kind if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else T.ArrayType(T.DoubleType())
    typed = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), F.col("label"))
    good = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    good = F.coalesce(good & F.exists("embedding", lambda v: v != 0), F.lit(False))
    # -0.0 and 0.0 are one number; copies are told by their components.
    content = F.transform("embedding", lambda v: v + F.lit(0.0))
    rows = typed.select(
        "vec_id",
        F.col("label").cast("string").alias("label"),
        F.when(good, F.col("embedding")).alias("embedding"),
        F.when(good, F.xxhash64("label", content)).alias("h1"),
        F.when(good, F.xxhash64(F.lit("second"), content, "label")).alias("h2"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialise(rows, "vectors")
    whole = rows.where("h1 is not null")
    codes = whole.select("row", "embedding").mapInArrow(_coded(_models(rows)), "row bigint, code bigint, bits int")
    # The row numbers of a class bring its code, its label and its vector; the vectors themselves stay where they are.
    classes = whole.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.min("row").alias("row"), F.min("label").alias("label"), F.min(F.size("embedding")).alias("size"))
    classes = classes.join(codes, "row").withColumn("lab", F.xxhash64("label", "size")).withColumn("rep", F.monotonically_increasing_id())
    classes = materialise(classes, "classes")
    some = classes.where(F.pmod(F.xxhash64("rep"), F.lit(SHARE)) == 0)
    shape = "lab bigint, key int, rep bigint, code bigint"
    sizes = some.select("rep", "lab", "code", "bits").mapInArrow(_entries, shape).groupBy("lab", "key").agg(F.ceil(F.count("*") * SHARE / BLOCK).cast("int").alias("blocks"))
    hot = materialise(sizes.where("blocks > 1"), "hot-buckets")
    entries = classes.select("rep", "lab", "code", "bits").mapInArrow(_entries, shape).join(hot, ["lab", "key"], "left")
    own = F.pmod(F.xxhash64("rep", F.lit("block")), F.coalesce("blocks", F.lit(1))).cast("bigint")
    dealt = entries.select("lab", "key", "rep", "code", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("blocks", F.lit(1)).cast("bigint") - 1)).alias("other"))
    # The two blocks of a task and, as the last bit, on which side the vector is.
    deal = F.shiftleft(F.shiftleft(F.least("own", "other"), 20) + F.greatest("own", "other"), 1) + F.when(F.col("own") <= F.col("other"), 0).otherwise(1)
    dealt = dealt.select("lab", "key", deal.alias("deal"), "rep", "code")
    task = ["lab", "key", F.shiftright("deal", 1)]
    sent = materialise(dealt.repartition(*task).sortWithinPartitions(*task).mapInArrow(_candidates, "key int, deal bigint, rep bigint"), "candidates")
    told = classes.join(sent.select("rep").distinct(), "rep", "left_semi").select("rep", "row", "copies", "code", "label", "size")
    fetched = rows.select("row", "embedding").join(told, "row").drop("row")
    pair = F.shiftright("deal", 1)
    across = F.shiftright("deal", 21) != pair.bitwiseAND(F.lit((1 << 20) - 1))
    work = sent.join(fetched, "rep").select(
        "rep", "copies", "code", "embedding", "key", F.concat_ws("|", "size", "key", pair, "label").alias("task"), F.col("deal").bitwiseAND(F.lit(1)).alias("side"), across.alias("across")
    )
    found = materialise(work.repartition("task").sortWithinPartitions("task").mapInArrow(_linked(least), "rep bigint, links bigint, other bigint"), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = component_roots(found.where("rep <> other").select(F.col("rep").alias("u"), F.col("other").alias("v")).distinct()).withColumnRenamed("vertex", "rep")
    joined = classes.select("h1", "h2", "rep", "copies", "least_id").join(counts, "rep", "left").join(roots, "rep", "left")
    joined = materialise(joined.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least_id", F.coalesce("root", "rep").alias("root")), "linked-classes")
    for done in (sent, found, classes, hot):
        discard(done)
    members = joined.join(joined.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("h1", "h2", "n_links", "component_id")
    out = rows.select("vec_id", "h1", "h2").join(members, ["h1", "h2"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
