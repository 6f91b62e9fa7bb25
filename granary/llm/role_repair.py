"""Repair of conversations whose roles are out of order: generalised LR parsing over a graph-structured stack.

The role grammar is ``(s?(ua)+)?``: an optional system turn, then turns of user and assistant in pairs. Every row is kept, given
another role or deleted, and rows without text may be put in; each edit has a cost and a letter. The rows are read from the last
to the first, so that the audit grows at its left end and of two ways to one stack top the one with the least (cost, audit)
stays the better one whatever is read later. Reversed, the grammar is ``C -> Q | Q s | nothing``, ``Q -> a u | Q a u``; its LR
automaton has the tops below, and the graph-structured stack is one node for each top, pointing at the node under it.

Defined results: nulls are one blank in roles, texts and the damage key; rows of one turn are ordered by role and text; repeated
rows are duplicates; a null id is a conversation of its own; an empty table gives no row; extra columns are not read. The audit
of a conversation is one cell and its digest one pass over its text, so one task walks a conversation from end to end; it holds
one byte a row and streams the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.llm.words import lean
from granary.session import materialise

#: Costs of the edits, and what a truncated row adds unless it is deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: Tops of the stack, by what has been read from the end: nothing, a, pairs, pairs and a, pairs and s.
NOTHING, A, PAIRS, PAIRS_A, WHOLE = range(5)
#: LR actions: what a token does to a top. Reading u reduces (``Q -> a u`` or ``Q -> Q a u``) and goes to the pairs.
SHIFT = {(NOTHING, "a"): A, (PAIRS, "a"): PAIRS_A, (PAIRS, "s"): WHOLE, (A, "u"): PAIRS, (PAIRS_A, "u"): PAIRS}
ACCEPT = (NOTHING, PAIRS, WHOLE)
ROLES = {"u": "user", "a": "assistant"}

BLANKS = " \t\n\v\f\r"
#: Codes of a row besides its initial.
FINE, CUT_OFF, GONE = 0, 1, 2

#: A node of the graph: (letter, node at its right); the end of the audit is None.
Node = tuple[str, "Node"] | None


def _less(x: Node, y: Node) -> bool:
    """Is the audit from ``x`` before that from ``y`` in ASCII order?"""
    while x is not y:
        if x is None or y is None:
            return x is None
        if x[0] != y[0]:
            return x[0] < y[0]
        x, y = x[1], y[1]
    return False


def _merge(tops: dict[int, tuple[int, Node]], top: int, cost: int, audit: Node) -> bool:
    """Merge a way into the node of an equal top; true if it is the better one."""
    old = tops.get(top)
    if old is None or cost < old[0] or (cost == old[0] and _less(audit, old[1])):
        tops[top] = (cost, audit)
        return True
    return False


def _insert(tops: dict[int, tuple[int, Node]]) -> None:
    """Put rows in before the one read last, as long as a top gets better."""
    todo = list(tops)
    while todo:
        top = todo.pop()
        cost, audit = tops[top]
        for role in ROLES:
            to = SHIFT.get((top, role))
            if to is not None and _merge(tops, to, cost + INSERT, ("I", audit)):
                todo.append(to)


def cheapest_edits(initials: str, codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows with these role initials and codes."""
    tops: dict[int, tuple[int, Node]] = {NOTHING: (0, None)}
    _insert(tops)
    for initial, code in zip(reversed(initials), reversed(codes), strict=True):
        read: dict[int, tuple[int, Node]] = {}
        more = TRUNCATED if code == CUT_OFF else 0
        for top, (cost, audit) in tops.items():
            _merge(read, top, cost + DELETE, ("D", audit))
            if code == GONE:
                continue
            to = SHIFT.get((top, initial))
            if to is not None:
                _merge(read, to, cost + KEEP + more, ("K", audit))
            for role in ROLES:
                to = SHIFT.get((top, role))
                if to is not None:
                    _merge(read, to, cost + REROLE + more, ("R", audit))
        _insert(read)
        tops = read
    best: dict[int, tuple[int, Node]] = {}
    for top in ACCEPT:
        if top in tops:
            _merge(best, NOTHING, *tops[top])
    cost, node = best[NOTHING]
    letters = []
    while node is not None:
        letters.append(node[0])
        node = node[1]
    return cost, "".join(letters)


class Repaired:
    """The repaired conversation row by row, as its audit says; ``rows()`` takes the rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def _put_in(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._next(), ""

    def _next(self) -> str:
        self.last = "a" if self.last == "u" else "u"
        return ROLES[self.last]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._put_in()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._next(), text
        elif edit == "K":
            self.last = role[:1]
            yield role, text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._put_in()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that crc32 of ``conv_id:turn`` deals; nulls are one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20).alias("_h")
    )
    text = F.when(F.col("_h") == 1, F.lit("")).when(F.col("_h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_h") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("_h <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies, first, blank, cut``: equal rows of a turn together with their number.

    ``first``: no earlier turn of the conversation has the same role and text. Counts and minima combine before the shuffle, so a
    text repeated all over is no single task.
    """
    seen = rows.withColumn("_turn", F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    equal = seen.groupBy("conv_id", "turn", "_turn", "role", "text").agg(F.count("*").alias("copies"))
    equal = equal.withColumn("_text", F.sha2("text", 256))
    earliest = equal.groupBy("conv_id", "role", "_text").agg(F.min("_turn").alias("_least"))
    e = earliest.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_text").alias("_t"), "_least")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_text") == F.col("_t"))
    first = F.col("_turn").eqNullSafe(F.col("_least"))
    solid = F.rtrim("text", F.lit(BLANKS))
    return equal.join(e, same).select(
        "conv_id", "turn", "role", "text", "copies", first.alias("first"), (solid == "").alias("blank"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut")
    )


_FOUND = "conv_id {id}, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = ("su", "ua", "au")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict] | None]]:
    """``(id, row)`` of sorted batches, and ``(id, None)`` after the last row of each conversation."""
    last, any_row = None, False
    for batch in batches:
        names = batch.schema.names
        columns = [c.to_pylist() for c in batch.columns]
        at = names.index("conv_id")
        for row in zip(*columns, strict=True):
            if any_row and row[at] != last:
                yield last, None
            last, any_row = row[at], True
            yield last, dict(zip(names, row, strict=True))
    if any_row:
        yield last, None


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    initials, codes = [], bytearray()
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    out: list[dict] = []
    kept: list = []
    for conv_id, row in _conversations(_remember(batches, kept)):
        if row is None:
            cost, audit = cheapest_edits("".join(initials), bytes(codes))
            out.append({"conv_id": conv_id, **counts, "cost": cost, "audit": audit})
            initials, codes, counts = [], bytearray(), dict.fromkeys(counts, 0)
            if len(out) >= 1000:
                yield _batch(out, kept[0])
                out = []
            continue
        initial = row["role"][:1] or " "
        for k in range(row["copies"]):
            if initials and initials[-1] + initial not in LEGAL:
                counts["illegal"] += 1
            fault = "blank" if row["blank"] else "duplicate" if not row["first"] or k else "truncated" if row["cut"] else None
            if fault:
                counts[fault] += 1
            initials.append(initial)
            codes.append({"blank": GONE, "duplicate": GONE, "truncated": CUT_OFF, None: FINE}[fault])
    if out:
        yield _batch(out, kept[0])


def _remember(batches: Iterator[pa.RecordBatch], into: list) -> Iterator[pa.RecordBatch]:
    """Pass on, with the type of the id kept."""
    for batch in batches:
        if not into:
            into.append(batch.schema.field("conv_id").type)
        yield batch


def _batch(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    types = {"conv_id": id_type, "audit": pa.string(), "repaired_sha256": pa.string(), "role": pa.string(), "text": pa.string(), "place": pa.int64()}
    names = list(rows[0])
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.int64())) for n in names], names=names)


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, object]]:
    """``(id, (role, text))`` for every repaired row and ``(id, None)`` at the end of a conversation; the audit leads its rows."""
    repaired = None
    for conv_id, row in _conversations(batches):
        if row is None:
            for pair in repaired.end():
                yield conv_id, pair
            yield conv_id, None
        elif row["audit"] is not None:
            repaired = Repaired(row["audit"])
        else:
            for _ in range(row["copies"]):
                for pair in repaired.row(row["role"], row["text"]):
                    yield conv_id, pair


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list = []
    out, digest, empty = [], hashlib.sha256(), True
    for conv_id, pair in _rows_out(_remember(batches, kept)):
        if pair is not None:
            digest.update((("" if empty else "\n") + f"{pair[0]}:{pair[1]}").encode())
            empty = False
            continue
        out.append({"conv_id": conv_id, "repaired_sha256": digest.hexdigest()})
        digest, empty = hashlib.sha256(), True
        if len(out) >= 1000:
            yield _batch(out, kept[0])
            out = []
    if out:
        yield _batch(out, kept[0])


def _write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list = []
    out, place = [], 0
    for conv_id, pair in _rows_out(_remember(batches, kept)):
        if pair is None:
            place = 0
            continue
        out.append({"conv_id": conv_id, "place": place, "role": pair[0], "text": pair[1]})
        place += 1
        if len(out) >= 1000:
            yield _batch(out, kept[0])
            out = []
    if out:
        yield _batch(out, kept[0])


def _sorted(rows: DataFrame, *order) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def repairs(rows: DataFrame) -> DataFrame:
    """``conv_id, blank, duplicate, truncated, illegal, cost, audit`` of conversations made of ``rows`` as :func:`faults` gives them."""
    order = _sorted(rows, F.asc_nulls_first("turn"), "role", "text")
    return order.select("conv_id", "role", "copies", "first", "blank", "cut").mapInArrow(lean(_find), _FOUND.format(id=dict(rows.dtypes)["conv_id"]))


def _guided(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of every conversation behind its audit, sorted."""
    none = F.lit(None)
    guides = found.select("conv_id", *[none.cast(t).alias(n) for n, t in rows.select("turn", "role", "text", "copies").dtypes], "audit")
    both = guides.unionByName(rows.select("conv_id", "turn", "role", "text", "copies", none.cast("string").alias("audit")))
    return _sorted(both, F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "text").select("conv_id", "role", "text", "copies", "audit")


def repaired_rows(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """``conv_id, place, role, text``: the repaired conversations themselves."""
    rows = materialise(faults(damaged(conversations) if damage else _plain(conversations)), "faults")
    out = _guided(rows, materialise(repairs(rows), "repairs"))
    return out.mapInArrow(lean(_write_out), f"conv_id {dict(rows.dtypes)['conv_id']}, place long, role string, text string")


def _plain(conversations: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", "turn", blank("role"), blank("text"))


def conversation_repairs(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """One row for each ``conv_id``: faults, cost and audit of the cheapest repair and the digest of the repaired rows."""
    rows = materialise(faults(damaged(conversations) if damage else _plain(conversations)), "faults")
    found = materialise(repairs(rows), "repairs")
    digests = _guided(rows, found).mapInArrow(lean(_digest), f"conv_id {dict(rows.dtypes)['conv_id']}, repaired_sha256 string")
    turns = rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    out = conversations.select(F.col("conv_id").alias("_id")).distinct()
    for part in (turns, found, digests):
        out = out.join(part, F.col("_id").eqNullSafe(part["conv_id"]), "left").drop("conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(
        F.col("_id").alias("conv_id"),
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
