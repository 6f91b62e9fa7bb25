import hashlib
import itertools
import random
import re
import zlib

import pytest

from granary.llm.role_repair import cheapest_edits, conversation_repairs, repaired_rows
from granary.llm.tables import table
from tests.llm.conftest import SF_SMALL

GRAMMAR = re.compile("(s?(ua)+)?")


def damaged(rows):
    blank = lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        yield from [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)


def all_edits(rows, states):
    """Cheapest (cost, audit, output) by trying every edit, with at most two rows put in at each place."""
    best = None
    grow = [(0, "", ())]
    for (role, text), state in [*zip(rows, states, strict=True), ((None, None), None)]:
        more = []
        for cost, audit, out in grow:
            for puts in itertools.chain([()], itertools.product(("user", "assistant"), repeat=1), itertools.product(("user", "assistant"), repeat=2)):
                c, a, o = cost + 3 * len(puts), audit + "I" * len(puts), (*out, *((p, "") for p in puts))
                if state is None:
                    more.append((c, a, o))
                    continue
                more.append((c + 4, a + "D", o))
                if state in ("blank", "duplicate"):
                    continue
                cut = 3 if state == "truncated" else 0
                more.append((c + cut, a + "K", (*o, (role, text))))
                for other in ("user", "assistant"):
                    more.append((c + 3 + cut, a + "R", (*o, (other, text))))
        legal = []
        for c, a, o in more:
            roles = "".join(r[:1] or " " for r, _ in o)
            if c <= 4 * len(rows) and re.fullmatch("s?(ua)*u?", roles):  # can still be completed, for no more than deleting all
                legal.append((c, a, o))
        grow = legal
    for c, a, o in grow:
        if GRAMMAR.fullmatch("".join(r[:1] or " " for r, _ in o)) and (best is None or (c, a) < best[:2]):
            best = (c, a, o)
    return best


def brute_force(rows, damage=True):
    out = {}
    left = list(damaged(rows)) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in left if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in mine if r[0] is not None]
        states, seen = [], set()
        for _, role, text in mine:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            state = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "fine"
            seen.add((role, text))
            states.append(state)
        initials = [r[1][:1] or " " for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, kept = all_edits([r[1:] for r in mine], states)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(states.count(s) for s in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(conversations, damage=True):
    got = conversation_repairs(conversations, damage)
    assert got.columns == COLUMNS
    rows = got.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_conversations_against_all_edits(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    short = {c for c in {r[0] for r in rows} if sum(r[0] == c for r in rows) <= 5}
    rows = [r for r in rows if r[0] in short]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(docs) == brute_force(rows) and len(short) >= 10


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    pick = random.Random(seed)
    texts = ["One.", "Two!", "Three", " \n", "", None, "Four? \t", "Five. ", "One"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(pick.randrange(1, 5)):
            rows.append((conv, pick.choice([turn, turn, turn, None, turn + 3]), pick.choice(["user", "assistant", "system", "tool", None, ""]), pick.choice(texts)))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, audit string, cost int")
    assert rows_of(docs) == brute_force(rows)
    assert rows_of(docs, False) == brute_force(rows, False)


def test_edges(spark):
    docs = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert rows_of(docs) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    docs = spark.createDataFrame([(gone, 0, "user", "Hello.")], docs.schema)
    assert rows_of(docs) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 3, "user", "And?"), (2, 0, "system", "Be kind.")]
    got = repaired_rows(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    want = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 2, "user", "And?"), (1, 3, "assistant", "")]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_a_long_conversation(spark):
    """Ten thousand turns, most of them with one text; the batches of a task cut it many times."""
    rows = [(7, k, "user" if k % 3 else "assistant", "Same." if k % 2 else f"Turn {k}.") for k in range(10_000)]
    got = rows_of(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), False)
    _, blank, duplicate, truncated, _, cost, audit, _ = got[7]
    assert (blank, duplicate, truncated) == (0, 4998, 0) and len(audit.replace("I", "")) == 10_000 and cost == 4 * audit.count("D") + 3 * sum(map(audit.count, "IR"))


def test_ties_take_the_least_audit():
    assert cheapest_edits("", b"") == (0, "")
    assert cheapest_edits("uu", bytes([0, 0])) == (3, "KR")
    assert cheapest_edits("s", bytes([0])) == (4, "D")
    assert cheapest_edits("u", bytes([0])) == (3, "KI")
