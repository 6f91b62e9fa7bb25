import re
import zlib
from collections import Counter

import pytest

from granary.llm.spelling_variants import DAMAGE, counted_words, near_words, spelling_variants
from granary.llm.tables import table
from tests.llm.conftest import DOCUMENTS, SF_SMALL

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts_of(rows, damage):
    words = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def brute_force(rows, damage=DAMAGE):
    words = counts_of(rows, damage)
    alphabet = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        some = {w[:i] + w[i + 1 :] for i in range(len(w))}
        some |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
        some |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        near[w] = (some & words.keys()) - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows_of(docs, damage=DAMAGE):
    got = spelling_variants(docs, damage=damage)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_documents_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = rows_of(docs)
    assert got == brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[1] is not None for r in got) >= 5  # the chains are in the next test


def test_chains_ties_and_repeated_letters(spark):
    counts = {"aaaaaaaa": 900, "aaaaaaab": 80, "aaaaaabb": 7, "aaaaabbb": 2, "aaaaaaa": 4, "aaaaaaaaa": 6, "aaaaaaac": 900, "baaaaaaa": 3, "Ünderlay": 2, "ünderlay": 30, "zzzzzzz": 1, "zzzzzzy": 20, "colours": 5, "colors": 90, "coloürs": 50, "mirrors": 3, "mirrros": 40}
    docs = spark.createDataFrame([(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())], "doc_id long, text string")
    want = brute_force([(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())], None)
    assert rows_of(docs, None) == want
    by_word = {r[0]: r for r in want}
    assert by_word["aaaaabbb"][1] is None and by_word["aaaaaabb"][1:3] == ("aaaaaaab", "aaaaaaaa") and by_word["aaaaaaa"][4] == 4


def test_awkward_rows(spark, awkward, nothing):
    assert rows_of(awkward) == brute_force([(r.doc_id, r.text) for r in awkward.collect()])
    assert rows_of(nothing) == set()


def test_very_long_words_and_null_ids(spark):
    long = "é" * 3000 + "a" * 50
    texts = [long, long, long[:-1], long[:-1], "b" + long, f"b{long} short", " ".join([long] * 30)]
    docs = spark.createDataFrame([(None, t, None, None, None, *["x"] * 6) for t in texts], DOCUMENTS)
    got = {r[0]: r for r in rows_of(docs, None)}
    assert {w: r[3:5] for w, r in got.items()} == {long: (32, 2), long[:-1]: (2, 1), "b" + long: (2, 1)}
    assert got[long[:-1]][1] == long and got["b" + long][2] == long


@pytest.mark.parametrize("damage", [None, 3])
def test_words_are_counted_as_stated(spark, damage):
    rows = [(1, "Ärgerlich ärgerlich ärgerlicH ärger×lich x" * 3), (None, "ärgerlich Ärgerlich"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in counted_words(docs, damage=damage).collect()}
    assert got == counts_of(rows, damage)


def test_only_counts_leave_a_group(spark):
    """One row per rotation and word is all that is written: the plan joins no word with its neighbours."""
    words = spark.createDataFrame([(k, f"same{c}word", 2) for k, c in enumerate("abcdefghijklmnopqrstuvwxyz")], "id long, word string, n long")
    near = near_words(words)
    assert "Join" not in near._jdf.queryExecution().executedPlan().toString()
    assert {(r.n_near, r.best_id) for r in near.collect()} == {(25, 0), (25, 1)}
