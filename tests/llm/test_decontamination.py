import random

from granary.llm.decontamination import benchmark_passages, plain_words, rows_without_benchmark
from granary.llm import decontamination
from tests.llm.conftest import words

ITEMS = {k: words(100 + k, 14 + k % 40, 900) for k in range(30)}


def edited(text, edits, seed):
    pick, out = random.Random(seed), text.split()
    for _ in range(edits):
        kind, at = pick.randrange(3), pick.randrange(len(out))
        if kind == 0:
            out[at] = f"new{pick.randrange(99)}"
        elif kind == 1:
            out.insert(at, f"new{pick.randrange(99)}")
        else:
            out.pop(at)
    return " ".join(out)


def distance(needle, text):
    """Least edits of words between ``needle`` and any run of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(needle, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def benchmark(spark):
    rows = [(k, t, "x") for k, t in ITEMS.items()] + [(None, words(1, 30), "x"), (77, None, None), (78, "", ""), (79, "too short an item", "x"), (80, ITEMS[3], "x"), (80, ITEMS[3], "x")]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


def test_recall_against_brute_force(spark):
    docs, want = [], {}
    for k, item in ITEMS.items():
        allowed = int(0.2 * len(item.split()))
        for edits in range(allowed + 3):
            doc = 1000 * k + edits
            text = f"{words(doc, 60, 900)} {edited(item, edits, doc)} {words(doc + 5, 40, 900)}"
            docs.append((doc, text.upper() if edits % 2 else text.replace(" ", ", ")))
            plain = text.split()
            for i, t in ITEMS.items():
                d = distance(t.split(), plain) if i == k else 99
                if d <= allowed:
                    want[doc, i] = d
    found = benchmark_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), benchmark(spark)).where("item_id < 70").collect()
    got = {(r.doc_id, r.item_id): r.edits for r in found}
    near = {p: d for p, d in want.items() if d <= 1}
    assert near.keys() <= got.keys()  # exact and almost exact passages, all
    assert len(want.keys() & got.keys()) >= 0.95 * len(want)
    assert all(p in want and got[p] == want[p] for p in got)


def test_places_and_edges(spark, awkward, nothing):
    item = ITEMS[7]
    n = len(item.split())
    docs = spark.createDataFrame(
        [(1, f"a b {item} c d e {item}", "x"), (None, item, "x"), (2, item.title(), None), (2, item.title(), None), (3, None, None), (4, "", None), (5, "too short an item", None), (6, ITEMS[3], None)],
        "doc_id long, text string, item_id string",
    )
    found = sorted((str(r.doc_id), r.item_id, r.first_word, r.last_word, r.edits) for r in benchmark_passages(docs, benchmark(spark)).collect())
    m = len(ITEMS[3].split())
    assert found == sorted([("5", 79, 0, 4, 0), ("1", 7, 2, 2 + n, 0), ("1", 7, 5 + n, 5 + 2 * n, 0), ("None", 7, 0, n, 0), ("2", 7, 0, n, 0), ("2", 7, 0, n, 0), ("6", 3, 0, m, 0), ("6", 80, 0, m, 0)])
    kept = rows_without_benchmark(docs, benchmark(spark))
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4"]
    assert benchmark_passages(awkward, benchmark(spark)).count() == 0 and rows_without_benchmark(awkward, benchmark(spark)).count() == awkward.count()
    assert benchmark_passages(nothing, benchmark(spark)).count() == 0
    assert benchmark_passages(docs, benchmark(spark).limit(0)).count() == 0


def test_rows_are_judged_by_their_own_text(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 20)
    item, clean = ITEMS[7], "a b c d e f g h"
    rows = [(None, f"x {item}", "y"), (None, clean, None), (None, None, "n"), (2, item, None), (2, clean, "z"), (3, "", None), (4, ITEMS[3].title(), "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    kept = rows_without_benchmark(docs, benchmark(spark))
    assert kept.columns == docs.columns and sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [rows[1], rows[2], rows[4], rows[5]]))


def test_a_benchmark_of_many_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"x y {t} z") for k, t in ITEMS.items()], "doc_id long, text string")
    whole = {tuple(r) for r in benchmark_passages(docs, benchmark(spark)).collect()}
    monkeypatch.setattr(decontamination, "BLOCK", 4)
    assert {tuple(r) for r in benchmark_passages(docs, benchmark(spark)).collect()} == whole and len(whole) >= 31


def test_short_items_and_scripts_without_blanks(spark):
    question, chinese = "What is the capital city of France?", "請問下列哪一個城市是法國的首都並且位於塞納河的兩岸而且人口超過兩百萬"
    items = spark.createDataFrame([(1, question), (2, "Paris"), (3, "one two one two"), (4, chinese), (5, question), (6, "日本の首都")], "item_id long, text string")
    changed = chinese.replace("城市", "地方")  # two of 33 characters
    texts = [
        (1, f"Quiz: what is the capital\ncity of FRANCE -- Paris."), (2, "Paris"), (3, "They went to Paris, the capital city of France."), (4, "one two one two one two one two one two"),
        (5, f"甲乙丙丁「{changed}」，戊己庚辛。"), (6, "甲乙丙丁戊己庚辛" * 6), (7, "これは日本の首都です"), (8, "日本の大きな首都"), (9, "abc日本の首都xyz"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.first_word, r.edits) for r in benchmark_passages(docs, items).collect()}
    assert found == {(1, 1, 1, 0), (1, 5, 1, 0), (2, 2, 0, 0), (4, 3, 0, 0), (4, 3, 4, 0), (5, 4, 4, 2), (7, 6, 3, 0), (9, 6, 1, 0)}
    assert sorted(r.doc_id for r in rows_without_benchmark(docs, items).collect()) == [3, 6, 8]


def test_words_of_scripts_without_blanks():
    import pyarrow as pa

    words = plain_words(pa.array(["日本のabc、x", "", "本", "é語"]))
    assert [words.text(i, i + 1) for i in range(len(words.start))] == ["日", "本", "の", "abc", "x", "本", "é", "語"]
    assert words.first.tolist() == [0, 5, 5, 6, 8] and words.hash[1] == words.hash[5]
