"""The registered queries: SQL twins where there are some, and the pipeline against plain Python."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from granary.llm import queries
from granary.llm.tables import table
from tests.llm.conftest import SF_SMALL, words
from tests.llm.test_decontamination import distance
from tests.llm.test_jaccard_join import brute_force
from workload.check import compare, database


def test_one_query_for_each_operator_and_the_pipeline():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14)) and queries.QUERIES.keys() | {"pipeline"} <= names.keys()
    assert queries.ORACLES.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_twins_agree(spark, name):
    assert compare(spark, database(SF_SMALL), SF_SMALL, name).startswith("ok")


def test_pipeline_against_plain_python(spark, tmp_path):
    """Stage by stage on a small corpus, each stage's result derived from its own input."""
    token = "3f786850e387550fdab836ed7e6dc881de23001b"
    rows = table(spark, SF_SMALL, "documents").collect()
    rows = [tuple(r) for r in rows]
    item = table(spark, SF_SMALL, "benchmark").orderBy("item_id").first().text
    base = words(3, 120)
    extra = [base, base, base + " more", f"{words(4, 50)} {item} {words(5, 50)}", f'{words(6, 80)} token = "{token}" {words(7, 20)}', None, ""]
    rows += [(10_000 + k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(extra)] + [(None, words(8, 40), None, None, None)]
    docs = spark.createDataFrame(rows, table(spark, SF_SMALL, "documents").schema)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]
    good = stages["quality classifier"](spark, docs, SF_SMALL).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    kept = {r.doc_id for r in good}
    clean = [i for i, q in labels.items() if q == 1]
    assert len([i for i in clean if i in kept]) >= 0.95 * len(clean) and len(good) < len(rows)

    component = {i: c for i, _, c in brute_force([(r.doc_id, r.text) for r in rows_of(rows)]) if i is not None}
    single = stages["n-gram Jaccard join"](spark, docs, SF_SMALL).collect()
    assert sorted(str(r.doc_id) for r in single) == sorted([str(i) for i, c in component.items() if i == c] + ["None"])

    plain = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [plain(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    grams = [{tuple(i[k : k + 3]) for k in range(len(i) - 2)} for i in items]
    spoiled = set()
    for r in rows_of(rows):
        text = plain(r.text)
        own = {tuple(text[k : k + 3]) for k in range(len(text) - 2)}
        for i, g in zip(items, grams, strict=True):
            if len(own & g) >= 3 and distance(i, text) <= int(0.2 * len(i)):
                spoiled.add(r.doc_id)
    unspoiled = stages["benchmark decontamination"](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in unspoiled} == {r.doc_id for r in rows_of(rows)} - spoiled and 10_003 in spoiled

    masked = {r.doc_id: r for r in stages["secret scans"](spark, docs, SF_SMALL).collect()}
    for r in rows_of(rows):
        want = None if r.text is None else re.sub(r'(?i)(?<=token = ")[0-9a-f]{40}(?=")', "<secret>", r.text)
        assert masked[r.doc_id].text == want

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages["best-fit packing"](spark, docs, SF_SMALL).collect()
    total = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows_of(rows))
    assert sum(p.length for p in pieces) == total


def rows_of(rows):
    from collections import namedtuple

    Row = namedtuple("Row", "doc_id text lang source n_chars")
    return [Row(*r) for r in rows]


def test_pipeline_runs_through(spark):
    found = entry.queries()["pipeline"](spark, SF_SMALL)
    assert found.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < found.where("piece = 0").count() < table(spark, SF_SMALL, "documents").count()


def test_pipeline_of_nothing(spark, nothing):
    docs = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        docs = out if name != "best-fit packing" else docs
