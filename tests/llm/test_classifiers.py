import pytest

from granary.llm import quality, toxicity
from granary.llm.tables import held_out, table
from tests.llm.conftest import SF_MIDDLE, SF_SMALL

CASES = [(quality, quality.fit_quality, "quality", 5, 0), (toxicity, toxicity.fit_toxicity, "toxic", 3, 1)]


def rates(rows, label, held):
    own = rows[rows.held_out == held]
    return own.predicted[own[label] == 1].mean(), own.predicted[own[label] == 0].mean()


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = (table(spark, SF_MIDDLE, n) for n in ("documents", "labels"))
    return {label: fit(docs, labels, learn=~held_out("doc_id", m, r)) for _, fit, label, m, r in CASES}


@pytest.mark.parametrize(("module", "label", "least", "most"), [(quality, "quality", 0.97, 0.25), (toxicity, "toxic", 0.65, 0.02)])
def test_held_out_accuracy(spark, models, module, label, least, most):
    docs, labels = (table(spark, SF_MIDDLE, n) for n in ("documents", "labels"))
    rows = module.scored(docs, models[label]).join(labels, "doc_id").toPandas()
    hits, false = rates(rows, label, True)
    assert hits >= least and false <= most
    assert rows.score.between(0, 1).all() and rows.held_out.mean() < 0.5


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_documents(awkward, nothing, models, module, label):
    found = module.scored(awkward, models[label])
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(empty) == 1 and len({r.score for r in rows if r.doc_id == 6}) == 1
    assert module.scored(nothing, models[label]).count() == 0


@pytest.mark.parametrize(("module", "fit", "label"), [(c[0], c[1], c[2]) for c in CASES])
def test_labels_that_are_null_repeated_or_missing(spark, awkward, nothing, module, fit, label):
    schema = f"doc_id long, {label} int, lang string"
    odd = spark.createDataFrame([(None, 1, "x"), (5, None, None), (5, 1, "x"), (5, 0, "y"), (5, 1, "x"), (1, 0, None), (999, 1, None)], schema)
    assert module.scored(awkward, fit(awkward, odd, label)).count() == awkward.count()
    none = spark.createDataFrame([], schema)
    scores = {round(r.score, 9) for r in module.scored(awkward, fit(awkward, none, label)).collect()}
    assert len(scores) == 1
    assert module.scored(awkward, fit(nothing, odd, label)).count() == awkward.count()


def test_rejected_documents_go(spark, awkward):
    labels = table(spark, SF_SMALL, "labels")
    docs = table(spark, SF_SMALL, "documents")
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert kept.join(labels.where("quality = 1"), "doc_id").count() >= 0.9 * docs.join(labels.where("quality = 1"), "doc_id").count()
    assert quality.good_documents(awkward, labels).columns == awkward.columns


def test_sentences_that_offend(spark, models):
    clean = "And the thing is on the of. This is by the and for it. Was there in the by."
    docs = spark.createDataFrame([(1, f"{clean} You are an idiot and a worthless moron. {clean}", "x"), (2, clean, None), (3, None, None), (4, "", "")], "doc_id long, text string, sentence string")
    found = toxicity.offending_sentences(docs, models["toxic"]).collect()
    assert [(r.doc_id, r.sentence) for r in found] == [(1, 3)]
    words = docs.first().text.split()
    assert " ".join(words[found[0].from_word : found[0].to_word]) == "You are an idiot and a worthless moron."
    assert {r.doc_id: r.predicted for r in toxicity.scored(docs, models["toxic"]).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}
