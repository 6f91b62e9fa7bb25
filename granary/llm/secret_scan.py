"""Secret scan: candidates by pattern, false positives removed by a random forest. DataFrame and SQL functions only.

One pattern finds candidates in whole texts: key blocks, every value after a credential name, long runs with a digit. Each is
described by its length, transitions between kinds of characters, share covered by dictionary words, likeness to a path
and the words before and after it. A random forest learned from labelled findings votes; its trees are written out as
SQL conditions, so scoring is one expression over the array of a text's candidates: no shuffle, no join, no row model.

The tables hold no labelled findings. ``labelled_findings`` makes them from documents: generated credentials in the
usual places (label 1), and look-alikes such as digests, versions, addresses, paths, placeholders and numbers (label 0),
set between words of the documents. It takes ``SAMPLE`` documents at most; anyone with reviewed findings passes those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from granary.llm.tables import bounded_sample, free_name
from granary.session import materialise

SAMPLE = 1500
TREES = 20
DEPTH = 6
BEFORE, AFTER = 60, 20

# Words of the features.
_CREDENTIAL = ["token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "auth", "bearer", "credential", "private_key", "client_secret"]
_HARMLESS = ["commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "version", "revision", "integrity", "etag", "build", "phone", "tel", "card", "call", "mail", "from", "at", "see"]
_WORDS = ["your", "example", "sample", "test", "dummy", "changeme", "placeholder", "here", "token", "secret", "password", "key", "api", "my", "the", "insert", "none", "null", "xxxx", "user", "admin", "default", "value", "version", "usr", "lib", "bin", "home", "src", "com", "org", "www", "http", "mail", "file"]

_RUN = r"A-Za-z0-9_+/=.@~\-"
def _any(words: list[str]) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


_NAMES = _any(_CREDENTIAL)
#: What stands between a name and its value; a value without quotes, closing marks left out.
_ASSIGN = r"[\"'`]?\]?\s{0,3}[=:]{1,3}>?\s{0,3}"
_BARE = r"(?![\s\"'`=:>])[^\s\"`]*[^\s\"'`.,;:)\]}]"


def _quoted(quote: str) -> str:
    """What stands between two of ``quote`` on a line, escaped ones included; loops over groups are short for the Java stack."""
    return rf"(?<={quote})[^{quote}\\\n\r]*+(?:\\.[^{quote}\\\n\r]*+){{0,50}}+(?<!{quote})(?={quote})"


#: A key from BEGIN to END, or its header with the lines that follow; the value of a credential name, quoted or not; what
#: follows "bearer"; the quoted value of a key; a run of 12 characters or more with a digit.
CANDIDATE = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*+(?:-{1,4}+(?!-)[^-]*+){0,200}+-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----|(?:\s{1,9}[A-Za-z0-9+/=]{40,}+){0,500}+)"
    rf"|(?<=[\"'`])(?<=(?i:{_NAMES}){_ASSIGN}[\"'`])(?:{'|'.join(map(_quoted, '\"\'`'))})"
    rf"|(?<=[=:>\s])(?<=[=:]>?\s{{0,3}})(?<=(?i:{_NAMES}){_ASSIGN}){_BARE}"
    rf"|(?<=[rR]\s{{1,3}})(?<=(?i:bearer)\s{{1,3}}){_BARE}"
    rf"|(?<=[\"'])(?<=(?i:key)\s?[=:]\s?[\"'])[^\"'\s]{{6,}}(?=[\"'])"
    rf"|(?<![{_RUN}])(?=[A-Za-z_+/=.@~\-]*+[0-9])(?![A-Za-z0-9_+/.@~\-]*(?i:{_NAMES})=)[{_RUN}]{{12,}}"
)

FEATURES = ["length", "digits", "kinds", "cases", "capitals", "dictionary", "path", "address", "separators", "distinct", "hexadecimal", "numeric", "credential", "harmless", "assigned", "quoted", "code"]


def _left(text: Column, pattern: str) -> Column:
    """Characters that remain without ``pattern``."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _features(c: Column) -> Column:
    """Numbers that describe a candidate ``c(value, before, after)``."""
    value, before, after = c["value"], c["before"], c["after"]
    size = F.length(value).cast("double")
    near = F.lower(F.regexp_extract(before, r"(\S+\s+)?(\S+\s*)?\S*$", 0))
    values = [
        size,
        1 - _left(value, "[0-9]") / size,
        (F.length(F.regexp_replace(value, r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", "#")) - size) / size,
        (F.length(F.regexp_replace(value, r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])", "#")) - size) / size,
        1 - _left(value, "[A-Z]") / size,
        1 - _left(F.lower(value), _any(_WORDS)) / size,
        size - _left(value, "[/.]"),
        value.rlike("@").cast("double"),
        (size - _left(value, r"[_.\-]")) / size,
        F.size(F.array_distinct(F.split(value, ""))) / F.least(size, F.lit(36.0)),
        value.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        value.rlike(r"^[0-9+().\-]+$").cast("double"),
        near.rlike(rf"({_NAMES})[^a-z]*$").cast("double"),
        near.rlike(rf"(^|[^a-z0-9])({_any(_HARMLESS)})[^a-z]*$").cast("double"),
        before.rlike(r"[=:]\s*[\"'`]?$").cast("double"),
        (before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")).cast("double"),
        value.rlike(r"^[<$%{(\[]|[(\[]").cast("double"),
    ]
    return F.struct(*[F.coalesce(v.cast("double"), F.lit(0.0)).alias(n) for v, n in zip(values, FEATURES, strict=True)])


def candidates(text: Column) -> Column:
    """The candidates of a text in their order: ``array<struct<value, before, after, gap>>``; ``gap``: length of what stands before."""
    values, parts = F.regexp_extract_all(text, F.lit(CANDIDATE), 0), F.split(text, CANDIDATE, -1)
    # Zipped first: inside the function over candidates the text would be cut again for each of them.
    rows = F.arrays_zip(values.alias("value"), parts.alias("left"), F.slice(parts, 2, F.size(values) + 1).alias("right"))
    return F.transform(
        F.filter(rows, lambda c: c["value"].isNotNull()),
        lambda c: F.struct(
            c["value"].alias("value"),
            F.substring(c["left"], -BEFORE, BEFORE).alias("before"),
            F.substring(c["right"], 1, AFTER).alias("after"),
            F.length(c["left"]).alias("gap"),
        ),
    )


def labelled_findings(docs: DataFrame) -> DataFrame:
    """``line, label``: generated findings between words of ``docs``, each line with one candidate."""
    ids = bounded_sample(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", SAMPLE)
    some = docs.select("doc_id", F.substring(F.coalesce(F.col("text").cast("string"), F.lit("")), 1, 300).alias("text"))
    some = some.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))  # SAMPLE ids at most
    clean = F.split(F.regexp_replace("text", r"[0-9\"'=:@]|\S{12,}", ""), r"\s+")
    pick = lambda names, salt: F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(len(names))) + 1).cast("int"))
    key = F.concat(F.lit("finding"), F.col("doc_id").cast("string"))
    parts = {
        "number": F.pmod(F.xxhash64("doc_id", F.lit("n")), F.lit(10**12)).cast("string"),
        "digest": F.sha1(key),
        "long": F.sha2(key, 256),
        "mixed": F.regexp_replace(F.base64(F.unhex(F.sha2(key, 256))), "[+/=]", "7"),
        "marked": F.base64(F.unhex(F.sha2(key, 256))),
        "turn": F.xxhash64("doc_id", F.lit("turn")),
        "name": pick(_CREDENTIAL, "name"),
        "plain": pick(_HARMLESS, "plain"),
        **{f"word{k}": F.coalesce(F.try_element_at(clean, F.lit(k)), F.lit("and")) for k in range(2, 9)},
    }
    some = materialise(some.select(*[v.alias(k) for k, v in parts.items()]), "findings-parts")
    number, digest, long, mixed, marked, name, plain = (F.col(c) for c in ("number", "digest", "long", "mixed", "marked", "name", "plain"))
    word = lambda k: F.col(f"word{k}")
    # One of several forms for each document, so that the number of lines stays.
    turns = lambda *forms: F.element_at(F.array(*forms), (F.pmod(F.xxhash64("turn", F.lit(len(forms)), forms[0]), F.lit(len(forms))) + 1).cast("int"))
    block = F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), F.array_join(F.transform(F.sequence(F.lit(1), F.length(word(2)) + 2), lambda k: F.base64(F.unhex(F.sha2(F.concat(digest, k.cast("string")), 256)))), "\n"), F.lit("\n-----END RSA PRIVATE KEY-----"))
    true = [
        F.concat(name, F.lit(' = "'), digest, F.lit('"')),
        turns(F.concat(F.upper(name), F.lit(' = "'), F.upper(digest), F.lit('"!!')), F.concat(F.upper(name), F.lit("="), marked)),
        turns(F.concat(name, F.lit(": "), F.substring(long, 1, 32)), F.concat(name, F.lit(": "), F.substring(marked, 1, 40))),
        turns(F.concat(name, F.lit("='"), F.substring(mixed, 1, 36), F.lit("'")), F.concat(name, F.lit(' = "'), F.substring(marked, 5, 40), F.lit('"'))),
        F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 1, 16))),
        turns(F.concat(F.lit("ghp_"), F.substring(mixed, 3, 36)), F.concat(F.lit("Authorization: Bearer "), F.substring(marked, 1, 30))),
        turns(F.concat(F.lit("sk_live_"), F.substring(mixed, 2, 24)), F.concat(F.upper(name), F.lit("="), F.substring(mixed, 2, 16))),
        turns(
            F.concat(F.lit('password = "'), word(2), F.substring(mixed, 1, 8), F.lit('"')),
            F.concat(name, F.lit(": "), word(2), F.substring(number, 1, 1)),
            F.concat(name, F.lit(' = "'), word(2), F.substring(number, 1, 2), F.lit('"')),
            F.concat(name, F.lit("="), F.substring(mixed, 1, 8)),
        ),
        turns(F.lit("-----BEGIN RSA PRIVATE KEY-----"), block),
        turns(
            F.concat(name, F.lit(' = "'), long, F.lit('"')),
            F.concat(name, F.lit(" = "), word(2), word(3), word(4)),
            F.concat(name, F.lit(': "'), word(3), word(4), F.lit('"')),
            F.concat(name, F.lit(': "'), word(2), F.lit(" "), word(3), F.lit(" "), word(4), F.lit('"')),
        ),
    ]
    false = [
        F.concat(plain, F.lit(" "), digest),
        F.concat(plain, F.lit(": "), long),
        F.concat(F.lit('"'), plain, F.lit('" = "'), F.substring(digest, 1, 32), F.lit('"')),
        F.concat(word(2), F.lit("-"), F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-4"), F.substring(digest, 14, 3), F.lit("-a"), F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12)),
        F.concat(F.lit("/usr/lib/"), word(2), F.lit("/"), word(3), F.lit("-1.2."), F.substring(number, 1, 2), F.lit("/src")),
        F.concat(word(2), F.lit("."), F.substring(number, 1, 2), F.lit("@mail"), F.substring(number, 3, 1), F.lit(".example.com")),
        F.lpad(number, 16, "4"),
        F.concat(F.lit("+1"), F.lpad(F.substring(number, 1, 10), 10, "5"), F.lit("-0")),
        F.concat(F.lit("1"), F.substring(number, 1, 2), F.lit(".1"), F.substring(number, 3, 2), F.lit(".1"), F.substring(number, 5, 1), F.lit(".2"), F.substring(number, 6, 1)),
        turns(F.concat(name, F.lit(' = "your_'), name, F.lit('_here_1"')), F.concat(name, F.lit(": your_"), name), F.concat(F.upper(name), F.lit("=changeme")), F.concat(name, F.lit(' = "my '), name, F.lit(' here"'))),
        turns(F.concat(name, F.lit(' = "xxxxxxxxxxxx'), F.substring(number, 1, 2), F.lit('"')), F.concat(name, F.lit(": none")), F.concat(name, F.lit(' = "default"'))),
        turns(F.concat(name, F.lit(' = "example-'), word(2), F.lit('-123"')), F.concat(name, F.lit(": "), word(2)), F.concat(F.lit("bearer "), word(2))),
        turns(F.concat(name, F.lit(' = "<'), word(2), F.lit('>"')), F.concat(name, F.lit(" = ${"), F.upper(name), F.lit("}")), F.concat(name, F.lit(" = get_"), word(2), F.lit("("), word(3), F.lit(")"))),
        F.concat(F.lit("https://www.example.com/"), word(2), F.lit("/"), F.substring(number, 1, 4)),
        F.concat(word(2), F.lit("_"), word(3), F.lit("_"), word(4), F.lit("_2")),
        F.concat(word(2), word(3), F.substring(number, 1, 3)),
    ]
    lines = [F.struct(F.concat_ws(" ", word(5), word(6), f, word(7), word(8)).alias("line"), F.lit(label).alias("label"), F.lit(float(len(true) + len(false)) / 2 / len(kind)).alias("weight")) for label, kind in ((1.0, true), (0.0, false)) for f in kind]
    return some.select(F.inline(F.array(*lines)))


def fit_forest(findings: DataFrame) -> RandomForestClassificationModel:
    """Learn from ``findings(line, label[, weight])``: the last candidate of each line has the label."""
    # Written before it is described, else every feature would look for the candidates again.
    described = materialise(findings.select("label", "weight", F.try_element_at(candidates(F.col("line")), F.lit(-1)).alias("c")), "candidates").where("c is not null")
    rows = described.select("label", "weight", _features(F.col("c")).alias("f")).select("label", "weight", "f.*")
    rows = materialise(rows.coalesce(1).sortWithinPartitions("label", *FEATURES), "findings")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, weightCol="weight", featureSubsetStrategy="sqrt", subsamplingRate=0.8, maxBins=64)
    return forest.fit(vectors)


def forest_score(model: RandomForestClassificationModel, features: Column) -> Column:
    """Mean of the trees' probabilities of label 1, written as conditions."""

    def written(node) -> Column:
        if node.numDescendants() == 0:
            stats = list(node.impurityStats().stats())
            return F.lit(float(stats[1] / sum(stats)) if len(stats) > 1 and sum(stats) else 0.0)
        split = node.split()
        name = FEATURES[split.featureIndex()]
        return F.when(features[name] <= float(split.threshold()), written(node.leftChild())).otherwise(written(node.rightChild()))

    trees = [written(tree._java_obj.rootNode()) for tree in model.trees]
    return reduce(lambda a, b: a + b, trees) / len(trees)


def text_secrets(text: Column, model: RandomForestClassificationModel, least: float = 0.5) -> Column:
    """The kept findings of a text: ``array<struct<start, value, score>>`` in their order, ``start`` in characters from 0."""
    found = F.transform(candidates(text), lambda c: F.struct(c["value"].alias("value"), c["gap"].alias("gap"), _features(c).alias("f")))
    rated = F.transform(found, lambda c: F.struct(c["value"].alias("value"), c["gap"].alias("gap"), forest_score(model, c["f"]).alias("score")))
    kept = F.array().cast("array<struct<start:int,value:string,score:double>>")
    start = F.struct(F.lit(0).alias("place"), kept.alias("kept"))

    def step(seen: Column, c: Column) -> Column:
        at = seen["place"] + c["gap"]
        row = F.struct(at.alias("start"), c["value"].alias("value"), c["score"].alias("score"))
        return F.struct((at + F.length(c["value"])).alias("place"), F.when(c["score"] >= least, F.array_append(seen["kept"], row)).otherwise(seen["kept"]).alias("kept"))

    # Texts without a candidate, nearly all of them, end at the pattern.
    return F.when(text.rlike(CANDIDATE), F.aggregate(rated, start, step, lambda seen: seen["kept"]))


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """``doc_id, start, length, score``: the findings of each text that the forest keeps.

    ``findings`` as for :func:`fit_forest`; by default those of :func:`labelled_findings`. Null and empty texts have none.
    Repeated rows give their findings each, a null ``doc_id`` stays null. Other columns are not read. An empty table has
    no findings.
    """
    model = _model(docs, findings)
    if model is None:
        return docs.select(F.col("doc_id").cast("bigint"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(0.0).alias("score")).limit(0)
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.explode(text_secrets(F.col("text").cast("string"), model, least)).alias("s"))
    return found.select("doc_id", F.col("s.start").alias("start"), F.length("s.value").alias("length"), F.round("s.score", 6).alias("score"))


def _model(docs: DataFrame, findings: DataFrame | None) -> RandomForestClassificationModel | None:
    findings = labelled_findings(docs) if findings is None else findings
    return None if findings.isEmpty() else fit_forest(findings)


def masked_secrets(docs: DataFrame, mask: str = "<secret>", findings: DataFrame | None = None) -> DataFrame:
    """``docs`` with every kept finding replaced by ``mask``; ``n_chars`` follows the text.

    A value that no plain word can be, of 12 characters or with a digit in 6, is replaced wherever else it stands, too.
    """
    model = _model(docs, findings)
    if model is None:
        return docs
    text = F.col("text").cast("string")
    def step(seen: Column, c: Column) -> Column:
        left = F.substr(text, seen["place"] + 1, c["start"] - seen["place"])
        return F.struct((c["start"] + F.length(c["value"])).alias("place"), F.concat(seen["clean"], left, F.lit(mask)).alias("clean"))

    def masked(found: Column) -> Column:
        cut = F.aggregate(found, F.struct(F.lit(0).alias("place"), F.lit("").alias("clean")), step, lambda seen: F.concat(seen["clean"], F.substr(text, seen["place"] + 1, F.length(text))))
        values = F.array_distinct(F.transform(found, lambda s: s["value"]))
        values = F.filter(values, lambda v: (F.length(v) >= 12) | ((F.length(v) >= 6) & v.rlike("[0-9]")))
        values = F.array_sort(values, lambda a, b: F.length(b) - F.length(a))  # a value that holds another goes first
        return F.aggregate(values, cut, lambda t, v: F.replace(t, v, F.lit(mask)))

    # The findings are named twice; as an element of an array they are worked out once.
    clean = F.coalesce(F.element_at(F.transform(F.array(text_secrets(text, model)), masked), 1), text)
    name = free_name(docs.columns, "_clean")
    out = docs.withColumn(name, clean)
    changed = {"text": F.col(name).cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        same = F.col(name).eqNullSafe(text)
        changed["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length(name).cast(docs.schema["n_chars"].dataType))
    return out.select([changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])
