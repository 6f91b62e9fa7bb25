"""Spelling variants by permuterm rotations, in SQL functions from the texts to the forms.

A word ``w`` is closed by a terminator, and its rotations are sorted. The rotation that ends just before the code point at
``i`` reads ``w[i+1:] + "$" + w[:i]``: two words that differ by a replacement at ``i`` share it, and a word without that code
point has it as a whole rotation of its own. So every word gives one rotation for each code point it may lose or replace
(``skips``) and one for each place where it may gain one (``wholes``), and words are near where such rotations meet. A group of
equal rotations holds at most one whole word and one word for each letter of the alphabet (90 letters), whatever the number of
rows, so each is scanned in one short window; no pair is written, only counts and the best neighbour.

Defined results: null and empty texts have no words; a null id counts as the empty text in ``<doc_id>:<run>``; repeated rows
count again; of neighbours equally frequent the least in code-point order is taken; an empty table gives no row; runs of any
length are whole (a rotation above 64 code points is told by its SHA-256, so that rows stay short); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.operators.rows import numbered
from granary.session import discard, materialise

#: Words of fewer code points and rarer words are no entries.
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as its variant.
TIMES = 10
#: One run in so many loses a code point before it is counted.
DAMAGE = 31

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A terminator outside the alphabet of the runs.
END = "$"


def counted_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int | None = DAMAGE) -> DataFrame:
    """``word, n``: the runs of letters of all texts after damage, those long and frequent enough.

    A run too short before it loses a letter is too short after it, so only runs of ``least_length`` leave the texts.
    """
    runs = F.regexp_extract_all("text", F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least_length},}})"), 1)
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_of"), F.explode(runs).alias("_run"))
    run = run.select("_of", F.translate("_run", UPPER, LOWER).alias("word"))
    if damage:
        run = run.select("word", F.crc32(F.concat_ws(":", "_of", "word")).alias("_h"))
        at = (F.col("_h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        run = run.select(F.when(F.col("_h") % damage == 0, cut).otherwise(F.col("word")).alias("word"))
    words = run.groupBy("word").agg(F.count("*").alias("n"))
    return words.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def _short(rotation: Column) -> Column:
    return F.when(F.length(rotation) <= 64, rotation).otherwise(F.sha2(rotation, 256))


def rotations(words: DataFrame) -> DataFrame:
    """``rotation, whole, id, n, leads`` of ``words(id, word, n)``; ``leads``: the skipped code point begins its run of equal ones.

    A word that loses any code point of such a run becomes the same shorter word; only the leading one counts.
    """
    length = F.length("word")
    before = lambda i: F.substring(F.col("word"), F.lit(1), i)
    after = lambda i: F.substring(F.col("word"), i + 1, length)
    whole = lambda i: F.struct(
        _short(F.concat(after(i), F.lit(END), before(i))).alias("rotation"), F.lit(True).alias("whole"), F.lit(True).alias("leads")
    )
    skip = lambda i: F.struct(
        _short(F.concat(after(i + 1), F.lit(END), before(i))).alias("rotation"),
        F.lit(False).alias("whole"),
        ((i == 0) | (F.substring(F.col("word"), i, F.lit(1)) != F.substring(F.col("word"), i + 1, F.lit(1)))).alias("leads"),
    )
    wholes = words.select("id", "n", F.inline(F.transform(F.sequence(F.lit(0), length), whole)))
    skips = words.select("id", "n", F.inline(F.transform(F.sequence(F.lit(0), length - 1), skip)))
    return wholes.unionAll(skips)


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best_id`` of the words with neighbours; of equally frequent ones the least ``id``."""
    group = Window.partitionBy("rotation")
    # The skipping words of a group first, the most frequent ahead.
    ranked = group.orderBy("whole", F.desc("n"), "id")
    me = F.struct((-F.col("n")).alias("less"), F.col("id").alias("id"))
    skips, leading = ~F.col("whole"), ~F.col("whole") & F.col("leads")
    scanned = rotations(words).select(
        "id",
        "whole",
        "leads",
        me.alias("me"),
        F.count("*").over(group).alias("size"),
        F.count_if(skips).over(group).alias("skips"),
        F.count_if(leading).over(group).alias("leading"),
        F.min(F.when(F.col("whole"), me)).over(group).alias("shorter"),
        F.min(F.when(leading, me)).over(group).alias("longer"),
        F.min(F.when(skips, me)).over(group).alias("first"),
        F.lead(F.when(skips, me)).over(ranked).alias("next"),
    )
    replaced = F.when(F.col("me") == F.col("first"), F.col("next")).otherwise(F.col("first"))
    shorter = F.when(F.col("leads"), F.col("shorter"))
    met = scanned.where("size > 1").select(
        "id",
        F.when(F.col("whole"), F.col("leading")).otherwise(F.col("skips") - 1 + shorter.isNotNull().cast("int")).alias("found"),
        F.when(F.col("whole"), F.col("longer")).otherwise(F.least(replaced, shorter)).alias("best"),
    )
    near = met.where("found > 0").groupBy("id").agg(F.sum("found").alias("n_near"), F.min("best").alias("best"))
    return near.select("id", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.id").alias("best_id"))


def _last_forms(forms: DataFrame) -> DataFrame:
    """``id, root`` from ``id, form``: every step is ``TIMES`` as frequent at least, so doubling ends after five or six rounds."""
    paths = forms.select("id", F.col("form").alias("root"))
    while True:
        ahead = paths.select(F.col("id").alias("root"), F.col("root").alias("_ahead"))
        further = materialise(paths.join(ahead, "root", "left").select("id", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("_moved")), "forms")
        moving = not further.where("_moved").isEmpty()
        if hasattr(paths, "_granary_path"):
            discard(paths)
        paths = further
        if not moving:
            return paths.drop("_moved")


def spelling_variants(docs: DataFrame, times: int = TIMES, damage: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word; see the head of this module for the odd cases."""
    words = materialise(numbered(counted_words(docs, damage=damage), ["word"], "id"), "words")
    near = materialise(near_words(words), "near-words")
    ready = words.select("id", "n").join(near, "id").where(F.col("best_n") >= times * F.col("n"))
    forms = materialise(ready.select("id", F.col("best_id").alias("form"), F.col("best_n").alias("form_n")), "forms")
    roots = _last_forms(forms.select("id", "form"))
    named = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
    linked = forms.join(roots.join(named("root"), "root"), "id").join(named("form"), "form")
    full = words.join(near.select("id", "n_near"), "id", "left").join(linked.select("id", "form_word", "root_word", "form_n"), "id", "left")
    return full.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        "form_n",
    )
