"""Licence scan: sentences become identifiers, identifier sequences are matched against ordered rules.

DataFrame and SQL functions only, one expression per row: no shuffle, no join. A whole text is normalised (lower case,
letters and digits, single blanks, marks for the ends of sentences) and the known licence sentences are found in it in
their order. Line breaks, comment marks, ``v. 2.0`` and ``Identifier: MIT`` count as blanks inside a known sentence. The identifiers of a text form a line such as ``,7,,8,,9,``. A rule is an ordered list of identifiers;
it holds where they follow one another, other known sentences in between allowed.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences and notices, normalised, with their identifiers.
SENTENCES = {
    1: "licensed under the apache license version 2 0",
    2: "released under the mit license",
    3: "this work is licensed under the gnu general public license version 3",
    4: "licensed under cc by nc 4 0",
    5: "you may not use this file except in compliance with the license",
    6: "you may obtain a copy of the license at",
    7: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    8: "see the license for the specific language governing permissions and limitations under the license",
    9: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    10: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    11: "the software is provided as is without warranty of any kind express or implied",
    12: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    13: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    14: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",
    15: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    16: "this software is provided by the copyright holders and contributors as is",
    17: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    18: "this program is distributed in the hope that it will be useful but without any warranty",
    19: "you should have received a copy of the gnu general public license along with this program",
    20: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    21: "the software is provided as is and the author disclaims all warranties with regard to this software",
    22: "this source code form is subject to the terms of the mozilla public license v 2 0",
    23: "if a copy of the mpl was not distributed with this file you can obtain one at",
    24: "this is free and unencumbered software released into the public domain",
    25: "anyone is free to copy modify publish use compile sell or distribute this software",
    26: "this work is licensed under a creative commons attribution 4 0 international license",
    27: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    28: "spdx license identifier apache 2 0",
    29: "spdx license identifier mit",
    30: "spdx license identifier gpl 3 0",
    31: "spdx license identifier bsd 3 clause",
    32: "all rights reserved",
}

# Rules as (licence, kind, ordered sentence identifiers), longer ones of a licence first.
RULES: list[tuple[str, str, tuple[int, ...]]] = [
    ("Apache-2.0", "header", (1, 5, 6, 7, 8)),
    ("Apache-2.0", "header", (1, 5, 7)),
    ("Apache-2.0", "notice", (1,)),
    ("Apache-2.0", "tag", (28,)),
    ("MIT", "text", (9, 10, 11)),
    ("MIT", "notice", (2,)),
    ("MIT", "tag", (29,)),
    ("GPL-3.0", "header", (17, 18, 19)),
    ("GPL-3.0", "notice", (3,)),
    ("GPL-3.0", "tag", (30,)),
    ("CC-BY-NC-4.0", "notice", (4,)),
    ("CC-BY-4.0", "notice", (26,)),
    ("CC-BY-SA-4.0", "notice", (27,)),
    ("BSD-3-Clause", "text", (12, 13, 14, 15, 16)),
    ("BSD-3-Clause", "tag", (31,)),
    ("BSD-2-Clause", "text", (12, 13, 14, 16)),
    ("ISC", "text", (20, 21)),
    ("MPL-2.0", "header", (22, 23)),
    ("MPL-2.0", "notice", (22,)),
    ("Unlicense", "text", (24, 25)),
]
#: Licences whose text holds another's.
_WITHIN = {"BSD-2-Clause": "BSD-3-Clause"}

#: Every known sentence has one of these; other texts are not normalised at all.
HINT = "(?i)licen[sc]e|copyright|warrant|permission|public domain|rights reserved|redistribut|gnu|anyone is free"
#: Ends of sentences: lines, closing marks before white space, runs of ornaments.
ENDS = r"[.!?;:]+(?:\s|$)|[\n\r]+|[!#$%&*|]+"
_KNOWN = "|".join(sorted(SENTENCES.values(), key=lambda s: (-len(s), s)))
#: The hint and the known sentences where a line break or comment mark may stand between two words.
_HINT = HINT.replace(" ", "[^A-Za-z0-9]+")
#: ``ENDS`` in two: those that may stand inside a known sentence (line breaks, comment marks, ``v. 2.0``, ``Identifier: MIT``), and the others.
_SOFT = r"[.:]+(?:\s|$)|[\n\r]+|[#*|]+"
_HARD = r"[.:]*[!?;][.!?;:]*(?:[\s|]|$)|[!$%&]+"
_FOUND = rf"(?<![a-z0-9])(?:{_KNOWN.replace(' ', '[ |]')})(?![a-z0-9])"


def normalised(text: Column) -> Column:
    """Lower case, letters and digits, single blanks; between two sentences one ``|``, or ``!`` where no known sentence goes on."""
    lines = F.regexp_replace(text, r"[\n\r]+[ \t]*[;!%&$]+", "\n")  # comment marks
    cut = F.regexp_replace(F.regexp_replace(lines, _SOFT, "|"), _HARD, "!")
    words = F.regexp_replace(F.lower(cut), "[^a-z0-9|!]+", " ")
    ends = F.regexp_replace(F.regexp_replace(words, r" ?\|[ |]*", "|"), r"[ |]?![ |!]*", "!")
    return F.regexp_replace(ends, r"^[ |!]+|[ |!]+$", "")


def known_sentences(text: Column) -> Column:
    """``array<struct<id, sentence>>``: the known sentences of a text in order, each with the number, from 0, of the text's
    sentence that it begins in; null without any hint of a licence."""
    ids = F.create_map(*chain.from_iterable((F.lit(s), F.lit(i)) for i, s in SENTENCES.items()))
    bars = lambda t: F.length(t) - F.length(F.translate(t, "|!", ""))

    def found(whole: Column) -> Column:
        values, parts = F.regexp_extract_all(whole, F.lit(_FOUND), 0), F.split(whole, _FOUND, -1)
        rows = F.filter(F.arrays_zip(values.alias("value"), parts.alias("left")), lambda c: c["value"].isNotNull())
        start = F.struct(F.lit(0).alias("sentence"), F.array().cast("array<struct<id:int,sentence:int>>").alias("rows"))

        def step(seen: Column, c: Column) -> Column:
            at = seen["sentence"] + bars(c["left"])
            row = F.struct(ids[F.translate(c["value"], "|", " ")].alias("id"), at.alias("sentence"))
            return F.struct((at + bars(c["value"])).alias("sentence"), F.array_append(seen["rows"], row).alias("rows"))

        return F.when(whole.rlike(_FOUND), F.aggregate(rows, start, step, lambda seen: seen["rows"]))

    return F.when(text.rlike(_HINT), _once(normalised(text), found))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, however often it is named."""
    return F.element_at(F.transform(F.array(value), then), 1)


def licences(text: Column) -> Column:
    """``array<struct<licence, kind, first_sentence, sentences>>``: the longest rule of each licence that a text follows."""

    def rows(known: Column) -> Column:
        ids = F.transform(known, lambda k: k["id"])
        line = F.concat(F.lit(","), F.array_join(ids.cast("array<string>"), ",,"), F.lit(","))
        return F.when(known.isNotNull(), _once(F.struct(known.alias("known"), ids.alias("ids"), line.alias("line")), followed))

    def followed(c: Column) -> Column:
        rows = []
        for k, (licence, kind, rule) in enumerate(RULES):
            holds = c["line"].rlike(_spaced(rule))
            for other in longer_rules(k):
                holds = holds & ~c["line"].rlike(_spaced(other[2]))
            first = F.try_element_at(c["known"], F.array_position(c["ids"], rule[0]).cast("int"))["sentence"]
            row = F.struct(F.lit(licence).alias("licence"), F.lit(kind).alias("kind"), first.alias("first_sentence"), F.lit(len(rule)).alias("sentences"))
            rows.append(F.when(holds, row))
        return F.filter(F.array(*rows), lambda r: r.isNotNull())

    return _once(known_sentences(text), rows)


def longer_rules(k: int) -> list[tuple[str, str, tuple[int, ...]]]:
    """The rules that take precedence over rule ``k``: longer ones of its licence, and of a licence whose text holds it."""
    licence, _, rule = RULES[k]
    return [r for r in RULES[:k] if r[0] == licence or _WITHIN.get(licence) == r[0] and set(rule) <= set(r[2])]


def _spaced(rule: tuple[int, ...]) -> str:
    """The rule over a line in which every identifier has a comma on either side."""
    return ",(?:,[0-9]+,)*?".join(f",{i}" for i in rule) + ","


def find_licences(docs: DataFrame) -> DataFrame:
    """``doc_id, licence, kind, first_sentence, sentences``: one row for each licence that a text names or holds.

    ``kind`` tells a notice, header, tag or whole text; ``first_sentence`` counts the text's sentences from 0 to the first
    place of the rule's first sentence; a known sentence that line breaks or comment marks cut counts where it begins. Null and empty texts and texts without a known sentence give no row. Repeated rows
    give theirs each, a null ``doc_id`` stays null. Other columns are not read.
    """
    text = F.col("text").cast("string")
    # Nearly all texts end at the hint; the rest is worked out once, for the others.
    return docs.where(text.rlike(_HINT)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.inline(licences(text)))
