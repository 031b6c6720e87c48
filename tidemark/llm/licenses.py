"""Licence recognition by sentences and ordered rules, in built-in expressions only.

A text's lines and paragraphs are cut into sentences, each is normalised (lower case,
letters, digits and dots only, one blank between words), and known sentences get their
identifier.  The sequence of identifiers is then matched against the licence rules in
their order; a rule is a sequence of identifiers that must follow one another, and a
rule that matches takes its sentences away from the weaker rules below it.

Sentences are looked for in lines and, for wrapped texts, in paragraphs with their line
breaks as blanks.

Edge cases: null and empty texts and texts without a known sentence or a licence word give
no row; texts with licence words but no rule that matches give the licence ``UNKNOWN``;
copies and repeated rows give a row each; a doc_id may be null; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, let

#: Identifiers of licence sentences and the sentences, normalised.
SENTENCES = (
    ("ApacheLic", "licensed under the apache license version 2.0"),
    ("ApacheLicThe", "licensed under the apache license version 2.0 the license"),
    ("ApacheMayNot", "you may not use this file except in compliance with the license"),
    ("ApacheCopy", "you may obtain a copy of the license at"),
    ("ApacheAsIs", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("ApacheSee", "see the license for the specific language governing permissions and limitations under the license"),
    ("MitReleased", "released under the mit license"),
    ("MitLicensed", "licensed under the mit license"),
    ("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("MitNotice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("AsIsMit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("Gpl3Work", "this work is licensed under the gnu general public license version 3"),
    ("Gpl2Work", "this work is licensed under the gnu general public license version 2"),
    ("FreeSoftware", "this program is free software"),
    ("GplTerms3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("GplTerms2", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("GplHope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("GplImplied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("GplSee", "see the gnu general public license for more details"),
    ("Lgpl3Work", "this work is licensed under the gnu lesser general public license version 3"),
    ("CcByNc4", "licensed under cc by nc 4.0"),
    ("CcBy4", "licensed under cc by 4.0"),
    ("CcBySa4", "licensed under cc by sa 4.0"),
    ("CcBy4Work", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("CcByNc4Work", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("CcBySa4Work", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("Bsd3Lic", "licensed under the bsd 3 clause license"),
    ("Bsd2Lic", "licensed under the bsd 2 clause license"),
    ("Mpl2Subject", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("SpdxMit", "spdx license identifier mit"),
    ("SpdxApache", "spdx license identifier apache 2.0"),
    ("SpdxGpl3", "spdx license identifier gpl 3.0 only"),
    ("Reserved", "all rights reserved"),
)

#: Licence rules, strongest first: (licence, sequence of sentence identifiers).
RULES = (
    ("Apache-2.0", ("ApacheLicThe", "ApacheMayNot", "ApacheCopy")),
    ("Apache-2.0", ("ApacheLic", "ApacheMayNot")),
    ("MIT", ("MitGrant", "MitNotice", "AsIsMit")),
    ("MIT", ("MitGrant", "MitNotice")),
    ("GPL-3.0-or-later", ("FreeSoftware", "GplTerms3", "GplHope", "GplImplied", "GplSee")),
    ("GPL-3.0-or-later", ("FreeSoftware", "GplTerms3")),
    ("GPL-2.0-or-later", ("FreeSoftware", "GplTerms2")),
    ("GPL-3.0", ("Gpl3Work",)),
    ("GPL-2.0", ("Gpl2Work",)),
    ("LGPL-3.0", ("Lgpl3Work",)),
    ("Apache-2.0", ("ApacheLicThe",)),
    ("Apache-2.0", ("ApacheLic",)),
    ("MIT", ("MitReleased",)),
    ("MIT", ("MitLicensed",)),
    ("MIT", ("MitGrant",)),
    ("CC-BY-NC-4.0", ("CcByNc4",)),
    ("CC-BY-NC-4.0", ("CcByNc4Work",)),
    ("CC-BY-SA-4.0", ("CcBySa4",)),
    ("CC-BY-SA-4.0", ("CcBySa4Work",)),
    ("CC-BY-4.0", ("CcBy4",)),
    ("CC-BY-4.0", ("CcBy4Work",)),
    ("BSD-3-Clause", ("Bsd3Lic",)),
    ("BSD-2-Clause", ("Bsd2Lic",)),
    ("MPL-2.0", ("Mpl2Subject",)),
    ("MIT", ("SpdxMit",)),
    ("Apache-2.0", ("SpdxApache",)),
    ("GPL-3.0", ("SpdxGpl3",)),
)

#: Every known sentence holds one of these, so texts without any are not cut up.
LICENCE_WORDS = r"(?i)licen[sc]|copyright|permission|warrant|free software|rights reserved"

_WORDS = "[^a-z0-9.]+"


def normalised(sentence: Column) -> Column:
    """Lower case, other than letters, digits and dots as blanks, no dots at either end."""
    return F.btrim(F.regexp_replace(F.lower(sentence), _WORDS, " "), F.lit(" ."))


def _sentences(text: Column) -> Column:
    """Sentences of lines, in order; a blank line apart, then those of paragraphs."""
    lines = F.split(text, r"\r?\n")
    paragraphs = F.split(text, r"(?:[ \t]*\r?\n){2,}")
    cut = lambda parts: F.flatten(F.transform(parts, lambda p: F.split(p, r"(?<=[.!?;:])\s+")))
    return F.concat(cut(lines), F.array(F.lit("")), cut(F.transform(paragraphs, lambda p: F.regexp_replace(p, r"\s+", " "))))


def _identified(text: Column, sentences: Sequence[tuple[str, str]]) -> Column:
    """Identifiers of the known sentences in order, ``-`` for runs of others."""
    known = F.create_map(*[F.lit(x) for name, s in sentences for x in (s, name)])
    of = lambda s: F.coalesce(F.try_element_at(known, normalised(s)), F.lit("-"))
    named = F.transform(_sentences(text), of)
    return let(named, lambda n: F.filter(n, lambda x, i: (x != "-") | (F.coalesce(F.get(n, i - 1), F.lit("-")) != "-")))


def _matched(sequence: Column, rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Licences of the rules that match, in the rules' order, as an array.

    ``sequence`` is written as ``;a;;b;;-;``; a rule's identifiers must follow one another
    there and are then taken out, so that no weaker rule counts them again.
    """
    def taken(part: str, licence: str):
        return lambda s: F.when(F.contains(s["left"], F.lit(part)), F.struct(
            F.replace(s["left"], F.lit(part), F.lit(";-;")).alias("left"), F.array_append(s["found"], F.lit(licence)).alias("found"))).otherwise(s)

    state = F.struct(F.concat(F.lit(";"), F.array_join(sequence, ";;"), F.lit(";")).alias("left"), F.array().cast("array<string>").alias("found"))
    for licence, ids in rules:
        state = let(state, taken("".join(f";{x};" for x in ids), licence))
    return F.array_distinct(state["found"])


def recognise(docs: DataFrame, sentences: Sequence[tuple[str, str]] = SENTENCES, rules=RULES) -> DataFrame:
    """(doc_id, sentences, licenses) of texts with licence words; both comma-joined.

    ``sentences``: distinct identifiers in order of first appearance.  ``licenses``: in the
    order of the rules, ``UNKNOWN`` if none matches.
    """
    hit = doc_texts(docs).filter(F.col("text").rlike(LICENCE_WORDS)).withColumn("ids", _identified(F.col("text"), sentences))
    found = hit.select("doc_id", "ids", _matched(F.col("ids"), rules).alias("licenses"))
    return found.select("doc_id", F.array_join(F.array_distinct(F.filter("ids", lambda x: x != "-")), ",").alias("sentences"),
                        F.when(F.size("licenses") > 0, F.array_join("licenses", ",")).otherwise("UNKNOWN").alias("licenses"))


def _oracle() -> str:
    """The same rules over whole lines; enough for texts whose licence sentences stand on lines of their own."""
    known = ", ".join(f"('{s}', '{n}', {i})" for i, (n, s) in enumerate(SENTENCES))
    single = [(lic, ids[0], i) for i, (lic, ids) in enumerate(RULES) if len(ids) == 1]
    rules = ", ".join(f"('{n}', '{lic}', {i})" for lic, n, i in single)
    words = LICENCE_WORDS
    return f"""
WITH known(s, name, k) AS (VALUES {known}), rules(name, licence, r) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE regexp_matches(text, '{words}')),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
p AS (SELECT rid, i, unnest(string_split(regexp_replace(line, '([.!?;:])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10))) AS part,
        unnest(range(len(string_split(regexp_replace(line, '([.!?;:])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10))))) AS j FROM l),
n AS (SELECT rid, i, j, trim(regexp_replace(lower(part), '[^a-z0-9.]+', ' ', 'g'), ' .') AS s FROM p),
m AS (SELECT rid, name, min(i * 100000 + j) AS pos FROM n JOIN known USING (s) GROUP BY 1, 2),
f AS (SELECT rid, string_agg(name, ',' ORDER BY pos) AS sentences FROM m GROUP BY 1),
g AS (SELECT rid, string_agg(licence, ',' ORDER BY r) AS licenses
      FROM (SELECT rid, licence, min(r) AS r FROM m JOIN rules USING (name) GROUP BY 1, 2) GROUP BY 1)
SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(licenses, 'UNKNOWN') AS licenses
FROM d LEFT JOIN f USING (rid) LEFT JOIN g USING (rid)
"""


ORACLE_SQL = _oracle()
