"""Licence scans by sentence rules (operator 4), DataFrame functions only.

A text is cut into sentences (at line ends and after . ! ? ; followed by
white space) and each sentence is normalised: lower case, runs of other
characters than letters and digits become one blank. Known sentences have
identifiers; the others are forgotten. A known sentence may be wrapped: it is also
found where several cut sentences in a row, joined by blanks, equal it; the
longest one counts. The identifiers of a document, in
order, form a string in which each rule, an ordered sequence of identifiers, is
searched. A rule that stands inside a longer matched rule of the same place is
not reported. Places are counted over the cut sentences, so a wrapped
sentence takes several.

The known sentences and rules are small fixed tables; only documents that
hold one of the words without which no known sentence exists are cut at all.

Cases: a null text counts as empty; documents without a match give no row; a
rule that occurs several times gives a row per occurrence; repeated rows give
repeated results; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
CC_PARTS = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
CC_KINDS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = {"4.0": "International", "3.0": "Unported"}

# Sentences of licence texts and notices, by identifier.
SENTENCES = {
    10: "Licensed under the Apache License, Version 2.0.",
    11: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    12: "you may not use this file except in compliance with the License.",
    13: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
    14: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    15: "See the License for the specific language governing permissions and limitations under the License.",
    20: "Released under the MIT License.",
    21: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    22: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    23: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    24: "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    30: "This work is licensed under the GNU General Public License, version 3.",
    31: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    32: "See the GNU General Public License for more details.",
    33: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    34: "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    40: "Licensed under CC BY-NC 4.0.",
    41: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    50: "All rights reserved.",
    60: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    61: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    62: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    63: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    64: "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    65: "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;",
    70: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    80: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    81: "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    82: "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    90: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/.",
    91: "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
}
# Rules, each a licence and its sentences in order.
RULES = {
    "apache-2.0-notice": ("Apache-2.0", [10]),
    "apache-2.0-header": ("Apache-2.0", [11, 12, 13]),
    "apache-2.0-full-header": ("Apache-2.0", [11, 12, 13, 14, 15]),
    "apache-2.0-short": ("Apache-2.0", [11, 12]),
    "mit-notice": ("MIT", [20]),
    "mit-text": ("MIT", [21, 22]),
    "mit-named-text": ("MIT", [20, 21, 22]),
    "mit-full-text": ("MIT", [21, 22, 23, 24]),
    "gpl-3.0-notice": ("GPL-3.0", [30]),
    "gpl-3.0-header": ("GPL-3.0", [31, 32]),
    "gpl-3.0-full-header": ("GPL-3.0", [31, 33, 34, 32]),
    "gpl-3.0-grant": ("GPL-3.0", [31]),
    "cc-by-nc-4.0-notice": ("CC-BY-NC-4.0", [40]),
    "cc-by-4.0-notice": ("CC-BY-4.0", [41]),
    "all-rights-reserved": ("proprietary", [50]),
    "bsd-start": ("BSD", [60, 61]),
    "bsd-2-text": ("BSD-2-Clause", [60, 61, 62, 64, 65]),
    "bsd-3-text": ("BSD-3-Clause", [60, 61, 62, 63, 64, 65]),
    "isc-grant": ("ISC", [70]),
    "mpl-2.0-header": ("MPL-2.0", [80, 81]),
    "mpl-2.0-header-https": ("MPL-2.0", [80, 82]),
    "epl-2.0-header": ("EPL-2.0", [90]),
    "epl-1.0-header": ("EPL-1.0", [91]),
}


def _families() -> None:
    """The GNU and Creative Commons families: one notice, grant and deed a licence and version, from their names."""
    sid = 100
    for short, name in GNU.items():
        for version in ("2", "2.1", "3") if short == "LGPL" else ("2", "3"):
            if (short, version) in (("AGPL", "2"), ("LGPL", "2")):
                continue
            key, licence = f"{short.lower()}-{version if '.' in version else version + '.0'}", f"{short}-{version if '.' in version else version + '.0'}"
            thing = "library" if short == "LGPL" else "program"
            mark = ":" if version == "3" else ";"
            terms = f"under the terms of the {name} as published by the Free Software Foundation{';' if mark == ';' else ','} either version {version} of the License, or (at your option) any later version."
            for k, text in ((sid, f"This work is licensed under the {name}, version {version}."),
                            (sid + 1, f"This {thing} is free software{mark} you can redistribute it and/or modify it {terms}"),
                            (sid + 2, f"You should have received a copy of the {name} along with this {thing}.")):
                if text not in SENTENCES.values():
                    SENTENCES[k] = text
                    RULES.setdefault(f"{key}-{('notice', 'grant', 'copy')[k - sid]}", (licence, [k]))
            sid += 3
    sid = 200
    for kind in CC_KINDS:
        for version, scope in CC_VERSIONS.items():
            full = "-".join(CC_PARTS[p] for p in kind.split("-"))
            licence = f"CC-{kind.upper()}-{version}"
            for k, text in ((sid, f"Licensed under CC {kind.upper()} {version}."),
                            (sid + 1, f"This work is licensed under a Creative Commons {full} {version} {scope} License.")):
                if text not in SENTENCES.values():
                    SENTENCES[k] = text
                    RULES.setdefault(f"cc-{kind}-{version}-{('short', 'deed')[k - sid]}", (licence, [k]))
            sid += 2


_families()
# Words of which every known sentence holds one, and every text that a rule matches.
GATE = ["licens", "permission", "redistribut", "reserved"]


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def known_sentences() -> list[tuple[int, str]]:
    """``(sid, sentence)``, normalised, of the known sentences."""
    return [(k, re.sub("[^a-z0-9]+", " ", raw.lower()).strip()) for k, raw in SENTENCES.items()]


def known_at(parts: Column, place: Column, part: Column) -> Column:
    """``(size, place, sid)`` of the longest known sentence that ``size`` of the normalised
    ``parts`` make up from ``place`` (where ``part`` stands) on; null if there is none."""
    known = known_sentences()
    # each part has a word or more, so the sentence's number of words bounds the parts looked at
    table = F.array(*[
        F.struct(F.lit(k).alias("sid"), F.lit(s).alias("sentence"), F.lit(s + " ").alias("closed"), F.lit(len(s.split())).alias("words"))
        for k, s in known])

    def joined(size: Column) -> Column:  # single elements: F.slice copies the whole array
        return F.array_join(F.transform(F.sequence(F.lit(0), size - 1), lambda j: F.get(parts, place - 1 + j)), " ")

    def size_of(k: Column) -> Column:
        begun = F.startswith(F.concat(joined(k["words"]), F.lit(" ")), k["closed"])
        # past the end of the text nothing is joined: the least size counts
        sizes = F.filter(F.sequence(F.lit(1), k["words"]), lambda m: joined(m) == k["sentence"])
        return F.when(begun, F.array_min(sizes))

    near = F.filter(table, lambda k: F.startswith(k["closed"], F.concat(part, F.lit(" "))))
    sized = F.transform(near, lambda k: F.struct(size_of(k).alias("size"), place.alias("place"), k["sid"].alias("sid")))
    return F.array_max(F.filter(sized, lambda x: x["size"].isNotNull()))


def rule_matches(sid_at, k: Column, ids: list[int]) -> Column:
    """Do the known sentences from place ``k`` on have these identifiers?"""
    out = sid_at(k) == ids[0]
    for j, sid in enumerate(ids[1:], 1):
        out = out & (sid_at(k + j) == sid)
    return F.coalesce(out, F.lit(False))


def rule_spans(sid_at, k: Column, first: int) -> Column:
    """``(rule, license, n_sentences)`` of the rules that begin with sentence ``first`` and match at place ``k``, but
    for those that stand inside a longer rule which matches around them. Constant work a place."""
    found = []
    for name, (licence, ids) in RULES.items():
        if ids[0] != first:
            continue
        hit = rule_matches(sid_at, k, ids)
        for _, outer in RULES.values():
            for at in range(len(outer) - len(ids) + 1) if len(outer) > len(ids) else ():
                if outer[at : at + len(ids)] == ids:
                    hit = hit & ~rule_matches(sid_at, k - at, outer)
        found.append(F.when(hit, F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("license"), F.lit(len(ids)).alias("n"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, license, rule, n_sentences, first_sentence, last_sentence)`` of every match; the
    sentences are counted from 1 over the document's own."""
    gate = F.lit(False)
    for word in GATE:
        gate = gate | F.lower(F.col("text")).contains(word)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(gate)
    cut = F.split(F.regexp_replace("text", r"([.!?;])[ \t\r\n]+", "$1\n"), "\n+")
    cut = F.filter(cut, lambda s: s.rlike("[A-Za-z0-9]"))
    # a generated column is computed once: the optimizer doesn't repeat it inside the lambdas below
    parted = rows.select("id", F.explode(F.array(F.transform(cut, normalised))).alias("parts"))
    found = F.transform("parts", lambda part, k: known_at(F.col("parts"), k + 1, part))
    # only a document's known sentences go on
    seen = parted.select("id", F.explode(F.array(F.filter(found, lambda x: x.isNotNull()))).alias("seen")).filter(F.size("seen") > 0)

    def sid_at(k: Column) -> Column:
        return F.get("seen", k)["sid"]

    starts = sorted({ids[0] for _, ids in RULES.values()})

    def spans_at(x: Column, k: Column) -> Column:
        by_first = F.lit(None)
        for first in starts:
            by_first = F.when(x["sid"] == first, rule_spans(sid_at, k, first)).otherwise(by_first)
        return F.transform(F.coalesce(by_first, F.array().cast("array<struct<rule:string,license:string,n:int>>")), lambda m: F.struct(
            m["rule"].alias("rule"), m["license"].alias("license"), m["n"].cast("bigint").alias("n_sentences"),
            x["place"].cast("bigint").alias("first_sentence"),
            (F.get("seen", k + m["n"] - 1)["place"] + F.get("seen", k + m["n"] - 1)["size"] - 1).cast("bigint").alias("last_sentence")))

    spans = seen.select("id", F.explode(F.flatten(F.transform("seen", spans_at))).alias("m"))
    return spans.select(
        F.col("id").alias(id_col), "m.license", "m.rule", "m.n_sentences", "m.first_sentence", "m.last_sentence")


def oracle_sql() -> str:
    quoted = lambda s: s.replace("'", "''")
    known = ", ".join(f"({k}, '{quoted(s)}')" for k, s in SENTENCES.items())
    rules = ", ".join(f"('{k}', '{name}', '{','.join(map(str, ids))}', {len(ids)})" for k, (name, ids) in RULES.items())
    return f"""
WITH known AS (SELECT sid, trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM (VALUES {known}) t(sid, raw)),
rules AS (SELECT * FROM (VALUES {rules}) t(rule, license, ids, n)),
cut AS (
  SELECT doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?;])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), '\\n+'),
                             lambda s: regexp_matches(s, '[A-Za-z0-9]')) AS parts FROM documents
),
sent AS (
  SELECT doc_id, place, parts, part FROM (
    SELECT doc_id, unnest(range(1, len(parts) + 1)) AS place, parts, unnest(parts) AS part FROM (
      SELECT doc_id, list_transform(parts, lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))) AS parts FROM cut))
  WHERE part IN (SELECT array_to_string(string_split(sentence, ' ')[1 : w], ' ') FROM known, range(1, 90) n(w))
),
sized AS (
  SELECT doc_id, place, sid, min(m) AS size FROM sent JOIN known ON starts_with(known.sentence, part), range(1, 90) n(m)
  WHERE m <= len(string_split(sentence, ' ')) AND array_to_string(parts[place : place + m - 1], ' ') = sentence GROUP BY doc_id, place, sid
),
seen AS (
  SELECT doc_id, place, sid, place + size - 1 AS stop, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, place ORDER BY size DESC, sid DESC) AS best FROM sized) WHERE best = 1
),
spans AS (
  SELECT a.doc_id, a.k AS a, b.k AS b, a.place AS first_sentence, b.stop AS last_sentence, rule, license, n
  FROM rules r JOIN seen a ON true JOIN seen b ON b.doc_id = a.doc_id AND b.k = a.k + r.n - 1
  WHERE (SELECT string_agg(sid, ',' ORDER BY k) FROM seen c WHERE c.doc_id = a.doc_id AND c.k BETWEEN a.k AND b.k) = r.ids
)
SELECT doc_id, license, rule, CAST(n AS BIGINT) AS n_sentences, first_sentence, last_sentence FROM spans x
WHERE NOT EXISTS (SELECT 1 FROM spans y WHERE y.doc_id = x.doc_id AND y.a <= x.a AND y.b >= x.b AND y.b - y.a > x.b - x.a)
"""
