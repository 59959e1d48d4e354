"""Licence scan by canonical digests: equal texts after normalisation, found by a hash join.

A text is cut into lines. Copyright lines are left out; the others are lower-cased, everything but
letters and digits becomes one blank, and equivalent spellings are brought to one form word by word.
The SHA-256 digest of the joined words is looked up among the digests of known licence texts: once
for the entire text, and once for each run of words in it that is as long as a known text and starts
with that text's first words. So a notice or a whole licence is found however its lines are broken,
inside longer lines and between other text. Numbers and spellings must be those of a known text.

Of the known texts only first words and lengths reach the driver. Digests of runs meet the known
digests in a join that keeps one row for each document and place found; Spark broadcasts them while
they are small and merges otherwise. Words that start no known text make no row, however frequent.

Defined results:
* null, empty or blank texts, and texts of copyright lines alone, match nothing;
* known texts that are equal after normalisation: all their ids are listed;
* repeated documents: each row has its own result; columns of the input are not read but for id and text;
* empty tables: no rows, or no matches.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words that licence texts use for the same thing -> one form.
EQUIVALENT = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing",
    "sublicence": "sublicense", "acknowledgement": "acknowledgment", "analogue": "analog", "authorised": "authorized",
    "behaviour": "behavior", "centre": "center", "favour": "favor", "fulfilment": "fulfillment", "honour": "honor",
    "judgement": "judgment", "organisation": "organization", "programme": "program", "recognise": "recognize",
    "whilst": "while", "wilful": "willful", "v2": "version 2", "v3": "version 3", "https": "http",
}

# Short public notices (id, text).
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
]

# Standard headers, and ways to write them (id, text).
GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License "
       "as published by the Free Software Foundation, {2}")
HEADERS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", "licenses this file to you under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License 2.0"),
    ("MIT", "This project is licensed under the MIT License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("ISC", "Licensed under the ISC License"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License v. 2.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License v2.0"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("CC0-1.0", "Licensed under CC0 1.0"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
                "software to the public domain worldwide"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *[(i, GNU.format(what, kind, end.format(version)))
      for i, kind, version in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library", "2"), ("LGPL-2.1", "Lesser", "2.1"),
                               ("LGPL-3.0", "Lesser", "3"), ("AGPL-3.0", "Affero", "3"))
      for what in ("program", "library", "file", "software")
      for end in ("either version {0} of the License, or (at your option) any later version", "version {0}")],
    *[(i, f"{start} the GNU {kind} General Public License, version {version}")
      for i, kind, version in (("LGPL-2.1", "Lesser", "2.1"), ("LGPL-3.0", "Lesser", "3"), ("AGPL-3.0", "Affero", "3"))
      for start in ("This work is licensed under", "Licensed under")],
]

# Whole licence texts: license_texts/ID.txt, and ID.regents.txt for the wording of the University of California.
TEXTS = Path(__file__).parent / "license_texts"
# Titles that may stand above a licence text without a title of its own.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "ISC License (ISC)", "The ISC License"],
          "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"], "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License"],
          "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"], "Unlicense": ["The Unlicense"]}
LIST_NUMBER = r"(?m)^\s*\(?[0-9a-z][.)]\s"

# Lines of a licence that is broken before the word "copyright" are none.
COPYRIGHT_LINE = (r"^\s*(?:(?i:copyright)(?!\s+(?i:notices?|holders?|owners?|laws?|licen[sc]es?|interests?|and|or|statements?|disclaimers?|permission)\b)"
                  r"|(?i:\(c\)|©))")
ANCHOR = 3  # words by which the start of a known text is recognised


def known_notices(spark: SparkSession) -> DataFrame:
    rows = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in NOTICES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(license_id, text)")


def known_texts(spark: SparkSession) -> DataFrame:
    """(license_id, text): notices, standard headers and whole licence texts, with titles and with unnumbered clauses."""
    rows = [*NOTICES, *HEADERS]
    for path in sorted(TEXTS.glob("*.txt")):
        full = path.read_text(encoding="utf-8")
        license_id = path.stem.removesuffix(".regents")
        for body in dict.fromkeys([full, re.sub(LIST_NUMBER, " ", full)]):
            rows += [(license_id, f"{title}\n{body}") for title in ["", *TITLES.get(license_id, [])]]
    return spark.createDataFrame(rows, "license_id string, text string")


def canonical_lines(text: Column) -> Column:
    """The normalised lines of a text that hold a word and aren't copyright lines."""
    spelling = F.create_map(*[F.lit(x) for pair in EQUIVALENT.items() for x in pair])
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE))

    def canonical(line: Column) -> Column:
        words = F.split(F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " ")), " ")
        return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(spelling, w), w)), " ")

    return F.filter(F.transform(lines, canonical), lambda line: line != "")


def digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def known_canonical(known: DataFrame) -> DataFrame:
    """(license_id, t): the joined words."""
    return known.select("license_id", F.array_join(canonical_lines(F.col("text")), " ").alias("t")).where("t <> ''")


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id), each once."""
    return known_canonical(known).select(digest(F.col("t")).alias("digest"), "license_id").distinct()


def known_starts(known: DataFrame) -> tuple[int, dict[str, list[int]]]:
    """(words of a start, start -> lengths in words of the known texts that begin so)."""
    words = F.split("t", " ")
    found = known_canonical(known).select(F.slice(words, 1, ANCHOR).alias("start"), F.size(words).alias("n")).distinct().collect()
    size = min((len(r.start) for r in found), default=ANCHOR)
    starts = {}
    for r in found:
        starts.setdefault(" ".join(r.start[:size]), set()).add(r.n)
    return size, {s: sorted(n) for s, n in sorted(starts.items())}


def runs(words: Column, known: DataFrame) -> Column:
    """(at, to, digest) of the runs of words that start like a known text and are as long."""
    size, starts = known_starts(known)
    if not starts:
        return F.array().cast("array<struct<at:int,to:int,digest:string>>")
    lengths = F.create_map(*[x for s, n in starts.items() for x in (F.lit(s), F.array(*map(F.lit, n)))])
    first = sorted({s.split(" ")[0] for s in starts})
    places = F.filter(F.sequence(F.lit(1), F.size(words)), lambda at: F.element_at(words, at).isin(first))

    def at_place(at: Column) -> Column:
        fitting = F.filter(F.try_element_at(lengths, F.array_join(F.slice(words, at, size), " ")), lambda n: at + n - 1 <= F.size(words))
        return F.transform(fitting, lambda n: F.struct(at.alias("at"), (at + n - 1).alias("to"), digest(F.array_join(F.slice(words, at, n), " ")).alias("digest")))

    return F.flatten(F.filter(F.transform(places, at_place), lambda found: found.isNotNull()))


def license_scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, whole, notices, n_notices): ids for the entire text, ids found in it, found runs that are in no longer one."""
    lines = canonical_lines(F.col(text_col))
    name = F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("h"), F.octet_length(text_col).alias("n"))
    rows = docs.select(name.alias("_row"), F.array_join(lines, " ").alias("t")).select("_row", "t", F.split("t", " ").alias("words"))
    whole = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("to"), digest(F.col("t")).alias("digest"))
    units = (rows.select("_row", F.explode(F.concat(F.array(whole), runs(F.col("words"), known))).alias("u"))
             .select("_row", "u.at", "u.to", "u.digest"))
    found = units.join(known_digests(known), "digest").distinct().groupBy("_row").agg(
        F.collect_set(F.when(F.col("at") < 0, F.col("license_id"))).alias("whole"),
        F.collect_set(F.when(F.col("at") >= 0, F.col("license_id"))).alias("notices"),
        F.collect_set(F.when(F.col("at") >= 0, F.struct("at", (-F.col("to")).alias("back")))).alias("places"))
    # In order of starts, longest first: a run that ends no later than one before it is inside that one.
    outer = F.aggregate(F.array_sort("places"), F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")), lambda seen, place: F.struct(
        F.greatest(seen["to"], -place["back"]).alias("to"), (seen["n"] + (-place["back"] > seen["to"]).cast("int")).alias("n")), lambda seen: seen["n"])
    found = found.withColumn("n", outer)
    listed = docs.select(F.col(id_col).alias("doc_id"), name.alias("_row")).join(found, "_row", "left")
    none = F.array().cast("array<string>")
    return listed.select("doc_id", F.array_sort(F.coalesce("whole", none)).alias("whole"),
                         F.array_sort(F.coalesce("notices", none)).alias("notices"),
                         F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"))
