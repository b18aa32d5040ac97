"""Licence scan by sparse TF-IDF cosine and directory inheritance, in DataFrame functions only.

Sentences and lines of every whole text that speak of licences are its headers. Each header, and all headers of a text
together, become sparse vectors: a term weighs its count in the header times its inverse document frequency over the whole
corpus' headers (and the templates). They are compared with licence templates by cosine; the best of at least ``LEAST`` is the
text's own licence.

A header's dot products need the weights of the templates' terms only: these few are in the expression. Its length needs the
weights of all its terms: the terms of no template are counted over the corpus (combined before the shuffle) and their counts
joined back by term. The ``COMMON`` most frequent ones are broadcast, so the largest key of the shuffled join holds less than one
in ``COMMON`` of all occurrences, whatever the corpus repeats.

A text that is mostly headers (``FILE_SHARE`` of its characters), or whose file name says so, is a licence file: it licenses its
directory. Texts without a licence of their own inherit from the nearest ancestor directory that has one: the distinct
directories are expanded to their ancestors and joined by path, then texts join their directory.

``documents`` has no paths; ``document_path`` lays the ids out by leading digits below their source: 5417 of src3 is
src3/5/54/541/5417.txt.

Defined results: a null or empty text has no licence of its own and may inherit; a null path is no place: nothing is
inherited; of several licence files in a directory the most similar counts, of equals the last by name; repeated rows repeat
their result (each counts in the frequencies); a very long text is read whole; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.common import stored, table

LEAST = 0.55
FILE_SHARE = 0.5
#: Terms whose corpus counts are broadcast, the most frequent ones.
COMMON = 1000
#: A longer term is known by its digest, so that a count's row has a bounded size.
LONGEST = 40

#: Fixed texts: short forms and openings of public licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "GPL-2.0": ["This program is licensed under the GNU General Public License, version 2"],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright by the CC0 1.0 Universal Public Domain Dedication."],
    "Proprietary": ["Copyright. All rights reserved. No part may be reproduced without written permission."],
}
TRIGGER = r"(?i)licen[sc]e|copyright|all rights reserved|permission is hereby|redistribut|public domain|free software"
#: Headers end at line breaks and after marks followed by space.
CUT = r"\n|(?<=[.!?;])\s+"
TERM = r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*"
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicense)[^/]*$"


def terms_of(text: str) -> Counter:
    """Lower-cased terms with their counts (the same rule as ``_vector``)."""
    return Counter(x.lower() for x in re.findall(TERM, text))


def _vector(c: Column) -> Column:
    """Array of (term, count) of a text: the terms sorted, equal ones side by side."""
    term = F.transform(F.regexp_extract_all(c, F.lit(TERM), F.lit(0)), F.lower)
    term = F.sort_array(F.transform(term, lambda t: F.when(F.length(t) > LONGEST, F.sha2(t, 256)).otherwise(t)))

    def counted(terms: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(terms) - 1)
        first = F.filter(at, lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1)))
        inside = lambda starts: F.transform(starts, lambda p, k: F.struct(F.get(terms, p).alias("term"), (F.coalesce(F.get(starts, k + 1), F.size(terms)) - p).alias("tf")))
        return F.when(F.size(terms) > 0, F.flatten(F.transform(F.array(first), inside))).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))

    return F.flatten(F.transform(F.array(term), counted))


def document_path(id_col: str = "doc_id", source_col: str = "source") -> Column:
    digits = F.col(id_col).cast("string")
    above = F.when(F.length(digits) > 1, F.transform(F.sequence(F.lit(1), F.length(digits) - 1), lambda n: F.substring(digits, F.lit(1), n))).otherwise(F.array().cast("array<string>"))
    return F.when(F.col(source_col).isNotNull() & digits.isNotNull(), F.concat_ws("/", F.col(source_col), above, F.concat(digits, F.lit(".txt"))))


VOCABULARY = sorted({t for texts in TEMPLATES.values() for x in texts for t in terms_of(x)})


def idf_of(n: Column | float, held: Column | float, ln) -> Column | float:
    """Smoothed inverse document frequency: n headers and templates, held of them hold the term."""
    return ln((1 + n) / (1 + held)) + 1


def weights(heads: DataFrame, held: DataFrame) -> tuple[int, dict[str, float]]:
    """Number of headers and templates, and the IDF of the templates' terms."""
    texts = [terms_of(t) for ts in TEMPLATES.values() for t in ts]
    n = heads.count() + len(texts)
    known = {r["term"]: r["held"] for r in held.filter(F.col("term").isin(VOCABULARY)).collect()}
    return n, {t: idf_of(n, known.get(t, 0) + sum(t in x for x in texts), log) for t in VOCABULARY}


def squared_rest(heads: DataFrame, held: DataFrame, n: int) -> DataFrame:
    """Per header (row, head): the squared length of its part outside the templates' terms."""
    other = ~F.col("term").isin(VOCABULARY)
    terms = heads.select("row", "head", F.explode("terms").alias("t")).select("row", "head", "t.term", "t.tf").filter(other)
    counts = stored(held.filter(other), "counts")
    often = stored(counts.orderBy(F.desc("held"), "term").limit(COMMON), "common")
    seldom = counts.join(F.broadcast(often.select("term")), "term", "left_anti")
    first = terms.join(F.broadcast(often.withColumnRenamed("held", "often")), "term", "left")
    known = first.filter("often is not null").select("row", "head", "tf", F.col("often").alias("held"))
    known = known.unionByName(first.filter("often is null").join(seldom, "term").select("row", "head", "tf", "held"))
    weight = F.col("tf") * idf_of(F.lit(n), F.col("held"), F.log)
    return known.groupBy("row", "head").agg(F.sum(weight * weight).alias("rest"))


def _numbers(values: dict[str, float]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[F.lit(float(v)) for v in values.values()]))


def _sum(terms: Column, values: Column, power: int) -> Column:
    """Sum of count^power * value over the terms that have a value."""
    return F.aggregate(terms, F.lit(0.0), lambda total, t: total + F.coalesce(F.pow(t["tf"].cast("double"), F.lit(power)) * F.try_element_at(values, t["term"]), F.lit(0.0)))


def best_licence(terms: Column, rest: Column, idf: dict[str, float]) -> Column:
    """Struct (similarity, licence) of the template that is nearest to a header, ties by the last name."""
    known = F.filter(terms, lambda t: t["term"].isin(VOCABULARY))

    def against(own_terms: Column) -> Column:
        length = F.sqrt(_sum(own_terms, _numbers({t: w * w for t, w in idf.items()}), 2) + rest)
        pairs = []
        for name, texts in TEMPLATES.items():
            for text in texts:
                counts = terms_of(text)
                own = {t: c * idf[t] ** 2 for t, c in counts.items()}
                norm = sum((c * idf[t]) ** 2 for t, c in counts.items()) ** 0.5
                near = _sum(own_terms, _numbers(own), 1) / (length * F.lit(norm))
                pairs.append(F.struct(F.round(near, 6).alias("similarity"), F.lit(name).alias("licence")))
        return F.array_max(F.array(*pairs))

    return F.get(F.transform(F.array(known), against), 0)


def licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None) -> DataFrame:
    """id_col, path, licence, similarity, origin (own, inherited, none), from_directory, is_licence_file: one row per row."""
    path = document_path(id_col) if path is None else path
    rows = df.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).alias("text"))
    heads = F.when(F.col("text").rlike(TRIGGER), F.filter(F.split("text", CUT, -1), lambda s: s.rlike(TRIGGER))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("lines", F.coalesce(heads, F.array().cast("array<string>")))
    share = F.aggregate("lines", F.lit(0), lambda n, s: n + F.length(F.trim(s))) / F.greatest(F.length(F.trim("text")), F.lit(1))
    together = F.when(F.size("lines") > 1, F.array(F.array_join("lines", "\n"))).otherwise(F.array().cast("array<string>"))
    units = F.transform(F.concat("lines", together), _vector)
    # the number is fixed once written, and tells rows of one id apart
    noted = rows.select(F.monotonically_increasing_id().alias("row"), "id", "path", units.alias("heads"), (F.coalesce(share, F.lit(0.0)) >= FILE_SHARE).alias("mostly"))
    noted = stored(noted, "headers")

    heads = noted.select("row", F.posexplode("heads").alias("head", "terms"))
    held = heads.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count("*").alias("held"))
    n, idf = weights(heads, held)
    scored = heads.join(squared_rest(heads, held, n), ["row", "head"], "left").filter(F.size("terms") > 0)
    best = scored.select("row", best_licence(F.col("terms"), F.coalesce("rest", F.lit(0.0)), idf).alias("best")).groupBy("row").agg(F.max("best").alias("best"))
    own = noted.drop("heads").join(best, "row", "left")
    named = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    own = own.select(
        "id", "path", F.regexp_replace("path", "/?[^/]*$", "").alias("directory"), F.when(F.col("best.similarity") >= LEAST, F.col("best")).alias("best"), (F.col("mostly") | named).alias("file")
    )
    own = stored(own, "own")

    # one licence a directory; every distinct directory looks at its ancestors, the nearest wins
    files = own.filter(F.col("best").isNotNull() & F.col("file") & F.col("directory").isNotNull())
    grants = files.groupBy("directory").agg(F.max("best").alias("best"))
    grants = grants.select("directory", F.col("best.licence").alias("granted"), F.col("best.similarity").alias("granted_similarity"))
    places = own.filter(F.col("best").isNull() & F.col("directory").isNotNull()).select("directory").distinct()
    levels = F.split("directory", "/")
    up = places.select(F.col("directory").alias("place"), F.explode(F.transform(F.sequence(F.lit(1), F.size(levels)), lambda n: F.concat_ws("/", F.slice(levels, F.lit(1), n)))).alias("directory"))
    nearest = up.join(grants, "directory").groupBy("place").agg(F.max(F.struct(F.length("directory").alias("depth"), "directory", "granted", "granted_similarity")).alias("from"))
    got = own.join(nearest, own["directory"] == nearest["place"], "left")
    mine = F.col("best").isNotNull()
    return got.select(
        F.col("id").alias(id_col), "path", F.when(mine, F.col("best.licence")).otherwise(F.col("from.granted")).alias("licence"),
        F.when(mine, F.col("best.similarity")).otherwise(F.col("from.granted_similarity")).alias("similarity"),
        F.when(mine, "own").when(F.col("from").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("from.directory")).alias("from_directory"), (mine & F.col("file")).alias("is_licence_file"),
    )


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or its directory's."""
    return licences(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same from its definition: every header against every template, every directory against every grant."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    texts = enumerate((n, terms_of(t)) for n, ts in TEMPLATES.items() for t in ts)
    rows = ",\n    ".join(f"({i}, {quote(name)}, [{', '.join(quote(t) for t in counts.elements())}])" for i, (name, counts) in texts)
    return rf"""
WITH template AS (SELECT * FROM (VALUES
    {rows}) v(tid, licence, terms)),
doc AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN source IS NOT NULL AND doc_id IS NOT NULL THEN array_to_string(list_concat([source],
    list_transform(range(1, length(CAST(doc_id AS VARCHAR))), lambda n: CAST(doc_id AS VARCHAR)[1:n]), [CAST(doc_id AS VARCHAR) || '.txt']), '/') END AS path FROM documents),
cut AS (SELECT *, list_filter(string_split(regexp_replace(text, '([.!?;])\s+', '\1' || chr(10), 'g'), chr(10)), lambda s: regexp_matches(s, '{TRIGGER}')) AS lines FROM doc),
unit AS (SELECT doc_id, row_number() OVER () AS uid, head FROM (
    SELECT doc_id, unnest(CASE WHEN len(lines) > 1 THEN list_append(lines, array_to_string(lines, chr(10))) ELSE lines END) AS head FROM cut)),
word AS (SELECT doc_id, uid, lower(unnest(regexp_extract_all(head, '{TERM}'))) AS term FROM unit),
unit_term AS (SELECT doc_id, uid, term, count(*) AS tf FROM word GROUP BY doc_id, uid, term),
template_term AS (SELECT tid, licence, term, count(*) AS tf FROM (SELECT tid, licence, unnest(terms) AS term FROM template) GROUP BY tid, licence, term),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM unit) + (SELECT count(*) FROM template)) / (1 + count(*))) + 1 AS w
  FROM (SELECT term FROM template_term UNION ALL SELECT term FROM unit_term) GROUP BY term),
unit_norm AS (SELECT uid, sqrt(sum(tf * tf * w * w)) AS norm FROM unit_term JOIN idf USING (term) GROUP BY uid),
template_norm AS (SELECT tid, sqrt(sum(tf * tf * w * w)) AS norm FROM template_term JOIN idf USING (term) GROUP BY tid),
near AS (SELECT u.doc_id, t.licence, round(sum(u.tf * t.tf * w * w) / any_value(n.norm * m.norm), 6) AS similarity
  FROM unit_term u JOIN template_term t USING (term) JOIN idf USING (term) JOIN unit_norm n USING (uid) JOIN template_norm m USING (tid) GROUP BY u.doc_id, u.uid, t.tid, t.licence),
best AS (SELECT doc_id, max({{'similarity': similarity, 'licence': licence}}) AS b FROM near GROUP BY doc_id),
own AS (SELECT c.doc_id, c.path, regexp_replace(c.path, '/?[^/]*$', '') AS directory, CASE WHEN b.similarity >= {LEAST} THEN b END AS b,
    list_sum(list_concat([0], list_transform(lines, lambda s: length(trim(s, ' '))))) / greatest(length(trim(text, ' ')), 1) >= {FILE_SHARE} OR coalesce(regexp_matches(c.path, '{FILE_NAME}'), false) AS file
  FROM cut c LEFT JOIN best USING (doc_id)),
grants AS (SELECT directory AS grant_dir, max(b) AS g FROM own WHERE b IS NOT NULL AND file AND directory IS NOT NULL GROUP BY directory),
place AS (SELECT DISTINCT directory FROM own WHERE b IS NULL AND directory IS NOT NULL),
nearest AS (SELECT directory, arg_max(grant_dir, length(grant_dir)) AS grant_dir, arg_max(g, length(grant_dir)) AS g
  FROM place JOIN grants ON directory = grant_dir OR starts_with(directory, grant_dir || '/') GROUP BY directory)
SELECT doc_id, path, coalesce(b.licence, g.licence) AS licence, coalesce(b.similarity, g.similarity) AS similarity,
  CASE WHEN b IS NOT NULL THEN 'own' WHEN g IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN b IS NULL THEN grant_dir END AS from_directory, b IS NOT NULL AND file AS is_licence_file
FROM own LEFT JOIN nearest USING (directory)
"""


QUERIES = {"op10_licences": op10_licences}
ORACLE = {"op10_licences": _oracle()}
