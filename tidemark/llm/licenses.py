"""License scans by diagonal voting, in DataFrame operations only.

Every rolling hash of ``K`` words of every document is joined to the places where
it stands in the templates.  Hits of one template in a document vote for the
diagonal (document place less template place); neighbouring diagonals, which a
few inserted or left-out words make, are merged; a merged span counts when the
template words it covers are enough of the template and it is not stretched over
much more of the document than of the template.

The base is plainer: places where the words of a phrase stand consecutively.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters.
Odd input: a null or empty text has no words, places or labels; first_word and
last_word are null without places; repeated rows give equal result rows; texts
of fewer than ``K`` words can only have base places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import row_key
from tidemark.sources.tables import read_table

K = 3
MIN_COVER = 60  # percent of a template's words
MAX_STRETCH = 150  # percent of the template stretch that a span may take
SLACK = 3  # diagonals; a quarter of the words in short templates

# Well-known license notices, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """The words of a text column as an array."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, BREAK), "")


def grams(words):
    """Rolling hashes of K words, in order."""
    at = lambda i, j: F.get(words, i + j)
    last = F.size(words) - K
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[at(i, j) for j in range(K)]))
    ).otherwise(F.array().cast("array<bigint>"))


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """gram, template, label, place, size of the template: a fixed small table."""
    values = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(templates))
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, text)")
    rows = rows.select("template", "label", words_of(F.col("text")).alias("w"))
    return rows.select("template", "label", F.size("w").alias("size"), F.posexplode(grams(F.col("w"))).alias("place", "gram"))


def spans(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """key, template, label, start, stop (words), cover (share of the template's
    words) of every verified span in ``docs`` (key, w: its words)."""
    table = F.broadcast(template_grams(docs.sparkSession, templates))
    hits = docs.select("key", F.posexplode(grams(F.col("w"))).alias("pos", "gram")).join(table, "gram")
    votes = hits.groupBy("key", "template", "label", "size", (F.col("pos") - F.col("place")).alias("shift")).agg(
        F.min("pos").alias("low"), F.max("pos").alias("high"), F.collect_set("place").alias("places")
    )
    along = Window.partitionBy("key", "template").orderBy("shift")
    slack = F.least(F.lit(SLACK), F.floor(F.col("size") / 4))
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(along) > slack, F.lit(True))
    merged = votes.withColumn("group", F.sum(apart.cast("int")).over(along))
    merged = merged.groupBy("key", "template", "label", "size", "group").agg(
        F.min("low").alias("start"),
        (F.max("high") + K).alias("stop"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
    )
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (K - 1)))))
    merged = merged.withColumn("covered", F.size(covered)).withColumn(
        "stretch", F.array_max("places") - F.array_min("places") + K
    )
    return merged.where(
        (F.col("covered") * 100 >= F.col("size") * MIN_COVER)
        & ((F.col("stop") - F.col("start")) * 100 <= F.col("stretch") * MAX_STRETCH)
    ).select("key", "template", "label", "start", "stop", (F.col("covered") / F.col("size")).alias("cover"))


def base_places(w):
    """(start, label) of every place of a base phrase, in order."""
    last = lambda i: F.get(w, i - 1)
    label = lambda i: (
        F.when(last(i).isin("mit", "apache"), last(i)).when(
            (last(i) == "public") & (F.get(w, i - 2) == "general"), F.lit("gpl")
        )
    )
    ends = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (F.get(w, i) == "license") & label(i).isNotNull())
    found = F.transform(
        ends, lambda i: F.struct((i - F.when(label(i) == "gpl", 2).otherwise(1)).alias("at"), label(i).alias("label"))
    )
    return F.when(F.array_contains(w, "license"), found).otherwise(F.expr("array()").cast("array<struct<at:int,label:string>>"))


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """The contract's columns for each row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id"), row_key().alias("key"), words_of(F.col("text")).alias("w"))
    base = rows.select(
        "doc_id", "key", F.size("w").cast("long").alias("n_words"), base_places(F.col("w")).alias("places")
    )
    found = spans(rows, templates).groupBy("key").agg(
        F.collect_set("label").alias("more"), F.max("cover").alias("score")
    )
    labels = F.array_distinct(F.col("places.label"))
    at = F.col("places.at")
    return base.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(labels, F.coalesce("more", F.expr("array()").cast("array<string>")))), ","
        ).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query(spark, sf_dir):
    """License places and labels of every document."""
    return scan(read_table(spark, sf_dir, "documents"))


_VALUES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
templates AS (SELECT template, label, {_WORDS} AS w FROM (VALUES {_VALUES}) AS t(template, label, text)),
doc_grams AS (
  SELECT doc_id, p, w[p + 1 : p + 3] AS gram FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS p FROM docs)),
template_grams AS (
  SELECT template, label, len(w) AS size, p AS place, w[p + 1 : p + 3] AS gram
  FROM (SELECT *, unnest(range(0, len(w) - 2)) AS p FROM templates)),
hits AS (
  SELECT DISTINCT doc_id, template, label, size, p, place, p - place AS shift
  FROM doc_grams JOIN template_grams USING (gram)),
shifts AS (SELECT DISTINCT doc_id, template, size, shift FROM hits),
grouped AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY shift) AS grp
  FROM (SELECT *, CASE WHEN shift - lag(shift) OVER (PARTITION BY doc_id, template ORDER BY shift)
                            <= least(3, size // 4) THEN 0 ELSE 1 END AS new FROM shifts)),
merged AS (
  SELECT doc_id, template, label, h.size, grp, max(p) + 3 - min(p) AS long, max(place) - min(place) + 3 AS stretch,
         count(DISTINCT place + j) AS covered
  FROM hits h JOIN grouped g USING (doc_id, template, shift), (VALUES (0), (1), (2)) AS o(j)
  GROUP BY doc_id, template, label, h.size, grp),
found AS (
  SELECT doc_id, label, covered / size AS cover FROM merged
  WHERE 100 * covered >= 60 * size AND 100 * long <= 150 * stretch),
base AS (
  SELECT doc_id, i, CASE WHEN w[i + 1] IN ('mit', 'apache') THEN w[i + 1] ELSE 'gpl' END AS label
  FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM docs)
  WHERE (w[i + 1] IN ('mit', 'apache') AND w[i + 2] = 'license')
     OR (w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license')),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM found) GROUP BY doc_id),
s AS (SELECT doc_id, max(cover) AS score FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""
