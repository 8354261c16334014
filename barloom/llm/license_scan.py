"""License scan: MinHash bands over text windows retrieve templates, shingles verify them.

Words are runs of letters and digits, lower-cased; shingles are five words.
Templates fall into classes by length: c is the least power of two not below the
number of shingles, 8 at least. For each class a text has windows of 2c shingles
every c, so each run of c shingles lies whole within one. A window that holds a
share s of a template of n > c/2 shingles has a Jaccard similarity of at least
s n / (2c + (1 - s) n), over 0.19 for s = 0.8; the shortest templates, down to a
single shingle in windows of 16, have 1/16. With BANDS bands of one MinHash each
a window misses with a probability below (15/16)^BANDS, 7e-8 for 256 bands, and
below 1e-20 for n > c/2.

A band agrees if the template's least shingle of the band is in the window and
none in the window hashes lower. So a text in which no such shingle occurs has no
candidate, and is passed over before any window is built.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5
BANDS = 256
SHARE = 0.8
LEAST = 8

#: Names of licenses and wording of their notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def templates(spark: SparkSession) -> DataFrame:
    """(license, text) of the notices known."""
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def _let(value: Column, use) -> Column:
    """use(value) with the value worked out once, also where lambdas read it for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingles(text: Column) -> Column:
    """Hashes of each five words in a row; none if there are fewer."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        count = F.size(w) - WORDS
        places = F.sequence(F.lit(0), F.greatest(count, F.lit(0)))
        each = F.transform(places, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WORDS))))
        return F.when(count >= 0, each).otherwise(F.array().cast("array<bigint>"))

    return _let(words, hashed)


def _band(shingle: Column, band: Column) -> Column:
    return F.xxhash64(shingle, band)


def _index(known: DataFrame) -> list:
    """Of each template: its shingles, class, and the least shingle and hash of each band."""
    own = F.array_distinct("shingles")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.array_min(F.transform("own", lambda x: F.struct(_band(x, b).alias("least"), x.alias("shingle")))),
    )
    return (
        known.select("license", _shingles(F.col("text")).alias("shingles"))
        .select("license", own.alias("own"))
        .where(F.size("own") > 0)
        .select("license", "own", bands.alias("bands"))
        .collect()
    )


def _step(shingles: int) -> int:
    """The class of a template by its number of different shingles."""
    return max(LEAST, 1 << (shingles - 1).bit_length())


def _literal(index: list) -> Column:
    """The index as one constant of the plan."""
    told = [
        {
            "license": row["license"],
            "step": _step(len(row["own"])),
            "own": row["own"],
            "lead": sorted({b["shingle"] for b in row["bands"]}),
            "bands": [{"band": i, "least": b["least"], "shingle": b["shingle"]} for i, b in enumerate(row["bands"])],
        }
        for row in index
    ]
    band = "struct<band:int,least:bigint,shingle:bigint>"
    kind = f"array<struct<license:string,step:int,own:array<bigint>,lead:array<bigint>,bands:array<{band}>>>"
    return F.from_json(F.lit(json.dumps(told)), kind)


def licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, license, containment, windows, first_word), for each row of docs and each license in it.

    known has (license, text); it is read on the driver and must be small, as it
    becomes part of the expressions. A license is in a text if a window holds at
    least 80 % of the different shingles of one of its templates. containment is
    the largest share, windows counts the window and template pairs that reach it,
    and first_word is the word at which the first such window begins. Templates
    with fewer than five words are passed over. Null, empty and short texts give
    no row; a row that repeats gives its rows again; a null doc_id stays null.
    """
    index = _index(known)
    least = sorted({b["shingle"] for row in index for b in row["bands"]})
    none = F.array().cast("array<struct<license:string,containment:double,first_word:int>>")

    def search(shingles: Column) -> Column:
        found = F.flatten(F.transform(_literal(index), lambda known: _matches(known, shingles)))
        return F.when(F.exists(shingles, lambda x: x.isin(least)), found).otherwise(none)

    # One pass over the texts: explode_outer, as no filter may be moved below it and read them again.
    return (
        docs.select("doc_id", _let(_shingles(F.col("text")), search).alias("all"))
        .select("doc_id", "all", F.explode_outer(F.array_distinct(F.col("all.license"))).alias("license"))
        .where(F.col("license").isNotNull())
        .withColumn("own", F.filter("all", lambda m: m["license"] == F.col("license")))
        .select(
            "doc_id",
            "license",
            F.array_max(F.col("own.containment")).alias("containment"),
            F.size("own").cast("long").alias("windows"),
            F.array_min(F.col("own.first_word")).cast("long").alias("first_word"),
        )
    )


def _matches(known: Column, shingles: Column) -> Column:
    """The windows of a text that hold a template, as an array."""
    step = known["step"]
    places = F.filter(
        F.sequence(F.lit(0), F.size(shingles) - 1), lambda i: F.array_contains(known["lead"], F.get(shingles, i))
    )
    number = lambda i: F.floor(i / step).cast("int")
    windows = F.array_distinct(
        F.flatten(F.transform(places, lambda i: F.array(number(i), F.greatest(number(i) - 1, F.lit(0)))))
    )
    cut = F.transform(
        windows, lambda w: F.struct((w * step).alias("at"), F.slice(shingles, w * step + 1, 2 * step).alias("x"))
    )
    agrees = lambda w: F.exists(
        known["bands"],
        lambda b: F.array_contains(w["x"], b["shingle"]) & F.forall(w["x"], lambda x: _band(x, b["band"]) >= b["least"]),
    )
    shared = lambda w: F.size(F.array_intersect(known["own"], w["x"])) / F.size(known["own"])
    held = F.transform(
        F.filter(cut, agrees),
        lambda w: F.struct(known["license"].alias("license"), shared(w).alias("containment"), w["at"].alias("first_word")),
    )
    return F.filter(held, lambda m: m["containment"] >= SHARE)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: All windows of all texts against all templates, without MinHash.
SQL = rf"""
WITH known AS (
  SELECT t, license, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS words
  FROM (VALUES {", ".join(f"({i}, {_quoted(n)}, {_quoted(x)})" for i, (n, x) in enumerate(TEMPLATES))}) AS v(t, license, text)
), own AS (
  SELECT DISTINCT t, license, array_to_string(words[i : i + {WORDS - 1}], ' ') AS shingle
  FROM (SELECT t, license, words, unnest(range(1, len(words) - {WORDS - 2})) AS i FROM known)
), sized AS (
  SELECT t, license, count(*) AS n, greatest({LEAST}, CAST(2 ** ceil(log2(count(*))) AS BIGINT)) AS step FROM own GROUP BY ALL
), texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT r, doc_id, i - 1 AS place, array_to_string(words[i : i + {WORDS - 1}], ' ') AS shingle
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - {WORDS - 2})) AS i FROM texts)
), hits AS (
  SELECT r, doc_id, o.t, s.license, n, step, shingle, place // step AS w FROM shingles JOIN own o USING (shingle) JOIN sized s USING (t)
), windows AS (
  SELECT * FROM hits UNION ALL SELECT * REPLACE (w - 1 AS w) FROM hits WHERE w > 0
), held AS (
  SELECT r, doc_id, license, t, w * step AS first_word, count(DISTINCT shingle) / n AS containment
  FROM windows GROUP BY r, doc_id, license, t, n, step, w HAVING count(DISTINCT shingle) / n >= {SHARE}
)
SELECT doc_id, license, max(containment) AS containment, count(*) AS windows, CAST(min(first_word) AS BIGINT) AS first_word
FROM held GROUP BY r, doc_id, license
"""
