"""License scan in DataFrame expressions only: TF-IDF cosine to templates, and inheritance along directories.

Lines that speak of licensing are the notices of a file. Notices and templates
become sparse vectors (term, weight) with TF-IDF weights; document frequencies
are counted over all distinct notices and templates. The dot products come from
a join on the terms of the templates, so only pairs with a common term arise.
A file's header licence is the best template of its notices, if near enough. A
file whose words are mostly notice, or that is named like one, is a licence file
and speaks for its directory. Files without a header inherit from the licence
file of the nearest directory above them: directories are joined to all their
ancestors by path, and the deepest match wins.

Defined results: null, empty and blank texts have no notices and inherit; a null
path has no directory; equal notices are scored once; of equally near templates
the first by name wins, of several licence files in a directory the best scored,
then the first by name of the licence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.operators.lookup import lookup

# Words that make a line a notice, and names of licence files.
NOTICE = r"(?i)(licen[sc]e|copyright|all rights reserved|warrant(y|ies)|redistribut|permission is hereby|public domain|spdx)"
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|copyright|notice|unlicense)([._-][a-z0-9._-]*)?$"

# Notices as licences word them, long and short ones; several templates may stand for one licence.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for license information."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software. The software is provided as is, without warranty of any kind.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, "
        "without warranties or conditions of any kind, either express or implied.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or any later version. This program is distributed in the hope that it will "
        "be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that redistributions retain the "
        "copyright notice, this list of conditions and the following disclaimer.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License. Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and dedicated this work to the public domain. CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. Confidential and proprietary. Unauthorized copying of this file is prohibited."),
)


@dataclass(frozen=True)
class Matching:
    """Least cosine of a header licence; share of words in notices that makes a file a licence file."""

    cosine: float = 0.6
    share: float = 0.5


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template int, licence string, text string")


def _terms(text: Column) -> Column:
    """Lower-case words and version numbers."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+(?:[.][0-9]+)*"), F.lit(0))


def _weights(texts: DataFrame, key: str) -> DataFrame:
    """(key, term, times) of a table (key, text)."""
    return texts.select(key, F.explode(_terms(F.col("text"))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("times"))


def scored(notices: DataFrame, known: DataFrame) -> DataFrame:
    """(text, licence, cosine): the template that comes nearest to a notice or to one of its lines, for each distinct notice."""
    texts = notices.select(F.col("text").alias("notice")).distinct()
    parts = texts.select("notice", F.explode(F.array_distinct(F.concat(F.array("notice"), F.split("notice", "\n")))).alias("text"))
    parts = parts.withColumn("key", F.sha2("text", 256))
    distinct = parts.select("key", "text").distinct()
    ours = _weights(distinct, "key")
    theirs = _weights(known.select("template", "text"), "template")
    seen = ours.groupBy("term").agg(F.count(F.lit(1)).alias("n")).unionByName(theirs.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    total = float(distinct.count() + known.count())
    rarity = seen.groupBy("term").agg(F.sum("n").alias("n")).select("term", (F.log((total + 1) / (F.col("n") + 1)) + 1).alias("idf"))

    def weighed(df: DataFrame, key: str) -> DataFrame:
        return df.join(rarity, "term").select(key, "term", ((F.log(F.col("times").cast("double")) + 1) * F.col("idf")).alias("w"))

    a, b = weighed(ours, "key"), weighed(theirs, "template").withColumnRenamed("w", "v")
    norms = a.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    other = b.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("other"))
    dots = a.join(b, "term").groupBy("key", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosines = dots.join(norms, "key").join(other, "template").join(known.select("template", "licence"), "template")
    away = (-F.round(F.col("dot") / (F.col("norm") * F.col("other")), 6)).alias("away")
    best = cosines.select("key", F.struct(away, "licence").alias("x")).groupBy("key").agg(F.min("x").alias("x"))
    best = parts.join(best, "key").groupBy("notice").agg(F.min("x").alias("x"))
    return best.select(F.col("notice").alias("text"), F.col("x.licence").alias("licence"), (-F.col("x.away")).alias("cosine"))


def scanned(files: DataFrame, known: DataFrame, id_column: str, path: Column, text_column: str = "text", how: Matching | None = None) -> DataFrame:
    """One row per file: its licence, where that comes from (header, inherited or none), the cosine of its header and whether
    it is a licence file."""
    how = how or Matching()
    text = F.coalesce(F.col(text_column), F.lit(""))
    named = F.coalesce(path.rlike(LICENCE_FILE), F.lit(False))
    noticed = text.rlike(NOTICE)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOTICE))
    notice = F.when(named & text.rlike(r"\S"), text).when(noticed, F.array_join(F.transform(lines, lambda line: F.trim(line)), "\n"))
    words = lambda c: F.size(F.regexp_extract_all(c, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    base = files.select(F.col(id_column).alias("id"), path.alias("path"), notice.alias("notice"), F.when(noticed, words(text)).alias("n_words"), named.alias("named"))
    base = base.withColumn("dir", F.regexp_extract(F.col("path"), "^(.*/)[^/]*$", 1))
    best = scored(base.where("notice is not null").select(F.col("notice").alias("text")), known)
    # many files share one notice, and most have none: the lookup spreads both over tasks
    matched = lookup(base, best, {"notice": "text"}, "id")
    near = F.coalesce(F.col("cosine") >= how.cosine, F.lit(False))
    file_like = F.col("named") | (words(F.col("notice")) >= how.share * F.col("n_words"))
    matched = matched.select(
        "id", "path", "dir", F.when(near, F.col("licence")).alias("own"), F.when(near, F.col("cosine")).alias("cosine"),
        (near & F.coalesce(file_like, F.lit(False))).alias("is_licence_file"),
    )
    speaks = (
        matched.where("is_licence_file and path is not null")
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("cosine")).alias("away"), F.col("own").alias("licence"))).alias("x"))
        .select(F.col("dir").alias("above"), F.col("x.licence").alias("licence"))
    )
    dirs = matched.where("path is not null").select("dir").distinct()
    above = F.expr("explode(transform(sequence(0, size(split(dir, '/')) - 1), i -> concat_ws('', transform(slice(split(dir, '/'), 1, i), p -> concat(p, '/')))))")
    nearest = (
        dirs.select("dir", above.alias("above"))
        .join(speaks, "above")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "licence")).alias("x"))
        .select("dir", F.col("x.licence").alias("inherited"), F.col("x.above").alias("inherited_from"))
    )
    out = lookup(matched, nearest, {"dir": "dir"}, "id")
    by = F.when(F.col("own").isNotNull(), "header").when(F.col("inherited").isNotNull() & F.col("path").isNotNull(), "inherited").otherwise("none")
    return out.select(
        F.col("id").alias(id_column), "path", F.when(by == "header", F.col("own")).when(by == "inherited", F.col("inherited")).alias("licence"),
        by.alias("licence_from"), F.when(by == "inherited", F.col("inherited_from")).alias("inherited_from"), "cosine", "is_licence_file",
    )
