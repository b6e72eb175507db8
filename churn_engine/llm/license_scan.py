"""Licence scan: sparse TF-IDF cosine of texts to licence notices and full licence texts, then inheritance from the nearest directory.

Built-in functions only. Compared are whole texts, leading comments, single lines, and spans as long as a notice. A file's own licence is
that of its most similar piece; a file that is a licence text, consists mostly of notices, or is named as a licence file and has a licence,
is a licence file and covers its directory; a file without a licence of its own takes that of the nearest directory above it that a licence
file covers.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churn_engine.llm.common import store

#: Usual notices of licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]
#: GNU headers, which differ by the name and the number of the licence.
for _id, _number, _name in [
    ("AGPL-3.0", "3", "GNU Affero General Public License"),
    ("GPL-2.0", "2", "GNU General Public License"),
    ("GPL-3.0", "3", "GNU General Public License"),
    ("LGPL-2.1", "2.1", "GNU Lesser General Public License"),
    ("LGPL-3.0", "3", "GNU Lesser General Public License"),
]:
    TEMPLATES.append((_id, f"{_name} Version {_number}"))
    TEMPLATES.append(
        (
            _id,
            f"This program is free software: you can redistribute it and/or modify it under the terms of the {_name} as published by the Free "
            f"Software Foundation, either version {_number} of the License, or (at your option) any later version.",
        )
    )
TEMPLATES += [
    (_id, f"SPDX-License-Identifier: {_id}")
    for _id in "AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC0-1.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MIT MPL-2.0".split()
]
COSINE = 0.6
#: A licence file has at least this share of its characters in licence lines or in one header or span.
FILE_SHARE = 0.5
#: Names of licence files.
FILE_NAME = r"(?i)(?:^|/)(?:un)?(?:licen[cs]e|copying)(?:[-._][^/]*)?$"
#: First characters of a comment line.
COMMENT = r"^\s*(?://|#|/\*|\*|--|;|%|$)"
#: Fewer documents than this share have a word that is worth looking for.
COMMON = 0.05
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("([a-z0-9]+)"))


def _words(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def _template_tokens(text: str) -> Counter:
    return Counter(re.findall("[a-z0-9]+", text.lower()))


def vocabulary_weights(texts: DataFrame, words: list[str], text_col: str = "text") -> dict[str, float]:
    """1 + ln((1 + files) / (1 + files with the word)) for the words of the notices, over all files. As many rows as
    there are such words reach the driver."""
    found = F.array_intersect(tokens(F.col(text_col)), _words(words))
    counted = texts.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    df = {r["word"]: r["count"] for r in counted}
    n = df.get("", 0)  # once for each file
    return {w: 1 + math.log((1 + n) / (1 + df.get(w, 0))) for w in words}


def full_texts() -> list[tuple[str, str]]:
    """Full licence texts, by the names of their files."""
    return [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]


def key_words(templates: list[tuple[str, str]], idf: dict[str, float], cosine: float, common: float = 0.0) -> list[str]:
    """Words of which a piece must hold at least one to come near any template. The others of a template, those with an idf below
    ``common`` first and then its lightest, have together less than ``cosine`` of its length, so a piece with none but those stays below."""
    keys = set()
    for _, text in templates:
        weights = sorted((idf[w] >= common, n * idf[w], w) for w, n in _template_tokens(text).items())
        left = cosine**2 * sum(x * x for _, x, _ in weights) * (1 - 1e-9)
        for _, x, word in weights:
            if x * x < left:
                left -= x * x
            else:
                keys.add(word)
    return sorted(keys)


def _needed(license_id: str, text: str) -> list[str]:
    """Words of a licence's id that its template holds: licences whose notices differ by a name or number only are told apart by them."""
    return sorted(set(_template_tokens(license_id)) & set(_template_tokens(text)))


def _header(text: Column) -> Column:
    """The comment that a text begins with: a block comment, or its first lines that are comments or empty."""
    lines = F.split(text, "\n")
    first_other = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT)), F.lit(False)).cast("int")
    start = F.ltrim(text)
    return (
        F.when(start.startswith("/*"), F.substring_index(start, "*/", 1))
        .when(start.startswith("<!--"), F.substring_index(start, "-->", 1))
        .when(start.startswith('"""'), F.substring_index(F.substr(start, F.lit(4)), '"""', 1))
        .when(first_other > 0, F.array_join(F.slice(lines, F.lit(1), first_other - 1), "\n"))
        .otherwise(text)
    )


def _near_spans(floor: float, rarest: float) -> Column:
    """The spans of ``words`` that may come near a notice: as long as it (``n_words``), with the words it ``needs``.

    Blocks as long as the notice are summed first. A span lies in two neighbouring blocks, so where what two of them share with the notice is
    below ``floor`` no span between them is looked at. What is left is bounded again with the span's own length: a word that no template
    has (not in ``found``) weighs ``rarest``.
    """
    n, size = F.col("n_words"), F.size("words")
    of = lambda w, what: F.coalesce(F.try_element_at("shares", w)[what], F.lit(0.0))
    total = lambda part, what: F.aggregate(part, F.lit(0.0), lambda x, w: x + of(w, what))
    gain = lambda at, many: total(F.slice("words", at, many), "share")
    blocks = F.transform(F.sequence(F.lit(0), F.floor(size / n).cast("int")), lambda k: F.struct(k.alias("k"), gain(k * n + 1, n).alias("sum")))
    pairs = F.zip_with(blocks, F.slice(blocks, 2, size + 1), lambda x, y: F.struct(x.k.alias("k"), (x.sum + F.coalesce(y.sum, F.lit(0.0))).alias("sum")))
    last = F.greatest(F.lit(1), size - n + 1)
    begins = F.filter(pairs, lambda p: (p.sum >= floor) & (p.k * n + 1 <= last))
    starts = F.flatten(F.transform(begins, lambda p: F.sequence(p.k * n + 1, F.least(p.k * n + n, last))))
    spans = F.transform(F.filter(starts, lambda at: gain(at, n) >= floor), lambda at: F.slice("words", at, n))

    def near(span: Column) -> Column:
        weight, unknown = total(span, "idf"), F.size(F.filter(span, lambda w: ~F.array_contains("found", w)))
        square = weight * weight
        return F.least(F.lit(1.0), total(span, "share")) * square >= floor * (square + unknown * rarest**2)

    spans = F.filter(spans, lambda x: (F.size(F.array_except("needs", x)) == 0) & near(x))
    return F.transform(spans, lambda x: F.array_join(x, " "))


def scan_licenses(
    files: DataFrame,
    id_col: str = "file_id",
    path_col: str = "path",
    text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    cosine: float = COSINE,
    full: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per input row: ``id_col, path, license, similarity, found_in, covered_by``.

    ``found_in`` is ``file`` for a licence file, ``line`` for another file with a notice (in a line, its header or a span of words),
    ``directory`` for an inherited licence, which the licence file of the directory ``covered_by`` brings; all are null without a licence. A
    text that is near a full licence text has that licence; otherwise the most similar piece counts, then the licence that sorts first; of
    several licence files of a directory likewise. A word that no template has weighs as much as the rarest word of the templates. A piece
    must hold the words of a licence's id that the template holds, so a notice of another version is not taken for this one, and a name
    without its version names no licence that has versions.

    A span is any run of as many words as a notice has. A text is cut into spans for a notice only if the words they share have ``cosine`` of the notice's
    length, and a span is compared only if its words have, also for the span's own length: all others are below ``cosine`` by Cauchy and
    Schwarz, so none is missed.

    Equal pieces are compared once, and directories rather than files are joined to their ancestors, so neither a notice that a third
    of all files share nor a directory with a third of all files is a single task.

    Defined cases: null and empty texts have no licence of their own but may inherit one; null paths inherit nothing; rows that repeat an id
    and path are one file with the pieces of all of them; an empty table gives an empty result; other columns are ignored.
    """
    full = full_texts() if full is None else full
    spark = files.sparkSession
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    texts = rows.where("text IS NOT NULL")
    everything = [*templates, *full]
    words = sorted({w for _, t in everything for w in _template_tokens(t)})
    idf = vocabulary_weights(texts, words)
    rarest = max(idf.values())
    keys = _words(key_words(everything, idf, cosine, common=1 - math.log(COMMON)))
    postings, names, spans = [], [], []
    for i, (name, text) in enumerate(everything):
        squares = {w: (n * idf[w]) ** 2 for w, n in _template_tokens(text).items()}
        length, needed = math.sqrt(sum(squares.values())), _needed(name, text)
        names.append((i, name, needed, i >= len(templates)))
        postings += [(w, i, math.sqrt(x) / length, int(w in needed)) for w, x in squares.items()]
        if i < len(templates):
            shares = {w: (x / length**2, idf[w]) for w, x in squares.items()}
            spans.append((i, len(re.findall("[a-z0-9]+", text.lower())), needed, shares))
    postings = F.broadcast(spark.createDataFrame(postings, "word string, template int, weight double, needed int"))
    names = F.broadcast(spark.createDataFrame(names, "template int, license string, needs array<string>, is_full boolean"))
    spans = F.broadcast(spark.createDataFrame(spans, "template int, n_words int, needs array<string>, shares map<string,struct<share:double,idf:double>>"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "word string, idf double"))
    floor = cosine**2 * (1 - 1e-9)

    # Texts, and the templates whose words in the text would reach the cosine. Where keys collide, a text is compared with more templates.
    held = texts.withColumn("found", F.array_intersect(tokens(F.col("text")), _words(words))).where(F.arrays_overlap("found", keys))
    held = store(held.withColumn("key", F.xxhash64("id", "path", "text")))
    shared = held.select("key", F.explode("found").alias("word")).join(postings, "word").groupBy("key", "template")
    shared = shared.agg(F.sum(F.col("weight") * F.col("weight")).alias("share"), F.sum("needed").alias("needed")).where(F.col("share") >= floor)
    shared = shared.join(names, "template").where("needed >= size(needs)").groupBy("key")
    shared = shared.agg(F.collect_list(F.struct("template", "needs", "is_full")).alias("near"), F.max("is_full").alias("is_full"))
    held = store(held.join(shared.hint("merge"), "key").drop("key"))

    # Their pieces.
    may_name = lambda x: F.arrays_overlap(tokens(x), keys) & F.exists("near", lambda t: F.size(F.array_except(t.needs, tokens(x))) == 0)
    pieces = F.concat(
        F.transform(F.filter(F.split("text", "\n"), may_name), lambda x: F.struct(F.lit("line").alias("kind"), x.alias("piece"))),
        F.array(F.struct(F.lit("header").alias("kind"), _header(F.col("text")).alias("piece"))),
        F.when(F.col("is_full"), F.array(F.struct(F.lit("whole").alias("kind"), F.col("text").alias("piece")))).otherwise(F.array()),
    )
    n_chars = F.length("text").alias("n_chars")
    pieces = held.select("id", "path", n_chars, F.lit(None).cast("int").alias("template"), F.inline(pieces))
    cut = held.select("id", "path", n_chars, tokens(F.col("text")).alias("words"), "found", F.explode(F.filter("near", lambda t: ~t.is_full)).alias("t"))
    cut = cut.withColumn("template", F.col("t.template")).drop("t").join(spans, "template")
    cut = cut.select("id", "path", "n_chars", "template", F.explode(_near_spans(floor, rarest)).alias("piece")).withColumn("kind", F.lit("span"))
    pieces = pieces.unionByName(cut).where("piece != ''")
    pieces = store(pieces.withColumn("digest", F.unhex(F.md5(F.concat_ws("/", "template", "piece")))))

    # Distinct pieces as sparse vectors, joined to the templates' words; a span only to its notice's. All that follows for a piece
    # happens where its digest lies.
    single = store(pieces.groupBy("digest").agg(F.first("template").alias("only"), F.first("piece").alias("piece")))
    spread = single.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "digest")
    terms = spread.select("digest", "only", F.explode(tokens(F.col("piece"))).alias("word")).groupBy("digest", "only", "word").agg(F.count(F.lit(1)).alias("tf"))
    terms = terms.join(known, "word", "left").withColumn("weight_piece", F.col("tf") * F.coalesce("idf", F.lit(rarest)))
    lengths = terms.groupBy("digest").agg(F.sqrt(F.sum(F.col("weight_piece") * F.col("weight_piece"))).alias("length"))
    products = terms.join(postings, "word").where("only IS NULL OR only = template").groupBy("digest", "template")
    products = products.agg(F.sum(F.col("weight_piece") * F.col("weight")).alias("product"), F.sum("needed").alias("needed"))
    near = products.join(names, "template").where("needed >= size(needs)")
    near = near.join(lengths, "digest").select("digest", "license", "is_full", F.round(F.col("product") / F.col("length"), 6).alias("similarity"))
    near = near.where(F.col("similarity") >= cosine)
    order = F.struct(-F.col("similarity"), F.col("license"))
    near = near.groupBy("digest", "is_full").agg(F.min_by(F.struct("license", "similarity"), order).alias("r"))
    near = store(near.select("digest", "is_full", "r.license", "r.similarity"))
    found = pieces.join(near, "digest").select("id", "path", "kind", "n_chars", "license", "similarity", F.length("piece").alias("n"), "is_full")
    found = found.where("kind != 'whole' OR is_full").withColumn("is_text", F.expr("kind = 'whole'"))
    own = found.groupBy("id", "path").agg(
        F.min_by(F.struct("license", "similarity"), F.struct(~F.col("is_text"), order)).alias("r"),
        (
            F.max("is_text")
            | (F.coalesce(F.sum(F.when(F.expr("kind = 'line' AND NOT is_full"), F.col("n"))), F.lit(0)) / F.max("n_chars") >= FILE_SHARE)
            | (F.max(F.when(F.expr("kind != 'line'"), F.col("n") / F.col("n_chars")).otherwise(0.0)) >= FILE_SHARE)
            | F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
        ).alias("is_file"),
    )
    own = store(own.select("id", "path", F.col("r.license").alias("license"), F.col("r.similarity").alias("similarity"), "is_file"))
    directory = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    covering = own.where("is_file AND path IS NOT NULL").groupBy(directory.alias("above")).agg(F.min_by(F.struct("license", "similarity"), order).alias("r"))
    covering = covering.select("above", F.col("r.license").alias("their_license"), F.col("r.similarity").alias("their_similarity"))
    directories = rows.where("path IS NOT NULL").select(directory.alias("directory")).distinct()
    parts = F.split("directory", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    above = directories.select("directory", F.explode(F.array_distinct(F.concat(ancestors, F.array("directory")))).alias("above"))
    nearest = above.join(covering, "above").groupBy("directory").agg(
        F.max_by(F.struct("above", "their_license", "their_similarity"), F.length("above")).alias("r")
    )
    nearest = nearest.select("directory", "r.*")
    placed = rows.select("id", "path").withColumn("directory", directory)
    own = own.select(F.col("id").alias("own_id"), F.col("path").alias("own_path"), "license", "similarity", "is_file")
    placed = placed.join(own, F.col("id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left")
    placed = placed.join(nearest, "directory", "left").withColumn("inherits", F.col("license").isNull() & F.col("path").isNotNull() & F.col("above").isNotNull())
    return placed.select(
        F.col("id").alias(id_col),
        "path",
        F.when(F.col("inherits"), F.col("their_license")).otherwise(F.col("license")).alias("license"),
        F.when(F.col("inherits"), F.col("their_similarity")).otherwise(F.col("similarity")).alias("similarity"),
        F.when(F.col("inherits"), "directory").when(F.col("license").isNotNull(), F.when(F.col("is_file"), "file").otherwise("line")).alias("found_in"),
        F.when(F.col("inherits"), F.col("above")).alias("covered_by"),
    )
