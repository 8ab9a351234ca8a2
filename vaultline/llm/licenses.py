"""License scans: sparse TF-IDF cosine to templates, then inheritance from directories.

A file is compared by its lines, its paragraphs (between blank lines) and as a whole,
each a TF-IDF vector over lower-cased words; document frequencies of the template words
are counted over all files, a word of no template counts as seen in none. The best
template at ``MIN_COSINE`` or more is the file's own license. A template's heaviest
words are its keys: without one of them the cosine cannot reach the bound, so texts
that hold no key are passed over without loss.

Files named LICENSE, COPYING and the like give their license to their directory. A
file without a license of its own takes that of its nearest ancestor directory that
has one: the distinct directories' ancestors are joined to the licensed directories by
path, the deepest is kept, and files are joined to their directory.

Defined cases: null or empty text has no license of its own; a null path has no
directory and inherits nothing; ties go to the higher cosine, then the first license
name; of several licence files of one directory the same rule picks one; repeated rows
each give a row; an empty table gives an empty result. Only the id, path and text
columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.arrays import array_rows, summed
from vaultline.llm.text import slices, texts_frame, texts_of
from vaultline.session import materialize

MIN_COSINE = 0.7
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.\-_].*)?$"

# License names and their usual notices, one or more a license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, public domain dedication."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_KEPT = b".-+"
_FOLD = bytes(32 if b < 128 and not chr(b).isalnum() and b not in _KEPT else b for b in bytes(range(256)).lower())


def words_of(text: bytes) -> list[bytes]:
    return [w for w in (x.strip(b".-") for x in text.translate(_FOLD).split()) if w]


def units_of(text: bytes) -> list[bytes]:
    """Lines, paragraphs and the whole text, without repeats."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    blocks = [x for x in re.split(rb"\n[ \t\r]*\n", text) if x.strip()]
    return list(dict.fromkeys([*lines, *blocks, text]))


class Matcher:
    """Template vectors for given document frequencies."""

    def __init__(self, templates, vocabulary: list[bytes], df: np.ndarray, n_files: int, least: float):
        self.idf = {w: math.log((n_files + 1) / (d + 1)) + 1 for w, d in zip(vocabulary, df.tolist())}
        self.unseen = math.log(n_files + 1) + 1
        self.least = least
        self.vectors = []
        self.keys: set[bytes] = set()
        for name, text in templates:
            v = self.vector(words_of(text.encode()))
            self.vectors.append((name, v))
            rest = sum(x * x for x in v.values())
            for w in sorted(v, key=lambda w: (-v[w], w)):
                if rest < (0.999 * least) ** 2:
                    break
                self.keys.add(w)
                rest -= v[w] ** 2

    def vector(self, words: list[bytes]) -> dict[bytes, float]:
        """Unit-length TF-IDF weights."""
        v = {w: n * self.idf.get(w, self.unseen) for w, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    def match(self, text: bytes) -> tuple[str, float] | None:
        if self.keys.isdisjoint(words_of(text)):
            return None
        best = None
        for unit in units_of(text):
            words = words_of(unit)
            if self.keys.isdisjoint(words):
                continue
            v = self.vector(words)
            for name, t in self.vectors:
                cosine = sum(x * v[w] for w, x in t.items() if w in v)
                if cosine >= self.least and (best is None or (-cosine, name) < (-best[1], best[0])):
                    best = name, cosine
        return best


def document_frequencies(files: DataFrame, vocabulary: list[bytes], text_col: str = "text") -> tuple[np.ndarray, int]:
    """Files that hold each template word, and files, over all rows."""
    def run(batches):
        place = {w: i for i, w in enumerate(vocabulary)}
        wanted, total = set(place), np.zeros((1, len(place) + 1))
        for batch in batches:
            for b in slices(batch, "t"):
                for t in texts_of(b, "t"):
                    for w in wanted.intersection(words_of(t)):
                        total[0, place[w]] += 1
                total[0, -1] += b.num_rows
        if total.any():
            yield array_rows(total)

    src = texts_frame(files).select(F.col(text_col).cast("string").alias("t"))
    df = summed(src.mapInArrow(run, "part int, sums binary"), (1, len(vocabulary) + 1))[0]
    return df[:-1], int(df[-1])


def own_licenses(files: DataFrame, id_col: str, path_col: str, text_col: str, templates=TEMPLATES,
                 least: float = MIN_COSINE) -> DataFrame:
    """``(id, path, own_license, own_score)`` per row."""
    vocabulary = sorted({w for _, t in templates for w in words_of(t.encode())})
    df, n = document_frequencies(files, vocabulary, text_col)

    def run(batches):
        matcher = Matcher(templates, vocabulary, df, n, least)
        for batch in batches:
            for b in slices(batch, "t"):
                got = [matcher.match(t) or (None, None) for t in texts_of(b, "t")]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("path"), pa.array([g[0] for g in got], pa.string()),
                                                  pa.array([g[1] for g in got], pa.float64())],
                                                 ["id", "path", "own_license", "own_score"])

    src = texts_frame(files).select(F.col(id_col).cast("long").alias("id"), F.col(path_col).cast("string").alias("path"),
                       F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "id long, path string, own_license string, own_score double")


def inherit(matched: DataFrame) -> DataFrame:
    """``(id, path, own_license, own_score, license, inherited_from)`` from own licenses.

    ``inherited_from`` is the directory whose licence file applies, null where the
    license is the file's own or there is none.
    """
    clean = F.regexp_replace(F.regexp_replace("path", r"(^|/)(\./)+", "$1"), r"/{2,}|^/|/$", "/")
    clean = F.trim(clean, F.lit("/"))
    files = matched.withColumn("dir", F.when(F.col("path").isNotNull(), F.regexp_replace(clean, r"(^|/)[^/]*$", "")))
    named = files.where(F.regexp_extract(clean, r"[^/]*$", 0).rlike(LICENSE_FILE) & F.col("own_license").isNotNull())
    licensed = named.groupBy("dir").agg(F.min_by("own_license", F.struct(-F.col("own_score"), "own_license")).alias("dir_license"))
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    above = (files.select("dir").where("dir is not null").distinct()
             .select("dir", F.explode(F.array_distinct(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(up))).alias("up")))
    nearest = (above.join(licensed.withColumnRenamed("dir", "up"), "up").groupBy("dir")
               .agg(F.max_by(F.struct("up", "dir_license"), F.length("up")).alias("n"))
               .select("dir", F.col("n.up").alias("from_dir"), F.col("n.dir_license").alias("dir_license")))
    return files.join(nearest, "dir", "left").select(
        "id", "path", "own_license", "own_score", F.coalesce("own_license", "dir_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("from_dir")).alias("inherited_from"))


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", templates=TEMPLATES,
         least: float = MIN_COSINE) -> DataFrame:
    """Own and inherited license of every file (see ``inherit`` for the columns)."""
    return inherit(materialize(own_licenses(files, id_col, path_col, text_col, templates, least), "licenses_own"))
