"""License notices in texts, found by voting of word k-grams on offset diagonals."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of, written
from .text import LOWER, PUNCT, mix64, slices, word_hashes, word_spans

#: Words of a k-gram: all of a template that is shorter.
GRAM = 4
#: A template of at least LONG words may differ from the text in this share of its words, a shorter one in none.
LONG, EDITS = 20, 0.2
#: Bits of the first filter for each k-gram of a template, and at the most.
FILTER_FACTOR, FILTER_MOST = 64, 1 << 23

# Phrases whose every place counts, with their labels.
PHRASES = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license")]

# Sentences and notices as their licenses publish them, with SPDX-like labels.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("gpl-2.0", "GNU General Public License, version 2"),
    ("gpl-3.0", "GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
            "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
            "GNU General Public License for more details."),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, "
            "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the "
            "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
            "other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by-sa", "CC BY-SA"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-nd", "CC BY-ND"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "CC0 1.0 Universal"),
]


@dataclass(frozen=True)
class Template:
    """words: lower case. base: every place of it counts as a place of a phrase."""

    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def gram(self) -> int:
        return min(GRAM, len(self.words))

    @property
    def edits(self) -> int:
        return int(len(self.words) * EDITS) if len(self.words) >= LONG else 0

    @property
    def votes(self) -> int:
        """k-grams that any text within the allowed edits shares, as an edit spoils at most k of them."""
        return max(1, len(self.words) - self.gram + 1 - self.gram * self.edits)


def words_of(text: str) -> list[str]:
    """A text's words by the operator's rule."""
    data = text.encode()
    starts, ends, _ = word_spans(pa.array([text]), PUNCT)
    return [LOWER[np.frombuffer(data[s:e], np.uint8)].tobytes().decode() for s, e in zip(starts, ends)]


def templates_of(phrases, notices) -> list[Template]:
    made = [Template(label, tuple(words_of(text)), base) for rows, base in ((phrases, True), (notices, False))
            for label, text in rows]
    return [t for t in made if t.words]


def rolling(words: np.ndarray, left: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside texts, and their places; left: words to the text's end, this one included."""
    at = np.flatnonzero(left >= k)
    acc = np.full(len(at), k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[at + j]
    return mix64(acc), at


def _grams_of(templates: list[Template]) -> list[tuple[int, int, int]]:
    """(hash, template, position) of all k-grams of all templates."""
    found = []
    for t, template in enumerate(templates):
        words, counts = word_hashes(pa.array([" ".join(template.words)]), PUNCT, LOWER)
        grams, at = rolling(words, counts[0] - np.arange(len(words)), template.gram)
        found += [(int(g), t, int(p)) for g, p in zip(grams.view(np.int64), at)]
    return found


def _filter(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The hashes in order, and a table of bits of their heads that sorts out most others at once."""
    size = 1 << 10
    while size < min(FILTER_FACTOR * len(grams), FILTER_MOST):
        size *= 2
    bits = np.zeros(size, bool)
    shift = 64 - int(size).bit_length() + 1
    bits[grams >> np.uint64(shift)] = True
    return np.unique(grams), bits, shift


_SCANNED = "row long, doc_id long, n_words long, region long, lo long, key long, at long, text string"


def _scan(known: np.ndarray, bits: np.ndarray, shift: int, lengths: list[int], reach: int):
    """For each text a row with its number of words, a row for each k-gram that a template has, and the texts of the
    regions that lie within `reach` words of one. Regions of a text are disjoint, so no notice is parted."""

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 1):
            size = batch.num_rows
            texts = batch.column(1)
            words, counts = word_hashes(texts, PUNCT, LOWER)
            ends = np.cumsum(counts)
            left = np.repeat(ends, counts) - np.arange(len(words))
            keys, places = [], []
            for k in lengths:
                grams, at = rolling(words, left, k)
                hit = np.flatnonzero(bits[grams >> np.uint64(shift)])
                hit = hit[np.isin(grams[hit], known)]
                keys.append(grams[hit])
                places.append(at[hit])
            key, at = np.concatenate(keys), np.concatenate(places)
            order = np.argsort(at, kind="stable")
            key, at = key[order], at[order]
            doc = np.searchsorted(ends, at, "right")
            begin = ends - counts
            rows = number + np.arange(size)
            number += size

            def out(row, doc_id, n_words, region, lo, key, at, text):
                return pa.RecordBatch.from_arrays(
                    [pa.array(row), doc_id, n_words, region, lo, key, at, text],
                    ["row", "doc_id", "n_words", "region", "lo", "key", "at", "text"])

            none, no_text = pa.nulls(size, pa.int64()), pa.nulls(size, pa.string())
            yield out(rows, batch.column(0), pa.array(counts), none, none, none, none, no_text)
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 2 * reach)
            region = np.cumsum(new) - 1
            none = pa.nulls(len(at), pa.int64())
            yield out(rows[doc], none, none, pa.array(at[new][region]), none, pa.array(key.view(np.int64)),
                      pa.array(at - begin[doc]), pa.nulls(len(at), pa.string()))
            firsts = np.flatnonzero(new)
            lasts = np.append(firsts[1:], len(at)) - 1
            owner = doc[firsts]
            lo = np.maximum(at[firsts] - reach, begin[owner])
            hi = np.minimum(at[lasts] + reach, ends[owner] - 1)
            starts, stops, data = word_spans(texts, PUNCT)
            pieces = pa.array([data[starts[a]:stops[b]].tobytes() for a, b in zip(lo, hi)], pa.binary()).cast(pa.string())
            none = pa.nulls(len(lo), pa.int64())
            yield out(rows[owner], none, none, pa.array(at[firsts]), pa.array(lo - begin[owner]), none, none, pieces)

    return run


def fits(text: list[str], lo: int, hi: int, template: Template) -> list[tuple[int, int, float]]:
    """(first, last, similarity) of the places in words lo to hi - 1 where the template stands within its edits.

    Similarity is 1 less the edit distance in words over the template's length. Of places that overlap only the best
    stays, the first of equals.
    """
    n = len(template.words)
    lo, hi = max(lo, 0), min(hi, len(text))
    if template.edits == 0:
        return [(i, i + n - 1, 1.0) for i in range(lo, hi - n + 1) if tuple(text[i:i + n]) == template.words]
    ids = {w: i for i, w in enumerate(dict.fromkeys(template.words))}
    x = np.array([ids.get(w, -1) for w in text[lo:hi]], np.int64)
    place = np.arange(len(x) + 1)
    cost, start = np.zeros(len(x) + 1, np.int64), place.copy()  # of the template's words so far, ending before a place
    for i, w in enumerate(template.words):
        step = np.concatenate([[i + 1], np.minimum(cost[:-1] + (x != ids[w]), cost[1:] + 1)])
        origin = np.concatenate([[0], np.where(cost[:-1] + (x != ids[w]) <= cost[1:] + 1, start[:-1], start[1:])])
        # Words of the text that the template lacks: the least of step[j] + (i - j).
        low = np.minimum.accumulate(step - place)
        source = np.maximum.accumulate(np.where(step - place == low, place, 0))
        cost, start = low + place, origin[source]
    found = []
    for end in np.argsort(cost, kind="stable"):
        if cost[end] > template.edits:
            break
        a, b = int(start[end]), int(end) - 1
        if a <= b and all(b < c or a > d for c, d, _ in found):
            found.append((a, b, 1 - int(cost[end]) / n))
    return sorted((lo + a, lo + b, s) for a, b, s in found)


_SPANS = "row long, label string, base boolean, first long, last long, similarity double"


def _verify(templates: list[Template]):
    def run(batches):
        for batch in batches:
            for row, lo, text, bands in zip(*(batch.column(c).to_pylist() for c in ("row", "lo", "text", "bands"))):
                words = words_of(text)
                spans = {}
                for band in bands:
                    t = templates[band["template"]]
                    n = len(t.words)
                    for a, b, s in fits(words, band["low"] - lo - t.edits, band["high"] - lo + n + t.edits, t):
                        spans[(band["template"], a, b)] = s
                yield _best(row, lo, spans, templates)

    return run


def _best(row: int, lo: int, spans: dict, templates: list[Template]) -> pa.RecordBatch:
    """All places of phrases; of notices that overlap those with the higher (similarity, length)."""
    kept, order = [], sorted(spans, key=lambda k: (-spans[k], k[1] - k[2], k))
    taken = np.zeros(max((b for _, _, b in spans), default=-1) + 1, bool)
    for key in order:
        t, a, b = key
        if templates[t].base:
            kept.append(key)
        elif not taken[a:b + 1].any():
            taken[a:b + 1] = True
            kept.append(key)
    schema = pa.schema([("row", pa.int64()), ("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()),
                        ("last", pa.int64()), ("similarity", pa.float64())])
    return pa.RecordBatch.from_pylist(
        [{"row": row, "label": templates[t].label, "base": templates[t].base, "first": lo + a, "last": lo + b,
          "similarity": spans[(t, a, b)]} for t, a, b in kept], schema)


def _diagonals(hits: DataFrame, templates: list[Template]) -> DataFrame:
    """Bands of neighbouring diagonals (offsets of a template in a text) with enough votes."""
    spark = hits.sparkSession
    grams = written(spark.createDataFrame(_grams_of(templates), "key long, template int, pos long"), "template-grams")
    about = spark.createDataFrame([(i, t.edits, t.votes) for i, t in enumerate(templates)],
                                  "template int, edits int, least int")
    # Both are files or lists of known size: Spark broadcasts them while they are small, and joins by shuffle beyond.
    votes = (hits.join(grams, "key").groupBy("row", "region", "template", (F.col("at") - F.col("pos")).alias("offset"))
             .agg(F.count("*").alias("votes")))
    line = Window.partitionBy("row", "region", "template").orderBy("offset")
    votes = votes.join(written(about, "templates"), "template")
    far = F.coalesce(F.col("offset") - F.lag("offset").over(line) > F.col("edits"), F.lit(True))
    merged = votes.withColumn("new", far.cast("int")).withColumn("band", F.sum("new").over(line))
    return (merged.groupBy("row", "region", "template", "band")
            .agg(F.min("offset").alias("low"), F.max("offset").alias("high"), F.sum("votes").alias("votes"),
                 F.first("least").alias("least")).where("votes >= least"))


def license_spans(docs: DataFrame, phrases=PHRASES, notices=NOTICES, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts (row, doc_id, n_words) and the verified places of licenses in them (row, label, base, first, last, similarity).

    `row` numbers the texts anew, as identifiers may repeat or be null; first and last are places of words, from 0.

    Method: rolling hashes of all k words of the lower-cased texts (k = GRAM, fewer for shorter templates), behind a
    filter of the templates' hashes, are joined with the templates' positions. Each pair votes for its diagonal, the
    place in the text where the template would begin. Votes of diagonals at most the allowed edits apart are added up,
    and bands with as many votes as any text within the edits must have are verified word by word: a short template
    stands as it is, a long one by the edit distance of its words. So no place within the rule is missed. Of notices
    that overlap the more similar one is kept, then the longer; places of phrases all stay.

    Null texts are empty; texts without words have no places. A text may be of any length: of it only its hits and the
    words around them go on, one row for each region, and regions are apart by more than a notice can span. Equal rows
    each have their own. No rows give no rows. Other columns are not read. phrases, notices: (label, text); a template
    without words is left out. They are a parameter of some thousand words, held by every task.
    """
    spark = docs.sparkSession
    templates = templates_of(phrases, notices)
    grams = np.array([g for g, _, _ in _grams_of(templates)], np.int64).view(np.uint64)
    # As far as a notice within its edits can go on without a k-gram: every edit may spoil k of them.
    reach = max((t.gram * (t.edits + 1) if t.edits else len(t.words) for t in templates), default=0)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    scan = _scan(*_filter(grams), sorted({t.gram for t in templates}) or [GRAM], reach)
    scanned = written(rows.mapInArrow(scan, _SCANNED), "scanned")
    heads = scanned.where(F.col("n_words").isNotNull()).select("row", "doc_id", "n_words")
    if not templates:
        return heads, spark.createDataFrame([], _SPANS)
    hits = scanned.where(F.col("key").isNotNull()).select("row", "region", "key", "at")
    bands = _diagonals(hits, templates).groupBy("row", "region").agg(
        F.collect_list(F.struct("template", "low", "high")).alias("bands"))
    regions = scanned.where(F.col("text").isNotNull()).select("row", "region", "lo", "text")
    found = regions.join(bands, ["row", "region"]).select("row", "lo", "text", "bands").mapInArrow(_verify(templates), _SPANS)
    return heads, written(found, "license-spans")


def license_report(docs: DataFrame, phrases=PHRASES, notices=NOTICES, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row for each text: doc_id, n_words, n_base (places of phrases), first_word, last_word (their smallest and largest
    start), base_labels, labels (comma-joined, sorted, distinct), score (the best similarity of a place, else 0).

    Cases are those of `license_spans`.
    """
    heads, spans = license_spans(docs, phrases, notices, id_col, text_col)
    start = F.when(F.col("base"), F.col("first"))
    per = spans.groupBy("row").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("similarity").alias("score"))
    return heads.join(per, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
