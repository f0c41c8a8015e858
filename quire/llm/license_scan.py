"""License scans by an exact set-similarity join of text blocks with license templates.

A template of w words is looked for in blocks of the least power of two of at least 2w words; blocks overlap by half, so a passage
of the template's length lies whole in one of them. A block meets a template if it holds at least ``share`` of its
distinct words; templates of fewer than ``LEAST_SHARED`` distinct words have to be held whole, as few words of a short notice tell licenses apart.

The join never compares a block with all templates. Tokens are put in one global order, the rarest in all documents first. A
template that must share ``need`` of its n tokens with a block shares one of its first n - need + 1 (prefix filter), so blocks are
cut only around those tokens; a block with fewer tokens of the templates than the least need goes (length filter); of a block and a
template that share a prefix token, the first common one bounds what can follow on either side (positional filter); what
is left is verified on the whole token sets. None of the filters loses a pair.

Texts are read where they lie, twice: once to count the templates' tokens, once to cut blocks; only the blocks that pass go
through the join, named by a row number that is fixed by writing the table, so rows that share an id, a text or both stay apart and no
key is hot. The templates are bounded (TEMPLATE_BYTES), and so is all that is collected or broadcast: their own tokens.

Cases: null and empty texts have no words, no labels and score 0; texts of any length are cut into blocks; equal rows and rows that share an
id, or have none, each get their own result; equal templates give one label; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table

SHARE, LEAST_SHARED, TEMPLATE_BYTES = 0.8, 10, 8 << 20
#: Phrases of the base scan and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Notices as their licenses ask for them.
TEMPLATES = (
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on the UTF-8 bytes of a lower-cased text.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = pa.struct([("width", pa.int32()), ("no", pa.int64()), ("tokens", pa.list_(pa.int32()))])


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.translate(_LOWER))


class Template:
    """A template's distinct words, how many of them a block has to hold, and the size of its blocks."""

    def __init__(self, label: str, text: str, share: float = SHARE):
        all_ = words(text.encode())
        self.label, self.words = label, sorted(set(all_))
        n = len(self.words)
        self.need = n if n < LEAST_SHARED else -int(-share * n // 1)
        self.width = 1 << max(1, 2 * len(all_) - 1).bit_length()


def token_counts(docs: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """How often each token of the vocabulary occurs in all documents; a row a token and task, summed by Spark."""
    number = {w: i for i, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(number), np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found = [i for w in words(text or b"") if (i := number.get(w)) is not None]
                total += np.bincount(np.array(found, np.int64), minlength=len(number))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["token", "n"])

    sums = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # the vocabulary at most
    return dict.fromkeys(vocabulary, 0) | {vocabulary[r["token"]]: r["n"] for r in sums}


class _Cutter:
    """Cuts the blocks of a text that can meet a template: around prefix tokens, with tokens enough."""

    def __init__(self, templates: list[Template], rank: dict[bytes, int]):
        self.rank = rank
        self.kinds = []
        for width in sorted({t.width for t in templates}):
            mine = [t for t in templates if t.width == width]
            held, first = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
            for t in mine:
                order = sorted(rank[w] for w in t.words)
                held[order] = True
                first[order[: len(order) - t.need + 1]] = True
            self.kinds.append((width, held, first, min(t.need for t in mine)))

    def cut(self, ws: list[bytes]) -> list[dict]:
        at = [(i, r) for i, w in enumerate(ws) if (r := self.rank.get(w)) is not None]
        if not at:
            return []
        place, token = np.array(at, np.int64).T
        out = []
        for width, held, first, least in self.kinds:
            near = place[first[token]]
            if not len(near):
                continue
            step = width // 2
            for no in np.unique(np.concatenate([near // step, near // step - 1])).tolist():
                if no < 0:
                    continue
                lo, hi = np.searchsorted(place, [no * step, no * step + width])
                inside = np.unique(token[lo:hi])
                inside = inside[held[inside]]
                if len(inside) >= least:
                    out.append({"width": width, "no": no, "tokens": inside.tolist()})
        return out


def base_places(ws: list[bytes], phrases: list[tuple[tuple[bytes, ...], str]]) -> tuple[list[int], set[str]]:
    """The starts of the phrases in a list of words, one for each phrase and place, and the labels of those found."""
    starts, labels = [], set()
    for phrase, label in phrases:
        at, head, size = -1, phrase[0], len(phrase)
        for _ in range(ws.count(head)):
            at = ws.index(head, at + 1)
            if tuple(ws[at : at + size]) == phrase:
                starts.append(at)
                labels.add(label)
    return starts, labels


def scan(spark: SparkSession, docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels and labels (arrays, sorted), score, matches.

    matches: label, block width, block number and the share of the template's words, of every pair of block and template that meets the threshold.
    score: 1 with a base phrase, otherwise the highest share of a match, or 0.
    """
    if sum(len(t.encode()) for _, t in templates) > TEMPLATE_BYTES:
        raise ValueError(f"templates hold {TEMPLATE_BYTES} bytes at most")
    kinds = [t for t in (Template(label, text, share) for label, text in templates) if t.words]
    vocabulary = sorted({w for t in kinds for w in t.words})
    counts = token_counts(docs, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}
    cutter, split = _Cutter(kinds, rank), [(tuple(words(p.encode())), label) for p, label in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                ws = words(text or b"")
                starts, labels = base_places(ws, split)
                rows.append((len(ws), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels), cutter.cut(ws)))
            kinds_ = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(_BLOCK)]
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds_)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, blocks array<struct<width:int,no:long,tokens:array<int>>>"
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    rows = Table(spark, read.withColumn("row", F.monotonically_increasing_id())).df  # written, so a row keeps its number

    ordered = [(i, t.label, t.width, t.need, sorted(rank[w] for w in t.words)) for i, t in enumerate(kinds)]
    whole = F.broadcast(spark.createDataFrame(ordered, "template int, label string, width int, need int, of array<int>"))  # TEMPLATE_BYTES at most
    heads = [(width, token, i, at, len(of), need) for i, _, width, need, of in ordered for at, token in enumerate(of[: len(of) - need + 1])]
    heads = F.broadcast(spark.createDataFrame(heads, "width int, token int, template int, at int, size int, need int"))
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    probes = blocks.select("row", "width", "no", F.size("tokens").alias("held"), F.posexplode("tokens").alias("pos", "token"))
    first = probes.join(heads, ["width", "token"]).groupBy("row", "width", "no", "template").agg(F.min(F.struct("pos", "at", "held", "size", "need")).alias("f"))
    possible = first.where(1 + F.least(F.col("f.held") - F.col("f.pos") - 1, F.col("f.size") - F.col("f.at") - 1) >= F.col("f.need")).select("row", "width", "no", "template")
    paired = possible.join(blocks, ["row", "width", "no"]).join(whole.drop("width"), "template")
    common = F.size(F.array_intersect("tokens", "of"))
    met = paired.select("row", "width", "no", "label", "need", common.alias("common"), (common / F.size("of")).alias("share")).where("common >= need")
    found = met.groupBy("row").agg(F.sort_array(F.collect_set("label")).alias("_labels"), F.max("share").alias("_share"), F.sort_array(F.collect_list(F.struct("label", "width", "no", "share"))).alias("matches"))
    out = rows.drop("blocks").join(found, "row", "left")
    labels = F.sort_array(F.array_union("base_labels", F.coalesce("_labels", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), score.alias("score"), "matches")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), F.round("score", 6).alias("score"))


def sql() -> str:
    """The query in SQL, without any filter: every block with every template of its width."""
    kinds = [Template(*x) for x in TEMPLATES]
    templates = ", ".join(f"({i}, '{t.label}', {t.need}, {t.width}, {len(t.words)}, '{w.decode()}')" for i, t in enumerate(kinds) for w in t.words)
    phrases = ", ".join(f"({i}, '{label}', {k}, '{w}')" for i, (p, label) in enumerate(PHRASES) for k, w in enumerate(p.split()))
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM t),
p AS (SELECT * FROM (VALUES {phrases}) AS v(phrase, label, k, word)),
places AS (SELECT r, phrase, label, i - k AS spot FROM w JOIN p USING (word) GROUP BY r, phrase, label, i - k HAVING count(*) = (SELECT count(*) FROM p AS q WHERE q.phrase = p.phrase)),
base AS (SELECT r, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
m AS (SELECT * FROM (VALUES {templates}) AS v(template, label, need, width, n, word)),
hits AS (SELECT DISTINCT r, template, label, need, n, word, unnest([i // (width // 2), i // (width // 2) - 1]) AS no FROM w JOIN m USING (word)),
met AS (SELECT r, template, label, n, count(*) AS common FROM hits WHERE no >= 0 GROUP BY r, template, label, need, n, no HAVING count(*) >= need),
every AS (SELECT r, label FROM met UNION SELECT r, label FROM places),
labels AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY r),
best AS (SELECT r, max(common / n) AS share FROM met GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END, 6) AS score
FROM t LEFT JOIN base USING (r) LEFT JOIN labels USING (r) LEFT JOIN best USING (r)
"""
