"""Toxicity by a counterfactual-regularised linear classifier.

A document is the set of its lower-cased words and of their first 3, 4 and 5 letters (word families),
hashed into ``2**BITS`` buckets. A logistic regression with an L1 penalty is fitted on the driver
on at most ``sample`` labelled documents, those with the smallest hash of their id (the documented bound; an id with
several texts or labels counts once, with the smallest of them; only hashed features come to the driver). Counterfactual regularisation: in every labelled document
that names a group, the identity term is swapped for every other one, and the squared change of the
score is penalised, ``fairness`` times; one swap of every pair is always assumed, so that terms the
sample lacks are held to the others as well. Naming a group thus moves no score.

Scoring reads each text once, where it lies; the model is a dictionary of the non-zero weights.

Cases: null and empty texts get the score of no words; very long texts are read whole; ties and repeated rows score alike; without
labelled rows every score is 0; an empty table gives no rows; extra columns are ignored unless kept, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import fresh

BITS, THRESHOLD, SAMPLE = 20, 0.7, 10_000
#: Sizes of the prefixes that stand beside a word: its stem in several languages.
PREFIXES = (4, 6)

#: Group names that are swapped for one another (English, French, German, Spanish).
IDENTITY_TERMS = tuple(
    """women men girls boys woman man muslim muslims jewish jews christian christians hindu buddhist atheist catholic
    black white asian latino african arab european gay lesbian straight transgender bisexual queer immigrant immigrants
    refugee refugees disabled blind deaf elderly young old rich poor femmes hommes musulmans juifs noirs blancs immigrés
    frauen männer muslime juden christen schwarze weiße einwanderer mujeres hombres musulmanes judíos negros blancos inmigrantes""".split()
)
_EDGE = ".,;:!?\"'()[]{}«»“”‘’…-–—*#$%&|<>_/\\"


def tokens(text: str | None) -> set[str]:
    return {w for x in set((text or "").lower().split()) if (w := x.strip(_EDGE))}


def _buckets(word: str, memo: dict[str, tuple[int, ...]]) -> tuple[int, ...]:
    got = memo.get(word)
    if got is None:
        mask = (1 << BITS) - 1
        names = ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]
        got = tuple(zlib.crc32(x.encode()) & mask for x in names)
        if len(memo) < 200_000:
            memo[word] = got
    return got


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms, memo = {t: i for i, t in enumerate(IDENTITY_TERMS)}, {}
    for batch in batches:
        rows, named = [], []
        for text in batch.column("text").to_pylist():
            words = tokens(text)
            rows.append(np.unique(np.array([b for w in words for b in _buckets(w, memo)], np.int32)).tobytes())
            named.append(sorted(terms[w] for w in words if w in terms))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array(rows, pa.binary()), pa.array(named, pa.list_(pa.int32()))], names=["doc_id", "toxic", "features", "named"])


def fit(rows: list[tuple[int, bytes, list[int]]], l1: float = 5e-5, fairness: float = 1.0, steps: int = 300) -> tuple[float, dict[int, float]]:
    """The bias and the non-zero weights of the buckets.

    Without rows, or with one label only, there are no weights and the bias decides for that label (0 without rows); rows without
    features count for the bias; equal rows count as often as they are given.
    """
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return (-50.0 if not len(y) or y.max() == 0 else 50.0), {}
    size = 1 << BITS
    sets = [np.frombuffer(r[1], np.int32) for r in rows]
    n1, n0 = y.sum(), (1 - y).sum()
    d1, d0 = np.zeros(size), np.zeros(size)
    for label, d in ((1, d1), (0, d0)):  # in pieces: the driver never holds all features at once in a wide form
        mine = [s for s, t in zip(sets, y, strict=True) if t == label]
        for i in range(0, len(mine), 500):
            d += np.bincount(np.concatenate(mine[i : i + 500]), minlength=size)
    some = np.flatnonzero(d1 + d0 >= 3)
    d1, d0 = d1[some], d0[some]
    p1, p0 = (d1 + 0.5) / (n1 + 1), (d0 + 0.5) / (n0 + 1)
    p = (d1 + d0 + 0.5) / (len(y) + 1)
    z = (p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    memo: dict = {}
    term_buckets = [_buckets(t, memo) for t in IDENTITY_TERMS]
    use = some[np.abs(z) > 4]
    at = np.full(size, -1, np.int32)
    at[use] = np.arange(len(use))
    held_in = [x[x >= 0] for x in (at[s] for s in sets)]
    row, col = np.repeat(np.arange(len(sets)), [len(x) for x in held_in]), np.concatenate(held_in)
    # Swaps: how often each ordered pair of terms would be exchanged.
    t = len(IDENTITY_TERMS)
    held = np.bincount([i for r in rows for i in r[2]] or [0], minlength=t) * (1 if any(r[2] for r in rows) else 0)
    pairs = 1.0 + held[:, None] + held[None, :]
    np.fill_diagonal(pairs, 0)
    lap = (np.diag(pairs.sum(1)) - pairs) / pairs.sum()
    m = np.zeros((t, len(use)))
    for i, bs in enumerate(term_buckets):
        for b in bs:
            if at[b] >= 0:
                m[i, at[b]] = 1
    quad = fairness * (m.T @ (lap @ m)) if m.any() else None
    w, bias = np.zeros(len(use)), float(np.log(n1 / n0))
    prev, mom = w.copy(), 1.0
    x, xb = w.copy(), bias
    prev_b = bias
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    # The step is the inverse of the curvature's bound, found by power iteration.
    v = np.ones(len(use)) / max(len(use), 1) ** 0.5
    curve = 1.0
    for _ in range(25):
        xv = np.bincount(row, weights=v[col], minlength=len(y)) * weight
        u = 0.5 * np.bincount(col, weights=xv[row], minlength=len(use)) + (2 * quad @ v if quad is not None else 0)
        curve = float(np.linalg.norm(u)) or 1.0
        v = u / curve
    rate = 1 / (1.1 * curve + 0.5)
    for _ in range(steps):
        s = xb + np.bincount(row, weights=x[col], minlength=len(y))
        err = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - y) * weight * 2
        g = np.bincount(col, weights=err[row], minlength=len(use))
        if quad is not None:
            g = g + 2 * quad @ x
        w = x - rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        bias = xb - rate * err.sum()
        nxt = (1 + np.sqrt(1 + 4 * mom * mom)) / 2
        if (x - w) @ (w - prev) > 0:
            nxt = 1.0  # restart the momentum
        k = (mom - 1) / nxt
        x, xb = w + k * (w - prev), bias + k * (bias - prev_b)
        prev, prev_b, mom = w, bias, nxt
    # The bias puts the boundary between the classes' nearer ends, a third of the way from the clean ones: a toxic word counts alone.
    s = np.bincount(row, weights=w[col], minlength=len(y))
    bias = -(np.quantile(s[y == 1], 0.1) + 2 * np.quantile(s[y == 0], 0.98)) / 3
    gap = max(np.quantile(s[y == 1], 0.1) - np.quantile(s[y == 0], 0.98), 1e-3)
    scale = max(1.0, 8.0 / gap)
    return float(bias * scale), {int(use[i]): float(w[i] * scale) for i in np.flatnonzero(w)}


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id and r (toxic, features, named): at most ``sample`` rows, one an id, however often ids repeat in either table."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic")
    return found.mapInArrow(_features, "doc_id long, toxic int, features binary, named array<int>").groupBy("doc_id").agg(F.min(F.struct("toxic", "features", "named")).alias("r"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> tuple[float, dict[int, float]]:
    """docs (doc_id, text), labels (doc_id, toxic): a model fitted on at most ``sample`` documents."""
    rows = sorted(training_rows(docs, labels, sample).collect(), key=lambda x: x["doc_id"])
    return fit([(x["r"]["toxic"], bytes(x["r"]["features"]), list(x["r"]["named"])) for x in rows], **options)


def score(docs: DataFrame, model: tuple[float, dict[int, float]], keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The kept columns and the score, between 0 and 1, under the given name."""
    bias, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for text in (x.as_py() for x in batch.column(batch.num_columns - 1)):  # one text at a time is a Python string
                hit: set[int] = set()
                for w in tokens(text):
                    v = known.get(w)
                    if v is None:
                        v = tuple(b for b in _buckets(w, {}) if b in weights)
                        if len(known) < 500_000 and len(w) <= 40:  # so bounded in bytes too
                            known[w] = v
                    if v:
                        hit.update(v)
                out.append(bias + sum(weights[b] for b in sorted(hit)))
            s = 1 / (1 + np.exp(-np.clip(np.array(out, float), -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s)], names=out_schema.names)

    held = docs.select(*keep, F.col("text").alias(fresh(docs, "_quire_text")))
    out_schema = StructType([*held.schema.fields[:-1], StructField(name, DoubleType())])
    return held.mapInArrow(run, out_schema)


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: documents whose score is under the threshold, with their own columns.

    Rows are scored by their texts alone: null and empty texts and rows without an id stay, repeated rows stay or go
    together, of rows that share an id each is judged by its own text; an empty table gives no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    model = train(docs, labels)
    name = fresh(docs, "_quire_score")
    return score(docs, model, keep=tuple(docs.columns), name=name).where(F.col(name) < THRESHOLD).select(*docs.columns)
