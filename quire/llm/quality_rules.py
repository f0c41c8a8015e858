"""Quality rules and line labelling by a linear-chain conditional random field.

Every line with a word gets binary features of its look (share of symbols, capitals, digits, repeated
words, words glued to punctuation, length, being a copy of an earlier line). A two-label chain (content,
boilerplate) is trained here by gradient ascent on the exact conditional likelihood (forward-backward),
on at most ``sample`` labelled documents, those with the smallest hash of their id, of up to SAMPLE_BYTES each
(longer ones are labelled like any other, but not trained on, so that the driver's share is bounded in bytes too).

The lines of a training document get weak labels of their own, with the document's label as prior: in a document of quality 1
a line is content, unless it repeats an earlier line, is one that ``COMMON`` or more of the sampled documents hold, or
consists of symbols and digits mostly; in one of quality 0 a line is boilerplate, unless it has eight words or more, is in no other
sampled document, and shows none of the features of bad lines. So the sequences change their label within documents, and the chain learns
its transitions from that. Viterbi decoding labels the lines of every document; it is kept if the words of content
lines are at least ``min_share`` of its words and no base rule fails.

Work is per document and narrow: nothing but the bounded training sample is shuffled.

Cases: null and empty texts have no words, fail the base rule and are not kept; very long texts are labelled whole; ties in
decoding go to content; repeated rows give repeated results; an id with several texts or labels trains once, with the smallest of them;
without labels the transition and features are zero, so all lines are content; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_RE

SAMPLE, SAMPLE_BYTES, MIN_SHARE, SEGMENT = 3_000, 1 << 20, 0.5, 200
#: A line that this many sampled documents hold is boilerplate in all of them.
COMMON = 3
WORDS = re.compile(WORD_RE)
_SYMBOLS = "#*$%&|<>"
_SYMBOL = re.compile(r"[#*$%&|<>]")
_DIGIT = re.compile(r"[0-9]")
_GLUED = re.compile(r"[!?]{2,}")
_LETTER = re.compile(r"[^\W\d_]")
_NO_ASCII_LETTERS = bytes(c for c in range(256) if not chr(c).isascii() or not chr(c).isalpha())
#: Cut points of the shares that features are made of.
SHARES = (0.02, 0.1, 0.3, 0.6)
N_FEATURES = 2 + 5 * len(SHARES) + 5


def few_letters(line: str, chars: int) -> bool:
    """Whether under half of so many characters are letters. Where the ASCII ones are enough the others need no look."""
    if 2 * len(line.encode("utf-8", "surrogatepass").translate(None, _NO_ASCII_LETTERS)) >= chars:
        return False
    return 2 * len(_LETTER.findall(line)) < chars


def line_features(words: list[str], line: str, copy: bool) -> list[int]:
    """The indices of the features that hold; words is not empty."""
    n, chars = len(words), sum(map(len, words))
    upper = sum(1 for w in words if len(w) > 2 and w.isupper())
    shares = (len(_SYMBOL.findall(line)) / chars, upper / n, len(_DIGIT.findall(line)) / chars, 1 - len(set(words)) / n if n > 8 else 0.0, len(_GLUED.findall(line)) / n)
    out = [0]
    if copy:
        out.append(1)
    for i, s in enumerate(shares):
        out.extend(2 + i * len(SHARES) + j for j, cut in enumerate(SHARES) if s >= cut)
    at = 2 + 5 * len(SHARES)
    out.append(at + (n >= 4) + (n >= 20))
    if few_letters(line, chars):
        out.append(at + 3)
    if n > 8 and sum(a == b for a, b in zip(words, words[1:], strict=False)) > 0.3 * n:
        out.append(at + 4)
    return out


def lines_of(text: str) -> tuple[list[list[int]], list[int], int]:
    """Features and word count of every line with a word, and the lines equal to an earlier one."""
    seen: set[str] = set()
    feats, counts, copies = [], [], 0
    for line in text.split("\n"):
        words = WORDS.findall(line)
        if words:
            copy = line in seen
            seen.add(line)
            copies += copy
            feats.append(line_features(words, line, copy))
            counts.append(len(words))
    return feats, counts, copies


def repeated(words: list[str]) -> int:
    """Words in three-word windows that are found at least twice in the list."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    k = len(ids)
    pair = np.unique(a[:-1] * k + a[1:], return_inverse=True)[1]
    _, inverse, count = np.unique(pair[:-1] * k + a[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inverse] > 1)
    mark = np.zeros(n, bool)
    for d in range(3):
        mark[at + d] = True
    return int(mark.sum())


def _emissions(docs: list[list[list[int]]], w: np.ndarray) -> list[np.ndarray]:
    """The lines' scores of several documents: one matrix of features for all of them."""
    lines = [f for feats in docs for f in feats]  # none is empty: feature 0 always holds
    if not lines:
        return [np.zeros(0) for _ in docs]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    flat = np.fromiter((x for f in lines for x in f), np.int64, int(sizes.sum()))
    scores = np.add.reduceat(w[flat], np.cumsum(sizes) - sizes)
    return np.split(scores, np.cumsum([len(d) for d in docs])[:-1])


def viterbi(scores: np.ndarray, stay: np.ndarray) -> np.ndarray:
    """1 for boilerplate: the best labelling of the lines; scores are for label 1 against 0."""
    a, b = 0.0, float(scores[0])
    back = []
    s00, s11 = float(stay[0]), float(stay[1])
    for e in scores[1:]:
        from0, from1 = a + s00 < b, a >= b + s11
        back.append((from0, not from1))
        a, b = (b if from0 else a + s00), (a if from1 else b + s11) + float(e)
    label = int(b > a)
    out = [label]
    for to0, to1 in reversed(back):
        label = int(to1 if label else to0)
        out.append(label)
    return np.array(out[::-1], np.int8)


#: Features that say nothing bad of a line: that it is one, and how long it is.
_PLAIN = frozenset((0, 2 + 5 * len(SHARES), 3 + 5 * len(SHARES), 4 + 5 * len(SHARES)))
_COPY, _NO_LETTERS = 1, 2 + 5 * len(SHARES) + 3


def weak_labels(rows: list[tuple[int, list[list[int]], list[int], list[int]]]) -> list[list[int]]:
    """1 for boilerplate, for each line of each (quality, features, line hashes, word counts)."""
    held: dict[int, int] = {}
    for _, _, names, _ in rows:
        for x in set(names):
            held[x] = held.get(x, 0) + 1
    out = []
    for quality, feats, names, counts in rows:
        if quality:
            out.append([int(_COPY in f or held[x] >= COMMON or _NO_LETTERS in f) for f, x in zip(feats, names, strict=True)])
        else:
            out.append([int(not (n >= 8 and held[x] == 1 and _PLAIN.issuperset(f))) for f, x, n in zip(feats, names, counts, strict=True)])
    return out


def fit(rows: list[tuple[list[int], list[list[int]]]], steps: int = 60, l2: float = 1e-2) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights for boilerplate and the two scores for staying in a label (held between -1 and 2); rows are (label of each line, features of each line).

    Without rows, without lines or with one label only everything is zero; a row without lines is left out; equal rows count as often as they are given.

    Sequences are laid side by side, so that forward and backward run over all of them at once; a document of more
    than ``SEGMENT`` lines is laid as several, all of which count, and loses only the transitions between them.
    """
    w, stay = np.zeros(N_FEATURES), np.zeros(2)
    rows = [r for r in rows if r[1]]
    if not rows or len({x for y, _ in rows for x in y}) < 2:
        return w, stay
    # Each document weighs the same within the half that its line labels give it to, each label half; shared by its lines.
    mean = np.array([np.mean(y) for y, _ in rows])
    share = np.where(mean > 0.5, 0.5 / max((mean > 0.5).sum(), 1), 0.5 / max((mean <= 0.5).sum(), 1)) / [len(f) for _, f in rows]
    parts = [(i, y[k : k + SEGMENT], f[k : k + SEGMENT]) for i, (y, f) in enumerate(rows) for k in range(0, len(f), SEGMENT)]
    share, y, rows = share[np.array([p[0] for p in parts])], np.array([x for p in parts for x in p[1]]), [(None, p[2]) for p in parts]
    length = np.array([len(f) for _, f in rows])
    t_max, n = int(length.max()), len(rows)
    seq = np.repeat(np.arange(n), length)
    pos = np.concatenate([np.arange(k) for k in length])
    sizes = [len(f) for _, fs in rows for f in fs]
    cell = np.repeat(np.arange(len(seq)), sizes)
    feat = np.array([x for _, fs in rows for f in fs for x in f])
    per = share[seq]
    g2w, g2s = np.full(N_FEATURES, 1e-8), np.full(2, 1e-8)
    inside = np.zeros((t_max, n), bool)
    inside[pos, seq] = True
    grid = np.full((t_max, n), -1)
    grid[pos, seq] = y
    for _ in range(steps):
        e = np.zeros((t_max, n))
        e[pos, seq] = np.bincount(cell, weights=w[feat], minlength=len(seq))
        trans = np.array([[stay[0], 0.0], [0.0, stay[1]]])
        alpha, beta = np.zeros((t_max, n, 2)), np.zeros((t_max, n, 2))
        alpha[0, :, 1] = e[0]
        for t in range(1, t_max):
            step = np.logaddexp(alpha[t - 1][:, 0, None] + trans[0], alpha[t - 1][:, 1, None] + trans[1])
            step[:, 1] += e[t]
            alpha[t] = np.where(inside[t][:, None], step, alpha[t - 1])
        z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
        for t in range(t_max - 2, -1, -1):
            nxt = beta[t + 1] + np.stack([np.zeros(n), e[t + 1]], 1)
            step = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
            beta[t] = np.where(inside[t + 1][:, None], step, beta[t + 1])
        p1 = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z)[pos, seq]
        err = (y - p1) * per
        gw = np.bincount(feat, weights=err[cell], minlength=N_FEATURES) - l2 * 1e-2 * w
        gs = np.zeros(2)
        if t_max > 1:
            live = inside[1:] * share
            for k in (0, 1):
                p = np.exp(alpha[:-1, :, k] + trans[k, k] + (e[1:] if k else 0) + beta[1:, :, k] - z)
                gs[k] = (((grid[1:] == k) & (grid[:-1] == k)) * live - p * live).sum() - l2 * 1e-2 * stay[k]
        g2w += gw * gw
        g2s += gs * gs
        w += 0.5 * gw / np.sqrt(g2w)
        stay = np.clip(stay + 0.1 * gs / np.sqrt(g2s), -1.0, 2.0)
    return w, stay


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: tuple[list, list, list] = ([], [], [])
        for text in batch.column("text").to_pylist():
            feats, counts, _ = lines_of(text or "")
            names = [xxhash.xxh64_intdigest(" ".join(WORDS.findall(x)).encode("utf-8", "surrogatepass")) >> 1 for x in (text or "").split("\n") if WORDS.search(x)]
            for c, v in zip(cols, (feats, names, counts), strict=True):
                c.append(v)
        kinds = (pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int32()), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "quality", "lines", "names", "counts"])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id and r (quality, lines, names, counts): at most ``sample`` rows, one an id, however often ids repeat in either table."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES)
    found = found.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "quality")
    return found.mapInArrow(_training, "doc_id long, quality int, lines array<array<int>>, names array<long>, counts array<long>").groupBy("doc_id").agg(F.min(F.struct("quality", "lines", "names", "counts")).alias("r"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    rows = [x["r"] for x in sorted(training_rows(docs, labels, sample).collect(), key=lambda x: x["doc_id"])]
    rows = [(r["quality"], r["lines"], r["names"], r["counts"]) for r in rows]
    return fit(list(zip(weak_labels(rows), [r[1] for r in rows], strict=True)))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_words long"


def label(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document: its counts, the base verdict, the words of content lines and the verdict."""
    w, stay = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lines = [lines_of(t) for t in texts]
            for text, (feats, counts, copies), scores in zip(texts, lines, _emissions([x[0] for x in lines], w), strict=True):
                words = WORDS.findall(text)
                n, twice = len(words), repeated(words)
                good = int(np.array(counts)[viterbi(scores, stay) == 0].sum()) if feats else 0
                failed = n < 50 or 100 * twice > 50 * n
                row = (n, sum(map(len, words)), sum(map(text.count, _SYMBOLS)), copies, twice, failed, not failed and good >= min_share * n, good)
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return label(docs, train(docs, labels))
