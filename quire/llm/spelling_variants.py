"""Spelling variants: words one edit apart, found from forward and reversed sorted dictionaries.

One inserted, deleted or replaced character leaves either the first half or the second half of a word intact. So of a
pair whose shorter word has m characters, both hold the same first m // 2 characters, or the same last m - m // 2. The dictionary is laid
out twice for each m, by its words' starts (forward) and by their ends (reversed), for words of m and of m + 1
characters. Sorted, the words that share a half lie next to one another: a block, found by scanning a range. A block of over ``SPLIT`` words is
subdivided: what is left open between the shared start and the shared end is halved again, and one of the halves is intact once
more. This ends where one character is open, in blocks bounded by the alphabet. A block of over ``DEAL`` words is subdivided by Spark before the
ranges are dealt to tasks, a smaller one in its task. Within a block the words are verified, in numpy.

No pair is found twice. A pair's edit is put at its first difference; a half to the left of it is a shared start, and a
shared end is used only where the first difference lies before the half's end. So exactly one of the two halves of each subdivision takes
a pair on, and numbers of partners add up over blocks. A block sends on one row a word (how many partners, and the best of them),
never its pairs.

Sizes of blocks are counted before words are dealt to tasks. Levels of Spark's subdivision number log2 of the longest open part at most.

Cases: null and empty texts have no words; a null doc_id counts as an empty one where a character is to be deleted; repeated rows count
as often as they are given; texts and words of any length are taken whole; an empty table gives no rows; ties of n go to the
smaller word in code-point order; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table

LEAST_LENGTH, LEAST_N, DOMINANCE, DROP = 6, 5, 5, 199
#: Words of a block that are compared with one another, and those that one task takes; keys with over one row in HOT_PARTS join by broadcast.
SPLIT, DEAL, HOT_PARTS = 64, 4096, 1000
#: Distinct words held while counting, and numbers in an array while comparing.
HELD_WORDS, CELLS = 200_000, 1 << 21
#: ``[A-Za-zÀ-ÿ]+`` on the UTF-8 bytes of a lower-cased text.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def runs(text: bytes, doc_id: int | None) -> Counter[bytes]:
    """A document's words and how often each occurs; where 199 divides the checksum of id and word, the word lacks a character."""
    counts = Counter(_RUN.findall(text.translate(_LOWER)))
    head, changed = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), []
    head = zlib.crc32(b":", head)
    for word in counts:
        h = zlib.crc32(word, head)
        if h % DROP == 0:
            changed.append((word, h))
    shorter = [(word.decode(), h, counts.pop(word)) for word, h in changed]  # all of them go before any comes back: what is left of one may be another
    for letters, h, n in shorter:
        at = h % len(letters)
        counts[(letters[:at] + letters[at + 1 :]).encode()] += n
    return counts


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N) -> DataFrame:
    """word and n of the words that are long and frequent enough. A task counts before its words are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            long_ = [(w, n) for w, n in held.items() if len(w) >= least_length]  # bytes; characters are counted below
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in long_], pa.binary()).cast(pa.string()), pa.array([n for _, n in long_], pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                for w, n in runs(text or b"", i).items():
                    held[w] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _key(m: str, lo: str, end: str) -> F.Column:
    """The shared start and end of a word, with the sizes that tell them apart."""
    size = F.length("word")
    return F.concat_ws(",", *[F.col(c).cast("string") for c in (m, lo, end)], F.concat(F.substring("word", F.lit(1), F.col(lo)), F.substring("word", size - F.col(end) + 1, F.col(end))))


def _halves(rows: DataFrame) -> DataFrame:
    """Each entry twice: with half of its open part added to the shared start, and with the other half added to the shared end."""
    half = F.floor((F.col("m") - F.col("lo") - F.col("end")) / 2).cast("int")
    forward = F.struct((F.col("lo") + half).alias("lo"), F.col("end").alias("end"))
    backward = F.struct(F.col("lo").alias("lo"), (F.col("m") - F.col("lo") - half).alias("end"))
    sides = rows.select("word", "n", "m", F.explode(F.array(forward, backward)).alias("s")).select("word", "n", "m", "s.lo", "s.end")
    return sides.withColumn("key", _key("m", "lo", "end"))


def blocks(spark: SparkSession, dictionary: DataFrame, deal: int = DEAL, hot_parts: int = HOT_PARTS) -> DataFrame:
    """word, n, m, lo, end, key: the entries of all blocks, none of over ``deal`` words but where one character is open."""
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1))
    now = _halves(dictionary.select("word", "n", sizes.alias("m")).where("m > 0").withColumns({"lo": F.lit(0), "end": F.lit(0)}))
    done = None
    while True:
        large = (F.count("*") > deal) & F.first(F.col("m") - F.col("lo") - F.col("end") > 1)
        big = Table(spark, now.groupBy("key").agg(F.count("*").alias("size"), large.alias("large")).where("large").select("key", "size")).df
        total = big.agg(F.sum("size")).first()[0]
        if not total:
            return now if done is None else done.unionByName(now)
        hot = F.broadcast(big.where(F.col("size") > total / hot_parts).select("key"))  # hot_parts keys at most
        cold = big.where(F.col("size") <= total / hot_parts).select("key")
        rest = now.join(hot, "key", "left_anti")
        small = rest.join(cold, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        now = Table(spark, _halves(now.join(hot, "key", "left_semi").unionByName(rest.join(cold, "key", "left_semi")))).df


def _near(short: np.ndarray, long_: np.ndarray, left: np.ndarray, right: np.ndarray, k: np.ndarray, bounded: np.ndarray) -> np.ndarray:
    """For pairs of open parts: is ``right`` one edit from ``left``, which has k characters, with the first difference inside the block?

    Parts are rows of code points, filled up with zeros. ``short`` holds them from the left, ``long_`` from the right.
    """
    a, b = short[left], short[right]
    width = a.shape[1]
    differs = a != b
    first = np.where(differs.any(1), differs.argmax(1), width)
    same_size = (b != 0).sum(1) == k
    one = differs.sum(1) == 1
    unlike = (long_[left] != long_[right])[:, ::-1]
    last = np.where(unlike.any(1), unlike.argmax(1), width)  # characters in common at the end
    start = np.minimum(first, k)
    inserted = (start + np.minimum(last, k) >= k) & ~(bounded & (start == k))
    return np.where(same_size, one, inserted)


def _letters(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the parts, from the left and from the right, filled up with zeros."""
    wide = np.array(parts, f"U{max(max(map(len, parts)), 1)}")
    left = wide.view(np.uint32).reshape(len(parts), -1)
    right = np.zeros_like(left)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    row, col = np.nonzero(left)
    right[row, left.shape[1] - sizes[row] + col] = left[row, col]
    return left, right


def subdivided(words_: list[str], at: list[int], m: int, lo: int, end: int, split: int) -> list[tuple[list[int], int, int]]:
    """Of a block (the places of its words, and how much of start and end they share) the parts that can hold a pair, as the block."""
    out, todo = [], [(at, lo, end)]
    while todo:
        at, lo, end = todo.pop()
        if len(at) < 2 or all(len(words_[i]) > m for i in at):
            continue
        half = (m - lo - end) // 2
        if len(at) <= split or not half:
            out.append((at, lo, end))
            continue
        more = m - lo - half
        forward, backward = defaultdict(list), defaultdict(list)
        for i in at:
            w = words_[i]
            forward[w[lo : lo + half]].append(i)
            backward[w[len(w) - more : len(w) - end]].append(i)
        todo.extend((x, lo + half, end) for x in forward.values())
        todo.extend((x, lo, more) for x in backward.values())
    return out


def verified(rows: pa.Table, split: int = SPLIT) -> pa.Table:
    """Of whole blocks, sorted by key: word, n_near, best_n, best for every word that has partners in its block."""
    words_, n_of = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    m_of, lo_of, end_of = (rows.column(c).to_pylist() for c in ("m", "lo", "end"))
    code = rows.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    begin = np.flatnonzero(np.diff(code, prepend=-1)).tolist()
    found = [(m_of[a], *part) for a, b in zip(begin, [*begin[1:], len(words_)], strict=True) for part in subdivided(words_, list(range(a, b)), m_of[a], lo_of[a], end_of[a], split)]
    at = np.array([i for _, x, _, _ in found for i in x], np.int64)  # the row of each entry
    count = np.array([len(x) for _, x, _, _ in found], np.int64)
    m, lo, end = (np.repeat(np.array(v, np.int64), count) for v in ([f[0] for f in found], [f[2] for f in found], [f[3] for f in found]))
    first = np.cumsum(count) - count
    start, after = np.repeat(first, count), np.repeat(first + count, count)  # each entry's block
    parts = [words_[i][a : len(words_[i]) - e] for i, a, e in zip(at.tolist(), lo.tolist(), end.tolist(), strict=True)]
    open_, width = m - lo - end, np.fromiter(map(len, parts), np.int64, len(parts))
    fan = np.where(width == open_, after - start, 0)  # a shorter word meets its whole block
    fans = np.append(0, np.cumsum(fan))
    near, best = np.zeros(len(words_), np.int64), [-1] * len(words_)
    n_list = n_of.tolist()
    lo_entry = 0
    while lo_entry < len(at):
        # Blocks are taken together while their letters and pairs fit in CELLS numbers; one block's pairs are cut further.
        stop, widest = lo_entry, 1
        while stop < len(at):
            to = int(after[stop])
            w = max(widest, int(width[stop:to].max()))
            if stop > lo_entry and (to - lo_entry + fans[to] - fans[lo_entry]) * w > CELLS:
                break
            stop, widest = to, w
        left_letters, right_letters = _letters(parts[lo_entry:stop])
        f = fan[lo_entry:stop]
        a_all = np.repeat(np.arange(lo_entry, stop), f)
        b_all = start[a_all] + np.arange(len(a_all)) - np.repeat(np.cumsum(f) - f, f)
        use = (width[b_all] > width[a_all]) | (a_all < b_all)
        a_all, b_all = a_all[use], b_all[use]
        step = max(1, CELLS // widest)
        for i in range(0, len(a_all), step):
            a, b = a_all[i : i + step], b_all[i : i + step]
            good = _near(left_letters, right_letters, a - lo_entry, b - lo_entry, open_[a], end[a] > 0)
            a, b = at[a[good]], at[b[good]]
            for x, y in ((a, b), (b, a)):
                np.add.at(near, x, 1)
                for u, v in zip(x.tolist(), y.tolist(), strict=True):
                    w = best[u]
                    if w < 0 or n_list[v] > n_list[w] or (n_list[v] == n_list[w] and words_[v] < words_[w]):
                        best[u] = v
        lo_entry = stop
    held = np.flatnonzero(near).tolist()
    return pa.table({"word": pa.array([words_[i] for i in held], pa.string()), "n_near": pa.array(near[held], pa.int64()), "best_n": pa.array([n_list[best[i]] for i in held], pa.int64()), "best": pa.array([words_[best[i]] for i in held], pa.string())})


def scan(batches: Iterator[pa.RecordBatch], split: int = SPLIT) -> Iterator[pa.RecordBatch]:
    """Whole blocks from rows sorted by key; a block that a batch cuts is carried over."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        keys = rows.column("key")
        last, cut = keys[-1].as_py(), len(keys) - 1
        while cut and keys[cut - 1].as_py() == last:
            cut -= 1
        rest = rows.slice(cut)
        if cut:
            yield from verified(rows.slice(0, cut), split).to_batches()
    if rest is not None:
        yield from verified(rest, split).to_batches()


def partners(spark: SparkSession, dictionary: DataFrame, split: int = SPLIT, deal: int = DEAL) -> DataFrame:
    """word, n_near, best_n, best: how many words are near each one that has any, and the most frequent of them."""
    entries = blocks(spark, dictionary, deal)
    scanned = entries.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: scan(b, split), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("low"), F.col("best").alias("best"))).alias("b")  # the largest n, then the smallest word
    return scanned.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.low")).alias("best_n"), F.col("b.best").alias("best"))


def roots(spark: SparkSession, forms: DataFrame, longest: int) -> DataFrame:
    """word and root of the rows of (word, form): each step doubles the length of the chains that are followed."""
    now = forms.select("word", F.col("form").alias("root"))
    done = 1
    while done < longest:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = Table(spark, now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))).df
        done *= 2
    return now


def variants(spark: SparkSession, docs: DataFrame, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N, dominance: int = DOMINANCE, split: int = SPLIT, deal: int = DEAL) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents that is long and frequent enough."""
    if dominance < 2:
        raise ValueError("a form has to be at least twice as frequent as its word")
    dictionary = Table(spark, words(docs, least_length, least_n)).df
    linked = dictionary.join(partners(spark, dictionary, split, deal), "word", "left")
    dominant = F.col("best_n") >= dominance * F.col("n")
    linked = Table(spark, linked.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(dominant, F.col("best")).alias("form"), F.when(dominant, F.col("best_n")).alias("form_n"))).df
    forms = linked.where("form is not null").select("word", "form")
    most, longest = dictionary.agg(F.max("n")).first()[0] or 0, 1
    while dominance**longest * least_n <= most:  # n grows at each step of a chain
        longest += 1
    return linked.join(roots(spark, forms, longest), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
