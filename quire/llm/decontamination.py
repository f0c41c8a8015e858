"""Benchmark decontamination by spaced seeds (native: DataFrame functions only).

Words are lower-cased runs of letters and digits. Fixed masks over ``SPAN`` words keep some places
and ignore others, so that a window survives substitutions at ignored places. The hashes of all
benchmark windows are joined with those of all training windows; every hit names an item and a
diagonal (document place less item place). Around each hit the whole item is laid over the
document and words are compared in place; a document is contaminated if a stretch of at least ``min_words``
words (or the whole item, if it has fewer) has at least ``min_share`` (in thousandths) of its words in agreement.
Reported is, of the stretches that start at the lowest balance before their end, the one with the most agreeing
words, then the shortest, then the first. Items under 13 words have lighter masks of their own, and those under 5,
which leave no room for a substitution, are looked up whole: by the hash of all their words.

Work is on distinct texts, named by two hashes: copies meet the benchmark once, and rows without an id or rows that
share an id with different texts are told apart.

Skew: the document side only streams through the seed join. The seed table is broadcast while its rows times
``ROW_BYTES`` stay under ``broadcast_bytes``; beyond that a bitmap of the seeds (16 bits a seed, but ``2**MOST_SLOT_BITS`` words of
64 bits at most: with 16 million seeds it lets through 6 % of the windows that no seed matches) is broadcast instead and drops the windows that no seed can match before both sides
are shuffled by seed, where the adaptive plan splits frequent seeds. Hits are reduced to distinct (text, item, diagonal) before
anything is grouped, written, counted, and joined with the texts in the same two ways.

Cases: null or empty texts have no words and are clean; a row with a null id is reported with a null doc_id; repeated rows give
repeated results collapsed to one row per (doc_id, item_id), of several texts under one id the best stretch; an item without words matches
nothing, a null item_id is reported as null; very long texts are exploded word by word; empty tables give no rows; extra
columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table, fresh

#: Fixed masks: places kept (1) and ignored (0). Whatever places MIN_SHARE lets be substituted in a stretch of 13 to 25
#: words, one of the masks fits between them somewhere (searched exhaustively; tests repeat it up to 20). A longer stretch is a row of
#: such stretches, one of which has the share, so no stretch that has it goes without a hit.
MASKS = ("1110111", "11010000111", "110110011")
#: The same for whole items under 13 words, by their least and greatest length.
SHORT_MASKS = ((5, 6, ("111", "1101")), (7, 12, ("1111", "11011")))
#: A stretch this long with this share of agreeing words is contamination.
MIN_WORDS, MIN_SHARE = 13, 0.8
#: A broadcast's bound, and what a row of seeds or hits takes in it at most (its fields, the hash table's slot and overhead).
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 80
#: The bitmap that stands before a shuffle of seeds has 2**LEAST_SLOT_BITS to 2**MOST_SLOT_BITS slots of 64 bits.
LEAST_SLOT_BITS, MOST_SLOT_BITS = 14, 22


def words(text) -> F.Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def seeds(hashes, at, mask: str, tag: int) -> F.Column:
    """The hash of the kept places of the window that starts at ``at``; null where the window does not fit."""
    kept = [F.get(hashes, at + F.lit(k)) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + F.lit(len(mask)) <= F.size(hashes), F.xxhash64(F.lit(tag), *kept))


def key() -> F.Column:
    """A text's name: two independent hashes."""
    text = F.coalesce("text", F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def slot_bits(seeds_: int) -> int:
    """About 16 bits a seed, within the bounds."""
    return min(max((max(seeds_, 1) * 16 // 64).bit_length(), LEAST_SLOT_BITS), MOST_SLOT_BITS)


def may_hold(probes: DataFrame, index: DataFrame, seeds_: int) -> DataFrame:
    """The probes whose seed's bit is set in a bitmap of the index's seeds; of bounded size, so it can be broadcast."""
    slot = lambda s: F.shiftrightunsigned(s, 64 - slot_bits(seeds_)).cast("int")
    bit = lambda s: F.expr(f"shiftleft(1L, cast({s} & 63 as int))")
    bitmap = index.groupBy(slot("seed").alias("_slot")).agg(F.bit_or(bit("seed")).alias("_bits"))  # 2**MOST_SLOT_BITS rows at most
    return probes.join(F.broadcast(bitmap), slot(probes["seed"]) == F.col("_slot")).where(F.col("_bits").bitwiseAND(bit("seed")) != 0).drop("_slot", "_bits")


def once(column) -> F.Column:
    """The column behind a generator of one row: the optimiser can't copy its expression into each use."""
    return F.explode(F.array(column))


def decontaminate_texts(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per contaminated text (``text_key``, see ``key``) and item_id: n_words compared, n_agree, doc_start."""
    items = benchmark.select("item_id", once(words(F.col("text"))).alias("item_words")).where(F.size("item_words") > 0)
    items = items.select("item_id", F.xxhash64("item_words").alias("item_key"), "item_words", once(F.transform("item_words", lambda w: F.xxhash64(w))).alias("hw"))
    short = max(SHORT_MASKS)[1]
    lengths = sorted(r[0] for r in items.where(F.size("hw") <= short).select(F.size("hw")).distinct().collect())  # 12 numbers at most
    of = lambda lo, hi: F.size("hw").between(lo, hi)
    shapes = [(m, t, F.lit(True)) for t, m in enumerate(masks)] + [("1" * n, 100 + n, of(n, n)) for n in lengths if n < min(SHORT_MASKS)[0]]
    for i, (lo, hi, some) in enumerate(SHORT_MASKS):
        if any(lo <= n <= hi for n in lengths):
            shapes += [(m, 50 + 10 * i + k, of(lo, hi)) for k, m in enumerate(some)]
    # One row a word and its window's hashes beside it: generators and hashes stay within generated code.
    places = lambda h: F.explode(F.sequence(F.lit(0), F.size(h) - 1)).alias("at")
    each = lambda h, which: F.explode(F.array(*[F.when(w, seeds(F.col(h), F.col("at"), m, t)) if which else seeds(F.col(h), F.col("at"), m, t) for m, t, w in shapes])).alias("seed")
    index = items.select("item_id", "item_key", "hw", places("hw")).select("item_id", "item_key", F.col("at").alias("item_at"), each("hw", True)).where("seed is not null").distinct()
    index = Table(spark, index).df
    n_seeds = index.count()
    small = n_seeds * ROW_BYTES <= broadcast_bytes
    hashed = docs.select(key().alias("text_key"), once(F.transform(words(F.col("text")), lambda w: F.xxhash64(w))).alias("h")).where(F.size("h") > 0)
    probes = hashed.select("text_key", "h", places("h")).select("text_key", "at", each("h", False)).where("seed is not null")
    hits = probes.join(F.broadcast(index), "seed") if small else may_hold(probes, index, n_seeds).join(index, "seed")
    hits = hits.select("text_key", "item_id", "item_key", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    # Lay each item over the text at its diagonals. Hits are few next to documents, so they go to the texts, not the
    # texts to them, as long as they stay within the broadcast's bound; beyond that both are shuffled.
    held = Table(spark, hits).df
    keys = held.select("text_key").distinct()
    keys = F.broadcast(keys) if held.count() * ROW_BYTES <= broadcast_bytes else keys
    texts = docs.select(key().alias("text_key"), "text").join(keys, "text_key", "left_semi").groupBy("text_key").agg(F.min("text").alias("text"))
    laid = texts.join(held, "text_key").join(items.select(F.col("item_id").alias("_i"), F.col("item_key").alias("_k"), "item_words").distinct(), F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item_key") == F.col("_k")))
    both = laid.select("text_key", "item_id", "diagonal", "item_words", once(words(F.col("text"))).alias("w"))
    n, at = F.size("item_words"), F.greatest(F.col("diagonal"), F.lit(0))
    overlap_end = F.least(F.col("diagonal") + n, F.size("w"))
    doc_part = F.slice("w", at + 1, F.greatest(overlap_end - at, F.lit(0)))
    item_part = F.slice("item_words", at - F.col("diagonal") + 1, F.greatest(overlap_end - at, F.lit(0)))
    same = F.zip_with(doc_part, item_part, lambda a, b: F.when(a == b, 1).otherwise(0))
    both = both.select("text_key", "item_id", at.alias("doc_start"), n.alias("item_n"), once(same).alias("same"))
    # A word that agrees adds 1 - min_share to the balance, a substitution takes min_share: a stretch has the share if the
    # balance does not fall over it. So, for every end, it is held against the lowest balance at least ``need`` words before.
    loss, gain = round(min_share * 1000), 1000 - round(min_share * 1000)
    need = F.least(F.col("item_n"), F.lit(min_words))
    steps = F.transform("same", lambda x, i: F.struct(x.alias("new"), F.when(i >= need, F.get("same", i - need)).alias("old")))
    fields = ("n", "sum", "ok", "back", "back_sum", "back_ok", "low", "low_sum", "low_ok", "best_n", "best_ok", "best_at")
    zero = F.struct(*[F.lit(0).cast("long").alias(f) for f in fields])
    worth = lambda hit: F.when(hit == 1, F.lit(gain)).otherwise(F.lit(-loss))

    def walk(s, x):
        n, total, ok = s["n"] + 1, s["sum"] + worth(x["new"]), s["ok"] + x["new"]
        late = x["old"].isNotNull()
        back, back_sum, back_ok = (F.when(late, s[f] + v).otherwise(s[f]) for f, v in (("back", F.lit(1)), ("back_sum", worth(x["old"])), ("back_ok", x["old"])))
        lower = late & (back_sum < s["low_sum"])
        low, low_sum, low_ok = (F.when(lower, v).otherwise(s[f]) for f, v in (("low", back), ("low_sum", back_sum), ("low_ok", back_ok)))
        agree, size = ok - low_ok, n - low
        better = (n >= need) & (total >= low_sum) & ((agree > s["best_ok"]) | ((agree == s["best_ok"]) & (size < s["best_n"])))
        best = (F.when(better, v).otherwise(s[f]) for f, v in (("best_n", size), ("best_ok", agree), ("best_at", low)))
        return F.struct(*[v.cast("long").alias(f) for f, v in zip(fields, (n, total, ok, back, back_sum, back_ok, low, low_sum, low_ok, *best), strict=True)])

    both = both.select("text_key", "item_id", "doc_start", once(F.aggregate(steps, zero, walk)).alias("r")).where("r.best_n > 0")
    best = both.groupBy("text_key", "item_id").agg(F.max(_found(F.col("r.best_ok"), F.col("r.best_n"), F.col("doc_start") + F.col("r.best_at"))).alias("b"))
    return best.select("text_key", "item_id", (-F.col("b.less")).cast("long").alias("n_words"), F.col("b.n_agree").cast("long").alias("n_agree"), (-F.col("b.early")).cast("long").alias("doc_start"))


def _found(n_agree, n_words, start) -> F.Column:
    """Ordered by merit: most agreeing words, then shortest, then first."""
    return F.struct(n_agree.alias("n_agree"), (-n_words).alias("less"), (-start).alias("early"))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, **options) -> DataFrame:
    """One row per contaminated (doc_id, item_id): n_words compared, n_agree, doc_start, share."""
    bad = Table(spark, decontaminate_texts(spark, docs, benchmark, broadcast_bytes=broadcast_bytes, **options)).df
    side = F.broadcast(bad) if bad.count() * ROW_BYTES <= broadcast_bytes else bad
    rows = docs.select("doc_id", key().alias("text_key")).join(side, "text_key")
    best = rows.groupBy("doc_id", "item_id").agg(F.max(_found(F.col("n_agree"), F.col("n_words"), F.col("doc_start"))).alias("b"))
    n_words = -F.col("b.less")
    return best.select("doc_id", "item_id", n_words.alias("n_words"), F.col("b.n_agree").alias("n_agree"), (-F.col("b.early")).alias("doc_start"), F.round(F.col("b.n_agree") / n_words, 6).alias("share"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return decontaminate(spark, read("documents"), read("benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The pipeline's stage: documents that hold no benchmark passage.

    Decided by text: every row of a contaminated text goes, also without an id; a clean text under the same id stays.
    Null and empty texts stay; repeated rows stay or go together; an empty table gives no rows.
    """
    mine = fresh(docs, "_quire_key")
    bad = decontaminate_texts(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), broadcast_bytes=broadcast_bytes)
    bad = Table(spark, bad.select(F.col("text_key").alias(mine)).distinct()).df
    side = F.broadcast(bad) if bad.count() * ROW_BYTES <= broadcast_bytes else bad
    return docs.withColumn(mine, key()).join(side, mine, "left_anti").select(*docs.columns)
