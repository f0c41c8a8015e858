"""License scans, vector codes and spelling variants against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from quire.llm import license_scan, spelling_variants, vector_codes

SF = "/root/testdata/sf0.001"
EXTRA = "key size n m lo end word row blocks token template tokens _key _n vector code error".split()


def with_extra(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(1).alias(c) for c in EXTRA if c not in df.columns])


# ---- licenses ------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def plain_scan(text, templates, share=0.8):
    """Every block with every template."""
    ws = WORDS.findall(lowered(text or ""))
    at, base = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        for i in range(len(ws)):
            if ws[i : i + len(p)] == p:
                at.append(i)
                base.add(label)
    best, labels = 0.0, set(base)
    for label, t in templates:
        all_ = WORDS.findall(lowered(t))
        have = set(all_)
        if not have:
            continue
        width = 2
        while width < 2 * len(all_):
            width *= 2
        for lo in range(0, len(ws), width // 2):
            common = len(have & set(ws[lo : lo + width]))
            if common == len(have) if len(have) < 10 else 10 * common >= round(10 * share) * len(have):
                labels.add(label)
                best = max(best, common / len(have))
    return len(ws), len(at), min(at, default=None), max(at, default=None), sorted(base), sorted(labels), 1.0 if at else best


def test_license_scan(spark):
    r = random.Random(4)
    templates = (*license_scan.TEMPLATES[:4], ("own", " ".join(f"t{i}" for i in range(20)) + " the of the"), ("own", "t1 t2 the"), ("none", " - "), ("é", "ÉTÉ été ünder Ünder"))
    noise = ["the", "of", "mit", "License", "t1", "t2", "t3", "under", "by", "4", "0", "nc", "é", "ünder"]
    texts = [None, "", " \n", "MIT License", "mit-license apache\nLICENSE, General public license's mit license", "ÉTÉ été Ünder ünder", "été ÉTÉ"]
    for i in range(60):
        ws = [r.choice(noise) if r.random() < 0.7 else f"t{r.randint(0, 25)}" for _ in range(r.randint(0, 150))]
        if i % 3 == 0:  # a whole notice with some words lost, anywhere, over line ends
            own = [w for w in templates[4][1].split() if r.random() < 0.85]
            k = r.randint(0, len(ws))
            ws[k:k] = own
        texts.append(r.choice([" ", "\n", ", "]).join(ws))
    texts += [texts[9], "x " * 40_000 + templates[0][1] + " y" * 40_000]
    rows = [(None if i % 11 == 3 else i % 50, t) for i, t in enumerate(texts)]
    df = with_extra(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = license_scan.scan(spark, df, templates)
    want = [(i, *plain_scan(t, templates)) for i, t in rows]
    key = lambda x: str(x)
    assert sorted([tuple(x[:8]) for x in map(tuple, got.collect())], key=key) == sorted(want, key=key)
    assert any("own" in w[6] for w in want) and any(0.8 <= w[7] < 1 for w in want)
    assert license_scan.scan(spark, df.limit(0), templates).count() == 0
    with pytest.raises(ValueError, match="bytes"):
        license_scan.scan(spark, df, (("x", "w" * (9 << 20)),))


def test_license_shares():
    """A template of n words needs 0.8 n of them, rounded up, also where 0.8 n is whole."""
    assert [license_scan.Template("x", " ".join(f"w{i}" for i in range(n))).need for n in (9, 10, 15, 20, 21)] == [9, 8, 12, 16, 17]


# ---- vectors -------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    usable = [(i, [int(np.floor(256 * x)) for x in v], b) for i, v, b in rows if v and not any(x is None or not np.isfinite(x) for x in v)]
    size = len(usable[0][1]) // parts
    cut = lambda v, p: tuple(v[p * size : (p + 1) * size])
    order = sorted(usable, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[cut(v, p) for _, v, _ in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda x, book: min((far(x, c), j) for j, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for _, v, _ in usable:
                groups[best(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [tuple(sum(c) // len(c) for c in zip(*groups[j], strict=True)) if j in groups else e for j, e in enumerate(books[p])]
    out = []
    for i, v, b in usable:
        found = [best(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, b, bytes(j for _, j in found), sum(d for d, _ in found)))
    sums = collections.Counter()
    for _, b, _, e in out:
        sums[b] += e
    return [(*o, sums[o[1]]) for o in out], books


def test_vector_codes(spark):
    r = np.random.default_rng(2)
    rows = [(int(i), r.normal(size=8).astype(np.float32).tolist(), int(i) % 3 if i % 4 else None) for i in r.permutation(120)]
    rows += [(7, rows[0][1], 1), (None, rows[1][1], 2), (None, None, 1), (500, [], 1), (501, [float("nan")] * 8, 1), (502, [None] + [0.0] * 7, 1), (503, [float("inf")] + [0.0] * 7, 1)]
    rows += [(600 + i, [0.25] * 8, 0) for i in range(50)] + [(-1, [0.25] * 8, 0), (-2, [0.25] * 8, 0)]  # ties: equal first entries
    df = with_extra(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4))
    for parts, entries in ((4, 10), (2, 200), (8, 1)):
        out, books = vector_codes.compress(spark, df, parts, entries)
        want, plain = plain_codes(rows, parts, entries, 2)
        assert books.tolist() == [[list(e) for e in b] for b in plain]
        got = [(x["vec_id"], x["label"], bytes(x["code"]), x["error"], x["label_error"]) for x in out.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        code = next(x for x in got if x[0] == 601)
        assert len(vector_codes.decoded(code[2], books)) == 8
    out, _ = vector_codes.compress(spark, df.limit(0))
    assert out.columns == ["vec_id", "label", "code", "error", "label_error"] and out.count() == 0
    wide, _ = vector_codes.compress(spark, df.select("vec_id", "embedding", "label").unionByName(spark.createDataFrame([(9999, [1.0] * 16, 1), (9998, [3e9] * 8, 1)], "vec_id long, embedding array<float>, label int")), 4, 10)
    assert wide.where("vec_id > 9000").count() == 0 and wide.count() == len(plain_codes(rows, 4, 10, 0)[0])


def test_screen_is_exact():
    """Entries that float32 cannot tell apart: far from the origin, and equal ones."""
    r = np.random.default_rng(3)
    centre = r.integers(-(1 << 27), 1 << 27, 6)
    entries = centre + r.integers(-3, 4, (64, 6))
    entries[40:] = entries[:24]
    v = np.concatenate([centre + r.integers(-3, 4, (500, 6)), r.integers(-(1 << 27), 1 << 27, (500, 6)), np.zeros((5, 6), np.int64)])
    index, distance, open_rows = vector_codes.Codebook(entries).nearest(v)
    exact = ((v[:, None] - entries[None]) ** 2).sum(2)
    assert (index == exact.argmin(1)).all() and (distance == exact.min(1)).all() and open_rows >= 500
    small = r.integers(-300, 300, (64, 6))
    index, _, open_rows = vector_codes.Codebook(small).nearest(w := r.integers(-300, 300, (5000, 6)))
    assert (index == ((w[:, None] - small[None]) ** 2).sum(2).argmin(1)).all() and open_rows < 500


# ---- spelling ------------------------------------------------------------


def plain_variants(rows, least_length, least_n):
    counts = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lowered(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_n}
    holes, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            if (x := w[:i] + w[i + 1 :]) in n:
                near[w].add(x)
                near[x].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, c in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * c else None
    out = []
    for w, c in n.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, c, len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters, split, deal", [("ab", 4, 6), ("abcé÷", 3, 20), ("abcdefghij", 64, 4096)])
def test_spelling_variants(spark, letters, split, deal):
    r = random.Random(letters)
    lexicon = ["".join(r.choice(letters) for _ in range(r.randint(4, 11))) for _ in range(300)]
    lexicon += ["x" * k + "y" * j for k in range(4, 9) for j in range(4)] + ["Q" * 700, "q" * 701, "a" * 300 + "b" * 300, "a" * 300 + "c" + "b" * 300, "×÷ÀÿßÉ", "naïve" * 2, "naive" * 2]
    weight = [r.choice([1, 1, 1, 5, 30, 200]) for _ in lexicon]
    rows = [(i, r.choice([" ", "\n", "_1-"]).join(r.choices(lexicon, weight, k=r.randint(0, 400)))) for i in range(60)]
    rows += [(77, " ".join(["chaina"] * 2 + ["chainaa"] * 12 + ["chainaaa"] * 80)), (None, " ".join(lexicon)), (5, "Aaaaaa aaaaaa AAAAAA"), (6, None), (7, ""), (None, rows[3][1]), (3, rows[3][1])]
    df = with_extra(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = spelling_variants.variants(spark, df, 6, 2, split=split, deal=deal)
    want = plain_variants(rows, 6, 2)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain
    assert spelling_variants.variants(spark, df.limit(0)).count() == 0


def test_shortened_words():
    """What is left of one word is another one that is to be shortened too: each loses one character, in either order."""
    for text in ("aaabbbaaa aabbbaaa aabbbaaa", "aabbbaaa aaabbbaaa aabbbaaa"):
        assert dict(spelling_variants.runs(text.encode(), 72)) == {b"aabbbaaa": 1, b"aabbbaa": 2}


def test_spelling_query(spark):
    """The whole table, with production parameters."""
    rows = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = spelling_variants.query(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_variants(rows, 6, 5)


# ---- names of words and texts --------------------------------------------


def test_substring_dedup_tells_words_apart(spark):
    """Two words of 2,048 letters whose polynomials in an odd base are equal modulo 2^64; and windows of two such words in turn."""
    from quire.llm import common, substring_dedup

    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    two = one.translate(str.maketrans("ab", "ba"))
    head = " ".join(f"w{i}" for i in range(34))
    mixed = [" ".join((one, two)[bin(i).count("1") % 2 ^ flip] for i in range(35)) for flip in (0, 1)]
    short = [f"{a} {head[3:]} {b}" for a, b in (("ab", "ba"), ("ba", "ab"), ("aab", "b"), ("a", "abb"))]
    rows = [(0, f"{head} {one}"), (1, f"{head} {two}"), *enumerate(mixed, 2), *enumerate(short, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup(spark, df).collect()}
    seen = collections.Counter(tuple(t.split()[j : j + 35]) for _, t in rows for j in range(len(t.split()) - 34))
    assert max(seen.values()) == 1 and got == dict.fromkeys(range(8), 0)
    both = substring_dedup.dedup(spark, spark.createDataFrame([*rows, (8, rows[0][1])], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in both.collect()} == {i: 35 if i in (0, 8) else 0 for i in range(9)}
    r = random.Random(1)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(1, 150))) for _ in range(3000)] + [one, two]
    w = common.Words([" ".join(texts).encode()])
    for seed in (1, 2):
        assert len(set(w.strong(seed).tolist())) == len(set(texts))
    assert (w.strong(1) != w.strong(2)).all()
    alone = [common.Words([t.encode()]).strong(1)[0] for t in texts[:50]]
    assert (np.array(alone) == w.strong(1)[:50]).all()  # a word's hash is its own


def test_near_dedup_keeps_texts_of_one_name(spark, monkeypatch):
    """Where two texts have one name none is taken for the other; their copies still go."""
    from pyspark.sql import functions as F

    from quire.llm import near_copies, simhash

    monkeypatch.setattr(near_copies, "name", lambda: F.length(F.coalesce("text", F.lit(""))).cast("long"))
    rows = [(1, "one text here"), (2, "two text here"), (3, "two text here"), (4, None), (5, ""), (6, "a longer text"), (7, "another one, longer still")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["text"] or "" for r in simhash.stage(spark, df, "").collect())
    assert got == ["", "a longer text", "another one, longer still", "one text here", "two text here"]
