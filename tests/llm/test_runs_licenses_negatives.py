"""Periodic runs, licence scan and hard negatives against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import licenses, negatives
from eventloom.llm.queries import QUERIES
from eventloom.llm.runs import periodic_runs, repair, repeated_tail, runs
from tests.conftest import rows

from .samples import DOCS, frame, lowered, prose, rows_of_text

OTHER = ("seed", "runs", "found", "places", "row", "e", "items", "block", "anchor", "dims", "positives", "most")


def clashing(df):
    return df.withColumns({c: F.lit("other") for c in OTHER if c not in df.columns})


def folder(spark, tmp_path, df, name):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# periodic runs


def plain_runs(words, least=12):
    """Every period, every stretch of words that far apart."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequences():
    rng = random.Random(5)
    for kind in range(600):
        letters = rng.choice([1, 2, 3, 5, 20])
        words = [rng.randrange(letters) for _ in range(rng.randrange(120))]
        part = [rng.randrange(letters) for _ in range(rng.randrange(1, 25))]
        if kind % 4 == 1 and words:
            words = [words[i] for i in repeated_tail(len(words), rng.randrange(10**6)).tolist()]
        if kind % 4 == 2:
            words = (words[:20] + part * rng.randrange(1, 6)) * rng.randrange(1, 4) + words[:10] + part * 3
        if kind % 4 == 3:
            a, b = [0], [0, 1]
            for _ in range(rng.randrange(3, 9)):
                a, b = b, b + a
            words = b + words[: rng.randrange(10)] + b
        yield words


def test_runs_equal_all_periods():
    for number, words in enumerate(sequences()):
        least = (12, 12, 4, 5, 9)[number % 5]
        got = [tuple(r) for r in runs(np.array(words, np.int64), least).tolist()]
        assert got == plain_runs(words, least), (words, least)


def test_grammar_derives_its_sequence():
    for words in sequences():
        rest, rules = repair(words, 100)
        grown = []
        stack = rest[::-1]
        while stack:
            symbol = stack.pop()
            if symbol >= 100:
                stack += rules[symbol - 100][::-1]
            else:
                grown.append(symbol)
        assert grown == words
        pairs = list(zip(rest, rest[1:]))
        assert all(pairs.count(p) < 2 or p[0] == p[1] for p in pairs)


def test_long_periodic_sequences_stay_cheap():
    one = np.zeros(200_000, np.int64)
    assert runs(one).tolist() == [[0, 200_000, 1]]
    rng = np.random.default_rng(1)
    long = np.tile(rng.integers(0, 1000, 40_000), 5)
    assert runs(long).tolist() == [[0, 200_000, 40_000]]


def test_query_of_runs(spark, tmp_path):
    texts = rows_of_text()[:-6]
    texts = [r for r in texts if r[1] is None or len(r[1]) < 5000]
    texts += [(1000 + i, prose(i, 150, 60), "en", "a", 0) for i in range(60)]
    texts += [(2000, "a b c " * 40 + "x y z", "en", "a", 0), (2001, "A a " * 30, "en", "a", 0), (None, "a " * 20, "", "", 0)]
    sf = folder(spark, tmp_path, clashing(frame(spark, texts, clash=True)), "documents")
    expected = []
    changed = 0
    for doc, text, *_ in texts:
        words = re.findall(r"[^ \t-\r]+", text or "")
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        n = len(words)
        if h % 10 == 0 and n:
            changed += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = plain_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        gone = {i for s, e, q in found for i in range(s + q, s + e)}
        listed = "".join(f"{s},{e},{q}\n" for s, e, q in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append(
            (doc, len(found), *best, 1000 * best[1] // best[2] if found else None)
            + tuple(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept))
        )
    assert changed > 3
    got = QUERIES["op12_periodic_runs"](spark, sf)
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert rows(got, *columns) == sorted(expected, key=repr)


def test_runs_of_nothing(spark):
    assert periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
    got = periodic_runs(frame(spark, [(1, None, None, None, None), (1, " \n ", None, None, None)]))
    assert [(r["n_words"], r["runs"], r["text"]) for r in got.collect()] == [(0, [], "")] * 2
    with pytest.raises(ValueError):
        periodic_runs(frame(spark), least=3)


# licence scan


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))


def plain_blocks(words, found):
    out = []
    for t in found:
        c, size = t.stride, len(set(t.words))
        phrase = [w.decode() for w in t.words]
        for k in range(0, len(words), c):
            shared = len(set(words[k : k + 2 * c]) & set(phrase))
            places = [i for i in range(k, k + c) if t.phrase and words[i : i + len(phrase)] == phrase]
            if shared >= t.needed and (places or not t.phrase):
                out.append((t.label, k, min(k + 2 * c, len(words)), shared / size, places))
    return sorted(out)


def noticed(seed):
    rng = random.Random(seed)
    notice = rng.choice(list(licenses.NOTICES)).split()
    for _ in range(rng.randrange(6)):
        notice[rng.randrange(len(notice))] = "other"
    if rng.randrange(2):
        rng.shuffle(notice)
    return prose(seed, rng.randrange(40)) + "\n" + " ".join(notice) + "\n" + rng.choice(list(licenses.PHRASES)).upper()


def test_license_scan_equals_all_blocks(spark):
    texts = [noticed(i) for i in range(150)]
    texts += ["Under the-MIT, license under the mit license", "cc by nc cc by nc", "cc by", "İ under the mit licensé", None, ""]
    texts += [prose(9, 30000) + " Apache License, Version 2.0 " + prose(8, 3000), "x under the mit license"]
    docs = frame(spark, [(i // 2, t, "en", "a", 0) for i, t in enumerate(texts)], clash=True)
    found = licenses.templates()
    expected = sorted((i // 2, len(plain_words(t)), plain_blocks(plain_words(t), found)) for i, t in enumerate(texts))
    got = []
    for r in licenses.scan(clashing(docs)).collect():
        blocks = [(f["label"], f["start"], f["end"], f["containment"], f["places"]) for f in r["found"]]
        got.append((r["doc_id"], r["n_words"], sorted(blocks)))
    assert sorted(got) == expected
    assert sum(any(not b[4] for b in r[2]) for r in expected) > 40


def test_filters_lose_no_block():
    rng = random.Random(3)
    letters = [f"{chr(97 + i)}" for i in range(12)]
    for _ in range(300):
        notices = {" ".join(rng.choices(letters, k=rng.randrange(1, 9))): str(i) for i in range(4)}
        found = licenses.templates({"a b": "p", "c": "q"}, notices, rng.choice([0.3, 0.5, 0.8, 1.0]))
        index = licenses.Index(found, {w.encode(): rng.randrange(5) for w in letters})
        words = rng.choices([*letters, "y", "z"], k=rng.randrange(40))
        blocks = index.blocks([w.encode() for w in words])
        got = sorted((f["label"], f["start"], f["end"], f["containment"], f["places"]) for f in blocks)
        assert got == plain_blocks(words, found)


def test_license_scan_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).collect() == []
    got = licenses.scan(frame(spark, [(None, "under the mit license", None, None, None)]), [])
    assert [tuple(r) for r in got.collect()] == [(None, 4, [])]
    with pytest.raises(ValueError):
        licenses.templates({"...": "dots"})
    assert licenses.as_table(spark, licenses.templates()).count() == len(licenses.PHRASES) + len(licenses.NOTICES)


# hard negatives


def plain_negatives(found, label_of):
    """Rows anchor, positive, rank, negative, scores of every anchor, with Python's integers."""
    taking = []
    for vec, e, label in found:
        label = label_of(vec, label)
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        taking.append((vec, label, [math.floor(256 * np.float64(np.float32(x))) for x in e]))
    out = []
    for i, (vec, label, e) in enumerate(taking):
        if vec is None or vec % 50:
            continue
        scored = []
        for j, (other, kind, f) in enumerate(taking):
            if j != i and len(e) == len(f):
                s = sum(x * y for x, y in zip(e, f))
                if abs(s) < 1 << 62:
                    scored.append((-s, -(1 << 63) if other is None else other, other, kind))
        scored.sort(key=lambda r: r[:2])
        for p in [r for r in scored if r[3] == label][:5]:
            hard = [r for r in scored if r[3] != label and 50 * -p[0] <= 100 * -r[0] <= 95 * -p[0]]
            out += [(vec, p[2], k + 1, r[2], -p[0], -r[0]) for k, r in enumerate(hard[:3])]
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


def shifted(vec, label):
    return (label + 1) % 10 if vec is not None and label is not None and vec % 7 == 0 else label


def vectors(rng):
    found = []
    for i in range(400):
        e = [rng.choice([-0.5, 0.0, 0.25, 0.5]) if i % 3 else rng.gauss(0.1, 0.3) for _ in range(6)]
        found.append((i, e, 1 if i % 3 == 0 else rng.randrange(4)))
    found += [(450, None, 1), (500, [1.0] * 6, None), (550, [float("nan")] + [0.0] * 5, 1), (551, [None] * 6, 1)]
    found += [(600, [0.5] * 6, 2), (600, [0.5] * 6, 2), (None, [0.5] * 6, 2), (650, [], 1), (651, [], 2), (652, [], 1)]
    found += [(700, [0.5] * 3, 1), (701, [0.25] * 3, 1), (702, [0.375] * 3, 2), (703, [float("inf")] * 3, 2)]
    found += [(750, [2.0**20] * 6, 7), (751, [2.0**20] * 6, 7), (752, [2.0**20 * 0.9] * 6, 8), (753, [-(2.0**20)] * 6, 8)]
    found += [(800, [2.0**60] * 2, 5), (801, [2.0**60] * 2, 5), (802, [1.0] * 2, 5), (803, [0.75] * 2, 6)]
    return found


def test_hard_negatives_equal_all_pairs(spark, tmp_path, monkeypatch):
    found = vectors(random.Random(2))
    df = clashing(spark.createDataFrame(found, VECTORS).repartition(3))
    sf = folder(spark, tmp_path, df, "embeddings")
    expected = plain_negatives(found, shifted)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert rows(QUERIES["op13_hard_negatives"](spark, sf), *columns) == expected
    # many small blocks, several of one label
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "CANDIDATES", 16)
    monkeypatch.setattr(negatives, "TOGETHER", 2)
    assert rows(QUERIES["op13_hard_negatives"](spark, sf), *columns) == expected
    assert {r[0] for r in expected} >= {0, 50, 600, 650, 700, 750}


def test_packed_products_are_exact():
    rng = np.random.default_rng(4)
    for size in (1, 7, 100, 2**12, 2**20, 2**30, 2**50):
        for dims in (1, 3, 64):
            a = rng.integers(-size, size + 1, (5, dims)).astype(float)
            c = rng.integers(-size, size + 1, (11, dims)).astype(float)
            got = negatives.scores(a, c)
            for i in range(5):
                for j in range(11):
                    assert int(got[i, j]) == sum(int(x) * int(y) for x, y in zip(a[i], c[j], strict=True))


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(none, none["vec_id"] % 50 == 0).collect() == []
    one = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 1), (52, [0.75], 2)], VECTORS)
    assert negatives.hard_negatives(one, F.lit(False)).collect() == []
    names = one.withColumn("label", F.concat(F.lit("l"), "label"))
    got = negatives.hard_negatives(names, names["vec_id"] == 50, scale=4)
    assert [tuple(r) for r in got.collect()] == [(50, 51, 1, 52, 16, 12)]
