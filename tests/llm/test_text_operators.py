"""Line dedup, Jaccard join, decontamination and substring dedup against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import decontamination, jaccard, lines, substrings, words
from eventloom.llm.components import components
from eventloom.llm.shared import NO_ID

from .samples import DOCS, changed, frame, groups, lowered, prose, rows_of_text, shingles
from .samples import words as split

SPACE = " \t\n\x0b\x0c\r"


def as_id(x):
    return NO_ID if x is None else x


def test_word_hashes_follow_words():
    texts = [t for _, t, *_ in rows_of_text()]
    seen = {}
    for a, hashed, before in words.word_slices(pa.array(texts)):
        for k in range(len(before) - 1):
            own = hashed[before[k] : before[k + 1]].tolist()
            plain = split(texts[a + k] or "")
            assert len(own) == len(plain)
            for h, w in zip(own, plain, strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_of_a_sliced_column_and_of_long_texts():
    column = pa.array(["x", None, "a b", "b " * 3_000_000])
    found = [len(h) for _, h, _ in words.word_slices(column.slice(1))]
    assert sum(found) == 3_000_002


def expected_lines(rows):
    held = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            held.setdefault(lowered(line.strip(SPACE)), set()).add(as_id(doc))
    out = []
    for doc, text, *_ in rows:
        kept = []
        found = (text or "").split("\n")
        for line in found:
            key = lowered(line.strip(SPACE))
            if len(key) < 10 or len(held[key]) < 2 or as_id(doc) == min(held[key]):
                kept.append(line)
        out.append((as_id(doc), len(found), len(found) - len(kept), "\n".join(kept)))
    return sorted(out)


def line_rows(df):
    return sorted((as_id(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in df.collect())


@pytest.mark.parametrize("clash", [False, True])
def test_line_dedup(spark, clash):
    rows = [*rows_of_text(), (90, "  Shared LINE here \n\nshared line here\nown line of 90", "x", "y", 1)]
    rows += [(91, "shared line here\t\nshort", "x", "y", 1), (90, "shared line here", "x", "y", 1)]
    df = lines.dedup_lines(frame(spark, rows, clash))
    assert line_rows(df) == expected_lines(rows)
    assert "lang" in df.columns and df.schema["doc_id"].dataType.simpleString() == "bigint"


def test_line_index_is_reversible(spark):
    first = [(1, "alpha alpha alpha\nbeta beta beta", "", "", 1), (2, "beta beta beta\ngamma gamma gamma", "", "", 1)]
    second = [(0, "gamma gamma gamma\nnew new new new", "", "", 1), (5, "alpha alpha alpha", "", "", 1)]
    index = lines.LineIndex(spark)
    index.insert(frame(spark, first))
    before = sorted(map(tuple, index.counts.collect()))
    index.insert(frame(spark, second))
    both = first + second
    assert line_rows(index.clean(frame(spark, both))) == expected_lines(both)
    index.insert(frame(spark, second))  # again: nothing changes
    assert line_rows(index.clean(frame(spark, both))) == expected_lines(both)
    index.delete(frame(spark, [*second, (77, "", "", "", 1)]))
    assert sorted(map(tuple, index.counts.collect())) == before
    index.delete(frame(spark, first[:1]))
    assert line_rows(index.clean(frame(spark, first[1:]))) == expected_lines(first[1:])
    for row in index.filters.collect():
        held = lines.CuckooFilter.from_bytes(bytes(row.bits))
        keys = [(r.h1, r.h2) for r in index.counts.where(f"shard = {row.shard}").collect()]
        assert sum(int(np.count_nonzero(t)) for t in held.tables) == len(keys)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 1 << 63, 30_000).astype(np.uint64) * np.uint64(2) for _ in range(2))
    held = lines.CuckooFilter()
    for a in range(0, 20_000, 5_000):
        held.grow(5_000)
        held.add(h1[a : a + 5_000], h2[a : a + 5_000])
    assert held.has(h1[:20_000], h2[:20_000]).all()
    assert held.has(h1[20_000:], h2[20_000:]).mean() < 0.01
    held.remove(h1[:10_000], h2[:10_000])
    assert held.has(h1[10_000:20_000], h2[10_000:20_000]).all()
    again = lines.CuckooFilter.from_bytes(held.to_bytes())
    assert sum(np.count_nonzero(t) for t in again.tables) == 10_000


def expected_components(rows):
    """By row number: set size and smallest id of the component."""
    sets = [set(shingles(split(t or ""))) for _, t, *_ in rows]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links.append((i, j))
    root = groups(links, range(len(rows)))
    smallest = {}
    for i, r in root.items():
        smallest[r] = min(smallest.get(r, as_id(rows[i][0])), as_id(rows[i][0]))
    return sorted((as_id(rows[i][0]), len(sets[i]), smallest[root[i]]) for i in range(len(rows)))


def near_copies():
    """Families of near copies around a common passage, large enough for common shingles."""
    rng = random.Random(5)
    passage = prose(50, 30)
    rows = []
    for f in range(6):
        base = prose(100 + f, 60 + 20 * f)
        for k in range(25):
            text = changed(base, rng.choice((30, 60, 120, 300)), 1000 * f + k)
            rows.append((len(rows) + 1, text + " " + passage if k % 2 else text, "", "", 1))
    rows += [(1000 + i, prose(300 + i, 20) + " " + passage, "", "", 1) for i in range(60)]
    return rows


@pytest.mark.parametrize("rows", [rows_of_text(), near_copies()], ids=["odd", "families"])
def test_jaccard_components(spark, rows):
    df = jaccard.jaccard_components(frame(spark, rows, clash=True))
    got = sorted((as_id(r.doc_id), r.n_shingles, as_id(r.component_id)) for r in df.collect())
    assert got == expected_components(rows)


def test_one_of_each_keeps_the_first(spark):
    rows = near_copies()[:60]
    kept = sorted(r.doc_id for r in jaccard.one_of_each(frame(spark, rows)).collect())
    assert kept == sorted({c for _, _, c in expected_components(rows)})


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    df = components(spark.createDataFrame(links, "a long, b long").repartition(4))
    got = {r.node: r.root for r in df.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(200)}}


def expected_hits(docs, items):
    out = {}
    for doc, text, *_ in docs:
        found = split(text or "")
        for item, other in items:
            own = split(other or "")
            if not own or not found:
                continue
            weights = Counter(shingles(own))
            for a in range(max(1, len(found) - len(own) + 1)):
                window = Counter(shingles(found[a : a + len(own)]))
                common = sum((window & weights).values())
                s = common / (sum(window.values()) + sum(weights.values()) - common)
                if s >= 0.8 and s > out.get((doc, item), (0,))[0]:
                    out[doc, item] = (s, a)
    return sorted((d, i, a, round(s, 9)) for (d, i), (s, a) in out.items())


def test_decontamination(spark):
    items = [(i, prose(600 + i, 12 + 5 * i)) for i in range(8)] + [(20, None), (21, ""), (22, "tiny item"), (None, "no id " * 3)]
    docs = [(i, prose(700 + i, 80) + " " + (items[i % 8][1]).upper() + "\n" + prose(800 + i, 30), "", "", 1) for i in range(10)]
    docs += [(20 + i, prose(900 + i, 40) + " " + changed(items[7][1], 40, i) + " " + prose(950 + i, 9), "", "", 1) for i in range(12)]
    docs += [(50, items[3][1], "", "", 1), (51, "a Tiny\nITEM b", "", "", 1), (52, None, "", "", 1), (53, "", "", "", 1)]
    docs += [(54, prose(990, 500), "", "", 1), (55, items[5][1] + " " + items[5][1], "", "", 1)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(frame(spark, docs, clash=True), bench).collect()
    expected = [x for x in expected_hits(docs, items) if x[1] is not None]
    assert sorted((r.doc_id, r.item_id, r.start_word, round(r.similarity, 9)) for r in got if r.item_id is not None) == expected
    hit = {x[0] for x in expected_hits(docs, items)}
    clean = decontamination.without_benchmark(frame(spark, docs), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, *_ in docs if d not in hit)
    assert clean.columns == [c.split()[0] for c in DOCS.split(", ")]


def test_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(3)
    items = decontamination.Items(list(range(30)), [prose(i, 30) for i in range(30)])
    for _ in range(200):
        i = int(rng.integers(30))
        bits = np.unpackbits(items.prints[i])
        bits[rng.choice(128, decontamination.RADIUS, replace=False)] ^= 1
        found = items._within(np.packbits(bits)[None, :], 30)
        assert (0, i, decontamination.RADIUS) in found


def expected_spans(rows):
    """Removed bytes by plain search; rows of one id and text are one document."""
    docs = sorted({(as_id(d), t or "") for d, t, *_ in rows})
    seen, out = set(), {}
    for doc, text in docs:
        data = text.encode()
        mask = bytearray(len(data))
        for i in range(len(data) - 99):
            piece = data[i : i + 100]
            if piece in seen:
                mask[i : i + 100] = b"\1" * 100
            seen.add(piece)
        left = bytes(b for b, m in zip(data, mask, strict=True) if not m)
        spans = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        out[doc, text] = (len(data), sum(mask), spans, hashlib.sha256(left).hexdigest())
    return sorted((as_id(d), *out[as_id(d), t or ""]) for d, t, *_ in rows)


def substring_rows():
    passage = prose(9, 30)
    rows = [(i, prose(20 + i, 20) + passage[: 100 + 7 * i] + prose(60 + i, 20), "", "", 1) for i in range(12)]
    rows += [(30, "ab" * 300, "", "", 1), (31, "é" * 130, "", "", 1), (32, passage * 3, "", "", 1), (33, "z" * 99, "", "", 1)]
    rows += [(34, "z" * 100, "", "", 1), (35, "z" * 100, "", "", 1), (36, "q" * 101, "", "", 1)]
    return rows + [(r[0] and r[0] + 500, *r[1:]) for r in rows_of_text() if len(r[1] or "") < 10_000 and r[0] != 0]


def test_substring_dedup(spark):
    rows = substring_rows()
    # one text under an id only: the order of texts of one id is a hash's
    assert len({(d, t) for d, t, *_ in rows if d is not None}) == len({d for d, *_ in rows if d is not None})
    rows = [r for r in rows if r[0] is not None] + [(None, rows[2][1], "", "", 1)]
    got = []
    for r in substrings.repeated_spans(frame(spark, rows, clash=True)).collect():
        got.append((as_id(r.doc_id), r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), r.kept_sha256))
    assert sorted(got) == expected_spans(rows)


def test_empty_tables(spark):
    none = frame(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert lines.dedup_lines(none).count() == 0
    assert jaccard.jaccard_components(none).count() == 0
    assert substrings.repeated_spans(none).count() == 0
    assert decontamination.contaminated(none, bench).count() == 0
    assert decontamination.without_benchmark(frame(spark), bench).count() == frame(spark).count()


def test_texts_nobody_asks_for_are_not_shuffled(spark):
    from pyspark.sql import functions as F

    from eventloom.llm import jaccard

    docs = spark.range(-500, 1500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    asked = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("_doc"))
    found = {r.doc_id for r in jaccard._of_asked(docs, asked.union(asked)).collect()}
    assert {r._doc for r in asked.collect()} <= found and len(found) < 60
    assert not jaccard._of_asked(docs, asked.where("false")).collect()


def test_jaccard_components_of_lists_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 4)
    rows = near_copies()
    got = jaccard.jaccard_components(frame(spark, rows, clash=True)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected_components(rows)


def test_sets_that_bitmaps_tell_apart_are_not_compared(spark, monkeypatch):
    rows = []
    for f in range(3):
        base = prose(700 + f, 400).split(" ")
        for k in range(12):
            rng = random.Random(100 * f + k)
            text = " ".join(f"w{f}x{k}x{i}" if rng.random() < 0.035 else w for i, w in enumerate(base))
            rows.append((len(rows) + 1, text, "", "", 1))
    compared, names, plain, written = [], {}, jaccard._compared, jaccard.written
    monkeypatch.setattr(jaccard, "_compared", lambda docs, pairs, classes: compared.append(pairs.count()) or plain(docs, pairs, classes))
    monkeypatch.setattr(jaccard, "written", lambda df, name: names.setdefault(name, df.columns) and None or written(df, name))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows)).collect())
    assert got == expected_components(rows)
    # most pairs of a family share enough of their prefixes, but are not similar
    assert compared[1] < 30
    # prefixes are dealt out by shingle only, not with the classes
    assert "cold" in names["sets"] and "cold" not in names["classes"]


def test_bitmaps_never_hide_an_overlap():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (100, 100), (120, 130), (500, 1100)):
        pool = rng.integers(0, 1 << 63, n + m).astype(np.uint64)
        for shared in {0, min(n, m) // 2, min(n, m)}:
            a, b = np.sort(pool[:n]), np.sort(pool[n - shared : n - shared + m])
            most = jaccard._most(n, jaccard._bitmap(a), m, jaccard._bitmap(b))
            assert shared <= most <= shared + 0.5 * (min(n, m) - shared) + 1


def test_shared_keys_get_numbers_of_their_own(spark):
    from pyspark.sql import functions as F

    keys = [k for k in range(3000) for _ in range(1 + k % 3)]
    df = spark.createDataFrame([(k * 7919 - 5_000_000, i) for i, k in enumerate(keys)], "h long, class long")
    df = df.repartition(3, "h").sortWithinPartitions("h")
    got = df.mapInArrow(jaccard._shared, "h long, class long").groupBy("h").agg(F.collect_list("class").alias("c")).collect()
    held = {}
    for i, k in enumerate(keys):
        held.setdefault(k, []).append(i)
    assert sorted(sorted(r.c) for r in got) == sorted(c for c in held.values() if len(c) > 1)
