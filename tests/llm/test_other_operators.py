"""Embeddings, classifiers, packing, pages and WARC records."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import neighbours, packing, pages, quality, toxicity, warc
from eventloom.llm.shared import NO_ID

from .samples import frame, groups, prose, rows_of_text


def as_id(x):
    return NO_ID if x is None else x


def vectors(dense=300):
    rng = np.random.default_rng(4)
    rows = []

    def add(v, label):
        rows.append((len(rows), [float(x) for x in v], label))

    for label in range(3):
        for _ in range(200):
            add(rng.standard_normal(24), label)
        for _ in range(25):
            base = rng.standard_normal(24)
            for noise in (0.0, 0.05, 0.1, 0.15, 0.08):
                add(base + noise * rng.standard_normal(24), label)
    base = rng.standard_normal(24)
    for _ in range(dense):
        add(base + 0.15 * rng.standard_normal(24), 1)
    one = rng.standard_normal(24)
    add(one, 0), add(one, 0), add(2 * one, 0), add(one, 1), add(one, None)
    add([0.0] * 24, 0), add([float("nan")] + [1.0] * 23, 0), add([], 0), add([1.0, 2.0], 0), add([2.0, 4.0], 0)
    rows += [(len(rows), None, 0), (len(rows) + 1, [None] + [1.0] * 23, 0), (None, [float(x) for x in one], 0)]
    return rows


def test_neighbours(spark):
    rows = vectors()
    schema = "vec_id long, embedding array<double>, label int"
    df = spark.createDataFrame(rows, schema).withColumn("node", F.lit("x")).withColumn("group", F.lit(1)).repartition(4)
    got = {as_id(r.vec_id): (r.n_links, as_id(r.component_id), r.kept) for r in neighbours.link_vectors(df).collect()}
    assert len(got) == len(rows)
    usable = {}
    for i, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            usable[as_id(i)] = (np.array(v) / np.linalg.norm(v), label)
    links = Counter()
    pairs = []
    ids = list(usable)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            (a, la), (b, lb) = usable[i], usable[j]
            if la == lb and len(a) == len(b) and a @ b >= 0.93:
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    root = groups(pairs, [as_id(r[0]) for r in rows])
    wrong = [i for i in got if got[i] != (links[i], root[i], root[i] == i)]
    assert sum(got[i][0] for i in got) >= 0.99 * sum(links.values()) and len(wrong) <= 0.01 * len(got)
    assert not any(got[i][0] > links[i] for i in got)


def test_window_blocks_meet_at_their_borders(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "PART", 50)
    rows = [r for r in vectors(120) if r[0] is not None]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = neighbours.link_vectors(df)
    dense = [r for r in got.collect() if 975 <= r.vec_id < 1095]
    assert len({r.component_id for r in dense}) == 1 and all(r.n_links >= 100 for r in dense)


def test_vectors_that_lean_one_way(spark):
    """A label of 20,000 with a background cosine of 0.5, and 600 pairs just above the threshold."""
    rng = np.random.default_rng(12)

    def units(n):
        x = rng.standard_normal((n, 128))
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    lean = np.sqrt(0.5) * units(1) + np.sqrt(0.5) * units(20_000)
    lean /= np.linalg.norm(lean, axis=1, keepdims=True)
    side = units(600)
    side -= (side * lean[:600]).sum(1, keepdims=True) * lean[:600]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    rows = np.vstack([lean, 0.931 * lean[:600] + np.sqrt(1 - 0.931**2) * side])
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.component_id for r in neighbours.link_vectors(df).collect()}
    assert sum(got[20_000 + i] == got[i] for i in range(600)) >= neighbours.RECALL * 600


def test_passes_follow_the_shared_bits():
    few, many = neighbours.plan([(10, 5, 1000)], 0.93), neighbours.plan([(10, 5, 1000), (24, 20, 10**7)], 0.93)
    assert few[:2] == (neighbours.PASSES, neighbours.BITS) and many[0] > 60 and min(few[2], many[2]) >= neighbours.RECALL
    assert neighbours.plan([(24, 50, 10**7)], 0.93)[1] == 54 and neighbours.plan([], 0.93)[0] == neighbours.PASSES


def labelled(spark, bad, good, n=240):
    rows, marks = [], []
    for i in range(n):
        mark = i % 3 == 0
        rows.append((i, prose(i, 60, 300) + " " + (bad if mark else good)(i), "", "", 1))
        marks.append((i, 0 if mark else 1, 1 if mark else 0))
    marks += [(5, None, None), (None, 1, 1), (10_000, 1, 0)]
    return frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark, lambda i: "!! ".join(["JUNK"] * 12), lambda i: "fine.")
    weights = quality.fit(docs, labels, label="quality", learn=labels["doc_id"] % 5 != 0)
    scores = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    held = [i for i in scores if i % 5 == 0]
    assert all((scores[i] >= quality.THRESHOLD) == (i % 3 != 0) for i in held)
    odd = quality.score(frame(spark, clash=True), weights).collect()
    assert Counter(r.doc_id for r in odd) == Counter(r[0] for r in rows_of_text())
    assert all(0 <= r.score <= 1 for r in odd)


def test_quality_without_labels(spark):
    docs, labels = frame(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = quality.fit(docs, labels, label="quality", learn=F.lit(True))
    assert {r.score for r in quality.score(docs, weights).collect()} == {0.5}
    assert quality.score(frame(spark, []), weights).count() == 0


def test_regression_follows_plain_steps():
    """Two texts, the weights by the textbook recursion."""
    model = quality.Leader(bits=4)
    z, n = defaultdict(float), defaultdict(float)
    for at, values, label in [([1, 3, 16], [0.5, 1.0, 1.0], 1), ([3, 4, 16], [2.0, 0.3, 1.0], 0)] * 3:
        w = {}
        for i in at:
            l1, l2 = (0, 0) if i == 16 else (quality.L1, quality.L2)
            w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + l2)
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(at, values, strict=True))))
        for i, v in zip(at, values, strict=True):
            g = (p - label) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA * w[i]
            n[i] += g * g
        model.learn(np.array(at), np.array(values), label)
    assert np.allclose(model.z[[1, 3, 4, 16]], [z[i] for i in (1, 3, 4, 16)])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark, lambda i: f"you zorgling{i % 7} zorglon zorglat", lambda i: "be well")
    index = toxicity.fit(docs, labels, label="toxic", learn=labels["doc_id"] % 4 != 1)
    scores = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    held = [i for i in scores if i % 4 == 1]
    assert all((scores[i].score >= toxicity.THRESHOLD) == (i % 3 == 0) for i in held)
    assert all(scores[i].evidence[0].label == 1 for i in held if i % 3 == 0)
    kept = toxicity.without_toxic(docs, index)
    assert {r.doc_id for r in kept.collect()} == {i for i in scores if scores[i].score < toxicity.THRESHOLD}
    odd = toxicity.score(frame(spark, clash=True), index).collect()
    assert Counter(r.doc_id for r in odd) == Counter(r[0] for r in rows_of_text())
    assert {r.score for r in odd if r.doc_id == 3} == {index.base}
    assert toxicity.without_toxic(frame(spark, clash=True), index).columns == frame(spark, clash=True).columns


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    index = toxicity.fit(frame(spark), labels, label="toxic", learn=F.lit(True))
    assert len({r.score for r in toxicity.score(frame(spark), index).collect()}) == 1
    assert toxicity.score(frame(spark, []), index).count() == 0


def test_block_maxima_find_the_nearest():
    rng = np.random.default_rng(8)
    terms = [f"t{i}" for i in range(60)]
    idf = rng.uniform(1, 4, 60)
    examples = []
    for i in range(500):
        at = rng.choice(60, rng.integers(0, 8), replace=False)
        examples.append((i, int(rng.integers(2)), {int(t): int(rng.integers(1, 5)) for t in at}))
    examples += [(900 + i, 1, dict(examples[7][2])) for i in range(3)]
    index = toxicity.build(terms, idf, examples)
    dense = np.zeros((len(index.ids), 60))
    for row, (_, _, counts) in enumerate([x for x in examples if x[2]]):
        at, values = index.vector(counts)
        dense[row, at] = values
    for _ in range(100):
        counts = {int(t): int(rng.integers(1, 4)) for t in rng.choice(60, 5, replace=False)}
        at, values = index.vector(counts)
        near, similarity = index.nearest(at, values)
        cosines = dense[:, at] @ values
        order = sorted(range(len(cosines)), key=lambda i: (-round(cosines[i], 9), i))[: toxicity.NEIGHBOURS]
        assert near.tolist() == [i for i in order if cosines[i] > 0]
        assert np.allclose(similarity, cosines[near])


def plain_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_encoder_equals_the_tokenizer():
    tokenizer, encode = plain_tokens(), packing.Encoder(packing_path())
    texts = [t or "" for _, t, *_ in rows_of_text()]
    texts += ["It's, well... DON'T! 3.14, a.b,c. ,, .", "<|endoftext|> x<|startoftext|>y", "İstanbul ΑΣ ß ﬁ é ́x", "a b\x1cc", "汉字。かな, 한국"]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def packing_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("targets", [None, {"a": 3.0, "b": 1.0}])
def test_packing_round_trip(spark, targets):
    rows = rows_of_text()
    df = packing.pack(frame(spark, rows, clash=True), targets=targets, length=64, window=256)
    tokenizer = plain_tokens()
    expected = Counter(
        (d, tuple(ids))
        for (d, *_), e in zip(rows, tokenizer.encode_batch([r[1] or "" for r in rows], add_special_tokens=False), strict=True)
        for ids in [[*e.ids, packing.END]]
    )
    found = sorted(df.collect(), key=lambda r: (r.sequence_id, r.offset))
    at = Counter()
    for r in found:
        assert r.offset == at[r.sequence_id] and r.length == len(r.ids) // 4 > 0
        at[r.sequence_id] += r.length
    sizes = [at[k] for k in range(len(at))]
    assert all(s == 64 for s in sizes[: sum(sizes) // 64]) and all(s & (s - 1) == 0 for s in sizes)
    # the pieces of a document give it back; rows of a repeated id are told apart by their starts
    docs = defaultdict(list)
    for r in sorted(found, key=lambda r: r.start):
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        home = next(x for x in docs[r.doc_id] + [[0, ()]] if x[0] == r.start and (r.start == 0 or x[2] == r.doc_tokens))
        if r.start == 0:
            docs[r.doc_id].append([r.length, ids, r.doc_tokens])
        else:
            home[0], home[1] = home[0] + r.length, home[1] + ids
    assert sum(len(x[1]) for v in docs.values() for x in v) == sum(len(t) * n for (_, t), n in expected.items())
    single = {d for d, n in Counter(r[0] for r in rows).items() if n == 1}
    assert {(d, x[1]) for d in single for x in docs[d]} == {(d, t) for d, t in expected if d in single}


def test_schedule_follows_targets():
    totals = {"+a": 40_000, "+b": 30_000, "+c": 5_000}
    schedule = packing.Schedule(totals, {"+a": 2.0, "+b": 1.0, "+c": 1.0}, 1024, 256)
    where = defaultdict(Counter)
    places = set()
    for queue, n in totals.items():
        for first, place, size in schedule.stretches(queue, 0, n):
            for x in range(place, place + size):
                places.add(x)
                where[x // 1024][queue] += 1
    assert places == set(range(75_000))
    for k in range(15):  # until the smallest queue is empty
        assert abs(where[k]["+a"] - 512) <= 3 and abs(where[k]["+c"] - 256) <= 3
    same = packing.Schedule(totals, None, 1024, 256)
    cut = [x for a, b in ((0, 123), (123, 17_000), (17_000, 40_000)) for x in same.stretches("+a", a, b - a)]
    assert sum(x[2] for x in cut) == 40_000 and len({x[1] for x in cut}) == len(cut)


def packed_places(pieces, length):
    """Of each token of the packed stream, its source, in order."""
    out = []
    for r in sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset)):
        out += [r.source] * r.length
    return out


def test_packing_follows_targets_in_every_window(spark):
    rows = [(i, prose(i, 50), "", ("web", "book", None)[i % 3], 0) for i in range(300)]
    docs = frame(spark, rows)
    for targets, first in (({"web": 3, "book": 1}, {"web": 192, "book": 64}), ({"book": 1.0, None: 1.0}, {"book": 128, None: 128})):
        places = packed_places(packing.pack(docs, targets=targets, length=64, window=256), 64)
        total, left, at = Counter(places), Counter(places), 0
        while all(left[s] >= n for s, n in first.items()):  # until the first queue is empty
            part = Counter(places[at : at + 256])
            assert all(abs(part[s] - n) <= 1 for s, n in first.items()) and not part.keys() - first.keys()
            left.subtract(part)
            at += 256
        assert at >= 0.9 * 256 * min(total[s] // n for s, n in first.items())
        last = ({"web", "book", None} - first.keys()).pop()
        assert set(places[-total[last] :]) == {last}
    for wrong in ({"webb": 1.0}, {"web": 1.0, "+web": 2.0}, {"web": -1.0}, {"web": float("nan")}):
        with pytest.raises(ValueError):
            packing.pack(docs, targets=wrong, length=64, window=256)


def test_packing_keeps_sources_beyond_the_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 4)
    rows = [(i, prose(i, 30), "", None if i % 9 == 8 else f"s{i % 9}", 0) for i in range(270)]
    pieces = packing.pack(frame(spark, rows), targets={"s1": 3.0, "s2": 1.0}, length=64, window=256)
    assert {(r.doc_id, r.source) for r in pieces.collect()} == {(r[0], r[3]) for r in rows}
    places = packed_places(pieces, 64)
    assert all(abs(Counter(places[at : at + 256])["s1"] - 192) <= 1 for at in range(0, 768, 256))
    assert set(places[: Counter(places)["s1"]]) == {"s1", "s2"}


def test_packing_nothing(spark):
    assert packing.pack(frame(spark, [])).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><b>";</script></head>
<body class="has-sidebar"><header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy</div><article><h1>Head &amp; more</h1><p>One <b>bold</b>
 two<br>three<p>Four &lt;5 &copy &#233;&nbsp;x<ul><li>i<li>ii</ul><div class="share-bar">Share</div>
<form>f<input value=1></form><p class=lead>a < b and c</p><section class="comments"><p>first!</p></section></article>
<aside>side</aside><footer>foot</footer></body></html>"""


def test_main_text():
    assert pages.main_text(PAGE).split("\n") == ["Head & more", "One bold two three", "Four <5 © é x", "i", "ii", "a < b and c"]
    assert pages.main_text("") == "" and pages.main_text("plain <") == "plain <"
    assert pages.main_text("<p>cut <b>off</b> her<a hre") == "cut off her"
    assert "first!" in pages.plain_text(PAGE) and "var a" not in pages.plain_text(PAGE)


def test_classes_about_the_page_and_heads_of_articles():
    page = '<div class="page has-sidebar no-ads"><article class=with-comments><header class="entry-header"><h1>A</h1></header>'
    page += '<p>b</p><div class=commentList><p>c</p></div></article><div id="sideBar-menu">d</div></div>'
    assert pages.main_text(page) == "A\nb"
    assert pages.main_text('<div class="header">x</div><h2 class="site-header">y</h2><p>z</p>') == "y\nz"


def test_site_style_tree(spark):
    def page(i):
        body = "".join(f"<p>{prose(10 * i + k, 9)}</p>" for k in range(4))
        return f"<html><body><div class='x1'><p>Welcome to our site</p></div><div class='x2'>{body}</div><div>Call us</div></body></html>"

    rows = [(i, "https://one.example/p", page(i)) for i in range(8)] + [(20, "https://two.example/", page(1))]
    rows += [(30, None, None), (31, "", ""), (None, "https://one.example/q", page(3)), (0, "https://one.example/p", page(0))]
    rows += [(40 + i, "https://same.example/", page(5)) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("low", F.lit("z")).repartition(3)
    got = sorted(((as_id(r.page_id), r.url or "", r.text) for r in pages.extract(df).collect()), key=repr)
    expected = []
    for i, url, html in rows:
        k = {20: 1, None: 3}.get(i, 5 if i is not None and i >= 40 else i)
        article = "\n".join(prose(10 * k + j, 9) for j in range(4)) if html else ""
        whole = f"Welcome to our site\n{article}\nCall us"
        expected.append((as_id(i), url or "", article if not html or "one." in url else whole))
    assert got == sorted(expected, key=repr)
    assert pages.extract(df.limit(0)).count() == 0


def test_role_words_on_wrappers():
    side, body = "<div class=ad>Buy</div><nav>Go</nav>", "<h1>Head</h1><p>one two three</p><p>four five six seven</p>"
    text = "Head\none two three\nfour five six seven"
    for wrapper in ('div class="sidebar-layout"', 'div id="form-wrapper"', 'form id="aspnetForm"', "div class=comments-page"):
        for inner in ("article", "main"):
            end = wrapper.split()[0]
            assert pages.main_text(f"<{wrapper}>{side}<{inner}>{body}</{inner}></{end}>") == text
    assert pages.main_text(f"<form id=aspnetForm><div class=search-page>{body}</div></form>") == text
    assert pages.main_text(f"<article><div class=form-body>{body}</div></article>") == text
    # what is beside the article, or in it without being most of it, keeps its role
    others = "<div class=related><article><p>teaser</p></article></div><ol class=comment-list><li><article>so long a reply</article></ol>"
    assert pages.main_text(f"<div class=sidebar-layout><article>{body}</article>{others}</div>") == text
    assert pages.main_text(f"<main><article>{body}</article><div class=comments>{'<p>I think not</p>' * 90}</div></main>") == text
    assert pages.main_text(f"<div>{body}</div><ol class=comment-list><li><article>first</article></ol>") == text


def test_role_words_on_inline_elements():
    page = '<p>Look up <span class="search-term">spark</span>, <em class="notice">not</em> <label>sparks</label>.</p>'
    for whole in (f"<article>{page}</article>", page):
        assert pages.main_text(whole) == "Look up spark, not sparks."
    assert pages.main_text("<article>text</article><a class=share-button>Share</a>") == "text"


@pytest.mark.parametrize("holder", ["article", "div"])
def test_copies_with_other_adverts_are_no_template(spark, holder):
    def page(k, advert):
        body = "".join(f"<p>{prose(50 * k + j, 9)}</p>" for j in range(3))
        return f"<body><div class=ad><b>Buy {advert}</b></div><nav>Go {advert}</nav><{holder}><h1>{prose(50 * k + 9, 4)}</h1>{body}</{holder}><div>Call us</div></body>"

    copies, others = 400, 8
    rows = [(i, "https://one.example/", page(0, i)) for i in range(copies)]
    rows += [(copies + k, "https://one.example/", page(k, k)) for k in range(1, others + 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for r in pages.extract(df).collect():
        k = max(0, r.page_id - copies)
        assert r.text.split("\n") == [prose(50 * k + 9, 4), *(prose(50 * k + j, 9) for j in range(3))]


def test_one_headline_for_all_articles(spark):
    rows = [(i, "https://one.example/", f"<article><h1>The weather</h1><p>{prose(i, 9)}</p></article>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in pages.extract(df).collect()} == {f"The weather\n{prose(i, 9)}" for i in range(6)}


def test_text_inside_and_outside_of_articles_is_judged(spark):
    def page(i):
        around = f"<div class=x0>Welcome to our site</div><div class=x1><p>{prose(i, 9)}</p></div>"
        return f"<body>{around}<article><h1>The weather</h1><p>{prose(100 + i, 9)}</p><div class=x2>More from us</div></article></body>"

    def near_copy(i):
        return f"<article><h1>Head</h1><p>{prose(7, 30)}</p><p class=y>{prose(200 + i, 9)}</p></article>"

    rows = [(i, "https://one.example/", page(i)) for i in range(6)] + [(10, "https://two.example/", page(0))]
    rows += [(20 + i, "https://three.example/", near_copy(i)) for i in range(6)]
    got = dict(pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text").collect())
    for i in range(6):
        assert got[i].split("\n") == [prose(i, 9), "The weather", prose(100 + i, 9)]
        # what is most of an article is no template, though its path says nothing
        assert got[20 + i].split("\n") == ["Head", prose(7, 30), prose(200 + i, 9)]
    assert got[10].split("\n") == ["Welcome to our site", prose(0, 9), "The weather", prose(100, 9), "More from us"]


def test_warc_round_trip(spark):
    rows = [(1, "https://a.example/x", PAGE), (2, None, None), (None, "https://a.example/y", "é"), (1, "https://a.example/x", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("block", F.lit("z"))
    found = warc.responses(df)
    sources = {r.record_id: r for r in found.collect()}
    derived = warc.derivatives(found).collect()
    assert len(sources) == 3 and len(derived) == 8
    for r in derived:
        ((headers, block),) = warc.parse(bytes(r.record))
        source = sources[r.refers_to]
        assert block == bytes(r.block) and headers["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        assert headers["WARC-Refers-To"] == f"<{source.record_id}>" and headers["WARC-Type"] == r.type
        assert headers.get("WARC-Target-URI") == source.target_uri == r.target_uri
        assert r.source_payload_digest == source.payload_digest and r.source_block_digest == source.block_digest
        if r.type == "conversion":
            assert block.decode() == pages.plain_text({1: PAGE, 2: ""}.get(r.page_id, "é"))
        else:
            fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if line)
            assert fields["source-payload-digest-holds"] == "true" and fields["source-header-Content-Type"].startswith("text/html")
            assert headers["WARC-Concurrent-To"] == fields["conversion"]
    both = list(warc.parse(b"".join(bytes(r.record) for r in derived)))
    assert len(both) == 8


def test_warc_odd_messages(spark):
    import gzip

    body = gzip.compress(b"<p>caf\xe9</p>")
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(body), body)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    rows = [
        (1, "urn:1", "u", warc.DATE, head + chunked, "sha1:X", None),
        (2, "urn:2", "u", None, b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG", None, None),
        (3, "urn:3", None, None, None, None, None),
        (4, "urn:4", "u", None, b"<p>no headers</p>", None, None),
        (5, None, "u", None, b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=odd\r\n\r\n<b>gone", None, None),
    ]
    out = warc.derivatives(spark.createDataFrame(rows, warc.RESPONSES)).collect()
    texts = {r.page_id: bytes(r.block).decode() for r in out if r.type == "conversion"}
    assert texts == {1: "café", 3: "", 4: "no headers", 5: "gone"}
    assert sum(r.type == "metadata" for r in out) == 5
    assert b"source-block-digest-holds: false" in next(bytes(r.block) for r in out if r.page_id == 1 and r.type == "metadata")
    assert warc.derivatives(spark.createDataFrame([], warc.RESPONSES)).count() == 0


def test_crc_of_ids(spark):
    from eventloom.llm.queries import remainder

    got = spark.createDataFrame([(0,), (12345,), (-7,), (None,)], "doc_id long").select("doc_id", remainder(F.col("doc_id"), 5).alias("r"))
    assert {r.doc_id: r.r for r in got.collect()} == {i: zlib.crc32(str(i).encode()) % 5 for i in (0, 12345, -7)} | {None: None}
