"""The whole pipeline against plain Python, on documents made for it."""

from collections import Counter, defaultdict

import corpus_pipeline
from eventloom.llm import packing

from .samples import DOCS, changed, frame, prose
from .test_other_operators import plain_tokens
from .test_text_operators import expected_components, expected_hits, expected_lines


def corpus():
    bench = [(i, prose(5000 + i, 25)) for i in range(5)]
    rows, labels = [], []
    for i in range(160):
        text = prose(6000 + i, 50)
        if i % 8 == 3:
            text += f" you zorgling{i % 5} zorglon zorglat"
        if i % 10 == 0:
            text = text + "\nThe same closing line everywhere\n" + prose(7000 + i, 8)
        if i % 20 == 7:
            text = changed(prose(6000, 200), 100, i)  # near copies of one text
        if i % 20 == 9:
            text = text + " " + bench[i % 5][1]
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(i % 8 == 3)))
    rows += [(200, None, None, None, None), (201, "", "", "", 0), (None, prose(1, 30), "en", "s0", 5)]
    return rows, labels, bench


def test_pipeline_equals_plain_python(spark, tmp_path):
    rows, labels, bench = corpus()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    toxic = {i for i, _, y in labels if y and "zorg" in rows[i][1]}
    left = [r for r in rows if r[0] not in toxic]
    texts = {doc: text for doc, _, _, text in expected_lines(left)}
    left = [(doc, text, "", "", len(text)) for doc, text in texts.items()]
    first = {doc for doc, _, root in expected_components(left) if doc == root}
    first |= {doc for doc, text in texts.items() if not text}
    left = [r for r in left if r[0] in first]
    hit = {doc for doc, *_ in expected_hits(left, bench)}
    left = [r for r in left if r[0] not in hit]
    assert toxic and hit and len(texts) > len(first)

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
    kept = {r.doc_id if r.doc_id is not None else -(1 << 63): r for r in docs.collect()}
    assert set(kept) == {r[0] for r in left}
    assert all((kept[d].text or "") == t and (t == "" or kept[d].n_chars == len(t)) for d, t, *_ in left)

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = plain_tokens()
    size = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t, *_ in left}
    got = Counter()
    places = defaultdict(list)
    for p in pieces:
        got[p.doc_id if p.doc_id is not None else -(1 << 63)] += p.length
        places[p.sequence_id].append((p.offset, p.length))
    assert dict(got) == size
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == packing.LENGTH or at & (at - 1) == 0


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"
    ]
