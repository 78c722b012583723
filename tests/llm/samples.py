"""Small documents with everything that may go wrong, and plain-Python helpers."""

import random
import re

from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators might use themselves.
CLASHES = ("h", "h1", "class", "n", "label", "score", "start", "_drop", "_id", "bucket", "hub", "root", "queue", "ids", "known", "at", "first", "n_lines", "low", "host", "node")


def lowered(text):
    return text.translate(str.maketrans(UPPER, LOWER))


def words(text):
    return re.findall(r"[^ \t-\r]+", lowered(text))


def shingles(found, size=5):
    if len(found) < size:
        return [tuple(found)] if found else []
    return [tuple(found[i : i + size]) for i in range(len(found) - size + 1)]


def prose(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(text, every, seed):
    """The text with one word in ``every`` replaced."""
    rng = random.Random(seed)
    return " ".join(w if rng.randrange(every) else f"x{rng.randrange(10**6)}" for w in text.split())


def rows_of_text():
    base = prose(1, 200)
    texts = [None, "", " \n\t", "one", "one", "A b c d", "a B c d", "a b c d e", base, base, base.upper()]
    texts += [changed(base, every, s) for s, every in enumerate((200, 120, 80, 60, 50, 40, 30, 20))]
    texts += [prose(2, 40000), prose(3, 60) + "\n" + prose(4, 60), prose(4, 60) + "\r\n" + prose(5, 60)]
    texts += ["é" * 9, "É" * 30, "﻿ zero width", "x\x00y " * 30]
    rows = [(i * 3, t, "en", ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    return [*rows, (None, base, None, None, None), (None, None, None, None, None), rows[9], rows[12]]


def frame(spark, rows=None, clash=False):
    df = spark.createDataFrame(rows_of_text() if rows is None else rows, DOCS)
    if clash:
        df = df.withColumns({c: F.lit("other") for c in CLASHES})
    return df.repartition(3)


def groups(links, nodes):
    """Smallest node reachable from each."""
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
