"""Counter files read in pieces."""

import random

import pytest

from eventloom.sources import counterfiles
from eventloom.sources.counterfiles import CounterReader, read_counters
from tests.conftest import rows


def content(run, n, classes, version, seed=0):
    rng = random.Random(seed)
    lines, expected = ["# counters", str(version), " ".join(map(str, [run, len(classes), *classes]))], []
    for rec in range(n):
        stamp = [rng.randrange(10**6) for _ in range(rng.choice([4, 5]))]
        lines += ["#  note"] * rng.randrange(2) + [""] * rng.randrange(2) + ["  ".join(map(str, stamp))]
        for c in classes:
            values = [rng.randrange(10 ** rng.randrange(1, 10)) for _ in range(8 if version > 2 else 6)]
            lines.append("\t".join(map(str, values)))
            expected.append((run, version, rec, *(*stamp, None)[:5], c, *(*values, None, None)[:8]))
    return "\n".join(lines) + "\n" * rng.randrange(2), expected


@pytest.mark.parametrize("split", [300, 1 << 20])
def test_pieces_give_the_same_records(spark, tmp_path, split):
    expected = []
    for i, (n, classes, version) in enumerate([(30, [3, 8], 3), (0, [1], 2), (7, [5], 2), (1, list(range(20)), 4), (4, [], 2)]):
        (tmp_path / f"in{i % 2}").mkdir(exist_ok=True)
        text, found = content(100 + i, n, classes, version, i)
        (tmp_path / f"in{i % 2}" / f"{i}.cnt").write_text(text)
        expected += found
    (tmp_path / "_SUCCESS").write_text("not a counter file")
    got = read_counters(spark, str(tmp_path), split)
    assert got.dtypes[2] == ("rec", "int") and rows(got) == sorted(expected, key=repr)
    assert rows(read_counters(spark, f"file://{tmp_path}", split)) == sorted(expected, key=repr)


def test_a_large_file_is_several_tasks(spark, tmp_path):
    text, expected = content(7, 4000, [1, 2, 3], 3)
    (tmp_path / "large.cnt").write_text(text)
    for i in range(50):
        (tmp_path / f"small{i}.cnt").write_text(content(10 + i, 1, [1], 2)[0])
    split = len(text) // 7
    shares = CounterReader({"path": str(tmp_path), "splitbytes": str(split)}).partitions()
    assert len([s for s in shares if s.pieces[0][0].endswith("large.cnt")]) == 8
    assert len(shares) == 9  # the small files share one
    assert len(CounterReader({"path": str(tmp_path), "splitbytes": str(split), "what": "counts"}).partitions()) == 8
    got = read_counters(spark, str(tmp_path), split).where("run = 7")
    assert rows(got) == sorted(expected, key=repr)


GOOD = ["1 2 3 4", "1 2 3 4 5 6", "11 12 13 14 15 16"]


@pytest.mark.parametrize(
    ("broken", "what"),
    [
        (["1 2 3", *GOOD[1:]], "time stamp"),
        ([GOOD[0], "1 2 3 4 5", GOOD[2]], "counters"),
        ([GOOD[0], GOOD[1]], "counters"),
        ([*GOOD, "1 2 3 4 5 6"], "time stamp"),
        ([GOOD[0], "1 2 x 4 5 6", GOOD[2]], "number"),
    ],
)
@pytest.mark.parametrize("split", [1, 50, 10_000])
def test_malformed_records_fail_in_any_piece(spark, tmp_path, broken, what, split):
    for place in (0, 5):
        records = [*GOOD * place, *broken, *GOOD * (9 - place)]
        path = tmp_path / f"{place}.cnt"
        path.write_text("\n".join(["2", "9 2 4 5", *records]))
        reader = CounterReader({"path": str(path), "splitbytes": str(split)})
        with pytest.raises(counterfiles.MalformedFile, match=f"malformed {what}"):
            for share in reader.partitions():
                list(reader.read(share))


def test_cut_off_and_headless_files(spark, tmp_path):
    for name, lines, what in [
        ("cut", ["2", "9 2 4 5", *GOOD * 20, *GOOD[:2]], "last record"),
        ("none", ["# only a note"], "header"),
        ("short", ["2", "9 3 4 5"], "number of classes"),
    ]:
        (tmp_path / name).write_text("\n".join(lines))
        with pytest.raises(Exception, match=f"malformed {what}"):
            read_counters(spark, str(tmp_path / name), 100).count()
    with pytest.raises(Exception, match="nowhere"):
        read_counters(spark, str(tmp_path / "nowhere")).collect()
