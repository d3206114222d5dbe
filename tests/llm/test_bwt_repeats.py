"""Removed bytes against a table of all windows, with anchors taken apart and not."""

import random

import numpy as np
import pytest

from marginalia.llm import bwt_repeats


def plain(docs):
    """(doc_id, bytes kept, removed runs), sorted."""
    first = {}
    for i, text in docs:
        b = (text or "").encode() if i is not None else b""
        for k in range(len(b) - 49):
            first[b[k:k + 50]] = min(first.get(b[k:k + 50], i), i)
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        if i is not None:
            for k in range(len(b) - 49):
                if first[b[k:k + 50]] < i:
                    gone[k + 1:k + 51] = True
        edge = np.flatnonzero(np.diff(gone))
        out.append((i, bytes(c for c, g in zip(b, gone[1:]) if not g), edge[::2].tolist(), edge[1::2].tolist()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def docs():
    r = random.Random(1)
    base = "".join(r.choices("ab ", k=3000))

    def part():
        at = r.randrange(2900)
        return base[at:at + r.randrange(400)]

    texts = [lambda: None, lambda: "", lambda: "x" * r.choice([49, 50, 51, 200]), lambda: "é" * 60,
             lambda: part() + r.choice(["", "zz", "é€"]) + part(), lambda: base]
    rows = [(r.choice([None, *range(12)]), r.choice(texts)()) for _ in range(150)]
    return rows + rows[:20]


@pytest.mark.parametrize("hot", [50_000, 0, 3])
def test_against_all_windows(spark, docs, hot):
    df = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id long, text string, kept string, shard int")
    got = bwt_repeats.remove_repeats(df, hot_places=hot, shard_bytes=9000).collect()
    assert sorted([(x["doc_id"], bytes(x["kept"]), x["starts"], x["ends"]) for x in got], key=str) == plain(docs)
    assert all(x["n_bytes"] == len(x["kept"]) + sum(x["ends"]) - sum(x["starts"]) for x in got)


def test_long_text_and_nothing(spark):
    """A text of several blocks, and its copy with a changed byte; an empty table; texts without windows."""
    r = random.Random(2)
    long = "".join(r.choices("abcdefgh ", k=2 * bwt_repeats.BLOCK_BYTES + 77))
    rows = [(1, long), (2, long[:1_500_000] + "#" + long[1_500_001:])]
    got = bwt_repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert bytes(got[0]["kept"]).decode() == long and bytes(got[1]["kept"]) == b"#"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bwt_repeats.remove_repeats(empty).count() == 0
    short = spark.createDataFrame([(1, "a" * 49), (2, "a" * 49), (3, None)], "doc_id long, text string")
    assert all(not x["starts"] for x in bwt_repeats.remove_repeats(short).collect())


def test_interleave():
    r = random.Random(3)
    rows = sorted(bytes(r.choices(b"ab", k=9)) for _ in range(40)) + sorted(bytes(r.choices(b"abc", k=9)) for _ in range(30))
    order, common = bwt_repeats.interleave(np.array([list(x) for x in rows], np.uint8).T)
    merged = [rows[i] for i in order]
    assert merged == sorted(rows)
    for k in range(1, len(rows)):
        a, b = merged[k - 1], merged[k]
        assert common[k] == next((h for h in range(9) if a[h] != b[h]), 9)
