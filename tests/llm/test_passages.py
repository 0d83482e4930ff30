"""Repeated passages against a plain count of all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stratiform.llm import passages
from stratiform.llm.passages import repeated_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """doc_id, text, ... -> sorted (doc_id, n_words, n_removed, kept)."""
    first = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        if doc is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        if doc is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i:i + window])] < doc:
                    gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def found(spark, rows, window, **kw):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, start string, n int").repartition(5)
    got = repeated_passages(docs, window, **kw).select(
        "doc_id", "n_words", F.expr("aggregate(removed, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"), "kept")
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    line = [rng.choice(words) for _ in range(16)]  # a line that many documents hold, longer than a window
    short = [rng.choice(words) for _ in range(10)]  # and one that is shorter
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for doc in range(120):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 80))]
        for part in (line, short):
            if rng.random() < 0.6:
                at = rng.randrange(len(text) + 1)
                text[at:at] = part
        if rng.random() < 0.3:
            a = rng.randrange(30)
            text += passage[a:a + rng.randrange(5, 30)]
        rows.append((doc * 7 % 121, rng.choice(["\t", " ", "\n ", "\x0b"]).join(text)))
    base = rows[5][1].split()
    for doc in range(200, 260):  # near copies
        copy = list(base)
        if copy:
            copy[rng.randrange(len(copy))] = "changed"
        rows.append((doc, " ".join(copy)))
    rows += [(300 + i, rows[9][1]) for i in range(30)] + [rows[3], rows[3]]  # exact copies, a repeated row
    rows += [(4, "one id " + rows[11][1]), (4, "with another text " + rows[12][1])]
    rows += [(None, rows[9][1]), (None, None), (400, None), (401, ""), (402, " \n\t "), (403, "a " * 300), (404, "b " + "a " * 90)]
    return rows


@pytest.mark.parametrize("bucket_most", [1000, 3, 0])
def test_equal_to_plain_windows(spark, corpus, bucket_most):
    assert found(spark, corpus, 12, bucket_most=bucket_most) == plain(corpus, 12)


def test_window_shorter_than_a_minimiser(spark, corpus):
    assert found(spark, corpus[:80], 3) == plain(corpus[:80], 3)


def test_far_branches_of_the_joins(spark, corpus, monkeypatch):
    monkeypatch.setattr("stratiform.llm.common.fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(passages, "sized_join", lambda a, b, on, how="inner", **k: a.join(b, on, how))
    assert found(spark, corpus, 12) == plain(corpus, 12)


def test_a_hot_key_is_spread(spark):
    from stratiform.llm.common import spread_join
    left = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows")).where("k % 2 <> 0 OR k = -1")
    for how in ("inner", "left"):
        got = spread_join(left, right, ["k"], "rows", how, most_hot=50, least_hot=10)
        want = left.join(right, "k", how)
        assert sorted(map(tuple, got.select("id", "k", "rows").collect())) == sorted(map(tuple, want.select("id", "k", "rows").collect()))


def test_very_long_text_and_segments(spark, monkeypatch):
    rng = random.Random(9)
    words = [str(rng.randrange(10**9)) for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[70_000:70_200])), (3, "x " + " ".join(words[131_050:131_090]) + " y"),
            (4, "z" * 600_000 + " " + " ".join(words[:49]))]
    assert found(spark, rows, 50) == plain(rows, 50)


def test_empty_table(spark):
    assert found(spark, [], 50) == []
