"""Near-duplicates: crowds that do not link, ids with several texts, hot hubs; against all pairs."""

import random
import re

import pytest

from stratiform.llm import minhash
from stratiform.llm.minhash import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(rows, k):
    out = []
    for doc, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        out.append((doc, grams))
    return out


def plain(rows, k, percent):
    """{(doc_id, n_shingles, component_id, kept)} by comparing all pairs."""
    docs = sets(rows, k)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(docs):
        for b, y in docs[:i]:
            if a is not None and b is not None and x and y and (a == b or 100 * len(x & y) >= percent * len(x | y)):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return sorted(((a, len(x), None if a is None else find(a), a is None or find(a) == a) for a, x in docs), key=repr)


def found(spark, rows, k=5, percent=80, **kw):
    docs = spark.createDataFrame([(d, t, 1, "w") for d, t in rows], "doc_id bigint, text string, n long, node string").repartition(4)
    return sorted((tuple(r) for r in near_duplicates(docs, k, percent, **kw).collect()), key=repr)


def crowd(n, rng, shared=80, own=35):
    """Documents that share text which is in all of them, and no more: no two link."""
    common = [f"c{i}" for i in range(shared)]
    return [(i, " ".join(common + [f"d{rng.randrange(10**9)}" for _ in range(own)])) for i in range(n)]


@pytest.mark.parametrize("paired_most", [64, 2])
def test_boilerplate_crowd_with_some_links(spark, paired_most):
    rng = random.Random(6)
    rows = crowd(90, rng)
    for i in range(12):  # some near copies inside the crowd
        words = rows[i][1].split()
        words[100 + i % 10] = "changed"
        rows.append((500 + i, " ".join(words)))
    rows += [(600 + i, f"alone {i} " + " ".join(str(rng.random()) for _ in range(30))) for i in range(20)]
    assert found(spark, rows, paired_most=paired_most) == plain(rows, 5, 80)


def test_one_id_with_two_texts_brings_links_together(spark):
    rng = random.Random(1)
    a, b = ([f"{x}{rng.randrange(10**6)}" for _ in range(60)] for x in "ab")
    near_a, near_b = a[:-1] + ["other"], b[:-1] + ["other"]
    rows = [(7, " ".join(a)), (7, " ".join(b)), (8, " ".join(near_a)), (9, " ".join(near_b)), (10, " ".join(near_b)), (3, " ".join(b)),
            (11, "nothing like the others at all"), (None, " ".join(a)), (12, None), (13, ""), (14, "Two words"), (15, "two WORDS")]
    assert found(spark, rows) == plain(rows, 5, 80)


def test_hot_copies_and_repeated_rows(spark, monkeypatch):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    rows = [(i, " ".join(base[:40] + ["x%d" % (i % 30)] + base[41:])) for i in range(120)] + [(1000, " ".join(base))] * 5
    assert found(spark, rows) == plain(rows, 5, 80)
    monkeypatch.setattr("stratiform.llm.common.fits_broadcast", lambda *a, **k: False)
    assert found(spark, rows) == plain(rows, 5, 80)


def test_rare_shingles_lose_no_link(spark):
    """The pairs that the rarest shingles give hold every pair that links."""
    from pyspark.sql import functions as F
    rng = random.Random(4)
    rows = crowd(40, rng, 60, 25)
    for i in range(40):
        words = rows[i][1].split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(5)}"
        rows.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    features = minhash.document_features(docs, 3)
    nodes = minhash._nodes(features.dropDuplicates(minhash._NAME))
    sets_of = minhash._sets_reader(nodes, docs, 3, False)
    got = {tuple(r) for r in minhash._rare_pairs(nodes.select("node", F.col("node").alias("component")), nodes, sets_of, 80).collect()}
    named = sets(rows, 3)
    want = {(a, b) for a, x in named for b, y in named if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    assert want and want <= got and len(got) < 40 * 40


def test_work_on_a_crowd_grows_in_proportion(spark):
    """Twice the documents that share boilerplate give no pairs at all, not four times as many."""
    from pyspark.sql import functions as F
    for n in (150, 300):
        docs = spark.createDataFrame(crowd(n, random.Random(3)), "doc_id bigint, text string")
        features = minhash.document_features(docs, 5)
        nodes = minhash._nodes(features)
        sets_of = minhash._sets_reader(nodes, docs, 5, False)
        assert minhash._rare_pairs(nodes.select("node", F.col("node").alias("component")), nodes, sets_of, 80).count() == 0


@pytest.mark.parametrize("some", [minhash.SOME, 100])
def test_rarest_shingles_in_place_are_those_by_shuffle(spark, monkeypatch, some):
    """The sets of a crowd stay in their tasks while the list of shared shingles is small; the rows are those of the joins."""
    monkeypatch.setattr(minhash, "SOME", some)
    rng = random.Random(8)
    sets = [(i, sorted({rng.randrange(60) ** 2 - 900 for _ in range(rng.randrange(1, 40))} | {10_000 + i})) for i in range(50)]
    sets = spark.createDataFrame(sets + [(99, [123_456])], "node bigint, set array<bigint>").repartition(3)
    counts = minhash._holders(sets)
    in_place = minhash._rarest_in_place(sets, counts.where("holders > 1"), 85)
    for df in (counts, in_place):
        assert "explode(set" not in df._jdf.queryExecution().toString()
    rows = [sorted(map(tuple, df.collect())) for df in (in_place, minhash._rarest_by_shuffle(sets, counts, 85))]
    assert rows[0] == rows[1] and len(rows[0]) > 20
    assert minhash._rarest_in_place(sets, counts.where("holders > 1000"), 85).isEmpty()


def test_crowd_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = crowd(90, random.Random(9))
    rows += [(500 + i, rows[i][1] + " more") for i in range(9)]
    monkeypatch.setattr(minhash, "fits_broadcast", lambda df: False)
    assert found(spark, rows, paired_most=2) == plain(rows, 5, 80)


def test_empty_table(spark):
    assert found(spark, []) == []
