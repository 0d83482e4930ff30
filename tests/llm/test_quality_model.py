"""The quality model against a plain one, its far join, and the labels it never sees."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratiform.llm import quality
from stratiform.llm.common import table
from stratiform.llm.quality import ORDER, score_quality


def grams(text, k=ORDER):
    c = "\x01" * (ORDER - 1) + text
    return [c[i:i + ORDER] for i in range(len(text))]


def plain_model(trusted):
    """p(gram) by interpolated modified Kneser-Ney, as the module bounds its discounts."""
    counts = {ORDER: Counter(g for t in trusted for g in grams(t))}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, spare, total = {}, {}, {}
    for k, c in counts.items():
        n = [0] + [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        cuts[k] = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i - 0.05) if n[i] else 0.5 * i for i in (1, 2, 3)]
        spare[k], total[k] = defaultdict(float), Counter()
        for g, v in c.items():
            spare[k][g[:-1]] += cuts[k][min(v, 3) - 1]
            total[k][g[:-1]] += v

    def p(g):
        k = len(g)
        below = p(g[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        if not total[k][g[:-1]]:
            return below
        v = counts[k].get(g, 0)
        held = v - cuts[k][min(v, 3) - 1] if v else 0.0
        return held / total[k][g[:-1]] + spare[k][g[:-1]] / total[k][g[:-1]] * below

    return p


def fixture(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "é", "ab"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25))), rng.choice(["en", "fr"])) for i in range(80)]
    rows += [(100, "zzzz qqq 777", "en"), (101, None, "en"), (102, "", None)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint")


@pytest.mark.parametrize("far", [False, True])
def test_perplexity_equals_the_plain_model(spark, monkeypatch, far):
    rows, docs, trusted = fixture(spark)
    if far:
        monkeypatch.setattr(quality, "fits_broadcast", lambda *a, **k: False)
    counted = {r["doc_id"] for r in trusted.where(quality.fold(folds=2) == 0).collect()}
    p = plain_model([t for i, t, _ in rows if i in counted])
    got = {r["doc_id"]: r["perplexity"] for r in score_quality(docs, trusted).collect()}
    assert set(got) == {i for i, *_ in rows}
    for i, text, _ in rows:
        if not text:
            assert got[i] is None
        else:
            want = math.exp(-sum(math.log(p(g)) for g in grams(text)) / len(text))
            assert got[i] == pytest.approx(want, rel=1e-9), (i, text)


def test_no_trusted_text_rejects_only_texts_without_words(spark):
    rows, docs, trusted = fixture(spark)
    kept = {r["doc_id"]: r["kept"] for r in score_quality(docs, trusted.limit(0)).collect()}
    assert all(kept[i] == bool(t) for i, t, _ in rows)


def test_labelled_documents_of_the_small_table(spark):
    """Rows labelled good that the model has not counted are left alone; most labelled bad go."""
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    scored = score_quality(table(spark, sf, "documents"), labels.where("quality = 1")).join(labels, "doc_id")
    held = scored.where(~((F.col("quality") == 1) & (quality.fold(folds=2) == 0)))
    share = {r["quality"]: r["s"] for r in held.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("s")).collect()}
    assert share[1] >= 0.98 and share[0] <= 0.3
