"""The subsequence kernel against plain sums, and the classifier on rows it has not seen."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratiform.llm import toxicity
from stratiform.llm.common import table
from stratiform.llm.toxicity import DECAY, LONGEST, SPAN, Kernel, score_toxicity


def features(word):
    out = defaultdict(float)
    for i in range(len(word)):
        for j in range(i + 1, len(word)):
            for k in range(j + 1, min(len(word), i + SPAN)):
                out[word[i], word[j], word[k]] += DECAY ** (k - i + 1)
    return out


def length(word):
    return sum(DECAY ** (2 * (k - i + 1)) for i in range(len(word)) for j in range(i + 1, len(word))
               for k in range(j + 1, min(len(word), i + SPAN))) ** 0.5


def test_kernel_is_the_sum_over_subsequences():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, LONGEST + 1))) for _ in range(60)]
    landmarks = [w for w in words if len(w) >= 3][:12]
    got = Kernel(landmarks, DECAY)(words)
    for i, w in enumerate(words):
        fw, nw = features(w), length(w)
        for j, z in enumerate(landmarks):
            fz = features(z)
            want = sum(v * fz.get(k, 0.0) for k, v in fw.items()) / (nw * length(z)) if nw else 0.0
            assert got[i, j] == pytest.approx(want, abs=1e-9)
    weights = np.array([rng.random() for _ in landmarks])
    assert np.allclose(Kernel(landmarks, DECAY).weighted(words, weights), got @ weights)


def test_held_out_rows(spark):
    """Learnt from two thirds of the labelled rows, judged on the rest."""
    sf = "/root/testdata/sf0.1"
    scored = score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).where("held_out").join(table(spark, sf, "labels"), "doc_id")
    found = {r["toxic"]: r["s"] for r in scored.groupBy("toxic").agg(F.avg("predicted").alias("s")).collect()}
    assert found[1] >= 0.9 and found[0] <= 0.02


def test_a_task_holds_the_units_of_some_texts_at_a_time(monkeypatch):
    """A batch of many texts gives its units in parts, the same ones; all at once took hundreds of MB of a worker."""
    rng = random.Random(5)
    texts = [None if i % 17 == 0 else " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(0, 300))) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts), pa.array([i % 2 for i in range(300)])], ["doc_id", "text", "toxic"])
    monkeypatch.setattr(toxicity, "CHUNK", 10_000, raising=False)
    parts = list(toxicity._split(iter([batch])))
    assert len(parts) > 10 and max(p.num_rows for p in parts) < 10_000
    got = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    assert got == [(i, i % 2, u, c) for i, t in enumerate(texts) for u, c in toxicity.units(t or "").items()]
