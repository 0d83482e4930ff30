"""Insults of fewer than three letters."""

import random

from stratiform.llm.toxicity import score_toxicity

WORDS = ["stone", "river", "green", "walks", "table", "house", "quiet", "paper", "winter", "silver"]


def predicted(spark, insult, asked):
    """The predictions on ``asked`` after learning from 200 texts with ``insult()`` and 400 without."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(WORDS) for _ in range(30)]
        if i % 3 == 0:
            words.insert(rng.randrange(30), insult(rng))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame([*rows, *enumerate(asked, 9000)], "doc_id bigint, text string")
    out = {r.doc_id: r.predicted for r in score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    return [out[9000 + i] for i in range(len(asked))]


def test_insults_of_two_letters(spark):
    assert predicted(spark, lambda rng: "zq", ["green zq table", "green table"]) == [1, 0]
