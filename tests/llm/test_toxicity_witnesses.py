"""Witnesses of the toxicity model in samples full of copies."""

import random

from stratiform.llm.toxicity import score_toxicity

WORDS = ["stone", "river", "green", "walks", "table", "house", "quiet", "paper", "winter", "silver"]


def scores(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: r for r in score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}


def test_copies_do_not_raise_the_bar(spark):
    rng = random.Random(4)
    plain = lambda: [rng.choice(WORDS) for _ in range(30)]
    rows, labels = [], []
    copied = " ".join([*plain(), "nitwit", *plain()])
    for i in range(2600):
        if i < 2000:
            text = copied
        else:
            words = plain()
            if i < 2014:
                words[rng.randrange(1, 29)] = "scoundrel"
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(i < 2014)))
    rows += [(9000, "green scoundrel table"), (9001, "green table house")]
    out = scores(spark, rows, labels)
    assert out[9000].predicted == 1 and out[9001].predicted == 0


def test_leaning_units_are_trained_on_without_a_significant_one(spark):
    rows = [(i, f"{WORDS[i % 10]} {WORDS[i // 10 % 10]} quiet") for i in range(60)]
    rows += [(100, "stone scoundrel river"), (103, "a scoundrel walks")]
    out = scores(spark, [*rows, (900, "scoundrel")], [(i, int(i >= 100)) for i, _ in rows])
    assert out[900].predicted == 1 and out[0].predicted == 0
