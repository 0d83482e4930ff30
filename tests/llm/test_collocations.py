"""Collocations against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from stratiform.llm import collocations as C


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, least, top):
    out = []
    for lang in {x or "und" for x, _ in rows}:
        f, n = Counter(), 0
        for x, text in rows:
            if (x or "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, 6):
                    f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for p, a in cand.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        covered[p[i:j]] = max(covered[p[i:j]], a)
        scored = []
        for p, a in cand.items():
            if covered[p] >= a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def fixture():
    rng = random.Random(2)
    words = ["the", "of", "a", "Ün", "x-1", "Alpha", "beta", "new", "york", "city", "in"]
    weights = [30, 20, 10, 3, 3, 5, 5, 2, 2, 2, 9]
    rows = []
    for _ in range(150):
        text = ""
        for _ in range(rng.randrange(0, 60)):
            text += rng.choice(["New York city", "in the", "a  b\ta b a b"]) if rng.random() < 0.1 else rng.choices(words, weights)[0]
            text += rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "? "])
        rows.append((rng.choice(["en", "fr", None, "und"]), text))
    rows += [("en", "same words over and over again here")] * 40
    rows += [("fr", None), (None, ""), ("es", "only once"), ("de", " .,;\n")]
    return rows


def found(spark, rows, least, top, **kw):
    docs = spark.createDataFrame([(i, x, t, 1, "w") for i, (x, t) in enumerate(rows)],
                                 "doc_id bigint, lang string, text string, codes int, word string").repartition(3)
    return sorted(tuple(r) for r in C.collocations(docs, least, top, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"hot_rows": 30}, {"frequent_most": 0}, {"frequent_most": 0, "hot_rows": 12, "max_bytes": 0}])
def test_equal_to_plain_counts(spark, kw):
    rows = fixture()
    assert found(spark, rows, 6, 40, **kw) == plain(rows, 6, 40)


def test_small_blocks_keep_phrases_whole(spark, monkeypatch):
    """One long text, coded and sorted in parts smaller than it."""
    from functools import partial

    import pyarrow as pa

    rng = random.Random(4)
    text = " ".join(rng.choice("abcdefg") for _ in range(3000))
    monkeypatch.setattr("stratiform.llm.wordcodes.BLOCK", 64)
    monkeypatch.setattr(C, "WORDS", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text.encode()], pa.binary())], ["lang", "text"])
    code = {}
    for out in C._census(iter([batch]), 1):
        code.update({r["code"]: r["word"].decode() for r in out.to_pylist()})
    assert sorted(code.values()) == list("abcdefg")
    none = np.zeros(0, dtype=np.uint64)
    rows = sorted((r["bucket"], r["packed"]) for out in C._suffixes(iter([batch]), 1, None, none, 5) for r in out.to_pylist())
    again = pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows]), pa.array([p for _, p in rows], pa.binary())], ["bucket", "packed"])
    got = {tuple(code[c] for c in r["codes"]): r["a"] for out in C._counted(iter([again]), None, none, 3) for r in out.to_pylist()}
    w = text.split()
    want = Counter(tuple(w[i:i + k]) for k in range(2, 6) for i in range(len(w) - k + 1))
    assert got == {p: a for p, a in want.items() if a >= 3}


def test_codes_shared_by_two_words_are_given_again(spark, monkeypatch):
    from pyspark.sql import functions as F
    calls = []

    def clashing(df, tag):
        calls.append(tag)
        return df.unionByName(df.limit(1).withColumn("word", F.lit(b"clash"))) if len(calls) == 1 else df

    monkeypatch.setattr(C, "staged", clashing)
    docs = spark.createDataFrame([("en", "a b c a")], "lang string, text string").selectExpr("lang", "CAST(text AS binary) AS text")
    census, seed = C.word_census(docs)
    assert seed == 2 and census.agg(F.sum("n")).first()[0] == 4


def test_exact_scores_beyond_64_bits(spark):
    """1000 * a * n passes 2^63 for counts that a corpus can have."""
    a, n, l, r = 10**9, 10**13, 3 * 10**9, 7 * 10**9
    wide = "decimal(38,0)"
    got = spark.sql(f"""SELECT CAST(CAST(CAST(1000 AS decimal(4,0)) * CAST({a} AS decimal(15,0)) * CAST({n} AS decimal(18,0)) AS {wide})
        div CAST(CAST({l} AS decimal(18,0)) * CAST({r} AS decimal(18,0)) AS {wide}) AS bigint) AS s""").first()["s"]
    assert got == 1000 * a * n // (l * r)


def test_empty_table(spark):
    assert found(spark, [], 2, 10) == []
