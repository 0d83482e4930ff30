"""Filter interactions against sets of row numbers."""

import itertools
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from stratiform.llm import filteraudit
from stratiform.llm.filteraudit import common, failed_by_text, filter_interactions, gallop, union

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ids = st.lists(st.integers(0, 60), unique=True).map(sorted)


@settings(max_examples=300, deadline=None)
@given(st.lists(ids, max_size=6))
def test_union_is_the_sorted_set(lists):
    assert union(lists) == sorted(set().union(*map(set, lists)))


@settings(max_examples=300, deadline=None)
@given(ids, ids, st.integers(0, 61))
def test_common_and_gallop(a, b, x):
    assert common(a, b) == len(set(a) & set(b))
    assert gallop(a, x, 0) == sum(v < x for v in a)


def plain_bits(text):
    words = WORD.findall(text)
    return ((len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
            + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + 8 * any(c in "#$%&*|" for c in text))


def test_filters_of_one_text():
    rng = random.Random(1)
    texts = ["", "a", "É#", " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i % 100}" for i in range(200)),
             " ".join(f"w{i % 99}" for i in range(200)), "ABC" + "é" * 97, "ABC" + "é" * 98, "a b " * 300]
    texts += ["".join(rng.choice("aB \n\té|") for _ in range(900)) for _ in range(40)]
    texts.append(" ".join(str(i % 400_000) for i in range(500_000)))  # more than one piece
    for text in texts:
        assert failed_by_text(text.encode()) == plain_bits(text)


def plain(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    first = {}
    for doc, _, text in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    parts = {}
    for n, (doc, lang, text) in enumerate(rows):
        bits = plain_bits(text or "") + 16 * (doc is not None and first[text or ""] < doc)
        parts.setdefault(lang or "", []).append((n, bits, doc in good and doc is not None, doc in toxic and doc is not None))
    out = []
    for part, docs in parts.items():
        fails = {f: {n for n, bits, *_ in docs if bits >> i & 1} for i, f in enumerate("ABCDE")}
        every = {n for n, *_ in docs}
        rest, total = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = set()
            for step, f in enumerate(order, 1):
                new = fails[f] - gone
                total[f] += len(new)
                others = set().union(*(fails[o] for o in "ABCDE" if o != f))
                rest.append((part, order, step, len(every) - len(gone | new), len(new), len(fails[f] & gone), len(fails[f] - others),
                             sum(n in new and g for n, _, g, _ in docs), sum(n in new and t for n, _, _, t in docs), f))
                gone |= new
        out += [(*r[:-1], total[r[-1]]) for r in rest]
    return sorted(out)


def fixture():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Aa", "b", "c|", "dd", "e"] if rng.random() < 0.2 else [f"w{i}" for i in range(500)])
                      for _ in range(rng.choice([20, 220, 260]))) for _ in range(60)]
    texts += [" ".join(f"v{rng.randrange(900)}" for _ in range(300)) + tail for tail in ("", " #", " $$") for _ in range(8)]
    rows = [(i * 13 % 211, rng.choice(["en", "fr", None]), rng.choice(texts)) for i in range(200)]
    rows += [(7, "en", "shared id"), (7, "en", "shared id too"), (7, "en", "shared id"), (None, "fr", texts[0]), (None, None, None), (500, "", "")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 211, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id bigint, lang string, text string, part string, bits int").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return sorted(tuple(r) for r in filter_interactions(docs, marks).collect())


def test_equal_to_sets(spark):
    rows, labels = fixture()
    assert audited(spark, rows, labels) == plain(rows, labels)


def test_far_branch_and_small_blocks(spark, monkeypatch):
    rows, labels = fixture()
    monkeypatch.setattr("stratiform.llm.common.fits_broadcast", lambda *a, **k: False)
    assert audited(spark, rows, labels) == plain(rows, labels)


def test_blocks_add_up(monkeypatch):
    import pyarrow as pa
    rng = random.Random(8)
    batch = pa.RecordBatch.from_arrays([pa.array(["a"] * 90 + ["b"] * 40), pa.array([rng.randrange(128) for _ in range(130)], pa.int32())],
                                       ["part", "bits"])

    def sums():
        got = {}
        for out in filteraudit._union_sizes(iter([batch])):
            for r in out.to_pylist():
                key = r["part"], r["subset"]
                got[key] = tuple(x + y for x, y in zip(got.get(key, (0, 0, 0)), (r["docs"], r["good"], r["toxic"])))
        return got

    whole = sums()
    monkeypatch.setattr(filteraudit, "BLOCK", 7)
    assert sums() == whole and whole[("a", -1)][0] == 90


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    rows, _ = fixture()
    assert audited(spark, rows[:20], []) == plain(rows[:20], [])
