"""The methods against brute force."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stratiform.llm.components import connected_components
from stratiform.llm.licenses import Automaton
from stratiform.llm.packing import differencing, pack_block
from stratiform.llm.warc import LoserTree


@given(st.lists(st.integers(1, 1024), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_blocks_stay_within_capacity(sizes):
    place = pack_block(sizes, 1024)
    fill = np.bincount(place, weights=sizes)
    assert len(place) == len(sizes) and fill.max() <= 1024


def test_differencing_balances():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 1000) for _ in range(200)]
    fill = np.bincount(differencing(sizes, 10), weights=sizes, minlength=10)
    assert fill.sum() == sum(sizes) and fill.max() - fill.min() < 0.01 * fill.mean()


@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
@settings(max_examples=80, deadline=None)
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_automaton_regions():
    a = Automaton("[[please]] give {{2}} to me")
    accept = lambda s: a.run([w.encode() for w in s.split()], 0)[0]
    assert accept("please give it to me") == 5 and accept("give all of to me now") == 5
    assert accept("give to me") == 3 and accept("give one two three to me") == -1 and accept("please take to me") == -1


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(1000, 1040)]
    root = list(range(2000))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    out = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(out.get(i, i) == root[i] for i in range(2000))
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
