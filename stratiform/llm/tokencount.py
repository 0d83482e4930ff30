"""Token counts of a byte-fallback BPE piece model by rank-synchronous array merging.

A text is cut into pre-tokens (a run of blanks with the word that follows); no piece
of the vocabulary crosses such a cut, so their counts add up.  The pre-tokens of a
batch that are not known yet lie side by side in ragged numpy arrays; in every round
each sequence applies its own lowest-rank pair, all sequences at once, until no pair
is left, and the surviving symbols are counted.  Where several places of a sequence
hold its lowest-rank pair they merge in one round, left to right, unless that would
create a pair which the sequential rule prefers; then only the leftmost does.  Very
long pre-tokens follow the same order with a heap, in n log n.

Defined results: NULL text counts as empty (0 bytes, 0 tokens); every row gives one
row, repeated rows too; NULL ids stay NULL; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 400_000  # pre-tokens remembered by a Python worker
LONG = 512  # symbols above which a pre-token is merged on its own
CHUNK_CHARS = 1 << 20  # text handled at once
_NONE = np.iinfo(np.int32).max
_models: dict[str, "PieceModel"] = {}


class PieceModel:
    """The merge table of a piece model: every way to join two symbols into a piece."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores = [], []
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                pieces.append(sp.id_to_piece(i))
                scores.append(sp.get_score(i))
        self._init(pieces, scores)

    def _init(self, pieces: list[str], scores: list[float]) -> None:
        symbol = {p: i for i, p in enumerate(pieces)}
        self.known = len(pieces)
        for p in pieces:
            for ch in p:
                symbol.setdefault(ch, len(symbol))
        self.symbol, self.size = symbol, len(symbol) + 1
        level = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        keys, ranks, merged = [], [], []
        for p, s in zip(pieces, scores):
            for cut in range(1, len(p)):
                a, b = symbol.get(p[:cut]), symbol.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    ranks.append(level[s])
                    merged.append(symbol[p])
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array(ranks, dtype=np.int32)[order]
        self.merged = np.array(merged, dtype=np.int32)[order]
        in_pieces = {ch for p in pieces if len(p) > 1 for ch in p}
        self.splits = not any(re.search("[^▁]▁", p) for p in pieces)
        self.newline_alone = "\n" not in in_pieces
        self.words = re.compile(" *[^ \n]+| +" if self.newline_alone else " *[^ ]+| +")
        self.cache: dict[str, int] = {}

    def bytes_of(self, ch: str) -> int:
        """Tokens of a character that joined nothing: itself, or its UTF-8 bytes."""
        return 1 if self.symbol.get(ch, self.known) < self.known else len(ch.encode("utf-8", "surrogatepass"))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of every pair (none: the largest int) and the symbol it makes."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], -1)

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text.replace("▁", " ")
        return self.words.findall(text) if self.splits else [text]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of every text."""
        cut = [self.units(t) for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        get = self.cache.get
        new = list({u for us in cut for u in us if u not in self.cache})
        if new:
            self.cache.update(zip(new, self.merge(new)))
        alone = self.bytes_of("\n") if self.newline_alone and self.splits else 0
        return [sum(map(get, us)) + (t.count("\n") * alone if alone else 0) for us, t in zip(cut, texts)]

    def merge(self, units: list[str]) -> list[int]:
        out = [0] * len(units)
        short = []
        for i, u in enumerate(units):
            if len(u) > LONG:
                out[i] = self.merge_long(u.replace(" ", "▁"))
            else:
                short.append(i)
        for k in range(0, len(short), 50_000):
            some = short[k:k + 50_000]
            for i, c in zip(some, self.merge_short([units[i].replace(" ", "▁") for i in some]).tolist()):
                out[i] = c
        return out

    def merge_short(self, units: list[str]) -> np.ndarray:
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        chars = "".join(units)
        table = {c: (self.symbol.get(c, self.size - 1), self.bytes_of(c)) for c in set(chars)}
        sym = np.fromiter((table[c][0] for c in chars), np.int32, len(chars))
        cost = np.fromiter((table[c][1] for c in chars), np.int32, len(chars))
        seq = np.repeat(np.arange(len(units)), lengths)
        total = np.zeros(len(units), dtype=np.int64)
        while len(sym):
            inside = np.empty(len(sym), dtype=bool)  # a pair starts here
            inside[:-1] = seq[1:] == seq[:-1]
            inside[-1] = False
            rank = np.full(len(sym), _NONE, dtype=np.int32)
            made = np.full(len(sym), -1, dtype=np.int32)
            at = np.flatnonzero(inside)
            rank[at], made[at] = self.pairs(sym[at], sym[at + 1])
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            size = np.diff(np.r_[first, len(sym)])
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == _NONE
            if done.any():  # no pair left: count the symbols and leave
                total[seq[first[done]]] = np.add.reduceat(cost, first)[done]
                stay = np.repeat(~done, size)
                sym, cost, seq, rank, made = sym[stay], cost[stay], seq[stay], rank[stay], made[stay]
                lowest, size = lowest[~done], size[~done]
                if not len(sym):
                    break
            low = np.repeat(lowest, size)
            hit = rank == low
            # in a run of neighbouring hits every other one can merge, from the left
            idx = np.arange(len(sym))
            start = hit & ~np.r_[False, hit[:-1]]
            run = np.maximum.accumulate(np.where(start, idx, 0))
            chosen = hit & ((idx - run) % 2 == 0)
            new, keep = self._apply(sym, made, chosen)
            bad = self._preferred(sym, seq, new, keep, chosen, low)
            if bad.size:
                wrong = np.isin(seq, bad)
                leftmost = np.zeros(len(sym), dtype=bool)
                at = np.flatnonzero(chosen & wrong)
                leftmost[at[np.r_[True, seq[at][1:] != seq[at][:-1]]]] = True
                chosen = np.where(wrong, leftmost, chosen)
                new, keep = self._apply(sym, made, chosen)
            cost = np.where(chosen, 1, cost)[keep]
            sym, seq = new[keep], seq[keep]
        return total

    @staticmethod
    def _apply(sym, made, chosen):
        keep = np.ones(len(sym), dtype=bool)
        keep[1:] = ~chosen[:-1]
        return np.where(chosen, made, sym), keep

    def _preferred(self, sym, seq, new, keep, chosen, low) -> np.ndarray:
        """Sequences in which merging all places at once makes a pair not ranked after the merged one."""
        at = np.flatnonzero(keep)
        after, owner, merged, limit = new[at], seq[at], chosen[at], low[at]
        same = owner[1:] == owner[:-1]
        touch = np.flatnonzero(same & (merged[1:] | merged[:-1]))
        rank, _ = self.pairs(after[touch], after[touch + 1])
        bad = owner[touch[rank <= limit[touch]]]
        place = np.flatnonzero(chosen[:-2]) if len(sym) > 2 else np.empty(0, dtype=np.int64)
        place = place[seq[place] == seq[place + 2]]  # the right neighbour as it was
        rank, _ = self.pairs(new[place], sym[place + 2])
        return np.unique(np.r_[bad, seq[place[rank <= low[place]]]])

    def merge_long(self, text: str) -> int:
        """The same merges, one by one from a heap of (rank, place)."""
        n = len(text)
        sym = np.array([self.symbol.get(c, self.size - 1) for c in text], dtype=np.int64)
        rank, made = self.pairs(sym[:-1], sym[1:])
        heap = [(int(rank[i]), i, int(sym[i]), int(sym[i + 1]), int(made[i])) for i in np.flatnonzero(rank != _NONE)]
        heapq.heapify(heap)
        sym = sym.tolist()
        cost = [self.bytes_of(c) for c in text]
        prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]

        def push(i, j):
            key = sym[i] * self.size + sym[j]
            at = int(np.searchsorted(self.keys, key))
            if at < len(self.keys) and self.keys[at] == key:
                heapq.heappush(heap, (int(self.ranks[at]), i, sym[i], sym[j], int(self.merged[at])))

        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], cost[i], cost[j], sym[j] = m, 1, 0, -2
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
                push(i, nxt[i])
            if prev[i] >= 0:
                push(prev[i], i)
        return sum(cost)


def _model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and whether n_tokens exceeds ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            ids, size, tokens = batch.column(0), [], []
            some: list[str] = []
            chars = 0
            for t in batch.column(1):
                text = t.as_py() or ""
                size.append(len(text.encode()))
                some.append(text)
                chars += len(text)
                if chars >= CHUNK_CHARS:
                    tokens += model.counts(some)
                    some, chars = [], 0
            tokens += model.counts(some)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = kept.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
