"""Repeated passages: words covered by a window of words that an earlier document holds too.

Super-k-mer partitioning.  A window is ``window`` consecutive words; its minimiser is the least
hash among its runs of ``MINIMISER`` words.  Consecutive windows with one minimiser travel together
as one packed string (a super-k-mer, n windows in n + window - 1 words) to the bucket of that
minimiser, where the windows are sorted, and equal ones, now neighbours, are counted to the
least document that holds them.

What travels is reduced beforehand.  Per super-k-mer only its place, minimiser and a
128-bit fingerprint are shuffled, and equal ones are merged map-side to their first document.
Only where a minimiser has several different super-k-mers can windows inside them be equal, so only those
are packed, once each, from their first document.  A minimiser with more than ``BUCKET_MOST`` of them
(a line that very many documents hold in different surroundings) sends its windows one by one, by
128-bit fingerprints that merge map-side, so no bucket grows with the input.

Defined cases: a NULL id is no document that others can be compared with, so its text is kept
whole; NULL and empty text have no words; texts with fewer words than a window lose nothing; rows that share an id are
one document (neither is smaller); a row that is repeated gets the same result each
time; all texts are taken whole, in blocks of bounded memory.  A text equal to that of a smaller id loses all words that windows
cover without a comparison (equality by two 64-bit hashes).  Ids are cast to bigint; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import attached, freed, spread_join, staged
from stratiform.llm.texthash import mix
from stratiform.llm.wordcodes import Splitter, powers, signed, texts
from stratiform.operators.joins import sized_join

MINIMISER = 8  # words of a minimiser
BUCKET_MOST = 1_000  # super-k-mers of one minimiser that are sorted in one bucket
SEGMENT = 1 << 18  # words looked at together
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
_KEY = ["doc_id", "t1", "t2"]
_STEP = [int(x) for x in np.random.default_rng(77).integers(1, 1 << 62, 64) * 2 + 1]
_A, _B = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB  # bases of the two fingerprints, odd
_OTHER = np.uint64(0x589965CC75374CC3)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    least, span = values, 1
    while 2 * span <= width:
        least, span = np.minimum(least[:len(least) - span], least[span:]), 2 * span
    rest = width - span
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


class _Prints:
    """128-bit fingerprints of any run of words, from prefix sums."""

    def __init__(self, code: np.ndarray):
        n = len(code)
        self._down = powers(pow(_A, -1, 1 << 64), n), powers(pow(_B, -1, 1 << 64), n)
        self._sums = [np.zeros(n + 1, dtype=np.uint64) for _ in range(2)]
        np.cumsum(code * powers(_A, n), out=self._sums[0][1:])
        np.cumsum(mix(code ^ _OTHER) * powers(_B, n), out=self._sums[1][1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        return [mix((s[last] - s[first]) * d[first] + (last - first).astype(np.uint64)) for s, d in zip(self._sums, self._down)]


def _super_kmers(code: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(first word, number of windows, minimiser, print, print) of the super-k-mers of consecutive words."""
    m = min(MINIMISER, window)
    width = window - m + 1
    if len(code) < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64)
    grams = np.zeros(len(code) - m + 1, dtype=np.uint64)
    for i in range(m):
        grams += code[i:len(code) - m + 1 + i] * np.uint64(_STEP[i % 64])
    least = _sliding_least(mix(grams), width)
    at = np.flatnonzero(owner[:len(least)] == owner[window - 1:])  # windows inside one text
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    begins = np.flatnonzero(fresh)
    within = np.arange(len(at)) - np.repeat(begins, np.diff(np.r_[begins, len(at)]))
    begins = np.flatnonzero(within % width == 0)  # a run of one minimiser is cut where repetition makes it longer
    first, n = at[begins], np.diff(np.r_[begins, len(at)])
    return first, n, least[first], *_Prints(code).of(first, first + n + window - 1)


def _places(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    split = Splitter(BLANKS)
    names = [*_KEY, "start", "n", "mini", "f1", "f2"]
    for batch in batches:
        for part in texts(batch.column(3)):
            words = split.words(part.data)
            before = np.searchsorted(words.start, part.begin)
            owner = np.repeat(np.arange(len(part.begin) - 1), np.diff(before))
            ids = [batch.column(i)[part.rows.start:part.rows.stop] for i in range(3)]
            for lo in range(0, len(owner), SEGMENT):
                hi = min(len(owner), lo + SEGMENT + window - 1)
                first, n, mini, f1, f2 = _super_kmers(words.code[lo:hi], owner[lo:hi], window)
                doc = owner[first + lo]
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(doc)) for c in ids), pa.array(first + lo - before[doc]), pa.array(n.astype(np.int64)),
                     signed(mini), signed(f1), signed(f2)], names)


def _packed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Of every wanted super-k-mer its words as one string, or, in a crowded bucket, the prints of its windows."""
    split = Splitter(BLANKS)
    schema = pa.schema([("mini", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()),
                        ("w1", pa.int64()), ("w2", pa.int64()), ("packed", pa.binary())])
    for batch in batches:
        for i in range(batch.num_rows):
            doc, raw, wanted = (batch.column(c)[i].as_py() for c in range(3))
            data = np.frombuffer(raw + b"\n", dtype=np.uint8)
            words = split.words(data)
            out: list[tuple] = []
            for w in wanted:
                lo, n = w["start"], w["n"]
                hi = lo + n + window - 1
                if not w["crowded"]:
                    text = b" ".join(raw[a:b] for a, b in zip(words.start[lo:hi].tolist(), words.end[lo:hi].tolist()))
                    out.append((w["mini"], w["f1"], w["f2"], doc, -1, 0, 0, text))
                    continue
                first = np.arange(n)
                w1, w2 = (x.view(np.int64).tolist() for x in _Prints(words.code[lo:hi]).of(first, first + window))
                out += [(w["mini"], w["f1"], w["f2"], doc, j, w1[j], w2[j], None) for j in range(n)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _sorted_bucket(rows: list[tuple], window: int) -> Iterator[tuple]:
    """Windows of a bucket's super-k-mers in order; per super-k-mer the windows that a smaller document holds."""
    windows, owner = [], []
    for k, (_, _, _, text) in enumerate(rows):
        ends = np.flatnonzero(np.frombuffer(text + b" ", dtype=np.uint8) == 32)
        begins = np.r_[0, ends[:-1] + 1]
        for a, b in zip(begins[:len(ends) - window + 1].tolist(), ends[window - 1:].tolist()):
            windows.append(text[a:b])
            owner.append(k)
    order = sorted(range(len(windows)), key=windows.__getitem__)
    least = [0] * len(windows)
    lo = 0
    while lo < len(order):
        hi, same = lo + 1, windows[order[lo]]
        while hi < len(order) and windows[order[hi]] == same:
            hi += 1
        doc = min(rows[owner[i]][2] for i in order[lo:hi])
        for i in order[lo:hi]:
            least[i] = doc
        lo = hi
    at = 0
    for k, (f1, f2, doc, _) in enumerate(rows):
        n = 0
        while at + n < len(owner) and owner[at + n] == k:
            n += 1
        early = [j for j in range(n) if least[at + j] < doc]
        at += n
        if early:
            yield f1, f2, early


def _buckets(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("early", pa.list_(pa.int64()))])

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = list(_sorted_bucket(rows, window))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    here, rows = None, []
    for batch in batches:
        for mini, *row in zip(*(batch.column(c).to_pylist() for c in range(5))):
            if mini != here:
                yield from out(rows)
                here, rows = mini, []
            rows.append(tuple(row))
    yield from out(rows)


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    split = Splitter(BLANKS)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(span)), ("kept", pa.binary())])
    for batch in batches:
        for part in texts(batch.column(1)):
            raw = part.data.tobytes()
            words = split.words(part.data)
            before = np.searchsorted(words.start, part.begin).tolist()
            n_words, removed, kept = [], [], []
            rows = slice(part.rows.start, part.rows.stop)
            for k, (copy, spans) in enumerate(zip(batch.column(2)[rows].to_pylist(), batch.column(3)[rows].to_pylist())):
                lo, n = before[k], before[k + 1] - before[k]
                merged: list[list[int]] = [[0, n]] if copy and n >= window else []
                for s in sorted(spans or (), key=lambda s: s["start"]):
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                stay = np.ones(n, dtype=bool)
                for a, b in merged:
                    stay[a:b] = False
                at = np.flatnonzero(stay) + lo
                n_words.append(n)
                removed.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b" ".join(raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())))
            yield pa.RecordBatch.from_arrays([batch.column(0)[rows], pa.array(n_words, pa.int64()), pa.array(removed, pa.list_(span)),
                                              pa.array(kept, pa.binary())], schema=schema)


def repeated_passages(docs: DataFrame, window: int = 50, bucket_most: int = BUCKET_MOST, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, removed (spans of words, merged and in order) and kept (the other words, joined by a blank)."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"),
                        F.col("text").cast("binary").alias("text"))

    distinct = staged(keyed.where("doc_id IS NOT NULL").select(*_KEY).distinct(), "texts")
    firsts = distinct.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id"))
    copies = staged(distinct.join(firsts, _KEY, "left_anti"), "copies")

    place_schema = ", ".join(f"{c} bigint" for c in [*_KEY, "start", "n", "mini", "f1", "f2"])
    places = staged(keyed.where("doc_id IS NOT NULL AND length(text) >= " + str(2 * window - 1))
                    .mapInArrow(lambda b: freed(_places(b, window)), place_schema), "places")
    places = sized_join(places, copies, _KEY, "left_anti")

    contents = staged(places.groupBy("mini", "f1", "f2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
                                                              F.count(F.lit(1)).alias("rows")), "contents")
    crowds = staged(contents.groupBy("mini").agg(F.count(F.lit(1)).alias("n_contents")).where("n_contents > 1"), "crowds")
    shared = staged(spread_join(contents, crowds, ["mini"], "n_contents", "left")
                    .where("first_doc < last_doc OR n_contents IS NOT NULL")
                    .select("f1", "f2", "first_doc", "rows", "n_contents"), "shared")
    seen = staged(spread_join(places, shared, ["f1", "f2"], "rows"), "seen")

    own = seen.where("doc_id = first_doc AND n_contents IS NOT NULL")
    pick = F.min(F.struct(*_KEY, "start", "n", "mini", (F.col("n_contents") > bucket_most).alias("crowded"))).alias("p")
    wanted = (own.groupBy("f1", "f2").agg(pick).select("f1", "f2", "p.*")
              .groupBy(*_KEY).agg(F.collect_list(F.struct("start", "n", "mini", "f1", "f2", "crowded")).alias("wanted")))
    packed = (sized_join(keyed, wanted, _KEY, "inner").select("doc_id", "text", "wanted")
              .mapInArrow(lambda b: freed(_packed(b, window)),
                          "mini bigint, f1 bigint, f2 bigint, doc bigint, at bigint, w1 bigint, w2 bigint, packed binary"))
    packed = staged(packed.dropDuplicates(["f1", "f2", "at"]), "packed")

    sorted_in = (packed.where("packed IS NOT NULL").select("mini", "f1", "f2", "doc", "packed")
                 .repartition("mini").sortWithinPartitions("mini")
                 .mapInArrow(lambda b: freed(_buckets(b, window)), "f1 bigint, f2 bigint, early array<bigint>"))
    single = packed.where("packed IS NULL").select("w1", "w2", "f1", "f2", "at", "doc")
    least = staged(single.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("rows"))
                   .where("rows > 1"), "least")
    one_by_one = (spread_join(single, least, ["w1", "w2"], "rows").where("least < doc")
                  .groupBy("f1", "f2").agg(F.collect_set("at").alias("early")))
    early = staged(sorted_in.unionByName(one_by_one), "early")

    whole = seen.where("doc_id > first_doc").select(*_KEY, "start", (F.col("start") + F.col("n") + window - 1).alias("end"))
    parts = (own.join(early, ["f1", "f2"]).select(*_KEY, "start", F.explode("early").alias("at"))
             .select(*_KEY, (F.col("start") + F.col("at")).alias("start"), (F.col("start") + F.col("at") + window).alias("end")))
    spans = whole.unionByName(parts).groupBy(*_KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    known = staged(spans.select(*_KEY, F.lit(False).alias("copy"), "spans")
                   .unionByName(copies.select(*_KEY, F.lit(True).alias("copy")), allowMissingColumns=True), "known")
    return (attached(keyed, known, _KEY).select("doc_id", "text", "copy", "spans")
            .mapInArrow(lambda b: freed(_kept(b, window)),
                        "doc_id bigint, n_words bigint, removed array<struct<start: bigint, end: bigint>>, kept binary")
            .withColumn("kept", F.col("kept").cast("string")))
