"""Phrases whose words stand together more often than their parts would let expect.

Counting is by multikey three-way quicksort of suffix pointers.  Every word that begins a run of
frequent words is a suffix, cut at ``DEPTH`` words or at the end of the run.  Suffixes are routed globally by
their leading words to buckets; a bucket sorts its suffixes by one word at a time into
smaller, equal and larger ones.  The size of the equal partition at a depth is the count of the phrase that leads
to it, and a partition below ``least`` is abandoned, since it can hold no frequent phrase.

Three passes over the texts and joins of small tables:

1. census: occurrences of every word per language, merged map-side; texts are then read as codes of words, those of
   infrequent words end a run (when the frequent words are too many to broadcast, none does,
   and the buckets alone abandon them).
2. suffixes: each task sorts and merges equal suffixes, so copies travel as a weight, and sends one packed
   array per bucket.  A bucket is chosen by the leading words up to the first that is not
   hot (two at least), hot being a word with more than ``hot_rows`` occurrences, so no bucket
   grows with a common word or word pair.  Phrases of hot words alone have their suffixes in several
   buckets, so their counts are summed in the task and sent as totals.
3. buckets: the quicksort.

Scores, the drop rule and the ranking are joins and aggregates in decimals wide enough to be exact.

Defined cases: NULL text is empty; a NULL language is ``und``; NULL ids count like others (ids are not read);
repeated rows count each time; ties go to the smaller phrase in byte order, and a language with fewer phrases
than asked for gives those it has; long texts are read whole, in blocks; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import freed, staged
from stratiform.llm.texthash import mix
from stratiform.llm.wordcodes import Splitter, signed, texts
from stratiform.operators.joins import BROADCAST_MAX_BYTES, fits_broadcast, sized_join, skew_safe_join

DEPTH = 5
LEAST = 100
TOP = 2_000
FREQUENT_MOST = 2_000_000  # frequent words sent to every task; beyond it all words travel
HOT_WORDS_MOST = 4_000_000  # hot words sent to every task
WORDS = 1 << 20  # words sorted at once in a task of the second pass
BUCKET_ROWS = 1_000_000  # occurrences meant for one bucket
BLANKS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
END, TOTAL = 0, 1  # marks in place of a word: the run ends here; the row is the sum of a phrase of hot words
_SALTS = 64


def _language_code(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little")


def _coded(batch: pa.RecordBatch, split: Splitter, seed: int):
    """(raw text, words, code of each with the language in it, owner, languages) of a few texts at a time."""
    for part in texts(batch.column(1)):
        langs = batch.column(0)[part.rows.start:part.rows.stop].to_pylist()
        words = split.words(part.data)
        owner = np.searchsorted(part.begin, words.start, side="right") - 1
        codes = {x: _language_code(x, seed) for x in set(langs)}
        own = np.array([codes[x] for x in langs], dtype=np.uint64)
        code = mix(words.code ^ own[owner])
        code[code <= TOTAL] += np.uint64(2)
        yield part, words, code, owner, langs


def _census(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    split = Splitter(BLANKS, BREAKS, lower=True, seed=seed)
    for batch in batches:
        for part, words, code, owner, langs in _coded(batch, split, seed):
            raw = part.data.tobytes().lower()
            known, at, n = np.unique(code, return_index=True, return_counts=True)
            spelt = [raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in owner[at].tolist()], pa.string()), signed(known), pa.array(spelt, pa.binary()), pa.array(n)],
                ["lang", "code", "word", "n"])


def _runs_of(columns: list[np.ndarray], depth: int) -> np.ndarray:
    """Where, in sorted rows, the first ``depth`` columns differ from the row before."""
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[:1] = True
    for c in columns[:depth]:
        fresh[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(fresh)


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _symbols(code: np.ndarray, frequent: np.ndarray | None) -> np.ndarray:
    """Codes as they travel: of known frequent words the place among them, past the marks."""
    if frequent is None:
        return code
    return (np.searchsorted(frequent, code) + TOTAL + 1).astype(np.uint32)


def _merged(code: np.ndarray, reach: np.ndarray, hot: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct suffixes (one array per depth), their numbers and the number of leading words that choose the bucket."""
    at = np.flatnonzero(reach >= 2)
    padded = np.r_[code, np.zeros(DEPTH, dtype=code.dtype)]
    columns = [np.where(reach[at] > d, padded[at + d], code.dtype.type(END)) for d in range(DEPTH)]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    begins = _runs_of(columns, DEPTH)
    n = np.diff(np.r_[begins, len(order)])
    columns = [c[begins] for c in columns]
    led = np.ones(len(begins), dtype=bool)
    lead = np.full(len(begins), 1)
    totals, sums = [[] for _ in range(DEPTH)], []
    for d in range(DEPTH):
        led &= _is_in(columns[d], hot)  # all words so far are hot
        lead += led
        if 1 <= d < DEPTH - 1 and led.any():
            some = [c[led] for c in columns[:d + 1]]
            first = _runs_of(some, d + 1)
            sums.append(np.add.reduceat(n[led], first))
            for k in range(DEPTH):
                fill = TOTAL if k == d + 1 else END
                totals[k].append(some[k][first] if k <= d else np.full(len(first), fill, dtype=code.dtype))
    lead = np.clip(lead, 2, DEPTH)
    if sums:
        lead = np.r_[lead, np.full(sum(map(len, sums)), DEPTH)]
        columns = [np.concatenate([c, *t]) for c, t in zip(columns, totals)]
        n = np.concatenate([n, *sums])
    return columns, n, lead


def _routed(columns: list[np.ndarray], lead: np.ndarray, buckets: int) -> np.ndarray:
    key = np.zeros(len(lead), dtype=np.uint64)
    for d, c in enumerate(columns):
        key = np.where(lead > d, mix(key * np.uint64(31) + c.astype(np.uint64)), key)
    return (key % np.uint64(buckets)).astype(np.int64)


def _suffixes(batches: Iterator[pa.RecordBatch], seed: int, frequent: np.ndarray | None, hot: np.ndarray,
              buckets: int) -> Iterator[pa.RecordBatch]:
    split = Splitter(BLANKS, BREAKS, lower=True, seed=seed)
    kind = _symbols(hot, frequent).dtype
    hot = _symbols(hot, frequent)

    def out(codes: list[np.ndarray], reaches: list[np.ndarray]) -> pa.RecordBatch:
        columns, n, lead = _merged(np.concatenate(codes), np.concatenate(reaches), hot)
        bucket = _routed(columns, lead, buckets)
        order = np.argsort(bucket, kind="stable")
        begins = _runs_of([bucket[order]], 1)
        packed = []
        for a, b in zip(begins, np.r_[begins[1:], len(order)]):
            rows = order[a:b]
            packed.append(np.concatenate([*(c[rows] for c in columns), n[rows].astype(kind)]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(bucket[order][begins]), pa.array(packed, pa.binary())], ["bucket", "packed"])

    codes, reaches, size = [], [], 0
    for batch in batches:
        for part, words, code, owner, _ in _coded(batch, split, seed):
            stays = np.ones(len(code), dtype=bool) if frequent is None else _is_in(code, frequent)
            joined = (owner[1:] == owner[:-1]) & (words.piece[1:] == words.piece[:-1]) & stays[1:] & stays[:-1]
            ends = np.r_[np.flatnonzero(~joined), len(code) - 1]  # last word of every run
            reach = ends[np.searchsorted(ends, np.arange(len(code)))] - np.arange(len(code)) + 1 if len(code) else code.astype(np.int64)
            for lo in range(0, len(code), WORDS):  # a long text is handed on in parts; the words after a part are repeated
                hi = min(lo + WORDS, len(code))
                some = np.zeros(hi - lo + DEPTH, dtype=np.int64)
                some[:hi - lo] = np.minimum(reach[lo:hi], DEPTH)
                tail = _symbols(code[lo:hi + DEPTH], frequent)
                codes.append(np.r_[tail, np.zeros(hi - lo + DEPTH - len(tail), dtype=kind)])
                reaches.append(some)
                size += hi - lo
                if size >= WORDS:
                    yield out(codes, reaches)
                    codes, reaches, size = [], [], 0
    if size:
        yield out(codes, reaches)


def frequent_prefixes(columns: list[np.ndarray], n: np.ndarray, hot: np.ndarray, least: int) -> Iterator[tuple[list[int], int]]:
    """(words, count) of the phrases of two words or more whose suffixes are all here and number ``least`` or more.

    Multikey three-way quicksort: a partition is split by the word at its depth into smaller, equal and larger ones; the
    equal one goes on at the next depth.  A partition of fewer suffixes than ``least`` is abandoned.
    """
    is_hot = [_is_in(c, hot) for c in columns]
    work = [(np.arange(len(n)), 0, True)]  # suffix pointers, depth, whether all words before are hot
    while work:
        at, depth, led = work.pop()
        if n[at].sum() < least:
            continue
        words = columns[depth][at]
        pivot = np.sort(words[[0, len(words) // 2, -1]])[1]
        equal = at[words == pivot]
        work.append((at[words < pivot], depth, led))
        work.append((at[words > pivot], depth, led))
        if pivot == END:
            continue
        count = int(n[equal].sum())
        if pivot == TOTAL:
            if count >= least:
                yield [int(columns[d][equal[0]]) for d in range(depth)], count
            continue
        if count < least:
            continue
        all_hot = led and bool(is_hot[depth][equal[0]])
        if depth >= 1 and (not all_hot or depth == DEPTH - 1):
            yield [int(columns[d][equal[0]]) for d in range(depth + 1)], count
        if depth + 1 < DEPTH:
            work.append((equal, depth + 1, all_hot))


def _counted(batches: Iterator[pa.RecordBatch], frequent: np.ndarray | None, hot: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    hot = _symbols(hot, frequent)

    def out(arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if arrays:
            *columns, n = np.concatenate(arrays, axis=1)
            found = list(frequent_prefixes(columns, n.astype(np.int64), hot, least))
            spread = [np.array(words, dtype=np.uint64) for words, _ in found]
            if frequent is not None:
                spread = [frequent[(words - np.uint64(TOTAL + 1)).astype(np.int64)] for words in spread]
            codes = [words.view(np.int64).tolist() for words in spread]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.list_(pa.int64())), pa.array([c for _, c in found], pa.int64())], ["codes", "a"])

    here, arrays = None, []
    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != here:
                yield from out(arrays)
                here, arrays = bucket, []
            arrays.append(np.frombuffer(packed.as_py(), dtype=hot.dtype).reshape(DEPTH + 1, -1))
    yield from out(arrays)


def _codes_of(df: DataFrame) -> np.ndarray:
    """Sorted codes of a table whose size its caller has checked."""
    return np.sort(df.select("code").toArrow().column(0).to_numpy().view(np.uint64))


def _join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], how: str, max_bytes: int) -> DataFrame:
    """Broadcast join under the bound, beyond it a shuffle join in which a hot left key is salted."""
    if fits_broadcast(right, max_bytes):
        right = F.broadcast(right)
        return left.join(right, reduce(lambda a, b: a & b, [left[x] == right[y] for x, y in zip(left_keys, right_keys)]), how)
    return skew_safe_join(left, right, left_keys, right_keys, how)


def word_census(docs: DataFrame, seed: int = 1) -> tuple[DataFrame, int]:
    """(lang, code, word, n) of every word, and the seed of its codes, under which no two words share one."""
    while True:
        census = staged(docs.mapInArrow(lambda b, s=seed: freed(_census(b, s)), "lang string, code bigint, word binary, n bigint")
                        .groupBy("lang", "code", "word").agg(F.sum("n").alias("n")), "census")
        if census.groupBy("code").agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty():
            return census, seed
        seed += 1


def phrase_counts(docs: DataFrame, census: DataFrame, seed: int, least: int = LEAST, frequent_most: int = FREQUENT_MOST,
                  hot_rows: int | None = None) -> DataFrame:
    """(codes, a): every phrase of two to five words with ``least`` occurrences or more."""
    total, frequent_n = census.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") >= least, 1))).first()
    hot_rows = hot_rows or max(20_000, min(total // 500, 5_000_000), total // HOT_WORDS_MOST)
    hot = _codes_of(census.where(F.col("n") > hot_rows))
    frequent = _codes_of(census.where(F.col("n") >= least)) if frequent_n <= frequent_most else None
    buckets = max(512, total // BUCKET_ROWS)
    return (docs.mapInArrow(lambda b: freed(_suffixes(b, seed, frequent, hot, buckets)), "bucket bigint, packed binary")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(lambda b: freed(_counted(b, frequent, hot, least)), "codes array<bigint>, a bigint"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, frequent_most: int = FREQUENT_MOST, hot_rows: int | None = None,
                 max_bytes: int = BROADCAST_MAX_BYTES, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    census, seed = word_census(docs)
    phrases = staged(phrase_counts(docs, census, seed, least, frequent_most, hot_rows), "phrases")
    words = census.where(F.col("n") >= least).select("lang", "code", F.col("word").cast("string").alias("word"), F.col("n").alias("f"))
    sizes = census.groupBy("lang").agg(F.sum("n").alias("n"))

    size = F.size("codes")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(
        F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("codes", i, k))))
    covered = (phrases.where(size > 2).select(F.explode(inner).alias("codes"), "a")
               .groupBy("codes").agg(F.max("a").alias("longer")).select(F.col("codes").alias("of"), "longer"))
    open_ = (_join(phrases, covered, ["codes"], ["of"], "left", max_bytes)
             .where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).select("codes", "a"))
    open_ = staged(open_, "open-phrases")

    known = staged(phrases.select("codes", "a").unionByName(words.select(F.array("code").alias("codes"), F.col("f").alias("a")))
                   .select(F.col("codes").alias("of"), F.col("a").alias("f")), "known-phrases")
    cuts = open_.select("codes", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("codes", "a", "k", F.slice("codes", F.lit(1), F.col("k")).alias("first"),
                       F.slice("codes", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = _join(cuts, known, ["first"], ["of"], "inner", max_bytes).withColumnRenamed("f", "l").drop("of")
    cuts = _join(cuts, known, ["rest"], ["of"], "inner", max_bytes).withColumnRenamed("f", "r").drop("of")

    named = words.select(F.col("code").alias("of"), "word", F.col("lang").alias("language"))
    spelt = (_join(open_.select("codes", F.posexplode("codes").alias("pos", "code")), named, ["code"], ["of"], "inner", max_bytes)
             .groupBy("codes").agg(F.min("language").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))
             .select("codes", "lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase")))
    spelt = sized_join(spelt, sizes, "lang", max_bytes=max_bytes)
    wide = "decimal(38,0)"
    scored = cuts.join(spelt, "codes").selectExpr(
        "lang", "codes", "phrase", "a", "k", "l", "r", "n",
        f"CAST(CAST(CAST(1000 AS decimal(4,0)) * CAST(a AS decimal(15,0)) * CAST(n AS decimal(18,0)) AS {wide}) "
        f"div CAST(CAST(l AS decimal(18,0)) * CAST(r AS decimal(18,0)) AS {wide}) AS bigint) AS score")
    best = (scored.groupBy("codes").agg(F.min(F.struct("score", "k", "lang", "phrase", "a", "l", "r", "n")).alias("b"))
            .select("codes", "b.*"))
    # the first of each language, twice: within parts of it, then among the firsts of the parts
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").cast("binary").asc()]
    part = F.pmod(F.xxhash64("codes"), F.lit(_SALTS))
    some = (best.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= top))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
