"""How text filters interact: what each removes alone, after others, and on average over all orders.

Five filters judge every document on its whole text.  Per part of the table and per range of ids, the
documents are brought in order of their ids and every filter keeps the sorted posting list of those that fail it,
and so do two lists of marked documents (good, toxic).  The unions of all subsets of the filters are
computed by galloping k-way merges of the lists, the differences and common parts by galloping through
two lists, and only their sizes leave the block.  Sizes of blocks add up, so any order
of the filters follows from sums: a step removes what its union has more than the one before.

A block is at most ``BLOCK`` documents of one part in one task, whatever a part or an id holds,
so no group grows with the input.

Defined cases: NULL text is empty; a NULL part is the empty string; a NULL id is never a copy of another and has no
labels; rows that share an id are several documents, and are no copies of each other; an id
with several label rows has the marks of any of them; ids are cast to bigint; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import itertools
import json
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import attached, freed, staged

FILTERS = "ABCDE"
BLOCK = 1 << 16  # documents whose posting lists are held at once
PIECE = 1 << 20  # bytes of a text split into words at once
_EVERY = (1 << len(FILTERS)) - 1
# fixed values: the thresholds of the five filters
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, MARKS = 200, 50, 3, b"#$%&*|"
_UPPER, _INNER = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def _word_counts(raw: bytes) -> tuple[int, int]:
    """(words, distinct words), split a piece at a time."""
    if len(raw) <= PIECE:
        words = raw.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        while end < len(raw) and raw[end] not in _BLANKS:
            end += 1
        words = raw[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def failed_by_text(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    n, distinct = _word_counts(raw)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    points = len(raw.translate(None, _INNER))
    return ((n < LEAST_WORDS) | (100 * distinct < DISTINCT_PERCENT * n) << 1
            | (100 * upper > UPPER_PERCENT * points) << 2 | (len(raw.translate(None, MARKS)) < len(raw)) << 3)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = pa.array([failed_by_text(t.as_py() or b"") for t in batch.column(3)], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], bits], ["doc_id", "part", "digest", "bits"])


def gallop(ids: list[int], value: int, at: int) -> int:
    """The first place from ``at`` on that holds ``value`` or more, by doubled steps and a search in the last."""
    step, low, n = 1, at, len(ids)
    while at < n and ids[at] < value:
        low, at, step = at + 1, at + step, 2 * step
    return bisect_left(ids, value, low, min(at, n))


def union(lists: list[list[int]]) -> list[int]:
    """Sorted lists without repeats, merged: what the list in front holds below the next head is taken over at once."""
    heads = [(ids[0], k, 0) for k, ids in enumerate(lists) if ids]
    heapq.heapify(heads)
    merged: list[int] = []
    while len(heads) > 1:
        value, k, at = heads[0]
        ids, limit = lists[k], min(h[0] for h in heads[1:3])
        if value == limit:
            end = at + 1  # the other list will give it
        else:
            end = gallop(ids, limit, at)
            merged += ids[at:end]
        if end < len(ids):
            heapq.heapreplace(heads, (ids[end], k, end))
        else:
            heapq.heappop(heads)
    for _, k, at in heads:
        merged += lists[k][at:]
    return merged


def common(short: list[int], long: list[int]) -> int:
    """How many ids two sorted lists share; the longer one is galloped through."""
    if len(short) > len(long):
        short, long = long, short
    n = at = 0
    for value in short:
        at = gallop(long, value, at)
        if at == len(long):
            break
        n += long[at] == value
    return n


def _union_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, subset, docs, good, toxic) of every block; subset -1 is the block's documents."""
    schema = pa.schema([("part", pa.string()), ("subset", pa.int32()), ("docs", pa.int64()), ("good", pa.int64()), ("toxic", pa.int64())])

    def sizes(part: str, n: int, lists: list[list[int]]) -> pa.RecordBatch:
        *failing, good, toxic = lists
        rows = [(part, -1, n, len(good), len(toxic))]
        for subset in range(1, _EVERY + 1):
            ids = union([failing[i] for i in range(len(FILTERS)) if subset >> i & 1])
            rows.append((part, subset, len(ids), common(good, ids), common(toxic, ids)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    here, n, lists = None, 0, []
    for batch in batches:
        for part, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n and (part != here or n == BLOCK):
                yield sizes(here, n, lists)
                n = 0
            if not n:
                here, lists = part, [[] for _ in range(len(FILTERS) + 2)]
            for i in range(len(lists)):
                if marks >> i & 1:
                    lists[i].append(n)
            n += 1
    if n:
        yield sizes(here, n, lists)


def failing_filters(docs: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, bits) of every row; bit i is set when it fails filter i of ABCDE."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    judged = staged(docs.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.col("text").cast("binary").alias("text"))
                    .mapInArrow(lambda b: freed(_judged(b)), "doc_id bigint, part string, digest binary, bits int"), "judged")
    firsts = (judged.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
              .withColumn("first", F.lit(True)))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (attached(judged, firsts, ["doc_id", "digest"])
            .select("doc_id", "part", (F.col("bits") + F.when(copy, 16).otherwise(0)).alias("bits")))


def filter_orders() -> list[dict]:
    """Every order of the filters, step by step: the filters before the step and those with it, as bits."""
    rows = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            rows.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before, "after": before | bit})
            before |= bit
    return rows


def filter_interactions(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 32).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 64).otherwise(0)).alias("toxic"))
             .select("doc_id", (F.col("good") + F.col("toxic")).alias("marks")).where("marks > 0"))
    marked = (attached(failing_filters(docs, part_col, id_col, text_col), marks, ["doc_id"])
              .select("part", "doc_id", (F.col("bits") + F.coalesce("marks", F.lit(0))).alias("bits")))
    blocks = (marked.sortWithinPartitions("part", "doc_id").select("part", "bits")
              .mapInArrow(lambda b: freed(_union_sizes(b)), "part string, subset int, docs bigint, good bigint, toxic bigint"))
    sums = blocks.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("docs", "good", "toxic")])
    entry = F.struct("subset", F.struct("docs", "good", "toxic"))
    per_part = staged(sums.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("u")), "unions")

    steps = F.from_json(F.lit(json.dumps(filter_orders())),
                        "array<struct<filter_order: string, step: int, bit: int, before: int, after: int>>")
    laid = per_part.select("part", "u", F.explode(steps).alias("s")).select("part", "u", "s.*")

    def size(subset, what: str = "docs"):
        return F.when(subset == 0, F.lit(0)).otherwise(F.element_at("u", subset)[what]).cast("bigint")

    lost = {name: size(F.col("after"), what) - size(F.col("before"), what)
            for name, what in (("removed", "docs"), ("good_lost", "good"), ("toxic_lost", "toxic"))}
    out = laid.select(
        "part", "filter_order", "step", "bit", (size(F.lit(-1)) - size(F.col("after"))).alias("kept"),
        *[c.alias(name) for name, c in lost.items()],
        (size(F.col("bit")) - lost["removed"]).alias("redundant"),
        (size(F.lit(_EVERY)) - size(F.lit(_EVERY).bitwiseXOR(F.col("bit")))).alias("unique_fails"))
    return (out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
