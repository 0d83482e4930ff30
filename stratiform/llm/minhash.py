"""Near-duplicate documents by MinHash with tensored banding and exact confirmation.

Two small collections of ``m`` half keys each are made from ``h`` minimum hashes a
half key; every pair of a half key of the first and one of the second collection is
the key of one table.  So ``m * m`` tables of ``2 * h`` rows cost ``2 * m * h`` minimum
hashes, about the square root of what as many independent tables would take.

1. One pass over the texts gives each document its set size, a fingerprint of its
   whole shingle set, its half keys and an odd sketch (the parity of shingles per
   bit).  Documents with the same set are one class; its smallest id stands for it.
2. In every table bucket the member with the most company is the hub; all others are
   compared with it.  Links found so far are joined to components.
3. Only in buckets that still hold several components, the members outside the largest component are
   compared with the members of other components, as long as they are up to ``PAIRED_MOST``.
4. The members of buckets with more of them share text that is in all of them (boilerplate), so most of them do not link.
   They are compared by their rarest shingles: two sets that link share one of the first n - ceil(j n) + 1 shingles
   of either, in the order of how many of these members hold them.  What all share comes last
   in that order, so it makes no pairs, and no link is lost.

Differing bits of two odd sketches never outnumber the shingles in which two sets
differ, so pairs above the allowed difference are dropped without error; the rest is
confirmed on the full sets.

Defined results: NULL and empty texts, and texts without words, have an empty set and
link with nothing; a NULL id links with nothing and is kept; rows that share an id are one
document of several texts, which share its component and bring its links together; equal texts are one class; a very long text is
hashed whole, as the others are; ids are cast to bigint; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm import texthash
from stratiform.llm.common import attached, freed, spread_join, staged
from stratiform.llm.components import connected_components
from stratiform.operators.joins import fits_broadcast, sized_join

HALVES = 10  # half keys of each collection: 100 tables; pairs at the threshold miss all of them in 2 of 10,000 (85 %) or 2 of 1,000 (80 %) cases
ROWS = 3  # minimum hashes of a half key
PAIRED_MOST = 64  # members of a bucket outside its largest component that are compared with all others
WORDS = 16  # longs of an odd sketch
FOLDED = 8  # longs of the sketch carried into buckets
_BITS = [f"s{i}" for i in range(WORDS)]
_FOLD = [f"f{i}" for i in range(FOLDED)]
_NAME = ["doc_id", "n", "fp1", "fp2"]  # a document's set: rows that share an id may hold several
SOME = 1 << 18  # shingles of a crowd's sets looked at together in a task
_OTHER = np.uint64(0x5851F42D4C957F2D)


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    words, at = texthash.word_hashes(texts)
    return [np.unique(texthash.shingle_hashes(words[a:b], k)) for a, b in zip(at[:-1], at[1:])]


def _prints(values: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """The fingerprint of a set."""
    return np.add.reduce(values), np.add.reduce(texthash.mix(values ^ _OTHER))


def _features(batches, k: int, m: int, h: int):
    xor, factor = _functions(2 * m * h)
    for batch in batches:
        done = 0
        for texts in texthash.chunks(batch.column(1)):
            ids = batch.column(0).slice(done, len(texts))
            done += len(texts)
            sets = _shingle_sets(texts, k)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(size)
            n = len(texts)
            half = np.zeros((n, 2 * m), dtype=np.uint64)
            prints = np.zeros((n, 2), dtype=np.uint64)
            sketch = np.zeros((n, WORDS), dtype=np.uint64)
            if len(full):
                every = np.concatenate([sets[i] for i in full])
                begin = np.r_[0, np.cumsum(size[full])[:-1]]
                prints[full, 0] = np.add.reduceat(every, begin)
                prints[full, 1] = np.add.reduceat(texthash.mix(every ^ _OTHER), begin)
                owner = np.repeat(np.arange(len(full)), size[full])
                bit = (texthash.mix(every + np.uint64(0x14057B7EF767814F)) >> np.uint64(54)).astype(np.int64)
                odd = np.bincount(owner * (64 * WORDS) + bit, minlength=len(full) * 64 * WORDS) & 1
                sketch[full] = np.packbits(odd.astype(np.uint8).reshape(len(full), -1), axis=1).view(np.uint64)
                for i in range(2 * m):
                    value = np.full(len(full), np.uint64(i + 1))
                    for j in range(i * h, (i + 1) * h):
                        value = texthash.mix(value + np.minimum.reduceat((every ^ xor[j]) * factor[j], begin))
                    half[full, i] = value
            signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * m)
            lists = [pa.ListArray.from_arrays(offsets, signed(half[:, a:a + m].ravel())) for a in (0, m)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size), signed(prints[:, 0].copy()), signed(prints[:, 1].copy()), *lists,
                 *(signed(sketch[:, i].copy()) for i in range(WORDS))],
                ["doc_id", "n", "fp1", "fp2", "u", "v", *_BITS])


def document_features(docs: DataFrame, shingle: int, m: int = HALVES, h: int = ROWS) -> DataFrame:
    """Per row: set size ``n``, set fingerprint, half keys ``u`` and ``v`` and the odd sketch."""
    schema = ("doc_id bigint, n bigint, fp1 bigint, fp2 bigint, u array<bigint>, v array<bigint>, "
              + ", ".join(f"{c} bigint" for c in _BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(_features(batches, shingle, m, h))

    return docs.mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n, fp1, fp2, set): the sorted distinct shingle hashes of every row, and what names that set."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in texthash.chunks(batch.column(1)):
                ids = batch.column(0).slice(done, len(texts))
                done += len(texts)
                sets = _shingle_sets(texts, shingle)
                prints = np.array([_prints(s) for s in sets], dtype=np.uint64).reshape(-1, 2)
                offsets = pa.array(np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), *(pa.array(prints[:, i].copy().view(np.int64)) for i in (0, 1)),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))], [*_NAME, "set"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(sets_of(batches))

    return docs.mapInArrow(run, "doc_id bigint, n bigint, fp1 bigint, fp2 bigint, set array<bigint>")


def _may_link(bits: list[str], percent: int, a: str = "a", b: str = "b"):
    """No pair that links fails this: sizes, and the sketches' differing bits, allow the similarity."""
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in bits[1:]),
                 F.bit_count(F.col(f"{a}.{bits[0]}").bitwiseXOR(F.col(f"{b}.{bits[0]}"))))
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return ((small * 100 >= large * percent)
            & (differ * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)))


def _with_side(pairs: DataFrame, side: str, known: DataFrame, counts: DataFrame) -> DataFrame:
    """``pairs`` with what is known of one side; a node in very many pairs is dealt over tasks."""
    return spread_join(pairs, known.withColumnRenamed("node", side), [side], "__rows", counts=counts)


def _confirm(pairs: DataFrame, nodes: DataFrame, sets_of, percent: int, tag: str) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""

    def counted(pairs: DataFrame, what: str) -> dict[str, DataFrame]:
        return {side: staged(pairs.groupBy(side).agg(F.count(F.lit(1)).alias("__rows")), f"{tag}-{what}-{side}") for side in "ab"}

    pairs = staged(pairs, f"{tag}-pairs")
    counts = counted(pairs, "pairs")
    near = pairs
    for side in "ab":
        near = _with_side(near, side, nodes.select("node", F.struct("n", *_BITS).alias(f"x{side}")), counts[side])
    likely = staged(near.where(_may_link(_BITS, percent, "xa", "xb")).select("a", "b"), f"{tag}-likely")
    counts = counted(likely, "likely")
    sets = sets_of(counts["a"].select(F.col("a").alias("node")).union(counts["b"].select(F.col("b").alias("node"))).distinct(), tag)
    both = likely
    for side in "ab":
        both = _with_side(both, side, sets.withColumnRenamed("set", f"set_{side}"), counts[side])
    common = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    union = F.size("set_a") + F.size("set_b") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def _sets_reader(nodes: DataFrame, docs: DataFrame, shingle: int, several: bool):
    """A function from a table of nodes to their (node, set), read from the texts of their documents.

    ``several`` says that ids with more than one text exist, so that an id alone does not name a set.
    """

    def sets_of(wanted: DataFrame, tag: str) -> DataFrame:
        named = nodes.join(wanted, "node", "left_semi").select("node", *_NAME)
        sets = shingle_sets(sized_join(docs, named.select("doc_id").distinct(), "doc_id", "left_semi"), shingle)
        if several:
            sets = attached(staged(sets, f"{tag}-texts"), named, _NAME, "inner").select("node", "set")
        else:
            sets = sets.select(F.col("doc_id").alias("node"), "set")
        return staged(sets.dropDuplicates(["node"]), f"{tag}-sets")

    return sets_of


def _nodes(reps: DataFrame) -> DataFrame:
    """One node per set: its document's id, or, for further texts under one id, a negative number of their own."""
    several = staged(reps.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows"), F.min("fp1").alias("first1"))
                     .where("__rows > 1"), "several")
    own = spread_join(reps, several, ["doc_id"], "__rows", "left")
    first = F.col("__rows").isNull() | (F.col("fp1") == F.col("first1"))
    other = -(F.pmod(F.xxhash64(*_NAME), F.lit((1 << 62) - 1)) + (1 << 62))
    return own.select(F.when(first, F.col("doc_id")).otherwise(other).alias("node"), *reps.columns)


def _under_one_id(texts: DataFrame, several: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the nodes of the texts that share an id, None when no id has several texts."""
    if several.isEmpty():
        return None
    named = nodes.select(F.col("doc_id").alias("rep"), *_NAME[1:], "node")
    owned = staged(attached(spread_join(texts, several, ["doc_id"], "__rows").drop("__rows"), named, ["rep", *_NAME[1:]], "inner")
                   .select("doc_id", "node"), "owned")
    least = staged(owned.groupBy("doc_id").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("__rows")), "least-owned")
    return (spread_join(owned, least, ["doc_id"], "__rows").where("node <> least")
            .select(F.col("least").alias("a"), F.col("node").alias("b")))


def _some_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Of batches (node, set): the nodes of some rows, their set sizes and their shingles, up to SOME shingles or one row at a time."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))
        low = 0
        while low < len(ends):
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + SOME, "right")))
            yield (batch.column(0).slice(low, high - low), np.diff(ends[low:high], prepend=before),
                   batch.column(1).slice(low, high - low).flatten().to_numpy())
            low = high


def _holders(sets: DataFrame) -> DataFrame:
    """(x, holders): in how many sets a shingle is; added up over some sets before a row leaves a task."""

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, shingles in _some_sets(batches):
            x, c = np.unique(shingles, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(c.astype(np.int64))], ["x", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(counts_of(batches))

    return sets.select("node", "set").mapInArrow(run, "x bigint, c bigint").groupBy("x").agg(F.sum("c").alias("holders"))


def _rarest_in_place(sets: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """(node, x): of the rarest shingles of every set those that another set holds.

    ``shared`` (x, holders) is sent to the tasks, so its caller has measured it; no set leaves its task, only what is returned.
    """
    known = shared.select("x", "holders").toArrow().sort_by("x")
    sorted_x, holders = known["x"].to_numpy(), known["holders"].to_numpy()
    rank = np.empty(len(sorted_x), dtype=np.int64)
    rank[np.lexsort((sorted_x, holders))] = np.arange(len(sorted_x))

    def rarest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, size, shingles in _some_sets(batches):
            near = np.searchsorted(sorted_x, shingles)
            hit = np.flatnonzero(sorted_x[np.minimum(near, len(sorted_x) - 1)] == shingles)
            owner, place = np.repeat(np.arange(len(size)), size)[hit], near[hit]
            order = np.lexsort((rank[place], owner))
            owner, place = owner[order], place[order]
            held = np.bincount(owner, minlength=len(size))
            # those that no other set holds come first
            left = (size - np.ceil(size * percent / 100.0) + 1).astype(np.int64) - (size - held)
            kept = np.arange(len(owner)) - np.repeat(np.cumsum(held) - held, held) < left[owner]
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(owner[kept])), pa.array(sorted_x[place[kept]])], ["node", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(rarest_of(batches)) if len(sorted_x) else iter(())

    return sets.select("node", "set").mapInArrow(run, "node bigint, x bigint")


def _rarest_by_shuffle(sets: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """The rows of ``_rarest_in_place``, by joins, from the ``counts`` (x, holders) of all shingles."""
    held = sets.select("node", F.size("set").alias("n"), F.explode("set").alias("x"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100.0)) + 1
    return (spread_join(held, counts, ["x"], "holders").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "x"))).alias("all"))
            .select("node", F.explode(F.slice("all", F.lit(1), prefix.cast("int"))).alias("s"))
            .where("s.holders > 1").select("node", F.col("s.x").alias("x")))


def _rare_pairs(members: DataFrame, nodes: DataFrame, sets_of, percent: int) -> DataFrame:
    """Pairs of members (node, component) of different components that share one of their rarest shingles."""
    sets = sets_of(members.select("node"), "crowd")
    counts = staged(_holders(sets), "holders")
    shared = counts.where("holders > 1")
    rare = _rarest_in_place(sets, shared, percent) if fits_broadcast(shared) else _rarest_by_shuffle(sets, counts, percent)
    rare = rare.join(members, "node").join(nodes.select("node", F.struct("n", *_folded()).alias("s")), "node")
    return _across(staged(rare, "rare"), "x", percent)


def _largest(members: DataFrame, key: str) -> DataFrame:
    """Of the keys that several components hold: their rows, the component with the most, and the rows of the others."""
    parts = members.groupBy(key, "component").agg(F.count(F.lit(1)).alias("k"))
    return (parts.groupBy(key).agg(F.sum("k").alias("__rows"), F.max(F.struct("k", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1").select(key, "__rows", F.col("most.component").alias("main"), (F.col("__rows") - F.col("most.k")).alias("others")))


def _across(members: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs (a, b) of members (key, node, component, s) of one key and of different components that may link.

    Every pair has a member outside the largest component of its key, so only those are compared with all.
    """
    largest = staged(_largest(members, key), "largest")
    some = staged(spread_join(members, largest, [key], "__rows").drop("__rows"), "members")
    outside = some.where("component <> main").select(key, F.col("node").alias("other"), F.col("component").alias("of_other"), F.col("s").alias("s_other"))
    apart = ((F.col("l.component") != F.col("r.of_other")) & ((F.col("l.component") == F.col("l.main")) | (F.col("l.node") < F.col("r.other")))
             & _may_link(_FOLD, percent, "l.s", "r.s_other"))
    pairs = spread_join(some, outside, [key], "__rows", counts=largest.select(key, "__rows"), where=apart)
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _folded() -> list:
    return [F.col(f"s{i}").bitwiseXOR(F.col(f"s{i + FOLDED}")).alias(f"f{i}") for i in range(FOLDED)]


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, m: int = HALVES, h: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text", paired_most: int = PAIRED_MOST) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links) and kept."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    features = staged(document_features(docs, shingle, m, h), "features")
    known = features.where("doc_id IS NOT NULL AND n > 0")
    prints = ["n", "fp1", "fp2"]
    classes = staged(known.groupBy(*prints).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
                     .select(*prints, "rep"), "classes")
    members = staged(attached(known, classes, prints).select(*known.columns, F.coalesce("rep", "doc_id").alias("rep")), "members")
    nodes = staged(_nodes(members.where("doc_id = rep").dropDuplicates(_NAME)), "nodes")

    tables = F.flatten(F.transform("u", lambda a, i: F.transform(F.col("v"), lambda b, j: F.xxhash64(a, b, i, j))))
    keys = nodes.select(F.explode(tables).alias("key"), F.col("node").alias("id"))
    shared = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("in_key")).where("in_key > 1"), "shared-keys")
    buckets = staged(spread_join(keys, shared, ["key"], "in_key"), "buckets")
    company = buckets.groupBy("id").agg(F.sum("in_key").alias("company"))
    hubs = staged(buckets.join(company, "id").groupBy("key")
                  .agg(F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("best"), F.count(F.lit(1)).alias("__rows"))
                  .select("key", (-F.col("best.minus")).alias("hub"), "__rows"), "hubs")
    star = (spread_join(buckets, hubs, ["key"], "__rows").where("id <> hub")
            .select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct())
    texts = staged(members.select("doc_id", "rep", *prints).distinct(), "texts")
    several = staged(texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1"), "several-texts")
    same_id = _under_one_id(texts, several, nodes)
    sets_of = _sets_reader(nodes, docs, shingle, same_id is not None)
    first = staged(_confirm(star, nodes, sets_of, percent, "star"), "star-links")
    found = connected_components(first)

    placed = staged(buckets.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "placed")
    largest = staged(_largest(placed, "key"), "open-keys")
    rest = spread_join(placed, largest, ["key"], "__rows").select("key", F.col("id").alias("node"), "component", "others")
    few = rest.where(F.col("others") <= paired_most).join(nodes.select("node", F.struct("n", *_folded()).alias("s")), "node")
    across = _across(staged(few.select("key", "node", "component", "s"), "open-buckets"), "key", percent)
    crowd = staged(rest.where(F.col("others") > paired_most).select("node", "component").distinct(), "crowd")
    if not crowd.isEmpty():
        across = across.union(_rare_pairs(crowd, nodes, sets_of, percent)).distinct()
    second = _confirm(across, nodes, sets_of, percent, "across")

    links = first.union(second)
    joined = connected_components(links if same_id is None else links.union(same_id))
    rooted = (nodes.select("node", *_NAME).join(joined, F.col("node") == F.col("id"), "left")
              .select(*_NAME, F.coalesce("component", "node").alias("component")))
    least = rooted.groupBy("component").agg(F.min("doc_id").alias("root"), F.count(F.lit(1)).alias("__rows"))
    rooted = spread_join(rooted, staged(least, "roots"), ["component"], "__rows").select(
        F.col("doc_id").alias("rep"), *prints, "root")
    named = attached(texts, staged(rooted, "rooted"), ["rep", *prints]).groupBy("doc_id").agg(
        F.min("root").alias("root"))
    return (attached(features.select("doc_id", "n"), staged(named, "named"), ["doc_id"])
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
