"""Near-duplicate embeddings by random-hyperplane signs, exact cosines and components.

Equal vectors of a label are one class.  Every class gets ``bits`` signs in each of
``tables`` tables; classes that share a label, a table and all its signs meet in a
bucket.  Buckets are compared in blocks of bounded size with exact cosines in double
precision.  A pair that meets in several tables counts in the first of them only, so
each block returns sums and the roots of its own components instead of pairs: the
output stays linear however many members of a group link with each other.

Defined results: NULL or zero vectors, vectors with NULL or non-finite parts and rows
without a label link with nothing; vectors of different length never link; a NULL id
links with nothing and is kept; rows that share an id are added up under it; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import staged
from stratiform.llm.components import connected_components

TABLES = 24
BITS = 16
BLOCK = 512  # classes of a bucket in one block


def _signs(batches, tables: int, bits: int):
    planes: dict[int, np.ndarray] = {}
    weight = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        vectors = [np.array(v, dtype=np.float64) for v in batch.column(2).to_pylist()]
        out = np.zeros((len(vectors), tables), dtype=np.int64)
        for size in {len(v) for v in vectors}:
            if size not in planes:
                planes[size] = np.random.default_rng(size).standard_normal((size, tables * bits))
            at = [i for i, v in enumerate(vectors) if len(v) == size]
            side = (np.stack([vectors[i] for i in at]) @ planes[size] >= 0).reshape(len(at), tables, bits)
            out[at] = side @ weight
        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * tables)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))],
                                         ["rep", "label", "embedding", "copies", "signs"])


def _links_of(rows: list[dict], cosine: float) -> list[tuple]:
    """(rep, links, root) of one block pair: a block within itself, or its ``side`` 0 against ``side`` 1."""
    same = not rows or rows[0]["one"] == rows[0]["two"]
    a = [r for r in rows if r["side"] == 0]
    right = a if same else [r for r in rows if r["side"] == 1]
    if not a or not right or (same and len(a) < 2):
        return []
    table = a[0]["t"]

    def arrays(some):
        x = np.array([r["embedding"] for r in some], dtype=np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x, np.array([r["signs"] for r in some])

    x, sx = arrays(a)
    y, sy = (x, sx) if same else arrays(right)
    i, j = np.nonzero(x @ y.T >= cosine)
    if same:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return []
    counts = [np.zeros(len(a), dtype=np.int64), np.zeros(len(right), dtype=np.int64)]
    copies = [np.array([r["copies"] for r in some]) for some in (a, right)]
    for k in range(0, len(i), 100_000):
        p, q = i[k:k + 100_000], j[k:k + 100_000]
        first = ~(sx[p, :table] == sy[q, :table]).any(axis=1)  # not met in an earlier table
        np.add.at(counts[0], p[first], copies[1][q[first]])
        np.add.at(counts[1], q[first], copies[0][p[first]])
    if same:
        counts[0] += counts[1]
    reps = [np.array([r["rep"] for r in some]) for some in (a, right)]
    ids = reps[0] if same else np.concatenate(reps)
    u, v = i, (j if same else j + len(a))
    root = ids.copy()
    while True:  # smallest id along the block's links
        before = root.copy()
        np.minimum.at(root, u, root[v])
        np.minimum.at(root, v, root[u])
        if (root == before).all():
            break
    total = counts[0] if same else np.concatenate(counts)
    return [(int(r), int(c), int(m)) for r, c, m in zip(ids, total, root) if c or m != r]


def _blocks(batches, cosine: float):
    """Rows sorted by block; each block's rows are gathered, compared and dropped."""
    key, rows = None, []

    def result(found):
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["rep", "links", "root"])

    found: list[tuple] = []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[c] for c in ("label", "t", "sign", "size", "one", "two"))
            if now != key:
                found += _links_of(rows, cosine)
                key, rows = now, []
            rows.append(row)
        if found:
            yield result(found)
            found = []
    found += _links_of(rows, cosine)
    if found:
        yield result(found)


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.98, tables: int = TABLES, bits: int = BITS,
                           block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest id reachable) and kept."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    usable = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull()
                        & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0))
    classes = staged(usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                     "classes")
    kind = classes.schema["label"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _signs(batches, tables, bits)

    signed = staged(classes.select("rep", "label", "embedding", "copies").mapInArrow(
        sign, f"rep bigint, label {kind}, embedding array<double>, copies bigint, signs array<bigint>"), "signs")
    placed = signed.select("rep", "label", F.size("embedding").alias("size"), F.posexplode("signs").alias("t", "sign"))
    bucket = ["label", "size", "t", "sign"]
    shared = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") / F.lit(block)).cast("int")
    members = (placed.join(shared, bucket).withColumn("parts", parts)
               .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")))
    # a block meets itself and every other block of its bucket
    met = (members.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
           .select("rep", *bucket, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
                   F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side")))
    full = met.join(signed.select("rep", "embedding", "copies", "signs"), "rep")
    order = [*bucket, "one", "two"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(batches, cosine)

    found = staged(full.repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order)
                   .mapInArrow(compare, "rep bigint, links bigint, root bigint"), "links")
    roots = connected_components(found.select("rep", "root").distinct(), "rep", "root")
    linked = (found.groupBy("rep").agg(F.sum("links").alias("links"))
              .join(roots, F.col("rep") == F.col("id"), "left").select("rep", "links", "component"))
    per_class = (classes.join(linked, "rep", "left")
                 .select("label", "embedding", F.coalesce("component", "rep").alias("root"),
                         (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    per_id = (usable.join(per_class, ["label", "embedding"]).groupBy("vec_id")
              .agg(F.min("root").alias("root"), F.max("links").alias("links")))
    return (rows.select("vec_id").join(per_id, "vec_id", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
