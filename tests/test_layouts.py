"""Bucketed and clustered tables, counts taken by writes, day fingerprints, strict documents, switched folders."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import SF_SMALL
from stratiform import queries as Q
from stratiform import schemas
from stratiform.operators import bucketed, clustered, tables
from stratiform.operators.aggregates import layer_counts
from stratiform.operators.clustered import lookup_keys, write_clustered
from stratiform.operators.fingerprints import day_fingerprints, layer_diff
from stratiform.operators.observed import WriteLog
from stratiform.operators.quality import null_profile
from stratiform.operators.tables import write_table
from stratiform.plans import scenario
from stratiform.sources.landed import read_lookup_documents, read_table

PAIR = StructType([StructField("id", LongType()), StructField("name", StringType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- buckets -----------------------------------------------------------------------------

def test_bucketed_target_is_not_shuffled(spark, scratch):
    path = scratch("bucketed") + "/pairs"
    first = spark.createDataFrame([(i, f"a{i}") for i in range(50)], PAIR)
    stored = bucketed.merge_bucketed(first, "pairs_in_buckets", path, "id", PAIR, buckets=16)
    batch = spark.createDataFrame([(i, f"b{i}") for i in range(40, 60)] + [(55, "twice"), (None, "no key")], PAIR)
    fresh = bucketed.missing_rows(batch, stored, "id")
    fresh.collect()
    plan = fresh._jdf.queryExecution().executedPlan().toString().split("Final Plan ==")[-1].split("== Initial Plan ==")[0]
    join = plan[plan.index("LeftAnti"):]
    target = join[join.index("Bucketed: true") - 800:]
    assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 16 out of 16" in target
    got = bucketed.merge_bucketed(batch, "pairs_in_buckets", path, "id", PAIR, buckets=16)
    want = rows(first) + rows(batch.where("id >= 50 OR id IS NULL"))
    assert rows(got) == sorted(want, key=repr)
    spark.sql("DROP TABLE pairs_in_buckets")
    assert rows(bucketed.bucketed_table(spark, "pairs_in_buckets", path, PAIR, "id", 16)) == sorted(want, key=repr)


def test_bucketed_pending_is_null_safe(spark, scratch):
    path = scratch("bucketed-null") + "/pairs"
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], PAIR)
    stored = bucketed.merge_bucketed(spark.createDataFrame([(1, "a")], PAIR), "pairs_null", path, "id", PAIR, buckets=16)
    assert rows(bucketed.missing_rows(batch, stored, "id", null_safe=True).select("id")) == [(2,), (None,)]
    stored = bucketed.merge_bucketed(spark.createDataFrame([(None, "n")], PAIR), "pairs_null", path, "id", PAIR, buckets=16)
    assert rows(bucketed.missing_rows(batch, stored, "id", null_safe=True).select("id")) == [(2,)]
    with pytest.raises(tables.SchemaMismatch):
        bucketed.append_bucketed(spark.createDataFrame([(1,)], "id bigint"), "pairs_null", "id", 16)


# --- clusters ------------------------------------------------------------------------------

def _rows_scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_clustered_lookup_reads_fewer_rows(spark, scratch):
    """The same rows, written in any order and clustered, as many row groups each."""
    data = spark.range(400_000).selectExpr("CAST(pmod(xxhash64(id), 100000) AS bigint) * 2 AS id", "CAST(id AS string) AS name").repartition(1)
    plain, ordered = scratch("plain") + "/t", scratch("clustered") + "/t"
    data.write.option("parquet.block.size", 256 * 1024).parquet(plain)
    write_clustered(data, ordered, "id", tasks=4, row_group_bytes=256 * 1024, expected_keys=20_000)
    ids = [data.where("id % 3 = 0").first()["id"], 4, 100_001]
    results = [lookup_keys(spark, p, PAIR, "id", ids) for p in (plain, ordered)]
    assert rows(results[0]) == rows(results[1]) == rows(data.where(F.col("id").isin(ids)))
    scanned = [_rows_scanned(lookup_keys(spark, p, PAIR, "id", ids)) for p in (plain, ordered)]
    assert scanned[0] == 400_000 and scanned[1] < 100_000
    # inside the range of every group, but in none: only the bloom filter can tell
    assert _rows_scanned(lookup_keys(spark, ordered, PAIR, "id", [55_555])) < 20_000


def test_clustered_hot_key_and_bounds(spark, scratch):
    path = scratch("clustered-hot") + "/t"
    data = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id", "CAST(id AS string) AS name")
    write_clustered(data, path, "id", tasks=6)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < 10_000  # a third of the rows share a key, no file holds them all
    assert lookup_keys(spark, path, PAIR, "id", [7]).count() == 10_001
    assert lookup_keys(spark, path, PAIR, "id", []).count() == 0
    with pytest.raises(ValueError, match="too many literals"):
        lookup_keys(spark, path, PAIR, "id", range(clustered.PUSHED_MOST + 1))


# --- counts of writes --------------------------------------------------------------------

def test_report_equals_counts_and_null_profiles(spark):
    log = WriteLog()
    lake = scenario.two_runs(spark, SF_SMALL, tag="observed", log=log)
    stored = {("bronze", "approaches"): (lake.bronze_approaches, schemas.BRONZE_APPROACHES),
              ("bronze", "metadata"): (lake.bronze_metadata, schemas.BRONZE_METADATA),
              ("silver", "approaches"): (lake.silver_approaches, schemas.SILVER_APPROACHES),
              ("silver", "metadata"): (lake.silver_metadata, schemas.SILVER_METADATA),
              ("gold", "daily_summary"): (lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY)}
    frames = {k: read_table(spark, *v) for k, v in stored.items()}
    report = log.report(spark).where("layer <> 'landed'")
    assert rows(report.where("measure = 'rows'").select("layer", "table", "n")) == rows(layer_counts(frames))
    for (layer, table), df in frames.items():
        got = report.where((F.col("layer") == layer) & (F.col("table") == table) & (F.col("measure") == "nulls")).select("column", "n")
        assert rows(got) == rows(null_profile(df).select("column", "nulls"))


def test_entries_add_up_until_a_table_is_replaced(spark, scratch):
    from pyspark.sql import Observation
    log, path = WriteLog(), scratch("observed") + "/t"
    for mode, data in (("overwrite", [(1, "a"), (2, None)]), ("append", [(None, None)]), ("append", []), ("overwrite", [(9, "z")])):
        seen = Observation()
        write_table(spark.createDataFrame(data, PAIR), path, mode=mode, observation=seen)
        log.take("x", "t", seen, replaces=mode == "overwrite")
        if mode == "append" and not data:
            assert log.totals()[("x", "t")] == {"rows": 3, "nulls:id": 1, "nulls:name": 2}
    assert log.totals()[("x", "t")] == {"rows": 1, "nulls:id": 0, "nulls:name": 0}


def test_documents_that_declare_another_count_are_reported(spark, scratch):
    import json
    from stratiform.paths import Lake
    from stratiform.plans.jobs import ingest_bronze
    from stratiform.sources.landed import read_feed
    root = scratch("declared")
    obj = {"id": "1", "name": "n", "close_approach_data": [{"close_approach_date": "2024-01-02", "close_approach_date_full": "2024-Jan-02 01:00"}]}
    docs = [{"element_count": n, "near_earth_objects": {"2024-01-02": [obj] * 2}} for n in (2, 3, 2, None)]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(f"{root}/feed")
    log = WriteLog()
    ingest_bronze(Lake(root), read_feed(spark, f"{root}/feed"), spark.createDataFrame([], schemas.BRONZE_METADATA), log=log)
    assert log.totals()[("landed", "feed")] == {"rows": 4, "breaks:element_count": 2}
    assert log.totals()[("bronze", "approaches")]["rows"] == 8


# --- fingerprints --------------------------------------------------------------------------

def test_layer_diff_names_the_altered_days(spark):
    base = [(d, i % 5, f"n{i}" if i % 4 else None) for d in ("a", "b", "c", None) for i in range(20)]
    schema = "fecha string, id int, name string"
    left = spark.createDataFrame(base, schema)

    def days(changed):
        return {r["fecha"]: (r["left_rows"], r["right_rows"]) for r in layer_diff(left.repartition(3), spark.createDataFrame(changed, schema)).collect()}

    assert days(list(reversed(base))) == {}
    assert days(base + [base[0]]) == {"a": (20, 21)}  # one more of an equal row
    assert days([r for r in base if r[0] != "b"]) == {"b": (20, 0)}
    assert days(base + [("new", 1, None)]) == {"new": (0, 1)}
    assert days([(d, i, n if d is not None or i else "x") for d, i, n in base]) == {None: (20, 20)}
    swapped = [(d, i, None if (d, n) == ("c", "n1") else "n1" if d == "c" and n is None and i == 0 else n) for d, i, n in base]
    assert set(days(swapped)) == {"c"}
    nulls = spark.createDataFrame([("d", None, "1"), ("e", 1, None)], schema)
    moved = spark.createDataFrame([("d", 1, None), ("e", None, "1")], schema)
    assert layer_diff(nulls, moved).count() == 2


def test_fingerprints_of_parts_add_up(spark):
    df = Q.silver_approaches(spark, SF_SMALL)
    parts = day_fingerprints(df.where("hora < 9")).unionByName(day_fingerprints(df.where("hora >= 9")))
    summed = parts.groupBy("fecha").agg(*[F.sum(c).alias(c) for c in ("rows", "print_a", "print_b")])
    assert rows(summed.selectExpr("fecha", "rows", "CAST(print_a AS string)", "CAST(print_b AS string)")) == rows(
        day_fingerprints(df).selectExpr("fecha", "rows", "CAST(print_a AS string)", "CAST(print_b AS string)"))


# --- strict documents --------------------------------------------------------------------------

GOOD = '{"id":"1","name":"a } { b","absolute_magnitude_h":1.5,"is_sentry_object":true}'


def test_only_one_whole_object_is_a_document(spark, scratch):
    path = scratch("strict") + "/lookups"
    lines = [GOOD, "  " + GOOD + "  ", '{"id":"2"} {"id":"3"}', '{"id":"4"},{"id":"5"}', '{"id":"6"}]', '{"id":"7"}}', '{"id":"8"}] x',
             '{"id":"9"},"k":1', '{"id":"10"', "[]", "null", "7", '{"id":"11","id":"12"}', '{"name":"no id"}', '{"id":"13","absolute_magnitude_h":"1.5"}',
             '{"id":"14","is_sentry_object":"yes"}', '{"id":"15","estimated_diameter":3}',
             '{"id":"16","estimated_diameter":{"kilometers":{"estimated_diameter_min":2}},"more":[1]}', '{"id":17}', '{"id":"18","name":null}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    parsed, bad = read_lookup_documents(spark, path)
    assert sorted(r["id"] for r in parsed.collect()) == ["1", "1", "16", "17", "18"]
    assert parsed.where("id = '16'").first()["estimated_diameter"]["kilometers"]["estimated_diameter_min"] == 2.0
    assert parsed.schema.simpleString() == schemas.LOOKUP.simpleString()
    reasons = {r["_corrupt_record"]: r["reason"] for r in bad.collect()}
    assert reasons == {**{x: "not one JSON value" for x in lines[2:9]}, "[]": "no object", "null": "no object", "7": "no object",
                       lines[12]: "not one JSON value", lines[13]: "no id", lines[14]: "type of $.absolute_magnitude_h",
                       lines[15]: "type of $.is_sentry_object", lines[16]: "type of $.estimated_diameter"}
    assert all("/lookups/part-" in r["file_path"] for r in bad.collect())


def test_one_document_per_file(spark, scratch):
    path = scratch("strict-files").replace("file:", "")
    os.makedirs(path)
    for name, text in (("good.json", GOOD.replace(",", ",\n")), ("two.json", GOOD + "\n" + GOOD), ("cut.json", GOOD[:20])):
        with open(f"{path}/{name}", "w") as f:
            f.write(text)
    parsed, bad = read_lookup_documents(spark, path, multi_line=True)
    assert [r["name"] for r in parsed.collect()] == ["a } { b"]
    assert sorted(r["file_path"].rsplit("/", 1)[1] for r in bad.collect()) == ["cut.json", "two.json"]


# --- overwrite -----------------------------------------------------------------------------

class FailingMoves:
    """A file system whose moves fail from the n-th on, the given number of times."""

    def __init__(self, fs, fail):
        self._fs, self._fail, self.n = fs, fail, 0

    def rename(self, a, b):
        self.n += 1
        return False if self.n in self._fail else self._fs.rename(a, b)

    def delete(self, *a):
        return self._fs.delete(*a)


@pytest.mark.parametrize("fail", [{1}, {2}])
def test_a_failed_switch_leaves_the_old_table(spark, scratch, fail):
    root = scratch("switch")
    old, new = spark.createDataFrame([(1, "old")], PAIR), spark.createDataFrame([(2, "new")], PAIR)
    write_table(old, f"{root}/t")
    new.write.parquet(f"{root}/fresh")
    fs, hpath = tables._file_system(spark, root)
    with pytest.raises(OSError):
        tables.switch_folders(FailingMoves(fs, fail), hpath, f"{root}/t", f"{root}/fresh")
    assert rows(spark.read.parquet(f"{root}/t")) == [(1, "old")]
    tables.switch_folders(fs, hpath, f"{root}/t", f"{root}/fresh")
    assert rows(spark.read.parquet(f"{root}/t")) == [(2, "new")]


def test_when_nothing_can_be_moved_both_places_are_named(spark, scratch):
    root = scratch("switch-lost")
    write_table(spark.createDataFrame([(1, "old")], PAIR), f"{root}/t")
    fs, hpath = tables._file_system(spark, root)
    with pytest.raises(OSError, match="neither could be moved") as e:
        tables.switch_folders(FailingMoves(fs, {2, 3}), hpath, f"{root}/t", f"{root}/fresh")
    aside = str(e.value).split(" is in ")[1].split(",")[0]
    assert rows(spark.read.parquet(aside)) == [(1, "old")]
