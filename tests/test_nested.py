import json

from stratiform.operators.nested import feed_element_check, feed_rejects, flatten_feed, flatten_lookups
from stratiform.sources.landed import quarantined_ids, read_feed, read_lookup_documents


def _approach(day, full, v, km):
    return {"close_approach_date": day, "close_approach_date_full": full,
            "relative_velocity": {"kilometers_per_second": v}, "miss_distance": {"kilometers": km},
            "orbiting_body": "Earth"}


FEED_DOC = {
    "element_count": 4,
    "near_earth_objects": {
        "2015-09-08": [
            {"id": "2433", "name": "433 Eros (A898 PA)", "is_potentially_hazardous_asteroid": False,
             "close_approach_data": [_approach("2015-09-08", "2015-Sep-08 20:28", "12.5", "1000.25"),
                                     _approach("2016-01-01", "2016-Jan-01 01:00", "1", "2")]},
            {"id": "2433", "name": "433 Eros (A898 PA)", "is_potentially_hazardous_asteroid": False,
             "close_approach_data": [_approach("2015-09-08", "2015-Sep-08 21:00", "NaN", "5")]},
            {"id": "77", "name": "(2020 AB)", "is_potentially_hazardous_asteroid": True,
             "close_approach_data": []},
        ],
        "2015-09-09": [],
        "2015-09-10": [
            {"id": "88", "name": "(2020 CD)", "is_potentially_hazardous_asteroid": None,
             "close_approach_data": [_approach("2015-09-10", "2015-Sep-10 00:05", "3", "4")]},
        ],
    },
}


def _land(tmpdir, name, lines):
    p = f"{tmpdir}/{name}"
    import os
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/part-0.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_flatten_feed_first_approach_per_object(spark, tmp_path):
    feed = read_feed(spark, _land(tmp_path, "feed", [json.dumps(FEED_DOC)]))
    rows = flatten_feed(feed).orderBy("close_approach_date_full").collect()
    assert [r.id for r in rows] == ["2433", "2433", "88"]  # one id twice is kept twice
    first = rows[0]
    assert str(first.close_approach_date_full) == "2015-09-08 20:28:00"
    assert str(first.close_approach_date) == "2015-09-08 00:00:00"
    assert first.relative_velocity_km_per_second == 12.5 and first.miss_distance_km == 1000.25
    assert str(first.fecha) == "2015-09-08"
    assert rows[1].relative_velocity_km_per_second is None  # NaN text -> NULL
    assert rows[2].is_potentially_hazardous is None


def test_feed_rejects_empty_approach_list(spark, tmp_path):
    feed = read_feed(spark, _land(tmp_path, "feed", [json.dumps(FEED_DOC)]))
    assert [(r.feed_day, r.id) for r in feed_rejects(feed).collect()] == [("2015-09-08", "77")]


def test_feed_element_check(spark, tmp_path):
    doc2 = {"element_count": 5, "near_earth_objects": {"2015-09-11": []}}
    feed = read_feed(spark, _land(tmp_path, "feed", [json.dumps(FEED_DOC), json.dumps(doc2)]))
    r = feed_element_check(feed).first()
    assert (r.documents, r.declared_total, r.flattened_total, r.mismatched_documents) == (2, 9, 4, 1)


def test_empty_feed_gives_empty_frame(spark, tmp_path):
    doc = {"element_count": 0, "near_earth_objects": {}}
    feed = read_feed(spark, _land(tmp_path, "feed", [json.dumps(doc)]))
    assert flatten_feed(feed).count() == 0


LOOKUP = {"id": "2433", "name": "433 Eros (A898 PA)", "absolute_magnitude_h": 10.4,
          "estimated_diameter": {"kilometers": {"estimated_diameter_min": 1.5, "estimated_diameter_max": 3.0}},
          "is_potentially_hazardous_asteroid": False, "is_sentry_object": None, "nasa_jpl_url": "x/2433"}


def test_lookup_flatten_and_quarantine(spark, tmp_path):
    bad = json.dumps(dict(LOOKUP, id="99"))[:40]
    nulls = dict(LOOKUP, id="5", estimated_diameter={"kilometers": {"estimated_diameter_min": None,
                                                                   "estimated_diameter_max": None}})
    parsed, quarantine = read_lookup_documents(spark, _land(tmp_path, "lk", [json.dumps(LOOKUP), bad,
                                                                              json.dumps(nulls)]))
    rows = {r.id: r for r in flatten_lookups(parsed).collect()}
    assert set(rows) == {"2433", "5"}
    assert rows["2433"].diameter_max_km == 3.0 and rows["2433"].is_sentry_object is False
    assert rows["5"].diameter_min_km is None
    assert [r.id for r in quarantined_ids(quarantine).collect()] == [99]


def test_wrong_lookup_documents_are_quarantined(spark, tmp_path):
    one = json.dumps(LOOKUP)
    wrong = [json.dumps(dict(LOOKUP, absolute_magnitude_h="oops")), json.dumps(dict(LOOKUP, is_sentry_object="yes")), "[]",
             json.dumps({k: v for k, v in LOOKUP.items() if k != "id"}), one + one, one + " and more", "null", "7"]
    parsed, quarantine = read_lookup_documents(spark, _land(tmp_path, "wrong", [one, *wrong, json.dumps({"id": "8"})]))
    assert sorted(r.id for r in parsed.collect()) == ["2433", "8"]
    assert sorted(r[0] for r in quarantine.collect()) == sorted(wrong)


def test_ingest_keeps_rejects_and_reads_multiline_documents(spark, tmp_path, scratch):
    from stratiform.paths import Lake
    from stratiform.plans.jobs import ingest_bronze
    p = tmp_path / "feed_ml"
    p.mkdir()
    (p / "pull.json").write_text(json.dumps(FEED_DOC, indent=2))  # one pretty-printed document per file
    feed = read_feed(spark, str(p), multi_line=True)
    lookups = spark.createDataFrame([], "id string, name string, absolute_magnitude_h double, "
                                        "diameter_min_km double, diameter_max_km double, "
                                        "is_potentially_hazardous boolean, is_sentry_object boolean, "
                                        "nasa_jpl_url string")
    lake = Lake(scratch("rej"))
    assert ingest_bronze(lake, feed, lookups) is not None
    assert spark.read.parquet(lake.bronze_approaches).count() == 3
    assert [r.id for r in spark.read.parquet(lake.bronze_rejects).collect()] == ["77"]


def test_one_large_landed_file_is_read_in_parallel(spark, scratch):
    from conftest import SF_ORACLE
    from stratiform.sources.standins import feed_documents, load
    path = f"{scratch('one-file')}/feed"
    feed_documents(load(spark, SF_ORACLE, "events")).coalesce(1).write.text(path)  # a single file
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        feed = read_feed(spark, path)
        assert feed.rdd.getNumPartitions() > 1
        assert flatten_feed(feed).count() == 10000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
