"""DuckDB SQL equal in meaning to each registered query (independent formulation)."""

# Shared CTE text: the stand-in layers written in plain SQL.
BRONZE_APPROACHES = """
  SELECT CAST(user_id AS VARCHAR) AS id,
         CAST(user_id AS VARCHAR) || ' (' || event_type || ')' AS name,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS close_approach_date,
         ts AS close_approach_date_full,
         value AS relative_velocity_km_per_second,
         value * 1000.0 + CAST(json_extract_string(props, '$.k') AS DOUBLE) AS miss_distance_km,
         event_type AS orbiting_body,
         event_type = 'error' AS is_potentially_hazardous,
         CAST(ts AS DATE) AS fecha
  FROM events"""

BRONZE_METADATA = """
  SELECT CAST(p_partkey AS VARCHAR) AS id,
         CASE WHEN p_partkey % 3 = 0
              THEN CAST(p_partkey AS VARCHAR) || ' ' || p_name || ' (' || p_brand || ')'
              ELSE '(' || p_brand || ')' END AS name,
         10.0 + p_size / 2.0 AS absolute_magnitude_h,
         CAST(p_size AS DOUBLE) AS diameter_min_km,
         CAST(p_retailprice AS DOUBLE) AS diameter_max_km,
         p_size > 40 AS is_potentially_hazardous,
         p_type = 'PROMO' AS is_sentry_object,
         'catalog/' || CAST(p_partkey AS VARCHAR) AS nasa_jpl_url
  FROM part"""

SILVER_APPROACHES = f"""
  SELECT CAST(id AS BIGINT) AS id, close_approach_date_full,
         relative_velocity_km_per_second, miss_distance_km, orbiting_body,
         CAST(close_approach_date_full AS DATE) AS fecha,
         CAST(hour(close_approach_date_full) AS INTEGER) AS hora
  FROM ({BRONZE_APPROACHES})"""

SILVER_METADATA = f"""
  SELECT CAST(id AS BIGINT) AS id, absolute_magnitude_h, diameter_min_km, diameter_max_km,
         is_potentially_hazardous, is_sentry_object,
         NULLIF(regexp_extract(name, '^(\\d+)\\s', 1), '') AS numero_oficial,
         NULLIF(regexp_extract(name, '\\((.+)\\)', 1), '') AS designacion_provisional,
         regexp_matches(name, '^\\d+\\s') AS tiene_designacion_oficial,
         diameter_max_km - diameter_min_km AS incertidumbre_diametro_km,
         is_potentially_hazardous OR is_sentry_object AS bajo_seguimiento_riesgo
  FROM ({BRONZE_METADATA})"""


def daily_summary_sql(approaches: str, metadata: str) -> str:
    return f"""
  SELECT a.fecha,
         COUNT(a.id) AS cantidad_aproximaciones,
         round_even(AVG(a.relative_velocity_km_per_second) * 100, 0) / 100 AS velocidad_promedio_km_s,
         round_even(MAX(a.relative_velocity_km_per_second) * 100, 0) / 100 AS velocidad_maxima_km_s,
         round_even(MIN(a.miss_distance_km) * 100, 0) / 100 AS distancia_minima_km,
         round_even(AVG(a.miss_distance_km) * 100, 0) / 100 AS distancia_promedio_km,
         COALESCE(SUM(CAST(m.bajo_seguimiento_riesgo AS DOUBLE)), 0.0) AS cantidad_bajo_seguimiento_riesgo,
         round_even(MAX(m.diameter_max_km) * 100, 0) / 100 AS diametro_maximo_km
  FROM ({approaches}) a LEFT JOIN ({metadata}) m ON a.id = m.id
  WHERE a.fecha IS NOT NULL
  GROUP BY a.fecha"""


ORACLES = {
    "daily_summary": daily_summary_sql(SILVER_APPROACHES, SILVER_METADATA),
}


# --- the two deliveries and the single pull (fixed values, same as plans/scenario.py) -----------
RUN1_WHERE = "ts <= TIMESTAMP '2024-01-17 12:00:00'"
RUN2_WHERE = "ts >= TIMESTAMP '2024-01-14 00:00:00'"
PULL_WHERE = "ts >= TIMESTAMP '2024-01-07 00:00:00' AND ts < TIMESTAMP '2024-01-14 00:00:00'"


def bronze_approaches_where(where: str) -> str:
    return f"SELECT * FROM ({BRONZE_APPROACHES} WHERE {where})"


def silver_of(bronze: str) -> str:
    return f"""
  SELECT CAST(id AS BIGINT) AS id, close_approach_date_full,
         relative_velocity_km_per_second, miss_distance_km, orbiting_body,
         CAST(close_approach_date_full AS DATE) AS fecha,
         CAST(hour(close_approach_date_full) AS INTEGER) AS hora
  FROM ({bronze})"""


def silver_meta_of(bronze: str) -> str:
    return f"""
  SELECT CAST(id AS BIGINT) AS id, absolute_magnitude_h, diameter_min_km, diameter_max_km,
         is_potentially_hazardous, is_sentry_object,
         NULLIF(regexp_extract(name, '^(\\d+)\\s', 1), '') AS numero_oficial,
         NULLIF(regexp_extract(name, '\\((.+)\\)', 1), '') AS designacion_provisional,
         regexp_matches(name, '^\\d+\\s') AS tiene_designacion_oficial,
         diameter_max_km - diameter_min_km AS incertidumbre_diametro_km,
         is_potentially_hazardous OR is_sentry_object AS bajo_seguimiento_riesgo
  FROM ({bronze})"""


# Feed documents carry times to the minute: the flat rows of a landed feed.
FEED_FLAT = """
  SELECT CAST(user_id AS VARCHAR) AS id,
         CAST(user_id AS VARCHAR) || ' (' || event_type || ')' AS name,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS close_approach_date,
         date_trunc('minute', ts) AS close_approach_date_full,
         value AS relative_velocity_km_per_second,
         value * 1000.0 + CAST(json_extract_string(props, '$.k') AS DOUBLE) AS miss_distance_km,
         event_type AS orbiting_body,
         event_type = 'error' AS is_potentially_hazardous,
         CAST(ts AS DATE) AS fecha
  FROM events"""

FANOUT_METADATA = silver_meta_of(f"""
  SELECT m.* FROM ({BRONZE_APPROACHES}) r JOIN ({BRONZE_METADATA}) m ON r.id = m.id""")

REJECTS = """
  SELECT strftime(ts, '%Y-%m-%d') AS feed_day, CAST(user_id AS VARCHAR) AS id,
         CAST(user_id AS VARCHAR) || ' (' || event_type || ')' AS name
  FROM events WHERE event_type = 'error'"""

BROKEN = "p_name LIKE 'hot %'"
CATALOG_OK = f"SELECT * FROM ({BRONZE_METADATA}) WHERE CAST(id AS BIGINT) NOT IN (SELECT p_partkey FROM part WHERE {BROKEN})"

def two_runs_sql(distinct_lookups: bool = False) -> str:
    """CTEs of the lake after two pulls (bronze merges insert-only).

    Lookups answer every request (an entity once per approach row), or each
    entity once per pull with ``distinct_lookups``.
    """
    if distinct_lookups:
        bm1 = "SELECT cat.* FROM cat WHERE cat.id IN (SELECT id FROM r1)"
        new2 = "SELECT cat.* FROM cat WHERE cat.id IN (SELECT id FROM r2)"
    else:
        bm1 = "SELECT cat.* FROM r1 JOIN cat ON r1.id = cat.id"
        new2 = "SELECT cat.* FROM r2 JOIN cat ON r2.id = cat.id"
    return f"""
  r1 AS (SELECT * FROM ({FEED_FLAT} WHERE {RUN1_WHERE})),
  r2 AS (SELECT * FROM ({FEED_FLAT} WHERE {RUN2_WHERE})),
  ba AS (SELECT * FROM r1 UNION ALL
         SELECT * FROM r2 WHERE NOT EXISTS (
           SELECT 1 FROM r1 WHERE r1.id = r2.id AND r1.close_approach_date = r2.close_approach_date)),
  cat AS ({CATALOG_OK}),
  bm1 AS ({bm1}),
  bm AS (SELECT * FROM bm1 UNION ALL
         SELECT * FROM ({new2}) n WHERE n.id NOT IN (SELECT id FROM bm1)),
  sa AS ({silver_of('SELECT * FROM ba')}),
  sm AS ({silver_meta_of('SELECT * FROM bm')})"""


TWO_RUNS = two_runs_sql()


def _joined_sql() -> str:
    return f"""
  SELECT a.*, m.diameter_max_km, CAST(m.bajo_seguimiento_riesgo AS DOUBLE) AS bajo_seguimiento_riesgo
  FROM ({SILVER_APPROACHES}) a LEFT JOIN ({SILVER_METADATA}) m ON a.id = m.id"""


def _r2(expr: str) -> str:
    return f"round_even(({expr}) * 100, 0) / 100"


ORACLES.update({
    "daily_summary_fanout": daily_summary_sql(SILVER_APPROACHES, FANOUT_METADATA),
    "join_left_fanout": f"""
  WITH m AS (SELECT id, COUNT(*) AS metadata_rows,
                    SUM(CAST(bajo_seguimiento_riesgo AS DOUBLE)) AS bajo_seguimiento_riesgo,
                    MAX(diameter_max_km) AS diameter_max_km
             FROM ({FANOUT_METADATA}) GROUP BY id)
  SELECT a.id, a.close_approach_date_full, a.fecha, a.relative_velocity_km_per_second,
         COALESCE(m.metadata_rows, 0) AS metadata_rows, m.bajo_seguimiento_riesgo, m.diameter_max_km
  FROM ({SILVER_APPROACHES}) a LEFT JOIN m ON a.id = m.id""",
    "agg_count": f"""
  SELECT fecha, COUNT(id) AS cantidad_aproximaciones FROM ({_joined_sql()})
  WHERE fecha IS NOT NULL GROUP BY fecha""",
    "agg_mean": f"""
  SELECT fecha, {_r2('AVG(relative_velocity_km_per_second)')} AS velocidad_promedio_km_s,
         {_r2('AVG(miss_distance_km)')} AS distancia_promedio_km
  FROM ({_joined_sql()}) WHERE fecha IS NOT NULL GROUP BY fecha""",
    "agg_min_max": f"""
  SELECT fecha, MAX(relative_velocity_km_per_second) AS velocidad_maxima_km_s,
         MIN(miss_distance_km) AS distancia_minima_km, MAX(diameter_max_km) AS diametro_maximo_km
  FROM ({_joined_sql()}) WHERE fecha IS NOT NULL GROUP BY fecha""",
    "agg_flag_sum": f"""
  SELECT a.id, COALESCE(SUM(CAST(m.bajo_seguimiento_riesgo AS DOUBLE)), 0.0) AS cantidad_bajo_seguimiento_riesgo
  FROM ({SILVER_APPROACHES}) a LEFT JOIN ({SILVER_METADATA}) m ON a.id = m.id
  WHERE a.id IS NOT NULL GROUP BY a.id""",
    "agg_null_key": """
  SELECT l.quality, COUNT(d.doc_id) AS documents
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  WHERE l.quality IS NOT NULL GROUP BY l.quality""",
    "distinct_keys": f"SELECT DISTINCT id, fecha FROM ({SILVER_APPROACHES})",
    "silver_approaches": SILVER_APPROACHES,
    "silver_metadata": SILVER_METADATA,
    "cast_timestamp": """
  SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS close_approach_date,
         date_trunc('minute', ts) AS close_approach_date_full FROM events""",
    "cast_id": f"SELECT id AS id_text, CAST(id AS BIGINT) AS id FROM ({BRONZE_APPROACHES})",
    "cast_double": """
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         value AS relative_velocity_km_per_second FROM events""",
    "cast_bool": """
  SELECT d.doc_id, COALESCE(l.toxic = 1, false) AS is_toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "date_hour_split": """
  SELECT event_id, CAST(ts AS DATE) AS fecha, CAST(hour(ts) AS INTEGER) AS hora FROM events""",
    "name_number": f"SELECT id, numero_oficial FROM ({SILVER_METADATA})",
    "name_provisional": f"SELECT id, designacion_provisional FROM ({SILVER_METADATA})",
    "name_has_number": f"SELECT id, tiene_designacion_oficial FROM ({SILVER_METADATA})",
    "diff_range": f"SELECT id, incertidumbre_diametro_km FROM ({SILVER_METADATA})",
    "flag_or": f"SELECT id, bajo_seguimiento_riesgo FROM ({SILVER_METADATA})",
    "round_half_even": f"SELECT event_id, {_r2('value / 8.0')} AS value_eighth FROM events",
    "orphans_by_null": """
  SELECT d.doc_id, COUNT(*) AS orphan_rows
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL GROUP BY d.doc_id""",
    "orphans_by_key": """
  SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "dup_keys": f"""
  SELECT id, close_approach_date, COUNT(*) AS n FROM ({BRONZE_APPROACHES})
  GROUP BY id, close_approach_date HAVING COUNT(*) > 1""",
    "null_profile": f"""
  WITH s AS ({SILVER_METADATA})
  SELECT c AS "column", n AS nulls, (SELECT COUNT(*) FROM s) AS rows FROM (
    SELECT 'id' AS c, COUNT(*) FILTER (WHERE id IS NULL) AS n FROM s UNION ALL
    SELECT 'absolute_magnitude_h', COUNT(*) FILTER (WHERE absolute_magnitude_h IS NULL) FROM s UNION ALL
    SELECT 'diameter_min_km', COUNT(*) FILTER (WHERE diameter_min_km IS NULL) FROM s UNION ALL
    SELECT 'diameter_max_km', COUNT(*) FILTER (WHERE diameter_max_km IS NULL) FROM s UNION ALL
    SELECT 'is_potentially_hazardous', COUNT(*) FILTER (WHERE is_potentially_hazardous IS NULL) FROM s UNION ALL
    SELECT 'is_sentry_object', COUNT(*) FILTER (WHERE is_sentry_object IS NULL) FROM s UNION ALL
    SELECT 'numero_oficial', COUNT(*) FILTER (WHERE numero_oficial IS NULL) FROM s UNION ALL
    SELECT 'designacion_provisional', COUNT(*) FILTER (WHERE designacion_provisional IS NULL) FROM s UNION ALL
    SELECT 'tiene_designacion_oficial', COUNT(*) FILTER (WHERE tiene_designacion_oficial IS NULL) FROM s UNION ALL
    SELECT 'incertidumbre_diametro_km', COUNT(*) FILTER (WHERE incertidumbre_diametro_km IS NULL) FROM s UNION ALL
    SELECT 'bajo_seguimiento_riesgo', COUNT(*) FILTER (WHERE bajo_seguimiento_riesgo IS NULL) FROM s)""",
    "name_lossless": f"""
  WITH p AS (SELECT id, name,
                    NULLIF(regexp_extract(name, '^(\\d+)\\s', 1), '') AS numero_oficial,
                    NULLIF(regexp_extract(name, '\\((.+)\\)', 1), '') AS designacion_provisional
             FROM ({BRONZE_METADATA})),
  r AS (SELECT *, CASE WHEN numero_oficial IS NOT NULL AND designacion_provisional IS NOT NULL
                         THEN numero_oficial || ' (' || designacion_provisional || ')'
                       WHEN numero_oficial IS NOT NULL THEN numero_oficial
                       WHEN designacion_provisional IS NOT NULL THEN '(' || designacion_provisional || ')'
                  END AS rebuilt_name FROM p)
  SELECT * FROM r WHERE rebuilt_name IS DISTINCT FROM name""",
    "peek_top5": f"""
  SELECT * FROM ({BRONZE_APPROACHES}) ORDER BY close_approach_date_full, id LIMIT 5""",
    "window_7d": bronze_approaches_where(PULL_WHERE),
    "pending_by_id": f"""
  SELECT CAST(id AS BIGINT) AS id, name, absolute_magnitude_h, diameter_min_km, diameter_max_km,
         is_potentially_hazardous, is_sentry_object, nasa_jpl_url
  FROM ({BRONZE_METADATA}) m
  WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = CAST(m.id AS BIGINT))""",
    "pending_by_key": f"""
  WITH done AS ({silver_of(bronze_approaches_where(RUN1_WHERE))})
  SELECT CAST(b.id AS BIGINT) AS id, b.name, b.close_approach_date, b.close_approach_date_full,
         b.relative_velocity_km_per_second, b.miss_distance_km, b.orbiting_body,
         b.is_potentially_hazardous, b.fecha
  FROM ({bronze_approaches_where(RUN2_WHERE)}) b
  WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.id IS NOT DISTINCT FROM CAST(b.id AS BIGINT)
                    AND d.close_approach_date_full IS NOT DISTINCT FROM b.close_approach_date_full)""",
    "pending_missing_target": f"""
  SELECT CAST(id AS BIGINT) AS id, name, close_approach_date, close_approach_date_full,
         relative_velocity_km_per_second, miss_distance_km, orbiting_body, is_potentially_hazardous, fecha
  FROM ({BRONZE_APPROACHES})""",
    "merge_create": BRONZE_APPROACHES,
    "merge_insert_by_day": f"""
  WITH t AS ({bronze_approaches_where(RUN1_WHERE)}), s AS ({bronze_approaches_where(RUN2_WHERE)})
  SELECT * FROM t UNION ALL
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM t WHERE t.id = s.id AND t.close_approach_date = s.close_approach_date)""",
    "merge_insert_by_ts": f"""
  WITH t AS ({silver_of(bronze_approaches_where(RUN1_WHERE))}),
       s AS ({silver_of(bronze_approaches_where(RUN2_WHERE))})
  SELECT * FROM t UNION ALL
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM t WHERE t.id = s.id AND t.close_approach_date_full = s.close_approach_date_full)""",
    "merge_insert_dedup": f"""
  WITH t AS ({bronze_approaches_where(RUN1_WHERE)}),
       s AS (SELECT DISTINCT ON (id, close_approach_date) *
             FROM ({bronze_approaches_where(RUN2_WHERE)})
             ORDER BY id, close_approach_date, name NULLS FIRST, close_approach_date_full NULLS FIRST,
                      relative_velocity_km_per_second NULLS FIRST, miss_distance_km NULLS FIRST,
                      orbiting_body NULLS FIRST, is_potentially_hazardous NULLS FIRST, fecha NULLS FIRST)
  SELECT * FROM t UNION ALL
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM t WHERE t.id = s.id AND t.close_approach_date = s.close_approach_date)""",
    "merge_insert_by_id": f"""
  WITH t AS (SELECT m.* FROM ({bronze_approaches_where(RUN1_WHERE)}) r JOIN ({BRONZE_METADATA}) m ON r.id = m.id),
       s AS ({BRONZE_METADATA})
  SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id)""",
    "gold_roundtrip": daily_summary_sql(SILVER_APPROACHES, SILVER_METADATA),
    "partition_roundtrip": SILVER_APPROACHES,
    "migrate_layout": f"""
  SELECT 'bronze/approaches' AS "table", COUNT(*) AS rows FROM events UNION ALL
  SELECT 'bronze/metadata', COUNT(*) FROM part UNION ALL
  SELECT 'silver/approaches', COUNT(*) FROM events UNION ALL
  SELECT 'silver/metadata', COUNT(*) FROM part UNION ALL
  SELECT 'gold/daily_summary', COUNT(*) FROM (SELECT DISTINCT CAST(ts AS DATE) FROM events)""",
    "migrate_layout_rows": f"""
  SELECT *, 'bronze/approaches' AS "table" FROM ({BRONZE_APPROACHES}) UNION ALL BY NAME
  SELECT *, 'bronze/metadata' AS "table" FROM ({BRONZE_METADATA}) UNION ALL BY NAME
  SELECT * REPLACE (CAST(id AS VARCHAR) AS id), 'silver/approaches' AS "table" FROM ({SILVER_APPROACHES}) UNION ALL BY NAME
  SELECT * REPLACE (CAST(id AS VARCHAR) AS id), 'silver/metadata' AS "table" FROM ({SILVER_METADATA}) UNION ALL BY NAME
  SELECT *, 'gold/daily_summary' AS "table" FROM ({daily_summary_sql(SILVER_APPROACHES, SILVER_METADATA)})""",
    "feed_flatten": FEED_FLAT,
    "feed_count_check": """
  SELECT COUNT(DISTINCT (CAST(ts AS DATE), floor(event_id / 100))) AS documents,
         COUNT(*) AS declared_total, COUNT(*) AS flattened_total, CAST(0 AS BIGINT) AS mismatched_documents
  FROM events""",
    "lookup_flatten": BRONZE_METADATA,
    "lookup_quarantine": f"SELECT p_partkey AS id FROM part WHERE {BROKEN}",
    "lookup_semi": f"""
  SELECT * FROM ({BRONZE_METADATA}) m
  WHERE m.id IN (SELECT id FROM ({BRONZE_APPROACHES}))""",
    "lookup_per_request": f"""
  SELECT m.* FROM ({BRONZE_APPROACHES}) r JOIN ({BRONZE_METADATA}) m ON r.id = m.id""",
    "incremental_two_runs": f"WITH {TWO_RUNS} SELECT * FROM sa",
    "reprocess_equals_incremental": f"WITH {TWO_RUNS} SELECT * FROM sa",
    "e2e_daily_summary": f"WITH {TWO_RUNS} {daily_summary_sql('SELECT * FROM sa', 'SELECT * FROM sm')}",
    "e2e_daily_summary_distinct":
        f"WITH {two_runs_sql(True)} {daily_summary_sql('SELECT * FROM sa', 'SELECT * FROM sm')}",
    "integrity_report": f"""
  WITH {TWO_RUNS}
  SELECT COUNT(*) AS orphan_rows, COUNT(DISTINCT a.id) AS orphan_ids
  FROM sa a LEFT JOIN sm m ON a.id = m.id WHERE m.diameter_min_km IS NULL""",
    "orphan_recovery": f"""
  WITH {TWO_RUNS},
  orphan AS (SELECT DISTINCT a.id FROM sa a WHERE NOT EXISTS (SELECT 1 FROM sm WHERE sm.id = a.id))
  SELECT * FROM sm UNION ALL
  SELECT * FROM ({SILVER_METADATA}) WHERE id IN (SELECT id FROM orphan)""",
    "layer_counts": f"""
  WITH {TWO_RUNS}
  SELECT 'bronze' AS layer, 'approaches' AS "table", COUNT(*) AS rows FROM ba UNION ALL
  SELECT 'bronze', 'metadata', COUNT(*) FROM bm UNION ALL
  SELECT 'silver', 'approaches', COUNT(*) FROM sa UNION ALL
  SELECT 'silver', 'metadata', COUNT(*) FROM sm UNION ALL
  SELECT 'gold', 'daily_summary', COUNT(DISTINCT fecha) FROM sa""",
    "stream_ingest": f"WITH {TWO_RUNS} SELECT * FROM ba",
    "gold_after_recovery": f"""
  WITH {TWO_RUNS},
  orphan AS (SELECT DISTINCT a.id FROM sa a WHERE NOT EXISTS (SELECT 1 FROM sm WHERE sm.id = a.id)),
  rsm AS (SELECT * FROM sm UNION ALL SELECT * FROM ({SILVER_METADATA}) WHERE id IN (SELECT id FROM orphan))
  {daily_summary_sql('SELECT * FROM sa', 'SELECT * FROM rsm')}""",
    "silver_rerun_stable": silver_of(f"""
  SELECT * REPLACE (CASE WHEN orbiting_body = 'error' THEN NULL
                         WHEN hour(close_approach_date_full) < 6 THEN close_approach_date_full - INTERVAL 1 DAY
                         ELSE close_approach_date_full END AS close_approach_date_full)
  FROM ({BRONZE_APPROACHES})"""),
    "silver_backlog": SILVER_APPROACHES,
    "feed_rejects": REJECTS,
    "rejects_rerun": REJECTS,
    "schema_replace_roundtrip": SILVER_METADATA,
    "lookup_quarantine_content": """
  SELECT CASE WHEN p_partkey % 5 = 4 THEN 'parsed' ELSE 'quarantined' END AS state,
         CASE WHEN p_partkey % 5 NOT IN (1, 2) THEN p_partkey END AS id FROM part""",
    "lookup_literal_ids": f"""
  SELECT * FROM ({BRONZE_METADATA}) WHERE CAST(id AS BIGINT) IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 1000000000000)""",
    "agg_typed": """
  SELECT user_id, MIN(ts) AS first_ts, MAX(ts) AS last_ts, MIN(event_type) AS first_type, MAX(event_id) AS last_event_id,
         COUNT(value) FILTER (WHERE event_id % 7 <> 0) AS readings
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
})


# columns of the layer tables, for counts of NULLs
_LAYER_COLUMNS = {
    ("bronze", "approaches", "ba"): "id name close_approach_date close_approach_date_full relative_velocity_km_per_second "
                                    "miss_distance_km orbiting_body is_potentially_hazardous fecha",
    ("bronze", "metadata", "bm"): "id name absolute_magnitude_h diameter_min_km diameter_max_km is_potentially_hazardous "
                                  "is_sentry_object nasa_jpl_url",
    ("silver", "approaches", "sa"): "id close_approach_date_full relative_velocity_km_per_second miss_distance_km orbiting_body "
                                    "fecha hora",
    ("silver", "metadata", "sm"): "id absolute_magnitude_h diameter_min_km diameter_max_km is_potentially_hazardous is_sentry_object "
                                  "numero_oficial designacion_provisional tiene_designacion_oficial incertidumbre_diametro_km "
                                  "bajo_seguimiento_riesgo",
    ("gold", "daily_summary", "ds"): "fecha cantidad_aproximaciones velocidad_promedio_km_s velocidad_maxima_km_s distancia_minima_km "
                                     "distancia_promedio_km cantidad_bajo_seguimiento_riesgo diametro_maximo_km",
}


def _report_sql() -> str:
    parts = ["SELECT 'landed' AS layer, 'feed' AS \"table\", 'rows' AS measure, CAST(NULL AS VARCHAR) AS \"column\", "
             "(SELECT count(*) FROM docs) AS n", "SELECT 'landed', 'feed', 'breaks', 'element_count', 0"]
    for (layer, table, cte), columns in _LAYER_COLUMNS.items():
        parts.append(f"SELECT '{layer}', '{table}', 'rows', NULL, count(*) FROM {cte}")
        parts += [f"SELECT '{layer}', '{table}', 'nulls', '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM {cte}" for c in columns.split()]
    docs = " UNION ALL ".join(f"SELECT DISTINCT {i} AS run, CAST(ts AS DATE) AS d, floor(event_id / 100) AS b FROM events WHERE {w}"
                              for i, w in enumerate((RUN1_WHERE, RUN2_WHERE)))
    summary = daily_summary_sql("SELECT * FROM sa", "SELECT * FROM sm")
    return f"WITH {TWO_RUNS}, ds AS ({summary}), docs AS ({docs}) " + " UNION ALL ".join(parts)


ORACLES.update({
    "agg_mean_exact": f"""
  WITH s AS (SELECT *, miss_distance_km * pow(10.0, hora - 15) AS spread FROM ({SILVER_APPROACHES}))
  SELECT orbiting_body, {_r2('AVG(relative_velocity_km_per_second)')} AS velocity_mean, {_r2('AVG(miss_distance_km)')} AS distance_mean,
         {_r2('AVG(spread)')} AS spread_mean
  FROM s WHERE orbiting_body IS NOT NULL GROUP BY orbiting_body""",
    "silver_stream": SILVER_APPROACHES,
    "gold_incremental": ORACLES["gold_after_recovery"],
    "stream_dedup": f"""
  WITH r1 AS (SELECT DISTINCT * FROM ({FEED_FLAT} WHERE {RUN1_WHERE})), r2 AS (SELECT DISTINCT * FROM ({FEED_FLAT} WHERE {RUN2_WHERE}))
  SELECT * FROM r1 UNION ALL
  SELECT * FROM r2 WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.id = r2.id AND r1.close_approach_date = r2.close_approach_date)""",
    "merge_bucketed": ORACLES["merge_insert_by_id"],
    "lookup_clustered": f"""
  SELECT * FROM ({SILVER_APPROACHES}) WHERE id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 1000000000000)""",
    "run_report": _report_sql(),
    "lookup_quarantine_strict": f"""
  SELECT CASE WHEN p_partkey % 6 IN (0, 2, 3) THEN 'quarantined' ELSE 'parsed' END AS state, p_partkey AS id,
         CASE WHEN p_partkey % 6 = 1 THEN '}} {{' || name WHEN p_partkey % 6 IN (4, 5) THEN name END AS name,
         CASE WHEN p_partkey % 6 IN (0, 2, 3) THEN 'not one JSON value' END AS reason
  FROM part JOIN ({BRONZE_METADATA}) m ON m.id = CAST(p_partkey AS VARCHAR)""",
    "layer_diff": f"""
  WITH s AS ({SILVER_APPROACHES}),
  c AS (SELECT CASE WHEN day(fecha) = 20 THEN NULL ELSE fecha END AS fecha,
               CASE WHEN day(fecha) = 11 AND hora = 0 THEN 2 ELSE 1 END AS n
        FROM s WHERE NOT (day(fecha) = 9 AND orbiting_body = 'error')),
  l AS (SELECT fecha, count(*) AS n, max(day(fecha) = 3 AND hora = 5) AS bent FROM s GROUP BY fecha),
  r AS (SELECT fecha, sum(n) AS n FROM c GROUP BY fecha)
  SELECT coalesce(l.fecha, r.fecha) AS fecha, coalesce(l.n, 0) AS left_rows, CAST(coalesce(r.n, 0) AS BIGINT) AS right_rows
  FROM l FULL JOIN r ON l.fecha IS NOT DISTINCT FROM r.fecha
  WHERE l.n IS DISTINCT FROM r.n OR coalesce(bent, false)""",
})
