"""Every training-data query that SQL can express against its DuckDB SQL (sf0.001); the others have a test of their own."""

import duckdb
import pytest

from stratiform.llm.oracles import ORACLES
from stratiform.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
# query -> the test that compares it with a plain version, or with labels
TESTED = {"op1_pack": "test_llm_edge_cases", "op3_licenses": "test_llm_edge_cases", "op4_token_counts": "test_llm_edge_cases",
          "op6_quality": "test_quality_model", "op8_toxicity": "test_toxicity_kernel"}


def test_every_query_has_sql_or_a_test():
    assert set(QUERIES) == set(ORACLES) | set(TESTED)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    bag = lambda cols, rows: sorted((tuple(r[cols.index(c)] for c in sorted(cols)) for r in rows), key=repr)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, want.fetchall())


def test_native_plan_has_no_python(spark):
    plan = QUERIES["op2_contaminated"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "ArrowEval"))
