import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratiform.operators.aggregates import daily_summary, layer_counts, summarize

A_SCHEMA = "id bigint, fecha date, relative_velocity_km_per_second double, miss_distance_km double"
M_SCHEMA = "id bigint, diameter_max_km double, bajo_seguimiento_riesgo boolean"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
STRATEGIES = ["auto", "broadcast", "preaggregate", "join_first"]


def _summary(spark, a, m, strategy):
    out = daily_summary(spark.createDataFrame(a, A_SCHEMA), spark.createDataFrame(m, M_SCHEMA),
                        strategy=strategy)
    return {r.fecha: r for r in out.collect()}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_daily_rules(spark, strategy):
    a = [(1, D1, 1.0, 10.0), (2, D1, float("nan"), 20.0), (3, D1, 3.0, None),
         (4, D2, 0.125, 1.005), (None, None, 5.0, 5.0)]
    m = [(1, 7.5, True), (1, 2.0, False), (3, None, None)]  # id 1 twice: fan-out
    got = _summary(spark, a, m, strategy)
    assert set(got) == {D1, D2}  # NULL day dropped
    d1 = got[D1]
    assert d1.cantidad_aproximaciones == 4  # 2 rows for id 1 + id 2 + id 3
    assert d1.velocidad_promedio_km_s == round((1 + 1 + 3) / 3, 2)  # NaN skipped, fan-out weighted
    assert d1.velocidad_maxima_km_s == 3.0
    assert d1.distancia_minima_km == 10.0
    assert d1.distancia_promedio_km == round((10 + 10 + 20) / 3, 2)
    assert d1.cantidad_bajo_seguimiento_riesgo == 1.0
    assert d1.diametro_maximo_km == 7.5
    d2 = got[D2]
    assert d2.cantidad_bajo_seguimiento_riesgo == 0.0  # no metadata at all: 0.0, not NULL
    assert d2.diametro_maximo_km is None
    assert (d2.velocidad_promedio_km_s, d2.distancia_promedio_km) == (0.12, 1.0)  # half-even on floats


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_daily_empty_input(spark, strategy):
    assert _summary(spark, [], [], strategy) == {}


def test_output_types(spark):
    out = daily_summary(spark.createDataFrame([(1, D1, 1.0, 1.0)], A_SCHEMA),
                        spark.createDataFrame([(1, 1.0, True)], M_SCHEMA))
    assert out.dtypes == [("fecha", "date"), ("cantidad_aproximaciones", "bigint"),
                          ("velocidad_promedio_km_s", "double"), ("velocidad_maxima_km_s", "double"),
                          ("distancia_minima_km", "double"), ("distancia_promedio_km", "double"),
                          ("cantidad_bajo_seguimiento_riesgo", "double"), ("diametro_maximo_km", "double")]


cents = st.integers(min_value=0, max_value=100000).map(lambda c: c / 100)
rows_a = st.lists(st.tuples(st.integers(0, 6), st.sampled_from([D1, D2, None]), st.one_of(st.none(), cents),
                            st.one_of(st.none(), cents)), max_size=40)
rows_m = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), cents), st.one_of(st.none(), st.booleans())),
                  max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=rows_a, m=rows_m)
def test_strategies_agree_with_pandas(spark, a, m):
    import pandas as pd
    pa = pd.DataFrame(a, columns=["id", "fecha", "v", "d"])
    pm = pd.DataFrame(m, columns=["id", "dmax", "flag"])
    j = pa.merge(pm, on="id", how="left")
    j["flag"] = j["flag"].astype(float)
    exp = (j.dropna(subset=["fecha"]).groupby("fecha")
           .agg(n=("id", "count"), vm=("v", "mean"), vx=("v", "max"), dn=("d", "min"), dm=("d", "mean"),
                f=("flag", "sum"), dx=("dmax", "max")))
    exp[["vm", "vx", "dn", "dm", "dx"]] = exp[["vm", "vx", "dn", "dm", "dx"]].round(2)
    for strategy in STRATEGIES[1:]:
        got = _summary(spark, a, m, strategy)
        assert set(got) == set(exp.index)
        for day, e in exp.iterrows():
            g = got[day]
            for name, ev in [("cantidad_aproximaciones", e.n), ("velocidad_promedio_km_s", e.vm),
                             ("velocidad_maxima_km_s", e.vx), ("distancia_minima_km", e.dn),
                             ("distancia_promedio_km", e.dm), ("cantidad_bajo_seguimiento_riesgo", e.f),
                             ("diametro_maximo_km", e.dx)]:
                gv = getattr(g, name)
                if ev is None or (isinstance(ev, float) and math.isnan(ev)):
                    assert gv is None, (strategy, name)
                else:
                    assert gv == pytest.approx(float(ev), abs=1e-9), (strategy, name, day)


def test_summarize_rules(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), (None, 5.0)], "k string, x double")
    got = {r.k: r.s for r in summarize(df, "k", [("s", "x", "sum")]).collect()}
    assert got == {"a": 0.0, "b": 1.0}
    with pytest.raises(ValueError):
        summarize(df, "k", [("s", "x", "median")])


def test_layer_counts(spark):
    a = spark.range(3)
    b = spark.range(0)
    got = {(r.layer, r.table): r.rows for r in layer_counts({("bronze", "a"): a, ("silver", "b"): b}).collect()}
    assert got == {("bronze", "a"): 3, ("silver", "b"): 0}


def test_fanout_left_join_carries_the_weight(spark):
    from stratiform.operators.aggregates import fanout_left_join
    a = spark.createDataFrame([(1, D1, 1.0, 1.0), (2, D1, 2.0, 2.0), (None, D2, 3.0, 3.0)], A_SCHEMA)
    m = spark.createDataFrame([(1, 7.5, True), (1, 2.0, None), (3, 1.0, False)], M_SCHEMA)
    got = {r.relative_velocity_km_per_second: r for r in fanout_left_join(a, m).collect()}
    assert (got[1.0].metadata_rows, got[1.0].bajo_seguimiento_riesgo, got[1.0].diameter_max_km) == (2, 1.0, 7.5)
    assert (got[2.0].metadata_rows, got[2.0].bajo_seguimiento_riesgo) == (0, None)
    assert got[3.0].metadata_rows == 0 and len(got) == 3


def test_per_request_lookup_answers_once_per_request(spark):
    from stratiform.operators.merge import lookup
    ids = spark.createDataFrame([("1",), ("1",)], "id string")
    cat = spark.createDataFrame([("1", "a"), ("1", "a")], "id string, name string")
    assert lookup(ids, cat).count() == 2
