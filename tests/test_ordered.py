import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlens.functions.search import lower_bound, portable_hash, upper_bound
from wearlens.operators.ordered import exact_quantiles, positions, running_totals, slice_limit


def test_bounds_match_numpy(spark):
    edges = [0.5, 1.0, 1.0, 2.5, 9.0]
    xs = [-1.0, 0.5, 0.7, 1.0, 2.5, 3.0, 9.0, 10.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    e = F.array(*[F.lit(v) for v in edges])
    rows = df.select("x", lower_bound(e, F.col("x"), 5).alias("lo"), upper_bound(e, F.col("x"), 5).alias("hi")).collect()
    for r in rows:
        assert r.lo == np.searchsorted(edges, r.x, "left") and r.hi == np.searchsorted(edges, r.x, "right")


@pytest.mark.parametrize("rows_per_slice", [7, 10_000])
def test_running_totals(spark, rows_per_slice):
    df = spark.range(600).select(
        F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("g"),
        F.col("id").alias("o"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("m"),
        F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000))).alias("x"),
    )
    got = running_totals(df, ["g"], "o", ["m"], rows_per_slice, minima=["x"]).toPandas().sort_values(["g", "o"])
    want = df.toPandas().sort_values(["g", "o"])
    by = want.groupby("g")
    assert (got.m_cum.values == by.m.cumsum().values).all()
    assert (got.m_total.values == by.m.transform("sum").values).all()
    assert got.o_next.fillna(-1).tolist() == by.o.shift(-1).fillna(-1).tolist()
    running = by.x.transform(lambda s: s.astype(float).fillna(np.inf).cummin().shift(1)).replace(np.inf, np.nan)
    assert got.x_min_before.astype(float).fillna(-1).tolist() == running.fillna(-1).tolist()


@pytest.mark.parametrize("rows_per_slice", [9, 10_000])
def test_exact_quantiles(spark, rows_per_slice):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 400), "v": np.round(rng.normal(0, 1, 400), 1)})
    qs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", qs, rows_per_slice).toPandas()
    for g, part in pdf.groupby("g"):
        mine = got[got.g == g].sort_values("q")
        assert np.allclose(mine["quantile"], np.quantile(part.v, qs))


def test_quantiles_of_one_value(spark):
    df = spark.createDataFrame([(4.0,)], "v double")
    assert [r["quantile"] for r in exact_quantiles(df, [], "v", [0.25, 0.75]).collect()] == [4.0, 4.0]


def test_positions_are_dense(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g")).withColumn("h", portable_hash("id", 42))
    got = positions(df, ["g"], "h", "id", 1_000_003, buckets=16).toPandas()
    for _, part in got.groupby("g"):
        assert sorted(part.position) == list(range(len(part))) and (part.group_rows == len(part)).all()
        ordered = part.sort_values("position")
        assert list(zip(ordered.h, ordered.id)) == sorted(zip(part.h, part.id))


def test_limit_needs_a_hot_key(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    assert slice_limit(df, ["k"], 10) is None and slice_limit(df, ["k"], 9) == 9
    assert slice_limit(df.limit(0), ["k"], 1) is None
