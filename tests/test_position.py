"""Positions, tiles, running totals and quantiles against plain windows and numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from holdfast.functions.hashing import cell_of, shuffle_key
from holdfast.operators.cumulative import cumulate, exact_quantiles, slab_edges
from holdfast.operators.position import tile, with_position


@pytest.fixture(scope="module")
def tied(spark):
    """600 rows, a third of them on one level, some levels NULL."""
    draw = random.Random(3)
    rows = []
    for i in range(600):
        level = 7 if i % 3 == 0 else draw.choice([None, 1, 2, 3, 4, 9])
        rows.append((f"id{i}", level, draw.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "id string, level int, g string").cache()


@pytest.mark.parametrize("rows_per_cell", [7, 50, 10_000])
@pytest.mark.parametrize("way", ["asc", "desc"])
def test_position_equals_the_global_window(tied, rows_per_cell, way):
    placed = with_position(tied, "id", [("level", way)], rows_per_cell=rows_per_cell)
    key = F.col("level").desc() if way == "desc" else F.col("level").asc()
    everything = Window.partitionBy(F.lit(1))
    plain = everything.orderBy(key, shuffle_key("id", 0), "id")
    ranked = everything.orderBy(key)
    off = placed.select(
        (F.col("position") == F.row_number().over(plain) - 1).alias("p"),
        (F.col("level_start") == F.rank().over(ranked) - 1).alias("s"),
        (F.col("group_rows") == 600).alias("n"),
        (tile(F.col("position"), F.col("group_rows"), 10) == F.ntile(10).over(plain)).alias("t"),
    ).where(~(F.col("p") & F.col("s") & F.col("n") & F.col("t")))
    assert placed.count() == 600
    assert off.count() == 0


def test_position_within_groups_and_without_order(tied):
    placed = with_position(tied, "id", within=["g"], seed=5, rows_per_cell=11)
    w = Window.partitionBy("g").orderBy(shuffle_key("id", 5), "id")
    off = placed.withColumn("want", F.row_number().over(w) - 1)
    assert off.where(F.col("want") != F.col("position")).count() == 0
    assert placed.count() == 600


def test_position_does_not_depend_on_partitioning(tied):
    first = with_position(tied, "id", [("level", "desc")], rows_per_cell=20)
    second = with_position(tied.repartition(13), "id", [("level", "desc")], rows_per_cell=90)
    cols = ["id", "position"]
    assert first.select(cols).exceptAll(second.select(cols)).count() == 0


@pytest.mark.parametrize("rows", [1, 3, 9, 10, 11, 25, 99])
def test_tile_equals_ntile_for_any_size(spark, rows):
    df = spark.range(rows)
    w = Window.partitionBy(F.lit(1)).orderBy("id")
    both = df.select(
        tile(F.col("id"), F.lit(rows), 10).alias("a"), F.ntile(10).over(w).alias("b")
    )
    assert both.where(F.col("a") != F.col("b")).count() == 0


def test_cells_follow_the_digest_order(spark):
    df = spark.range(2000).select(shuffle_key("id", 1).alias("d"))
    cells = [r["c"] for r in df.select("d", cell_of(F.col("d"), 37).alias("c")).orderBy("d").collect()]
    assert cells == sorted(cells)
    assert set(cells) == set(range(37))


@pytest.mark.parametrize("rows_per_slab", [25, 10_000])
def test_cumulate_over_slabs(spark, rows_per_slab):
    draw = random.Random(1)
    rows = [(draw.choice("xy"), draw.choice([0.5, draw.random()]), 1) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    edges = slab_edges(df, "v", rows_per_slab)
    assert (len(edges) > 5) == (rows_per_slab == 25)
    hist = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    out = cumulate(hist, "v", ["n"], edges, ["g"], descending=True)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    checked = out.withColumn("want", F.sum("n").over(w) - F.col("n"))
    assert checked.where(F.col("want") != F.col("n_before")).count() == 0
    totals = {r["g"]: r["t"] for r in out.groupBy("g").agg(F.max("n_total").alias("t")).collect()}
    assert sum(totals.values()) == 500


@pytest.mark.parametrize("rows_per_slab", [30, 10_000])
def test_exact_quantiles_match_numpy(spark, rows_per_slab):
    draw = random.Random(9)
    rows = [("a", draw.gauss(0, 5)) for _ in range(301)]
    rows += [("b", draw.choice([1.0, 1.0, 2.0, 8.0])) for _ in range(200)]
    rows += [("b", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(df, "v", shares, ["g"], rows_per_slab).collect()
    for r in found:
        values = [v for g, v in rows if g == r["g"] and v is not None and v == v]
        assert r["n"] == len(values)
        got = [r[f"q{i}"] for i in range(len(shares))]
        np.testing.assert_allclose(got, np.percentile(values, [100 * s for s in shares]), rtol=1e-12)
