import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from motefield.operators import quantiles as q
from motefield.operators.quantiles import axis_percentiles, ordered_bucket, percentiles
from motefield.operators.voxels import with_colour_distance, with_voxel_count


def frame(spark, seed=0):
    rng = np.random.default_rng(seed)
    parts = [pd.DataFrame({"g": 0, "v": rng.normal(size=4000) * 10.0 ** rng.integers(-9, 9, 4000)}),
             pd.DataFrame({"g": 1, "v": rng.integers(-2, 3, 900).astype(float)}),
             pd.DataFrame({"g": 2, "v": np.zeros(50)}), pd.DataFrame({"g": 3, "v": [-7.25]}),
             pd.DataFrame({"g": 4, "v": np.float32(rng.normal(size=300)).astype(float)})]
    return pd.concat(parts)


def test_percentiles_match_numpy(spark, side):
    pdf = frame(spark)
    points = [0.0, 2.0, 10.0, 33.3, 50.0, 95.0, 99.0, 100.0]
    got = percentiles(spark.createDataFrame(pdf), ["g"], {"v": F.col("v")}, [(f"p{i}", "v", p) for i, p in enumerate(points)], "n").toPandas()
    assert len(got) == 5
    for _, row in got.iterrows():
        v = pdf.v[pdf.g == row.g]
        assert row.n == len(v)
        for i, p in enumerate(points):
            assert np.isclose(row[f"p{i}"], np.percentile(v, p), rtol=1e-12, atol=0), (row.g, p)


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 3.0)], "g int, v double")
    assert percentiles(df, ["g"], {"v": F.col("v")}, [("m", "v", 50.0)]).first().m == 2.0


def test_numbers_that_are_not_finite_are_left_out(spark):
    rows = [(1, v) for v in (1.0, float("nan"), 3.0, float("inf"), float("-inf"), None)] + [(2, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    assert [tuple(r) for r in percentiles(df, ["g"], {"v": F.col("v")}, [("m", "v", 50.0)], "n").collect()] == [(1, 2.0, 2)]


def test_crowded_buckets_are_cut(spark, side):
    rng = np.random.default_rng(5)
    parts = [np.linspace(456000, 456010, 5000), np.full(3000, 456001.5), 7e5 + rng.normal(size=4000) * 1e-7, rng.normal(size=2000) * 1e-30]
    pdf = pd.concat([pd.DataFrame({"g": i, "v": v}) for i, v in enumerate(parts)])
    spark.conf.set("motefield.crowded.rows", "50")
    points = [0.0, 5.0, 37.7, 50.0, 99.0, 100.0]
    got = percentiles(spark.createDataFrame(pdf), ["g"], {"v": F.col("v")}, [(f"p{i}", "v", p) for i, p in enumerate(points)], "n").toPandas()
    spark.conf.unset("motefield.crowded.rows")
    assert len(got) == 4
    for _, row in got.iterrows():
        v = pdf.v[pdf.g == row.g]
        assert row.n == len(v) and all(np.isclose(row[f"p{i}"], np.percentile(v, p), rtol=1e-12, atol=0) for i, p in enumerate(points))


def test_bucket_keeps_order(spark):
    v = np.sort(np.concatenate([-np.logspace(-12, 12, 3000), [0.0], np.logspace(-12, 12, 3000), 2.0 ** np.arange(-30, 30), np.nextafter(2.0 ** np.arange(-30, 30), 0)]))
    b = spark.createDataFrame(pd.DataFrame({"v": v})).select("v", ordered_bucket(F.col("v")).alias("b")).toPandas().sort_values("v").b.to_numpy()
    assert (np.diff(b) >= 0).all()


def test_several_axes(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(500, 3)), columns=list("xyz")).assign(g=1)
    row = axis_percentiles(spark.createDataFrame(pdf), ["g"], [5.0, 50.0]).first()
    for a in "xyz":
        assert np.isclose(row[f"{a}_p5"], np.percentile(pdf[a], 5)) and np.isclose(row[f"{a}_p50"], np.median(pdf[a]))


def test_voxel_counts_and_colour(spark, side):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.uniform(0, 0.5, (400, 3)), columns=list("xyz")).assign(scene_id=0)
    pdf.loc[:150, ["x", "y", "z"]] = 0.01          # a crowded voxel
    for i in range(3):
        pdf[f"f_dc_{i}"] = rng.normal(size=400).round(3)
    pdf["id"] = range(400)
    df = spark.createDataFrame(pdf)
    got = with_colour_distance(with_voxel_count(df, ["scene_id"], 0.1), ["scene_id"], 0.1).toPandas().set_index("id").sort_index()
    key = np.floor(pdf[["x", "y", "z"]] / 0.1).astype(int).apply(tuple, axis=1)
    assert (got.density.to_numpy() == key.map(key.value_counts()).to_numpy()).all()
    dc = pdf[[f"f_dc_{i}" for i in range(3)]]
    want = np.linalg.norm(dc - dc.groupby(key).transform("mean"), axis=1)
    assert np.allclose(got.colour_dist, want)


def plain_cuts(part, steps):
    """Percentiles of the rows left, one step after the other."""
    left, out = part[np.isfinite(part.v)], []
    for pct, below, always in steps:
        out.append(np.percentile(left.v, pct) if len(left) else None)
        drop = left[always] | ((left.v < out[-1]) & left[below]) if len(left) else []
        left = left[~np.array(drop, bool)]
    return out


@pytest.mark.parametrize("crowded", [None, 40])
def test_chained_cuts_are_those_of_one_step_after_the_other(spark, side, crowded):
    rng = np.random.default_rng(11)
    sizes = {0: 4000, 1: 1, 2: 37, 3: 900, 4: 5}
    parts = []
    for g, n in sizes.items():
        v = {0: rng.normal(size=n), 3: 5e5 + rng.integers(0, 7, n) / 1024}.get(g, rng.integers(0, 5, n).astype(float))
        parts.append(pd.DataFrame({"g": g, "v": v, "yes": True, "no": False, "a": rng.random(n) < 0.5, "b": rng.random(n) < (1.0 if g == 4 else 0.2)}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf.loc[rng.random(len(pdf)) < 0.02, "v"] = np.nan
    steps = [(10.0, "yes", "b"), (10.0, "a", "no"), (50.0, "yes", "no"), (97.0, "a", "a"), (10.0, "no", "no")]
    if crowded:
        spark.conf.set("motefield.crowded.rows", str(crowded))
    try:
        df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != 2, F.col("g")))
        cuts = q.chained_cuts(df, ["g"], F.col("v"), [q.Cut(f"c{i}", p, F.col(lo), F.col(al)) for i, (p, lo, al) in enumerate(steps)])
        got = {r.g: [r[f"c{i}"] for i in range(len(steps))] for r in cuts.collect()}
    finally:
        spark.conf.unset("motefield.crowded.rows")
    want = {None if g == 2 else g: plain_cuts(part, steps) for g, part in pdf.groupby("g")}
    assert set(got) == {g for g, w in want.items() if w[0] is not None}
    for g in got:
        for a, b in zip(want[g], got[g]):
            assert (a is None) == (b is None) and (a is None or b == pytest.approx(float(a), rel=1e-14, abs=0)), (g, want[g], got[g])
    assert got[4][1:] == [None] * 4


def test_chained_cuts_read_the_rows_twice(spark, tmp_path):
    rng = np.random.default_rng(3)
    pd.DataFrame({"g": rng.integers(0, 3, 20000), "v": rng.normal(size=20000), "a": rng.random(20000) < 0.3}).to_parquet(tmp_path / "t.parquet")
    written = []
    keep = q.stage
    q.stage = lambda df: written.append(df) or keep(df)
    try:
        df = spark.read.parquet(str(tmp_path / "t.parquet"))
        no = F.lit(False)
        assert q.chained_cuts(df, ["g"], F.col("v"), [q.Cut("c", 10.0, F.lit(True), no), q.Cut("d", 10.0, F.col("a"), no), q.Cut("e", 10.0, no, no)]).count() == 3
    finally:
        q.stage = keep
    assert len(written) == 2
