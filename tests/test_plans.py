import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from motefield.operators import filters as fl
from motefield.operators import hulls as hl
from motefield.operators import votes as vo
from motefield.operators import voxels as vx
from motefield.plans import scenes as pl


def plan(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def parquet(spark, path, n=300):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(n, 9)), columns=["x", "y", "z", "scale_0", "scale_1", "scale_2", "f_dc_0", "f_dc_1", "f_dc_2"])
    spark.createDataFrame(pdf.assign(scene_id=0, id=range(n))).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_scale_limit_reaches_the_scan(spark, tmp_path):
    text = plan(fl.max_scale_filter(parquet(spark, tmp_path / "s")).select("id"))
    pushed = text[text.index("PushedFilters"):]
    assert all(f"LessThanOrEqual(scale_{i}," in pushed for i in range(3))
    assert "ReadSchema: struct<scale_0:double,scale_1:double,scale_2:double,id:bigint>" in text


def test_small_statistics_do_not_move_the_rows(spark, tmp_path):
    text = plan(vx.with_voxel_count(parquet(spark, tmp_path / "s"), ["scene_id"], 0.1).select("id", "density"))
    physical = text[text.index("Physical Plan"):]
    assert "BroadcastHashJoin" in physical and "Exchange hashpartitioning" not in physical


def test_hull_is_an_equi_join_on_tiles(spark, tmp_path):
    s = parquet(spark, tmp_path / "s")
    cam = dict(scene_id=0, view_id=0, f=50.0, w=100, h=80, **{f"r{i}{j}": float(i == j) for i in range(3) for j in range(3)}, t0=0.0, t1=0.0, t2=-5.0)
    views = spark.createDataFrame(pd.DataFrame([cam]))
    boxes = spark.createDataFrame([(0, 1, 10, 10, 60, 60)], "scene_id bigint, item_id int, x0 int, y0 int, x1 int, y1 int")
    df = hl.visual_hull(s, views, boxes, ["scene_id"])
    physical = plan(df)[plan(df).index("Physical Plan"):]
    assert "NestedLoop" not in physical and "Cartesian" not in physical and df.count() > 0
    assert df.agg(F.count_distinct("id")).first()[0] == df.count()


def test_box_votes_fold_views_before_the_only_shuffle(spark, tmp_path):
    s = parquet(spark, tmp_path / "s")
    cam = dict(scene_id=0, f=50.0, w=100, h=80, **{f"r{i}{j}": float(i == j) for i in range(3) for j in range(3)}, t0=0.0, t1=0.0, t2=-5.0, x0=10, y0=10, x1=60, y1=60)
    views = spark.createDataFrame(pd.DataFrame([cam | {"view_id": i} for i in range(3)]))
    df = vo.box_votes(s, views, ["scene_id"], ["id"])
    steps = re.findall(r"\+- (HashAggregate|Exchange|BroadcastHashJoin)\b", plan(df).split("\n\n")[0])
    assert steps == ["HashAggregate", "Exchange", "HashAggregate", "BroadcastHashJoin"]
    p = s.toPandas().set_index("id").sort_index()
    depth = 5 - p.z
    u, v = 50 * p.x / depth + 50, 50 * p.y / depth + 40
    seen = (depth > 0) & (u >= 0) & (u < 100) & (v >= 0) & (v < 80)
    hit = seen & (u >= 10) & (u <= 60) & (v >= 10) & (v <= 60)
    got = df.toPandas().set_index("id").sort_index()
    assert (got.visible == 3 * seen).all() and (got.votes == 3 * hit).all() and (got.n_views == 3).all() and hit.sum() > 10


def test_only_pixels_in_an_image_are_looked_up(spark, tmp_path):
    """With every side over the broadcast limit, the exchange below the look-up stands on a filter for the image."""
    s = parquet(spark, tmp_path / "s")
    cam = dict(scene_id=0, f=50.0, w=100, h=80, **{f"r{i}{j}": float(i == j) for i in range(3) for j in range(3)}, t0=0.0, t1=0.0, t2=-5.0)
    views = spark.createDataFrame(pd.DataFrame([cam | {"view_id": i} for i in range(3)]))
    runs = spark.createDataFrame([(0, i, y, 5, 70) for i in range(3) for y in range(10, 50)], "scene_id bigint, view_id bigint, y int, x0 int, x1 int")
    index = vo.mask_index(runs, ["scene_id", "view_id"])
    seen = vo.masked_views(views, index, ["scene_id"])
    spark.conf.set("motefield.broadcast.bytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = vo.mask_votes(s, seen, index, ["scene_id"], ["id"])
        tree = plan(df).split("\n\n")[0]
        below = tree[tree.index("SortMergeJoin LeftOuter"):]
        moved = below[below.index("Exchange") + 1:]
        moved = moved[:moved.index("Exchange")]
        filters = re.findall(r"Filter \((\d+)\)", moved)
        said = [re.search(rf"\({n}\) Filter.*?Condition : ([^\n]*)", plan(df), re.S).group(1) for n in filters]
        assert any(re.fullmatch(r"\(?inside#\d+\)?", c) or "inside#" in c for c in said), said
        rows = df.count()
    finally:
        spark.conf.unset("motefield.broadcast.bytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == s.count()


def test_tile_words_hold_each_pixel_once(spark):
    runs = [(0, 3, 0, 63), (0, 3, 60, 64), (0, 3, 127, 128), (0, 4, 130, 400), (0, 5, 7, 7), (0, 5, 7, 9), (0, 6, 9, 8), (1, 3, 191, 192)]
    index = vo.mask_index(spark.createDataFrame(runs, "view_id int, y int, x0 int, x1 int"), ["view_id"], {"all": F.lit(True), "low": F.col("x1") < 100}).toPandas()
    def pixels(layer):
        words = index[index[layer].notna()]
        return sorted((r.view_id, r.y, r.tile * 64 + i) for r in words.itertuples() for i in range(64) if int(getattr(r, layer)) >> i & 1)
    want = lambda keep: sorted({(v, y, x) for v, y, a, b in runs if keep(b) for x in range(a, b + 1)})
    assert not index.duplicated(["view_id", "y", "tile"]).any()
    assert pixels("all") == want(lambda b: True)
    assert pixels("low") == want(lambda b: b < 100)


def test_cleaning_runs_the_chain_once(spark, monkeypatch):
    """The last steps of the chain run once for the count of voxels, the cleaned rows and the ladder."""
    runs = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    rows = spark.range(90).select((F.col("id") % 2).alias("scene_id"), *[(F.col("id") % 3).cast("double").alias(c) for c in "xyz"])
    monkeypatch.setattr(pl.fl, "slice_chain", lambda splats, planes: splats.mapInArrow(told, splats.schema))
    cleaned, ladder = pl.clean_scenes(rows, None)
    assert {(r.scene_id, r.level): (r.n_kept, r.n_total) for r in ladder.collect()}[0, "C"] == (0, 45)
    assert cleaned.where("density = 15").count() == 90 and runs.value == 90
