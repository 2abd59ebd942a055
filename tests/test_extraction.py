import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from motefield.operators import votes as vo
from motefield.plans import scenes as pl

W, H = 90, 70


def given(spark, runs, **more):
    keys = ["scene_id", "item_id", "view_id"]
    cam = dict(scene_id=0, **{f"r{i}{j}": float(i == j) for i in range(3) for j in range(3)}, t0=0.0, t1=0.0, t2=-2.0, f=40.0, w=W, h=H)
    views = spark.createDataFrame(pd.DataFrame([cam | {"view_id": i} for i in range(4)]))
    index = vo.mask_index(spark.createDataFrame(runs), keys, {"wide": F.lit(True), "tight": F.col("view_id") < 1})
    e = object.__new__(pl.Extraction)
    e.g = pl.Inputs(splats=None, hull_view=None, boxes=None, views=views, planes=None, masks=index, view_boxes=None, ids=["id"], **more)
    e.keys, e.row = ["scene_id", "item_id"], ["id", "item_id"]
    return e


def test_each_object_is_judged_by_its_own_masks_views_and_prompts(spark):
    rng = np.random.default_rng(2)
    pts = pd.DataFrame(rng.uniform(-0.5, 0.5, (80, 3)), columns=list("xyz")).assign(scene_id=0, id=range(80))
    hull = spark.createDataFrame(pd.concat([pts.assign(item_id=i) for i in (1, 2)]))
    half = {1: (0, W // 2 - 1), 2: (W // 2, W - 1)}          # item 1 has masks of the left half in views 0-2, item 2 of the right half in view 3 alone
    runs = pd.DataFrame([dict(scene_id=0, item_id=i, view_id=v, y=y, x0=half[i][0], x1=half[i][1]) for i, vs in ((1, (0, 1, 2)), (2, (3,))) for v in vs for y in range(H)])
    e = given(spark, runs)
    voted, counts = e._voted(hull, ["wide"])
    assert {(r.item_id, r.n_views) for r in counts.collect()} == {(1, 3), (2, 1)}
    got = voted.toPandas().set_index(["item_id", "id"])
    depth = 2 - pts.z
    x, y = np.trunc(40 * pts.x / depth + W / 2), np.trunc(40 * pts.y / depth + H / 2)
    seen = (x >= 0) & (x < W) & (y >= 0) & (y < H)
    for i, views in ((1, 3), (2, 1)):
        hit = seen & (x >= half[i][0]) & (x <= half[i][1])
        assert (got.loc[i].sort_index().votes.to_numpy() == views * hit).all() and (got.loc[i].sort_index().visible.to_numpy() == views * seen).all()
    kept = e.wide(e.judged(hull)).toPandas()
    left = set(pts.id[seen & (x < W // 2)])
    assert set(kept.id[kept.item_id == 1]) == left and set(kept.id[kept.item_id == 2]) == set(pts.id[seen & (x >= W // 2)]) and left


def wide(e, pts):
    return e.wide(e.judged(pts)).count()


def test_both_layers_are_judged_in_one_pass(spark, side):
    """The tight layer has item 1's first view alone, and no view of item 2."""
    rng = np.random.default_rng(4)
    pts = pd.DataFrame(rng.uniform(-1.7, 1.7, (60, 3)), columns=list("xyz")).assign(scene_id=0, id=range(60))
    hull = spark.createDataFrame(pd.concat([pts.assign(item_id=i) for i in (1, 2)]))
    runs = pd.DataFrame([dict(scene_id=0, item_id=i, view_id=v, y=y, x0=0, x1=W // 2) for i, vs in ((1, (0, 1, 2)), (2, (3,))) for v in vs for y in range(H)])
    got = given(spark, runs).judged(hull).toPandas().set_index(["item_id", "id"]).sort_index()
    depth = 2 - pts.z
    x, y = np.trunc(40 * pts.x / depth + W / 2), np.trunc(40 * pts.y / depth + H / 2)
    seen = ((x >= 0) & (x < W) & (y >= 0) & (y < H)).to_numpy()
    hit = seen & (x <= W // 2).to_numpy()
    seen, hit = seen & (depth > 0.01).to_numpy(), hit & (depth > 0.01).to_numpy()
    assert len(got) == 120 and 0 < hit.sum() < seen.sum() < 60
    for i, wide_views, tight_views in ((1, 3, 1), (2, 1, 0)):
        g = got.loc[i]
        assert (g.votes_wide == wide_views * hit).all() and (g.visible_wide == wide_views * seen).all()
        assert (g.votes_tight == tight_views * hit).all() and (g.visible_tight == tight_views * seen).all()
    e = given(spark, runs)
    assert e.tight(e.judged(hull)).where("item_id = 2").count() == 0        # no view asked: nothing is kept


def test_more_prompts_lower_the_share(spark):
    pts = spark.createDataFrame([(0, 0, 1, 0.0, 0.0, 0.0)], "id int, scene_id int, item_id int, x double, y double, z double")
    runs = pd.DataFrame([dict(scene_id=0, item_id=1, view_id=v, y=y, x0=0 if v < 2 else W - 1, x1=W - 1) for v in range(4) for y in range(H)])      # two views of four cover the point
    assert wide(given(spark, runs), pts) == 0                     # ceil(0.6 * 4) = 3
    prompts = spark.createDataFrame([(0, 1, 3)], "scene_id int, item_id int, n_prompts int")
    assert wide(given(spark, runs, prompts=prompts), pts) == 1    # ceil(0.5 * 4) = 2
    assert wide(given(spark, runs, prompts=prompts.withColumn("n_prompts", F.lit(2))), pts) == 0


def test_each_item_votes_with_its_own_boxes(spark):
    """Two items whose boxes lie in the same views, side by side."""
    rng = np.random.default_rng(6)
    pts = pd.DataFrame(rng.uniform(-0.9, 0.9, (90, 3)), columns=list("xyz")).assign(scene_id=0, id=range(90))
    hull = spark.createDataFrame(pd.concat([pts.assign(item_id=i) for i in (1, 2)]))
    cam = dict(scene_id=0, **{f"r{i}{j}": float(i == j) for i in range(3) for j in range(3)}, t0=0.0, t1=0.0, t2=-2.0, f=40.0, w=W, h=H)
    spans = {1: (0, W // 2), 2: (W // 2 + 1, W)}
    boxes = pd.DataFrame([cam | dict(view_id=v, item_id=i, x0=a, x1=b, y0=0, y1=H) for i, (a, b) in spans.items() for v in range(3 if i == 1 else 1)])
    got = vo.keep_box_votes(vo.box_votes(hull, spark.createDataFrame(boxes), ["scene_id", "item_id"], ["id"])).toPandas()
    depth = 2 - pts.z
    u, v = 40 * pts.x / depth + W / 2, 40 * pts.y / depth + H / 2
    seen = (depth > 0) & (u >= 0) & (u < W) & (v >= 0) & (v < H)
    for i, (a, b) in spans.items():
        want = set(pts.id[seen & (u >= a) & (u <= b)])
        assert want and set(got.id[got.item_id == i]) == want
        assert (got.n_views[got.item_id == i] == (3 if i == 1 else 1)).all()


def test_two_rugs_of_a_scene_lose_what_stands_on_each(spark, side):
    rng = np.random.default_rng(7)
    n = 400
    pts = pd.DataFrame({"x": rng.uniform(0, 4, n), "y": 1 + rng.uniform(-0.3, 0.05, n), "z": rng.uniform(0, 2, n)}).assign(scene_id=0, id=range(n))
    rug = {5: pts.x < 2.2, 6: pts.x >= 1.8}                          # two rugs that share a strip
    cones = pd.concat([pts[m].assign(item_id=i) for i, m in rug.items()])
    things = {1: (1.0, 1.0), 2: (3.0, 1.0), 3: (9.0, 9.0), 4: (2.0, 0.5)}   # 1 on the first rug, 2 on the second, 3 on none, 4 on both
    sib = pd.concat([pd.DataFrame({"x": x + rng.uniform(-0.3, 0.3, 200), "y": 1 + rng.uniform(-0.3, 0, 200), "z": z + rng.uniform(-0.3, 0.3, 200)}).assign(scene_id=0, object_id=o) for o, (x, z) in things.items()])
    sib = pd.concat([sib, pts[pts.x < 1.7].assign(object_id=9).drop(columns="id").iloc[:0]])
    got = pl.extract_rug(spark.createDataFrame(cones), F.lit(True), spark.createDataFrame(sib), ["scene_id"], "item_id", "object_id", ["id"]).toPandas()
    kept = {}
    for i, m in rug.items():
        own = pts[m]
        s = np.percentile(own.y, 95)
        band = own[(own.y >= s - 0.10) & (own.y <= s + 0.05)]
        mid = sib.groupby("object_id")[["x", "z"]].mean()
        over = mid[mid.x.between(band.x.min(), band.x.max()) & mid.z.between(band.z.min(), band.z.max())].index
        near = sib[sib.object_id.isin(over)][["x", "y", "z"]].to_numpy()
        d = np.sqrt(((band[["x", "y", "z"]].to_numpy()[:, None] - near[None]) ** 2).sum(2)).min(1)
        kept[i] = set(band.id[d >= 0.05])
        assert 0 < len(kept[i]) < len(band)
    assert {i: set(got.id[got.item_id == i]) for i in rug} == kept and kept[5] & kept[6]
