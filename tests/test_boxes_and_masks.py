import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from motefield.operators import dedup as dd
from motefield.operators import hulls as hl
from motefield.operators import masks as mk
from motefield.operators import selection as sel
from motefield.operators import votes as vo


def boxes(n, seed):
    rng = np.random.default_rng(seed)
    b = pd.DataFrame({"x0": rng.integers(0, 150, n), "y0": rng.integers(0, 80, n)})
    b["x1"], b["y1"] = b.x0 + rng.integers(0, 60, n), b.y0 + rng.integers(0, 40, n)
    b = pd.concat([b, b.iloc[: n // 4], b.iloc[:3], b.iloc[:3]], ignore_index=True)
    return b.assign(item_id=range(len(b)), scene_id=0)


def iou(a, b, floor):
    i = max(0, min(a.x1, b.x1) - max(a.x0, b.x0)) * max(0, min(a.y1, b.y1) - max(a.y0, b.y0))
    area = lambda r: max(floor, (r.x1 - r.x0) * (r.y1 - r.y0))
    u = area(a) + area(b) - i
    return i / u if u > 0 else 0


@pytest.mark.parametrize("limit", [0.3, 0.5])
def test_greedy_walk(spark, limit):
    b = boxes(80, 1)
    order = sorted(b.itertuples(), key=lambda r: (-(r.x1 - r.x0) * (r.y1 - r.y0), r.item_id))
    kept, clash = [], {}
    for r in order:
        hit = next((q for q in kept if iou(r, q, 1) >= limit), None)
        if hit is None:
            kept.append(r)
        else:
            clash[r.item_id] = hit.item_id
    got = dd.nms_any_label(spark.createDataFrame(b), ["scene_id"], "item_id", limit).toPandas()
    assert set(got.item_id[got.kept]) == {r.item_id for r in kept}
    assert {int(i): int(c) for i, c in zip(got.item_id, got.clash) if c == c} == clash


def test_same_label_walk(spark):
    b = boxes(60, 2)
    b["canonical"] = np.where(b.item_id % 2 == 0, "tv", None)
    kept = []
    for r in b.itertuples():
        if not any(q.canonical == r.canonical and iou(r, q, 0) >= 0.9 for q in kept):
            kept.append(r)
    got = dd.nms_same_label(spark.createDataFrame(b, "x0 int, y0 int, x1 int, y1 int, item_id int, scene_id int, canonical string"), ["scene_id"], "item_id").toPandas()
    assert set(got.item_id[got.kept]) == {r.item_id for r in kept}


def test_points_in_boxes(spark, side):
    rng = np.random.default_rng(3)
    p = pd.DataFrame({"u": rng.uniform(-50, 250, 500), "v": rng.uniform(-50, 150, 500)}).assign(scene_id=0, id=range(500))
    p["front"] = p.id % 5 > 0
    p.loc[:20, "u"] = 32.0                             # on a tile border
    b = boxes(30, 4)
    inside = lambda r, q: q.x0 <= r.u <= q.x1 and q.y0 <= r.v <= q.y1
    want = {(r.id, q.item_id) for r in p.itertuples() for q in b.itertuples() if r.front and inside(r, q)}
    pts, bx = spark.createDataFrame(p), spark.createDataFrame(b)
    got = hl.in_boxes(pts, bx, ["scene_id"], ["item_id"]).select("id", "item_id").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    out = hl.outside_boxes(pts, bx, ["scene_id"], need_front=False).toPandas()
    assert set(out.id) == {r.id for r in p.itertuples() if not any(inside(r, q) for q in b.itertuples())}


def test_neighbours_inside(spark):
    b = boxes(40, 5)
    got = hl.inside_neighbours(spark.createDataFrame(b), ["scene_id"], "item_id", 0.0, 500, 500, 0.25).collect()
    want = set()
    for t in b.itertuples():
        for q in b.itertuples():
            area = (q.x1 - q.x0) * (q.y1 - q.y0)
            i = max(0, min(t.x1, q.x1) - max(t.x0, q.x0)) * max(0, min(t.y1, q.y1) - max(t.y0, q.y0))
            if t.item_id != q.item_id and area > 0 and q.x1 > q.x0 and q.y1 > q.y0 and i / area > 0.25:
                want.add((t.item_id, q.item_id))
    assert len(got) == len(want) and {(r.target_id, r.neighbour_id) for r in got} == want


W, H = 90, 70


def bitmap(runs):
    m = np.zeros((H, W), bool)
    for r in runs.itertuples():
        m[r.y, r.x0:r.x1 + 1] = True
    return m


def random_runs(n, seed):
    rng = np.random.default_rng(seed)
    r = pd.DataFrame({"view_id": 0, "y": rng.integers(0, H, n), "x0": rng.integers(0, W, n)})
    r["x1"] = np.minimum(W - 1, r.x0 + rng.integers(0, 9, n))
    return r


def test_runs_merge_without_change(spark):
    r = random_runs(300, 6)
    out = mk.merge_runs(spark.createDataFrame(r), ["view_id"]).toPandas()
    assert (bitmap(out) == bitmap(r)).all() and len(out) < len(r)
    assert len(out) == (np.diff(np.pad(bitmap(r), ((0, 0), (1, 0))).astype(int), axis=1) == 1).sum()
    cut = mk.pack_runs(spark.createDataFrame(out), ["view_id"], 16).toPandas()
    assert (bitmap(cut) == bitmap(r)).all() and (cut.x0 // 16 == cut.tile).all() and (cut.x1 // 16 == cut.tile).all()


@pytest.mark.parametrize("radius", [0.4, 1.0, 5.0, 12.4, 60.0])
def test_dilation(spark, radius):
    r = random_runs(6, 7)
    got = bitmap(mk.mask_dilate(spark.createDataFrame(r), ["view_id"], F.lit(radius), F.lit(W), F.lit(H)).toPandas())
    src = bitmap(r)
    ys, xs = np.nonzero(src)
    yy, xx = np.mgrid[:H, :W]
    rr = int(round(radius))
    want = src.copy()
    if rr >= 1:
        for y, x in zip(ys, xs):
            want |= (yy - y) ** 2 + (xx - x) ** 2 <= rr * rr if rr <= 50 else abs(yy - y) + abs(xx - x) <= max(1, round(rr / 1.4))
    assert (got == want).all()


def test_mask_votes_match_bitmaps(spark, side):
    rng = np.random.default_rng(8)
    pts = pd.DataFrame(rng.uniform(-1.2, 1.2, (150, 3)), columns=list("xyz")).assign(scene_id=0, id=range(150))
    views = pd.DataFrame([dict(scene_id=0, view_id=i, r00=c, r01=0., r02=s, r10=0., r11=1., r12=0., r20=-s, r21=0., r22=c, t0=0., t1=0., t2=-2.0, f=40.0, w=W, h=H)
                          for i, (c, s) in enumerate([(1., 0.), (.8, .6), (0., 1.)])])
    runs = pd.concat([random_runs(200, 9), random_runs(150, 10).assign(view_id=1)]).assign(scene_id=0)
    index = vo.mask_index(spark.createDataFrame(runs), ["scene_id", "view_id"])
    mv = vo.masked_views(spark.createDataFrame(views), index, ["scene_id"])
    assert vo.view_counts(mv, ["scene_id"]).first().n_views == 2
    got = vo.insideness(vo.mask_votes(spark.createDataFrame(pts), mv, index, ["scene_id"], ["id"])).toPandas().set_index("id").sort_index()
    votes, seen = np.zeros(150, int), np.zeros(150, int)
    for v in views.itertuples():
        if v.view_id == 2:
            continue
        m = bitmap(runs[runs.view_id == v.view_id])
        cx, cz = v.r00 * pts.x + v.r02 * pts.z, v.r20 * pts.x + v.r22 * pts.z + v.t2
        d = -cz
        xi, yi = (40 * cx / np.maximum(d, 1e-6) + W / 2).to_numpy(), (40 * pts.y / np.maximum(d, 1e-6) + H / 2).to_numpy()
        ok = (d > 0.01).to_numpy() & (np.trunc(xi) >= 0) & (xi < W) & (np.trunc(yi) >= 0) & (yi < H)
        seen += ok
        votes[ok] += m[np.trunc(yi[ok]).astype(int), np.trunc(xi[ok]).astype(int)]
    assert (got.votes.to_numpy() == votes).all() and (got.visible.to_numpy() == seen).all() and votes.sum() > 10
    assert (got.insideness[seen == 0] == 0.5).all()


def test_collapse_guard_is_a_prefix(spark):
    rows = [(0, i, s) for i, s in enumerate([1.0, 0.9, 0.6, 0.59])] + [(1, i, s) for i, s in enumerate([0.0, 0.0])] + [(2, i, 1.0) for i in range(3)]
    got = sel.collapse_guard(spark.createDataFrame(rows, "g int, rung int, kept_share double"), ["g"]).groupBy("g").agg(F.max("rung")).collect()
    assert {tuple(r) for r in got} == {(0, 1), (1, 0), (2, 2)}


def test_small_masks_are_dropped(spark):
    r = pd.DataFrame({"view_id": [0, 0, 1], "y": [1, 1, 1], "x0": [0, 5, 0], "x1": [9, 14, 8]})
    assert {x.view_id for x in mk.healthy(spark.createDataFrame(r), ["view_id"], 15).collect()} == {0}


def test_a_long_chain_settles_in_logarithmic_rounds(spark, monkeypatch):
    """Each box overlaps the one before and the one after, so a plain round settles two of them."""
    n, writes = 4096, []
    plain = dd.stage
    monkeypatch.setattr(dd, "stage", lambda df: (writes.append(1), plain(df))[1])
    rows = [(i, 0, 30 * i, 0, 30 * i + 100, 100) for i in range(n)]
    b = spark.createDataFrame(rows, "item_id int, scene_id int, x0 int, y0 int, x1 int, y1 int")
    got = dd.greedy_nms(b, ["scene_id"], [], "item_id", 0.5).collect()
    assert {r.item_id for r in got if r.kept} == set(range(0, n, 2))
    assert all(r.clash == r.item_id - 1 for r in got if r.item_id % 2)
    assert (len(writes) - 3) / 2 <= 15


@pytest.mark.parametrize("seed", range(3))
def test_crowded_graph_equals_the_walk(spark, seed):
    """Dense overlaps: boxes that wait for several undecided ones, over several groups."""
    rng = np.random.default_rng(seed)
    n = 150
    x, y = rng.integers(0, 60, n), rng.integers(0, 40, n)
    pdf = pd.DataFrame({"item_id": rng.permutation(n), "scene_id": rng.integers(0, 2, n), "x0": x, "y0": y,
                        "x1": x + rng.integers(40, 60, n), "y1": y + rng.integers(40, 60, n)})
    kept, clash = [], {}
    for r in pdf.sort_values("item_id").itertuples():
        hit = next((q for q in kept if q.scene_id == r.scene_id and iou(r, q, 0) >= 0.4), None)
        if hit is None:
            kept.append(r)
        else:
            clash[r.item_id] = hit.item_id
    got = dd.greedy_nms(spark.createDataFrame(pdf), ["scene_id"], [], "item_id", 0.4).toPandas()
    assert set(got.item_id[got.kept]) == {r.item_id for r in kept}
    assert {int(i): int(c) for i, c in zip(got.item_id, got.clash) if c == c} == clash


@pytest.mark.parametrize("in_image", [True, False])
def test_votes_in_place_match_votes_by_rows(spark, side, in_image):
    """Repeated and null ids, items without views, a scene without cameras and positions that are no numbers."""
    rng = np.random.default_rng(5)
    n = 120
    pts = [(None if i % 17 == 0 else i % 100, i % 3, *map(float, rng.uniform(-3, 3, 3))) for i in range(n)]
    pts += [(7, 0, float("nan"), 0.0, 0.0), (8, 0, None, 0.0, 0.0)]
    s = spark.createDataFrame(pts, "id long, scene_id long, x double, y double, z double")
    cams = [(c, v, 40.0 + v, 64, 48, *[1.0 if i == j else 0.1 * v for i in range(3) for j in range(3)], 0.0, 0.2, -4.0) for c in (0, 1) for v in range(4)]
    names = ["scene_id", "view_id", *vo.CAMERA]
    boxes = [(*c, item, *map(int, rng.integers(0, 30, 2)), *map(int, rng.integers(30, 64, 2))) for c in cams for item in (1, 2) if (c[1] + item) % 3]
    views = spark.createDataFrame(boxes, [*names, "item_id", "x0", "y0", "x1", "y1"])
    items = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    want = vo.box_votes(s.crossJoin(items), views, ["scene_id", "item_id"], ["id"], in_image)
    got = vo.hull_box_votes(vo.with_pixels(s, views, ["scene_id"], in_image).crossJoin(items), s, views, ["scene_id"], "item_id", ["id"])
    rows = lambda df: sorted(map(str, df.select("id", "scene_id", "item_id", "votes", "visible", "n_views").collect()))
    assert rows(got) == rows(want) and want.where("votes > 0").count() > 20


def test_neighbour_boxes_are_dealt_out(spark):
    rows = [(0, i, i % 7 * 9, i % 5 * 9, i % 7 * 9 + 20, i % 5 * 9 + 20) for i in range(40)]
    items = spark.createDataFrame(rows, "scene_id long, item_id long, x0 int, y0 int, x1 int, y1 int").coalesce(1)
    pairs = hl.inside_neighbours(items, ["scene_id"], "item_id", 0.04, 192, 108, 0.25)
    assert pairs.rdd.getNumPartitions() >= 100 and pairs.count() > 40
