"""Registered queries on a few rows of their own, against their check statements."""

import duckdb
import numpy as np
import pandas as pd

import __spark_entry__ as entry
from catalog import files, jobs, joins
from motefield.operators import filters as fl
from motefield.operators import hulls as hl
from motefield.operators import spatial as sp
from motefield.operators import votes as vo


def checked(spark, folder, name, **tables):
    """Rows of a query and of its statement over the given tables."""
    con = duckdb.connect()
    for t, pdf in tables.items():
        pdf.to_parquet(f"{folder}/{t}.parquet", index=False)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = entry.queries()[name](spark, str(folder))
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    return sorted(map(tuple, got.collect())), sorted(want), got.columns


def test_prompt_hits_matches_its_statement(spark, tmp_path):
    orders = pd.DataFrame({"o_orderkey": range(1, 6001), "o_custkey": [i * i * 7919 % 1009 for i in range(6000)]})
    got, want, _ = checked(spark, tmp_path, "prompt_hits", orders=orders)
    assert got == want and len(got) > 0


def scene(rows, parts=900):
    """Splats and parts; 900 parts make 37 items, 2,000 have rugs among them."""
    line = pd.DataFrame({"l_orderkey": [i * i * 37 % 50021 for i in range(rows)], "l_partkey": [1 + i * 11 % parts for i in range(rows)],
                         "l_suppkey": [i * 7 % 13 for i in range(rows)], "l_linenumber": [1 + i % 7 for i in range(rows)]})
    return {"lineitem": line, "part": pd.DataFrame({"p_partkey": range(1, parts + 1)})}


def test_hulls_are_counted_without_writing_their_rows(spark, tmp_path, monkeypatch):
    from motefield import staging
    written, stage = [], staging.stage
    monkeypatch.setattr(staging, "stage", lambda df: written.append(df.columns) or stage(df))
    got, want, columns = checked(spark, tmp_path, "companion_hull", **scene(20000))
    assert columns[0] == "item_id" and sorted((*r[1:], r[0]) for r in got) == want and len(got) > 100
    assert all("ok" not in c for c in written)


def test_boxes_without_their_neighbours_hold_what_is_left_of_the_hull(spark, side):
    """Points on edges and corners too, boxes given twice, boxes without a cover, items without a name."""
    rng = np.random.default_rng(31)
    pts = pd.DataFrame({"scene_id": rng.integers(0, 2, 900), "id": range(900), "u": rng.uniform(-5, 110, 900), "v": rng.uniform(-5, 80, 900), "front": True})
    pts.loc[::2, ["u", "v"]] = pts.loc[::2, ["u", "v"]].round()
    pts.loc[::3, "u"] = pts.loc[::3, "u"] // 32 * 32
    pts.loc[[0, 1, 2], "u"] = [np.nan, np.inf, -np.inf]

    def boxes(n, most):
        lo = rng.integers(-4, 90, (n, 2))
        hi = lo + rng.integers(-1, most, (n, 2))
        return pd.DataFrame({"scene_id": rng.integers(0, 2, n), "item": rng.integers(0, 9, n), "x0": lo[:, 0], "y0": lo[:, 1], "x1": hi[:, 0], "y1": hi[:, 1]})
    schema = "scene_id int, item int, x0 int, y0 int, x1 int, y1 int"
    own = boxes(24, 70)
    rows = pd.concat([own, own.iloc[:4]]).astype(object)
    rows.iloc[5, 1] = None
    own, covers = spark.createDataFrame(rows, schema), spark.createDataFrame(boxes(150, 25).astype(object), schema)
    pts = spark.createDataFrame(pts)
    told = lambda df: sorted(map(str, df.select("scene_id", "id", "item").collect()))
    hull = hl.in_boxes(pts, own, ["scene_id"], ["item"])
    want = told(hl.outside_boxes(hull, covers, ["scene_id", "item"], need_front=False))
    got = told(hl.in_boxes(pts, hl.free_boxes(own, covers, ["scene_id"], "item"), ["scene_id"], ["item"]))
    assert got == want and 100 < len(want) < hull.count() - 100


def test_neighbours_are_carved_without_moving_hull_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hl, "outside_boxes", None)
    got, want, _ = checked(spark, tmp_path, "neighbour_carve", **scene(3000))
    assert got == want and len(got) > 50


def test_child_votes_send_a_splat_once(spark, tmp_path):
    """no second row of each splat and prompt beside its votes."""
    orders = pd.DataFrame({"o_orderkey": range(1, 60001), "o_custkey": [i * i * 7919 % 1009 for i in range(60000)]})
    got, want, _ = checked(spark, tmp_path, "child_vote", orders=orders, lineitem=scene(3000)["lineitem"])
    assert got == want and len(got) > 50
    plan = entry.queries()["child_vote"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_art_rows_are_judged_in_place(spark, tmp_path, monkeypatch):
    """the same rows as by a row per hull row and view, without that join."""
    tables = scene(1200)
    for t, pdf in tables.items():
        pdf.to_parquet(f"{tmp_path}/{t}.parquet", index=False)
    sf = str(tmp_path)
    pad = lambda b: jobs.bx.pad(b, jobs.k.ART_VIEW_PAD, jobs.F.lit(jobs.W), jobs.F.lit(jobs.H))
    hull = joins.art(spark, sf, jobs.k.ART_PAD).select(*jobs.KEY, "scene_id", "x", "y", "z", "item_id")
    kept = vo.keep_art_votes(vo.box_votes(hull, joins.item_boxes(spark, sf, pad), ["scene_id", "item_id"], jobs.KEY, in_image=False))
    kept = hull.join(kept.select(*jobs.KEY, "item_id"), [*jobs.KEY, "item_id"], "left_semi")
    eyes = joins.padded(spark, sf, 0.0).select("item_id", *[jobs.F.lit(v).alias(f"eye_{a}") for a, v in zip("xyz", (0.0, 0.6, 8.0))])
    want = fl.wall_slab(kept, ["item_id"], fl.pca_normals(kept, ["item_id"], eyes)).select(*jobs.KEY, "item_id").collect()
    monkeypatch.setattr(vo, "box_votes", None)
    got = entry.queries()["extract_art"](spark, sf).collect()
    assert sorted(got) == sorted(want) and 0 < len(want) < hull.count()


def test_siblings_are_met_once_for_all_rugs(spark, tmp_path, monkeypatch):
    """distances are taken between splats and siblings, whatever rugs the splats lie on."""
    keys, matched = [], sp._matched
    monkeypatch.setattr(sp, "_matched", lambda df, others, on, *a: keys.append(on) or matched(df, others, on, *a))
    got, want, _ = checked(spark, tmp_path, "sibling_subtract", **scene(4000, 2000))
    assert got == want and len(got) > 50 and keys == [["scene_id", "object_id"]]


def test_few_cells_are_looked_at_around_a_point(spark, monkeypatch):
    """two cells on average, not 27."""
    rng = np.random.default_rng(28)
    a, b = (pd.DataFrame(rng.uniform(-1, 1, (n, 3)), columns=list("xyz")).assign(scene_id=0, id=range(n)) for n in (700, 300))
    d = np.sqrt(((a[["x", "y", "z"]].to_numpy()[:, None] - b[["x", "y", "z"]].to_numpy()[None]) ** 2).sum(2)).min(1)
    sent, reached = [], sp._reached
    monkeypatch.setattr(sp, "_reached", lambda df, *s: sent.append((df.count(), reached(df, *s).count())) or reached(df, *s))
    a_, b_ = spark.createDataFrame(a), spark.createDataFrame(b)
    for wide in (2, 8):
        got = {r.id for r in sp.radius_anti(a_, b_, ["scene_id"], ["id"], 0.1, wide).collect()}
        gone = {r.id for r in sp.radius_semi(a_, b_, ["scene_id"], ["id"], 0.1, wide).collect()}
        assert got == set(a.id[d >= 0.1]) and gone == set(a.id[d < 0.1]) and got and gone
    assert sent[0][1] == 8 * sent[0][0] and sent[-1][1] < 3 * sent[-1][0]


def test_neighbours_are_found_in_blocks_and_slices(spark, monkeypatch):
    """F16: positions go to few blocks, not to the 27 cells around, and a crowded block is cut into slices."""
    rng = np.random.default_rng(5)
    p = np.r_[rng.uniform(0, 1, (1500, 3)), rng.normal(3, 1e-3, (300, 3)), rng.uniform(2, 4, (20, 3))]
    p = np.r_[p, np.repeat(p[:2], 3, axis=0)]
    df = spark.createDataFrame(pd.DataFrame(p, columns=list("xyz")).assign(g=0, id=range(len(p))))
    rows, nearest = spark.sparkContext.accumulator(0), sp._nearest

    def counted(block, k):
        rows.add(len(block))
        return nearest(block, k)
    monkeypatch.setattr(sp, "_nearest", counted)
    monkeypatch.setattr(sp, "_SLICE", 32)
    got = sp.knn_isolation(df, ["g"], ["id"]).toPandas().set_index("id").sort_index().isolation
    want = np.sort(np.linalg.norm(p[:, None] - p[None], axis=2), axis=1)[:, 1:9].mean(axis=1)
    assert np.allclose(got, want)
    assert 0 < rows.value < 14 * len(p)


def test_destreak_geometry_stages_no_whole_rows(spark, monkeypatch):
    """rows that are no streak stay where they are; also with repeated rows, null heights and null groups."""
    rng = np.random.default_rng(6)
    n = 600
    pdf = pd.DataFrame(rng.uniform(0, 1, (n, 3)), columns=list("xyz")).assign(
        g=[i % 2 for i in range(n)], id=range(n), scale_0=rng.uniform(-4, 0, n), scale_1=-5.0, scale_2=-5.0)
    pdf = pd.concat([pdf, pdf[:20]], ignore_index=True)
    pdf["g"] = pdf["g"].astype("Int64")
    pdf.loc[5, "g"] = pd.NA
    rows = [tuple(None if pd.isna(v) else (int(v) if c in ("g", "id") else float(v)) for c, v in zip(pdf.columns, r)) for r in pdf.itertuples(index=False)]
    rows.append((0.1, None, 0.2, 1, n, 0.0, -5.0, -5.0))
    df = spark.createDataFrame(rows, "x double, y double, z double, g long, id long, scale_0 double, scale_1 double, scale_2 double")
    wide, stage = [], fl.stage
    monkeypatch.setattr(fl, "stage", lambda d: wide.append("scale_0" in d.columns) or stage(d))
    got = sorted(fl.destreak_geometry(df, ["g"], ["id"]).toPandas()["id"])
    assert not any(wide)
    full = pd.DataFrame(rows, columns=pdf.columns)
    want = []
    for g, part in full[full.g.notna()].groupby("g"):
        real = part[part.y.notna()]
        q = real[["x", "y", "z"]].to_numpy()
        iso = np.sort(np.linalg.norm(q[:, None] - q[None], axis=2), axis=1)[:, 1:9].mean(axis=1)
        lo, hi = real.y.min(), real.y.max()
        drop = (real.y >= hi - 0.25 * (hi - lo)) & (real.scale_0 > np.log(0.07)) & (real.scale_0 + 5 > np.log(4)) & (iso > np.percentile(iso, 90))
        assert drop.any()
        want += real.id[~drop].tolist()
    with_null = part_keeps(full)
    assert got == sorted(want + with_null)


def part_keeps(full):
    """Ids of rows without a height that stay: null is no streak only where a scale already says so."""
    odd = full[full.y.isna() & full.g.notna()]
    return odd.id[~((odd.scale_0 > np.log(0.07)) & (odd.scale_0 + 5 > np.log(4)))].tolist()


def test_replies_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """a file per reply, not all of them by one task."""
    monkeypatch.setattr(files, "folder", lambda spark, what: str(tmp_path / what))
    got, want, _ = checked(spark, tmp_path, "reply_scan", part=pd.DataFrame({"p_partkey": range(1, 901)}))
    assert got == want and len(got) == 37
    assert len({f.name.split("-")[1] for f in tmp_path.glob("replies/item_id=*/part-*")}) > 10


def boxed(spark):
    """Points on edges and corners too and boxes of whole corners, some given twice, some without a group or item."""
    rng = np.random.default_rng(8)
    pts = pd.DataFrame({"scene_id": rng.integers(0, 3, 1500), "id": range(1500), "u": rng.uniform(-9, 210, 1500), "v": rng.uniform(-9, 120, 1500), "front": rng.random(1500) < 0.9})
    pts.loc[::2, ["u", "v"]] = pts.loc[::2, ["u", "v"]].round()
    pts.loc[::5, "u"] = pts.loc[::5, "u"] // 32 * 32
    pts.loc[[1, 3, 7], "u"] = [np.nan, np.inf, -np.inf]
    lo = rng.integers(-20, 190, (90, 2))
    hi = lo + rng.integers(-1, 60, (90, 2))
    rows = pd.DataFrame({"scene_id": rng.integers(0, 3, 90), "item": rng.integers(0, 40, 90), "x0": lo[:, 0], "y0": lo[:, 1], "x1": hi[:, 0], "y1": hi[:, 1]}).astype(object)
    rows = pd.concat([rows, rows.iloc[:5]])
    rows.iloc[3, 1] = rows.iloc[4, 0] = rows.iloc[6, 2] = None
    schema = "scene_id long, item long, x0 int, y0 int, x1 int, y1 int"
    pairs = pts[pts.front].merge(rows.dropna(subset=["scene_id", "x0"]).astype({"scene_id": "int64"}), on="scene_id")
    pairs = pairs[(pairs.u >= pairs.x0) & (pairs.u <= pairs.x1) & (pairs.v >= pairs.y0) & (pairs.v <= pairs.y1)]
    return spark.createDataFrame(pts), spark.createDataFrame([tuple(None if pd.isna(v) else int(v) for v in r) for r in rows.itertuples(index=False)], schema), rows, pairs


def test_hits_are_counted_from_sums_over_the_image(spark, side, monkeypatch):
    """F8: no row per splat and item is made to count them."""
    pts, boxes, rows, pairs = boxed(spark)
    monkeypatch.setattr(hl, "in_boxes", None)
    monkeypatch.setattr(hl, "seen", lambda *a: pts)
    got = hl.hull_counts(pts.withColumns({a: jobs.F.lit(0.0) for a in "xyz"}), None, boxes, ["scene_id"], "item").collect()
    n = pairs.dropna(subset=["item"]).groupby(["scene_id", "item"]).size().to_dict()
    want = [(r.scene_id, r.item, n.get((r.scene_id, r.item), 0)) for r in rows.itertuples()]
    key = lambda r: tuple(-1 if pd.isna(v) else int(v) for v in r)
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(n) > 20


def test_points_read_the_boxes_of_their_tile_from_arrays(spark, side, monkeypatch):
    """A point meets arrays of boxes, not single ones; also where a tile has several arrays."""
    pts, boxes, _, pairs = boxed(spark)
    monkeypatch.setattr(hl, "_PACK", 3)
    got = hl.in_boxes(pts, boxes, ["scene_id"], ["item"])
    assert "inline(_boxes" in got._jdf.queryExecution().optimizedPlan().toString()
    told = lambda pdf: sorted((i, -1 if pd.isna(m) else int(m)) for i, m in zip(pdf["id"], pdf["item"]))
    assert told(got.toPandas()) == told(pairs) and len(pairs) > 500


def test_box_votes_are_counted_by_compiled_code(spark, tmp_path, monkeypatch):
    """no lambda over an item's boxes for each hull row, and splats are not shuffled to their few scenes."""
    for t, pdf in scene(1500).items():
        pdf.to_parquet(f"{tmp_path}/{t}.parquet", index=False)
    run = lambda name: entry.queries()[name](spark, str(tmp_path))
    for name in ("bbox_vote", "art_bbox_vote"):
        got = run(name)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert " aggregate(" not in plan and "(aggregate(" not in plan and "SortMergeJoin [scene_id" not in plan
        with monkeypatch.context() as m:
            m.setattr(vo, "_COMPILED", 0)
            want = run(name)
            assert "aggregate(" in want._jdf.queryExecution().optimizedPlan().toString()
            assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 100


def test_many_short_rows_are_not_broadcast(spark):
    """A side that is small only as compressed files is not collected by the driver."""
    from motefield import staging
    rows = staging.stage(spark.range(200000).select(jobs.F.lit(7).cast("long").alias("a")))
    few = staging.stage(spark.range(50).select(jobs.F.col("id").alias("a")))
    spark.conf.set("motefield.broadcast.bytes", "1000000")
    try:
        assert staging.fits_broadcast(rows) and staging.light(rows) is rows
        assert staging.light(few) is not few
    finally:
        spark.conf.unset("motefield.broadcast.bytes")


def test_parents_are_attached_from_one_set_of_boxes(spark, tmp_path, monkeypatch):
    """the percentiles of all parts are taken, shuffled and staged once."""
    asked, aabb = [], joins.fr.robust_aabb
    monkeypatch.setattr(joins.fr, "robust_aabb", lambda df, keys: asked.append(keys) or aabb(df, keys))
    got, want, _ = checked(spark, tmp_path, "attach_parent", lineitem=scene(6000)["lineitem"])
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert [key(r)[::3] for r in sorted(got, key=key)] == [key(r)[::3] for r in sorted(want, key=key)]
    assert asked == [["scene_id", "pk"]] and any(r[3] is not None for r in got) and any(r[3] is None for r in got)
