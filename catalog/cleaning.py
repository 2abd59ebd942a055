"""Queries on scene cleaning and object filters."""

from pyspark.sql import functions as F

from motefield import constants as k
from motefield.functions import geometry as g
from motefield.functions import labels as lb
from motefield.operators import attributes as at
from motefield.operators import filters as fl
from motefield.operators import frames as fr
from motefield.operators import hulls as hl
from motefield.operators import voxels as vx

from .fixtures import mean, oracle, pct, table
from .registry import query
from .rows import (BOUNDS_CTE, H, ID, KEY, PROC, PX_CTE, QUAD_CTE, W, _BRIGHT, _PLANE_CTE, like_any, parquet_splats, pixel_items, proj,
                   splats, vox)

LOG = __import__("math").log
MAXS, MINS = "greatest(scale_0, scale_1, scale_2)", "least(scale_0, scale_1, scale_2)"


def lg(v):
    return f"{LOG(v)!r}e0"


def aniso_sql(limit, eps):
    return f"({MAXS} - greatest({MINS}, {lg(eps)}) > {lg(limit)})"


def ids(df, *more):
    return df.select(*KEY, *more)


def planes(spark, sf):
    return table(spark, sf, "planes")


def top_cte(name, source, p=10.0):
    return pct(f"{name}_t", source, "scene_id", [("top", "y", p)]) + (
        f", {name} AS (SELECT s.*, top FROM {source} AS s JOIN {name}_t USING (scene_id))")


def voxcount_cte(name, source, size, keys="scene_id"):
    return (f"{name}_v AS (SELECT *, {vox(size)} FROM {source}), "
            f"{name} AS (SELECT * EXCLUDE (vx, vy, vz), count(*) OVER (PARTITION BY {keys}, vx, vy, vz) AS density FROM {name}_v)")


def colour_cte(name, source, size=0.2):
    means = ", ".join(f"{mean(f'f_dc_{i}')} AS m{i}" for i in range(3))
    sq = " + ".join(f"(f_dc_{i} - m{i}) * (f_dc_{i} - m{i})" for i in range(3))
    return (f"{name}_v AS (SELECT *, {vox(size)} FROM {source}), "
            f"{name}_m AS (SELECT scene_id, vx, vy, vz, {means} FROM {name}_v GROUP BY scene_id, vx, vy, vz), "
            f"{name} AS (SELECT v.* EXCLUDE (vx, vy, vz), sqrt({sq}) AS dist FROM {name}_v AS v JOIN {name}_m USING (scene_id, vx, vy, vz))")


_CUT = pct("cp", "splats", "scene_id", [("p_id", "y", 10.0), ("p_ex", "y", 3.0)]) + """,
  cut AS (SELECT s.*, y >= p_id AND y <= -d / b + 0.35e0 AS keep_id, y >= p_ex AND y <= -d / b + 0.35e0 AS keep_extract
  FROM splats AS s JOIN cp USING (scene_id) JOIN planes USING (scene_id))"""


@query("ceiling_floor_cut", oracle(["splats", "planes"], f"SELECT {ID}, keep_id, keep_extract FROM cut", _CUT))
def ceiling_floor_cut(spark, sf):
    return ids(fl.ceiling_floor_cut(splats(spark, sf), planes(spark, sf)), "keep_id", "keep_extract")


_S2 = f"scale_0 <= {lg(0.5)} AND scale_1 <= {lg(0.5)} AND scale_2 <= {lg(0.5)}"


@query("max_scale_filter", oracle(["splats"], f"SELECT {ID} FROM splats WHERE {_S2}"))
def max_scale_filter(spark, sf):
    return ids(fl.max_scale_filter(splats(spark, sf)))


@query("top_band_aniso", oracle(["splats"], f"SELECT {ID} FROM tb WHERE NOT (y < top AND {aniso_sql(20.0, 1e-9)})", top_cte("tb", "splats")))
def top_band_aniso(spark, sf):
    return ids(fl.top_band_aniso(splats(spark, sf)))


@query("top_band_max_scale", oracle(["splats"], f"SELECT {ID} FROM tb WHERE NOT (y < top AND {MAXS} > {lg(0.10)})", top_cte("tb", "splats")))
def top_band_max_scale(spark, sf):
    return ids(fl.top_band_max_scale(splats(spark, sf)))


@query("top_band_density", oracle(["splats"], f"SELECT {ID} FROM tb WHERE NOT (y < top AND density < 25)",
       voxcount_cte("vc", "splats", 0.1) + ", " + top_cte("tb", "vc")))
def top_band_density(spark, sf):
    return ids(fl.top_band_density(splats(spark, sf)))


def band_cte(name, source):
    return (colour_cte(f"{name}_c", source) + ", " + top_cte(f"{name}_b", f"{name}_c")
            + f", {name}_in AS (SELECT * FROM {name}_b WHERE y < top), "
            + pct(f"{name}_p", f"{name}_in", "scene_id", [("lim", "dist", 95.0)])
            + f", {name} AS (SELECT b.* EXCLUDE (top, dist) FROM {name}_b AS b LEFT JOIN {name}_p USING (scene_id) "
              f"WHERE NOT coalesce(y < top AND dist > lim, FALSE))")


@query("top_band_colour_outlier", oracle(["splats"], f"SELECT {ID} FROM bo", band_cte("bo", "splats")))
def top_band_colour_outlier(spark, sf):
    return ids(fl.top_band_colour_outlier(splats(spark, sf)))


def scene_cte(name, source):
    return (colour_cte(f"{name}_c", source) + ", " + pct(f"{name}_p", f"{name}_c", "scene_id", [("lim", "dist", 99.0)])
            + f", {name} AS (SELECT b.* EXCLUDE (dist) FROM {name}_c AS b JOIN {name}_p USING (scene_id) WHERE dist <= lim)")


@query("scene_colour_outlier", oracle(["splats"], f"SELECT {ID} FROM so", scene_cte("so", "splats")))
def scene_colour_outlier(spark, sf):
    return ids(fl.scene_colour_outlier(splats(spark, sf)))


CHAIN_CTE = ", ".join([
    _CUT, f"s2 AS (SELECT * EXCLUDE (keep_id, keep_extract) FROM cut WHERE keep_id AND {_S2})",
    top_cte("t3", "s2"), f"s3 AS (SELECT * EXCLUDE (top) FROM t3 WHERE NOT (y < top AND {aniso_sql(20.0, 1e-9)}))",
    top_cte("t4", "s3"), f"s4 AS (SELECT * EXCLUDE (top) FROM t4 WHERE NOT (y < top AND {MAXS} > {lg(0.10)}))",
    voxcount_cte("v5", "s4", 0.1), top_cte("t5", "v5"), "s5 AS (SELECT * EXCLUDE (top, density) FROM t5 WHERE NOT (y < top AND density < 25))",
    band_cte("s6", "s5"), scene_cte("s7", "s6")])


@query("slice_chain", oracle(["splats", "planes"], f"SELECT {ID} FROM s7", CHAIN_CTE))
def slice_chain(spark, sf):
    return ids(fl.slice_chain(parquet_splats(spark, sf), planes(spark, sf)))


@query("clean_scenes", oracle(["splats", "planes"], """SELECT scene_id, level, count(*) FILTER (WHERE density >= least) AS n_kept, count(*) AS n_total
  FROM cd CROSS JOIN (VALUES ('A', 3), ('B', 10), ('C', 25), ('D', 60), ('E', 150)) AS l(level, least) GROUP BY scene_id, level""",
       CHAIN_CTE + ", " + voxcount_cte("cd", "s7", 0.1)))
def clean_scenes(spark, sf):
    from motefield.plans.scenes import clean_scenes as plan
    return plan(splats(spark, sf), planes(spark, sf))[1]


@query("cardinal_strip", oracle(["splats", "planes"], f"SELECT {ID} FROM vc WHERE density >= 15", pct("cp", "splats", "scene_id", [("cut", "y", 40.0)])
       + ", st AS (SELECT s.* REPLACE (x / 40 AS x, z / 40 AS z) FROM splats AS s JOIN cp USING (scene_id) JOIN planes USING (scene_id) WHERE y > cut AND y >= -d / b - 2.13e0 AND y <= -d / b), "
       + voxcount_cte("vc", "st", 0.05)))
def cardinal_strip(spark, sf):
    dense = splats(spark, sf).withColumns({"x": F.col("x") / 40, "z": F.col("z") / 40})        # voxels with enough splats
    return ids(fl.cardinal_strip(dense, planes(spark, sf)))


@query("density_filter", oracle(["splats"], f"SELECT {ID}, scene_id FROM vc WHERE density >= 10", voxcount_cte("vc", "splats", 0.1)))
def density_filter(spark, sf):
    return ids(fl.density_filter(splats(spark, sf), 10), "scene_id")


_DROP = "sd >= -0.18e0 AND sd <= 0.10e0 AND align > 0.3e0"


@query("floor_band_drop", oracle(["splats", "planes"], f"SELECT {ID} FROM pl WHERE NOT ({_DROP})", _PLANE_CTE))
def floor_band_drop(spark, sf):
    return ids(fl.floor_band_drop(splats(spark, sf), planes(spark, sf)))


@query("floor_counts", oracle(["splats", "planes"], f"""SELECT scene_id, object_id, count(*) FILTER (WHERE NOT ({_DROP})) AS n_kept,
  count(*) FILTER (WHERE {_DROP}) AS n_dropped, count(*) FILTER (WHERE sd < -0.18e0) AS n_above,
  count(*) FILTER (WHERE sd >= -0.18e0 AND sd <= 0.10e0) AS n_in_band, count(*) FILTER (WHERE {_DROP}) AS n_aligned,
  count(*) FILTER (WHERE sd >= -0.18e0 AND sd <= 0.10e0 AND NOT (align > 0.3e0)) AS n_preserved, count(*) FILTER (WHERE sd > 0.10e0) AS n_below
  FROM pl GROUP BY scene_id, object_id""", _PLANE_CTE))
def floor_counts(spark, sf):
    return fl.floor_counts(splats(spark, sf), planes(spark, sf), ["scene_id", "object_id"])


@query("destreak_colour", oracle(["splats"], f"SELECT {ID} FROM splats WHERE NOT ({MAXS} > {lg(0.10)} AND {_BRIGHT} < 0.25e0)"))
def destreak_colour(spark, sf):
    return ids(fl.destreak_colour(splats(spark, sf), 0.10, 0.25))


@query("bottom_band_carve", oracle(["splats"], f"""SELECT {ID} FROM (SELECT *, min(y) OVER w AS lo, max(y) OVER w AS hi FROM splats
  WINDOW w AS (PARTITION BY scene_id, object_id)) AS q WHERE {_BRIGHT} >= 0.45e0 OR y < lo + 0.75e0 * (hi - lo)"""))
def bottom_band_carve(spark, sf):
    s = splats(spark, sf).withColumn("score", g.brightness())
    return ids(fl.bottom_band_carve(s, ["scene_id", "object_id"], "score", 0.45, 25.0))


def rug_boxes(spark, sf):
    """The widened box of every item whose label takes the rug route."""
    it = pixel_items(spark, sf).where(lb.procedure(F.col("label")) == "rug")
    return it.select("scene_id", "item_id", *[F.greatest(F.lit(0), F.col(c) - 40).alias(c) for c in ("x0", "y0")], *[(F.col(c) + 40).alias(c) for c in ("x1", "y1")])


RUG_CTE = PX_CTE + ", " + proj("cam", "flt") + f""",
  rb AS (SELECT scene_id, item_id, greatest(0, x0 - 40) AS x0, greatest(0, y0 - 40) AS y0, x1 + 40 AS x1, y1 + 40 AS y1 FROM px WHERE {PROC} = 'rug'),
  rp AS (SELECT flt.*, item_id FROM flt JOIN rb USING (scene_id) WHERE view_id = 0 AND front AND u >= 0 AND u < w AND v >= 0 AND v < h
    AND u >= x0 AND u <= x1 AND v >= y0 AND v <= y1), """ + pct("rs", "rp", "scene_id, item_id", [("surface", "y", 95.0)]) + """,
  rug AS (SELECT rp.* FROM rp JOIN rs USING (scene_id, item_id) WHERE y >= surface - 0.10e0 AND y <= surface + 0.05e0)"""
RUG = ["scene_id", "item_id"]


def rug_cones(spark, sf):
    """Splats in the box of each rug, a row per splat and rug."""
    view = table(spark, sf, "views").where("view_id = 0")
    return hl.in_boxes(hl.seen(splats(spark, sf), view, ["scene_id"]), rug_boxes(spark, sf), ["scene_id"], ["item_id"])


def in_image():
    u, v = F.col("u"), F.col("v")
    return F.col("front") & (u >= 0) & (u < F.col("w")) & (v >= 0) & (v < F.col("h"))


def rug(spark, sf):
    return fl.rug_band(rug_cones(spark, sf), RUG, in_image())


@query("rug_band", oracle(["splats", "views", "items"], f"SELECT {ID}, item_id FROM rug", RUG_CTE))
def rug_band(spark, sf):
    return ids(rug(spark, sf), "item_id")


DEPTH_CTE = """dd AS (SELECT *, (x - 0.5e0) * 0.6e0 + (y - 0.25e0) * 0e0 + (z - -0.5e0) * 0.8e0 AS depth FROM splats),
  rr AS (SELECT scene_id, object_id, min(depth) AS lo, max(depth) AS hi, CAST(greatest(20, trunc((max(depth) - min(depth)) / 0.01e0)) AS INTEGER) AS bins
    FROM dd GROUP BY scene_id, object_id),
  bb AS (SELECT dd.*, lo, hi, bins, CAST(least(floor((depth - lo) / (hi - lo) * bins), bins - 1) AS INTEGER) AS i0 FROM dd JOIN rr USING (scene_id, object_id)),
  bc AS (SELECT *, CASE WHEN depth < (CASE WHEN i0 = bins THEN hi ELSE lo + i0 * ((hi - lo) / bins) END) THEN i0 - 1
    WHEN depth >= (CASE WHEN i0 + 1 = bins THEN hi ELSE lo + (i0 + 1) * ((hi - lo) / bins) END) AND i0 <> bins - 1 THEN i0 + 1 ELSE i0 END AS i FROM bb),
  bn AS (SELECT scene_id, object_id, lo, hi, bins, i, count(*) AS n FROM bc GROUP BY scene_id, object_id, lo, hi, bins, i),
  bt AS (SELECT *, row_number() OVER (PARTITION BY scene_id, object_id ORDER BY n DESC, i) AS r FROM bn),
  mode AS (SELECT scene_id, object_id, ((CASE WHEN i = bins THEN hi ELSE lo + i * ((hi - lo) / bins) END)
    + (CASE WHEN i + 1 = bins THEN hi ELSE lo + (i + 1) * ((hi - lo) / bins) END)) / 2 AS plane_depth FROM bt WHERE r = 1)"""
OBJ = ["scene_id", "object_id"]


def given_normals(spark, sf):
    return table(spark, sf, "objects").select(*OBJ, *[F.lit(v).alias(n) for n, v in [
        ("m_x", 0.5), ("m_y", 0.25), ("m_z", -0.5), ("n_x", 0.6), ("n_y", 0.0), ("n_z", 0.8)]])


@query("wall_slab", oracle(["splats"], f"SELECT {ID} FROM dd JOIN mode USING (scene_id, object_id) WHERE abs(depth - plane_depth) <= 0.05e0", DEPTH_CTE))
def wall_slab(spark, sf):
    return ids(fl.wall_slab(splats(spark, sf), OBJ, given_normals(spark, sf)))


@query("depth_mode", oracle(["splats"], "SELECT scene_id, object_id, plane_depth FROM mode", DEPTH_CTE))
def depth_mode(spark, sf):
    s = splats(spark, sf).withColumn("depth", (F.col("x") - 0.5) * 0.6 + (F.col("y") - 0.25) * 0.0 + (F.col("z") - -0.5) * 0.8)
    return fl.depth_mode(s, OBJ, "depth")


@query("pca_normal")
def pca_normal(spark, sf):
    eyes = table(spark, sf, "objects").select(*OBJ, F.lit(0.0).alias("eye_x"), F.lit(0.6).alias("eye_y"), F.lit(8.0).alias("eye_z"))
    return fl.pca_normals(splats(spark, sf), OBJ, eyes)


@query("min_area_items", oracle(["items"], """SELECT item_id, kind, CASE WHEN (bx1 - bx0) * (by1 - by0) < least
    THEN concat('too_small(', CAST((bx1 - bx0) * (by1 - by0) AS VARCHAR), ')') END AS dropped
  FROM items CROSS JOIN (VALUES ('furniture', 2500), ('art', 1000)) AS t(kind, least)"""))
def min_area_items(spark, sf):
    it = table(spark, sf, "items")
    a = fl.area_reasons(it, k.MIN_AREA_FURNITURE).withColumn("kind", F.lit("furniture"))
    b = fl.area_reasons(it, k.MIN_AREA_ART).withColumn("kind", F.lit("art"))
    return a.unionByName(b).select("item_id", "kind", "dropped")


@query("min_splats", oracle(["splats"], f"SELECT {ID} FROM splats JOIN (SELECT scene_id, pk FROM splats GROUP BY scene_id, pk HAVING count(*) >= 25) AS q USING (scene_id, pk)"))
def min_splats(spark, sf):
    return ids(fl.smallest_kept(splats(spark, sf), ["scene_id", "pk"], 25))


@query("class_exemption", oracle(["items"], f"""SELECT item_id, {like_any(lb.SHELVING)} AS skip_floor,
  {like_any(lb.TABLE_TOKENS, "trim(lower(split_part(split_part(concat(label, ' {soft}|wooden table legs {hard}'), '|', 1), '{', 1)))")} AS skip_low_ring,
  {like_any(["stool"])} AS skip_crop FROM items""".replace("{{", "{")))
def class_exemption(spark, sf):
    from motefield.operators.selection import class_exemptions
    it = table(spark, sf, "items").withColumn("prompt", F.concat("label", F.lit(" {soft}|wooden table legs {hard}")))
    return it.select("item_id", *[c.alias(n) for n, c in class_exemptions(F.col("label"), F.col("prompt")).items()])


@query("diorama_split", oracle(["splats"], f"SELECT quadrant, scene_id, count(*) AS n, min(x) AS x_min, max(x) AS x_max, min(z) AS z_min, max(z) AS z_max FROM quad GROUP BY quadrant, scene_id", QUAD_CTE))
def diorama_split(spark, sf):
    s = splats(spark, sf)
    q = fr.with_quadrants(s, fr.room_bounds(s, ["scene_id"]))
    return q.groupBy("quadrant", "scene_id").agg(F.count("*").alias("n"), *[f(a).alias(f"{a}_{n}") for a in "xz" for n, f in (("min", F.min), ("max", F.max))])


@query("voxel_density", oracle(["splats"], f"SELECT {ID}, density FROM vc", voxcount_cte("vc", "splats", 0.1)))
def voxel_density(spark, sf):
    return ids(vx.with_voxel_count(splats(spark, sf), ["scene_id"], 0.1), "density")


@query("voxel_mean_colour", oracle(["splats"], f"SELECT {ID}, dist AS colour_dist FROM cc", colour_cte("cc", "splats")))
def voxel_mean_colour(spark, sf):
    return ids(vx.with_colour_distance(splats(spark, sf), ["scene_id"], 0.2), "colour_dist")
