"""Queries on single rows: splat attributes, boxes, cameras."""

from pyspark.sql import functions as F

from motefield import constants as k
from motefield.functions import boxes as bx
from motefield.functions import geometry as g
from motefield.functions import labels as lb
from motefield.operators import attributes as at
from motefield.operators import cameras as cam
from motefield.operators import frames as fr
from motefield.operators import masks as mk

from .fixtures import oracle, pct, table
from .registry import query

KEY = ["ok", "pk", "sk", "ln"]
ID = "ok, pk, sk, ln"


def keep(df, *cols, digits=None):
    out = [F.round(F.col(c), digits).alias(c) if digits is not None else F.col(c) for c in cols]
    return df.select(*KEY, *out)


def splats(spark, sf):
    return table(spark, sf, "splats")


def parquet_splats(spark, sf):
    """The splats as a Parquet table, for jobs that pass over them many times."""
    from motefield.staging import stage
    return stage(splats(spark, sf))


@query("linear_scale", oracle(["splats"], f"""SELECT {ID}, round(exp(scale_0), 6) AS sx, round(exp(scale_1), 6) AS sy,
  round(exp(scale_2), 6) AS sz, round(exp(greatest(scale_0, scale_1, scale_2)), 6) AS max_scale,
  round(exp(least(scale_0, scale_1, scale_2)), 6) AS min_scale FROM splats"""))
def linear_scale(spark, sf):
    return keep(at.linear_scales(splats(spark, sf)), "sx", "sy", "sz", "max_scale", "min_scale", digits=6)


@query("anisotropy", oracle(["splats"], f"""SELECT {ID},
  round(exp(greatest(scale_0, scale_1, scale_2)) / greatest(exp(least(scale_0, scale_1, scale_2)), 1e-9), 5) AS ratio,
  round(exp(greatest(scale_0, scale_1, scale_2)) / greatest(exp(least(scale_0, scale_1, scale_2)), 1e-6), 5) AS streak_ratio
  FROM splats"""))
def anisotropy(spark, sf):
    return splats(spark, sf).select(*KEY, F.round(g.anisotropy(1e-9), 5).alias("ratio"),
                                    F.round(g.anisotropy(1e-6), 5).alias("streak_ratio"))


_RGB = ", ".join(f"0.5e0 + 0.28209479177387814e0 * f_dc_{i} AS {c}" for i, c in enumerate("rgb"))


@query("dc_to_rgb", oracle(["splats"], f"SELECT {ID}, {_RGB} FROM splats"))
def dc_to_rgb(spark, sf):
    return keep(at.dc_colour(splats(spark, sf)), "r", "g", "b")


_BRIGHT = "((f_dc_0 * 0.28e0 + 0.5e0) + (f_dc_1 * 0.28e0 + 0.5e0) + (f_dc_2 * 0.28e0 + 0.5e0)) / 3.0e0"


@query("brightness", oracle(["splats"], f"SELECT {ID}, {_BRIGHT} AS brightness FROM splats"))
def brightness(spark, sf):
    return splats(spark, sf).select(*KEY, g.brightness().alias("brightness"))


_ALPHA = "CAST(CAST(1e0 / (1e0 + exp(-least(greatest(opacity, -30e0), 30e0))) AS FLOAT) AS DOUBLE)"


@query("opacity_alpha", oracle(["splats"], f"SELECT {ID}, round({_ALPHA}, 6) AS alpha FROM splats"))
def opacity_alpha(spark, sf):
    return splats(spark, sf).select(*KEY, F.round(g.alpha(), 6).alias("alpha"))


_QN = "(sqrt(rot_0 * rot_0 + rot_1 * rot_1 + rot_2 * rot_2 + rot_3 * rot_3) + 1e-8)"


@query("quat_normalise", oracle(["splats"], f"SELECT {ID}, "
       + ", ".join(f"rot_{i} / {_QN} AS q{c}" for i, c in enumerate("wxyz")) + " FROM splats"))
def quat_normalise(spark, sf):
    return splats(spark, sf).select(*KEY, *[q.alias(f"q{c}") for c, q in zip("wxyz", g.unit_quaternion())])


def _byte(e):
    return f"CAST(trunc(least(greatest({e}, 0e0), 255e0)) AS INTEGER)"


_ENC = ", ".join(
    [f"{_byte(f'(0.5e0 + 0.28209479177387814e0 * f_dc_{i}) * 255')} AS c_{c}" for i, c in enumerate("rgb")]
    + [f"{_byte(_ALPHA + ' * 255')} AS c_a"]
    + [f"{_byte(f'rot_{i} / {_QN} * 128 + 128')} AS q_{c}" for i, c in enumerate("wxyz")])


@query("splat_encode", oracle(["splats"], f"SELECT {ID}, {_ENC} FROM splats"))
def splat_encode(spark, sf):
    return keep(at.encoded(splats(spark, sf)), "c_r", "c_g", "c_b", "c_a", "q_w", "q_x", "q_y", "q_z")


@query("point_colour", oracle(["splats"], f"SELECT {ID}, 'dc' AS kind, " + ", ".join(
    f"CAST(trunc(least(greatest(0.5e0 + 0.28209479177387814e0 * f_dc_{i}, 0e0), 1e0) * 255e0) AS INTEGER) AS p_{c}"
    for i, c in enumerate("rgb")) + f" FROM splats UNION ALL SELECT {ID}, 'bytes', "
    "CAST(trunc((ok % 256) / 255e0 * 255e0) AS INTEGER), CAST(trunc((pk % 256) / 255e0 * 255e0) AS INTEGER), "
    "CAST(trunc((sk % 256) / 255e0 * 255e0) AS INTEGER) FROM splats"))
def point_colour(spark, sf):
    s = splats(spark, sf)
    raw = s.select(*KEY, (F.col("ok") % 256).alias("red"), (F.col("pk") % 256).alias("green"),
                   (F.col("sk") % 256).alias("blue"))
    out = ["p_r", "p_g", "p_b"]
    a = at.point_colour(s).select(*KEY, F.lit("dc").alias("kind"), *out)
    return a.unionByName(at.point_colour(raw).select(*KEY, F.lit("bytes").alias("kind"), *out))


@query("default_attrs", oracle(["splats"], f"""SELECT {ID}, x, y, z, round(ln(0.01e0), 6) AS scale_0,
  0e0 AS f_dc_0, 1e0 AS rot_0, 0e0 AS rot_3, 1e0 AS alpha, 127 AS c_r FROM splats"""))
def default_attrs(spark, sf):
    df = at.encoded(at.fill_defaults(splats(spark, sf).select(*KEY, "x", "y", "z")))
    return df.select(*KEY, "x", "y", "z", F.round("scale_0", 6).alias("scale_0"), "f_dc_0", "rot_0", "rot_3",
                     g.alpha().alias("alpha"), "c_r")


_NORM_CTE = """q AS (SELECT *, greatest(sqrt(rot_0 * rot_0 + rot_1 * rot_1 + rot_2 * rot_2 + rot_3 * rot_3), 1e-9) AS qn FROM splats),
u AS (SELECT *, rot_0 / qn AS qw, rot_1 / qn AS qx, rot_2 / qn AS qy, rot_3 / qn AS qz,
  CASE WHEN scale_0 <= scale_1 AND scale_0 <= scale_2 THEN 0 WHEN scale_1 <= scale_2 THEN 1 ELSE 2 END AS axis FROM q),
v AS (SELECT *,
  CASE axis WHEN 0 THEN 1 - 2 * (qy * qy + qz * qz) WHEN 1 THEN 2 * (qx * qy - qw * qz) ELSE 2 * (qx * qz + qw * qy) END AS n0,
  CASE axis WHEN 0 THEN 2 * (qx * qy + qw * qz) WHEN 1 THEN 1 - 2 * (qx * qx + qz * qz) ELSE 2 * (qy * qz - qw * qx) END AS n1,
  CASE axis WHEN 0 THEN 2 * (qx * qz - qw * qy) WHEN 1 THEN 2 * (qy * qz + qw * qx) ELSE 1 - 2 * (qx * qx + qy * qy) END AS n2 FROM u),
nrm AS (SELECT *, n0 / greatest(sqrt(n0 * n0 + n1 * n1 + n2 * n2), 1e-9) AS nx, n1 / greatest(sqrt(n0 * n0 + n1 * n1 + n2 * n2), 1e-9) AS ny,
  n2 / greatest(sqrt(n0 * n0 + n1 * n1 + n2 * n2), 1e-9) AS nz FROM v)"""
_PLANE_CTE = """p0 AS (SELECT s.*, a, b, c, d, rot_0 AS qw, rot_1 AS qx, rot_2 AS qy, rot_3 AS qz,
  greatest(rot_0 * rot_0 + rot_1 * rot_1 + rot_2 * rot_2 + rot_3 * rot_3, 1e-18) AS n2 FROM splats AS s JOIN planes USING (scene_id)),
pl AS (SELECT *, (a * x + b * y + c * z + d) / sqrt(a * a + b * b + c * c) AS sd,
  abs(CASE WHEN scale_0 <= scale_1 AND scale_0 <= scale_2
      THEN a + 2e0 * (b * (qx * qy + qw * qz) + c * (qx * qz - qw * qy) - a * (qy * qy + qz * qz)) / n2
    WHEN scale_1 <= scale_2
      THEN b + 2e0 * (a * (qx * qy - qw * qz) + c * (qy * qz + qw * qx) - b * (qx * qx + qz * qz)) / n2
    ELSE c + 2e0 * (a * (qx * qz + qw * qy) + b * (qy * qz - qw * qx) - c * (qx * qx + qy * qy)) / n2 END)
  / sqrt(a * a + b * b + c * c) AS align FROM p0)"""


@query("splat_normal", oracle(["splats"], f"SELECT {ID}, nx, ny, nz FROM nrm", _NORM_CTE))
def splat_normal(spark, sf):
    return keep(at.normals(splats(spark, sf)), "nx", "ny", "nz")


@query("plane_distance", oracle(["splats", "planes"], f"SELECT {ID}, sd FROM pl", _PLANE_CTE))
def plane_distance(spark, sf):
    return keep(at.plane_columns(splats(spark, sf), table(spark, sf, "planes")), "sd")


@query("plane_alignment", oracle(["splats", "planes"], f"SELECT {ID}, align FROM pl", _PLANE_CTE))
def plane_alignment(spark, sf):
    return keep(at.plane_columns(splats(spark, sf), table(spark, sf, "planes")), "align")


def vox(size, p="v"):
    return ", ".join(f"CAST(floor({a} / {size}e0) AS BIGINT) AS {p}{a}" for a in "xyz")


@query("voxel_key", oracle(["splats"], f"SELECT {ID}, {vox(0.1)} FROM splats"))
def voxel_key(spark, sf):
    return splats(spark, sf).select(*KEY, *g.voxel(0.1))


_C, _S = "cos(radians(30e0))", "sin(radians(30e0))"
_CH, _SH = "cos(radians(30e0) / 2)", "sin(radians(30e0) / 2)"


@query("axis_rotate", oracle(["splats"], f"""SELECT {ID}, 'y_down' AS kind, x, -z AS y, y AS z,
  round(h * rot_0 - h * rot_1, 6) AS rot_0, round(h * rot_1 + h * rot_0, 6) AS rot_1,
  round(h * rot_2 - h * rot_3, 6) AS rot_2, round(h * rot_3 + h * rot_2, 6) AS rot_3
FROM (SELECT *, sqrt(0.5e0) AS h FROM splats) AS s
UNION ALL SELECT {ID}, 'turn', round({_C} * x + {_S} * z, 6), y, round(-{_S} * x + {_C} * z, 6),
  round({_CH} * rot_0 - {_SH} * rot_2, 6), round({_CH} * rot_1 + {_SH} * rot_3, 6),
  round({_CH} * rot_2 + {_SH} * rot_0, 6), round({_CH} * rot_3 - {_SH} * rot_1, 6) FROM splats"""))
def axis_rotate(spark, sf):
    s = splats(spark, sf)
    rots = [F.round(c, 6).alias(c) for c in g.ROT]
    a = at.to_y_down(s).select(*KEY, F.lit("y_down").alias("kind"), "x", "y", "z", *rots)
    b = at.turn_about_y(s, 30.0).select(*KEY, F.lit("turn").alias("kind"), F.round("x", 6).alias("x"), "y",
                                        F.round("z", 6).alias("z"), *rots)
    return a.unionByName(b)


@query("yaw_compose", oracle(["items"], """SELECT item_id, yaw, CASE WHEN abs(-yaw) >= 0.01e0 THEN -yaw END AS angle
  FROM (SELECT item_id, CAST((k % 13) * 5 - 30 AS DOUBLE) AS yaw FROM items) AS q"""))
def yaw_compose(spark, sf):
    df = table(spark, sf, "items").select("item_id", ((F.col("k") % 13) * 5 - 30).cast("double").alias("yaw"))
    return df.withColumn("angle", at.turn_for_yaw(F.col("yaw")))


def item_cameras(spark, sf):
    """A camera per item whose eye and target come from the box corners."""
    c = {"eye_x": "bx0", "eye_y": "by0", "eye_z": "bx1"}
    df = table(spark, sf, "items").select("item_id", "scene_id", "k", *[
        (F.col(v).cast("double") / 100).alias(n) for n, v in c.items()])
    return df.withColumns({"tgt_x": F.col("eye_x") + 1, "tgt_y": F.col("eye_y") + 0.5, "tgt_z": F.col("eye_z") - 2,
                           "w": F.lit(1920), "h": F.lit(1080), "fov": F.lit(70.0)})


_CAM_CTE = """ic AS (SELECT item_id, k, CAST(bx0 AS DOUBLE) / 100 AS eye_x, CAST(by0 AS DOUBLE) / 100 AS eye_y,
  CAST(bx1 AS DOUBLE) / 100 AS eye_z FROM items),
it AS (SELECT *, eye_x + 1 AS tgt_x, eye_y + 0.5e0 AS tgt_y, eye_z - 2 AS tgt_z FROM ic),
d AS (SELECT *, tgt_x - eye_x AS dx, tgt_y - eye_y AS dy, tgt_z - eye_z AS dz FROM it),
f AS (SELECT *, dx / sqrt(dx * dx + dy * dy + dz * dz) AS fx, dy / sqrt(dx * dx + dy * dy + dz * dz) AS fy,
  dz / sqrt(dx * dx + dy * dy + dz * dz) AS fz FROM d),
c AS (SELECT *, fy * 0e0 - fz * -1e0 AS cx, fz * 0e0 - fx * 0e0 AS cy, fx * -1e0 - fy * 0e0 AS cz FROM f),
r AS (SELECT *, cx / sqrt(cx * cx + cy * cy + cz * cz) AS rx, cy / sqrt(cx * cx + cy * cy + cz * cz) AS ry,
  cz / sqrt(cx * cx + cy * cy + cz * cz) AS rz FROM c),
u AS (SELECT *, ry * fz - rz * fy AS ux, rz * fx - rx * fz AS uy, rx * fy - ry * fx AS uz FROM r)"""


@query("look_at", oracle(["items"], """SELECT item_id, round(rx, 9) + 0 AS r00, round(ry, 9) + 0 AS r01, round(rz, 9) + 0 AS r02,
  round(-ux, 9) + 0 AS r10, round(-uy, 9) + 0 AS r11, round(-uz, 9) + 0 AS r12, round(-fx, 9) + 0 AS r20, round(-fy, 9) + 0 AS r21,
  round(-fz, 9) + 0 AS r22, round(-(rx * eye_x + ry * eye_y + rz * eye_z), 9) + 0 AS t0,
  round(-(-ux * eye_x + -uy * eye_y + -uz * eye_z), 9) + 0 AS t1,
  round(-(-fx * eye_x + -fy * eye_y + -fz * eye_z), 9) + 0 AS t2 FROM u""", _CAM_CTE))
def look_at(spark, sf):
    names = [f"r{i}{j}" for i in range(3) for j in range(3)] + ["t0", "t1", "t2"]
    v = cam.add_look_at(item_cameras(spark, sf), up=(0.0, -1.0, 0.0))
    return v.select("item_id", *[(F.round(n, 9) + 0).alias(n) for n in names])


@query("intrinsics", oracle(["items"], """SELECT item_id, round(0.5e0 * h / tan(0.5e0 * radians(fov)), 6) AS f, w * 0.5e0 AS px, h * 0.5e0 AS py
  FROM (SELECT item_id, CAST(40 + k % 50 AS DOUBLE) AS fov, CAST(1920 AS INTEGER) AS w, CAST(1080 AS INTEGER) AS h FROM items) AS q"""))
def intrinsics(spark, sf):
    v = item_cameras(spark, sf).withColumn("fov", (40 + F.col("k") % 50).cast("double"))
    return cam.add_intrinsics(v).select("item_id", F.round("f", 6).alias("f"), "px", "py")


_CENTRE = ", ".join([pct("md", "splats", "scene_id, object_id", [
    *[(f"m{a}", a, 50.0) for a in "xyz"], *[(f"l{a}", a, 5.0) for a in "xyz"], *[(f"h{a}", a, 95.0) for a in "xyz"]])])
_TAN35 = f"{__import__('math').tan(__import__('math').radians(70.0) / 2)!r}e0"


def _orbit_sql(frame, grid):
    vals = ", ".join(f"({'NULL' if t is None else repr(t)}, {float(y)!r}e0, {float(p)!r}e0)" for t, y, p in grid)
    return f"""SELECT scene_id, object_id, coalesce(tag, concat('y', CAST(CAST(yaw AS INTEGER) AS VARCHAR), '_p', CAST(CAST(pitch AS INTEGER) AS VARCHAR))) AS tag,
  round(mx - cos(radians(pitch)) * sin(radians(yaw)) * dist, 6) AS eye_x, round(my + sin(radians(pitch)) * dist, 6) AS eye_y,
  round(mz + cos(radians(pitch)) * cos(radians(yaw)) * dist, 6) AS eye_z, mx AS tgt_x, my AS tgt_y, mz AS tgt_z
FROM {frame} CROSS JOIN (VALUES {vals}) AS g(tag, yaw, pitch)"""


def _orbit_out(v):
    return v.select("scene_id", "object_id", "tag", *[F.round(f"eye_{a}", 6).alias(f"eye_{a}") for a in "xyz"],
                    *[f"tgt_{a}" for a in "xyz"])


@query("orbit_cameras", oracle(["splats"], _orbit_sql("fr", cam.orbit_grid()), _CENTRE + f""",
  fr AS (SELECT *, greatest(hx - lx, hy - ly, hz - lz) * 2.0e0 / (2.0e0 * {_TAN35}) AS dist FROM md)"""))
def orbit_cameras(spark, sf):
    f = fr.median_frame(splats(spark, sf), ["scene_id", "object_id"])
    f = f.withColumn("distance", cam.orbit_distance(F.col("extent"), k.MARGIN_ORBIT))
    return _orbit_out(cam.orbit(f, cam.orbit_grid()))


_TAN25 = f"{__import__('math').tan(__import__('math').radians(50.0) / 2)!r}e0"
_P298 = pct("pp", "splats", "scene_id, object_id", [(f"{o}{a}", a, p) for a in "xyz" for o, p in (("l", 2.0), ("h", 98.0))])


@query("review_cameras", oracle(["splats"], _orbit_sql("fr", cam.review_grid()), _P298 + f""",
  fr AS (SELECT *, (lx + hx) * 0.5e0 AS mx, (ly + hy) * 0.5e0 AS my, (lz + hz) * 0.5e0 AS mz,
   greatest(greatest(hx - lx, hy - ly, hz - lz), 0.15e0) * 1.55e0 / (2.0e0 * {_TAN25}) + 0.5e0 AS dist FROM pp)"""))
def review_cameras(spark, sf):
    f = fr.display_frame(splats(spark, sf), ["scene_id", "object_id"], fov=k.REVIEW_FOV)
    return _orbit_out(cam.orbit(f, cam.review_grid()))


@query("pitch_ring_cameras", oracle(["splats"], """SELECT scene_id, object_id, concat('p', CAST(CAST(pitch AS INTEGER) AS VARCHAR)) AS tag,
  round(mx - nx * dist * cos(radians(pitch)), 6) AS eye_x, round(my - sin(radians(pitch)) * dist, 6) AS eye_y,
  round(mz - nz * dist * cos(radians(pitch)), 6) AS eye_z, mx AS tgt_x, my AS tgt_y, mz AS tgt_z
  FROM fr CROSS JOIN (VALUES (0e0), (-15e0), (-30e0), (-45e0)) AS g(pitch)""", _CENTRE + f""",
  f0 AS (SELECT *, greatest(hx - lx, hy - ly, hz - lz) * 1.55e0 / (2.0e0 * {_TAN35}) AS dist, hx - lx AS fx, hz - lz AS fz FROM md),
  fr AS (SELECT *, fx / sqrt(fx * fx + fz * fz) AS nx, fz / sqrt(fx * fx + fz * fz) AS nz FROM f0)"""))
def pitch_ring_cameras(spark, sf):
    f = fr.median_frame(splats(spark, sf), ["scene_id", "object_id"])
    f = f.withColumns({"distance": cam.orbit_distance(F.col("extent"), k.MARGIN_DISPLAY),
                       "src_eye_x": F.lit(0.0), "src_eye_z": F.lit(0.0),
                       "src_tgt_x": F.col("span_x"), "src_tgt_z": F.col("span_z")})
    return _orbit_out(cam.pitch_ring(f))


PROJ = {
    "cam": "SELECT s.*, v.view_id, v.f, v.w, v.h, r00 * x + r01 * y + r02 * z + t0 AS cx, r10 * x + r11 * y + r12 * z + t1 AS cy, "
           "r20 * x + r21 * y + r22 * z + t2 AS cz FROM splats AS s JOIN views AS v USING (scene_id)",
    "flt": "SELECT *, cz < 0 AS front, f * cx / (CASE WHEN cz < 0 THEN -cz ELSE 1e0 END) + w * 0.5e0 AS u, "
           "f * cy / (CASE WHEN cz < 0 THEN -cz ELSE 1e0 END) + h * 0.5e0 AS v FROM cam",
    "idx0": "SELECT *, -cz AS depth, f * cx / greatest(-cz, 1e-6) + w * 0.5e0 AS xs, f * cy / greatest(-cz, 1e-6) + h * 0.5e0 AS ys FROM cam",
    "idx": "SELECT *, depth > 0.01e0 AND xs > -1 AND xs < w AND ys > -1 AND ys < h AS in_img, "
           "CASE WHEN depth > 0.01e0 AND xs > -1 AND xs < w AND ys > -1 AND ys < h THEN CAST(trunc(xs) AS INTEGER) END AS xi, "
           "CASE WHEN depth > 0.01e0 AND xs > -1 AND xs < w AND ys > -1 AND ys < h THEN CAST(trunc(ys) AS INTEGER) END AS yi FROM idx0",
    "rnd0": "SELECT *, CASE WHEN abs(u - trunc(u)) = 0.5e0 THEN 2 * round(u / 2) ELSE round(u) END AS ru, "
            "CASE WHEN abs(v - trunc(v)) = 0.5e0 THEN 2 * round(v / 2) ELSE round(v) END AS rv FROM flt",
    "rnd": "SELECT *, front AND ru >= 0 AND ru < w AND rv >= 0 AND rv < h AS in_img, "
           "CASE WHEN front AND ru >= 0 AND ru < w AND rv >= 0 AND rv < h THEN CAST(ru AS INTEGER) END AS xi, "
           "CASE WHEN front AND ru >= 0 AND ru < w AND rv >= 0 AND rv < h THEN CAST(rv AS INTEGER) END AS yi FROM rnd0",
}


def proj(*names):
    return ", ".join(f"{n} AS ({PROJ[n]})" for n in names)


def projected(spark, sf, rule):
    from motefield.operators.projection import project
    from motefield.staging import small
    return project(splats(spark, sf).join(small(table(spark, sf, "views")), "scene_id"), rule)


@query("project_float", oracle(["splats", "views"], """SELECT scene_id, object_id, view_id, count(*) AS n,
  count(*) FILTER (WHERE front) AS n_front, min(u) AS u_min, max(u) AS u_max, min(v) AS v_min, max(v) AS v_max
  FROM flt GROUP BY scene_id, object_id, view_id""", proj("cam", "flt")))
def project_float(spark, sf):
    return (projected(spark, sf, "float").groupBy("scene_id", "object_id", "view_id")
            .agg(F.count("*").alias("n"), F.count_if("front").alias("n_front"), F.min("u").alias("u_min"),
                 F.max("u").alias("u_max"), F.min("v").alias("v_min"), F.max("v").alias("v_max")))


_PIX = """SELECT scene_id, object_id, view_id, count(*) AS n, count(*) FILTER (WHERE in_img) AS n_in,
  CAST(sum(xi) AS BIGINT) AS sum_x, CAST(sum(yi) AS BIGINT) AS sum_y, CAST(sum(xi * yi) AS BIGINT) AS sum_xy FROM {} GROUP BY scene_id, object_id, view_id"""


def _pixels(spark, sf, rule):
    x, y = F.col("px"), F.col("py")
    return (projected(spark, sf, rule).groupBy("scene_id", "object_id", "view_id")
            .agg(F.count("*").alias("n"), F.count_if("inside").alias("n_in"), F.sum(x).alias("sum_x"),
                 F.sum(y).alias("sum_y"), F.sum(x * y).alias("sum_xy")))


@query("project_index", oracle(["splats", "views"], _PIX.format("idx"), proj("cam", "idx0", "idx")))
def project_index(spark, sf):
    return _pixels(spark, sf, "index")


@query("project_round", oracle(["splats", "views"], _PIX.format("rnd"), proj("cam", "flt", "rnd0", "rnd")))
def project_round(spark, sf):
    return _pixels(spark, sf, "round")


BOUNDS_CTE = pct("bp", "splats", "scene_id", [(f"{o}{a}", a, p) for a in "xz" for o, p in (("l", 15.0), ("h", 85.0))]) + """,
  bounds AS (SELECT *, (lx + hx) / 2 AS mx, (lz + hz) / 2 AS mz FROM bp)"""
QUAD_CTE = BOUNDS_CTE + """,
  quad AS (SELECT s.*, q AS quadrant FROM splats AS s JOIN bounds USING (scene_id) CROSS JOIN (VALUES ('NE'), ('NW'), ('SE'), ('SW')) AS t(q)
  WHERE (CASE WHEN q IN ('NE', 'SE') THEN x >= mx ELSE x <= mx END) AND (CASE WHEN q IN ('NE', 'NW') THEN z >= mz ELSE z <= mz END))"""


@query("quadrant_of", oracle(["splats"], f"SELECT {ID}, quadrant FROM quad", QUAD_CTE))
def quadrant_of(spark, sf):
    s = splats(spark, sf)
    return fr.with_quadrants(s, fr.room_bounds(s, ["scene_id"])).select(*KEY, "quadrant")


# --- boxes -----------------------------------------------------------------

PX_CTE = """px AS (SELECT *, CAST(trunc(bx0 * 192 / 1000) AS INTEGER) AS x0, CAST(trunc(by0 * 108 / 1000) AS INTEGER) AS y0,
  CAST(trunc(bx1 * 192 / 1000) AS INTEGER) AS x1, CAST(trunc(by1 * 108 / 1000) AS INTEGER) AS y1 FROM items)"""
W, H = 192, 108
# extraction route of a label
PROC = (f"CASE WHEN regexp_matches(label, '(?i){lb.TV_WORDS}') AND NOT regexp_matches(label, '(?i){lb.TV_NOT}') THEN 'tv' WHEN regexp_matches(label, '(?i){lb.LAMP_WORDS}') THEN 'lamp' "
        f"WHEN regexp_matches(label, '(?i)\\b(bookshelf|book[- ]?shelf|bookcase|shelving(?:\\s+unit)?|open\\s+shelving|shelf|shelves)\\b') THEN 'bookshelf' WHEN regexp_matches(label, '(?i){lb.RUG_WORDS}') THEN 'rug' "
        f"WHEN regexp_matches(label, '(?i){lb.TABLE_WORDS}') AND NOT regexp_matches(label, '(?i){lb.TABLE_NOT}') THEN 'table' ELSE 'general' END")


def pixel_items(spark, sf):
    it = table(spark, sf, "items")
    b = bx.to_pixels(tuple(F.col(c) for c in ("bx0", "by0", "bx1", "by1")), F.lit(W), F.lit(H))
    return it.withColumns(bx.as_columns(b))


def boxes_out(df, b):
    return df.select("item_id", *[c.cast("int").alias(n) for n, c in bx.as_columns(b).items()])


def pad_sql(px, py, extra="0", w=W, h=H):
    return (f"greatest(0, CAST(trunc(x0 - {px}) AS INTEGER)) AS x0, greatest(0, CAST(trunc(y0 - {py} - {extra}) AS INTEGER)) AS y0, "
            f"least({w}, CAST(trunc(x1 + {px}) AS INTEGER)) AS x1, least({h}, CAST(trunc(y1 + {py}) AS INTEGER)) AS y1")


def pad_cte(name, share, source="px"):
    px, py = f"(x1 - x0) * {share!r}e0", f"(y1 - y0) * {share!r}e0"
    return f"{name} AS (SELECT * EXCLUDE (x0, y0, x1, y1), {pad_sql(px, py)} FROM {source})"


@query("bbox_to_pixels", oracle(["items"], "SELECT item_id, x0, y0, x1, y1 FROM px", PX_CTE))
def bbox_to_pixels(spark, sf):
    return boxes_out(pixel_items(spark, sf), bx.box())


@query("bbox_pad", oracle(["items"], "SELECT item_id, x0, y0, x1, y1 FROM pd", PX_CTE + ", " + pad_cte("pd", 0.04)))
def bbox_pad(spark, sf):
    return boxes_out(pixel_items(spark, sf), bx.pad(bx.box(), k.HULL_PAD, F.lit(W), F.lit(H)))


@query("bbox_pad_asym", oracle(["items"], "SELECT item_id, " + pad_sql(
    "(x1 - x0) * (CASE WHEN x1 - x0 >= y1 - y0 THEN 0.15e0 ELSE 0.04e0 END)",
    "(y1 - y0) * (CASE WHEN x1 - x0 >= y1 - y0 THEN 0.04e0 ELSE 0.15e0 END)") + " FROM px", PX_CTE))
def bbox_pad_asym(spark, sf):
    b = bx.pad_long_short(bx.box(), F.lit(0.15), F.lit(0.04), F.lit(W), F.lit(H))
    return boxes_out(pixel_items(spark, sf), b)


@query("bbox_pad_top", oracle(["items"], "SELECT item_id, " + pad_sql(
    "(x1 - x0) * 0.05e0", "(y1 - y0) * 0.05e0", "(y1 - y0) * 0.12e0") + " FROM px", PX_CTE))
def bbox_pad_top(spark, sf):
    b = bx.pad_with_top(bx.box(), k.BOX_VOTE_PAD, k.BOX_VOTE_TOP, F.lit(W), F.lit(H))
    return boxes_out(pixel_items(spark, sf), b)


@query("bbox_pad_unclamped", oracle(["items"], """SELECT item_id, CAST(trunc(x0 - (x1 - x0) * 0.01e0) AS INTEGER) AS x0,
  CAST(trunc(y0 - (y1 - y0) * 0.01e0) AS INTEGER) AS y0, CAST(trunc(x1 + (x1 - x0) * 0.01e0) AS INTEGER) AS x1,
  CAST(trunc(y1 + (y1 - y0) * 0.01e0) AS INTEGER) AS y1 FROM px""", PX_CTE))
def bbox_pad_unclamped(spark, sf):
    return boxes_out(pixel_items(spark, sf), bx.pad_free(bx.box(), k.NEIGHBOUR_PAD))


def _items_views(spark, sf):
    """Each item with the view its number points at."""
    from motefield.staging import small
    v = table(spark, sf, "views").withColumn("depth", F.sqrt(
        (F.col("eye_x") - F.col("tgt_x")) * (F.col("eye_x") - F.col("tgt_x"))
        + (F.col("eye_y") - F.col("tgt_y")) * (F.col("eye_y") - F.col("tgt_y"))
        + (F.col("eye_z") - F.col("tgt_z")) * (F.col("eye_z") - F.col("tgt_z"))))
    it = pixel_items(spark, sf).withColumn("view_id", (F.col("item_id") % 8).cast("int"))
    return it.join(small(v.select("scene_id", "view_id", "f", "w", "h", "depth")), ["scene_id", "view_id"])


IV_CTE = PX_CTE + """, vd AS (SELECT scene_id, view_id, f, w, h, sqrt((eye_x - tgt_x) * (eye_x - tgt_x) + (eye_y - tgt_y) * (eye_y - tgt_y)
  + (eye_z - tgt_z) * (eye_z - tgt_z)) AS depth FROM views),
  iv AS (SELECT px.*, vd.view_id, f, w, h, depth FROM px JOIN vd ON px.scene_id = vd.scene_id AND px.item_id % 8 = vd.view_id)"""


@query("crop_window", oracle(["items", "views"], """SELECT item_id, greatest(0, x0 - slack) AS x0, greatest(0, y0 - top - slack) AS y0,
  least(192, x1 + slack) AS x1, least(108, y1 + slack) AS y1 FROM (SELECT *,
  CAST(trunc(greatest(greatest(1, x1 - x0), greatest(1, y1 - y0)) * 0.03e0) AS INTEGER) AS slack,
  CAST(trunc(2.0e0 * f / greatest(depth, 0.1e0)) AS INTEGER) AS top FROM iv) AS q""", IV_CTE))
def crop_window(spark, sf):
    b = bx.crop(bx.box(), k.CROP_SIDE, k.CROP_HEADROOM_M, F.col("f"), F.col("depth"), F.col("w"), F.col("h"))
    return boxes_out(_items_views(spark, sf), b)


def like_any(words, col="lower(label)"):
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


_SHELF, _TBL = like_any(lb.SHELVING), like_any(lb.LARGE_TABLES)


@query("pad_by_label", oracle(["items"], f"""SELECT item_id, CASE WHEN {_SHELF} OR {_TBL} THEN 0.15e0 ELSE 0.04e0 END AS pad_long,
  CASE WHEN {_SHELF} THEN 0.04e0 WHEN {_TBL} THEN 0.15e0 ELSE 0.04e0 END AS pad_short,
  CASE WHEN {_SHELF} THEN 2.0e0 WHEN {_TBL} THEN 0.3e0 ELSE 2.0e0 END AS top_extend_m FROM items"""))
def pad_by_label(spark, sf):
    return table(spark, sf, "items").select("item_id", *[c.alias(n) for n, c in lb.pads(F.col("label")).items()])


@query("mask_radius", oracle(["items", "views"], """SELECT item_id, tag, pad * f / greatest(depth, 0.1e0) AS radius_px
  FROM iv CROSS JOIN (VALUES ('soft', 0.10e0), ('hard', 0.035e0), ('wide', 0.15e0)) AS t(tag, pad)
  WHERE tag = 'wide' OR (tag = 'soft') = (item_id % 2 = 0)""", IV_CTE))
def mask_radius(spark, sf):
    df = _items_views(spark, sf)
    df = df.withColumn("tag", F.explode(F.array(
        F.when(F.col("item_id") % 2 == 0, "soft").otherwise("hard"), F.lit("wide"))))
    return df.select("item_id", "tag", mk.radius_px(mk.pad_metres(F.col("tag")), F.col("f"), F.col("depth")).alias("radius_px"))


_SIL = "sil AS (SELECT scene_id, view_id, min(x0) AS x0, min(y) AS y0, max(x1) AS x1, max(y) AS y1 FROM mask_runs GROUP BY scene_id, view_id)"
_FR = ", ".join(f"{a}_{b}" for a in ("centre", "lb", "lt", "rb", "rt") for b in "xyz")


@query("camera_frustum", oracle(["mask_runs", "views"], "SELECT scene_id, view_id, half_w, half_h, centre_x, centre_y, centre_z, " + ", ".join(
    f"centre_{a} + {u} * half_w * r0{i} + {v} * half_h * -r1{i} AS {un}{vn}_{a}"
    for un, u in (("l", "(2.0e0 * x0 / w - 1)"), ("r", "(2.0e0 * x1 / w - 1)"))
    for vn, v in (("b", "(1 - 2.0e0 * y1 / h)"), ("t", "(1 - 2.0e0 * y0 / h)"))
    for i, a in enumerate("xyz")) + " FROM c2", _SIL + """,
  c0 AS (SELECT *, tgt_x - eye_x AS dx, tgt_y - eye_y AS dy, tgt_z - eye_z AS dz FROM views JOIN sil USING (scene_id, view_id)),
  c1 AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS depth FROM c0),
  c2 AS (SELECT *, w / 2.0e0 * depth / f AS half_w, h / 2.0e0 * depth / f AS half_h, eye_x + depth * (dx / greatest(depth, 1e-9)) AS centre_x,
  eye_y + depth * (dy / greatest(depth, 1e-9)) AS centre_y, eye_z + depth * (dz / greatest(depth, 1e-9)) AS centre_z FROM c1)"""))
def camera_frustum(spark, sf):
    boxes = mk.silhouettes(table(spark, sf, "mask_runs"), ["scene_id", "view_id"])
    out = cam.frustum(table(spark, sf, "views"), boxes)
    return out.select("scene_id", "view_id", "half_w", "half_h", *_FR.split(", "))


@query("view_tag", oracle(["items"], """SELECT item_id, concat('y', CAST((k * 30) % 360 AS VARCHAR), '_p', CASE WHEN k % 2 = 0 THEN '-15' ELSE '-45' END) AS tag FROM items"""))
def view_tag(spark, sf):
    it = table(spark, sf, "items")
    return it.select("item_id", cam.view_tag(((F.col("k") * 30) % 360).cast("double"),
                                             F.when(F.col("k") % 2 == 0, -15.0).otherwise(-45.0)).alias("tag"))
