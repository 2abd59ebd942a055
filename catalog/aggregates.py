"""Queries on aggregates, frames, masks as sets, rankings and de-duplication."""

import math

from pyspark.sql import functions as F

from motefield import constants as k
from motefield.functions import boxes as bx
from motefield.functions import geometry as g
from motefield.functions import labels as lb
from motefield.operators import dedup as dd
from motefield.operators import filters as fl
from motefield.operators import fits as ft
from motefield.operators import frames as fr
from motefield.operators import inventory as inv
from motefield.operators import masks as mk
from motefield.operators import ranking as rk
from motefield.operators import selection as sel
from motefield.operators import votes as vo
from motefield.staging import stage

from .cleaning import MAXS, OBJ, _BRIGHT, _S2, lg
from .fixtures import mean, oracle, pct, table, hash_cte
from .joins import (BOX_CTE, PART_CTE, S, _SCORE, _SUB, part_links, parts, resolve_cte, runs, scored, stage_splats,
                    views)
from .registry import query
from .rows import H, ID, KEY, PX_CTE, W, _CENTRE, _P298, _TAN35, pixel_items, proj, splats

OK2 = "scene_id, object_id"


def r6(df, keys, cols):
    return df.select(*keys, *[F.round(c, 6).alias(c) for c in cols])


def r6sql(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@query("robust_aabb", oracle(["splats"], f"SELECT {OK2}, x_min, x_max, y_min, y_max, z_min, z_max, volume FROM boxes", BOX_CTE))
def robust_aabb(spark, sf):
    return fr.robust_aabb(splats(spark, sf), OBJ)


@query("tight_aabb", oracle(["splats"], f"SELECT {OK2}, " + ", ".join(f"l{a} - 0.02e0 AS {a}_min, h{a} + 0.02e0 AS {a}_max" for a in "xyz") + " FROM pp", _P298))
def tight_aabb(spark, sf):
    return fr.tight_aabb(splats(spark, sf), OBJ)


@query("median_centre", oracle(["splats", "objects"], f"""SELECT {OK2}, mx AS c_x, CASE WHEN lamp THEN (lo + hi) / 2e0 ELSE my END AS c_y, mz AS c_z,
  greatest(hx - lx, CASE WHEN lamp THEN hi - lo ELSE hy - ly END, hz - lz) AS extent, CASE WHEN lamp THEN 1.4e0 ELSE 2.0e0 END AS margin
  FROM md JOIN (SELECT {OK2}, min(y) AS lo, max(y) AS hi FROM splats GROUP BY ALL) AS r USING ({OK2})
  JOIN (SELECT {OK2}, contains(lower(label), 'floor') AND contains(lower(label), 'lamp') AS lamp FROM objects) AS o USING ({OK2})""", _CENTRE))
def median_centre(spark, sf):
    f = fr.median_frame(splats(spark, sf), OBJ, table(spark, sf, "objects").select(*OBJ, "label"))
    return f.select(*OBJ, "c_x", "c_y", "c_z", "extent", "margin")


@query("full_extent", oracle(["splats"], f"SELECT {OK2}, mx AS c_x, my AS c_y, mz AS c_z, extent FROM md JOIN (SELECT {OK2}, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS extent FROM splats GROUP BY ALL) AS r USING ({OK2})", _CENTRE))
def full_extent(spark, sf):
    return fr.full_extent(splats(spark, sf), OBJ)


@query("display_frame", oracle(["splats", "objects"], f"""SELECT {OK2}, CASE WHEN lk THEN 1e0 ELSE (lx + hx) * 0.5e0 END AS c_x, CASE WHEN lk THEN 2e0 ELSE (ly + hy) * 0.5e0 END AS c_y,
  CASE WHEN lk THEN 3e0 ELSE (lz + hz) * 0.5e0 END AS c_z, round(CASE WHEN lk THEN 4e0 ELSE greatest(hx - lx, hy - ly, hz - lz, 0.15e0) * 1.55e0 / (2.0e0 * {_TAN35}) + 0.5e0 END, 9) AS distance
  FROM (SELECT *, object_id % 5 = 0 AS lk FROM pp) AS q""", _P298))
def display_frame(spark, sf):
    locked = table(spark, sf, "objects").where("object_id % 5 = 0").select(*OBJ, *[F.lit(v).alias(n) for n, v in [
        ("c_x", 1.0), ("c_y", 2.0), ("c_z", 3.0), ("distance", 4.0)]])
    f = fr.display_frame(splats(spark, sf), OBJ, locked=locked)
    return f.select(*OBJ, "c_x", "c_y", "c_z", F.round("distance", 9).alias("distance"))


_TOP = ["eye_x", "eye_y", "eye_z", "tgt_x", "tgt_y", "tgt_z", "distance"]


@query("topdown_camera", oracle(["splats"], f"SELECT scene_id, {r6sql(_TOP)} FROM c", pct("tp", "splats", "scene_id", [
    ("xl", "x", 15.0), ("xh", "x", 85.0), ("zl", "z", 15.0), ("zh", "z", 85.0), ("ya", "y", 85.0)]) + f""",
  c0 AS (SELECT *, greatest((xh - xl) * 3.0e0 / (2 * {_TAN35} * (3840 / 2160e0)), (zh - zl) * 3.0e0 / (2 * {_TAN35})) AS distance FROM tp),
  c AS (SELECT scene_id, (xl + xh) / 2 AS eye_x, ya - distance AS eye_y, (zl + zh) / 2 AS eye_z, (xl + xh) / 2 + 0.001e0 AS tgt_x, ya AS tgt_y, (zl + zh) / 2 AS tgt_z, distance FROM c0)"""))
def topdown_camera(spark, sf):
    return r6(fr.topdown_camera(splats(spark, sf), S), S, _TOP)


@query("topdown_frame_full", oracle(["splats"], f"SELECT {OK2}, {r6sql(_TOP)} FROM c", f"""c0 AS (SELECT {OK2}, min(x) AS xl, max(x) AS xh, min(z) AS zl, max(z) AS zh, max(y) AS ya FROM splats GROUP BY ALL),
  c1 AS (SELECT *, greatest((xh - xl) * 1.55e0 / (2 * {_TAN35} * (1920 / 1080e0)), (zh - zl) * 1.55e0 / (2 * {_TAN35}), 1e0) AS distance FROM c0),
  c AS (SELECT {OK2}, (xl + xh) / 2 AS eye_x, ya - distance AS eye_y, (zl + zh) / 2 AS eye_z, (xl + xh) / 2 + 0.001e0 AS tgt_x, ya AS tgt_y, (zl + zh) / 2 AS tgt_z, distance FROM c1)"""))
def topdown_frame_full(spark, sf):
    return r6(fr.topdown_frame_full(splats(spark, sf), OBJ), OBJ, _TOP)


_T25 = f"{math.tan(math.radians(25.0))!r}e0"
_YAWS = ", ".join(f"({y}, {math.sin(math.radians(y))!r}, {math.cos(math.radians(y))!r})" for y in k.ART_YAWS)


def _lit(v):
    s = repr(float(v))
    return s if "e" in s else s + "e0"


_YAWS = ", ".join(f"({y}, {_lit(math.sin(math.radians(y)))}, {_lit(math.cos(math.radians(y)))})" for y in k.ART_YAWS)


@query("perpendicular_frame", oracle(["splats"], f"SELECT {OK2}, yaw, " + r6sql(["u_half", "v_half", "distance", "eye_x", "eye_z"]) + " FROM c", ", ".join([
    pct("m5", "splats", OK2, [("mx", "x", 50.0), ("my", "y", 50.0), ("mz", "z", 50.0)]),
    f"rl AS (SELECT {OK2}, yaw, si, co, (x - mx) * co - (z - mz) * si AS u, y - my AS v FROM splats JOIN m5 USING ({OK2}) CROSS JOIN (VALUES {_YAWS}) AS t(yaw, si, co))",
    pct("pf", "rl", OK2 + ", yaw, si, co", [("ul", "u", 5.0), ("uh", "u", 95.0), ("vl", "v", 5.0), ("vh", "v", 95.0)]),
    f"""c0 AS (SELECT *, greatest(abs(ul), abs(uh)) AS u_half, greatest(abs(vl), abs(vh)) AS v_half FROM pf JOIN m5 USING ({OK2})),
    c1 AS (SELECT *, greatest(u_half * 2.0e0 / ({_T25} * (1920 / 1080e0)), v_half * 2.0e0 / {_T25}, 0.5e0) AS distance FROM c0),
    c AS (SELECT *, mx + distance * si AS eye_x, mz + distance * co AS eye_z FROM c1)"""])))
def perpendicular_frame(spark, sf):
    f = fr.perpendicular_frames(splats(spark, sf), OBJ)
    return r6(f, [*OBJ, "yaw"], ["u_half", "v_half", "distance", "eye_x", "eye_z"])


@query("inside_view_camera", oracle(["splats"], """SELECT scene_id, tag, cx AS eye_x, CASE WHEN tag = 'topdown' THEN fy - 1.6e0 - 4.0e0 ELSE fy - 1.6e0 END AS eye_y, cz AS eye_z,
  CASE WHEN tag = 'topdown' THEN cx + 0.001e0 ELSE cx + dx * 5.0e0 END AS tgt_x, CASE WHEN tag = 'topdown' THEN fy ELSE fy - 1.6e0 END AS tgt_y,
  CASE WHEN tag = 'topdown' THEN cz ELSE cz + dz * 5.0e0 END AS tgt_z FROM iv CROSS JOIN (VALUES ('y0', 0e0, 1e0), ('y90', -1e0, 0e0), ('y180', 0e0, -1e0), ('y270', 1e0, 0e0), ('topdown', 0e0, 0e0)) AS t(tag, dx, dz)""",
       pct("iv", "splats", "scene_id", [("cx", "x", 50.0), ("cz", "z", 50.0), ("fy", "y", 95.0)])))
def inside_view_camera(spark, sf):
    return fr.inside_views(splats(spark, sf), S)


_T175, _T12 = _lit(math.tan(math.radians(17.5))), _lit(math.tan(math.radians(12.0)))


@query("front_camera", oracle(["splats"], f"SELECT {OK2}, {r6sql(_TOP)} FROM c", _P298 + f""",
  rm AS (SELECT scene_id, {mean('x')} AS rx, {mean('z')} AS rz FROM splats GROUP BY scene_id),
  f0 AS (SELECT *, (lx + hx) / 2 AS tx, (ly + hy) / 2 AS ty, (lz + hz) / 2 AS tz FROM pp JOIN rm USING (scene_id)),
  f1 AS (SELECT *, tx - rx AS ax, tz - rz AS az, greatest(sqrt((hx - lx) * (hx - lx) + (hz - lz) * (hz - lz)) / (1920 / 1080e0), abs(hy - ly)) * 2.6e0 / (2 * {_T175}) AS distance FROM f0),
  f2 AS (SELECT *, ax / sqrt(ax * ax + az * az) AS dx, az / sqrt(ax * ax + az * az) AS dz FROM f1),
  c AS (SELECT {OK2}, tx - dx * distance + 0.2e0 * dz AS eye_x, ty - {_T12} * distance - 0.1e0 AS eye_y, tz - dz * distance - 0.2e0 * dx AS eye_z,
    tx - 0.3e0 * dz AS tgt_x, ty AS tgt_y, tz + 0.3e0 * dx AS tgt_z, distance FROM f2)"""))
def front_camera(spark, sf):
    return r6(fr.front_camera(splats(spark, sf), OBJ, orbit_m=0.5, pan_m=0.3, lift_m=0.1), OBJ, _TOP)


_EXT = pct("ex", "splats", OK2, [(f"{o}{a}", a, p) for a in "xyz" for o, p in (("l", 15.0), ("h", 85.0))]) + f""",
  va AS (SELECT {OK2}, x_ext, y_ext, z_ext, CASE WHEN x_ext <= y_ext AND x_ext <= z_ext THEN 'x' WHEN y_ext <= z_ext THEN 'y' ELSE 'z' END AS axis
  FROM (SELECT {OK2}, hx - lx AS x_ext, hy - ly AS y_ext, hz - lz AS z_ext FROM ex) AS q)"""


@query("vertical_axis", oracle(["splats"], "SELECT * FROM va", _EXT))
def vertical_axis(spark, sf):
    return fr.vertical_axis(splats(spark, sf), OBJ)


@query("axis_assert", oracle(["splats"], "SELECT *, axis = 'y' AS y_vertical, CASE WHEN axis <> 'y' THEN axis END AS turn_from, z_ext > x_ext AS turn_90 FROM va", _EXT))
def axis_assert(spark, sf):
    return fr.axis_assert(splats(spark, sf), OBJ)


_RB = pct("bp", "splats", "scene_id", [(f"{a}b_{n}", a, p) for a in "xz" for n, p in (("min", 15.0), ("max", 85.0))]) + f""",
  rbd AS (SELECT *, (xb_min + xb_max) / 2 AS cx, (zb_min + zb_max) / 2 AS cz, cy - 1.0e0 AS eye_y FROM bp JOIN (SELECT scene_id, {mean('y')} AS cy FROM splats GROUP BY scene_id) AS m USING (scene_id))"""


@query("room_bounds", oracle(["splats"], "SELECT scene_id, xb_min, xb_max, zb_min, zb_max, cy, cx, cz, eye_y FROM rbd", _RB))
def room_bounds(spark, sf):
    return fr.room_bounds(splats(spark, sf), S)


@query("diorama_cameras", oracle(["splats"], """SELECT scene_id, q AS quadrant, ex AS eye_x, eye_y, ez AS eye_z, ex AS tgt_x, eye_y AS tgt_y, tz AS tgt_z, abs(tz - ez) AS target_dist FROM (
  SELECT scene_id, 'NE' AS q, (cx + xb_max) / 2 AS ex, eye_y, cz - 2.0e0 AS ez, zb_max AS tz FROM rbd UNION ALL SELECT scene_id, 'NW', (xb_min + cx) / 2, eye_y, cz - 2.0e0, zb_max FROM rbd
  UNION ALL SELECT scene_id, 'SE', (cx + xb_max) / 2, eye_y, cz + 2.0e0, zb_min FROM rbd UNION ALL SELECT scene_id, 'SW', (xb_min + cx) / 2, eye_y, cz + 2.0e0, zb_min FROM rbd) AS u""", _RB))
def diorama_cameras(spark, sf):
    return fr.diorama_cameras(fr.room_bounds(splats(spark, sf), S), S)


# --- ladders and picks -----------------------------------------------------

def sweep(spark, sf):
    rungs = [(f"{t:.2f}", t) for t in k.SCORE_LADDER]
    out = sel.threshold_sweep(scored(spark, sf), OBJ, rungs, lambda t: F.col("insideness") >= t)
    return out.withColumn("thresh", F.col("name").cast("double"))


SWEEP_CTE = _SCORE + f""", sw AS (SELECT {OK2}, rung, thresh, count(*) FILTER (WHERE insideness >= thresh) AS n_kept, count(*) AS n_total,
  CAST(count(*) FILTER (WHERE insideness >= thresh) AS DOUBLE) / count(*) AS kept_share FROM sc CROSS JOIN (VALUES (0, 0.30e0), (1, 0.45e0), (2, 0.60e0), (3, 0.75e0), (4, 0.85e0)) AS l(rung, thresh) GROUP BY {OK2}, rung, thresh),
  fall AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN p > 0 THEN CASE WHEN (p - kept_share) / p > 0.22e0 THEN 1 ELSE 0 END ELSE 1 END AS f FROM (SELECT *, lag(kept_share) OVER (PARTITION BY {OK2} ORDER BY rung) AS p FROM sw) AS q),
  guard AS (SELECT {OK2}, rung, thresh, n_kept, n_total, kept_share FROM (SELECT *, max(f) OVER (PARTITION BY {OK2} ORDER BY rung ROWS UNBOUNDED PRECEDING) AS cut FROM fall) AS q WHERE cut = 0)"""
_MASKS = ["splats", "views", "mask_runs"]
_SW = [*OBJ, "rung", "thresh", "n_kept", "n_total", "kept_share"]


@query("threshold_sweep", oracle(_MASKS, f"SELECT {', '.join(_SW)} FROM sw", SWEEP_CTE))
def threshold_sweep(spark, sf):
    return sweep(spark, sf).select(*_SW)


@query("collapse_guard", oracle(_MASKS, f"SELECT {', '.join(_SW)} FROM guard", SWEEP_CTE))
def collapse_guard(spark, sf):
    return sel.collapse_guard(sweep(spark, sf), OBJ).select(*_SW)


@query("rule_pick", oracle(_MASKS, f"SELECT {OK2}, max(rung) AS rung FROM guard GROUP BY {OK2}", SWEEP_CTE))
def rule_pick(spark, sf):
    return sel.rule_pick(sel.collapse_guard(sweep(spark, sf), OBJ), OBJ)


@query("ladder_by_label", oracle([*_MASKS, "objects"], f"SELECT {', '.join('sw.' + c for c in _SW)} FROM sw JOIN objects AS o USING ({OK2}) WHERE thresh <= 0.60e0 OR NOT (contains(lower(label), 'cabinet') OR contains(lower(label), 'shelf') OR contains(lower(label), 'shelving'))".replace("sw.scene_id", "scene_id").replace("sw.object_id", "object_id"), SWEEP_CTE))
def ladder_by_label(spark, sf):
    return sel.ladder_by_label(sweep(spark, sf), table(spark, sf, "objects").select(*OBJ, "label"), OBJ).select(*_SW)


def pick_replies(spark, sf):
    return table(spark, sf, "objects").where("object_id % 3 <> 2").select(*OBJ, (F.col("object_id") % 4).cast("int").alias("pick"))


@query("apply_pick", oracle([*_MASKS, "objects"], f"""SELECT {', '.join(f'sc.{c}' for c in ('ok', 'pk', 'sk', 'ln'))} FROM sc JOIN (SELECT {OK2}, CAST(CASE WHEN pick >= 1 AND pick <= n THEN pick - 1 ELSE floor(n / 2) END AS INTEGER) AS rung
  FROM (SELECT {OK2}, count(*) AS n FROM guard GROUP BY {OK2}) AS g LEFT JOIN (SELECT {OK2}, object_id % 4 AS pick FROM objects WHERE object_id % 3 <> 2) AS p USING ({OK2})) AS ch USING ({OK2})
  JOIN guard USING ({OK2}, rung) WHERE insideness >= thresh""", SWEEP_CTE))
def apply_pick(spark, sf):
    from motefield.staging import staged_small
    s = scored(spark, sf)
    rungs = [(f"{t:.2f}", t) for t in k.SCORE_LADDER]
    sw = sel.threshold_sweep(s, OBJ, rungs, lambda t: F.col("insideness") >= t).withColumn("thresh", F.col("name").cast("double"))
    guard = stage(sel.collapse_guard(sw, OBJ))
    chosen = sel.apply_pick(guard, pick_replies(spark, sf), OBJ).join(guard.select(*OBJ, "rung", "thresh"), [*OBJ, "rung"])
    return s.join(staged_small(chosen.select(*OBJ, "thresh")), OBJ).where(F.col("insideness") >= F.col("thresh")).select(*KEY)


_STREAK = ", ".join(f"({i}, {s!r}e0, {b!r}e0, {lg(s)})" for i, (_, s, b) in enumerate(k.STREAK_LADDER))
STREAK_CTE = f"""st AS (SELECT {OK2}, rung, count(*) FILTER (WHERE NOT (m > logs AND br < b)) AS n_kept, count(*) AS n_total FROM (SELECT {OK2}, {MAXS} AS m, {_BRIGHT} AS br FROM splats) AS s
  CROSS JOIN (VALUES {_STREAK}) AS l(rung, s, b, logs) GROUP BY {OK2}, rung)"""


def streak_sweep(spark, sf):
    return sel.threshold_sweep(splats(spark, sf), OBJ, k.STREAK_LADDER, lambda s, b: ~fl.dark_streak(s, b))


@query("destreak_sweep", oracle(["splats"], f"SELECT {OK2}, rung, n_kept, n_total FROM st", STREAK_CTE))
def destreak_sweep(spark, sf):
    return streak_sweep(spark, sf).select(*OBJ, "rung", "n_kept", "n_total")


@query("sweep_noop", oracle(["splats"], f"SELECT {OK2}, n_kept = n_total AS noop FROM st WHERE rung = 4", STREAK_CTE))
def sweep_noop(spark, sf):
    return sel.sweep_noop(streak_sweep(spark, sf), OBJ)


@query("nudge_threshold", oracle(["items"], """SELECT scene_id, quadrant, CASE WHEN near THEN greatest(0.01e0, least(0.50e0, c + CASE WHEN i % 2 = 0 THEN 0.03e0 ELSE -0.03e0 END)) ELSE c END AS next_thresh FROM (
  SELECT scene_id, quadrant, max(greatest(0.01e0, least(0.50e0, cur))) AS c, bool_or(abs(thresh - greatest(0.01e0, least(0.50e0, cur))) < 0.005e0) AS near, max(k % 4) AS i
  FROM (SELECT scene_id, quadrant, k, CAST(bx0 AS DOUBLE) / 1000 AS thresh, CAST(scene_id * 200 + 96 AS DOUBLE) / 1000 AS cur FROM items) AS t GROUP BY scene_id, quadrant) AS q"""))
def nudge_threshold(spark, sf):
    t = table(spark, sf, "items").select("scene_id", "quadrant", "k", (F.col("bx0").cast("double") / 1000).alias("thresh"),
                                         ((F.col("scene_id") * 200 + 96).cast("double") / 1000).alias("cur"))
    return sel.nudge_threshold(t, ["scene_id", "quadrant"], "cur", F.col("k") % 4)


def attempts(spark, sf):
    return table(spark, sf, "items").select("scene_id", (F.col("k") % 20).alias("grp"), F.col("item_id").alias("attempt"),
                                            (F.col("bx0") % 4).alias("main_hits"), (F.col("by0") % 6).alias("view_hits"))


@query("best_attempt", oracle(["items"], """SELECT scene_id, grp, ok AS accepted, attempt, main_hits, view_hits FROM (SELECT *, row_number() OVER (PARTITION BY scene_id, grp
  ORDER BY CASE WHEN ok THEN CASE WHEN main_hits >= 3 THEN 0 ELSE 1 END ELSE 0 END, CASE WHEN ok THEN 0 ELSE -main_hits END, CASE WHEN ok THEN 0 ELSE -view_hits END, attempt) AS r FROM (
  SELECT *, bool_or(main_hits >= 3) OVER (PARTITION BY scene_id, grp) AS ok FROM (SELECT scene_id, k % 20 AS grp, item_id AS attempt, bx0 % 4 AS main_hits, by0 % 6 AS view_hits FROM items) AS a) AS b) AS c WHERE r = 1"""))
def best_attempt(spark, sf):
    return sel.best_attempt(attempts(spark, sf), ["scene_id", "grp"])


# --- masks as sets ---------------------------------------------------------

VIEW = ["scene_id", "view_id"]
PIXELS = "SELECT DISTINCT scene_id, view_id, {} y, unnest(range(x0, x1 + 1)) AS px FROM {}"


def island(source, keys):
    """Runs of a pixel table, merged."""
    return (f"SELECT {keys}, y, CAST(min(px) AS INTEGER) AS x0, CAST(max(px) AS INTEGER) AS x1 FROM (SELECT *, px - row_number() OVER (PARTITION BY {keys}, y ORDER BY px) AS g FROM {source}) AS q GROUP BY {keys}, y, g")


@query("mask_union", oracle(["mask_runs"], island("px1", "scene_id, view_id"), "px1 AS (" + PIXELS.format("", "mask_runs") + ")"))
def mask_union(spark, sf):
    return mk.mask_union(runs(spark, sf), VIEW).select(*VIEW, "y", "x0", "x1")


@query("mask_offset", oracle(["mask_runs"], """SELECT scene_id, view_id, prompt_id, y + prompt_id * 9 - 10 AS y, greatest(0, x0 + view_id * 10 - 20) AS x0, least(191, x1 + view_id * 10 - 20) AS x1
  FROM mask_runs WHERE y + prompt_id * 9 - 10 BETWEEN 0 AND 107 AND least(191, x1 + view_id * 10 - 20) >= greatest(0, x0 + view_id * 10 - 20)"""))
def mask_offset(spark, sf):
    r = runs(spark, sf)
    return mk.mask_offset(r, F.col("view_id") * 10 - 20, F.col("prompt_id") * 9 - 10, F.lit(192), F.lit(108)).select(*VIEW, "prompt_id", "y", "x0", "x1")


@query("mask_dilate", oracle(["mask_runs"], island("px2", "scene_id, view_id"), f"""t AS (SELECT *, 1 + view_id % 5 AS r FROM mask_runs WHERE y % 6 = 0),
  g AS (SELECT scene_id, view_id, CAST(y + dy AS INTEGER) AS y, greatest(0, x0 - CAST(floor(sqrt(CAST(r * r - dy * dy AS DOUBLE))) AS INTEGER)) AS x0, least(191, x1 + CAST(floor(sqrt(CAST(r * r - dy * dy AS DOUBLE))) AS INTEGER)) AS x1
    FROM (SELECT *, unnest(range(-r, r + 1)) AS dy FROM t) AS u WHERE y + dy BETWEEN 0 AND 107),
  px2 AS ({PIXELS.format('', 'g')})""".replace("SELECT *, 1 + view_id % 5 AS r FROM mask_runs WHERE y % 6 = 0", "SELECT *, 1 + view_id % 5 AS r FROM mask_runs")))
def mask_dilate(spark, sf):
    return mk.mask_dilate(runs(spark, sf), VIEW, (1 + F.col("view_id") % 5).cast("double"), F.lit(192), F.lit(108)).select(*VIEW, "y", "x0", "x1")


_PP = "scene_id, view_id, prompt_id"
_PX3 = "px3 AS (SELECT DISTINCT scene_id, view_id, prompt_id, y, unnest(range(x0, x1 + 1)) AS px FROM mask_runs)"


@query("mask_health", oracle(["mask_runs"], f"SELECT i.* FROM ({island('px3', _PP)}) AS i JOIN (SELECT {_PP} FROM px3 GROUP BY {_PP} HAVING count(*) >= 1200) AS b USING ({_PP})", _PX3))
def mask_health(spark, sf):
    keys = [*VIEW, "prompt_id"]
    return mk.healthy(runs(spark, sf), keys, 1200).select(*keys, "y", "x0", "x1")


@query("pool_masks", oracle(["mask_runs"], f"SELECT i.* FROM ({island('px4', 'pass_no, scene_id, view_id')}) AS i JOIN (SELECT pass_no, scene_id, view_id FROM px4 GROUP BY ALL HAVING count(*) >= 1200) AS b USING (pass_no, scene_id, view_id)",
       "px4 AS (SELECT DISTINCT pass_id AS pass_no, scene_id, view_id, y, unnest(range(x0, x1 + 1)) AS px FROM mask_runs)"))
def pool_masks(spark, sf):
    r = runs(spark, sf)
    passes = [r.where(F.col("pass_id") == i).select(*VIEW, "y", "x0", "x1") for i in range(3)]
    return mk.pool_masks(passes, VIEW, 1200).select("pass_no", *VIEW, "y", "x0", "x1")


@query("silhouette_bbox", oracle(["mask_runs"], "SELECT scene_id, view_id, min(x0) AS x0, min(y) AS y0, max(x1) AS x1, max(y) AS y1 FROM mask_runs GROUP BY scene_id, view_id"))
def silhouette_bbox(spark, sf):
    return mk.silhouettes(runs(spark, sf), VIEW)


_HITS = _PX3 + f", hits AS (SELECT scene_id, prompt_id, count(*) AS hits FROM (SELECT {_PP} FROM px3 GROUP BY {_PP} HAVING count(*) >= 1000) AS q GROUP BY scene_id, prompt_id)"


@query("prompt_hits", oracle(["mask_runs"], "SELECT scene_id, prompt_id, hits, n_views FROM hits JOIN (SELECT scene_id, count(DISTINCT view_id) AS n_views FROM mask_runs GROUP BY scene_id) AS v USING (scene_id)", _HITS))
def prompt_hits(spark, sf):
    r = runs(spark, sf)
    hits = mk.prompt_hits(r, S, "prompt_id", "view_id", 1000)
    n = r.groupBy(*S).agg(F.count_distinct("view_id").alias("n_views"))
    return mk.hit_map(hits, n, S, "prompt_id").select("scene_id", F.explode("per_prompt_hits").alias("prompt_id", "hits"), "n_views")


@query("min_view_hits", oracle(["mask_runs"], "SELECT scene_id, prompt_id, hits FROM hits WHERE hits >= 5", _HITS))
def min_view_hits(spark, sf):
    return mk.min_view_hits(mk.prompt_hits(runs(spark, sf), S, "prompt_id", "view_id", 1000))


# --- sets of splats --------------------------------------------------------

@query("stage_union", oracle(["stage_splats"], f"SELECT DISTINCT scene_id, object_id, {ID} FROM stage_splats WHERE stage IN ({_SUB})"))
def stage_union(spark, sf):
    return stage_splats(spark, sf).where(F.col("stage").isin(k.SUBTRACT_STAGES)).select(*OBJ, *KEY).distinct()


def merged(spark, sf):
    s = splats(spark, sf)
    back = fl.density_filter(s, 10).select(*KEY, "scene_id", "x", "y", "z", "opacity")
    objs = stage_splats(spark, sf).where(F.col("stage") == "1_visual_hull").select(*KEY, "scene_id", "x", "y", "z", "rank")
    return back, objs, inv.merge_scene(back, objs)


_MERGE = "mv AS (SELECT *, count(*) OVER (PARTITION BY scene_id, CAST(floor(x / 0.1e0) AS BIGINT), CAST(floor(y / 0.1e0) AS BIGINT), CAST(floor(z / 0.1e0) AS BIGINT)) AS n FROM splats), bk AS (SELECT * FROM mv WHERE n >= 10), ob AS (SELECT * FROM stage_splats WHERE stage = '1_visual_hull')"


@query("merge_scene", oracle(["splats", "stage_splats"], f"SELECT {ID}, scene_id, x, y, z, opacity FROM bk UNION ALL SELECT {ID}, scene_id, x, y, z, 0e0 FROM ob", _MERGE))
def merge_scene(spark, sf):
    return merged(spark, sf)[2]


@query("reassembly_check", oracle(["splats", "stage_splats"], """SELECT scene_id, b + o AS merged_total, b AS background_splats, o AS object_total_splats, b + o AS expected_if_no_overlap, CAST(0 AS BIGINT) AS delta, TRUE AS same_rows
  FROM (SELECT scene_id, count(*) AS b FROM bk GROUP BY scene_id) AS x JOIN (SELECT scene_id, count(*) AS o FROM ob GROUP BY scene_id) AS y USING (scene_id)""", _MERGE))
def reassembly_check(spark, sf):
    return inv.reassembly_check(*merged(spark, sf), S)


@query("parent_alone", oracle(["splats", "stage_splats"], f"SELECT {ID} FROM splats AS s WHERE NOT EXISTS (SELECT 1 FROM stage_splats AS t WHERE t.stage = '2_sam_wide' AND t.ok = s.ok AND t.pk = s.pk AND t.sk = s.sk AND t.ln = s.ln)"))
def parent_alone(spark, sf):
    child = stage_splats(spark, sf).where(F.col("stage") == "2_sam_wide").select(*KEY)
    return splats(spark, sf).join(child, KEY, "left_anti").select(*KEY)


@query("concat_passes", oracle(["items"], "SELECT item_id, pass, label FROM (SELECT item_id, label, 'pass1_seating' AS pass FROM items WHERE k % 3 = 0 UNION ALL SELECT item_id, label, 'pass2_storage' FROM items WHERE k % 3 = 1 UNION ALL SELECT item_id, label, 'pass3_tables' FROM items WHERE k % 3 = 2) AS q"))
def concat_passes(spark, sf):
    it = table(spark, sf, "items")
    return inv.concat_passes({n: it.where(F.col("k") % 3 == i) for i, n in enumerate(["pass1_seating", "pass2_storage", "pass3_tables"])}).select("item_id", "pass", "label")


@query("concat_views", oracle(["splats"], f"SELECT {OK2}, kind, angle FROM (SELECT DISTINCT {OK2} FROM splats) AS o CROSS JOIN (SELECT 'yaw' AS kind, unnest([0, 45, 90, 135, 180, 225, 270, 315]) AS angle UNION ALL SELECT 'pitch', unnest([0, 45, 90, 135, 180, 225, 270, 315])) AS v"))
def concat_views(spark, sf):
    f = fr.perpendicular_frames(splats(spark, sf), OBJ)
    yaw = f.select(*OBJ, F.lit("yaw").alias("kind"), F.col("yaw").alias("angle"), "u_half")
    pitch = f.select(*OBJ, F.lit("pitch").alias("kind"), F.col("yaw").alias("angle"), "v_half")
    return yaw.unionByName(pitch, allowMissingColumns=True).select(*OBJ, "kind", "angle")


@query("splat_stats", oracle(["splats"], f"SELECT scene_id, median, p95, p99, max FROM ss JOIN (SELECT scene_id, max(m) AS max FROM sm GROUP BY scene_id) AS t USING (scene_id)", f"sm AS (SELECT scene_id, {MAXS} AS m FROM splats), " + pct("ss", "sm", "scene_id", [("median", "m", 50.0), ("p95", "m", 95.0), ("p99", "m", 99.0)])))
def splat_stats(spark, sf):
    return inv.splat_stats(splats(spark, sf), S, g.max_log_scale())


@query("stage_counts", oracle(["stage_splats"], "SELECT scene_id, object_id, stage, count(*) AS n_splats FROM stage_splats GROUP BY scene_id, object_id, stage"))
def stage_counts(spark, sf):
    return stage_splats(spark, sf).groupBy(*OBJ, "stage").agg(F.count("*").alias("n_splats"))


@query("point_raster", oracle(["splats", "views"], "SELECT scene_id, view_id, xi AS px, yi AS py, count(*) AS n, " + ", ".join(f"{mean(f'f_dc_{i}')} AS mean_f_dc_{i}" for i in range(3)) + ", min(depth) AS near_depth FROM idx WHERE in_img GROUP BY scene_id, view_id, xi, yi", proj("cam", "idx0", "idx")))
def point_raster(spark, sf):
    return ft.point_raster(splats(spark, sf), views(spark, sf), S)


_ANG = ", ".join(f"({t}, {_lit(c)}, {_lit(s)})" for t, c, s in ft.ANGLES)


@query("dominant_yaw", oracle(["splats"], "SELECT scene_id, coalesce(deg, 0e0) AS yaw_deg FROM (SELECT DISTINCT scene_id FROM cl) AS c LEFT JOIN (SELECT scene_id, median(CAST((theta + 45) % 90 - 45 AS DOUBLE)) AS deg FROM bst WHERE r <= 200 GROUP BY scene_id) AS m USING (scene_id)", f"""
  cl AS (SELECT DISTINCT scene_id, CAST(floor(x / 0.05e0) AS BIGINT) AS i, CAST(floor(z / 0.05e0) AS BIGINT) AS j FROM splats),
  ed AS (SELECT * FROM cl AS c WHERE (SELECT count(*) FROM cl AS d WHERE d.scene_id = c.scene_id AND abs(d.i - c.i) + abs(d.j - c.j) = 1) < 4),
  vo AS (SELECT scene_id, theta, CAST(round_even(i * co + j * si, 0) AS BIGINT) AS rho, count(*) AS votes FROM ed CROSS JOIN (VALUES {_ANG}) AS a(theta, co, si) GROUP BY 1, 2, 3 HAVING count(*) >= 10),
  bst AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY votes DESC, theta, rho) AS r FROM vo)"""))
def dominant_yaw(spark, sf):
    cells = stage(ft.edge_cells(stage(ft.floor_cells(splats(spark, sf), S, 0.05)), S))
    return ft.dominant_yaw(cells, S, least=10)


@query("plane_fit", oracle(["splats"], "SELECT scene_id, b.a AS a, b.b AS b, b.c AS c, b.d AS d, b.inliers AS inliers FROM (SELECT scene_id, arg_max({'a': a, 'b': b, 'c': c, 'd': d, 'inliers': inliers}, (inliers, -try)) AS b FROM sco GROUP BY scene_id) AS q", ", ".join([
  hash_cte("hs", "splats", KEY, 7), f"s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY h, {ID}) AS q FROM hs) AS z WHERE q <= 192)",
  hash_cte("h2", "s1", KEY, 8, "g"), f"""s2 AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY g, {ID}) - 1 AS r FROM h2),
  tr AS (SELECT scene_id, r // 3 AS try, """ + ", ".join(f"max(CASE WHEN r % 3 = {i} THEN {a} END) AS {a}{i}" for a in "xyz" for i in range(3)) + """ FROM s2 GROUP BY scene_id, r // 3),
  nr AS (SELECT *, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS na, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS nb, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nc FROM tr),
  ln_ AS (SELECT *, sqrt(na * na + nb * nb + nc * nc) AS len, CASE WHEN nb < 0 THEN -1e0 ELSE 1e0 END AS sg FROM nr),
  pn AS (SELECT scene_id, try, x0, y0, z0, na * sg / len AS a, nb * sg / len AS b, nc * sg / len AS c FROM ln_ WHERE len > 1e-12),
  pd_ AS (SELECT *, -(a * x0 + b * y0 + c * z0) AS d FROM pn),
  sco AS (SELECT p.scene_id, try, a, b, c, d, count(*) FILTER (WHERE abs(a * x + b * y + c * z + d) <= 0.05e0) AS inliers FROM pd_ AS p JOIN splats AS s ON s.scene_id = p.scene_id GROUP BY ALL)"""])))
def plane_fit(spark, sf):
    return ft.plane_fit(splats(spark, sf), S, KEY)


# --- ranking and de-duplication --------------------------------------------

def slugged(spark, sf):
    return table(spark, sf, "items").withColumn("slug", lb.slug(F.col("label")))


_SLUG = "coalesce(nullif(trim(regexp_replace(lower({}), '[^a-zA-Z0-9]+', '_', 'g'), '_'), ''), '{}')"
SLUG_CTE = f"sl AS (SELECT *, {_SLUG.format('label', 'item')} AS slug FROM items), fo AS (SELECT *, CASE WHEN n = 1 THEN slug ELSE concat(slug, '_', CAST(n AS VARCHAR)) END AS folder FROM (SELECT *, row_number() OVER (PARTITION BY scene_id, slug ORDER BY item_id) AS n FROM sl) AS q)"


@query("slug_suffix", oracle(["items"], "SELECT item_id, folder FROM fo", SLUG_CTE))
def slug_suffix(spark, sf):
    return rk.slug_suffix(slugged(spark, sf), S, "slug", "item_id").select("item_id", "folder")


def named(spark, sf):
    """Items with their folder and a refined label for two of three."""
    it = rk.slug_suffix(slugged(spark, sf), S, "slug", "item_id")
    it = it.withColumn("refined", F.expr("CASE k % 3 WHEN 0 THEN label WHEN 1 THEN concat('new ', label) END"))
    return it.withColumn("wanted", F.when(F.col("refined").isNotNull(), lb.slug(F.col("refined"), "object", 60)))


@query("rename_plan", oracle(["items"], "SELECT item_id, CASE WHEN NOT kp AND nm <> folder THEN nm END AS new_name FROM (SELECT *, CASE WHEN num = 1 THEN wanted ELSE concat(wanted, '_', CAST(num AS VARCHAR)) END AS nm FROM res) AS q", SLUG_CTE + f""",
  wn AS (SELECT *, {_SLUG.format("CASE k % 3 WHEN 0 THEN label WHEN 1 THEN concat('new ', label) END", 'object')} AS w0, k % 3 = 2 AS noref FROM fo),
  ww AS (SELECT * EXCLUDE (w0), CASE WHEN noref THEN NULL ELSE w0 END AS wanted FROM wn),
  kk AS (SELECT *, wanted IS NULL OR wanted = folder AS kp FROM ww),
  mv AS (SELECT *, row_number() OVER (PARTITION BY scene_id, wanted ORDER BY item_id) AS j FROM kk WHERE NOT kp),
  free AS (SELECT b.scene_id, b.wanted, n, row_number() OVER (PARTITION BY b.scene_id, b.wanted ORDER BY n) AS j FROM (SELECT scene_id, wanted, unnest(range(1, CAST(count(*) AS BIGINT) + (SELECT count(*) FROM items) + 1)) AS n FROM mv GROUP BY scene_id, wanted) AS b
    WHERE NOT EXISTS (SELECT 1 FROM kk WHERE kp AND kk.scene_id = b.scene_id AND kk.folder = CASE WHEN b.n = 1 THEN b.wanted ELSE concat(b.wanted, '_', CAST(b.n AS VARCHAR)) END)),
  res AS (SELECT mv.*, free.n AS num FROM mv JOIN free USING (scene_id, wanted, j) UNION ALL SELECT kk.*, NULL, NULL FROM kk WHERE kp)"""))
def rename_plan(spark, sf):
    return rk.rename_plan(named(spark, sf), S, "folder", "wanted", "item_id").select("item_id", "new_name")


@query("first_label_match", oracle(["items"], "SELECT scene_id, quadrant, min(item_id) AS item_id FROM items WHERE contains(lower(label), 'table') GROUP BY scene_id, quadrant"))
def first_label_match(spark, sf):
    return inv.first_label_match(table(spark, sf, "items"), ["scene_id", "quadrant"], " Table ", "item_id")


@query("sort_by_area", oracle(["items"], "SELECT scene_id, item_id, (bx1 - bx0) * (by1 - by0) AS area, row_number() OVER (PARTITION BY scene_id ORDER BY (bx1 - bx0) * (by1 - by0) DESC, item_id) AS position FROM items"))
def sort_by_area(spark, sf):
    it = table(spark, sf, "items").withColumn("area", (F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0")))
    it = it.withColumn("_o", -F.col("area") * 10_000_000_000 + F.col("item_id"))
    return rk.grouped_row_number(it, S, "_o", "position").select("scene_id", "item_id", "area", "position")


@query("view_limit", oracle(["splats"], f"SELECT {OK2}, pk FROM (SELECT *, row_number() OVER (PARTITION BY {OK2} ORDER BY pk) AS r FROM (SELECT DISTINCT {OK2}, pk FROM splats) AS d) AS q WHERE r <= 4"))
def view_limit(spark, sf):
    return rk.top_rows(splats(spark, sf).select(*OBJ, "pk").distinct(), OBJ, ["pk"], 4)


@query("point_sample", oracle(["splats"], f"SELECT {ID}, scene_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY h, {ID}) AS r FROM hs) AS q WHERE r <= 5000", hash_cte("hs", "splats", KEY, 42)))
def point_sample(spark, sf):
    return rk.sample_per_group(splats(spark, sf), S, 5000, KEY).select(*KEY, "scene_id")


IOU = "CAST({i} AS DOUBLE) / ({a} + {b} - {i})"
_BI = "(greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)))"


def area_sql(p, least=None):
    if least:
        return f"greatest({least}, ({p}.x1 - {p}.x0) * ({p}.y1 - {p}.y0))"
    return f"(greatest(0, {p}.x1 - {p}.x0) * greatest(0, {p}.y1 - {p}.y0))"


def iou_sql(least=None):
    i, a, b = _BI, area_sql("a", least), area_sql("b", least)
    return f"CASE WHEN {a} + {b} - {i} > 0 THEN CAST({i} AS DOUBLE) / ({a} + {b} - {i}) ELSE 0e0 END"


def norm_items(spark, sf):
    return table(spark, sf, "items").withColumnsRenamed({"bx0": "x0", "by0": "y0", "bx1": "x1", "by1": "y1"})


NORM = "ni AS (SELECT item_id, k, scene_id, label, quadrant, bx0 AS x0, by0 AS y0, bx1 AS x1, by1 AS y1 FROM items)"


@query("bbox_iou", oracle(["items"], f"SELECT a.item_id, {iou_sql()} AS iou, {iou_sql(1)} AS iou_floored FROM ni AS a JOIN ni AS b ON a.scene_id = b.scene_id AND b.k = a.k + 4", NORM))
def bbox_iou(spark, sf):
    it = norm_items(spark, sf)
    a, b = it.alias("a"), it.withColumn("k", F.col("k") - 4).alias("b")
    j = a.join(b, (F.col("a.scene_id") == F.col("b.scene_id")) & (F.col("a.k") == F.col("b.k")))
    ba, bb = bx.box("a."), bx.box("b.")
    return j.select("a.item_id", bx.iou(ba, bb).alias("iou"), bx.iou(ba, bb, 1).alias("iou_floored"))


def fold_sql(keys, order, limit, least, source):
    """Greedy walk as a recursive statement."""
    i = "(greatest(0, least(o.x1, b.x1) - greatest(o.x0, b.x0)) * greatest(0, least(o.y1, b.y1) - greatest(o.y0, b.y0)))"
    a, b = area_sql("o", least), area_sql("b", least)
    hit = f"list_filter(f.kept, lambda b: CASE WHEN {a} + {b} - {i} > 0 THEN CAST({i} AS DOUBLE) / ({a} + {b} - {i}) ELSE 0e0 END >= {limit}e0)"
    st = "struct_pack(id := o.item_id, x0 := o.x0, y0 := o.y0, x1 := o.x1, y1 := o.y1)"
    return (f"o AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM {source}), "
            f"f AS (SELECT {', '.join('o.' + c for c in keys.split(', '))}, n, item_id, CAST(NULL AS BIGINT) AS clash, [{st}] AS kept FROM o WHERE n = 1 UNION ALL "
            f"SELECT {', '.join('o.' + c for c in keys.split(', '))}, o.n, o.item_id, {hit}[1].id, CASE WHEN len({hit}) = 0 THEN list_append(f.kept, {st}) ELSE f.kept END "
            f"FROM f JOIN o ON {' AND '.join(f'f.{c} = o.{c}' for c in keys.split(', '))} AND o.n = f.n + 1)")


def recursive(sql):
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("nms_any_label", recursive(oracle(["items"], "SELECT item_id, clash, clash IS NULL AS kept FROM f", NORM + ", " + fold_sql("scene_id", "-((x1 - x0) * (y1 - y0)), item_id", 0.5, 1, "ni"))))
def nms_any_label(spark, sf):
    return dd.nms_any_label(norm_items(spark, sf), S, "item_id").select("item_id", "clash", "kept")


CANON = "CASE " + " ".join(
    f"WHEN regexp_matches(lo, '\\b{w}\\b') THEN trim(concat(trim(regexp_extract(lo, '^(.*?)\\b{w}\\b', 1)), ' {name}'))"
    for name, words in lb.SYNONYMS for w in words) + " ELSE lo END"
CANON_CTE = f"ca AS (SELECT *, {CANON} AS canonical FROM (SELECT *, trim(lower(label)) AS lo FROM ni) AS q)"


@query("nms_same_label", recursive(oracle(["items"], "SELECT item_id, clash, clash IS NULL AS kept FROM f", NORM + ", " + CANON_CTE + ", " + fold_sql("scene_id, canonical", "item_id", 0.9, None, "ca"))))
def nms_same_label(spark, sf):
    it = norm_items(spark, sf).withColumn("canonical", lb.canonical(F.col("label")))
    return dd.nms_same_label(it, S, "item_id").select("item_id", "clash", "kept")


_SING = ", ".join(f"'{x}'" for x in lb.SINGULAR)
SING_CTE = NORM + ", " + CANON_CTE + f""", si AS (SELECT *, (x1 - x0) * (y1 - y0) AS area, canonical IN ({_SING}) OR array_to_string(list_slice(string_split(canonical, ' '), -2, -1), ' ') IN ({_SING})
  OR string_split(canonical, ' ')[-1] IN ({_SING}) AS single FROM ca), sr AS (SELECT *, row_number() OVER (PARTITION BY scene_id, canonical ORDER BY area DESC, item_id) AS r,
  first_value(item_id) OVER (PARTITION BY scene_id, canonical ORDER BY area DESC, item_id) AS kept_ord FROM si)"""


@query("singular_items", oracle(["items"], "SELECT item_id, NOT (single AND r > 1) AS kept, CASE WHEN single AND r > 1 THEN kept_ord END AS kept_ord FROM sr", SING_CTE))
def singular_items(spark, sf):
    it = norm_items(spark, sf).withColumns({"canonical": lb.canonical(F.col("label")), "area": bx.area(bx.box())})
    keep, gone = inv.singular_items(it, S, F.col("item_id"))
    a = keep.select("item_id", F.lit(True).alias("kept"), F.lit(None).cast("bigint").alias("kept_ord"))
    return a.unionByName(gone.select("item_id", F.lit(False).alias("kept"), "kept_ord"))
