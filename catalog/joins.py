"""Queries on hulls, votes, subtraction, hierarchy and lookups."""

from pyspark.sql import functions as F

from motefield import constants as k
from motefield.functions import boxes as bx
from motefield.functions import geometry as g
from motefield.functions import labels as lb
from motefield.functions import rooms as rm
from motefield.operators import filters as fl
from motefield.operators import frames as fr
from motefield.operators import hierarchy as hi
from motefield.operators import hulls as hl
from motefield.operators import inventory as inv
from motefield.operators import masks as mk
from motefield.operators import selection as sel
from motefield.operators import spatial as sp
from motefield.operators import votes as vo

from .cleaning import OBJ, RUG_CTE, _S2, rug
from .fixtures import mean, oracle, pct, table
from .registry import query
from .rows import H, ID, KEY, PX_CTE, QUAD_CTE, W, pad_cte, pixel_items, proj, splats

S = ["scene_id"]


def views(spark, sf):
    return table(spark, sf, "views")


def padded(spark, sf, share):
    it = pixel_items(spark, sf)
    return it.withColumns(bx.as_columns(bx.pad(bx.box(), share, F.lit(W), F.lit(H))))


def view0(spark, sf):
    return views(spark, sf).where("view_id = 0")


FLT = proj("cam", "flt")
_IN = "front AND u >= x0 AND u <= x1 AND v >= y0 AND v <= y1"
_S_ID = "s.ok, s.pk, s.sk, s.ln"


def hull_sql(share):
    return (f"SELECT {_S_ID}, item_id FROM flt AS s JOIN pd ON s.scene_id = pd.scene_id WHERE view_id = 0 AND {_IN}",
            PX_CTE + ", " + pad_cte("pd", share) + ", " + FLT)


@query("visual_hull", oracle(["splats", "views", "items"], *hull_sql(0.04)))
def visual_hull(spark, sf):
    return hl.visual_hull(splats(spark, sf), view0(spark, sf), padded(spark, sf, k.HULL_PAD), S).select(*KEY, "item_id")


@query("wide_hull", oracle(["splats", "views", "items"], *hull_sql(0.10)))
def wide_hull(spark, sf):
    return hl.visual_hull(splats(spark, sf), view0(spark, sf), padded(spark, sf, k.WIDE_HULL_PAD), S).select(*KEY, "item_id")


def quad_views(spark, sf):
    """The camera of each quadrant: the first four views."""
    return views(spark, sf).where("view_id < 4").withColumn(
        "quadrant", F.element_at(F.array(*[F.lit(q) for q in ("NE", "NW", "SE", "SW")]), F.col("view_id") + 1))


_QV = "qv AS (SELECT *, CASE view_id WHEN 0 THEN 'NE' WHEN 1 THEN 'NW' WHEN 2 THEN 'SE' ELSE 'SW' END AS quadrant FROM flt WHERE view_id < 4)"


@query("visual_hull_quadrant", oracle(["splats", "views", "items"], f"""SELECT {_S_ID}, item_id FROM qv AS s
  JOIN pd ON s.scene_id = pd.scene_id AND s.quadrant = pd.quadrant
  JOIN quad AS q ON q.ok = s.ok AND q.pk = s.pk AND q.sk = s.sk AND q.ln = s.ln AND q.quadrant = s.quadrant WHERE {_IN}""",
       ", ".join([PX_CTE, pad_cte("pd", 0.04), FLT, _QV, QUAD_CTE])))
def visual_hull_quadrant(spark, sf):
    s = splats(spark, sf)
    q = fr.with_quadrants(s, fr.room_bounds(s, S))
    return hl.visual_hull(q, quad_views(spark, sf), padded(spark, sf, k.HULL_PAD), ["scene_id", "quadrant"]).select(*KEY, "item_id")


def art(spark, sf, share, pts=None, boxes=None):
    pts = hl.seen(splats(spark, sf) if pts is None else pts, quad_views(spark, sf).drop("view_id"), S)
    return hl.in_boxes(pts, padded(spark, sf, share) if boxes is None else boxes, ["scene_id", "quadrant"], ["item_id"])


def art_voted(spark, sf):
    """Rows of the art hull with enough votes."""
    s = splats(spark, sf).select(*KEY, "scene_id", "x", "y", "z")
    vb = item_boxes(spark, sf, lambda b: bx.pad(b, k.ART_VIEW_PAD, F.lit(W), F.lit(H)))
    hull = art(spark, sf, k.ART_PAD, vo.with_pixels(s, vb, S, in_image=False))
    return vo.keep_art_votes(vo.hull_box_votes(hull, s, vb, S, "item_id", KEY))


_ART = ", ".join([PX_CTE, pad_cte("pd", 0.06), FLT, _QV,
                  f"art AS (SELECT {_S_ID}, item_id FROM qv AS s JOIN pd ON s.scene_id = pd.scene_id AND s.quadrant = pd.quadrant WHERE {_IN})"])


@query("art_hull", oracle(["splats", "views", "items"], f"SELECT {ID}, item_id FROM art", _ART))
def art_hull(spark, sf):
    return art(spark, sf, k.ART_PAD).select(*KEY, "item_id")


@query("companion_hull", oracle(["splats", "views", "items"], f"SELECT {ID}, item_id FROM art JOIN (SELECT item_id FROM art GROUP BY item_id HAVING count(*) >= 100) USING (item_id)", _ART))
def companion_hull(spark, sf):
    """Rows are counted per item and then taken again for the items that stay; the whole hull is never written."""
    from motefield.staging import staged_small
    n = art(spark, sf, k.COMPANION_PAD).groupBy("item_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= k.MIN_COMPANION_SPLATS)
    kept = padded(spark, sf, k.COMPANION_PAD).join(staged_small(n.select("item_id")), "item_id", "left_semi")
    return art(spark, sf, k.COMPANION_PAD, boxes=kept).select("item_id", *KEY)


@query("hull_subtract", oracle(["splats", "views", "items"], f"""SELECT {_S_ID} FROM flt AS s WHERE view_id = 0 AND NOT EXISTS (
  SELECT 1 FROM px WHERE px.scene_id = s.scene_id AND {_IN})""", PX_CTE + ", " + FLT))
def hull_subtract(spark, sf):
    return hl.hull_subtract(splats(spark, sf), view0(spark, sf), pixel_items(spark, sf), S).select(*KEY)


@query("hull_subtract_hits", oracle(["splats", "views", "items"], f"""SELECT px.scene_id, item_id, count(s.ok) AS n_hit FROM px
  LEFT JOIN (SELECT * FROM flt WHERE view_id = 0) AS s ON s.scene_id = px.scene_id AND {_IN} GROUP BY px.scene_id, item_id""", PX_CTE + ", " + FLT))
def hull_subtract_hits(spark, sf):
    return hl.hull_counts(splats(spark, sf), view0(spark, sf), pixel_items(spark, sf), S)


# --- votes -----------------------------------------------------------------

IDX = proj("cam", "idx0", "idx")
VOTE_CTE = IDX + f""", vt AS (SELECT {ID}, scene_id, object_id, count(*) FILTER (WHERE in_img) AS visible,
  count(*) FILTER (WHERE in_img AND EXISTS (SELECT 1 FROM mask_runs AS m WHERE m.scene_id = idx.scene_id AND m.view_id = idx.view_id
    AND m.y = idx.yi AND idx.xi BETWEEN m.x0 AND m.x1)) AS votes FROM idx GROUP BY {ID}, scene_id, object_id)"""


def runs(spark, sf):
    return table(spark, sf, "mask_runs")


def voted(spark, sf, rule="index"):
    index = vo.mask_index(runs(spark, sf), ["scene_id", "view_id"])
    mv = vo.masked_views(views(spark, sf), index, S)
    return vo.mask_votes(splats(spark, sf), mv, index, S, KEY, rule), vo.view_counts(mv, S)


@query("mask_vote", oracle(["splats", "views", "mask_runs"], f"SELECT {ID}, votes, visible FROM vt WHERE votes >= 5 AND visible >= 5", VOTE_CTE))
def mask_vote(spark, sf):
    v, n = voted(spark, sf)
    return vo.keep_mask_votes(v, n, S, k.WIDE_VOTE_FRAC).select(*KEY, "votes", "visible")


_RND = proj("cam", "flt", "rnd0", "rnd") + f""", tv AS (SELECT {ID},
  count(*) FILTER (WHERE in_img AND EXISTS (SELECT 1 FROM mask_runs AS m WHERE m.scene_id = rnd.scene_id AND m.view_id = rnd.view_id
    AND m.y = rnd.yi AND rnd.xi BETWEEN m.x0 AND m.x1)) AS votes FROM rnd GROUP BY {ID})"""


@query("tv_vote", oracle(["splats", "views", "mask_runs"], f"SELECT {ID}, votes FROM tv WHERE votes >= 4", _RND))
def tv_vote(spark, sf):
    v, n = voted(spark, sf, "round")
    return vo.keep_mask_votes(v, n, S, k.TV_VOTE_FRAC, need_visible=False).select(*KEY, "votes")


@query("child_vote", oracle(["splats", "views", "mask_runs"], f"""SELECT {ID}, prompt_id, votes, visible FROM (
  SELECT {_S_ID.replace('s.', 'i.')}, p.prompt_id, p.n, count(*) FILTER (WHERE in_img) AS visible,
    count(*) FILTER (WHERE in_img AND EXISTS (SELECT 1 FROM mask_runs AS m WHERE m.scene_id = i.scene_id AND m.view_id = i.view_id
      AND m.prompt_id = p.prompt_id AND m.y = i.yi AND i.xi BETWEEN m.x0 AND m.x1)) AS votes
  FROM idx AS i JOIN (SELECT scene_id, prompt_id, view_id, count(*) OVER (PARTITION BY scene_id, prompt_id) AS n
    FROM (SELECT DISTINCT scene_id, prompt_id, view_id FROM mask_runs) AS d) AS p ON i.scene_id = p.scene_id AND i.view_id = p.view_id
  GROUP BY {_S_ID.replace('s.', 'i.')}, p.prompt_id, p.n) AS q WHERE votes >= ceil(0.5e0 * n) AND visible >= ceil(0.5e0 * n)""", IDX))
def child_vote(spark, sf):
    index = vo.mask_index(runs(spark, sf), ["scene_id", "view_id", "prompt_id"])
    mv = vo.masked_views(views(spark, sf), index, S, ["prompt_id"])
    v = vo.mask_votes(splats(spark, sf), mv, index, S, KEY, extra=["prompt_id"], zeros=False)     # at least one vote is needed
    out = vo.keep_mask_votes(v, vo.view_counts(mv, ["scene_id", "prompt_id"]), ["scene_id", "prompt_id"], k.CHILD_VOTE_FRAC)
    return out.select(*KEY, "prompt_id", "votes", "visible")


def item_boxes(spark, sf, pad):
    """Each item's box in its views, widened and padded."""
    it = pixel_items(spark, sf).join(table(spark, sf, "item_views").select("item_id", "view_id"), "item_id")
    wide = {"x0": F.floor(F.col("x0") / 3).cast("int"), "y0": F.floor(F.col("y0") / 3).cast("int"), "x1": F.col("x1") + 20, "y1": F.col("y1") + 10}
    it = it.withColumns(wide).select("scene_id", "item_id", "view_id", "x0", "y0", "x1", "y1")
    return views(spark, sf).join(it.withColumns(bx.as_columns(pad(bx.box()))), ["scene_id", "view_id"])


def item_box_cte(pad):
    """Boxes per item and view as ``vb``, with the number of views of the item."""
    return f"""vb0 AS (SELECT px.scene_id, px.item_id, view_id, CAST(floor(x0 / 3) AS INTEGER) AS x0, CAST(floor(y0 / 3) AS INTEGER) AS y0, x1 + 20 AS x1, y1 + 10 AS y1
    FROM px JOIN (SELECT item_id, view_id FROM item_views) AS iv USING (item_id)),
  vb AS (SELECT item_id, view_id, count(*) OVER (PARTITION BY item_id) AS n, {pad} FROM vb0)"""


from .rows import pad_sql  # noqa: E402

_VOTE_USES = ["splats", "views", "items", "item_views"]
_OWN = "SELECT h.ok, h.pk, h.sk, h.ln, h.item_id, n, s.* EXCLUDE (ok, pk, sk, ln), x0, y0, x1, y1 FROM hl AS h JOIN flt AS s USING (ok, pk, sk, ln) JOIN vb ON vb.item_id = h.item_id AND vb.view_id = s.view_id"


@query("bbox_vote", oracle(_VOTE_USES, f"SELECT {ID}, item_id, votes, visible FROM (SELECT {ID}, item_id, n, count(*) FILTER (WHERE seen) AS visible, "
       f"count(*) FILTER (WHERE seen AND u >= x0 AND u <= x1 AND v >= y0 AND v <= y1) AS votes FROM (SELECT *, "
       f"front AND u >= 0 AND u < w AND v >= 0 AND v < h AS seen FROM ({_OWN}) AS o) AS a GROUP BY {ID}, item_id, n) AS b "
       f"WHERE votes >= ceil(0.6e0 * n) AND visible >= ceil(0.6e0 * n)",
       ", ".join([PX_CTE, pad_cte("pd", 0.04), item_box_cte(pad_sql("(x1 - x0) * 0.05e0", "(y1 - y0) * 0.05e0", "(y1 - y0) * 0.12e0")), FLT,
                  f"hl AS (SELECT {_S_ID}, item_id FROM flt AS s JOIN pd ON s.scene_id = pd.scene_id WHERE view_id = 0 AND {_IN})"])))
def bbox_vote(spark, sf):
    """Every item's hull, judged by the item's own boxes."""
    s = splats(spark, sf).select(*KEY, "scene_id", "x", "y", "z")
    vb = item_boxes(spark, sf, lambda b: bx.pad_with_top(b, k.BOX_VOTE_PAD, k.BOX_VOTE_TOP, F.lit(W), F.lit(H)))
    hull = hl.visual_hull(vo.with_pixels(s, vb, S), view0(spark, sf), padded(spark, sf, k.HULL_PAD), S)
    return vo.keep_box_votes(vo.hull_box_votes(hull, s, vb, S, "item_id", KEY)).select(*KEY, "item_id", "votes", "visible")


@query("art_bbox_vote", oracle(_VOTE_USES, f"SELECT {ID}, item_id, votes FROM (SELECT {ID}, item_id, n, count(*) FILTER (WHERE {_IN}) AS votes FROM ({_OWN}) AS a GROUP BY {ID}, item_id, n) AS b "
       f"WHERE votes >= greatest(1, ceil(0.5e0 * n))", ", ".join([_ART, item_box_cte(pad_sql("(x1 - x0) * 0.03e0", "(y1 - y0) * 0.03e0")), "hl AS (SELECT * FROM art)"])))
def art_bbox_vote(spark, sf):
    return art_voted(spark, sf).select(*KEY, "item_id", "votes")


_SCORE = VOTE_CTE + ", sc AS (SELECT *, CASE WHEN visible > 0 THEN CAST(votes AS DOUBLE) / visible ELSE 0.5e0 END AS insideness FROM vt)"


def scored(spark, sf):
    from motefield.staging import stage
    v, _ = voted(spark, sf)
    return stage(vo.insideness(v).join(splats(spark, sf).select(*KEY, "object_id"), KEY))


@query("insideness", oracle(["splats", "views", "mask_runs"], f"SELECT {ID}, insideness FROM sc", _SCORE))
def insideness(spark, sf):
    v, _ = voted(spark, sf)
    return vo.insideness(v).select(*KEY, "insideness")


@query("insideness_hist", oracle(["splats", "views", "mask_runs"], """SELECT scene_id, object_id, count(*) FILTER (WHERE insideness < 0.3e0) AS n_low,
  count(*) FILTER (WHERE insideness >= 0.3e0 AND insideness <= 0.7e0) AS n_mid, count(*) FILTER (WHERE insideness > 0.7e0) AS n_high
  FROM sc GROUP BY scene_id, object_id""", _SCORE))
def insideness_hist(spark, sf):
    return vo.insideness_hist(scored(spark, sf), OBJ)


@query("vote_required", oracle(["items"], """SELECT item_id, CAST(ceil(CASE WHEN p >= 3 THEN greatest(0.4e0, 0.7e0 - 0.1e0 * (p - 2)) ELSE 0.7e0 END * n) AS BIGINT) AS required
  FROM (SELECT item_id, k % 6 + 1 AS p, k % 25 + 1 AS n FROM items) AS q"""))
def vote_required(spark, sf):
    it = table(spark, sf, "items")
    return it.select("item_id", vo.required_votes(F.col("k") % 25 + 1, k.TIGHT_VOTE_FRAC, F.col("k") % 6 + 1).alias("required"))


# --- subtraction -----------------------------------------------------------

def stage_splats(spark, sf):
    return table(spark, sf, "stage_splats")


_SUB = ", ".join(f"'{s}'" for s in k.SUBTRACT_STAGES)


@query("background_subtract", oracle(["splats", "stage_splats"], f"""SELECT {ID} FROM splats AS s WHERE NOT EXISTS (SELECT 1 FROM stage_splats AS t
  WHERE t.stage IN ({_SUB}) AND t.scene_id = s.scene_id AND t.x = s.x AND t.y = s.y AND t.z = s.z)"""))
def background_subtract(spark, sf):
    used = stage_splats(spark, sf).where(F.col("stage").isin(k.SUBTRACT_STAGES))
    return sp.exact_anti(splats(spark, sf), used, S).select(*KEY)


_RAD = 1e-5


@query("background_subtract_radius", oracle(["splats", "stage_splats"], f"""SELECT {ID} FROM splats AS s WHERE NOT EXISTS (SELECT 1 FROM (
  SELECT DISTINCT scene_id, x, y, z, CAST(floor(x / 0.5e0) AS BIGINT) + dx AS cx FROM stage_splats CROSS JOIN (VALUES (-1), (0), (1)) AS n(dx) WHERE stage IN ({_SUB})) AS t
  WHERE t.scene_id = s.scene_id AND t.cx = CAST(floor(s.x / 0.5e0) AS BIGINT)
    AND (t.x - s.x) * (t.x - s.x) + (t.y - s.y) * (t.y - s.y) + (t.z - s.z) * (t.z - s.z) < {_RAD!r} * {_RAD!r})"""))
def background_subtract_radius(spark, sf):
    used = stage_splats(spark, sf).where(F.col("stage").isin(k.SUBTRACT_STAGES))
    return sp.radius_anti(splats(spark, sf), used, S, KEY, _RAD, wide=8).select(*KEY)


@query("match_report", oracle(["splats", "stage_splats"], f"""SELECT t.scene_id, t.object_id, count(*) AS n_obj_splats, count(p.x) AS n_matched,
  round(100.0e0 * count(p.x) / greatest(count(*), 1), 1) AS match_pct, count(DISTINCT stage) AS n_stages
  FROM stage_splats AS t LEFT JOIN (SELECT DISTINCT scene_id, x, y, z FROM splats WHERE {_S2}) AS p
  ON t.scene_id = p.scene_id AND t.x = p.x AND t.y = p.y AND t.z = p.z WHERE t.stage IN ({_SUB}) GROUP BY t.scene_id, t.object_id"""))
def match_report(spark, sf):
    used = stage_splats(spark, sf).where(F.col("stage").isin(k.SUBTRACT_STAGES))
    return inv.match_report(inv.match_flags(used, fl.max_scale_filter(splats(spark, sf)), S), OBJ, "matched")


def latest(spark, sf, order):
    """Splats of the first stage of an order that each object has."""
    from motefield.staging import staged_small
    best = sel.stage_resolve(table(spark, sf, "stages"), OBJ, order)
    return stage_splats(spark, sf).join(staged_small(best), [*OBJ, "stage"], "left_semi")


def rank_sql(order):
    return "CASE stage " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(order, 1)) + " END"


def resolve_cte(name, order, source="stages"):
    inside = ", ".join(f"'{s}'" for s in order)
    return (f"{name} AS (SELECT scene_id, object_id, min_by(stage, {rank_sql(order)}) AS stage FROM {source} "
            f"WHERE stage IN ({inside}) GROUP BY scene_id, object_id)")


SIB_CTE = RUG_CTE + ", " + resolve_cte("lt", k.RUG_SIBLING_STAGES) + f""",
  sib AS (SELECT s.* FROM stage_splats AS s JOIN lt USING (scene_id, object_id, stage)),
  mid AS (SELECT scene_id, object_id, {mean('x')} AS mx, {mean('z')} AS mz
    FROM sib GROUP BY scene_id, object_id),
  area AS (SELECT scene_id, item_id, min(x) AS xl, max(x) AS xh, min(z) AS zl, max(z) AS zh FROM rug GROUP BY scene_id, item_id),
  onrug AS (SELECT scene_id, item_id, object_id FROM mid JOIN area USING (scene_id) WHERE mx BETWEEN xl AND xh AND mz BETWEEN zl AND zh),
  near AS (SELECT scene_id, onrug.item_id, x, y, z FROM sib JOIN onrug USING (scene_id, object_id)),
  rugonly AS (SELECT * FROM rug AS r WHERE NOT EXISTS (SELECT 1 FROM near AS n WHERE n.scene_id = r.scene_id AND n.item_id = r.item_id
    AND (n.x - r.x) * (n.x - r.x) + (n.y - r.y) * (n.y - r.y) + (n.z - r.z) * (n.z - r.z) < 0.05e0 * 0.05e0))"""


def rug_alone(spark, sf):
    from motefield.staging import stage
    return sp.sibling_subtract(stage(rug(spark, sf)), latest(spark, sf, k.RUG_SIBLING_STAGES), S, "object_id", KEY, k.SIBLING_RADIUS_M, ["item_id"])


@query("sibling_subtract", oracle(["splats", "views", "items", "stage_splats"], f"SELECT {ID}, item_id FROM rugonly", SIB_CTE))
def sibling_subtract(spark, sf):
    return rug_alone(spark, sf).select(*KEY, "item_id")


KNN_CTE = """kp AS (SELECT scene_id, object_id, ok, pk, sk, ln, x, y, z FROM splats),
  kd AS (SELECT a.ok, a.pk, a.sk, a.ln, min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), 8) AS d
    FROM kp AS a JOIN kp AS b ON a.scene_id = b.scene_id AND a.object_id = b.object_id
      AND NOT (a.ok = b.ok AND a.pk = b.pk AND a.sk = b.sk AND a.ln = b.ln) GROUP BY a.ok, a.pk, a.sk, a.ln),
  kn AS (SELECT ok, pk, sk, ln, (((((((sqrt(d[1]) + sqrt(d[2])) + sqrt(d[3])) + sqrt(d[4])) + sqrt(d[5])) + sqrt(d[6])) + sqrt(d[7])) + sqrt(d[8])) / 8.0e0 AS isolation FROM kd)"""


@query("knn_isolation", oracle(["splats"], f"SELECT {ID}, round(isolation, 9) AS isolation FROM kn", KNN_CTE))
def knn_isolation(spark, sf):
    return sp.knn_isolation(splats(spark, sf), OBJ, KEY).select(*KEY, F.round("isolation", 9).alias("isolation"))


from .cleaning import MAXS, aniso_sql, lg  # noqa: E402


@query("destreak_geometry", oracle(["splats"], f"""SELECT {ID} FROM kj JOIN ki USING (scene_id, object_id) WHERE NOT (y >= hi - 0.25e0 * (hi - lo)
  AND {MAXS} > {lg(0.07)} AND {aniso_sql(4.0, 1e-6)} AND isolation > iso)""", KNN_CTE + """,
  kj AS MATERIALIZED (SELECT s.*, isolation, min(y) OVER (PARTITION BY scene_id, object_id) AS lo, max(y) OVER (PARTITION BY scene_id, object_id) AS hi
    FROM splats AS s JOIN kn USING (ok, pk, sk, ln)), """ + pct("ki", "kj", "scene_id, object_id", [("iso", "isolation", 90.0)])))
def destreak_geometry(spark, sf):
    return fl.destreak_geometry(splats(spark, sf), OBJ, KEY).select(*KEY)


# --- hierarchy -------------------------------------------------------------

BOX_CTE = pct("rb5", "splats", "scene_id, object_id", [(f"{a}_{n}", a, p) for a in "xyz" for n, p in (("min", 5.0), ("max", 95.0))]) + """,
  boxes AS (SELECT *, (x_max - x_min) * (y_max - y_min) * (z_max - z_min) AS volume FROM rb5)"""


def parts(spark, sf):
    """Splats grouped by part and stacked in six flat layers, so that a scene has many objects."""
    return splats(spark, sf).withColumn("y", F.col("y") / 10 - (F.col("pk") % 6) * 0.12)


def part_boxes(spark, sf):
    return fr.robust_aabb(parts(spark, sf), ["scene_id", "pk"])


PART_CTE = "parts AS (SELECT * REPLACE (y / 10 - (pk % 6) * 0.12e0 AS y) FROM splats), " + pct("pb5", "parts", "scene_id, pk", [(f"{a}_{n}", a, p) for a in "xyz" for n, p in (("min", 5.0), ("max", 95.0))]) + """,
  pboxes AS (SELECT *, (x_max - x_min) * (y_max - y_min) * (z_max - z_min) AS volume FROM pb5),
  plinks AS (SELECT scene_id, child, parent FROM (SELECT c.scene_id, c.pk AS child, p.pk AS parent,
    row_number() OVER (PARTITION BY c.scene_id, c.pk ORDER BY p.volume, p.pk) AS r FROM pboxes AS c JOIN pboxes AS p ON c.scene_id = p.scene_id
    WHERE p.volume > c.volume AND p.x_min - 0.15e0 <= c.x_min AND p.x_max + 0.15e0 >= c.x_max AND p.z_min - 0.15e0 <= c.z_min AND p.z_max + 0.15e0 >= c.z_max
    AND (abs(c.y_min - p.y_max) <= 0.10e0 OR abs(c.y_max - p.y_min) <= 0.10e0)) AS q WHERE r = 1)"""


def part_links(spark, sf, boxes=None):
    from motefield.staging import stage
    return stage(hi.parent_child(part_boxes(spark, sf) if boxes is None else boxes, S, "pk"))


@query("parent_child", oracle(["splats"], "SELECT scene_id, child, parent FROM plinks", PART_CTE))
def parent_child(spark, sf):
    return part_links(spark, sf)


@query("smallest_parent", oracle(["splats"], "SELECT scene_id, grp, child, parent FROM glinks", PART_CTE + """,
  gboxes AS (SELECT *, pk % 3 AS grp FROM pboxes),
  glinks AS (SELECT scene_id, grp, child, parent FROM (SELECT c.scene_id, c.grp, c.pk AS child, p.pk AS parent,
    row_number() OVER (PARTITION BY c.scene_id, c.grp, c.pk ORDER BY p.volume, p.pk) AS r FROM gboxes AS c JOIN gboxes AS p ON c.scene_id = p.scene_id AND c.grp = p.grp
    WHERE p.volume > c.volume AND p.x_min - 0.15e0 <= c.x_min AND p.x_max + 0.15e0 >= c.x_max AND p.z_min - 0.15e0 <= c.z_min AND p.z_max + 0.15e0 >= c.z_max
    AND (abs(c.y_min - p.y_max) <= 0.10e0 OR abs(c.y_max - p.y_min) <= 0.10e0)) AS q WHERE r = 1)"""))
def smallest_parent(spark, sf):
    """The smallest parent within a third of each scene's parts, whose layers touch each other."""
    return hi.parent_child(part_boxes(spark, sf).withColumn("grp", F.col("pk") % 3), ["scene_id", "grp"], "pk")


@query("attach_parent", oracle(["splats"], "SELECT b.scene_id, b.pk, volume, parent FROM pboxes AS b LEFT JOIN plinks AS l ON b.scene_id = l.scene_id AND b.pk = l.child", PART_CTE))
def attach_parent(spark, sf):
    boxes = part_boxes(spark, sf)
    return hi.attach_parent(boxes.select("scene_id", "pk", "volume"), part_links(spark, sf, boxes), S, "pk")


@query("children_sorted", oracle(["splats"], """SELECT scene_id, parent, child, row_number() OVER (PARTITION BY scene_id, parent ORDER BY child) AS position FROM plinks""", PART_CTE))
def children_sorted(spark, sf):
    from motefield.operators.ranking import grouped_row_number
    return grouped_row_number(part_links(spark, sf), ["scene_id", "parent"], "child", "position").select("scene_id", "parent", "child", "position")


_TIGHT = pct("tb2", "parts", "scene_id, pk", [(f"{a}_{n}", a, p) for a in "xyz" for n, p in (("l", 2.0), ("h", 98.0))])
_HITS = PART_CTE + ", " + _TIGHT + f""", hits AS (SELECT {_S_ID}, s.scene_id, s.pk AS parent, l.child FROM parts AS s
  JOIN plinks AS l ON s.scene_id = l.scene_id AND s.pk = l.parent JOIN tb2 AS t ON t.scene_id = s.scene_id AND t.pk = l.child
  WHERE x >= x_l - 0.02e0 AND x <= x_h + 0.02e0 AND y >= y_l - 0.02e0 AND y <= y_h + 0.02e0 AND z >= z_l - 0.02e0 AND z <= z_h + 0.02e0)"""


def _child_subtract(spark, sf):
    s = parts(spark, sf)
    return hi.child_aabb_subtract(s, fr.tight_aabb(s, ["scene_id", "pk"]), part_links(spark, sf), S, "pk", ["ok", "sk", "ln"])


@query("child_aabb_subtract", oracle(["splats"], f"""SELECT {_S_ID} FROM splats AS s WHERE EXISTS (SELECT 1 FROM plinks AS l WHERE l.scene_id = s.scene_id AND l.parent = s.pk)
  AND NOT EXISTS (SELECT 1 FROM hits AS h WHERE h.ok = s.ok AND h.pk = s.pk AND h.sk = s.sk AND h.ln = s.ln)""", _HITS))
def child_aabb_subtract(spark, sf):
    return _child_subtract(spark, sf)[0].select(*KEY)


@query("child_aabb_hits", oracle(["splats"], "SELECT scene_id, parent AS pk, child, count(*) AS n_hit FROM hits GROUP BY scene_id, parent, child", _HITS))
def child_aabb_hits(spark, sf):
    return _child_subtract(spark, sf)[1]


@query("inside_neighbours", oracle(["items"], """SELECT t.scene_id, t.item_id AS target_id, n.item_id AS neighbour_id,
  CAST(greatest(0, least(n.x1, t.x1) - greatest(n.x0, t.x0)) * greatest(0, least(n.y1, t.y1) - greatest(n.y0, t.y0)) AS DOUBLE)
    / (greatest(0, n.x1 - n.x0) * greatest(0, n.y1 - n.y0)) AS inside_ratio
  FROM pd AS t JOIN px AS n ON t.scene_id = n.scene_id AND t.item_id <> n.item_id WHERE n.x1 > n.x0 AND n.y1 > n.y0
  AND CAST(greatest(0, least(n.x1, t.x1) - greatest(n.x0, t.x0)) * greatest(0, least(n.y1, t.y1) - greatest(n.y0, t.y0)) AS DOUBLE)
    / (greatest(0, n.x1 - n.x0) * greatest(0, n.y1 - n.y0)) > 0.25e0""", PX_CTE + ", " + pad_cte("pd", 0.04)))
def inside_neighbours(spark, sf):
    out = hl.inside_neighbours(pixel_items(spark, sf), S, "item_id", k.HULL_PAD, W, H, k.NEIGHBOUR_OVERLAP)
    return out.select("scene_id", "target_id", "neighbour_id", "inside_ratio")


_NB = PX_CTE + ", " + pad_cte("pd", 0.04) + ", " + FLT + f""", hull AS (SELECT {_S_ID}, s.scene_id, u, v, item_id AS target_id FROM flt AS s JOIN pd ON s.scene_id = pd.scene_id WHERE view_id = 0 AND {_IN}),
  nb AS (SELECT t.scene_id, t.item_id AS target_id, CAST(trunc(n.x0 - (n.x1 - n.x0) * 0.01e0) AS INTEGER) AS x0, CAST(trunc(n.y0 - (n.y1 - n.y0) * 0.01e0) AS INTEGER) AS y0,
    CAST(trunc(n.x1 + (n.x1 - n.x0) * 0.01e0) AS INTEGER) AS x1, CAST(trunc(n.y1 + (n.y1 - n.y0) * 0.01e0) AS INTEGER) AS y1
    FROM pd AS t JOIN px AS n ON t.scene_id = n.scene_id AND t.item_id <> n.item_id WHERE n.x1 > n.x0 AND n.y1 > n.y0
    AND CAST(greatest(0, least(n.x1, t.x1) - greatest(n.x0, t.x0)) * greatest(0, least(n.y1, t.y1) - greatest(n.y0, t.y0)) AS DOUBLE)
    / (greatest(0, n.x1 - n.x0) * greatest(0, n.y1 - n.y0)) > 0.25e0)"""


@query("neighbour_carve", oracle(["splats", "views", "items"], f"""SELECT {ID}, target_id FROM hull AS a WHERE NOT EXISTS (SELECT 1 FROM nb
  WHERE nb.scene_id = a.scene_id AND nb.target_id = a.target_id AND u >= x0 AND u <= x1 AND v >= y0 AND v <= y1)""", _NB))
def neighbour_carve(spark, sf):
    """Neighbours are cut out of the boxes, so that hull rows never move."""
    pairs = hl.inside_neighbours(pixel_items(spark, sf), S, "item_id", k.HULL_PAD, W, H, k.NEIGHBOUR_OVERLAP)
    boxes = pairs.withColumns(bx.as_columns(bx.pad_free(bx.box(), k.NEIGHBOUR_PAD)))
    tgt = padded(spark, sf, k.HULL_PAD).withColumnRenamed("item_id", "target_id")
    free = hl.free_boxes(tgt, boxes, S, "target_id")
    return hl.in_boxes(hl.seen(splats(spark, sf), view0(spark, sf), S), free, S, ["target_id"]).select(*KEY, "target_id")


# --- stages ----------------------------------------------------------------

@query("stage_resolve", oracle(["stages"], "SELECT scene_id, object_id, stage FROM sr", resolve_cte("sr", k.STAGES)))
def stage_resolve(spark, sf):
    return sel.stage_resolve(table(spark, sf, "stages"), OBJ)


def renders(spark, sf):
    s = table(spark, sf, "stages")
    v = s.withColumn("view", F.explode(F.array(*[F.lit(x) for x in k.CANONICAL_VIEWS])))
    pos = F.array_position(F.array(*[F.lit(x) for x in k.CANONICAL_VIEWS]), F.col("view"))
    return v.where((F.col("object_id") + F.col("rank") * 3 + pos) % 7 != 0)


@query("stage_resolve_rendered", oracle(["stages"], "SELECT scene_id, object_id, stage FROM sr", """rn AS (SELECT s.*, view FROM stages AS s
  CROSS JOIN (VALUES ('y0', 1), ('y90', 2), ('y180', 3), ('y270', 4), ('topdown', 5)) AS v(view, i) WHERE (object_id + rank * 3 + i) % 7 <> 0),
  fu AS (SELECT scene_id, object_id, stage FROM rn GROUP BY scene_id, object_id, stage HAVING count(DISTINCT view) = 5), """ + resolve_cte("sr", k.STAGES, "fu")))
def stage_resolve_rendered(spark, sf):
    return sel.stage_resolve_rendered(renders(spark, sf), OBJ)


@query("stage_resolve_latest", oracle(["stages"], "SELECT 'rug' AS use, * FROM a UNION ALL SELECT 'score', * FROM b UNION ALL SELECT 'group', * FROM c",
       ", ".join([resolve_cte("a", k.RUG_SIBLING_STAGES), resolve_cte("b", k.SCORE_INPUT_STAGES), resolve_cte("c", k.GROUP_STAGES)])))
def stage_resolve_latest(spark, sf):
    st = table(spark, sf, "stages")
    out = None
    for use, order in [("rug", k.RUG_SIBLING_STAGES), ("score", k.SCORE_INPUT_STAGES), ("group", k.GROUP_STAGES)]:
        part = sel.stage_resolve(st, OBJ, order).select(F.lit(use).alias("use"), *OBJ, "stage")
        out = part if out is None else out.unionByName(part)
    return out


# --- walls and lookups -----------------------------------------------------

WALL_CTE = pct("rw", "splats", "scene_id", [(f"r_{a}_{n}", a, p) for a in "xz" for n, p in (("min", 1.0), ("max", 99.0))]) + ", " + pct(
    "hw", "splats", "scene_id, object_id", [(f"h_{a}_{n}", a, p) for a in "xz" for n, p in (("min", 2.0), ("max", 98.0))]) + """,
  wd AS (SELECT scene_id, object_id, d, i, axis, back FROM (SELECT *, row_number() OVER (PARTITION BY scene_id, object_id ORDER BY d, i) AS r FROM (
    SELECT scene_id, object_id, h_x_min - r_x_min AS d, 0 AS i, 'x_min' AS axis, h_x_min AS back FROM hw JOIN rw USING (scene_id)
    UNION ALL SELECT scene_id, object_id, r_x_max - h_x_max, 1, 'x_max', h_x_max FROM hw JOIN rw USING (scene_id)
    UNION ALL SELECT scene_id, object_id, h_z_min - r_z_min, 2, 'z_min', h_z_min FROM hw JOIN rw USING (scene_id)
    UNION ALL SELECT scene_id, object_id, r_z_max - h_z_max, 3, 'z_max', h_z_max FROM hw JOIN rw USING (scene_id)) AS q) AS q2 WHERE r = 1),
  wall AS (SELECT scene_id, object_id, d AS dist, CASE WHEN d <= 2.5e0 THEN axis END AS wall_axis, CASE WHEN d <= 2.5e0 THEN back END AS wall_back FROM wd)"""


@query("wall_proximity", oracle(["splats"], "SELECT * FROM wall", WALL_CTE))
def wall_proximity(spark, sf):
    s = splats(spark, sf)
    return hi.wall_proximity(s, s, S, "object_id")


def verdicts(spark, sf):
    """A wall verdict for two of three objects."""
    return table(spark, sf, "objects").where("(object_id + scene_id) % 3 <> 2").select(
        *OBJ, ((F.col("object_id") + F.col("scene_id")) % 3 == 0).alias("wall_adjacent"))


_VERD = "vd AS (SELECT scene_id, object_id, (object_id + scene_id) % 3 = 0 AS wall_adjacent FROM objects WHERE (object_id + scene_id) % 3 <> 2)"


@query("camera_behind_object", oracle(["splats", "objects", "views"], """SELECT ov.scene_id, ov.object_id, ov.view_id FROM (SELECT o.object_id, v.* FROM objects AS o JOIN views AS v USING (scene_id)) AS ov
  LEFT JOIN wall USING (scene_id, object_id) LEFT JOIN vd USING (scene_id, object_id)
  WHERE NOT coalesce(wall_adjacent AND CASE wall_axis WHEN 'x_min' THEN eye_x < wall_back WHEN 'x_max' THEN eye_x > wall_back
    WHEN 'z_min' THEN eye_z < wall_back WHEN 'z_max' THEN eye_z > wall_back ELSE FALSE END, FALSE)""", WALL_CTE + ", " + _VERD))
def camera_behind_object(spark, sf):
    from motefield.staging import small
    s = splats(spark, sf)
    v = table(spark, sf, "objects").select(*OBJ).join(small(views(spark, sf)), "scene_id")
    out = hi.camera_behind_object(v, hi.wall_proximity(s, s, S, "object_id"), verdicts(spark, sf), OBJ)
    return out.select(*OBJ, "view_id")


@query("wall_verdict", oracle(["objects"], """SELECT o.scene_id, o.object_id, (regexp_matches(label, '(shelf|shelving)') AND NOT regexp_matches(label, 'tv|TV'))
  OR (regexp_matches(label, '(cabinet|console)') AND NOT regexp_matches(label, '(tv|TV)')) AND NOT (regexp_matches(label, 'table') AND NOT regexp_matches(label, '(cabinet|console)'))
  OR coalesce(wall_adjacent, FALSE) AS wall_adjacent FROM objects AS o LEFT JOIN vd USING (scene_id, object_id)""", _VERD))
def wall_verdict(spark, sf):
    return sel.wall_verdict(table(spark, sf, "objects"), verdicts(spark, sf), OBJ)


ROOM_SQL = "CASE k % 6 WHEN 0 THEN 'kitchen' WHEN 1 THEN 'Living Room' WHEN 2 THEN ' dining-room ' WHEN 3 THEN 'open plan' WHEN 4 THEN NULL ELSE 'office' END"
_ROOM_VALUES = ", ".join("('{}', {}, {}, {})".format(r, len(p), len(a), len(b)) for r, (p, a, b) in rm.ROOMS.items())


def room_scenes(spark, sf):
    return table(spark, sf, "items").select("item_id", F.expr(ROOM_SQL).alias("room_type"))


@query("room_config", oracle(["items"], f"""SELECT item_id, c.room AS room_key, n_passes, n_keep, n_skip FROM (SELECT item_id, {ROOM_SQL} AS room FROM items) AS i
  JOIN (VALUES {_ROOM_VALUES}) AS c(room, n_passes, n_keep, n_skip) ON c.room = CASE trim(lower(i.room)) WHEN 'kitchen' THEN 'kitchen' WHEN 'living room' THEN 'living_room'
    WHEN 'dining-room' THEN 'dining_room' WHEN 'office' THEN 'office' ELSE 'mixed' END"""))
def room_config(spark, sf):
    return rm.room_config(room_scenes(spark, sf)).select("item_id", "room_key", F.size("passes").alias("n_passes"),
                                                         F.size("keep_extras").alias("n_keep"), F.size("skip_extras").alias("n_skip"))


@query("prompt_text", oracle(["items"], "SELECT item_id, pass_name, prompt FROM (SELECT item_id, CASE trim(lower(" + ROOM_SQL + """)) WHEN 'kitchen' THEN 'kitchen' WHEN 'living room' THEN 'living_room'
    WHEN 'dining-room' THEN 'dining_room' WHEN 'office' THEN 'office' ELSE 'mixed' END AS room FROM items) AS i JOIN (VALUES """ + ", ".join(
    [f"('{r}', '{n}', 'Find: {', '.join(c)}.')" for r, (p, _, _) in rm.ROOMS.items() for n, c in p]
    + ["('{}', 'side_view', {})".format(r, "concat('KEEP', chr(10), " + "".join(f"'  • {x}', chr(10), " for x in a) + "'SKIP', chr(10), "
       + "".join("'  - {}', chr(10), ".format(x.replace("'", "''")) for x in b) + "'END')") for r, (_, a, b) in rm.ROOMS.items()]) + ") AS c(room, pass_name, prompt) USING (room)"))
def prompt_text(spark, sf):
    c = rm.room_config(room_scenes(spark, sf))
    a = rm.pass_prompts(c, "Find: {categories}.").select("item_id", "pass_name", "prompt")
    b = rm.detect_prompts(c, "KEEP\n{extra_keep}SKIP\n{extra_skip}END").select("item_id", F.lit("side_view").alias("pass_name"), "prompt")
    return a.unionByName(b)


def side_tables(spark, sf):
    it = table(spark, sf, "items")
    info = it.where("k % 3 <> 0").select("item_id", F.expr("CASE WHEN k % 3 = 1 THEN concat('named ', label) ELSE '  ' END").alias("name"),
                                         F.expr("CASE WHEN k % 4 = 1 THEN 'typed' ELSE '' END").alias("object_type"))
    prompts = it.where("k % 5 <> 0").select("item_id", F.concat(F.lit("|term "), F.col("k").cast("string"), F.lit(" {hard}|other")).alias("prompt"))
    return it, info, prompts


@query("label_resolve", oracle(["items"], """SELECT item_id, coalesce(CASE WHEN k % 3 = 1 THEN trim(concat('named ', label)) END,
  CASE WHEN k % 3 <> 0 AND k % 4 = 1 THEN 'typed' END, CASE WHEN k % 5 <> 0 THEN concat('term ', CAST(k AS VARCHAR)) END, label) AS label FROM items"""))
def label_resolve(spark, sf):
    it, info, prompts = side_tables(spark, sf)
    return inv.label_resolve(it, info, prompts, ["item_id"])


@query("pending_items", oracle(["items", "objects"], """SELECT item_id, scene_id, quadrant FROM items AS i WHERE NOT EXISTS (SELECT 1 FROM objects AS o
  WHERE o.scene_id = i.scene_id AND o.object_id = i.k % 16)"""))
def pending_items(spark, sf):
    it = table(spark, sf, "items").withColumn("object_id", F.col("k") % 16)
    return inv.pending_items(it, table(spark, sf, "objects"), OBJ).select("item_id", "scene_id", "quadrant")


def manifest(spark, sf):
    it = table(spark, sf, "items")
    metas = it.where("k % 5 <> 4").select("item_id", "label", F.expr("CASE WHEN k % 2 = 0 THEN 3 END").alias("phase"), "quadrant", F.col("bx0").alias("n_kept"))
    return inv.scene_manifest(it.select("item_id", "scene_id"), it.where("k % 7 <> 0").select("item_id"), metas, ["item_id"]).join(
        it.select("item_id", "scene_id"), "item_id")


MANIFEST_SQL = """SELECT item_id, CASE WHEN k % 5 <> 4 THEN CASE WHEN k % 2 = 0 THEN 3 ELSE 1 END END AS phase, CASE WHEN k % 5 <> 4 THEN label END AS label,
  CASE WHEN k % 5 <> 4 THEN CASE WHEN k % 2 = 0 THEN concat('phase2_', quadrant) ELSE 'phase1_topdown' END END AS source,
  CASE WHEN k % 5 <> 4 THEN bx0 END AS splats, CASE WHEN k % 7 <> 0 THEN 'hull_extracted' ELSE 'missing_hull' END AS status, scene_id FROM items"""


@query("scene_manifest", oracle(["items"], MANIFEST_SQL))
def scene_manifest(spark, sf):
    return manifest(spark, sf)


@query("phase_counts", oracle(["items"], "SELECT scene_id, phase, count(*) AS n_objects FROM mf GROUP BY scene_id, phase", f"mf AS ({MANIFEST_SQL})"))
def phase_counts(spark, sf):
    return inv.phase_counts(manifest(spark, sf), S)
