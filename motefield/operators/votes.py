"""Multi-view votes of splats, by boxes and by masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as k
from ..functions import boxes as bx
from ..functions import geometry as g
from ..staging import all_of, any_of, computed, small, stage, staged_small
from .masks import pack_runs
from .projection import project

RUN_TILE = 64
PIXEL_PARTS = 192
_COMPILED, _STEP = 64, 4      # boxes of an item that are counted by compiled code, so many in one step
_CORNERS = ["x0", "y0", "x1", "y1"]
CAMERA = ["f", "w", "h", *[f"r{i}{j}" for i in range(3) for j in range(3)], "t0", "t1", "t2"]


def required_votes(n_views: Column, frac: Column | float, n_prompts: Column | None = None) -> Column:
    """``ceil(frac * views)``; with three or more prompt terms the share falls by 0.1 each, to 0.4."""
    frac = frac if isinstance(frac, Column) else F.lit(float(frac))
    if n_prompts is not None:
        frac = F.when(n_prompts >= 3, F.greatest(F.lit(0.4), frac - F.lit(0.1) * (n_prompts - 2))).otherwise(frac)
    return F.ceil(frac * n_views)


def box_votes(df: DataFrame, views: DataFrame, on: list[str], ids: list[str], in_image: bool = True) -> DataFrame:
    """Per splat ``votes``, ``visible`` and ``n_views`` over views that carry a box ``x0..y1``.

    The views of a row are adjacent after the join, so partial aggregation folds
    them before the narrow result is shuffled by splat.  Counting over an array of
    views in place needs no shuffle, but its lambdas are not compiled: measured on
    600,000 splats and 8 views, 2.4 s against 1.0 s.
    """
    cams = views.select(*on, "view_id", *CAMERA, "x0", "y0", "x1", "y1")
    out = df.select(*ids, *on, "x", "y", "z").join(staged_small(cams), on, "left")
    out = project(out, "float")
    u, v, seen = F.col("u"), F.col("v"), F.col("front")
    if in_image:
        seen = seen & (u >= 0) & (u < F.col("w")) & (v >= 0) & (v < F.col("h"))
    hit = seen & bx.contains(bx.box(), u, v)
    return out.groupBy(*ids, *on).agg(F.count_if(hit).alias("votes"), F.count_if(seen).alias("visible"),
                                      F.count("view_id").alias("n_views"))


def with_pixels(df: DataFrame, views: DataFrame, on: list[str], in_image: bool = True) -> DataFrame:
    """Splats with ``_pu _pv _ps``: u, v and whether it sees them (1 or 0) of each camera of their scene, in the order of ``scene_cameras``.

    Taken once per splat, before hulls multiply the rows; splats are dealt out for that, as the
    scan of a few large files would leave all of it to a few tasks.
    """
    df = df.repartition(PIXEL_PARTS, *df.columns)
    def pixel(c: Column) -> Column:
        cx, cy, cz = g.camera_space(*g.cols("x", "y", "z"), get=lambda n: c[n])
        depth = -cz
        safe = F.when(depth > 0, depth).otherwise(F.lit(1.0))
        u, v = c["f"] * cx / safe + c["w"] * F.lit(0.5), c["f"] * cy / safe + c["h"] * F.lit(0.5)
        seen = (depth > 0) & (u >= 0) & (u < c["w"]) & (v >= 0) & (v < c["h"]) if in_image else depth > 0
        return F.struct(u.alias("u"), v.alias("v"), seen.cast("int").alias("seen"))
    # staged, as a shuffle by scene would leave all splats to as many tasks as there are scenes
    out = df.join(staged_small(scene_cameras(views, on)), on, "left")
    out = computed(out, {"_pixels": F.transform("_cameras", pixel)}).drop("_cameras")
    # plain arrays, which compiled code reads without a row object for each pixel
    return computed(out, {f"_p{c}": F.col(f"_pixels.{n}") for c, n in zip("uvs", ("u", "v", "seen"))}).drop("_pixels")


def scene_cameras(views: DataFrame, on: list[str]) -> DataFrame:
    """The different cameras of each scene, in one array."""
    cams = F.sort_array(F.collect_set(F.struct("view_id", *CAMERA)))
    return views.groupBy(*on).agg(cams.alias("_cameras"))


def box_slots(views: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Per group of ``keys`` its boxes as arrays ``_at _x0 _y0 _x1 _y1``, the first being the place of the camera in ``_pu``."""
    at = (F.array_position("_cameras", F.struct("view_id", *CAMERA)) - 1).cast("int")
    slot = F.struct(at.alias("at"), *[F.col(c).cast("double").alias(c) for c in _CORNERS])
    rows = views.join(staged_small(scene_cameras(views, on)), on).withColumn("_slot", slot)
    rows = rows.groupBy(*keys).agg(F.collect_list("_slot").alias("_boxes"), F.count("view_id").alias("n_views"))
    return stage(rows.select(*keys, "n_views", *[F.col(f"_boxes.{c}").alias(f"_{c}") for c in ("at", *_CORNERS)]))


def hull_box_votes(hull: DataFrame, splats: DataFrame, views: DataFrame, on: list[str], item: str, ids: list[str],
                   carry: list[str] = []) -> DataFrame:
    """``box_votes`` of hull rows that carry their pixels (``with_pixels`` with the same views), a row per splat and item;
    with ``carry``, a row per hull row, which keeps these columns.

    Each row counts its item's boxes in place, so hull rows are neither multiplied by views nor
    shuffled.  Rows of splats whose ids repeat in ``splats``, from which the hull was taken, are added up.
    """
    keys = [*on, item]
    slots = box_slots(views, on, keys)
    same = lambda a, b, cols: all_of([F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])
    given = [*ids, *keys, *carry, "_pu", "_pv", "_ps"]
    boxes = ["_at", *[f"_{c}" for c in _CORNERS]]
    rows = hull.select(*given).join(small(slots), keys, "left")

    def one(u: Column, v: Column, seen: Column, box: tuple[Column, ...]) -> Column:      # visible views in the lower 32 bits, votes in the upper
        return F.when(seen == 1, F.when(bx.contains(box, u, v), F.lit((1 << 32) + 1)).otherwise(F.lit(1).cast("bigint"))).otherwise(none)
    none = F.lit(0).cast("bigint")
    pixel = lambda c, at: F.get(f"_p{c}", at)
    most = slots.agg(F.max(F.size("_at"))).first()[0] or 0
    if most <= _COMPILED:              # a lambda over the boxes would not be compiled
        for i in range(0, most, _STEP):
            few = [F.lit(j) for j in range(i, min(i + _STEP, most))]
            sums = [one(*[pixel(c, F.get("_at", j)) for c in "uvs"], tuple(F.get(c, j) for c in boxes[1:])) for j in few]
            rows = computed(rows, {"_sums": reduce(lambda a, b: a + b, sums, F.col("_sums") if i else none)})
        rows = rows if most else rows.withColumn("_sums", none)
    else:
        each = lambda sums, b: sums + one(*[pixel(c, b["_at"]) for c in "uvs"], tuple(b[c] for c in boxes[1:]))
        rows = computed(rows, {"_sums": F.coalesce(F.aggregate(F.arrays_zip(*boxes), none, each), none)})
    rows = rows.select(*ids, *keys, *carry, F.shiftright("_sums", 32).alias("votes"), F.col("_sums").bitwiseAND(F.lit((1 << 32) - 1)).alias("visible"),
                       F.coalesce("n_views", F.lit(0).cast("bigint")).alias("n_views"))
    again = staged_small(splats.groupBy(*ids, *on).agg(F.count("*").alias("_n")).where("_n > 1"))
    if again.isEmpty():
        return rows
    once = rows.alias("r").join(again.alias("a"), same("r", "a", [*ids, *on]), "left_anti")
    more = rows.alias("r").join(again.alias("a"), same("r", "a", [*ids, *on]), "left_semi")
    summed = more.groupBy(*ids, *keys).agg(*[F.sum(c).alias(c) for c in ("votes", "visible", "n_views")])
    if carry:
        summed = more.select(*ids, *keys, *carry).alias("r").join(summed.alias("a"), same("r", "a", [*ids, *keys])).select(
            "r.*", "a.votes", "a.visible", "a.n_views")
    return once.unionByName(summed)


def keep_box_votes(voted: DataFrame, frac: float = k.BOX_VOTE_FRAC) -> DataFrame:
    need = required_votes(F.col("n_views"), frac)
    return voted.where((F.col("votes") >= need) & (F.col("visible") >= need))


def keep_art_votes(voted: DataFrame, frac: float = k.ART_VOTE_FRAC) -> DataFrame:
    """At least one vote; a group without views keeps everything."""
    need = F.greatest(F.lit(1), required_votes(F.col("n_views"), frac))
    return voted.where((F.col("n_views") == 0) | (F.col("votes") >= need))


def mask_index(runs: DataFrame, keys: list[str], layers: dict[str, Column] | None = None) -> DataFrame:
    """Masks as bitmaps of 64 pixels of a row, written once and reused by every vote.

    One row per ``keys``, image row and tile; bit i of a word is pixel ``64 * tile + i``.  Each
    of ``layers`` is a condition on the runs and has a word of its own, so that several votes
    over the same pixels look up once.  Runs may overlap.
    """
    layers = layers or {"mask": F.lit(True)}
    flags = [f"_in_{n}" for n in layers]
    cut = pack_runs(runs.where("x1 >= x0").withColumns(dict(zip(flags, layers.values()))), [*keys, *flags], RUN_TILE)
    bits = F.expr(f"shiftleft(shiftrightunsigned(-1L, {RUN_TILE - 1} - (x1 - x0)), x0 - tile * {RUN_TILE})")
    return stage(cut.groupBy(*keys, "y", "tile").agg(*[F.bit_or(F.when(F.col(f), bits)).alias(n) for n, f in zip(layers, flags)]))


def _named(stem: str, layer: str, layers: list[str]) -> str:
    return stem if len(layers) == 1 else f"{stem}_{layer}"


def mask_votes(df: DataFrame, views: DataFrame, index: DataFrame, on: list[str], ids: list[str],
               rule: str = "index", extra: list[str] = [], layers: list[str] = ["mask"], zeros: bool = True) -> DataFrame:
    """Per splat: views that see it (``visible``) and whose mask covers it (``votes``).

    ``views`` holds the views to count (``masked_views``); ``index`` is a ``mask_index`` keyed by
    ``on + view_id (+ extra)``.  Of several ``layers``, each has its views and its columns, named
    ``votes_layer`` and ``visible_layer``.  Only pixels inside an image are looked up, each in the
    one word of its tile.  A splat that no view sees comes from a row of its own, with zeros;
    without ``zeros``, for votes that must reach one, such splats are left out and no second row of each splat is shuffled.
    """
    has = [f"has_{n}" for n in layers]
    pts = df.select(*ids, *on, "x", "y", "z").join(small(views.select(*on, "view_id", *CAMERA, *extra, *has)), on)
    pts = project(pts, rule).where("inside").select(
        *ids, *on, "view_id", *extra, *has, F.col("py").alias("y"), F.expr(f"px div {RUN_TILE}").cast("int").alias("tile"), F.expr(f"px % {RUN_TILE}").alias("_bit"))
    rows = [*ids, *on, *extra]
    covered = lambda n: F.expr(f"cast(has_{n} and coalesce(shiftright({n}, _bit) & 1L, 0L) = 1L as int)").alias(f"_v_{n}")
    hit = pts.join(small(index.select(*on, "view_id", *extra, "y", "tile", *layers)), [*on, "view_id", *extra, "y", "tile"], "left").select(
        *rows, *[covered(n) for n in layers], *[F.col(f"has_{n}").cast("int").alias(f"_s_{n}") for n in layers])
    if zeros:
        asked = df.select(*ids, *on).join(small(views.select(*on, *extra).distinct()), on)
        hit = hit.unionByName(asked.select(*rows, *[F.lit(0).alias(f"_{c}_{n}") for c in "vs" for n in layers]))
    total = lambda c, stem, n: F.sum(f"_{c}_{n}").alias(_named(stem, n, layers))
    return hit.groupBy(*rows).agg(*[total("v", "votes", n) for n in layers], *[total("s", "visible", n) for n in layers])


def masked_views(views: DataFrame, index: DataFrame, on: list[str], extra: list[str] = [], layers: list[str] = ["mask"]) -> DataFrame:
    """The views that have a mask in some layer, and ``has_layer``: whether in that one."""
    have = index.groupBy(*on, "view_id", *extra).agg(*[(F.count(n) > 0).alias(f"has_{n}") for n in layers])
    return stage(views.join(have.where(any_of([F.col(f"has_{n}") for n in layers])), [*on, "view_id"]))


def view_counts(views: DataFrame, on: list[str], layers: list[str] = ["mask"]) -> DataFrame:
    """``n_views`` of each group (``n_views_layer`` of several layers)."""
    return views.groupBy(*on).agg(*[F.count_distinct(F.when(F.col(f"has_{n}"), F.col("view_id"))).alias(_named("n_views", n, layers)) for n in layers])


def keep_mask_votes(voted: DataFrame, counts: DataFrame, on: list[str], frac: float,
                    n_prompts: Column | None = None, need_visible: bool = True) -> DataFrame:
    out = voted.join(staged_small(counts), on)
    need = required_votes(F.col("n_views"), frac, n_prompts)
    keep = (F.col("votes") >= need) & (F.col("visible") >= need) if need_visible else (
        F.col("votes") >= F.greatest(F.lit(1), need))
    return out.where(keep)


def insideness(voted: DataFrame) -> DataFrame:
    """Share of the views that see a splat whose mask covers it; 0.5 when none sees it."""
    return voted.withColumn("insideness", F.when(F.col("visible") > 0, F.col("votes") / F.col("visible")).otherwise(0.5))


def insideness_hist(scored: DataFrame, keys: list[str]) -> DataFrame:
    s = F.col("insideness")
    return scored.groupBy(*keys).agg(F.count_if(s < 0.3).alias("n_low"), F.count_if((s >= 0.3) & (s <= 0.7)).alias("n_mid"),
                                     F.count_if(s > 0.7).alias("n_high"))
