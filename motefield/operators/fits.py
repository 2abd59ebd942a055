"""Rasters, dominant direction and floor plane of a scene."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..staging import attach, computed, small, stage, staged_small
from .projection import project
from .ranking import sample_per_group, top_rows, with_even_hash
from .voxels import exact_mean


def point_raster(df: DataFrame, views: DataFrame, on: list[str]) -> DataFrame:
    """Per pixel: splat count, mean f_dc and nearest depth."""
    cams = views.select(*on, "view_id", "f", "w", "h", *[f"r{i}{j}" for i in range(3) for j in range(3)], "t0", "t1", "t2")
    pts = project(df.join(small(cams), on), "index").where("inside")
    return pts.groupBy(*on, "view_id", "px", "py").agg(
        F.count("*").alias("n"), *[exact_mean(c).alias(f"mean_{c}") for c in g.DC], F.min("depth").alias("near_depth"))


def floor_cells(df: DataFrame, keys: list[str], size: float) -> DataFrame:
    """Occupied cells of the floor grid."""
    return df.select(*keys, F.floor(F.col("x") / size).alias("i"), F.floor(F.col("z") / size).alias("j")).distinct()


def edge_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with at least one empty side."""
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]))
    sides = cells.withColumn("_s", steps).select(*keys, (F.col("i") + F.col("_s.a")).alias("i"), (F.col("j") + F.col("_s.b")).alias("j"))
    full = sides.groupBy(*keys, "i", "j").agg(F.count("*").alias("_n")).where("_n = 4").select(*keys, "i", "j")
    return cells.join(full, [*keys, "i", "j"], "left_anti")


ANGLES = [(t, round(math.cos(math.radians(t)), 12), round(math.sin(math.radians(t)), 12)) for t in range(180)]


def dominant_yaw(cells: DataFrame, keys: list[str], least: int = 200, lines: int = 200) -> DataFrame:
    """Median of the strongest line angles, folded into -45..45 degrees; 0 without lines."""
    grid = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c"), F.lit(s).alias("s")) for t, c, s in ANGLES]))
    marks = cells.select(*keys, "i", "j", grid.alias("_a"))
    rho = F.rint(F.col("i") * F.col("_a.c") + F.col("j") * F.col("_a.s")).cast("bigint")
    votes = marks.groupBy(*keys, F.col("_a.t").alias("theta"), rho.alias("rho")).agg(F.count("*").alias("votes"))
    best = top_rows(votes.where(F.col("votes") >= least), keys, [F.desc("votes"), "theta", "rho"], lines)
    deg = ((F.col("theta") + 45) % 90 - 45).cast("double")
    found = best.groupBy(*keys).agg(F.median(deg).alias("_deg"))
    return cells.select(*keys).distinct().join(staged_small(found), keys, "left").select(
        *keys, F.coalesce("_deg", F.lit(0.0)).alias("yaw_deg"))


_CELLS = (32, 8, 2)      # cell sizes of the pyramid, as multiples of the distance that counts as near
_G = ["_gx", "_gy", "_gz"]
_COEF = ["a", "b", "c", "d"]


def _cells(df: DataFrame, keys: list[str], near: float) -> tuple[DataFrame, list[DataFrame]]:
    """Finite points with their finest cell, and per level of the pyramid each cell's count and box of points."""
    fine = near * _CELLS[-1]
    pts = computed(df.select(*keys, "x", "y", "z"), {a: F.col(a).cast("double") for a in "xyz"})
    for a in "xyz":
        pts = pts.where(F.abs(F.col(a)) < 1e15)
    pts = computed(pts, {**{a: F.col(a) for a in "xyz"}, **{g_: F.floor(F.col(a) / fine) for a, g_ in zip("xyz", _G)}})
    finest = stage(pts.groupBy(*keys, *_G).agg(F.count("*").alias("_n"), *[f(a).alias(f"_{a}_{m}") for a in "xyz" for m, f in (("lo", F.min), ("hi", F.max))]))
    levels = []
    for size in _CELLS:
        step = size // _CELLS[-1]
        up = finest.withColumns({g_: F.floor(F.col(g_) / step) for g_ in _G})
        levels.append(finest if step == 1 else up.groupBy(*keys, *_G).agg(F.sum("_n").alias("_n"), *[
            f(f"_{a}_{m}").alias(f"_{a}_{m}") for a in "xyz" for m, f in (("lo", F.min), ("hi", F.max))]))
    return pts, levels


def _cut(cells: DataFrame, near: float) -> tuple[DataFrame, DataFrame]:
    """Of cells with a plane each: those wholly near it, and those it leaves open; the rest is far."""
    mid = lambda a: (F.col(f"_{a}_lo") + F.col(f"_{a}_hi")) / 2
    half = lambda a: (F.col(f"_{a}_hi") - F.col(f"_{a}_lo")) / 2
    terms = list(zip("abc", "xyz"))
    at = F.abs(sum((F.col(n) * mid(a) for n, a in terms), F.col("d")))
    reach = sum((F.abs(F.col(n)) * half(a) for n, a in terms), F.lit(0.0))
    slack = 1e-9 * (sum((F.abs(F.col(n)) * (F.abs(mid(a)) + half(a)) for n, a in terms), F.abs(F.col("d"))) + 1.0)
    seen = cells.withColumns({"_whole": at + reach + slack <= near, "_far": at - reach - slack > near})
    return seen.where("_whole"), seen.where(~F.col("_whole") & ~F.col("_far"))


def open_cells(df: DataFrame, keys: list[str], planes: DataFrame, near: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points with their cell, counts settled by whole cells, finest cells that a plane cuts).

    A pyramid of cells is walked from coarse to fine, each level only with the planes that
    cut the cell above.  A cell whose points' box lies wholly near a plane adds its count, one
    wholly beyond it adds nothing; only cells that a plane cuts are asked point by point.
    """
    pts, levels = _cells(df, keys, near)
    settled, still = None, None
    for i, cells in enumerate(levels):
        if still is None:
            met = cells.join(small(planes), keys)
        else:
            step = _CELLS[i - 1] // _CELLS[i]
            above = still.select(*keys, *[F.col(g_).alias(f"_up{g_}") for g_ in _G], "try", *_COEF)
            met = cells.withColumns({f"_up{g_}": F.floor(F.col(g_) / step) for g_ in _G}).join(
                small(above), [*keys, *[f"_up{g_}" for g_ in _G]]).drop(*[f"_up{g_}" for g_ in _G])
        whole, still = _cut(met, near)
        still = stage(still.select(*keys, *_G, "_n", "try", *_COEF))
        whole = whole.groupBy(*keys, "try").agg(F.sum("_n").alias("_in"))
        settled = whole if settled is None else settled.unionByName(whole)
    return pts, settled, still


def inlier_counts(df: DataFrame, keys: list[str], planes: DataFrame, near: float) -> DataFrame:
    """``planes`` (keys, try, a, b, c, d) with ``inliers``, the points of the group within ``near`` of each."""
    pts, settled, cut = open_cells(df, keys, planes, near)
    asked = cut.groupBy(*keys, *_G).agg(F.max("_n").alias("_n"), F.collect_list(F.struct("try", *_COEF)).alias("_planes"))
    pts = attach(pts, asked, [*keys, *_G], "_n").where(F.col("_planes").isNotNull())
    dist = F.abs(F.col("_p.a") * F.col("x") + F.col("_p.b") * F.col("y") + F.col("_p.c") * F.col("z") + F.col("_p.d"))
    found = pts.withColumn("_p", F.explode("_planes")).where(dist <= near).groupBy(*keys, F.col("_p.try").alias("try")).agg(F.count("*").alias("_in"))
    total = settled.unionByName(found).groupBy(*keys, "try").agg(F.sum("_in").alias("inliers"))
    return planes.join(staged_small(total), [*keys, "try"], "left").fillna(0, ["inliers"])


def plane_fit(df: DataFrame, keys: list[str], ids: list[str], tries: int = 64, near: float = 0.05, seed: int = 7) -> DataFrame:
    """Floor plane by consensus: planes through seeded point triples, the one with most points near it.

    Points are counted by cells; see ``open_cells``.
    """
    pts = sample_per_group(df.select(*keys, *ids, "x", "y", "z"), keys, 3 * tries, ids, seed)
    pts = with_even_hash(pts, "_h", ids, seed + 1)
    w = Window.partitionBy(*keys).orderBy("_h", *ids)
    pts = pts.withColumn("_r", F.row_number().over(w) - 1).withColumns({"try": F.floor(F.col("_r") / 3), "_p": F.col("_r") % 3})
    tri = pts.groupBy(*keys, "try").agg(*[F.max(F.when(F.col("_p") == i, F.col(a).cast("double"))).alias(f"{a}{i}")
                                          for a in "xyz" for i in range(3)])
    edge = lambda i: tuple(F.col(f"{a}{i}") - F.col(f"{a}0") for a in "xyz")
    n = g.cross(edge(1), edge(2))
    tri = tri.withColumns(dict(zip(["na", "nb", "nc"], n))).withColumn(
        "_len", F.sqrt(F.col("na") * F.col("na") + F.col("nb") * F.col("nb") + F.col("nc") * F.col("nc"))).where("_len > 1e-12")
    sign = F.when(F.col("nb") < 0, -1.0).otherwise(1.0)
    tri = tri.withColumns({m: F.col(s) * sign / F.col("_len") for m, s in (("a", "na"), ("b", "nb"), ("c", "nc"))})
    tri = tri.withColumn("d", -(F.col("a") * F.col("x0") + F.col("b") * F.col("y0") + F.col("c") * F.col("z0")))
    tries_ = stage(tri.select(*keys, "try", "a", "b", "c", "d"))
    score = inlier_counts(df, keys, tries_, near)
    best = score.groupBy(*keys).agg(F.max_by(F.struct("a", "b", "c", "d", "inliers"), F.struct("inliers", (-F.col("try")).alias("t"))).alias("_b"))
    return best.select(*keys, "_b.*")
