"""Row filters of scene cleaning and object refinement, for many scenes at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as k
from ..functions import geometry as g
from ..staging import all_of, small, stage, staged_small
from .attributes import plane_columns
from .quantiles import Cut, chained_cuts, percentiles
from .voxels import with_colour_distance, with_voxel_count

SCENE = ["scene_id"]
Y = {"y": F.col}


def _with(df: DataFrame, keys: list[str], want: list[tuple[str, str, float]],
          measures: dict[str, Column] | None = None) -> DataFrame:
    measures = measures or {"y": F.col("y")}
    return df.join(small(percentiles(df, keys, measures, want)), keys)


def _floor_y(planes: DataFrame) -> DataFrame:
    return small(planes.select("scene_id", (-F.col("d") / F.col("b")).alias("_floor")))


def ceiling_floor_cut(df: DataFrame, planes: DataFrame) -> DataFrame:
    """Flags of the two cuts: ``keep_id`` (10 % off the top) and ``keep_extract`` (3 %)."""
    out = _with(df, SCENE, [("_id", "y", k.CEILING_PCT_ID), ("_ex", "y", k.CEILING_PCT_EXTRACT)])
    out = out.join(_floor_y(planes), "scene_id")
    above = F.col("y") <= F.col("_floor") + k.FLOOR_BUFFER_M
    return out.withColumns({"keep_id": (F.col("y") >= F.col("_id")) & above,
                            "keep_extract": (F.col("y") >= F.col("_ex")) & above}).drop("_id", "_ex", "_floor")


def max_scale_filter(df: DataFrame, limit: float = k.MAX_SCALE_M) -> DataFrame:
    """Longest axis at most ``limit``; plain comparisons, so that a scan can skip row groups."""
    log = math.log(limit)
    return df.where((F.col("scale_0") <= log) & (F.col("scale_1") <= log) & (F.col("scale_2") <= log))


def _top_band(df: DataFrame, keys: list[str], pct: float = k.TOP_BAND_PCT) -> DataFrame:
    return _with(df, keys, [("_top", "y", pct)])


def top_band_aniso(df: DataFrame, keys: list[str] = SCENE) -> DataFrame:
    return _top_band(df, keys).where(~((F.col("y") < F.col("_top")) & g.anisotropy_above(k.ANISO_RATIO, 1e-9))).drop("_top")


def top_band_max_scale(df: DataFrame, keys: list[str] = SCENE) -> DataFrame:
    big = g.max_log_scale() > math.log(k.TOP_MAX_SCALE_M)
    return _top_band(df, keys).where(~((F.col("y") < F.col("_top")) & big)).drop("_top")


def top_band_density(df: DataFrame, keys: list[str] = SCENE) -> DataFrame:
    """Drop thin voxels of the top band; the count is over all splats."""
    out = with_voxel_count(_top_band(df, keys), keys, k.DENSITY_VOXEL_M, "_density")
    return out.where(~((F.col("y") < F.col("_top")) & (F.col("_density") < k.DENSITY_MIN))).drop("_top", "_density")


def _colour_outlier(scored: DataFrame, keys: list[str], band: Column, pct: float) -> DataFrame:
    limit = percentiles(scored.where(band), keys, {"d": F.col("_dist")}, [("_limit", "d", pct)])
    out = scored.join(small(limit), keys, "left")
    return out.where(~F.coalesce(band & (F.col("_dist") > F.col("_limit")), F.lit(False))).drop("_dist", "_limit")


def top_band_colour_outlier(df: DataFrame, keys: list[str] = SCENE) -> DataFrame:
    """Drop the top band's splats beyond p95 of the band's own colour distances."""
    scored = stage(_top_band(with_colour_distance(df, keys, k.COLOUR_VOXEL_M, "_dist"), keys))
    return _colour_outlier(scored, keys, F.col("y") < F.col("_top"), k.COLOUR_BAND_PCT).drop("_top")


def scene_colour_outlier(df: DataFrame, keys: list[str] = SCENE) -> DataFrame:
    scored = stage(with_colour_distance(df, keys, k.COLOUR_VOXEL_M, "_dist"))
    out = _with(scored, keys, [("_limit", "d", k.COLOUR_SCENE_PCT)], {"d": F.col("_dist")})
    return out.where(F.col("_dist") <= F.col("_limit")).drop("_dist", "_limit")


def slice_chain(df: DataFrame, planes: DataFrame) -> DataFrame:
    """All cleaning steps in order, each percentile taken over the survivors so far.

    The four cuts by height that need no voxels come from one joint selection
    (``chained_cuts``).  The survivors of the density step are written once with all their
    columns, as both colour steps read them several times.
    """
    flag = lambda c: F.coalesce(c, F.lit(True))
    never, height = F.lit(False), F.col("y")
    log = math.log(k.MAX_SCALE_M)
    usable = (height <= F.col("_floor") + k.FLOOR_BUFFER_M) & all_of([F.col(f"scale_{i}") <= log for i in range(3)])
    long, big = g.anisotropy_above(k.ANISO_RATIO, 1e-9), g.max_log_scale() > math.log(k.TOP_MAX_SCALE_M)
    marked = df.join(_floor_y(planes), "scene_id")
    cuts = chained_cuts(marked, SCENE, height, [
        Cut("_ceiling", k.CEILING_PCT_ID, F.lit(True), ~F.coalesce(usable, F.lit(False))), Cut("_long", k.TOP_BAND_PCT, flag(long), never),
        Cut("_big", k.TOP_BAND_PCT, flag(big), never), Cut("_thin", k.TOP_BAND_PCT, never, never)])
    out = marked.join(small(cuts), "scene_id").where(usable & (height >= F.col("_ceiling")))
    out = out.where(~((height < F.col("_long")) & long)).where(~((height < F.col("_big")) & big)).drop("_floor", "_ceiling", "_long", "_big")
    out = with_voxel_count(out, SCENE, k.DENSITY_VOXEL_M, "_density")
    out = stage(out.where(~((height < F.col("_thin")) & (F.col("_density") < k.DENSITY_MIN))).drop("_thin", "_density"))
    out = with_colour_distance(_top_band(out, SCENE), SCENE, k.COLOUR_VOXEL_M, "_dist")
    out = _colour_outlier(out, SCENE, height < F.col("_top"), k.COLOUR_BAND_PCT).drop("_top")
    out = with_colour_distance(out, SCENE, k.COLOUR_VOXEL_M, "_dist")
    out = _with(out, SCENE, [("_limit", "d", k.COLOUR_SCENE_PCT)], {"d": F.col("_dist")})
    return out.where(F.col("_dist") <= F.col("_limit")).drop("_dist", "_limit")


def cardinal_strip(df: DataFrame, planes: DataFrame) -> DataFrame:
    """Strip between the ceiling cut and the floor, thin 5 cm voxels of the strip dropped."""
    out = _with(df, SCENE, [("_cut", "y", k.STRIP_CEILING_PCT)]).join(_floor_y(planes), "scene_id")
    out = out.where((F.col("y") > F.col("_cut")) & (F.col("y") >= F.col("_floor") - k.STRIP_HEIGHT_M)
                    & (F.col("y") <= F.col("_floor"))).drop("_cut", "_floor")
    return density_filter(out, k.STRIP_MIN, k.STRIP_VOXEL_M)


def density_filter(df: DataFrame, least: int, size: float = k.DENSITY_VOXEL_M, keys: list[str] = SCENE) -> DataFrame:
    return with_voxel_count(df, keys, size, "_density").where(F.col("_density") >= least).drop("_density")


# --- floor band ------------------------------------------------------------

def floor_drop_condition(thresh: Column | float = k.FLOOR_THRESH_M, upper: float = k.FLOOR_UPPER_M,
                         cos: float = k.FLOOR_COS) -> Column:
    """In the band around the floor and lying flat on it (needs ``sd`` and ``align``)."""
    return in_floor_band(thresh, upper) & (F.col("align") > cos)


def in_floor_band(thresh: Column | float = k.FLOOR_THRESH_M, upper: float = k.FLOOR_UPPER_M) -> Column:
    return (F.col("sd") >= -upper) & (F.col("sd") <= thresh)


def floor_band_drop(df: DataFrame, planes: DataFrame, thresh: float = k.FLOOR_THRESH_M) -> DataFrame:
    return plane_columns(df, planes).where(~floor_drop_condition(thresh)).select(*df.columns)


def floor_counts(df: DataFrame, planes: DataFrame, keys: list[str], thresh: Column | float = k.FLOOR_THRESH_M) -> DataFrame:
    """What the band drop keeps and why."""
    t = thresh if isinstance(thresh, Column) else F.lit(thresh)
    band, drop = in_floor_band(t), floor_drop_condition(t)
    return plane_columns(df, planes).groupBy(*keys).agg(
        F.count_if(~drop).alias("n_kept"), F.count_if(drop).alias("n_dropped"),
        F.count_if(F.col("sd") < -k.FLOOR_UPPER_M).alias("n_above"), F.count_if(band).alias("n_in_band"),
        F.count_if(drop).alias("n_aligned"), F.count_if(band & ~drop).alias("n_preserved"),
        F.count_if(F.col("sd") > t).alias("n_below"))


# --- streaks and carving ---------------------------------------------------

def dark_streak(scale_m: float, max_brightness: float) -> Column:
    return (g.max_log_scale() > math.log(scale_m)) & (g.brightness() < max_brightness)


def destreak_colour(df: DataFrame, scale_m: float, max_brightness: float) -> DataFrame:
    return df.where(~dark_streak(scale_m, max_brightness))


def destreak_geometry(df: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """Drop large, stretched, isolated splats of the lowest quarter of an object."""
    from .spatial import isolations, scored
    scores = isolations(df, keys)
    rows = scores.select(*keys, "isolation", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mult"))))
    limit = percentiles(rows, keys, {"i": F.col("isolation")}, [("_iso", "i", k.STREAK_ISO_PCT)])
    span = df.groupBy(*keys).agg(F.min("y").alias("_lo"), F.max("y").alias("_hi"))
    out = df.join(small(limit), keys).join(staged_small(span), keys)
    streak = ((F.col("y") >= F.col("_hi") - k.STREAK_BAND * (F.col("_hi") - F.col("_lo")))
              & (g.max_log_scale() > math.log(k.STREAK_SCALE_M)) & g.anisotropy_above(k.STREAK_ANISO, 1e-6))
    # whatever its isolation, a row that is no streak stays; only the others are shuffled to theirs
    asked = scored(out.where(F.coalesce(streak, F.lit(True))), scores, keys)
    return out.where(~streak).select(*df.columns).unionByName(
        asked.where(~(streak & (F.col("isolation") > F.col("_iso")))).select(*df.columns))


def bottom_band_carve(df: DataFrame, keys: list[str], score: str, limit: float, band_pct: float) -> DataFrame:
    """The score limit applies to the lowest part of the height only."""
    span = df.groupBy(*keys).agg(F.min("y").alias("_lo"), F.max("y").alias("_hi"))
    out = df.join(staged_small(span), keys)
    cut = F.col("_lo") + (1.0 - band_pct / 100.0) * (F.col("_hi") - F.col("_lo"))
    return out.where((F.col(score) >= limit) | (F.col("y") < cut)).drop("_lo", "_hi")


def rug_band(df: DataFrame, keys: list[str], box_test: Column) -> DataFrame:
    """Within the box, the band around the surface (p95 of y): 10 cm above to 5 cm below."""
    boxed = df.where(box_test)
    out = _with(boxed, keys, [("_surface", "y", 95.0)])
    y, s = F.col("y"), F.col("_surface")
    return out.where((y >= s - k.RUG_BAND_M) & (y <= s + k.RUG_BELOW_M)).drop("_surface")


def depth_mode(df: DataFrame, keys: list[str], depth: str) -> DataFrame:
    """Median of a thin depth range, else the middle of the fullest of equal bins."""
    r = df.groupBy(*keys).agg(F.min(depth).alias("_lo"), F.max(depth).alias("_hi")).withColumn(
        "_bins", F.greatest(F.lit(20), ((F.col("_hi") - F.col("_lo")) / 0.01).cast("int")))
    r = staged_small(r)
    span, lo, bins = F.col("_hi") - F.col("_lo"), F.col("_lo"), F.col("_bins")

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("_hi")).otherwise(lo + i * (span / bins))

    d = F.col(depth)
    binned = df.join(r, keys).where(span >= 0.05).withColumn(
        "_i", F.least(F.floor((d - lo) / span * bins).cast("int"), bins - 1))
    i = F.col("_i")
    binned = binned.withColumn("_i", i - F.when(d < edge(i), 1).otherwise(0)
                               + F.when((d >= edge(i + 1)) & (i != bins - 1), 1).otherwise(0))
    counts = binned.groupBy(*keys, "_lo", "_hi", "_bins", "_i").agg(F.count("*").alias("_n"))
    best = (counts.groupBy(*keys, "_lo", "_hi", "_bins").agg(F.max(F.struct("_n", (-F.col("_i")).alias("_i"))).alias("_b"))
            .withColumn("_i", -F.col("_b._i")))
    full = best.select(*keys, ((edge(F.col("_i")) + edge(F.col("_i") + 1)) / 2).alias("plane_depth"))
    thin = df.join(small(r.where(span < 0.05).select(*keys)), keys, "left_semi")
    med = percentiles(thin, keys, {"d": d}, [("plane_depth", "d", 50.0)])
    return stage(full.unionByName(med))


def wall_slab(df: DataFrame, keys: list[str], normals: DataFrame, half: float = k.SLAB_HALF_M) -> DataFrame:
    """Within 5 cm of the modal depth along each group's wall normal ``n_*`` from ``m_*``."""
    scored = df.join(small(normals), keys).withColumn("_depth", (
        (F.col("x") - F.col("m_x")) * F.col("n_x") + (F.col("y") - F.col("m_y")) * F.col("n_y")
        + (F.col("z") - F.col("m_z")) * F.col("n_z")))
    mode = depth_mode(scored, keys, "_depth")
    return scored.join(small(mode), keys).where(F.abs(F.col("_depth") - F.col("plane_depth")) <= half).select(*df.columns)


def pca_normals(df: DataFrame, keys: list[str], eyes: DataFrame) -> DataFrame:
    """Thinnest principal axis per group, turned toward the camera ``eye_*``.

    Spark sums the covariances; the task only solves one 3 x 3 problem per row.
    """
    import numpy as np
    import pandas as pd
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    cov = df.groupBy(*keys).agg(*[F.avg(a).alias(f"m_{a}") for a in "xyz"],
                                *[F.covar_samp(a, b).alias(f"v_{a}{b}") for a, b in pairs])
    cov = cov.join(small(eyes), keys)

    def solve(batches):
        for b in batches:
            if b.empty:
                continue
            m = np.empty((len(b), 3, 3))
            for (p, q) in pairs:
                i, j = "xyz".index(p), "xyz".index(q)
                m[:, i, j] = m[:, j, i] = b[f"v_{p}{q}"].to_numpy()
            _, vec = np.linalg.eigh(np.nan_to_num(m))
            n = vec[:, :, 0]
            c = b[["m_x", "m_y", "m_z"]].to_numpy()
            e = b[["eye_x", "eye_y", "eye_z"]].to_numpy()
            n = np.where((((e - c) * n).sum(axis=1) < 0)[:, None], -n, n)
            out = b[[*keys, "m_x", "m_y", "m_z"]].copy()
            out["n_x"], out["n_y"], out["n_z"] = n.T
            yield out

    fields = ", ".join([f"{x} {df.schema[x].dataType.simpleString()}" for x in keys]
                       + [f"{n} double" for n in ("m_x", "m_y", "m_z", "n_x", "n_y", "n_z")])
    return stage(cov.mapInPandas(solve, fields))


def smallest_kept(df: DataFrame, keys: list[str], least: int = k.MIN_COMPANION_SPLATS) -> DataFrame:
    """Splats of the groups that hold at least ``least`` of them."""
    n = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(*keys)
    return df.join(staged_small(n), keys, "left_semi")


def area_reasons(items: DataFrame, least: int, box: tuple[str, str, str, str] = ("bx0", "by0", "bx1", "by1")) -> DataFrame:
    """Why an item is dropped, or null: no box, or too small."""
    b = [F.col(c) for c in box]
    area = (b[2] - b[0]) * (b[3] - b[1])
    reason = (F.when(b[0].isNull() | b[1].isNull() | b[2].isNull() | b[3].isNull(), "no_box")
              .when(area < least, F.concat(F.lit("too_small("), area.cast("string"), F.lit(")"))))
    return items.withColumn("dropped", reason)
