"""Masks as sets of pixel runs: one row per horizontal run ``y, x0..x1``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as k


def radius_px(pad_m: Column, f: Column, depth: Column) -> Column:
    """Dilation radius in pixels of a pad in metres."""
    return pad_m * f / F.greatest(depth, F.lit(0.1))


def pad_metres(tag: Column) -> Column:
    return (F.when(tag == "soft", k.TIGHT_PAD_SOFT_M).when(tag == "hard", k.TIGHT_PAD_HARD_M)
            .otherwise(k.WIDE_PAD_M))


def merge_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching runs of a row become one; the pixel set is unchanged.

    The first aggregate keeps one run per start pixel, so that a row of an image
    holds at most as many runs as it has pixels when the window sorts it.
    """
    row = [*keys, "y"]
    w = Window.partitionBy(*row).orderBy("x0")
    once = runs.groupBy(*row, "x0").agg(F.max("x1").alias("x1")).where(F.col("x1") >= F.col("x0"))
    before = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = once.withColumn("_new", (before.isNull() | (F.col("x0") > before + 1)).cast("int"))
    island = starts.withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*row, "_i").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_i")


def mask_union(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Pixel-wise OR over everything not in ``keys`` (prompts, passes)."""
    return merge_runs(runs, keys)


def mask_offset(runs: DataFrame, dx: Column, dy: Column, w: Column, h: Column) -> DataFrame:
    """Move the runs of a crop into the whole image, cut at its edges."""
    out = runs.withColumns({"y": F.col("y") + dy, "x0": F.greatest(F.lit(0), F.col("x0") + dx),
                            "x1": F.least(w - 1, F.col("x1") + dx)})
    return out.where((F.col("y") >= 0) & (F.col("y") < h) & (F.col("x1") >= F.col("x0")))


def mask_dilate(runs: DataFrame, keys: list[str], radius: Column, w: Column, h: Column) -> DataFrame:
    """Grow by a disk up to radius 50, beyond it by a diamond of ``round(r / 1.4)`` steps."""
    r = F.rint(radius).cast("int")
    reach = F.when(r < 1, 0).when(r <= 50, r).otherwise(F.greatest(F.lit(1), F.rint(r / 1.4).cast("int")))
    merged = merge_runs(runs.withColumns({"_r": r, "_reach": reach, "_w": w, "_h": h}),
                        [*keys, "_r", "_reach", "_w", "_h"])
    grown = merged.withColumn("_dy", F.explode(F.sequence(-F.col("_reach"), F.col("_reach"))))
    dy, reach = F.col("_dy"), F.col("_reach")
    half = F.when(F.col("_r") <= 50, F.floor(F.sqrt((reach * reach - dy * dy).cast("double"))).cast("int")).otherwise(
        reach - F.abs(dy))
    out = grown.withColumns({"y": F.col("y") + dy, "x0": F.greatest(F.lit(0), F.col("x0") - half),
                             "x1": F.least(F.col("_w") - 1, F.col("x1") + half)})
    out = out.where((F.col("y") >= 0) & (F.col("y") < F.col("_h")))
    return merge_runs(out.select(*keys, "y", "x0", "x1"), keys)


def run_pixels() -> Column:
    return F.sum(F.col("x1") - F.col("x0") + 1)


def silhouettes(runs: DataFrame, keys: list[str]) -> DataFrame:
    return runs.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y").alias("y0"),
                                   F.max("x1").alias("x1"), F.max("y").alias("y1"))


def mask_sizes(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels of each mask, overlapping runs counted once."""
    return merge_runs(runs, keys).groupBy(*keys).agg(run_pixels().alias("n_px"))


def healthy(runs: DataFrame, keys: list[str], min_px: int) -> DataFrame:
    """Runs of the masks that hold at least ``min_px`` pixels, merged."""
    from ..staging import staged_small
    big = mask_sizes(runs, keys).where(F.col("n_px") >= min_px).select(*keys)
    return merge_runs(runs, keys).join(staged_small(big), keys, "left_semi")


def pool_masks(passes: list[DataFrame], keys: list[str], min_px: int) -> DataFrame:
    """Masks of several passes side by side, those too small left out."""
    pooled = None
    for i, p in enumerate(passes):
        p = p.withColumn("pass_no", F.lit(i))
        pooled = p if pooled is None else pooled.unionByName(p)
    return healthy(pooled, ["pass_no", *keys], min_px)


def prompt_hits(runs: DataFrame, keys: list[str], prompt: str, view: str,
                min_px: int = k.MIN_PROMPT_PX) -> DataFrame:
    """Views in which each prompt has a usable mask."""
    sizes = mask_sizes(runs, [*keys, view, prompt]).where(F.col("n_px") >= min_px)
    return sizes.groupBy(*keys, prompt).agg(F.count("*").alias("hits"))


def min_view_hits(hits: DataFrame, least: int = k.MIN_CHILD_VIEWS) -> DataFrame:
    return hits.where(F.col("hits") >= least)


def hit_map(hits: DataFrame, views: DataFrame, keys: list[str], prompt: str) -> DataFrame:
    """Map of prompt to hits per key, and how many views have any mask.

    The map has one entry per prompt term of an object, a handful by construction.
    """
    m = hits.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col(prompt), F.col("hits"))))).alias("per_prompt_hits"))
    return m.join(views, keys, "left")


def pack_runs(runs: DataFrame, keys: list[str], tile: int) -> DataFrame:
    """Runs cut at tile borders, so that a pixel meets only the runs of its tile."""
    out = runs.withColumn("_t", F.explode(F.sequence(F.floor(F.col("x0") / tile), F.floor(F.col("x1") / tile))))
    return out.select(*keys, "y", F.col("_t").cast("int").alias("tile"),
                      F.greatest(F.col("x0"), F.col("_t") * tile).cast("int").alias("x0"),
                      F.least(F.col("x1"), (F.col("_t") + 1) * tile - 1).cast("int").alias("x1"))
