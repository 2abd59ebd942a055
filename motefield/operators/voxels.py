"""Voxel statistics attached to splats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..staging import attach

VOXEL = ["vx", "vy", "vz"]


def with_voxel_count(df: DataFrame, keys: list[str], size: float, name: str = "density") -> DataFrame:
    """Number of splats in each splat's voxel."""
    v = df.select("*", *g.voxel(size))
    counts = v.groupBy(*keys, *VOXEL).agg(F.count("*").alias(name))
    return attach(v, counts, [*keys, *VOXEL], name).drop(*VOXEL)


_PART = float(1 << 20)


def exact_mean(c: str | Column) -> Column:
    """Mean that does not depend on the order of addition.

    Whole, first-20-bit and next-20-bit parts are summed as integers, so that a
    second pass over the same rows sees the same thresholds.  The sums hold for
    more than 10 ** 12 rows.
    """
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    rest = (v - F.floor(v)) * _PART
    low = (rest - F.floor(rest)) * _PART
    whole, first, second = [F.sum(F.floor(x)).cast("double") for x in (v, rest, low)]
    return (whole + (first + second / _PART) / _PART) / F.count("*")


def with_colour_distance(df: DataFrame, keys: list[str], size: float, name: str = "colour_dist") -> DataFrame:
    """Distance of a splat's f_dc to the mean of its voxel."""
    v = df.select("*", *g.voxel(size))
    means = v.groupBy(*keys, *VOXEL).agg(F.count("*").alias("_n"), *[exact_mean(c).alias(f"_m{c}") for c in g.DC])
    out = attach(v, means, [*keys, *VOXEL], "_n")
    d = [F.col(c).cast("double") - F.col(f"_m{c}") for c in g.DC]
    return out.withColumn(name, F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])).drop(
        *VOXEL, "_n", *[f"_m{c}" for c in g.DC])
