"""Splats to pixels, one short step at a time.

``df`` holds splats joined with camera columns.  Camera space and pixel position
are each evaluated once per row, so the code Spark generates stays small enough
to be compiled, and later joins do not repeat the arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..staging import computed


def project(df: DataFrame, rule: str) -> DataFrame:
    """Adds ``depth`` and, by rule, pixels and whether the camera sees them.

    float: ``u v`` as doubles, ``front`` (camera z below 0)
    index: ``px py`` cut toward zero, ``inside`` (depth over 1 cm, in the image)
    round: ``px py`` rounded half to even, ``inside`` (camera z below 0, in the image)
    """
    cx, cy, cz = g.camera_space(*g.cols("x", "y", "z"))
    df = computed(df, {"_cx": cx, "_cy": cy, "depth": -cz})
    depth = F.col("depth")
    safe = F.greatest(depth, F.lit(1e-6)) if rule == "index" else F.when(depth > 0, depth).otherwise(F.lit(1.0))
    df = computed(df, {"u": F.col("f") * F.col("_cx") / safe + F.col("w") * F.lit(0.5),
                       "v": F.col("f") * F.col("_cy") / safe + F.col("h") * F.lit(0.5)}).drop("_cx", "_cy")
    u, v, w, h = F.col("u"), F.col("v"), F.col("w"), F.col("h")
    if rule == "float":
        return df.withColumn("front", depth > 0)
    if rule == "index":
        df = computed(df, {"inside": (depth > 0.01) & (u > -1) & (u < w) & (v > -1) & (v < h)})
        x, y = u.cast("int"), v.cast("int")
    else:
        df = computed(df, {"u": F.rint(u), "v": F.rint(v)})
        df = computed(df, {"inside": (depth > 0) & (u >= 0) & (u < w) & (v >= 0) & (v < h)})
        x, y = u.cast("int"), v.cast("int")
    return computed(df, {"px": F.when(F.col("inside"), x), "py": F.when(F.col("inside"), y)}).drop("u", "v")
