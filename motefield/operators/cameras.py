"""Camera tables: one row per view, keyed by scene (and object)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as k
from ..functions import geometry as g


def _vec(prefix: str) -> g.Vec:
    return tuple(F.col(f"{prefix}_{a}") for a in "xyz")


def add_look_at(views: DataFrame, up: tuple[float, float, float] | None = None) -> DataFrame:
    """World-to-camera columns from ``eye_*``, ``tgt_*`` and ``up_*`` (or a fixed up)."""
    u = tuple(F.lit(float(c)) for c in up) if up else _vec("up")
    return views.withColumns(g.look_at(_vec("eye"), _vec("tgt"), u))


def add_intrinsics(views: DataFrame) -> DataFrame:
    """Focal length and principal point from ``fov``, ``w`` and ``h``."""
    return views.withColumns({"f": g.focal(F.col("h"), F.col("fov")),
                              "px": F.col("w") * F.lit(0.5), "py": F.col("h") * F.lit(0.5)})


def view_tag(yaw: Column, pitch: Column) -> Column:
    return F.concat(F.lit("y"), F.rint(yaw).cast("int").cast("string"),
                    F.lit("_p"), F.rint(pitch).cast("int").cast("string"))


def _grid(views: list[tuple[str | None, float, float]]) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(t).cast("string").alias("tag"), F.lit(float(y)).alias("yaw"),
                 F.lit(float(p)).alias("pitch")) for t, y, p in views]))


def orbit(frames: DataFrame, grid: list[tuple[str | None, float, float]]) -> DataFrame:
    """A view per frame and grid entry: eye on an orbit of ``distance`` around ``c_*``."""
    out = frames.withColumn("_g", _grid(grid)).select(*frames.columns, "_g.*")
    y, p, d = F.radians("yaw"), F.radians("pitch"), F.col("distance")
    # (Rx(pitch) Ry(yaw)) transposed, applied to (0, 0, distance)
    back = (-F.cos(p) * F.sin(y) * d, F.sin(p) * d, F.cos(p) * F.cos(y) * d)
    c = _vec("c")
    return out.withColumns({
        "tag": F.coalesce(F.col("tag"), view_tag(F.col("yaw"), F.col("pitch"))),
        **{f"eye_{a}": c[i] + back[i] for i, a in enumerate("xyz")},
        **{f"tgt_{a}": c[i] for i, a in enumerate("xyz")}})


def orbit_grid() -> list[tuple[str | None, float, float]]:
    """Twelve yaws at two pitches and one from above."""
    return ([(None, y, p) for p in k.ORBIT_PITCHES for y in k.ORBIT_YAWS]
            + [("topdown", 0.0, k.TOPDOWN_PITCH)])


def tight_grid() -> list[tuple[str | None, float, float]]:
    yaws = k.ORBIT_YAWS + k.TIGHT_EXTRA_YAWS
    return ([(None, y, p) for p in k.ORBIT_PITCHES for y in yaws]
            + [("topdown", 0.0, k.TOPDOWN_PITCH)])


def ring_grid(pitches: list[float]) -> list[tuple[str | None, float, float]]:
    return [(None, y, p) for p in pitches for y in k.ORBIT_YAWS + k.TIGHT_EXTRA_YAWS]


def review_grid() -> list[tuple[str | None, float, float]]:
    return ([(f"y{y}", y, k.REVIEW_FLAT_PITCH) for y in k.REVIEW_FLAT_YAWS]
            + [(f"oblique_y{y}", y, k.REVIEW_OBLIQUE_PITCH) for y in k.REVIEW_OBLIQUE_YAWS]
            + [("topdown", 0.0, k.TOPDOWN_PITCH)])


def pitch_ring(frames: DataFrame) -> DataFrame:
    """Four pitches along the heading of the source camera ``src_eye_*`` -> ``src_tgt_*``."""
    fx, fz = F.col("src_tgt_x") - F.col("src_eye_x"), F.col("src_tgt_z") - F.col("src_eye_z")
    n = F.sqrt(fx * fx + fz * fz)
    fx, fz = fx / n, fz / n
    out = frames.where(n >= 1e-6).withColumn(
        "pitch", F.explode(F.array(*[F.lit(float(p)) for p in k.TV_PITCHES])))
    p, d = F.radians("pitch"), F.col("distance")
    return out.withColumns({
        "tag": F.concat(F.lit("p"), F.col("pitch").cast("int").cast("string")),
        "eye_x": F.col("c_x") - fx * d * F.cos(p),
        "eye_y": F.col("c_y") - F.sin(p) * d,
        "eye_z": F.col("c_z") - fz * d * F.cos(p),
        "tgt_x": F.col("c_x"), "tgt_y": F.col("c_y"), "tgt_z": F.col("c_z")})


def orbit_distance(extent: Column, margin: Column | float, fov: float = k.FOV) -> Column:
    margin = margin if isinstance(margin, Column) else F.lit(float(margin))
    return extent * margin / (F.lit(2.0) * F.lit(math.tan(math.radians(fov) / 2)))


def frustum(views: DataFrame, boxes: DataFrame) -> DataFrame:
    """Image-plane centre, half sizes and the corners of the mask box in the world."""
    from ..staging import small
    df = views.join(small(boxes), ["scene_id", "view_id"])
    eye, tgt = _vec("eye"), _vec("tgt")
    right = tuple(F.col(f"r0{i}") for i in range(3))
    up = tuple(-F.col(f"r1{i}") for i in range(3))
    d = tuple(tgt[i] - eye[i] for i in range(3))
    depth = g.length(d)
    fwd = tuple(c / F.greatest(depth, F.lit(1e-9)) for c in d)
    half_w, half_h = F.col("w") / F.lit(2.0) * depth / F.col("f"), F.col("h") / F.lit(2.0) * depth / F.col("f")
    centre = tuple(eye[i] + depth * fwd[i] for i in range(3))
    df = df.withColumns({"depth": depth, "half_w": half_w, "half_h": half_h,
                         **{f"centre_{a}": centre[i] for i, a in enumerate("xyz")}})
    two = F.lit(2.0)
    us = {"l": two * F.col("x0") / F.col("w") - 1, "r": two * F.col("x1") / F.col("w") - 1}
    vs = {"b": 1 - two * F.col("y1") / F.col("h"), "t": 1 - two * F.col("y0") / F.col("h")}
    corners = {}
    for un, u in us.items():
        for vn, v in vs.items():
            for i, a in enumerate("xyz"):
                corners[f"{un}{vn}_{a}"] = (F.col(f"centre_{a}") + u * F.col("half_w") * right[i]
                                            + v * F.col("half_h") * up[i])
    return df.withColumns(corners)
