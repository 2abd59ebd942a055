"""Per-splat attributes as added columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SH_C0
from ..functions import geometry as g


def linear_scales(df: DataFrame) -> DataFrame:
    sx, sy, sz = [F.exp(c) for c in g.cols(*g.SCALES)]
    return df.withColumns({"sx": sx, "sy": sy, "sz": sz,
                           "max_scale": F.exp(g.max_log_scale()),
                           "min_scale": F.exp(g.min_log_scale())})


def dc_colour(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zip("rgb", g.rgb())))


def encoded(df: DataFrame) -> DataFrame:
    """The eight byte columns of a viewer record."""
    out = {f"c_{n}": g.to_byte(c * 255) for n, c in zip("rgb", g.rgb())}
    out["c_a"] = g.to_byte(g.alpha() * 255)
    for n, q in zip("wxyz", g.unit_quaternion()):
        out[f"q_{n}"] = g.to_byte(q * 128 + 128)
    return df.withColumns(out)


def point_colour(df: DataFrame) -> DataFrame:
    """Byte colour from f_dc, else from red/green/blue bytes, else mid grey."""
    have = set(df.columns)
    if set(g.DC) <= have:
        parts = [F.least(F.greatest(F.lit(0.5) + F.lit(SH_C0) * c, F.lit(0.0)), F.lit(1.0))
                 for c in g.cols(*g.DC)]
    elif {"red", "green", "blue"} <= have:
        parts = [c / F.lit(255.0) for c in g.cols("red", "green", "blue")]
    else:
        parts = [F.lit(0.7)] * 3
    return df.withColumns({f"p_{n}": (p * F.lit(255.0)).cast("int") for n, p in zip("rgb", parts)})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Add the optional columns a scan may lack, with their neutral values."""
    import math
    neutral = {**{c: math.log(0.01) for c in g.SCALES}, **{c: 0.0 for c in g.DC},
               "opacity": float("inf"), "rot_0": 1.0, "rot_1": 0.0, "rot_2": 0.0, "rot_3": 0.0}
    missing = {c: F.lit(v).cast("double") for c, v in neutral.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def normals(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zip(["nx", "ny", "nz"], g.splat_normal())))


def plane_columns(df: DataFrame, planes: DataFrame) -> DataFrame:
    """Signed distance to the scene's floor and alignment of the splat with it."""
    from ..staging import computed, small
    return computed(df.join(small(planes), "scene_id"), {"sd": g.plane_distance(), "align": g.plane_alignment()})


def to_y_down(df: DataFrame) -> DataFrame:
    """Turn a z-up table into y-down, positions and rotations."""
    import math
    x, y, z = g.z_up_to_y_down(*g.cols("x", "y", "z"))
    s = F.lit(math.sqrt(0.5))
    q = g.quaternion_product([s, s, F.lit(0.0), F.lit(0.0)], g.cols(*g.ROT))
    return df.withColumns({"x": x, "y": y, "z": z, **dict(zip(g.ROT, q))})


def turn_about_y(df: DataFrame, angle_deg) -> DataFrame:
    """Turn positions and rotations about the vertical axis by a column or number of degrees."""
    a = F.radians(angle_deg if not isinstance(angle_deg, (int, float)) else F.lit(float(angle_deg)))
    x, y, z = g.yaw_turn(*g.cols("x", "y", "z"), F.cos(a), F.sin(a))
    half = a / 2
    q = g.quaternion_product([F.cos(half), F.lit(0.0), F.sin(half), F.lit(0.0)], g.cols(*g.ROT))
    return df.withColumns({"x": x, "y": y, "z": z, **dict(zip(g.ROT, q))})


def turn_for_yaw(yaw_deg):
    """Angle to turn the points by for a chosen camera yaw; null when it is negligible."""
    angle = -yaw_deg
    return F.when(F.abs(angle) >= 0.01, angle)
