"""Column expressions for splats, cameras and planes.  y points down throughout."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BRIGHTNESS_C, SH_C0

SCALES = ["scale_0", "scale_1", "scale_2"]
DC = ["f_dc_0", "f_dc_1", "f_dc_2"]
ROT = ["rot_0", "rot_1", "rot_2", "rot_3"]

Vec = tuple[Column, Column, Column]


def cols(*names: str) -> list[Column]:
    return [F.col(n).cast("double") for n in names]


# --- attributes ------------------------------------------------------------

def max_log_scale() -> Column:
    return F.greatest(*cols(*SCALES))


def min_log_scale() -> Column:
    return F.least(*cols(*SCALES))


def anisotropy(eps: float) -> Column:
    """Longest over shortest axis, the shortest clamped at ``eps`` metres."""
    return F.exp(max_log_scale()) / F.greatest(F.exp(min_log_scale()), F.lit(eps))


def anisotropy_above(limit: float, eps: float) -> Column:
    """``anisotropy(eps) > limit`` decided on the logarithms."""
    return max_log_scale() - F.greatest(min_log_scale(), F.lit(math.log(eps))) > F.lit(math.log(limit))


def rgb() -> list[Column]:
    return [F.lit(0.5) + F.lit(SH_C0) * c for c in cols(*DC)]


def brightness() -> Column:
    a, b, c = [v * F.lit(BRIGHTNESS_C) + F.lit(0.5) for v in cols(*DC)]
    return (a + b + c) / F.lit(3.0)


def alpha() -> Column:
    """Sigmoid of the logit, its argument held within 30; single precision as stored."""
    o = F.col("opacity").cast("double")
    a = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(o, F.lit(-30.0)), F.lit(30.0))))
    return a.cast("float").cast("double")


def unit_quaternion() -> list[Column]:
    w, x, y, z = cols(*ROT)
    n = F.sqrt(w * w + x * x + y * y + z * z) + F.lit(1e-8)
    return [w / n, x / n, y / n, z / n]


def to_byte(v: Column) -> Column:
    """Clip to 0..255, then drop the fraction."""
    return F.least(F.greatest(v, F.lit(0.0)), F.lit(255.0)).cast("int")


def splat_normal() -> list[Column]:
    """Axis of the smallest scale, turned by the splat's rotation, as a unit vector."""
    w, x, y, z = cols(*ROT)
    n = F.greatest(F.sqrt(w * w + x * x + y * y + z * z), F.lit(1e-9))
    w, x, y, z = w / n, x / n, y / n, z / n
    two, one = F.lit(2.0), F.lit(1.0)
    axes = [
        [one - two * (y * y + z * z), two * (x * y + w * z), two * (x * z - w * y)],
        [two * (x * y - w * z), one - two * (x * x + z * z), two * (y * z + w * x)],
        [two * (x * z + w * y), two * (y * z - w * x), one - two * (x * x + y * y)]]
    s0, s1, s2 = cols(*SCALES)
    first, second = (s0 <= s1) & (s0 <= s2), s1 <= s2
    v = [F.when(first, a).when(second, b).otherwise(c) for a, b, c in zip(*axes)]
    length = F.greatest(F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2]), F.lit(1e-9))
    return [c / length for c in v]


# --- planes ----------------------------------------------------------------

def plane_norm(a: Column, b: Column, c: Column) -> Column:
    return F.sqrt(a * a + b * b + c * c)


def plane_distance() -> Column:
    """Signed distance to ``a b c d``; positive is below the floor."""
    a, b, c, d = cols("a", "b", "c", "d")
    x, y, z = cols("x", "y", "z")
    return (a * x + b * y + c * z + d) / plane_norm(a, b, c)


def plane_alignment() -> Column:
    """Cosine between the splat's normal and the plane's, without its sign.

    The dot product of the rotated shortest axis with the plane normal, written
    on the raw quaternion so that the expression stays small when Spark pushes
    a filter on it down to the scan.
    """
    a, b, c = cols("a", "b", "c")
    w, x, y, z = cols(*ROT)
    n2 = F.greatest(w * w + x * x + y * y + z * z, F.lit(1e-18))
    two = F.lit(2.0)
    d0 = a + two * (b * (x * y + w * z) + c * (x * z - w * y) - a * (y * y + z * z)) / n2
    d1 = b + two * (a * (x * y - w * z) + c * (y * z + w * x) - b * (x * x + z * z)) / n2
    d2 = c + two * (a * (x * z + w * y) + b * (y * z - w * x) - c * (x * x + y * y)) / n2
    s0, s1, s2 = cols(*SCALES)
    d = F.when((s0 <= s1) & (s0 <= s2), d0).when(s1 <= s2, d1).otherwise(d2)
    return F.abs(d) / plane_norm(a, b, c)


# --- voxels and turns ------------------------------------------------------

def voxel(size: float, prefix: str = "v") -> list[Column]:
    return [F.floor(F.col(a).cast("double") / F.lit(size)).alias(f"{prefix}{a}") for a in "xyz"]


def z_up_to_y_down(x: Column, y: Column, z: Column) -> Vec:
    return x, -z, y


def yaw_turn(x: Column, y: Column, z: Column, cos_a: Column, sin_a: Column) -> Vec:
    return cos_a * x + sin_a * z, y, -sin_a * x + cos_a * z


def quaternion_product(p: list[Column], q: list[Column]) -> list[Column]:
    pw, px, py, pz = p
    qw, qx, qy, qz = q
    return [pw * qw - px * qx - py * qy - pz * qz,
            pw * qx + px * qw + py * qz - pz * qy,
            pw * qy - px * qz + py * qw + pz * qx,
            pw * qz + px * qy - py * qx + pz * qw]


# --- vectors ---------------------------------------------------------------

def cross(a: Vec, b: Vec) -> Vec:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def length(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vec) -> Vec:
    n = length(a)
    return a[0] / n, a[1] / n, a[2] / n


# --- cameras ---------------------------------------------------------------

def look_at(eye: Vec, target: Vec, up: Vec) -> dict[str, Column]:
    """World to camera: rows right, minus true up, minus forward."""
    fwd = unit((target[0] - eye[0], target[1] - eye[1], target[2] - eye[2]))
    right = unit(cross(fwd, up))
    true_up = cross(right, fwd)
    rows = [right, tuple(-c for c in true_up), tuple(-c for c in fwd)]
    out = {}
    for i, r in enumerate(rows):
        for j in range(3):
            out[f"r{i}{j}"] = r[j]
        out[f"t{i}"] = -dot(r, eye)
    return out


def focal(height: Column, fov_deg: Column) -> Column:
    return F.lit(0.5) * height / F.tan(F.lit(0.5) * F.radians(fov_deg))


def camera_space(x: Column, y: Column, z: Column, get=F.col) -> Vec:
    return tuple(get(f"r{i}0") * x + get(f"r{i}1") * y + get(f"r{i}2") * z + get(f"t{i}")
                 for i in range(3))
