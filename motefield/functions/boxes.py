"""Column expressions for pixel boxes ``x0 y0 x1 y1``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{n}") for n in ("x0", "y0", "x1", "y1"))


def as_columns(b: Box, prefix: str = "") -> dict[str, Column]:
    return dict(zip([f"{prefix}x0", f"{prefix}y0", f"{prefix}x1", f"{prefix}y1"], b))


def cut(v: Column) -> Column:
    """Drop the fraction, toward zero."""
    return v.cast("int")


def to_pixels(b: Box, w: Column, h: Column) -> Box:
    """0..1000 coordinates to pixels."""
    x0, y0, x1, y1 = b
    return (cut(x0 * w / 1000), cut(y0 * h / 1000), cut(x1 * w / 1000), cut(y1 * h / 1000))


def pad_xy(b: Box, px: Column, py: Column, w: Column, h: Column) -> Box:
    x0, y0, x1, y1 = b
    zero = F.lit(0)
    return (F.greatest(zero, cut(x0 - px)), F.greatest(zero, cut(y0 - py)),
            F.least(w.cast("int"), cut(x1 + px)), F.least(h.cast("int"), cut(y1 + py)))


def pad(b: Box, share: Column | float, w: Column, h: Column) -> Box:
    """Grow each side by a share of the box, clamp to the image, drop fractions."""
    share = share if isinstance(share, Column) else F.lit(float(share))
    x0, y0, x1, y1 = b
    return pad_xy(b, (x1 - x0) * share, (y1 - y0) * share, w, h)


def pad_long_short(b: Box, long_share: Column, short_share: Column, w: Column, h: Column) -> Box:
    """Different shares for the longer and the shorter side; width is long on ties."""
    x0, y0, x1, y1 = b
    bw, bh = x1 - x0, y1 - y0
    wide = bw >= bh
    return pad_xy(b, bw * F.when(wide, long_share).otherwise(short_share),
                  bh * F.when(wide, short_share).otherwise(long_share), w, h)


def pad_with_top(b: Box, share: float, top: float, w: Column, h: Column) -> Box:
    """``pad`` plus extra height above the box."""
    x0, y0, x1, y1 = b
    px, py, extra = (x1 - x0) * F.lit(share), (y1 - y0) * F.lit(share), (y1 - y0) * F.lit(top)
    zero = F.lit(0)
    return (F.greatest(zero, cut(x0 - px)), F.greatest(zero, cut(y0 - py - extra)),
            F.least(w.cast("int"), cut(x1 + px)), F.least(h.cast("int"), cut(y1 + py)))


def pad_free(b: Box, share: float) -> Box:
    """Grow without clamping."""
    x0, y0, x1, y1 = b
    px, py = (x1 - x0) * F.lit(share), (y1 - y0) * F.lit(share)
    return cut(x0 - px), cut(y0 - py), cut(x1 + px), cut(y1 + py)


def crop(b: Box, side: float, headroom_m: float, f: Column, depth: Column, w: Column, h: Column) -> Box:
    """Crop rectangle: slack on every side and a metric headroom above."""
    x0, y0, x1, y1 = b
    bw, bh = F.greatest(F.lit(1), x1 - x0), F.greatest(F.lit(1), y1 - y0)
    slack = cut(F.greatest(bw, bh) * F.lit(side))
    top = cut(F.lit(headroom_m) * f / F.greatest(depth, F.lit(0.1)))
    zero = F.lit(0)
    return (F.greatest(zero, x0 - slack), F.greatest(zero, y0 - top - slack),
            F.least(w.cast("int"), x1 + slack), F.least(h.cast("int"), y1 + slack))


def area(b: Box) -> Column:
    x0, y0, x1, y1 = b
    return (x1 - x0) * (y1 - y0)


def clamped_area(b: Box) -> Column:
    x0, y0, x1, y1 = b
    return F.greatest(F.lit(0), x1 - x0) * F.greatest(F.lit(0), y1 - y0)


def overlap(a: Box, b: Box) -> Column:
    iw = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    ih = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return iw * ih


def iou(a: Box, b: Box, min_area: int = 0) -> Column:
    """Intersection over union; ``min_area=1`` is the variant that floors both areas at 1."""
    inter = overlap(a, b)
    sa = F.greatest(F.lit(min_area), area(a)) if min_area else clamped_area(a)
    sb = F.greatest(F.lit(min_area), area(b)) if min_area else clamped_area(b)
    union = sa + sb - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def contains(b: Box, u: Column, v: Column) -> Column:
    return (u >= b[0]) & (u <= b[2]) & (v >= b[1]) & (v <= b[3])
