"""Robust boxes, camera frames and room bounds, as grouped aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as k
from ..functions import geometry as g
from ..staging import small, staged_small
from .quantiles import axis_percentiles, percentiles
from .voxels import exact_mean


def _spread(hi: str, lo: str) -> dict[str, Column]:
    return {f"span_{a}": F.col(f"{a}_{hi}") - F.col(f"{a}_{lo}") for a in "xyz"}


def _largest(*cols: str) -> Column:
    return F.greatest(*[F.col(c) for c in cols])


def robust_aabb(df: DataFrame, keys: list[str]) -> DataFrame:
    """p5..p95 box and its volume."""
    p = axis_percentiles(df, keys, [5.0, 95.0])
    box = {f"{a}_{n}": F.col(f"{a}_p{q}") for a in "xyz" for n, q in (("min", 5), ("max", 95))}
    out = p.select(*keys, *[c.alias(n) for n, c in box.items()])
    return out.withColumn("volume", (F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min"))
                          * (F.col("z_max") - F.col("z_min")))


def tight_aabb(df: DataFrame, keys: list[str], pad: float = k.CHILD_BOX_PAD) -> DataFrame:
    """p2..p98 box grown by a margin."""
    p = axis_percentiles(df, keys, [2.0, 98.0])
    return p.select(*keys, *[(F.col(f"{a}_p2") - pad).alias(f"{a}_min") for a in "xyz"],
                    *[(F.col(f"{a}_p98") + pad).alias(f"{a}_max") for a in "xyz"])


def median_frame(df: DataFrame, keys: list[str], labels: DataFrame | None = None) -> DataFrame:
    """Median centre, p5..p95 spans and extent.

    With ``labels`` (keys, label), floor lamps take the true vertical range and
    a tighter margin.
    """
    p = axis_percentiles(df, keys, [5.0, 50.0, 95.0])
    out = p.withColumns({**{f"c_{a}": F.col(f"{a}_p50") for a in "xyz"}, **_spread("p95", "p5")})
    if labels is not None:
        from ..functions.labels import is_floor_lamp
        lamps = labels.where(is_floor_lamp(F.col("label"))).select(*keys)
        tall = df.join(small(lamps), keys, "left_semi").groupBy(*keys).agg(
            F.min("y").alias("_lo"), F.max("y").alias("_hi"))
        out = out.join(staged_small(tall), keys, "left").withColumns({
            "c_y": F.when(F.col("_lo").isNotNull(), (F.col("_lo") + F.col("_hi")) / 2.0).otherwise(F.col("c_y")),
            "span_y": F.coalesce(F.col("_hi") - F.col("_lo"), F.col("span_y")),
            "margin": F.when(F.col("_lo").isNotNull(), k.MARGIN_LAMP).otherwise(k.MARGIN_ORBIT)})
    out = out.withColumn("extent", _largest("span_x", "span_y", "span_z"))
    extra = ["margin"] if labels is not None else []
    return out.select(*keys, "c_x", "c_y", "c_z", "span_x", "span_y", "span_z", "extent", *extra)


def _range(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[f(a).alias(f"{a}_{n}") for a in "xyz"
                                   for n, f in (("min", F.min), ("max", F.max))])


def full_extent(df: DataFrame, keys: list[str]) -> DataFrame:
    """Median centre with the raw range, so that no splat leaves the frame."""
    med = axis_percentiles(df, keys, [50.0])
    r = _range(df, keys).withColumns(_spread("max", "min"))
    out = r.join(small(med), keys).withColumn("extent", _largest("span_x", "span_y", "span_z"))
    return out.select(*keys, *[F.col(f"{a}_p50").alias(f"c_{a}") for a in "xyz"], "extent")


def display_frame(df: DataFrame, keys: list[str], fov: float = k.FOV,
                  locked: DataFrame | None = None) -> DataFrame:
    """p2..p98 middle and distance; a locked frame for the key wins."""
    from .cameras import orbit_distance
    p = axis_percentiles(df, keys, [2.0, 98.0])
    out = p.withColumns({**{f"c_{a}": (F.col(f"{a}_p2") + F.col(f"{a}_p98")) * 0.5 for a in "xyz"},
                         **_spread("p98", "p2")})
    out = out.withColumn("extent", F.greatest(_largest("span_x", "span_y", "span_z"), F.lit(0.15)))
    out = out.withColumn("distance", orbit_distance(F.col("extent"), k.MARGIN_DISPLAY, fov) + 0.5)
    names = ["c_x", "c_y", "c_z", "distance"]
    if locked is not None:
        lk = locked.select(*keys, *[F.col(n).alias(f"_{n}") for n in names])
        out = out.join(small(lk), keys, "left").withColumns(
            {n: F.coalesce(F.col(f"_{n}"), F.col(n)) for n in names})
    return out.select(*keys, *names, "extent")


def _topdown(out: DataFrame, keys: list[str], y: str, distance: Column) -> DataFrame:
    return out.withColumn("distance", distance).select(
        *keys, F.col("_cx").alias("eye_x"), (F.col(y) - F.col("distance")).alias("eye_y"),
        F.col("_cz").alias("eye_z"), (F.col("_cx") + 0.001).alias("tgt_x"), F.col(y).alias("tgt_y"),
        F.col("_cz").alias("tgt_z"), "distance")


def _fit(ext: Column, margin: float, fov: float, aspect: float | None = None) -> Column:
    tan = math.tan(math.radians(fov / 2))
    return ext * margin / (2 * tan * aspect if aspect else 2 * tan)


def topdown_camera(df: DataFrame, keys: list[str], w: int = 3840, h: int = 2160) -> DataFrame:
    """View from above framing p15..p85; up is (0, 0, -1)."""
    p = percentiles(df, keys, {a: F.col(a) for a in "xyz"},
                    [("x_lo", "x", 15.0), ("x_hi", "x", 85.0), ("z_lo", "z", 15.0), ("z_hi", "z", 85.0),
                     ("y_at", "y", 85.0)])
    out = p.withColumns({"_cx": (F.col("x_lo") + F.col("x_hi")) / 2, "_cz": (F.col("z_lo") + F.col("z_hi")) / 2})
    d = F.greatest(_fit(F.col("x_hi") - F.col("x_lo"), k.MARGIN_TOPDOWN, k.FOV, w / h),
                   _fit(F.col("z_hi") - F.col("z_lo"), k.MARGIN_TOPDOWN, k.FOV))
    return _topdown(out, keys, "y_at", d)


def topdown_frame_full(df: DataFrame, keys: list[str], w: int = 1920, h: int = 1080) -> DataFrame:
    """View from above framing the raw range, at least 1 m away."""
    out = _range(df, keys).withColumns({
        "_cx": (F.col("x_min") + F.col("x_max")) / 2, "_cz": (F.col("z_min") + F.col("z_max")) / 2})
    d = F.greatest(_fit(F.col("x_max") - F.col("x_min"), k.MARGIN_DISPLAY, k.FOV, w / h),
                   _fit(F.col("z_max") - F.col("z_min"), k.MARGIN_DISPLAY, k.FOV), F.lit(1.0))
    return _topdown(out, keys, "y_max", d)


def perpendicular_frames(df: DataFrame, keys: list[str], yaws: list[int] = k.ART_YAWS,
                         w: int = 1920, h: int = 1080, fov: float = 50.0) -> DataFrame:
    """Per yaw: half widths seen from that side and the distance that fits them."""
    med = small(axis_percentiles(df, keys, [50.0]))
    rel = df.select(*keys, "x", "y", "z").join(med, keys).withColumns(
        {f"_{a}": F.col(a) - F.col(f"{a}_p50") for a in "xyz"})
    measures: dict[str, Column] = {"v": F.col("_y")}
    want: list[tuple[str, str, float]] = [("v_lo", "v", 5.0), ("v_hi", "v", 95.0)]
    for yaw in yaws:
        r = math.radians(yaw)
        measures[f"u{yaw}"] = F.col("_x") * F.lit(math.cos(r)) - F.col("_z") * F.lit(math.sin(r))
        want += [(f"u_lo_{yaw}", f"u{yaw}", 5.0), (f"u_hi_{yaw}", f"u{yaw}", 95.0)]
    p = percentiles(rel, keys, measures, want).join(med, keys)
    tan = math.tan(math.radians(fov / 2))
    views = p.withColumn("_v", F.explode(F.array(*[F.struct(
        F.lit(yaw).alias("yaw"), F.lit(math.sin(math.radians(yaw))).alias("s"),
        F.lit(math.cos(math.radians(yaw))).alias("c"),
        F.greatest(F.abs(F.col(f"u_lo_{yaw}")), F.abs(F.col(f"u_hi_{yaw}"))).alias("u_half"))
        for yaw in yaws])))
    views = views.withColumns({"yaw": F.col("_v.yaw"), "u_half": F.col("_v.u_half"),
                               "v_half": F.greatest(F.abs("v_lo"), F.abs("v_hi"))})
    views = views.withColumn("distance", F.greatest(
        F.col("u_half") * k.MARGIN_ART / (tan * (w / h)), F.col("v_half") * k.MARGIN_ART / tan, F.lit(0.5)))
    return views.select(
        *keys, "yaw", "u_half", "v_half", "distance",
        (F.col("x_p50") + F.col("distance") * F.col("_v.s")).alias("eye_x"), F.col("y_p50").alias("eye_y"),
        (F.col("z_p50") + F.col("distance") * F.col("_v.c")).alias("eye_z"),
        *[F.col(f"{a}_p50").alias(f"tgt_{a}") for a in "xyz"])


def inside_views(df: DataFrame, keys: list[str]) -> DataFrame:
    """Four headings from the middle of the room at eye height, and one from above."""
    p = percentiles(df, keys, {a: F.col(a) for a in "xyz"},
                    [("c_x", "x", 50.0), ("c_z", "z", 50.0), ("floor_y", "y", 95.0)])
    p = p.withColumn("e_y", F.col("floor_y") - k.EYE_HEIGHT_M)
    heads = [("y0", 0.0, 1.0), ("y90", -1.0, 0.0), ("y180", 0.0, -1.0), ("y270", 1.0, 0.0)]
    view = lambda tag, ey, tx, ty, tz: F.struct(
        F.lit(tag).alias("tag"), F.col("c_x").alias("eye_x"), ey.alias("eye_y"), F.col("c_z").alias("eye_z"),
        tx.alias("tgt_x"), ty.alias("tgt_y"), tz.alias("tgt_z"))
    views = [view(t, F.col("e_y"), F.col("c_x") + F.lit(x * 5.0), F.col("e_y"), F.col("c_z") + F.lit(z * 5.0))
             for t, x, z in heads]
    views.append(view("topdown", F.col("e_y") - 4.0, F.col("c_x") + 0.001, F.col("floor_y"), F.col("c_z")))
    return p.select(*keys, F.explode(F.array(*views)).alias("_v")).select(*keys, "_v.*")


def front_camera(df: DataFrame, keys: list[str], yaw_deg: float = 0.0, orbit_m: float = 0.0,
                 pan_m: float = 0.0, lift_m: float = 0.0, margin: float = 2.6, fov: float = 35.0,
                 pitch_deg: float = 12.0, w: int = 1920, h: int = 1080) -> DataFrame:
    """View of each object from the room's middle, slightly raised."""
    p = axis_percentiles(df, keys, [2.0, 98.0])
    room = staged_small(df.groupBy(keys[0]).agg(
        *[exact_mean(a).alias(f"room_{a}") for a in "xz"]))
    out = p.join(room, keys[0]).withColumns({
        **{f"tgt_{a}": (F.col(f"{a}_p2") + F.col(f"{a}_p98")) / 2 for a in "xyz"}, **_spread("p98", "p2")})
    diag = F.sqrt(F.col("span_x") * F.col("span_x") + F.col("span_z") * F.col("span_z"))
    fit = F.greatest(diag / F.lit(w / h), F.abs("span_y")) * margin
    out = out.withColumn("distance", fit / (2 * math.tan(math.radians(fov / 2))))
    ax, az = F.col("tgt_x") - F.col("room_x"), F.col("tgt_z") - F.col("room_z")
    n = F.sqrt(ax * ax + az * az)
    dx, dz = F.when(n < 1e-6, 0.0).otherwise(ax / n), F.when(n < 1e-6, -1.0).otherwise(az / n)
    c, s = math.cos(math.radians(yaw_deg)), math.sin(math.radians(yaw_deg))
    out = out.withColumns({"dx": c * dx - s * dz, "dz": s * dx + c * dz})
    d = F.col("distance")
    side = orbit_m - pan_m
    return out.select(
        *keys, (F.col("tgt_x") - F.col("dx") * d + side * F.col("dz")).alias("eye_x"),
        (F.col("tgt_y") - math.tan(math.radians(pitch_deg)) * d - lift_m).alias("eye_y"),
        (F.col("tgt_z") - F.col("dz") * d - side * F.col("dx")).alias("eye_z"),
        (F.col("tgt_x") - pan_m * F.col("dz")).alias("tgt_x"), "tgt_y",
        (F.col("tgt_z") + pan_m * F.col("dx")).alias("tgt_z"), "distance")


def axis_extents(df: DataFrame, keys: list[str]) -> DataFrame:
    p = axis_percentiles(df, keys, [15.0, 85.0])
    return p.select(*keys, *[(F.col(f"{a}_p85") - F.col(f"{a}_p15")).alias(f"{a}_ext") for a in "xyz"])


def vertical_axis(df: DataFrame, keys: list[str]) -> DataFrame:
    """The axis of the smallest p15..p85 extent; x before y before z on ties."""
    e = axis_extents(df, keys)
    first = F.array_min(F.array(*[F.struct(F.col(f"{a}_ext").alias("ext"), F.lit(i).alias("i"), F.lit(a).alias("axis"))
                                  for i, a in enumerate("xyz")]))
    return e.withColumn("axis", first["axis"])


def axis_assert(df: DataFrame, keys: list[str]) -> DataFrame:
    """Whether y is vertical, which axis to turn from if not, and the 90 degree preference."""
    v = vertical_axis(df, keys)
    return v.withColumns({"y_vertical": F.col("axis") == "y",
                          "turn_from": F.when(F.col("axis") != "y", F.col("axis")),
                          "turn_90": F.col("z_ext") > F.col("x_ext")})


def room_bounds(df: DataFrame, keys: list[str]) -> DataFrame:
    """p15..p85 floor rectangle, its centre, the mean height and the eye height."""
    p = percentiles(df, keys, {a: F.col(a) for a in "xz"},
                    [("xb_min", "x", 15.0), ("xb_max", "x", 85.0), ("zb_min", "z", 15.0), ("zb_max", "z", 85.0)])
    mean = df.groupBy(*keys).agg(exact_mean("y").alias("cy"))
    out = p.join(staged_small(mean), keys)
    return out.withColumns({"cx": (F.col("xb_min") + F.col("xb_max")) / 2, "cz": (F.col("zb_min") + F.col("zb_max")) / 2,
                            "eye_y": F.col("cy") - 1.0})


def diorama_cameras(bounds: DataFrame, keys: list[str], back: float = k.DIORAMA_BACK_M) -> DataFrame:
    """Four views into the quadrants of a room."""
    c = {n: F.col(n) for n in ("cx", "cz", "xb_min", "xb_max", "zb_min", "zb_max", "eye_y")}
    east, west = (c["cx"] + c["xb_max"]) / 2, (c["xb_min"] + c["cx"]) / 2
    view = lambda q, x, ez, tz: F.struct(
        F.lit(q).alias("quadrant"), x.alias("eye_x"), c["eye_y"].alias("eye_y"), ez.alias("eye_z"),
        x.alias("tgt_x"), c["eye_y"].alias("tgt_y"), tz.alias("tgt_z"))
    quads = F.array(view("NE", east, c["cz"] - back, c["zb_max"]), view("NW", west, c["cz"] - back, c["zb_max"]),
                    view("SE", east, c["cz"] + back, c["zb_min"]), view("SW", west, c["cz"] + back, c["zb_min"]))
    out = bounds.select(*keys, F.explode(quads).alias("_v")).select(*keys, "_v.*")
    return out.withColumn("target_dist", F.abs(F.col("tgt_z") - F.col("eye_z")))


def in_quadrant(quadrant: Column, x: Column, z: Column, cx: Column, cz: Column) -> Column:
    """Both sides of a dividing line count as inside."""
    return (F.when(quadrant.isin("NE", "SE"), x >= cx).otherwise(x <= cx)
            & F.when(quadrant.isin("NE", "NW"), z >= cz).otherwise(z <= cz))


def with_quadrants(df: DataFrame, bounds: DataFrame, keys: list[str] = ["scene_id"]) -> DataFrame:
    """A row per quadrant a splat lies in; one on a line is in several."""
    x, z, cx, cz = F.col("x"), F.col("z"), F.col("_cx"), F.col("_cz")
    b = bounds.select(*keys, F.col("cx").alias("_cx"), F.col("cz").alias("_cz"))
    hits = F.array_compact(F.array(*[F.when(in_quadrant(F.lit(q), x, z, cx, cz), q) for q in ("NE", "NW", "SE", "SW")]))
    return df.join(small(b), keys).withColumn("quadrant", F.explode(hits)).drop("_cx", "_cz")
