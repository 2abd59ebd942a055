"""Point-in-box joins: splats seen through a camera against detection boxes.

Boxes are cut into pixel tiles, so that the join is an equi-join on
(scene, view, tile) with a residual range test.  Spark broadcasts the boxes when
they are measured small and otherwise shuffles both sides by tile, where AQE can
split a crowded tile.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, LongType, StructField, StructType

from ..functions import boxes as bx
from ..staging import all_of, small, stage, staged_small
from .projection import project

TILE = 32
NEIGHBOUR_PARTS = 192
_EDGES = (4, 8, 16, 32, 64, 128)     # of tiles
_TILES_A_BOX = 8
_PACK = 256              # boxes of a tile in one array
_BAND = 64               # places along y, two a pixel, that are summed in one task


def seen(df: DataFrame, views: DataFrame, on: list[str]) -> DataFrame:
    """Splats with their pixel ``u v`` and ``front`` in each view of their scene."""
    cam = [c for c in views.columns if c in on or c in
           {"view_id", "quadrant", "f", "w", "h", *[f"r{i}{j}" for i in range(3) for j in range(3)], "t0", "t1", "t2"}]
    return project(df.join(small(views.select(*cam)), on), "float")


def _tiles(boxes: DataFrame, on: list[str], extra: list[str]) -> DataFrame:
    b = boxes.where((F.col("x1") >= F.col("x0")) & (F.col("y1") >= F.col("y0")))
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / TILE), F.floor(F.col(hi) / TILE))
    b = b.withColumn("_tx", F.explode(span("x0", "x1"))).withColumn("_ty", F.explode(span("y0", "y1")))
    return staged_small(b.select(*on, *extra, "x0", "y0", "x1", "y1", "_tx", "_ty"))


def _tiled(points: DataFrame, edge: int = TILE) -> DataFrame:
    return points.withColumns({"_tx": F.floor(F.col("u") / edge), "_ty": F.floor(F.col("v") / edge)})


def _packed(boxes: DataFrame, on: list[str], extra: list[str]) -> tuple[DataFrame, int]:
    """Boxes of each tile in arrays of about ``_PACK``, and the tiles' edge: the smallest that cuts a box into few tiles on average.

    A point reads the boxes of its tile one after the other, where a join on single boxes looks each of them up.
    """
    corners = ["x0", "y0", "x1", "y1"]
    b = stage(boxes.where((F.col("x1") >= F.col("x0")) & (F.col("y1") >= F.col("y0"))).select(*on, *extra, *corners))
    across = lambda lo, hi, e: F.floor(F.col(hi) / e) - F.floor(F.col(lo) / e) + 1
    tiles = b.agg(F.count("*"), *[F.sum((across("x0", "x1", e) * across("y0", "y1", e)).cast("double")) for e in _EDGES]).first()
    edge = next((e for e, n in zip(_EDGES, tiles[1:]) if n and n <= _TILES_A_BOX * tiles[0]), _EDGES[-1])
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / edge), F.floor(F.col(hi) / edge)))
    b = stage(b.withColumn("_tx", span("x0", "x1")).withColumn("_ty", span("y0", "y1")).withColumn("_i", F.monotonically_increasing_id()))
    there = [*on, "_tx", "_ty"]
    arrays = b.groupBy(*there).agg(F.ceil(F.count("*") / _PACK).alias("_arrays"))
    b = b.join(staged_small(arrays), there).groupBy(*there, F.pmod("_i", "_arrays").alias("_array")).agg(
        F.collect_list(F.struct(*[F.col(c).alias(f"_{c}") for c in corners], *extra)).alias("_boxes"))
    return staged_small(b.drop("_array")), edge


def in_boxes(points: DataFrame, boxes: DataFrame, on: list[str], extra: list[str],
             need_front: bool = True) -> DataFrame:
    """A row per (point, box) where the box holds the point's pixel."""
    p = points.where("front") if need_front else points
    packed, edge = _packed(boxes, on, extra)
    out = _tiled(p, edge).join(packed, [*on, "_tx", "_ty"]).select(*p.columns, F.inline("_boxes"))
    return out.where(bx.contains(bx.box("_"), F.col("u"), F.col("v"))).drop("_x0", "_y0", "_x1", "_y1")


def outside_boxes(points: DataFrame, boxes: DataFrame, on: list[str], need_front: bool = True) -> DataFrame:
    """Points no box holds."""
    p = _tiled(points).alias("p")
    b = _tiles(boxes, on, []).alias("b")
    cond = [F.col(f"p.{c}") == F.col(f"b.{c}") for c in [*on, "_tx", "_ty"]]
    hit = bx.contains(tuple(F.col(f"b.{c}") for c in ("x0", "y0", "x1", "y1")), F.col("p.u"), F.col("p.v"))
    if need_front:
        hit = hit & F.col("p.front")
    test = hit
    for c in cond:
        test = c & test
    return p.join(b, test, "left_anti").drop("_tx", "_ty")


_PLACES = 2 * TILE           # of an axis of a tile: whole coordinates are even, the open spaces between them odd
_CORNER = 1 << 6             # a corner within a tile, 0 to TILE


def _free(corners: np.ndarray, box: tuple[int, int, int, int]) -> list[tuple[int, int, int, int]]:
    """Places of a tile that lie in ``box`` and in none of ``corners``, as disjoint rectangles x0, y0, x1, y1."""
    edges = np.zeros((_PLACES + 2, _PLACES + 2), np.int32)
    cx0, cy0, cx1, cy1 = (corners // _CORNER ** i % _CORNER * 2 for i in (3, 2, 1, 0))
    for y, x, step in ((cy0, cx0, 1), (cy0, cx1 + 1, -1), (cy1 + 1, cx0, -1), (cy1 + 1, cx1 + 1, 1)):
        np.add.at(edges, (y, x), step)
    x0, y0, x1, y1 = box
    free = np.zeros((_PLACES + 1, _PLACES), bool)
    free[y0:y1 + 1, x0:x1 + 1] = edges.cumsum(0).cumsum(1)[y0:y1 + 1, x0:x1 + 1] == 0
    out, started = [], {}
    turns = np.diff(np.pad(free, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    for y in range(y0, y1 + 2):          # runs of a row go on those of the row before where they are the same
        runs = set(zip(np.flatnonzero(turns[y] > 0).tolist(), (np.flatnonzero(turns[y] < 0) - 1).tolist()))
        for r in [r for r in started if r not in runs]:
            out.append((r[0], started.pop(r), r[1], y - 1))
        for r in runs:
            started.setdefault(r, y)
    return out


def free_boxes(boxes: DataFrame, covers: DataFrame, on: list[str], item: str) -> DataFrame:
    """What ``covers`` of the same group and item leave of each box, as disjoint closed boxes.

    Boxes and covers are in whole pixels.  Covers are cut to a box's tiles, where few different
    ones are left, so a tile is one short list however many cover it.  An open side ends at the
    next double, so that ``in_boxes`` with the result gives just the rows of ``in_boxes`` and ``outside_boxes``.
    """
    keys, corners = [*on, item], ["x0", "y0", "x1", "y1"]
    valid = (F.col("x1") >= F.col("x0")) & (F.col("y1") >= F.col("y0"))
    whole = boxes.where(valid).groupBy(*keys, *corners).agg(F.count("*").alias("_n"))
    whole = stage(whole.withColumn("_box", F.monotonically_increasing_id()))
    span = lambda lo, hi: F.explode(F.sequence(F.floor(lo / TILE), F.floor(hi / TILE)))
    tile = ["_box", "_tx", "_ty"]

    def cut(df: DataFrame) -> DataFrame:
        df = df.withColumn("_tx", span(F.col("x0"), F.col("x1"))).withColumn("_ty", span(F.col("y0"), F.col("y1")))
        at = lambda c, t: F.least(F.greatest(F.col(c) - F.col(t) * TILE, F.lit(0)), F.lit(TILE)).cast("int")
        return df.withColumns({"x0": at("x0", "_tx"), "y0": at("y0", "_ty"), "x1": at("x1", "_tx"), "y1": at("y1", "_ty")})
    own = {c: f(F.col(f"b.{c}"), F.col(f"c.{c}")).alias(c) for c, f in zip(corners, (F.greatest, F.greatest, F.least, F.least))}
    met = covers.where(valid).alias("c").join(small(whole).alias("b"), all_of([F.col(f"b.{c}") == F.col(f"c.{c}") for c in keys]))
    met = cut(met.select("b._box", *own.values()).where(valid))
    code = ((F.col("x0") * _CORNER + F.col("y0")) * _CORNER + F.col("x1")) * _CORNER + F.col("y1")
    met = met.select(*tile, code.alias("_corners")).distinct().groupBy(*tile).agg(F.collect_list("_corners").alias("_corners"))
    left = cut(whole).join(met, tile, "left")
    out = StructType([*boxes.select(*keys).schema.fields, *[StructField(c, DoubleType()) for c in corners]])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            ints = np.array([batch.column(c).to_numpy(zero_copy_only=False) for c in (*corners, "_tx", "_ty", "_n")], np.int64).T
            for i, (box, covered) in enumerate(zip(ints.tolist(), batch.column("_corners"))):
                covered = np.array(covered.values, np.int64) if covered.is_valid else np.zeros(0, np.int64)
                x0, y0, x1, y1 = (2 * c for c in box[:4])
                free = _free(covered, (x0, y0, min(x1, _PLACES - 1), min(y1, _PLACES - 1)))    # the far edge is the next tile's
                found += [(a + box[4] * _PLACES, b + box[5] * _PLACES, c + box[4] * _PLACES, d + box[5] * _PLACES) for a, b, c, d in free] * box[6]
                rows += [i] * len(free) * box[6]
            places = np.array(found, np.int64).reshape(-1, 4)
            low, high = (places[:, :2] // 2).astype(float), ((places[:, 2:] + 1) // 2).astype(float)
            low = np.where(places[:, :2] % 2, np.nextafter(low, np.inf), low)
            high = np.where(places[:, 2:] % 2, np.nextafter(high, -np.inf), high)
            ends = [pa.array(c) for c in (*low.T, *high.T)]
            taken = [batch.column(c).take(pa.array(rows, pa.int64())) for c in keys]
            yield pa.RecordBatch.from_arrays([*taken, *ends], names=[*keys, *corners])

    cloudpickle.register_pickle_by_value(sys.modules[__name__])      # the code travels with the job
    return left.select(*keys, *corners, "_tx", "_ty", "_n", "_corners").mapInArrow(pieces, out)


def visual_hull(df: DataFrame, views: DataFrame, boxes: DataFrame, on: list[str], item: str = "item_id") -> DataFrame:
    """Splats in front of the camera whose pixel lies in an item's padded box."""
    return in_boxes(seen(df, views, on), boxes, on, [item]).select(*df.columns, item)


def _box_counts(points: DataFrame, boxes: DataFrame, on: list[str], item: str) -> DataFrame:
    """``n_hit`` per group and item: points in its boxes of whole corners, without a row per point and box.

    Points are counted per place, a whole coordinate or the open space between two.  A band of the
    image is summed up from its corner in one task, and a box takes four of these sums from each band that it touches.
    """
    keys, corners = [*on, item], ["x0", "y0", "x1", "y1"]
    named = all_of([F.col(c).isNotNull() for c in on])
    place = lambda c: (F.floor(c) * 2 + (c > F.floor(c)).cast("int")).cast("bigint")
    b = boxes.where(named & (F.col("x1") >= F.col("x0")) & (F.col("y1") >= F.col("y0"))).select(*keys, *[(F.col(c).cast("bigint") * 2).alias(c) for c in corners])
    b = stage(b.withColumn("_band", F.explode(F.sequence(F.floor(F.col("y0") / _BAND), F.floor(F.col("y1") / _BAND)))))
    bands = small(stage(b.select(*on, "_band").distinct().withColumn("_place", F.monotonically_increasing_id())))
    asked = b.join(bands, [*on, "_band"]).select("_place", F.lit(True).alias("_asks"), *keys, *corners)
    u, v, most = F.col("u"), F.col("v"), F.lit(2.0 ** 61)
    real = points.where(named & (F.abs(u) <= most) & (F.abs(v) <= most)).select(*on, place(u).alias("x0"), place(v).alias("y0"))
    real = real.withColumn("_band", F.floor(F.col("y0") / _BAND)).join(bands, [*on, "_band"])
    counted = real.groupBy("_place", "x0", "y0").agg(F.count("*").alias("_n")).withColumn("_asks", F.lit(False))
    both = asked.unionByName(counted, allowMissingColumns=True).repartition("_place").sortWithinPartitions("_place", "_asks")
    out = StructType([*boxes.select(*keys).schema.fields, StructField("_n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, sums = None, [], None
        for batch in batches:
            place, asks, x0, y0, x1, y1, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_place", "_asks", *corners, "_n"))
            asks = asks.astype(bool)
            starts = np.flatnonzero(np.append(True, (np.diff(place) != 0) | (asks[1:] != asks[:-1]))) if batch.num_rows else []
            for lo, hi in zip(starts, np.append(starts[1:], batch.num_rows)):
                if place[lo] != here:
                    here, held, sums = place[lo], [], None
                if not asks[lo]:
                    held.append([c[lo:hi].astype(np.int64) for c in (x0, y0, n)])
                    continue
                if sums is None:
                    xs, ys, many = (np.concatenate(c) for c in zip(*held)) if held else np.zeros((3, 0), np.int64)
                    (xs, i), (ys, j) = np.unique(xs, return_inverse=True), np.unique(ys, return_inverse=True)
                    sums = np.zeros((len(ys) + 1, len(xs) + 1), np.int64)
                    np.add.at(sums, (j + 1, i + 1), many)
                    sums = sums.cumsum(0).cumsum(1)
                left, right = np.searchsorted(xs, x0[lo:hi], "left"), np.searchsorted(xs, x1[lo:hi], "right")
                low, high = np.searchsorted(ys, y0[lo:hi], "left"), np.searchsorted(ys, y1[lo:hi], "right")
                hits = sums[high, right] - sums[low, right] - sums[high, left] + sums[low, left]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, hi - lo) for c in keys], pa.array(hits)], names=out.names)

    cloudpickle.register_pickle_by_value(sys.modules[__name__])      # the code travels with the job
    return both.mapInArrow(count, out).groupBy(*keys).agg(F.sum("_n").alias("n_hit"))


def hull_counts(df: DataFrame, views: DataFrame, boxes: DataFrame, on: list[str], item: str = "item_id") -> DataFrame:
    """Splats hit per item; items that hit nothing count 0."""
    points = df.select(*on, "x", "y", "z")
    if all(isinstance(boxes.schema[c].dataType, IntegralType) for c in ("x0", "y0", "x1", "y1")):
        hits = _box_counts(seen(points, views, on).where("front"), boxes, on, item)
    else:
        hits = visual_hull(points, views, boxes, on, item).groupBy(*on, item).agg(F.count("*").alias("n_hit"))
    return boxes.select(*on, item).join(hits, [*on, item], "left").fillna(0, ["n_hit"])


def hull_subtract(df: DataFrame, views: DataFrame, boxes: DataFrame, on: list[str]) -> DataFrame:
    """Splats outside the cone of every tight box."""
    return outside_boxes(seen(df, views, on), boxes, on).select(*df.columns)


def inside_neighbours(items: DataFrame, on: list[str], item: str, pad_share: float, w: int, h: int,
                      least: float) -> DataFrame:
    """Pairs (target, neighbour) where more than ``least`` of the neighbour's own area lies in the
    target's padded box.  Candidates meet in pixel tiles, never as all pairs of a scene."""
    b = bx.box()
    pad = items.select(*on, F.col(item).alias("target_id"), *[c.alias(n) for n, c in bx.as_columns(
        bx.pad(b, pad_share, F.lit(w), F.lit(h)), "t_").items()])
    span = lambda lo, hi: F.sequence(F.floor(lo / TILE), F.floor(hi / TILE))
    t = bx.box("t_")
    pad = pad.where((t[2] >= t[0]) & (t[3] >= t[1])).withColumn("_tx", F.explode(span(t[0], t[2]))).withColumn(
        "_ty", F.explode(span(t[1], t[3])))
    own = items.where((b[2] > b[0]) & (b[3] > b[1])).select(*on, F.col(item).alias("neighbour_id"), "x0", "y0", "x1", "y1")
    own = own.withColumn("_tx", F.explode(span(b[0], b[2]))).withColumn("_ty", F.explode(span(b[1], b[3])))
    # tiles hold very different numbers of pairs, so boxes are dealt out one by one; a coalesced few would end in long tasks
    own = own.repartition(NEIGHBOUR_PARTS, *on, "neighbour_id", "_tx", "_ty")
    pairs = staged_small(pad).join(own, [*on, "_tx", "_ty"]).where(F.col("target_id") != F.col("neighbour_id"))
    # a pair meets in every tile both boxes touch; keep the first of them
    first = ((F.col("_tx") == F.greatest(F.floor(t[0] / TILE), F.floor(b[0] / TILE)))
             & (F.col("_ty") == F.greatest(F.floor(t[1] / TILE), F.floor(b[1] / TILE))))
    ratio = bx.overlap(b, t) / bx.clamped_area(b)
    return pairs.where(first).withColumn("inside_ratio", ratio).where(F.col("inside_ratio") > least).select(
        *on, "target_id", "neighbour_id", "inside_ratio", "x0", "y0", "x1", "y1")
