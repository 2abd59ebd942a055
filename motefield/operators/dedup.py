"""Greedy de-duplication of overlapping boxes, spread over the cluster.

Walking boxes in order and dropping each that overlaps a kept one equals this:
a box is kept when none of its earlier overlapping boxes is kept.  So each box is
the conjunction of conditions on earlier boxes, and a box with a single condition
left is that earlier box, or its opposite.  Rounds replace such boxes wherever they
are named, which halves every chain; no group of boxes is ever gathered in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..staging import stage

_TILE = 64
_BOX = ["x0", "y0", "x1", "y1"]


def _edges(boxes: DataFrame, keys: list[str], limit: float, min_area: int) -> DataFrame:
    """Pairs (earlier ``a``, later ``b``) with IoU at or above the limit."""
    size = F.floor(F.log(bx.area(bx.box()).cast("double")) / F.lit(math.log(1 / limit))).cast("int")
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / _TILE), F.floor(F.col(hi) / _TILE))
    cells = boxes.withColumn("_size", size).withColumn("_tx", F.explode(span("x0", "x1"))).withColumn(
        "_ty", F.explode(span("y0", "y1")))
    near = cells.withColumn("_size", F.explode(F.array(F.col("_size") - 1, F.col("_size"), F.col("_size") + 1)))
    a, b = cells.alias("a"), near.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]
    same += [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_size", "_tx", "_ty")]
    first = ((F.col("a._tx") == F.greatest(F.floor(F.col("a.x0") / _TILE), F.floor(F.col("b.x0") / _TILE)))
             & (F.col("a._ty") == F.greatest(F.floor(F.col("a.y0") / _TILE), F.floor(F.col("b.y0") / _TILE))))
    over = bx.iou(tuple(F.col(f"a.{c}") for c in _BOX), tuple(F.col(f"b.{c}") for c in _BOX), min_area) >= limit
    pairs = a.join(b, [*same, F.col("a._at") < F.col("b._at")]).where(first & over)
    return pairs.select(*[F.col(f"a.{c}").alias(c) for c in keys], F.col("a._at").alias("a"), F.col("b._at").alias("b"))


def _settled(edges: DataFrame, keys: list[str]) -> DataFrame:
    """For every box of the overlap graph whether it is kept: (keys, ``b``, ``keep``).

    A row (b, a, pos) reads "b needs a kept" or, with ``pos`` false, "b needs a dropped";
    a null ``a`` is the constant ``pos``.  Each round sums up every box over its rows: a
    false constant settles it, and so does having constants alone; one condition makes it
    an alias.  Settled boxes and aliases are then put in where they are named, among the
    aliases too, so what an alias points at doubles its distance every round.  A chain of
    n overlaps takes about log2(n) rounds; only boxes that wait for several undecided
    ones at once advance a level a round.  Rows never become more.
    """
    def named(left: str, lcol: str, right: str, rcol: str) -> Column:
        out = F.col(f"{left}.{lcol}") == F.col(f"{right}.{rcol}")
        for c in keys:
            out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        return out

    later = edges.select(*keys, "b").distinct()
    roots = edges.select(*keys, "a").distinct().alias("r").join(later.alias("l"), named("r", "a", "l", "b"), "left_anti")
    nothing = F.lit(None).cast(edges.schema["a"].dataType)
    rows = stage(edges.select(*keys, "b", "a", F.lit(False).alias("pos")).unionByName(
        roots.select(*keys, F.col("a").alias("b"), nothing.alias("a"), F.lit(True).alias("pos"))))
    while not rows.where("a IS NOT NULL").isEmpty():
        constant = F.col("a").isNull()
        of = rows.groupBy(*keys, "b").agg(
            F.max(constant & ~F.col("pos")).alias("_false"), F.min("a").alias("_a"), F.max("a").alias("_z"),
            F.min(F.when(~constant, F.col("pos"))).alias("_lo"), F.max(F.when(~constant, F.col("pos"))).alias("_hi"))
        one = F.col("_a") == F.col("_z")
        wrong = F.col("_false") | F.coalesce(one & (F.col("_lo") != F.col("_hi")), F.lit(False))
        of = stage(of.select(*keys, "b", (wrong | F.col("_a").isNull() | one).alias("_single"),
                             F.when(~wrong, F.col("_a")).alias("a"), F.when(wrong, False).otherwise(F.coalesce("_lo", F.lit(True))).alias("pos")))
        single = of.where("_single").drop("_single")
        several = rows.alias("e").join(of.where("NOT _single").alias("s"), named("e", "b", "s", "b"), "left_semi")
        joined = several.unionByName(single).alias("e").join(single.alias("s"), named("e", "a", "s", "b"), "left")
        hit = F.col("s.pos").isNotNull()
        rows = stage(joined.select(*[F.col(f"e.{c}").alias(c) for c in [*keys, "b"]],
                                   F.when(hit, F.col("s.a")).otherwise(F.col("e.a")).alias("a"),
                                   F.when(hit, F.col("e.pos") == F.col("s.pos")).otherwise(F.col("e.pos")).alias("pos")))
    return rows.groupBy(*keys, "b").agg(F.min("pos").alias("keep"))


def greedy_nms(items: DataFrame, keys: list[str], order: list[Column], ident: str, limit: float,
               min_area: int = 0) -> DataFrame:
    """Items with ``kept`` and, for the dropped, ``clash``: the first kept box they overlap.

    ``order`` is the visiting order and must end in something unique.  Copies of a
    box share the fate of their first one, so they never meet pair by pair.
    Boxes without area overlap nothing and stay.
    """
    it = items.withColumn("_at", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(ident).alias("id")))
    it = stage(it)
    solid = (F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))
    firsts = it.where(solid).groupBy(*keys, *_BOX).agg(F.min("_at").alias("_at"))
    edges = stage(_edges(firsts, keys, limit, min_area))

    def eq(left: str, right: str, lcol: str, rcol: str) -> Column:
        out = F.col(f"{left}.{lcol}") == F.col(f"{right}.{rcol}")
        for c in keys:
            out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        return out

    kept = _settled(edges, keys).where("keep")
    kept_edges = edges.alias("e").join(kept.alias("l"), eq("e", "l", "a", "b"), "left_semi")
    clash = kept_edges.groupBy(*keys, "b").agg(F.min("a")["id"].alias("_clash"))
    box_of = firsts.withColumnRenamed("_at", "_first")
    on = [F.col(f"i.{c}").eqNullSafe(F.col(f"f.{c}")) for c in keys] + [F.col(f"i.{c}") == F.col(f"f.{c}") for c in _BOX]
    out = it.alias("i").join(box_of.alias("f"), on, "left").select("i.*", "f._first").alias("i")
    out = out.join(clash.alias("c"), eq("i", "c", "_first", "b"), "left").select("i.*", "c._clash")
    copy = F.coalesce(F.col("_first.id") != F.col(ident), F.lit(False)) & solid
    found = F.coalesce(F.col("_clash"), F.when(copy, F.col("_first.id")))
    return out.withColumns({"clash": found, "kept": found.isNull()}).drop("_at", "_first", "_clash")


def nms_any_label(items: DataFrame, keys: list[str], ident: str, limit: float = 0.5) -> DataFrame:
    """Largest first, whatever the label; equal areas in input order."""
    return greedy_nms(items, keys, [-bx.area(bx.box())], ident, limit, min_area=1)


def nms_same_label(items: DataFrame, keys: list[str], ident: str, limit: float = 0.9) -> DataFrame:
    """In order of arrival, only against boxes of the same canonical label."""
    return greedy_nms(items, [*keys, "canonical"], [], ident, limit)
