"""Exact linear-interpolated percentiles of many groups, without sorting a group.

A group may hold a third of all rows, so no task may see a whole group.  The
selection runs in narrow scans:

1. a histogram over order-preserving buckets, logarithmic in the magnitude.  Partial aggregation leaves a few thousand rows per group
   whatever the group's size; running counts tell which bucket holds each rank;
2. while a bucket that is asked for is crowded (map coordinates fall into one), it is
   cut evenly between its least and largest value, and only the parts that hold
   a rank go on;
3. the values of those parts, counted per distinct value, whose running
   counts give the two order statistics next to each requested position.

The interpolation is ``lo + (hi - lo) * fraction`` at position ``p * (n - 1)``.
Nulls, NaN and infinities are left out, of the counts too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructField, StructType

from ..staging import small, stage

_NEAR = 1e6            # magnitudes well below 1 / _NEAR share the buckets around zero
_STEPS = 1500.0        # buckets per factor e above that
_PARTS, _LEVELS = 4096, 3   # how finely and how often a crowded bucket is cut
CROWDED_ROWS = 1_000_000
_CROWDED_CONF = "motefield.crowded.rows"


def ordered_bucket(v: Column) -> Column:
    """Bucket number that never decreases as ``v`` grows; finer near zero, bounded overall.

    log1p is linear around zero and logarithmic beyond, and monotone in floating
    point as well.
    """
    return (F.signum(v) * F.floor(F.log1p(F.abs(v) * F.lit(_NEAR)) * F.lit(_STEPS))).cast("bigint")


def _joined(rows: DataFrame, targets: DataFrame, on: list[str]) -> DataFrame:
    """Rows of the buckets asked for; a null in a key is a group like any other."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in on]
    rest = [c for c in targets.columns if c not in on]
    return rows.alias("r").join(small(targets).alias("t"), same).select("r.*", *[F.col(f"t.{c}") for c in rest])


def percentiles(df: DataFrame, keys: list[str], measures: dict[str, Column],
                want: list[tuple[str, str, float]], with_count: str | None = None) -> DataFrame:
    """One row per group with a column for each ``(output, measure, percent)``.

    The result is staged, so that joins against it are planned by its real size.
    """
    names = list(measures)
    if len(names) == 1:
        long = df.select(*keys, F.lit(0).alias("_m"), measures[names[0]].cast("double").alias("_v"))
    else:
        long = df.select(*keys, F.posexplode(
            F.array(*[measures[n].cast("double") for n in names])).alias("_m", "_v"))
    long = long.where(F.abs("_v") < float("inf")).withColumn("_b", ordered_bucket(F.col("_v")))
    group = [*keys, "_m"]
    extremes = [F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")]

    by_bucket = Window.partitionBy(*group).orderBy("_b")
    whole = Window.partitionBy(*group)
    hist = (long.groupBy(*group, "_b").agg(*extremes)
            .withColumn("_end", F.sum("_n").over(
                by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("_total", F.sum("_n").over(whole))
            .withColumn("_start", F.col("_end") - F.col("_n")))

    slots = list(dict.fromkeys((names.index(m), p) for _, m, p in want))
    asks = F.array(*[F.struct(F.lit(n).alias("slot"), F.lit(i).alias("m"), F.lit(p / 100.0).alias("q"))
                     for n, (i, p) in enumerate(slots)])

    def position(ask: Column) -> Column:
        return ask["q"] * (F.col("_total") - 1)

    def ranks(ask: Column) -> tuple[Column, Column]:
        low = F.floor(position(ask))
        return low, F.least(low + 1, F.col("_total") - 1)

    def holds(rank: Column, lo: str, hi: str) -> Column:
        return (rank >= F.col(lo)) & (rank < F.col(hi))

    needed = F.exists(asks, lambda a: (a["m"] == F.col("_m")) & (
        holds(ranks(a)[0], "_start", "_end") | holds(ranks(a)[1], "_start", "_end")))
    told = [*group, "_b", "_start", "_total"]
    limit = int(df.sparkSession.conf.get(_CROWDED_CONF, str(CROWDED_ROWS)))
    crowded = (F.col("_n") > limit) & (F.col("_least") < F.col("_most"))
    targets, rows, exact = stage(hist.where(needed).select(*told, "_n", "_least", "_most")), long, []
    for level in range(_LEVELS + 1):
        more = targets.where(crowded)
        last = level == _LEVELS or more.isEmpty()
        exact.append(_joined(rows, targets if last else targets.where(~crowded), [*group, "_b"]).select(*told, "_v"))
        if last:
            break
        part = F.least(F.lit(_PARTS - 1), F.floor((F.col("_v") - F.col("_least")) / (F.col("_most") - F.col("_least")) * _PARTS))
        inner = _joined(rows, more, [*group, "_b"]).select(
            *group, (F.col("_b") * _PARTS + part).alias("_b"), "_v", F.col("_b").alias("_outer"), F.col("_start").alias("_base"), "_total")
        within = Window.partitionBy(*group, "_outer").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cut = (inner.groupBy(*group, "_outer", "_b", "_base", "_total").agg(*extremes)
               .withColumn("_end", F.col("_base") + F.sum("_n").over(within)).withColumn("_start", F.col("_end") - F.col("_n")))
        targets, rows = stage(cut.where(needed).select(*told, "_n", "_least", "_most")), inner.select(*group, "_b", "_v")

    by_value = Window.partitionBy(*group, "_b").orderBy("_v")
    found = exact[0]
    for e in exact[1:]:
        found = found.unionByName(e)
    fine = (found.groupBy(*told, "_v").agg(F.count("*").alias("_n"))
            .withColumn("_hi", F.col("_start") + F.sum("_n").over(
                by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("_lo", F.col("_hi") - F.col("_n")))

    asked = fine.withColumn("_a", F.explode(asks)).where(F.col("_a.m") == F.col("_m"))
    low, high = ranks(F.col("_a"))
    asked = asked.withColumns({"_l": F.when(holds(low, "_lo", "_hi"), F.col("_v")),
                               "_u": F.when(holds(high, "_lo", "_hi"), F.col("_v")),
                               "_p": position(F.col("_a"))})
    value = F.col("_l") + (F.col("_u") - F.col("_l")) * (F.col("_p") - F.floor("_p"))
    per_slot = (asked.where(F.col("_l").isNotNull() | F.col("_u").isNotNull())
                .groupBy(*keys, F.col("_a.slot").alias("_slot"))
                .agg(F.max("_l").alias("_l"), F.max("_u").alias("_u"), F.max("_p").alias("_p"),
                     F.max("_total").alias("_total"))
                .withColumn("_value", value))
    wide = [F.max(F.when(F.col("_slot") == slots.index((names.index(m), p)), F.col("_value"))).alias(out)
            for out, m, p in want]
    if with_count:
        wide.append(F.max("_total").alias(with_count))
    return stage(per_slot.groupBy(*keys).agg(*wide))


@dataclass(frozen=True)
class Cut:
    """One step of ``chained_cuts``: a percentile of the rows left, and the rows that it takes away.

    Rows with ``below`` go if their value is less than the percentile, rows with ``always`` wherever they are.
    """
    name: str
    percent: float
    below: Column
    always: Column


def _selected(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, below: np.ndarray, always: np.ndarray,
              shares: list[float]) -> tuple[list[float | None] | None, np.ndarray]:
    """The cuts over ascending intervals with counts per class; or, where intervals are too wide, which of them to open.

    ``n``: interval by class; ``below``, ``always``: step by class.  While a cut is known only up
    to some intervals, what is left of them lies between two counts, and so do later ranks.
    """
    least, most = n.copy(), n.copy()
    wide, open_, cuts = lo < hi, np.zeros(len(lo), bool), []
    place = np.arange(len(lo))
    for q, low, all_ in zip(shares, below, always):
        fewest, total = int(least.sum()), int(most.sum())
        if not total:
            cuts.append(None)
            continue
        first = int(np.searchsorted(np.cumsum(most.sum(1)), np.floor(q * max(fewest - 1, 0)), "right"))
        last = min(len(lo) - 1, int(np.searchsorted(np.cumsum(least.sum(1)), min(np.floor(q * (total - 1)) + 1, total - 1), "right")))
        if fewest == total and not wide[[first, last]].any():
            at = q * (total - 1)
            cut = lo[first] + (lo[last] - lo[first]) * (at - np.floor(at))
            cuts.append(float(cut))
            under = lo < cut
            least[np.ix_(under, low)] = most[np.ix_(under, low)] = 0
        else:
            cuts.append(None)
            open_[first:last + 1] |= wide[first:last + 1]
            least[np.ix_(place <= last, low)] = 0
            most[np.ix_(place < first, low)] = 0
        least[:, all_] = most[:, all_] = 0
    return (None, open_) if open_.any() else (cuts, open_)


def chained_cuts(df: DataFrame, keys: list[str], value: Column, steps: list[Cut]) -> DataFrame:
    """One row per group with a percentile for each step, each taken over what the steps before it leave.

    One histogram over order-preserving buckets, with a count for each combination of the
    steps' flags, bounds the buckets that all cuts can lie in, the later ones too.  Only
    values of those buckets are then counted one by one, in one further scan; a bucket of more
    than ``CROWDED_ROWS`` rows is cut evenly first.  A task sees a group's buckets, never its rows.
    Nulls, NaN and infinities take no part; a step without rows left has a null.
    """
    flags = [f for s in steps for f in (s.below, s.always)]
    code = reduce(lambda a, b: a + b, [F.when(F.coalesce(f, F.lit(True)), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(flags)])
    rows = df.select(*keys, value.cast("double").alias("_v"), code.cast("int").alias("_c")).where(F.abs("_v") < float("inf"))
    rows = rows.withColumn("_b", ordered_bucket(F.col("_v")))
    counted = [F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    entries = rows.groupBy(*keys, "_b", F.lit(0.0).alias("_part"), "_c").agg(*counted)
    shares, names, many = [s.percent / 100.0 for s in steps], [s.name for s in steps], len(steps)
    limit = int(df.sparkSession.conf.get(_CROWDED_CONF, str(CROWDED_ROWS)))
    schema = StructType([*entries.schema.fields, StructField("_open", BooleanType()), StructField("_cuts", ArrayType(DoubleType()))])

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        """A row with the cuts, or the group's entries with those to open."""
        spans = part.groupby(["_b", "_part"]).agg(lo=("_lo", "min"), hi=("_hi", "max")).sort_values("lo")
        classes, column = np.unique(part["_c"].to_numpy(), return_inverse=True)
        n = np.zeros((len(spans), len(classes)), np.int64)
        row = spans.index.get_indexer(pd.MultiIndex.from_frame(part[["_b", "_part"]]))
        np.add.at(n, (row, column), part["_n"].to_numpy())
        bit = lambda i: classes >> i & 1 == 1
        cuts, open_ = _selected(spans["lo"].to_numpy(), spans["hi"].to_numpy(), n, np.array([bit(2 * i) for i in range(many)]),
                                np.array([bit(2 * i + 1) for i in range(many)]), shares)
        if cuts is None:
            return part.assign(_open=open_[row], _cuts=None)
        return part.head(1).assign(_open=False, _cuts=[cuts])

    told = [*keys, "_b", "_part"]
    found = []
    while True:
        entries = stage(entries.groupBy(*keys).applyInPandas(settle, schema))
        found.append(entries.where("_cuts is not null"))
        rest = entries.where("_cuts is null").drop("_cuts")
        if rest.where("_open").isEmpty():
            break
        spans = rest.where("_open").groupBy(*told).agg(F.sum("_n").alias("_rows"), F.min("_lo").alias("_from"), F.max("_hi").alias("_to"))
        inner = rows.alias("r").join(small(spans).alias("s"), [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*keys, "_b"]] + [F.col("r._v").between(F.col("s._from"), F.col("s._to"))])
        part = F.when(F.col("s._rows") <= limit, F.col("r._v")).otherwise(
            F.col("s._from") + F.least(F.lit(_PARTS - 1), F.floor((F.col("r._v") - F.col("s._from")) / (F.col("s._to") - F.col("s._from")) * _PARTS))
            * ((F.col("s._to") - F.col("s._from")) / _PARTS))
        inner = inner.select(*[F.col(f"r.{c}").alias(c) for c in [*keys, "_b", "_v", "_c"]], part.alias("_part"))
        entries = rest.where("not _open").drop("_open").unionByName(inner.groupBy(*told, "_c").agg(*counted))
    return reduce(DataFrame.unionByName, found).select(*keys, *[F.col("_cuts")[i].alias(n) for i, n in enumerate(names)])


def with_percentiles(df: DataFrame, keys: list[str], measures: dict[str, Column],
                     want: list[tuple[str, str, float]]) -> DataFrame:
    """Every row of ``df`` with its group's percentiles attached."""
    return df.join(small(percentiles(df, keys, measures, want)), keys)


def axis_percentiles(df: DataFrame, keys: list[str], points: list[float],
                     axes: str = "xyz", with_count: str | None = None) -> DataFrame:
    """``x_p5 .. z_p95`` for the given percents of each axis."""
    return percentiles(
        df, keys, {a: F.col(a) for a in axes},
        [(f"{a}_p{p:g}", a, p) for a in axes for p in points], with_count)
