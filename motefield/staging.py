"""Materialised intermediates and size-checked joins.

Two things every multi-pass operator needs at scale:

* ``stage`` cuts a plan by writing it to the shared checkpoint folder and
  reading it back.  The files outlive executors, and because they are files
  Spark knows their real size.
* ``small`` adds a broadcast hint only when that measured size is below a
  limit.  Above it the join stays a shuffle join, which AQE can split on skew.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
ROW_BYTES = 48           # of a broadcast row beside its values: its header, its place in the hash table
HOT_GROUP_ROWS = 1_000_000
SALTS = 512

_LIMIT_CONF = "motefield.broadcast.bytes"
_HOT_CONF = "motefield.hot.group.rows"
_local_dirs: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temp folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="motefield-")
    return _local_dirs[app]


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files."""
    path = f"{staging_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_in_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get(_LIMIT_CONF, str(BROADCAST_BYTES)))
    return size_in_bytes(df) <= limit


def small(df: DataFrame) -> DataFrame:
    """Broadcast hint for a side whose planned size is under the limit."""
    return F.broadcast(df) if fits_broadcast(df) else df


def light(df: DataFrame) -> DataFrame:
    """``small`` for sides of very many short rows: files are compressed and what is broadcast is not, so rows are counted as well."""
    limit = int(df.sparkSession.conf.get(_LIMIT_CONF, str(BROADCAST_BYTES)))
    return F.broadcast(df) if fits_broadcast(df) and df.count() * (8 * len(df.columns) + ROW_BYTES) <= limit else df


def staged_small(df: DataFrame) -> DataFrame:
    """Stage a derived side so that its size is measured, then ``small`` it."""
    return small(stage(df))


def computed(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``withColumns`` that is evaluated once per row.

    Plain projections are merged into whatever reads them, so a long expression
    used as a join key and in a join's residual test would run again for every
    match, and a filter on it would be copied down to the scan.  A one-element
    ``inline`` keeps it in place.
    """
    rest = [c for c in df.columns if c not in values]
    return df.select(*rest, F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def attach(df: DataFrame, stats: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Join per-group statistics back to the rows of the groups.

    A null in a key makes a group of its own, as grouping has it, and NaN equals NaN; a
    row whose group is missing in ``stats`` stays, with nulls.  ``weight`` is the
    group's row count.  When ``stats`` is measured small it is broadcast and the
    rows do not move.  Otherwise the groups above ``HOT_GROUP_ROWS`` (at most rows /
    HOT_GROUP_ROWS of them, so that list is bounded) are broadcast, and only rows of
    the other groups meet their statistics through the shuffle; hot rows are
    salted so that they spread evenly over it.  Both ways give the same rows.
    """
    stats = stage(stats)
    values = [c for c in stats.columns if c not in keys]
    on = lambda left, right, cols: [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    if fits_broadcast(stats):
        out = df.alias("d").join(F.broadcast(stats).alias("s"), on("d", "s", keys), "left")
        return out.select(*[F.col(f"d.{c}") for c in df.columns], *[F.col(f"s.{c}") for c in values])
    hot_rows = int(df.sparkSession.conf.get(_HOT_CONF, str(HOT_GROUP_ROWS)))
    hot = stats.where(F.col(weight) >= hot_rows).select(*keys, F.struct(*values).alias("_hot"))
    cold = stats.where(F.col(weight) < hot_rows).select(*keys, F.lit(0).alias("_salt"), F.struct(*values).alias("_cold"))
    out = df.alias("d").join(small(hot).alias("h"), on("d", "h", keys), "left").select("d.*", "h._hot")
    out = out.withColumn("_salt", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
        1 + F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")))
    out = out.alias("d").join(cold.alias("c"), on("d", "c", [*keys, "_salt"]), "left")
    return out.select(*[F.col(f"d.{c}") for c in df.columns],
                      *[F.coalesce(F.col(f"d._hot.{c}"), F.col(f"c._cold.{c}")).alias(c) for c in values])
