"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are put in a random but fixed order and cut into blocks of
``block_tokens`` words; a document belongs to the block in which it starts.  A source of
weight w has one block due in each window: block j is released at slot ``floor(j / w)`` and
due by ``ceil((j + 1) / w)``.  In every slot the released block with the earliest deadline
goes out.  With weights that add up to one this meets every deadline, so after any number
of slots each source is less than one block away from its share.

Weights are taken exactly, as whole parts of their sum (a float is a fraction), so windows
follow the given weights however long the mixture is.  The driver schedules the whole
horizon, one block a slot, and writes it to the shared folder as it goes: it holds about
``slots`` slots, at least one stretch of blocks a source, and never a document.  The table
has a row for each ``STRETCH`` blocks of a source, with their slots as arrays, and is
broadcast while it measures small.

``repeat``: the mixture lasts until the source that is largest for its weight has gone out
once; sources that end sooner start again, so every document appears at least once and the
shares hold to the end.  Otherwise each document appears once and a source that has ended
leaves its slots empty.

Defined cases.  Text null or without words: no words; the document goes with its block.
``source`` null: a source of its own.  Sources missing in given weights, or with weight 0 or
less, are left out; no weights at all: ``words ** power`` of each source.  Equal rows are
separate documents.  More than ``MAX_SOURCES`` sources: an error.
"""

from __future__ import annotations

import heapq
import math
import uuid
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import small, staging_dir
from .common import running, word_count

BLOCK_TOKENS = 4096
SLOTS = 1 << 20
STRETCH = 1024
POWER = 0.9
MAX_SOURCES = 1 << 16


def whole_weights(weights: list[float], slots: int) -> list[int]:
    """Whole parts of ``slots`` that add up to it: one each, the rest by largest remainders."""
    total, free = sum(weights), slots - len(weights)
    exact = [w / total * free for w in weights]
    parts = [int(e) for e in exact]
    by_rest = sorted(range(len(weights)), key=lambda i: (parts[i] - exact[i], i))
    for i in by_rest[:free - sum(parts)]:
        parts[i] += 1
    return [p + 1 for p in parts]


def exact_weights(weights: list[float]) -> list[int]:
    """Whole numbers, as small as can be, whose ratios are exactly those of ``weights``."""
    exact = [Fraction(w) for w in weights]
    under = math.lcm(*[e.denominator for e in exact])
    parts = [int(e * under) for e in exact]
    shared = math.gcd(*parts) or 1
    return [p // shared for p in parts]


def schedule(parts: list[int], horizon: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, slot, release, deadline) of ``horizon`` slots by earliest deadline first."""
    total = sum(parts)
    waiting = [(0, i, 0) for i in range(len(parts)) if parts[i] > 0]      # by release
    ready: list[tuple[int, int, int, int]] = []                           # by deadline
    for slot in range(horizon):
        while waiting and waiting[0][0] <= slot:
            release, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-((j + 1) * total // -parts[i]), i, j, release))
        due, i, j, release = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline was missed")
        yield i, j, slot, release, due
        heapq.heappush(waiting, ((j + 1) * total // parts[i], i, j + 1))


def one_period(parts: list[int]) -> list[tuple[int, int, int]]:
    """(source, block, slot) of the slots after which the schedule repeats."""
    return [row[:3] for row in schedule(parts, sum(parts))]


_STRETCHES = "i int, __stretch long, __slot array<long>, __release array<long>, __deadline array<long>"


def stretches(spark: SparkSession, parts: list[int], horizon: int, slots: int) -> DataFrame:
    """The schedule, a row for ``STRETCH`` blocks of a source, in files of about ``slots`` slots."""
    path = f"{staging_dir(spark)}/schedule-{uuid.uuid4().hex}"
    times = lambda: tuple(array("q") for _ in range(3))
    open_, ended, done = [times() for _ in parts], [0] * len(parts), []

    def write(rows: list) -> None:
        offsets = pa.array(np.append(0, np.cumsum([len(t[0]) for _, _, t in rows])).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.frombuffer(t[c], np.int64) for _, _, t in rows]))) for c in range(3)]
        table = pa.table([pa.array([i for i, _, _ in rows], pa.int32()), pa.array([s for _, s, _ in rows], pa.int64()), *lists],
                         names=["i", "__stretch", "__slot", "__release", "__deadline"])
        spark.createDataFrame(table, _STRETCHES).write.mode("append").parquet(path)

    for i, j, *at in schedule(parts, horizon):
        for column, value in zip(open_[i], at):
            column.append(value)
        if (j + 1) % STRETCH == 0:
            done.append((i, ended[i], open_[i]))
            open_[i], ended[i] = times(), ended[i] + 1
            if len(done) * STRETCH >= slots:
                write(done)
                done = []
    done += [(i, ended[i], t) for i, t in enumerate(open_) if len(t[0])]
    if done:
        write(done)
    else:
        spark.createDataFrame([], _STRETCHES).write.mode("append").parquet(path)
    return spark.read.schema(_STRETCHES).parquet(path)


def mix(docs: DataFrame, weights: dict | None = None, power: float = POWER, block_tokens: int = BLOCK_TOKENS,
        slots: int = SLOTS, repeat: bool = True) -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_epoch``, ``mix_block``, ``mix_release``, ``mix_deadline``, ``mix_slot`` and ``mix_offset``.

    Sorted by ``mix_slot, mix_offset`` this is the mixture; ``mix_offset`` counts the words of
    the source that come before in its epoch.
    """
    spark = docs.sparkSession
    names = ["mix_tokens", "mix_epoch", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_offset"]
    docs = docs.drop(*names)
    counted = docs.withColumn("mix_tokens", word_count())
    found = counted.groupBy("source").agg(F.sum("mix_tokens").alias("words"), F.count("*").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        weights = {r.source: max(1, r.words) ** power for r in found}
    found = sorted((r for r in found if weights.get(r.source, 0) > 0), key=lambda r: (r.source is None, r.source))
    parts = exact_weights([weights[r.source] for r in found]) if found else []
    total = sum(parts)
    blocks = [max(1, -(-r.words // block_tokens)) for r in found]
    horizon = max((-(-n * total // a) for n, a in zip(blocks, parts)), default=0)
    table = [(r.source, i, n, (-(-a * horizon // total) - 1) // n if repeat else 0) for i, (r, a, n) in enumerate(zip(found, parts, blocks))]
    sources = spark.createDataFrame(table, "source string, i int, n long, again long")
    planned = small(stretches(spark, parts, horizon, slots))

    placed = running(counted, ["source"], "mix_tokens", "mix_offset")
    own = placed.alias("d").join(F.broadcast(sources).alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    own = own.select("d.*", "s.i", "s.n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s.again"))).alias("mix_epoch"))
    block = F.least(F.expr(f"mix_offset div {int(block_tokens)}"), F.col("n") - 1) + F.col("mix_epoch") * F.col("n")
    own = own.withColumn("mix_block", block).withColumn("__stretch", F.expr(f"mix_block div {STRETCH}"))
    out = own.join(planned, ["i", "__stretch"])
    for c in ("slot", "release", "deadline"):
        out = out.withColumn(f"mix_{c}", F.get(F.col(f"__{c}"), (F.col("mix_block") % STRETCH).cast("int")))
    out = out.where("mix_slot is not null")      # blocks beyond the horizon
    return out.select(*docs.columns, *names)


def in_order(mixed: DataFrame, partitions: int) -> DataFrame:
    """The mixture as consecutive ranges of slots, each sorted: the files of a write follow its order."""
    last = mixed.agg(F.coalesce(F.max("mix_slot"), F.lit(0))).first()[0]
    part = F.expr(f"cast(mix_slot * {int(partitions)} div {int(last) + 1} as int)")
    return mixed.repartitionById(partitions, part).sortWithinPartitions("mix_slot", "mix_offset")
