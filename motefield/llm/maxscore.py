"""Exact top-k inner products by MaxScore over dimension postings.

Every component is a term whose posting list holds the value of each candidate.  For a
query, a term's contribution lies between the products with its least and largest value in
the shard.  Terms are ordered by the width of that range.  Those whose widths together
cannot lift a candidate from the floor to the current k-th score are non-essential: only
the others' postings are traversed in full, then the rest are probed, widest first, for the
candidates that can still compete.  Shards keep the k best of each query; the lists are
merged by rank.

Candidates are packed into shards of about ``SHARD_ROWS`` rows, queries into blocks of
about ``QUERY_ROWS``; every block meets every shard in a task of bounded size.  Vectors of
different lengths are compared as far as both go (a missing component is an absent term).

Defined cases.  Rows whose id or vector is null, or whose vector holds a null or non-finite
component, take no part.  An empty vector scores 0 with all.  Rows that repeat id and vector count
once; a query is not compared with rows of its id.  Scores outside 64 bits rank by their true value
and are shown as the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import small, stage

SCALE = 256
SHARD_ROWS, QUERY_ROWS, STEP = 32768, 512, 4096
_EXACT, _LONG = float(1 << 53), (1 << 63) - 1


def finite(vector: str):
    """True where a vector is there and all its components are finite numbers."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _pack(table: pa.Table, key: str) -> pa.Table:
    rows = [np.asarray(v, np.float32 if pa.types.is_float32(table.column("v").type.value_type) else np.float64) for v in table.column("v").to_pylist()]
    width = max(map(len, rows))
    dense = np.zeros((len(rows), width), rows[0].dtype)
    for i, r in enumerate(rows):
        dense[i, :len(r)] = r
    return pa.table({key: table.column(key).slice(0, 1).cast(pa.int32()), "ids": [table.column("id").to_numpy().astype(np.int64).tobytes()],
                     "rows": pa.array([len(rows)], pa.int32()), "wide": [dense.dtype == np.float64], "values": [dense.tobytes()]})


def _blocks(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Packed blocks of rows, dealt by the hash of the id."""
    count = max(1, -(-rows.count() // size))
    dealt = rows.withColumn(key, F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))
    return stage(dealt.groupBy(key).applyInArrow(lambda t: _pack(t, key), f"{key} int, ids binary, rows int, wide boolean, values binary")), count


def terms(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * values.astype(np.float64))


def top(query: np.ndarray, own: int, ids: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, step: int = STEP) -> list[tuple]:
    """The k best (score, id) of a shard; ``postings`` has a row per term, ``low`` and ``high`` its extremes."""
    a, b = query * low, query * high
    floor, width = np.minimum(a, b), np.abs(b - a)
    order = np.argsort(-width, kind="stable")
    order = order[query[order] != 0]
    rest = np.append(np.cumsum(width[order][::-1])[::-1], 0)       # what the terms from here on can add
    base, best, bar = floor.sum(), [], None
    for at in range(0, len(ids), step):
        mine = ids[at:at + step]
        score = np.full(len(mine), base)
        live, done = None, 0
        if bar is not None:
            essential = int(np.searchsorted(-rest, -(bar - base), "right"))     # rest[essential] < bar - base
            essential = min(essential, len(order))
        else:
            essential = len(order)
        for j in order[:essential]:
            score += query[j] * postings[j, at:at + step] - floor[j]
        done = essential
        if done < len(order):
            live = np.flatnonzero(score + rest[done] >= bar)
            score = score[live]
            for j in order[done:]:
                score = score + (query[j] * postings[j, at:at + step][live] - floor[j])
                done += 1
                keep = score + rest[done] >= bar
                live, score = live[keep], score[keep]
        else:
            live = np.arange(len(mine)) if bar is None else np.flatnonzero(score >= bar)
            score = score[live]
        other = mine[live] != own
        found = list(zip(score[other], mine[live][other]))
        if len(found) > k:
            part = np.partition(score[other], len(found) - k)[len(found) - k]
            found = [f for f in found if f[0] >= part]
        best = sorted(best + found, key=lambda f: (-f[0], f[1]))[:k]
        bar = best[-1][0] if len(best) == k else None
    return best


def sortable(score: int) -> bytes:
    """Bytes that sort as the whole number does, however large it is."""
    size = (score.bit_length() + 7) // 8
    raw = size.to_bytes(2, "big") + abs(score).to_bytes(size, "big")
    return b"\1" + raw if score >= 0 else b"\0" + bytes(255 - b for b in raw)


def _search(batches: Iterator[pa.RecordBatch], k: int, scale: int, step: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            read = lambda p: np.frombuffer(row[f"{p}values"], np.float64 if row[f"{p}wide"] else np.float32).reshape(row[f"{p}rows"], -1)
            queries, shard = terms(read("q_"), scale), terms(read("s_"), scale)
            width = min(queries.shape[1], shard.shape[1])
            queries, postings = queries[:, :width], np.ascontiguousarray(shard[:, :width].T)
            own, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["s_ids"], np.int64)
            if width and 4 * width * np.abs(queries).max() * np.abs(postings).max() >= _EXACT:
                whole = np.frompyfunc(int, 1, 1)
                queries, postings = whole(queries), whole(postings)
            low = postings.min(1) if width else np.zeros(0)
            high = postings.max(1) if width else np.zeros(0)
            out = [(row["block"] << 20 | i, q, v, max(-_LONG - 1, min(_LONG, int(s))), sortable(int(s)))
                   for i, q in enumerate(own) for s, v in top(queries[i], q, ids, postings, low, high, k, step)]
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in columns[:4]] + [pa.array(columns[4], pa.binary())],
                                             names=["key", "query_id", "vec_id", "score", "order"])


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE, shard_rows: int = SHARD_ROWS,
           query_rows: int = QUERY_ROWS, step: int = STEP) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; both tables have ``vec_id`` and ``embedding``."""
    ready = lambda df: df.where(F.col("vec_id").isNotNull() & finite("embedding")).select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")).distinct()
    shards, _ = _blocks(ready(vectors), "shard", shard_rows)
    blocks, count = _blocks(ready(queries), "block", query_rows)
    prefixed = lambda df, p, key: df.select(key, *[F.col(c).alias(p + c) for c in ("ids", "rows", "wide", "values")])
    # each shard goes to each block of the stated queries; a copy is a few megabytes
    met = (prefixed(shards, "s_", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
           .join(small(prefixed(blocks, "q_", "block")), "block").drop("shard").repartition(F.col("block"), F.xxhash64("s_ids")))
    found = met.mapInArrow(lambda it: _search(it, k, scale, step), "key long, query_id long, vec_id long, score long, order binary")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("order"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
