"""Kernels and plumbing that the operators of this subpackage share.

Text kernels work on the UTF-8 bytes of an Arrow column, many documents at a time.
``exchange`` moves what they find to hash buckets as packed arrays: one row per batch
and bucket instead of one per word, which is what makes a pass over every rolling
window of a corpus affordable.  The number of buckets follows the size of the input, so
a bucket stays a few megabytes; keys that many documents of a batch share are folded
before they are sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..staging import attach, size_in_bytes, small, stage

SLICE_BYTES = 3 << 19
BUCKET_BYTES = 4 << 20
MAX_BUCKETS = 1 << 20
KEY_BITS = 38

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (shift, xor, multiply)."""
    x = x.astype(_U, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    x ^= x >> _U(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(8, (n - 1).bit_length()))[:n]


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[0] = 1
    return np.multiply.accumulate(p)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, seen = 0, np.cumsum(sizes)
        while at < len(sizes):
            past = int(np.searchsorted(seen, (seen[at - 1] if at else 0) + limit, "right"))
            stop = max(at + 1, past)
            yield batch.slice(at, stop - at)
            at = stop
    pa.default_memory_pool().release_unused()


def light(work):
    """A function of one group that gives Arrow's free memory back when it is done: a worker waits for its next task with little."""
    def run(table: pa.Table) -> pa.Table:
        try:
            return work(table)
        finally:
            pa.default_memory_pool().release_unused()
    return run


def widened(df: DataFrame, more: str) -> StructType:
    """The columns of ``df``, whatever their names, and those of a schema text."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


class Words:
    """The words of a batch: byte ranges, the document each belongs to, and a 64-bit hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        if lower:
            data = _LOWER[data]
        self.data, self.offsets = data, offsets
        docs = len(offsets) - 1
        self.blank = _SPACE[data]
        begin = np.ones(len(data) + 1, bool)
        begin[1:] = np.append(self.blank, True)[:-1] if len(data) else True
        begin[offsets[:-1]] = True
        self.starts = np.flatnonzero(~self.blank & begin[:-1])
        until = np.ones(len(data), bool)
        if len(data):
            until[:-1] = self.blank[1:] | begin[1:-1]
        self.ends = np.flatnonzero(~self.blank & until) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(docs), self.counts)
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        n = len(self.starts)
        if not n:
            return np.zeros(0, _U)
        lead = self.starts[0]
        spans = np.diff(np.append(self.starts, len(self.data)))
        inside = np.arange(lead, len(self.data)) - np.repeat(self.starts, spans)
        values = _BYTE[self.data[lead:]] * powers(_BASE | 1, int(spans.max()))[inside]
        values[self.blank[lead:]] = 0
        total = np.add.reduceat(values, self.starts - lead)
        return mix(total + (self.ends - self.starts).astype(_U) * _U(0xD1B54A32D192ED03))

    def grams(self, k: int, base: int = 0xA24BAED4963EE407) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every run of ``k`` words inside one document, and the index of its first word."""
        at = np.flatnonzero(np.arange(len(self.hash)) + k <= self.first[1:][self.doc])
        if not len(at):
            return np.zeros(0, _U), at
        factors, total = powers(base | 1, k), np.zeros(len(self.hash) - k + 1, _U)
        for j in range(k):
            total += self.hash[j:len(self.hash) - k + 1 + j] * factors[j]
        return mix(total[at]), at

    def whole(self, base: int = 0x8CB92BA72F3D8DD7) -> np.ndarray:
        """One hash per document of its whole sequence of words."""
        out = np.zeros(len(self.counts), _U)
        full = np.flatnonzero(self.counts)
        if len(full):
            inside = np.arange(len(self.hash)) - np.repeat(self.first[:-1], self.counts)
            values = self.hash * powers(base | 1, int(self.counts.max()))[inside]
            out[full] = np.add.reduceat(values, self.first[full])
        return mix(out + self.counts.astype(_U))


def words_of(batch: pa.RecordBatch, lower: bool, text: str = "text") -> Words:
    return Words(*utf8(batch.column(text)), lower)


# ---- packed arrays

def pack(values: np.ndarray) -> bytes:
    """Integers as differences to the least, in the narrowest of 1, 2, 4 or 8 bytes."""
    values = values.astype(np.int64)
    least = values.min() if len(values) else np.int64(0)
    rest = (values - least).view(_U)
    top = int(rest.max()) if len(rest) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + least.tobytes() + rest.astype(f"<u{width}").tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=9).astype(np.int64) + np.frombuffer(blob, np.int64, 1, 1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending integers as steps."""
    return pack(np.diff(values.astype(np.int64), prepend=np.int64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob))


def joined(column, read) -> tuple[np.ndarray, np.ndarray]:
    """All arrays of a packed column, and for each value the row it came from."""
    parts = [read(b) for b in column.to_pylist()]
    sizes = [len(p) for p in parts]
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.repeat(np.arange(len(parts)), sizes)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bucket, its ascending keys of ``KEY_BITS`` bits, and the positions they came from."""
    mask = _U((1 << KEY_BITS) - 1)
    mixed = ((keys >> _U(KEY_BITS)) % _U(buckets) << _U(KEY_BITS)) | (keys & mask)
    order = np.argsort(mixed, kind="stable")
    mixed = mixed[order]
    bucket = (mixed >> _U(KEY_BITS)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(edges, np.append(edges[1:], len(bucket))):
        yield int(bucket[lo]), (mixed[lo:hi] & mask).astype(np.int64), order[lo:hi]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(values)))


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    return int(min(MAX_BUCKETS, max(8, size_in_bytes(df) // bucket_bytes)))


# ---- connected components

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of an edge list and the least node each is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = np.minimum(label, label[label])
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            return nodes, nodes[label]


def components(edges: DataFrame) -> DataFrame:
    """Node and component (its least node) of every node of ``edges`` (two long columns).

    Rounds of large and small stars (each node hands its larger neighbours, then itself, to
    its least neighbour) run until the edges stay the same.  Each half is written to the shared folder.  No edge list
    leaves the executors; minima are combined before they move, and go back to the edges by
    ``attach``, so a node with very many neighbours is no single task's.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    e = (edges.where(F.col(a) != F.col(b)).select(F.least(a, b).cast("long").alias("u"), F.greatest(a, b).cast("long").alias("v")).distinct())
    e, last = stage(e), None
    while True:
        size = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size[0] == 0 or size == last:
            break
        last = size
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("w"))
        e = stage(attach(both.where("v > u"), least, ["u"], "w").select(F.col("m").alias("u"), "v").where("u <> v").distinct())
        least = e.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("w"))
        e = (attach(e, least, ["v"], "w").select(F.col("m").alias("u"), F.col("u").alias("v")).where("u <> v")
             .unionByName(least.select(F.col("m").alias("u"), "v")).distinct())
        e = stage(e)
    nodes = e.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
    roots = e.select(F.col("u").alias("node")).distinct().join(nodes, "node", "left_anti")
    return nodes.unionByName(roots.withColumn("component", F.col("node"))).select("node", "component")


# ---- running sums

def as_read(df: DataFrame) -> DataFrame:
    """``df`` with the order in which its files hold it: ``__file``, and ``__at``, the row's position there.

    Files come by the number that Spark gives the parts of a write, then by path; other
    files by path.  A table that is not read from Parquet files is written down first.
    """
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        df = stage(df)
    path = F.col("_metadata.file_path")
    part = F.regexp_extract(path, r"/part-(\d{1,10})-[^/]*$", 1)
    return df.select("*", F.concat(F.lpad(part, 10, "0"), path).alias("__file"), F.col("_metadata.row_index").alias("__at"))


def running(df: DataFrame, group: list[str], value: str, name: str, rows: int = 2048, order: tuple[str, str] | None = None,
            total: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the group that come before, and ``__h``, the order.

    The order is that of a hash of the whole row, so equal rows may stand in either order;
    or that of the two columns ``order``, a file and a row's position in it (see ``as_read``).
    The hash's leading bits, or the positions of a file, cut each group into ranges of about
    ``rows`` rows; sums of ranges and of stretches of ranges (or files) are added up first, so
    no window holds a whole group.  Nulls in the group columns make a group of their own.
    ``total`` is the number of rows, counted here where it is not given.
    """
    if order:
        file, at = order
        df = df.withColumn("__h", F.col(at)).withColumn("__g", F.struct(F.col(file).alias("file"), F.expr(f"{at} div {int(rows)}").alias("range")))
        wider = F.col("__g.file")
    else:
        bits = max(0, int((df.count() if total is None else total) // rows).bit_length())
        high = F.shiftright(F.col("__h"), 64 - bits) if bits else F.lit(0).cast("long")
        df = df.withColumn("__h", F.xxhash64(F.lit(29), *df.columns)).withColumn("__g", high)
        wider = F.shiftright(F.col("__g"), bits // 2)
    sums = stage(df.groupBy(*group, "__g").agg(F.sum(value).alias("__s")).withColumn("__gg", wider))
    before = lambda keys, order: F.coalesce(F.sum("__s").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upper = sums.groupBy(*group, "__gg").agg(F.sum("__s").alias("__s")).withColumn("__up", before(group, "__gg"))
    lower = sums.withColumn("__low", before([*group, "__gg"], "__g"))
    same = lambda a, b, keys: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    base = (lower.alias("l").join(upper.alias("u"), same("l", "u", [*group, "__gg"]))
            .select(*[F.col(f"l.{g}").alias(g) for g in [*group, "__g"]], (F.col("__low") + F.col("__up")).alias("__base")))
    rows_ = df.alias("d").join(small(stage(base)).alias("b"), same("d", "b", [*group, "__g"]))
    within = Window.partitionBy(*[F.col(f"d.{g}") for g in group], F.col("d.__g")).orderBy("d.__h").rowsBetween(Window.unboundedPreceding, -1)
    return rows_.withColumn(name, F.col("__base") + F.coalesce(F.sum(F.col(f"d.{value}")).over(within), F.lit(0))).select(
        *[F.col(f"d.{c}") for c in df.columns if c != "__g"], name)


def word_count(text: str = "text"):
    """Words of a text; none where it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
