"""Near-copies of embeddings by PCA-ordered, tiled comparison.

Within a label, unit vectors are turned to principal axes (fitted on a bounded sample; the
axes only decide how soon pairs are given up, not which pairs link).  Two unit vectors whose
cosine reaches the threshold t are at most ``sqrt(2 - 2t)`` apart in every coordinate, so
rows are laid in cells of that width along the leading two axes and only neighbouring cells
meet.  A cell is cut into tiles of at most about ``TILE_ROWS`` rows; each pair of tiles is a task.

In a task, rows stand in the order of the leading coordinate.  Products are summed over the
leading coordinates first; what the others can add is bounded by the norms of the two
suffixes, and a pair is given up as soon as the sum and the bound stay below the threshold.
Pairs that are left get their cosine from the vectors as given, in double precision.

Equal vectors of one label are one row in all this, with its number of copies.  A task
returns, per row, how many vectors it links with, and a spanning forest of its links; never
the pairs.

Defined cases.  A vector or label that is null, a zero vector, one with a null or non-finite
component, or a row without an id: no links, a component of its own.  Vectors of different
lengths are not compared.  Rows that repeat an id are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import small, stage
from .common import components, forest
from .maxscore import finite

THRESHOLD = 0.98
TILE_ROWS = 1024
SAMPLE = 8192
LEADING = 8              # coordinates that are multiplied for all pairs of two tiles
_STRIP, _CLOSE = 128, 1e-9


def _axes(batches: list[np.ndarray]) -> np.ndarray:
    """Principal axes of unit vectors of one length, most telling first, as columns."""
    x = np.stack(batches)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


def _unit(values: list) -> list[np.ndarray]:
    rows = [np.array(v, np.float64) for v in values]
    return [r / np.abs(r).max() / np.linalg.norm(r / np.abs(r).max()) for r in rows]


def _place(batches: Iterator[pa.RecordBatch], axes, width: float) -> Iterator[pa.RecordBatch]:
    """Cells of vectors along the two leading axes."""
    known = axes.value
    for batch in batches:
        rows = _unit(batch.column("v").to_pylist())
        cells = [np.floor(r @ known[len(r)][:, :2] / width).astype(np.int64).tolist() if len(r) in known else [0, 0] for r in rows]
        x, y = [c[0] for c in cells], [c[1] if len(c) > 1 else 0 for c in cells]
        columns = {n: batch.column(n) for n in batch.schema.names} | {"x": pa.array(x, pa.int32()), "y": pa.array(y, pa.int32())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def linked(a: np.ndarray, b: np.ndarray | None, axes: np.ndarray | None, threshold: float, leading: int = LEADING) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``a`` x ``b`` (or of ``a`` with itself, first index smaller) whose cosine is at least ``threshold``."""
    own, reach = b is None, np.sqrt(max(0.0, 2 - 2 * threshold)) + _CLOSE
    turn = (lambda m: m @ axes) if axes is not None else (lambda m: m)
    scaled = lambda m: np.ldexp(m, -np.frexp(np.abs(m).max(1, keepdims=True))[1])      # exact, and no square overflows
    a, b = scaled(a), scaled(a if own else b)
    unit = lambda m: turn(m / np.sqrt((m * m).sum(1, keepdims=True)))
    p, q = unit(a), unit(b)
    i, j = np.argsort(p[:, 0], kind="stable"), np.argsort(q[:, 0], kind="stable")
    p, q = p[i], q[j]
    cuts = [*range(0, p.shape[1], leading), p.shape[1]]
    suffix = lambda m: np.stack([np.sqrt((m[:, c:] ** 2).sum(1)) for c in cuts[1:]])
    sp, sq = suffix(p), suffix(q)
    found = []
    for lo in range(0, len(p), _STRIP):
        hi = min(lo + _STRIP, len(p))
        u, v = np.searchsorted(q[:, 0], [p[lo, 0] - reach, p[hi - 1, 0] + reach])
        part = p[lo:hi, :leading] @ q[u:v, :leading].T
        x, y = np.nonzero(part + sp[0][lo:hi, None] * sq[0][None, u:v] >= threshold - _CLOSE)
        part = part[x, y]
        x, y = x + lo, y + u
        if own:
            keep = i[x] < j[y]
            x, y, part = x[keep], y[keep], part[keep]
        for k, (c, d) in enumerate(zip(cuts[1:-1], cuts[2:]), 1):
            if not len(x):
                break
            part = part + np.einsum("ij,ij->i", p[x, c:d], q[y, c:d])
            keep = part + sp[k][x] * sq[k][y] >= threshold - _CLOSE
            x, y, part = x[keep], y[keep], part[keep]
        x, y = i[x], j[y]
        keep = cosines(a[x], b[y]) >= threshold
        found.append((x[keep], y[keep]))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.zeros(0, np.int64),) * 2


def _compare(table: pa.Table, axes, threshold: float) -> pa.Table:
    """Links of one pair of tiles: numbers per row (kind 0) and a forest (kind 1)."""
    uid, copies = table.column("uid").to_numpy(), table.column("copies").to_numpy()
    second = table.column("second").to_numpy(zero_copy_only=False).astype(bool)
    values = table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(uid), -1)
    turn = axes.value.get(values.shape[1])
    left, right = np.flatnonzero(~second), np.flatnonzero(second)
    if not len(left) or (table.column("cross")[0].as_py() and not len(right)):
        x = y = np.zeros(0, np.int64)
    elif len(right):
        x, y = linked(values[left], values[right], turn, threshold)
        x, y = left[x], right[y]
    else:
        x, y = linked(values[left], None, turn, threshold)
        x, y = left[x], left[y]
    number = np.bincount(x, copies[y], len(uid)) + np.bincount(y, copies[x], len(uid))
    some = np.flatnonzero(number)
    node, root = forest(uid[x], uid[y]) if len(x) else (np.zeros(0, np.int64),) * 2
    tree = node != root
    return pa.table({"kind": np.repeat([0, 1], [len(some), tree.sum()]).astype(np.int32), "u": np.concatenate([uid[some], root[tree]]),
                     "v": np.concatenate([number[some].astype(np.int64), node[tree]])})


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS, sample: int = SAMPLE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row; ``vectors``: vec_id, embedding, label."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), "label")
    total, ids = rows.agg(F.count("*"), F.count_distinct("vec_id")).first()
    rows = rows.withColumn("uid", F.col("vec_id")) if total == ids else stage(rows.withColumn("uid", F.monotonically_increasing_id()))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("v") & F.exists("v", lambda x: x != 0))
    classes = stage(usable.groupBy("label", "v").agg(F.min("uid").alias("rep"), F.count("*").alias("copies")))
    repeated = classes.where("copies > 1")
    member = stage(usable.join(repeated, ["label", "v"]).select("uid", "rep", "copies"))
    reps = classes.select(F.col("rep").alias("uid"), "label", "v", "copies")

    count = max(1, reps.count())
    drawn = reps.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) < F.lit(min(1.0, sample / count)) * (1 << 20)).select("v").toArrow().column("v").to_pylist()
    by_length: dict[int, list] = {}
    for r in _unit(drawn):
        by_length.setdefault(len(r), []).append(r)
    axes = spark.sparkContext.broadcast({n: _axes(x) for n, x in by_length.items()})
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    placed = stage(reps.mapInArrow(lambda it: _place(it, axes, width), reps.schema.simpleString()[7:-1] + ",x:int,y:int"))
    cell = ["label", "size", "x", "y"]
    placed = placed.withColumn("size", F.size("v"))
    tiles = stage(placed.groupBy(*cell).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles")))
    placed = placed.join(small(tiles), cell).withColumn("tile", F.pmod(F.xxhash64("uid"), F.col("tiles")).cast("int"))
    own = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    keyed = lambda df, x1, y1, t1, x2, y2, t2, second, cross: df.select(
        "uid", "copies", "v", "label", "size", *[c.alias(n) for n, c in zip(("x1", "y1", "t1", "x2", "y2", "t2", "second", "cross"), (x1, y1, t1, x2, y2, t2, second, cross))])
    c = F.col
    parts = keyed(own, c("x"), c("y"), F.least("tile", "other"), c("x"), c("y"), F.greatest("tile", "other"), c("tile") > c("other"), c("tile") != c("other"))
    for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1)):
        far = lambda sx, sy: tiles.select("label", "size", (c("x") - sx).alias("x"), (c("y") - sy).alias("y"), c("tiles").alias("far"))
        for sign in (1, -1):
            met = placed.join(small(far(sign * dx, sign * dy)), cell).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("far") - 1)))
            here, there = (c("x"), c("y"), c("tile")), (c("x") + sign * dx, c("y") + sign * dy, c("other"))
            first, then = (here, there) if sign > 0 else (there, here)
            parts = parts.unionByName(keyed(met, *first, *then, F.lit(sign < 0), F.lit(True)))
    found = stage(parts.groupBy("label", "size", "x1", "y1", "t1", "x2", "y2", "t2")
                  .applyInArrow(lambda t: _compare(t, axes, threshold), "kind int, u long, v long"))
    links = found.where("kind = 0").groupBy(F.col("u").alias("rep")).agg(F.sum("v").alias("n"))
    tree = components(found.where("kind = 1").select("u", "v"))
    out = (rows.select("uid", "vec_id").join(member, "uid", "left").withColumn("rep", F.coalesce("rep", "uid"))
           .join(links, "rep", "left").join(tree.select(F.col("node").alias("rep"), "component"), "rep", "left")
           .select("uid", "vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    if total != ids:
        out = stage(out)
        out = out.join(out.groupBy("component").agg(F.min("vec_id").alias("component_id")), "component")
    else:
        out = out.withColumn("component_id", F.col("component"))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
