"""Near-copies by n-gram Jaccard: a blocked product of the document by n-gram incidence.

The incidence matrix has a row per document and a column per distinct n-gram (five words,
A-Z lower-cased; a shorter document has its whole sequence as its one column).  Two rows
link when ``100 * overlap >= 75 * union``.

1. Columns are ordered by their exact sums, rare ones first.  Columns that a thousandth of
   all documents or more have are found first and told to every task (there are at most a
   thousand times the mean row length of them); they come last and are never sent.  All
   others meet in hash buckets, which answer each row with the columns it shares.
2. A pair that links shares a column among the first ``n - ceil(3n/4) + 1`` of either row in
   that order.  Columns of one document come first of all and tie nothing, so most rows have
   no tie.  The rows of each remaining leading column are tied together; the components of
   these ties are the diagonal blocks outside which the product has no entry that links.
3. In a block, dense slabs of columns are multiplied and added up.  After each slab, pairs
   whose overlap cannot reach three sevenths of their sizes any more are discarded, rows
   without a live pair leave, and the product stops when none is left.  A block of many rows
   is cut by size class (ratio 4/3; only neighbouring classes can link) and then into
   tiles; each pair of tiles is a task.
4. A task returns a spanning forest of its links, never the pairs; copies (equal rows) are
   one row in all this and are tied to it afterwards.

Defined cases.  Text null or without words: ``n_shingles`` 0, linked with nothing.  Rows
with null or repeated ``doc_id`` are rows of their own; ``component_id`` is the least
``doc_id`` in the component, null if it has none.  N-grams are told apart by 64-bit hashes.
Known limit: a block is as large as its ties make it, also where few of its pairs link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import small, stage
from .common import KEY_BITS, Words, bucket_count, by_bucket, components, forest, joined, light, mix, pack, pack_sorted, runs, slices, unpack, unpack_sorted, words_of
from .repeats import numbered

N = 5
COMMON = 1000            # a column is common if one in so many documents has it
SEEN = 4                 # .. counting the slices in which so many documents have it
TILE_ROWS = 256
SLAB = 2048
ENTRY, ROW, REPLY, TIE, EDGE = 0, 1, 2, 3, 4
_ROWS = "kind int, bucket int, a binary, b binary, c binary, d binary"
_FIELDS = ["kind", "bucket", "a", "b", "c", "d"]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_FIELDS)


def incidence(w: Words, n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column hash (ascending and distinct in a row), and the number of columns of each row."""
    keys, at = w.grams(n)
    doc = w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    keys, doc = np.concatenate([keys, w.whole(0xF1357AEA2E62A9C5)[short]]), np.concatenate([doc, short])
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])) if len(keys) else np.zeros(0, bool)
    keys, doc = keys[new], doc[new]
    return doc, keys, np.bincount(doc, minlength=len(w.counts))


def _signatures(doc: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash per row of its whole set of columns."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = np.add.reduceat(mix(keys ^ np.uint64(0x5851F42D4C957F2D)), np.append(0, np.cumsum(sizes))[:-1][full])
    return mix(out ^ (sizes.astype(np.uint64) << np.uint64(40))).view(np.int64)


def _leaders(signature: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """True for the row with the least uid among the equal rows of this slice."""
    order = np.lexsort((uid, signature))
    lead = np.zeros(len(uid), bool)
    lead[order[runs(signature[order])[0]]] = True
    return lead


def _often(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Columns that several documents of a slice have, with their numbers."""
    for batch in slices(batches):
        uid = batch.column("uid").to_numpy()
        doc, keys, sizes = incidence(words_of(batch, lower=True), n)
        keys = np.sort(keys[_leaders(_signatures(doc, keys, sizes), uid)[doc]])
        starts, counts = runs(keys)
        often = counts >= SEEN
        yield pa.RecordBatch.from_arrays([pa.array(keys[starts][often].view(np.int64)), pa.array(counts[often])], names=["key", "n"])


def _common(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the common columns, ascending, and their counts."""
    documents = rows.count()
    counts = rows.mapInArrow(lambda it: _often(it, n), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    table = counts.where(F.col("n") >= F.lit(max(64, documents // COMMON))).toArrow()
    key, count = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(key)
    return key[order], count[order]


def _leading(sizes: np.ndarray) -> np.ndarray:
    return sizes - (3 * sizes + 3) // 4 + 1


def _tie_rows(keys: np.ndarray, ids: np.ndarray, buckets: int, home: int) -> list[tuple]:
    """Rows that share one of these columns are tied here; one of them goes on to the bucket of the column."""
    rows, ties = [], []
    for bucket, key, src in by_bucket(keys, buckets):
        starts, counts = runs(key)
        least = np.minimum.reduceat(ids[src], starts)
        tied = np.stack([np.repeat(least, counts), ids[src]], 1)
        ties.append(tied[tied[:, 0] != tied[:, 1]])
        rows.append((TIE, bucket, pack_sorted(key[starts]), pack(least), b"", b""))
    if sum(map(len, ties)):
        root, node = _forest_rows(np.concatenate(ties))
        rows.append((EDGE, home, pack(root), pack(node), b"", b""))
    return rows


def _send(batches: Iterator[pa.RecordBatch], n: int, buckets: int, common) -> Iterator[pa.RecordBatch]:
    """Rows with sizes and signatures; entries of their columns, by bucket; ties by common columns."""
    known, sums = common.value
    for batch in slices(batches):
        uid = batch.column("uid").to_numpy()
        home = int(uid[0] % buckets)
        doc, keys, sizes = incidence(words_of(batch, lower=True), n)
        signature = _signatures(doc, keys, sizes)
        lead = _leaders(signature, uid)[doc]
        doc, keys = doc[lead], keys[lead]
        place = np.zeros(len(keys), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            place = np.where(known[at] == keys, sums[at], 0)
        often = place > 0
        held = np.bincount(doc[often], minlength=len(sizes))
        rows = []
        of = uid % buckets
        for bucket in np.unique(of):
            at = np.flatnonzero(of == bucket)
            rows.append((ROW, int(bucket), pack(uid[at]), pack(sizes[at]), signature[at].tobytes(), pack(held[at])))
        for bucket, key, src in by_bucket(keys[~often], buckets):
            rows.append((ENTRY, bucket, pack_sorted(key), pack(uid[doc[~often][src]]), b"", b""))
        reach = _leading(sizes) - (sizes - held)
        deep = often & (reach > 0)[doc]
        if deep.any():
            d, k = doc[deep], keys[deep]
            order = np.lexsort((place[deep], d))
            d, k = d[order], k[order]
            starts, counts = runs(d)
            first = np.arange(len(d)) - np.repeat(starts, counts) < reach[d]
            rows += _tie_rows(k[first], uid[d[first]], buckets, home)
        yield _table(rows)


def _reply(table: pa.Table, buckets: int) -> pa.Table:
    """Columns of one bucket that several rows have: each of the rows learns how many."""
    kind = table.column("kind").to_numpy()
    out = [table.filter(pa.array(kind != ENTRY))]
    entries = table.filter(pa.array(kind == ENTRY))
    if entries.num_rows:
        bucket = entries.column("bucket")[0].as_py()
        key, uid = joined(entries.column("a"), unpack_sorted)[0], joined(entries.column("b"), unpack)[0]
        order = np.argsort(key, kind="stable")
        key, uid = key[order], uid[order]
        sizes = runs(key)[1]
        counts = np.repeat(sizes, sizes)
        shared = counts > 1
        key, uid, counts = key[shared] | (bucket << KEY_BITS), uid[shared], counts[shared]
        of = uid % buckets
        order = np.argsort(of, kind="stable")
        rows = []
        for s, c in zip(*runs(of[order])):
            at = order[s:s + c]
            rows.append((REPLY, int(of[at[0]]), pack(uid[at]), pack(key[at]), pack(counts[at]), b""))
        out.append(pa.Table.from_batches([_table(rows)]))
    return pa.concat_tables([t.select(_FIELDS).cast(out[0].schema) for t in out])


def _lead(table: pa.Table, buckets: int) -> pa.Table:
    """The leading columns of the rows of one bucket of rows, as ties by bucket of columns."""
    kind = table.column("kind").to_numpy()
    out = [table.filter(pa.array(kind != REPLY))]
    rows, replies = table.filter(pa.array(kind == ROW)), table.filter(pa.array(kind == REPLY))
    if replies.num_rows:
        home = replies.column("bucket")[0].as_py()
        ids, sizes, held = (joined(rows.column(c), unpack)[0] for c in ("a", "b", "d"))
        order = np.argsort(ids)
        ids, sizes, held = ids[order], sizes[order], held[order]
        uid, key, count = (joined(replies.column(c), unpack)[0] for c in ("a", "b", "c"))
        order = np.lexsort((key, count, uid))
        uid, key = uid[order], key[order]
        starts, shared = runs(uid)
        at = np.searchsorted(ids, uid[starts])
        reach = _leading(sizes[at]) - (sizes[at] - held[at] - shared)
        first = np.arange(len(uid)) - np.repeat(starts, shared) < np.repeat(reach, shared)
        if first.any():
            out.append(pa.Table.from_batches([_table(_tie_rows(key[first].astype(np.uint64), uid[first], buckets, home))]))
    return pa.concat_tables([t.select(_FIELDS).cast(out[0].schema) for t in out])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([
            pa.array(joined(batch.column("a"), unpack)[0]), pa.array(joined(batch.column("b"), unpack)[0]),
            pa.array(joined(batch.column("c"), lambda b: np.frombuffer(b, np.int64))[0])], names=["uid", "n", "signature"])


def _forest_rows(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    node, root = forest(pairs[:, 0], pairs[:, 1])
    return root[node != root], node[node != root]


def _tie(table: pa.Table) -> pa.Table:
    """Ties of one bucket of columns: rows that share one, as a forest."""
    key, ids = joined(table.column("a"), unpack_sorted)[0], joined(table.column("b"), unpack)[0]
    order = np.argsort(key, kind="stable")
    ids = ids[order]
    starts, counts = runs(key[order])
    tied = np.stack([np.repeat(np.minimum.reduceat(ids, starts), counts), ids], 1)
    tied = tied[tied[:, 0] != tied[:, 1]]
    root, node = _forest_rows(tied) if len(tied) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return pa.table({"u": pa.array(root), "v": pa.array(node)})


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(joined(batch.column(c), unpack)[0]) for c in ("a", "b")], names=["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        doc, keys, sizes = incidence(words_of(batch, lower=True), n)
        ends = np.append(0, np.cumsum(sizes))
        blobs = [keys[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
        columns["columns"] = pa.array(blobs, pa.binary())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``left`` x ``right`` (or of ``left`` with itself) whose Jaccard is at least 3/4."""
    own = right is None
    sets = left if own else left + right
    m = len(left)
    sizes = np.array([len(s) for s in sets])
    column = np.unique(np.concatenate(sets), return_inverse=True)[1] if sizes.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
    column, row = column[often], row[often]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    a, b = np.arange(m), (np.arange(m) if own else np.arange(m, len(sets)))
    need = 3 * (sizes[a][:, None] + sizes[b][None, :])       # links when 7 * overlap >= need
    live = 7 * np.minimum(sizes[a][:, None], sizes[b][None, :]) >= need
    live &= sizes[b][None, :] > 0
    if own:
        live &= a[:, None] < b[None, :]
    rest = np.bincount(row, minlength=len(sets))
    overlap = np.zeros(need.shape, np.int64)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, slab):
        live &= 7 * (overlap + np.minimum(rest[a][:, None], rest[b][None, :])) >= need
        x, y = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
        if not len(x):
            break
        s = slice(*np.searchsorted(column, [lo, lo + slab]))
        dense = np.zeros((len(sets), min(slab, width - lo)), np.float32)
        dense[row[s], column[s] - lo] = 1
        overlap[np.ix_(x, y)] += (dense[a[x]] @ dense[b[y]].T).astype(np.int64)
        rest = rest - np.bincount(row[s], minlength=len(sets))
    return np.nonzero(live & (7 * overlap >= need))


def _multiply(table: pa.Table) -> pa.Table:
    """Links of one block or pair of tiles, as a forest."""
    uid = table.column("uid").to_numpy()
    second = table.column("second").to_numpy(zero_copy_only=False).astype(bool)
    sets = [np.frombuffer(b, np.uint64) for b in table.column("columns").to_pylist()]
    left, right = np.flatnonzero(~second), np.flatnonzero(second)
    if len(right):
        x, y = linked_pairs([sets[i] for i in left], [sets[i] for i in right])
        pairs = np.stack([uid[left[x]], uid[right[y]]], 1)
    else:
        x, y = linked_pairs([sets[i] for i in left], None)
        pairs = np.stack([uid[left[x]], uid[left[y]]], 1)
    root, node = _forest_rows(pairs) if len(pairs) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return pa.table({"u": pa.array(root), "v": pa.array(node)})


def _blocks(nodes: DataFrame, tile_rows: int) -> DataFrame:
    """uid and the blocks it takes part in: (component, class, tile, class, tile), and whether it is on the second side."""
    sized = stage(nodes.withColumn("class", F.floor(F.log("n") / F.lit(float(np.log(4 / 3)))).cast("int")))
    whole = sized.groupBy("component").agg(F.count("*").alias("rows")).where("rows > 1")
    sized = sized.join(whole, "component")
    few = sized.where(F.col("rows") <= tile_rows).select("uid", "component", *[F.lit(-1).alias(c) for c in ("c1", "t1", "c2", "t2")], F.lit(False).alias("second"))
    many = sized.where(F.col("rows") > tile_rows)
    tiles = stage(many.groupBy("component", "class").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles")))
    many = many.join(tiles, ["component", "class"]).withColumn("tile", F.pmod(F.xxhash64("uid"), F.col("tiles")).cast("int"))
    same = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "uid", "component", F.col("class").alias("c1"), F.least("tile", "other").alias("t1"), F.col("class").alias("c2"), F.greatest("tile", "other").alias("t2"),
        (F.col("tile") > F.col("other")).alias("second"))
    next_ = tiles.select("component", (F.col("class") - 1).alias("class"), F.col("tiles").alias("far"))
    up = many.join(next_, ["component", "class"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("far") - 1))).select(
        "uid", "component", F.col("class").alias("c1"), F.col("tile").alias("t1"), (F.col("class") + 1).alias("c2"), F.col("other").alias("t2"), F.lit(False).alias("second"))
    before = tiles.select("component", (F.col("class") + 1).alias("class"), F.col("tiles").alias("far"))
    down = many.join(before, ["component", "class"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("far") - 1))).select(
        "uid", "component", (F.col("class") - 1).alias("c1"), F.col("other").alias("t1"), F.col("class").alias("c2"), F.col("tile").alias("t2"), F.lit(True).alias("second"))
    return few.unionByName(same).unionByName(up).unionByName(down)


def near_groups(docs: DataFrame, n: int = N, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``__uid``, ``doc_id``, ``n_shingles`` and ``component`` (least uid reachable by links) of every row."""
    spark: SparkSession = docs.sparkSession
    if "__uid" not in docs.columns:
        docs = numbered(docs)
    docs = docs.select("__uid", F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = bucket_count(docs)
    rows = docs.select(F.col("__uid").alias("uid"), "text")
    common = spark.sparkContext.broadcast(_common(rows, n))
    sent = stage(rows.mapInArrow(lambda it: _send(it, n, buckets, common), _ROWS)
                 .groupBy("bucket").applyInArrow(light(lambda t: _reply(t, buckets)), _ROWS)
                 .groupBy("bucket").applyInArrow(light(lambda t: _lead(t, buckets)), _ROWS))
    sizes = stage(sent.where(F.col("kind") == ROW).select("a", "b", "c").mapInArrow(_rows, "uid long, n long, signature long"))
    ties = (sent.where(F.col("kind") == TIE).groupBy("bucket").applyInArrow(light(_tie), "u long, v long")
            .unionByName(sent.where(F.col("kind") == EDGE).select("a", "b").mapInArrow(_edges, "u long, v long")))
    first = sizes.where("n > 0").groupBy("signature", "n").agg(F.min("uid").alias("u"), F.count("*").alias("copies")).where("copies > 1")
    first = small(stage(first))              # of its own, so that a join with very many copies can be split
    copies = stage(sizes.join(first, ["signature", "n"]).where("uid <> u").select("u", F.col("uid").alias("v")))
    blocks = components(ties.unionByName(copies))
    nodes = blocks.withColumnRenamed("node", "uid").join(copies, F.col("uid") == F.col("v"), "left_anti").join(sizes.select("uid", "n"), "uid")
    parts = stage(_blocks(nodes, tile_rows))
    sets = (rows.join(small(stage(parts.select("uid").distinct())), "uid").select("uid", "text")
            .mapInArrow(lambda it: _sets(it, n), "uid long, columns binary"))
    links = (parts.join(sets, "uid").groupBy("component", "c1", "t1", "c2", "t2")
             .applyInArrow(light(_multiply), "u long, v long"))
    linked = components(links.unionByName(copies))
    ids = docs.select("__uid", "doc_id")
    return (ids.join(sizes.select(F.col("uid").alias("__uid"), F.col("n").alias("n_shingles")), "__uid")
            .join(linked.withColumnRenamed("node", "__uid"), "__uid", "left")
            .withColumn("component", F.coalesce("component", "__uid")))


def _told_apart(rows: DataFrame) -> bool:
    """True where the row number is the document's own id."""
    return rows.where("not (__uid <=> doc_id)").isEmpty()


def near_components(docs: DataFrame, n: int = N, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``."""
    rows = numbered(docs.select("doc_id", "text"))
    groups = near_groups(rows, n, tile_rows)
    if _told_apart(rows):
        return groups.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    groups = stage(groups)
    least = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return groups.join(least, "component").select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = N) -> DataFrame:
    """``docs`` with one row of each group of near-copies: the least ``doc_id``, nulls last, then the row written first."""
    rows = numbered(docs)
    groups = near_groups(rows, n).where("n_shingles > 0")
    if _told_apart(rows):
        gone = groups.where("component <> __uid").select("__uid")
    else:
        groups = stage(groups)
        key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__uid")
        least = groups.groupBy("component").agg(F.min(key)["__uid"].alias("kept"))
        gone = groups.join(least, "component").where("__uid <> kept").select("__uid")
    return rows.join(small(stage(gone)), "__uid", "left_anti").select(docs.columns)
