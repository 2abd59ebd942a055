"""Removal of word runs that an earlier document already has (fixed-block anchors).

Any run of ``window`` words contains a whole block of ``block`` words that starts at a
multiple of ``block`` in its document, as long as ``2 * block - 1 <= window``.  So:

1. every document's non-overlapping blocks are indexed, and every rolling run of ``block``
   words is a probe; both meet in hash buckets, and a probe that meets the indexed block of
   another document is an anchor;
2. anchors are extended: each window that covers an anchor is compared by its hash with
   the windows of all documents, and the least document that has it is found;
3. neighbouring windows that an earlier document has merge to maximal repeats, and their
   words go.

Rows travel as packed arrays (see ``common``).  Keys that several documents of one batch
share are answered in the batch and sent once, and exact copies inside a batch are settled
there, so neither copies nor common passages pile up in a bucket.

Defined cases.  Text null or without words: nothing to remove.  ``doc_id`` null: the row is
neither compared nor changed.  A repeated ``doc_id``: its rows do not remove words from each
other, and each loses what a smaller one has.  Equality is that of 70-bit or longer hashes of the word sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import small, stage
from .common import KEY_BITS, bucket_count, by_bucket, joined, light, pack, pack_sorted, runs, slices, unpack, unpack_sorted, widened, words_of

WINDOW, BLOCK = 13, 7
ENTRY, SPAN, HIT = 0, 1, 2
_ROW = "kind int, bucket int, a binary, b binary, c binary, d binary"
_FEW = 4096              # up to so many anchors of a document are kept as 16-bit keys, more as 32-bit keys
_FIELDS = ["kind", "bucket", "a", "b", "c", "d"]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_FIELDS)


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("uid").to_numpy(), batch.column("doc").to_numpy()


def _spread(kind: int, uid: np.ndarray, first: np.ndarray, second: np.ndarray, buckets: int) -> list[tuple]:
    """Answers for documents, packed by the bucket of the document."""
    of = uid % buckets
    order = np.argsort(of, kind="stable")
    starts, counts = runs(of[order])
    out = []
    for s, n in zip(starts, counts):
        at = order[s:s + n]
        out.append((kind, int(of[at[0]]), pack(uid[at]), pack(first[at]), pack(second[at]), b""))
    return out


def _spans(uid: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of documents merged to (uid, first word, number of words)."""
    order = np.lexsort((at, uid))
    uid, at = uid[order], at[order]
    new = np.append(True, (uid[1:] != uid[:-1]) | (at[1:] > at[:-1] + window)) if len(uid) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(uid)) - 1
    return uid[first], at[first], at[last] + window - at[first]


def _fold(bucket, key: np.ndarray) -> np.ndarray:
    """32 bits of a key; two keys that fold alike only make a window a candidate."""
    return (key ^ (bucket * 0x9E3779B1)) & 0xFFFFFFFF


def _probe(batches: Iterator[pa.RecordBatch], window: int, block: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Index entries and probes of each slice, by bucket of the block's hash."""
    for batch in slices(batches):
        uid, doc = _ids(batch)
        w = words_of(batch, lower=False)
        rows = []
        whole = w.whole()
        order = np.lexsort((doc, whole))
        starts, sizes = runs(whole[order])
        copy = np.zeros(len(doc), bool)
        copy[order] = doc[order] > np.repeat(doc[order][starts], sizes)
        settled = np.flatnonzero(copy & (w.counts >= window))
        if len(settled):
            rows += _spread(SPAN, uid[settled], np.zeros(len(settled), np.int64), w.counts[settled], buckets)
        keys, at = w.grams(block)
        of = w.doc[at]
        keep = ~copy[of] & (w.counts[of] >= window)
        keys, at, of = keys[keep], at[keep], of[keep]
        indexed = (at - w.first[of]) % block == 0
        for bucket, key, src in by_bucket(keys, buckets):
            starts, sizes = runs(key)
            d = doc[of[src]]
            low, high = np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts)
            flag = np.logical_or.reduceat(indexed[src], starts)
            shared = np.flatnonzero(low != high)
            if len(shared):      # several documents of this slice: answered here
                entry = np.repeat(low != high, sizes)
                rows += _spread(HIT, uid[of[src[entry]]], np.zeros(entry.sum(), np.int64), _fold(bucket, key[entry]), buckets)
            # one row of the run stands for it; where all rows have one doc_id, which may be repeated, each of them asks
            first = np.diff(of[src], prepend=-1) != 0
            first &= np.repeat(low == high, sizes)
            first[starts] = True
            run = np.repeat(np.arange(len(starts)), sizes)[first]
            rows.append((ENTRY, bucket, pack_sorted(key[first]), pack(low[run]), pack(uid[of[src[first]]]), np.packbits(flag[run]).tobytes()))
        yield _table(rows)


def _meet(table: pa.Table, buckets: int) -> pa.Table:
    """Probes and index entries of one bucket: keys with an indexed block and two documents."""
    kind = table.column("kind").to_numpy()
    out = [table.filter(pa.array(kind != ENTRY))]
    entries = table.filter(pa.array(kind == ENTRY))
    if entries.num_rows:
        bucket = entries.column("bucket")[0].as_py()
        key, row = joined(entries.column("a"), unpack_sorted)
        doc, uid = joined(entries.column("b"), unpack)[0], joined(entries.column("c"), unpack)[0]
        sizes = np.bincount(row, minlength=entries.num_rows)
        flag = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(entries.column("d").to_pylist(), sizes)])
        order = np.argsort(key, kind="stable")
        key, doc, uid, flag = key[order], doc[order], uid[order], flag[order]
        starts, sizes = runs(key)
        ok = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)) & (np.maximum.reduceat(flag, starts) > 0)
        hit = np.repeat(ok, sizes)
        if hit.any():
            out.append(pa.Table.from_batches([_table(_spread(HIT, uid[hit], np.zeros(hit.sum(), np.int64), _fold(bucket, key[hit]), buckets))]))
    return pa.concat_tables([t.select(_FIELDS).cast(out[0].schema) for t in out])


def _anchors(table: pa.Table) -> pa.Table:
    """One row per document: the folded keys of its anchors."""
    uid, key = joined(table.column("a"), unpack)[0], joined(table.column("c"), unpack)[0]
    order = np.argsort(uid, kind="stable")
    starts, sizes = runs(uid[order])
    blobs = []
    for s, n in zip(starts, sizes):
        keys = key[order[s:s + n]]
        blobs.append(np.unique(keys & 0xFFFF).astype(np.uint16).tobytes() + b"\0" if n <= _FEW else np.unique(keys).astype(np.uint32).tobytes() + b"\1")
    return pa.table({"uid": pa.array(uid[order][starts]), "anchors": pa.array(blobs, pa.binary())})


def _extend(batches: Iterator[pa.RecordBatch], window: int, block: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows that cover an anchor, by bucket of the window's hash."""
    table = np.zeros(1 << 16, bool)
    for batch in slices(batches):
        uid, doc = _ids(batch)
        w = words_of(batch, lower=False)
        keys, at = w.grams(block)
        bucket = ((keys >> np.uint64(KEY_BITS)) % np.uint64(buckets)).astype(np.int64)
        folded = _fold(bucket, (keys & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64))
        first = np.searchsorted(at, w.first)
        hit = np.zeros(len(w.hash) + 1, np.int64)
        for i, blob in enumerate(batch.column("anchors").to_pylist()):
            mine = slice(first[i], first[i + 1])
            if blob[-1]:
                found = np.isin(folded[mine], np.frombuffer(blob[:-1], np.uint32))
            else:
                keep = np.frombuffer(blob[:-1], np.uint16)
                table[keep] = True
                found = table[folded[mine] & 0xFFFF]
                table[keep] = False
            hit[at[mine][found]] = 1
        seen = np.append(0, np.cumsum(hit))
        keys, at = w.grams(window)
        keep = seen[at + window - block + 1] > seen[at]
        keys, at = keys[keep], at[keep]
        check = (w.grams(window, 0xD6E8FEB86659FD93)[0][keep] >> np.uint64(32)).astype(np.int64)
        of = w.doc[at]
        place = at - w.first[of]
        rows = []
        for bucket, key, src in by_bucket(keys, buckets):
            order = np.lexsort((doc[of[src]], check[src], key))
            key, src = key[order], src[order]
            chk, d = check[src], doc[of[src]]
            starts, sizes = runs(np.stack([key, chk], 1).view("i8,i8").ravel())
            later = d > np.repeat(d[starts], sizes)
            if later.any():
                rows += _spread(SPAN, *_spans(uid[of[src[later]]], place[src[later]], window), buckets)
            src, key = src[~later], key[~later]
            rows.append((ENTRY, bucket, pack_sorted(key), pack(check[src]) + pack(place[src]), pack(doc[of[src]]), pack(uid[of[src]])))
        yield _table(rows)


def _compare(table: pa.Table, window: int, buckets: int) -> pa.Table:
    """Windows of one bucket that a smaller document has too."""
    kind = table.column("kind").to_numpy()
    out = [table.filter(pa.array(kind != ENTRY))]
    entries = table.filter(pa.array(kind == ENTRY))
    if entries.num_rows:
        key = joined(entries.column("a"), unpack_sorted)[0]
        doc, uid = joined(entries.column("c"), unpack)[0], joined(entries.column("d"), unpack)[0]
        pairs = []
        for blob, n in zip(entries.column("b").to_pylist(), [len(unpack_sorted(b)) for b in entries.column("a").to_pylist()]):
            cut = 9 + n * blob[0]
            pairs.append((unpack(blob[:cut]), unpack(blob[cut:])))
        check, place = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        order = np.lexsort((check, key))
        key, check, doc, uid, place = key[order], check[order], doc[order], uid[order], place[order]
        starts, sizes = runs(np.stack([key, check], 1).view("i8,i8").ravel())
        later = doc > np.repeat(np.minimum.reduceat(doc, starts), sizes)
        if later.any():
            out.append(pa.Table.from_batches([_table(_spread(SPAN, *_spans(uid[later], place[later], window), buckets))]))
    return pa.concat_tables([t.select(_FIELDS).cast(out[0].schema) for t in out])


def _gather(table: pa.Table) -> pa.Table:
    """One row per document: its merged repeats as starts and lengths in words."""
    uid, start, size = (joined(table.column(c), unpack)[0] for c in ("a", "b", "c"))
    order = np.lexsort((start, uid))
    uid, start, stop = uid[order], start[order], (start + size)[order]
    firsts, counts = runs(uid)
    blobs = []
    for f, n in zip(firsts, counts):
        s, e = start[f:f + n], np.maximum.accumulate(stop[f:f + n])
        new = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
        s, e = s[new], e[np.append(new[1:], n) - 1]
        blobs.append(np.stack([s, e]).astype(np.int32).tobytes())
    return pa.table({"uid": pa.array(uid[firsts]), "spans": pa.array(blobs, pa.binary())})


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__uid``: ``doc_id`` where that is unique, else a row number that is written down."""
    rows, ids = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if rows == ids:
        return docs.withColumn("__uid", F.col("doc_id").cast("long"))
    return stage(docs.withColumn("__uid", F.monotonically_increasing_id()))


def repeated_spans(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``uid`` and ``spans`` of documents that repeat an earlier one; ``docs``: __uid, doc_id, text."""
    if not 0 < 2 * block - 1 <= window:
        raise ValueError("a window must hold a whole block: 2 * block - 1 <= window")
    buckets = bucket_count(docs)
    rows = docs.where("doc_id is not null and text is not null").select(F.col("__uid").alias("uid"), F.col("doc_id").cast("long").alias("doc"), "text")
    met = stage(rows.mapInArrow(lambda it: _probe(it, window, block, buckets), _ROW)
                .groupBy("bucket").applyInArrow(light(lambda t: _meet(t, buckets)), _ROW))
    anchors = small(stage(met.where(F.col("kind") == HIT).groupBy("bucket").applyInArrow(light(_anchors), "uid long, anchors binary")))
    found = (rows.join(anchors, "uid").select("uid", "doc", "text", "anchors")
             .mapInArrow(lambda it: _extend(it, window, block, buckets), _ROW)
             .groupBy("bucket").applyInArrow(light(lambda t: _compare(t, window, buckets)), _ROW))
    spans = found.unionByName(met.where(F.col("kind") == SPAN))
    return spans.where(F.col("kind") == SPAN).groupBy("bucket").applyInArrow(light(_gather), "uid long, spans binary")


class _Cut:
    """Which words of a batch go."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = w = words_of(batch, lower=False)
        change = np.zeros(len(w.hash) + 1, np.int64)
        for i, blob in enumerate(batch.column("__spans").to_pylist()):
            if blob:
                s, e = np.frombuffer(blob, np.int32).reshape(2, -1)
                np.add.at(change, s + w.first[i], 1)
                np.add.at(change, e + w.first[i], -1)
        self.gone = np.cumsum(change[:-1]) > 0
        self.removed = np.add.reduceat(np.append(self.gone, False).astype(np.int64), np.minimum(w.first[:-1], len(self.gone)))
        self.removed[w.counts == 0] = 0


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        cut = _Cut(batch)
        w, kept = cut.words, ~cut.gone
        data = np.where(w.blank, np.uint8(0x20), w.data)
        mark = np.zeros(len(data) + 1, np.int8)
        np.add.at(mark, w.starts[kept], 1)
        np.add.at(mark, w.ends[kept], -1)
        keep = np.cumsum(mark[:-1]) > 0
        at = np.flatnonzero(kept)
        more = at[:-1][w.doc[at[1:]] == w.doc[at[:-1]]] if len(at) else at
        keep[w.ends[more]] = True            # the blank after a kept word that another follows
        text = data[keep].tobytes()
        ends = np.append(0, np.cumsum(keep))[w.offsets]
        sums = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(w.counts, pa.int64()), pa.array(cut.removed, pa.int64()), pa.array(sums)],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text without its repeats; blanks before a repeat and what follows it stay."""
    for batch in slices(batches):
        cut = _Cut(batch)
        w = cut.words
        until = np.append(w.starts[1:], len(w.data))
        last = np.flatnonzero(np.append(w.doc[1:] != w.doc[:-1], True)) if len(w.doc) else np.zeros(0, np.int64)
        until[last] = w.offsets[1:][w.doc[last]]
        mark = np.zeros(len(w.data) + 1, np.int64)
        np.add.at(mark, w.starts[cut.gone], 1)
        np.add.at(mark, until[cut.gone], -1)
        keep = np.cumsum(mark[:-1]) <= 0
        data = w.data[keep].tobytes()
        ends = np.append(0, np.cumsum(keep))[w.offsets]
        old = batch.column("text").is_null().to_numpy(zero_copy_only=False)
        texts = [None if null else data[a:b].decode() for null, a, b in zip(old, ends[:-1], ends[1:])]
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("__spans", "__uid")}
        columns |= {"text": pa.array(texts, pa.string()), "n_words": pa.array(w.counts, pa.int64()), "n_removed": pa.array(cut.removed, pa.int64())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def repeat_digest(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the SHA-256 of the kept words joined by one space."""
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    spans = small(stage(repeated_spans(rows, window, block)))
    return (rows.join(spans.select(F.col("uid").alias("__uid"), F.col("spans").alias("__spans")), "__uid", "left")
            .mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``docs`` with repeats cut from ``text``, plus ``n_words`` and ``n_removed`` (which replace columns of those names)."""
    rows = numbered(docs.drop("n_words", "n_removed"))
    spans = small(stage(repeated_spans(rows.select("__uid", "doc_id", "text"), window, block)))
    return (rows.join(spans.select(F.col("uid").alias("__uid"), F.col("spans").alias("__spans")), "__uid", "left")
            .mapInArrow(_texts, widened(rows.drop("__uid"), "n_words long, n_removed long")))
