"""Token ids packed into rows of one length by best-fit-decreasing.

Texts become ids of a public byte-level vocabulary (its file is read once on the driver and
handed to the tasks), each closed by one end id.  A document longer than a row is cut into
whole rows and a rest; nothing is dropped.  The pieces of a part of the table (about
``PART_BYTES`` of text; rows stay where they are read, so nothing is shuffled) are packed
longest first, each into the open row with the least room that still holds it.  Rooms are
the leaves of a segment tree over 0 .. row length; its nodes count open rows, so the search
is a walk down the tree.

A packed row holds ``ids`` and ``positions`` as little-endian arrays (16 bits, 32 for larger
vocabularies) of the full row length, ``cu_seqlens`` (the cumulative lengths of its
segments, from 0), and for each segment the ``doc_ids`` entry and the token ``offsets`` entry
in its document.  Positions start again at 0 in each segment; what is left of a row is the
end id at positions that go on from 0.

Defined cases.  Text null: no segment.  Text empty: the end id alone.  ``doc_id`` null: a
segment with a null id.  Equal rows are packed each.  Ids of special tokens are never read
out of a text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROW = 2048
PART_BYTES = 16 << 20
_loaded: dict = {}


class Rooms:
    """Open rows by their room: a segment tree whose nodes count the rows below them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int]:
        """Room and number of the row with the least room of ``least`` or more; (-1, -1) if there is none."""
        node, count = least + self.leaves, self.count
        if not count[node]:
            while node and (node & 1 or not count[node + 1]):      # up to the first right neighbour with rows
                node >>= 1
            if not node:
                return -1, -1
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of piece numbers: pieces in order of size, largest first, each into the fullest row that holds it."""
    rooms, rows = Rooms(capacity), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        room, row = rooms.take(size)
        if row < 0:
            room, row = capacity, len(rows)
            rows.append([])
        rows[row].append(piece)
        if room > size:
            rooms.add(room - size, row)
    return rows


def _encoding(raw: bytes, pattern: str):
    import tiktoken
    key = (hash(raw), pattern)
    if key not in _loaded:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        _loaded[key] = tiktoken.Encoding("byte pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]


def pack_rows(ids: list[np.ndarray], docs: list, row: int, end: int, dtype: str) -> pa.RecordBatch:
    """Packed rows of documents' ids (each with its end id)."""
    doc, offset, sizes = [], [], []
    for i, x in enumerate(ids):
        for at in range(0, len(x), row):
            doc.append(i)
            offset.append(at)
            sizes.append(min(row, len(x) - at))
    out = []
    for members in best_fit(np.array(sizes, np.int64), row):
        matrix, places = np.full(row, end, dtype), np.zeros(row, dtype)
        bounds = np.append(0, np.cumsum([sizes[m] for m in members]))
        for m, a, b in zip(members, bounds[:-1], bounds[1:]):
            matrix[a:b] = ids[doc[m]][offset[m]:offset[m] + sizes[m]]
            places[a:b] = np.arange(b - a)
        places[bounds[-1]:] = np.arange(row - bounds[-1])
        out.append((matrix.tobytes(), places.tobytes(), bounds.tolist(), [docs[doc[m]] for m in members], [offset[m] for m in members]))
    columns = list(zip(*out)) if out else [[]] * 5
    types = [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["ids", "positions", "cu_seqlens", "doc_ids", "offsets"])


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = SPLIT, row: int = ROW, part_bytes: int = PART_BYTES) -> DataFrame:
    """``ids``, ``positions``, ``cu_seqlens``, ``doc_ids``, ``offsets``: one row per packed row."""
    with open(vocabulary, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(raw.value, pattern)
        end = encoding.max_token_value + 1
        dtype = "<u2" if max(end, row) < 1 << 16 else "<u4"
        ids, ids_of, held = [], [], 0
        for batch in slices(batches, 1 << 20):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text is not None:
                    ids.append(np.array([*encoding.encode_ordinary(text), end], dtype))
                    ids_of.append(doc)
                    held += len(text)
            if held >= part_bytes:
                yield pack_rows(ids, ids_of, row, end, dtype)
                ids, ids_of, held = [], [], 0
        if ids:
            yield pack_rows(ids, ids_of, row, end, dtype)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, offsets array<long>")
