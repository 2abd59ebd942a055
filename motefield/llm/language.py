"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1 that is a function of its code point.  A
trigram is bound from three of them: the first letter's vector rotated twice, times the
second's rotated once, times the third's.  A text is the bundle (sum) of its trigrams, a
language the bundle of its training documents' unit vectors, and a document is given to the
language whose prototype has the largest cosine with it.

Texts are lower-cased; a run of anything but letters counts as one blank, also at both ends.
Bundles and prototypes are whole numbers (a prototype is its unit vector in steps of
1 / ``STEPS``), so their products are exact sums and do not depend on how rows are batched.

Only the prototypes are learned, from labelled documents outside the held-out quarter.  At
most about ``SAMPLE`` documents a language take part, drawn by a hash of id and text (all of
them, where a language has fewer); prediction reads every text whole, however long.

Defined cases.  Text null or without a letter: ``und``, score 0.  A negative cosine scores 0.
Equal cosines: the language first in order.  ``doc_id`` null: predicted, not held out, not
learned from.  No labelled document at all: every document is ``und``.  Equal rows are
predicted apart, and learned from as often as they are drawn.  An empty table gives an empty
one.  Columns named ``lang_pred`` and ``score`` are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, utf8, widened

DIMENSIONS = 1024
SAMPLE = 2000
STEPS = 1 << 14
UNKNOWN = "und"
_ROWS, _WIDTH, _DENSE = 256, 4096, 1 << 24


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            out[c] = ord(s.lower()[0])
    return out


def letter_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row of +1 and -1 per code point."""
    words = mix(codes.astype(np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(1, dimensions // 64 + 1, dtype=np.uint64))
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(codes), dimensions // 8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _streams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts (0 for a blank) and the row of each; blanks are single and stand at both ends."""
    data, offsets = utf8(batch.column("text"))
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    lengths = np.diff(np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets])
    letters, row = _letters()[codes], np.repeat(np.arange(len(lengths)), lengths)
    keep = letters > 0
    keep[1:] |= (letters[1:] == 0) & (letters[:-1] > 0) & (row[1:] == row[:-1])
    letters, row = letters[keep], row[keep]
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(row)) - 1 if len(row) else first
    front = first[letters[first] > 0] if len(first) else first
    back = last[letters[last] > 0] if len(last) else last
    at = np.concatenate([back + 1, front])                       # in this order where one text ends and the next begins
    return np.insert(letters, at, 0), np.insert(row, at, np.concatenate([row[back], row[front]]))


def bundles(batch: pa.RecordBatch, dimensions: int = DIMENSIONS) -> Iterator[tuple[slice, np.ndarray]]:
    """Row ranges of the batch and their texts' bundles (zero without a letter)."""
    letters, row = _streams(batch)
    codes, ids = np.unique(letters, return_inverse=True)
    size, vectors = len(codes), letter_vectors(codes, dimensions)
    same = row[2:] == row[:-2]
    key = ((ids[:-2] * size + ids[1:-1]) * size + ids[2:])[same]
    row = row[2:][same]
    if size ** 3 <= _DENSE:
        grams = np.flatnonzero(np.bincount(key, minlength=1))
        place = np.zeros(int(grams[-1]) + 1 if len(grams) else 1, np.int64)
        place[grams] = np.arange(len(grams))
        key = place[key]
    else:
        grams, key = np.unique(key, return_inverse=True)
    if not len(key):
        grams = grams[:0]
    ends = np.searchsorted(row, np.arange(0, batch.num_rows + _ROWS, _ROWS))
    spans = [slice(i, min(i + _ROWS, batch.num_rows)) for i in range(0, batch.num_rows, _ROWS)]
    exact = np.float32 if len(key) < 1 << 24 else np.float64          # no sum goes beyond its whole numbers
    sums = [np.zeros((s.stop - s.start, dimensions), exact) for s in spans]
    for lo in range(0, len(grams), _WIDTH):
        g = grams[lo:lo + _WIDTH]
        bound = np.roll(vectors, 2, 1)[g // (size * size)] * np.roll(vectors, 1, 1)[g // size % size] * vectors[g % size]
        for k, s in enumerate(spans):
            mine = slice(ends[k], ends[k + 1])
            at = key[mine] - lo
            inside = (at >= 0) & (at < len(g)) if len(grams) > _WIDTH else slice(None)
            counts = np.bincount((row[mine][inside] - s.start) * len(g) + at[inside], minlength=(s.stop - s.start) * len(g))
            sums[k] += counts.reshape(-1, len(g)).astype(exact) @ bound
    yield from zip(spans, sums)


def _length(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(1, keepdims=True))


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = _length(vectors)
    return np.divide(vectors, length, out=np.zeros(vectors.shape), where=length > 0)


def cosines(vectors: np.ndarray, profiles: np.ndarray) -> np.ndarray:
    """Of each text with each prototype, both in whole numbers; 0 for a text without a letter."""
    product, length = vectors.astype(np.float64) @ profiles.T, _length(vectors) * _length(profiles).T
    return np.divide(product, length, out=np.zeros(product.shape), where=length > 0)


def _partial(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        total: dict[str, np.ndarray] = {}
        names = batch.column("lang").to_pylist()
        for s, vectors in bundles(batch, dimensions):
            for name, v in zip(names[s], np.rint(_unit(vectors) * 2 ** 20)):
                total[name] = total.get(name, 0) + v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["lang", "vector"])


def _total(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b) for b in table.column("vector").to_pylist())
    return pa.table({"lang": table.column("lang").slice(0, 1), "vector": pa.array([total.tobytes()], pa.binary())})


def held_out():
    """True for the quarter of documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def prototypes(docs: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, unit vectors in whole steps of 1 / ``STEPS``, one row each."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "lang", "text")
    share = known.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    drawn = known.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    found = (drawn.select("lang", "text").mapInArrow(lambda it: _partial(it, dimensions), "lang string, vector binary")
             .groupBy("lang").applyInArrow(_total, "lang string, vector binary").orderBy("lang").collect())
    vectors = np.array([np.frombuffer(r.vector) for r in found]).reshape(-1, dimensions)
    return [r.lang for r in found], np.rint(_unit(vectors) * STEPS)


def predict(docs: DataFrame, names: list[str], profiles: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of those names are replaced)."""
    docs = docs.drop("lang_pred", "score")
    dimensions = profiles.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            label, score = [], []
            for _, vectors in bundles(batch, dimensions):
                cosine = cosines(vectors, profiles) if names else np.zeros((len(vectors), 1))
                best = cosine.argmax(1)
                blank = ~vectors.any(1)
                label += [UNKNOWN if b or not names else names[k] for b, k in zip(blank, best)]
                score.append(np.where(blank, 0.0, np.clip(cosine[np.arange(len(best)), best], 0, 1)))
            columns = [*batch.columns, pa.array(label, pa.string()), pa.array(np.concatenate(score))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, widened(docs, "lang_pred string, score double"))


def identify(docs: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    names, profiles = prototypes(docs, sample, dimensions)
    return (predict(docs.select("doc_id", "text"), names, profiles)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
