"""Scoring documents by a subword lattice model and by a word unigram base.

The vocabulary is an existing one; its pieces' weights start from its own order (a piece of
rank r weighs 1 / (r + 3)) and are then learned from the training documents: ``rounds``
times, expected uses of each piece over all segmentations of all training words are counted
and normalised, with ``PRIOR`` added to each piece and to the end of a document.  The
probability of a text is the product over its words of the sum over all segmentations (see
``lattice``; white space only parts words) times that of one end.

Every count covers all training documents.  A slice of documents sends each of its distinct
words once to the word's hash bucket, as packed arrays, and keeps which documents have it
how often.  A bucket adds up training counts, scores its words once, and answers each slice
for the words that it sent; the slice adds up its documents.  So all that moves grows with
the text, and no table of words is sent to all tasks; only the weights of the fixed
vocabulary are.

Defined cases.  Text null or without words: the end alone.  ``doc_id`` null: scored, not
held out, not learned from.  Rows with one ``doc_id`` are scored apart.  Bytes that no
piece starts with are single-byte pieces of the prior weight.  No training document:
``train_tokens`` 0 and a null base score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .common import bucket_count, by_bucket, joined, light, pack, slices, unpack, words_of
from .lattice import Pieces, read_vocabulary
from .repeats import numbered

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 4
PRIOR = 0.1
SMOOTHING = 0.1
_SENT = "slice long, bucket int, keys binary, text binary, sizes binary, trained binary, docs binary, uid binary, tf binary"
_MERGED = "bucket int, text binary, sizes binary, trained binary, slices binary, sent binary, words binary"


def _send(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct words of a slice by bucket, each with the documents that have it."""
    names = [f.split()[0] for f in _SENT.split(", ")]
    for batch in slices(batches):
        uid, train = batch.column("uid").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False)
        w = words_of(batch, lower=True)
        keys, first, word = np.unique(w.hash, return_index=True, return_inverse=True)
        pair, tf = np.unique(word * len(uid) + w.doc, return_counts=True)
        word, doc = pair // len(uid), pair % len(uid)
        docs = np.bincount(word, minlength=len(keys))
        begin = np.append(0, np.cumsum(docs))
        trained = np.bincount(word, tf * train[doc], minlength=len(keys)).astype(np.int64)
        sizes = (w.ends - w.starts)[first]
        rows = []
        for bucket, _, src in by_bucket(keys, buckets):
            s, n = w.starts[first[src]], sizes[src]
            at = np.repeat(s - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())
            mine = np.repeat(begin[src] - np.append(0, np.cumsum(docs[src]))[:-1], docs[src]) + np.arange(docs[src].sum())
            rows.append((int(uid[0]), bucket, keys[src].tobytes(), w.data[at].tobytes(), pack(n), pack(trained[src]), pack(docs[src]), pack(uid[doc[mine]]), pack(tf[mine])))
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 7]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _merge(table: pa.Table) -> pa.Table:
    """One row per bucket: each distinct word once, and which of them each slice has sent, in its order."""
    keys, row = joined(table.column("keys"), lambda b: np.frombuffer(b, np.uint64))
    text = np.frombuffer(b"".join(table.column("text").to_pylist()), np.uint8)
    sizes, trained = (joined(table.column(c), unpack)[0] for c in ("sizes", "trained"))
    _, one, word = np.unique(keys, return_index=True, return_inverse=True)
    begin, n = np.append(0, np.cumsum(sizes))[:-1], sizes[one]
    letters = np.repeat(begin[one] - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())
    total = np.bincount(word, trained, len(one)).astype(np.int64)
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "text": [text[letters].tobytes()], "sizes": [pack(n)], "trained": [pack(total)],
                     "slices": [table.column("slice").to_numpy().astype(np.int64).tobytes()], "sent": [pack(np.bincount(row, minlength=table.num_rows))],
                     "words": [pack(word)]})


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = joined(batch.column("trained"), unpack)[0]
        yield pa.RecordBatch.from_arrays([pa.array([int(c.sum())]), pa.array([int((c > 0).sum())])], names=["tokens", "kinds"])


def _expect(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    pieces, scores = model.value
    total = np.zeros(len(pieces.names))
    for batch in batches:
        for row in batch.to_pylist():
            n, c = unpack(row["sizes"]), unpack(row["trained"])
            keep = c > 0
            letters = np.frombuffer(row["text"], np.uint8)[np.repeat(keep, n)]
            total += pieces.expected_counts(letters, n[keep], c[keep].astype(float), scores)
    used = np.flatnonzero(total)
    # whole millionths: sums are then the same however rows are batched or retried
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.rint(total[used] * 1e6).astype(np.int64))], names=["piece", "uses"])


def learn(words: DataFrame, documents: int, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[Pieces, np.ndarray, float]:
    """Pieces, their natural log weights, and that of the end of a document."""
    names, ranks = read_vocabulary(vocabulary)
    first: dict[bytes, float] = {}
    for name, rank in zip([*names, *(bytes([b]) for b in range(256))], [*ranks, *[float(ranks.max())] * 256]):
        first[name] = min(rank, first.get(name, rank))
    pieces = Pieces(list(first))
    weight = np.array([1 / (first[p] + 3) for p in pieces.names])
    scores, end = np.log(weight / (2 * weight.sum())), np.log(0.5)
    spark = words.sparkSession
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((pieces, scores))
        found = (words.select("text", "sizes", "trained").mapInArrow(lambda it: _expect(it, model), "piece long, uses long")
                 .groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow())
        uses = np.full(len(pieces.names), PRIOR)
        uses[found.column("piece").to_numpy()] += found.column("uses").to_numpy() / 1e6
        total = uses.sum() + documents + PRIOR
        scores, end = np.log(uses / total), np.log((documents + PRIOR) / total)
    return pieces, scores, float(end)


def _answer(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """To each slice, the training counts and the log10 probabilities of the words it sent to a bucket."""
    pieces, scores = model.value
    for batch in batches:
        for row in batch.to_pylist():
            n, c, sent, word = (unpack(row[k]) for k in ("sizes", "trained", "sent", "words"))
            lattice = pieces.log_probability(np.frombuffer(row["text"], np.uint8), n, scores) / np.log(10)
            ends = np.append(0, np.cumsum(sent))
            for lo in range(0, len(sent), 256):
                part = [word[a:b] for a, b in zip(ends[lo:lo + 256], ends[lo + 1:lo + 257])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(row["slices"], np.int64)[lo:lo + 256]), pa.array([row["bucket"]] * len(part), pa.int32()), pa.array([None] * len(part), pa.binary()),
                    pa.array([None] * len(part), pa.binary()), pa.array([None] * len(part), pa.binary()),
                    pa.array([pack(c[w]) for w in part], pa.binary()), pa.array([lattice[w].tobytes() for w in part], pa.binary())], names=_PARTS)


_PARTS = ["slice", "bucket", "docs", "uid", "tf", "counts", "lattice"]


def _add(table: pa.Table) -> pa.Table:
    """Sums of the documents of one slice."""
    rows = table.to_pylist()
    answers = {r["bucket"]: r for r in rows if r["counts"] is not None}
    asked = [r for r in rows if r["counts"] is None]
    uid, tf, count, lattice = [], [], [], []
    for r in asked:
        docs, a = unpack(r["docs"]), answers[r["bucket"]]
        uid.append(unpack(r["uid"]))
        tf.append(unpack(r["tf"]))
        count.append(np.repeat(unpack(a["counts"]), docs))
        lattice.append(np.repeat(np.frombuffer(a["lattice"]), docs))
    uid, tf, count, lattice = (np.concatenate(x) for x in (uid, tf, count, lattice))
    ids, at = np.unique(uid, return_inverse=True)
    order = np.lexsort((lattice, tf, at))                          # additions in an order of their own, however slices came
    at, tf, count, lattice = at[order], tf[order], count[order], lattice[order]
    add = lambda v: np.bincount(at, v * tf, len(ids))
    return pa.table({"uid": ids, "words": add(1.0).astype(np.int64), "known": add(count > 0).astype(np.int64),
                     "base": add(np.log10(count + SMOOTHING)), "lattice": add(lattice)})


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))


def score(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    docs = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    train = F.col("doc_id").isNotNull() & ~held_out()
    buckets = bucket_count(docs)
    sent = stage(docs.select(F.col("__uid").alias("uid"), "text", train.alias("train")).where("text is not null")
                 .mapInArrow(lambda it: _send(it, buckets), _SENT))
    words = stage(sent.select("slice", "bucket", "keys", "text", "sizes", "trained").groupBy("bucket").applyInArrow(light(_merge), _MERGED))
    documents = docs.where(train).count()
    sums = words.select("trained").mapInArrow(_totals, "tokens long, kinds long").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    tokens, kinds = sums[0] + documents, sums[1] + (documents > 0)
    pieces, scores, end = learn(words, documents, vocabulary, rounds)
    model = spark.sparkContext.broadcast((pieces, scores))
    answers = words.mapInArrow(lambda it: _answer(it, model), "slice long, bucket int, docs binary, uid binary, tf binary, counts binary, lattice binary")
    asked = sent.select("slice", "bucket", "docs", "uid", "tf", *[F.lit(None).cast("binary").alias(c) for c in ("counts", "lattice")])
    parts = asked.unionByName(answers).groupBy("slice").applyInArrow(light(_add), "uid long, words long, known long, base double, lattice double")
    out = docs.select("__uid", "doc_id").join(parts.withColumnRenamed("uid", "__uid"), "__uid", "left")
    have = lambda c: F.coalesce(F.col(c), F.lit(0))
    n = have("words") + 1
    final = float(np.log10(documents + SMOOTHING))
    share = float(np.log10(tokens + SMOOTHING * (kinds + 1)))
    return out.select("doc_id", held_out().alias("held_out"), n.alias("n_tokens"), (have("known") + F.lit(int(documents > 0))).alias("n_known"),
                      F.lit(tokens).cast("long").alias("train_tokens"),
                      (F.lit(None).cast("double") if not tokens else have("base") + F.lit(final) - n * F.lit(share)).alias("base_score"),
                      (have("lattice") + F.lit(end / np.log(10))).alias("score"))
