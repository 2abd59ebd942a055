"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of vocabulary A (byte-level BPE) and B (pieces with byte fallback) of one text are
placed by the bytes they stand for.  A slice of documents is one pass over Arrow arrays:
texts are cut where both tokenizers start anew, and the token lists of a slice's different
stretches are flattened and take their parents' stretch numbers; running sums of byte
lengths, less the sum before the stretch, give each token's end; an Acero full outer join
of both token tables on (stretch, end) has one row for each span of bytes between two
ends.  In the order of ends, the token of a span is the next one of its side that ends
there or later, so a span is a link, each overlapping pair of tokens has just one, and
spans at which both sides end close a group.  Both sides end where a stretch does, so the
links and groups of a document are those of its stretches, one after the other.

Links are counted by id pair in each slice (``Table.group_by``), and Spark adds the partial
counts up.  The counts go back to the distinct pairs of each document by ``attach``:
broadcast while measured small, else by a shuffle in which very common pairs are salted.

Both tokenizers start anew at a blank between two characters that are no white space (the
files' rules are checked when they are read; otherwise texts are not cut), so each stretch
of text between such blanks is encoded and aligned once a slice, many of them as one text by A, and
stretches met before are remembered in each worker, up to ``REMEMBERED``.

Defined cases.  Text null or empty, or with bytes that the tokens do not give back (U+2581,
which B takes for a blank): no tokens, all numbers 0 and ``groups`` empty.  The names of
special tokens in a text are plain text.  Equal rows and rows without an id are documents
of their own, and count as often as they stand there.  Texts are read whole; one slice
holds one text at least.  An empty table gives an empty table.  Pairs of one count tie: all
of them are best.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import attach, small, stage
from . import pieces
from .common import slices
from .repeats import numbered

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = pieces.VOCABULARY
REMEMBERED = 1 << 17
LONGEST = 64
_TOGETHER = 512       # new stretches that A encodes as one text
_ALIGNED = "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
_B_BITS = 32


def _byte_of() -> dict[str, int]:
    """Character to byte in a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of each of their ids, and the stretches encoded so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        v, byte = pieces.vocabulary(path_b), _byte_of()
        names = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.bytes_a = [b""] * (names[-1][1] + 1)
        for name, i in names:
            self.bytes_a[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.bytes_a, self.bytes_b = (pa.array(t, pa.binary()) for t in (self.bytes_a, v.bytes))
        self.sizes_a, self.sizes_b = (pc.binary_length(t).cast(pa.int64()) for t in (self.bytes_a, self.bytes_b))
        with open(path_a) as f:
            rules = json.load(f)
        apart = (rules["normalizer"] is None and rules["pre_tokenizer"]["type"] == "ByteLevel" and rules["pre_tokenizer"].get("use_regex", True)
                 and v.words.pattern.startswith(" "))
        self.apart = apart
        self.cut = re.compile(r"(?<=\S) (?=\S)" if apart else r"(?!)")
        self.known, self.coded = pa.array([], pa.string()), tuple(pa.array([], pa.list_(pa.int64())) for _ in "ab")

    def encode(self, stretches: pa.StringArray) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids by A of a blank and each of the different stretches, and by B of each (which adds the blank).

        The stretches met last are remembered.
        """
        stretches = pa.array(stretches, pa.string())
        at = pc.index_in(stretches, self.known)
        new = stretches.filter(at.is_null())
        fresh = self._fresh_a(new), _lists(self.b.encode(new.to_pylist(), num_threads=1) if len(new) else [])
        place = np.where(at.is_valid(), pc.fill_null(at, 0), len(self.known) + np.cumsum(at.is_null()) - 1)
        found = tuple(pa.concat_arrays([old, ids]).take(pa.array(place)) for old, ids in zip(self.coded, fresh))
        self._remember(stretches, found, at)
        return found

    def _fresh_a(self, new: pa.StringArray) -> pa.ListArray:
        """A's ids of stretches, those that no white space ends joined by blanks, at which A starts anew."""
        words = new.to_pylist()
        plain = np.array([not (w[:1].isspace() or w[-1:].isspace() or not w) for w in words], bool)
        joined, rest = [w for w, p in zip(words, plain) if p], [w for w, p in zip(words, plain) if not p]
        if not self.apart:
            joined, rest, plain = [], words, np.zeros(len(words), bool)
        runs = [joined[i:i + _TOGETHER] for i in range(0, len(joined), _TOGETHER)]
        coded = self.a.encode_batch_fast([" " + " ".join(r) for r in runs], add_special_tokens=False) if runs else []
        ids = np.array([i for c in coded for i in c.ids], np.int64)
        ends = np.cumsum(self.sizes_a.to_numpy()[ids])
        stops = np.cumsum(pc.binary_length(pa.array(joined, pa.string())).to_numpy().astype(np.int64) + 1)
        last = np.searchsorted(ends, stops)
        if len(stops) and not (last[-1] == len(ends) - 1 and np.array_equal(ends[last], stops)):
            rest, plain, ids, last = words, np.zeros(len(words), bool), ids[:0], last[:0]      # a token goes over a blank
        own = _lists([c.ids for c in self.a.encode_batch_fast([" " + w for w in rest], add_special_tokens=False)] if rest else [])
        whole = pa.ListArray.from_arrays(pa.array(np.append(0, last + 1).astype(np.int32)), pa.array(ids))
        place = np.where(plain, np.cumsum(plain) - 1, len(whole) + np.cumsum(~plain) - 1)
        return pa.concat_arrays([whole, own]).take(pa.array(place))

    def _remember(self, stretches: pa.StringArray, found: tuple[pa.ListArray, ...], at: pa.Array) -> None:
        """These stretches, then those known before, as long as there is room."""
        short = pc.less_equal(pc.utf8_length(stretches), LONGEST)
        mine = np.flatnonzero(short.to_numpy(zero_copy_only=False))[:REMEMBERED]
        old = np.ones(len(self.known), bool)
        old[pc.drop_null(at).to_numpy()] = False
        kept, mine = pa.array(np.flatnonzero(old)[:REMEMBERED - len(mine)]), pa.array(mine)
        self.known = pa.concat_arrays([stretches.take(mine), self.known.take(kept)])
        self.coded = tuple(pa.concat_arrays([new.take(mine), x.take(kept)]) for new, x in zip(found, self.coded))


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _lists(rows: list[list[int]]) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(rows), np.int64, ends[-1])))


def _bytes(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    """What the ids of each list stand for."""
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, table.take(lists.values)), b"")


def _placed(lists: pa.ListArray, sizes: pa.Array, side: str) -> pa.Table:
    """Stretch, end in it, number and id of each token; ``lists`` are those of the different stretches."""
    ids = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists)
    ends = pc.cumulative_sum(sizes.take(ids))
    first = np.flatnonzero(np.diff(owner.to_numpy(), prepend=-1))
    before = np.zeros(len(lists), np.int64)
    before[owner.to_numpy()[first]] = np.append(0, ends.to_numpy()[first[1:] - 1])
    return pa.table({"stretch": owner, "end": pc.subtract(ends, pa.array(before).take(owner)), f"at_{side}": pa.array(np.arange(len(ids))), side: ids})


def _joined(ids: pa.Array, closes: np.ndarray) -> pa.Array:
    """Ids of each group as text."""
    ends = np.append(0, np.flatnonzero(closes) + 1).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), ids.cast(pa.string())), ",")


def _ends(counts: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))


def _sums(docs: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(docs, weights=values, minlength=n).astype(np.int64)


def _counts(docs: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(docs, minlength=n).astype(np.int64)


def _align(batch: pa.RecordBatch, t: Pair) -> pa.RecordBatch:
    """A row for each document of the batch, and one more with the pair counts of all."""
    n = batch.num_rows
    words = [t.cut.split(x) if x else [] for x in batch.column("text").to_pylist()]
    flat = pa.array([w for ws in words for w in ws], pa.string()).dictionary_encode()
    doc = np.repeat(np.arange(n), [len(ws) for ws in words])
    ids_a, ids_b = t.encode(flat.dictionary)
    wanted = pc.binary_join_element_wise("", flat.dictionary, " ").cast(pa.binary())
    good = pc.and_(pc.equal(_bytes(ids_a, t.bytes_a), wanted), pc.equal(_bytes(ids_b, t.bytes_b), wanted)).take(flat.indices).to_numpy(zero_copy_only=False)
    whole = np.ones(n, bool)
    whole[doc[~good]] = False
    keep = whole[doc]
    n_a = n_b = n_groups = n_links = np.zeros(n, np.int64)
    groups, pairs, times = pa.array([""] * n), pa.array([[]] * n, pa.list_(pa.int64())), pa.array([[]] * n, pa.list_(pa.int64()))
    all_pairs, all_times = [], []
    if keep.any():
        which, owner = flat.indices.to_numpy()[keep], doc[keep]
        used = np.zeros(len(flat.dictionary), bool)
        used[which] = True
        which = (np.cumsum(used) - 1)[which]
        m = int(used.sum())
        lists_a, lists_b = (x.filter(pa.array(used)) for x in (ids_a, ids_b))
        a, b = _placed(lists_a, t.sizes_a, "a"), _placed(lists_b, t.sizes_b, "b")
        met = a.join(b, ["stretch", "end"], join_type="full outer", use_threads=False)
        met = met.take(pc.sort_indices(met, [("stretch", "ascending"), ("end", "ascending")])).combine_chunks()
        has_a, has_b = (met[c].is_valid().to_numpy() for c in ("at_a", "at_b"))
        both, of = has_a & has_b, met["stretch"].to_numpy()
        links, closed = _counts(of, m), _counts(of[both], m)
        n_a, n_b, n_groups, n_links = (_sums(owner, x[which], n) for x in (lists_a.value_lengths().to_numpy(), lists_b.value_lengths().to_numpy(), closed, links))
        texts = pc.binary_join_element_wise(_joined(a["a"].combine_chunks(), both[has_a]), _joined(b["b"].combine_chunks(), both[has_b]), "|")
        texts = pc.binary_join(pa.ListArray.from_arrays(_ends(closed), texts), ";").take(pa.array(which))
        groups = pc.binary_join(pa.ListArray.from_arrays(_ends(_counts(owner, n)), texts), ";")
        pair = pc.add(pc.shift_left(pc.fill_null_backward(met["a"]), _B_BITS), pc.fill_null_backward(met["b"])).combine_chunks()
        pair = pa.ListArray.from_arrays(_ends(links), pair).take(pa.array(which)).flatten()
        mine = pa.table({"doc": np.repeat(owner, links[which]), "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        mine = mine.take(pc.sort_indices(mine["doc"])).combine_chunks()
        ends = _ends(_counts(mine["doc"].to_numpy(), n))
        pairs, times = (pa.ListArray.from_arrays(ends, mine[c].combine_chunks()) for c in ("pair", "count_all"))
        total = mine.group_by(["pair"], use_threads=False).aggregate([("count_all", "sum")])
        all_pairs, all_times = total["pair"].to_pylist(), total["count_all_sum"].to_pylist()
    one = lambda column, last: pa.concat_arrays([column, pa.array([last], column.type)])
    numbers = [one(pa.array(x), None) for x in (n_a, n_b, n_groups, n_links)]
    return pa.RecordBatch.from_arrays([one(batch.column("uid"), None), one(batch.column("doc_id"), None), *numbers, one(groups, None), one(pairs, all_pairs), one(times, all_times)],
                                      names=[c.split()[0] for c in _ALIGNED.split(", ")])


def align(docs: DataFrame, path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B) -> DataFrame:
    """Of documents (``uid``, ``doc_id``, ``text``): numbers of tokens, groups and links, ``groups`` as text, distinct id pairs of links and how often.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``; a pair is A's id * 2**32 + B's.  Rows without a ``uid`` hold the pair counts of a slice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers_of(path_a, path_b)
        for batch in slices(batches):
            yield _align(batch, t)

    return docs.select("uid", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links of it in the whole corpus) and ``best``: 1 where ``n`` is the highest of the pair's B id."""
    parts = aligned.where("uid is null").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    n = stage(parts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")).withColumn("b", F.expr(f"pair & {(1 << _B_BITS) - 1}L")))
    top = n.groupBy("b").agg(F.max("n").alias("top"))
    return n.join(small(stage(top)), "b").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))


def alignment_digest(docs: DataFrame, path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and the SHA-256 of the groups."""
    rows = numbered(docs.select("doc_id", "text")).withColumnRenamed("__uid", "uid")
    told = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = stage(align(rows, path_a, path_b).select(*[c.split()[0] for c in _ALIGNED.split(", ") if "groups s" not in c], told))
    links = aligned.where("uid is not null").select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("uid", F.col("p.pairs").alias("pair"), "p.times")
    sums = (attach(links, pair_counts(aligned), ["pair"], "n").groupBy("uid")
            .agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    have = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return (aligned.where("uid is not null").join(sums, "uid", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", have("n_best"), have("count_sum"), "groups_sha256"))
