"""Spelling variants: words one edit apart, and the form each variant leads to.

Letters are hashed to a few symbols.  For each word, all strings within one edit of its
reduced spelling are generated, and looked up among the reduced spellings of all words: two
words one edit apart always meet so.  What is found is verified on the words as they are.  Reduced
spellings travel as 64-bit numbers (a sum of powers, so all edits of a word follow from two
running sums), which a collision can only add candidates to.  A word of n letters has about
(2 * symbols + 1) * n neighbours, so very long words grow the work by their length only.

Counting words is a partial count in each task; only the vocabulary takes part in the rest.
Its reduced spellings are broadcast while measured small; beyond that both sides meet by a
shuffle on the number, where Spark may split a crowded one.

A word's form is its near word with the most occurrences, if that has ``RATIO`` times its
own.  Counts grow by that factor along forms, so roots are found in a few doublings.

Defined cases.  Text null or empty: no words.  ``doc_id`` null: an empty text in the hash.
Equal rows count apart, but lose the same letters.  Near words of one count: the first in
code-point order is the form.  A word without near words has itself as root.  Texts and words
are read whole, whatever their length.  An empty table has no words.  Columns other than
``doc_id`` and ``text`` do not matter, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import small, stage
from .common import mix, powers

RUN = r"[A-Za-zÀ-ÿ]+"
DROPS = 199              # one run in so many loses a letter
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SYMBOLS = 8
_BASE = 0xD6E8FEB86659FD93
_LETTERS = 1 << 12       # letters of the words whose neighbours are made at once


def occurrences(docs: DataFrame, drops: int = DROPS, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of a corpus: runs of letters, some of which lose one."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.expr(f"regexp_extract_all(text, '{RUN}', 0)")).alias("run"))
    runs = runs.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run")).where(F.length("run") >= least_letters)
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.expr("cast(h % length(run) as int)")
    word = F.when(F.col("h") % drops == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= least_letters)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def symbols_of(codes: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Symbols 1, 2 .. of letters."""
    return (mix(codes.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)).astype(np.uint64)


def neighbourhoods(words: list[str], symbols: int = SYMBOLS) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of each word's reduced spelling, and the numbers of all strings within one edit of it."""
    sizes = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    own, near = np.zeros(len(words), np.uint64), []
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    p, back = powers(_BASE, int(sizes.max(initial=0)) + 2), np.uint64(pow(_BASE, -1, 1 << 64))
    for k, (lo, n) in enumerate(zip(np.append(0, np.cumsum(sizes)), sizes)):
        s = symbols_of(codes[lo:lo + n], symbols)
        terms = s * p[1:n + 1]
        upto = np.append(np.uint64(0), np.cumsum(terms, dtype=np.uint64))
        own[k] = upto[-1]
        without = upto[:-1] + (upto[-1] - upto[1:]) * back
        replaced = (upto[-1] - terms)[:, None] + every * p[1:n + 1, None]
        inserted = (upto + (upto[-1] - upto) * p[1])[:, None] + every * p[1:n + 2, None]
        near.append(np.unique(np.concatenate([own[k:k + 1], without, replaced.ravel(), inserted.ravel()])))
    return own, near


def _reduced(batches: Iterator[pa.RecordBatch], symbols: int, neighbours: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        ends = np.cumsum([len(w) for w in words])
        at = 0
        while at < len(words):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _LETTERS, "right")))
            own, near = neighbourhoods(words[at:stop], symbols)
            if neighbours:
                cut = pa.array(np.append(0, np.cumsum([len(x) for x in near])).astype(np.int32))
                keys = pa.ListArray.from_arrays(cut, pa.array(np.concatenate(near).view(np.int64)))
            else:
                keys = pa.array(own.view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.slice(at, stop - at).columns, keys], names=["word", "n", "key"])
            at = stop


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Ordered pairs ``word``, ``n``, ``near``, ``near_n`` of words (``word``, ``n``) exactly one edit apart."""
    listed = stage(words.mapInArrow(lambda it: _reduced(it, symbols, False), "word string, n long, key long"))
    asked = words.mapInArrow(lambda it: _reduced(it, symbols, True), "word string, n long, key array<long>").select("word", "n", F.explode("key").alias("key"))
    found = asked.join(small(listed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))), "key")
    return found.where("word <> near and levenshtein(word, near, 1) = 1").select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form that following ``form`` leads to, of words that have one."""
    reached = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = small(reached.select(F.col("word").alias("root"), F.col("root").alias("further")))
        longer = stage(reached.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        reached = longer.select("word", "root")


def variants(docs: DataFrame, symbols: int = SYMBOLS, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of the words of a corpus."""
    words = stage(occurrences(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("least"), F.col("near").alias("word"))).alias("best")
    near = near_words(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best)
    big = F.expr(f"-best.least >= {int(ratio)} * n")
    told = stage(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                         F.when(big, F.col("best.word")).alias("form"), F.when(big, -F.col("best.least")).alias("form_n")))
    ends = small(roots(told.where("form is not null").select("word", "form")))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
