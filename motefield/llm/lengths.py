"""Padded batches from optimal length buckets.

The lengths of all documents (words and one end) make a histogram of one bin for each
length.  Dynamic programming over it chooses ``buckets`` upper bounds that minimise padding
(a document is padded to its bucket's bound).  n different lengths take n * n / 2 tokens, so
up to some 3 * 10**10 tokens there cannot be more than ``MOST_LENGTHS``; a corpus that has
more of them is binned in the narrowest even steps that make do.  Inside a bucket,
documents fill batches of as many rows as the token budget holds, one at least.

Rows get their place in a bucket from running sums over ranges of a row hash, so a bucket
with a third of all documents is no single task's.  With ``keep_order`` the ranges are those
of the files as read: each bucket keeps the order of the table, that of a mixture for one.

Defined cases.  Text null or without words: length 1.  Equal rows are separate documents.
A document longer than the budget is a batch of its own.  An empty table has no buckets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import computed, stage
from .common import as_read, running, word_count

BUCKETS = 16
BATCH_TOKENS = 16384
MOST_LENGTHS = 1 << 18


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds out of ``lengths`` (ascending) that minimise the padding of ``counts`` documents.

    The cost of one more bucket is split at a middle length first; what is best to its left
    and right then lies on the same side (the costs meet the quadrangle inequality).
    """
    n = len(lengths)
    if not n:
        return []
    rows = np.append(0, np.cumsum(counts)).astype(object if counts.sum() * int(lengths[-1]) > 1 << 62 else np.int64)
    tokens = np.append(0, np.cumsum(counts * lengths)).astype(rows.dtype)
    cost = lambda i, j: lengths[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])     # bins i .. j-1 in one bucket
    best = np.array([cost(0, j) for j in range(n + 1)], rows.dtype)
    best[0] = 0
    choice = []
    for _ in range(min(buckets, n) - 1):
        new, frm = best.copy(), np.full(n + 1, -1)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            c = best[i] + cost(i, j)
            at = int(np.argmin(c))
            if c[at] < best[j]:
                new[j], frm[j] = c[at], i[at]
            split = int(i[at])
            todo += [(lo, j - 1, a, split), (j + 1, hi, split, b)]
        best = new
        choice.append(frm)
    bounds, j = [], n
    for frm in reversed(choice):
        if j and frm[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(frm[j])
    if j:
        bounds.append(int(lengths[j - 1]))
    return bounds[::-1]


def histogram(measured: DataFrame, length: str) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, ascending, and how many rows have each; beyond ``MOST_LENGTHS`` of them, the longest of each bin."""
    counts = stage(measured.groupBy(F.col(length).alias("top")).agg(F.count("*").alias("rows")))
    step, n = 1, counts.count()
    while n > MOST_LENGTHS:
        step *= 2
        n = counts.select(F.expr(f"(top + {step - 1}) div {step}")).distinct().count()
    found = counts.groupBy(F.expr(f"(top + {step - 1}) div {step}").alias("bin")).agg(F.max("top").alias("top"), F.sum("rows").alias("rows")).orderBy("bin").toArrow()
    return found.column("top").to_numpy(), found.column("rows").to_numpy()


def batch(docs: DataFrame, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, keep_order: bool = False) -> DataFrame:
    """``docs`` with ``pack_tokens``, ``pack_length`` (its bucket's bound), ``pack_batch`` and ``pack_row``.

    A batch is named by its bucket's bound and its number there.  Columns of these names are replaced.
    """
    names = ["pack_tokens", "pack_length", "pack_batch", "pack_row"]
    docs = docs.drop(*names)
    measured = computed(as_read(docs) if keep_order else docs, {"pack_tokens": word_count() + 1})      # counted once for all bounds
    lengths, counts = histogram(measured, "pack_tokens")
    bounds = best_bounds(lengths, counts, buckets)
    listed = ", ".join(f"{b}L" for b in bounds) or "1L"
    measured = measured.withColumn("pack_length", F.expr(f"filter(array({listed}), b -> b >= pack_tokens)[0]")).withColumn("__one", F.lit(1).cast("long"))
    placed = running(measured, ["pack_length"], "__one", "__place", order=("__file", "__at") if keep_order else None, total=int(counts.sum()))
    rows = f"greatest(1L, {int(batch_tokens)} div pack_length)"
    return placed.select(*docs.columns, "pack_tokens", "pack_length", F.expr(f"__place div {rows}").alias("pack_batch"), F.expr(f"__place % {rows}").alias("pack_row"))
