import hashlib
import random
import re

import pytest

from motefield.llm.repeats import remove_repeats, repeat_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=13):
    """rows: (doc_id, text) -> list of (doc_id, n_words, n_removed, kept)."""
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                least[k] = min(d, least.get(k, d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and least[tuple(w[i:i + n])] < d:
                gone[i:i + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), kept))
    return out


def corpus(seed=0, n=120):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "漢字", "A", "a"]
    passages = [[r.choice(vocabulary) for _ in range(r.choice([12, 13, 14, 40, 70]))] for _ in range(6)]
    rows, kept = [], []
    for d in range(n):
        w = [r.choice(vocabulary) for _ in range(r.choice([0, 3, 13, 60, 200]))]
        if r.random() < 0.5:
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(passages)
        if kept and r.random() < 0.3:
            w = list(r.choice(kept))
            if w and r.random() < 0.5:
                w[r.randrange(len(w))] = "changed"
        kept.append(w)
        rows.append((d * 7 % 1009, "".join(x + r.choice([" ", "\n", "  ", "\t"]) for x in w)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "the " * 5000), (2004, "the " * 30), (2005, "x" * 100000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_digest_matches_brute_force(spark, side, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeat_digest(df).collect()}
    want = {d: (n, g, hashlib.sha256(" ".join(k).encode()).hexdigest()) for d, n, g, k in brute(rows)}
    assert got == want and sum(g for _, g, _ in want.values()) > 1000


def test_repeated_and_null_ids_extra_columns_and_texts(spark):
    p = " ".join(f"p{i}" for i in range(20))
    rows = [(5, f"a b\n{p}  c", 1), (5, p, 2), (None, p, 3), (9, f"x y\n{p}\tz z", 4), (9, None, None), (9, f"x y\n{p}\tz z", 4), (1, "short", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted((tuple(r[c] if r[c] is not None else -1 for c in ("doc_id", "text", "n_words", "n_removed")) for r in remove_repeats(df).collect()), key=str)
    want = sorted([(5, f"a b\n{p}  c", 23, 0), (5, p, 20, 0), (-1, p, 20, 0), (9, "x y\nz z", 24, 20), (9, -1, 0, 0), (9, "x y\nz z", 24, 20), (1, "short", 1, 0)], key=str)
    assert got == want


def test_rows_of_one_id_apart_from_the_smaller_document(spark):
    p, q = (" ".join(f"{c}{i}" for i in range(30)) for c in "pq")
    rows = [(9, f"x y {p} z"), (9, f"{q} other {p}"), (9, f"x y {p} z"), (1, f"a {p} b"), (1, f"a {p} b"), (2, f"c {q}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")      # the rows of 9 in one slice, the smaller documents in another
    try:
        got = sorted((r.doc_id, r.n_words, r.n_removed) for r in repeat_digest(df).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted((d, n, g) for d, n, g, _ in brute(rows)) == [(1, 32, 0), (1, 32, 0), (2, 31, 0), (9, 33, 30), (9, 33, 30), (9, 61, 60)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeat_digest(df).count() == 0 and remove_repeats(df).columns == ["doc_id", "text", "n_words", "n_removed"]


def test_a_window_must_hold_a_block(spark):
    with pytest.raises(ValueError):
        repeat_digest(spark.createDataFrame([(1, "a")], "doc_id long, text string"), window=13, block=8)
