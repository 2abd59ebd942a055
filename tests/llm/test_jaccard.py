import random
import re

import numpy as np
import pytest

from motefield.llm import jaccard
from motefield.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def columns(text, n=5):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows):
    """(row number, size, component as row numbers)."""
    sets = [columns(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(d, len(s), find(i)) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, n=250):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)] + ["É", "Straße", "ABC", "abc"]
    base = [[r.choice(vocabulary) for _ in range(r.choice([4, 9, 40, 90]))] for _ in range(8)]
    passage = [r.choice(vocabulary) for _ in range(50)]
    rows = []
    for d in range(n):
        if r.random() < 0.6:
            w = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            w = w[:r.choice([len(w), len(w), len(w) - len(w) // 5])]
        else:
            w = [r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 5, 30, 120]))] + (passage if r.random() < 0.5 else [])
        rows.append((d * 13 % 1009, (r.choice([str.upper, str]) if r.random() < .2 else str)(" ".join(w))))
    rows += [(5000, None), (5001, " "), (5002, "same " * 4000), (5003, "same " * 10)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,tile", [(0, 256), (1, 8), (2, 3)])
def test_components_match_brute_force(spark, side, seed, tile):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_components(df, tile_rows=tile).collect()}
    found = brute(rows)
    least = {}
    for d, _, c in found:
        least[c] = min(d, least.get(c, d))
    assert got == {(d, n, least[c]) for d, n, c in found}
    assert len(set(least.values())) < len(rows) * 0.8


def test_null_and_repeated_ids_and_extra_columns(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text, 1), (3, text, 1), (None, text, 2), (7, "other words " * 9, 3), (7, None, 4), (8, None, 5), (9, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component int")
    kept = sorted(jaccard.keep_one(df).collect(), key=str)
    assert sorted(map(str, kept)) == sorted(str(r) for r in df.where("component in (1, 3, 4, 5, 6)").dropDuplicates().collect())
    ids = jaccard.near_components(df.drop("component")).where("n_shingles = 6").collect()
    assert [r.component_id for r in ids] == [3, 3, 3]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_components(df).count() == 0 and jaccard.keep_one(df).count() == 0


def test_slabs_and_discarding_do_not_change_the_links():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 40, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(60) < p], r.integers(0, 1 << 40, k).astype(np.uint64)])) for p in (1, .95, .9, .8) for k in (0, 3, 9, 20)]
    sets.append(np.zeros(0, np.uint64))
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i]) and len(sets[j])
            and 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (len(sets[i]) + len(sets[j]))}
    for slab in (7, 2048):
        assert set(zip(*map(list, jaccard.linked_pairs(sets, None, slab)))) == want
        x, y = jaccard.linked_pairs(sets[:6], sets[6:], slab)
        assert {(i, j + 6) for i, j in zip(x, y)} == {(i, j) for i, j in want if i < 6 <= j}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, 1000 + i) for i in range(300)]
    df = spark.createDataFrame(chain + star + [(5, 5), (9, 8)], "u long, v long").repartition(9)
    got = {r.node: r.component for r in components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {1000 + i: 7 for i in range(300)} | {7: 7, 8: 8, 9: 8}
    assert got == want
