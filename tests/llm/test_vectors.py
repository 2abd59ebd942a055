import math
import random

import numpy as np
import pytest

from motefield.llm import cosine, maxscore


def table(seed, n=260, d=12, scale=1.0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(9, d))
    rows = []
    for i in range(n):
        v = centre[r.integers(9)] + r.normal(size=d) * r.choice([0.0, 0.02, 0.1, 1.0])
        rows.append((int(i * 7 % 1013), [float(np.float32(x * scale)) for x in v], int(r.integers(3))))
    rows += [(5000, None, 1), (5001, [], 1), (5002, [float("nan")] * d, 1), (5003, [0.0] * d, 1), (5004, [1.0, None], 1), (5005, rows[3][1], None), (5006, rows[3][1], rows[3][2]),
             (None, rows[3][1], 1), (5007, [float("inf")] + [0.0] * (d - 1), 2), (5008, [1.0] * 3, 1), (5009, [1.0] * 3, 1)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k=5):
    ok = {(i, tuple(math.floor(256 * x) for x in v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q, a in ok:
        if q % 50 == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q))[:k]
            out |= {(q, r): (i, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("seed,scale", [(0, 1.0), (1, 0.001), (2, 1e9), (3, 40.0)])
def test_top_k_matches_brute_force(spark, side, seed, scale):
    rows = table(seed, scale=scale)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = maxscore.search(df, df.where("vec_id % 50 = 0"), shard_rows=64, query_rows=3, step=16).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == brute_top(rows) and len(got) == len(brute_top(rows))


def test_top_k_of_few_rows_ties_and_copies(spark):
    df = spark.createDataFrame([(50, [1.0], 0), (7, [1.0], 0), (3, [1.0], 0), (3, [1.0], 0)], SCHEMA)
    got = [(r["rank"], r.vec_id, r.score) for r in maxscore.search(df, df.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [(1, 3, 65536), (2, 7, 65536)]
    assert maxscore.search(df.limit(0), df.limit(0)).count() == 0 and maxscore.search(df, df.limit(0)).count() == 0


def brute_links(rows, t):
    good = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ids = [i for i, _, _ in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, v, l) in enumerate(rows):
        for j in range(i):
            b, w, m = rows[j]
            if a is not None and b is not None and l is not None and l == m and good(v) and good(w) and len(v) == len(w):
                x, y = np.array(v), np.array(w)
                if (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= t:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    group = {}
    for i in range(len(rows)):
        group.setdefault(find(i), []).append(i)
    least = {i: min((ids[k] for k in g if ids[k] is not None), default=None) for g in group.values() for i in g}
    return sorted(((ids[i], links[i], least[i], ids[i] is None or ids[i] == least[i]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("seed,t,tile", [(0, 0.98, 1024), (1, 0.98, 9), (2, 0.9, 20), (3, 0.5, 30)])
def test_links_match_brute_force(spark, side, seed, t, tile):
    rows = table(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = cosine.near_vectors(df, threshold=t, tile_rows=tile, sample=100)
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows, t)


def test_repeated_ids_and_empty_tables(spark):
    rows = [(4, [1.0, 0.0], 1), (4, [1.0, 0.001], 1), (2, [0.0, 1.0], 1), (4, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, cosine.near_vectors(df).collect()), key=str) == brute_links(rows, 0.98)
    assert cosine.near_vectors(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        cosine.near_vectors(df, threshold=0)


def test_no_pair_is_given_up_that_links():
    r = np.random.default_rng(8)
    a = r.normal(size=(300, 20))
    a[100:] = a[r.integers(0, 100, 200)] + r.normal(size=(200, 20)) * 0.15
    axes = np.linalg.eigh(a.T @ a)[1][:, ::-1]
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    want = set(zip(*np.nonzero(np.triu(unit @ unit.T >= 0.97, 1))))
    for turn in (axes, None):
        assert set(zip(*cosine.linked(a, None, turn, 0.97, leading=4))) == want
    x, y = cosine.linked(a[:120], a[120:], axes, 0.97)
    assert set(zip(x, y + 120)) == {(i, j) for i, j in want if i < 120 <= j}
