import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from motefield.llm import lengths, mixing, tokens
from motefield.llm.common import running

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed=0, n=300):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * r.choice([1, 2, 5, 9, 40, 41, 300])), r.choice(["hot"] * 5 + ["a", "b", "c", None])) for i in range(n)]
    return rows + [(1000, None, "a"), (1001, "", None), (1002, "x " * 30000, "b"), (1003, "w w", "hot"), (1003, "w w", "hot")]


@pytest.mark.parametrize("rows", [1, 16, 10 ** 6])
def test_running_sums(spark, side, rows):
    df = spark.createDataFrame([(r.choice(["hot", "hot", "x", None]), i, r.randint(0, 9)) for r in [random.Random(2)] for i in range(500)], "g string, i long, v long")
    got = running(df, ["g"], "v", "before", rows).toPandas().sort_values(["__h"])
    for _, part in got.groupby(got.g.fillna("null")):
        assert (part.before.to_numpy() == np.append(0, part.v.cumsum().to_numpy())[:-1]).all()
    assert len(got) == 500


def test_one_period_meets_every_window_and_share():
    r = random.Random(1)
    for _ in range(60):
        n = r.randint(1, 30)
        q = max(16 * n, r.choice([64, 1024]))
        a = mixing.whole_weights([r.random() ** 3 + 1e-6 for _ in range(n)], q)
        seen = np.zeros(n)
        for i, j, slot in mixing.one_period(a):
            assert j * q // a[i] <= slot < -(-(j + 1) * q // a[i])
            seen[i] += 1
            assert (np.abs(seen - np.array(a) * (slot + 1) / q) < 1).all()
        assert sum(a) == q and (seen == a).all()


def test_shares_are_those_of_the_given_weights_over_the_whole_horizon(spark, side):
    weights = {"hot": 0.3, "rare": 1e-3, "b": 0.5, None: 0.199}
    rows = [(i, "w w", "hot") for i in range(6000)] + [(9000 + i, "w w", s) for i, s in enumerate(["rare", "rare", "b", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, weights=weights, block_tokens=2, slots=2048).select("source", "mix_slot", "mix_release", "mix_deadline").toPandas().sort_values("mix_slot")
    horizon = math.ceil(6000 * sum(map(Fraction, weights.values())) / Fraction(0.3))
    assert got.mix_slot.tolist() == list(range(horizon))       # every document is one block
    assert (got.mix_release <= got.mix_slot).all() and (got.mix_slot < got.mix_deadline).all()
    for s, w in weights.items():
        seen = (got.source.isna() if s is None else got.source == s).cumsum()
        share = Fraction(w) / sum(map(Fraction, weights.values()))
        assert max(abs(n - share * (slot + 1)) for n, slot in zip(seen.tolist(), got.mix_slot.tolist())) < 1


def test_exact_weights():
    assert mixing.exact_weights([3, 1]) == [3, 1] and mixing.exact_weights([0.5, 0.25, 0.125]) == [4, 2, 1]
    w = [0.3, 1e-4, 7.5, 1e-9]
    assert all(Fraction(a, sum(mixing.exact_weights(w))) == Fraction(x) / sum(map(Fraction, w)) for a, x in zip(mixing.exact_weights(w), w))


@pytest.mark.parametrize("repeat", [True, False])
def test_mixture(spark, side, repeat):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix(df, power=0.5, block_tokens=64, slots=64, repeat=repeat).toPandas()
    assert set(zip(got.doc_id, got.source.fillna("-"))) == {(d, s or "-") for d, _, s in rows}
    first = got[got.mix_epoch == 0]
    assert len(first) == len(rows) and (repeat or len(got) == len(rows))
    assert (got.mix_release <= got.mix_slot).all() and (got.mix_slot < got.mix_deadline).all()
    for s, part in first.groupby(first.source.fillna("-")):
        part = part.sort_values(["mix_offset", "mix_tokens"])
        assert (part.mix_offset.to_numpy() == np.append(0, part.mix_tokens.cumsum().to_numpy())[:-1]).all()
    assert got.groupby("mix_slot").source.nunique(dropna=False).max() == 1      # a slot is one source's block
    if repeat:       # every source lasts as long as the mixture; what follows its last start is that document's
        for _, part in got.groupby(got.source.fillna("-")):
            last = part.loc[part.mix_block.idxmax()]
            rate = last.mix_block / last.mix_slot
            assert ((part.mix_block + part.mix_tokens / 64).max() + 2) / rate >= got.mix_slot.max() - 64


def test_given_weights_order_and_odd_tables(spark):
    df = spark.createDataFrame(texts(3), "doc_id long, text string, source string")
    got = mixing.mix(df, weights={"hot": 3, "a": 1, None: 0}, block_tokens=64)
    assert {r.source for r in got.select("source").distinct().collect()} == {"hot", "a"}
    ordered = mixing.in_order(got, 4).withColumn("p", F.spark_partition_id()).toPandas()
    assert (ordered.mix_slot.diff().dropna() >= 0).all() and ordered.p.nunique() > 1
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.withColumn("mix_slot", F.lit("x"))).dtypes[-2] == ("mix_slot", "bigint")


def test_bounds_are_optimal():
    r = random.Random(5)
    for _ in range(200):
        size = np.unique([r.randint(1, 60) for _ in range(r.randint(1, 9))])
        count, k = np.array([r.randint(1, 9) for _ in size]), r.randint(1, 5)
        pad = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in zip(size.tolist(), count.tolist()))
        want = min(pad([*c, int(size[-1])]) for m in range(min(k, len(size))) for c in itertools.combinations(size[:-1].tolist(), m))
        got = lengths.best_bounds(size, count, k)
        assert len(got) <= k and pad(got) == want


def test_batches(spark, side):
    rows = texts(7)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, pack_row string").repartition(3)
    got = lengths.batch(df, buckets=4, batch_tokens=512).toPandas()
    n = {d: len(WORD.findall(t or "")) + 1 for d, t, _ in rows}
    assert len(got) == len(rows) and all(n[d] == t for d, t in zip(got.doc_id, got.pack_tokens))
    size = np.array(sorted({*n.values()}))
    values = [n[d] for d, _, _ in rows]
    bounds = lengths.best_bounds(size, np.array([values.count(x) for x in size]), 4)
    assert all(min(b for b in bounds if b >= t) == length for t, length in zip(got.pack_tokens, got.pack_length))
    for length, part in got.groupby("pack_length"):
        per = max(1, 512 // length)
        assert sorted(part.pack_batch * per + part.pack_row) == list(range(len(part))) and part.pack_row.max() < per
    assert lengths.batch(df.limit(0)).count() == 0


def test_each_length_has_a_bin_until_there_are_too_many(spark, monkeypatch):
    sizes = [1, 1023, 1024, 1025, 1026, 5000, 5001, 10 ** 9]
    df = spark.createDataFrame([(n,) for n in sizes + sizes[:3]], "n long")
    top, count = lengths.histogram(df, "n")
    assert top.tolist() == sizes and count.tolist() == [2, 2, 2, 1, 1, 1, 1, 1]
    monkeypatch.setattr(lengths, "MOST_LENGTHS", 5)
    top, count = lengths.histogram(df, "n")
    assert count.sum() == 11 and top[-1] == 10 ** 9 and len(top) <= 5 and set(top.tolist()) <= set(sizes)


def test_best_fit_takes_the_fullest_row_that_holds():
    r = random.Random(3)
    for _ in range(200):
        cap = r.choice([5, 8, 31, 64])
        size = np.array([r.randint(1, cap) for _ in range(r.randint(0, 60))], np.int64)
        plain = []
        for p in np.argsort(-size, kind="stable"):
            fits = [(cap - sum(row), k) for k, row in enumerate(plain) if cap - sum(row) >= size[p]]
            (plain[min(fits)[1]].append(size[p]) if fits else plain.append([size[p]]))
        rows = tokens.best_fit(size, cap)
        assert sorted(sum(size[m] for m in row) for row in rows) == sorted(map(sum, plain)) and sorted(sum(rows, [])) == list(range(len(size)))


def test_packed_rows_give_every_text_back(spark):
    rows = [(d, t, 1) for d, t, _ in texts(9)] + [(2000, "Ünï <|endoftext|> 漢字\n\n  tail ", 1), (None, "no id", 1), (2001, "long words " * 4000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offsets int").repartition(2)
    with open(tokens.VOCABULARY, "rb") as f:
        encoding = tokens._encoding(f.read(), tokens.SPLIT)
    end, parts = encoding.max_token_value + 1, {}
    for r in tokens.pack_documents(df, row=128, part_bytes=50000).collect():
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == 128 and r.cu_seqlens[0] == 0 and len(r.doc_ids) == len(r.offsets) == len(r.cu_seqlens) - 1
        for d, o, a, b in zip(r.doc_ids, r.offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (places[a:b] == np.arange(b - a)).all() and b > a
            parts.setdefault(d, []).append((o, ids[a:b].tolist()))
        assert (ids[r.cu_seqlens[-1]:] == end).all()
    assert set(parts) == {d for d, t, _ in rows if t is not None}
    for d, t, _ in rows:
        if t is not None and d != 1003:
            at, whole = 0, []
            for o, ids in sorted(parts[d]):
                assert o == at
                at, whole = at + len(ids), whole + ids
            assert whole[-1] == end and encoding.decode(whole[:-1]) == t
    assert sorted(len(x) for _, x in parts[1003]) == [3, 3]
    assert tokens.pack_documents(df.limit(0)).count() == 0
