import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from motefield.llm import likelihood
from motefield.llm.lattice import Pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = [b" ", b" th", b"th", b"e", b" the", b"the", b"re", b"r", b"t", b"h", b"\xc3", b"\xc3\xa9", b"\xa9"]


def every_way(word, weight):
    """Summed probability of all segmentations, and expected uses of each piece, by enumeration."""
    total, uses = 0.0, Counter()

    def go(at, p, used):
        nonlocal total
        if at == len(word):
            total += p
            for u in used:
                uses[u] += p
            return
        for piece, w in weight.items():
            if word.startswith(piece, at):
                go(at + len(piece), p * w, [*used, piece])
    go(0, 1.0, [])
    return total, {k: v / total for k, v in uses.items()} if total else {}


def test_recursions_match_enumeration():
    pieces = Pieces(PIECES)
    r = random.Random(4)
    weight = {p: r.random() for p in pieces.names}
    scores = np.log([weight[p] for p in pieces.names])
    words = [b"the", b"there", b"e", b"rere", "thé".encode(), b"the", b"tttt"]
    data, lengths = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    got = pieces.log_probability(data, lengths, scores)
    want = [every_way(b" " + w, weight) for w in words]
    assert np.allclose(got, [math.log(t) for t, _ in want])
    times = np.arange(1.0, len(words) + 1)
    uses = pieces.expected_counts(data, lengths, times, scores)
    assert np.allclose(uses, [sum(t * u.get(p, 0) for t, (_, u) in zip(times, want)) for p in pieces.names])


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """Base scores and counts; the lattice sums with given weights are checked apart."""
    held = [zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    words = [WORD.findall(low(t)) for _, t in rows]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    ends = held.count(False)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    p = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    return {d: (h, len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n, sum(p(c[w]) for w in ws) + p(ends)) for (d, _), ws, h in zip(rows, words, held)}, words, c, ends


def test_scores_match_a_plain_model(spark):
    r = random.Random(1)
    vocabulary = ["the", "The", "there", "Straße", "x1", "漢字", "a-b", "zzz"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 5, 60])))) for i in range(60)]
    rows += [(100, None), (101, " \t"), (102, "y" * 3000), (103, "the " * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {g.doc_id: g for g in likelihood.score(df, rounds=2).collect()}
    want, words, c, ends = brute(rows)
    assert set(got) == set(want)
    for d, (h, n, known, total, base) in want.items():
        g = got[d]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (h, n, known, total)
        assert g.base_score == pytest.approx(base, abs=1e-5)
    # the same model by hand
    names, ranks = likelihood.read_vocabulary(likelihood.VOCABULARY)
    first = {}
    for p, k in zip([*names, *(bytes([b]) for b in range(256))], [*ranks, *[ranks.max()] * 256]):
        first[p] = min(k, first.get(p, k))
    pieces = Pieces(list(first))
    w = np.array([1 / (first[p] + 3) for p in pieces.names])
    scores = np.log(w / (2 * w.sum()))
    train = list(c)
    data, lengths = np.frombuffer("".join(train).encode(), np.uint8), np.array([len(x.encode()) for x in train])
    for _ in range(2):
        uses = pieces.expected_counts(data, lengths, np.array([float(c[x]) for x in train]), scores) + 0.1
        total = uses.sum() + ends + 0.1
        scores, end = np.log(uses / total), math.log((ends + 0.1) / total)
    for (d, _), ws in zip(rows, words):
        data = np.frombuffer("".join(ws).encode(), np.uint8)
        want_score = (pieces.log_probability(data, np.array([len(x.encode()) for x in ws], int), scores).sum() + end) / math.log(10)
        assert got[d].score == pytest.approx(want_score, rel=1e-6, abs=1e-5)


def test_null_and_repeated_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", 1), (1, "a b", 2), (None, "a q", 3), (2, None, 4)], "doc_id long, text string, score int")
    got = sorted((g.doc_id or -1, g.n_tokens, g.n_known, g.held_out) for g in likelihood.score(df, rounds=1).collect())
    assert got == [(-1, 3, 2, False), (1, 3, 3, False), (1, 3, 3, False), (2, 1, 1, False)]
    assert likelihood.score(df.limit(0), rounds=1).count() == 0
    alone = likelihood.score(df.where("doc_id is null"), rounds=1).collect()
    assert [(g.train_tokens, g.base_score, g.n_known) for g in alone] == [(0, None, 0)]
