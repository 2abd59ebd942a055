import re
import zlib
from collections import Counter

import numpy as np
import pytest

from motefield.llm import spelling

SF = "/root/testdata/sf0.001/documents.parquet"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    form, out = {}, []
    for w, c in words.items():
        found = [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, []) if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * c:
            form[w] = best
        out.append((w, c, len(found)))
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), c, k, words[form[w]] if w in form else None) for w, c, k in out)


def found(docs):
    out = spelling.variants(docs)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def test_whole_table(spark, side):
    docs = spark.read.parquet(SF)
    got = found(docs)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()]) and len(got) > 100


def made_up():
    """A chain of forms, ties, letters beyond ASCII, edits at both ends, and long words."""
    rng = np.random.default_rng(5)
    texts = []
    for word, n in [("colour", 4000), ("color", 9000), ("colours", 700), ("colourss", 130), ("colourssx", 25), ("xcolourssx", 5), ("straße", 60), ("strasse", 5), ("straêe", 5),
                    ("abcdef", 50), ("abcdeg", 50), ("abcdex", 5), ("bcdefgh", 6), ("abcdefgh", 6), ("l" * 5000, 30), ("l" * 4999, 5), ("l" * 2000 + "m" + "l" * 2999, 5), ("Éclair", 9), ("éclair", 9)]:
        texts += [word] * n
    rng.shuffle(texts)
    return [(i % 97 if i % 13 else None, " ".join(texts[i:i + 40]) + ", " + "- ".join(texts[i:i + 2]).upper()) for i in range(0, len(texts), 40)]


@pytest.mark.parametrize("symbols", [1, 3, 8])
def test_made_up_words(spark, side, symbols):
    rows = made_up()
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    want = brute(rows)
    got = sorted(tuple(r) for r in spelling.variants(docs, symbols).collect())
    assert got == want
    assert max(len(r[1] or "") for r in want) > 4000 and any(r[1] and r[1] != r[2] for r in want)


def test_neighbourhoods_are_all_strings_one_edit_away():
    words, k = ["banana", "a", "ßéz"], 3
    number = lambda s: sum(int(x) * pow(spelling._BASE, i + 1, 1 << 64) for i, x in enumerate(s)) % (1 << 64)
    own, around = spelling.neighbourhoods(words, k)
    for w, o, got in zip(words, own, around):
        s = spelling.symbols_of(np.array([ord(c) for c in w]), k).tolist()
        edits = {tuple(s)} | {tuple(s[:i] + s[i + 1:]) for i in range(len(s))} | {tuple(s[:i] + [c] + s[i + j:]) for i in range(len(s) + 1) for c in range(1, k + 1) for j in (0, 1)}
        assert o == number(s) and set(got.tolist()) == {number(e) for e in edits}


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "12 34 short"), (3, "only once here")], "doc_id long, text string")
    assert found(df) == [] and found(df.limit(0)) == []
    again = spark.createDataFrame([(5, "repeated rows"), (None, "repeated rows")] * 5, "doc_id long, text string")
    assert found(again) == brute([(5, "repeated rows"), (None, "repeated rows")] * 5)
