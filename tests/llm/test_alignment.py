import hashlib
from collections import Counter, defaultdict

import sentencepiece
from tokenizers import Tokenizer

from motefield.llm import alignment

SF = "/root/testdata/sf0.001/documents.parquet"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """From whole texts, pair by pair: the columns of each row."""
    a_side, b_side = Tokenizer.from_file(alignment.VOCABULARY_A), sentencepiece.SentencePieceProcessor(model_file=alignment.VOCABULARY_B)
    a_side.encode_special_tokens = True
    byte = alignment._byte_of()
    names = {i: n for n, i in a_side.get_vocab().items()}
    told = []
    for doc, text in rows:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        own_a = [bytes(byte[c] for c in names[i]) for i in a]
        own_b = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_side.id_to_piece(i)]]
        if not text or not b"".join(own_a) == b"".join(own_b) == (" " + text).encode():
            a, b, own_a, own_b = [], [], [], []
        spans = []
        for ids, own in ((a, own_a), (b, own_b)):
            at, out = 0, []
            for i, x in zip(ids, own):
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        groups, ga, gb, k = [], [], [], 0
        ends_b = {e for _, e, _ in spans[1]}
        for s, e, i in spans[0]:
            ga.append(i)
            while k < len(spans[1]) and spans[1][k][1] <= e:
                gb.append(spans[1][k][2])
                k += 1
            if e in ends_b:
                groups.append((ga, gb))
                ga, gb = [], []
        links, lo = [], 0
        for s, e, i in spans[0]:
            while lo < len(spans[1]) and spans[1][lo][1] <= s:
                lo += 1
            j = lo
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, spans[1][j][2]))
                j += 1
        told.append((doc, len(a), len(b), groups, links))
    counts = Counter(x for *_, links in told for x in links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    shown = lambda groups: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return [(doc, n_a, n_b, len(groups), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(shown(groups).encode()).hexdigest() if groups else "") for doc, n_a, n_b, groups, links in told]


def digest(docs):
    out = alignment.alignment_digest(docs)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_whole_table(spark, side):
    docs = spark.read.parquet(SF)
    assert digest(docs) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=repr)


ODD = [(1, None), (2, ""), (3, " "), (4, "  lead and  double   blanks \n\n  x "), (5, "a▁b never comes back"), (6, "the <|endoftext|> is </s> <s> text <0x0A>"),
       (7, "naïve café 漢字かな 😀 don't\tI'll    x \x1f y"), (8, "w" * 3000 + " " + "é" * 2000), (8, "again"), (8, "again"), (None, "again"), (None, None), (9, "\x00\x01 ﬁ "),
       (10, "1234567890 --- ... !!!!!!!! \r\n  　 end"), (11, "а б в кириллица"), (12, "x" * 70 + " y " * 500)]


def test_odd_texts(spark, side):
    docs = spark.createDataFrame([(d, t, 1, "g", [1]) for d, t in ODD], "doc_id long, text string, uid int, groups string, pairs array<int>")
    assert digest(docs.repartition(3)) == sorted(brute(ODD), key=repr)
    assert digest(docs.limit(0)) == []
    assert digest(docs.where("doc_id = 5")) == [(5, 0, 0, 0, 0, 0, 0, "")]


def test_groups_and_pairs_do_not_depend_on_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(ODD)], "uid long, doc_id long, text string")
    rows = lambda df: sorted((r.uid, r.groups, sorted(zip(r.pairs, r.times))) for r in alignment.align(df).where("uid is not null").collect())
    assert rows(docs.repartition(1)) == rows(docs.repartition(5))
    counts = lambda df: sorted(tuple(r) for r in alignment.pair_counts(alignment.align(df)).collect())
    assert counts(docs.repartition(1)) == counts(docs.repartition(5))


def test_stretches_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    t = alignment.Pair(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    words = ["some", "words", "are", "met", "some", "x" * 100]
    first = t.encode(words)
    assert t.encode(words) == first and len(t.known) <= 3


def test_new_stretches_are_encoded_together(monkeypatch):
    """A encodes many stretches as one text, with the ids of each by itself, also of those with blanks at an end."""
    t = alignment.Pair(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    words = ["some", "don't", " lead", "end\n", "naïve", "x" * 100, "<|endoftext|>", "12,345.6", "漢字かな", " ", "😀!", "some more", "\x1f", "a "]
    texts = []

    class Told:
        def encode_batch_fast(self, batch, **more):
            texts.extend(batch)
            return real.encode_batch_fast(batch, **more)
    real, t.a = t.a, Told()
    a, b = t.encode(words)
    assert len(texts) < len(words) - 5
    assert a.to_pylist() == [real.encode(" " + w, add_special_tokens=False).ids for w in words]
    assert b.to_pylist() == [t.b.encode(w) for w in words]
    again = t.encode(words[::-1] + ["new"])
    assert again[0].to_pylist()[:-1] == a.to_pylist()[::-1] and again[1].to_pylist()[:-1] == b.to_pylist()[::-1]


def test_a_stretch_is_aligned_once(monkeypatch):
    """However often a stretch stands in a slice, the join has its ends once."""
    t, seen = alignment.Pair(alignment.VOCABULARY_A, alignment.VOCABULARY_B), []
    placed = alignment._placed
    monkeypatch.setattr(alignment, "_placed", lambda lists, *more: seen.append(len(lists)) or placed(lists, *more))
    batch = alignment.pa.RecordBatch.from_pylist([{"uid": i, "doc_id": i, "text": "some words " * 50 + "end"} for i in range(20)])
    assert alignment._align(batch, t).num_rows == 21 and seen == [3, 3]
