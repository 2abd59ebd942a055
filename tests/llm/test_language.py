import zlib

import numpy as np
import pyarrow as pa
import pytest

from motefield.llm import language

SF = "/root/testdata/sf0.01/documents.parquet"


def brute_bundle(text, d):
    letters = [ord(c.lower()[0]) if c.isalpha() else 0 for c in text or ""]
    stream = [0]
    for c in letters:
        if c or stream[-1]:
            stream.append(c)
    if stream[-1]:
        stream.append(0)
    v = np.zeros(d)
    vec = lambda c: language.letter_vectors(np.array([c]), d)[0]
    for a, b, c in zip(stream, stream[1:], stream[2:]):
        v += np.roll(vec(a), 2) * np.roll(vec(b), 1) * vec(c)
    return v


@pytest.mark.parametrize("dense", [1 << 24, 1])
def test_bundles_match_a_plain_sum(monkeypatch, dense):
    monkeypatch.setattr(language, "_DENSE", dense)
    monkeypatch.setattr(language, "_ROWS", 3)
    monkeypatch.setattr(language, "_WIDTH", 5)
    texts = ["Straße über, ", None, "", "12 34", "a", "漢字 かな\nx", "THE the  the", " É"]
    got = np.concatenate([v for _, v in language.bundles(pa.record_batch({"text": pa.array(texts, pa.string())}), 128)])
    assert np.array_equal(got, np.stack([brute_bundle(t, 128) for t in texts]))


def test_held_out_accuracy_and_columns(spark):
    docs = spark.read.parquet(SF)
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_batching_does_not_show(spark):
    docs = spark.read.parquet(SF).limit(200)
    a = {tuple(r) for r in language.identify(docs.repartition(1), sample=10 ** 6).collect()}
    b = {tuple(r) for r in language.identify(docs.repartition(7), sample=10 ** 6).collect()}
    assert a == b


def test_odd_rows(spark):
    rows = [(1, "the thing", "en", 0), (2, "le chien", "fr", 0), (None, "the thing", "en", 1), (4, None, None, 2), (4, "", "en", 3), (5, "123 ,", "fr", 4), (6, "the " * 50000, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {(r.doc_id, r.text is None, r.held_out, r.lang_pred) for r in language.identify(df).join(df.select("doc_id", "text"), "doc_id", "left").collect()}
    assert {(4, True, False, "und"), (6, False, zlib.crc32(b"6") % 4 == 2, "en")} <= got
    assert language.identify(df.where("lang is null")).where("lang_pred <> 'und'").count() == 0
    assert language.identify(df.limit(0)).count() == 0
    names, profiles = language.prototypes(df)
    assert language.predict(df, names, profiles).columns == ["doc_id", "text", "lang", "lang_pred", "score"]


def test_prediction_matches_a_plain_version(spark):
    docs = spark.read.parquet(SF).where("doc_id % 5 = 0")
    rows, d = docs.collect(), 256
    vector = {r.doc_id: brute_bundle(r.text, d) for r in rows}
    unit = lambda v: v / np.sqrt((v ** 2).sum()) if v.any() else v
    total = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            total[r.lang] = total.get(r.lang, 0) + np.rint(unit(vector[r.doc_id]) * 2 ** 20)
    profile = {k: np.rint(unit(v) * language.STEPS) for k, v in sorted(total.items())}
    got = {r.doc_id: r for r in language.identify(docs, sample=10 ** 6, dimensions=d).collect()}
    for r in rows:
        v, g = vector[r.doc_id], got[r.doc_id]
        if not v.any():
            assert (g.lang_pred, g.score) == ("und", 0.0)
            continue
        cosine = {k: float(unit(v) @ unit(p)) for k, p in profile.items()}
        assert cosine[g.lang_pred] >= max(cosine.values()) - 1e-12 and abs(g.score - max(0.0, cosine[g.lang_pred])) < 1e-12


def test_a_language_under_one_id_is_drawn_in_part(spark):
    rows = [(1, f"the number {i} of this thing", "en") for i in range(400)] + [(2 + i, f"le chien {i} est dans la maison", "fr") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert zlib.crc32(b"1") % 4 != 2
    names, _ = language.prototypes(df, sample=50)
    assert names == ["en", "fr"]
