import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from motefield.llm import mixing

from .test_jaccard import brute as groups
from .test_packing import WORD
from .test_repeats import brute as repeats

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert docs.columns == COLUMNS and [n for n, _ in cp.STAGES] == ["language id", "n-gram Jaccard join", "substring dedup", "mix sources", "pack by length"]
    got, rows = [], [docs.collect()]
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.schema == docs.schema
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows.append(docs.collect())
    named = [[(r.doc_id, r.text) for r in part] for part in rows]

    assert {d for d, _ in named[1]} == {r.doc_id for r in rows[0] if r.text and any(c.isalpha() for c in r.text)}
    found = groups(named[1])
    least = {}
    for d, _, c in found:
        least[c] = min(d, least.get(c, d))
    assert sorted(named[2]) == sorted((d, t) for (d, t), (_, n, c) in zip(named[1], found) if not n or least[c] == d)
    want = {d: kept for d, n, _, kept in repeats(named[2]) if not n or kept}
    assert {d: WORD.findall(t) for d, t in named[3]} == want
    assert set(named[4]) == set(named[3]) and len(named[4]) >= len(named[3])
    mixed = mixing.mix(spark.read.parquet(f"{tmp_path}/2")).orderBy("mix_slot", "mix_offset").select("doc_id", "mix_tokens").collect()
    assert sorted(r.doc_id for r in mixed) == sorted(d for d, _ in named[4])
    assert sorted((r.doc_id, r.text) for r in rows[5]) == sorted(named[4])
    assert all(r.pack_tokens == len(WORD.findall(r.text)) + 1 <= r.pack_length for r in rows[5])


def test_batches_follow_the_mixture(spark, side, tmp_path):
    rows = [(i, " ".join(["w"] * (1 + i % 3)), "en", "large", 0) for i in range(3000)] + [(9000 + i, "s s", "en", "small", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.in_order(mixing.mix(docs, weights={"large": 10, "small": 1}, block_tokens=64), 12)
    mixed.select(*docs.columns[:-1], F.col("mix_slot").alias("n_chars")).write.parquet(f"{tmp_path}/mixed")     # n_chars carries the slot
    got = cp.pack(spark, spark.read.parquet(f"{tmp_path}/mixed"), SF).toPandas()
    assert len(got) == mixed.count() and got[got.source == "small"].doc_id.duplicated().any()
    for length, part in got.groupby("pack_length"):
        part = part.sort_values(["pack_batch", "pack_row"])
        per = max(1, 16384 // length)
        assert (part.pack_batch * per + part.pack_row).tolist() == list(range(len(part)))
        assert part.n_chars.is_monotonic_increasing and part.n_chars.nunique() > 5
    # a table that is no files
    plain = cp.pack(spark, spark.createDataFrame([(i, "a b", None, None, 0) for i in range(40)], docs.schema).repartitionByRange(3, "doc_id"), SF)
    assert [r.doc_id for r in plain.orderBy("pack_batch", "pack_row").collect()] == list(range(40))


PACKED = ["pack_tokens", "pack_length", "pack_batch", "pack_row"]
ODD = {
    "empty": ([], []),
    # null and blank texts go for want of a letter; of the equal rows one stays
    "odd": ([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "words " * 40, None, None, 3), (3, "more words a b c", "en", "s", 5), (4, "12 34", "en", "s", 5)],
            [(None, "words " * 40), (3, "more words a b c")]),
    "repeated": ([(7, "one two three four five six", "en", "s", 1)] * 5, [(7, "one two three four five six")]),
    "ties": ([(i, f"text number {i} of a few", "en", "s", i) for i in range(6)], [(i, f"text number {i} of a few") for i in range(6)]),
}


@pytest.mark.parametrize("case", list(ODD))
def test_odd_tables(spark, tmp_path, case):
    rows, kept = ODD[case]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = cp.run(spark, str(tmp_path))
    assert out.columns == [*COLUMNS, *PACKED]
    assert {(r.doc_id, r.text) for r in out.collect()} == set(kept)
    if case != "odd":                    # a single source does not start again
        assert out.count() == len(kept)


def test_nothing_labelled_loses_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    out = cp.language_id(spark, docs, SF)
    want = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in out.collect()} == want and out.count() == len(want) and out.schema == docs.schema


def test_the_limit_has_no_step(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").select("doc_id", "text", "lang", "source", "n_chars")
    near = lambda n: (cp.LEAST_SCORE * (n / (n + cp.REPEATS_ONCE_IN)) ** 0.5)
    assert all(0 < near(n + 1) - near(n) < 0.004 for n in range(1, 2000))
    junk = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(3000))        # letters of no language here
    rows = spark.createDataFrame([(10 ** 6, junk, None, "s", 3000)], base.schema)
    assert cp.language_id(spark, base.unionByName(rows), SF).where("doc_id = 1000000").count() == 0


def test_columns_of_any_name_come_through_every_stage(spark, tmp_path):
    names = ["lang_pred", "score", "n_words", "n_removed", "n_shingles", "component", "component_id", "mix_slot", "mix_epoch", "mix_tokens", "__uid", "__h", "__g", "__spans",
             "uid", "held", "i", "n", "again", "odd name", "with.dot", "__file", "__at", "__one"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    plain = cp.mix_sources(spark, docs, SF)
    docs = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns + (PACKED if i == 4 else [])
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows = docs.collect()
        assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)
    assert plain.count() > 0
