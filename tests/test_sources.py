import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from motefield.sources import ply
from motefield.sources import sidecars as sc


def table(n, seed=0):
    rng = np.random.default_rng(seed)
    cols = ["x", "y", "z", "scale_0", "scale_1", "scale_2", "f_dc_0", "f_dc_1", "f_dc_2", "opacity", "rot_0", "rot_1", "rot_2", "rot_3"]
    return pd.DataFrame(rng.normal(size=(n, len(cols))).astype("f4"), columns=cols).assign(id=np.arange(n, dtype="i4"), obj=np.where(np.arange(n) % 10 == 0, "small", "big"))


def test_round_trip_over_byte_ranges_and_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ply, "_CHUNK", 3001)
    pdf = table(1500)
    df = spark.createDataFrame(pdf)
    cols = [c for c in pdf.columns if c != "obj"]
    ply.write_ply(df, str(tmp_path), F.concat(F.lit("s/02_"), "obj", F.lit("/1_visual_hull")), cols, ["id"], rows_per_file=500)
    files = sorted(os.path.relpath(os.path.join(d, f), tmp_path) for d, _, fs in os.walk(tmp_path) for f in fs)
    assert len([f for f in files if "02_big" in f]) == 3 and "s/02_small/1_visual_hull.ply" in files
    assert not [f for f in files if "/." in f]
    back = ply.read_ply(spark, str(tmp_path), recursive=True)
    assert back.rdd.getNumPartitions() > 10
    got = back.toPandas().sort_values("id").reset_index(drop=True)
    assert np.array_equal(got[cols].to_numpy(), pdf[cols].to_numpy())
    assert got.groupby("file").row_no.apply(lambda s: sorted(s) == list(range(len(s)))).all()
    assert {(r.slug, r.stage) for r in sc.stage_files(spark, str(tmp_path)).collect()} == {("small", "1_visual_hull"), ("big", "1_visual_hull")}


def test_foreign_header_and_missing_columns(spark, tmp_path):
    rows = np.zeros(5, np.dtype([("x", "<f4"), ("red", "u1"), ("n", "<i2")]))
    rows["x"], rows["red"], rows["n"] = np.arange(5), 250, -3
    head = b"ply\r\nformat binary_little_endian 1.0\r\ncomment made by hand\r\nelement vertex 5\r\nproperty float x\r\nproperty uchar red\r\nproperty short n\r\nend_header\r\n"
    (tmp_path / "a.ply").write_bytes(head + rows.tobytes())
    df = ply.read_ply(spark, str(tmp_path / "a.ply"))
    assert df.dtypes[:3] == [("x", "float"), ("red", "smallint"), ("n", "smallint")]
    assert [(r.x, r.red, r.n) for r in df.orderBy("row_no").collect()] == [(float(i), 250, -3) for i in range(5)]
    wide = ply.read_ply(spark, str(tmp_path / "a.ply"), schema="x float, opacity float")
    assert [r.opacity for r in wide.collect()] == [None] * 5


def test_viewer_records(spark, tmp_path):
    pdf = table(50)
    ply.write_viewer(spark.createDataFrame(pdf), str(tmp_path), F.lit("all"), ["id"])
    raw = np.frombuffer((tmp_path / "all.splat").read_bytes(), np.dtype([("p", "<f4", 3), ("s", "<f4", 3), ("c", "u1", 4), ("q", "u1", 4)]))
    assert len(raw) == 50
    order = np.argsort(raw["p"][:, 0])
    want = pdf.sort_values("x")
    assert np.array_equal(raw["p"][order], want[["x", "y", "z"]].to_numpy())
    assert np.allclose(raw["s"][order], np.exp(want[["scale_0", "scale_1", "scale_2"]]), rtol=1e-5)
    rgb = np.clip((0.5 + 0.28209479177387814 * want[["f_dc_0", "f_dc_1", "f_dc_2"]].astype("f8")) * 255, 0, 255).astype(int)
    assert np.array_equal(raw["c"][order][:, :3], rgb)
    q = want[["rot_0", "rot_1", "rot_2", "rot_3"]].astype("f8").to_numpy()
    q = q / (np.linalg.norm(q, axis=1, keepdims=True) + 1e-8)
    assert np.array_equal(raw["q"][order], np.clip(q * 128 + 128, 0, 255).astype(int))


def test_masks_from_grey_maps(spark, tmp_path):
    px = np.zeros((4, 6), np.uint8)
    px[1, 2:5], px[3, 0], px[3, 5], px[0, 0] = 128, 255, 200, 127
    (tmp_path / "mask_y0.pgm").write_bytes(b"P5\n# note\n6 4\n255\n" + px.tobytes())
    got = {(r.mask, r.y, r.x0, r.x1) for r in sc.mask_scan(spark, str(tmp_path)).collect()}
    assert got == {("mask_y0", 1, 2, 4), ("mask_y0", 3, 0, 0), ("mask_y0", 3, 5, 5)}
    for folder in ("s/02_a", "s/02_b"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "y000_p00.pgm").write_bytes(b"P5\n6 4\n255\n" + px.tobytes())
    got = {(r.mask, r.tag) for r in sc.mask_scan(spark, str(tmp_path)).collect()}
    assert got == {("mask_y0", "mask_y0"), ("s/02_a/y000_p00", "y000_p00"), ("s/02_b/y000_p00", "y000_p00")}


def ply_file(path, kinds, n=2):
    names = {"<f4": "float", "<i4": "int", "u1": "uchar"}
    head = f"ply\nformat binary_little_endian 1.0\nelement vertex {n}\n" + "".join(f"property {names[k]} {c}\n" for c, k in kinds) + "end_header\n"
    path.write_bytes(head.encode() + np.ones(n, np.dtype(kinds)).tobytes())


def test_schema_is_the_union_of_all_headers(spark, tmp_path):
    ply_file(tmp_path / "a.ply", [("x", "<f4")])
    ply_file(tmp_path / "b.ply", [("x", "<f4"), ("f_rest_0", "<f4"), ("n", "<i4")])
    for df in (ply.read_ply(spark, str(tmp_path)), spark.read.format("splat_ply").load(str(tmp_path))):
        assert df.columns == ["x", "f_rest_0", "n", "file", "row_no"]
        assert sorted((r.x, r.f_rest_0, r.n) for r in df.where("n is not null").collect()) == [(1.0, 1.0, 1)] * 2 and df.count() == 4
    ply_file(tmp_path / "c.ply", [("x", "u1")])
    with pytest.raises(ValueError):
        ply.read_ply(spark, str(tmp_path))


def test_integers_the_format_cannot_hold_are_refused(spark, tmp_path):
    for value in (2 ** 40 + 5, None):
        df = spark.createDataFrame([(value, 1.0)], "id long, x float")
        with pytest.raises(Exception, match="32 bits|nulls"):
            ply.write_ply(df, str(tmp_path / f"o{value}"), F.lit("a"), ["id", "x"], ["x"])
    ply.write_ply(spark.createDataFrame([(-2 ** 31, 1.0)], "id long, x float"), str(tmp_path / "ok"), F.lit("a"), ["id", "x"], ["x"])
    assert ply.read_ply(spark, str(tmp_path / "ok")).first().id == -2 ** 31


def test_converted_parts_are_one_file_again(spark, tmp_path):
    pdf = table(300)
    ply.write_ply(spark.createDataFrame(pdf), str(tmp_path / "in"), F.lit("s/big"), [c for c in pdf.columns if c != "obj"], ["id"], rows_per_file=100)
    got = ply.convert_tree(spark, str(tmp_path / "in"), str(tmp_path / "out"), recursive=True).collect()
    assert [(r.name, r.n_splats) for r in got] == [("s/big", 300)]
    assert os.listdir(tmp_path / "out" / "s") == ["big.splat"] and (tmp_path / "out" / "s" / "big.splat").stat().st_size == 9600


def test_items_and_replies(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps({"items": [{"label": "tv", "bbox_2d": [1, 2, 3, 4]}, {"label": "rug"}], "image_size": [10, 20]}, indent=2))
    got = sc.item_scan(spark, str(tmp_path / "i.json")).orderBy("idx").collect()
    assert [(r.idx, r.label, r.w, r.bbox_2d) for r in got] == [(0, "tv", 10, [1, 2, 3, 4]), (1, "rug", 10, None)]
    (tmp_path / "r.txt").write_text("line one\nline two")
    assert sc.reply_scan(spark, str(tmp_path / "r.txt")).first().raw == "line one\nline two"


class Dying:
    """A file system whose ``move`` fails from the n-th call on, as a driver that is lost there."""

    def __init__(self, system, calls):
        self.system, self.calls = system, calls

    def move(self, a, b):
        if self.calls == 0:
            raise InterruptedError("driver lost")
        self.calls -= 1
        self.system.move(a, b)

    def __getattr__(self, name):
        return getattr(self.system, name)


def written(path, names, value):
    import pyarrow as pa
    from pyspark.sql.types import FloatType, StringType, StructField, StructType
    job = ply.SplatWriter({"path": str(path)}, StructType([StructField("x", FloatType()), StructField("file", StringType())]), "ply")
    batch = lambda some: pa.RecordBatch.from_pydict({"x": pa.array([value] * len(some), pa.float32()), "file": some})
    return job, [job.write([batch(names[:2])]), job.write([batch(names[2:])])]


@pytest.mark.parametrize("calls", range(6))
def test_a_commit_that_dies_shows_all_or_nothing(spark, tmp_path, monkeypatch, calls):
    names = ["s/a.ply", "s/b.ply", "t/c.ply", "t/d.ply"]
    job, messages = written(tmp_path, names, 1.0)
    job.commit(messages)
    job, messages = written(tmp_path, names, 2.0)
    plain = ply._filesystem
    with monkeypatch.context() as m:
        m.setattr(ply, "_filesystem", lambda p: (Dying(plain(p)[0], calls), plain(p)[1]))
        if calls < 5:
            with pytest.raises(InterruptedError):
                job.commit(messages)
        else:
            job.commit(messages)
    want = 1.0 if calls == 0 else 2.0
    rows = lambda p, deep=False: sorted((os.path.relpath(r.file.replace("file:", ""), tmp_path), r.x) for r in ply.read_ply(spark, str(p), deep).collect())
    assert rows(tmp_path, True) == [(n, want) for n in names]
    assert rows(tmp_path / "t") == [(n, want) for n in names[2:]] and rows(tmp_path / "t/d.ply") == [("t/d.ply", want)]
    assert ply.recover(spark, str(tmp_path)) == (1 if 0 < calls < 5 else 0)
    assert rows(tmp_path, True) == [(n, want) for n in names]
    if calls:
        assert not [f for _, _, fs in os.walk(tmp_path) for f in fs if not f.endswith(".ply") or f.startswith(".")]


def test_abort_takes_back_only_what_is_not_committed(spark, tmp_path, monkeypatch):
    names = ["a.ply", "b.ply", "c.ply", "d.ply"]
    job, messages = written(tmp_path, names, 1.0)
    job.abort(messages)
    assert os.listdir(tmp_path) == []
    job, messages = written(tmp_path, names, 2.0)
    plain = ply._filesystem
    with monkeypatch.context() as m:
        m.setattr(ply, "_filesystem", lambda p: (Dying(plain(p)[0], 2), plain(p)[1]))
        with pytest.raises(InterruptedError):
            job.commit(messages)
    job.abort(messages)
    assert sorted(f for f in os.listdir(tmp_path) if f.endswith(".ply")) == names
    lost, _ = written(tmp_path, names, 3.0)                # an attempt whose message never came
    lost.commit([])
    later, messages = written(tmp_path, names, 4.0)
    later.write([])
    later.commit(messages)
    assert {r.x for r in ply.read_ply(spark, str(tmp_path)).collect()} == {4.0}
