import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from motefield.functions import geometry as g
from motefield.operators import attributes as at
from motefield.operators import cameras as cam
from motefield.operators import filters as fl
from motefield.operators import fits as ft
from motefield.operators.projection import project


def splats(n=200, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(rng.normal(size=(n, 3)), columns=list("xyz"))
    for i in range(3):
        pdf[f"scale_{i}"], pdf[f"f_dc_{i}"] = rng.normal(-3, 1, n), rng.normal(size=n)
    for i in range(4):
        pdf[f"rot_{i}"] = rng.normal(size=n)
    return pdf.assign(opacity=rng.normal(0, 20, n), scene_id=0, id=range(n))


def rotation(q):
    w, x, y, z = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
                     [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
                     [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])


def test_normal_and_alignment(spark):
    pdf = splats()
    planes = spark.createDataFrame([(0, 0.1, 0.9, -0.2, 0.4)], "scene_id int, a double, b double, c double, d double")
    got = at.plane_columns(at.normals(spark.createDataFrame(pdf)), planes).toPandas().set_index("id").sort_index()
    p = np.array([0.1, 0.9, -0.2])
    for i, r in pdf.iterrows():
        n = rotation(r[["rot_0", "rot_1", "rot_2", "rot_3"]].to_numpy(float))[:, int(np.argmin(r[["scale_0", "scale_1", "scale_2"]].to_numpy(float)))]
        assert np.allclose(got.loc[i, ["nx", "ny", "nz"]].to_numpy(float), n)
        assert np.isclose(got.loc[i, "align"], abs(n @ p) / np.linalg.norm(p))
        assert np.isclose(got.loc[i, "sd"], (r[["x", "y", "z"]].to_numpy(float) @ p + 0.4) / np.linalg.norm(p))


def test_turns_keep_rotations_consistent(spark):
    pdf = splats(30)
    base = at.normals(spark.createDataFrame(pdf)).toPandas().set_index("id").sort_index()
    for turned, m in [(at.turn_about_y(spark.createDataFrame(pdf), 40.0), rotation(np.array([np.cos(np.radians(20)), 0, np.sin(np.radians(20)), 0]))),
                      (at.to_y_down(spark.createDataFrame(pdf)), np.array([[1, 0, 0], [0, 0, -1], [0, 1, 0]]))]:
        got = at.normals(turned).toPandas().set_index("id").sort_index()
        assert np.allclose(got[["x", "y", "z"]], pdf[["x", "y", "z"]] @ m.T)
        assert np.allclose(got[["nx", "ny", "nz"]], base[["nx", "ny", "nz"]] @ m.T)


def test_orbit_camera_sees_its_target_in_the_middle(spark):
    f = spark.createDataFrame([(0, 1.0, 2.0, 3.0, 4.0)], "scene_id int, c_x double, c_y double, c_z double, distance double")
    v = cam.orbit(f, cam.orbit_grid()).withColumns({"fov": F.lit(70.0), "w": F.lit(1920), "h": F.lit(1080)})
    v = cam.add_intrinsics(cam.add_look_at(v, up=(0.0, -1.0, 0.0)))
    v = project(v.withColumns({a: F.col(f"c_{a}") for a in "xyz"}), "float")
    out = v.select("tag", "u", "v", (F.col("eye_y") < F.col("c_y")).alias("above"), "front").toPandas()
    assert len(out) == 25 and {"y0_p-15", "y330_p-45", "topdown"} <= set(out.tag)
    assert out.front.all() and np.allclose(out.u, 960) and np.allclose(out.v, 540) and out.above.all()


def test_pixel_rules(spark):
    v = "r00 double, r01 double, r02 double, r10 double, r11 double, r12 double, r20 double, r21 double, r22 double, t0 double, t1 double, t2 double, f double, w int, h int"
    rows = [(1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 10.0, 20, 10, x, y, z) for x, y, z in
            [(0.0, 0.0, -1.0), (-1.05, 0.0, -1.0), (-1.1, 0.0, -1.0), (0.999, 0.499, -1.0), (1.0, 0.0, -1.0), (0.0, 0.0, -0.005), (0.0, 0.0, 1.0), (1.0, 1.0, 0.0), (0.25, 0.15, -1.0)]]
    df = spark.createDataFrame(rows, v + ", x double, y double, z double")
    got = [(r.px, r.py, r.inside) for r in project(df, "index").collect()]
    assert got[0] == (10, 5, True) and got[1] == (0, 5, True)          # -0.5 is cut to 0
    assert got[2][2] is False and got[3] == (19, 9, True) and not any(r[2] for r in got[4:8])
    last = project(df, "round").collect()[8]
    assert (last.px, last.py) == (12, 6)             # 12.5 and 6.5 go to the even side


def test_opaque_and_default_alpha_is_full(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0)], "x double, y double, z double")
    row = at.encoded(at.fill_defaults(df)).first()
    assert (row.c_a, row.c_r, row.q_w, row.q_x) == (255, 127, 255, 128)


def test_plane_fit_finds_the_floor(spark):
    rng = np.random.default_rng(2)
    floor = np.c_[rng.uniform(-3, 3, 1500), rng.normal(1.0, 0.005, 1500), rng.uniform(-3, 3, 1500)]
    rest = rng.uniform(-3, 3, (700, 3))
    pdf = pd.DataFrame(np.r_[floor, rest], columns=list("xyz")).assign(scene_id=0, id=range(2200))
    r = ft.plane_fit(spark.createDataFrame(pdf), ["scene_id"], ["id"]).first()
    assert r.b > 0.99 and abs(r.d + 1.0) < 0.05 and r.inliers > 1400


def test_art_slab_along_its_own_normal(spark):
    rng = np.random.default_rng(4)
    n = np.array([0.6, 0.0, 0.8])
    a, b = np.array([0.8, 0, -0.6]), np.array([0.0, 1, 0])
    flat = rng.uniform(-1, 1, (800, 1)) * a + rng.uniform(-1, 1, (800, 1)) * b + rng.normal(0, 0.004, (800, 1)) * n
    off = rng.uniform(-1, 1, (60, 1)) * a + 0.3 * n
    pdf = pd.DataFrame(np.r_[flat, off], columns=list("xyz")).assign(item_id=1, id=range(860))
    df = spark.createDataFrame(pdf)
    eyes = spark.createDataFrame([(1, 0.0, 0.0, 5.0)], "item_id int, eye_x double, eye_y double, eye_z double")
    normals = fl.pca_normals(df, ["item_id"], eyes)
    r = normals.first()
    cov = np.cov(pdf[["x", "y", "z"]].to_numpy().T)
    want = np.linalg.eigh(cov)[1][:, 0]
    want = want if want[2] > 0 else -want
    assert np.allclose([r.n_x, r.n_y, r.n_z], want, atol=1e-6)
    kept = fl.wall_slab(df, ["item_id"], normals).toPandas().id
    assert set(kept) == set(range(800))


def test_thin_depth_uses_the_median(spark):
    pdf = pd.DataFrame({"k": 1, "d": [0.0, 0.01, 0.011, 0.02, 0.021]})
    assert fl.depth_mode(spark.createDataFrame(pdf), ["k"], "d").first().plane_depth == 0.011


def plane_room(n, seed):
    rng = np.random.default_rng(seed)
    p = rng.uniform(-2, 2, (n, 3))
    p[: n // 2, 1] = 0.3 * p[: n // 2, 0] + rng.normal(0, 0.01, n // 2)
    pdf = pd.DataFrame(p, columns=list("xyz")).assign(scene_id=np.arange(n) % 2, id=range(n))
    n_ = rng.normal(size=(10, 3))
    n_ /= np.linalg.norm(n_, axis=1, keepdims=True)
    planes = pd.DataFrame(n_, columns=list("abc")).assign(d=rng.uniform(-1, 1, 10), **{"try": range(10)})
    planes.loc[0, list("abcd")] = [-0.3 / 1.09 ** 0.5, 1 / 1.09 ** 0.5, 0.0, 0.0]
    planes.loc[1, "d"] = 100.0
    return pdf, pd.concat([planes.assign(scene_id=s) for s in (0, 1)], ignore_index=True)


def test_inliers_by_cells_equal_plain_counts(spark, side):
    pdf, planes = plane_room(4000, 1)
    pdf.loc[:3, "x"], pdf.loc[4:6, "y"], pdf.loc[7, "z"] = np.nan, np.inf, None
    got = ft.inlier_counts(spark.createDataFrame(pdf), ["scene_id"], spark.createDataFrame(planes), 0.05).collect()
    assert len(got) == 20
    for r in got:
        p = pdf[pdf.scene_id == r.scene_id]
        assert r.inliers == (abs(r.a * p.x + r.b * p.y + r.c * p.z + r.d) <= 0.05).sum()
    assert ft.inlier_counts(spark.createDataFrame(pdf).limit(0), ["scene_id"], spark.createDataFrame(planes), 0.05).agg(F.sum("inliers")).first()[0] == 0


def test_few_points_are_asked(spark):
    pdf, planes = plane_room(60000, 2)
    _, _, cut = ft.open_cells(spark.createDataFrame(pdf), ["scene_id"], spark.createDataFrame(planes), 0.05)
    assert cut.agg(F.sum("_n")).first()[0] < 60000 * 10 / 10
