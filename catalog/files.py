"""Queries that write tables to the formats of a scene folder and read them back."""

import uuid

from pyspark.sql import functions as F

from motefield.functions import labels as lb
from motefield.operators import filters as fl
from motefield.operators import frames as fr
from motefield.operators import masks as mk
from motefield.operators import selection as sel
from motefield.sources import ply
from motefield.sources import sidecars as sc
from motefield.staging import staging_dir

from .aggregates import _RB, island, slugged
from .cleaning import OBJ, _S2
from .fixtures import oracle, table
from .joins import S, resolve_cte, stage_splats, views
from .registry import query
from .rows import ID, KEY, splats


REPLY_PARTS = 192


def folder(spark, what):
    return f"{staging_dir(spark)}/{what}-{uuid.uuid4().hex}"


FLOATS = ["x", "y", "z", "scale_0", "scale_1", "scale_2", "f_dc_0", "f_dc_1", "f_dc_2", "opacity", "rot_0", "rot_1", "rot_2", "rot_3"]


def file_name():
    return F.concat(F.lit("scene_"), F.col("scene_id").cast("string"), F.lit("/02_object_"), F.col("object_id").cast("string"), F.lit("/1_visual_hull"))


def tree(spark, sf, rows_per_file=ply.ROWS_PER_FILE):
    path = folder(spark, "ply")
    s = splats(spark, sf).withColumns({c: F.col(c).cast("float") for c in FLOATS}).withColumns({c: F.col(c).cast("int") for c in KEY})
    ply.write_ply(s, path, file_name(), [*KEY, *FLOATS], KEY, rows_per_file)
    return path


@query("ply_scan", oracle(["splats"], "SELECT " + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in KEY) + ", " + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in FLOATS) + " FROM splats"))
def ply_scan(spark, sf):
    return ply.read_ply(spark, tree(spark, sf), recursive=True).drop("file", "row_no")


@query("ply_sink", oracle(["splats"], "SELECT concat('scene_', scene_id, '/02_object_', object_id) AS name, count(*) AS n, count(*) - 1 AS last_row FROM splats GROUP BY scene_id, object_id"))
def ply_sink(spark, sf):
    df = ply.read_ply(spark, tree(spark, sf), recursive=True)
    name = F.regexp_extract("file", r"(scene_\d+/02_object_\d+)/1_visual_hull(?:\.part-\d+)?\.ply$", 1)
    return df.groupBy(name.alias("name")).agg(F.count("*").alias("n"), F.max("row_no").alias("last_row"))


@query("splat_sink", oracle(["splats"], "SELECT concat('scene_', scene_id, '/02_object_', object_id) AS name, count(*) * 32 AS bytes FROM splats GROUP BY scene_id, object_id"))
def splat_sink(spark, sf):
    path = folder(spark, "viewer")
    ply.write_viewer(splats(spark, sf), path, file_name(), KEY)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.splat").load(path)
    name = F.regexp_extract("path", r"(scene_\d+/02_object_\d+)/", 1)
    return files.groupBy(name.alias("name")).agg(F.sum("length").alias("bytes"))


@query("convert_tree", oracle(["splats"], "SELECT concat('scene_', scene_id, '/02_object_', object_id, '/1_visual_hull') AS name, count(*) AS n_splats FROM splats GROUP BY scene_id, object_id"))
def convert_tree(spark, sf):
    return ply.convert_tree(spark, tree(spark, sf), folder(spark, "converted"), recursive=True)


@query("object_listing", oracle(["splats"], "SELECT DISTINCT concat('scene_', scene_id) AS scene, concat('object_', object_id) AS slug, '1_visual_hull' AS stage FROM splats"))
def object_listing(spark, sf):
    return sc.stage_files(spark, tree(spark, sf))


_V = ["r00", "r01", "r02", "r10", "r11", "r12", "r20", "r21", "r22", "t0", "t1", "t2", "f", "w", "h", "eye_x", "eye_y", "eye_z", "tgt_x", "tgt_y", "tgt_z"]


@query("camera_scan", oracle(["objects", "views"], f"SELECT scene_id, object_id, concat('v', view_id) AS tag, {', '.join(_V)} FROM objects JOIN views USING (scene_id)"))
def camera_scan(spark, sf):
    from motefield.staging import small
    path = folder(spark, "cameras")
    v = table(spark, sf, "objects").select(*OBJ).join(small(views(spark, sf)), "scene_id")
    row = lambda i: F.array(*[F.col(f"r{i}{j}") for j in range(3)], F.col(f"t{i}"))
    one, zero = F.lit(1.0), F.lit(0.0)
    cam = F.struct(F.concat(F.lit("v"), F.col("view_id").cast("string")).alias("tag"), F.col("w").alias("width"), F.col("h").alias("height"),
                   F.array(row(0), row(1), row(2), F.array(zero, zero, zero, one)).alias("V"),
                   F.array(F.array(F.col("f"), zero, F.col("w") * 0.5), F.array(zero, F.col("f"), F.col("h") * 0.5), F.array(zero, zero, one)).alias("K"),
                   F.array("eye_x", "eye_y", "eye_z").alias("eye"), F.array("tgt_x", "tgt_y", "tgt_z").alias("target"))
    files = v.groupBy(*OBJ).agg(F.to_json(F.struct(F.collect_list(cam).alias("cameras"))).alias("value"))
    files.write.partitionBy(*OBJ).text(path)
    got = sc.camera_scan(spark, path)
    ids = [F.regexp_extract("file", rf"{c}=(\d+)", 1).cast("bigint").alias(c) for c in OBJ]
    return got.select(*ids, "tag", *_V)


_DV = ["eye_x", "eye_y", "eye_z", "tgt_x", "tgt_y", "tgt_z", "target_dist"]


@query("diorama_camera_scan", oracle(["splats"], """SELECT scene_id, q AS quadrant, ex AS eye_x, eye_y, ez AS eye_z, ex AS tgt_x, eye_y AS tgt_y, tz AS tgt_z, abs(tz - ez) AS target_dist, cx, cz FROM (
  SELECT rbd.*, 'NE' AS q, (cx + xb_max) / 2 AS ex, cz - 2.0e0 AS ez, zb_max AS tz FROM rbd UNION ALL SELECT rbd.*, 'NW', (xb_min + cx) / 2, cz - 2.0e0, zb_max FROM rbd
  UNION ALL SELECT rbd.*, 'SE', (cx + xb_max) / 2, cz + 2.0e0, zb_min FROM rbd UNION ALL SELECT rbd.*, 'SW', (xb_min + cx) / 2, cz + 2.0e0, zb_min FROM rbd) AS u""", _RB))
def diorama_camera_scan(spark, sf):
    from motefield.staging import stage
    path = folder(spark, "dioramas")
    bounds = stage(fr.room_bounds(splats(spark, sf), S))
    cams = fr.diorama_cameras(bounds, S)
    arr = lambda p: F.array(*[F.col(f"{p}_{a}") for a in "xyz"])
    entry = cams.select("scene_id", F.col("quadrant").alias("name"), arr("eye").alias("eye"), arr("tgt").alias("target"), "target_dist")
    both = entry.unionByName(bounds.withColumn("name", F.lit("bounds")), allowMissingColumns=True)
    body = F.struct(*[c for c in both.columns if c not in ("scene_id", "name")])
    files = both.groupBy("scene_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("name"), body)))).alias("value"))
    files.write.partitionBy("scene_id").text(path)
    got, room = sc.diorama_camera_scan(spark, path)
    scene = F.regexp_extract("file", r"scene_id=(\d+)", 1).cast("bigint").alias("scene_id")
    return got.select(scene, "quadrant", *_DV).join(room.select(scene, "cx", "cz"), "scene_id")


@query("item_scan", oracle(["items"], "SELECT scene_id, grp, CAST(row_number() OVER (PARTITION BY scene_id, grp ORDER BY item_id) - 1 AS INTEGER) AS idx, label, CAST(bx0 AS INTEGER) AS x0, CAST(by1 AS INTEGER) AS y1, quadrant, CAST(192 AS INTEGER) AS w FROM (SELECT *, CAST(floor(k / 40) AS BIGINT) AS grp FROM items) AS q"))
def item_scan(spark, sf):
    path = folder(spark, "items")
    it = table(spark, sf, "items").withColumn("grp", F.floor(F.col("k") / 40))
    item = F.struct("item_id", "label", F.array("bx0", "by0", "bx1", "by1").alias("bbox_2d"), F.lit("high").alias("confidence"), "quadrant")
    files = it.groupBy("scene_id", "grp").agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"), F.array(F.lit(192), F.lit(108)).alias("image_size"))).alias("value"))
    files.write.partitionBy("scene_id", "grp").text(path)
    ids = [F.regexp_extract("file", rf"{c}=(\d+)", 1).cast("bigint").alias(c) for c in ("scene_id", "grp")]
    return sc.item_scan(spark, path).select(*ids, "idx", "label", F.col("bbox_2d")[0].alias("x0"), F.col("bbox_2d")[3].alias("y1"), "quadrant", "w")


@query("item_sink", oracle(["items"], "SELECT item_id, label, bx0, kept, scene_id, quadrant, count(*) OVER (PARTITION BY scene_id, quadrant) AS n_raw, count(*) FILTER (WHERE NOT kept) OVER (PARTITION BY scene_id, quadrant) AS n_dropped FROM (SELECT *, k % 4 <> 3 OR k % 3 <> 0 AS kept FROM items) AS q"))
def item_sink(spark, sf):
    path = folder(spark, "item-rows")
    it = table(spark, sf, "items").withColumn("kept", (F.col("k") % 4 != 3) | (F.col("k") % 3 != 0))
    sc.item_sink(it, path, ["item_id", "label", "bx0", "kept"])
    got = spark.read.schema("item_id bigint, label string, bx0 bigint, kept boolean, scene_id bigint, quadrant string").json(path)
    return got.join(sc.drop_counts(got, ["scene_id", "quadrant"], "kept").drop("n_kept"), ["scene_id", "quadrant"])


@query("reply_scan", oracle(["items", "replies"], "SELECT item_id, raw FROM replies"))
def reply_scan(spark, sf):
    path = folder(spark, "replies")
    # a file per reply: they are small, so without a number all would be written by one task, and without the option renamed one by one by the driver
    replies = table(spark, sf, "replies").select("item_id", F.col("raw").alias("value")).repartition(REPLY_PARTS, "item_id")
    replies.write.partitionBy("item_id").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    got = sc.reply_scan(spark, path)
    return got.select(F.regexp_extract("file", r"item_id=(\d+)", 1).cast("bigint").alias("item_id"), F.regexp_replace("raw", r"\n$", "").alias("raw"))


def write_masks(df, path):
    """Grey maps of 192 x 108 pixels from merged runs, one file per view in the folder of its scene."""
    path = ply.qualified(df.sparkSession, path)

    def draw(key, pdf):
        import numpy as np
        import pandas as pd

        from motefield.sources.ply import _filesystem
        px = np.zeros((108, 192), np.uint8)
        for y, a, b in zip(pdf.y, pdf.x0, pdf.x1):
            px[y, a:b + 1] = 200
        system, base = _filesystem(path)
        system.create_dir(f"{base}/scene_{key[0]}", recursive=True)
        with system.open_output_stream(f"{base}/scene_{key[0]}/v{key[1]}.pgm") as f:
            f.write(b"P5\n192 108\n255\n" + px.tobytes())
        return pd.DataFrame({"n": [int((px > 127).sum())]})
    return df.groupBy("scene_id", "view_id").applyInPandas(draw, "n bigint")


@query("mask_scan", oracle(["mask_runs"], "SELECT concat('scene_', scene_id, '/v', view_id) AS mask, concat('v', view_id) AS tag, y, x0, x1 FROM (" + island("px1", "scene_id, view_id") + ") AS q",
       "px1 AS (SELECT DISTINCT scene_id, view_id, y, unnest(range(x0, x1 + 1)) AS px FROM mask_runs)"))
def mask_scan(spark, sf):
    path = folder(spark, "masks")
    write_masks(mk.mask_union(table(spark, sf, "mask_runs"), ["scene_id", "view_id"]), path).count()
    return sc.mask_scan(spark, path)


@query("report_sink", oracle(["splats"], f"SELECT scene_id, 'max_scale' AS stage, 0.5e0 AS limit_m, count(*) AS n_in, count(*) FILTER (WHERE {_S2}) AS n_kept, round(CAST(count(*) FILTER (WHERE {_S2}) AS DOUBLE) / count(*), 4) AS frac_kept FROM splats GROUP BY scene_id"))
def report_sink(spark, sf):
    path = folder(spark, "reports")
    s = splats(spark, sf)
    sc.report_sink(sc.stage_report(s, fl.max_scale_filter(s), S, "max_scale", {"limit_m": 0.5}), path, ["scene_id", "stage"])
    return spark.read.schema("limit_m double, n_in bigint, n_kept bigint, frac_kept double, scene_id bigint, stage string").json(path)


@query("manifest_sink", oracle(["stage_splats", "objects"], f"""SELECT scene_id, object_id, label, stage, CASE WHEN stage IS NOT NULL THEN concat('object_', object_id, '.splat') END AS splat,
  CASE WHEN stage IS NOT NULL THEN round(coalesce(n, 0) * 32 / 1e6, 2) END AS size_mb, stage IS NULL AS skipped FROM objects LEFT JOIN sr USING (scene_id, object_id)
  LEFT JOIN (SELECT scene_id, object_id, stage, count(*) AS n FROM stage_splats GROUP BY ALL) AS c USING (scene_id, object_id, stage)""", "early AS (SELECT * FROM stages WHERE rank < 3), " + resolve_cte("sr", ["9_subtracted", "8_final", "7_final"], "early")))
def manifest_sink(spark, sf):
    path = folder(spark, "manifest")
    st = table(spark, sf, "stages").where("rank < 3")
    objs = table(spark, sf, "objects").select(*OBJ, "label", F.concat(F.lit("object_"), F.col("object_id").cast("string")).alias("slug"))
    sizes = stage_splats(spark, sf).groupBy(*OBJ, "stage").agg(F.count("*").alias("n_splats"))
    sc.final_manifest(objs, sel.stage_resolve(st, OBJ), sizes, OBJ).write.partitionBy("scene_id").json(path)
    return spark.read.schema("object_id bigint, label string, stage string, splat string, size_mb double, skipped boolean, scene_id bigint").json(path)
