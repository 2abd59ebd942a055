"""Side files of a scene: cameras, items, replies, masks, reports and manifests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAMERA = ("struct<tag:string,yaw_deg:double,pitch_deg:double,fov:double,width:int,height:int,V:array<array<double>>,"
          "K:array<array<double>>,eye:array<double>,target:array<double>>")
CAMERAS = f"fov double, width int, height int, distance double, cameras array<{CAMERA}>"
QUADRANT = "struct<eye:array<double>,target:array<double>,up:array<double>,fov:double,width:int,height:int,target_dist:double," \
           "cx:double,cz:double,xb_min:double,xb_max:double,zb_min:double,zb_max:double,eye_y:double,cy:double,back:double>"
ITEM = "struct<label:string,bbox_2d:array<int>,bbox_pixels:array<int>,confidence:string,pass:string,quadrant:string>"
ITEMS = f"items array<{ITEM}>, image_size array<int>, passes array<string>"


def flat_camera(c: str = "c") -> list[Column]:
    """A camera's matrices as the flat columns the projections use."""
    v, kk = F.col(f"{c}.V"), F.col(f"{c}.K")
    return ([v[i][j].alias(f"r{i}{j}") for i in range(3) for j in range(3)] + [v[i][3].alias(f"t{i}") for i in range(3)]
            + [kk[0][0].alias("f"), F.col(f"{c}.width").alias("w"), F.col(f"{c}.height").alias("h")]
            + [F.col(f"{c}.eye")[i].alias(f"eye_{a}") for i, a in enumerate("xyz")]
            + [F.col(f"{c}.target")[i].alias(f"tgt_{a}") for i, a in enumerate("xyz")])


def camera_scan(spark: SparkSession, path: str) -> DataFrame:
    """A row per camera of every camera file, with the file it came from."""
    df = spark.read.schema(CAMERAS).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return df.select(F.input_file_name().alias("file"), F.explode("cameras").alias("c")).select("file", "c.tag", *flat_camera())


def diorama_camera_scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Quadrant cameras and room bounds of every quadrant camera file."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    entries = raw.select(F.input_file_name().alias("file"), F.explode(F.from_json("value", f"map<string,{QUADRANT}>")).alias("name", "c"))
    views = entries.where(F.col("name") != "bounds").select(
        "file", F.col("name").alias("quadrant"), *[F.col(f"c.{n}")[i].alias(f"{s}_{a}") for n, s in (("eye", "eye"), ("target", "tgt"), ("up", "up"))
                                                   for i, a in enumerate("xyz")], "c.fov", F.col("c.width").alias("w"), F.col("c.height").alias("h"), "c.target_dist")
    bounds = entries.where(F.col("name") == "bounds").select("file", *[f"c.{n}" for n in (
        "cx", "cz", "xb_min", "xb_max", "zb_min", "zb_max", "eye_y", "cy", "back")])
    return views, bounds


def item_scan(spark: SparkSession, path: str) -> DataFrame:
    """A row per detected item with its position in the file and the image size."""
    df = spark.read.schema(ITEMS).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    out = df.select(F.input_file_name().alias("file"), F.col("image_size")[0].alias("w"), F.col("image_size")[1].alias("h"),
                    F.posexplode("items").alias("idx", "i"))
    return out.select("file", "w", "h", "idx", "i.*")


FILES_PER_FOLDER = 8


def by_folder(df: DataFrame, folders: list[str]) -> DataFrame:
    """Rows of a folder in few tasks, and so in few files; a crowded folder in ``FILES_PER_FOLDER``."""
    return df.repartition(*folders, F.pmod(F.xxhash64(*df.columns), F.lit(FILES_PER_FOLDER)))


def item_sink(items: DataFrame, path: str, columns: list[str]) -> None:
    """Items as JSON rows in one folder per scene and quadrant."""
    by_folder(items.select(*columns, "scene_id", "quadrant"), ["scene_id", "quadrant"]).write.partitionBy("scene_id", "quadrant").mode("append").json(path)


def drop_counts(items: DataFrame, keys: list[str], kept: str) -> DataFrame:
    return items.groupBy(*keys).agg(F.count("*").alias("n_raw"), F.count_if(F.col(kept)).alias("n_kept"),
                                    F.count_if(~F.col(kept)).alias("n_dropped"))


def reply_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per reply file: its path and the whole text."""
    df = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return df.select(F.input_file_name().alias("file"), F.col("value").alias("raw"))


def mask_scan(spark: SparkSession, path: str, above: int = 127) -> DataFrame:
    """8-bit grey maps (binary PGM) as runs of the pixels brighter than ``above``.

    ``mask`` is the file's path below ``path`` without its ending, so that files of one
    name in the folders of different scenes, objects or passes stay apart; ``tag`` is the bare name.
    """
    import pyarrow as pa

    def runs(batches):
        import numpy as np
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                head, at = [], 0
                while len(head) < 4:
                    end = at
                    while content[end:end + 1] not in (b" ", b"\n", b"\t", b"\r"):
                        end += 1
                    if content[at:at + 1] == b"#":
                        end = content.index(b"\n", at)
                    elif end > at:
                        head.append(content[at:end])
                    at = end + 1
                w, h = int(head[1]), int(head[2])
                px = np.frombuffer(content, np.uint8, w * h, at).reshape(h, w) > above
                edge = np.diff(np.pad(px, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                y, x0 = np.nonzero(edge == 1)
                _, x1 = np.nonzero(edge == -1)
                n = len(y)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(y.astype("i4")), pa.array(x0.astype("i4")), pa.array((x1 - 1).astype("i4"))],
                    names=["path", "y", "x0", "x1"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pgm").load(path)
    out = files.select("path", "content").mapInArrow(runs, "path string, y int, x0 int, x1 int")
    below = F.regexp_replace(F.col("path"), r"^[a-z0-9+.-]+:/+", "/")
    root = F.lit("/" + re.sub(r"^[a-z0-9+.-]+:/+", "", path).strip("/") + "/")
    inside = F.substring(below, F.instr(below, root) + F.length(root), F.length(below))
    return out.select(F.regexp_replace(inside, r"\.pgm$", "").alias("mask"), F.regexp_extract("path", r"([^/]+)\.pgm$", 1).alias("tag"), "y", "x0", "x1")


def stage_files(spark: SparkSession, path: str) -> DataFrame:
    """Scene, object and stage of every stage file, by listing alone."""
    from ..operators.inventory import object_listing
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.ply").load(path)
    return object_listing(listed.select("path", "length"))


def report_sink(metrics: DataFrame, path: str, partition: list[str]) -> None:
    """Stage reports as JSON, a folder per scene and stage."""
    by_folder(metrics, partition).write.partitionBy(*partition).mode("append").json(path)


def stage_report(before: DataFrame, after: DataFrame, keys: list[str], stage: str, settings: dict[str, float]) -> DataFrame:
    """Rows in, rows kept and their share, with the settings used."""
    a = before.groupBy(*keys).agg(F.count("*").alias("n_in"))
    b = after.groupBy(*keys).agg(F.count("*").alias("n_kept"))
    out = a.join(b, keys, "left").fillna(0, ["n_kept"])
    return out.select(*keys, F.lit(stage).alias("stage"), *[F.lit(v).alias(n) for n, v in settings.items()], "n_in", "n_kept",
                      F.round(F.col("n_kept") / F.col("n_in"), 4).alias("frac_kept"))


RECORD_BYTES = 32


def final_manifest(objects: DataFrame, final: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Per object: label, final stage, file and size; objects without a stage are marked skipped."""
    out = objects.join(final, keys, "left").join(sizes.select(*keys, "stage", "n_splats"), [*keys, "stage"], "left")
    has = F.col("stage").isNotNull()
    return out.select(*keys, "label", "stage", F.when(has, F.concat("slug", F.lit(".splat"))).alias("splat"),
                      F.when(has, F.round(F.coalesce("n_splats", F.lit(0)) * RECORD_BYTES / 1e6, 2)).alias("size_mb"), (~has).alias("skipped"))
