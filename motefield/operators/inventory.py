"""Tables about items and objects: listings, manifests, labels, what is left to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import small, staged_small


def pending_items(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Items not yet extracted."""
    return items.join(done.select(*keys).distinct(), keys, "left_anti")


def label_resolve(hulls: DataFrame, info: DataFrame, prompts: DataFrame, keys: list[str]) -> DataFrame:
    """Refined name, else object type, else first prompt term, else hull label."""
    clean = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    out = hulls.join(info.select(*keys, "name", "object_type"), keys, "left").join(
        prompts.select(*keys, "prompt"), keys, "left")
    from ..functions.labels import tagged_terms
    first = F.get(tagged_terms(F.col("prompt")), F.lit(0))["text"]
    return out.select(*keys, F.coalesce(clean("name"), clean("object_type"), first, F.col("label")).alias("label"))


def scene_manifest(objects: DataFrame, hulls: DataFrame, metas: DataFrame, keys: list[str]) -> DataFrame:
    """Status, phase and source of every object; objects without a meta or hull are kept."""
    out = (objects.join(metas.select(*keys, F.lit(True).alias("_meta"), "label", "phase", "quadrant", "n_kept"), keys, "left")
           .join(hulls.select(*keys, F.lit(True).alias("_hull")), keys, "left"))
    third = F.coalesce(F.col("phase") == 3, F.lit(False))
    return out.select(
        *keys, F.when(F.col("_meta"), F.when(third, 3).otherwise(1)).alias("phase"),
        F.when(F.col("_meta"), F.col("label")).alias("label"),
        F.when(F.col("_meta"), F.when(third, F.concat(F.lit("phase2_"), "quadrant")).otherwise("phase1_topdown")).alias("source"),
        F.when(F.col("_meta"), F.col("n_kept")).alias("splats"),
        F.when(F.col("_hull"), "hull_extracted").otherwise("missing_hull").alias("status"))


def phase_counts(manifest: DataFrame, keys: list[str]) -> DataFrame:
    return manifest.groupBy(*keys, "phase").agg(F.count("*").alias("n_objects"))


def singular_items(items: DataFrame, keys: list[str], order: Column) -> tuple[DataFrame, DataFrame]:
    """One-per-room classes keep their largest box (earliest on ties); and what that drops.

    ``items`` carries ``canonical`` and ``area``.
    """
    from ..functions.labels import is_singular
    it = items.withColumns({"_single": is_singular(F.col("canonical")), "_ord": order})
    best = (it.where("_single").groupBy(*keys, "canonical")
            .agg(F.max(F.struct("area", (-F.col("_ord")).alias("o"))).alias("_best")))
    best = staged_small(best.select(*keys, "canonical", F.col("_best.area").alias("_ba"), (-F.col("_best.o")).alias("_bo")))
    out = it.join(best, [*keys, "canonical"], "left")
    keep = ~F.col("_single") | (F.col("_ord") == F.col("_bo"))
    return (out.where(keep).select(*items.columns),
            out.where(~keep).select(*items.columns, F.col("_bo").alias("kept_ord"), F.col("_ba").alias("kept_area")))


def first_label_match(items: DataFrame, keys: list[str], text: str, order: str, label: str = "label") -> DataFrame:
    """First item in order whose label contains the text."""
    from ..functions.labels import strip
    wanted = text.strip().lower()
    hit = items.where(F.contains(F.lower(F.col(label)), F.lit(wanted)))
    return hit.groupBy(*keys).agg(F.min(order).alias(order))


def match_report(matched: DataFrame, keys: list[str], hit: str, stage: str = "stage") -> DataFrame:
    """Splats, matches, percent and stages per object."""
    n, m = F.count("*"), F.count_if(F.col(hit))
    return matched.groupBy(*keys).agg(
        n.alias("n_obj_splats"), m.alias("n_matched"), F.round(F.lit(100.0) * m / F.greatest(n, F.lit(1)), 1).alias("match_pct"),
        F.count_distinct(stage).alias("n_stages"))


def merge_scene(background: DataFrame, objects: DataFrame) -> DataFrame:
    """Background and all object splats; the background's columns count, missing ones become 0."""
    cols = background.columns
    both = background.unionByName(objects.select(*[c for c in cols if c in objects.columns]), allowMissingColumns=True)
    filled = [c for c in cols if c not in objects.columns]
    return (both.fillna(0, filled) if filled else both).select(*cols)


def fingerprint(columns: list[str], seed: int) -> Column:
    """Sum of row hashes: the same for the same rows in any order, copies counted.  Nulls are marked by place."""
    marks = [F.col(c).isNull() for c in columns]
    return F.sum(F.xxhash64(F.lit(seed), *columns, *marks).cast("decimal(20,0)"))


def reassembly_check(background: DataFrame, objects: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of the parts against the count of the whole, and whether the rows are the ``same_rows``.

    Rows are compared as multisets by two sums of 64-bit hashes over all columns of ``merged``, so
    an exchanged row with equal counts shows.  A group of the parts alone is reported with a
    ``merged_total`` of 0.  One pass and one shuffle of sums.
    """
    tag = lambda df, part: df.withColumn("_part", F.lit(part))
    parts = merge_scene(tag(background, "b"), tag(objects, "o"))
    rows = parts.select("_part", *[F.col(f.name).cast(f.dataType) for f in merged.schema]).unionByName(tag(merged, "m"))
    sums = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), *[fingerprint(merged.columns, i).alias(f"_h{i}") for i in (0, 1)])
    part = lambda *names: F.col("_part").isin(*names)
    count = lambda *names: F.coalesce(F.sum(F.when(part(*names), F.col("_n"))), F.lit(0)).cast("long")
    rest = [F.sum(F.when(part("m"), F.col(h)).otherwise(-F.col(h))) for h in ("_h0", "_h1")]
    out = sums.groupBy(*keys).agg(
        count("m").alias("merged_total"), count("b").alias("background_splats"), count("o").alias("object_total_splats"),
        ((rest[0] == 0) & (rest[1] == 0)).alias("same_rows"))
    expected = F.col("background_splats") + F.col("object_total_splats")
    delta = F.col("merged_total") - expected
    return out.withColumns({"expected_if_no_overlap": expected, "delta": delta, "same_rows": F.col("same_rows") & (delta == 0)})


def object_listing(paths: DataFrame, path: str = "path") -> DataFrame:
    """Scene, object and stage of every stage file in a listing of paths."""
    pat = r"([^/]+)/02_([^/]+)/([^/]+?)(?:\.part-\d+)?\.ply$"
    hit = paths.where(F.col(path).rlike(pat))
    return hit.select(*[F.regexp_extract(path, pat, i).alias(n) for i, n in ((1, "scene"), (2, "slug"), (3, "stage"))]).distinct()


def rewrite_path(path: Column, old: Column, new: Column) -> Column:
    return F.replace(path, F.concat(old, F.lit("/")), F.concat(new, F.lit("/")))


def splat_stats(df: DataFrame, keys: list[str], measure: Column) -> DataFrame:
    """Median, p95, p99 and maximum of a measure."""
    from .quantiles import percentiles
    p = percentiles(df, keys, {"m": measure}, [("median", "m", 50.0), ("p95", "m", 95.0), ("p99", "m", 99.0)])
    top = df.groupBy(*keys).agg(F.max(measure).alias("max"))
    return p.join(staged_small(top), keys)


def match_flags(objects: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Object splats with ``matched``: their position is a position of the source."""
    spots = source.select(*keys, "x", "y", "z").distinct().withColumn("_hit", F.lit(True))
    out = objects.join(spots, [*keys, "x", "y", "z"], "left")
    return out.withColumn("matched", F.coalesce("_hit", F.lit(False))).drop("_hit")


def concat_passes(passes: dict[str, DataFrame]) -> DataFrame:
    """Items of all passes, each tagged with its pass."""
    out = None
    for name, df in passes.items():
        df = df.withColumn("pass", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def explode_info(info: DataFrame, keys: list[str]) -> DataFrame:
    """A row per sub-object, material and colour of an object."""
    def rows(kind: str, column: str) -> Column:
        values = F.coalesce(F.col(column), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    every = F.concat(rows("sub_object", "sub_objects"), rows("material", "materials"), rows("color", "colors"))
    return info.select(*keys, F.explode(every).alias("_r")).select(*keys, "_r.*")
