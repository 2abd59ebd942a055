"""Choosing among candidates: ladders, guards, picks, stage ranks and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as k
from ..functions import labels as lb
from ..staging import small, staged_small


def class_exemptions(label: Column, prompt: Column) -> dict[str, Column]:
    """Steps a class skips; the low camera ring looks at the first prompt term only."""
    parent = lb.strip(F.lower(F.get(F.split(F.get(F.split(prompt, r"\|"), F.lit(0)), r"\{"), F.lit(0))))
    return {"skip_floor": lb.mentions(label, lb.SHELVING), "skip_low_ring": lb.mentions(parent, lb.TABLE_TOKENS),
            "skip_crop": lb.mentions(label, ["stool"])}


# --- ladders ---------------------------------------------------------------

def ladder(values: list[tuple]) -> Column:
    """Exploded rungs: ``rung`` number, name and the settings ``s0, s1 ..``."""
    return F.explode(F.array(*[F.struct(F.lit(i).alias("rung"), F.lit(str(v[0])).alias("name"), *[
        F.lit(float(s)).alias(f"s{j}") for j, s in enumerate(v[1:])]) for i, v in enumerate(values)]))


def threshold_sweep(df: DataFrame, keys: list[str], rungs: list[tuple], keep) -> DataFrame:
    """Kept count and share per group and rung, in one scan.

    ``keep`` maps a rung's settings to a condition.  Each rung is one conditional
    count, so the rows are neither copied nor shuffled before aggregation.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_total"), *[
        F.count_if(keep(*r[1:])).alias(f"_k{i}") for i, r in enumerate(rungs)])
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("rung"), F.lit(str(r[0])).alias("name"),
                                        F.col(f"_k{i}").alias("n_kept")) for i, r in enumerate(rungs)]))
    out = counts.select(*keys, "n_total", rows.alias("_r")).select(*keys, "_r.*", "n_total")
    return out.withColumn("kept_share", F.col("n_kept") / F.col("n_total"))


def sweep_noop(sweep: DataFrame, keys: list[str]) -> DataFrame:
    """True when even the strictest rung drops nothing."""
    last = sweep.groupBy(*keys).agg(F.max_by(F.struct("n_kept", "n_total"), "rung").alias("_l"))
    return last.select(*keys, (F.col("_l.n_kept") == F.col("_l.n_total")).alias("noop"))


def ladder_by_label(sweep: DataFrame, labels: DataFrame, keys: list[str], value: str = "thresh") -> DataFrame:
    """Rigid shelving is not offered the strict end of the ladder."""
    out = sweep.join(small(labels), keys)
    return out.where((F.col(value) <= k.RIGID_CAP) | ~lb.mentions(F.col("label"), lb.RIGID_SHELVING)).drop("label")


def collapse_guard(sweep: DataFrame, keys: list[str], drop: float = k.COLLAPSE_DROP) -> DataFrame:
    """Rungs before the first collapse of the kept share; a share of 0 counts as a full drop.

    A ladder has a handful of rungs, so the window holds a handful of rows.
    """
    w = Window.partitionBy(*keys).orderBy("rung")
    prev = F.lag("kept_share").over(w)
    fall = F.when(prev.isNull(), F.lit(0.0)).when(prev > 0, (prev - F.col("kept_share")) / prev).otherwise(F.lit(1.0))
    out = sweep.withColumn("_fall", (fall > drop).cast("int"))
    out = out.withColumn("_cut", F.max("_fall").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.where("_cut = 0").drop("_fall", "_cut")


def rule_pick(guarded: DataFrame, keys: list[str]) -> DataFrame:
    """The strictest rung that survives the guard."""
    return guarded.groupBy(*keys).agg(F.max("rung").alias("rung"))


def apply_pick(guarded: DataFrame, picks: DataFrame, keys: list[str]) -> DataFrame:
    """The rung a reply chose (1-based among the guarded); the middle one without a usable reply."""
    n = guarded.groupBy(*keys).agg(F.count("*").alias("_n"))
    chosen = n.join(small(picks.select(*keys, "pick")), keys, "left").withColumn("rung", F.when(
        (F.col("pick") >= 1) & (F.col("pick") <= F.col("_n")), F.col("pick") - 1).otherwise(F.floor(F.col("_n") / 2)).cast("int"))
    return chosen.select(*keys, "rung")


def nudge_threshold(trials: DataFrame, keys: list[str], current: str, step: Column) -> DataFrame:
    """Next threshold: held within its limits, moved by 3 cm when it repeats an earlier trial.

    ``trials`` has one row per earlier trial (``thresh``), with the proposal repeated.
    """
    near = F.max(F.abs(F.col("thresh") - F.col("_c")) < 0.005)
    out = (trials.withColumn("_c", F.greatest(F.lit(k.FLOOR_THRESH_MIN), F.least(F.lit(k.FLOOR_THRESH_MAX), F.col(current))))
           .groupBy(*keys).agg(F.max("_c").alias("_c"), near.alias("_near"), F.max(step).alias("_i")))
    moved = F.greatest(F.lit(k.FLOOR_THRESH_MIN), F.least(
        F.lit(k.FLOOR_THRESH_MAX), F.col("_c") + F.when(F.col("_i") % 2 == 0, 0.03).otherwise(-0.03)))
    return out.select(*keys, F.when(F.col("_near"), moved).otherwise(F.col("_c")).alias("next_thresh"))


def best_attempt(attempts: DataFrame, keys: list[str], least: int = k.MIN_HIT_VIEWS) -> DataFrame:
    """First attempt with enough main hits, else the one with most (main, view) hits, earliest on ties."""
    passed = F.col("main_hits") >= least
    first = F.min_by(F.struct("attempt", "main_hits", "view_hits"), F.when(passed, F.col("attempt")))
    best = F.max_by(F.struct("attempt", "main_hits", "view_hits"),
                    F.struct("main_hits", "view_hits", (-F.col("attempt")).alias("a")))
    out = attempts.groupBy(*keys).agg(F.max(passed).alias("accepted"), F.when(F.max(passed), first).otherwise(best).alias("_b"))
    return out.select(*keys, "accepted", "_b.*")


# --- stages ----------------------------------------------------------------

def stage_rank(stage: Column, order: list[str]) -> Column:
    """Position in an order of stages, null when not in it."""
    return F.nullif(F.array_position(F.array(*[F.lit(s) for s in order]), stage), F.lit(0))


def stage_resolve(stages: DataFrame, keys: list[str], order: list[str] = k.STAGES) -> DataFrame:
    """The most refined existing stage of each object."""
    ranked = stages.withColumn("_r", stage_rank(F.col("stage"), order)).where(F.col("_r").isNotNull())
    return ranked.groupBy(*keys).agg(F.min_by("stage", "_r").alias("stage"))


def stage_resolve_rendered(renders: DataFrame, keys: list[str], views: list[str] = k.CANONICAL_VIEWS) -> DataFrame:
    """The most refined stage of which every canonical view exists."""
    full = (renders.where(F.col("view").isin(views)).groupBy(*keys, "stage")
            .agg(F.count_distinct("view").alias("_n")).where(F.col("_n") == len(views)))
    return stage_resolve(full, keys)


def stage_pick(stages: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """With both compared stages present a reply chooses (the later one by default), else a fixed order."""
    a, b = "4_sam_tight", "6_inside_outside"
    fixed = stage_resolve(stages, keys, k.PICK_ORDER)
    both = (stages.where(F.col("stage").isin(a, b)).groupBy(*keys).agg(F.count_distinct("stage").alias("_n"))
            .where(F.col("_n") == 2).select(*keys, F.lit(True).alias("_both")))
    out = fixed.join(staged_small(both), keys, "left").join(small(replies.select(*keys, "pick")), keys, "left")
    return out.select(*keys, F.when(F.col("_both"), F.when(F.col("pick") == 1, a).otherwise(b)).otherwise(
        F.col("stage")).alias("stage"))


# --- verdicts --------------------------------------------------------------

def wall_verdict(objects: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """False without a verdict; always true for shelving and storage that stands on walls."""
    out = objects.join(small(verdicts.select(*keys, "wall_adjacent")), keys, "left")
    forced = (lb.procedure(F.col("label")) == "bookshelf") | (
        (lb.procedure(F.col("label")) == "general") & lb.mentions(F.col("label"), lb.WALL_FLUSH))
    return out.select(*keys, (forced | F.coalesce("wall_adjacent", F.lit(False))).alias("wall_adjacent"))


def qc_split(objects: DataFrame, verdicts: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Objects that go on, and the rejected ones with the reason."""
    out = objects.join(small(verdicts.select(*keys, "verdict", "reason")), keys, "left")
    rejected = F.coalesce(F.col("verdict") == "REJECT", F.lit(False))
    return out.where(~rejected), out.where(rejected)


# fixed values: the stages each route runs, in order
PLANS = {
    "general": ["1_visual_hull", "2_sam_wide", "4_sam_tight", "4a_floor_drop", "4b_sam_tight_low",
                "4c_sam_tight_high", "5_sweep_fallback", "6_inside_outside", "8_final"],
    "bookshelf": ["1_visual_hull", "2_sam_wide", "4_sam_tight", "4b_sam_tight_low", "4c_sam_tight_high",
                  "5_sweep_fallback", "6_inside_outside", "8_final"],
    "table": ["1_visual_hull", "2_sam_wide", "3_floor_drop", "8_final"],
    "lamp": ["1_visual_hull", "2_sam_wide", "5_sweep_fallback", "8_final"],
    "tv": ["1_visual_hull", "4_sam_tight"],
    "rug": ["1_visual_hull", "4_rug"],
}


def procedure_plan(objects: DataFrame, label: str = "label") -> DataFrame:
    """A row per object and stage of its route."""
    table = F.create_map(*[x for p, s in PLANS.items() for x in (F.lit(p), F.array(*[F.lit(t) for t in s]))])
    proc = lb.procedure(F.col(label))
    return objects.withColumn("procedure", proc).select("*", F.posexplode(table[F.col("procedure")]).alias("step", "stage"))
