"""Whole jobs over many scenes and objects, composed of the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as k
from ..functions import labels as lb
from ..operators.attributes import plane_columns
from ..operators import filters as fl
from ..operators import frames as fr
from ..operators import hierarchy as hi
from ..operators import hulls as hl
from ..operators import inventory as inv
from ..operators import selection as sel
from ..operators import spatial as sp
from ..operators import votes as vo
from ..operators import voxels as vx
from ..operators.screens import hull_mask_votes
from ..staging import all_of, computed, light, stage, staged_small


def clean_scenes(splats: DataFrame, planes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned splats with their voxel density, and the density ladder's kept counts."""
    # written once as it leaves the chain: neither the count nor what it is attached to runs the chain's last steps again
    cleaned = vx.with_voxel_count(stage(fl.slice_chain(splats, planes)), ["scene_id"], k.DENSITY_VOXEL_M)
    sweep = sel.threshold_sweep(cleaned, ["scene_id"], k.DENSITY_LADDER, lambda least: F.col("density") >= least)
    return cleaned, sweep.select("scene_id", F.col("name").alias("level"), "n_kept", "n_total")


@dataclass
class Inputs:
    """Tables an extraction reads; replies and masks come from outside.

    Masks, view boxes and prompts belong to one object each (``on`` and ``item``);
    cameras are the scene's, or an object's own where ``views`` has the item too.
    """
    splats: DataFrame
    hull_view: DataFrame
    boxes: DataFrame                      # padded boxes with item and label
    views: DataFrame
    planes: DataFrame
    masks: DataFrame                      # mask index per item and view with the layers wide and tight
    view_boxes: DataFrame                 # views of items with the item's box
    ids: list[str]
    neighbours: DataFrame | None = None   # boxes of other items inside an item's box, cut out of its hull
    prompts: DataFrame | None = None      # number of prompt terms per item, as ``n_prompts``
    on: list[str] = field(default_factory=lambda: ["scene_id"])
    item: str = "item_id"
    wide_frac: float = k.WIDE_VOTE_FRAC
    tight_frac: float = k.TIGHT_VOTE_FRAC
    box_frac: float = k.BOX_VOTE_FRAC


def _keep(df: DataFrame, kept: DataFrame, ids: list[str]) -> DataFrame:
    return df.join(kept.select(*ids), ids, "left_semi")


class Extraction:
    """Steps of the routes; all objects of all scenes go through a step in one job.

    Each object is judged by its own views, masks and boxes, so a row of a step is a
    splat of one object's hull.  Rows stay narrow on the way: ids, position, item, and
    what the floor and streak tests say of the splat, taken once at the scan.
    ``whole`` fetches the other columns of the survivors.
    """

    def __init__(self, given: Inputs, streak_rung: int = 1):
        self.g = given
        self.keys = [*given.on, given.item]
        self.row = [*given.ids, given.item]
        _, scale, bright = k.STREAK_LADDER[streak_rung]
        marked = computed(plane_columns(given.splats, given.planes), {
            "on_floor": fl.floor_drop_condition(), "streak": fl.dark_streak(scale, bright)})
        self.points = marked.select(*given.ids, *given.on, "x", "y", "z", "on_floor", "streak")

    def hull(self, routes: list[str], carve: bool = True) -> DataFrame:
        """Hull rows of the items whose label takes one of the routes, without what their neighbours' boxes cover."""
        g = self.g
        boxes = g.boxes.where(lb.procedure(F.col("label")).isin(routes))
        if carve and g.neighbours is not None:
            boxes = hl.free_boxes(boxes, g.neighbours, g.on, g.item)
        out = hl.in_boxes(hl.seen(self.points, g.hull_view, g.on), boxes, g.on, [g.item])
        return stage(out.select(*self.points.columns, g.item))

    def whole(self, df: DataFrame) -> DataFrame:
        """Extracted rows with every column of their splat."""
        g = self.g
        return g.splats.join(df.select(*g.ids, g.item), g.ids)

    def _voted(self, df: DataFrame, layers: list[str], rule: str = "index") -> tuple[DataFrame, DataFrame]:
        """Votes of the object's own masks per row, and the number of views that have one."""
        g = self.g
        by_item = g.item in g.views.columns
        on, extra = (self.keys, []) if by_item else (g.on, [g.item])
        seen = vo.masked_views(g.views, g.masks, on, extra, layers)
        return vo.mask_votes(df, seen, g.masks, self.keys, g.ids, rule, layers=layers), vo.view_counts(seen, self.keys, layers)

    def judged(self, df: DataFrame) -> DataFrame:
        """Rows with the votes of both mask layers, taken in one pass, and what their object's votes must reach.

        Three prompt terms or more lower the shares.  Rows of objects without masks are left out.
        """
        layers = ["wide", "tight"]
        voted, counts = self._voted(df, layers)
        prompts = None
        if self.g.prompts is not None:
            counts, prompts = counts.join(self.g.prompts, self.keys, "left"), F.col("n_prompts")
        need = {f"need_{n}": vo.required_votes(F.col(f"n_views_{n}"), frac, prompts) for n, frac in zip(layers, (self.g.wide_frac, self.g.tight_frac))}
        counts = counts.select(*self.keys, *[c.alias(n) for n, c in need.items()])
        return stage(df.join(voted, [*self.g.ids, *self.keys]).join(staged_small(counts), self.keys))

    def _enough(self, df: DataFrame, layer: str) -> DataFrame:
        need = F.col(f"need_{layer}")
        return df.where((need > 0) & (F.col(f"votes_{layer}") >= need) & (F.col(f"visible_{layer}") >= need))

    def wide(self, df: DataFrame) -> DataFrame:
        return self._enough(df, "wide")

    def tight(self, df: DataFrame) -> DataFrame:
        return self._enough(df, "tight")

    def screened(self, routes: list[str], frac: float) -> DataFrame:
        """Uncarved hull rows of the items whose label takes one of the routes, with enough wide votes of rounded pixels.

        Rows are judged where they are found; the hull is not written.
        """
        g = self.g
        on, extra = (self.keys, []) if g.item in g.views.columns else (g.on, [g.item])
        masked = vo.masked_views(g.views, g.masks, on, extra, ["wide"])
        boxes = g.boxes.where(lb.procedure(F.col("label")).isin(routes))
        return hull_mask_votes(self.points, g.hull_view, boxes, masked, g.masks, vo.view_counts(masked, self.keys, ["wide"]), g.on, g.item, g.ids, frac)

    def floor(self, df: DataFrame) -> DataFrame:
        return df.where(~F.col("on_floor"))

    def box(self, df: DataFrame) -> DataFrame:
        g = self.g
        voted = vo.box_votes(df, g.view_boxes, self.keys, g.ids)
        return stage(_keep(df, vo.keep_box_votes(voted, g.box_frac), self.row))

    def inside(self, df: DataFrame) -> DataFrame:
        """Insideness, the guarded ladder of each object, and its strictest safe rung."""
        g = self.g
        scored = vo.insideness(df.withColumns({"votes": F.col("votes_wide"), "visible": F.col("visible_wide")}))
        rungs = [(f"{t:.2f}", t) for t in k.SCORE_LADDER]
        sweep = sel.threshold_sweep(scored, self.keys, rungs, lambda t: F.col("insideness") >= t)
        sweep = sweep.withColumn("thresh", F.col("name").cast("double"))
        labels = g.boxes.select(*self.keys, "label")
        guard = stage(sel.collapse_guard(sel.ladder_by_label(sweep, labels, self.keys), self.keys))
        pick = sel.rule_pick(guard, self.keys).join(guard.select(*self.keys, "rung", "thresh"), [*self.keys, "rung"])
        out = scored.join(staged_small(pick.select(*self.keys, "thresh")), self.keys)
        return out.where(F.col("insideness") >= F.col("thresh")).select(*df.columns)

    def destreak(self, df: DataFrame) -> DataFrame:
        return df.where(~F.col("streak"))


def extract_general(e: Extraction) -> DataFrame:
    return e.destreak(e.inside(e.box(e.floor(e.tight(e.wide(e.judged(e.hull(["general"]))))))))


def extract_bookshelf(e: Extraction) -> DataFrame:
    """The general route without the floor step."""
    return e.destreak(e.inside(e.box(e.tight(e.wide(e.judged(e.hull(["bookshelf"])))))))


def extract_table(e: Extraction) -> DataFrame:
    return e.floor(e.wide(e.judged(e.hull(["table"]))))


def extract_lamp(e: Extraction) -> DataFrame:
    return e.destreak(e.box(e.wide(e.judged(e.hull(["lamp"])))))


def extract_tv(e: Extraction, frac: float = k.TV_VOTE_FRAC) -> DataFrame:
    """Rounded projection votes on the hull of each screen."""
    return e.screened(["tv"], frac)


def extract_rug(cones: DataFrame, in_image: Column, siblings: DataFrame, scene: list[str], item: str, obj: str, ids: list[str]) -> DataFrame:
    """Of each rug: the band around its surface in its box, without what stands on it.  ``cones``: a row per splat and rug."""
    band = stage(fl.rug_band(cones, [*scene, item], in_image))
    return sp.sibling_subtract(band, siblings, scene, obj, ids, k.SIBLING_RADIUS_M, [item])


def extract_art(hull: DataFrame, splats: DataFrame, view_boxes: DataFrame, eyes: DataFrame, on: list[str], item: str, ids: list[str]) -> DataFrame:
    """Box votes on the hull, then the slab around the piece's own plane.

    ``hull`` is of ``splats`` with their pixels (``votes.with_pixels``); its rows are judged in place, and only those that stay are written.
    """
    voted = vo.hull_box_votes(hull, splats, view_boxes, on, item, ids, carry=["x", "y", "z"])
    named = all_of([F.col(c).isNotNull() for c in (*ids, item)])
    kept = stage(vo.keep_art_votes(voted).where(named).select(*ids, *on, "x", "y", "z", item))
    return fl.wall_slab(kept, [item], fl.pca_normals(kept, [item], eyes))


def finalise_scene(splats: DataFrame, stage_splats: DataFrame, ids: list[str], scene: list[str], obj: str,
                   radius: float = k.MATCH_RADIUS_M) -> DataFrame:
    """Parents, subtraction of children, background and the reassembled counts."""
    boxes = stage(fr.robust_aabb(splats, [*scene, obj]))
    links = stage(hi.parent_child(boxes, scene, obj))
    carved, _ = hi.child_aabb_subtract(splats, fr.tight_aabb(splats, [*scene, obj]), links, scene, obj, ids)
    whole = splats.join(light(stage(links.select(*scene, F.col("parent").alias(obj)).distinct())), [*scene, obj], "left_anti")
    objects = stage(whole.unionByName(carved))
    background = stage(sp.radius_anti(splats, stage_splats, scene, [obj, *ids], radius, wide=8))
    merged = inv.merge_scene(background, objects)
    return inv.reassembly_check(background, objects, merged, scene)
