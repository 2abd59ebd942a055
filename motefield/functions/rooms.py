"""Room types: detection passes and the extra keep and skip lines of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PLANTS = "floor-standing potted plants"
_LAMPS = "floor-standing lamps"
_SCREENS = "TVs / monitors / mirrors mounted on walls or sitting on furniture"
_MIRRORS = "mirrors mounted on walls"
_STOVES = "free-standing stoves / ovens / range hoods"
_FRIDGES = "free-standing refrigerators"
_APPLIANCES = "kitchen appliances (kettles, coffee makers, microwaves, toasters, blenders, mixers)"

# fixed values: room types with their passes, keep lines and skip lines
ROOMS: dict[str, tuple[list[tuple[str, list[str]]], list[str], list[str]]] = {
    "living_room": (
        [("pass0_shelving", ["bookshelf", "bookcase", "open shelving unit", "etagere", "display shelf",
                             "tall shelving unit"]),
         ("pass1_seating", ["sofa", "armchair", "chair", "ottoman", "stool", "loveseat", "recliner", "bench"]),
         ("pass2_storage", ["cabinet", "sideboard", "credenza", "tv stand", "media console"]),
         ("pass3_tables", ["coffee table", "side table", "console table", "end table"])],
        [_LAMPS, _PLANTS, _SCREENS, "free-standing speakers / hi-fi cabinets / record players on the floor"], []),
    "dining_room": (
        [("pass0_shelving", ["bookshelf", "bookcase", "open shelving unit", "etagere", "display shelf"]),
         ("pass1_seating", ["dining chair", "armchair", "bench"]),
         ("pass2_storage", ["sideboard", "buffet", "cabinet", "credenza", "china cabinet", "hutch"]),
         ("pass3_tables", ["dining table", "side table", "console table"])],
        [_LAMPS, _PLANTS, _MIRRORS], []),
    "kitchen": (
        [("pass1_seating", ["bar stool", "kitchen stool", "chair"]),
         ("pass2_islands", ["kitchen island", "kitchen cart", "freestanding cabinet"]),
         ("pass3_tables", ["kitchen table", "breakfast table"])],
        [_STOVES, _FRIDGES, _APPLIANCES, _PLANTS],
        ["kitchen base cabinets, kitchen wall cabinets, kitchen built-ins, and any cabinetry that runs "
         "along the kitchen wall"]),
    "bedroom": (
        [("pass1_bed", ["bed", "platform bed", "daybed", "bunk bed"]),
         ("pass2_seating", ["chair", "armchair", "stool", "bench", "ottoman"]),
         ("pass3_storage", ["dresser", "wardrobe", "armoire", "chest of drawers", "nightstand",
                            "bedside table", "vanity"]),
         ("pass4_tables", ["desk", "side table", "writing desk"])],
        ["bookshelves / bookcases / open shelving units", _LAMPS, _PLANTS, _SCREENS,
         "freestanding wardrobes / armoires / chests not caught by topdown"],
        ["built-in closets, walk-in closet doors, recessed wardrobes",
         "items lying on the bed (pillows, blankets, throws — these are part of the bed's bbox)"]),
    "office": (
        [("pass1_desks", ["desk", "writing desk", "executive desk", "credenza", "conference table"]),
         ("pass2_seating", ["office chair", "desk chair", "task chair", "armchair", "couch", "bench"]),
         ("pass3_storage", ["filing cabinet", "bookshelf", "bookcase", "credenza", "cabinet", "lateral file"]),
         ("pass4_tables", ["side table", "coffee table", "console table"])],
        ["tall bookshelves / bookcases / open shelving units / filing towers (treat each unit as ONE object)",
         _LAMPS, _PLANTS, "monitors / TVs sitting on desks or mounted on walls",
         "printers / multi-function printers / paper shredders",
         "free-standing whiteboards / cork boards / easels"],
        ["items sitting on the desk (keyboards, mice, papers, mugs, pens, books — these belong to the "
         "desk's bbox)"]),
    "bathroom": (
        [("pass1_fixtures", ["toilet", "freestanding bathtub", "vanity", "freestanding shower"]),
         ("pass2_storage", ["cabinet", "linen cabinet", "vanity cabinet"]),
         ("pass3_seating", ["stool", "bench", "chair"])],
        [_PLANTS, _MIRRORS, "wall-mounted shelves / open shelving", "towel racks (free-standing)"],
        ["wall-mounted toiletry holders, soap dishes, shower fixtures, toilet paper holders, towel bars"]),
    "hallway": (
        [("pass1_seating", ["bench", "stool", "chair"]),
         ("pass2_storage", ["console table", "credenza", "shoe cabinet", "coat stand", "umbrella stand"]),
         ("pass3_tables", ["console table", "side table"])],
        ["tall narrow bookshelves / shelving units", _LAMPS, _PLANTS, _MIRRORS], []),
    "mixed": (
        [("pass0_shelving", ["bookshelf", "bookcase", "open shelving unit", "etagere", "display shelf",
                             "filing tower"]),
         ("pass1_seating", ["sofa", "armchair", "chair", "ottoman", "stool", "loveseat", "recliner", "bench",
                            "dining chair", "office chair", "bar stool"]),
         ("pass2_bed", ["bed", "platform bed", "daybed"]),
         ("pass3_storage", ["cabinet", "sideboard", "credenza", "tv stand", "media console", "dresser",
                            "wardrobe", "chest of drawers", "nightstand", "filing cabinet"]),
         ("pass4_tables", ["coffee table", "dining table", "side table", "console table", "desk", "kitchen table"]),
         ("pass5_kitchen", ["kitchen island", "kitchen cart"])],
        [_LAMPS, _PLANTS, _SCREENS, _STOVES, _FRIDGES, _APPLIANCES],
        ["kitchen base cabinets, kitchen wall cabinets, kitchen built-ins, any cabinetry running along the "
         "kitchen wall"]),
}


def room_table(spark: SparkSession) -> DataFrame:
    rows = [(r, [{"name": n, "categories": c} for n, c in p], keep, skip) for r, (p, keep, skip) in ROOMS.items()]
    return spark.createDataFrame(rows, "room_type string, passes array<struct<name:string,categories:array<string>>>, "
                                       "keep_extras array<string>, skip_extras array<string>")


def room_key(room_type: Column) -> Column:
    """Normalised room type; anything unknown is mixed."""
    from .labels import strip
    r = F.translate(strip(F.lower(F.coalesce(room_type, F.lit("")))), " -", "__")
    return F.when(r.isin(list(ROOMS)), r).otherwise("mixed")


def room_config(scenes: DataFrame, column: str = "room_type") -> DataFrame:
    """Scenes with the configuration of their room type."""
    from ..staging import small
    conf = room_table(scenes.sparkSession).withColumnRenamed("room_type", "room_key")
    return scenes.withColumn("room_key", room_key(F.col(column))).join(small(conf), "room_key")


def pass_prompts(configured: DataFrame, template: str) -> DataFrame:
    """A prompt per inventory pass: ``{categories}`` in the template is the pass's list."""
    out = configured.withColumn("_p", F.explode("passes"))
    text = F.replace(F.lit(template), F.lit("{categories}"), F.concat_ws(", ", "_p.categories"))
    return out.withColumns({"pass_name": F.col("_p.name"), "prompt": text}).drop("_p")


def detect_prompts(configured: DataFrame, template: str) -> DataFrame:
    """The side-view prompt with ``{extra_keep}`` and ``{extra_skip}`` lines filled in."""
    lines = lambda c, mark: F.array_join(F.transform(c, lambda x: F.concat(F.lit(mark), x, F.lit("\n"))), "")
    text = F.replace(F.lit(template), F.lit("{extra_keep}"), lines("keep_extras", "  • "))
    return configured.withColumn("prompt", F.replace(text, F.lit("{extra_skip}"), lines("skip_extras", "  - ")))
