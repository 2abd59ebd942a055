"""Column expressions on labels, prompts and slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: label word lists and patterns
SYNONYMS = [
    ("range hood", ["range hood", "hood vent", "extractor hood"]),
    ("bookshelf", ["bookshelf", "bookcase", "open shelving unit", "open shelving", "open shelf",
                   "open bookshelf", "open bookcase", "tall storage shelves", "tall storage shelf",
                   "tall shelves", "tall shelf", "tall shelving", "ladder shelves", "ladder shelf",
                   "display shelves", "display shelf", "shelving units", "shelving unit",
                   "wooden shelving", "metal shelving", "wooden shelves", "etagere", "étagère"]),
    ("floor lamp", ["floor lamp", "tall lamp", "standing lamp"]),
    ("potted plant", ["potted plant", "house plant", "houseplant", "indoor plant", "plant in pot",
                      "tall plant", "large plant"]),
    ("pet bed", ["pet bed", "dog bed", "cat bed", "animal bed"]),
    ("tv", ["flat screen tv", "flat-screen tv", "flat screen television", "flat-screen television",
            "television", "tv"]),
    ("mirror", ["wall mirror", "mirror"]),
    ("refrigerator", ["refrigerator", "fridge", "freezer"]),
    ("stove", ["kitchen stove", "stove", "oven", "cooktop", "range"]),
]
SINGULAR = ["refrigerator", "range hood", "stove", "kitchen stove"]
SHELVING = ["bookshelf", "bookcase", "book shelf", "shelving", "shelf", "etagere", "etagère", "étagère"]
RIGID_SHELVING = ["cabinet", "cupboard", "bookshelf", "bookcase", "book shelf", "shelf", "shelves",
                  "shelving", "etagere", "etagère", "étagère", "sideboard", "credenza", "hutch"]
WALL_FLUSH = ["cabinet", "cupboard", "sideboard", "credenza", "hutch", "buffet", "dresser",
              "wardrobe", "armoire", "chest of drawers", "console"]
CABINET_RICH = ["cabinet", "countertop", "sideboard", "console", "buffet", "hutch", "credenza",
                "shelving unit", "display shelf"]
LARGE_TABLES = ["dining table", "kitchen table", "writing table", "desk"]
TABLE_TOKENS = ["table", "desk"]
STRUCTURAL = ["legs", "leg", "base", "pedestal", "frame", "skirt", "plinth", "caster", "casters",
              "spindle", "spindles", "stretcher", "stretchers"]
TV_WORDS = r"\b(tv|television|monitor|screen|flat[- ]?screen)\b"
TV_NOT = r"\b(stand|console|cabinet|unit|table)\b"
LAMP_WORDS = r"\b(floor[- ]?lamp|floor[- ]?standing\s+lamp|standing\s+lamp|torch[ie]+re)\b"
SHELF_WORDS = (r"\b(bookshelf|book[- ]?shelf|bookcase|shelving(?:\s+unit)?|open\s+shelving"
               r"|etagere|etag[eè]re|étag[eè]re|shelf|shelves)\b")
RUG_WORDS = r"\b(rug|carpet|area\s+rug|floor\s+mat|runner)\b"
TABLE_WORDS = r"\b(table|desk)\b"
TABLE_NOT = r"\b(sideboard|cabinet|console|nightstand)\b"
STORAGE_WORDS = (r"\b(cabinet|cupboard|sideboard|console|credenza|hutch|bookshelf|bookcase|"
                 r"book[- ]?shelf|shelf|shelves|shelving|etagere|etag[eè]re|étag[eè]re)\b")
COMPANION_WORDS = [
    ("tv", ["tv", "monitor", "television", "screen"]),
    ("bookshelf", ["bookshelf", "bookcase", "shelving", "shelf", "etagere", "étagère"]),
    ("sideboard", ["sideboard", "credenza", "cabinet", "buffet", "console", "media"]),
    ("table", ["coffee table", "side table", "end table", "console table", "accent table"]),
    ("desk", ["desk", "workspace"]),
]
COMPANION_ITEMS = {
    "tv": "Soundbars / speakers / center channels, Remote controls, Set-top boxes / cable boxes / "
          "streaming devices / gaming consoles, Routers / modems, Visible cables / power cords "
          "(only if clearly bundled), Decor sitting on the same surface (small lamps, plants, "
          "figurines, books)",
    "bookshelf": "Books (groups of books on the same shelf count as ONE item per shelf, not per "
                 "book), Vases, Picture frames, Baskets, Small potted plants, Sculptures / "
                 "figurines, Decor objects, Small boxes / storage bins, Candles, Bowls, Small "
                 "lamps sitting on shelves",
    "sideboard": "Decor objects (vases, candles, sculptures, picture frames), Small lamps, Plants, "
                 "Books, Trays, Bowls / decorative dishes",
    "table": "Decor objects (books, candles, vases, sculptures), Coasters / trays, Plants, Small "
             "lamps, Remote controls, Magazines",
    "desk": "Monitor / laptop, Keyboard, Mouse, Lamp, Books / notebooks, Pen holder / stationery, "
            "Plants, Speakers / headphones, Cables",
    "generic": "Any accessory / supporting / decor objects sitting on, next to, or associated "
               "with the parent object",
}


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, so that expressions stay small."""
    return F.element_at(F.transform(F.array(value), use), 1)


def unicode_words(pattern: str) -> str:
    """Word boundaries that treat accented letters as letters."""
    return "(?U)" + pattern


def strip(c: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def mentions(label: Column, words: list[str]) -> Column:
    """Whether the lower-cased label holds any of the words as a substring."""
    lo = F.lower(F.coalesce(label, F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | F.contains(lo, F.lit(w))
    return out


def slug(label: Column, empty: str = "item", cap: int | None = None) -> Column:
    s = F.regexp_replace(F.lower(label), r"[^a-zA-Z0-9]+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    if cap:
        s = F.when(F.length(s) > cap, F.regexp_replace(F.substring(s, 1, cap), r"_+$", "")).otherwise(s)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(empty))


def _words_pattern(words: list[str]) -> str:
    return "|".join(w.replace("-", r"\-") for w in words)


_SYNONYM_LIST = [(w, name) for name, words in SYNONYMS for w in words]


def canonical(label: Column) -> Column:
    """Class name of the first synonym found on word boundaries, keeping what precedes it."""
    lo = strip(F.lower(F.coalesce(label, F.lit(""))))
    names = F.array(*[F.lit(n) for _, n in _SYNONYM_LIST])
    heads = F.array(*[F.lit(rf"(?U)^(.*?)\b{_words_pattern([w])}\b") for w, _ in _SYNONYM_LIST])

    def first(c: Column) -> Column:
        return F.coalesce(*[F.when(c.rlike(unicode_words(rf"\b{_words_pattern([w])}\b")), F.lit(i + 1))
                            for i, (w, _) in enumerate(_SYNONYM_LIST)])

    def renamed(s: Column) -> Column:
        prefix = strip(F.call_function("regexp_extract", s["lo"], F.element_at(heads, s["i"]), F.lit(1)))
        return F.when(s["i"].isNull(), s["lo"]).otherwise(strip(F.concat(prefix, F.lit(" "), F.element_at(names, s["i"]))))

    return let(let(lo, lambda c: F.struct(c.alias("lo"), first(c).alias("i"))), renamed)


def is_singular(canon: Column) -> Column:
    """The label, its last two words or its last word is a one-per-room class."""
    parts = F.split(strip(canon), r"\s+")
    last_two = F.array_join(F.slice(parts, -F.least(F.size(parts), F.lit(2)), 2), " ")
    return canon.isin(SINGULAR) | last_two.isin(SINGULAR) | F.element_at(parts, -1).isin(SINGULAR)


def _found(label: Column, pattern: str) -> Column:
    return F.coalesce(label, F.lit("")).rlike("(?iu)" + unicode_words(pattern))


def procedure(label: Column) -> Column:
    """Extraction route by label, first matching rule."""
    return (F.when(_found(label, TV_WORDS) & ~_found(label, TV_NOT), "tv")
            .when(_found(label, LAMP_WORDS), "lamp")
            .when(_found(label, SHELF_WORDS), "bookshelf")
            .when(_found(label, RUG_WORDS), "rug")
            .when(_found(label, TABLE_WORDS) & ~_found(label, TABLE_NOT), "table")
            .otherwise("general"))


def checked_procedure(label: Column, decided: Column, reply: Column) -> Column:
    """Correct the route of storage labels by an open-or-closed reply."""
    ans = F.lower(strip(F.coalesce(reply, F.lit(""))))
    fixed = (F.when(F.contains(ans, F.lit("open")) & F.contains(ans, F.lit("shelv")), F.lit("bookshelf"))
             .when(F.contains(ans, F.lit("closed")) & F.contains(ans, F.lit("cabinet"))
                   & (decided == "bookshelf"), F.lit("general"))
             .otherwise(decided))
    return F.when(_found(label, STORAGE_WORDS), fixed).otherwise(decided)


def is_floor_lamp(label: Column) -> Column:
    return mentions(label, ["floor"]) & mentions(label, ["lamp"])


def flags(label: Column) -> dict[str, Column]:
    return {"rigid_shelving": mentions(label, RIGID_SHELVING),
            "wall_flush": mentions(label, WALL_FLUSH),
            "cabinet_rich": mentions(label, CABINET_RICH),
            "floor_lamp": is_floor_lamp(label),
            "stool": mentions(label, ["stool"])}


def pads(label: Column) -> dict[str, Column]:
    """Hull padding shares and upward extension by label class."""
    shelving, table = mentions(label, SHELVING), mentions(label, LARGE_TABLES)
    return {"pad_long": F.when(shelving | table, 0.15).otherwise(0.04),
            "pad_short": F.when(~shelving & table, 0.15).otherwise(0.04),
            "top_extend_m": F.when(~shelving & table, 0.3).otherwise(2.0)}


def companion_preset(label: Column) -> Column:
    lo = F.lower(label)
    out = None
    for name, words in COMPANION_WORDS:
        hit = lo.rlike(unicode_words(rf"\b({_words_pattern(words)})\b"))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("generic")


def companion_items(preset: Column) -> Column:
    pairs = [F.lit(x) for kv in COMPANION_ITEMS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), preset)


def tagged_terms(prompt: Column) -> Column:
    """``term {soft}|term {hard}`` to an array of (text, tag); no tag means soft."""
    tag = r"(?i)\s*\{(soft|hard)\}\s*$"
    terms = F.filter(F.transform(F.split(prompt, r"\|"), strip), lambda t: t != "")
    out = F.transform(terms, lambda t: F.struct(
        strip(F.regexp_replace(t, tag, "")).alias("text"),
        F.coalesce(F.nullif(F.lower(F.regexp_extract(t, tag, 1)), F.lit("")), F.lit("soft")).alias("tag")))
    return F.filter(out, lambda s: s["text"] != "")


def cleaned_prompt(raw: Column) -> Column:
    """Strip fences and quotes, keep the first line with any text."""
    def unfence(s: Column) -> Column:
        lines = F.filter(F.split(s, "\n"), lambda x: ~F.startswith(x, F.lit("```")))
        return F.when(F.startswith(s, F.lit("```")), strip(F.array_join(lines, "\n"))).otherwise(s)

    s = let(strip(raw), unfence)
    for q in ['"', "'", "`"]:
        s = F.regexp_replace(s, f"^{q}+|{q}+$", "")

    def first_line(c: Column) -> Column:
        bare = lambda x: strip(F.regexp_replace(F.regexp_replace(strip(x), '^"+|"+$', ""), "^'+|'+$", ""))
        lines = F.filter(F.transform(F.split(c, r"\r\n|[\n\r]"), bare), lambda x: x != "")
        return F.coalesce(F.get(lines, F.lit(0)), c)

    return let(strip(s), first_line)


def structural(text: Column, parent: Column) -> Column:
    """The prompt names a structural piece of the parent: its last word plus legs, base ..."""
    noun = F.element_at(F.split(strip(F.lower(parent)), r"\s+"), -1)
    lo = F.lower(text)
    return F.contains(lo, noun) & lo.rlike(rf"\b({_words_pattern(STRUCTURAL)})\b")
