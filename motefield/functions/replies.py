"""Column expressions that read answers out of free-text replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as k
from .labels import let, strip
from .rooms import ROOMS

# fixed values: reply patterns
BOX_LABEL = (r'(?:"bbox_2d"|"bbox_pixels"|"bbox")\s*:\s*\[\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\][^"]*'
             r'"label"\s*:\s*"([^"]+)"')
LABEL_BOX = (r'"label"\s*:\s*"([^"]+)"[^"]*(?:"bbox_2d"|"bbox_pixels"|"bbox")[^\[]*\[\s*(\d+)\s*,\s*(\d+)\s*,'
             r'\s*(\d+)\s*,\s*(\d+)')
BOX_ONLY = r'(?:"bbox_2d"|"bbox_pixels"|"bbox")\s*:\s*\[\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\]'
ROOM_FIELD = r'"room_type"\s*:\s*"([^"]+)"'

ITEM = "array<struct<bbox_2d:array<double>,label:string,confidence:string>>"


def unfenced(raw: Column) -> Column:
    return strip(F.replace(F.replace(raw, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))


def braces(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, null when there is no such stretch."""
    def cut(t: Column) -> Column:
        start = F.instr(t, "{")
        end = F.length(t) - F.instr(F.reverse(t), "}") + 1
        return F.when((start > 0) & F.contains(t, F.lit("}")) & (end > start), F.substring(t, start, end - start + 1))
    return let(text, cut)


def valid(json: Column) -> Column:
    """The text itself when it is well-formed JSON, else null."""
    return let(json, lambda j: F.when(F.try_parse_json(j).isNotNull(), j))


def reply_json(raw: Column) -> Column:
    return valid(braces(unfenced(raw)))


def ints(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("int"))


def _regex_items(text: Column, pattern: str, box: tuple[int, ...], label: int) -> Column:
    groups = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (*box, label)]
    return F.transform(F.arrays_zip(*[g.alias(n) for g, n in zip(groups, "abcde")]), lambda z: F.struct(
        F.array(*[z[n].cast("int") for n in "abcd"]).alias("bbox_2d"), z["e"].alias("label"),
        F.lit("unknown").alias("confidence")))


def items(raw: Column) -> Column:
    """Array of (bbox_2d, label, confidence): JSON, else box-then-label, else label-then-box."""
    def read(text: Column) -> Column:
        none = F.array().cast(ITEM)
        shaped = lambda js: F.transform(F.coalesce(F.from_json(js, f"items {ITEM}")["items"], none), lambda i: F.struct(
            ints(i["bbox_2d"]).alias("bbox_2d"), i["label"].alias("label"), i["confidence"].alias("confidence")))
        other = let(_regex_items(text, BOX_LABEL, (1, 2, 3, 4), 5), lambda one: F.when(F.size(one) > 0, one).otherwise(
            _regex_items(text, LABEL_BOX, (2, 3, 4, 5), 1)))
        return let(valid(braces(text)), lambda js: F.when(js.isNotNull(), shaped(js)).otherwise(other))
    return let(unfenced(raw), read)


def last_json(raw: Column) -> Column:
    """The whole reply as JSON, else its widest brace slice, else null."""
    fenced = lambda s: F.when(F.startswith(s, F.lit("```")), F.regexp_replace(
        F.regexp_replace(s, r"^```[a-zA-Z]*\n", ""), r"\n```\s*$", "")).otherwise(s)
    return let(let(strip(raw), fenced), lambda s: F.coalesce(valid(s), valid(braces(s))))


def _truthy(json: Column, field: str, default: bool) -> Column:
    return let(F.lower(F.get_json_object(json, f"$.{field}")), lambda v: F.when(v.isNull(), F.lit(default)).otherwise(
        ~v.isin("false", "0", "null", "", "0.0")))


def box(raw: Column, default_found: bool = False) -> Column:
    """Four ints of the box a reply found, else null; any of three field names, or a bare pattern."""
    def first_box(js: Column) -> Column:
        return F.coalesce(*[let(F.from_json(F.get_json_object(js, f"$.{f}"), "array<double>"), lambda a: F.when(F.size(a) > 0, a))
                            for f in ("bbox_2d", "bbox_pixels", "bbox")])

    def good(js: Column) -> Column:
        return let(first_box(js), lambda b: F.when(_truthy(js, "found", default_found) & (F.size(b) == 4), ints(b)))

    def read(text: Column) -> Column:
        m = F.array(*[F.regexp_extract(text, BOX_ONLY, i).try_cast("int") for i in (1, 2, 3, 4)])
        return let(braces(text), lambda part: let(valid(part), lambda js: F.when(js.isNotNull(), good(js)).when(
            part.isNotNull() & text.rlike(BOX_ONLY), m)))
    return let(unfenced(raw), read)


def pick(raw: Column, n: Column | int, default: Column) -> Column:
    """First integer token within 1..n, else the default."""
    n = F.lit(n) if isinstance(n, int) else n
    tokens = F.split(strip(F.translate(raw, ",.", "  ")), r"\s+")
    hits = F.filter(F.transform(F.filter(tokens, lambda t: t.rlike("^[0-9]+$")), lambda t: t.try_cast("bigint")),
                    lambda t: (t >= 1) & (t <= n))
    return F.coalesce(F.get(hits, F.lit(0)), default.cast("bigint"))


def winner(raw: Column, labels: list[str]) -> Column:
    """First candidate named as ``WINNER=<letter>``, else the middle one."""
    up = F.upper(raw)
    hit = [F.when(F.contains(up, F.lit(f"WINNER={x}")), F.lit(x)) for x in labels]
    return F.coalesce(*hit, F.lit(labels[len(labels) // 2]))


def clamped_number(raw: Column, n: Column | int) -> Column:
    """First number held within 1..n, as a position from 0; 0 without a number."""
    n = F.lit(n) if isinstance(n, int) else n
    v = F.coalesce(F.regexp_extract(raw, r"\d+", 0).try_cast("bigint"), F.lit(1))
    return F.greatest(F.lit(1), F.least(v, n)) - 1


def clamped_index(raw: Column, field: str, n: Column | int) -> Column:
    """An integer JSON field held within 0..n-1; 0 on failure."""
    n = F.lit(n) if isinstance(n, int) else n
    v = F.get_json_object(reply_json(raw), f"$.{field}").try_cast("bigint")
    return F.greatest(F.lit(0), F.least(n - 1, F.coalesce(v, F.lit(0))))


def companions(raw: Column, w: Column, h: Column) -> Column:
    """Items of a reply with pixel boxes; an empty array on any failure."""
    got = F.coalesce(F.from_json(reply_json(raw), f"items {ITEM}")["items"], F.array().cast(ITEM))
    px = lambda v, size: (v * size / 1000).cast("int")
    return F.transform(got, lambda i: F.struct(i["label"].alias("label"), F.when(F.size(i["bbox_2d"]) == 4, F.array(
        px(i["bbox_2d"][0], w), px(i["bbox_2d"][1], h), px(i["bbox_2d"][2], w), px(i["bbox_2d"][3], h))).alias("bbox_pixels")))


def yes_no(raw: Column) -> Column:
    up = F.upper(strip(raw))
    return up.rlike(r"\bYES\b") & ~F.startswith(up, F.lit("NO"))


def room_type(raw: Column) -> Column:
    """JSON field, else pattern, else the first known name in the text; unknown is mixed."""
    js = F.nullif(F.get_json_object(reply_json(raw), "$.room_type"), F.lit(""))
    field = F.nullif(F.regexp_extract(raw, ROOM_FIELD, 1), F.lit(""))
    flat = F.replace(F.lower(raw), F.lit(" "), F.lit("_"))
    scan = [F.when(F.contains(flat, F.lit(r)), F.lit(r)) for r in ROOMS]
    rt = F.coalesce(js, field, *scan)
    return F.when(rt.isin(list(ROOMS)), rt).otherwise("mixed")


def judge(raw: Column, fallback: Column) -> dict[str, Column]:
    """Verdict, next threshold and reason of a floor-band judge; STOP when unreadable."""
    js = reply_json(raw)
    get = lambda f: F.get_json_object(js, f"$.{f}")
    t = F.when(get("new_thresh_m").isNull(), fallback).otherwise(get("new_thresh_m").try_cast("double"))
    ok = js.isNotNull() & t.isNotNull()
    v = F.upper(F.coalesce(get("verdict"), F.lit("STOP")))
    return {
        "verdict": F.when(ok & v.isin("STOP", "INCREASE", "DECREASE"), v).otherwise("STOP"),
        "new_thresh_m": F.when(ok, F.greatest(F.lit(k.FLOOR_THRESH_MIN), F.least(F.lit(k.FLOOR_THRESH_MAX), t))).otherwise(fallback),
        "floor_visible": F.when(ok, _truthy(js, "floor_visible", False)).otherwise(False),
        "legs_preserved": F.when(ok, _truthy(js, "legs_preserved", True)).otherwise(True),
        "reasoning": F.when(ok, F.substring(F.coalesce(get("reasoning"), F.lit("")), 1, 200)).otherwise("parse_error")}


def face_on(raw: Column, yaws: list[int] = k.ART_YAWS) -> dict[str, Column]:
    js = reply_json(raw)
    y = F.get_json_object(js, "$.best_yaw_deg").try_cast("int")
    return {"best_yaw": F.when(y.isin(yaws), y).otherwise(yaws[0]),
            "reasoning": F.when(js.isNull(), "fallback").otherwise(F.coalesce(F.get_json_object(js, "$.reasoning"), F.lit("")))}


def art_qc(raw: Column) -> dict[str, Column]:
    """PASS unless a readable reply says REJECT."""
    text = unfenced(raw)
    part = braces(text)
    js = valid(part)
    v = F.upper(F.coalesce(F.get_json_object(js, "$.verdict"), F.lit("PASS")))
    return {"verdict": F.when(v.isin("PASS", "REJECT"), v).otherwise("PASS"),
            "reason": F.when(part.isNull(), "qc_parse_fallback").when(js.isNull(), "qc_json_fallback").otherwise(
                F.coalesce(F.get_json_object(js, "$.reason"), F.lit("")))}


def object_qc(raw: Column) -> dict[str, Column]:
    js = last_json(raw)
    return {"verdict": strip(F.upper(F.coalesce(F.get_json_object(js, "$.verdict"), F.lit("")))),
            "reason": F.coalesce(F.get_json_object(js, "$.reason"), F.lit(""))}


INFO = ("name string, description string, sub_objects array<string>, style string, materials array<string>, "
        "colors array<string>")


def info(raw: Column) -> Column:
    """Object attributes of a review reply."""
    return F.from_json(last_json(raw), INFO)
