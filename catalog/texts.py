"""Queries on labels, prompts and replies."""

from pyspark.sql import functions as F

from motefield import constants as k
from motefield.functions import labels as lb
from motefield.functions import replies as rp
from motefield.functions import rooms as rm
from motefield.operators import inventory as inv
from motefield.operators import selection as sel

from .aggregates import CANON, CANON_CTE, NORM, SING_CTE, _SLUG, norm_items
from .cleaning import OBJ, like_any
from .fixtures import oracle, table
from .registry import query
from .rows import H, PROC, W


def items(spark, sf, **cols):
    return table(spark, sf, "items").withColumns({n: F.expr(e) for n, e in cols.items()})


def raw_cte(expr):
    return f"rr AS (SELECT *, {expr} AS raw FROM items)"


TRIM = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
UNFENCE = TRIM.format("replace(replace(raw, '```json', ''), '```', '')")
BRACE = "CASE WHEN instr(t, '{') > 0 AND contains(t, '}') AND length(t) - instr(reverse(t), '}') + 1 > instr(t, '{') THEN substr(t, instr(t, '{'), length(t) - instr(reverse(t), '}') + 1 - instr(t, '{') + 1) END"


def js_cte(expr=None, source="items"):
    """``js``: rows with the unfenced text ``t``, its brace slice ``p`` and the slice when valid ``j``."""
    first = f"rr AS (SELECT *{', ' + expr + ' AS raw' if expr else ''} FROM {source}), "
    return first + f"tt AS (SELECT *, {UNFENCE} AS t FROM rr), pp AS (SELECT *, {BRACE} AS p FROM tt), js AS (SELECT *, CASE WHEN json_valid(p) THEN p END AS j FROM pp)"


def js(f):
    return f"json_extract_string(j, '$.{f}')"


@query("slugify", oracle(["items"], f"SELECT item_id, {_SLUG.format('label', 'item')} AS slug, {_SLUG.format('label', 'object')} AS capped FROM items"))
def slugify(spark, sf):
    return items(spark, sf).select("item_id", lb.slug(F.col("label")).alias("slug"), lb.slug(F.col("label"), "object", 60).alias("capped"))


@query("canonical_label", oracle(["items"], "SELECT item_id, canonical FROM ca", NORM + ", " + CANON_CTE))
def canonical_label(spark, sf):
    return items(spark, sf).select("item_id", lb.canonical(F.col("label")).alias("canonical"))


@query("is_singular", oracle(["items"], "SELECT item_id, single AS is_singular FROM si", SING_CTE))
def is_singular(spark, sf):
    it = norm_items(spark, sf).withColumn("canonical", lb.canonical(F.col("label")))
    return it.select("item_id", lb.is_singular(F.col("canonical")).alias("is_singular"))


_BL = "(?:\"bbox_2d\"|\"bbox_pixels\"|\"bbox\")\\s*:\\s*\\[\\s*(\\d+)\\s*,\\s*(\\d+)\\s*,\\s*(\\d+)\\s*,\\s*(\\d+)\\s*\\][^\"]*\"label\"\\s*:\\s*\"([^\"]+)\""


@query("parse_items", oracle(["items", "replies"], f"""SELECT item_id, pos, x0, y0, x1, y1, label, confidence FROM (
  SELECT item_id, CAST(i - 1 AS INTEGER) AS pos, CAST(json_extract(j, concat('$.items[', i - 1, '].bbox_2d[0]')) AS INTEGER) AS x0, CAST(json_extract(j, concat('$.items[', i - 1, '].bbox_2d[1]')) AS INTEGER) AS y0,
    CAST(json_extract(j, concat('$.items[', i - 1, '].bbox_2d[2]')) AS INTEGER) AS x1, CAST(json_extract(j, concat('$.items[', i - 1, '].bbox_2d[3]')) AS INTEGER) AS y1,
    json_extract_string(j, concat('$.items[', i - 1, '].label')) AS label, json_extract_string(j, concat('$.items[', i - 1, '].confidence')) AS confidence
  FROM (SELECT *, unnest(range(1, CAST(json_array_length(j, '$.items') AS BIGINT) + 1)) AS i FROM js WHERE j IS NOT NULL) AS q
  UNION ALL SELECT item_id, 0, CAST(regexp_extract(t, '{_BL}', 1) AS INTEGER), CAST(regexp_extract(t, '{_BL}', 2) AS INTEGER), CAST(regexp_extract(t, '{_BL}', 3) AS INTEGER),
    CAST(regexp_extract(t, '{_BL}', 4) AS INTEGER), regexp_extract(t, '{_BL}', 5), 'unknown' FROM js WHERE j IS NULL AND regexp_matches(t, '{_BL}')) AS u""", js_cte(None, "replies")))
def parse_items(spark, sf):
    r = table(spark, sf, "replies").select("item_id", F.posexplode(rp.items(F.col("raw"))).alias("pos", "i"))
    return r.select("item_id", "pos", *[F.col("i.bbox_2d")[n].alias(c) for n, c in enumerate(("x0", "y0", "x1", "y1"))], "i.label", "i.confidence")


_LAST = """CASE k % 5 WHEN 0 THEN concat('```json', chr(10), '{"a": ', CAST(k AS STRING), '}', chr(10), '```') WHEN 1 THEN concat(' {"a": ', CAST(k AS STRING), '} ')
  WHEN 2 THEN concat('text {"a": ', CAST(k AS STRING), '} more') WHEN 3 THEN 'no json here' ELSE concat('bad {"a": ', CAST(k AS STRING), ' more') END"""


@query("last_json", oracle(["items"], "SELECT item_id, CAST(CASE WHEN k % 5 < 3 THEN k END AS BIGINT) AS a, k % 5 < 3 AS readable FROM items"))
def last_json(spark, sf):
    j = rp.last_json(F.col("raw"))
    return items(spark, sf, raw=_LAST).select("item_id", F.get_json_object(j, "$.a").cast("bigint").alias("a"), j.isNotNull().alias("readable"))


_BOXR = """CASE k % 7 WHEN 0 THEN concat('{"found": true, "bbox_2d": [', CAST(bx0 AS STRING), ', ', CAST(by0 AS STRING), ', ', CAST(bx1 AS STRING), ', ', CAST(by1 AS STRING), ']}')
  WHEN 1 THEN concat('```json', chr(10), '{"found": true, "bbox": [', CAST(bx0 AS STRING), ', ', CAST(by0 AS STRING), ', ', CAST(bx1 AS STRING), ', ', CAST(by1 AS STRING), ']}', chr(10), '```')
  WHEN 2 THEN '{"found": false}' WHEN 3 THEN concat('{"found": true, "bbox_pixels": [', CAST(bx0 AS STRING), ', ', CAST(by0 AS STRING), ', ', CAST(bx1 AS STRING), ', ', CAST(by1 AS STRING), '], oops}')
  WHEN 4 THEN 'nothing' WHEN 5 THEN concat('{"bbox_2d": [', CAST(bx0 AS STRING), ', ', CAST(by0 AS STRING), ', ', CAST(bx1 AS STRING), ', ', CAST(by1 AS STRING), ']}') ELSE '{"found": true, "bbox_2d": [1, 2, 3]}' END"""


def _boxes(name, has):
    return f"SELECT item_id, '{name}' AS kind, " + ", ".join(f"CAST(CASE WHEN {has} THEN b{c} END AS INTEGER) AS {c}" for c in ("x0", "y0", "x1", "y1")) + " FROM items"


@query("parse_bbox_reply", oracle(["items"], _boxes("strict", "k % 7 IN (0, 1, 3)") + " UNION ALL " + _boxes("lenient", "k % 7 IN (0, 1, 3, 5)")))
def parse_bbox_reply(spark, sf):
    it = items(spark, sf, raw=_BOXR)
    out = None
    for kind, lenient in (("strict", False), ("lenient", True)):
        b = rp.box(F.col("raw"), lenient)
        part = it.select("item_id", F.lit(kind).alias("kind"), *[F.get(b, F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])
        out = part if out is None else out.unionByName(part)
    return out


_PICK = """CASE k % 5 WHEN 0 THEN concat('I choose ', CAST(k % 9 AS STRING), '.') WHEN 1 THEN concat('candidate 12, or ', CAST(k % 6 AS STRING)) WHEN 2 THEN 'none of them'
  WHEN 3 THEN concat('3', CAST(k % 4 AS STRING), 'x 2') ELSE CAST(k % 7 AS STRING) END"""


@query("parse_pick", oracle(["items"], """SELECT item_id, coalesce(list_filter(list_transform(list_filter(string_split_regex(trim(translate(raw, ',.', '  ')), '\\s+'), lambda t: regexp_full_match(t, '[0-9]+')), lambda t: CAST(t AS BIGINT)),
  lambda t: t >= 1 AND t <= 5)[1], CAST(3 AS BIGINT)) AS pick FROM rr""", raw_cte(_PICK)))
def parse_pick(spark, sf):
    return items(spark, sf, raw=_PICK).select("item_id", rp.pick(F.col("raw"), 5, F.lit(3)).alias("pick"))


_WIN = "CASE k % 4 WHEN 0 THEN concat('winner=', substr('ABCDEFG', CAST(k % 7 AS INT) + 1, 1), '; REASON=x') WHEN 1 THEN 'I like C' WHEN 2 THEN 'WINNER=E and WINNER=B' ELSE 'WINNER=Z' END"


@query("parse_winner", oracle(["items"], "SELECT item_id, CASE WHEN contains(upper(raw), 'WINNER=A') THEN 'A' WHEN contains(upper(raw), 'WINNER=B') THEN 'B' WHEN contains(upper(raw), 'WINNER=C') THEN 'C' WHEN contains(upper(raw), 'WINNER=D') THEN 'D' WHEN contains(upper(raw), 'WINNER=E') THEN 'E' ELSE 'C' END AS winner FROM rr", raw_cte(_WIN)))
def parse_winner(spark, sf):
    return items(spark, sf, raw=_WIN).select("item_id", rp.winner(F.col("raw"), list("ABCDE")).alias("winner"))


_IDX = """CASE k % 4 WHEN 0 THEN concat('{"best_iter": ', CAST(k % 9 AS STRING), ', "reasoning": "r"}') WHEN 1 THEN concat('Pick ', CAST(k % 12 AS STRING), ' of 5') WHEN 2 THEN '{"best_iter": "x"}' ELSE 'no' END"""


@query("parse_clamped", oracle(["items"], """SELECT item_id, greatest(1, least(coalesce(TRY_CAST(regexp_extract(raw, '[0-9]+') AS BIGINT), 1), 5)) - 1 AS number,
  CASE WHEN k % 4 = 0 THEN greatest(0, least(4, k % 9)) ELSE CAST(0 AS BIGINT) END AS idx FROM rr""", raw_cte(_IDX)))
def parse_clamped(spark, sf):
    return items(spark, sf, raw=_IDX).select("item_id", rp.clamped_number(F.col("raw"), 5).alias("number"), rp.clamped_index(F.col("raw"), "best_iter", 5).alias("idx"))


@query("parse_companions", oracle(["items", "replies"], """SELECT item_id, json_extract_string(j, '$.items[0].label') AS label, CAST(trunc(CAST(json_extract(j, '$.items[0].bbox_2d[0]') AS DOUBLE) * 192 / 1000) AS INTEGER) AS x0,
  CAST(trunc(CAST(json_extract(j, '$.items[0].bbox_2d[3]') AS DOUBLE) * 108 / 1000) AS INTEGER) AS y1 FROM js WHERE j IS NOT NULL""", js_cte(None, "replies")))
def parse_companions(spark, sf):
    r = table(spark, sf, "replies").select("item_id", F.explode(rp.companions(F.col("raw"), F.lit(W), F.lit(H))).alias("c"))
    return r.select("item_id", "c.label", F.col("c.bbox_pixels")[0].alias("x0"), F.col("c.bbox_pixels")[3].alias("y1"))


_YES = "CASE k % 6 WHEN 0 THEN 'YES' WHEN 1 THEN 'It stands at a wall, yes.' WHEN 2 THEN 'No, but yes' WHEN 3 THEN 'yesterday' WHEN 4 THEN ' yes ' ELSE 'no' END"


@query("parse_yes_no", oracle(["items"], """SELECT 'reply' AS kind, CAST(item_id AS VARCHAR) AS id, k % 6 IN (0, 1, 4) AS wall FROM items UNION ALL
  SELECT 'talk', concat(conv_id, '/', turn), regexp_matches(upper(text), '\\bYES\\b') AND NOT starts_with(ltrim(upper(text)), 'NO') FROM conversations"""))
def parse_yes_no(spark, sf):
    a = items(spark, sf, raw=_YES).select(F.lit("reply").alias("kind"), F.col("item_id").cast("string").alias("id"), rp.yes_no(F.col("raw")).alias("wall"))
    b = table(spark, sf, "conversations").select(F.lit("talk").alias("kind"), F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("id"),
                                                 rp.yes_no(F.col("text")).alias("wall"))
    return a.unionByName(b)


_ROOMR = """CASE k % 6 WHEN 0 THEN '{"room_type": "bedroom"}' WHEN 1 THEN 'x "room_type": "office" broken {' WHEN 2 THEN 'looks like a Dining Room to me' WHEN 3 THEN '{"room_type": "Garage"}' WHEN 4 THEN 'who knows' ELSE '{"room_type": ""} kitchen' END"""


@query("parse_room_type", oracle(["items"], "SELECT item_id, CASE k % 6 WHEN 0 THEN 'bedroom' WHEN 1 THEN 'office' WHEN 2 THEN 'dining_room' WHEN 5 THEN 'kitchen' ELSE 'mixed' END AS room_type FROM items"))
def parse_room_type(spark, sf):
    return items(spark, sf, raw=_ROOMR).select("item_id", rp.room_type(F.col("raw")).alias("room_type"))


_JUDGE = """CASE k % 5 WHEN 0 THEN concat('{"verdict": "increase", "new_thresh_m": ', CAST(k % 90 AS STRING), 'e-2, "floor_visible": true, "legs_preserved": false, "reasoning": "', repeat('ab', 120), '"}')
  WHEN 1 THEN '{"verdict": "MAYBE"}' WHEN 2 THEN '{"verdict": "DECREASE", "new_thresh_m": "soon"}' WHEN 3 THEN 'STOP' ELSE '{"verdict": "DECREASE", "new_thresh_m": 0.25}' END"""


@query("parse_judge", oracle(["items"], """SELECT item_id, CASE k % 5 WHEN 0 THEN 'INCREASE' WHEN 4 THEN 'DECREASE' ELSE 'STOP' END AS verdict,
  CASE k % 5 WHEN 0 THEN greatest(0.01e0, least(0.5e0, CAST(concat(CAST(k % 90 AS VARCHAR), 'e-2') AS DOUBLE))) WHEN 4 THEN 0.25e0 ELSE 0.1e0 END AS new_thresh_m, k % 5 = 0 AS floor_visible, k % 5 <> 0 AS legs_preserved,
  CASE k % 5 WHEN 0 THEN repeat('ab', 100) WHEN 1 THEN '' WHEN 4 THEN '' ELSE 'parse_error' END AS reasoning FROM items"""))
def parse_judge(spark, sf):
    return items(spark, sf, raw=_JUDGE).select("item_id", *[c.alias(n) for n, c in rp.judge(F.col("raw"), F.lit(0.1)).items()])


_FACE = """CASE k % 4 WHEN 0 THEN concat('{"best_yaw_deg": ', CAST((k % 10) * 45 AS STRING), ', "reasoning": "flat"}') WHEN 1 THEN '{"best_yaw_deg": 50}' WHEN 2 THEN 'none' ELSE '{"best_yaw_deg": "90"}' END"""


@query("parse_face_on", oracle(["items"], """SELECT item_id, CAST(CASE k % 4 WHEN 0 THEN CASE WHEN k % 10 < 8 THEN (k % 10) * 45 ELSE 0 END WHEN 3 THEN 90 ELSE 0 END AS INTEGER) AS best_yaw,
  CASE k % 4 WHEN 0 THEN 'flat' WHEN 2 THEN 'fallback' ELSE '' END AS reasoning FROM items"""))
def parse_face_on(spark, sf):
    return items(spark, sf, raw=_FACE).select("item_id", *[c.alias(n) for n, c in rp.face_on(F.col("raw")).items()])


_QC = """CASE k % 5 WHEN 0 THEN '{"verdict": "reject", "reason": "noise"}' WHEN 1 THEN '{"verdict": "PASS", "reason": "ok"}' WHEN 2 THEN 'no json' WHEN 3 THEN '{"verdict": "REJECT", }' ELSE '{"verdict": "unsure"}' END"""


@query("parse_qc", oracle(["items"], """SELECT item_id, 'art' AS kind, CASE WHEN k % 5 = 0 THEN 'REJECT' ELSE 'PASS' END AS verdict,
  CASE k % 5 WHEN 0 THEN 'noise' WHEN 1 THEN 'ok' WHEN 2 THEN 'qc_parse_fallback' WHEN 3 THEN 'qc_json_fallback' ELSE '' END AS reason FROM items
  UNION ALL SELECT item_id, 'object', CASE k % 5 WHEN 0 THEN 'REJECT' WHEN 1 THEN 'PASS' WHEN 4 THEN 'UNSURE' ELSE '' END, CASE k % 5 WHEN 0 THEN 'noise' WHEN 1 THEN 'ok' ELSE '' END FROM items"""))
def parse_qc(spark, sf):
    it = items(spark, sf, raw=_QC)
    a = it.select("item_id", F.lit("art").alias("kind"), *[c.alias(n) for n, c in rp.art_qc(F.col("raw")).items()])
    return a.unionByName(it.select("item_id", F.lit("object").alias("kind"), *[c.alias(n) for n, c in rp.object_qc(F.col("raw")).items()]))


_PROMPT = """CASE k % 4 WHEN 0 THEN concat('```text', chr(10), '"', label, ' {soft}|wooden legs {hard}"', chr(10), '```') WHEN 1 THEN concat('''', label, '|base''', chr(10), 'second line')
  WHEN 2 THEN concat(chr(10), '  `', label, ' pillow`  ') ELSE label END"""


@query("clean_prompt", oracle(["items"], """SELECT item_id, CASE k % 4 WHEN 0 THEN concat(label, ' {soft}|wooden legs {hard}') WHEN 1 THEN concat(label, '|base') WHEN 2 THEN concat(trim(label), ' pillow') ELSE trim(label) END AS prompt
  FROM (SELECT item_id, k, CASE WHEN k % 4 = 0 THEN ltrim(label) WHEN k % 4 = 1 THEN ltrim(label) ELSE label END AS label FROM items) AS q"""))
def clean_prompt(spark, sf):
    return items(spark, sf, raw=_PROMPT).select("item_id", lb.cleaned_prompt(F.col("raw")).alias("prompt"))


_TAGS = "concat(label, ' {soft}| wooden ', lower(label), ' legs {HARD} |', CASE WHEN k % 3 = 0 THEN '' ELSE 'picture frame' END, '| {soft} |lamp shade')"
TAG_CTE = f"""tg AS (SELECT item_id, k, label, unnest(string_split({_TAGS}, '|')) AS piece, generate_subscripts(string_split({_TAGS}, '|'), 1) AS n FROM items),
  tr AS (SELECT *, trim(piece) AS term FROM tg WHERE trim(piece) <> ''),
  ts AS (SELECT *, trim(regexp_replace(term, '(?i)\\s*\\{{(soft|hard)\\}}\\s*$', '')) AS text, coalesce(nullif(lower(regexp_extract(term, '(?i)\\s*\\{{(soft|hard)\\}}\\s*$', 1)), ''), 'soft') AS tag FROM tr),
  tn AS (SELECT item_id, k, text, tag, CAST(row_number() OVER (PARTITION BY item_id ORDER BY n) - 1 AS INTEGER) AS pos FROM ts WHERE text <> '')"""


def terms(spark, sf):
    return items(spark, sf, prompt=_TAGS).select("item_id", F.posexplode(lb.tagged_terms(F.col("prompt"))).alias("pos", "t"),
                                                 F.get(lb.tagged_terms(F.col("prompt")), F.lit(0))["text"].alias("parent")).select("item_id", "pos", "t.*", "parent")


@query("tagged_prompts", oracle(["items"], "SELECT item_id, pos, text, tag FROM tn", TAG_CTE))
def tagged_prompts(spark, sf):
    return terms(spark, sf).select("item_id", "pos", "text", "tag")


@query("child_prompts", oracle(["items"], """SELECT item_id, pos, text, CASE WHEN pos = 0 THEN 'parent_body' WHEN contains(lower(text), noun) AND regexp_matches(lower(text), '\\b(legs|leg|base|pedestal|frame|skirt|plinth|caster|casters|spindle|spindles|stretcher|stretchers)\\b')
  THEN 'structural' END AS skipped FROM (SELECT t.*, string_split_regex(lower(p.text), '\\s+')[-1] AS noun FROM tn AS t JOIN tn AS p ON t.item_id = p.item_id AND p.pos = 0) AS q""", TAG_CTE))
def child_prompts(spark, sf):
    t = terms(spark, sf)
    why = F.when(F.col("pos") == 0, "parent_body").when(lb.structural(F.col("text"), F.col("parent")), "structural")
    return t.select("item_id", "pos", "text", why.alias("skipped"))


def _rx(p):
    return p.replace("'", "''")


@query("decide_procedure", oracle(["items"], f"SELECT item_id, {PROC} AS procedure FROM items"))
def decide_procedure(spark, sf):
    return items(spark, sf).select("item_id", lb.procedure(F.col("label")).alias("procedure"))


_ROUTE = "CASE k % 4 WHEN 0 THEN 'Open_Shelving' WHEN 1 THEN ' closed_cabinet ' WHEN 2 THEN 'unsure' END"


@query("route_check", oracle(["items"], f"""SELECT item_id, CASE WHEN regexp_matches(label, '(?i)\\b(cabinet|cupboard|sideboard|console|credenza|hutch|bookshelf|bookcase|shelf|shelves|shelving)\\b')
  THEN CASE WHEN k % 4 = 0 THEN 'bookshelf' WHEN k % 4 = 1 AND procedure = 'bookshelf' THEN 'general' ELSE procedure END ELSE procedure END AS procedure FROM (SELECT *, {PROC} AS procedure FROM items) AS q"""))
def route_check(spark, sf):
    it = items(spark, sf, reply=_ROUTE)
    return it.select("item_id", lb.checked_procedure(F.col("label"), lb.procedure(F.col("label")), F.col("reply")).alias("procedure"))


@query("label_flags", oracle(["items"], f"""SELECT item_id, {like_any(lb.RIGID_SHELVING)} AS rigid_shelving, {like_any(lb.WALL_FLUSH)} AS wall_flush, {like_any(lb.CABINET_RICH)} AS cabinet_rich,
  contains(lower(label), 'floor') AND contains(lower(label), 'lamp') AS floor_lamp, contains(lower(label), 'stool') AS stool FROM items"""))
def label_flags(spark, sf):
    return items(spark, sf).select("item_id", *[c.alias(n) for n, c in lb.flags(F.col("label")).items()])


_PRE = "CASE " + " ".join("WHEN regexp_matches(lower(label), '\\b({})\\b') THEN '{}'".format("|".join(w for w in ws if w.isascii()), n) for n, ws in lb.COMPANION_WORDS) + " ELSE 'generic' END"
_PREI = "CASE preset " + " ".join(f"WHEN '{n}' THEN '{t}'" for n, t in lb.COMPANION_ITEMS.items()) + " END"


@query("companion_preset", oracle(["items"], f"SELECT item_id, preset, {_PREI} AS items FROM (SELECT item_id, {_PRE} AS preset FROM items) AS q"))
def companion_preset(spark, sf):
    it = items(spark, sf).select("item_id", lb.companion_preset(F.col("label")).alias("preset"))
    return it.withColumn("items", lb.companion_items(F.col("preset")))


_INFO = """concat('{"name": "', label, '", "description": "d", "sub_objects": ["legs", "seat ', CAST(k % 3 AS STRING), '"], "style": "plain", "materials": ["wood"], "colors": ["', CASE WHEN k % 2 = 0 THEN 'red' ELSE 'blue' END, '", "grey"]}')"""


@query("info_explode", oracle(["items"], """SELECT item_id, name, kind, value FROM (SELECT item_id, label AS name, 'sub_object' AS kind, unnest(['legs', concat('seat ', CAST(k % 3 AS VARCHAR))]) AS value FROM items
  UNION ALL SELECT item_id, label, 'material', 'wood' FROM items UNION ALL SELECT item_id, label, 'color', unnest([CASE WHEN k % 2 = 0 THEN 'red' ELSE 'blue' END, 'grey']) FROM items) AS q"""))
def info_explode(spark, sf):
    i = items(spark, sf, raw=_INFO).select("item_id", rp.info(F.col("raw")).alias("i"))
    return inv.explode_info(i.select("item_id", "i.*"), ["item_id", "name"])


@query("path_rewrite", oracle(["items"], "SELECT item_id, concat('scene/02_new_', CAST(k AS VARCHAR), '/8_final.ply') AS path FROM items"))
def path_rewrite(spark, sf):
    it = items(spark, sf, path="concat('scene/02_old_', CAST(k AS STRING), '/8_final.ply')", old="concat('02_old_', CAST(k AS STRING))", new="concat('02_new_', CAST(k AS STRING))")
    return it.select("item_id", inv.rewrite_path(F.col("path"), F.col("old"), F.col("new")).alias("path"))


# --- verdict-driven selection ----------------------------------------------

@query("stage_pick", oracle(["stages", "objects"], f"""SELECT scene_id, object_id, CASE WHEN both2 = 2 THEN CASE WHEN pick = 1 THEN '4_sam_tight' ELSE '6_inside_outside' END ELSE stage END AS stage FROM (
  SELECT scene_id, object_id, min_by(stage, CASE stage {' '.join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(k.PICK_ORDER))} END) AS stage, count(DISTINCT stage) FILTER (WHERE stage IN ('4_sam_tight', '6_inside_outside')) AS both2
  FROM stages WHERE stage IN ({', '.join(f"'{s}'" for s in k.PICK_ORDER)}) GROUP BY scene_id, object_id) AS a LEFT JOIN (SELECT scene_id, object_id, object_id % 3 AS pick FROM objects WHERE object_id % 4 <> 3) AS p USING (scene_id, object_id)"""))
def stage_pick(spark, sf):
    replies = table(spark, sf, "objects").where("object_id % 4 <> 3").select(*OBJ, (F.col("object_id") % 3).alias("pick"))
    return sel.stage_pick(table(spark, sf, "stages"), replies, OBJ)


@query("qc_split", oracle(["items"], "SELECT item_id, CASE WHEN k % 5 = 0 THEN 'rejected' ELSE 'passed' END AS side, CASE k % 5 WHEN 0 THEN 'noise' WHEN 1 THEN 'ok' ELSE '' END AS reason FROM items"))
def qc_split(spark, sf):
    it = items(spark, sf, raw=_QC)
    v = it.select("item_id", *[c.alias(n) for n, c in rp.object_qc(F.col("raw")).items()])
    ok, bad = sel.qc_split(it.select("item_id"), v, ["item_id"])
    return ok.select("item_id", F.lit("passed").alias("side"), "reason").unionByName(bad.select("item_id", F.lit("rejected").alias("side"), "reason"))


_PLANS = ", ".join(f"('{p}', {i}, '{s}')" for p, st in sel.PLANS.items() for i, s in enumerate(st))


@query("procedure_plan", oracle(["items"], f"SELECT item_id, procedure, CAST(step AS INTEGER) AS step, stage FROM (SELECT item_id, {PROC} AS procedure FROM items) AS q JOIN (VALUES {_PLANS}) AS p(procedure, step, stage) USING (procedure)"))
def procedure_plan(spark, sf):
    return sel.procedure_plan(items(spark, sf)).select("item_id", "procedure", "step", "stage")
