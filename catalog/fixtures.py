"""Input tables for the registered queries, as SQL text both engines accept.

The texts follow FIXTURES.md.  ``table`` runs a text in Spark, ``oracle`` puts
the same texts in front of a check statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_VIEW_ANGLES = [(0, 10, 0), (1, 8, 6), (2, 0, 10), (3, -6, 8),
                (4, -10, 0), (5, -8, -6), (6, 0, -10), (7, 6, -8)]
_SCENE_VIEWS = ", ".join(f"({s}, {v}, {c}, {d})" for s in range(4) for v, c, d in _VIEW_ANGLES)

_LABELS = ["beige armchair", "Silver Range Hood", "black flat screen TV", "wooden tv stand",
           "tall shelving", "round coffee table", "white fridge", "floor-standing lamp",
           "grey area rug", "wooden cabinet", "green house plant", "desk lamp",
           "console table", "kitchen range", "open shelving unit"]


def _label_case(col: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_LABELS))
    return f"CASE {col} {whens} ELSE '  !!  ' END"


TEXTS: dict[str, tuple[list[str], str]] = {}

TEXTS["splats"] = (["lineitem"], """
WITH b AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, CAST(l_linenumber AS BIGINT) AS ln,
         l_partkey % 4 AS scene_id,
         CAST(floor(l_partkey / 4) AS BIGINT) % 12 AS object_id,
         (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000003 AS h1,
         (l_orderkey * 15485 + l_suppkey * 6700417 + l_linenumber * 97) % 1000003 AS h2,
         (l_partkey * 86028121 + l_orderkey * 433 + l_suppkey * 17) % 1000003 AS h3
  FROM lineitem)
SELECT ok, pk, sk, ln, scene_id, object_id,
  CAST(((object_id * 2617) % 7000) - 3500 + (h1 % 500) - (h2 % 250) AS DOUBLE) / 1000 AS x,
  CAST(1200 - CAST(floor((h3 % 700) * ((object_id % 4) + 1) / 2) AS BIGINT) AS DOUBLE) / 1000 AS y,
  CAST(((object_id * 1733) % 5000) - 2500 + (h2 % 500) - (h3 % 250) AS DOUBLE) / 1000 AS z,
  CAST(-((h1 % 4500) + 500) AS DOUBLE) / 1000 AS scale_0,
  CAST(-((h2 % 4500) + 500) AS DOUBLE) / 1000 AS scale_1,
  CAST(-((h3 % 4500) + 500) AS DOUBLE) / 1000 AS scale_2,
  CAST((h1 % 3600) - 1800 AS DOUBLE) / 1000 AS f_dc_0,
  CAST((h2 % 3600) - 1800 AS DOUBLE) / 1000 AS f_dc_1,
  CAST((h3 % 3600) - 1800 AS DOUBLE) / 1000 AS f_dc_2,
  CAST((h1 % 1201) - 600 AS DOUBLE) / 100 AS opacity,
  CAST((h1 % 199) - 99 AS DOUBLE) / 100 AS rot_0,
  CAST((h2 % 199) - 99 AS DOUBLE) / 100 AS rot_1,
  CAST((h3 % 199) - 99 AS DOUBLE) / 100 AS rot_2,
  CAST(((h1 + h2) % 199) - 99 AS DOUBLE) / 100 AS rot_3
FROM b""")

# eight orbit cameras per scene around (0, 0.6, 0) at distance 8, image 192 x 108
TEXTS["views"] = ([], f"""
SELECT CAST(scene_id AS BIGINT) AS scene_id, view_id,
       -c AS r00, 0 * c AS r01, s AS r02, 0 * c AS t0,
       0 * c AS r10, 1 + 0 * c AS r11, 0 * c AS r12, -CAST(6 AS DOUBLE) / 10 + 0 * c AS t1,
       s AS r20, 0 * c AS r21, c AS r22, -CAST(8 AS DOUBLE) + 0 * c AS t2,
       CAST(617 AS DOUBLE) / 8 AS f, 192 AS w, 108 AS h,
       8 * s AS eye_x, CAST(6 AS DOUBLE) / 10 + 0 * c AS eye_y, 8 * c AS eye_z,
       0 * c AS tgt_x, CAST(6 AS DOUBLE) / 10 + 0 * c AS tgt_y, 0 * c AS tgt_z
FROM (SELECT scene_id, view_id, CAST(ci AS DOUBLE) / 10 AS c, CAST(si AS DOUBLE) / 10 AS s
      FROM (VALUES {_SCENE_VIEWS}) AS q(scene_id, view_id, ci, si)) AS v""")

TEXTS["mask_runs"] = (["orders"], """
SELECT o_custkey % 4 AS scene_id, CAST(o_orderkey % 8 AS INT) AS view_id,
       CAST((o_orderkey * 37 + o_custkey) % 108 AS INT) AS y,
       CAST((o_custkey * 13 + o_orderkey) % 150 AS INT) AS x0,
       CAST(least(191, (o_custkey * 13 + o_orderkey) % 150 + o_orderkey % 40) AS INT) AS x1,
       CAST(o_orderkey % 3 AS INT) AS prompt_id, CAST(o_custkey % 3 AS INT) AS pass_id
FROM orders""")

# an item per block of 25 parts; k and k + 4 are near-duplicates in the same scene
TEXTS["items"] = (["part"], f"""
WITH a AS (SELECT min(p_partkey) AS item_id, CAST(floor(p_partkey / 25) AS BIGINT) AS k
           FROM part GROUP BY CAST(floor(p_partkey / 25) AS BIGINT)),
b AS (SELECT item_id, k, k % 4 AS scene_id, CAST(floor(k / 8) AS BIGINT) % 16 AS li,
             k - CASE WHEN k % 8 >= 4 THEN 4 ELSE 0 END AS m FROM a)
SELECT item_id, k, scene_id,
  (m * 73) % 700 + k % 3 AS bx0, (m * 191) % 700 AS by0,
  (m * 73) % 700 + k % 3 + 20 + (m * 17) % 250 AS bx1,
  (m * 191) % 700 + 20 + (m * 29) % 250 + (k % 5) * 8 AS by1,
  CASE k % 4 WHEN 0 THEN 'NE' WHEN 1 THEN 'NW' WHEN 2 THEN 'SE' ELSE 'SW' END AS quadrant,
  {_label_case('li')} AS label
FROM b""")

# masks of each item: the extents of the scene's runs near its box, without one view in eight; boxes of each item in two views of three
TEXTS["mask_spans"] = (["mask_runs"], """
SELECT scene_id, view_id, y, prompt_id, min(x0) AS x0, max(x1) AS x1 FROM mask_runs GROUP BY scene_id, view_id, y, prompt_id""")
TEXTS["item_masks"] = (["items", "mask_spans"], """
SELECT i.item_id, m.scene_id, m.view_id, m.y, CAST(greatest(m.x0, i.lx) AS INT) AS x0, CAST(least(m.x1, i.hx) AS INT) AS x1, m.prompt_id
FROM mask_spans AS m INNER JOIN (SELECT item_id, k, scene_id, CAST(floor(bx0 * 192 / 1000) AS INT) - 70 AS lx, CAST(floor(by0 * 108 / 1000) AS INT) - 45 AS ly,
    least(191, CAST(floor(bx1 * 192 / 1000) AS INT) + 70) AS hx, CAST(floor(by1 * 108 / 1000) AS INT) + 45 AS hy FROM items) AS i
  ON m.scene_id = i.scene_id AND (m.view_id + i.k) % 8 <> 0 AND m.y >= i.ly AND m.y <= i.hy AND m.x0 <= i.hx AND m.x1 >= i.lx""")
TEXTS["item_views"] = (["items"], """
SELECT i.item_id, i.k, i.scene_id, CAST(v.view_id AS INT) AS view_id FROM items AS i
INNER JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS v(view_id) ON (v.view_id + i.k) % 3 <> 0""")

TEXTS["replies"] = (["items"], """
SELECT item_id, scene_id, CASE item_id % 4
  WHEN 0 THEN concat('```json', chr(10), j, chr(10), '```')
  WHEN 1 THEN j
  WHEN 2 THEN substr(j, 1, length(j) - 2)
  ELSE concat('Sure, here it is: ', j, ' Done.') END AS raw
FROM (SELECT item_id, scene_id, concat('{"items": [{"bbox_2d": [', CAST(bx0 AS STRING), ', ',
        CAST(by0 AS STRING), ', ', CAST(bx1 AS STRING), ', ', CAST(by1 AS STRING),
        '], "label": "', label, '", "confidence": "high"}]}') AS j FROM items) AS r""")

TEXTS["planes"] = ([], """
SELECT CAST(scene_id AS BIGINT) AS scene_id, CAST(pa AS DOUBLE) / 100 AS a, CAST(pb AS DOUBLE) / 100 AS b,
       CAST(pc AS DOUBLE) / 100 AS c, CAST(pd AS DOUBLE) / 100 AS d
FROM (VALUES (0, 0, 100, 0, -115), (1, 2, 100, 1, -110), (2, -3, 98, 0, -112), (3, 0, 100, -4, -108))
  AS q(scene_id, pa, pb, pc, pd)""")

# one row per object, with a label
TEXTS["objects"] = (["splats"], f"""
SELECT scene_id, object_id, count(*) AS n_splats,
       {_label_case('((object_id + scene_id * 4) % 15)')} AS label
FROM splats GROUP BY scene_id, object_id""")

# which stages exist for which object
_STAGE_ROWS = ", ".join(f"({i}, '{s}')" for i, s in enumerate([
    "9_subtracted", "8_final", "7_final", "6_inside_outside", "5_subtracted", "5_bookshelf_sweep",
    "4_rug", "5_sweep_fallback", "4_sam_tight", "3_floor_drop", "2_pitch_sweep_refined",
    "2_sam_wide", "1_visual_hull"], start=1))
TEXTS["stage_names"] = ([], f"SELECT rank, stage FROM (VALUES {_STAGE_ROWS}) AS r(rank, stage)")
TEXTS["stages"] = (["objects", "stage_names"], """
SELECT o.scene_id, o.object_id, r.rank, r.stage
FROM objects AS o INNER JOIN stage_names AS r
  ON (o.object_id * 7 + r.rank * 5 + o.scene_id) % 3 = 0""")

# splats of the stages of an object: a stage of rank r keeps a deterministic part of the object
TEXTS["stage_splats"] = (["splats", "stages"], """
SELECT s.ok, s.pk, s.sk, s.ln, s.scene_id, s.object_id, t.stage, t.rank, s.x, s.y, s.z
FROM splats AS s INNER JOIN stages AS t ON s.scene_id = t.scene_id AND s.object_id = t.object_id
WHERE (s.ok + s.ln) % (16 - t.rank) < 2""")


def _order(names: list[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done or name in BASE:
            return
        for dep in TEXTS[name][0]:
            visit(dep)
        done.append(name)

    for n in names:
        visit(n)
    return done


def _ctes(names: list[str]) -> list[str]:
    return [f"{n} AS ({TEXTS[n][1]})" for n in _order(names)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture or driver table as a DataFrame, read from ``sf_dir``."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    used = _order([name])
    base = sorted({d for n in used for d in TEXTS[n][0] if d in BASE})
    files = [f"{b} AS (SELECT * FROM parquet.`{sf_dir}/{b}.parquet`)" for b in base]
    return spark.sql(f"WITH {', '.join(files + _ctes([name]))} SELECT * FROM {name}")


def oracle(uses: list[str], select: str, ctes: str = "") -> str:
    parts = _ctes(uses) + ([ctes] if ctes else [])
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def pct(name: str, source: str, keys: str, want: list[tuple[str, str, float]]) -> str:
    """CTE ``name``: rank-based percentiles of ``source`` per ``keys``."""
    exprs = sorted({e for _, e, _ in want})
    ctes, out = [], []
    for i, e in enumerate(exprs):
        ctes.append(
            f"{name}_r{i} AS (SELECT {keys}, v, row_number() OVER (PARTITION BY {keys} ORDER BY v) - 1 AS r, "
            f"count(*) OVER (PARTITION BY {keys}) AS n FROM (SELECT {keys}, {e} AS v FROM {source}) AS q WHERE v IS NOT NULL)")
        cols = []
        for o, ee, p in want:
            if ee != e:
                continue
            pos = f"(CAST({p / 100.0!r} AS DOUBLE) * (n - 1))"
            lo = f"max(CASE WHEN r = floor({pos}) THEN v END)"
            hi = f"max(CASE WHEN r = least(floor({pos}) + 1, n - 1) THEN v END)"
            cols.append(f"{lo} + ({hi} - {lo}) * max({pos} - floor({pos})) AS {o}")
        ctes.append(f"{name}_a{i} AS (SELECT {keys}, {', '.join(cols)} FROM {name}_r{i} GROUP BY {keys})")
        out += [o for o, ee, _ in want if ee == e]
    joins = f"{name}_a0" + "".join(f" JOIN {name}_a{i} USING ({keys})" for i in range(1, len(exprs)))
    ctes.append(f"{name} AS (SELECT {keys}, {', '.join(out)} FROM {joins})")
    return ", ".join(ctes)


def mean(v: str) -> str:
    """Order-independent mean: integer sums of the whole and of two 20-bit parts."""
    rest = f"(({v} - floor({v})) * 1048576e0)"
    low = f"(({rest} - floor({rest})) * 1048576e0)"
    whole, first, second = [f"CAST(sum(CAST(floor({x}) AS BIGINT)) AS DOUBLE)" for x in (v, rest, low)]
    return f"(({whole} + ({first} + {second} / 1048576e0) / 1048576e0) / count(*))"


def hash_cte(name, source, ids, seed, add="h"):
    """``source`` with the arithmetic hash of its ids as a column."""
    ctes, last = [], f"{name}_0"
    ctes.append(f"{last} AS (SELECT *, CAST({seed} AS BIGINT) AS {add} FROM {source})")
    for n, i in enumerate([*ids, "1", "1"], 1):
        ctes.append(f"{name}_{n} AS (SELECT * REPLACE (({add} * {add} + {add}) % 2147483647 AS {add}) FROM (SELECT * REPLACE (({add} * 48271 + {i}) % 2147483647 AS {add}) FROM {last}) AS q)")
        last = f"{name}_{n}"
    return ", ".join([*ctes, f"{name} AS (SELECT * FROM {last})"])
