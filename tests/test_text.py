import pytest
from pyspark.sql import functions as F

from motefield.functions import labels as lb
from motefield.functions import replies as rp


def one(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_canonical_labels(spark):
    got = one(spark, lb.canonical, "Silver Range Hood", "kitchen range", "étagère", "tall tv stand", "orange lamp", "  Tall  House Plant ", None, "flat-screen tv", "ladder shelf unit")
    assert got == ["silver range hood", "kitchen stove", "bookshelf", "tall tv", "orange lamp", "tall potted plant", "", "tv", "bookshelf"]


def test_singular(spark):
    assert one(spark, lb.is_singular, "silver range hood", "stove", "black kitchen stove", "bookshelf", "") == [True, True, True, False, False]


@pytest.mark.parametrize("label,route", [("black flat screen TV", "tv"), ("wooden tv stand", "general"), ("floor-standing lamp", "lamp"), ("desk lamp", "table"),
                                         ("étagère", "bookshelf"), ("wall shelf", "bookshelf"), ("area rug", "rug"), ("console table", "general"), ("torchiere", "lamp"),
                                         ("nightstand table", "general"), ("", "general"), (None, "general")])
def test_routes(spark, label, route):
    assert one(spark, lb.procedure, label) == [route]


def test_slugs(spark):
    assert one(spark, lb.slug, "Grey  Sofa!", "  !! ", "_a_") == ["grey_sofa", "item", "a"]
    assert one(spark, lambda c: lb.slug(c, "object", 10), "abcdefghi jkl", "--") == ["abcdefghi", "object"]


def test_prompts(spark):
    got = one(spark, lb.tagged_terms, "beige armchair {soft}|wooden legs {HARD}| |lamp| {hard}")[0]
    assert [tuple(x) for x in got] == [("beige armchair", "soft"), ("wooden legs", "hard"), ("lamp", "soft")]
    assert one(spark, lb.cleaned_prompt, '```\n"a|b"\n```', "\n\n 'x y' \nz", '""') == ["a|b", "x y", ""]


def test_items_three_ways(spark):
    good = '```json\n{"items": [{"bbox_2d": [1, 2, 3, 4], "label": "tv", "confidence": "high"}]}\n```'
    cut = '{"items": [{"bbox_2d": [1, 2, 3, 4], "label": "tv"}, {"bbox": [5,6,7,8], "label": "rug"}'
    turned = '{"items": [{"label": "tv", "bbox_2d": [1, 2, 3, 4]}'
    got = one(spark, rp.items, good, cut, turned, "nothing", '{"other": 1}')
    assert [tuple(map(lambda v: tuple(v) if isinstance(v, list) else v, i)) for i in got[0]] == [((1, 2, 3, 4), "tv", "high")]
    assert [(i.bbox_2d, i.label) for i in got[1]] == [([1, 2, 3, 4], "tv"), ([5, 6, 7, 8], "rug")]
    assert [(i.bbox_2d, i.label, i.confidence) for i in got[2]] == [([1, 2, 3, 4], "tv", "unknown")]
    assert got[3] == [] and got[4] == []


def test_picks(spark):
    assert one(spark, lambda c: rp.pick(c, 3, F.lit(2)), "9, then 3.", "4 5", "candidate2", "1") == [3, 2, 2, 1]
    assert one(spark, lambda c: rp.winner(c, list("ABC")), "winner=c", "none", "WINNER=B WINNER=A") == ["C", "B", "A"]
    assert one(spark, rp.yes_no, "YES.", "no, yes", "It is up against a wall, yes", "yesterday") == [True, False, True, False]


def test_last_json(spark):
    assert one(spark, rp.last_json, '```json\n{"a": 1}\n```', 'x {"a": 2} y', "{bad", "[1, 2]") == ['{"a": 1}', '{"a": 2}', None, "[1, 2]"]


def test_art_quality_defaults_to_pass(spark):
    for text, verdict in [("junk", "PASS"), ('{"verdict": "reject"}', "REJECT"), ('{"verdict": "meh"}', "PASS"), ('{"verdict": }', "PASS")]:
        assert one(spark, lambda c: rp.art_qc(c)["verdict"], text) == [verdict]
