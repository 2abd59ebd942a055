from motefield.operators import inventory as inv

COLS = "scene_id int, id int, x double, shade double"


def check(spark, merged, objects=((1, 3, 2.0), (1, 3, 2.0), (2, 4, 1.0))):
    back = spark.createDataFrame([(1, 1, 0.5, 0.1), (1, 2, None, 0.2), (2, 5, 1.0, None)], COLS)
    objs = spark.createDataFrame(list(objects), "scene_id int, id int, x double")
    whole = inv.merge_scene(back, objs) if merged is None else spark.createDataFrame(merged, COLS)
    return {r.scene_id: r for r in inv.reassembly_check(back, objs, whole, ["scene_id"]).collect()}


WHOLE = [(1, 3, 2.0, 0.0), (1, 2, None, 0.2), (1, 3, 2.0, 0.0), (1, 1, 0.5, 0.1), (2, 4, 1.0, 0.0), (2, 5, 1.0, 0.0)]


def test_parts_make_the_whole_in_any_order(spark):
    for got in (check(spark, None), check(spark, WHOLE)):
        assert {s: (r.merged_total, r.background_splats, r.object_total_splats, r.delta, r.same_rows) for s, r in got.items()} == {
            1: (4, 2, 2, 0, True), 2: (2, 1, 1, 0, True)}


def test_an_exchanged_row_shows_though_counts_agree(spark):
    for i, row in ((0, (1, 1, 0.5, 0.1)), (1, (1, 2, 0.2, None)), (3, (1, 1, 0.5000001, 0.1))):
        got = check(spark, WHOLE[:i] + [row] + WHOLE[i + 1:])
        assert got[1].delta == 0 and not got[1].same_rows and got[2].same_rows


def test_lost_rows_and_lost_scenes(spark):
    got = check(spark, WHOLE[:3])
    assert (got[1].delta, got[1].same_rows) == (-1, False)
    assert (got[2].merged_total, got[2].delta, got[2].same_rows) == (0, -2, False)
    assert check(spark, [(1, 1, 0.5, 0.1), (1, 2, None, 0.2), (2, 5, 1.0, 0.0)], [(3, 1, 1.0)])[3].merged_total == 0
