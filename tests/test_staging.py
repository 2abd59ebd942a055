import math

from pyspark.sql import functions as F

from motefield.staging import attach


def test_both_ways_keep_every_row(spark, side):
    rows = [(i, g, x) for i, (g, x) in enumerate([(0, 1.0)] * 30 + [(0, None), (None, 1.0), (None, None), (1, float("nan")), (1, float("nan")), (7, 7.0)])]
    df = spark.createDataFrame(rows, "id int, g int, x double")
    stats = df.where("g is null or g <> 7").groupBy("g", "x").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = {r.id: (r.n, r.top) for r in attach(df, stats, ["g", "x"], "n").collect()}
    same = lambda a, b: a == b or isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)
    want = {i: (len(m := [j for j, h, y in rows if h == g and same(x, y)]), max(m)) for i, g, x in rows if g != 7}
    assert got == want | {rows[-1][0]: (None, None)}
