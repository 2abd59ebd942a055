from pyspark.sql import functions as F

from motefield.llm import preferences as pr
from motefield.llm.queries import QUERIES


def show(role, text):
    return f"<|{role or ''}|>\n{text or ''}<|end|>\n"


def brute(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    out = [n, "".join(show(*t) for t in a[:n])]
    for rest in (a[n:], b[n:]):
        spans, at = [], 0
        for role, text in rest:
            begin = at + len(f"<|{role or ''}|>\n")
            at += len(show(role, text))
            if role == "assistant":
                spans.append((begin, at))
        out += ["".join(show(*t) for t in rest), spans]
    return tuple(out)


def test_pairs_match_a_plain_rendering(spark):
    u, a = lambda t: ("user", t), lambda t: ("assistant", t)
    pairs = [([u("q"), a("x"), u("r"), a("y")], [u("q"), a("x"), u("r"), a("zé漢")]), ([u("q")], [u("q")]), ([], []), ([u("q"), a("x")], [u("q")]),
             ([("system", None), u("q"), a("")], [("system", None), u("p"), a("x"), a("y")]), ([(None, "t"), a(None)], [(None, "t"), a("")]), ([a("long " * 30000)], [a("b")])]
    df = spark.createDataFrame([(i, c, r, "kept") for i, (c, r) in enumerate(pairs)] + [(99, None, [("user", "q")], "kept")],
                               "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    got = {r.id: (r.prompt_turns, r.prompt, r.chosen_text, [tuple(s) for s in r.chosen_spans], r.rejected_text, [tuple(s) for s in r.rejected_spans])
           for r in pr.format_pairs(df).collect()}
    assert got == {i: brute(c, r) for i, (c, r) in enumerate(pairs)} | {99: brute([], pairs[1][0])}


def test_pairs_from_turns(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "x"), (0, 2, "user", "r"), (1, 1, "assistant", "b"), (1, 0, "system", None), (1, 1, "assistant", "b"), (1, None, "user", "first"),
            (2, 0, "user", "no reply"), (4, 0, "user", "q"), (4, 1, "assistant", "alone"), (None, 0, "user", "lost"), (6, 0, "assistant", "same"), (7, 0, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("chosen", F.lit(1))
    got = {r.conv_id: ([tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected]) for r in pr.swapped_replies(df).collect()}
    assert got == {0: ([("user", "q"), ("assistant", "x")], [("user", "q"), ("assistant", "b")]),
                   1: ([("user", "first"), ("system", None), ("assistant", "b")], [("user", "first"), ("system", None), ("assistant", "x")]),
                   2: ([("user", "no reply")],) * 2, 4: ([("user", "q"), ("assistant", "alone")], [("user", "q")]),
                   6: ([("assistant", "same")],) * 2, 7: ([("assistant", "same")],) * 2}
    assert pr.format_pairs(pr.swapped_replies(df.limit(0))).count() == 0


def test_main_path_runs_no_python(spark):
    plan = QUERIES["op7_preference_pairs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
