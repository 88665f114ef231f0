import re

from pyspark.sql import functions as F

from lexmill.operators import merge, rank
from lexmill.schema import ENTRIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"[+:]- Exchange ", plan_of(df)))


def merged(spark):
    rows = [(f"r{k % 7}", f"s{k % 40}", src, kind, "all", k, k, ["nf01"] if k % 3 else None, "okuri-rule|c|r|s", "r", "rule-generated" if k % 2 else "upstream-provided", None) for k in range(200) for src, kind in (("skk-l", "nasi"), ("jmdict", "nasi"), ("jmdict", "ari"))]
    return spark.createDataFrame(rows, ENTRIES)


def test_a_ranking_takes_four_exchanges(spark):
    m = merged(spark)
    ids, costs, clicks = ["skk-l", "jmdict"], m.select("reading", "surface", "cost"), m.select("surface", F.col("rank").alias("clicks"))
    nasi = rank.positions(rank.nasi_order(m, ids, costs, clicks, ["skk-l"]))
    assert exchanges(nasi) <= 4 and "SortAggregate" not in plan_of(nasi) and "SortMergeJoin" not in plan_of(rank.positions(rank.nasi_order(m, ids, costs)))
    assert exchanges(rank.positions(rank.nasi_order(m, ids, costs))) == exchanges(rank.positions(rank.nasi_order(m, ids))) == 1  # without clicks all is by reading
    ari = rank.positions(rank.ari_order(m, ids, {"skk-l": 0, "jmdict": 1}, costs))
    assert exchanges(ari) == 2 and exchanges(rank.positions(rank.ari_order(m, ids, {"skk-l": 0, "jmdict": 1}))) == 1
    assert "Join" not in plan_of(ari)


def test_often_repeated_keys_fold_to_the_same_rows(spark):
    m = merged(spark).withColumn("surface", F.concat(F.lit("s"), (F.col("rank") % 3).cast("string")))
    m = m.withColumn("scope", F.when(F.col("rank") % 5 == 0, "skk").otherwise("all")).withColumn("inf", F.when(F.col("rank") % 4 > 0, F.array(F.lit("a"), (F.col("rank") % 2).cast("string"))))
    one, two = merge.fold(m), merge.fold(m, often=True)
    assert one.count() == 7 * 3 * 3 and one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_columns_of_the_callers_own(spark):
    rows = spark.createDataFrame([("a", "x", True, "t", 1, 2), ("b", "x", False, "u", 3, 4), ("c", "y", True, "v", 5, 6), ("d", "y", True, "w", 7, 8)], "reading string, surface string, said boolean, title string, low int, owner int")
    clicks = spark.createDataFrame([("x", 5), ("x", 2), ("y", 9)], "surface string, clicks long")
    got = {r["reading"]: (r["title_clicks"], r["title"], r["low"], r["owner"]) for r in rank.with_guarded_clicks(rows, clicks).collect()}
    assert got == {"a": (7, "t", 1, 2), "b": (None, "u", 3, 4), "c": (None, "v", 5, 6), "d": (None, "w", 7, 8)}
    named = rows.withColumn("mine", F.lit(1)).withColumn("least", F.lit("l"))
    costs = spark.createDataFrame([("a", "x", 9), ("a", "x", 4), ("z", "z", 1)], "reading string, surface string, cost int")
    out = rank.with_least_cost(named, costs)
    assert out.columns == [*named.columns, "word_cost"] and {r["reading"]: (r["word_cost"], r["mine"], r["least"]) for r in out.collect()} == {"a": (4, 1, "l"), "b": (None, 1, "l"), "c": (None, 1, "l"), "d": (None, 1, "l")}


def test_loanwords_and_rows_that_are_no_candidates(spark):
    kinds = "reading string, surface string, source string, rank long, cost int, pri array<string>, irregular boolean, original_reading string, said boolean, spelling string"
    rows = [
        ("こ", "珈", "jmdict", 1, 7, ["gai1"], True, "コ", True, "p"), ("こ", "コ", "x", 2, 3, None, False, "こ", False, "q"),  # the tags move
        ("か", "可", "jmdict", 3, 7, ["gai1"], False, "カ", True, "p"), ("か", "カ", None, 4, None, None, None, None, True, None),  # no candidate is there
        ("き", "木", "jmdict", 5, 7, ["a"], False, "キ", True, "p"), ("き", "キ", "jmdict", 6, 7, ["b"], False, "キキ", True, "p"),  # another loanword stands for its surface
    ]
    got = {tuple(str(x) for x in r) for r in rank.move_loanword_tags(spark.createDataFrame(rows, kinds), said=F.lit(False)).collect()}
    want = [
        ("こ", "珈", "jmdict", 1, 7, None, True, True, "p"), ("こ", "コ", "jmdict", 1, None, ["gai1"], False, False, "p"), ("こ", "コ", "x", 2, 3, None, False, False, "q"), ("か", "可", "jmdict", 3, 7, ["gai1"], False, True, "p"),
        ("か", "カ", None, 4, None, None, None, True, None), ("き", "木", "jmdict", 5, 7, None, False, True, "p"), ("き", "キ", "jmdict", 5, None, ["a"], False, False, "p"), ("き", "キ", "jmdict", 6, 7, ["b"], False, True, "p"),
    ]
    assert got == {tuple(str(x) for x in r) for r in want}
