from lexmill.operators import merge


def test_alike_rows_are_checked_once(spark):
    rows = spark.createDataFrame([("a", "ab", "x")] * 50 + [("a", "*", "x"), ("a", "b・c", "y"), ("a", "b", ""), ("b", None, None)] * 2, "source string, reading string, surface string")
    out = merge.reject_counts(rows)
    assert {(r["source"], r["metric"]): r["n"] for r in out.collect()} == {
        ("a", "parsed_pairs"): 56, ("a", "unsupported_reading"): 2, ("a", "invalid_surface"): 2, ("a", "separator_joined_pairs"): 2, ("b", "parsed_pairs"): 2, ("b", "unsupported_reading"): 2,
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Aggregate [source") > plan.index("ArrowEvalPython")  # below Python, in a plan that is read from its end
