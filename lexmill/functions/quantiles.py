"""Exact order statistics without gathering values: histograms that are refined where a wanted rank lies.

Each round counts the values of the intervals that are still open in bins of equal width, by hash aggregates of a bounded size, and
keeps of each wanted rank's bin its least value, its greatest one and how many values lie before. A bin of one value is the answer. An
interval's ends are values that occur, so each round tells at least two of them apart; rounds end, however values are spread or repeated.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 256


def order_statistics(rows: DataFrame, value: str, wanted: dict[object, Sequence[int]], by: str | None = None) -> dict[tuple[object, int], float]:
    """(group, rank from 0) to the value at that rank of its group, of finite values as doubles. wanted: ranks by group; without ``by`` the group is None."""
    group = F.col(by) if by else F.lit(None).cast("string")
    points = rows.select(group.alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    spark, kind = rows.sparkSession, points.schema["g"].dataType.simpleString()
    found: dict[tuple[object, int], float] = {}
    ends = {r["g"]: (r["lo"], r["hi"], r["n"]) for r in points.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect()}  # a row per group
    open_ = []
    for g, ranks in wanted.items():
        lo, hi, n = ends.get(g, (None, None, 0))
        if ranks and not 0 <= min(ranks) <= max(ranks) < n:
            raise ValueError(f"{g} has {n} values")
        if ranks:
            open_.append((g, lo, hi, 0, sorted(set(ranks))))
    while open_:
        for g, lo, _, _, ranks in (x for x in open_ if x[1] == x[2]):
            found |= {(g, r): lo for r in ranks}
        if not (open_ := [x for x in open_ if x[1] != x[2]]):
            break
        intervals = spark.createDataFrame([(k, g, lo, hi) for k, (g, lo, hi, _, _) in enumerate(open_)], f"k int, og {kind}, lo double, hi double")
        inside = points.join(F.broadcast(intervals), F.col("g").eqNullSafe(F.col("og")) & F.col("v").between(F.col("lo"), F.col("hi")))  # as many intervals as wanted ranks at most
        share = F.col("v") / 2 - F.col("lo") / 2  # halves, for the width of all doubles is none itself
        bins = F.when(F.col("v") == F.col("hi"), BINS - 1).otherwise(F.least(F.lit(BINS - 2), F.floor(share / (F.col("hi") / 2 - F.col("lo") / 2) * (BINS - 1)))).cast("int")
        bins = F.when(F.col("v") == F.col("lo"), 0).otherwise(bins)
        counted = inside.groupBy("k", bins.alias("bin")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
        by_interval: dict[int, list] = {}
        for r in sorted(counted.collect(), key=lambda r: (r["k"], r["bin"])):  # at most BINS rows an interval
            by_interval.setdefault(r["k"], []).append(r)
        rest = []
        for k, (g, _, _, before, ranks) in enumerate(open_):
            for r in by_interval[k]:
                if own := [x for x in ranks if before <= x < before + r["n"]]:
                    rest.append((g, r["lo"], r["hi"], before, own))
                before += r["n"]
        open_ = rest
    return found


def quantiles(rows: DataFrame, value: str, shares: Sequence[float], by: str | None = None) -> dict[object, list[float]]:
    """Quantiles of a column, or of each group's, linear between neighbours. Groups without values are left out."""
    group = F.col(by) if by else F.lit(None).cast("string")
    sizes = {r["g"]: r["n"] for r in rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(group.alias("g")).agg(F.count("*").alias("n")).collect()}  # a row per group
    places = {g: [s * (n - 1) for s in shares] for g, n in sizes.items()}
    at = order_statistics(rows, value, {g: [x for p in ps for x in (math.floor(p), math.ceil(p))] for g, ps in places.items()}, by)
    return {g: [(lo := at[g, math.floor(p)]) + (at[g, math.ceil(p)] - lo) * (p - math.floor(p)) for p in ps] for g, ps in places.items()}
