"""Pseudo-costs: signals of different scales on one scale, lower first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_kana

# Calibrated constants that results have to agree with.
NF_COST = (6517, 7212, 7360, 7401, 7404, 7404, 7488, 7488)
FIRST_COST, SECOND_COST = 7736, 7906
KATAKANA_SHIFT = 5642
MOZC_KNOTS = (
    (2708, 5090), (3294, 5848), (4052, 6517), (4628, 6569), (4991, 7288), (5274, 7401), (5514, 7404), (5908, 7725), (6082, 7864), (6417, 8302),
    (6585, 8995), (6759, 9219), (6945, 9428), (7139, 9770), (7370, 9813), (7614, 10376), (7928, 10617), (9104, 11137), (10545, 11676), (10824, 11862),
)
CLICK_KNOTS = (
    (10, 11258), (11, 11149), (15, 10903), (24, 10680), (36, 10549), (52, 10421), (71, 10178), (94, 9882), (122, 9796), (156, 9772), (197, 9578), (245, 9384),
    (308, 9236), (387, 9046), (490, 8459), (622, 8101), (806, 7832), (1067, 7624), (1483, 7404), (2239, 7332), (4100, 6559), (8155, 6337), (13357, 5895),
)
KANA_FLOOR = 1000
ABSENT_SHIFT = 3000
DEFAULT_COST = {
    "jmdict": 12000, "skk-hukugougo": 12000, "skk-law": 12000, "skk-jis2004": 12000, "sudachi-small": 13000, "sudachi-core": 13000, "sudachi-notcore": 13000,
    "skk-jinmei": 14000, "skk-geo": 14000, "skk-station": 14000, "skk-propernoun": 14000, "jmnedict": 15000, "jawiki": 16000, "jmed": 17000,
}
IRREGULAR_COST, OTHER_COST, TRANSLITERATION_COST, ASCII_COST = 17500, 18000, 19000, 20000


def interpolate(x: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Piecewise linear over knots of ascending x, clamped outside, halves rounded to even. Null stays null."""
    x = x.cast("double")
    out = F.when(x <= knots[0][0], F.lit(float(knots[0][1])))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out = out.when(x <= x1, F.bround(F.lit(float(y0)) + (y1 - y0) * (x - x0) / float(x1 - x0)))
    return out.when(x.isNotNull(), F.lit(float(knots[-1][1]))).cast("int")


def mozc_cost(cost: Column) -> Column:
    return interpolate(cost, MOZC_KNOTS)


def click_cost(clicks: Column) -> Column:
    return interpolate(clicks, CLICK_KNOTS)


def pri_cost(tags: Column) -> Column:
    """Cost of priority tags (an array): the best band nfNN, else whether any tag ends in 1. Null for null or no tags."""
    bands = F.transform(F.filter(tags, lambda t: t.rlike(r"\Anf[0-9]+\z")), lambda t: F.substring(t, 3, 9).cast("int"))
    band = F.least(F.floor(F.greatest(F.array_min(bands) - 1, F.lit(0)) / 6), F.lit(len(NF_COST) - 1)).cast("int")
    banded = F.when(F.size(bands) > 0, F.get(F.array(*map(F.lit, NF_COST)), band))
    return F.when(F.size(tags) > 0, F.coalesce(banded, F.when(F.exists(tags, lambda t: t.endswith("1")), FIRST_COST).otherwise(SECOND_COST)))


def is_plausible(surface: Column, cost: Column) -> Column:
    """A word cost that says something: very low ones of kana-only surfaces don't."""
    return F.coalesce((cost >= KANA_FLOOR) | (cost.isNotNull() & ~is_kana(surface)), F.lit(False))


def default_cost(source: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in DEFAULT_COST.items() for x in kv))
    return F.coalesce(F.try_element_at(table, source), F.lit(OTHER_COST))
