"""The order of a key's candidates, from signals of many sources on one cost scale.

Rows of all sources and word costs are brought together once, by reading. There, tags move to the loanwords that they belong to, and all is summed up to one
row per (reading, surface): what the order needs is a least, a flag or a count, so that sums are of numbers only. Clicks are by title, so they take one exchange by
surface; the order is a tuple of columns, and one window by reading ranks it. Aggregates and windows by more columns than those that rows are dealt by need no exchange of
their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import costs as C
from ..functions import okuri, text
from ..schema import ALL, ARI, GENERATED, NASI, SKK_ONLY
from ..sources.catalog import IRREGULAR_TAGS

FIRST_SOURCE, TAGGED_SOURCE, MEASURED_SOURCE = "skk-l", "jmdict", "sudachi-small"
ORDER = ["tier", "order_cost", "minus_families", "tie_clicks", "tie_source", "tie_rank", "surface"]


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has such columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def exclusive_owner(signals: DataFrame, title: str = "surface", owner: str = "reading") -> DataFrame:
    """title, n_owners, owner: the only owner of a title, null if there are several."""
    n = F.countDistinct(owner)
    return signals.groupBy(F.col(title).alias("title")).agg(n.alias("n_owners"), F.when(n == 1, F.min(owner)).alias("owner"))


def move_loanword_tags(rows: DataFrame, **others: Column) -> DataFrame:
    """A tagged katakana reading marks a loanword: where that spelling is a candidate of the key, the tags belong to it.

    Each row of (reading, surface, source, rank, cost, pri, irregular, original_reading, and more) stays; one that loses its tags is followed by a row of the spelling that
    gets them, with ``others`` in other columns. A loanword's row looks for its spelling while a copy of it stands for its surface, so that no join is needed. Rows without a source are no candidates.
    """
    spelling, there, role, row = free(rows, "spelling", "there", "role", "row")
    tagged = (F.col("source") == TAGGED_SOURCE) & F.col("pri").isNotNull() & (F.col("original_reading") != F.col("surface"))
    loan = F.coalesce(tagged & text.is_katakana(F.col("original_reading")), F.lit(False))
    roles = rows.withColumn(role, F.explode(F.when(loan, F.array(F.lit("seeks"), F.lit("stands"))).otherwise(F.array(F.when(F.col("source").isNull(), "passes").otherwise("stands")))))
    seeks = F.col(role) == "seeks"
    roles = roles.withColumn(spelling, F.when(seeks, F.col("original_reading")).otherwise(F.col("surface")))
    found = roles.withColumn(there, F.bool_or(F.col(role) == "stands").over(Window.partitionBy("reading", spelling))).where(seeks | ~loan)
    moved = seeks & F.col(there)
    kept = {"pri": F.when(~moved, F.col("pri"))}
    given = {"surface": F.col(spelling), "cost": F.lit(None), "irregular": F.lit(False)} | others
    struct = lambda of: F.struct(*(of.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in ("reading", "original_reading")))
    both = F.when(moved, F.array(struct(kept), struct(given))).otherwise(F.array(struct(kept)))
    # The reading stays outside, so that rows dealt by it still are.
    return found.select("reading", F.explode(both).alias(row)).select(*("reading" if c == "reading" else f"{row}.`{c}`" for c in rows.columns if c != "original_reading"))


def evidence(rows: DataFrame, ids: list[str], ordered_sources: list[str] = (), also: tuple[Column, ...] = ()) -> DataFrame:
    """One row per (reading, surface) of rows (reading, surface, source, rank, cost, pri, irregular[, word_cost][, said]), of numbers and flags only.

    fallback_source: of the sources that have the pair, that with the least default cost, then the least id; fallback_rank: its least rank, if it is one of
    ``ordered_sources``. A row whose source is null adds its word cost, and whether it ``said`` something, but no candidate: ``n`` counts the others. also: further aggregates.
    """
    tagged = F.col("source") == TAGGED_SOURCE
    order = sorted(set(ids), key=lambda s: (C.DEFAULT_COST.get(s, C.OTHER_COST), s.encode())) or [""]
    of = lambda values: F.try_element_at(F.create_map(*(F.lit(x) for kv in zip(order, values) for x in kv)), F.col("source"))
    families = sorted({s.partition("-")[0] for s in order})
    # A bit for each family, in as many longs as they need.
    masks = [[1 << (k % 63) if k // 63 == part else 0 for k in (families.index(s.partition("-")[0]) for s in order)] for part in range(-(-len(families) // 63))]
    ranks = {f"rank{order.index(s)}": s for s in order if s in ordered_sources}
    extra = [c for c in ("word_cost", "said") if c in rows.columns]
    seen = rows.groupBy("reading", "surface").agg(
        F.count("source").alias("n"), F.min(F.when(F.col("source") == FIRST_SOURCE, F.col("rank"))).alias("first_rank"), F.min(F.when(tagged, C.pri_cost(F.col("pri")))).alias("tag_cost"),
        F.min(F.when((F.col("source") == MEASURED_SOURCE) & (F.col("cost") != 0), F.col("cost"))).alias("measured_cost"), F.coalesce(F.bool_or(tagged), F.lit(False)).alias("is_tagged"),
        F.coalesce(F.bool_and(F.when(tagged, F.col("irregular"))), F.lit(False)).alias("irregular"), F.min(of(range(len(order)))).alias("fallback"),
        *(F.bit_or(of(m).cast("long")).alias(f"families{k}") for k, m in enumerate(masks)), *(F.min(F.when(F.col("source") == s, F.col("rank"))).alias(c) for c, s in ranks.items()),
        *(F.min(c).alias(c) if c == "word_cost" else F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in extra), *also,
    )
    at = lambda values: F.get(F.array(*map(F.lit, values)), F.col("fallback"))
    n_families = sum((F.bit_count(F.coalesce(f"families{k}", F.lit(0).cast("long"))) for k in range(len(masks))), F.lit(0))
    rank = F.coalesce(*(F.when(F.col("fallback") == order.index(s), F.col(c)) for c, s in ranks.items()), F.lit(None).cast("long"))
    return seen.withColumns({"families": n_families, "fallback_cost": at([C.DEFAULT_COST.get(s, C.OTHER_COST) for s in order]), "fallback_source": at(order), "fallback_rank": rank}).drop("fallback", *ranks, *(f"families{k}" for k in range(len(masks))))


def with_order(seen: DataFrame, mozc: Column, absent_shift: Column, clicks: Column, ordered_sources: list[str]) -> DataFrame:
    """``seen`` of ``evidence`` with signal (null without one) and ORDER's columns.

    mozc: word cost or null. absent_shift: whether a word that lacks one is taken to be rarer. clicks: of the title, or null.
    """
    s, key = F.col("surface"), F.col("reading")
    plausible = C.is_plausible(s, mozc)
    shift = F.when(F.col("tag_cost").isNull() & text.is_katakana(s), C.KATAKANA_SHIFT).otherwise(0)
    absent = F.when(absent_shift, C.ABSENT_SHIFT).otherwise(0)
    signal = F.when(plausible, C.mozc_cost(mozc)).otherwise(F.least("tag_cost", F.col("measured_cost") + shift) + absent)
    out = seen.withColumn("signal", signal).withColumn("_clicks", F.coalesce(F.when(clicks > 0, clicks), F.lit(0)).cast("long"))
    weak = F.col("signal").isNull()
    clicked = F.when(F.col("_clicks") > 0, C.click_cost(F.col("_clicks")) + absent)
    cost = F.when(weak, F.least(F.col("fallback_cost"), clicked)).otherwise(F.col("signal"))
    cost = F.when(F.col("irregular"), F.greatest(cost, F.lit(C.IRREGULAR_COST))).otherwise(cost)
    transliterated = text.is_katakana(s) & (text.katakana_key(s) == key) & ~F.col("is_tagged") & ~plausible
    cost = F.when(text.is_ascii(s) & ~text.is_ascii(key), F.greatest(cost, F.lit(C.ASCII_COST))).when(transliterated, F.greatest(cost, F.lit(C.TRANSLITERATION_COST))).otherwise(cost)
    top = F.col("first_rank").isNotNull()
    tier = F.when(top, 0).when((s == key) & ~text.is_ascii(key), 2).otherwise(1)
    tie = lambda value, none: F.when(~top & weak, value).otherwise(F.lit(none))
    in_order = F.col("fallback_source").isin(ordered_sources) if ordered_sources else F.lit(False)
    return (
        out.withColumn("tier", tier).withColumn("order_cost", F.when(top, F.col("first_rank")).otherwise(cost.cast("long"))).withColumn("minus_families", F.when(top, F.lit(0)).otherwise(-F.col("families")).cast("long"))
        .withColumn("tie_clicks", tie(-F.col("_clicks"), 0)).withColumn("tie_source", tie(F.col("fallback_source"), "")).withColumn("tie_rank", tie(F.when(in_order, F.col("fallback_rank")).otherwise(F.lit(0)), 0)).drop("_clicks")
    )


def with_least_cost(rows: DataFrame, costs: DataFrame, reading: str = "reading", surface: str = "surface", out: str = "word_cost") -> DataFrame:
    """``rows`` with the least cost of their (reading, surface), null where there is none: that a word lacks one is evidence, too.

    Both are dealt by the reading, once and together; the least is that of a window, so there is no join.
    """
    mine, least = free(rows.withColumn(out, F.lit(None)), "mine", "least")
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema} | {reading: F.col("reading").alias(reading), surface: F.col("surface").alias(surface)}
    there = costs.select("reading", "surface", F.col("cost").alias(least)).select(*(blank[c] for c in rows.columns), least, F.lit(False).alias(mine))
    both = rows.withColumns({least: F.lit(None).cast(there.schema[least].dataType), mine: F.lit(True)}).unionByName(there)
    return both.repartition(reading).withColumn(out, F.min(least).over(Window.partitionBy(reading, surface))).where(mine).drop(mine, least)


def with_guarded_clicks(rows: DataFrame, clicks: DataFrame, out: str = "title_clicks") -> DataFrame:
    """``rows`` (reading, surface, said, ...) with the clicks of the title that is their surface; null if rows that ``said`` something give the title to another reading, or to several."""
    title, n, low, high = free(rows, "title", "n_clicks", "low", "high")
    titles = clicks.groupBy(F.col("surface").alias(title)).agg(F.sum("clicks").alias(n))
    both = rows.join(titles, F.col("surface") == F.col(title), "left")
    owner, by_title = F.when(F.col("said"), F.col("reading")), Window.partitionBy("surface")
    known = both.withColumns({low: F.min(owner).over(by_title), high: F.max(owner).over(by_title)})
    none, mine = F.col(low).isNull(), (F.col(low) == F.col(high)) & (F.col(low) == F.col("reading"))
    return known.withColumn(out, F.when(none | mine, F.col(n))).drop(title, n, low, high)


def _irregular() -> Column:
    return F.coalesce(F.arrays_overlap("inf", F.array(*map(F.lit, IRREGULAR_TAGS))), F.lit(False))


def nasi_order(merged: DataFrame, ids: list[str], costs: DataFrame | None = None, clicks: DataFrame | None = None, ordered_sources: list[str] = (), shift_without_costs: bool = True, ignored: tuple[str, ...] = ()) -> DataFrame:
    """ORDER's columns, signal, reading and surface of each nasi candidate of the selected sources ``ids``.

    merged: ENTRIES. costs: (reading, surface, cost) of the selected word-cost sources. clicks: (surface, clicks). Both rank candidates
    and add none. A title's clicks count for a reading unless signals give the title to another. shift_without_costs: without
    ``costs`` all words count as lacking one, as the export does. ignored: sources whose rows don't count as evidence (for hold-outs),
    though their candidates still own titles.
    """
    base = merged.where(F.col("source").isin(ids) & (F.col("kind") == NASI) & F.col("scope").isin(ALL, SKK_ONLY))
    said = (F.col("source") == FIRST_SOURCE) | ((F.col("source") == MEASURED_SOURCE) & (F.col("cost") != 0)) | ((F.col("source") == TAGGED_SOURCE) & F.col("pri").isNotNull())
    no = lambda kind: F.lit(None).cast(kind)
    rows = base.select("reading", "surface", "source", "rank", "cost", "pri", _irregular().alias("irregular"), "original_reading", F.coalesce(said, F.lit(False)).alias("said"), no("int").alias("word_cost"))
    if ignored:
        rows = rows.where(~F.col("source").isin(list(ignored)) | F.col("said")).withColumn("source", F.when(~F.col("source").isin(list(ignored)), F.col("source")))
    if costs is not None:
        blank = {f.name: no(f.dataType) for f in rows.schema} | {"said": F.lit(False), "word_cost": F.col("cost")}
        rows = rows.unionByName(costs.select(*(F.col(c) if c in ("reading", "surface") else blank[c].cast(rows.schema[c].dataType).alias(c) for c in rows.columns)))
    rows = rows.repartition("reading")
    if TAGGED_SOURCE in ids and TAGGED_SOURCE not in ignored:
        rows = move_loanword_tags(rows, said=F.lit(False))
    seen = evidence(rows, ids, ordered_sources)
    mozc = F.col("word_cost") if costs is not None else no("int")
    counted = no("long")
    if clicks is not None:
        seen = with_guarded_clicks(seen.withColumn("said", F.col("said") | C.is_plausible(F.col("surface"), mozc)), clicks)
        counted = F.col("title_clicks")
    out = with_order(seen.where("n > 0"), mozc, F.lit(costs is not None or shift_without_costs), counted, list(ordered_sources))
    return out.select("reading", "signal", *ORDER)


def ari_order(merged: DataFrame, ids: list[str], ordinals: dict[str, int], costs: DataFrame | None = None) -> DataFrame:
    """As nasi_order, of ari candidates: given ones by source and rank, then generated ones by the cost of their dictionary form."""
    rows = merged.where(F.col("source").isin(ids) & (F.col("kind") == ARI) & F.col("scope").isin(ALL, SKK_ONLY))
    made = (F.col("confidence") == GENERATED).alias("made")
    rows = rows.select("reading", "surface", "source", "rank", "cost", "pri", _irregular().alias("irregular"), made, F.when(made, okuri.base_of(F.col("pos"))).alias("base"))
    if costs is not None:
        # Only generated rows look for a cost: others have no base, and are dealt evenly by what they have instead.
        keyed = rows.withColumns({"base_reading": F.coalesce("base.reading", F.concat(F.lit("\n"), "reading")), "base_surface": F.coalesce("base.surface", "surface")})
        rows = with_least_cost(keyed, costs, "base_reading", "base_surface")
        rows = rows.withColumn("word_cost", F.when(C.is_plausible(F.col("surface"), F.col("word_cost")), F.col("word_cost")))
    rows = rows.repartition("reading")
    place = F.try_element_at(F.create_map(*(F.lit(x) for kv in ordinals.items() for x in kv)), F.col("source"))
    given = F.when(~F.col("made"), F.struct((F.col("source") != FIRST_SOURCE).cast("int").alias("other"), place.alias("ordinal"), "rank"))
    # A pair that any source gives goes by that alone: its rows are no evidence. Rows of a pair are together already.
    at = rows.withColumn("at", F.min(given).over(Window.partitionBy("reading", "surface"))).withColumn("source", F.when(F.col("at").isNull(), F.col("source")))
    seen = evidence(at, ids, also=tuple(F.min(f"at.{c}").cast("long").alias(f"at_{c}") for c in ("other", "ordinal", "rank")))
    mozc = F.col("word_cost") if costs is not None else F.lit(None).cast("int")
    made = with_order(seen, mozc, F.lit(costs is not None), F.lit(None).cast("long"), [])
    is_given = F.col("at_other").isNotNull()
    upstream = {"signal": F.lit(None), "tier": F.lit(-1), "order_cost": F.col("at_other"), "minus_families": F.col("at_ordinal"), "tie_clicks": F.col("at_rank"), "tie_source": F.lit(""), "tie_rank": F.lit(0)}
    return made.select("reading", *(F.when(is_given, upstream[c]).otherwise(F.col(c)).alias(c) if c in upstream else c for c in ("signal", *ORDER)))


def positions(ordered: DataFrame, key: str = "reading", order=tuple(ORDER)) -> DataFrame:
    """With position, from 0, within the key."""
    return ordered.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def origins(merged: DataFrame, ids: list[str]) -> DataFrame:
    """metric, n over ari candidates: keys, keys with a given candidate, and candidates by where they come from."""
    rows = merged.where(F.col("source").isin(ids) & (F.col("kind") == ARI) & F.col("scope").isin(ALL, SKK_ONLY))
    kind = F.when(F.col("confidence") != GENERATED, "skk").otherwise(F.substring_index("source", "-", 1))
    sets = rows.groupBy("reading", "surface").agg(F.array_sort(F.collect_set(kind)).alias("kinds"))
    label = F.concat(F.lit("candidates_"), F.when(F.array_contains("kinds", "skk"), "skk").otherwise(F.array_join("kinds", "+")))
    by_key = sets.groupBy("reading").agg(F.bool_or(F.array_contains("kinds", "skk")).alias("given"))
    keys = by_key.select(F.explode(F.filter(F.array(F.lit("keys"), F.when(F.col("given"), "keys_with_upstream")), lambda x: x.isNotNull())).alias("metric"))
    return sets.select(label.alias("metric")).union(keys).groupBy("metric").agg(F.count("*").alias("n"))
