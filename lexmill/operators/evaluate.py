"""How good orders and rules are, against a truth; and the calibration that costs come from."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import costs as C
from ..functions import quantiles, text
from .rank import ORDER, positions

QUANTILES = (0.01, 0.02, 0.05, *(k / 20 for k in range(2, 20)), 0.95, 0.98, 0.99)


def truth_order(candidates: DataFrame, key: str = "reading", value: str = "surface", rank: str = "rank") -> DataFrame:
    """reading, surface, position of keys with two different candidates or more, each at its first place."""
    first = candidates.groupBy(F.col(key).alias("reading"), F.col(value).alias("surface")).agg(F.min(rank).alias("rank"))
    w = Window.partitionBy("reading")
    placed = first.withColumn("n", F.count("*").over(w)).withColumn("position", F.row_number().over(w.orderBy("rank", "surface")) - 1)
    return placed.where("n > 1").select("reading", "surface", "position")


def order_agreement(truth: DataFrame, order: DataFrame) -> DataFrame:
    """scope (adjacent, first-two), n, agree, lexical, signal, signal_agree over neighbouring candidates of ``truth``.

    order: reading, signal and ORDER's columns of the ranking under test; a candidate that it lacks comes behind all others.
    """
    has = order.withColumn("_has", F.lit(True))
    key = F.struct(*(F.col(c) for c in ORDER))
    missing = F.struct(F.lit(1).alias("tier"), F.lit(C.OTHER_COST + 1).cast("long").alias("order_cost"), F.lit(0).cast("long").alias("minus_families"), F.lit(0).cast("long").alias("tie_clicks"), F.lit("").alias("tie_source"), F.lit(0).cast("long").alias("tie_rank"), F.col("surface").alias("surface"))
    types = [t for _, t in order.select(*ORDER).dtypes]
    cast = f"struct<{','.join(f'{n}:{t}' for n, t in zip(ORDER, types))}>"
    rows = truth.join(has, ["reading", "surface"], "left").withColumn("at", F.when(F.col("_has"), key.cast(cast)).otherwise(missing.cast(cast)))
    w = Window.partitionBy("reading").orderBy("position")
    pairs = rows.select("position", "surface", "at", "signal", F.lead("surface").over(w).alias("next"), F.lead("at").over(w).alias("next_at"), F.lead("signal").over(w).alias("next_signal")).where("next IS NOT NULL")
    return neighbour_counts(pairs.select("position", (F.col("at") < F.col("next_at")).alias("agree"), (F.col("surface") < F.col("next")).alias("lexical"), (F.col("signal").isNotNull() & F.col("next_signal").isNotNull()).alias("signal")))


def neighbour_counts(pairs: DataFrame) -> DataFrame:
    """Of neighbours (position, agree, lexical, signal): counts over all, and over those at the front."""
    scope = F.explode(F.when(F.col("position") == 0, F.array(F.lit("adjacent"), F.lit("first-two"))).otherwise(F.array(F.lit("adjacent")))).alias("scope")
    return pairs.select(scope, "agree", "lexical", "signal").groupBy("scope").agg(F.count("*").alias("n"), F.count_if("agree").alias("agree"), F.count_if("lexical").alias("lexical"), F.count_if("signal").alias("signal"), F.count_if(F.col("signal") & F.col("agree")).alias("signal_agree"))


def first_kinds(positions: DataFrame) -> DataFrame:
    """label (lexical, ordered), kind, n: what the first candidate is, of non-ASCII keys with two candidates or more."""
    heads = positions.groupBy("reading").agg(F.count("*").alias("n"), F.min("surface").alias("lexical"), F.min_by("surface", "position").alias("ordered"))
    heads = heads.where((F.col("n") > 1) & ~text.is_ascii(F.col("reading")))
    each = heads.select(F.explode(F.array(*(F.struct(F.lit(x).alias("label"), text.script_kind(F.col(x)).alias("kind")) for x in ("lexical", "ordered")))).alias("x")).select("x.*")
    return each.where("kind IS NOT NULL").groupBy("label", "kind").agg(F.count("*").alias("n"))


def top(positions: DataFrame, k: int = 8) -> DataFrame:
    return positions.where(F.col("position") < k)


def wilson(hits: Column, total: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The interval's ends; (0, 1) without any trial."""
    n, zz = total.cast("double"), z * z
    p = hits / n
    spread = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    low, high = (p + zz / (2 * n) - spread) / (1 + zz / n), (p + zz / (2 * n) + spread) / (1 + zz / n)
    return F.when(n > 0, low).otherwise(0.0), F.when(n > 0, high).otherwise(1.0)


def rule_precision(generated: DataFrame, truth: DataFrame, by_letter: bool = False) -> DataFrame:
    """grouping, label, pairs, key_known, hits, stem_known, stem_hits, low, high.

    generated: key, stem, source, class. truth: key, stem. A pair counts once per label. key_known: pairs whose key the truth has;
    hits: of those, pairs that it has; stem: the same by key without its letter.
    """
    own = truth.select("key", "stem").distinct()
    bare = F.expr("substr(key, 1, char_length(key) - 1)")
    label = lambda name, c: F.struct(F.lit(name).alias("grouping"), c.alias("label"))
    labels = [label("source", F.col("source")), label("class", F.col("class")), label("source/class", F.concat_ws(" ", "source", "class"))]
    if by_letter:
        labels.append(label("letter", F.expr("substr(key, -1)")))
    each = generated.select("key", "stem", F.explode(F.array(*labels)).alias("g")).select("key", "stem", "g.*").distinct().withColumn("bare", bare)
    marked = (
        each.join(own.withColumn("hit", F.lit(True)), ["key", "stem"], "left").join(own.select("key").distinct().withColumn("known", F.lit(True)), "key", "left")
        .join(own.select(bare.alias("bare"), "stem").distinct().withColumn("stemmed", F.lit(True)), ["bare", "stem"], "left")
    )
    yes = lambda *c: F.count_if(F.coalesce(F.expr(" AND ".join(c)), F.lit(False)))
    out = marked.groupBy("grouping", "label").agg(F.count("*").alias("pairs"), yes("known").alias("key_known"), yes("known", "hit").alias("hits"), yes("stemmed").alias("stem_known"), yes("stemmed", "hit").alias("stem_hits"))
    low, high = wilson(F.col("hits"), F.col("key_known"))
    return out.withColumn("low", low).withColumn("high", high).orderBy("grouping", F.desc("pairs"), "label")


def ratio_text(hits: Column, total: Column) -> Column:
    """"0.750 (3/4)" with thousands separated, or n/a without any trial."""
    return F.when(total > 0, F.format_string("%.3f (%,d/%,d)", hits / total, hits, total)).otherwise("n/a")


def unknown_sample(generated: DataFrame, truth: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """key, stem, labels of ``n`` generated pairs whose key the truth lacks, drawn by a seeded hash: the same on every run."""
    outside = generated.join(truth.select("key").distinct(), "key", "left_anti")
    pairs = outside.groupBy("key", "stem").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "source", "class"))), " ").alias("labels"))
    return pairs.orderBy(F.sha2(F.concat_ws("\t", F.lit(str(seed)), "key", "stem"), 256), "key", "stem").limit(n)


def evaluate_rules(generated: DataFrame, truth: DataFrame, by_letter: bool = False, sample: int = 0, seed: int = 0) -> dict[str, DataFrame]:
    """How good generated pairs (key, stem, source, class) are against given ones (key, stem): by_group, total (one row), and sample if asked for."""
    own, pairs = truth.select("key", "stem").distinct(), generated.select("key", "stem").distinct()
    marked = pairs.join(own.select("key").distinct().withColumn("known", F.lit(True)), "key", "left").join(own.withColumn("hit", F.lit(True)), ["key", "stem"], "left")
    size = own.agg(F.count("*").alias("truth"))
    total = marked.agg(F.count("*").alias("pairs"), F.count_if("known").alias("key_known"), F.count_if("hit").alias("hits")).join(F.broadcast(size), F.lit(True))  # one row each
    total = total.withColumn("precision", ratio_text(F.col("hits"), F.col("key_known"))).withColumn("recall", ratio_text(F.col("hits"), F.col("truth")))
    out = {"by_group": rule_precision(generated, truth, by_letter), "total": total}
    return out | ({"sample": unknown_sample(generated, truth, sample, seed)} if sample else {})


def evaluate_order(candidates: DataFrame, ordered: DataFrame, probes: int = 8) -> dict[str, DataFrame]:
    """How far an order (``rank.nasi_order``, with the truth's source among its ``ignored``) agrees with that of a truth's candidates (reading, surface, rank).

    agreement: of neighbours; first_kinds: what stands first; probes: the first candidates of each key.
    """
    truth = truth_order(candidates)
    placed = positions(ordered)
    return {"agreement": order_agreement(truth, ordered), "first_kinds": first_kinds(placed), "probes": top(placed, probes).select("reading", "surface", "position")}


def knots(rows: DataFrame, x: str, y: str, shares: Sequence[float] = QUANTILES, falling: bool = False) -> DataFrame:
    """n, x, y: matched quantiles of two scales over rows that have both; of equal x the first stays. falling: large x goes with small y.

    Quantiles are exact, by histograms of bounded size, so no task holds a column.
    """
    q = sorted(shares)
    both = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    at_x, at_y = (quantiles.quantiles(both, c, q).get(None, []) for c in (x, y))
    pairs = list(enumerate(zip(at_x, at_y[::-1] if falling else at_y)))
    kept = [(n, *p) for n, p in pairs if not n or pairs[n - 1][1][0] != p[0]]
    return rows.sparkSession.createDataFrame(kept, "n int, x double, y double")


def pool(blocks: Iterable[tuple[list, float, int]]) -> list[tuple[list, float, int]]:
    """Blocks (keys, mean, weight) in the order of their keys, made to never fall by pooling neighbours. Neighbours that are pooled in a part stay so in the whole, so results of parts are blocks again."""
    out: list[tuple[list, float, int]] = []
    for keys, mean, weight in blocks:
        keys = list(keys)
        while out and out[-1][1] > mean:
            before, m, w = out.pop()
            keys, mean, weight = before + keys, (m * w + mean * weight) / (w + weight), w + weight
        out.append((keys, mean, weight))
    return out


def pooled_medians(rows: DataFrame, band: str, value: str) -> list[tuple[int, float]]:
    """Median of each band, made to never fall along the bands by pooling neighbours, weighted by their rows."""
    known = rows.where(F.col(value).isNotNull())
    medians = quantiles.quantiles(known, value, (0.5,), by=band)
    sizes = {r["g"]: r["n"] for r in known.groupBy(F.col(band).alias("g")).agg(F.count("*").alias("n")).collect()}  # a row per band
    return [(k, m) for keys, m, _ in pool(([b], medians[b][0], sizes[b]) for b in sorted(medians)) for k in keys]
