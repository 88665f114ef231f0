"""Mixing to target weights with soft domain membership.

A classifier trained on a labelled table gives each document a posterior over domains. Document i of n_i
tokens takes part n_i * p_id in domain d. Nonnegative rates r_i (expected copies) are fitted by least squares so that
the expected totals sum(r_i n_i p_id) meet the targets t_d:

    1/2 sum_d (y_d - t_d)^2 / s_d + ridge/2 sum_i u_i (r_i - 1)^2,   y_d = sum_i u_i r_i p_id,   r_i >= least

with u_i = n_i / sum n and s_d the domain's present share. In the metric of u the gradient is
sum_d p_id (y_d - t_d) / s_d + ridge (r_i - 1), with a Lipschitz constant of at most 1 + ridge, so the projected
gradient needs no line search. An iteration is one pass that sums len(domains) numbers; a rate
follows from its document's posterior and the gradients so far, so no rates are gathered or joined.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import bounded_sample, cut, fresh, mapped, rows_of

#: Of the words of labelled texts, so many of the most frequent are known to the classifier.
VOCABULARY = 20_000
#: The labels are taken to be wrong this often, so that no posterior is sharper than labels can be.
SMOOTHING = 0.02


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over words, as mean log-likelihood times a fitted sharpness, so that long texts aren't overconfident."""

    domains: tuple[str, ...]
    index: dict[bytes, int]
    weight: np.ndarray  # (words + 1, domains): the last row is for unknown words
    prior: np.ndarray
    sharpness: float

    def mean(self, words: list[bytes]) -> np.ndarray:
        get, unknown = self.index.get, len(self.weight) - 1
        at = np.fromiter((get(w, unknown) for w in words), np.int64, len(words))
        return self.weight[at].mean(0) if len(words) else np.zeros(len(self.domains))

    def posterior(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words and posterior; a text without words has the prior."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return len(words), softmax((self.prior + self.sharpness * self.mean(words))[None, :])[0]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[str | None, str]], domains: tuple[str, ...], vocabulary: int = VOCABULARY) -> Classifier:
    """From (text, domain) rows; rows of other domains are passed over. Without rows the posterior is even."""
    from collections import Counter

    of = {d: k for k, d in enumerate(domains)}
    texts = [(t, of[d]) for t, d in rows if d in of]
    split = lambda t: (t or "").encode("utf-8", "surrogatepass").lower().split()
    counts = [Counter() for _ in domains]
    for t, d in texts:
        counts[d].update(split(t))
    total = sum(counts, Counter())
    known = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:vocabulary]]
    table = np.array([[c[w] for c in counts] for w in known] + [[sum(c.values()) - sum(c[w] for w in known) for c in counts]], float) + 0.5
    weight = np.log(table / table.sum(0))
    prior = np.log((np.bincount([d for _, d in texts], minlength=len(domains)) + 1.0) / (len(texts) + len(domains)))
    model = Classifier(domains, {w: k for k, w in enumerate(known)}, weight, prior, 1.0)
    if not texts:
        return model
    means, truth = np.stack([model.mean(split(t)) for t, _ in texts]), np.array([d for _, d in texts])
    soft = np.eye(len(domains))[truth] * (1 - SMOOTHING) + SMOOTHING / len(domains)
    loss = lambda s: -(soft * np.log(softmax(prior + s * means) + 1e-300)).sum(1).mean()
    return Classifier(domains, model.index, weight, prior, min((0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=loss))


def labelled_rows(labelled: DataFrame, most: int = 2_000) -> list[tuple[str | None, str]]:
    """At most ``most`` rows (text, domain) of the labelled table, by the hash of their ids."""
    chosen = bounded_sample(labelled.where(F.col("domain").isNotNull()), most)
    return [(r["text"], r["domain"]) for r in chosen.select("text", "domain").collect()]


def members(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens (words), p (posterior by domain) of each row. Narrow."""

    def run(batches):
        for b in batches:
            out = [(i, *model.posterior(t)) for i, t in rows_of(b, "doc_id", "text")]
            ids, n, p = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field("doc_id").type), pa.array(n, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))], ["doc_id", "n_tokens", "p"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", F.col(text_col).alias("text")), run, f"doc_id {kind}, n_tokens long, p array<double>")


@dataclass(frozen=True)
class Fit:
    """gradients: of each iteration, by domain, and its momentum. total: tokens; shares: of the domains at rate 1; targets: their wanted shares times the budget. settled: whether it ended before rounds ran out."""

    gradients: tuple[tuple[float, ...], ...]
    ridge: float
    least: float
    total: float
    shares: tuple[float, ...]
    targets: tuple[float, ...]
    reached: tuple[float, ...]
    settled: bool = True

    def rates(self, p: np.ndarray) -> np.ndarray:
        """Rates of documents with posteriors ``p`` (n, domains)."""
        ahead, r, step = np.ones(len(p)), np.ones(len(p)), 1 / (1 + self.ridge)
        for *g, push in self.gradients:
            new = np.maximum(self.least, ahead - step * (p @ np.array(g) + self.ridge * (ahead - 1)))
            ahead, r = new + push * (new - r), new
        return r


def fit(state: DataFrame, weights: dict[str, float], domains: tuple[str, ...], budget: float | None = 1.0, least: float = 0.0, ridge: float = 1e-3, rounds: int = 80, tolerance: float = 1e-6, span: int = 12) -> Fit:
    """Accelerated projected gradient over ``state`` (of ``members``; materialise it, it is read once per iteration).

    budget: wanted tokens as a multiple of those there are; None: the least at which no domain's target is below what it has.
    The momentum starts anew when it points uphill. It ends when no domain's share of the tokens moves by ``tolerance``;
    where rounds run out before, it warns of that.
    """
    d = range(len(domains))
    share = lambda r, name: [F.sum(F.col("n_tokens") * r * F.col("p")[k]).alias(f"{name}{k}") for k in d]
    first = state.agg(F.sum("n_tokens").alias("n"), *share(F.lit(1.0), "r")).first()
    total = float(first["n"] or 0)
    w = np.array([weights.get(x, 0.0) for x in domains], float)
    w = w / w.sum() if w.sum() else np.full(len(domains), 1 / len(domains))
    if not total:
        return Fit((), ridge, least, 0.0, tuple(0.0 for _ in d), tuple(w), tuple(0.0 for _ in d))
    y = reached = np.array([first[f"r{k}"] for k in d]) / total
    shares = y.copy()
    target = w * (float(np.max(shares / np.maximum(w, 1e-9))) if budget is None else budget)
    step, t, pending, gradients, done, moves = 1 / (1 + ridge), 1.0, [], [], False, float("inf")
    now = state.withColumn("s", F.struct(F.lit(1.0).alias("ahead"), F.lit(1.0).alias("r"), F.lit(0.0).alias("uphill")))
    for _ in range(rounds):
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        g = (*((y - target) / np.maximum(shares, 1e-12)).tolist(), (before - 1) / t)
        gradients.append(g)
        pending.append(g)
        history = F.array(*(F.array(*map(F.lit, map(float, h))) for h in pending))

        def move(s, h):
            pull = sum((F.col("p")[k] * h[k] for k in d), F.lit(0.0))
            new = F.greatest(F.lit(float(least)), s["ahead"] - step * (pull + ridge * (s["ahead"] - 1)))
            return F.struct((new + h[len(domains)] * (new - s["r"])).alias("ahead"), new.alias("r"), ((s["ahead"] - new) * (new - s["r"])).alias("uphill"))

        moved = now.withColumn("s", F.aggregate(history, F.col("s"), move))
        if len(pending) == span:  # the rates so far become a column
            now, pending = cut(moved), []
            moved = now
        got = moved.agg(F.sum(F.col("n_tokens") * F.col("s.uphill")).alias("uphill"), *share(F.col("s.ahead"), "y"), *share(F.col("s.r"), "r")).first()
        y, new = (np.array([got[f"{c}{k}"] for k in d]) / total for c in "yr")
        if got["uphill"] > 0:
            t = 1.0
        moves, reached = float(np.abs(new - reached).max()), new
        done = moves < tolerance
        if done:
            break
    if not done:
        warnings.warn(f"mixing: {rounds} rounds ran out while shares moved by {moves:.1e}; reached {reached.tolist()} of {target.tolist()}", RuntimeWarning, stacklevel=2)
    return Fit(tuple(gradients), ridge, least, total, tuple(shares.tolist()), tuple(target.tolist()), tuple(reached.tolist()), done)


def copies(rate: F.Column, seed: int = 7) -> F.Column:
    """Whole copies whose expectation is the rate: the fraction is drawn by the hash of doc_id, the same on every run."""
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("long")


def with_rates(state: DataFrame, found: Fit) -> DataFrame:
    """``state`` with rate and copies."""

    def run(batches):
        for b in batches:
            p = np.array(b.column(b.schema.get_field_index("p")).to_pylist(), float).reshape(b.num_rows, len(found.targets))
            yield b.append_column("rate", pa.array(found.rates(p), pa.float64()))

    return mapped(state, run, StructType([*state.schema, StructField("rate", DoubleType())])).withColumn("copies", copies(F.col("rate")))


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = 1.0, least: float = 0.0, most_labelled: int = 2_000, text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, p_<domain>, rate, copies.

    ``labelled``: (doc_id, text, domain), of which at most ``most_labelled`` rows train the classifier. ``weights``: wanted
    share of tokens by domain. Null and empty texts have no tokens and the prior as posterior; repeated rows each count;
    rows of one doc_id draw alike; an empty table gives an empty one; other columns aren't read.
    """
    domains = tuple(sorted(weights))
    state = cut(members(docs, train(labelled_rows(labelled, most_labelled), domains), text_col))
    found = fit(state, weights, domains, budget, least)
    out = with_rates(state, found)
    return out.select("doc_id", "n_tokens", *(F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(domains)), "rate", "copies")


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = 1.0, least: float = 0.0, most_labelled: int = 2_000, text_col: str = "text", tolerance: float = 1e-6) -> DataFrame:
    """``docs`` itself at the fitted rates: each row as often as its copies say, with all its columns. Texts are scored twice and not shuffled."""
    domains = tuple(sorted(weights))
    model = train(labelled_rows(labelled, most_labelled), domains)
    found = fit(cut(members(docs, model, text_col)), weights, domains, budget, least, tolerance=tolerance)
    at = docs.columns.index(text_col)
    rate, times, copy = fresh(docs, "rate", "times", "copy")

    def run(batches):
        for b in batches:
            p = np.array([model.posterior(t)[1] for t in b.column(at).to_pylist()], float).reshape(b.num_rows, len(domains))
            yield b.append_column(rate, pa.array(found.rates(p), pa.float64()))

    rated = mapped(docs, run, StructType([*docs.schema, StructField(rate, DoubleType())]))
    repeated = rated.withColumn(times, copies(F.col(rate))).where(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(*(F.col(f"`{c}`") for c in docs.columns))
