"""A counterfactually regularised toxicity classifier.

Logistic regression on which words, and which word beginnings, a text holds. In labelled sentences that
name a group, the group's name is swapped for others'; the objective holds, besides the loss on labels,

    swap * mean over pairs of (f(sentence) - f(swapped sentence))^2

so a group's name alone can't move a score, and neutral mentions of groups that the labels happen to
go with aren't taken for toxic. Groups' names are a table (``IDENTITIES``), which a corpus needn't hold; so the labelled texts
add stand-ins: frequent words that go with neither label and stand in like places, in rows of those that are most alike.
Learnt on a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, mapped, rows_of

#: Names that are swapped for one another, by what they name. A parameter: any language's words will do.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "transgender", "bisexual"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
MARKS = ".,;:!?\"'()[]{}<>*#$%&|…«»„“”-"
BEGINNINGS = (4, 5, 6, 7)
#: A feature is used if its shares among the two labels differ by so many standard errors.
LEAST_Z = 5.0


def features_of(word: str) -> tuple[str, ...]:
    """A lower-case word without marks: itself and its beginnings."""
    return (word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)) if word else ()


def words_of(text: str | None) -> set[str]:
    return {w.strip(MARKS) for w in set((text or "").lower().split())}


@dataclass
class Model:
    weight: dict[str, float]
    bias: float
    n_pairs: int = 0  # swapped sentences that were learnt from
    memo: dict[str, tuple] = field(default_factory=dict, repr=False)

    def score(self, text: str | None) -> float:
        """Between 0 and 1; an empty text has the score of one without any known feature."""
        found, memo, weight = set(), self.memo, self.weight
        for w in set((text or "").lower().split()):
            if (hit := memo.get(w)) is None:
                if len(memo) > 300_000:
                    memo.clear()
                hit = tuple(f for f in features_of(w.strip(MARKS)) if f in weight)
                if len(w) <= 64:
                    memo[w] = hit
            if hit:
                found.update(hit)
        z = self.bias + sum(weight[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

    def __reduce__(self):
        return Model, (self.weight, self.bias, self.n_pairs)


def differences(texts: list[str | None], index: dict[str, int], identities=IDENTITIES) -> Counter:
    """(features lost, features won): how often, over the texts' sentences with a name swapped for each other one of its row that the sentence lacks.

    Features are those in ``index``, by number.
    """
    counted: Counter = Counter()
    held: dict[str, tuple[int, ...]] = {}

    def used(w: str) -> tuple[int, ...]:
        if (k := held.get(w)) is None:
            k = held[w] = tuple(index[x] for x in features_of(w) if x in index)
        return k

    swappable = [(name, [other for other in row if other != name]) for row in identities for name in row]
    some = {name for name, _ in swappable}
    for t in texts:
        for sentence in re.split(r"(?<=[.!?])\s+|\n", t or ""):
            own = words_of(sentence)
            if own.isdisjoint(some):
                continue
            if len(held) > 500_000:
                held.clear()
            n_of = Counter(k for w in own for k in used(w))
            for name, others in swappable:
                if name in own:
                    lost = {k for k in used(name) if n_of[k] == 1}
                    for other in others:
                        if other not in own:
                            new = used(other)
                            counted[tuple(sorted(lost.difference(new))), tuple(sorted(k for k in new if not n_of[k]))] += 1
    return counted


def stand_ins(texts: list[str | None], y: np.ndarray, by: list[Counter], most: int = 48, row: int = 4, least: int = 12) -> tuple[tuple[str, ...], ...]:
    """Rows of words that go with neither label (shares within one standard error) and follow like words, by the cosine of what they follow.

    by: in how many texts of each label a feature is. At most ``most`` words, the most frequent first; each is in ``least`` texts at least.
    """
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)

    def neutral(w: str) -> bool:
        a, b = by[1][w], by[0][w]
        both = (a + b) / n.sum()
        return a + b >= least and both < 0.5 and abs(a / n[1] - b / n[0]) < np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))

    words = sorted((w for w in by[0].keys() & by[1].keys() if w.isalpha() and len(w) >= 3 and neutral(w)), key=lambda w: (-by[0][w] - by[1][w], w))[:most]
    if len(words) < 2:
        return ()
    place, before = {w: k for k, w in enumerate(words)}, [Counter() for _ in words]
    for t in texts:
        split = [x.strip(MARKS) for x in (t or "").lower().split()]
        for left, w in zip(split, split[1:]):
            if (k := place.get(w)) is not None:
                before[k][left] += 1
    known = {x: k for k, (x, _) in enumerate(sorted(sum(before, Counter()).items(), key=lambda c: (-c[1], c[0]))[:500])}
    v = np.zeros((len(words), len(known) + 1))
    for k, c in enumerate(before):
        for x, m in c.items():
            v[k, known.get(x, len(known))] += m
    v = np.sqrt(v)
    alike = v @ v.T / np.maximum(np.linalg.norm(v, axis=1)[:, None] * np.linalg.norm(v, axis=1)[None], 1e-12)
    left, out = list(range(len(words))), []
    while len(left) > 1:
        first = left.pop(0)
        near = sorted(left, key=lambda k: (-alike[first, k], k))[: row - 1]
        left = [k for k in left if k not in near]
        out.append((words[first], *(words[k] for k in near)))
    return tuple(out)


def train(rows: list[tuple[str | None, int]], swap: float = 20.0, ridge: float = 0.005, most_features: int = 4_000, rounds: int = 400, identities=IDENTITIES, learnt: bool = True) -> Model:
    """From (text, toxic) rows. Deterministic; without both labels every score is the prior. learnt: whether stand-ins are added to ``identities``."""
    rows = [(t, int(y)) for t, y in rows if y in (0, 1)]
    texts, y = [t for t, _ in rows], np.array([y for _, y in rows], float)
    of = lambda words: {x for w in words for x in features_of(w)}
    # Features are counted text by text and made again when it is known which count, so that no text's features are held.
    by = [Counter(), Counter()]
    for t, label in rows:
        by[label].update(of(words_of(t)))
    n = [int((y == k).sum()) for k in (0, 1)]
    if not all(n):
        rate = (n[1] + 1) / (sum(n) + 2)
        return Model({}, float(np.log(rate / (1 - rate))))
    if learnt:
        named = {w for row in identities for w in row}
        identities = (*identities, *(row for row in stand_ins(texts, y, by) if not named & set(row)))
    gain = {}
    for f in by[0].keys() | by[1].keys():
        a, b = by[1][f], by[0][f]
        if a + b >= 3:
            p, q = (a + 0.5) / (n[1] + 1), (b + 0.5) / (n[0] + 1)
            both = (a + b) / sum(n)
            if abs(a / n[1] - b / n[0]) >= LEAST_Z * np.sqrt(max(both * (1 - both), 1e-12) * (1 / n[0] + 1 / n[1])):
                gain[f] = abs(p - q) * abs(np.log(p / q))
    names = {x for row in identities for w in row for x in features_of(w)}
    chosen = sorted(gain, key=lambda f: (-gain[f], f))[:most_features]
    chosen += sorted((names & (by[0].keys() | by[1].keys())) - set(chosen))  # the swaps need a group's names, telling or not
    index = {f: k for k, f in enumerate(chosen)}

    by.clear()
    cols = [sorted(index[x] for x in of(words_of(t)) if x in index) for t in texts]
    row, col = np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.array([c for r in cols for c in r], np.int64)
    counted = differences(texts, index, identities)  # equal ones once, with how many there are
    pairs, times = list(counted), np.array(list(counted.values()), float)
    prow = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs]) if pairs else np.zeros(0, np.int64)
    pcol = np.array([k for a, b in pairs for k in (*a, *b)], np.int64)
    sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    w, bias, m, v = np.zeros(len(index)), float(np.log(n[1] / n[0])), np.zeros(len(index) + 1), np.zeros(len(index) + 1)
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, w[col], len(y))
        err = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        grad = np.bincount(col, err[row], len(w)) / len(y) * 10 + ridge * w * 0.1
        if len(pairs):
            d = times * np.bincount(prow, sign * w[pcol], len(pairs))
            grad += 2 * swap * np.bincount(pcol, sign * d[prow], len(w)) / times.sum()
        g = np.append(grad, err.mean() * 10)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Model({f: float(w[k]) for f, k in index.items() if abs(w[k]) > 1e-3}, float(bias), int(times.sum()))


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = 2_000, text_col: str = "text", most_chars: int = 64 << 20) -> list[tuple[str | None, int]]:
    """At most ``per_label`` rows of each label, by the hashes of doc_id and text, of those that aren't held out; of these as many as have ``most_chars`` characters together."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2))
    texts = docs.select("doc_id", F.col(text_col).alias("text"))
    out = []
    for k in (0, 1):
        few = F.broadcast(bounded_sample(usable.where(F.col("toxic") == k).select("doc_id"), per_label).distinct())  # at most per_label ids
        # An id may be that of any number of rows.
        first = texts.join(few, "doc_id").withColumns({"h": F.xxhash64("doc_id"), "g": F.xxhash64("text")}).orderBy("h", "doc_id", "g").limit(per_label)
        chars = F.sum(F.coalesce(F.char_length("text"), F.lit(0))).over(Window.orderBy("h", "doc_id", "g").rowsBetween(Window.unboundedPreceding, 0))  # over per_label rows at most
        out += [(r["doc_id"], r["text"], k) for r in first.withColumn("chars", chars).where(F.col("chars") <= most_chars).collect()]
    return [(t, k) for _, t, k in sorted(out, key=lambda x: x[0])]


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_label: int = 2_000, text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, swap_pairs (how many swapped sentences the model was held to; the same in all rows).

    ``labels``: (doc_id, toxic). held_out: crc32 of doc_id as text leaves 2 by 4; such labels aren't learnt from. Only the
    text makes the score. Null texts count as empty; repeated rows score alike; an empty table gives an empty one.
    A null doc_id isn't held out (held_out is false).
    """
    model = train(training_rows(docs, labels, per_label, text_col))

    def run(batches):
        for b in batches:
            out = [(i, i is not None and is_held_out(i), s, int(s >= threshold), model.n_pairs) for i, s in ((i, model.score(t)) for i, t in rows_of(b, "doc_id", "text"))]
            cols = list(zip(*out)) if out else [()] * 5
            types = [b.schema.field("doc_id").type, pa.bool_(), pa.float64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "held_out", "score", "predicted", "swap_pairs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", F.col(text_col).alias("text")), run, f"doc_id {kind}, held_out boolean, score double, predicted int, swap_pairs long")
