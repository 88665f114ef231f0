"""Quality rules as weak supervision.

Each rule votes good or bad or abstains. Nothing else is needed from a document, so the corpus
is summed up as counts of vote patterns (at most 3 to the number of rules, whatever its size).
Expectation-maximisation over those counts estimates, without labels, how often each rule is
right on good and on bad documents, and the share of good ones; a document's posterior
probability of being good follows from its pattern. One bad vote against many good ones
therefore doesn't reject a document, as it would if all rules had to pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mapped, rows_of

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts", "n_ended", "n_distinct", "n_plain", "n_bare")
GOOD, BAD, NONE = 2, 0, 1
#: Words of letters (bytes over 127 count as letters), with at most the marks that prose puts around them.
LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
PLAIN = re.compile(rb"[\"'(\[]?[A-Za-z\x80-\xff]+(?:['-][A-Za-z\x80-\xff]+)*[.,;:?!\"')\]]{0,2}")


def repeated_words(ids: np.ndarray, distinct: int, width: int = 3) -> int:
    """Words in windows of ``width`` words that are found at two places or more, the first included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key, size = ids[:n].astype(np.int64), distinct
    for k in range(1, width):
        if size * distinct >= 2**63:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            size = int(key.max()) + 1
        key, size = key * distinct + ids[k : k + n], size * distinct
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.zeros(len(ids), bool)
    at = np.isin(key, twice)
    for k in range(width):
        hit[k : k + n] |= at
    return int(hit.sum())


def _kind(word: bytes) -> int:
    """2 a plain word, 0 without any letter, else 1."""
    return _known_kind(word) if len(word) <= 64 else _known_kind.__wrapped__(word)


@lru_cache(maxsize=100_000)
def _known_kind(word: bytes) -> int:
    return 2 if PLAIN.fullmatch(word) else 1 if LETTER.search(word) else 0


def measure(text: str | None) -> tuple[int, ...]:
    """STATS of a text; all 0 for null or empty."""
    if not text:
        return (0,) * len(STATS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    index = dict(zip(first := dict.fromkeys(words), range(len(first))))
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    seen, dup, lines, ended = set(), 0, 0, 0
    for line in raw.split(b"\n"):
        if bare := line.strip():
            dup += line in seen
            seen.add(line)
            lines += 1
            ended += bare[-1:] in b".!?:;\"')"
    plain = bare_words = 0
    for w, n in Counter(words).items():
        kind = _kind(w)
        plain += n * (kind == 2)
        bare_words += n * (kind == 0)
    x = np.frombuffer(raw, np.uint8)
    upper = int(((x >= 65) & (x <= 90)).sum())
    letters = int((((x | 32) >= 97) & ((x | 32) <= 122) & (x < 128)).sum())
    return (
        len(words), len(text) - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")), sum(map(text.count, SYMBOLS)),
        dup, repeated_words(ids, len(index)), lines, upper, letters, text.count("!"), ended, len(index), plain, bare_words,
    )


def ratio(top: str, base: str, good: Callable[[float], bool], bad: Callable[[float], bool]) -> Callable[[dict], int]:
    def vote(s: dict) -> int:
        if not s[base]:
            return NONE
        x = s[top] / s[base]
        return GOOD if good(x) else BAD if bad(x) else NONE

    return vote


def never(x: float) -> bool:
    """For rules that only ever find faults: the fault's absence is no merit, so they abstain."""
    return False


#: Each looks at another side of a text, so that they err independently, as the model assumes.
RULES: dict[str, Callable[[dict], int]] = {
    "symbols": ratio("n_symbols", "n_words", never, lambda x: x > 0.1),
    "repeated_lines": ratio("n_dup_lines", "n_lines", never, lambda x: x > 0.3),
    "repeated_words": ratio("n_repeat_words", "n_words", lambda x: x < 0.1, lambda x: x > 0.3),
    "capitals": ratio("n_upper", "n_letters", never, lambda x: x > 0.4),
    "shouting": ratio("n_shouts", "n_words", never, lambda x: x > 0.2),
    "plain_words": ratio("n_plain", "n_words", lambda x: x > 0.85, lambda x: x < 0.6),
    "bare_words": ratio("n_bare", "n_words", never, lambda x: x > 0.2),
    "word_length": ratio("word_chars", "n_words", lambda x: 3 <= x <= 9, lambda x: x < 2.5 or x > 14),
    "line_ends": ratio("n_ended", "n_lines", lambda x: x > 0.7, lambda x: x < 0.3),
    "variety": ratio("n_distinct", "n_words", lambda x: x > 0.3, lambda x: x < 0.12),
}


def pattern(stats: tuple[int, ...], rules=RULES) -> int:
    s, code = dict(zip(STATS, stats)), 0
    for rule in rules.values():
        code = 3 * code + rule(s)
    return code


@dataclass(frozen=True)
class Model:
    """share: of good documents. votes[c][j]: how often rule j votes bad, abstains, votes good on documents of class c (0 bad, 1 good)."""

    share: float
    votes: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        votes, rules = votes_of(codes, self.votes.shape[1]), np.arange(self.votes.shape[1])
        bad, good = (np.log(share) + np.log(v[rules, votes]).sum(1) for share, v in ((1 - self.share, self.votes[0]), (self.share, self.votes[1])))
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))

    def accuracies(self) -> np.ndarray:
        """How often each rule is right when it votes."""
        right = self.share * self.votes[1][:, GOOD] + (1 - self.share) * self.votes[0][:, BAD]
        return right / (right + self.share * self.votes[1][:, BAD] + (1 - self.share) * self.votes[0][:, GOOD])


def votes_of(codes: np.ndarray, n: int) -> np.ndarray:
    return np.stack([codes // 3 ** (n - 1 - j) % 3 for j in range(n)], 1)


#: Pseudo-counts of (bad, none, good) votes on bad and on good documents.
PRIOR = np.array([[6.0, 3.0, 1.0], [1.0, 3.0, 6.0]])


def fit(counts: dict[int, int], n_rules: int = len(RULES), prior: np.ndarray = PRIOR, share: float = 0.8, share_weight: float = 20.0, rounds: int = 500) -> Model:
    """EM over counts of vote patterns, from the prior. A rule is never taken to be worse than chance."""
    codes = np.array(sorted(counts), np.int64)
    w = np.array([counts[c] for c in codes.tolist()], float)
    hit = (votes_of(codes, n_rules)[:, :, None] == np.arange(3)).astype(float) if len(codes) else np.zeros((0, n_rules, 3))
    start = np.repeat((prior / prior.sum(1, keepdims=True))[:, None, :], n_rules, 1)
    model = Model(share, start)
    for _ in range(rounds):
        p = model.posterior(codes) if len(codes) else np.zeros(0)
        seen = [np.tensordot(mass * w, hit, 1) + prior[c] for c, mass in enumerate((1 - p, p))]
        votes = np.stack([x / x.sum(1, keepdims=True) for x in seen])
        for v, more, less in ((BAD, 0, 1), (GOOD, 1, 0)):
            wrong = votes[more][:, v] < votes[less][:, v]
            both = (seen[0][:, v] + seen[1][:, v]) / (seen[0].sum(1) + seen[1].sum(1))
            votes[:, wrong, v] = both[wrong]
        votes /= votes.sum(2, keepdims=True)
        new = Model(float(np.clip(((p * w).sum() + share * share_weight) / (w.sum() + share_weight), 1e-6, 1 - 1e-6)), votes)
        done = abs(new.share - model.share) < 1e-9 and float(np.abs(new.votes - model.votes).max()) < 1e-9
        model = new
        if done:
            break
    return model


def failed(stats: tuple[int, ...], least_words: int = 50, most_repeated: int = 50) -> bool:
    return stats[0] < least_words or 100 * stats[4] > most_repeated * stats[0]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, STATS (long), base_failed and the vote pattern of each row. Narrow."""

    def run(batches):
        for b in batches:
            ids, stats = [], []
            for i, text in rows_of(b, "id", "text"):
                ids.append(i)
                stats.append(measure(text))
            cols = list(zip(*stats)) if stats else [()] * len(STATS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field("id").type), *(pa.array(c, pa.int64()) for c in cols), pa.array(map(failed, stats), pa.bool_()), pa.array(map(pattern, stats), pa.int64())],
                ["id", *STATS, "base_failed", "pattern"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    made = mapped(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run, f"id {kind}, {', '.join(f'{s} long' for s in STATS)}, base_failed boolean, pattern long")
    return made.withColumnRenamed("id", id_col)


def pattern_counts(stats: DataFrame) -> dict[int, int]:
    """Over all documents that pass the base: at most 3 to the number of rules rows."""
    return {r["pattern"]: r["n"] for r in stats.where(~F.col("base_failed")).groupBy("pattern").agg(F.count("*").alias("n")).collect()}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: the id, STATS, base_failed, pattern, quality (posterior), kept.

    kept is false if base_failed, else quality >= ``least``. A null text has no words (and so fails the base);
    repeated rows count as often as they occur and are judged alike; an empty table gives an empty one; other
    columns aren't read.
    """
    stats = cut(measured(docs, id_col, text_col))
    model = fit(pattern_counts(stats))
    codes = np.arange(3 ** len(RULES))
    scores = docs.sparkSession.createDataFrame(list(zip(codes.tolist(), model.posterior(codes).tolist())), "pattern long, quality double")
    return stats.join(F.broadcast(scores), "pattern", "left").select(id_col, *STATS, "base_failed", "pattern", "quality", (~F.col("base_failed") & (F.col("quality") >= least)).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Texts are measured twice, once for the patterns' counts and once to filter, so that no text is shuffled or stored.
    """
    text = docs.select(F.lit(0).alias("id"), docs[text_col].alias("text"))
    model = fit(pattern_counts(measured(text, "id", "text")))
    good = frozenset(np.flatnonzero(model.posterior(np.arange(3 ** len(RULES))) >= least).tolist())
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            stats = [measure(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([not failed(s) and pattern(s) in good for s in stats], pa.bool_()))

    return mapped(docs, run, docs.schema)
