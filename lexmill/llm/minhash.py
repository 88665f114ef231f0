"""MinHash near-duplicates with sequential Bayesian verification.

One pass gives each text its set of word shingles (as 64-bit hashes), a 128-bit digest of that set
and a key per band of its MinHash signature. Texts of equal sets are one class from then on. Classes that
share a band key are candidates. They aren't written out as pairs: candidates are gathered in blocks of a
bounded number of classes, and each pair of blocks that share a key is one unit of work. In a unit,
pairs that share a key are compared signature batch by signature batch; a pair goes as soon as the
posterior probability that its similarity reaches the threshold is below ``miss``; what survives is verified on
the whole sets. A unit returns no more links than join its classes, and components follow by
alternating stars. Buckets of any size are worked through in full, in blocks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, cut, mapped, rows_of, ship, sift

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on unsigned 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stream(seed: int, n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed))


class WordHashes:
    """64-bit hashes of a text's words: polynomials over their bytes, all at once from running sums."""

    BASE = 0x2545F4914F6CDD1D | 1

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def _grow(self, n: int) -> None:
        n = max(n, 2 * len(self.up))
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.r_[_U(1), np.full(n, self.BASE, np.uint64)])
            self.down = np.cumprod(np.r_[_U(1), np.full(n, pow(self.BASE, -1, 2**64), np.uint64)])

    def __call__(self, raw: bytes) -> np.ndarray:
        x = np.frombuffer(raw, np.uint8)
        if len(x) >= len(self.up):
            self._grow(len(x) + 1)
        edge = np.diff(np.r_[True, self.space[x], True].astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.r_[_U(0), np.cumsum((x.astype(np.uint64) + _U(1)) * self.up[: len(x)])]
        return mixed((sums[end] - sums[start]) * self.down[start])


@dataclass(frozen=True)
class Scheme:
    """width: words of a shingle. Texts link if 100 * intersection >= percent * union.

    rows: hashes of a band. At 24 bands a pair just at the threshold shares no band with probability
    (1 - (percent/100)^rows)^24, which has to be 5e-6 at most. miss: with what probability a link may be pruned.
    """

    width: int = 3
    percent: int = 85
    bands: int = 24
    miss: float = 1e-6

    @cached_property
    def rows(self) -> int:
        return max([1, *(r for r in range(1, 20) if (1 - (self.percent / 100) ** r) ** self.bands <= 5e-6)])

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def __post_init__(self):
        put = lambda k, v: object.__setattr__(self, k, v)
        put("a", (_stream(1, self.size) >> _U(32)).astype(np.uint32)[:, None] | np.uint32(1))
        put("b", (_stream(2, self.size) >> _U(32)).astype(np.uint32)[:, None])
        put("place", _stream(3, self.width) | _U(1))
        put("fold", _stream(4, self.rows) | _U(1))
        put("band", _stream(5, self.bands))
        put("words", WordHashes())

    def shingles(self, text: str | None) -> np.ndarray:
        """The set as sorted distinct hashes; A-Z count as a-z."""
        h = self.words((text or "").encode("utf-8", "surrogatepass").lower())
        n = len(h) - self.width + 1
        if not len(h):
            return h
        if n < 1:
            return mixed((h * self.place[: len(h)]).sum(keepdims=True) + _U(len(h)))
        return np.unique(mixed(sum(h[k : k + n] * self.place[k] for k in range(self.width))))

    def signature(self, s: np.ndarray) -> np.ndarray:
        x, best = ((s ^ (s << _U(29))) >> _U(32)).astype(np.uint32), np.full(self.size, 2**32 - 1, np.uint32)
        for k in range(0, len(x), 1024):
            v = self.a * x[None, k : k + 1024]
            v += self.b
            np.minimum(best, v.min(1), out=best)
        return best

    def keys(self, signature: np.ndarray) -> np.ndarray:
        return mixed((signature.reshape(-1, self.bands, self.rows).astype(np.uint64) * self.fold).sum(2) + self.band).view(np.int64)

    @cached_property
    def least(self) -> list[tuple[int, int]]:
        """(hashes compared, matches needed): below, the posterior P(similarity >= threshold) is under ``miss``.

        With a uniform prior it is Beta(matches + 1, misses + 1), whose tail is a binomial sum.
        """
        t, out = self.percent / 100, []
        for n in range(self.bands, self.size + 1, self.bands):
            tail, need = 0.0, n + 1
            for m in range(n + 1):
                tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if tail >= self.miss:
                    need = m
                    break
            out.append((n, need))
        return out

    def __reduce__(self):
        return Scheme, (self.width, self.percent, self.bands, self.miss)


def row_key(text) -> F.Column:
    """What tells rows of one doc_id, or without one, apart: a hash of the text, so rows of equal keys have equal texts."""
    return F.xxhash64(text)


def sketch(docs: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (hash of the text), n_shingles, digest (null for empty sets), keys (null for empty sets) of each row. Narrow."""

    def run(batches):
        for b in batches:
            out = []
            for i, row, text in rows_of(b, "doc_id", "row", "text"):
                s = scheme.shingles(text)
                out.append((i, row, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None, scheme.keys(scheme.signature(s))[0] if len(s) else None))
            cols = list(zip(*out)) if out else [()] * 5
            types = [b.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "row", "n_shingles", "digest", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.select(docs[id_col].alias("doc_id"), row_key(docs[text_col]).alias("row"), docs[text_col].alias("text")), run, f"doc_id {kind}, row long, n_shingles long, digest binary, keys array<long>")


def linked(scheme: Scheme, one: list[np.ndarray], two: list[np.ndarray] | None) -> list[tuple[int, int]]:
    """Links (i in one, j in two; two None: within one) that join what the pairs' links join: no pair that links is left unjoined."""
    sig = np.stack([scheme.signature(s) for s in one])
    keys = scheme.keys(sig)
    other = sig if two is None else np.stack([scheme.signature(s) for s in two])
    other_keys = keys if two is None else scheme.keys(other)
    hit = np.zeros((len(sig), len(other)), bool)
    for k in range(scheme.bands):
        hit |= keys[:, k, None] == other_keys[None, :, k]
    i, j = np.nonzero(np.triu(hit, 1) if two is None else hit)
    same, at = np.zeros(len(i), np.int64), 0
    for n, need in scheme.least:
        same += (sig[i, at:n] == other[j, at:n]).sum(1)
        on = same >= need
        i, j, same, at = i[on], j[on], same[on], n
    if not len(i):
        return []
    inter = intersections(one, one if two is None else two, i, j)
    sizes, others = np.array([len(s) for s in one]), np.array([len(s) for s in (one if two is None else two)])
    on = 100 * inter >= scheme.percent * (sizes[i] + others[j] - inter)
    root = list(range(len(one) + (0 if two is None else len(two))))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(i[on].tolist(), j[on].tolist()):
        p, q = find(x), find(y if two is None else len(one) + y)
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


def intersections(one: list[np.ndarray], two: list[np.ndarray], i: np.ndarray, j: np.ndarray, wide: int = 8192) -> np.ndarray:
    """Sizes of the intersections of the sets one[i] and two[j], all from products of incidence matrices, ``wide`` columns at a time."""
    rows, cols = np.unique(i), np.unique(j)
    a, b = [one[k] for k in rows.tolist()], [two[k] for k in cols.tolist()]
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    total = np.zeros((len(rows), len(cols)), np.float32)
    at_a, at_b = ([np.searchsorted(shared, s[np.isin(s, shared, assume_unique=True)]) for s in side] for side in (a, b))
    for k in range(0, len(shared), wide):
        left, right = (np.zeros((len(side), wide), np.float32) for side in (a, b))
        for m, where in ((left, at_a), (right, at_b)):
            for r, w in enumerate(where):
                lo, hi = np.searchsorted(w, (k, k + wide))
                m[r, w[lo:hi] - k] = 1
        total += left @ right.T
    return total[np.searchsorted(rows, i), np.searchsorted(cols, j)].astype(np.int64)


def candidate_links(rows: DataFrame, docs: DataFrame, scheme: Scheme, id_col: str, text_col: str, keep: Tables, block: int = 256) -> DataFrame:
    """Links (a, b: digests) between classes, from ``rows`` of ``sketch`` and their texts; read them while ``keep`` holds."""
    reps = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("at"), F.first("keys").alias("keys"))
    keys = reps.select(F.explode("keys").alias("key"), "digest")
    several = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("digest").alias("low")).where("n > 1")
    edges = keep(keys.join(several, "key").select("key", "digest", "low"), "edges")
    # Candidates near one another get one home: the least class over their buckets, and over those buckets' classes.
    home = edges.groupBy("digest").agg(F.min("low").alias("home"))
    for _ in range(2):
        low = edges.join(home, "digest").groupBy("key").agg(F.min("home").alias("low2"))
        home = edges.join(low, "key").groupBy("digest").agg(F.min("low2").alias("home"))
    home = keep(home, "home")
    salts = home.groupBy("home").agg(F.ceil(F.count("*") / block).alias("salts"))
    member = keep(home.join(salts, "home").select("digest", F.struct("home", F.pmod(F.xxhash64("digest"), "salts").alias("salt")).alias("block")), "member")
    at = edges.join(member, "digest").select("key", "block").distinct()
    pairs = at.alias("x").join(at.alias("y"), F.expr("x.key = y.key and x.block <= y.block")).select(F.col("x.block").alias("one"), F.col("y.block").alias("two")).distinct()
    sides = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    units = sides.join(member, "block").join(reps.select("digest", F.col("at.doc_id").alias("of_doc"), F.col("at.row").alias("of_row")), "digest")
    units = keep(units.select("one", "two", (F.col("block") == F.col("one")).alias("first"), "digest", "of_doc", "of_row"), "units")
    text = docs.select(docs[id_col].alias("doc_id"), row_key(docs[text_col]).alias("row"), docs[text_col].alias("text"))
    text = text.where(sift(units, "of_row")(F.col("row")))  # texts that are no candidate's aren't shuffled
    # Of equal texts without an id one is enough.
    text = text.where("doc_id IS NOT NULL").unionByName(text.where("doc_id IS NULL").dropDuplicates(["row"]))
    full = text.join(units.hint("shuffle_hash"), F.expr("doc_id <=> of_doc AND row = of_row")).select("one", "two", "first", "digest", "text")

    def run(table: pa.Table) -> pa.Table:
        own = {}
        for first, digest, t in zip(*(table.column(c).to_pylist() for c in ("first", "digest", "text"))):
            if digest not in own:
                s = scheme.shingles(t)
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == digest:  # else another text of this doc_id and hash
                    own[digest] = (first, s)
        within = all(first for first, _ in own.values())
        one = [d for d, (first, _) in own.items() if first]
        two = one if within else [d for d, (first, _) in own.items() if not first]
        found = linked(scheme, [own[d][1] for d in one], None if within else [own[d][1] for d in two]) if one else []
        return pa.table({"a": pa.array([one[i] for i, _ in found], pa.binary()), "b": pa.array([two[j] for _, j in found], pa.binary())})

    ship(docs.sparkSession)
    return full.groupBy("one", "two").applyInArrow(run, "a binary, b binary")


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) of each node in ``links`` (a, b), root being the least node that it is joined with; by alternating large and small stars."""

    def canonical(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    edges, before = cut(canonical(links.select(F.col("a").alias("u"), F.col("b").alias("v")))), None
    for _ in range(most):
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", "low"))
        edges = cut(canonical(small))
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(docs: DataFrame, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, row, n_shingles, component_id, root (of the row's group of linked texts; null for empty sets)."""
    with Tables(docs.sparkSession) as keep:
        rows = keep(sketch(docs, scheme, id_col, text_col), "sketch")
        links = keep(candidate_links(rows, docs, scheme, id_col, text_col, keep), "links")
        roots = components(links)
        classes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("low"))
        placed = classes.join(roots, F.col("digest") == F.col("node"), "left").select("digest", "low", F.coalesce("root", "digest").alias("root"))
        ids = placed.groupBy("root").agg(F.min("low").alias("component_id"))
        known = keep(placed.join(ids, "root").select("digest", "root", "component_id"), "known")
        out = rows.drop("keys").join(known, "digest", "left")
        component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return cut(out.select("doc_id", "row", "n_shingles", component.alias("component_id"), "root"))


def near_duplicates(docs: DataFrame, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the least doc_id that is reachable over links, kept whether it is the row's own. Texts without words, and
    null texts, have empty sets and link with nothing. A text of fewer words than a shingle is one shingle. Rows that
    repeat a doc_id are judged by their own texts; null ids never become a component's id unless all are null (then
    component_id is null and all are kept). Empty tables give empty ones; other columns aren't read.
    """
    out = grouped(docs, scheme, id_col, text_col).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("doc_id", id_col)


#: The contract's rows, from all pairs of texts that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.m = e.x),
c AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""
