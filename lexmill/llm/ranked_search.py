"""Ranked lexical search, score at a time over impact-ordered postings.

What a term adds to a document's score, its impact, is an integer that index time knows up to the term's weight. Documents are read once: each becomes a row of the
terms that any item asks for, with their occurrences. From chunks of such rows a task builds postings by term, in groups of
equal impact, highest first. An item's groups are then processed in descending order of what they add, over all its
terms; after each step the rest of a document's score is bounded by the sum of what its terms' next groups add. Once no document that
hasn't been met can reach the k-th best score, only those that still can are completed, term by term, and the exact best k
are what the chunk yields. The k-th score that a task has found is where its next chunk starts. Nothing is cut off: a chunk's own best k hold all of
its documents that are among the best k of all.

Items are worked through in blocks of bounded size, so that what tasks are given doesn't grow with their number; each block reads the documents once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, cut, mapped, rows_of

#: Bytes as they are in terms: other bytes are spaces, A-Z small.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: A block of items has about so many bytes of text, unless one item is longer.
BLOCK = 4 << 20
#: A chunk of documents ends at so many postings or documents.
POSTINGS, DOCUMENTS = 1 << 21, 1 << 16
#: A step goes down to this share of the highest impact that is left.
STEP = 0.6
_SALTS = 64


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def rows_of_terms(docs: DataFrame, place: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n (terms with repeats), terms (numbers by ``place``), counts of each row that has a term."""

    def run(batches):
        wanted = place.keys()
        for b in batches:
            kind, ids, ns, terms, counts = b.schema.field("id").type, [], [], [], []
            for i, raw in rows_of(b, "id", "raw"):
                if words := terms_of(raw or b""):
                    c = Counter(words)
                    hits = wanted & c.keys()
                    ids.append(i)
                    ns.append(len(words))
                    terms.append([place[w] for w in hits])
                    counts.append([c[w] for w in hits])
            many = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(ns, pa.int64()), pa.array(terms, many), pa.array(counts, many)], ["id", "n", "terms", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("raw")), run, f"id {kind}, n long, terms array<int>, counts array<int>")


class Chunk:
    """The postings of some documents: by term, highest impact first; and by term and document, to complete scores."""

    def __init__(self, order: np.ndarray, n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, documents: int, total: int):
        self.order = order  # of the documents' ids, nulls last
        doc = np.repeat(np.arange(len(n), dtype=np.int64), lengths)
        m = 50 + (50 * n * documents) // max(total, 1)
        tf = counts.astype(np.int64)
        s = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        by = np.lexsort((-s, terms))
        self.doc, self.s = doc[by], s[by]
        self.down = -self.s
        self.terms, start = np.unique(terms[by], return_index=True)
        self.start = np.r_[start, len(by)]
        self.acc = np.zeros(len(n), np.int64)
        self.by_doc: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, term: int) -> tuple[int, int]:
        k = int(np.searchsorted(self.terms, term))
        return (int(self.start[k]), int(self.start[k + 1])) if k < len(self.terms) and self.terms[k] == term else (0, 0)

    def _sorted(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """A term's postings in the order of documents."""
        if lo not in self.by_doc:
            by = np.argsort(self.doc[lo:hi])
            self.by_doc[lo] = self.doc[lo:hi][by], self.s[lo:hi][by]
        return self.by_doc[lo]

    def best(self, item: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the best k for an item (term, weight) whose score is at least ``floor`` and above 0; equal scores by id."""
        lists = [[w, *self.of(t)] for t, w in item]
        lists = [[w, lo, hi, lo] for w, lo, hi in lists if w > 0 and lo < hi]  # weight, first, end, next
        floor, acc, found = max(floor, 1), self.acc, np.zeros(0, np.int64)
        ahead = np.array([w * int(self.s[lo]) for w, lo, _, _ in lists], np.int64)  # what each term's next group adds
        while ahead.any() and (rest := int(ahead.sum())) >= floor:
            level = int(STEP * int(ahead.max()))
            for j in np.flatnonzero(ahead >= max(level, 1)).tolist():
                w, lo, hi, at = lists[j]
                least = max(-(-level // w), 1)  # whole groups: all postings of w * s >= level
                end = at + int(np.searchsorted(self.down[at:hi], -least, side="right"))
                acc[self.doc[at:end]] += w * self.s[at:end]  # a term has a document once
                lists[j][3] = end
                ahead[j] = w * int(self.s[end]) if end < hi else 0
            found = np.flatnonzero(acc)
            if len(found) >= k:
                floor = max(floor, int(np.partition(acc[found], len(found) - k)[len(found) - k]))
        # No other document can get as far as ``floor``. Those that can are completed by the terms with most ahead first.
        rest = int(ahead.sum())
        open_ = found[acc[found] + rest >= floor]
        score = acc[open_]
        for j in np.argsort(-ahead, kind="stable").tolist():
            w, lo, hi, at = lists[j]
            if at < hi and len(open_):
                docs, s = self._sorted(lo, hi)
                where = np.minimum(np.searchsorted(docs, open_), len(docs) - 1)
                add = np.where(docs[where] == open_, w * s[where], 0)
                # What has been counted already isn't counted again: groups from the next one on only.
                add[add > int(ahead[j])] = 0
                score += add
                rest -= int(ahead[j])
                on = score + rest >= floor
                open_, score = open_[on], score[on]
                if len(score) >= k:
                    floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
        acc[found] = 0
        by = np.lexsort((self.order[open_], -score))[:k]
        by = by[score[by] > 0]
        return open_[by], score[by]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, postings, rows = [], 0, 0
    for b in batches:
        held.append(b)
        postings, rows = postings + len(b.column(b.schema.get_field_index("terms")).flatten()), rows + b.num_rows
        if postings >= POSTINGS or rows >= DOCUMENTS:
            yield pa.Table.from_batches(held)
            held, postings, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def candidates(rows: DataFrame, items: list[list[tuple[int, int]]], documents: int, total: int, k: int) -> DataFrame:
    """item (its number), id, score: of each chunk of ``rows_of_terms``, the best k documents of each item."""

    def run(batches):
        floors = [1] * len(items)
        for table in _chunks(batches):
            table = table.combine_chunks()
            ids = table["id"].combine_chunks()
            flat = lambda c: table[c].combine_chunks().flatten().to_numpy()
            order = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
            lengths = pc.list_value_length(table["terms"]).to_numpy()
            chunk = Chunk(order, table["n"].to_numpy(), lengths, flat("terms"), flat("counts"), documents, total)
            for j, item in enumerate(items):
                docs, score = chunk.best(item, k, floors[j])
                if len(docs):
                    if len(docs) == k:
                        floors[j] = max(floors[j], int(score[-1]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), j, np.int32)), ids.take(pa.array(docs)), pa.array(score)], ["item", "id", "score"])

    return mapped(rows, run, f"item int, id {rows.schema['id'].dataType.simpleString()}, score long")


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(items: DataFrame, docs: DataFrame, k: int = 50, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: for each item, the k documents of highest score above 0, equal scores by ascending id (nulls last).

    Terms are runs of letters, digits and characters beyond ASCII, A-Z counted as a-z; an item's terms count once. Items that share an id are one, a null one
    too; items without terms, and null texts, have no rows. Documents that repeat an id are rows of their own and can appear
    both. Empty tables give empty ones; other columns aren't read.
    """
    spark = docs.sparkSession
    asked = items.select(items[item_col].alias("item"), F.coalesce(items[item_text], F.lit("")).cast("binary").alias("raw"))
    size = asked.agg(F.sum(F.length("raw"))).first()[0] or 0
    blocks = -(-size // BLOCK) or 1
    parts = [_search_block(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), docs, k, id_col, text_col) for b in range(blocks)]
    kinds = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    out = reduce(DataFrame.union, [p for p in parts if p is not None] or [spark.createDataFrame([], f"item {kinds[0]}, rank int, id {kinds[1]}, score long")])
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(asked: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame | None:
    spark, wanted = docs.sparkSession, {}
    for r in asked.collect():  # one block: about BLOCK bytes
        wanted.setdefault(r["item"], set()).update(terms_of(bytes(r["raw"])))
    if not (place := {t: j for j, t in enumerate(sorted(set().union(*wanted.values())))} if wanted else {}):
        return None
    with Tables(spark) as keep:
        rows = keep(rows_of_terms(docs, place, id_col, text_col), "rows")
        documents, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = {r["t"]: r["n"] for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}  # a row per term of the block
        names = sorted(wanted, key=repr)
        terms = [sorted((place[t], weight(documents, frequency[place[t]])) for t in wanted[i] if place[t] in frequency) for i in names]
        found = candidates(rows.where(F.size("terms") > 0), terms, documents, total, k)
        # The best of salted parts first, so that the last step has few rows an item, whatever the number of tasks.
        salted = _best(found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS))), k, "item", "salt").drop("rank", "salt")
        numbers = spark.createDataFrame([(j, i) for j, i in enumerate(names)], f"number int, item {asked.schema['item'].dataType.simpleString()}")
        best = cut(_best(salted, k, "item").withColumnRenamed("item", "number"))
        return best.join(F.broadcast(numbers), "number").select("item", F.col("rank").cast("int").alias("rank"), "id", "score")  # numbers: a block's items


#: The same rows from all terms.
ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL), lengths AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT item_id, term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), total),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM lengths, total),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM w JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 50
"""
