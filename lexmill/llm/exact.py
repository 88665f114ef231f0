"""Exact dedup by a tree-merge of sorted digest runs.

Each partition turns its texts into runs: a row per digest, sorted, with the number of rows, and of these the best one (most code
points, then least id). Partitions then exchange runs in rounds, as in a k-nomial tree: there are FAN^R slots, a slot is a
number of R digits in base FAN, and in round r those that differ in the r-th digit only exchange with one another, each taking the
digests whose own r-th digit is its. Spark's external sort merges the runs that meet, and equal digests become one row again, at every level. After R
rounds each digest is in one slot, with its totals. A digest that a third of all rows share is one row of each
run at most, so no slot gets more than the others.

Runs are sorted by the first 64 bits of the digest; rows are taken for equal only if all 256 bits and the length of the normalised text agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, cut, mapped, rows_of, sift

#: Partitions that exchange with one another in a round; a power of 2.
FAN = 4
#: Rows of a run that a partition sorts in memory; larger partitions have several runs.
RUN = 1 << 17
_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_COLUMNS = ("slot", "short", "digest", "size", "chars", "unknown", "id", "row", "n")


def _schema(kind: str) -> str:
    return f"slot int, short long, digest binary, size long, chars long, unknown boolean, id {kind}, row long, n long"


def digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row (a number), mark (hash of the text), chars (code points), size (bytes of the normalised text), digest of each row; to be stored, for the numbers to stay."""

    def run(batches):
        for b in batches:
            out = []
            for raw in b.column(b.schema.get_field_index("raw")):
                raw = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                bare = raw.translate(None, _SPACE)
                out.append((len(raw.translate(None, _CONTINUED)), len(bare), hashlib.sha256(bare).digest()))
            cols = list(zip(*out)) or [()] * 3
            kept = [b.column(b.schema.get_field_index(c)) for c in ("id", "mark")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary())))], ["id", "mark", "chars", "size", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    raw = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("mark"), docs[text_col].cast("binary").alias("raw"))
    return mapped(raw, run, f"id {kind}, mark long, chars long, size long, digest binary").withColumn("row", F.monotonically_increasing_id())


def better(a: tuple, b: tuple) -> bool:
    """Of two rows (size, chars, unknown, id, row, n) of equal texts: whether a stays. More code points, then the least id (nulls last), then the first row."""
    if a[1] != b[1]:
        return a[1] > b[1]
    if a[2] != b[2]:
        return b[2]
    if not a[2] and a[3] != b[3]:
        return a[3] < b[3]
    return a[4] < b[4]


def merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (short, digest, size, chars, unknown, id, row, n) in the order of (short, digest): one per text, with the best row and the sum of n.

    Only digests that agree in ``short`` are held against one another in full.
    """
    last = None
    for row in rows:
        if last is not None and last[0] == row[0] and last[1] == row[1]:
            if last[2] != row[2]:
                raise ValueError("two texts of different lengths share a digest")
            best = row if better(row[2:], last[2:]) else last
            last = (*best[:7], last[7] + row[7])
        else:
            if last is not None:
                yield last
            last = row
    if last is not None:
        yield last


def _batches(rows: Iterator[tuple], kind: pa.DataType, slot) -> Iterator[pa.RecordBatch]:
    types = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), kind, pa.int64(), pa.int64())
    some: list[tuple] = []

    def out() -> pa.RecordBatch:
        cols = list(zip(*some)) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], list(_COLUMNS))

    for row in rows:
        some.append((slot(row[0]), *row))
        if len(some) == 1 << 14:
            yield out()
            some.clear()
    yield out()


def runs(rows: DataFrame, slots: int) -> DataFrame:
    """The sorted runs of each partition of ``digested`` rows, in the slots that the partitions have."""
    to = _next_slot(0, slots)

    def run(batches):
        from pyspark import TaskContext

        own, held = TaskContext.get().partitionId() % slots, []
        short = lambda d: int.from_bytes(d[:8], "big", signed=True)

        def one_run():
            held.sort(key=lambda r: (r[0], r[1]))
            kind = b.schema.field("id").type
            yield from _batches(merged(iter(held)), kind, lambda s: to(own, s))
            held.clear()

        for b in batches:
            held += [(short(d), d, size, chars, i is None, i, row, 1) for i, row, chars, size, d in rows_of(b, "id", "row", "chars", "size", "digest")]
            if len(held) >= RUN:
                yield from one_run()
        if held:
            yield from one_run()

    return mapped(rows.select("id", "row", "chars", "size", "digest"), run, _schema(rows.schema["id"].dataType.simpleString()))


def _next_slot(done: int, slots: int):
    """(own slot, short digest) to the slot after round ``done``: the own one with that digit of the digest's."""
    bits, rounds = FAN.bit_length() - 1, _rounds(slots)
    at = bits * (rounds - 1 - done)
    mask = (FAN - 1) << at
    total = bits * rounds

    def to(own: int, short: int) -> int:
        top = (short & (2**64 - 1)) >> (64 - total)
        return (own & ~mask) | (top & mask)

    return to


def _rounds(slots: int) -> int:
    return (slots.bit_length() - 1) // (FAN.bit_length() - 1)


def exchanged(run: DataFrame, done: int, slots: int) -> DataFrame:
    """One round: rows go to the slot that they name, are merged there, and name the slot of the next round."""
    last = done + 1 == _rounds(slots)
    to = (lambda own, short: own) if last else _next_slot(done + 1, slots)

    def work(batches):
        from pyspark import TaskContext

        own, kind = TaskContext.get().partitionId(), None

        def rows():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("id").type
                yield from rows_of(b, *_COLUMNS[1:])

        found = merged(rows())
        for first in found:
            def again(first=first):
                yield first
                yield from found

            yield from _batches(again(), kind, lambda s: to(own, s))

    kind = run.schema["id"].dataType.simpleString()
    dealt = run.repartitionById(slots, F.col("slot")).sortWithinPartitions("short", "digest")
    return mapped(dealt, work, _schema(kind))


def groups(rows: DataFrame, slots: int | None = None) -> DataFrame:
    """short, digest, size, chars, id, row (of the row that stays), n of each text in ``digested`` rows."""
    wanted = slots or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = FAN
    while slots < wanted:
        slots *= FAN
    found = runs(rows, slots)
    for done in range(_rounds(slots)):
        found = exchanged(found, done, slots)
    return found.drop("slot", "unknown")


def judged(docs: DataFrame, keep: Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, mark, keep_id, group_size, kept, digest of each row; to be used while ``keep`` holds."""
    rows = keep(digested(docs, id_col, text_col), "rows")
    # Most texts are there once; only what several rows share is joined. A text is there once, so no hashed side has a hot key.
    shared = keep(groups(rows).where("n > 1").select("digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), "n"), "shared")
    found = rows.join(shared.hint("shuffle_hash"), "digest", "left")
    alone = F.col("n").isNull()
    return found.select(
        "id", "mark", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "digest",
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, keep_id, group_size, kept, text_sha256 (of the text without white space).

    Of equal texts that with the most code points, then the least id, stays; ids that are null stand behind all others, and of rows alike in
    both one stays. keep_id is null if only rows without an id are the longest. Null texts count as empty, and all texts without words are equal. Empty
    tables give empty ones; other columns aren't read.
    """
    with Tables(docs.sparkSession) as keep:
        found = judged(docs, keep, id_col, text_col)
        return cut(found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns, whatever their names. Texts are shuffled only where a row may have to go."""
    with Tables(docs.sparkSession) as keep:
        found = judged(docs, keep, id_col, text_col).where("group_size > 1")
        known = cut(found.groupBy(F.col("id").alias("of_id"), F.col("mark").alias("of_mark")).agg(F.max("kept").alias("stays")))
    unsure = sift(known, "of_id", "of_mark")("id", "mark")
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("mark"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"))
    fits = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark"))
    held = rows.where(unsure).join(known.hint("shuffle_hash"), fits, "left").where(F.coalesce("stays", F.lit(True))).dropDuplicates(["id", "mark"])
    return rows.where(~unsure).select("all.*").unionByName(held.select("all.*"))


#: The same rows by grouping.
ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
