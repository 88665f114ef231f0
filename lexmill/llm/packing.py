"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

The plan never sees documents. Lengths of pieces are at most ``capacity``, so their histogram
has at most ``capacity`` rows whatever the corpus holds; best-fit decreasing runs over those
counts, placing a whole count of equal pieces into a whole group of equal bins at once. What
it yields are runs of slots: pieces of one length, from one rank on, go to consecutive
sequences at one offset. The documents then take the planned slots by joining on the rank
within their length. Ranks are dealt by (length, salt), as many salts as the length's count
asks for, so a length that a third of all pieces have is ranked by many tasks.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mapped, rows_of

#: A run of slots: piece number ``rank`` of ``length`` is in sequence
#: first_sequence + (rank - first_rank) div per_bin, at first_offset + (rank - first_rank) mod per_bin * length.
RUN = "length long, first_rank long, n long, first_sequence long, per_bin long, first_offset long"


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs of slots as in RUN.

    Each length splits at most one group of bins and opens at most two, so there are at most
    3 * capacity groups; a bin takes at most sqrt(2 * capacity) different lengths. So the plan's
    size is bounded by the capacity alone.
    """
    groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first sequence, number)
    runs, bins = [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        left, rank = counts[length], 0

        def place(first: int, room: int, n: int) -> int:
            """n bins with ``room`` take what is left of this length, each as many as fit; returns how many pieces are placed."""
            each = room // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            if full:
                runs.append((length, rank, full * each, first, each, capacity - room))
                groups[room - each * length].append((first, full))
            if rest:
                runs.append((length, rank + full * each, rest, first + full, rest, capacity - room))
                groups[room - rest * length].append((first + full, 1))
            if full + bool(rest) < n:
                groups[room].append((first + full + bool(rest), n - full - bool(rest)))
            return full * each + rest

        for room in range(length, capacity + 1):
            if not left:
                break
            taken, groups[room] = groups[room], []
            while taken:
                first, n = taken.pop()
                if not left:
                    groups[room].append((first, n))
                    continue
                done = place(first, room, n)
                left, rank = left - done, rank + done
        if left:
            n = -(-left // (capacity // length))
            place(bins, capacity, n)
            bins += n
    return runs


#: Below it, letters are composed and have one small letter each (but for one, whose small form isn't a letter alone).
LATIN_END = "\u0250"
#: The byte alphabet of byte-level BPE: printable bytes stand for themselves, the others for characters from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = dict(zip(_PLAIN, map(chr, _PLAIN))) | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class ChunkIds(dict):
    """Ids, as little-endian unsigned 32-bit, of chunks between spaces and newlines.

    At most ``memo`` chunks are remembered in each of two generations, so that frequent ones outlive a renewal.
    A chunk of letters and one mark is a word's ids and the mark's, since pre-tokens end where letters do. A chunk of
    Latin letters alone is one pre-token, which its lower case and the byte alphabet make ready for the model's merges.
    """

    def __init__(self, path: str, memo: int, longest: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.memo, self.longest, self.old = Tokenizer.from_file(path), memo, longest, {}
        self[""] = b""

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.old.get(chunk)) is None:
            if chunk.isalpha() and max(chunk) < LATIN_END and (word := chunk.lower()).isalpha():
                found = self.tok.model.tokenize(word if word.isascii() else "".join(map(BYTES.__getitem__, word.encode())))
                ids = b"".join([t.id.to_bytes(4, "little") for t in found])
            elif len(chunk) > 1 and chunk[-1] in ".,;:!?" and (word := chunk[:-1]).lower().isalpha() and max(word) < LATIN_END:
                ids = self[word] + self[chunk[-1]]
            else:
                ids = b"".join([i.to_bytes(4, "little") for i in self.tok.encode_batch_fast([chunk], add_special_tokens=False)[0].ids])
        if len(chunk) <= self.longest:
            if len(self) >= self.memo:
                self.old = dict(self)
                self.clear()
                self[""] = b""
            self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False, memo: int = 350_000, longest: int = 64) -> DataFrame:
    """Documents (doc_id, text) as pieces of at most ``capacity`` ids, each document ended by ``end_id``.

    ``tokenizer``: path of a ``tokenizers`` file whose pre-tokens hold no white space, end where letters do, and whose normaliser
    works inside white space, as word BPE does; then a text's ids are those of its chunks between
    spaces and newlines, and each different chunk is encoded once while it is remembered.
    """

    def run(batches):
        ids, end, size = ChunkIds(tokenizer, memo, longest), end_id.to_bytes(4, "little"), 4 * capacity
        for b in batches:
            out = []
            for doc, text in rows_of(b, "doc_id", "text"):
                all_ids = ids.of(text or "") + end
                for k in range(0, len(all_ids), size):
                    piece = all_ids[k : k + size]
                    out.append((doc, k // size, k // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None))
            cols = list(zip(*out)) if out else [()] * 6
            arrays = [pa.array(cols[0], b.schema.field("doc_id").type)] + [pa.array(c, pa.int64() if k else pa.int32()) for k, c in enumerate(cols[1:5])]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(cols[5], pa.binary())] * with_ids, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def assign(pieces: DataFrame, capacity: int, per_group: int = 50_000) -> DataFrame:
    """Pieces with a ``length`` in 1..capacity, plus sequence_id and offset; every row keeps its columns.

    ``pieces`` is read three times, so pass a materialised one. Which of equally long pieces takes which of
    their slots follows from (doc_id, piece); repeated rows take a slot each, ties in any order.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs = spark.createDataFrame(plan(counts, capacity) or [], RUN)
    salts = spark.createDataFrame([(k, -(-n // per_group)) for k, n in counts.items()], "length long, salts long")
    dealt = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts")))
    before = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = dealt.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("k"))
    slot = F.col("rank") - F.col("first_rank")
    placed = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))).drop(runs["length"])
    return placed.select(
        *(c for c in pieces.columns),
        (F.col("first_sequence") + F.floor(slot / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + slot % F.col("per_bin") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into few sequences of at most ``capacity`` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, little-endian
    unsigned 32-bit, if ``with_ids``). A null or empty text is the end id alone. Repeated rows are
    packed each; a null doc_id stays null; an empty table gives an empty one; other columns are dropped.
    """
    pieces = cut(cut_pieces(docs, tokenizer, capacity, end_id, with_ids))
    return assign(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id, n, ids (binary).

    A group is one sequence, so at most ``capacity`` ids.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), parts.alias("p")).select("sequence_id", "n", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
