"""Fill-in-the-middle by bit-parallelism on big integers.

A text's UTF-8 bytes are translated to two masks, one bit a byte with the first byte highest: letters, and bytes that
begin a code point. A unit is a run of letters or one other code point, so a unit begins where a code point begins, unless it is a
letter behind a letter: a shift and two boolean operations mark all of those at once. ``bit_count`` gives their
number, and the place of the k-th one is found by halving: the upper half's count says in which half it lies.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, rows_of

_LETTER = bytes(49 if chr(b).isalpha() and b < 128 else 48 for b in range(256))
_HEAD = bytes(48 if b & 0xC0 == 0x80 else 49 for b in range(256))
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: What stands before the parts: prefix, suffix, middle.
MARKS = (b"<P>", b"<S>", b"<M>")
#: Rows go back to Spark in batches of about so many bytes.
_FLUSH = 8 << 20


def boundaries(raw: bytes) -> tuple[int, int]:
    """(where units begin, where code points begin) as bit masks of len(raw) bits, the first byte's bit highest."""
    if not raw:
        return 0, 0
    letters, heads = int(raw.translate(_LETTER), 2), int(raw.translate(_HEAD), 2)
    return heads & ~(letters & (letters >> 1)), heads


def select(mask: int, width: int, k: int) -> int:
    """How many bits stand before the k-th (from 0) set one of a mask of ``width`` bits, from the highest on; ``width`` if there are k only."""
    at = 0
    while width > 1:
        low = width >> 1
        high = mask >> low
        n = high.bit_count()
        if k < n:
            mask, width = high, width - low
        else:
            k, at, mask, width = k - n, at + width - low, mask & ((1 << low) - 1), low
    return at if width and k < mask else at + width


@dataclass(frozen=True)
class Cut:
    n: int
    start: int  #: of the middle, in bytes
    end: int
    prefix_chars: int
    middle_chars: int


def cut_at(raw: bytes, first: int, second: int) -> Cut:
    """The prefix ends after the smaller of first % (n+1) and second % (n+1) units, the middle after the larger."""
    units, heads = boundaries(raw)
    n, width = units.bit_count(), len(raw)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    start = select(units, width, low)
    end = start if high == low else select(units, width, high)
    before = lambda p: (heads >> (width - p)).bit_count()
    return Cut(n, start, end, before(start), before(end) - before(start))


def draws(doc_id, seed: int = 1) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from a document's id; a null id counts as empty text."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[k : k + 4], "big") for k in (0, 4, 8, 12))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain: int = 10, suffix_first: int = 20) -> DataFrame:
    """One row per row of ``docs``: the id, n (units), form, output (text), prefix_chars, middle_chars (code points; null if plain).

    plain: of 100 documents, how many stay as they are; suffix_first: of 100 others, how many get the suffix first. Empty and null texts,
    and those that hold a mark, are plain, so each output can be undone (``restored``). Rows that repeat an id are drawn alike. Empty tables
    give empty ones; other columns aren't read.
    """

    def made(i, raw: bytes) -> tuple:
        h1, h2, h3, h4 = draws(i, seed)
        c = cut_at(raw, h1, h2)
        if not raw or h3 % 100 >= 100 - plain or any(m in raw for m in MARKS):
            return c.n, PLAIN, raw, None, None
        prefix, middle, suffix = raw[: c.start], raw[c.start : c.end], raw[c.end :]
        p, s, m = MARKS
        spm = h4 % 100 < suffix_first
        return c.n, SPM if spm else PSM, b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)), c.prefix_chars, c.middle_chars

    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64())

    def run(batches):
        for b in batches:
            kind, ids, rows, size = b.schema.field("id").type, [], [], 0

            def out():
                cols = list(zip(*rows)) or [()] * 5
                return pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["id", "n", "form", "output", "prefix_chars", "middle_chars"])

            for i, raw in rows_of(b, "id", "raw"):
                ids.append(i)
                rows.append(made(i, raw))
                size += len(raw)
                if size > _FLUSH:
                    yield out()
                    ids, rows, size = [], [], 0
            yield out()

    kind = docs.schema[id_col].dataType.simpleString()
    raw = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("raw"))
    found = mapped(raw, run, f"id {kind}, n long, form string, output binary, prefix_chars long, middle_chars long")
    return found.select(F.col("id").alias(id_col), "n", "form", F.col("output").cast("string").alias("output"), "prefix_chars", "middle_chars")


def restored(output: Column, form: Column) -> Column:
    """The text from which an output was made. Marks are there once each, since a text that holds one stays plain."""
    parts = F.split(output, "<[PSM]>")
    order = {PSM: (1, 3, 2), SPM: (2, 3, 1)}
    joined = {k: F.concat(*(F.get(parts, F.lit(i)) for i in v)) for k, v in order.items()}
    return F.when(form == PSM, joined[PSM]).when(form == SPM, joined[SPM]).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """``transform`` with the digests of outputs and of the texts rebuilt from them, instead of texts."""
    found = transform(docs)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


#: The same rows by lists of units.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid, coalesce(array_to_string(w[b + 1:], ''), '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
