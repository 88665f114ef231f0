"""Token counts by a sentencepiece BPE model, with a whole-token shortcut.

A sentencepiece BPE model merges inside the whole text, after each space has become U+2581 and
one U+2581 has been put in front. If no piece of the vocabulary holds U+2581 behind another
character, no merge crosses the place before a U+2581, so a text falls into pre-tokens
(U+2581 and the characters up to the next one) that are encoded alone. ``Shortcut.prove``
checks that on the vocabulary, and asks the library itself, once and offline, which strings
of the vocabulary come back as exactly one token: a pre-token among those counts one, by one
lookup. Only the rest is merged, each different one once while it stays in a bounded memo.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, rows_of

SPACE = "▁"


def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@dataclass(frozen=True)
class Shortcut:
    """whole: pre-tokens without their U+2581 that are one token. split: pre-tokens can be encoded alone."""

    whole: frozenset[str]
    split: bool

    @classmethod
    def prove(cls, path: str) -> Shortcut:
        sp = processor(path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        plain = "".join(sp.encode("a b", out_type=str)) == f"{SPACE}a{SPACE}b" and "".join(sp.encode("  ", out_type=str)) == SPACE * 3
        if not plain or any(SPACE in p.lstrip(SPACE) for p in pieces):
            return cls(frozenset(), False)
        words = [p[1:] for p in pieces if p.startswith(SPACE) and SPACE not in p[1:] and len(p) > 1]
        return cls(frozenset(w for w, ids in zip(words, sp.encode(words, num_threads=1)) if len(ids) == 1 and sp.id_to_piece(ids[0]) == SPACE + w), True)


class Counter:
    """Counts tokens of texts; ``memo`` bounds how many merged pre-tokens are remembered."""

    def __init__(self, path: str, shortcut: Shortcut, memo: int = 400_000, longest: int = 64):
        self.sp, self.shortcut, self.memo, self.longest = processor(path), shortcut, memo, longest
        self._forget()

    def _forget(self) -> None:
        self.known = dict.fromkeys(self.shortcut.whole, 1)

    def __call__(self, text: str) -> int:
        # Runs of spaces, and spaces at the ends, make pre-tokens of several U+2581: those texts go through the library.
        if not text or not self.shortcut.split or SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            return len(self.sp.encode(text)) if text else 0
        parts = text.split(" ")
        if rest := list(set(parts).difference(self.known)):
            found = dict(zip(rest, map(len, self.sp.encode(rest, num_threads=1))))
            if len(rest) + len(self.known) > self.memo:
                self._forget()
            kept = {w: n for w, n in found.items() if len(w) <= self.longest}
            self.known.update(kept)
            if len(kept) < len(found) or any(w not in self.known for w in parts):
                return sum(found[w] if w in found else self.known[w] if w in self.known else len(self.sp.encode(w)) for w in parts)
        return sum(map(self.known.__getitem__, parts))


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: the id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``model``: path of a sentencepiece model that every executor can open. Counts are those of
    ``SentencePieceProcessor.encode`` without begin or end tokens. A null text counts as empty
    (0 bytes, 0 tokens), a null id stays null; repeated rows each give a row; an empty table
    gives an empty one; other columns of ``docs`` are not read. One narrow pass, no shuffle.
    """
    shortcut = docs.sparkSession.sparkContext.broadcast(Shortcut.prove(model))  # at most the vocabulary

    def run(batches):
        count = Counter(model, shortcut.value)
        for b in batches:
            out = [(i, len(t.encode("utf-8", "surrogatepass")), count(t)) for i, t in ((i, t or "") for i, t in rows_of(b, "id", "text"))]
            ids, n_bytes, n_tokens = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field("id").type), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
