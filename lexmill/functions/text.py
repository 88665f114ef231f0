"""Scalar functions and predicates over readings and surfaces. Everything is native but NFKC, which Spark lacks."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Katakana with a hiragana counterpart, and those: the blocks are 0x60 apart.
KATAKANA_LETTERS = "".join(map(chr, range(0x30A1, 0x30F7)))
HIRAGANA_LETTERS = "".join(chr(ord(c) - 0x60) for c in KATAKANA_LETTERS)
SEPARATORS = "・、。「」【】"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x.strip()).lower())


def nfkc(c: Column) -> Column:
    """Stripped, NFKC, lower-case. Printable ASCII is that already but for case and outer spaces, and takes no Python."""
    plain = c.rlike(r"\A[ -~]*\z")
    return F.when(plain, F.lower(F.trim(c))).otherwise(_nfkc(F.when(~plain, c)))


def to_hiragana(c: Column) -> Column:
    return F.translate(c, KATAKANA_LETTERS, HIRAGANA_LETTERS)


def normalize(c: Column) -> Column:
    return to_hiragana(nfkc(c))


def katakana_key(c: Column) -> Column:
    """``search_key`` of a text that ``is_katakana``: that is in NFKC already, so it takes no Python, and rows stay dealt as they are."""
    return F.translate(to_hiragana(c), SEPARATORS, "")


def search_key(c: Column) -> Column:
    """The key that a reading is found by: normalised, without separators."""
    return F.translate(normalize(c), SEPARATORS, "")


def is_supported_reading(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\A[ -~ぁ-ゖー]+\z"), F.lit(False))


def is_valid_surface(c: Column) -> Column:
    return F.coalesce((c != "") & (c != "*") & ~c.rlike(r"\p{Cc}"), F.lit(False))


def is_katakana(c: Column) -> Column:
    return c.rlike(r"\A[ァ-ヺー・ヽヾ]+\z")


def is_kana(c: Column) -> Column:
    return c.rlike(r"\A[ぁ-ゖァ-ヺー・ゝゞヽヾ]+\z")


def is_ascii(c: Column) -> Column:
    return c.rlike(r"\A\p{ASCII}*\z")


def is_okuri_key(c: Column) -> Column:
    """Kana, then one Latin letter, at the end."""
    return c.rlike(r"[ぁ-ゖー][a-z]\z")


def is_valid_dictionary_key(kind: Column, key: Column) -> Column:
    return (key != "") & ~key.rlike(r"[\s\p{Z}/;#\[\]]") & (is_okuri_key(key) == (kind == "ari"))


@lru_cache(maxsize=1)
def joining_class() -> str:
    """A character class of what forms one grapheme with what stands before it: marks by the Unicode version of this Python, as the JVM's own classes may know fewer, and a few others."""
    more = [(0x1F3FB, 0x1F3FF), (0x200C, 0x200D), (0xFF9E, 0xFF9F), (0xE0020, 0xE007F)]  # fixed values: skin tones, joiners, half-width voicing, tags
    joins = lambda c: unicodedata.category(chr(c)) in ("Mn", "Me", "Mc") or any(a <= c <= b for a, b in more)
    runs: list[list[int]] = []
    for c in filter(joins, range(sys.maxunicode + 1)):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]"


def joins_previous(c: Column) -> Column:
    """Whether the first character forms one grapheme with what stands before it. A first character below the first mark takes no search."""
    return (c >= F.lit("\u0300")) & c.rlike(rf"\A{joining_class()}")


def is_valid_candidate(c: Column) -> Column:
    return (c != "") & ~c.rlike(r"[/;#\[\]]") & ~c.startswith("(") & ~joins_previous(c)


def script_kind(c: Column) -> Column:
    """ascii, hiragana, katakana or null."""
    return F.when(is_ascii(c), "ascii").when(c.rlike(r"\A[ぁ-ゖー]+\z"), "hiragana").when(is_katakana(c), "katakana")


def unescape_code_points(c: Column) -> Column:
    """Escapes of four hexadecimal digits, or of any number in braces, behind a backslash and u, as their characters. One that names none, a surrogate or beyond the last code point, stays as it is written."""
    parts = F.split(F.regexp_replace(c, r"\\u(?:[0-9a-fA-F]{4}|\{[0-9a-fA-F]+\})", "\u0000$0\u0001"), "\u0000")

    def part(p: Column, k: Column) -> Column:
        return F.when(k == 0, p).otherwise(F.concat(F.get(F.transform(F.array(F.substring_index(p, "\u0001", 1)), named), F.lit(0)), F.substring_index(p, "\u0001", -1)))

    def named(written: Column) -> Column:
        # In a lambda nothing is shared, so that what is used often is an element of an array.
        return F.get(F.transform(F.array(F.ltrim(F.translate(written, "\\u{}", ""), F.lit("0"))), lambda h: F.when(is_code(h), of_code(h)).otherwise(written)), F.lit(0))

    def is_code(h: Column) -> Column:
        n = F.char_length(h)
        return F.when(n == 4, ~h.rlike("\\A[dD][89a-fA-F]")).when(n == 6, h.startswith("10")).otherwise(n < 6)

    def of_code(h: Column) -> Column:  # chr() stops at one byte; the mark of byte order in front lets one behind it stand
        return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(h, 8, "0"))), "UTF-32")

    return F.when(~c.contains("\\u"), c).otherwise(F.array_join(F.transform(parts, part), ""))
