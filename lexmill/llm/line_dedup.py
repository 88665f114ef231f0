"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Lines of equal sets are one class, whose place is that of its first line by
(doc_id, line number). Words are ordered by rarity, and each class puts out only the first words of its set in that
order: two sets whose Jaccard similarity reaches the threshold share one of those (prefix filter). What meets on
a word is checked by sizes (length filter), by how many words can still follow in both (positional filter),
and by bits that bound how many words differ; what is left is verified on the whole sets. A line is removed if an earlier
line has the same set or links with it.

So a class needs one earlier class that links with it, not all of them, and pairs of classes are never written out as such.
A semi-join over the words first keeps those classes that can link with any other one at all, by the filters. The bits that
bound how many words differ are 64 for short sets, 128 from HALVED words on and 256 from QUARTERED on, so that long sets pass no more often
by chance than short ones, however many there are. From here on all sets have 256 bits. Classes that may link with an earlier one
are held against the two first classes of their words' buckets, and only the best candidate is verified. Who is still open meets the classes at ranks 0 to 15 of their buckets, then 16 to 127, and so on in growing blocks; whoever has
found an earlier link drops out, and the last block ends where the largest bucket of an open class does. No
bucket is capped, and no link that decides is lost.

Any total order of words gives the same result; rarity only keeps buckets small. It is counted over all
words in BUCKETS hash buckets, so the order is a table of fixed size. A word is from then on the long
(rarity level, hash), with 57 bits of hash; a class is known by 128 bits of its set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, cut, sift

BUCKETS = 1 << 16
#: A bucket is ranked in parts of about so many classes.
PART = 1 << 20
#: Longs of a wide sketch; a power of 2.
WIDE = 4
#: Sets of so many words have 128 and 256 bits in the first semi-join: 64 bits fill up with some 60 differing words, which long sets may have.
HALVED, QUARTERED = 64, 180
#: Ends of the first block of ranks; each next block ends at GROWTH times the last one's end.
BLOCK, GROWTH = 16, 8


def rarity(docs: DataFrame, text_col: str = "text") -> list[int]:
    """A level from 0 (rare) to 63 of each hash bucket of words, over all texts. Words are told apart by spaces alone: it is only an order."""
    counted = docs.select(F.explode(F.split(text_col, " ")).alias("w")).groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).agg(F.count("*").alias("n"))
    levels = [0] * BUCKETS
    for r in counted.collect():  # at most BUCKETS rows
        levels[r["bucket"]] = min(63, int(1.4 * math.log2(r["n"])))
    return levels


def _parts(word) -> Column:
    """Into how many parts a word's bucket is dealt: by the upper bound of its count that its level is."""
    return F.greatest(F.lit(1), F.ceil(F.pow(F.lit(2.0), (F.shiftright(word, 57) + 1) / 1.4) / PART)).cast("long")


def _words(line) -> Column:
    """Words of a line of ``_lines``, without a lambda or a pattern: split at each space, empty strings taken out."""
    return F.array_remove(F.split(line, " "), "")


def _set_of(line, levels: list[int]) -> Column:
    """The line's distinct words as longs, rarest first."""
    table = F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")  # folded to a constant, which plans print: hence levels, not what they are shifted to
    # Lambdas are interpreted, so each has as few steps as can be. A set known to hold no nulls is sorted as plain longs.
    as_long = lambda h: F.coalesce(F.call_function("shiftleft", table[h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")], F.lit(57)).bitwiseOR(F.shiftrightunsigned(h, 7)), F.lit(0).cast("long"))
    return F.sort_array(F.array_distinct(F.transform(F.transform(_words(line), lambda w: F.xxhash64(w)), as_long)))


def _flips(words) -> Column:
    """64 bits, each whether an odd number of words falls on it."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))))


def _bits(words, size) -> list[Column]:
    """parity of all words; half, quarter and both of long sets: of words with bit 6, bit 7, and both. Sets that differ in n words differ in at most n bits of the cells these make."""
    having = lambda words, bit: F.filter(words, lambda w: w.bitwiseAND(F.lit(bit)) > 0)
    return [
        _flips(words).alias("parity"), F.when(size >= HALVED, _flips(having(words, 64))).alias("half"),
        F.when(size >= QUARTERED, _flips(having(words, 128))).alias("quarter"), F.when(size >= QUARTERED, _flips(having(having(words, 128), 64))).alias("both"),
    ]


def _rows(docs: DataFrame, text_col: str, apart: bool) -> DataFrame:
    """doc_id, row, text, and all: the row as it came. ``row`` tells rows apart: of rows with an id their texts' hash, of others a number each.

    If not ``apart`` it is null: rows that share a doc_id, or have none, are one document.
    """
    base = docs.select("doc_id", F.col(text_col).alias("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"))
    if not apart:
        return base.withColumn("row", F.lit(None).cast("long"))
    known = base.withColumn("row", F.xxhash64("text"))
    nameless = cut(base.where("doc_id IS NULL").withColumn("row", F.monotonically_increasing_id()))  # the numbers have to stay
    return known if nameless.isEmpty() else known.where("doc_id IS NOT NULL").unionByName(nameless)


def _at() -> Column:
    """A line's place in the order. Rows that share a doc_id are one document; rows without one are a document each if they have a number."""
    return F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("row")).alias("own"), "line_no")


def _lines(rows: DataFrame) -> DataFrame:
    """doc_id, row, line_no, line, with spaces for other white space."""
    text = F.coalesce("text", F.lit(""))
    for c in ("\t", "\x0b", "\f", "\r"):
        text = F.replace(text, F.lit(c), F.lit(" "))
    return rows.select("doc_id", "row", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _class(words) -> list[Column]:
    return [F.xxhash64(words).alias("c1"), F.xxhash64(F.lit(1), words).alias("c2")]


def line_table(rows: DataFrame, levels: list[int], num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, row, line_no, c1 and c2 (the class), size, BITS, prefix of each line with words."""
    sets = _lines(rows).where(F.btrim("line") != "").select("doc_id", "row", "line_no", _set_of(F.col("line"), levels).alias("words"))
    size = F.size("words")
    least = F.floor((num * size + (den - 1)) / den).cast("int")  # the least overlap with any set: ceil(size * num / den)
    return sets.select("doc_id", "row", "line_no", *_class("words"), size.alias("size"), *_bits(F.col("words"), size), F.slice("words", 1, size - least + 1).alias("prefix"))


def first_lines(lines: DataFrame) -> DataFrame:
    """One row per class: id (any number), c1, c2, at (its first line's place), size, BITS, prefix. To be stored, for the ids to stay."""
    first = lines.groupBy("c1", "c2").agg(F.min(F.struct(_at().alias("at"), "size", *BITS, "prefix")).alias("f"))  # equal places hold equal lines
    return first.select(F.monotonically_increasing_id().alias("id"), "c1", "c2", "f.*")


#: Columns of ``_bits``.
BITS = ("parity", "half", "quarter", "both")


def _at_least() -> str:
    """Of two rows x and y: the least number of words that differ, by as many bits as both have."""
    count = lambda *names: f"bit_count({' ^ '.join(f'x.{n} ^ y.{n}' for n in names)})"
    four = " + ".join([count("both"), count("half", "both"), count("quarter", "both"), count(*BITS)])
    two = f"{count('half')} + {count('parity', 'half')}"
    return f"coalesce({four}, {two}, {count('parity')})"




def _can_link(num: int, den: int, differ: str) -> str:
    """Length, position and bits allow that the rows x and y of a bucket link."""
    both = "(x.size + y.size)"
    return (  # the cheap ones first
        f"{den} * x.size >= {num} * y.size AND {den} * y.size >= {num} * x.size AND {num + den} * least(x.size - x.pos, y.size - y.pos) >= {num} * {both}"
        f" AND {num + den} * ({both} - ({differ})) >= 2 * {num} * {both}"
    )


def _sketch() -> list[Column]:
    """WIDE times 64 bits of a set from its exploded words w, for all sizes: they tell nearly exactly how many words differ."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("w").bitwiseAND(F.lit(63)).cast("int"))
    cell = F.shiftright("w", 6).bitwiseAND(F.lit(WIDE - 1))
    return [F.bit_xor(F.when(cell == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"b{k}") for k in range(WIDE)]


def promising(classes: DataFrame, num: int, den: int) -> DataFrame:
    """word, id, size, pos of the prefixes' words on which a class can link with another one."""
    least = next(s for s in range(1, 10_000) if num * (s + 1) <= den * s)  # below, no other size is near enough
    index = classes.where(F.col("size") >= least).select("id", "size", *BITS, F.posexplode("prefix").alias("pos", "word"))
    return index.alias("x").join(index.alias("y"), F.expr(f"x.word = y.word AND x.id <> y.id AND {_can_link(num, den, _at_least())}"), "left_semi").drop(*BITS)


def _sets(ids: DataFrame, rows: DataFrame, levels: list[int]) -> DataFrame:
    """id, words of the classes in ``ids`` (id, c1, at) only, from one line each."""
    wanted = ids.select("id", "c1", F.col("at.doc_id").alias("of_doc"), F.col("at.own").alias("of_own"), F.col("at.line_no").alias("of_line"))
    own = F.when(F.col("doc_id").isNull(), F.col("row"))
    lines = _lines(rows).where(sift(wanted, "of_doc", "of_line", bits=21)("doc_id", "line_no"))  # before any shuffle
    found = lines.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("line_no") == F.col("of_line")) & own.eqNullSafe(F.col("of_own")))
    # Of rows that share a doc_id only one may have the class's line. A filter here would become a key of the join, for all lines.
    sets = found.select("id", "c1", _set_of(F.col("line"), levels).alias("words")).select("id", "c1", "words", F.xxhash64("words").alias("name"))
    return sets.groupBy("id").agg(F.first(F.when(F.col("name") == F.col("c1"), F.col("words")), ignorenulls=True).alias("words"))


def preceded(classes: DataFrame, rows: DataFrame, levels: list[int], keep: Tables, num: int = 4, den: int = 5) -> DataFrame:
    """c1, c2 of the classes that link with an earlier one."""
    hits = keep(promising(classes, num, den), "promising")
    places = keep(classes.select("id", "c1", "c2", "at"), "places")
    ids = keep(places.join(hits.select("id").distinct().hint("shuffle_hash"), "id"), "ids")
    # Classes at one place, of rows that share a doc_id, share their number: neither is earlier.
    order = ids.select("at").distinct().orderBy("at").select("at", F.monotonically_increasing_id().alias("ord"))
    order = keep(order, "order")
    sets = keep(_sets(ids, rows, levels), "sets")
    part = Window.partitionBy("word", F.pmod("id", _parts(F.col("word")))).orderBy("ord", "id")
    wide = sets.select("id", F.explode("words").alias("w")).groupBy("id").agg(*_sketch())
    numbered = ids.join(order.hint("shuffle_hash"), "at").select("id", "ord").join(wide, "id")
    ranked = keep(hits.join(numbered.hint("shuffle_hash"), "id").withColumn("rank", F.row_number().over(part) - 1), "ranked")
    keep.drop("promising", "order")
    differ = f"({' + '.join(f'bit_count(x.b{k} ^ y.b{k})' for k in range(WIDE))})"
    earlier = F.expr(f"x.word = y.word AND y.ord < x.ord AND {_can_link(num, den, differ)}")

    # Who has nothing before it that it may link with is done. In most buckets of the rest, the first two classes settle it.
    able = keep(ranked.alias("x").join(ranked.alias("y"), earlier, "left_semi"), "able")

    def verified(pairs: DataFrame) -> DataFrame:
        """id of the pairs (id, other) whose whole sets link."""
        both = pairs.join(sets.withColumnRenamed("words", "a"), "id").join(sets.select(F.col("id").alias("other"), F.col("words").alias("b")), "other")
        return keep(both.where((num + den) * F.size(F.array_intersect("a", "b")) >= num * (F.size("a") + F.size("b"))).select("id").distinct(), "verified")

    score = F.expr(f"struct({differ} / (x.size + y.size) AS score, y.id AS other)")
    best = able.alias("x").join(ranked.where("rank < 2").alias("y"), earlier).select("x.id", score.alias("best")).groupBy("id").agg(F.min("best").alias("best"))
    done = verified(keep(best.select("id", "best.other"), "pairs"))
    probes = keep(able.join(done, "id", "left_anti"), "probes")
    arena = keep(ranked.join(probes.select("word").distinct(), "word", "left_semi"), "arena")
    keep.drop("able", "ranked")
    low, high = 0, BLOCK
    while True:
        # Only who stands behind the block's start has anyone left to meet.
        most = probes.agg(F.max("rank").alias("r")).first()["r"]
        if most is None or (low and most <= low and not _dealt(arena, low)):
            return keep(ids.join(done, "id", "left_semi").select("c1", "c2"), "preceded")
        met = probes.alias("x").join(arena.where((F.col("rank") >= low) & (F.col("rank") < high)).alias("y"), earlier)
        more = verified(keep(met.select("x.id", F.col("y.id").alias("other")).distinct(), "pairs"))
        done, probes = done.union(more), keep(probes.join(more, "id", "left_anti"), "probes")
        low, high = high, GROWTH * high


def _dealt(ranked: DataFrame, low: int) -> bool:
    """Whether a bucket in parts has ranks from ``low`` on: there, a class's own rank doesn't say how many are before it."""
    return not ranked.where((_parts(F.col("word")) > 1) & (F.col("rank") >= low)).isEmpty()


@contextmanager
def judged(rows: DataFrame, num: int = 4, den: int = 5) -> Iterator[DataFrame]:
    """doc_id, row, line_no, c1, c2, near (an earlier line of another set links), removed of each line with words in ``rows`` of ``_rows``.

    To be used inside the block.
    """
    with Tables(rows.sparkSession) as keep:
        levels = rarity(rows)
        wide = keep(line_table(rows, levels, num, den), "wide")
        classes = keep(first_lines(wide), "classes")
        lines = keep(wide.select("doc_id", "row", "line_no", "c1", "c2"), "lines")
        keep.drop("wide")
        late = preceded(classes, rows, levels, keep, num, den).withColumn("near", F.lit(True))
        keep.drop("classes", "sets", "arena", "pairs", "ids", "verified", "probes")
        places = keep.read("places")
        # A class is there once, so that neither hashed side has a hot key.
        known = places.select("c1", "c2", F.col("at").alias("first")).join(late.hint("shuffle_hash"), ["c1", "c2"], "left")
        near = F.coalesce("near", F.lit(False))
        found = lines.withColumn("at", _at()).join(known.hint("shuffle_hash"), ["c1", "c2"])
        yield found.select("doc_id", "row", "line_no", "c1", "c2", near.alias("near"), (near | (F.col("first") < F.col("at"))).alias("removed"))


def line_report(docs: DataFrame, text_col: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """One row per doc_id of ``docs``: n_lines (with words), n_removed, n_near (lines that an earlier line of another set links with), removed_lines (numbers from 0, comma-joined).

    Lines without words aren't compared and never removed. Null texts have no lines. Rows that repeat a doc_id, or have
    none, are one document: their equal lines at one place count once, and neither is later than the other. Null ids come first.
    Empty tables give empty ones; other columns aren't read.
    """
    with judged(_rows(docs, text_col, apart=False), num, den) as found:
        lines = found.repartition("doc_id").dropDuplicates(["doc_id", "line_no", "c1", "c2"])  # one shuffle for this and the next
        numbers = F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("line_no"))))
        by_doc = lines.groupBy("doc_id").agg(
            F.count("*").alias("n_lines"), F.count_if("removed").alias("n_removed"), F.count_if("near").alias("n_near"), F.array_join(F.transform(numbers, lambda n: n.cast("string")), ",").alias("removed_lines")
        )
        by_doc = cut(by_doc)
    none = {"n_lines": 0, "n_removed": 0, "n_near": 0, "removed_lines": ""}
    return docs.select("doc_id").distinct().alias("i").join(by_doc.alias("b"), F.col("i.doc_id").eqNullSafe(F.col("b.doc_id")), "left").select("i.doc_id", *(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in none.items()))


def remove_lines(docs: DataFrame, text_col: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` with the removed lines taken out of their texts; all rows and columns stay, whatever their names, but for texts of which nothing is left.

    A row goes if it had lines with words and all are removed: its whole text is a repetition. Each row loses lines of its own
    only, also where others share its doc_id; rows without a doc_id are a document each, in the order they are read in.
    """
    rows = _rows(docs, text_col, apart=True)
    with judged(rows, num, den) as found:
        gone = cut(found.where("removed").groupBy(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row")).agg(F.collect_set("line_no").alias("gone")))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row") == F.col("of_row"))
    full = rows.join(gone.hint("shuffle_hash"), same, "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda _, k: ~F.array_contains("gone", k)), "\n")
    made = full.select("all", F.col("gone").isNotNull().alias("touched"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("left"))
    made = made.where(~F.col("touched") | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    return made.select(*(F.col("left").alias(c) if c == text_col else F.col(f"all.`{c}`") for c in docs.columns))


#: The same result from an inverted index of words.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), s AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS w FROM l
), lines AS (SELECT doc_id, line_no, w FROM s WHERE len(w) > 0),
classes AS (SELECT w, min((doc_id, line_no)) AS pos, row_number() OVER (ORDER BY w) AS id, len(w) AS n FROM lines GROUP BY w),
tokens AS (SELECT id, n, unnest(w) AS t FROM classes),
rare AS (SELECT t, count(*) AS f FROM tokens GROUP BY t),
ranked AS (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY f, t) AS k FROM tokens JOIN rare USING (t)),
prefix AS (SELECT id, n, t FROM ranked WHERE k <= n - ceil(4 * n / 5.0) + 1),
cand AS (SELECT DISTINCT x.id AS a, y.id AS b FROM prefix x JOIN prefix y ON x.t = y.t AND x.id < y.id AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
links AS (
  SELECT a, b FROM cand JOIN classes p ON p.id = a JOIN classes q ON q.id = b WHERE 9 * len(list_intersect(p.w, q.w)) >= 4 * (p.n + q.n)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
linked AS (SELECT a AS id, min(pos) AS other FROM ways JOIN classes ON id = b GROUP BY a),
known AS (SELECT w, pos, coalesce(other < pos, false) AS near FROM classes LEFT JOIN linked USING (id)),
judged AS (SELECT doc_id, line_no, near, near OR pos < (doc_id, line_no) AS removed FROM lines JOIN known USING (w)),
by_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed, count(*) FILTER (near) AS n_near,
    coalesce(string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (removed), '') AS removed_lines FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_near, 0)::BIGINT AS n_near, coalesce(removed_lines, '') AS removed_lines
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN by_doc USING (doc_id)
"""
