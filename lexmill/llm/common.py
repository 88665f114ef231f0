"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a word is, everywhere in this subpackage. bytes.split() of UTF-8 gives the same words.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where that is unset, a temporary folder is set if the master is local (as in tests), and else this raises.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named and not re.match(r"local(\[|\Z)", sc.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lexmill-"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that nothing before it runs twice.

    The files go when the JVM no longer refers to them, if spark.cleaner.referenceTracking.cleanCheckpoints is on. For large
    tables there is ``Tables``, whose files go when told to.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark then drops a query's shuffle files when the query ends, instead of when the driver happens to collect garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The driver keeps a text of each query's plan, and makes it anew with each stage; tables that stand in a plan as values would make it one of MB.
_PLAN_CHARS = "spark.sql.maxPlanStringLength"
PLAN_CHARS = 100_000


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Tables:
    """Tables in the shared folder that live as long as a block: ``with Tables(spark) as keep: df = keep(df, name)``.

    Shuffle files of the queries that run in the block, but for checkpoints, go as each query ends, so disk is what is kept and one
    query's shuffles. What isn't kept is planned anew where it is used again. Texts of plans end after PLAN_CHARS.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Tables:
        self.before = {k: self.spark.conf.get(k, None) for k in (_CLEAN, _PLAN_CHARS)}
        self.spark.conf.set(_CLEAN, "true")
        self.spark.conf.set(_PLAN_CHARS, str(PLAN_CHARS))
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = [*self.paths.get(name, []), path]
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str) -> DataFrame:
        """The table kept last under this name."""
        return self.spark.read.parquet(self.paths[name][-1])

    def drop(self, *names: str) -> None:
        """Remove the tables kept under these names."""
        for name in names:
            for path in self.paths.pop(name, []):
                remove(self.spark, path)

    def __exit__(self, *_) -> None:
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        self.drop(*list(self.paths))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has columns of those names."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def sift(keys: DataFrame, *columns: str, bits: int = 20) -> Callable[..., Column]:
    """A test of fixed size whether values may be among those of some columns: true for all that are, and for few others while there are few.

    It keeps rows that can't join from being shuffled; nulls count as values.
    """
    spot = lambda *c: F.shiftrightunsigned(F.xxhash64(*c), 64 - bits)
    bit = lambda *c: spot(*c).bitwiseAND(F.lit(63)).cast("int")
    found = keys.groupBy(F.shiftright(spot(*columns), 6).alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(*columns))).alias("bits"))
    cells = [0] * (1 << (bits - 6))
    for r in found.collect():  # at most 2 ** (bits - 6) rows
        cells[r["cell"]] = r["bits"]
    table = F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>")  # folded to a constant
    return lambda *c: F.call_function("shiftright", table[F.shiftright(spot(*c), 6).cast("int")], bit(*c)).bitwiseAND(F.lit(1)) == 1


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per application; they may run where it isn't installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="lexmill-")) / "lexmill.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


#: Texts of 10,000 rows, Spark's measure of an Arrow batch, are tens of MB, that a worker holds as Arrow, as Python's values and as what it makes of them; so batches end after so many bytes, too.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def release() -> None:
    """Give the memory that a task has freed back to the system: a worker lives on, and its allocators would keep it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


def mapped(df: DataFrame, f, schema) -> DataFrame:
    """mapInArrow by a function that needs this package. From then on the session's Arrow batches are of BATCH_BYTES at most, and a row.

    What a task has freed goes back to the system as it ends.
    """

    def run(batches):
        try:
            yield from f(batches)
        finally:
            release()

    spark = df.sparkSession
    ship(spark)
    now = spark.conf.get(_BATCH).lower().removesuffix("b")
    if not now.isdecimal() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` rows, by the hash of their ids: the same on every run. Few more than those are sorted, whatever the table's size."""
    n, scale = rows.count(), 1 << 30
    share = min(scale, int(scale * 2 * most / max(n, 1)))
    h = F.xxhash64(id_col)
    return rows.where(F.pmod(h, F.lit(scale)) < share).orderBy(h, id_col).limit(most)


def words_of(text) -> F.Column:
    """Native: the words of a text column; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def rows_of(batch, *names: str):
    """The named columns of an Arrow batch as tuples of Python values."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))
