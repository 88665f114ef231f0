"""A lexicon that grows by batches: rows are folded into buckets as they come, in any order of batches.

A store is a folder of buckets by the hash of the reading, and of manifests, one per version, that name each bucket's folder. A batch reads and
rewrites only the buckets that it has rows for, beside the old ones; then its manifest appears by one rename, and the newest manifest is the store. So a batch is
there as a whole or not at all, and who reads an older version still finds it until ``vacuum``.

What is kept of a key says all that later rows can ask: the first known priority comes with its own rank, and tags are a set that is empty once nothing is shared. Folding is then
associative, commutative and idempotent: replayed batches change nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge
from ..runtime import _move, _path, scratch
from ..schema import ENTRIES, ENTRY_KEY

STATE = [*ENTRY_KEY, "scope", "rank", "cost", "pri", "pri_rank", "pos", "original_reading", "confidence", "tags"]


def states(rows: DataFrame) -> DataFrame:
    """STATE of each row of ``merge.fold``'s input."""
    known = {"pri_rank": F.when(F.col("pri").isNotNull(), F.col("rank")), "tags": F.array_sort(F.array_distinct(F.coalesce("inf", F.array().cast("array<string>"))))}
    return rows.select(*((known[c].alias(c) if c in known else F.col(c)) for c in STATE))


def combined(state: DataFrame, *more: str) -> DataFrame:
    """One STATE per key, from any number of them, and the columns ``more`` that are the same for a key."""
    first = lambda c: F.min_by(c, "rank").alias(c)
    shared = F.aggregate(F.collect_set("tags"), F.lit(None).cast("array<string>"), lambda a, x: F.when(a.isNull(), x).otherwise(F.array_intersect(a, x)))
    out = state.groupBy(*more, *ENTRY_KEY).agg(
        merge.widest(F.col("scope")).alias("scope"), F.min("rank").alias("rank"), F.min("cost").alias("cost"), F.min_by("pri", "pri_rank").alias("pri"), F.min("pri_rank").alias("pri_rank"),
        first("pos"), first("original_reading"), first("confidence"), F.array_sort(shared).alias("tags"),
    )
    return out.select(*more, *STATE)


def entries_of(state: DataFrame) -> DataFrame:
    """ENTRIES of STATE."""
    rows = state.withColumn("inf", F.when(F.size("tags") > 0, F.col("tags")))
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in ENTRIES))


class Store:
    """One writer at a time; ``buckets`` is fixed by the first batch."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = (self.manifest() or {"buckets": buckets})["buckets"]

    def _versions(self) -> list[int]:
        folder, fs = _path(self.spark, f"{self.path}/manifests")
        names = [str(s.getPath().getName()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """version, buckets and the folder of each bucket that has rows; None before the first batch."""
        versions = self._versions()
        if not versions:
            return None
        name = f"{self.path}/manifests/{versions[-1] if version is None else version:012d}.json"
        return json.loads(self.spark.read.text(name, wholetext=True).first()[0])

    def _read(self, folders: dict[str, str]) -> DataFrame:
        schema = states(self.spark.createDataFrame([], ENTRIES)).schema
        paths = [f"{self.path}/{f}" for f in folders.values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def entries(self, version: int | None = None) -> DataFrame:
        return entries_of(self._read((self.manifest(version) or {"folders": {}})["folders"]))

    def fold_parsed(self, parsed: DataFrame) -> list[int]:
        """``fold`` of the PARSED rows that aren't rejected."""
        rows = merge.checked(parsed).where("reject IS NULL")
        return self.fold(rows.withColumnRenamed("reading", "original_reading").withColumnRenamed("key", "reading"))

    def fold(self, rows: DataFrame, often: bool = False) -> list[int]:
        """Fold rows (the input of ``merge.fold``) in; returns the buckets that were written. often: as there; rows that differ in rank and cost only are folded first."""
        rows = merge.least_ranks(rows) if often else rows
        bucket = F.pmod(F.xxhash64("reading"), F.lit(self.buckets)).cast("int")
        with scratch(self.spark, "batch") as staged:
            combined(states(rows)).withColumn("bucket", bucket).write.parquet(staged)
            fresh = self.spark.read.parquet(staged)
            touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())  # as many as there are buckets, at most
            if not touched:
                return []
            now = self.manifest() or {"version": 0, "folders": {}}
            old = self._read({b: f for b, f in now["folders"].items() if int(b) in touched}).withColumn("bucket", bucket)
            both = combined(old.unionByName(fresh.select(old.columns)).repartition("bucket"), "bucket")
            version = now["version"] + 1
            place = f"data/{version:012d}-{uuid.uuid4().hex}"
            both.sortWithinPartitions("bucket", "reading", "surface", "source", "kind").write.partitionBy("bucket").parquet(f"{self.path}/{place}")
        self._commit({"version": version, "buckets": self.buckets, "folders": now["folders"] | {str(b): f"{place}/bucket={b}" for b in touched}})
        return touched

    def _commit(self, manifest: dict) -> None:
        """The manifest appears whole by a rename to a name that isn't there yet; a second writer of the same version fails."""
        name = f"{self.path}/manifests/{manifest['version']:012d}.json"
        (new, fs), (target, _) = _path(self.spark, f"{self.path}/manifests/.{uuid.uuid4().hex}"), _path(self.spark, name)
        out = fs.create(new, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if fs.exists(target):
            fs.delete(new, False)
            raise OSError(f"{name} is there already")
        _move(fs, new, target)

    def vacuum(self, versions: int = 1) -> int:
        """Delete what the newest ``versions`` manifests don't name; returns how many folders went."""
        held = self._versions()[-versions:]
        named = {f for v in held for f in self.manifest(v)["folders"].values()}
        gone = 0
        folder, fs = _path(self.spark, f"{self.path}/data")
        for batch in fs.listStatus(folder) if fs.exists(folder) else []:
            own = batch.getPath()
            for b in fs.listStatus(own):
                where = f"data/{own.getName()}/{b.getPath().getName()}"
                if where not in named:
                    gone += str(b.getPath().getName()).startswith("bucket=")
                    fs.delete(b.getPath(), True)
            if not len(fs.listStatus(own)):
                fs.delete(own, True)
        for v in set(self._versions()) - set(held):
            fs.delete(_path(self.spark, f"{self.path}/manifests/{v:012d}.json")[0], False)
        return gone


def merged_with(entries: DataFrame | None, parsed: DataFrame) -> DataFrame:
    """ENTRIES after another batch of PARSED rows, without a store. Batches have to come in the order of ranks, for the first known priority is kept without its rank."""
    fresh = merge.entries(parsed)
    return fresh if entries is None else merge.fold(entries.select(fresh.columns).unionByName(fresh))


def maintain(stream: DataFrame, path: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Start a query that folds each micro-batch of PARSED rows into the store at ``path``; replayed batches change nothing."""
    return stream.writeStream.foreachBatch(lambda batch, _: Store(batch.sparkSession, path, buckets).fold_parsed(batch) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(stream: DataFrame, time: str, size: str = "1 day", late: str = "1 day") -> DataFrame:
    """source, window, n of rows with an event time, late rows dropped after ``late``."""
    return stream.withWatermark(time, late).groupBy("source", F.window(time, size)).agg(F.count("*").alias("n"))
