"""Whether outputs, archives and metadata are what their lists say."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import tarfile
from pathlib import PurePosixPath

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import _move, _path, materialized, ship
from ..sources import planned

LIST = "CONTENTS.sha256.json"


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """path (below the folder), sha256 of all files."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = folder.rstrip("/").rpartition("/")[2]
    return found.select(F.substring_index("path", f"/{name}/", -1).alias("path"), F.sha2("content", 256).alias("sha256"))


def row_digests(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, sha256 of a text column: a listing that ``differences`` can compare."""
    return rows.select(key, F.sha2(value, 256).alias("sha256"))


def differences(left: DataFrame, right: DataFrame, key: str = "path", value: str = "sha256") -> DataFrame:
    """key, problem (missing, unlisted, changed) of what is in ``left`` against the list in ``right``."""
    l, r = left.select(key, F.col(value).alias("l")), right.select(key, F.col(value).alias("r"))  # noqa: E741
    problem = F.when(F.col("l").isNull(), "missing").when(F.col("r").isNull(), "unlisted").when(F.col("l") != F.col("r"), "changed")
    return l.join(r, key, "full_outer").select(key, problem.alias("problem")).where("problem IS NOT NULL")


def differs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one of two relations has more often than the other."""
    return left.exceptAll(right).union(right.exceptAll(left))


def fingerprints(rows: DataFrame, key: str, buckets: int = 256) -> DataFrame:
    """bucket (of the key's hash), n, h1, h2: what tells multisets of rows apart whatever their order; sums of two hashes of all columns, so each task adds up its own rows."""
    columns = sorted(rows.columns)
    total = lambda *seed: F.sum(F.xxhash64(*seed, *columns).cast("decimal(38,0)"))
    return rows.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("n"), total().alias("h1"), total(F.lit(1)).alias("h2"))


def _free(df: DataFrame, name: str) -> str:
    """The name, changed if ``df`` has a column of it."""
    while name in df.columns:
        name += "_"
    return name


def changed_rows(one: DataFrame, two: DataFrame, key: str, buckets: int = 256) -> DataFrame:
    """Rows with side (one or two) that the other side lacks, counted as often as they come. Only buckets whose fingerprints differ are compared row by row."""
    own = [fingerprints(df, key, buckets).select("bucket", F.struct("n", "h1", "h2").alias(name)) for df, name in ((one, "a"), (two, "b"))]
    unlike = own[0].join(own[1], "bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")
    found = [r["bucket"] for r in unlike.collect()]  # at most as many as there are buckets
    columns = sorted(one.columns)
    more, side = (_free(one, name) for name in ("more", "side_of"))
    some = [df.select(*columns, F.lit(n).cast("long").alias(more)).where(F.pmod(F.xxhash64(key), F.lit(buckets)).isin(found)) for df, n in ((one, 1), (two, -1))]
    # Both ways at once: each side is read and moved once.
    left = some[0].unionByName(some[1]).groupBy(*columns).agg(F.sum(more).alias(more)).where(F.col(more) != 0)
    told = left.withColumn(side, F.when(F.col(more) > 0, "one").otherwise("two"))
    return told.select(*columns, F.col(side).alias("side"), F.explode(F.sequence(F.lit(1).cast("long"), F.abs(more))).alias(more)).drop(more)


def listing(spark: SparkSession, checksums: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(checksums.items()), "path string, sha256 string")


def unsafe_members(names: list[tuple[str, bool]]) -> list[str]:
    """Of (name, whether it is a link): absolute, leading out of the archive, links, or there twice."""
    seen, out = set(), []
    for name, link in names:
        p = PurePosixPath(name)
        if link or p.is_absolute() or ".." in p.parts or str(p) in seen:
            out.append(name)
        seen.add(str(p))
    return out


#: What a release's names may look like.
REPOSITORY, TAG = r"[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+", r"[A-Za-z0-9][A-Za-z0-9._-]*"


#: What each field of a release looks like, and what is said where it doesn't.
RELEASE = {"repository": (REPOSITORY, "a repository is owner/name"), "tag": (TAG, "a tag has letters, digits, dots, underscores and hyphens"), "modifier": (r"[^\r\n]*\S[^\r\n]*", "the modifier is one line")}


def release_identity(repository: str, tag: str, modifier: str, when: str) -> dict:
    """What a release says about itself; raises where a name isn't one. when: an ISO time."""
    said = {"repository": repository, "tag": tag, "modifier": modifier, "generated_at": when}
    for field, (rule, message) in RELEASE.items():
        if not re.fullmatch(rule, said[field]):
            raise ValueError(message)
    return said


def write_archive(spark: SparkSession, folder: str, path: str, most: int = 2 << 30, part: int = 64 << 20) -> dict[str, str]:
    """A gzipped tar of a folder's files with the list of their checksums, which is returned: as parts in the folder ``path`` that, one behind the other, are the archive.

    Each part is some files' members, of about ``part`` bytes or one file, packed by an executor in blocks, so that no file's bytes pass through the driver or lie in memory as a whole. There as a
    whole or not at all; more than ``most`` bytes raise.
    """
    top, at, rows = folder.rstrip("/"), 0, []
    for name, size in planned.listed(top):
        if (name := name.removeprefix(f"{top}/")) != LIST:
            rows.append((at // part, name))
            at += size + 1024
    (target, fs), (new, _) = _path(spark, path), _path(spark, f"{path}.new")

    def pack(own: pd.DataFrame) -> pd.DataFrame:
        out = []
        with planned.created(f"{path}.new/part-{own['part'].iloc[0]:06d}.tar.gz") as raw:
            with gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1, mtime=0) as packed:
                for name in own["name"].sort_values():
                    with planned._open(f"{top}/{name}") as f:
                        out.append((name, _add(packed, name, f.size(), f)))
            size = raw.tell()
        return pd.DataFrame([(n, h, size if not k else 0) for k, (n, h) in enumerate(out)], columns=["name", "sha256", "bytes"])

    ship(spark)
    fs.delete(new, True)
    try:
        made = spark.createDataFrame(rows, "part long, name string").groupBy("part").applyInPandas(pack, "name string, sha256 string, bytes long").collect()  # one row per file
        listed, size = {r["name"]: r["sha256"] for r in made}, sum(r["bytes"] for r in made)
        if not 0 < size < most:
            raise ValueError(f"the archive has {size} bytes")
        last = io.BytesIO()
        with gzip.GzipFile(fileobj=last, mode="wb", mtime=0) as packed:
            data = json.dumps(listed, indent=2, sort_keys=True).encode()
            _add(packed, LIST, len(data), io.BytesIO(data))
            packed.write(bytes(2 * tarfile.BLOCKSIZE))  # the archive's end
        planned.put(f"{path}.new/part-{rows[-1][0] + 1:06d}.tar.gz", last.getvalue())
        fs.delete(target, True)
        _move(fs, new, target)
    except BaseException:
        fs.delete(new, True)
        raise
    return listed


def _add(out, name: str, size: int, data) -> str:
    """Write a member's header and bytes, block by block; returns their sha256."""
    info = tarfile.TarInfo(name)
    info.size = size
    out.write(info.tobuf(tarfile.PAX_FORMAT))
    digest, left = hashlib.sha256(), size
    while left:
        block = data.read(min(left, 1 << 20))
        if not block:
            raise OSError(f"{name} became shorter")
        digest.update(block)
        out.write(block)
        left -= len(block)
    out.write(bytes(-size % tarfile.BLOCKSIZE))
    return digest.hexdigest()


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """name, regular, sha256, text (of the list of checksums only) of a tar's members but folders, gzipped or not: a file, or a folder of parts, each of which is one task's. Bytes are hashed in blocks."""

    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                with planned._open(file) as f:
                    packed = f.read(2) == b"\x1f\x8b"
                    f.seek(0)
                    rows = []
                    with tarfile.open(fileobj=gzip.GzipFile(fileobj=f) if packed else f, mode="r|") as tar:
                        for m in tar:
                            if m.isdir():
                                continue
                            digest, text = hashlib.sha256(), b""
                            if m.isreg():
                                data = tar.extractfile(m)
                                while block := data.read(1 << 20):
                                    digest.update(block)
                                    text += block if PurePosixPath(m.name).name == LIST else b""
                            rows.append((m.name, m.isreg(), digest.hexdigest(), text.decode("utf-8", "replace") if text else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, (pa.string(), pa.bool_(), pa.string(), pa.string()))], ["name", "regular", "sha256", "text"])

    ship(spark)
    parts = planned.listed(path)
    return spark.createDataFrame([(p,) for p, _ in parts], "path string").repartition(len(parts)).mapInArrow(run, "name string, regular boolean, sha256 string, text string")


def rebuild_differences(spark: SparkSession, rebuilt: str, recorded: dict[str, str]) -> DataFrame:
    """path, problem of outputs made anew against the checksums that were recorded of the first ones; empty if all are the same."""
    return differences(digests(spark, rebuilt), listing(spark, recorded))


def verify_archive(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """path, problem of a tar with its own list of checksums; empty if all is well. A folder that all members are in is taken off their names.

    unsafe: absolute, leading out of the archive, no regular file, or there twice. missing: listed or ``required``, and not there.
    """
    members = materialized(archive_members(spark, path))
    step = F.split("name", "/")
    tops = members.agg(F.min(step[0]).alias("a"), F.max(step[0]).alias("b"), F.min(F.size(step)).alias("n")).first()
    name = F.expr("substr(name, instr(name, '/') + 1)") if tops["a"] == tops["b"] and tops["n"] > 1 else F.col("name")
    wrong = ~F.col("regular") | F.col("name").startswith("/") | F.array_contains(step, "..") | (F.count("*").over(Window.partitionBy("name")) > 1)
    unsafe = members.withColumn("wrong", wrong).where("wrong").select(F.col("name").alias("path"), F.lit("unsafe").alias("problem"))
    found = members.where("regular").select(name.alias("path"), "sha256", "text")
    listed = found.where(F.col("path") == LIST).select(F.explode(F.from_json("text", "map<string,string>")).alias("path", "sha256"))
    needed = spark.createDataFrame([(r,) for r in (*required, LIST)], "path string").join(found.select("path"), "path", "left_anti").withColumn("problem", F.lit("missing"))
    return unsafe.unionByName(needed).unionByName(differences(found.where(F.col("path") != LIST).drop("text"), listed)).distinct()


def verify_folder(spark: SparkSession, folder: str) -> DataFrame:
    """path, problem of a folder against the list in it."""
    listed = json.loads(spark.read.format("binaryFile").load(f"{folder}/{LIST}").first()["content"])
    return differences(digests(spark, folder).where(F.col("path") != LIST), listing(spark, listed))


def metadata_mismatches(spark: SparkSession, lock: list[dict], kept: DataFrame) -> DataFrame:
    """id, problem between pinned sources and those that a merged relation was made of (id, metadata as JSON)."""
    own = spark.createDataFrame([(s["id"], json.dumps(s, ensure_ascii=False, sort_keys=True)) for s in lock], "id string, metadata string")
    return differences(kept.select("id", "metadata"), own, "id", "metadata")
