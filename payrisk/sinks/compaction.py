"""Merge the small files of a table."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_FILE_BYTES = 256 * 1024 * 1024
#: Files of at least this share of the target stay as they are.
LARGE = 0.5
#: Folders whose name begins so are skipped by every reader of a table.
_WORK = "_compact-"


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path``, from the file system's own summary."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(file_system.getContentSummary(location).getLength())


def compact(
    spark: SparkSession,
    source_path: str,
    new_path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    partition_columns: Sequence[str] = (),
) -> DataFrame:
    """Rewrite a Parquet folder with fewer files into ``new_path``; the source stays as it is.

    Unpartitioned tables need no shuffle: each task reads several files and writes one. Partitioned
    tables are rebalanced on their partition columns, which AQE merges and splits by size.
    """
    table = spark.read.parquet(source_path)
    if partition_columns:
        table = table.hint("rebalance", *[F.col(c) for c in partition_columns])
        table.write.partitionBy(*partition_columns).parquet(new_path)
    else:
        files = max(1, -(-folder_bytes(spark, source_path) // target_bytes))
        table.coalesce(files).write.parquet(new_path)
    return spark.read.schema(table.schema).parquet(new_path)


def pack(sizes: Sequence[int], target: int) -> list[int]:
    """The bin of each size, first-fit decreasing: the largest first, each into the first bin that
    has room. A tree of the bins' largest rooms finds that bin in a logarithmic number of steps."""
    width = 1
    while width < len(sizes):
        width *= 2
    room = [target] * (2 * width)
    bins = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = 1
        while at < width:
            at = 2 * at if room[2 * at] >= sizes[i] else 2 * at + 1
        room[at] -= sizes[i]
        bins[i] = at - width
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return bins


def small_file_groups(
    spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """(folder, file, bytes, bin): which small files of a Parquet table go into one new file.

    Known from the files' metadata; no column is read. Groups stay within a folder and below the
    target, and have two files at least. Large files are pruned when the table is listed.
    """
    small = F.col("_metadata.file_size") < int(target_bytes * LARGE)
    files = (
        spark.read.parquet(path)
        .filter(small)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
        )
        .distinct()
        .withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    )

    def grouped(folder: pd.DataFrame) -> pd.DataFrame:
        folder = folder.sort_values("file").reset_index(drop=True)
        folder["bin"] = pack(folder["bytes"].tolist(), target_bytes)
        counts = folder.groupby("bin")["file"].transform("size")
        return folder[counts > 1][["folder", "file", "bytes", "bin"]]

    groups = files.groupBy("folder").applyInPandas(
        grouped, "folder string, file string, bytes bigint, bin long"
    )
    return groups.withColumn("group", F.sha1(F.concat_ws("#", "folder", "bin")))


def compact_small_files(
    spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES
) -> int:
    """Merge the small files of a Parquet table in place; returns the number of new files.

    Large files are neither read nor moved. The new files are written beside the table first, with
    the list of what each replaces; then each takes its place and its sources are deleted. A run
    that is cut off in between is finished by ``finish_compaction``, which also is the last step
    here; meanwhile readers may see a group's rows twice, so let them use a versioned view.
    """
    finish_compaction(spark, path)
    work = f"{path}/{_WORK}{uuid.uuid4().hex}"
    groups = small_file_groups(spark, path, target_bytes)
    groups.write.parquet(f"{work}/groups")
    groups = spark.read.parquet(f"{work}/groups")
    table = spark.read.parquet(path)
    first = groups.select("folder").first()
    if first is None:
        _delete(spark, work)
        return 0
    # Folders carry the partition columns' values; files hold the others.
    held = _partition_columns(spark, path, first["folder"])
    columns = [c for c in table.columns if c not in held]
    small = F.col("_metadata.file_size") < int(target_bytes * LARGE)
    rows = table.filter(small).select(F.col("_metadata.file_path").alias("file"), *columns)
    (
        rows.join(groups.select("file", "group"), "file")
        .drop("file")
        .repartition("group")
        .write.partitionBy("group")
        .parquet(f"{work}/new")
    )
    return finish_compaction(spark, path)


def finish_compaction(spark: SparkSession, path: str) -> int:
    """Put the new files of begun compactions into their places and delete what they replace.
    Compactions whose files were not all written are dropped. Returns the number of files placed."""
    done = 0
    for work in _folders(spark, path):
        if _exists(spark, f"{work}/new/_SUCCESS"):
            done += _switch(spark, work)
        _delete(spark, work)
    return done


def _switch(spark: SparkSession, work: str) -> int:
    """Only names pass through here, one group after the other."""
    done = 0
    groups = spark.read.parquet(f"{work}/groups")
    by_group = groups.groupBy("group", "folder").agg(F.collect_list("file").alias("files"))
    for r in by_group.toLocalIterator():
        for new in _files(spark, f"{work}/new/group={r['group']}"):
            # A task gives the files of all its groups the same name.
            done += _rename(spark, new, f"{r['folder']}/{r['group']}-{new.rsplit('/', 1)[1]}")
        for old in r["files"]:
            _delete(spark, old)
    return done


def _path(spark: SparkSession, text: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(text) if ":/" in text else text)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def _partition_columns(spark: SparkSession, path: str, folder: str) -> set[str]:
    """The columns that folders below ``path`` name; the path itself may hold = signs."""
    root, files = _path(spark, path)
    above = files.makeQualified(root).toUri().getPath().rstrip("/")
    below = _path(spark, folder)[0].toUri().getPath()[len(above) :]
    return {p.split("=")[0] for p in below.split("/") if "=" in p}


def _exists(spark: SparkSession, text: str) -> bool:
    location, files = _path(spark, text)
    return bool(files.exists(location))


def _delete(spark: SparkSession, text: str) -> None:
    location, files = _path(spark, text)
    files.delete(location, True)


def _rename(spark: SparkSession, old: str, new: str) -> int:
    source, files = _path(spark, old)
    if not files.rename(source, _path(spark, new)[0]):
        raise OSError(f"cannot move {old} to {new}")
    return 1


def _listed(spark: SparkSession, text: str) -> Iterator[tuple[str, bool]]:
    location, files = _path(spark, text)
    if files.exists(location):
        for status in files.listStatus(location):
            yield status.getPath().toUri().toString(), status.isDirectory()


def _folders(spark: SparkSession, path: str) -> list[str]:
    return [p for p, folder in _listed(spark, path) if folder and p.rsplit("/", 1)[1].startswith(_WORK)]


def _files(spark: SparkSession, path: str) -> list[str]:
    return [p for p, folder in _listed(spark, path) if not folder and p.endswith(".parquet")]


def rewrite_statement(catalog: str, table: str, target_bytes: int = TARGET_FILE_BYTES) -> str:
    """The same for an Iceberg table, which compacts in place and keeps its snapshots."""
    return (
        f"CALL {catalog}.system.rewrite_data_files(table => '{table}', "
        f"options => map('target-file-size-bytes', '{target_bytes}'))"
    )
