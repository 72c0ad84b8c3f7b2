"""Full snapshots of a source, each landed under a path of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerprice.sources.commit_log import CommitLog, FoldedLog
from hammerprice.sources.csv_files import read_raw_csv, write_csv

_LAYOUT = r"source=([^/]+)/snapshot_date=([^/]+)/"


def snapshot_folder(root: str, source: str, snapshot_date: str) -> str:
    return f"{root.rstrip('/')}/source={source}/snapshot_date={snapshot_date}"


def land_snapshot(df: DataFrame, root: str, source: str, snapshot_date: str) -> str:
    """Write one full snapshot and announce it. An existing snapshot is never rewritten: file streams would miss that."""
    folder = snapshot_folder(root, source, snapshot_date)
    write_csv(df, folder, mode="errorifexists")
    announce(df.sparkSession, root, source, snapshot_date)
    return folder


#: So many signals are left for streams to see; a stream that is further behind still sees that there is something new.
SIGNALS = 64


def announcements(root: str) -> str:
    """Folder of the signals of the newest complete snapshots; streams watch it, as they do not see closing marks."""
    return f"{root.rstrip('/')}/landed"


def manifest(spark: SparkSession, root: str) -> FoldedLog:
    """The log of announced snapshots; its state is the newest snapshot date per source."""

    def newest(state: dict, landed: dict) -> dict:
        source, date = landed["source"], landed["snapshot_date"]
        return state | {source: max(date, state.get(source, date))}

    return FoldedLog(CommitLog(spark, f"{root.rstrip('/')}/manifest"), newest)


def announce(spark: SparkSession, root: str, source: str, snapshot_date: str) -> None:
    """Enter a complete snapshot in the manifest and signal it to streams.

    Writers that land files by other means call this afterwards. No call lists a folder.
    """
    if not is_complete(spark, snapshot_folder(root, source, snapshot_date)):
        raise FileNotFoundError(f"snapshot {snapshot_date} of {source} has no closing mark")
    number = manifest(spark, root).add({"source": source, "snapshot_date": snapshot_date})
    files, signal = _file_system(spark, f"{announcements(root)}/{number}.txt")
    files.create(signal, True).close()
    if number > SIGNALS:
        files.delete(_file_system(spark, f"{announcements(root)}/{number - SIGNALS}.txt")[1], False)


def announce_missing(spark: SparkSession, root: str) -> int:
    """Announce the complete snapshots that are newer than their source's announced ones; lists all folders."""
    known, found = latest_snapshots(spark, root), 0
    for row in snapshot_listing(spark, root).orderBy("source", "snapshot_date").collect():  # one row per snapshot
        source, date = row["source"], row["snapshot_date"]
        if date > known.get(source, "") and is_complete(spark, snapshot_folder(root, source, date)):
            announce(spark, root, source, date)
            found += 1
    return found


def land_raw_files(spark: SparkSession, location: str, root: str, source: str, snapshot_date: str) -> str:
    return land_snapshot(read_raw_csv(spark, location, missing=()), root, source, snapshot_date)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether the writer of a snapshot has set its closing mark."""
    files, path = _file_system(spark, f"{folder}/_SUCCESS")
    return files.exists(path)


def snapshot_listing(spark: SparkSession, root: str) -> DataFrame:
    """(source, snapshot_date) of every landed snapshot, unfinished ones too; reads names only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    return (
        files.select(
            F.regexp_extract("path", _LAYOUT, 1).alias("source"), F.regexp_extract("path", _LAYOUT, 2).alias("snapshot_date")
        )
        .where(F.col("source") != "")
        .distinct()
    )


def latest_snapshots(spark: SparkSession, root: str) -> dict[str, str]:
    """Newest announced snapshot date per source, from the manifest."""
    return manifest(spark, root).head()[1]


def read_latest(spark: SparkSession, root: str, **options) -> DataFrame:
    """The newest snapshot of every source, united by column name; older ones are replaced as a whole."""
    newest = latest_snapshots(spark, root)
    if not newest:
        raise FileNotFoundError(f"no snapshot under {root}")
    folders = [snapshot_folder(root, source, date) for source, date in sorted(newest.items())]
    return read_raw_csv(spark, folders, **options)
