"""Landed JSON files: which are new, and writing album records as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linernotes.sources.tables import open_table

JSON_FILES = "*.[jJ][sS][oO][nN]"
PACKED_RECORDS = 1_000_000


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder; only the listing is read, not the files' content.

    Spark lists on the driver, or with executors where there are many folders; the paths of one
    landing folder pass through the driver either way. For folders of many millions of files let
    the stream keep track of what is new, as ``run_bronze`` does.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def new_files(landed: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """(name, path) of landed JSON files whose name is not stored yet, one path per name."""
    named = landed.select(file_name(F.col("path")).alias("name"), "path").where(
        F.endswith(F.lower("name"), F.lit(".json"))
    )
    admitted = named.groupBy("name").agg(F.min("path").alias("path"))
    if stored is None:
        return admitted
    known = stored.select(file_name(F.col("path")).alias("name"))
    return admitted.join(known, "name", "left_anti")


def not_stored(rows: DataFrame, path: str, folder: str) -> DataFrame:
    """Rows whose file, named by a column of paths, has no namesake below a folder of stored files.

    The column holds paths as a listing gives them (``path``), or else as rows' metadata do, with signs escaped.
    """
    files = open_table(rows.sparkSession, folder, "binaryFile", recursiveFileLookup="true")
    if files is None:
        return rows
    same = F.col("path") if path == "path" else F.col("_metadata.file_path")
    known = files.select(file_name(same).alias("__stored")).distinct()
    return rows.join(known, file_name(rows[path]) == F.col("__stored"), "left_anti")


def write_albums(albums: DataFrame, folder: str, compression: str = "none") -> None:
    """Album records as JSON lines, many to a file; non-ASCII text is kept as it is.

    With a ``compression`` file names end in that of the codec: a stream of them needs a ``pathGlobFilter`` of its own.
    Such a file is read by one task, so none has more than ``PACKED_RECORDS``.
    """
    most = 0 if compression == "none" else PACKED_RECORDS
    writer = albums.write.option("ignoreNullFields", False).option("maxRecordsPerFile", most)
    writer.option("compression", compression).json(folder)
