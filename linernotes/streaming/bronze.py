"""Landed JSON to the bronze table: each new file once, each batch under its own id.

The file log in the checkpoint remembers every file ever read, whatever its age; it grows by a line
a file and is compacted by Spark. A checkpoint that is lost or replaced begins a new ingest: it reads
all landed files again, into partitions of its own, so nothing that was there is replaced.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import StructType

from linernotes import fixed_values as fv
from linernotes.config import BronzeConfig
from linernotes.sources.landing import JSON_FILES, not_stored
from linernotes.sources.tables import ensure_bronze, open_table, registered_batches
from linernotes.streaming import quarantine, schemas


#: Of a stream of whole files; their content is not read unless it is asked for.
FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def json_options(cfg: BronzeConfig) -> dict[str, str]:
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": fv.CORRUPT_COLUMN,
        "recursiveFileLookup": "true",
        "pathGlobFilter": JSON_FILES,
        **cfg.reader_options,
    }


def with_corrupt(schema: str | StructType) -> str | StructType:
    if fv.CORRUPT_COLUMN in (schema if isinstance(schema, str) else schema.names):
        return schema
    column = StructType.fromDDL(f"{fv.CORRUPT_COLUMN} STRING")
    return f"{schema}, {fv.CORRUPT_COLUMN} STRING" if isinstance(schema, str) else StructType([*schema, *column])


def _landed(spark: SparkSession, cfg: BronzeConfig, format: str) -> DataStreamReader:
    if cfg.source_format.lower() != "json":
        raise ValueError(f"only json can be read, not {cfg.source_format!r}")
    reader = (
        spark.readStream.format(format)
        .options(**json_options(cfg))
        .option("fileNameOnly", True)
        .option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        .option("maxFileAge", cfg.max_file_age)
    )
    if cfg.archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", cfg.archive)
    return reader


def read_landing(spark: SparkSession, cfg: BronzeConfig) -> DataFrame:
    """Stream of landed JSON records, by the configured schema.

    Files are told apart by name alone, at any depth. Text that is not valid JSON, or does not fit
    the schema, is kept in the corrupt column.
    """
    reader = _landed(spark, cfg, "json")
    if cfg.schema is None:
        raise ValueError("a stream of records needs a schema; without one, batches of files are read")
    return reader.schema(with_corrupt(cfg.schema)).load(cfg.landing)


def read_files(spark: SparkSession, cfg: BronzeConfig, paths: list[str], schema: str | StructType) -> DataFrame:
    """Landed records of the given files, with the ingestion columns."""
    exact = [re.sub(r"([\\\[\]{}*?,])", r"\\\1", p) for p in paths]  # a path is read as a pattern
    options = {k: v for k, v in json_options(cfg).items() if k not in ("pathGlobFilter", "recursiveFileLookup")}
    return spark.read.schema(with_corrupt(schema)).options(**options).json(exact).transform(with_ingestion_columns)


def read_learning(spark: SparkSession, cfg: BronzeConfig, paths: list[str], ingest: str, batch: int) -> DataFrame:
    """Like ``read_files``, by the schema that these files' own fields are merged into."""
    options = {k: v for k, v in json_options(cfg).items() if k not in ("pathGlobFilter", "recursiveFileLookup")}
    exact = [re.sub(r"([\\\[\]{}*?,])", r"\\\1", p) for p in paths]
    # A field that is null throughout says nothing of its type.
    found = spark.read.options(**options).option("dropFieldIfAllNull", True).json(exact).schema
    return read_files(spark, cfg, paths, schemas.advance(spark, cfg, found, ingest, batch).schema)


def with_ingestion_columns(df: DataFrame) -> DataFrame:
    """When and from which file each row came, as the first two columns."""
    return df.select(
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_ingested_filename"),
        *df.columns,
    )


def append_batch(
    batch: DataFrame, batch_id: int, cfg: BronzeConfig, ingest: str = "direct", started: bool = False
) -> None:
    """Write one batch into its own partition: a replayed batch replaces itself.

    ``ingest`` names the checkpoint that numbers the batches. The first write clears whatever lies
    at the path. Only a batch 0 can be the first, so the later ones do not look; nor does one that is
    known to be ``started``.
    """
    if cfg.files_per_batch is None:
        batch = batch.hint("rebalance")
    elif cfg.files_per_batch:
        # Not coalesce: that would also read the batch with so few tasks.
        batch = batch.repartition(cfg.files_per_batch)
    started = started or batch_id > 0 or open_table(batch.sparkSession, cfg.path, cfg.format) is not None
    dynamic = started and cfg.mode == "append"
    options = dict(cfg.writer_options)
    if cfg.format == "delta":
        options.setdefault("mergeSchema", "true")
    (
        batch.withColumn(fv.INGEST_COLUMN, F.lit(ingest))
        .withColumn(fv.BATCH_COLUMN, F.lit(batch_id).cast("long"))
        .write.format(cfg.format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .options(**options)
        .partitionBy(fv.INGEST_COLUMN, fv.BATCH_COLUMN, *cfg.partition_by)
        .save(cfg.path)
    )


def ingest_id(spark: SparkSession, cfg: BronzeConfig) -> str:
    """The id that Spark gave the checkpoint when it was made."""
    return spark.read.json(f"{cfg.checkpoint.rstrip('/')}/metadata").first()["id"]


def start_bronze(
    spark: SparkSession, cfg: BronzeConfig, written: list[tuple[str, int]] | None = None
) -> StreamingQuery:
    """Start ingesting every file not seen before; the query ends when they are done.

    Each batch's bad records are set aside. With a configured schema records are streamed; without one
    the stream is of file names, at most ``max_files_per_trigger`` a batch, and each batch is read by what
    its files add to the schema. The partitions of the batches are added to ``written``.

    With an ``archive`` Spark moves a batch's files there, under their own paths, after the batch is committed;
    those of a run's last batch when the next run begins its first. So no batch that may be repeated misses a
    file. Files whose name is ``stored`` already are left out of their batch, and go to the archive with it.
    """
    own_id = cache(lambda: ingest_id(spark, cfg))

    path = "path" if cfg.schema is None else "_ingested_filename"

    def write(batch: DataFrame, batch_id: int) -> None:
        if cfg.stored is not None:
            batch = not_stored(batch, path, cfg.stored)
        if cfg.schema is None:
            paths = [r["path"] for r in batch.select("path").distinct().collect()]
            if not paths:
                return
            batch = read_learning(spark, cfg, paths, own_id(), batch_id)
        append_batch(batch, batch_id, cfg, own_id())
        quarantine.set_aside_batch(spark, cfg, own_id(), batch_id)
        if written is not None:
            written.append((own_id(), batch_id))

    if cfg.schema is None:
        rows = _landed(spark, cfg, "binaryFile").schema(FILES).load(cfg.landing).select("path")
    else:
        rows = read_landing(spark, cfg).transform(with_ingestion_columns)
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", cfg.checkpoint)
        .queryName(f"bronze_{cfg.subdir}")
        .trigger(availableNow=True)
        .start()
    )


def committed(spark: SparkSession, cfg: BronzeConfig) -> list[int]:
    """Numbers of the batches in the checkpoint's commit log, which Spark keeps to the last hundred or so."""
    log = open_table(spark, f"{cfg.checkpoint.rstrip('/')}/commits", "text")
    if log is None:
        return []
    names = log.select(F.col("_metadata.file_name").alias("n")).distinct().where(F.col("n").rlike("^[0-9]+$"))
    return sorted(int(r["n"]) for r in names.collect())


def unregistered(spark: SparkSession, cfg: BronzeConfig) -> list[tuple[str, int]] | None:
    """Committed batches that the catalog does not show, whichever run wrote them.

    None if the log does not reach back to the last batch shown: then folders have to be listed.
    """
    known = registered_batches(spark, cfg, ingest_id(spark, cfg))
    log = committed(spark, cfg)
    if known is None or (log and log[0] > max(known, default=-1) + 1):
        return None
    return [(ingest_id(spark, cfg), b) for b in log if b not in known]


def run_bronze(
    spark: SparkSession, cfg: BronzeConfig, written: list[tuple[str, int]] | None = None
) -> tuple[str, str, str]:
    """Ingest, wait for the end, register the table. Returns its name, path and format."""
    start_bronze(spark, cfg, written).awaitTermination()
    return ensure_bronze(spark, cfg, unregistered(spark, cfg), schemas.bronze_schema(spark, cfg))


def repair(spark: SparkSession, cfg: BronzeConfig, files: list[str]) -> tuple[str, int]:
    """Read repaired files: the records their first reading did not have come into bronze as a batch."""

    def read(paths: list[str]) -> DataFrame:
        if cfg.schema is None:
            return read_learning(spark, cfg, paths, "repair", 0)
        return read_files(spark, cfg, paths, cfg.schema)

    def append(rows: DataFrame, batch: int, cfg: BronzeConfig, ingest: str) -> None:
        append_batch(rows, batch, cfg, ingest, started=True)

    batch = quarantine.repair(spark, cfg, read, append, files)
    ensure_bronze(spark, cfg, [batch], schemas.bronze_schema(spark, cfg))
    return batch
