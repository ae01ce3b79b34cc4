"""Reading and writing lake tables, and registering them in the catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from linernotes import fixed_values as fv
from linernotes.config import BronzeConfig, GoldConfig
from linernotes.functions.text import table_name

_NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def open_table(
    spark: SparkSession, path: str, format: str = "parquet", **options: str
) -> DataFrame | None:
    """The table at a path, or None when no data is there."""
    try:
        return spark.read.format(format).options(**options).load(path)
    except AnalysisException as e:
        if e.getCondition() in _NOTHING_THERE:
            return None
        raise


def open_tables(
    spark: SparkSession, base: str, names: list[str], format: str = "parquet"
) -> dict[str, DataFrame]:
    """The tables that exist under a folder; missing ones are left out."""
    found = {n: open_table(spark, f"{base}/{n}", format) for n in names}
    return {n: df for n, df in found.items() if df is not None}


def read_bronze(spark: SparkSession, cfg: BronzeConfig) -> DataFrame:
    """Bronze rows, compacted or not. Columns added by later batches are null in the earlier ones.

    With a schema, configured or learned, that costs nothing; without one the footers of all files are
    merged.
    """
    from linernotes.sources.compacted import with_runs
    from linernotes.streaming.schemas import bronze_schema

    schema, reader = bronze_schema(spark, cfg), spark.read.format(cfg.format)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    return with_runs(spark, cfg, reader.load(cfg.path))


def register(
    spark: SparkSession,
    table: str,
    path: str,
    format: str,
    partitioned: bool = False,
    new: list[str] | None = None,
    schema: StructType | None = None,
) -> str:
    """Make an external table known to the catalog; repeating it changes nothing.

    ``new`` names the partitions (``a='x', b=1``) that may have come since it was last registered;
    without it, or for a table not known yet, all folders are listed. A table whose columns are not those
    of ``schema`` any more is made anew over the same files.
    """
    known = spark.catalog.databaseExists(table.split(".")[0]) and spark.catalog.tableExists(table)
    database = table.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if known and schema is not None and format != "delta":
        shown = {f.name: f.dataType for f in spark.table(table).schema}
        if any(shown.get(f.name) != f.dataType for f in schema):
            spark.sql(f"DROP TABLE {table}")  # of an external table: the files stay
            known = False
    if not known and schema is not None and partitioned:
        parts = f"{fv.INGEST_COLUMN}, {fv.BATCH_COLUMN}"
        spark.sql(f"CREATE TABLE {table} ({schema.toDDL()}) USING {format} PARTITIONED BY ({parts}) LOCATION '{path}'")
    elif not known:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {format} LOCATION '{path}'")
    if partitioned and known and new is not None:
        if new:
            parts = " ".join(f"PARTITION ({p})" for p in new)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    elif partitioned:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return table


def registered_batches(spark: SparkSession, cfg: BronzeConfig, ingest: str) -> set[int] | None:
    """The batches of an ingest that the catalog shows; None if it does not know the table."""
    from linernotes.sources.compacted import live_table

    database, table = cfg.table.split(".")[0], live_table(spark, cfg)
    if cfg.format == "delta" or not spark.catalog.databaseExists(database) or not spark.catalog.tableExists(table):
        return None
    shown = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({fv.INGEST_COLUMN}='{ingest}')")
    batch = F.regexp_extract("partition", f"{fv.BATCH_COLUMN}=([0-9]+)", 1).cast("long")
    return {r["b"] for r in shown.select(batch.alias("b")).distinct().collect()}


def ensure_bronze(
    spark: SparkSession,
    cfg: BronzeConfig,
    batches: list[tuple[str, int]] | None = None,
    schema: StructType | None = None,
) -> tuple[str, str, str]:
    """Register the bronze table whenever data exists, also if this run brought none.

    ``batches`` are the (ingest, batch) partitions to add, None if they are not known.
    """
    from linernotes.sources import compacted

    if open_table(spark, cfg.path, cfg.format) is not None:
        new = None
        if batches is not None and not cfg.partition_by and cfg.mode == "append":
            new = [f"{fv.INGEST_COLUMN}='{i}', {fv.BATCH_COLUMN}={b}" for i, b in batches]
        schema = None if cfg.partition_by else schema
        table = compacted.live_table(spark, cfg)
        register(spark, table, cfg.path, cfg.format, cfg.format != "delta", new, schema)
        if table != cfg.table and schema is not None:
            compacted.show(spark, cfg, schema)
    return cfg.table, cfg.path, cfg.format


def write_gold(spark: SparkSession, df: DataFrame, name: str, cfg: GoldConfig) -> str:
    """Overwrite a gold table and point the catalog at it; the name is made catalog-safe."""
    name = table_name(name)
    path = f"{cfg.path.rstrip('/')}/{name}"
    df.write.format(cfg.format).mode("overwrite").options(**cfg.writer_options).save(path)
    table = f"{cfg.database}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.database}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return register(spark, table, path, cfg.format)


#: Ids are hashes as hexadecimal text, which only an entropy coder makes smaller.
PACKED = {"compression": "zstd"}


def write_sorted(df: DataFrame, path: str, *keys: str, distinct: bool = False, in_ranges: bool = False) -> None:
    """Write a table in key order, so that a scan for one key skips nearly all row groups.

    With ``distinct`` repeated rows are taken out where rows of equal keys have met, which takes no shuffle. Rows
    that lie ``in_ranges`` of the keys already are not moved.
    """
    rows = df if in_ranges else df.repartitionByRange(*keys)
    rows = rows.distinct() if distinct else rows
    rows.sortWithinPartitions(*keys).write.options(**PACKED).parquet(path)
