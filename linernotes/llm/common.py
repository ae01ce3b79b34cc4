"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the public vocabularies lie; callers pass another path where theirs differ.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same lower-casing for bytes.translate: only A-Z change.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one in the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"


def cut(df: DataFrame) -> DataFrame:
    """``df`` as files in the shared folder, so that a lost executor loses none of it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: like ``cut``, and Spark knows its size.

    For tables that are small as a rule but need not be: Spark then broadcasts them or not by what
    they measure.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(df: DataFrame, *but: str) -> list[Column]:
    """The columns of ``df``, whatever signs their names hold, but for some."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in but]


def held_out(modulus: int, remainder: int, doc_id: Column | str = "doc_id") -> Column:
    """Whether crc32 of the id as text has this remainder; an id that is null is not held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % modulus == remainder, F.lit(False))


def spread_pieces(text: Column | str, pieces: int, chars: int) -> Column:
    """Up to ``pieces`` substrings of ``chars`` code points, evenly spaced over the whole text.

    A bounded view of a text of any length, for fitting only.
    """
    col = F.col(text) if isinstance(text, str) else text
    room = F.greatest(F.length(col) - chars, F.lit(0))
    step = F.greatest(F.ceil(room / (pieces - 1)).cast("int"), F.lit(chars))
    parts = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring(col, i * step + 1, F.lit(chars)))
    return F.filter(parts, lambda p: p != "")


def read_bounded(path: str) -> bytes:
    """A vocabulary file (a few MB at most) on the driver; executors get its bytes, not its path."""
    with open(path, "rb") as f:
        return f.read()


def slices(texts: pd.Series, size: int) -> Iterator[list]:
    """Lists of texts of about ``size`` together, so that memory follows neither the batch nor its longest text's neighbours."""
    part, total = [], 0
    for text in texts:
        part.append(text)
        total += len(text or "")
        if total >= size:
            yield part
            part, total = [], 0
    if part:
        yield part
