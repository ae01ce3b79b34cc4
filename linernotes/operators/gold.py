"""Gold dimensions and link tables from bronze album records.

Ids are hashes of normalised text, so links are made without a join. Every distinct combines
before its shuffle, and each table reads only the bronze columns it needs; bronze is not cached,
since eight narrow column scans are cheaper than holding the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from linernotes import fixed_values as fv
from linernotes.functions.text import (
    content_id, has_text, label_key, norm_text, norm_title, strip_takes, year_number,
)


def album_records(bronze: DataFrame) -> DataFrame:
    """(album_id, album, when and whence it came) of each record with an id."""
    arrival = [c for c in ("_ingested_at", "_ingested_filename") if c in bronze.columns]
    return bronze.where(F.col("id").isNotNull()).select(
        F.col("id").alias("album_id"),
        F.struct(
            F.trim("artists").alias("ensemble"),
            F.trim("title").alias("title"),
            year_number(F.col("year")).alias("year"),
            F.trim("label").alias("label"),
            F.col("style").alias("styles"),
            F.col("cover_url"),
        ).alias("album"),
        *arrival,
    )


def albums(bronze: DataFrame) -> DataFrame:
    """One row per album id: its first ingested record. Rows without an id are left out.

    Without ingestion columns the least record in column order stands in for the first.
    """
    typed = album_records(bronze)
    arrival = [c for c in typed.columns if c not in ("album_id", "album")]
    # A refused tie-break would make the row depend on partitioning, so the record itself is last.
    first = F.min_by("album", F.struct(*arrival, "album"))
    return typed.groupBy("album_id").agg(first.alias("album")).select("album_id", "album.*")


def labels(bronze: DataFrame) -> DataFrame:
    """Distinct label spellings; spellings that differ in case share one id."""
    names = bronze.select(F.trim("label").alias("name")).where(has_text(F.col("name"))).distinct()
    return names.select(label_key(F.col("name")).alias("label_id"), "name")


# A filter on a normalised text would be pushed down to the scan and there run the normaliser a
# second time for every row. Its length as an aggregate stays above the aggregation.
def _keep(norm: str) -> Column:
    return F.max(F.length(norm)).alias("_length")


NOT_EMPTY = "_length > 0"


def _most_used(spellings: DataFrame, key: str, shown: str, n: str) -> DataFrame:
    """Per key the most frequent spelling, ties by the smallest string; an empty key is left out."""
    counted = spellings.groupBy(key, shown).agg(F.sum(n).alias("_n"))
    best = F.min_by(shown, F.struct(-F.col("_n"), F.col(shown)))
    return counted.groupBy(key).agg(best.alias(shown), _keep(key)).where(NOT_EMPTY)


def _spelling_counts(texts: DataFrame, text: str) -> DataFrame:
    """Distinct trimmed texts with their number of rows: later text work runs once per spelling."""
    trimmed = texts.select(F.trim(text).alias(text)).where(has_text(F.col(text)))
    return trimmed.groupBy(text).agg(F.count(F.lit(1)).alias("n"))


def artists(bronze: DataFrame) -> DataFrame:
    """One row per normalised name over musicians and leaders."""
    names = bronze.select(F.explode(F.concat(_list("musicians"), _list("leaders"))).alias("name"))
    counts = _spelling_counts(names, "name").withColumn("norm", norm_text(F.col("name")))
    chosen = _most_used(counts, "norm", "name", "n")
    return chosen.select(content_id(F.col("norm")).alias("artist_id"), "name")


def works(bronze: DataFrame) -> DataFrame:
    """One row per normalised track title, takes stripped."""
    titles = bronze.select(F.explode("tracklist").alias("title"))
    counts = _spelling_counts(titles, "title").select(
        strip_takes(F.col("title")).alias("work_title"), norm_title(F.col("title")).alias("norm"), "n"
    )
    chosen = _most_used(counts, "norm", "work_title", "n")
    return chosen.select(content_id(F.col("norm")).alias("work_id"), "work_title")


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def album_artist(bronze: DataFrame) -> DataFrame:
    """Distinct (album, artist, role)."""
    # One list, leaders first: the position tells the role.
    both = F.posexplode(F.concat(_list("leaders"), _list("musicians"))).alias("pos", "name")
    leader = F.col("pos") < F.size(_list("leaders"))
    credits = bronze.select(F.col("id").alias("album_id"), "leaders", both)
    normed = credits.where(has_text(F.col("name"))).select(
        "album_id", norm_text(F.col("name")).alias("norm"),
        F.when(leader, fv.LEADER).otherwise(fv.MUSICIAN).alias("role"),
    )
    links = normed.groupBy("album_id", "norm", "role").agg(_keep("norm")).where(NOT_EMPTY)
    return links.select("album_id", content_id(F.col("norm")).alias("artist_id"), "role")


def album_work(bronze: DataFrame) -> DataFrame:
    """Distinct (album, work): takes of one title on one album collapse."""
    titles = bronze.select(F.col("id").alias("album_id"), F.explode("tracklist").alias("title"))
    normed = titles.where(has_text(F.col("title"))).select(
        "album_id", norm_title(F.col("title")).alias("norm")
    )
    links = normed.groupBy("album_id", "norm").agg(_keep("norm")).where(NOT_EMPTY)
    return links.select("album_id", content_id(F.col("norm")).alias("work_id"))


def album_label(bronze: DataFrame) -> DataFrame:
    """Distinct (album, label)."""
    named = bronze.select(F.col("id").alias("album_id"), F.lower(F.trim("label")).alias("name"))
    return named.where(has_text(F.col("name"))).distinct().select(
        "album_id", content_id(F.col("name")).alias("label_id")
    )


def track_table(bronze: DataFrame) -> DataFrame:
    """(album_id, norm, name): an album's distinct normalised titles, each with its first cleaned name.

    Its rows are those of the tracks, and of the links of albums and works.
    """
    titles = bronze.select(F.col("id").alias("album_id"), F.posexplode("tracklist"))
    named = titles.where(has_text(F.col("col"))).select(
        "album_id", "pos", strip_takes(F.col("col")).alias("name"),
        norm_title(F.col("col")).alias("norm"),
    )
    first = F.min_by("name", F.struct("pos", "name"))
    rows = named.groupBy("album_id", "norm").agg(first.alias("name"), _keep("norm"))
    return rows.where(NOT_EMPTY).select("album_id", "norm", "name")


def tracks(bronze: DataFrame) -> DataFrame:
    """An album's distinct tracks by normalised title, each with its first cleaned name."""
    return _tracks_of(track_table(bronze))


def _tracks_of(rows: DataFrame) -> DataFrame:
    return rows.select(_track_id(), "album_id", "name")


def _album_work_of(rows: DataFrame) -> DataFrame:
    return rows.select("album_id", content_id(F.col("norm")).alias("work_id"))


# ---- the same from shared inputs, for building all tables -----------------------------------


def title_table(bronze: DataFrame) -> DataFrame:
    """(album_id, work_title, norm, n, pos): an album's distinct titles, cleaned and normalised.

    n counts a title's rows, pos is its first position.
    """
    titles = bronze.select(F.col("id").alias("album_id"), F.posexplode("tracklist").alias("pos", "title"))
    trimmed = titles.select("album_id", "pos", F.trim("title").alias("title")).where(has_text(F.col("title")))
    counted = trimmed.groupBy("album_id", "title").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    cleaned = strip_takes(F.col("title")).alias("work_title")
    return counted.select("album_id", cleaned, norm_title(F.col("title")).alias("norm"), "n", "pos")


def credit_table(bronze: DataFrame) -> DataFrame:
    """(album_id, name, norm, role, n): an album's distinct names by role, normalised and counted."""
    both = F.posexplode(F.concat(_list("leaders"), _list("musicians"))).alias("pos", "name")
    leader = F.col("pos") < F.size(_list("leaders"))
    credits = bronze.select(F.col("id").alias("album_id"), "leaders", both)
    trimmed = credits.select(
        "album_id", F.trim("name").alias("name"), F.when(leader, fv.LEADER).otherwise(fv.MUSICIAN).alias("role")
    ).where(has_text(F.col("name")))
    counted = trimmed.groupBy("album_id", "name", "role").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("album_id", "name", norm_text(F.col("name")).alias("norm"), "role", "n")


def artists_from(credits: DataFrame) -> DataFrame:
    chosen = _most_used(credits, "norm", "name", "n")
    return chosen.select(content_id(F.col("norm")).alias("artist_id"), "name")


def works_from(titles: DataFrame) -> DataFrame:
    chosen = _most_used(titles, "norm", "work_title", "n")
    return chosen.select(content_id(F.col("norm")).alias("work_id"), "work_title")


def album_artist_from(credits: DataFrame) -> DataFrame:
    links = credits.where("norm <> ''").select("album_id", "norm", "role").distinct()
    return links.select("album_id", content_id(F.col("norm")).alias("artist_id"), "role")


def album_work_from(titles: DataFrame) -> DataFrame:
    links = titles.where("norm <> ''").select("album_id", "norm").distinct()
    return links.select("album_id", content_id(F.col("norm")).alias("work_id"))


def track_firsts(titles: DataFrame) -> DataFrame:
    """(track_id, album_id, first): each title's position and name, of which a track shows the least."""
    first = F.struct("pos", F.col("work_title").alias("name")).alias("first")
    return titles.where("norm <> ''").select(_track_id(), "album_id", first)


def _track_id() -> Column:
    return content_id(F.concat_ws("#", F.col("album_id").cast("string"), "norm")).alias("track_id")


# Tables that are made from the rows of ``track_table`` alone where both are asked for.
FROM_TRACK_TABLE: dict[str, Callable[[DataFrame], DataFrame]] = {"album_work": _album_work_of, "tracks": _tracks_of}

# Bronze columns each table reads.
INPUT = {
    "albums": ("id", "artists", "title", "year", "label", "style", "cover_url", "_ingested_at",
               "_ingested_filename"),
    "artists": ("musicians", "leaders"),
    "album_artist": ("id", "musicians", "leaders"),
    "labels": ("label",),
    "works": ("tracklist",),
    "album_work": ("id", "tracklist"),
    "album_label": ("id", "label"),
    "tracks": ("id", "tracklist"),
}

# Dimensions before links, as a graph load needs them.
TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "albums": albums,
    "artists": artists,
    "album_artist": album_artist,
    "labels": labels,
    "works": works,
    "album_work": album_work,
    "album_label": album_label,
    "tracks": tracks,
}


def all_tables(bronze: DataFrame) -> dict[str, DataFrame]:
    return {name: build(bronze) for name, build in TABLES.items()}


def split_corrupt(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt-text column, and rows to set aside.

    Set aside are unparsable documents and documents without an album id.
    """
    bad = F.col("id").isNull()
    if fv.CORRUPT_COLUMN in bronze.columns:
        bad = bad | F.col(fv.CORRUPT_COLUMN).isNotNull()
    return bronze.where(~bad).drop(fv.CORRUPT_COLUMN), bronze.where(bad)
