"""Curation of landed catalogue documents into album records.

Four landed tables stand in for the catalogue's documents, one row per document:

* search results: type, id, year, format, format_descriptions, label, style, cover_image,
  master_url, resource_url, plus where they were found: style_query, page, position
* masters: url, id, year, title, styles, main_release_url, most_recent_release_url
* releases: url, title, master_id, master_url, labels, tracklist, extraartists, artists
* artist details: url, members

Following a URL is an equi-join on it. The nested payload of a release (tracklist, credits) is
joined last, for the surviving albums only, so it is never shuffled for a rejected result; of it
only the parts an album record needs go on.

URLs named by very many rows (a group on a third of all releases) meet in joins only, which adaptive
execution splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linernotes import fixed_values as fv
from linernotes.config import CurationConfig
from linernotes.functions import credits as cr, labels as lb
from linernotes.functions.titles import clean_tracklist

ALBUM_COLUMNS = [
    "artists", "title", "id", "year", "label", "tracklist", "musicians", "leaders", "style",
    "cover_url",
]


@dataclass(frozen=True)
class Catalogue:
    search: DataFrame
    masters: DataFrame
    releases: DataFrame
    artist_details: DataFrame


# ---- settings as small tables -------------------------------------------------------------


def enabled_styles(spark: SparkSession, cfg: CurationConfig) -> DataFrame:
    """Enabled styles with their place in the settings."""
    rows = list(enumerate(cfg.enabled_styles))
    return spark.createDataFrame([(s, i) for i, s in rows], "style STRING, position INT")


def enabled_labels(spark: SparkSession, cfg: CurationConfig) -> DataFrame:
    """Enabled label keys, canonical names and their place in the settings."""
    rows = [(k, n, i) for i, (k, n) in enumerate(cfg.enabled_labels.items())]
    return spark.createDataFrame(rows, "key STRING, name STRING, position INT")


def search_scope(styles: DataFrame, first: int, last: int) -> DataFrame:
    """One row per enabled style and year; an explode, since the years are a known range."""
    years = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year")
    return styles.select("style", "position", years)


# ---- filters on search results ------------------------------------------------------------


def _style_position(c: Column, styles: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in styles]), c) if styles else F.lit(0)


def in_scope(search: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Results found under an enabled style."""
    return search.where(F.col("style_query").isin(cfg.enabled_styles))


def valid_year(year: Column, first: int, last: int) -> Column:
    """True for an all-digit year inside the range, both ends included."""
    return year.rlike(r"^[0-9]+\z") & year.try_cast("int").between(first, last)


def master_year_ok(year: Column, first: int) -> Column:
    """Lower bound only; a missing year or 0 is out."""
    number = year.try_cast("int")
    return (number != 0) & (number >= first)


def accept_results(search: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Results in scope, in years, not singles, on an enabled label; adds ``label_hint``."""
    hint = lb.first_known_label(F.col("label"), cfg.enabled_labels)
    return (
        in_scope(search, cfg)
        .where(valid_year(F.col("year"), cfg.first_year, cfg.last_year))
        .where(lb.is_album_format(F.col("format"), F.col("format_descriptions")))
        .withColumn("label_hint", hint)
        .where(F.col("label_hint").isNotNull())
    )


# ---- results to masters -------------------------------------------------------------------


def _or_unmatched(url: Column, row_id: Column) -> Column:
    """The URL, or a value no URL equals. Rows without one then spread over all partitions
    of an outer join, where nulls would all meet in one."""
    return F.coalesce(url, F.concat(F.lit("#"), F.coalesce(row_id.cast("string"), F.lit(""))))


def _document_url(url: Column, kind: str, doc_id: Column, base: str) -> Column:
    built = F.concat(F.lit(f"{base}/{kind}/"), doc_id.cast("string"))
    return F.coalesce(F.when(url != "", url), built)


def release_master_urls(results: DataFrame, releases: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Search results of type release, with the master URL their release document names."""
    wanted = results.where(F.col("type") == "release").withColumn(
        "release_url", _document_url(F.col("resource_url"), "releases", F.col("id"), cfg.url_base)
    )
    # A master id of 0 is no master.
    mid = F.when(F.col("master_id") != 0, F.col("master_id"))
    links = releases.select(
        F.col("url").alias("release_url"),
        _document_url(F.col("master_url"), "masters", mid, cfg.url_base).alias("_master"),
    ).where(F.col("_master").isNotNull())
    return wanted.join(links, "release_url").withColumn("master_url", F.col("_master")).drop(
        "_master", "release_url"
    )


def to_masters(results: DataFrame, catalogue: Catalogue, cfg: CurationConfig) -> DataFrame:
    """Master results as they are, release results under their master; other types are dropped.

    Adds the master's main and most recent release URL. A release result takes id, year and
    style from the master and keeps its own cover; it is dropped when the master is missing.
    """
    direct = results.where(F.col("type") == "master")
    resolved = release_master_urls(results, catalogue.releases, cfg)
    masters = catalogue.masters.select(
        F.col("url").alias("_url"),
        F.struct("id", "year", "styles", "main_release_url", "most_recent_release_url").alias("m"),
    )
    both = direct.unionByName(resolved)
    url = F.nullif("master_url", F.lit(""))
    both = both.withColumn("_key", _or_unmatched(url, F.col("id"))).join(
        masters, F.col("_key") == F.col("_url"), "left"
    )
    is_master = F.col("type") == "master"
    no_strings = cr.no_strings()
    return both.where(is_master | F.col("m").isNotNull()).select(
        F.when(is_master, F.col("id")).otherwise(F.col("m.id")).alias("id"),
        F.when(is_master, F.col("year")).otherwise(F.col("m.year").cast("string")).alias("year"),
        F.coalesce(F.when(is_master, F.col("style")).otherwise(F.col("m.styles")), no_strings)
        .alias("style"),
        F.col("cover_image").alias("cover_url"),
        "label_hint", "style_query", "page", "position",
        F.col("year").alias("found_year"),
        F.nullif(F.col("m.main_release_url"), F.lit("")).alias("main_release_url"),
        F.nullif(F.col("m.most_recent_release_url"), F.lit("")).alias("most_recent_release_url"),
    )


def credited_ensemble(artists: Column) -> Column:
    """First credited artist's name, "" when there is none."""
    return F.coalesce(F.get(artists, 0)["name"], F.lit(""))


def drop_compilations(albums: DataFrame, ensemble: Column) -> DataFrame:
    return albums.where(~F.coalesce(F.lower(ensemble) == fv.COMPILATION_CREDIT, F.lit(False)))


def without_compilations(candidates: DataFrame, releases: DataFrame) -> DataFrame:
    """Candidates whose main release is not credited to "Various"."""
    heads = releases.select(
        F.col("url").alias("_url"), credited_ensemble(F.col("artists")).alias("_ensemble")
    )
    key = _or_unmatched(F.col("main_release_url"), F.col("id"))
    joined = candidates.withColumn("_key", key).join(heads, F.col("_key") == F.col("_url"), "left")
    return drop_compilations(joined, F.col("_ensemble")).drop("_key", "_url", "_ensemble")


def not_stored(candidates: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Candidates whose album id is not among the stored ones."""
    if stored is None:
        return candidates
    return candidates.join(stored.select("id"), "id", "left_anti")


def search_order(cfg: CurationConfig) -> list[Column]:
    """The order in which results come up: style by style, year by year, page by page."""
    return [
        _style_position(F.col("style_query"), cfg.enabled_styles),
        F.col("found_year").cast("int"), F.col("page"), F.col("position"),
    ]


def first_seen(candidates: DataFrame, order: list[Column], key: str = "id") -> DataFrame:
    """One row per key, the least in the given order; combines before the shuffle."""
    rest = [c for c in candidates.columns if c != key]
    row = F.struct(*rest)
    best = F.min_by(row, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return candidates.groupBy(key).agg(best.alias("_row")).select(key, "_row.*")


# ---- masters to albums --------------------------------------------------------------------


def _of_urls(releases: DataFrame, urls: DataFrame) -> DataFrame:
    """The releases whose URL is asked for: nested rows are cut down before they move."""
    wanted = urls.toDF("url").where("url IS NOT NULL")
    return releases.join(wanted, "url", "left_semi")


def main_release(albums: DataFrame, releases: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Albums with what is needed of their main release, nothing else of it.

    Adds ``artists``, ``title``, ``tracklist``, ``label_names``, ``group`` (name and URL of the
    credited group), ``main_players`` and ``has_release``. Without a main release the texts are ""
    and the lists empty.
    """
    titles = F.transform("tracklist", lambda t: t["title"])
    rel = _of_urls(releases, albums.select("main_release_url")).select(
        F.col("url").alias("_url"),
        F.struct(
            credited_ensemble(F.col("artists")).alias("artists"), "title",
            clean_tracklist(titles).alias("tracklist"),
            F.transform("labels", lambda x: x["name"]).alias("label_names"),
            credited_group(F.col("artists")).alias("group"),
            cr.players(F.col("extraartists"), cfg.performing_roles, cfg.excluded_roles)
            .alias("main_players"),
        ).alias("_main"),
    )
    key = _or_unmatched(F.col("main_release_url"), F.col("id"))
    text = lambda name: F.coalesce(F.col(f"_main.{name}"), F.lit(""))
    names = lambda name: F.coalesce(F.col(f"_main.{name}"), cr.no_strings())
    return (
        albums.withColumn("_key", key)
        .join(rel, F.col("_key") == F.col("_url"), "left")
        .withColumns({
            "artists": text("artists"), "title": text("title"), "tracklist": names("tracklist"),
            "label_names": F.col("_main.label_names"), "group": F.col("_main.group"),
            "main_players": names("main_players"), "has_release": F.col("_main").isNotNull(),
        })
        .drop("_key", "_url", "_main")
    )


def album_players(albums: DataFrame, releases: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Adds ``musicians``: the main release's players, else the most recent release's.

    Only albums without players of their own look up the recent release, by id and URL alone.
    """
    url = F.col("most_recent_release_url")
    lacking = F.col("has_release") & (F.size("main_players") == 0) & (url != F.col("main_release_url"))
    wanted = albums.where(lacking).select("id", url.alias("url"))
    recent = _of_urls(releases, wanted.select("url")).select(
        "url", cr.players(F.col("extraartists"), cfg.performing_roles, cfg.excluded_roles).alias("_recent")
    )
    found = wanted.join(recent, "url").select("id", "_recent")
    raw = F.when(F.size("main_players") > 0, F.col("main_players")).otherwise(
        F.coalesce("_recent", cr.no_strings())
    )
    return albums.join(found, "id", "left").withColumn("musicians", cr.clean_players(raw)).drop("_recent")


def credited_group(artists: Column) -> Column:
    """First credited artist as a struct of ``group_name`` (name, else variation) and its URL."""
    first = F.get(artists, 0)
    name = F.coalesce(F.nullif(first["name"], F.lit("")), first["anv"])
    return F.struct(
        F.regexp_replace(name, r"(?Ud)^\s+|\s+$", "").alias("group_name"),
        F.nullif(first["resource_url"], F.lit("")).alias("group_url"),
    )


def member_leaders(
    groups: DataFrame, artist_details: DataFrame, wanted: Column | None = None
) -> DataFrame:
    """Adds ``members_found``: members of the group that its own name mentions.

    Needs ``group_name`` and ``group_url``; rows not wanted are not looked up. Where several documents have a group's
    URL there is a row for each of them; of equal ones the members are compared once, before the rows are repeated.
    """
    asked = F.length("group_name") > 0
    if wanted is not None:
        asked = asked & wanted
    row_id = F.xxhash64("group_name", "group_url", *[c for c in ("id", "url") if c in groups.columns])
    details = artist_details.select(
        F.col("url").alias("_url"), F.transform("members", lambda m: m["name"]).alias("_members")
    ).groupBy("_url", "_members").agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    found = (
        groups.withColumn("_key", _or_unmatched(F.when(asked, F.col("group_url")), row_id))
        .join(details, F.col("_key") == F.col("_url"), "left")
        .withColumn("members_found", cr.members_named_in(F.col("group_name"), F.col("_members")))
        .drop("_key", "_url", "_members")
    )
    copies = F.array_repeat(F.lit(True), F.coalesce("_copies", F.lit(1)))
    return found.withColumn("_copies", F.explode(copies)).drop("_copies")


def album_leaders(albums: DataFrame, artist_details: DataFrame) -> DataFrame:
    """Adds ``leaders``: players named in the credit, else group members, else the ensemble."""
    credited = albums.withColumn("_credited", cr.named_in(F.col("artists"), F.col("musicians")))
    groups = credited.select(*credited.columns, "group.*")
    none_credited = F.size("_credited") == 0
    found = F.when(none_credited, F.col("members_found")).otherwise(F.col("_credited"))
    return (
        member_leaders(groups, artist_details, none_credited)
        .withColumn("leaders", cr.leaders_or_ensemble(found, F.col("artists")))
        .drop("_credited", "group_name", "group_url", "members_found")
    )


def album_label(albums: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Adds ``label``: the release's label by rule, without its number."""
    label = lb.release_label(F.col("label_names"), F.col("label_hint"), cfg.enabled_labels)
    return albums.withColumn("label", lb.drop_label_number(label))


def album_records(albums: DataFrame) -> DataFrame:
    """The ten columns of a landed album record."""
    return albums.withColumn("style", F.coalesce("style", cr.no_strings())).select(*ALBUM_COLUMNS)


def curate(
    catalogue: Catalogue, cfg: CurationConfig, stored: DataFrame | None = None
) -> DataFrame:
    """Album records of all accepted results, one per master, the first seen."""
    candidates = to_masters(accept_results(catalogue.search, cfg), catalogue, cfg)
    in_years = candidates.where(master_year_ok(F.col("year"), cfg.first_year))
    accepted = without_compilations(not_stored(in_years, stored), catalogue.releases)
    unique = first_seen(accepted, search_order(cfg))
    albums = main_release(unique, catalogue.releases, cfg)
    albums = album_players(albums, catalogue.releases, cfg)
    albums = album_leaders(albums, catalogue.artist_details)
    return album_records(album_label(albums, cfg))
