"""Graph questions about albums, for one id or for a table of ids.

All of them show an album as a "card": its tracks, leaders and participants as distinct sorted
names, and its label, with one row per label. A card is aggregated per edge type before anything
is joined, and only for the albums asked for.

A bulk question would repeat an album's lists in every row that album is part of, so it leaves them
out unless asked with ``with_lists=True``, and its result is as long as the edges are; the lists are
one ``album_cards`` row per album, or one ``album_names`` row per name for albums of any size.

Rows are in order of year and title (nulls last), then album and label, so a limit keeps the same rows
on every run. A ``limit`` holds for each id of a bulk question, too; the rows are chosen before any list
is gathered.

Hot keys (an artist on a third of all albums) meet in joins only, which adaptive execution splits, and in
the choice of the first rows, which tasks make among their own rows first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from linernotes import fixed_values as fv
from linernotes.operators.graph import Graph

LISTS = ["tracks", "leaders", "participants"]


def check_years(year_min: int | None, year_max: int | None) -> None:
    for year in (year_min, year_max):
        if year is not None and not fv.QUERY_YEAR_MIN <= year <= fv.QUERY_YEAR_MAX:
            raise ValueError(
                f"year {year} is outside {fv.QUERY_YEAR_MIN}..{fv.QUERY_YEAR_MAX}"
            )


def in_years(
    albums: DataFrame, year_min: int | None = None, year_max: int | None = None
) -> DataFrame:
    """Albums in an inclusive range; albums without a year pass only when no bound is set."""
    check_years(year_min, year_max)
    if year_min is not None:
        albums = albums.where(F.col("year") >= year_min)
    if year_max is not None:
        albums = albums.where(F.col("year") <= year_max)
    return albums


def distinct_ids(ids: list[str], at_least: int = 1) -> list[str]:
    """The ids without repeats, first occurrence first."""
    unique = list(dict.fromkeys(ids))
    if len(unique) < at_least:
        raise ValueError(f"at least {at_least} different ids are needed")
    return unique


def distinct_id_lists(requests: DataFrame, ids: str, at_least: int = 1) -> DataFrame:
    """The same for a column of id lists; requests with too few different ids are left out."""
    return requests.withColumn(ids, F.array_distinct(ids)).where(F.size(ids) >= at_least)


def _only(rows: DataFrame, albums: DataFrame | None) -> DataFrame:
    """Rows of the given albums, or all. Spark chooses how to join by the ids' size."""
    return rows if albums is None else rows.join(albums.select("album_id"), "album_id", "left_semi")


def _named_edges(graph: Graph, albums: DataFrame | None, lists: list[str] = LISTS) -> DataFrame:
    people = graph.of_albums("leads").select(
        "album_id", "artist_id", F.lit("leaders").alias("kind")
    ).unionByName(
        graph.of_albums("plays_in").select("album_id", "artist_id", F.lit("participants").alias("kind"))
    )
    people = _only(people, albums).join(graph.artists, "artist_id")
    if "tracks" not in lists:
        return people.select("album_id", "kind", "name")
    titles = _only(graph.of_albums("contains"), albums).join(graph.works, "work_id")
    return people.select("album_id", "kind", "name").unionByName(
        titles.select(
            "album_id", F.lit("tracks").alias("kind"), F.col("work_title").alias("name")
        )
    )


def album_names(graph: Graph, albums: DataFrame | None = None) -> DataFrame:
    """Distinct (album_id, kind, name): the cards' lists as rows, for albums of any size."""
    return _named_edges(graph, albums).distinct()


def album_lists(graph: Graph, albums: DataFrame | None = None, lists: list[str] = LISTS) -> DataFrame:
    """Per album its lists of names, three or those asked for; albums without an edge of these have no row."""
    collected = [
        F.sort_array(F.collect_set(F.when(F.col("kind") == k, F.col("name")))).alias(k)
        for k in lists
    ]
    return _named_edges(graph, albums, lists).groupBy("album_id").agg(*collected)


def _no_null_lists(lists: list[str] = LISTS) -> dict[str, Column]:
    empty = F.array().cast("array<string>")
    return {c: F.coalesce(c, empty) for c in lists}


def album_labels(graph: Graph, albums: DataFrame | None = None) -> DataFrame:
    """(album_id, label): the label nodes' names."""
    edges = _only(graph.released_by, albums).join(graph.labels, "label_id")
    return edges.select("album_id", F.col("name").alias("label"))


def album_cards(
    graph: Graph, albums: DataFrame | None = None, with_lists: bool = True, cut: bool = True,
    asked: list[str] = LISTS,
) -> DataFrame:
    """The cards of the given albums (rows of the album node table), or of all.

    With ``cut`` the edges are cut down to those albums first; leave it off for most of the albums. Edges of
    lists that are not ``asked`` for are not read. Columns: album_id, ensemble, title, tracks, leaders, participants, year, label, cover.
    """
    ids = albums if cut else None
    cards = (graph.albums if albums is None else albums).drop("label")
    cards = cards.join(album_labels(graph, ids), "album_id", "left")
    lists: list[str] = []
    if with_lists:
        lists = asked
        cards = cards.join(album_lists(graph, ids, lists), "album_id", "left").withColumns(_no_null_lists(lists))
    cover = F.col("cover_url").alias("cover")
    return cards.select("album_id", "ensemble", "title", *lists, "year", "label", cover)


def _asked(nodes: DataFrame, key: str, ids: str | DataFrame | None) -> DataFrame:
    """The nodes asked for. One id is one row, as keys are unique: small enough to broadcast."""
    if ids is None:
        return nodes
    if isinstance(ids, DataFrame):
        return nodes.join(ids.select(key), key, "left_semi")
    return F.broadcast(nodes.where(F.col(key) == ids))


def _order() -> list[Column]:
    """Year and title, nulls last; album and label decide among equal ones."""
    return [F.asc_nulls_last(c) for c in ("year", "title", "album_id", "label")]


#: Up to this limit Spark's row-number filter keeps the first rows in each task before its shuffle.
FEW = 1000
PARTS = 64


def _first(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The first rows of each key, or of all where there is no key.

    Spark cuts each task's rows to a few before they meet; of more than ``FEW`` the first of 64 parts of a
    key are taken, then of those, so that no task sorts all rows of a hot key.
    """
    if not keys:
        return rows.orderBy(*_order()).limit(limit)
    part = F.pmod(F.xxhash64("album_id"), F.lit(PARTS))
    for by in ([[*keys, part]] if limit > FEW else []) + [keys]:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*_order()))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")
    return rows


def _answer(
    graph: Graph, mine: DataFrame, albums: DataFrame, keys: list[str], columns: list[str],
    with_lists: bool, limit: int | None, cut: bool,
) -> DataFrame:
    """The cards of the albums in ``mine``; sorted where one id is asked for, that is without keys."""
    if limit is not None and limit < 0:
        raise ValueError(f"a limit can't be {limit}")
    chosen = _only(albums, mine) if cut else albums
    lists = [c for c in LISTS if c in columns]
    if limit is None:
        rows = mine.join(album_cards(graph, chosen, with_lists, cut, lists), "album_id")
    else:
        rows = _first(mine.join(album_cards(graph, chosen, False, cut), "album_id"), keys, limit)
        if with_lists:
            rows = rows.join(album_lists(graph, rows, lists), "album_id", "left").withColumns(_no_null_lists(lists))
    rows = rows if keys else rows.orderBy(*_order())
    shown = {"album_title": F.col("title").alias("album_title")}
    return rows.select(*keys, *[shown.get(c, c) for c in _shown(columns, with_lists)])


def _shown(columns: list[str], with_lists: bool) -> list[str]:
    return columns if with_lists else [c for c in columns if c not in LISTS]


def _is_single(ids: str | int | DataFrame | None) -> bool:
    return not (ids is None or isinstance(ids, DataFrame))


def _artist_albums(
    graph, name, artist, year_min, year_max, limit, with_lists, columns
) -> DataFrame:
    single = _is_single(artist)
    with_lists = single if with_lists is None else with_lists
    people = _asked(graph.artists, "artist_id", artist).withColumnRenamed("name", "artist")
    mine = getattr(graph, name)
    mine = mine.where(F.col("artist_id") == artist) if single else mine
    mine = mine.join(people, "artist_id")
    albums = in_years(graph.albums, year_min, year_max)
    # Where all artists are asked for, or no list is shown, there is nothing worth cutting down.
    cut = single or (with_lists and artist is not None)
    keys = [] if single else ["artist_id"]
    return _answer(graph, mine, albums, keys, columns, with_lists, limit, cut)


def artist_sessions(
    graph: Graph,
    artist: str | DataFrame | None,
    year_min: int | None = None,
    year_max: int | None = None,
    limit: int | None = None,
    with_lists: bool | None = None,
) -> DataFrame:
    """Albums an artist plays on. A DataFrame of ``artist_id`` asks for many at once, None for all."""
    columns = ["artist", "album_id", "ensemble", "title", *LISTS, "year", "label", "cover"]
    return _artist_albums(
        graph, "plays_in", artist, year_min, year_max, limit, with_lists, columns
    )


def leader_sessions(
    graph: Graph,
    artist: str | DataFrame | None,
    year_min: int | None = None,
    year_max: int | None = None,
    limit: int | None = None,
    with_lists: bool | None = None,
) -> DataFrame:
    """Albums an artist leads."""
    columns = ["artist", "ensemble", "title", *LISTS, "year", "label", "cover"]
    return _artist_albums(graph, "leads", artist, year_min, year_max, limit, with_lists, columns)


COLLAB_COLUMNS = [
    "album_id", "ensemble", "title", "leaders", "participants", "year", "label", "cover",
]


def collab_albums(
    graph: Graph,
    artists: list[str],
    year_min: int | None = None,
    year_max: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Albums on which all of at least two artists play."""
    wanted = distinct_ids(artists, at_least=2)
    together = (
        graph.plays_in.where(F.col("artist_id").isin(wanted))
        .groupBy("album_id")
        .agg(F.count_distinct("artist_id").alias("n"))
        .where(F.col("n") == len(wanted))
    )
    albums = in_years(graph.albums, year_min, year_max)
    return _answer(graph, together.select("album_id"), albums, [], COLLAB_COLUMNS, True, limit, True)


def request_sets(requests: DataFrame) -> DataFrame:
    """(request_id, set_id, artists) of requests of at least two artists; ``set_id`` is the least request of that set.

    A request without an id, or for an artist without one, has no shared albums and is left out.
    """
    wanted = requests.select("request_id", "artist_id").where(F.col("request_id").isNotNull()).distinct()
    lists = wanted.groupBy("request_id").agg(
        F.sort_array(F.collect_set("artist_id")).alias("artists"), F.count(F.lit(1)).alias("_size")
    )
    asked = lists.where((F.size("artists") == F.col("_size")) & (F.col("_size") >= 2)).drop("_size")
    sets = asked.groupBy("artists").agg(F.min("request_id").alias("set_id"))
    return asked.join(sets, "artists").select("request_id", "set_id", "artists")


def shared_albums(graph: Graph, requests: DataFrame) -> DataFrame:
    """(request_id, album_id) for requests (request_id, artist_id) of at least two artists.

    Requests for the same artists are answered once. Each set of artists starts from its artist with the
    fewest albums, and those albums are then checked for the others: an artist on a third of all albums
    costs a request nothing extra unless all its artists are like that. Plays are not broadcast: in files,
    by which Spark goes, they are in order and take a hundredth of what they do in memory.
    """
    asked = request_sets(requests)
    sets = asked.where(F.col("request_id") == F.col("set_id"))
    wanted = sets.select("set_id", F.size("artists").alias("size"), F.explode("artists").alias("artist_id"))
    known = wanted.select("artist_id").distinct()
    plays = graph.plays_in.join(known, "artist_id", "left_semi")
    albums_of = plays.groupBy("artist_id").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min_by("artist_id", F.struct(F.coalesce("n", F.lit(0)), "artist_id"))
    starts = wanted.join(albums_of, "artist_id", "left").groupBy("set_id").agg(rarest.alias("start"))
    others = starts.join(wanted, "set_id").where(F.col("artist_id") != F.col("start"))
    begun = plays.select(F.col("artist_id").alias("start"), "album_id")
    candidates = others.join(begun.hint("merge"), "start").select("set_id", "album_id", "size", "artist_id")
    present = candidates.join(plays.hint("merge"), ["album_id", "artist_id"], "left_semi")
    shared = (
        present.groupBy("set_id", "album_id", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == F.col("size") - 1)
    )
    return shared.join(asked.drop("artists"), "set_id").select("request_id", "album_id")


def collab_albums_bulk(
    graph: Graph,
    requests: DataFrame,
    year_min: int | None = None,
    year_max: int | None = None,
    with_lists: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Shared albums for many requests; requests of fewer than two artists give no row."""
    shared = shared_albums(graph, requests)
    albums = in_years(graph.albums, year_min, year_max)
    # Lists are worth cutting the edges down for; without them there is little to cut.
    return _answer(graph, shared, albums, ["request_id"], COLLAB_COLUMNS, with_lists, limit, with_lists)


def album_detail(graph: Graph, album: int | DataFrame | None = None) -> DataFrame:
    """One struct column ``album`` per card, of one id, a table of ids or all albums."""
    if album is None:
        cards = album_cards(graph)
    else:
        cards = album_cards(graph, _asked(graph.albums, "album_id", album))
    columns = ["album_id", "ensemble", "title", *LISTS, "year", "label", "cover"]
    return cards.select(F.struct(*columns).alias("album"))


def work_appearances(
    graph: Graph,
    work: str | DataFrame | None,
    limit: int | None = None,
    with_lists: bool | None = None,
) -> DataFrame:
    """Albums that contain a work, each with all its tracks and people."""
    single = _is_single(work)
    with_lists = single if with_lists is None else with_lists
    mine = graph.contains.where(F.col("work_id") == work) if single else graph.contains
    mine = mine.join(_asked(graph.works, "work_id", work), "work_id")
    cut = single or (with_lists and work is not None)
    keys = [] if single else ["work_id"]
    columns = ["work_title", "ensemble", "album_title", *LISTS, "year", "label", "cover"]
    return _answer(graph, mine, graph.albums, keys, columns, with_lists, limit, cut)


def led_sessions_of(graph: Graph, name: str) -> DataFrame:
    """Players of one display name, the albums they play on, and those albums' leaders."""
    players = graph.artists.where(F.col("name") == name).select(
        F.col("artist_id").alias("player_id"), F.col("name").alias("player")
    )
    plays = graph.plays_in.select(F.col("artist_id").alias("player_id"), "album_id")
    leads = graph.leads.select(F.col("artist_id").alias("leader_id"), "album_id")
    leaders = graph.artists.select(
        F.col("artist_id").alias("leader_id"), F.col("name").alias("leader")
    )
    return (
        plays.join(players, "player_id")
        .join(graph.albums.select("album_id", "title"), "album_id")
        .join(leads, "album_id")
        .join(leaders, "leader_id")
        .select("player_id", "player", "album_id", "title", "leader_id", "leader")
    )
