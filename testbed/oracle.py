"""The registered queries as SQL over the same tables, written independently of the library."""

from __future__ import annotations

import hashlib

from linernotes import fixed_values as fv
from testbed import views

BASE = views.BASE


def norm(x: str) -> str:
    folded = f"translate(lower(trim({x}, ' ')), '{fv.FOLD_FROM}', '{fv.FOLD_TO}')"
    words = f"regexp_replace({folded}, '[^A-Za-z0-9_\\s]', ' ', 'g')"
    return f"trim(regexp_replace({words}, '\\s+', ' ', 'g'), ' ')"


def strip_takes(x: str) -> str:
    bare = f"regexp_replace({x}, '(?i:\\s*\\([^)]*\\btake\\b[^)]*\\))', '', 'g')"
    return f"trim(regexp_replace({bare}, '\\s+', ' ', 'g'), ' ')"


def year_number(x: str) -> str:
    digits = f"regexp_extract(trim({x}, ' '), '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1)"
    return f"TRY_CAST({digits} AS INTEGER)"


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, '|'), '')"


def names_of(x: str) -> str:
    """A distinct sorted list as text, empty for no rows."""
    return f"coalesce(string_agg(DISTINCT {x}, '|' ORDER BY {x}), '')"


# ---- album records, gold, graph ------------------------------------------------------------

RECORDS = """
items AS (
  SELECT *, coalesce(l_orderkey, o_orderkey) AS id, o_orderkey % 11 = 0 AS is_low
  FROM orders
  LEFT JOIN lineitem ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey),
bronze AS MATERIALIZED (
  SELECT id,
    CASE WHEN l_orderkey IS NULL THEN 'Various' ELSE ' ' || s_name || ' Quintet' END AS artists,
    '  ' || o_orderpriority || ' Session ' AS title,
    CASE WHEN id % 97 = 0 THEN 'n/a' WHEN id % 89 = 0 THEN year(o_orderdate)::VARCHAR || '.0'
         ELSE year(o_orderdate)::VARCHAR END AS year,
    CASE WHEN id % 101 = 0 THEN '  ' WHEN is_low THEN lower(c_mktsegment)
         WHEN l_linenumber = 7 THEN c_mktsegment || ' Records'
         WHEN id % 7 = 0 THEN c_mktsegment || ' ' ELSE c_mktsegment END AS label,
    CASE WHEN l_orderkey IS NOT NULL THEN [
      CASE WHEN l_linenumber % 3 = 0 THEN p_name || ' (take ' || l_linenumber || ')'
           WHEN l_linenumber = 5 THEN ' ' || p_name || '  (Alternate Take)'
           WHEN l_linenumber = 2 THEN upper(p_name) ELSE p_name END,
      p_name || ' No. ' || p_partkey,
      CASE WHEN l_linenumber = 4 THEN '???' END] END AS tracklist,
    CASE WHEN l_orderkey IS NOT NULL THEN [
      CASE WHEN l_linenumber % 3 = 0 THEN upper(s_name)
           WHEN l_linenumber = 5 THEN replace(s_name, 'u', 'ü') ELSE s_name END,
      s_name,
      CASE WHEN l_linenumber = 6 THEN '' END] END AS musicians,
    CASE WHEN l_linenumber = 1 THEN [s_name] WHEN l_linenumber = 2 THEN [' ']
         WHEN l_linenumber < 7 THEN []::VARCHAR[] END AS leaders,
    CASE WHEN l_orderkey IS NOT NULL THEN [p_type, 'Hard Bop'] END AS style,
    CASE WHEN l_returnflag <> 'R' THEN 'http://covers/' || l_orderkey END AS cover_url,
    coalesce(l_shipdate, o_orderdate) AS _ingested_at,
    concat_ws('-', id::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR)
      AS _ingested_filename
  FROM items)"""


def gold_ctes(source: str = "bronze", prefix: str = "") -> str:
    p = prefix
    return f"""
{p}albums AS (
  SELECT id AS album_id, trim(artists, ' ') AS ensemble, trim(title, ' ') AS title,
    {year_number('year')} AS year, trim(label, ' ') AS label, style AS styles, cover_url
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ingested_at, _ingested_filename) AS rn
        FROM {source}) WHERE rn = 1),
{p}labels AS (
  SELECT DISTINCT sha256(lower(trim(label, ' '))) AS label_id, trim(label, ' ') AS name
  FROM {source} WHERE trim(label, ' ') <> ''),
{p}credits AS (
  SELECT id, trim(unnest(leaders), ' ') AS name, 'leader' AS role FROM {source}
  UNION ALL
  SELECT id, trim(unnest(musicians), ' ') AS name, 'musician' AS role FROM {source}),
{p}normed AS MATERIALIZED (
  SELECT id, name, role, {norm('name')} AS norm FROM {p}credits WHERE name <> ''),
{p}artists AS (
  SELECT sha256(norm) AS artist_id, name FROM (
    SELECT norm, name, row_number() OVER (PARTITION BY norm ORDER BY count(*) DESC, name) AS rn
    FROM {p}normed WHERE norm <> '' GROUP BY norm, name) WHERE rn = 1),
{p}album_artist AS MATERIALIZED (
  SELECT DISTINCT id AS album_id, sha256(norm) AS artist_id, role FROM {p}normed WHERE norm <> ''),
{p}titles AS (
  SELECT id, unnest(tracklist) AS raw, generate_subscripts(tracklist, 1) AS pos, _ingested_filename
  FROM {source}),
{p}cleaned AS MATERIALIZED (
  SELECT id, pos, clean, {norm('clean')} AS norm FROM (
    SELECT id, pos, {strip_takes('raw')} AS clean FROM {p}titles WHERE trim(raw, ' ') <> '')),
{p}works AS (
  SELECT sha256(norm) AS work_id, clean AS work_title FROM (
    SELECT norm, clean, row_number() OVER (PARTITION BY norm ORDER BY count(*) DESC, clean) AS rn
    FROM {p}cleaned WHERE norm <> '' GROUP BY norm, clean) WHERE rn = 1),
{p}album_work AS MATERIALIZED (
  SELECT DISTINCT id AS album_id, sha256(norm) AS work_id FROM {p}cleaned WHERE norm <> ''),
{p}album_label AS (
  SELECT DISTINCT id AS album_id, sha256(lower(trim(label, ' '))) AS label_id
  FROM {source} WHERE trim(label, ' ') <> ''),
{p}tracks AS (
  SELECT sha256(id || '#' || norm) AS track_id, id AS album_id, clean AS name FROM (
    SELECT id, norm, clean, row_number() OVER (PARTITION BY id, norm ORDER BY pos, clean) AS rn
    FROM {p}cleaned WHERE norm <> '') WHERE rn = 1)"""


GOLD = RECORDS + "," + gold_ctes()

GRAPH = GOLD + f""",
label_nodes AS (SELECT label_id, min(name) AS name FROM labels GROUP BY label_id),
leads AS (SELECT DISTINCT artist_id, album_id FROM album_artist WHERE role = 'leader'),
plays_in AS MATERIALIZED (SELECT DISTINCT artist_id, album_id FROM album_artist),
led AS (
  SELECT album_id, {names_of('name')} AS leaders FROM leads JOIN artists USING (artist_id)
  GROUP BY album_id),
played AS (
  SELECT album_id, {names_of('name')} AS participants FROM plays_in JOIN artists USING (artist_id)
  GROUP BY album_id),
held AS (
  SELECT album_id, {names_of('work_title')} AS tracks FROM album_work JOIN works USING (work_id)
  GROUP BY album_id),
released AS (
  SELECT album_id, name AS label FROM album_label JOIN label_nodes USING (label_id)),
cards AS MATERIALIZED (
  SELECT a.album_id, a.ensemble, a.title, coalesce(tracks, '') AS tracks,
    coalesce(leaders, '') AS leaders, coalesce(participants, '') AS participants,
    a.year, r.label, a.cover_url AS cover
  FROM albums a LEFT JOIN led USING (album_id) LEFT JOIN played USING (album_id)
  LEFT JOIN held USING (album_id) LEFT JOIN released r USING (album_id))"""

# Two loads: records delivered before a date, then the others.
LOADS = (
    RECORDS
    + f""",
early AS (SELECT * FROM bronze WHERE _ingested_at < TIMESTAMP '{views.SECOND_LOAD}'),
late AS (SELECT * FROM bronze WHERE _ingested_at >= TIMESTAMP '{views.SECOND_LOAD}'),"""
    + gold_ctes("early", "e_") + "," + gold_ctes("late", "l_")
)


def _upsert(table: str, key: str, props: str, order: str) -> str:
    return f"""WITH {LOADS}, both_loads AS (
      SELECT *, 1 AS age FROM e_{table} UNION ALL SELECT *, 0 AS age FROM l_{table})
    SELECT {key}, {props} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY age{order}) AS rn
      FROM both_loads) WHERE rn = 1"""


# Nodes that are missing when edges are loaded, so that both ends' checks show.
KNOWN = {
    "album_id": "album_id % 10 <> 3", "artist_id": "artist_id < 'e'", "work_id": "work_id < 'e'",
    "label_id": "label_id < 'c'",
}


def _edges(table: str, a: str, b: str, role: str = "TRUE") -> str:
    return f"""WITH {LOADS}
    SELECT DISTINCT {a}, {b} FROM (
      SELECT * FROM e_{table} UNION ALL SELECT * FROM l_{table})
    WHERE {role} AND {KNOWN[a]} AND {KNOWN[b]}"""


# ---- catalogue documents -------------------------------------------------------------------


def _pick(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "][l_linenumber]"


def known_label(names: str) -> str:
    case = "CASE " + " ".join(
        f"WHEN contains(lower(l), '{k}') THEN '{n}'"
        for k, n in views.CURATION.enabled_labels.items()
    ) + " END"
    return f"list_filter(list_transform({names}, lambda l: {case}), lambda c: c IS NOT NULL)[1]"


def album_format(a: str, b: str) -> str:
    hits = " OR ".join(f"contains(lower(f), '{w}')" for w in fv.SINGLE_FORMATS)
    return (
        f"len(list_filter(list_concat(coalesce({a}, []), coalesce({b}, [])), lambda f: {hits})) = 0"
    )


def _one_of(x: str, tokens: list[str]) -> str:
    return f"regexp_matches({x}, '{'|'.join(tokens)}')"


def players(credits: str) -> str:
    role = "lower(coalesce(c.role, ''))"
    keep = f"({_one_of(role, fv.PERFORMING_ROLES)} OR NOT {_one_of(role, fv.EXCLUDED_ROLES)})"
    kept = f"list_filter({credits}, lambda c: c.name <> '' AND {keep})"
    return f"coalesce(list_transform({kept}, lambda c: c.name), [])"


def clean_players(names: str) -> str:
    bare = f"list_transform(list_distinct({names}), lambda n: regexp_replace(n, '\\s*\\(\\d+\\)$', ''))"
    return f"list_sort({bare})"


def named_in(ensemble: str, names: str) -> str:
    hits = f"list_filter({names}, lambda n: contains(lower({ensemble}), lower(n)))"
    return f"CASE WHEN {ensemble} <> '' THEN coalesce({hits}, []) ELSE [] END"


def clean_title(x: str) -> str:
    steps = [
        ("(?i)^(.*)(\\s+-.*take.*)$", "\\1", ""),
        ("(?i)^(.*)\\s+-.*(\\([^)]*orig[^)]*\\))\\s*$", "\\1", ""),
        ("(?i)^(.*)\\s+(\\([^)]*orig[^)]*\\))\\s*$", "\\1", ""),
        ("(?i)^\\s*Band\\s*#\\d+\\s*[:\\-]?\\s*", "", ""),
        ("\\s+\\(?[A-Z]{1,3}\\d{3,5}.*$", "", ""),
        ("\\s*-\\s*\\d{1,2}\\s*$", "", ""),
        ("(?i)^(.*?)\\s*(\\([^)]*\\btake\\b[^)]*\\))\\s*$", "\\1", ""),
        ("(?i)\\s*(?:-|—)?\\s*(?:New|Short|Orig(?:inal)?\\.?|Only)\\s+Take(?:\\s*#?\\s*\\d+)?\\s*$",
         "", ""),
        ('^\\s*"(.+)"\\s*$', "\\1", ""),
        ("\\s{2,}", " ", "g"),
        ("^\\s+|\\s+$", "", "g"),
    ]
    out = x
    for pattern, new, flags in steps:
        out = f"regexp_replace({out}, '{pattern}', '{new}'" + (f", '{flags}')" if flags else ")")
    return f"CASE WHEN {x} NOT IN ('', '-') THEN {out} END"


def clean_tracklist(titles: str) -> str:
    each = f"list_transform({titles}, lambda t: {clean_title('t.title')})"
    return f"coalesce(list_filter({each}, lambda t: t <> ''), [])"


DOCUMENTS = f"""
release_rows AS (
  SELECT *, (l_orderkey * 10 + l_linenumber) * {views.RELEASES_A_LINE} + row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rid
  FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_returnflag) AS flag,
      year(min(l_shipdate)) AS ship_year
    FROM lineitem GROUP BY ALL)
  JOIN (SELECT p_partkey, p_name, p_brand AS brand FROM part) ON p_partkey = l_partkey
  JOIN (SELECT s_suppkey, s_name FROM supplier) ON s_suppkey = l_suppkey),
releases AS (
  SELECT rid, l_linenumber, '{BASE}/releases/' || rid AS url, upper(p_name) || ' Album' AS title,
    CASE WHEN l_linenumber = 5 THEN 0 ELSE l_orderkey END AS master_id,
    CASE WHEN l_linenumber <= 4 THEN '{BASE}/masters/' || l_orderkey
         WHEN l_linenumber = 6 THEN '' END AS master_url,
    CASE WHEN l_linenumber = 3 THEN []::VARCHAR[] WHEN l_linenumber = 4 THEN ['']
         ELSE ['Sub of ' || p_name || ' (6)', brand] END AS labels,
    [{{'title': p_name || {_pick(views.TRACK_SUFFIX_1)}}}, {{'title': '"' || p_name || '"'}},
     {{'title': '-'}}, {{'title': 'Band #3: ' || p_name || {_pick(views.TRACK_SUFFIX_2)}}}] AS tracklist,
    [{{'name': s_name || ' (2)',
       'role': CASE WHEN flag = 'A' THEN 'Mixed By' ELSE {_pick(views.ROLES_1)} END}},
     {{'name': s_name, 'role': {_pick(views.ROLES_2)}}},
     {{'name': s_name || ' (2)', 'role': 'Engineer'}}, {{'name': '', 'role': 'Piano'}}] AS extraartists,
    CASE WHEN flag = 'R' THEN 'Various' WHEN l_linenumber = 3 THEN '' ELSE s_name || ' Quintet'
      END AS artist,
    CASE WHEN flag = 'R' THEN 'Various' WHEN l_linenumber = 3 THEN s_name || ' Trio'
      ELSE s_name || ' Quintet' END AS group_name,
    '{BASE}/artists/' || s_name AS artist_url
  FROM release_rows),
masters AS (
  SELECT '{BASE}/masters/' || o_orderkey AS url, o_orderkey AS id,
    CASE WHEN o_orderkey % 19 = 0 THEN 0 ELSE year(o_orderdate) END AS year,
    CASE WHEN o_orderkey % 5 <> 0 THEN [o_orderpriority, 'Hard Bop'] END AS styles,
    '{BASE}/releases/' || ((o_orderkey * 10 + lo) * {views.RELEASES_A_LINE} + 1) AS main_url,
    CASE WHEN o_orderkey % 23 <> 0 THEN '{BASE}/releases/' || ((o_orderkey * 10 + hi) * {views.RELEASES_A_LINE} + 1) END AS recent_url
  FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem
    GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
details AS (
  SELECT '{BASE}/artists/' || s_name AS url, ['Someone Else', s_name, s_name, lower(s_name)] AS members
  FROM supplier),
search AS (
  SELECT 'master' AS type, o_orderkey AS id,
    CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN 'n/a'
         ELSE year(o_orderdate)::VARCHAR END AS year,
    CASE o_orderstatus WHEN 'P' THEN ['Vinyl', '7"'] WHEN 'O' THEN ['LP', 'Album'] END AS format,
    CASE WHEN o_custkey % 9 = 0 THEN ['Mono', '45 RPM'] ELSE ['Mono'] END AS format_descriptions,
    ['Unknown', c_mktsegment || ' Ltd', 'Brand#1'] AS label,
    CASE WHEN o_orderkey % 5 <> 0 THEN [o_orderpriority] END AS style,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'http://img/m' || o_orderkey END AS cover_image,
    CASE WHEN o_orderkey % 17 <> 0 THEN '{BASE}/masters/' || o_orderkey END AS master_url,
    NULL::VARCHAR AS resource_url,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'hard bop' WHEN '2-HIGH' THEN 'bop'
         WHEN '3-MEDIUM' THEN 'modal' WHEN '5-LOW' THEN 'cool jazz' ELSE 'swing' END AS style_query,
    3 AS page, o_orderkey AS position
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  UNION ALL
  SELECT CASE WHEN l_linenumber = 7 THEN 'artist' ELSE 'release' END, rid, ship_year::VARCHAR,
    CASE WHEN flag = 'N' THEN ['CD'] ELSE ['Vinyl', 'LP'] END,
    CASE WHEN flag = 'N' THEN ['7 Inch'] END, [brand, 'Automatic'], ['ignored'],
    'http://img/r' || rid, NULL,
    CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN '' ELSE '{BASE}/releases/' || rid END,
    ['bop', 'hard bop', 'modal', 'swing', 'post bop', 'cool jazz', 'fusion'][l_linenumber],
    l_linenumber, rid
  FROM release_rows)"""

_STYLES = views.CURATION.enabled_styles
_FIRST, _LAST = views.CURATION.first_year, views.CURATION.last_year
_STYLE_LIST = ", ".join(f"'{s}'" for s in _STYLES)
_VALID_YEAR = (
    f"coalesce(regexp_full_match(year, '[0-9]+') "
    f"AND TRY_CAST(year AS INTEGER) BETWEEN {_FIRST} AND {_LAST}, FALSE)"
)

CURATION = DOCUMENTS + f""",
accepted AS (
  SELECT *, {known_label('label')} AS hint FROM search
  WHERE style_query IN ({_STYLE_LIST}) AND {_VALID_YEAR}
    AND {album_format('format', 'format_descriptions')} AND {known_label('label')} IS NOT NULL),
resolved AS (
  SELECT a.* REPLACE (coalesce(nullif(r.master_url, ''),
    '{BASE}/masters/' || nullif(r.master_id, 0)) AS master_url)
  FROM accepted a JOIN releases r
    ON r.url = coalesce(nullif(a.resource_url, ''), '{BASE}/releases/' || a.id)
  WHERE a.type = 'release' AND (r.master_url <> '' OR r.master_id <> 0)),
candidates AS (
  SELECT CASE WHEN b.type = 'master' THEN b.id ELSE m.id END AS id,
    CASE WHEN b.type = 'master' THEN b.year ELSE m.year::VARCHAR END AS year,
    coalesce(CASE WHEN b.type = 'master' THEN b.style ELSE m.styles END, []) AS style,
    b.cover_image AS cover_url, b.hint, b.style_query, b.page, b.position, b.year AS found_year,
    m.main_url, m.recent_url
  FROM (SELECT * FROM accepted WHERE type = 'master' UNION ALL BY NAME SELECT * FROM resolved) b
  LEFT JOIN masters m ON b.master_url = m.url WHERE b.type = 'master' OR m.url IS NOT NULL),
in_years AS (SELECT * FROM candidates WHERE year::INTEGER >= {_FIRST}),
kept AS (
  SELECT c.* FROM in_years c LEFT JOIN releases r ON r.url = c.main_url
  WHERE coalesce(lower(r.artist), '') <> 'various'),
stored AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'),
fresh AS (SELECT * FROM kept WHERE id NOT IN (SELECT id FROM stored)),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
    list_position([{_STYLE_LIST}], style_query), found_year::INTEGER, page, position) AS rn
    FROM fresh) WHERE rn = 1),
opened AS (
  SELECT f.*, coalesce(r.artist, '') AS artists, coalesce(r.title, '') AS title, r.rid,
    {clean_tracklist('r.tracklist')} AS tracklist, r.labels, r.group_name, r.artist_url,
    {players('r.extraartists')} AS main_players
  FROM firsts f LEFT JOIN releases r ON r.url = f.main_url),
played AS (
  SELECT o.*, {clean_players('''CASE WHEN len(o.main_players) > 0 THEN o.main_players ELSE
    ''' + players('r.extraartists') + ''' END''')} AS musicians
  FROM opened o LEFT JOIN releases r
    ON r.url = o.recent_url AND o.rid IS NOT NULL AND o.recent_url <> o.main_url),
credited AS (SELECT *, {named_in('artists', 'musicians')} AS named FROM played),
led AS (
  SELECT c.*, CASE WHEN len(named) > 0 THEN named ELSE
    list_sort(list_distinct({named_in('c.group_name', 'd.members')})) END AS found
  FROM credited c LEFT JOIN details d ON d.url = c.artist_url AND c.group_name <> ''),
labelled AS (
  SELECT *, coalesce({known_label('labels')}, nullif(labels[1], ''), hint) AS full_label FROM led),
curated AS (
  SELECT artists, title, id, year, regexp_replace(full_label, '^(.*)\\s+\\(\\d+\\)$', '\\1') AS label,
    tracklist, musicians,
    CASE WHEN len(found) > 0 THEN found WHEN artists <> '' THEN [artists] ELSE [] END AS leaders,
    style, cover_url
  FROM labelled)"""

ARTIST = hashlib.sha256(b"supplier 000000001").hexdigest()
ARTIST_2 = hashlib.sha256(b"supplier 000000002").hexdigest()
WORK = hashlib.sha256(b"blue anvil").hexdigest()

_CARD = "ensemble, title, tracks, leaders, participants, year, label, cover"
# The place of a row in a single question's answer.
_ORDER = "year NULLS LAST, title NULLS LAST, album_id, label NULLS LAST"
_POS = f"row_number() OVER (ORDER BY {_ORDER}) AS pos"
_BARE_CARD = "ensemble, title, year, label, cover"
_TEXTS = """
texts AS (
  SELECT 'document' AS kind, doc_id::VARCHAR AS key, text FROM documents
  UNION ALL SELECT 'turn', conv_id || '-' || turn, text FROM conversations
  UNION ALL SELECT 'part', p_partkey::VARCHAR, p_name FROM part
  UNION ALL SELECT 'page', page_id::VARCHAR, html FROM pages)"""
_YEARS = """
years AS (
  SELECT o_orderkey, CASE o_orderkey % 9
    WHEN 0 THEN 'abc' WHEN 1 THEN year(o_orderdate) || '.0' WHEN 2 THEN ''
    WHEN 3 THEN ' ' || year(o_orderdate) || ' ' WHEN 4 THEN '99999999999'
    WHEN 5 THEN NULL WHEN 6 THEN '-' || o_orderkey ELSE year(o_orderdate)::VARCHAR END AS year
  FROM orders)"""
_PATHS = """
paths AS (
  SELECT '/landing/' || l_shipmode || '/' || l_orderkey || l_suffix AS path FROM (
    SELECT l_orderkey, l_returnflag AS l_shipmode,
      CASE WHEN l_linestatus = 'O' THEN '.json' WHEN l_returnflag = 'N' THEN '.JSON' ELSE '.txt' END
        AS l_suffix FROM lineitem)),
raw_paths AS (
  SELECT '/raw/albums/' || o_orderkey || '.json' AS path FROM orders WHERE o_orderstatus = 'F')"""

_FLAT_ALBUM = f"""album_id, ensemble, title, year, label, {joined('styles')} AS styles, cover_url"""
_FLAT_RECORD = f"""artists, title, id, year, label, {joined('tracklist')} AS tracklist,
  {joined('musicians')} AS musicians, {joined('leaders')} AS leaders, {joined('style')} AS style,
  cover_url"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Text and typing.
    q["n1_norm_text"] = f"WITH {_TEXTS} SELECT kind, key, {norm('text')} AS norm FROM texts"
    q["n2_strip_takes"] = f"""WITH {RECORDS}, tracks AS (
        SELECT id, unnest(tracklist) AS title FROM bronze)
      SELECT 'track' AS kind, id::VARCHAR AS key, {strip_takes('title')} AS cleaned FROM tracks
      UNION ALL SELECT 'document', doc_id::VARCHAR, {strip_takes('text')} FROM documents
      UNION ALL SELECT 'turn', conv_id || '-' || turn, {strip_takes('text')} FROM conversations"""
    q["n3_content_id"] = f"""WITH {_TEXTS} SELECT kind, key, sha256({norm('text')}) AS content_id,
      sha256(lower(trim(text, ' '))) AS label_id FROM texts"""
    q["n4_has_text"] = f"""WITH {RECORDS}, credits AS (
        SELECT id, unnest(list_concat(coalesce(musicians, []), coalesce(leaders, []))) AS name
        FROM bronze), titles AS (SELECT id, unnest(tracklist) AS name FROM bronze)
      SELECT id, name, {norm('name')} AS norm FROM (
        SELECT * FROM credits UNION ALL SELECT * FROM titles)
      WHERE trim(name, ' ') <> '' AND {norm('name')} <> ''"""
    q["n5_year_number"] = f"WITH {_YEARS} SELECT o_orderkey, {year_number('year')} AS year FROM years"
    q["n6_table_name"] = f"WITH {GOLD} SELECT album_id, work_id FROM album_work"
    flags = ", ".join(
        f"contains(lower(text), '{t.lower()}') AS has_{n}" for n, t in views.SEARCH_TEXTS.items()
    )
    q["n7_contains_text"] = f"WITH {_TEXTS} SELECT kind, key, {flags} FROM texts"
    ranks = ", ".join(
        f"CASE WHEN starts_with(lower(text), '{t.lower()}') THEN 0 ELSE 1 END AS rank_{n}"
        for n, t in views.SEARCH_TEXTS.items()
    )
    q["n8_prefix_rank"] = f"WITH {_TEXTS} SELECT kind, key, {ranks} FROM texts"

    # Curation.
    styles = ", ".join(f"('{s}', {i})" for i, s in enumerate(_STYLES))
    labels = ", ".join(
        f"('{n}', {i})" for i, n in enumerate(views.CURATION.enabled_labels.values())
    )
    q["c1_enabled_values"] = f"""WITH {DOCUMENTS}
      SELECT 'style' AS kind, s.v AS value, s.p AS position, count(style_query) AS results
      FROM (VALUES {styles}) s(v, p) LEFT JOIN search ON style_query = s.v GROUP BY ALL
      UNION ALL
      SELECT 'label', l.v, l.p, count(known) FROM (VALUES {labels}) l(v, p)
      LEFT JOIN (SELECT {known_label('label')} AS known FROM search) ON known = l.v GROUP BY ALL"""
    q["c2_search_scope"] = f"""WITH {DOCUMENTS}
      SELECT s.v AS style, y.year, count(search.id) AS results
      FROM (VALUES {styles}) s(v, p), (SELECT unnest(range({_FIRST}, {_LAST} + 1))::INTEGER AS year) y
      LEFT JOIN search ON style_query = s.v AND search.year = y.year::VARCHAR GROUP BY ALL"""
    q["c2_in_scope"] = f"""WITH {DOCUMENTS} SELECT type, id, style_query FROM search
      WHERE style_query IN ({_STYLE_LIST})"""
    q["c3_valid_year"] = f"""WITH {_YEARS}, {DOCUMENTS}
      SELECT 'search' AS kind, id, {_VALID_YEAR} AS valid FROM search
      UNION ALL SELECT 'text', o_orderkey, {_VALID_YEAR} FROM years"""
    q["c4_master_year"] = f"""WITH {DOCUMENTS} SELECT id, year FROM masters WHERE year >= {_FIRST}"""
    q["c5_album_format"] = f"""WITH {DOCUMENTS} SELECT type, id FROM search
      WHERE {album_format('format', 'format_descriptions')}"""
    q["c6_label_match"] = f"""WITH {DOCUMENTS} SELECT type, id, {known_label('label')} AS label_hint
      FROM search WHERE {known_label('label')} IS NOT NULL"""
    q["c7_release_label"] = f"""WITH {DOCUMENTS} SELECT url,
      coalesce({known_label('labels')}, nullif(labels[1], ''), 'Hint') AS label FROM releases"""
    q["c8_label_number"] = f"""WITH {DOCUMENTS}, names AS (SELECT url, unnest(labels) AS raw FROM releases)
      SELECT url, regexp_replace(raw, '^(.*)\\s+\\(\\d+\\)$', '\\1') AS label FROM names"""
    q["c9_release_masters"] = f"""WITH {DOCUMENTS}
      SELECT s.id AS release_id, m.id AS master_id, m.year, {joined('m.styles')} AS style,
        s.cover_image AS cover_url
      FROM search s
      JOIN releases r ON r.url = coalesce(nullif(s.resource_url, ''), '{BASE}/releases/' || s.id)
      JOIN masters m
        ON m.url = coalesce(nullif(r.master_url, ''), '{BASE}/masters/' || nullif(r.master_id, 0))
      WHERE s.type = 'release'"""
    q["c10_type_dispatch"] = f"""WITH {CURATION} SELECT id, year, {joined('style')} AS style, cover_url,
      hint AS label_hint, found_year, page, position, main_url AS main_release_url FROM candidates"""
    q["c11_main_release"] = f"""WITH {CURATION} SELECT id, artists, title,
      {joined('tracklist')} AS tracklist FROM opened"""
    q["c12_clean_tracks"] = f"""WITH {DOCUMENTS}
      SELECT url, {joined(clean_tracklist('tracklist'))} AS tracklist FROM releases"""
    q["c13_players"] = f"""WITH {DOCUMENTS}
      SELECT url, {joined(players('extraartists'))} AS players FROM releases"""
    q["c14_player_fallback"] = f"""WITH {CURATION} SELECT id, len(main_players) = 0 AS fell_back,
      {joined('musicians')} AS musicians FROM played"""
    q["c15_clean_players"] = f"""WITH {DOCUMENTS} SELECT url,
      {joined(clean_players('list_transform(extraartists, lambda c: c.name)'))} AS names FROM releases"""
    q["c16_leaders_in_credit"] = f"""WITH {CURATION} SELECT id, {joined('named')} AS leaders FROM credited"""
    q["c17_leaders_from_members"] = f"""WITH {DOCUMENTS} SELECT r.url,
      {joined("list_sort(list_distinct(" + named_in('r.group_name', 'd.members') + "))")} AS leaders
      FROM releases r LEFT JOIN details d ON d.url = r.artist_url"""
    q["c18_leader_fallback"] = f"""WITH {CURATION} SELECT id, artists, {joined('leaders')} AS leaders
      FROM curated"""
    q["c19_drop_compilations"] = f"""WITH {DOCUMENTS} SELECT m.id FROM masters m
      LEFT JOIN releases r ON r.url = m.main_url WHERE coalesce(lower(r.artist), '') <> 'various'"""
    q["c20_first_seen"] = f"""WITH {CURATION} SELECT id, style_query, found_year, page, position
      FROM firsts"""
    q["c21_not_stored"] = f"""WITH {CURATION} SELECT id, position FROM in_years
      WHERE id NOT IN (SELECT id FROM stored)"""
    q["c22_album_records"] = f"WITH {CURATION} SELECT {_FLAT_RECORD} FROM curated"
    def block(items: str, line: str) -> str:
        return f"""CASE WHEN len({items}) > 0 THEN array_to_string(list_transform({items},
          lambda t, i: {line}), chr(10)) ELSE '{fv.NOT_AVAILABLE}' END"""
    q["c23_album_listing"] = f"""WITH {CURATION} SELECT id, artists, title, year, label, cover_url,
      array_to_string(leaders, ', ') AS leaders, array_to_string(style, ', ') AS style,
      {block('tracklist', "i || '. ' || t")} AS tracklist, {block('musicians', "'- ' || t")} AS musicians
      FROM curated"""

    # Gold.
    q["g1_albums"] = f"WITH {GOLD} SELECT {_FLAT_ALBUM} FROM albums"
    for key, name in [
        ("g2_labels", "labels"), ("g3_artists", "artists"), ("g4_works", "works"),
        ("g5_album_artist", "album_artist"), ("g6_album_work", "album_work"),
        ("g7_album_label", "album_label"), ("g8_tracks", "tracks"),
    ]:
        q[key] = f"WITH {GOLD} SELECT * FROM {name}"
    counted = ["albums", "artists", "album_artist", "labels", "works", "album_work", "album_label",
               "tracks"]
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in counted)
    q["g9_all_tables"] = f"WITH {GOLD} {counts}"

    # Graph load.
    q["l1a_album_nodes"] = f"""SELECT {_FLAT_ALBUM} FROM (
      {_upsert('albums', 'album_id', 'ensemble, title, year, label, styles, cover_url', '')})"""
    q["l1b_artist_nodes"] = _upsert("artists", "artist_id", "name", "")
    q["l1c_work_nodes"] = _upsert("works", "work_id", "work_title", "")
    q["l1d_label_nodes"] = _upsert("labels", "label_id", "name", ", name")
    q["l2a_leads"] = _edges("album_artist", "artist_id", "album_id", "role = 'leader'")
    q["l2b_plays_in"] = _edges("album_artist", "artist_id", "album_id")
    q["l2c_contains"] = _edges("album_work", "album_id", "work_id")
    q["l2d_released_by"] = _edges("album_label", "album_id", "label_id")
    q["l3_key_violations"] = f"""WITH {GOLD}
      SELECT 'labels' AS node, label_id AS key, count(*) AS rows FROM labels GROUP BY ALL
      HAVING count(*) > 1"""
    q["l4_load_map"] = f"""WITH {GRAPH}
      SELECT 'albums' AS table_name, count(*) AS rows FROM albums
      UNION ALL SELECT 'artists', count(*) FROM artists
      UNION ALL SELECT 'works', count(*) FROM works
      UNION ALL SELECT 'labels', count(*) FROM label_nodes
      UNION ALL SELECT 'leads', count(*) FROM leads
      UNION ALL SELECT 'plays_in', count(*) FROM plays_in
      UNION ALL SELECT 'contains', count(*) FROM album_work
      UNION ALL SELECT 'released_by', count(*) FROM album_label"""
    q["l4_own_map"] = f"""WITH {GOLD}, first_track AS (
        SELECT album_id, min(name) AS name FROM tracks GROUP BY album_id),
      named AS (
        SELECT album_id, count(DISTINCT artist_id) AS people FROM album_artist GROUP BY album_id)
      SELECT album_id, title, year, name, people
      FROM albums LEFT JOIN first_track USING (album_id) LEFT JOIN named USING (album_id)"""
    q["l5_needed_columns"] = f"""WITH {GOLD}
      SELECT album_id, artist_id FROM album_artist"""

    q["g9_incremental"] = f"""WITH {GOLD}
      SELECT 'albums' AS kind, album_id::VARCHAR AS id, title AS shown FROM albums
      UNION ALL SELECT 'labels', label_id, name FROM labels
      UNION ALL SELECT 'artists', artist_id, name FROM artists
      UNION ALL SELECT 'works', work_id, work_title FROM works
      UNION ALL SELECT 'tracks', track_id, name FROM tracks
      UNION ALL SELECT 'album_artist', album_id || '-' || artist_id, role FROM album_artist
      UNION ALL SELECT 'album_work', album_id || '-' || work_id, NULL FROM album_work
      UNION ALL SELECT 'album_label', album_id || '-' || label_id, NULL FROM album_label"""

    # Graph queries.
    for key, table, id_, name in [
        ("q1_suggest_artists", "artists", "artist_id", "name"),
        ("q2_suggest_works", "works", "work_id", "work_title"),
        ("q3_suggest_albums", "albums", "album_id", "title"),
    ]:
        text = views.SUGGEST[key].lower()
        q[key] = f"""WITH {GRAPH} SELECT {id_} AS id, {name} AS name,
          CASE WHEN starts_with(lower({name}), '{text}') THEN 0 ELSE 1 END AS rank,
          rank() OVER (ORDER BY CASE WHEN starts_with(lower({name}), '{text}') THEN 0 ELSE 1 END, lower({name}), {id_}) AS pos
          FROM {table} WHERE contains(lower({name}), '{text}')"""
    for like in ("q1_suggest_artists", "q2_suggest_works", "q3_suggest_albums"):
        q[f"{like[:2]}_indexed"] = q[like]
    q["q4_artist_sessions"] = f"""WITH {GRAPH} SELECT name AS artist, album_id, {_CARD}, {_POS}
      FROM plays_in JOIN artists USING (artist_id) JOIN cards USING (album_id)
      WHERE artist_id = '{ARTIST}' AND year BETWEEN 1996 AND 1999"""
    q["q4_bulk"] = f"""WITH {GRAPH} SELECT artist_id, name AS artist, album_id, {_BARE_CARD}
      FROM plays_in JOIN artists USING (artist_id) JOIN cards USING (album_id)"""
    q["q4_bulk_first"] = f"""{q["q4_bulk"]}
      QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY {_ORDER}) <= 3"""
    q["q5_leader_sessions"] = f"""WITH {GRAPH} SELECT name AS artist, {_CARD}, {_POS}
      FROM leads JOIN artists USING (artist_id) JOIN cards USING (album_id)
      WHERE artist_id = '{ARTIST}'"""
    q["q5_bulk"] = f"""WITH {GRAPH} SELECT artist_id, name AS artist, {_BARE_CARD}
      FROM leads JOIN artists USING (artist_id) JOIN cards USING (album_id) WHERE year >= 1997"""
    q["q5_bulk_lists"] = f"""WITH {GRAPH} SELECT artist_id, name AS artist, {_CARD}
      FROM leads JOIN artists USING (artist_id) JOIN cards USING (album_id)
      WHERE year >= 1997"""
    collab = "ensemble, title, leaders, participants, year, label, cover"
    q["q6_collab_albums"] = f"""WITH {GRAPH} SELECT album_id, {collab}, {_POS} FROM cards WHERE album_id IN (
      SELECT album_id FROM plays_in WHERE artist_id IN ('{ARTIST}', '{ARTIST_2}')
      GROUP BY album_id HAVING count(DISTINCT artist_id) = 2)"""
    q["q6_bulk"] = f"""WITH {GRAPH}, requests AS (
        SELECT s_suppkey AS request_id, sha256({norm('s_name')}) AS artist_id FROM supplier
        UNION ALL SELECT s_suppkey - 1, sha256({norm('s_name')}) FROM supplier
        UNION ALL SELECT s_suppkey, sha256('supplier 000000003') FROM supplier),
      wanted AS (SELECT DISTINCT * FROM requests),
      sizes AS (SELECT request_id, count(*) AS k FROM wanted GROUP BY request_id HAVING count(*) >= 2),
      hits AS (SELECT request_id, album_id, count(*) AS n FROM wanted JOIN plays_in USING (artist_id)
        GROUP BY request_id, album_id)
      SELECT request_id, album_id, {_BARE_CARD} FROM hits JOIN sizes USING (request_id)
      JOIN cards USING (album_id) WHERE n = k"""
    q["q6_bulk_first"] = q["q6_bulk"].replace(_BARE_CARD, collab) + f"""
      QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY {_ORDER}) <= 2"""
    q["q7_album_detail"] = f"WITH {GRAPH} SELECT album_id, {_CARD} FROM cards WHERE album_id = 1"
    q["q7_bulk"] = f"WITH {GRAPH} SELECT album_id, {_CARD} FROM cards"
    q["q7_names"] = f"""WITH {GRAPH}
      SELECT DISTINCT album_id, 'leaders' AS kind, name FROM leads JOIN artists USING (artist_id)
      UNION ALL SELECT DISTINCT album_id, 'participants', name
      FROM plays_in JOIN artists USING (artist_id)
      UNION ALL SELECT DISTINCT album_id, 'tracks', work_title
      FROM album_work JOIN works USING (work_id)"""
    appearance = "ensemble, title AS album_title, tracks, leaders, participants, year, label, cover"
    q["q8_work_appearances"] = f"""WITH {GRAPH} SELECT work_title, {appearance}, {_POS}
      FROM album_work JOIN works USING (work_id) JOIN cards USING (album_id)
      WHERE work_id = '{WORK}'"""
    q["q8_bulk"] = f"""WITH {GRAPH} SELECT work_id, work_title, ensemble, title AS album_title, year,
        label, cover
      FROM album_work JOIN works USING (work_id) JOIN cards USING (album_id)"""
    q["q9_led_sessions_of"] = f"""WITH {GRAPH}
      SELECT p.artist_id AS player_id, p.name AS player, al.album_id, al.title,
        l.artist_id AS leader_id, l.name AS leader
      FROM artists p JOIN plays_in pi ON pi.artist_id = p.artist_id
      JOIN albums al ON al.album_id = pi.album_id
      JOIN leads le ON le.album_id = al.album_id JOIN artists l ON l.artist_id = le.artist_id
      WHERE p.name = 'Supplier#000000001'"""
    q["q10_year_range"] = f"""WITH {GOLD}
      SELECT 'none' AS bounds, album_id, year FROM albums
      UNION ALL SELECT 'min', album_id, year FROM albums WHERE year >= 1998
      UNION ALL SELECT 'max', album_id, year FROM albums WHERE year <= 1998
      UNION ALL SELECT 'both', album_id, year FROM albums WHERE year BETWEEN 1997 AND 1998"""
    q["q11_wanted_ids"] = """WITH lists AS (
        SELECT l_orderkey, list_distinct([l_suppkey, l_partkey, l_suppkey]) AS ids FROM lineitem)
      SELECT l_orderkey, array_to_string(list_sort(ids), '|') AS ids, len(ids)::INTEGER AS n FROM lists
      WHERE len(ids) >= 2"""
    fields = [("album_id", True), ("ensemble", False), ("title", False), ("year", True),
              ("label", False), ("cover_url", False)]
    parts = " || ".join(
        "coalesce(',\"" + c + "\":" + ("' || " + c if num else "\"' || " + c + " || '\"'") + ", '')"
        for c, num in fields
    )
    q["q12_without_nulls"] = f"""WITH {GOLD} SELECT album_id, '{{' || substr({parts}, 2) || '}}' AS record
      FROM albums"""

    # Ingestion.
    q["s1_new_files"] = f"""WITH {_PATHS}
      SELECT name, min(path) AS path FROM (
        SELECT path, string_split(path, '/')[-1] AS name FROM paths WHERE lower(path) LIKE '%.json')
      WHERE name NOT IN (SELECT string_split(path, '/')[-1] FROM raw_paths) GROUP BY name"""
    q["s1_listed_files"] = "SELECT s_suppkey || '.json' AS name FROM supplier WHERE s_suppkey % 2 = 1"
    q["s1_archived_stream"] = """SELECT c_custkey AS id, c_name AS title, TRUE AS archived FROM customer
      WHERE c_custkey % (SELECT greatest(8, (count(*) + 999) // 1000) FROM customer) % 4 <> 3"""
    q["s2b_multi_line"] = """SELECT doc_id AS id, text AS title, lang AS label FROM documents
      UNION ALL SELECT NULL, NULL, 'no id' FROM range((SELECT greatest(8, (count(*) + 999) // 1000) FROM documents))"""
    q["s2b_repaired_files"] = """SELECT doc_id AS id, text AS title,
      (SELECT count(*) FROM documents WHERE lang = 'en')::INTEGER AS set_aside, 0::INTEGER AS "left" FROM documents"""
    q["s8_broken_run"] = q["s5_compacted"] = f"WITH {RECORDS} SELECT id, title, year FROM bronze"
    record = f"WITH {RECORDS} SELECT {_FLAT_RECORD} FROM bronze"
    for key in ("s2_json_stream", "s6_incremental", "s7_append", "s9_bronze_scan", "s14_album_json"):
        q[key] = record
    q["s2b_corrupt_records"] = """SELECT 'good' AS kind, count(*) AS rows, sum(doc_id)::BIGINT AS ids
      FROM documents WHERE lang <> 'en'
      UNION ALL SELECT 'unreadable record', count(*), NULL FROM documents WHERE lang = 'en'"""
    q["s3_format_guard"] = f"WITH {RECORDS} SELECT id, title FROM bronze"
    q["s4_ingestion_columns"] = f"""WITH {RECORDS} SELECT id, 0 AS at_position, 1 AS name_position,
      TRUE AS has_time, TRUE AS has_json_name FROM bronze"""
    q["s5_batch_files"] = f"WITH {RECORDS} SELECT count(*) AS rows, TRUE AS within FROM bronze"
    q["s8_registered"] = f"WITH {RECORDS} SELECT id, title, year FROM bronze"
    q["s10_gold_table"] = f"WITH {GOLD} SELECT {_FLAT_ALBUM} FROM albums"
    q["s11_gold_scan"] = f"""WITH {GOLD} SELECT 'labels' AS table_name, count(*) AS rows FROM labels
      UNION ALL SELECT 'album_label', count(*) FROM album_label"""
    q["s12_row_counts"] = f"""WITH {GOLD} SELECT 'bronze' AS table_name, count(*) AS rows FROM bronze
      UNION ALL {counts}"""
    q["s13_schema_evolution"] = f"""WITH {RECORDS} SELECT id, title,
      CASE WHEN label = lower(label) THEN label END AS label,
      CASE WHEN label = lower(label) THEN cover_url END AS cover_url,
      CASE WHEN label = lower(label) THEN 2.5 ELSE 1 END::DOUBLE AS year FROM bronze WHERE label IS NOT NULL
      UNION ALL SELECT count(*), 'no readable record in the file', NULL, NULL, 0 FROM bronze WHERE label = lower(label)"""
    q["l2_incremental_load"] = f"WITH {GRAPH} SELECT artist_id, album_id FROM plays_in"
    q["s15_batched_sink"] = f"WITH {GRAPH} SELECT artist_id, album_id FROM plays_in"
    q["s16_session"] = "SELECT o_orderstatus AS status, 'on' AS setting, count(*) AS rows FROM orders GROUP BY 1"
    return q
