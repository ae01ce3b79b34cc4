"""Album records and catalogue documents derived from the given tables.

Album records: each line item is one delivered record of the album with its order's key, and an
order without line items is a record without lists. So no list is ever collected from rows, and
an order of any size stays spread over many records.

Catalogue documents: one release per distinct (order, line number, part, supplier), so that every line
item reaches one; one master per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linernotes.config import CurationConfig

BASE = "https://catalogue.test"

CURATION = CurationConfig(
    first_year=1996,
    last_year=2000,
    styles={
        "bop": True, "hard bop": True, "modal": True, "swing": False, "post bop": True,
        "cool jazz": True, "fusion": False,
    },
    labels={
        "house": ("Household", False),
        "auto": ("Automobile Records", True),
        "brand#11": ("Brand Eleven", True),
        "brand#1": ("Brand One", True),
        "brand#2": ("Brand Two", True),
        "build": ("Builders", True),
    },
    url_base=BASE,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bronze column -> (expression, tables it needs besides the line items).
BRONZE = {
    "id": ("coalesce(l_orderkey, o_orderkey)", ()),
    "artists": (
        "CASE WHEN l_orderkey IS NULL THEN 'Various' ELSE concat(' ', s_name, ' Quintet') END",
        ("supplier",)),
    "title": ("concat('  ', o_orderpriority, ' Session ')", ("orders",)),
    "year": (
        """CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
                WHEN o_orderkey % 89 = 0 THEN concat(cast(year(o_orderdate) AS string), '.0')
                ELSE cast(year(o_orderdate) AS string) END""",
        ("orders",)),
    "label": (
        """CASE WHEN o_orderkey % 101 = 0 THEN '  '
                WHEN o_orderkey % 11 = 0 THEN lower(c_mktsegment)
                WHEN l_linenumber = 7 THEN concat(c_mktsegment, ' Records')
                WHEN o_orderkey % 7 = 0 THEN concat(c_mktsegment, ' ')
                ELSE c_mktsegment END""",
        ("orders", "customer")),
    "tracklist": (
        """CASE WHEN l_orderkey IS NOT NULL THEN array(
             CASE WHEN l_linenumber % 3 = 0 THEN concat(p_name, ' (take ', l_linenumber, ')')
                  WHEN l_linenumber = 5 THEN concat(' ', p_name, '  (Alternate Take)')
                  WHEN l_linenumber = 2 THEN upper(p_name)
                  ELSE p_name END,
             concat(p_name, ' No. ', p_partkey),
             CASE WHEN l_linenumber = 4 THEN '???' END) END""",
        ("part",)),
    "musicians": (
        """CASE WHEN l_orderkey IS NOT NULL THEN array(
             CASE WHEN l_linenumber % 3 = 0 THEN upper(s_name)
                  WHEN l_linenumber = 5 THEN replace(s_name, 'u', 'ü')
                  ELSE s_name END,
             s_name,
             CASE WHEN l_linenumber = 6 THEN '' END) END""",
        ("supplier",)),
    "leaders": (
        """CASE WHEN l_linenumber = 1 THEN array(s_name)
                WHEN l_linenumber = 2 THEN array(' ')
                WHEN l_linenumber < 7 THEN cast(array() AS array<string>) END""",
        ("supplier",)),
    "style": ("CASE WHEN l_orderkey IS NOT NULL THEN array(p_type, 'Hard Bop') END", ("part",)),
    "cover_url": (
        "CASE WHEN l_returnflag <> 'R' THEN concat('http://covers/', l_orderkey) END", ()),
    "_ingested_at": ("coalesce(l_shipdate, o_orderdate)", ("orders",)),
    "_ingested_filename": (
        "concat_ws('-', coalesce(l_orderkey, o_orderkey), l_linenumber, l_partkey, l_suppkey)", ()),
}


#: Line items that Spark may send to the driver and all executors for a join; they are counted from footers.
FEW_LINES = 500_000


def bronze(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Album records with the given columns (default all), joining only what those need."""
    columns = columns or tuple(BRONZE)
    needed = {t for c in columns for t in BRONZE[c][1]}
    rows = table(spark, sf_dir, "lineitem")
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        if "customer" in needed:  # before the line items, of which there are several an order
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        # Many line items are not broadcast, however small the files of the columns asked for.
        rows = rows.hint("merge") if rows.count() > FEW_LINES else rows
        rows = orders.join(rows, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    else:
        rows = rows.withColumn("o_orderkey", F.lit(None).cast("long"))
    for name, key, own in [
        ("part", "l_partkey", "p_partkey"),
        ("supplier", "l_suppkey", "s_suppkey"),
    ]:
        if name in needed:
            rows = rows.join(table(spark, sf_dir, name), F.col(key) == F.col(own), "left")
    return rows.select(*[F.expr(BRONZE[c][0]).alias(c) for c in columns])


# Release-level texts by line number 1..7: first and second track suffix, three roles.
TRACK_SUFFIX_1 = [" - Short-Take 5", " - 8", " (alt. take)", " (Original)", " QX417-2",
                  " - Orig. Take #9", " Opus-5"]
TRACK_SUFFIX_2 = [" - (Original Master)", " (RT8052-3) y", " New Take 6", "  two   blanks ", "", " - Mistake",
                  " (take) end"]
ROLES_1 = ["Tenor Saxophone", "Engineer", "Producer, Piano", "Piano Technician", "", "Liner Notes",
           "Drums"]
ROLES_2 = ["Engineer", "Bass", "Design", "Recorded By", "Photography", "Trumpet", "Producer"]
STYLE_QUERIES = ["bop", "hard bop", "modal", "swing", "post bop", "cool jazz", "fusion"]

def _pick(values: list[str]) -> str:
    """The value of a line's number, the last one for a line without a number."""
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"element_at(array({quoted}), coalesce(l_linenumber, -1))"


# Ids of a line's first releases: its number, then the place of part and supplier among the line's, which is
# less than this. The others' ids are negative hashes of the whole key, so no line runs into the next one's ids.
RELEASES_A_LINE = 1000


def release_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct (order, line number, part, supplier): id, names, first ship date.

    The window orders only a line's first releases: Spark cuts each partition's rows of a line down to these
    before they meet. The others come after a line's last one with a place. There is at most one such for each 999
    rows, so all tasks get them, and only line items of such lines move a second time.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    line, release = ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]

    def distinct(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*line, *release).agg(
            F.min("l_returnflag").alias("flag"), F.year(F.min("l_shipdate")).alias("ship_year")
        )

    items = table(spark, sf_dir, "lineitem")
    place = F.row_number().over(Window.partitionBy(*line).orderBy(*release))
    first = distinct(items).withColumn("place", place).where(F.col("place") < RELEASES_A_LINE)
    last = first.where(F.col("place") == RELEASES_A_LINE - 1).select(
        *[F.col(c).alias(f"_{c}") for c in line], F.struct(*release).alias("_last")
    )
    same_line = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in line]
    others = distinct(items.join(F.broadcast(last), same_line).where(F.struct(*release) > F.col("_last")))
    numbered = first.unionByName(others.withColumn("place", F.lit(None).cast("int")))
    rid = f"""coalesce((l_orderkey * 10 + l_linenumber) * {RELEASES_A_LINE} + place,
                      -1 - (xxhash64({", ".join([*line, *release])}) & {(1 << 63) - 1}))"""
    return (
        numbered.withColumn("rid", F.expr(rid)).drop("place")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumnRenamed("p_brand", "brand")
    )


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release_rows(spark, sf_dir).selectExpr(
        f"concat('{BASE}/releases/', rid) AS url",
        "concat(upper(p_name), ' Album') AS title",
        "CASE WHEN l_linenumber = 5 THEN 0 ELSE l_orderkey END AS master_id",
        f"""CASE WHEN l_linenumber <= 4 THEN concat('{BASE}/masters/', l_orderkey)
                 WHEN l_linenumber = 6 THEN '' END AS master_url""",
        """CASE WHEN l_linenumber = 3 THEN cast(array() AS array<struct<name:string>>)
                WHEN l_linenumber = 4 THEN array(named_struct('name', ''))
                ELSE array(named_struct('name', concat('Sub of ', p_name, ' (6)')),
                           named_struct('name', brand)) END AS labels""",
        f"""array(named_struct('title', concat(p_name, {_pick(TRACK_SUFFIX_1)})),
                  named_struct('title', concat('"', p_name, '"')),
                  named_struct('title', '-'),
                  named_struct('title', concat('Band #3: ', p_name, {_pick(TRACK_SUFFIX_2)}))
            ) AS tracklist""",
        f"""array(named_struct('name', concat(s_name, ' (2)'),
                               'role', CASE WHEN flag = 'A' THEN 'Mixed By' ELSE {_pick(ROLES_1)} END),
                  named_struct('name', s_name, 'role', {_pick(ROLES_2)}),
                  named_struct('name', concat(s_name, ' (2)'), 'role', 'Engineer'),
                  named_struct('name', '', 'role', 'Piano')) AS extraartists""",
        f"""array(named_struct(
              'name', CASE WHEN flag = 'R' THEN 'Various' WHEN l_linenumber = 3 THEN ''
                           ELSE concat(s_name, ' Quintet') END,
              'anv', concat(' ', s_name, ' Trio '),
              'resource_url', concat('{BASE}/artists/', s_name))) AS artists""",
    )


def masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi")
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        f"concat('{BASE}/masters/', o_orderkey) AS url",
        "o_orderkey AS id",
        "CASE WHEN o_orderkey % 19 = 0 THEN 0 ELSE year(o_orderdate) END AS year",
        "o_orderpriority AS title",
        "CASE WHEN o_orderkey % 5 <> 0 THEN array(o_orderpriority, 'Hard Bop') END AS styles",
        f"concat('{BASE}/releases/', (l_orderkey * 10 + lo) * {RELEASES_A_LINE} + 1) AS main_release_url",
        f"""CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE
              concat('{BASE}/releases/', (l_orderkey * 10 + hi) * {RELEASES_A_LINE} + 1) END AS most_recent_release_url""",
    )


def artist_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        f"concat('{BASE}/artists/', s_name) AS url",
        """array(named_struct('name', 'Someone Else'), named_struct('name', s_name),
                 named_struct('name', s_name), named_struct('name', lower(s_name))) AS members""",
    )


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    found_masters = orders.selectExpr(
        "'master' AS type",
        "o_orderkey AS id",
        """CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN 'n/a'
                ELSE cast(year(o_orderdate) AS string) END AS year""",
        """CASE o_orderstatus WHEN 'P' THEN array('Vinyl', '7"') WHEN 'O' THEN array('LP', 'Album')
                END AS format""",
        """CASE WHEN o_custkey % 9 = 0 THEN array('Mono', '45 RPM') ELSE array('Mono')
                END AS format_descriptions""",
        "array('Unknown', concat(c_mktsegment, ' Ltd'), 'Brand#1') AS label",
        "CASE WHEN o_orderkey % 5 <> 0 THEN array(o_orderpriority) END AS style",
        "CASE WHEN o_orderkey % 13 <> 0 THEN concat('http://img/m', o_orderkey) END AS cover_image",
        f"CASE WHEN o_orderkey % 17 <> 0 THEN concat('{BASE}/masters/', o_orderkey) END AS master_url",
        "cast(NULL AS string) AS resource_url",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'hard bop' WHEN '2-HIGH' THEN 'bop'
                WHEN '3-MEDIUM' THEN 'modal' WHEN '5-LOW' THEN 'cool jazz'
                ELSE 'swing' END AS style_query""",
        "3 AS page",
        "o_orderkey AS position",
    )
    found_releases = release_rows(spark, sf_dir).selectExpr(
        "CASE WHEN l_linenumber = 7 THEN 'artist' ELSE 'release' END AS type",
        "rid AS id",
        "cast(ship_year AS string) AS year",
        "CASE WHEN flag = 'N' THEN array('CD') ELSE array('Vinyl', 'LP') END AS format",
        "CASE WHEN flag = 'N' THEN array('7 Inch') END AS format_descriptions",
        "array(brand, 'Automatic') AS label",
        "array('ignored') AS style",
        "concat('http://img/r', rid) AS cover_image",
        "cast(NULL AS string) AS master_url",
        f"""CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN ''
                 ELSE concat('{BASE}/releases/', rid) END AS resource_url""",
        f"{_pick(STYLE_QUERIES)} AS style_query",
        "l_linenumber AS page",
        "rid AS position",
    )
    return found_masters.unionByName(found_releases)


# Records shipped before this date are the first graph load, the others the second.
SECOND_LOAD = "1998-01-01 00:00:00"

# Search texts of the containment and prefix queries, and of the suggestions.
SEARCH_TEXTS = {"the": "The ", "percent": "%", "underscore": "_", "ring": "RING", "que": "QUE"}
SUGGEST = {
    "q1_suggest_artists": "R#00000000",
    "q2_suggest_works": "R",
    "q3_suggest_albums": "5-low",
}


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text the given tables hold: (kind, key, text)."""
    sources = [
        ("documents", "'document'", "cast(doc_id AS string)", "text"),
        ("conversations", "'turn'", "concat(conv_id, '-', turn)", "text"),
        ("part", "'part'", "cast(p_partkey AS string)", "p_name"),
        ("pages", "'page'", "cast(page_id AS string)", "html"),
    ]
    parts = [
        table(spark, sf_dir, t).selectExpr(f"{kind} AS kind", f"{key} AS key", f"{text} AS text")
        for t, kind, key, text in sources
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def year_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 9
             WHEN 0 THEN 'abc' WHEN 1 THEN concat(year(o_orderdate), '.0') WHEN 2 THEN ''
             WHEN 3 THEN concat(' ', year(o_orderdate), ' ') WHEN 4 THEN '99999999999'
             WHEN 5 THEN NULL WHEN 6 THEN concat('-', o_orderkey)
             ELSE cast(year(o_orderdate) AS string) END AS year""",
    )


def landed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        """concat('/landing/', l_returnflag, '/', l_orderkey,
             CASE WHEN l_linestatus = 'O' THEN '.json' WHEN l_returnflag = 'N' THEN '.JSON'
                  ELSE '.txt' END) AS path"""
    )


def raw_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").selectExpr(
        "concat('/raw/albums/', o_orderkey, '.json') AS path"
    )


def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey AS id")


def collab_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per supplier: itself, the next one, and one fixed other."""
    from linernotes.functions.text import content_id, norm_text

    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", content_id(norm_text(F.col("s_name"))).alias("artist_id")
    )
    fixed = content_id(F.lit("supplier 000000003"))
    asked = F.explode(F.array(
        F.struct(F.col("s_suppkey").alias("request_id"), F.col("artist_id")),
        F.struct((F.col("s_suppkey") - 1).alias("request_id"), F.col("artist_id")),
        F.struct(F.col("s_suppkey").alias("request_id"), fixed.alias("artist_id")),
    ))
    return suppliers.select(asked.alias("r")).select("r.*")
