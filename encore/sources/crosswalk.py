"""Staging rows derived from the TPC-H-like test tables.

Stands in for the log and catalogue files wherever a query runs on those
tables. Nothing here depends on the session time zone.

How the joins run is left to Spark, and a hot key to the skew handling of AQE, but for the
catalogue: Spark takes the size of a join for the product of its inputs' sizes and would rather
broadcast the line items, so the catalogue is counted and broadcast up to ``BROADCAST_ROWS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000  # of some 200 bytes: about 100 MB
BESIDE = " "  # between objects of the written files, whether a line ends there or not
# The text of a row is some ten times its Parquet. A packed file is read by one task, so it has few rows.
PACKED = {"lineSep": BESIDE, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def counted_broadcast(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` to be broadcast if it is counted to have few rows, else as it is."""
    return F.broadcast(side) if side.count() <= rows else side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ``events`` row whose user is a customer."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    joined = table(spark, sf_dir, "events").join(
        customers, F.expr("user_id = c_custkey")
    )
    return joined.selectExpr(
        "'Supplier#' || lpad(string(int(get_json_object(props, '$.k')) + 5), 9, '0') as artist",
        "if(event_type = 'error', 'Logged Out', 'Logged In') as auth",
        "'Customer' as firstname",
        "if(user_id % 2 = 0, 'F', 'M') as gender",
        "int(event_id % 50) as iteminsession",
        "c_name as lastname",
        "cast(value as decimal(10,5)) as length",
        "if(event_id % 3 = 0, 'paid', 'free') as level",
        "n_name as location",
        "if(event_type = 'view', 'PUT', 'GET') as method",
        "case event_type when 'view' then 'NextSong' when 'click' then 'Home'"
        " when 'signup' then 'Upgrade' when 'purchase' then 'Settings'"
        " when 'error' then 'Error' end as page",
        "cast(1500000000000 + user_id as decimal(18,0)) as registration",
        "int(user_id * 31 + day(ts)) as sessionid",
        "'Song ' || (event_id % 64) as song",
        "if(event_type = 'error', 404, 200) as status",
        "unix_date(date(ts)) * 86400000L + hour(ts) * 3600000L as ts",
        "'agent/' || (user_id % 7) as useragent",
        "if(event_type = 'error', null, int(user_id)) as userid",
    )


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ``lineitem`` row: parts are songs, suppliers are artists."""
    suppliers = table(spark, sf_dir, "supplier")
    supplier_count = suppliers.agg(F.count("*")).scalar()
    artists = suppliers.join(
        table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey")
    )
    parts = table(spark, sf_dir, "part").withColumn("_supplier", F.col("p_partkey") % supplier_count)
    # Computed once per part and not once per line item.
    catalogue = parts.join(artists, F.expr("_supplier = s_suppkey")).selectExpr(
        "p_partkey",
        "1 as num_songs",
        "'AR' || lpad(string(s_suppkey), 16, '0') as artist_id",
        "if(s_acctbal < 0, null, cast(s_acctbal / 1000 as decimal(10,5))) as artist_latitude",
        "if(s_acctbal < 0, null, cast(-s_acctbal / 100 as decimal(10,5))) as artist_longitude",
        "if(p_size <= 2, '', n_name) as artist_location",
        "s_name as artist_name",
        "'SO' || lpad(string(p_partkey), 16, '0') as song_id",
        "p_name as title",
        "cast(p_retailprice as decimal(10,5)) as duration",
        "if(p_size <= 5, 0, 1970 + p_size) as year",
    )
    items = table(spark, sf_dir, "lineitem").select("l_partkey")
    joined = items.join(counted_broadcast(catalogue), F.expr("l_partkey = p_partkey"))
    return joined.drop("l_partkey", "p_partkey")


def write_logs(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The staging events as packed log files: JSON lines in nested folders.

    Keys come in two spellings, user ids are quoted and may be empty, the
    registration is a float, and one key belongs to no column.
    """
    events = staging_events(spark, sf_dir)
    text_id = F.coalesce(F.col("userid").cast("string"), F.lit(""))
    values = {
        **{c: F.col(c) for c in events.columns},
        "registration": F.col("registration").cast("double"),
        "userid": text_id,
    }
    # The spelling of log keys that are not plain lower case.
    camel = {
        "firstname": "firstName",
        "lastname": "lastName",
        "iteminsession": "itemInSession",
        "sessionid": "sessionId",
        "useragent": "userAgent",
        "userid": "userId",
    }
    spelled = F.to_json(
        F.struct(*[v.alias(camel.get(c, c)) for c, v in values.items()]),
        {"ignoreNullFields": "false"},
    )
    shouted = F.to_json(
        F.struct(*[v.alias(c.upper()) for c, v in values.items()], F.lit("x").alias("OTHER"))
    )
    line = F.when(F.col("iteminsession") % 2 == 0, spelled).otherwise(shouted)
    lines = events.select(_on_lines(line), F.col("page").alias("folder"))
    lines.write.partitionBy("folder").options(**PACKED).text(path)


def _on_lines(text: Column) -> Column:
    """Texts in ``value`` with the end of their line, but for one in 32, after which the next goes on.

    To be written with BESIDE between them: lines are made as rows come, and no text is shuffled.
    """
    alone = F.monotonically_increasing_id() % 32 != 0
    return F.concat(text, F.when(alone, "\n").otherwise("")).alias("value")


def write_catalogue(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The staging songs as packed files, one JSON object a line or two."""
    songs = staging_songs(spark, sf_dir)
    one = F.to_json(F.struct(*songs.columns), {"ignoreNullFields": "false"})
    songs.select(_on_lines(one)).write.options(**PACKED).text(path)
