"""The test tables in the shapes the operators expect, in Spark and as SQL.

``SQL`` holds common table expressions; ``with_tables`` puts those a query
names, and those they need, in front of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import stage

# plays shipped from this day on are held back when recommendations are scored
HIDDEN_FROM = "2000-06-01"

# lines that one task groups at once
TASK_LINES = 1 << 19
# lines of so many tasks are joined as Spark plans it
PLAIN_TASKS = 8

LINE_KEY = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
]

SQL = {
    "plays": """SELECT o_custkey AS user_id, l_partkey AS song_id,
        CAST(SUM(CAST(CEIL(l_quantity / 5) AS BIGINT)) AS BIGINT) AS play_count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
    "lines": """SELECT o_custkey AS user_id, l_partkey AS song_id,
        CAST(CEIL(l_quantity / 5) AS BIGINT) AS play_count,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_shipdate) AS line
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "order_brands": """SELECT DISTINCT o_orderkey AS basket_id, p_brand AS item
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
    "song_tracks": """SELECT p_partkey AS song_id, 'T' || CAST(p_partkey AS VARCHAR) AS track_id
        FROM part WHERE p_partkey % 7 <> 0""",
    "track_paths": """SELECT 'T' || CAST(p_partkey AS VARCHAR) AS track_id,
        p_brand || '/T' || CAST(p_partkey AS VARCHAR) || '.h5' AS path
        FROM part WHERE p_partkey % 11 <> 0""",
    "user_paths": """SELECT user_id, track_id, path, song_id, play_count, line
        FROM lines JOIN song_tracks USING (song_id) JOIN track_paths USING (track_id)""",
    "features": """SELECT p_partkey AS song_id, 'T' || CAST(p_partkey AS VARCHAR) AS track_id,
        CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size,
        p_retailprice AS price, CAST(0 AS DOUBLE) AS flat FROM part""",
    "ratings": """SELECT user_id, song_id, play_count,
        least(CAST(5 AS DOUBLE), log2(play_count) + 1) AS rating FROM by_user""",
    "by_song": """SELECT * FROM plays WHERE song_id IN
        (SELECT song_id FROM plays GROUP BY 1 HAVING count(*) >= 10)""",
    "by_user": """SELECT * FROM by_song WHERE user_id IN
        (SELECT user_id FROM by_song GROUP BY 1 HAVING count(*) >= 5)""",
    "centered": """SELECT user_id, song_id, rating,
        CASE WHEN lo = hi THEN 0 ELSE rating - mean END AS c
        FROM ratings JOIN (SELECT song_id, avg(rating) AS mean, min(rating) AS lo, max(rating) AS hi
            FROM ratings GROUP BY 1) USING (song_id)""",
    "norms": "SELECT song_id, sqrt(sum(c * c)) AS norm FROM centered GROUP BY 1",
}

NEEDS = {
    "user_paths": ["lines", "song_tracks", "track_paths"],
    "by_song": ["plays"],
    "by_user": ["by_song"],
    "ratings": ["by_user"],
    "centered": ["ratings"],
    "norms": ["centered"],
}


def with_tables(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named tables, those they need, and the ``extra`` ones, in order, then ``body``."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    parts = [(name, SQL[name]) for name in ordered] + list((extra or {}).items())
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts) + "\n" + body


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _joined(rows: DataFrame, other: DataFrame, folder: str, key: str, other_key: str) -> DataFrame:
    """``rows`` made of the lines with what ``other`` has for their key.

    Many lines meet in tasks that hold a bounded number of them, however many
    shuffle partitions the session has; few are joined as Spark plans it.
    """
    tasks = _line_count(rows.sparkSession, folder) // TASK_LINES + 1
    if tasks > PLAIN_TASKS:
        rows, other = rows.repartition(tasks, key), other.repartition(tasks, other_key)
    return rows.join(other, F.col(key) == F.col(other_key))


def _line_count(spark: SparkSession, folder: str) -> int:
    return table(spark, folder, "lineitem").count()


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return _joined(table(spark, folder, "lineitem"), orders, folder, "l_orderkey", "o_orderkey")


def _branded_lines(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    return _joined(_order_lines(spark, folder), part, folder, "l_partkey", "p_partkey")


def _plays_of_line():
    return F.ceil(F.col("l_quantity") / 5).cast("bigint")


def _dealt(rows: DataFrame, folder: str, *keys: str) -> DataFrame:
    """Rows made of the lines, by their keys in as many tasks as bound the lines of one.

    Few of them repeat a key, so a table of the keys takes far more memory than
    the rows are in a shuffle, by whose bytes Spark sizes the tasks otherwise.
    """
    n = _line_count(rows.sparkSession, folder)
    spread = min(rows.sparkSession.sparkContext.defaultParallelism, n // 32_768 + 1)
    return rows.repartition(max(n // TASK_LINES + 1, spread), *keys)


def plays(spark: SparkSession, folder: str) -> DataFrame:
    rows = _order_lines(spark, folder).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("song_id"), _plays_of_line().alias("n")
    )
    return _dealt(rows, folder, "user_id", "song_id").groupBy("user_id", "song_id").agg(F.sum("n").alias("play_count"))


def stored_plays(spark: SparkSession, folder: str) -> DataFrame:
    """``plays`` written once, for operators that read them several times."""
    return stage(plays(spark, folder), "plays")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Single plays with a sortable ``line`` key."""
    return _order_lines(spark, folder).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("song_id"),
        _plays_of_line().alias("play_count"), F.struct(*LINE_KEY).alias("line"),
    )


def order_brands(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _branded_lines(spark, folder).select(F.col("o_orderkey").alias("basket_id"), F.col("p_brand").alias("item"))
    return _dealt(pairs, folder, "basket_id", "item").distinct()


def song_tracks(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").where("p_partkey % 7 <> 0")
    return part.select(F.col("p_partkey").alias("song_id"), _track().alias("track_id"))


def track_paths(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").where("p_partkey % 11 <> 0")
    path = F.concat("p_brand", F.lit("/"), _track(), F.lit(".h5"))
    return part.select(_track().alias("track_id"), path.alias("path"))


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Song features, some of them missing and one constant."""
    size = F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("double"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("song_id"), _track().alias("track_id"), size.alias("size"),
        F.col("p_retailprice").alias("price"), F.lit(0.0).alias("flat"),
    )


def _track():
    return F.concat(F.lit("T"), F.col("p_partkey").cast("string"))


def order_plays(spark: SparkSession, folder: str) -> DataFrame:
    """Brands per order with their plays, visible or hidden by ship date."""
    hidden = F.col("l_shipdate") >= F.lit(HIDDEN_FROM).cast("timestamp")
    named = _branded_lines(spark, folder).select(
        F.col("o_orderkey").alias("user_id"), F.col("p_brand").alias("song_id"), hidden.alias("hidden"), _plays_of_line().alias("n")
    )
    keys = ["user_id", "song_id", "hidden"]
    return _dealt(named, folder, *keys).groupBy(*keys).agg(F.sum("n").alias("play_count"))


def songs(spark: SparkSession, folder: str, full: bool = False) -> DataFrame:
    """Parts as song records with the scalar groups and arrays of a song.

    With ``full``, numbers that parts have no column for are derived from the
    part's key, each with a period of its own, instead of being null.
    """
    from earshot.sources import schemas

    number = F.col("p_size").cast("double")
    values = {
        "song_id": F.concat(F.lit("S"), F.col("p_partkey").cast("string")),
        "track_id": _track(),
        "title": F.concat("p_name", F.lit(", "), "p_type"),
        "release": F.concat_ws(",", "p_type", "p_brand"),
        "artist_name": F.col("p_brand"),
        "artist_id": F.concat(F.lit("A"), F.col("p_size").cast("string")),
        "release_7digitalid": F.col("p_partkey").cast("int"),
        "artist_latitude": F.when(F.col("p_size") % 10 == 0, F.lit(float("nan"))).otherwise(number),
        "duration": F.col("p_retailprice"),
        "tempo": number * 2.5,
        "danceability": F.lit(0.0),
        "year": F.lit(1950).cast("int") + F.col("p_size"),
        "segments_start": F.array(number, number + 0.5),
    }
    groups = []
    for group in schemas.SCALAR_GROUPS:
        fields = {**schemas.SCALAR_GROUPS[group], **schemas.ARRAY_GROUPS[group]}
        if full:
            for place, (name, type_name) in enumerate(schemas.SCALAR_GROUPS[group].items()):
                if type_name.lower() in ("double", "int", "bigint") and (name not in values or name == "danceability"):
                    period = 89 + 2 * place
                    values[name] = (F.col("p_partkey") * (place + 3) % period + F.col("p_size") % (place + 2)) / period * 10
        groups.append(F.struct(*[
            values.get(name, F.lit(None)).cast(type_name).alias(name) for name, type_name in fields.items()
        ]).alias(group))
    return table(spark, folder, "part").select(*groups)
