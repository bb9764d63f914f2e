"""Queries on who listens to what."""

from pyspark.sql import functions as F

from earshot.functions import columns as C
from earshot.operators import activity as A
from earshot.operators import ordering as O
from earshot.operators import ratings as R
from earshot.operators import text as X
from earshot.operators.itemsets import to_baskets
from earshot.sources.writers import user_path_lists, user_play_map
from earshot.session import stage
from earshot.suite import tables as T
from earshot.suite.registry import query
from earshot.suite.tables import with_tables


@query(with_tables("plays", "SELECT count(DISTINCT user_id) AS users FROM plays"))
def distinct_users(spark, folder):
    return A.distinct_users(T.plays(spark, folder))


@query(with_tables("plays", "SELECT DISTINCT song_id FROM plays"))
def distinct_items(spark, folder):
    return A.distinct_items(T.plays(spark, folder))


def _within_bound(exact, estimates):
    # four standard errors of sketches of 4,096 bytes
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("exact"))
    return exact.join(estimates, "song_id", "full_outer").select("song_id", "exact", F.coalesce(near, F.lit(False)).alias("near"))


@query(with_tables("plays", "SELECT song_id, count(DISTINCT user_id) AS exact, true AS near FROM plays GROUP BY 1"))
def estimated_listeners_of_songs(spark, folder):
    """Distinct listeners per song, and whether sketches of two halves of the plays, merged, come near."""
    plays = stage(T.plays(spark, folder), "plays")
    half = F.pmod(F.xxhash64("user_id", "song_id"), F.lit(2))
    halves = [A.distinct_sketches(plays.where(half == n), "song_id", "user_id") for n in (0, 1)]
    merged = A.merged_sketches(halves[0].union(halves[1]), "song_id")
    exact = A.item_popularity(plays).select("song_id", F.col("distinct_users").alias("exact"))
    return _within_bound(exact, A.estimated_distinct(merged, "song_id"))


USER_ACTIVITY = """SELECT user_id, CAST(sum(play_count) AS BIGINT) AS total_plays,
    count(DISTINCT song_id) AS distinct_songs FROM plays GROUP BY 1 ORDER BY distinct_songs, user_id"""


@query(with_tables("plays", USER_ACTIVITY))
def user_activity(spark, folder):
    return A.user_activity(T.plays(spark, folder), ordered=True)


@query(with_tables("lines", USER_ACTIVITY.replace("FROM plays", "FROM lines")))
def user_activity_of_single_plays(spark, folder):
    return A.user_activity(T.lines(spark, folder), ordered=True)


@query(with_tables("plays", """SELECT song_id, CAST(sum(play_count) AS BIGINT) AS total_plays,
    count(DISTINCT user_id) AS distinct_users FROM plays GROUP BY 1 ORDER BY distinct_users DESC, song_id"""))
def item_popularity(spark, folder):
    return A.item_popularity(T.plays(spark, folder), ordered=True)


@query(with_tables("plays", """SELECT song_id, CAST(sum(play_count) AS BIGINT) AS total_plays,
    count(DISTINCT user_id) AS distinct_users FROM plays GROUP BY 1 HAVING count(DISTINCT user_id) > 32"""))
def popular_items(spark, folder):
    return A.popular_items(T.plays(spark, folder), min_users=32)


@query(with_tables("plays", """SELECT user_id,
    CAST(sum(play_count) AS DOUBLE) / count(DISTINCT song_id) AS plays_per_song
    FROM plays GROUP BY 1 ORDER BY 2, 1"""))
def plays_per_song(spark, folder):
    return A.plays_per_song(T.plays(spark, folder), ordered=True)


@query(with_tables("by_user", """SELECT 'lines' AS stage, count(*) AS n FROM plays
    UNION ALL SELECT 'songs_kept', count(DISTINCT song_id) FROM by_song
    UNION ALL SELECT 'users_kept', count(DISTINCT user_id) FROM by_user
    UNION ALL SELECT 'lines_kept', count(*) FROM by_user"""))
def funnel_counts(spark, folder):
    return A.funnel_counts(T.stored_plays(spark, folder))


@query(with_tables("plays", """SELECT user_id, song_id, play_count FROM plays WHERE song_id IN
    (SELECT song_id FROM plays GROUP BY 1 HAVING count(*) >= 30)"""))
def min_item_support(spark, folder):
    return R.min_item_support(T.stored_plays(spark, folder), 30)


@query(with_tables("plays", """SELECT user_id, song_id, play_count FROM plays WHERE user_id IN
    (SELECT user_id FROM plays GROUP BY 1 HAVING count(*) >= 40)"""))
def min_user_items(spark, folder):
    return R.min_user_items(T.stored_plays(spark, folder), 40)


@query(with_tables("plays", "SELECT user_id, song_id, play_count FROM k2", {
    "k1": "SELECT * FROM plays WHERE song_id IN (SELECT song_id FROM plays GROUP BY 1 HAVING count(*) >= 30)",
    "k2": "SELECT * FROM k1 WHERE user_id IN (SELECT user_id FROM k1 GROUP BY 1 HAVING count(*) >= 20)",
}))
def qualified_plays(spark, folder):
    return R.qualified_plays(T.stored_plays(spark, folder), 30, 20)


@query(with_tables("by_user", "SELECT user_id, song_id, round(rating, 9) AS rating FROM r", {
    "r": "SELECT user_id, song_id, least(CAST(5 AS DOUBLE), log2(play_count) + 1) AS rating FROM by_user"}))
def log_ratings(spark, folder):
    rows = R.to_ratings(T.stored_plays(spark, folder), "log2")
    return rows.withColumn("rating", F.round("rating", 9))


@query(with_tables("by_user", "SELECT user_id, song_id, CAST(play_count AS DOUBLE) AS rating FROM by_user"))
def raw_ratings(spark, folder):
    return R.to_ratings(T.stored_plays(spark, folder), "raw")


@query(with_tables("plays", """SELECT user_id, song_id, play_count FROM plays
    WHERE user_id = (SELECT min(user_id) FROM plays)"""))
def plays_of_one_user(spark, folder):
    plays = T.plays(spark, folder)
    return A.for_user(plays, plays.agg(F.min("user_id")).first()[0])


@query(with_tables("ratings", """SELECT user_id, song_id, round(rating, 9) AS rating FROM ratings
    WHERE song_id IN (SELECT song_id FROM ratings WHERE user_id = (SELECT min(user_id) FROM ratings))"""))
def rated_items(spark, folder):
    ratings = stage(R.to_ratings(T.stored_plays(spark, folder)), "ratings")
    mine = R.rated_items(ratings, ratings.agg(F.min("user_id")).first()[0])
    return mine.withColumn("rating", F.round("rating", 9))


@query(with_tables("ratings", """SELECT user_id, song_id, round(rating, 9) AS rating FROM ratings
    WHERE song_id NOT IN (SELECT song_id FROM ratings WHERE user_id = (SELECT min(user_id) FROM ratings))"""))
def candidate_items(spark, folder):
    ratings = stage(R.to_ratings(T.stored_plays(spark, folder)), "ratings")
    others = R.candidate_items(ratings, ratings.agg(F.min("user_id")).first()[0])
    return others.withColumn("rating", F.round("rating", 9))


@query(with_tables("user_paths", """SELECT user_id, count(*) AS tracks FROM user_paths
    GROUP BY 1 HAVING count(*) >= 30"""))
def active_users(spark, folder):
    return A.active_users(user_paths(spark, folder), 30)


@query(with_tables("user_paths", """SELECT user_id, count(*) AS tracks FROM user_paths
    GROUP BY 1 HAVING count(*) >= 30 ORDER BY min(line) LIMIT 11"""))
def first_active_users(spark, folder):
    return A.first_users(user_paths(spark, folder), 30, 11)


@query(with_tables("user_paths", "SELECT count(DISTINCT user_id) AS users FROM user_paths"))
def resolved_users(spark, folder):
    return A.resolved_users(user_paths(spark, folder))


@query(with_tables("lines", """SELECT user_id, song_id, play_count FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id, song_id ORDER BY line) AS rn FROM lines)
    WHERE rn = 1"""))
def first_play_of_song(spark, folder):
    return O.dedup(T.lines(spark, folder), ["user_id", "song_id"], ["line"], "first").drop("line")


@query(with_tables("lines", """SELECT user_id, song_id, play_count FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id, song_id ORDER BY line DESC) AS rn FROM lines)
    WHERE rn = 1"""))
def last_play_of_song(spark, folder):
    return O.dedup(T.lines(spark, folder), ["user_id", "song_id"], ["line"], "last").drop("line")


@query(with_tables("lines", """SELECT user_id, song_id, play_count FROM lines
    ORDER BY line LIMIT 1000"""))
def head_lines(spark, folder):
    return O.head_lines(T.lines(spark, folder), ["line"], 1000).drop("line")


@query(with_tables("plays", """SELECT user_id, song_id, play_count FROM plays
    ORDER BY user_id DESC, song_id DESC, play_count DESC LIMIT 2"""))
def top_triplets(spark, folder):
    return O.top(T.plays(spark, folder), 2)


@query(with_tables("plays", """SELECT row_number() OVER (ORDER BY user_id, song_id) AS "SongNumber",
    user_id, song_id, play_count FROM plays"""))
def numbered_plays(spark, folder):
    return O.number_rows(T.plays(spark, folder), ["user_id", "song_id"])


@query(with_tables("plays", """SELECT user_id, song_id, play_count,
    row_number() OVER (PARTITION BY user_id ORDER BY song_id) <= 21 AS is_train FROM plays"""))
def positional_split(spark, folder):
    return O.positional_split(T.stored_plays(spark, folder), 21)


@query(with_tables("plays", """SELECT user_id AS basket_id, CAST(0 AS INTEGER) AS part,
    string_agg(CAST(song_id AS VARCHAR), ',' ORDER BY song_id) AS items FROM plays GROUP BY 1"""))
def baskets_as_lists(spark, folder):
    rows = T.stored_plays(spark, folder).select(F.col("user_id").alias("basket_id"), F.col("song_id").alias("item"))
    return to_baskets(rows).withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


def user_paths(spark, folder):
    from earshot.operators.features import resolve_paths, resolve_tracks

    resolved = resolve_tracks(T.lines(spark, folder), T.song_tracks(spark, folder))
    return resolve_paths(resolved, T.track_paths(spark, folder))


FIRST_COUNTS = {"first_counts": """SELECT user_id, path, play_count FROM (SELECT *,
    row_number() OVER (PARTITION BY user_id, path ORDER BY line) AS rn FROM user_paths) WHERE rn = 1"""}


@query(with_tables("user_paths", "SELECT * FROM first_counts", FIRST_COUNTS))
def user_play_counts(spark, folder):
    from earshot.operators.features import user_play_counts as counts

    return counts(
        T.lines(spark, folder), T.song_tracks(spark, folder), T.track_paths(spark, folder)
    ).select("user_id", "path", "play_count")


@query(with_tables("user_paths", """SELECT user_id, CAST(0 AS INTEGER) AS part,
    string_agg(path || '=' || CAST(play_count AS VARCHAR), ',' ORDER BY path) AS counts
    FROM first_counts GROUP BY 1""", FIRST_COUNTS))
def user_play_maps(spark, folder):
    rows = user_play_map(user_play_counts(spark, folder))
    entries = F.transform(
        F.array_sort(F.map_entries("counts")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return rows.select("user_id", "part", F.array_join(entries, ",").alias("counts"))


@query(with_tables("user_paths", """SELECT user_id, CAST(0 AS INTEGER) AS part,
    string_agg(path, ',' ORDER BY line) AS paths FROM user_paths GROUP BY 1"""))
def user_path_list(spark, folder):
    rows = user_path_lists(user_paths(spark, folder))
    return rows.withColumn("paths", F.array_join("paths", ","))


@query("""SELECT term, count(*) AS n FROM
    (SELECT unnest(string_split_regex(lower(p_name), '[^\\p{L}\\p{M}\\p{N}_]+')) AS term FROM part)
    WHERE term <> '' AND term NOT IN ('small', 'large') GROUP BY 1""")
def name_word_frequency(spark, folder):
    return X.term_frequency(T.table(spark, folder, "part"), "p_name", ["small", "large"])


@query("""SELECT term, count(*) AS n FROM
    (SELECT unnest(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+')) AS term FROM documents)
    WHERE term <> '' AND term NOT IN ('a', 'an', 'and', 'are', 'as', 'at', 'be', 'by', 'for', 'from', 'in',
    'is', 'it', 'of', 'on', 'or', 'that', 'the', 'this', 'to', 'was', 'with')
    GROUP BY 1 ORDER BY n DESC, term LIMIT 200""")
def document_word_frequency(spark, folder):
    return X.term_frequency(T.table(spark, folder, "documents"), "text", n=200)


@query(with_tables("plays", """SELECT term, count(*) AS n FROM
    (SELECT unnest(string_split_regex(lower(p_name), '[^\\p{L}\\p{M}\\p{N}_]+')) AS term
     FROM plays JOIN part ON song_id = p_partkey WHERE user_id = (SELECT min(user_id) FROM plays))
    WHERE term <> '' GROUP BY 1"""))
def word_frequency_of_one_user(spark, folder):
    plays = T.plays(spark, folder)
    mine = A.for_user(plays, plays.agg(F.min("user_id")).first()[0])
    names = mine.join(T.table(spark, folder, "part"), F.col("song_id") == F.col("p_partkey"))
    return X.term_frequency(names, "p_name", [])


def _countries(spark, folder):
    artists = T.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("artist_id"), "s_name", F.col("s_nationkey").alias("nation")
    )
    nations = T.table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("country")
    )
    lookup = artists.join(nations, "nation").select("artist_id", "country")
    return X.artist_country(artists.select("artist_id", "s_name"), lookup)


@query("""SELECT s_suppkey AS artist_id, s_name, n_name AS country
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def artist_country(spark, folder):
    return _countries(spark, folder)


@query("""SELECT n_name AS country, count(*) AS artists
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def artists_by_country(spark, folder):
    return X.artists_by_country(_countries(spark, folder))


@query("""SELECT p_partkey, replace(p_name || ', ' || p_type, ',', '') AS no_commas,
    CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS number,
    p_name AS unwrapped, 'T' || CAST(p_partkey AS VARCHAR) AS stem,
    p_brand || '|' || p_name AS joined FROM part""")
def cleaned_text(spark, folder):
    """Commas, ``nan``, byte-string wrappers and file stems, put into the text and taken out again."""
    part = T.table(spark, folder, "part")
    wrapped = (
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("b'"), "p_name", F.lit("'")))
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit('b"'), "p_name", F.lit('"')))
        .otherwise(F.col("p_name"))
    )
    size = F.when(F.col("p_size") % 10 == 0, F.lit("nan")).otherwise(F.col("p_size").cast("string"))
    path = F.concat("p_brand", F.lit("/T"), F.col("p_partkey").cast("string"), F.lit(".h5"))
    return part.select(
        "p_partkey",
        C.strip_commas(F.concat("p_name", F.lit(", "), "p_type")).alias("no_commas"),
        C.to_number(size).alias("number"),
        C.unwrap_bytes(wrapped).alias("unwrapped"),
        C.file_stem(path).alias("stem"),
        F.concat_ws("|", "p_brand", "p_name").alias("joined"),
    )
