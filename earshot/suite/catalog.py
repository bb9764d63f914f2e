"""Queries on song records and their ragged arrays."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from earshot.operators import catalog as C
from earshot.sources import schemas
from earshot.sources.readers import read_songs
from earshot.suite import tables as T
from earshot.suite.registry import query

CATALOG_SQL = """SELECT 'S' || CAST(p_partkey AS VARCHAR) AS "SongID",
    CAST(p_partkey AS VARCHAR) AS "AlbumID", p_type || p_brand AS "AlbumName",
    'A' || CAST(p_size AS VARCHAR) AS "ArtistID",
    CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS "ArtistLatitude",
    CAST(NULL AS VARCHAR) AS "ArtistLocation", CAST(NULL AS DOUBLE) AS "ArtistLongitude",
    p_brand AS "ArtistName", CAST(0 AS DOUBLE) AS "Danceability", p_retailprice AS "Duration",
    CAST(NULL AS INTEGER) AS "KeySignature", CAST(NULL AS DOUBLE) AS "KeySignatureConfidence",
    p_size * CAST(2.5 AS DOUBLE) AS "Tempo", CAST(NULL AS INTEGER) AS "TimeSignature",
    CAST(NULL AS DOUBLE) AS "TimeSignatureConfidence", p_name || ', ' || p_type AS "Title",
    CAST(1950 + p_size AS INTEGER) AS "Year" FROM part"""


@query(f"""SELECT row_number() OVER (ORDER BY "SongID") AS "SongNumber", * FROM ({CATALOG_SQL})""")
def song_catalog(spark, folder):
    return C.catalog_rows(T.songs(spark, folder))


@query(f"""SELECT "Title", "Tempo", "Duration" FROM ({CATALOG_SQL})""")
def selected_attributes(spark, folder):
    songs = T.songs(spark, folder)
    rows = songs.select(*[C.scalar_field(f.split(".")[1]).alias(n) for n, f in C.CATALOG_FIELDS.items()])
    return C.select_attrs(rows, "title, TEMPO, Duration")


def _sql_scalars():
    known = {
        "song_id": "'S' || CAST(p_partkey AS VARCHAR)", "track_id": "'T' || CAST(p_partkey AS VARCHAR)",
        "title": "p_name || ', ' || p_type", "release": "p_type || ',' || p_brand", "artist_name": "p_brand",
        "artist_id": "'A' || CAST(p_size AS VARCHAR)", "release_7digitalid": "p_partkey",
        "artist_latitude": "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size END", "duration": "p_retailprice",
        "tempo": "p_size * CAST(2.5 AS DOUBLE)", "danceability": "0", "year": "1950 + p_size",
    }
    types = {"double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR"}
    return ", ".join(
        f'CAST({known.get(name, "NULL")} AS {types[kind]}) AS "{name}"'
        for group in schemas.SCALAR_GROUPS.values() for name, kind in group.items()
    )


@query(f"SELECT {_sql_scalars()} FROM part")
def song_scalar_fields(spark, folder):
    from earshot.session import staging_path

    path = staging_path(spark, "songs")
    T.songs(spark, folder).write.parquet(path)
    return C.song_scalars(read_songs(spark, path))


def _sql_fields(fields, types):
    kinds = {"double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR", "bigint": "BIGINT"}
    columns = ", ".join(f'CAST("{field}" AS {kinds[types[name]]}) AS "{name}"' for name, field in fields.items())
    return f"SELECT {columns} FROM (SELECT {_sql_scalars()} FROM part)"


@query(_sql_fields(C.FEATURE_FIELDS, schemas.SONG_FEATURE_TYPES))
def song_feature_columns(spark, folder):
    return C.song_features(T.songs(spark, folder))


@query(_sql_fields(C.PROFILE_FIELDS, schemas.USER_FEATURE_TYPES))
def profile_feature_columns(spark, folder):
    return C.profile_features(T.songs(spark, folder))


@query("""SELECT vec_id AS song_id, CAST(len(a) AS INTEGER) AS n_starts, CAST(len(b) AS INTEGER) AS n_weights,
    CAST(a[1] AS DOUBLE) AS first_start, CAST(a[len(a)] AS DOUBLE) AS last_start,
    round(list_sum(b), 6) AS weight_sum
    FROM (SELECT vec_id, CAST(list_slice(embedding, 1, vec_id % 64 + 1) AS DOUBLE[]) AS a,
        CAST(list_slice(embedding, vec_id % 64 + 1, 64) AS DOUBLE[]) AS b FROM embeddings)""")
def ragged_arrays(spark, folder):
    """Records of up to 16 songs with two flat arrays, cut up into the arrays of each song."""
    n = F.col("vec_id") % 64
    vectors = T.table(spark, folder, "embeddings").select(
        (F.col("vec_id") / 16).cast("bigint").alias("record"), "vec_id",
        F.slice("embedding", F.lit(1), (n + 1).cast("int")).cast("array<double>").alias("a"),
        F.slice("embedding", (n + 1).cast("int"), (64 - n).cast("int")).cast("array<double>").alias("b"),
    )
    before = W.partitionBy("record").orderBy("vec_id").rowsBetween(W.unboundedPreceding, -1)
    placed = vectors.select("*", *[
        F.coalesce(F.sum(F.size(c)).over(before), F.lit(0)).cast("int").alias(f"idx_{c}") for c in ("a", "b")
    ])
    entry = F.struct("vec_id", "a", "b", "idx_a", "idx_b")
    records = placed.groupBy("record").agg(F.array_sort(F.collect_list(entry)).alias("s")).select(
        F.flatten("s.a").alias("starts"), F.flatten("s.b").alias("weights"),
        F.transform("s", lambda x: F.struct(
            x["vec_id"].alias("song_id"), x["idx_a"].alias("idx_starts"), x["idx_b"].alias("idx_weights")
        )).alias("songs"),
    )
    cut = C.ragged_slice(records, {"starts": "idx_starts", "weights": "idx_weights"})
    total = F.aggregate("weights", F.lit(0.0), lambda acc, x: acc + x)
    return cut.select(
        "song_id", F.size("starts").alias("n_starts"), F.size("weights").alias("n_weights"),
        F.element_at("starts", 1).alias("first_start"), F.element_at("starts", -1).alias("last_start"),
        F.round(total, 6).alias("weight_sum"),
    )
