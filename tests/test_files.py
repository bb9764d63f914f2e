import pytest
from pyspark.sql import functions as F

from earshot.functions import columns as C
from earshot.operators import catalog
from earshot.operators.text import artist_country, artists_by_country
from earshot.sources import readers as R
from earshot.sources import schemas
from earshot.sources import writers as K


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_triplets(spark, tmp_path):
    path = write(tmp_path / "t.txt", "u1\ts1\t3", 'u"2\ts1\t1')
    assert rows(R.read_triplets(spark, path)) == [('u"2', "s1", 1), ("u1", "s1", 3)]


def test_whitespace_triplets_keep_two_or_three_fields(spark, tmp_path):
    path = write(tmp_path / "t.txt", "u1  s1\t3 extra", " u2 s2 4", "short")
    assert rows(R.read_triplets_ws(spark, path, 3)) == [("u1", "s1", 3), ("u2", "s2", 4)]
    assert rows(R.read_triplets_ws(spark, path, 2)) == [("u1", "s1"), ("u2", "s2")]
    with pytest.raises(ValueError):
        R.read_triplets_ws(spark, path, 4)


def test_last_line_of_a_song_wins_across_splits(spark, tmp_path):
    lines = [f"s{i % 7}\tT{i}\tignored" for i in range(2000)] + ["lonely", "s0\tLAST"]
    path = write(tmp_path / "map.txt", *lines)
    want = {f"s{k}": f"T{max(i for i in range(2000) if i % 7 == k)}" for k in range(1, 7)} | {"s0": "LAST"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = R.read_song_tracks(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        assert {r.song_id: r.track_id for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_song_features_drop_headers_and_short_lines(spark, tmp_path):
    header = ",".join(schemas.SONG_FEATURE_TYPES)
    path = write(
        tmp_path / "f.csv", header,
        '"One, two",S1,A1,0.5,0.4,nan,0.1,200.0,0.0,-5.5,77,Album,Artist,0.0,210.5,0.9,120.0,4,1.0,1999,',
        "Three,S2,A1,nan,0.4,,0.1,200.0,0.0,-5.5,78,Album,Artist,0.0,210.5,0.9,120.0,4,1.0,0",
        "short,S3,A1",
    )
    got = R.read_song_features(spark, path).orderBy("songId").collect()
    assert [(r.title, r.songId, r.artistfamilarity, r.songHotness, r.albumID, r.year) for r in got] == [
        ("One, two", "S1", 0.5, None, 77, 1999), ("Three", "S2", None, None, 78, 0),
    ]


def test_song_features_keep_lines_with_an_empty_last_field(spark, tmp_path):
    line = '"One, two",S1,A1,0.5,0.4,nan,0.1,200.0,0.0,-5.5,77,Album,"Artist ""x"", y",0.0,210.5,0.9,120.0,4,1.0,'
    path = write(tmp_path / "f.csv", line, line.replace("S1", "S2") + "1999,", "a,b,c")
    got = R.read_song_features(spark, path).orderBy("songId").collect()
    assert [(r.songId, r.artistName, r.year) for r in got] == [("S1", 'Artist "x", y', None), ("S2", 'Artist "x", y', 1999)]


def test_user_ids_with_odd_characters(spark, tmp_path):
    ids = ["a+b", "50%", "x y", "a/b=c", None]
    df = spark.createDataFrame([(i, f"s{n}", 1.0) for n, i in enumerate(ids)], "user_id STRING, songID STRING, duration DOUBLE")
    K.write_user_features(df, str(tmp_path / "out"))
    got = R.read_user_features(spark, str(tmp_path / "out")).select("songID", "user_id")
    assert rows(got, "songID") == [(f"s{n}", i) for n, i in enumerate(ids)]


def test_user_features_take_the_user_from_the_file_name(spark, tmp_path):
    header = "," + ",".join(schemas.USER_FEATURE_TYPES)
    line = "0,0.7,0.5,b'Devo',0.0,205.5,0.154,0.0,-16.6,,b'SO1',\"b\"\"It's, ok\"\"\",94.4,../A/TR1.h5"
    write(tmp_path / "abc_FV.csv", header, line)
    write(tmp_path / "def_FV.csv", header, line.replace("0,0.7,", "0,0.9,"))
    got = R.read_user_features(spark, str(tmp_path)).withColumn("title", C.unwrap_bytes(F.col("songTitle")))
    assert rows(got.select("user_id", "artistFamiliarity", "songHotness", "title", "trackID")) == [
        ("abc", 0.7, None, "It's, ok", "../A/TR1.h5"), ("def", 0.9, None, "It's, ok", "../A/TR1.h5"),
    ]


def test_user_feature_sink_and_source(spark, tmp_path):
    df = spark.createDataFrame([("u/1", "s1", 2.5, None), ("u2", "s2", 1.0, 'say "hi", all')],
                               "user_id STRING, songID STRING, duration DOUBLE, songTitle STRING")
    K.write_user_features(df, str(tmp_path / "out"))
    got = R.read_user_features(spark, str(tmp_path / "out"))
    assert rows(got.select("user_id", "songID", "duration", "songTitle")) == [
        ("u/1", "s1", 2.5, None), ("u2", "s2", 1.0, 'say "hi", all'),
    ]


def test_user_feature_buckets_hold_every_row(spark, tmp_path):
    df = spark.createDataFrame(
        [("u/1", "s1", 2.5, None), ("u2", "s2", 1.0, 'say "hi", all'), (None, "s3", None, ""), ("", "s4", 4.0, "x"), ("u2", "s2", 1.0, "y")],
        "user_id STRING, songID STRING, duration DOUBLE, songTitle STRING",
    )
    K.write_user_feature_buckets(df, str(tmp_path / "out"), 4)
    got = R.read_user_feature_buckets(spark, str(tmp_path / "out")).select(*df.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    for user in ("u/1", "u2", "", "nobody"):
        own = R.read_user_feature_buckets(spark, str(tmp_path / "out"), user).select(*df.columns)
        assert sorted(map(tuple, own.collect()), key=str) == sorted((tuple(r) for r in df.collect() if r.user_id == user), key=str)


def test_files_of_buckets_do_not_grow_with_listeners(spark, tmp_path):
    """Beside that, one listener with most rows is spread over files, and reading one opens one bucket."""
    files = {}
    for users in (50, 3000):
        df = spark.range(9000).select(
            F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % users).alias("user_id"), F.col("id").cast("string").alias("songID")
        )
        K.write_user_feature_buckets(df, str(tmp_path / str(users)), 8)
        files[users] = len(list((tmp_path / str(users)).glob("buckets=8/bucket=*/*.parquet")))
    assert max(files.values()) <= 8 + 8
    own = R.read_user_feature_buckets(spark, str(tmp_path / "3000"), "0")
    assert own.count() == 6000 + len([i for i in range(2, 9000, 3) if i % 3000 == 0])
    opened = {r[0].rsplit("/", 2)[1] for r in own.select(F.input_file_name()).distinct().collect()}
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert len(opened) == 1 and "PartitionFilters: [isnotnull(bucket" in plan


def test_user_paths_round_trip_in_line_order_and_in_parts(spark, tmp_path):
    df = spark.createDataFrame([("u", "b", 1), ("u", "a", 2), ("v", "c", 3)], "user_id STRING, path STRING, line INT")
    K.write_user_paths(df, str(tmp_path / "p"))
    assert rows(R.read_user_paths(spark, str(tmp_path / "p"))) == [("u", ["b", "a"]), ("v", ["c"])]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "p")).collect()) == ["u\tb\ta\t", "v\tc\t"]
    many = spark.range(50).select(F.lit("u").alias("user_id"), F.col("id").cast("string").alias("path"), F.col("id").alias("line"))
    K.write_user_paths(many, str(tmp_path / "q"), limit=10)
    parts = R.read_user_paths(spark, str(tmp_path / "q")).collect()
    assert sorted([int(p) for p in r.paths] for r in parts) == [list(range(i, i + 10)) for i in range(0, 50, 10)]
    lists = K.user_path_lists(many, limit=15).orderBy("part").collect()
    assert [int(p) for r in lists for p in r.paths] == list(range(50)) and [r.part for r in lists] == [0, 1, 2, 3]


def test_user_counts_lines_and_map(spark, tmp_path):
    df = spark.createDataFrame([("u", "b", 1), ("u", "a", 2)], "user_id STRING, path STRING, play_count BIGINT")
    K.write_user_counts(df, str(tmp_path / "c"))
    assert [r.value for r in spark.read.text(str(tmp_path / "c")).collect()] == ["u\ta\t2\tb\t1\t"]
    assert K.user_play_map(df).first().counts == {"a": 2, "b": 1}


def test_artist_locations_and_countries(spark, tmp_path):
    path = write(tmp_path / "loc.txt", "A1<SEP>40.5<SEP>-73.9<SEP>x", "A2<SEP>nan<SEP>1", "A3")
    assert rows(R.read_artist_locations(spark, path), "artist_id") == [("A1", 40.5, -73.9), ("A2", None, 1.0)]
    frame = spark.createDataFrame([("A1", "United States"), ("A2", "Japan")], "artist_id STRING, country STRING")
    out = str(tmp_path / "country")
    K.append_artist_country(frame, out)
    K.append_artist_country(spark.createDataFrame([("A3", "United Kingdom")], frame.schema), out)
    stored = R.read_artist_country(spark, out)
    assert rows(stored) == [("A1", "United States"), ("A2", "Japan"), ("A3", "United Kingdom")]
    artists = spark.createDataFrame([("A1",), ("A9",)], "artist_id STRING")
    assert rows(artist_country(artists, stored)) == [("A1", "United States")]
    assert rows(artists_by_country(stored)) == [("Japan", 1), ("United Kingdom", 1), ("United States", 1)]


def test_track_listing_ignores_case_of_the_extension(spark, tmp_path):
    for name in ("a/TR1.h5", "a/b/TR2.H5", "a/TR3.txt", "c/TR1.h5"):
        write(tmp_path / name, "x")
    got = {r.track_id: r.path for r in R.list_tracks(spark, str(tmp_path)).collect()}
    assert set(got) == {"TR1", "TR2"}
    assert got["TR1"].endswith("c/TR1.h5")


def song(song_id, title="T", release="R, x", latitude=float("nan"), starts=(0.0, 1.0)):
    values = {"song_id": song_id, "title": title, "release": release, "artist_latitude": latitude,
              "segments_start": list(starts), "year": 1999, "tempo": 90.5}
    return tuple(
        tuple(values.get(n) for n in {**schemas.SCALAR_GROUPS[g], **schemas.ARRAY_GROUPS[g]})
        for g in schemas.SCALAR_GROUPS
    )


def test_songs_scalars_catalog_and_listed_files(spark, tmp_path):
    songs = spark.createDataFrame([song("S2", 'say "hi"'), song("S1", latitude=3.5)], schemas.SONGS)
    songs.repartition(2, "metadata.song_id").write.parquet(str(tmp_path / "songs"))
    read = R.read_songs(spark, str(tmp_path / "songs"))
    assert len(catalog.song_scalars(read).columns) == 33
    assert rows(catalog.song_scalars(read, ["song_id", "artist_latitude", "year"])) == [("S1", 3.5, 1999), ("S2", None, 1999)]
    plan = catalog.song_scalars(read, ["tempo"])._jdf.queryExecution().executedPlan().toString()
    assert "segments_start" not in plan
    K.write_catalog(read, str(tmp_path / "catalog"))
    got = R.read_song_catalog(spark, str(tmp_path / "catalog"))
    assert rows(got.select("SongNumber", "SongID", "AlbumName", "ArtistLatitude", "Title", "Tempo", "Year")) == [
        (1, "S1", "R x", 3.5, "T", 90.5, 1999), (2, "S2", "R x", None, 'say "hi"', 90.5, 1999),
    ]
    K.write_catalog(read, str(tmp_path / "few"), "Title, Tempo")
    few = R.read_song_catalog(spark, str(tmp_path / "few"))
    assert rows(few.select("Title", "Tempo", "SongID"), "Title") == [("T", 90.5, None), ('say "hi"', 90.5, None)]
    assert few.columns == R.read_song_catalog(spark, str(tmp_path / "catalog")).columns
    files = sorted((tmp_path / "songs").glob("*.parquet"))
    (tmp_path / "songs" / "bad.parquet").write_text("not parquet")
    listing = write(tmp_path / "list.txt", str(files[0]), str(tmp_path / "songs" / "bad.parquet"), "/gone.parquet")
    kept = R.read_listed(spark, listing, str(tmp_path / "songs"))
    want = spark.read.schema(schemas.SONGS).parquet(str(files[0])).count()
    assert kept.count() == want
    # the same name in another folder is another file, and paths may be relative
    read.coalesce(1).write.parquet(str(tmp_path / "songs" / "more"))
    twin = tmp_path / "songs" / "more" / files[0].name
    next((tmp_path / "songs" / "more").glob("*.parquet")).rename(twin)
    assert R.read_listed(spark, listing, str(tmp_path / "songs")).count() == want
    relative = write(tmp_path / "relative.txt", f"./more/{files[0].name}", "")
    assert R.read_listed(spark, relative, str(tmp_path / "songs")).count() == 2


def test_unlisted_files_are_not_opened(spark, tmp_path):
    from earshot.suite import tables as T

    data = tmp_path / "records"
    T.songs(spark, "/root/testdata/sf0.001").repartition(6).write.parquet(str(data))
    files = sorted(data.glob("*.parquet"))
    want = sum(spark.read.schema(schemas.SONGS).parquet(str(f)).count() for f in files[:2])
    # reading one of these would fail, as bad files are not passed over
    for bad in files[2:]:
        bad.write_text("not parquet")
    (data / f".{files[3].name}.crc").unlink(missing_ok=True)
    odd = data / "a b%41é.parquet"
    odd.write_bytes(files[0].read_bytes())
    listing = write(tmp_path / "list.txt", str(files[0]), files[1].name, "gone.parquet")
    got = R.read_listed(spark, listing, str(data), skip_bad=False)
    assert got.count() == want
    assert {f.rsplit("/", 1)[1] for f in got.inputFiles()} == {f.name for f in files[:2]}
    listing = write(tmp_path / "odd.txt", odd.name)
    assert R.read_listed(spark, listing, str(data), skip_bad=False).count() > 0
    # the ways for many files and for names like patterns give the same rows
    assert R.read_listed(spark, write(tmp_path / "two.txt", files[0].name, odd.name), str(data), limit=1).count() > 0
    marked = data / "part[1].parquet"
    marked.write_bytes(files[0].read_bytes())
    listing = write(tmp_path / "marked.txt", marked.name)
    one = spark.read.schema(schemas.SONGS).parquet(str(files[0])).count()
    assert R.read_listed(spark, listing, str(data)).count() == one
    assert R.read_listed(spark, write(tmp_path / "none.txt", "gone"), str(data)).count() == 0


def test_attribute_selection(spark):
    df = spark.createDataFrame([(1, "x")], "Tempo INT, Title STRING")
    assert catalog.select_attrs(df, "title, TEMPO").columns == ["Title", "Tempo"]
    with pytest.raises(ValueError, match="pitch"):
        catalog.select_attrs(df, "title, pitch")
    with pytest.raises(ValueError):
        catalog.scalar_field("segments_start")


def test_ragged_slices_end_where_the_next_begins(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0, 3.0, 4.0], [[1.0], [2.0]], [("a", 0, 0), ("b", 1, 1), ("c", 1, 2)]), ([9.0], [], [("z", 0, 0)])],
        "starts ARRAY<DOUBLE>, pitches ARRAY<ARRAY<DOUBLE>>, songs ARRAY<STRUCT<song_id: STRING, i: INT, j: INT>>",
    )
    got = {r.song_id: (r.starts, r.pitches) for r in catalog.ragged_slice(df, {"starts": "i", "pitches": "j"}).collect()}
    assert got == {"a": ([1.0], [[1.0]]), "b": ([], [[2.0]]), "c": ([2.0, 3.0, 4.0], []), "z": ([9.0], [])}


def test_text_columns(spark):
    df = spark.createDataFrame(
        [("b'it'", " NaN", "x/y/TR1.b.h5"), ('b"it\'s"', "", "TR2"), ("bit", "1e3", "/a/TR3.H5"), ("b''", "abc", "T.")],
        "t STRING, n STRING, p STRING",
    )
    got = df.select(C.unwrap_bytes(F.col("t")), C.to_number(F.col("n")), C.file_stem(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("it", None, "TR1"), ("it's", None, "TR2"), ("bit", 1000.0, "TR3"), ("", None, "T")]
    words = spark.createDataFrame([("Beyoncé & Jay_Z, 99!",)], "t STRING").select(C.words(F.col("t"))).first()[0]
    assert [w for w in words if w] == ["beyoncé", "jay_z", "99"]
    assert C.parse_attrs("Title, Tempo\n") == ["title", "tempo"]
