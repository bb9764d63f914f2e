"""Song records: scalar fields, attribute lists, ragged arrays, the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.columns import nan_number_to_null, parse_attrs, strip_commas
from earshot.operators.ordering import number_rows
from earshot.sources import schemas

# The catalog attributes in their written order, and the song field of each.
CATALOG_FIELDS = {
    "SongID": "metadata.song_id",
    "AlbumID": "metadata.release_7digitalid",
    "AlbumName": "metadata.release",
    "ArtistID": "metadata.artist_id",
    "ArtistLatitude": "metadata.artist_latitude",
    "ArtistLocation": "metadata.artist_location",
    "ArtistLongitude": "metadata.artist_longitude",
    "ArtistName": "metadata.artist_name",
    "Danceability": "analysis.danceability",
    "Duration": "analysis.duration",
    "KeySignature": "analysis.key",
    "KeySignatureConfidence": "analysis.key_confidence",
    "Tempo": "analysis.tempo",
    "TimeSignature": "analysis.time_signature",
    "TimeSignatureConfidence": "analysis.time_signature_confidence",
    "Title": "metadata.title",
    "Year": "musicbrainz.year",
}

# The columns of a song feature file, and the song field of each.
FEATURE_FIELDS = {
    "title": "title", "songId": "song_id", "artistId": "artist_id", "artistfamilarity": "artist_familiarity",
    "artistHotness": "artist_hotttnesss", "songHotness": "song_hotttnesss", "songEnfOfFadeIn": "end_of_fade_in",
    "startFadeout": "start_of_fade_out", "energy": "energy", "loudness": "loudness", "albumID": "release_7digitalid",
    "albumName": "release", "artistName": "artist_name", "danceability": "danceability", "duration": "duration",
    "keySignatureConfidence": "key_confidence", "tempo": "tempo", "timeSignature": "time_signature",
    "timeSignatureConfidence": "time_signature_confidence", "year": "year",
}

# The columns of a listener's feature file, and the song field of each.
PROFILE_FIELDS = {
    "trackID": "track_id", "songID": "song_id", "artistFamiliarity": "artist_familiarity",
    "artistHottness": "artist_hotttnesss", "artistName": "artist_name", "duration": "duration",
    "dancebility": "danceability", "endOfFadeIn": "end_of_fade_in", "energy": "energy", "loudness": "loudness",
    "songHotness": "song_hotttnesss", "tempo": "tempo", "songTitle": "title",
}


def select_attrs(df: DataFrame, attributes: str | Sequence[str]) -> DataFrame:
    """Columns named in ``"Title, Tempo"`` in any case; an unknown name is an error."""
    wanted = parse_attrs(attributes if isinstance(attributes, str) else ",".join(attributes))
    known = {column.lower(): column for column in df.columns}
    unknown = [name for name in wanted if name not in known]
    if unknown or not wanted:
        raise ValueError(f"unknown attributes {unknown}; choose from {sorted(known.values())}")
    return df.select(*[known[name] for name in wanted])


def scalar_field(name: str) -> Column:
    for group, fields in schemas.SCALAR_GROUPS.items():
        if name in fields:
            column = F.col(f"{group}.{name}")
            return (nan_number_to_null(column) if fields[name] == "double" else column).alias(name)
    raise ValueError(f"{name!r} is not a scalar song field")


def song_scalars(songs: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Scalar fields of song records, all 33 by default; only these are read from Parquet."""
    if fields is None:
        fields = [name for group in schemas.SCALAR_GROUPS.values() for name in group]
    return songs.select(*[scalar_field(name) for name in fields])


def _from_fields(songs: DataFrame, fields: Mapping[str, str], types: Mapping[str, str]) -> DataFrame:
    return songs.select(*[scalar_field(field).cast(types[name]).alias(name) for name, field in fields.items()])


def song_features(songs: DataFrame) -> DataFrame:
    """Song records to the 20 columns of a song feature file; NaN becomes NULL."""
    return _from_fields(songs, FEATURE_FIELDS, schemas.SONG_FEATURE_TYPES)


def profile_features(songs: DataFrame) -> DataFrame:
    """Song records to the 13 columns of a listener's feature file; NaN becomes NULL."""
    return _from_fields(songs, PROFILE_FIELDS, schemas.USER_FEATURE_TYPES)


def catalog_rows(songs: DataFrame, attrs: str | None = None) -> DataFrame:
    """The numbered catalog of song records, by default with all 17 attributes.

    Commas leave album names and locations, NaN becomes NULL.
    """
    columns = []
    for name, field in CATALOG_FIELDS.items():
        column = scalar_field(field.split(".")[1])
        if name in ("AlbumName", "ArtistLocation"):
            column = strip_commas(column)
        if name == "AlbumID":
            column = column.cast("string")
        columns.append(column.alias(name))
    rows = select_attrs(songs.select(*columns), attrs or list(CATALOG_FIELDS))
    return number_rows(rows, rows.columns)


def ragged_slice(
    records: DataFrame, arrays: Mapping[str, str], songs: str = "songs", keep: Sequence[str] = ("song_id",)
) -> DataFrame:
    """Per-song arrays out of records of several songs.

    A record has flat arrays and ``songs``, an array of structs with the start
    offset of each song in each flat array. ``arrays`` names flat column →
    offset field. A song's slice ends where the next song's begins; the last
    runs to the end. All happens inside the record, without a shuffle, and each
    flat array is cut up once.
    """
    def cut(song: Column, position: Column) -> Column:
        following = F.get(F.col(songs), position + 1)
        parts = []
        for flat, offset in arrays.items():
            end = F.coalesce(following[offset], F.size(flat))
            parts.append(F.slice(F.col(flat), song[offset] + 1, end - song[offset]).alias(flat))
        return F.struct(*[song[name].alias(name) for name in keep], *parts)

    return records.select(F.inline(F.transform(songs, cut)))
