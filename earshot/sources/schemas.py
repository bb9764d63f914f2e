"""Explicit schemas of the inputs; nothing is inferred.

The column spellings are those of the file headers, which are fixed values.
"""

PLAYS = "user_id STRING, song_id STRING, play_count BIGINT"

CATALOG = (
    "SongNumber BIGINT, SongID STRING, AlbumID STRING, AlbumName STRING, ArtistID STRING, "
    "ArtistLatitude DOUBLE, ArtistLocation STRING, ArtistLongitude DOUBLE, ArtistName STRING, "
    "Danceability DOUBLE, Duration DOUBLE, KeySignature INT, KeySignatureConfidence DOUBLE, "
    "Tempo DOUBLE, TimeSignature INT, TimeSignatureConfidence DOUBLE, Title STRING, Year INT"
)

SONG_FEATURE_TYPES = {
    "title": "string", "songId": "string", "artistId": "string",
    "artistfamilarity": "double", "artistHotness": "double", "songHotness": "double",
    "songEnfOfFadeIn": "double", "startFadeout": "double", "energy": "double",
    "loudness": "double", "albumID": "bigint", "albumName": "string", "artistName": "string",
    "danceability": "double", "duration": "double", "keySignatureConfidence": "double",
    "tempo": "double", "timeSignature": "int", "timeSignatureConfidence": "double", "year": "int",
}

USER_FEATURE_TYPES = {
    "artistFamiliarity": "double", "artistHottness": "double", "artistName": "string",
    "dancebility": "double", "duration": "double", "endOfFadeIn": "double", "energy": "double",
    "loudness": "double", "songHotness": "double", "songID": "string", "songTitle": "string",
    "tempo": "double", "trackID": "string",
}
USER_FEATURES = "_idx BIGINT, " + ", ".join(f"{n} {t}" for n, t in USER_FEATURE_TYPES.items())

METADATA_SCALARS = {
    "artist_familiarity": "double", "artist_hotttnesss": "double", "artist_id": "string",
    "artist_mbid": "string", "artist_playmeid": "int", "artist_7digitalid": "int",
    "artist_latitude": "double", "artist_longitude": "double", "artist_location": "string",
    "artist_name": "string", "release": "string", "release_7digitalid": "int",
    "song_id": "string", "song_hotttnesss": "double", "title": "string", "track_7digitalid": "int",
}
ANALYSIS_SCALARS = {
    "analysis_sample_rate": "int", "audio_md5": "string", "danceability": "double",
    "duration": "double", "end_of_fade_in": "double", "energy": "double", "key": "int",
    "key_confidence": "double", "loudness": "double", "mode": "int", "mode_confidence": "double",
    "start_of_fade_out": "double", "tempo": "double", "time_signature": "int",
    "time_signature_confidence": "double", "track_id": "string",
}
MUSICBRAINZ_SCALARS = {"year": "int"}

SCALAR_GROUPS = {
    "metadata": METADATA_SCALARS,
    "analysis": ANALYSIS_SCALARS,
    "musicbrainz": MUSICBRAINZ_SCALARS,
}

METADATA_ARRAYS = {
    "similar_artists": "array<string>", "artist_terms": "array<string>",
    "artist_terms_freq": "array<double>", "artist_terms_weight": "array<double>",
}
ANALYSIS_ARRAYS = {
    "segments_start": "array<double>", "segments_confidence": "array<double>",
    "segments_pitches": "array<array<double>>", "segments_timbre": "array<array<double>>",
    "segments_loudness_max": "array<double>", "segments_loudness_max_time": "array<double>",
    "segments_loudness_start": "array<double>",
    "sections_start": "array<double>", "sections_confidence": "array<double>",
    "beats_start": "array<double>", "beats_confidence": "array<double>",
    "bars_start": "array<double>", "bars_confidence": "array<double>",
    "tatums_start": "array<double>", "tatums_confidence": "array<double>",
}
MUSICBRAINZ_ARRAYS = {"artist_mbtags": "array<string>", "artist_mbtags_count": "array<int>"}

ARRAY_GROUPS = {
    "metadata": METADATA_ARRAYS,
    "analysis": ANALYSIS_ARRAYS,
    "musicbrainz": MUSICBRAINZ_ARRAYS,
}


def _struct_ddl(fields: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"{name}: {type_name}" for name, type_name in fields.items()) + ">"


SONGS = ", ".join(
    f"{group} {_struct_ddl({**SCALAR_GROUPS[group], **ARRAY_GROUPS[group]})}"
    for group in SCALAR_GROUPS
)
