"""Scalar expressions (SCA1-SCA10). All are built-in Column expressions (JVM, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_genre(genres: Column) -> Column:
    """First entry of a pipe-separated genre list."""
    return F.split(genres, r"\|", 2)[0]


def title_with_first_genre(title: Column, genres: Column) -> Column:
    """SCA1. ``"Title (year) (FirstGenre)"``; null when the title is unknown."""
    return F.concat(title, F.lit(" ("), first_genre(genres), F.lit(")"))


def genres_array(genres: Column) -> Column:
    """SCA2. ``'A|B'`` -> ``['A', 'B']``."""
    return F.split(genres, r"\|")


def release_year(title: Column) -> Column:
    """SCA3. Year in a trailing ``(yyyy)`` of a title, else null."""
    y = F.regexp_extract(title, r"\((\d{4})\)\s*$", 1)
    return F.when(y != "", y.cast("int"))


def key_file_name(key: Column) -> Column:
    """SCA4. Last path part of an object key (after URL decoding)."""
    return F.element_at(F.split(url_decoded(key), "/"), -1)


def key_folder(key: Column) -> Column:
    """SCA4. Everything before the last ``/``."""
    return F.regexp_replace(url_decoded(key), r"/[^/]*$", "")


def url_decoded(key: Column) -> Column:
    """SCA4. ``+`` as space and ``%xx`` escapes decoded; invalid escapes leave the text as is."""
    return F.coalesce(F.try_url_decode(key), key)


def output_key(key: Column, name: str) -> Column:
    """SCA4. Sibling key: same folder, new file name."""
    return F.concat(key_folder(key), F.lit("/" + name))


def strip_uri_prefix(uri: Column) -> Column:
    """SCA5. ``scheme://bucket/rest`` -> ``rest``."""
    return F.regexp_replace(uri, r"^[a-z][a-z0-9+.-]*://[^/]+/?", "")


def last_path_part(x: Column) -> Column:
    """SCA6. Name = last ``/`` part of an identifier."""
    return F.substring_index(x, "/", -1)


def round_to_json(c: Column, digits: int = 4) -> Column:
    """SCA7. Round a number (or each field of a struct of numbers) to ``digits`` and render JSON."""
    return F.to_json(F.struct(F.round(c, digits).alias("value")))


def nested(c: str, *path) -> Column:
    """SCA8. ``nested('results', 'transcripts', 0, 'transcript')``; missing index -> null."""
    out = F.col(c)
    for p in path:
        out = F.get(out, p) if isinstance(p, int) else out.getField(p)
    return out


def epoch_to_ts(c: Column) -> Column:
    """SCA9. Epoch seconds -> timestamp."""
    return F.timestamp_seconds(c)


def ts_to_epoch(c: Column) -> Column:
    """SCA9. Timestamp -> epoch seconds."""
    return F.unix_seconds(c.cast("timestamp"))


def iso_z(c: Column) -> Column:
    """SCA9. Timestamp -> ISO-8601 text with ``Z``."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(c: Column) -> Column:
    """SCA9. ISO-8601 text (``Z`` or offset) -> timestamp; bad text -> null."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                      F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
                      F.try_to_timestamp(c))


def json_config(c: Column, schema: str) -> Column:
    """SCA10. JSON text -> typed struct (numbers given as strings are read by the schema)."""
    return F.from_json(c, schema, {"allowNumericLeadingZeros": "true"})
