"""Batch tags, file-name timestamps and time-zone tags as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tag layout and the file-name timestamp format.
TAG_FORMAT = "yyyyMMdd_HHmmss"
TAG_REGEX = r"(\d{8}_\d{6})"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def batch_tag(path, table: str, source: str = "folder") -> Column:
    """``DH_<TABLE>_<yyyyMMdd_HHmmss>`` taken from a file path.

    ``source='folder'`` takes the first ``<table>_<ts>`` match in the path (the landing folder);
    ``source='file'`` anchors the match in the last path segment. No match gives an empty suffix.
    """
    if source == "file":
        rx = table + "_" + TAG_REGEX + r"[^/]*$"
    else:
        rx = table + "_" + TAG_REGEX
    return F.concat(F.lit("DH_" + table.upper() + "_"), F.regexp_extract(_col(path), rx, 1))


def format_batch_tag(ts_text) -> Column:
    """ISO text such as ``2025-08-24T11:23:39.0000000`` -> ``20250824_112339`` (first 26 chars parsed)."""
    head = F.substring(_col(ts_text), 1, 26)
    ts = F.try_to_timestamp(head, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return F.date_format(ts, TAG_FORMAT)


def file_name_timestamp(name) -> Column:
    """Timestamp of a ``<entity>_<yyyyMMdd_HHmmss>.<ext>`` file name, anchored at the end of the name."""
    stamp = F.regexp_extract(_col(name), r"_(\d{8}_\d{6})\.[^./]*$", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit(TAG_FORMAT)).cast("timestamp_ntz")


def file_entity(name) -> Column:
    """Entity part of ``<entity>_<yyyyMMdd_HHmmss>.<ext>``; underscores inside the entity are kept."""
    return F.nullif(F.regexp_extract(_col(name), r"^(.*)_\d{8}_\d{6}\.[^./]*$", 1), F.lit(""))


def local_batch_tag(ts_utc, zone: str = "Asia/Kolkata") -> Column:
    """UTC wall time -> tag in a local zone, independent of the session time zone."""
    ntz = _col(ts_utc).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz), TAG_FORMAT)


def iso_text(ts) -> Column:
    """Render a timestamp as ``yyyy-MM-ddTHH:mm:ss.SSSSSS0`` (the seven-digit ISO form landing systems emit)."""
    return F.concat(F.date_format(_col(ts).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0"))


def parse_date(text, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date; unparsable text gives NULL instead of failing the job under ANSI mode."""
    return F.to_date(F.try_to_timestamp(_col(text), F.lit(fmt)))
