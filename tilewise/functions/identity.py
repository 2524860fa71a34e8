"""Keys, names and guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_SHA256 = r"^[0-9a-f]{64}$"


def group_key(*parts: Column) -> Column:
    """Canonical JSON array of texts: compact, non-ASCII kept."""
    return F.to_json(F.array(*[p.cast("string") for p in parts]))


def file_identity(path: Column) -> Column:
    """Last part of a POSIX path; null where there is none or it is a dot name."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    return F.when(~name.isin("", ".", ".."), name)


def url_file_identity(url: Column) -> Column:
    """Last part of a URL's path, without query and fragment."""
    return file_identity(F.try_parse_url(url, F.lit("PATH")))


def is_sha256(value: Column) -> Column:
    return F.coalesce(value.rlike(HEX_SHA256), F.lit(False))
