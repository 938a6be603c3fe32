"""Object keys, content types and status classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KEY_PREFIX = "wallpapers"
DEFAULT_EXTENSION = "jpg"
CONTENT_TYPES = {
    ".png": "image/png",
    ".webp": "image/webp",
    ".jpeg": "image/jpeg",
    ".jpg": "image/jpeg",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
MISSING_CODES = ("404", "NoSuchKey", "NotFound")
RETRYABLE_STATUSES = (429, 500, 502, 503, 504)


def url_extension(url: Column, strict: bool = False) -> Column:
    """Lower-cased text after the last dot of the whole URL, cut at ``?``.

    The rule looks at the whole URL, so ``a.png?v=1.2`` gives ``2`` and a URL whose only dots
    are in its host gives part of the path. ``strict=True`` looks at the last path segment,
    without query and fragment, instead.
    """
    if strict:
        path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
        found = F.regexp_extract(path, r"\.([^./]+)$", 1)
        return F.lower(F.when(found != "", found).otherwise(F.lit(DEFAULT_EXTENSION)))
    tail = F.when(F.contains(url, F.lit(".")), F.substring_index(url, ".", -1)).otherwise(
        F.lit(DEFAULT_EXTENSION)
    )
    return F.lower(F.substring_index(tail, "?", 1))


def object_key(key: Column, url: Column, prefix: str = KEY_PREFIX, strict: bool = False) -> Column:
    """``prefix/key.extension``: the same row always gets the same object."""
    return F.concat(F.lit(f"{prefix}/"), key, F.lit("."), url_extension(url, strict))


def content_type(key: Column) -> Column:
    """Content type by the key's suffix, ignoring case."""
    lowered = F.lower(key)
    chosen = None
    for suffix, mime in CONTENT_TYPES.items():
        hit = F.endswith(lowered, F.lit(suffix))
        chosen = F.when(hit, mime) if chosen is None else chosen.when(hit, mime)
    return chosen.otherwise(F.lit(DEFAULT_CONTENT_TYPE))


def probe_class(code: Column) -> Column:
    """What an existence probe's error code says: the object is missing, or nobody knows."""
    return F.when(code.isin(*MISSING_CODES), "missing").otherwise("unknown")


def is_retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE_STATUSES)


def payload_size(body: Column) -> Column:
    """Size in bytes, for strings as well as binaries."""
    return F.octet_length(body).cast("bigint")
