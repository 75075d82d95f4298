"""Object keys: URL decoding and the region part of a landing path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_key(c: Column, plus_is_blank: bool = True) -> Column:
    """URL-decode an object key; malformed escapes are left as they are.

    Event notifications encode a blank as ``+``; file URIs do not, so pass
    ``plus_is_blank=False`` for ``_metadata.file_path``.
    """
    escaped = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    if not plus_is_blank:
        escaped = F.replace(escaped, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(escaped), c)


def region_from_key(c: Column, default: str = "unknown") -> Column:
    """Value of the first path part that starts with ``region=``."""
    found = F.regexp_extract(c, r"(?:^|/)region=([^=/]*)", 1)
    return F.when(c.rlike(r"(^|/)region="), found).otherwise(F.lit(default))
