"""Host names and their parent domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the host is what follows the scheme up to a slash or colon.
HOST_PATTERN = r"https?://([^/:]+)"
# The strict form also skips user information and stops at a query or fragment.
STRICT_HOST_PATTERN = r"(?i)https?://(?:[^/?#@]*@)?([^/:?#]+)"


def host_of(url: Column, strict: bool = False) -> Column:
    """Host of a URL, ``''`` when there is none, null for a null URL.

    ``strict`` also folds case and drops user information and a trailing dot.
    """
    if strict:
        return F.regexp_replace(F.lower(F.regexp_extract(url, STRICT_HOST_PATTERN, 1)), r"\.+$", "")
    return F.regexp_extract(url, HOST_PATTERN, 1)


def parent_domains(host: Column) -> Column:
    """All suffixes of at least two labels, longest first; empty for a bare label."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), count - 1),
        lambda i: F.array_join(F.slice(labels, i, count), "."),
    )
    return F.when(count > 1, suffixes).otherwise(F.array().cast("array<string>"))
