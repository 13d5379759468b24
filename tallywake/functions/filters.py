"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: page addresses that end in a static asset. Case-sensitive, and a query string after the
# extension makes the address a page again.
STATIC_ASSET = r"\.(css|js|png)$"


def is_page(url: Column | str) -> Column:
    """True for addresses that are not static assets. Line breaks never occur inside an address."""
    return ~F.col(url).rlike(STATIC_ASSET) if isinstance(url, str) else ~url.rlike(STATIC_ASSET)


def not_equal(col: str, value: str, ignore_case: bool = True) -> Column:
    """Inequality on a label; by default `UNINSTALL` equals `uninstall`."""
    return F.lower(col) != value.lower() if ignore_case else F.col(col) != value
