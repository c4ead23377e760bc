"""Link and URL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import ANCHOR, PARENT_PREFIX, QUOTE

# the target is the first quoted, non-empty string after the anchor literal,
# within the same line
LINK_PATTERN = f'{ANCHOR}[^{QUOTE}\n]*{QUOTE}([^{QUOTE}\n]+)'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def href_targets(html) -> Column:
    """All link targets of a page, in order, as written (not normalized)."""
    return F.regexp_extract_all(_col(html), F.lit(LINK_PATTERN), 1)


def normalize_url(url, times: int = 1) -> Column:
    """Strip a leading ``../`` up to ``times`` times (one strip per step)."""
    out = _col(url)
    for _ in range(times):
        out = F.when(out.startswith(PARENT_PREFIX), F.substring(out, len(PARENT_PREFIX) + 1, 1 << 30)).otherwise(out)
    return out


def site_of(path) -> Column:
    """First non-empty path segment (leading slashes skipped)."""
    return F.regexp_extract(_col(path), r"^/*([^/]+)", 1)
