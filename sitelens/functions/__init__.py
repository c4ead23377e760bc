"""Column functions (all built-in Spark expressions, no Python UDFs)."""

from .text import (indexable_lines_array, line_terms, lines_array, numbered_lines,
                   term_counts, text_bytes, text_lines, text_words)
from .urls import LINK_PATTERN, href_targets, normalize_url, site_of
from .timefmt import uptime_hms

__all__ = [
    "lines_array", "numbered_lines", "indexable_lines_array", "line_terms", "term_counts",
    "text_bytes", "text_words", "text_lines", "href_targets", "normalize_url", "site_of",
    "LINK_PATTERN", "uptime_hms",
]
