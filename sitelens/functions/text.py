"""Text rules of the indexer as array expressions over one page row.

A page is one row, so its lines, indexable rows and per-line term counts are
computed inside the row with higher-order functions.  Nothing here shuffles;
page size alone bounds the work of a task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import LINE_SEP, MARKUP_FIRST_CHAR, TERM_SEP, WORD_ENDS

MARKUP_LIKE = MARKUP_FIRST_CHAR + "_%"           # the marker plus at least one more character
WORD_END_PATTERN = f"[^{WORD_ENDS}]+[{WORD_ENDS}]"  # a counted word is followed by a word end


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lines_array(html) -> Column:
    """Physical lines; a final LF does not open an empty last line, blank
    lines in between count, an empty text has no line."""
    # the lambda's variable: the text is built and split once, not for each use of its parts
    cut = lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p)
    return F.get(F.transform(F.array(F.split(_col(html), LINE_SEP, -1)), cut), F.lit(0))


def numbered_lines(lines) -> Column:
    """``array<struct<line_no bigint, line string>>`` with 0-based line_no."""
    return F.transform(_col(lines), lambda l, i: F.struct(i.cast("bigint").alias("line_no"), l.alias("line")))


def indexable_lines_array(numbered) -> Column:
    """Drop markup lines (first character ``<`` and at least one more).

    Filtering inside the array, before any explode, lets ``posexplode`` give
    the dense 0-based ``row`` ordinal with no window or shuffle.
    """
    return F.filter(_col(numbered), lambda z: ~z["line"].like(MARKUP_LIKE))


def line_terms(line) -> Column:
    """Terms of a line: split on the space byte, runs collapse, case and
    punctuation kept, tab and CR stay inside words."""
    return F.array_remove(F.split(_col(line), TERM_SEP, -1), "")


def sorted_runs(sorted_col) -> Column:
    """0-based start positions of runs of equal values in a sorted array."""
    s = _col(sorted_col)
    flags = F.transform(s, lambda x, i: F.when(i == 0, i).when(x != s[i - 1], i).otherwise(F.lit(-1)))
    return F.filter(flags, lambda i: i >= 0)


def term_counts(sorted_terms, run_starts) -> Column:
    """``array<struct<term, tf>>`` from a sorted term array and its run starts
    (two columns, so each array is computed once)."""
    s = _col(sorted_terms)
    st = _col(run_starts)
    n = F.size(s)
    nxt = lambda j: F.when(j + 1 < F.size(st), st[j + 1]).otherwise(n)
    return F.transform(st, lambda b, j: F.struct(s[b].alias("term"), (nxt(j) - b).cast("bigint").alias("tf")))


def repeats(sorted_col) -> Column:
    """The values of a sorted array that are equal to the one before them:
    every occurrence of a value but its first."""
    s = _col(sorted_col)
    return F.filter(s, lambda x, i: x == F.get(s, i - 1))


def words_once(sorted_terms, repeated) -> Column:
    """The distinct terms of a sorted array: those that occur once, then those
    among its :func:`repeats`."""
    return F.concat(F.array_except(_col(sorted_terms), _col(repeated)), F.array_distinct(_col(repeated)))


def repeat_counts(repeated, run_starts) -> Column:
    """Occurrences of the distinct :func:`repeats`, in their order."""
    st = _col(run_starts)
    end = lambda j: F.when(j + 1 < F.size(st), F.get(st, j + 1)).otherwise(F.size(_col(repeated)))
    return F.transform(st, lambda b, j: (end(j) - b + 1).cast("bigint"))


def text_bytes(text) -> Column:
    return F.octet_length(_col(text)).cast("bigint")


def text_words(text) -> Column:
    """Words as the word counter sees them: a run of bytes other than space
    and LF that is followed by a space or LF (a last unterminated word is not
    counted)."""
    return F.size(F.regexp_extract_all(_col(text), F.lit(WORD_END_PATTERN), 0)).cast("bigint")


def text_lines(text) -> Column:
    """Number of LF bytes."""
    t = _col(text)
    return (F.length(t) - F.length(F.replace(t, F.lit(LINE_SEP), F.lit("")))).cast("bigint")
