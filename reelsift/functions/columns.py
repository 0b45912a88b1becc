"""Scalar column expressions shared by the operators.

All of them are JVM-side expressions, no Python UDF anywhere.  Higher-order
functions (where arrays are involved) run interpreted, beside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's workload constants.
POSITIVE_THRESHOLD = 3.5  # rating >= 3.5 is a positive ("liked") sample
DEFAULT_RELEASE_YEAR = 1990  # feature job default for null or short titles
TITLE_YEAR_SUFFIX = 6  # " (YYYY)" is six characters at the end of a title

_PIPE = "[|]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def label(rating="rating", threshold: float = POSITIVE_THRESHOLD) -> Column:
    """1 when rating >= threshold, else 0 (null rating -> 0, as ``otherwise``)."""
    return F.when(_c(rating) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def release_year(title="title", default: int | None = DEFAULT_RELEASE_YEAR, unparsed: int | None = None) -> Column:
    """Year from a ``Name (YYYY)`` title.

    ``default`` is returned for a null title or a trimmed title shorter than six
    characters; ``unparsed`` when the four characters before the closing
    parenthesis are not a number.  The feature job uses (1990, null); the strict
    item loader uses (0, 0).
    """
    t = F.trim(_c(title))
    parsed = F.substring(t, -5, 4).try_cast("int")
    if unparsed is not None:
        parsed = F.coalesce(parsed, F.lit(unparsed))
    return F.when(_c(title).isNull() | (F.length(t) < TITLE_YEAR_SUFFIX), F.lit(default).cast("int")).otherwise(parsed)


def clean_title(title="title") -> Column:
    """Title without its `` (YYYY)`` suffix when a year parses; else the trimmed title."""
    t = F.trim(_c(title))
    has_year = (F.length(t) >= TITLE_YEAR_SUFFIX) & F.substring(t, -5, 4).try_cast("int").isNotNull()
    head = F.substring(t, F.lit(1), F.length(t) - F.lit(TITLE_YEAR_SUFFIX))
    return F.when(has_year, F.trim(head)).otherwise(t)


def genre_slot(genres="genres", i: int = 0) -> Column:
    """The i-th genre (0-based) of a ``A|B|C`` string; null past the end."""
    return F.get(F.split(_c(genres), _PIPE), i)


def genre_array(genres="genres") -> Column:
    """Genre list of a ``A|B|C`` string: blank or null -> empty list; trailing
    empty pieces dropped (so ``A|B|`` -> [A, B])."""
    g = _c(genres)
    stripped = F.regexp_replace(g, "[|]+$", "")
    empty = F.array().cast("array<string>")
    return F.when(g.isNull() | (F.trim(g) == "") | (stripped == ""), empty).otherwise(F.split(stripped, _PIPE))


def genre_pieces(genres="genres") -> Column:
    """Genres as the feature job splits them: like ``genre_array``, but a blank string is one blank genre."""
    g = _c(genres)
    return F.when(g == "", F.array(F.lit(""))).otherwise(genre_array(g))


def fmt2(x) -> Column:
    """Two-decimal text with thousands separators; rounded to 6 places first so
    the last digit does not depend on summation order."""
    return F.format_number(F.round(_c(x), 6), 2)


def uniform(*parts, seed: int = 0) -> Column:
    """Deterministic uniform number in [0, 1) from the md5 of ``parts`` and a seed.

    Same value in any engine that has md5 and hex parsing, so random operators
    (sampling, splits, fallback scores) can be checked exactly.
    """
    key = F.concat_ws(":", *[_c(p).cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def round6(x) -> Column:
    """Round to 6 places half away from zero on ``x * 1e6`` (the same IEEE steps
    as C's ``round``), so ranks and outputs agree with other engines even when
    the shortest decimal form of ``x`` ends in 5 at the seventh place."""
    v = _c(x)
    # beyond 2**53 / 1e6 a double has no sixth place, and floor() to a long would saturate further on
    return F.when(F.abs(v) >= 9.0e9, v).otherwise(F.signum(v) * F.floor(F.abs(v) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6))


def to_double_array(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def unit_vector(a) -> Column:
    """a / |a|; null for a null or zero vector (a zero vector has no direction)."""
    arr = to_double_array(a)
    n = norm(arr)
    return F.when(arr.isNull() | (n == 0), F.lit(None).cast("array<double>")).otherwise(
        F.transform(arr, lambda x: x / n)
    )


def cosine100(a, b) -> Column:
    """Cosine similarity x 100; null when either vector is missing, the sizes
    differ or a vector is all zeros (callers coalesce null to the -1 sentinel)."""
    x, y = to_double_array(a), to_double_array(b)
    denom = norm(x) * norm(y)
    ok = x.isNotNull() & y.isNotNull() & (F.size(x) == F.size(y)) & (denom != 0)
    return F.when(ok, dot(x, y) / denom * 100.0)
