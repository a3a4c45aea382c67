"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from built-in functions, so it stays
inside whole-stage codegen; nothing runs Python per row.
"""

from __future__ import annotations

import fnmatch
import re


from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "glob_to_regex", "globs_to_regex", "matches_any_glob", "hash_unit",
    "hash_bigint", "micros", "whole_days", "round_even", "fill_nan",
    "finite", "bool_int", "ci_format", "ci_mid", "ci_center_bars",
    "cosine_rate", "list_len", "list_first", "list_last", "list_contains",
    "list_count", "list_slice", "list_tail", "tokens_text", "split_first",
    "split_last", "rsplit_last", "trunc_div", "strip_suffix_upper", "concat_cast",
    "site_label", "parse_ci_lo", "parse_ci_hi", "EPOCH_NTZ",
]

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- patterns
#: A shell pattern's pieces: a closed bracket set, or one character.
_GLOB_PIECE = re.compile(r"\[(!?)(\]?[^\]]*)\]|(.)", re.S)


def glob_to_regex(pattern: str) -> str:
    """Shell pattern (case-sensitive) as an anchored regex that both Java and
    RE2 accept. ``\\z`` anchors at the very end, unlike ``$``."""
    wild = {"*": ".*", "?": "."}

    def piece(m) -> str:
        if m[3] is not None:
            return wild.get(m[3], re.escape(m[3]))
        members = re.sub(r"([\\\[\]^&])", r"\\\1", m[2])
        return f"[{'^' if m[1] else ''}{members}]"

    return "(?s)\\A" + _GLOB_PIECE.sub(piece, pattern) + "\\z"


def globs_to_regex(patterns) -> str:
    return "|".join(f"(?:{glob_to_regex(p)})" for p in patterns)


def matches_any_glob(c, patterns) -> Column:
    """True when the text matches any of the shell patterns."""
    return col_of(c).rlike(globs_to_regex(patterns))


def _fnmatch_check(text: str, patterns) -> bool:
    """What the patterns mean, by the standard library (for tests)."""
    return any(fnmatch.fnmatchcase(text, p) for p in patterns)


# ---------------------------------------------------------------- hashing
def hash_bigint(c, seed) -> Column:
    """First 32 bits of md5(text(c) || '|' || seed) as a non-negative bigint.
    Stateless and identical in DuckDB, so samples, splits, shards and
    bootstrap draws all have SQL twins."""
    h = F.md5(F.concat(col_of(c).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def hash_unit(c, seed) -> Column:
    """Deterministic uniform draw in [0, 1) keyed on a column value."""
    return hash_bigint(c, seed) / F.lit(4294967296.0)


# ---------------------------------------------------------------- time
def micros(c) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ values,
    independent of the session time zone for NTZ input."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, cast({_sql(c)} as timestamp_ntz))")


def whole_days(start, end) -> Column:
    """Whole days from start to end, truncated toward zero."""
    d = micros(end) - micros(start)
    return trunc_div(d, 86400000000)


def trunc_div(num: Column, den: int) -> Column:
    """Integer division that truncates toward zero, like a duration's
    ``total_days``."""
    q = F.floor(F.abs(num) / F.lit(den))
    return (F.signum(num) * q).cast("bigint")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("micros() takes a column name")


# ---------------------------------------------------------------- numbers
def round_even(c, places: int = 4) -> Column:
    """numpy-style rounding: half to even on the binary value."""
    s = float(10 ** places)
    return F.rint(col_of(c) * F.lit(s)) / F.lit(s)


def fill_nan(c) -> Column:
    """numpy ``nan_to_num``: NaN and null → 0, ±inf → ± largest double."""
    x = col_of(c).cast("double")
    big = 1.7976931348623157e308
    return (F.when(x.isNull() | F.isnan(x), F.lit(0.0))
            .when(x == float("inf"), F.lit(big))
            .when(x == float("-inf"), F.lit(-big))
            .otherwise(x))


def finite(c) -> Column:
    """Not null, not NaN, not ±inf (S5). Null input gives null → row dropped."""
    x = col_of(c).cast("double")
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def bool_int(c) -> Column:
    return col_of(c).cast("int")


def ci_mid(lo, hi) -> Column:
    return (col_of(lo) + col_of(hi)) / 2


def fixed_text(x, places: int = 3) -> Column:
    """The exact binary value of a double, rounded half to even to ``places``
    decimals, as text (as C's ``%.3f``); null if null, not finite, or not
    below 2**31. A negative number keeps its sign when it rounds to zero.

    The value is taken apart into 31 + 32 bits behind the point, which is all
    that a double above 2**-10 has, so ties and the digits beyond the shortest
    decimal form decide as they do in binary."""
    v = col_of(x).cast("double")
    size = F.abs(v)
    high = F.floor(size * float(1 << 31))
    low = F.floor((size * float(1 << 31) - high.cast("double")) * float(1 << 32))
    scale = 10 ** places
    # both parts times the scale, in units of 2**-63 of the last place
    n = (high.cast("decimal(38,0)") * F.lit(str(1 << 32)).cast("decimal(11,0)") + low.cast("decimal(11,0)")).cast("decimal(34,0)")
    n = (n * F.lit(scale).cast("decimal(4,0)")).cast("decimal(38,0)")
    unit = F.lit(str(1 << 63)).cast("decimal(20,0)")
    rest = (n % unit).cast("decimal(20,0)")
    whole = ((n - rest) / unit).cast("decimal(20,0)")
    half = F.lit(str(1 << 62)).cast("decimal(20,0)")
    up = (rest > half) | ((rest == half) & (whole % F.lit(2).cast("decimal(1,0)") == 1))
    count = (whole + F.when(up, 1).otherwise(0).cast("decimal(1,0)")).cast("bigint")
    digits = F.concat(F.floor(count / scale).cast("bigint").cast("string"), F.lit("." if places else ""),
                      F.lpad((count % scale).cast("string"), places, "0") if places else F.lit(""))
    text = F.concat(F.when((v < 0) | (F.signum(v).cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit("")), digits)
    return F.when(v.isNotNull() & ~F.isnan(v) & (size < float(1 << 31)), text)


def ci_format(lo, hi, places: int = 3) -> Column:
    """``mid (±half)`` text of an interval, each number rounded as its exact
    binary value, half to even (0.8125 gives 0.812); a null or non-finite bound
    gives null. Bounds in either order give the same text."""
    a, b = col_of(lo).cast("double"), col_of(hi).cast("double")
    least, most = F.least(a, b), F.greatest(a, b)
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.concat(fixed_text((least + most) / 2, places), F.lit(" (±"), fixed_text((most - least) / 2, places), F.lit(")")))


def ci_center_bars(lo, hi):
    """(midpoint, lower arm, upper arm) for error bars."""
    m = ci_mid(lo, hi)
    return m, m - col_of(lo), col_of(hi) - m


_CI_CELL = r"^\[\s*(\S+)\s+(\S+)\s*\]$"


def _ci_part(c, i: int) -> Column:
    v = F.regexp_extract(col_of(c), _CI_CELL, i)
    return F.coalesce(F.when(v != "", v).try_cast("double"), F.lit(float("nan")))


def parse_ci_lo(c) -> Column:
    """Lower bound of a ``"[lo hi]"`` cell; null or unparsable → NaN."""
    return _ci_part(c, 1)


def parse_ci_hi(c) -> Column:
    """Upper bound of a ``"[lo hi]"`` cell; null or unparsable → NaN."""
    return _ci_part(c, 2)


def cosine_rate(base_lr, r, n_rounds) -> Column:
    """lr × ½(1 + cos(π(r − 1)/R)), from the base rate each round."""
    return col_of(base_lr) * 0.5 * (1 + F.cos(F.pi() * (col_of(r) - 1) / col_of(n_rounds)))


# ---------------------------------------------------------------- lists
def list_len(c) -> Column:
    return F.array_size(col_of(c))


def list_first(c) -> Column:
    return F.try_element_at(col_of(c), F.lit(1))


def list_last(c) -> Column:
    return F.try_element_at(col_of(c), F.lit(-1))


def list_contains(c, v) -> Column:
    return F.coalesce(F.array_contains(col_of(c), v), F.lit(False))


def list_count(c, v) -> Column:
    return F.size(F.filter(col_of(c), lambda x: x == v))


def list_slice(c, n: int) -> Column:
    return F.slice(col_of(c), 1, n)


def list_tail(c, n: int) -> Column:
    """Last n elements; the whole list when shorter (``slice`` with a negative
    start is empty for a short list)."""
    a = col_of(c)
    return F.when(F.array_size(a) > n, F.slice(a, -n, n)).otherwise(a)


def tokens_text(c) -> Column:
    """``<a>, <b>`` text of a token list."""
    return F.array_join(F.transform(col_of(c), lambda t: F.concat(F.lit("<"), t, F.lit(">"))), ", ")


# ---------------------------------------------------------------- strings
def split_first(c, sep: str = "//") -> Column:
    return F.substring_index(col_of(c), sep, 1)


def split_last(c, sep: str = "//") -> Column:
    return F.substring_index(col_of(c), sep, -1)


def rsplit_last(c, sep: str = "_") -> Column:
    return F.substring_index(col_of(c), sep, -1)


def strip_suffix_upper(c, suffix: str) -> Column:
    return F.trim(F.upper(F.regexp_replace(col_of(c), re.escape(suffix) + r"\z", "")))


def concat_cast(prefix: str, c) -> Column:
    """``prefix || cast(c as string)``; null stays null."""
    return F.concat(F.lit(prefix), col_of(c).cast("string"))


def site_label(c, labels, suffix_sep: str = "-") -> Column:
    """First listed label found in the name decides; else the last part of
    the name upper-cased."""
    s = F.lower(col_of(c))
    out = F.upper(F.substring_index(col_of(c), suffix_sep, -1))
    for lab in reversed(labels):
        out = F.when(s.contains(lab), F.lit(lab.upper())).otherwise(out)
    return out
