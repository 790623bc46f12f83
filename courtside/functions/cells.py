"""Box-score cell rules: positional cells, guarded casts, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(cells: Column | str, pos: int) -> Column:
    """Cell at 0-based ``pos``, stripped (C19); null when the row is short."""
    return F.trim(F.get(_col(cells), pos))


def has_cells(cells: Column | str, more_than: int) -> Column:
    """Arity guard ``len(cells) > n``."""
    return F.size(_col(cells)) > more_than


def guarded_int(text: Column | str) -> Column:
    """Integer parse that yields null instead of failing."""
    t = F.trim(_col(text))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))


def strict_int(text: Column | str) -> Column:
    """Integer parse that fails the query on bad input under ANSI mode (C17)."""
    return F.trim(_col(text)).cast("int")


def percent_value(text: Column | str) -> Column:
    """``'86.7%'`` -> 86.7; blank or unparsable -> null."""
    t = F.trim(F.regexp_replace(F.trim(_col(text)), r"^%+|%+$", ""))
    return F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), t.try_cast("double"))


def half_even(x: Column | str, digits: int) -> Column:
    """``round(x, n)`` of the binary value, exact ties to even, as Python rounds (C20).

    ``x * 10**n`` is rounded by the multiplication, so 2.675 would look like a
    tie; the exact remainder of the product (split multiplication) tells on
    which side of the half the value lies.  Exact while ``x * 10**n`` is below
    2**52; larger values have no such digits left and stay as they are.
    """
    v, scale = _col(x).cast("double"), float(10 ** digits)
    high = v * 134217729.0 - (v * 134217729.0 - v)  # the upper 26 bits
    product = v * scale
    rest = (high * scale - product) + (v - high) * scale
    low = F.floor(product).cast("double")
    part = product - low
    up = (part > 0.5) | ((part == 0.5) & ((rest > 0) | ((rest == 0) & (low % 2 != 0))))
    return F.when(F.abs(product) < 2.0 ** 52, (low + F.when(up, 1.0).otherwise(0.0)) / scale).otherwise(v)


def fixed(x: Column | str, digits: int) -> Column:
    """Fixed-point text, ``'%.2f'``, rounded as ``half_even``."""
    return F.format_string(f"%.{digits}f", half_even(x, digits))


def season_label(year: Column | str) -> Column:
    """``2024`` -> ``'2024-25'``."""
    y = _col(year)
    return F.concat(y.cast("string"), F.lit("-"),
                    F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def score_label(team1: Column | str, pts1: Column | str,
                team2: Column | str, pts2: Column | str) -> Column:
    """``'A 114 - B 106'``."""
    return F.format_string("%s %d - %s %d", _col(team1), _col(pts1),
                           _col(team2), _col(pts2))


def winner(team1: Column | str, pts1: Column | str,
           team2: Column | str, pts2: Column | str) -> Column:
    """Strictly more points wins; a tie goes to the second team."""
    return F.when(_col(pts1) > _col(pts2), _col(team1)).otherwise(_col(team2))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
