"""Column expressions that bring identifiers of many writers to one form. All run inside whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a blank at the ends of a value: white space, no-break and typographic spaces, zero width space, byte order mark.
BLANKS = " \t\n\r\x0b\x0c\u0085\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u202f\u205f\u3000\ufeff"


def trimmed(c: Column) -> Column:
    """Without blanks of any kind at either end."""
    return F.btrim(c, F.lit(BLANKS))


def word(c: Column) -> Column:
    """Lower case without outer blanks; null for null and for blank values."""
    return F.nullif(F.lower(trimmed(c)), F.lit(""))


def digest(c: Column) -> Column:
    """64 lower-case hex digits, or null where the value is no digest.

    Case, outer blanks and an algorithm prefix before a colon carry no meaning.
    """
    clean = F.lower(trimmed(F.substring_index(c, ":", -1)))
    return F.when(clean.rlike("^[0-9a-f]{64}$"), clean)


def code(c: Column, digits: int, pad: bool = False) -> Column:
    """A perceptual code as ``digits`` lower-case hex digits, or null where it is unusable.

    Unusable: null, other signs than hex digits, too long, too short (unless ``pad`` fills leading zeros), and
    featureless codes whose bits are all 0 or all 1.
    """
    clean = F.lower(trimmed(c))
    clean = F.when(clean.startswith("0x"), F.substring(clean, 3, 1_000_000)).otherwise(clean)
    shape = f"^[0-9a-f]{{1,{digits}}}$" if pad else f"^[0-9a-f]{{{digits}}}$"
    full = F.lpad(clean, digits, "0") if pad else clean
    return F.when(clean.rlike(shape) & ~full.isin("0" * digits, "f" * digits), full)


def hamming(a: Column, b: Column, digits: int) -> Column:
    """Number of different bits of two hex codes of equal length; 13 digits (52 bits) at a time."""
    total = F.lit(0)
    for at in range(0, digits, 13):
        n = min(13, digits - at)
        x, y = (F.conv(F.substring(c, at + 1, n), 16, 10).cast("bigint") for c in (a, b))
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total
