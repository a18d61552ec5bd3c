"""The string polynomial hash behind the bitmap unique-visitor count.

h = h * seed + code(char) over the string, keeping the low ``bits`` bits.
Masking after every step gives the same low bits as masking once at the end
(arithmetic modulo 2^bits) and can never overflow a LONG under ANSI mode.
Characters are taken by code point; ids here are ASCII digits (D12), for
which code point and UTF-16 unit agree.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's for the same offsets:
# seed 61 and a 2^29-bit bitmap.
DEFAULT_SEED = 61
DEFAULT_BITS = 29


def poly_hash(s: Column | str, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> Column:
    """Column expression for the masked polynomial hash of a string column."""
    col = F.col(s) if isinstance(s, str) else s
    mask = (1 << bits) - 1
    codes = F.transform(F.split(col, ""), lambda ch: F.ascii(ch).cast("long"))
    # split('', '') yields [''], whose ascii is 0 -> hash 0, as for the empty string.
    return F.aggregate(
        codes, F.lit(0).cast("long"),
        lambda acc, c: (acc * F.lit(seed) + c).bitwiseAND(F.lit(mask)),
    )
