"""Randomness as a function of (seed, row id).

``rand(seed)`` depends on how rows fall into partitions; an md5 of seed and id
does not, so a lost executor or another shuffle width cannot change a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 2.0**32


def _as_column(part) -> Column:
    return part if isinstance(part, Column) else F.col(part)


def seeded_hash(seed, *parts) -> Column:
    """Hex md5 of ``seed|part|part...``; a part is a column or its name."""
    return F.md5(
        F.concat_ws("|", F.lit(str(seed)), *[_as_column(p).cast("string") for p in parts])
    )


def uniform(seed, *parts) -> Column:
    """Uniform in the open interval (0, 1), safe under a logarithm."""
    head = F.conv(F.substring(seeded_hash(seed, *parts), 1, 8), 16, 10).cast("bigint")
    return (head + F.lit(0.5)) / F.lit(_RANGE)


def reaches(bound: float, seed, *parts) -> Column:
    """``uniform(seed, *parts) >= bound``, by the digits of the hash as they are: hex
    numbers of one length stand in the order of their text."""
    least = math.ceil(max(bound, 0.0) * _RANGE - 0.5) if bound < 1 else _RANGE
    # No digits are enough for a bound that no draw reaches; "g" is above them all.
    return seeded_hash(seed, *parts) >= F.lit(f"{least:08x}" if least < _RANGE else "g")


def pick(seed, n, *parts) -> Column:
    """Uniform integer in [0, n); ``n`` is an int or a column."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.floor(uniform(seed, *parts) * n).cast("int")


def standard_normal(seed, *parts) -> Column:
    """Standard normal deviate by Box-Muller from two independent uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(f"{seed}|r", *parts)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(f"{seed}|a", *parts))
