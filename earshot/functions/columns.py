"""Column expressions; all of them stay in the JVM."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F

# Display texts for missing names, width of a text, decimals of a distance and of an average.
UNKNOWN_TITLE = "Desconocida"
UNKNOWN_ARTIST = "Desconocido"
UNKNOWN_USERNAME = "N/A"
DISPLAY_WIDTH = 33
DISTANCE_DIGITS = 4
AVERAGE_DIGITS = 2


def log_rating(plays: str = "play_count") -> Column:
    """Damped play count."""
    return F.log1p(F.col(plays))


def display_text(value: Column, fallback: str, width: int = DISPLAY_WIDTH) -> Column:
    """At most ``width`` characters; the fallback for NULL and empty text."""
    return F.substring(F.coalesce(F.nullif(value, F.lit("")), F.lit(fallback)), 1, width)


def rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def pair_bucket(*keys: str, buckets: int = 10) -> Column:
    """A bucket number that depends on the key values alone, so other engines can repeat it."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % buckets).cast("int")


def ml_vector(features: str) -> Column:
    """``array<float>`` to an ML vector without a Python round trip."""
    return array_to_vector(F.col(features).cast("array<double>"))


def gain(position: Column) -> Column:
    """Gain of a hit at the 0-based position."""
    return F.lit(1.0) / F.log(position + F.lit(2))


def ideal_gain(n: Column, k: int) -> Column:
    """Largest possible sum of gains for ``n`` true items in a list of ``k``."""
    sums, total = [], 0.0
    for i in range(k):
        total += 1.0 / math.log(i + 2)
        sums.append(total)
    return F.element_at(F.array(*[F.lit(s) for s in sums]), F.least(n, F.lit(k)).cast("int"))
