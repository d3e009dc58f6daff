"""Column expressions shared by the operators. All are built-in Spark functions (JVM-side,
inside whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text labels of the cluster description (activity, rating profile, joiner).
ACTIVITY_LABELS = ("Usuario muy activo", "Usuario activo", "Usuario ocasional o moderado")
RATING_LABELS = ("muy positivo", "mas critico", "intermedio")
DESCRIPTION_JOINER = " con perfil de calificacion "
# Title preview suffix and the "+n more" remainder text of the preview list.
ELLIPSIS = "..."
MORE_SUFFIX = " más"

# Split hash constants (multipliers and modulus) of the deterministic 80/20 split.
SPLIT_USER_MULT = 2654435761
SPLIT_ITEM_MULT = 40503
SPLIT_MODULUS = 1000003


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recommendation_score(avg_rating: str | Column, rating_count: str | Column) -> Column:
    """Cluster popularity score: mean rating times natural log of (1 + number of ratings)."""
    return col(avg_rating) * F.log1p(col(rating_count))


def split_bucket(user: str | Column, item: str | Column, ts: str | Column,
                 buckets: int = 10) -> Column:
    """Bucket in ``[0, buckets)`` of ``((user*A + item*B + ts) mod P) mod buckets``.

    Each term is reduced to ``[0, P)`` before multiplying, so no intermediate exceeds ~2e12
    and negative ids fall into the same buckets as their residues, never below zero.
    """
    p = F.lit(SPLIT_MODULUS)
    a = F.lit(SPLIT_USER_MULT % SPLIT_MODULUS)
    b = F.lit(SPLIT_ITEM_MULT % SPLIT_MODULUS)
    total = (F.pmod(col(user), p) * a + F.pmod(col(item), p) * b
             + F.pmod(F.coalesce(col(ts), F.lit(0)), p))
    return (total % p) % F.lit(buckets)


def epoch_seconds_ntz(ts: str | Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock timestamp, independent of the session time
    zone (``unix_seconds`` rejects TIMESTAMP_NTZ)."""
    c = col(ts).cast("timestamp_ntz")
    return (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86400)
            + F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60) + F.second(c).cast("bigint"))


def threshold_bucket(value: str | Column, thresholds: Sequence[float]) -> Column:
    """Number of thresholds strictly below ``value``: 0..len(thresholds)."""
    out = F.lit(0).cast("bigint")
    for t in thresholds:
        out = out + F.when(col(value) > F.lit(t), 1).otherwise(0)
    return out


def activity_label(avg_movies: str | Column, activity: tuple[float, float] = (100, 300)) -> Column:
    active, very_active = activity
    return (F.when(col(avg_movies) > very_active, ACTIVITY_LABELS[0])
            .when(col(avg_movies) > active, ACTIVITY_LABELS[1])
            .otherwise(ACTIVITY_LABELS[2]))


def rating_label(avg_rating: str | Column, rating: tuple[float, float] = (3.2, 4.0)) -> Column:
    critical, positive = rating
    return (F.when(col(avg_rating) >= positive, RATING_LABELS[0])
            .when(col(avg_rating) < critical, RATING_LABELS[1])
            .otherwise(RATING_LABELS[2]))


def describe(activity: Column, profile: Column) -> Column:
    return F.concat(activity, F.lit(DESCRIPTION_JOINER), profile)


def shorten(text: str | Column, width: int = 30) -> Column:
    """First ``width`` characters, plus an ellipsis when the text was longer."""
    c = col(text)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit(ELLIPSIS))).otherwise(c)


def squared_distance(values: Sequence[Column], center: Sequence[float]) -> Column:
    terms = [(v - F.lit(float(c))) * (v - F.lit(float(c))) for v, c in zip(values, center)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def argmin(exprs: Sequence[Column]) -> Column:
    """Index of the smallest expression, the first one on ties (as K-Means assignment)."""
    smallest = F.least(*exprs) if len(exprs) > 1 else exprs[0]
    out = None
    for i in range(len(exprs) - 1, -1, -1):
        out = F.when(exprs[i] == smallest, F.lit(i).cast("bigint")) if out is None else \
            F.when(exprs[i] == smallest, F.lit(i).cast("bigint")).otherwise(out)
    return out
