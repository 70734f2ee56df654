"""Score formulas as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The weights of the two aims.
COMPREHENSION = {"zipf_need": 0.40, "aoa_component": 0.20, "fr_opacity": 0.15, "sense_surprise": 0.15, "book_gain": 0.10}
REUSE = {"zipf_need": 0.45, "aoa_component": 0.20, "fr_opacity": 0.15, "reuse": 0.20}
#: Opacity of expressions by label, and their need.
EXPRESSION_OPACITY = {"idiome": 0.9, "phrasal_verb": 0.7, "semi_fige": 0.5}
EXPRESSION_NEED = 0.6
#: Fixed value: expressions less sure than this are looked at again.
EXPRESSION_REVIEW_BELOW = 0.6


def clip01(c: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def zipf(count: Column, total: Column) -> Column:
    """Common logarithm of the occurrences in a billion words."""
    return F.log10(count / total * 1e9)


def zipf_need(z: Column) -> Column:
    return F.coalesce(clip01((6 - z) / 4), F.lit(0.5))


def aoa_residual(aoa: Column, z: Column) -> Column:
    """Age of acquisition beyond what the frequency lets expect."""
    return aoa - (12 - 1.1 * z)


def aoa_component(residual: Column, sign: int = -1) -> Column:
    return F.coalesce(clip01(0.5 + sign * residual / 8), F.lit(0.5))


def sense_surprise(count: Column, total: Column) -> Column:
    return F.when(F.coalesce(total, F.lit(0)) == 0, 0.5).otherwise(clip01(1 - F.coalesce(count, F.lit(0)) / total))


def book_gain(n: Column) -> Column:
    return clip01(F.log1p(n.cast("double")) / F.log1p(F.lit(20.0)))


def weighted(parts: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, weight in parts.items():
        total = total + weight * F.col(name)
    return total


def coarse_priority(z: Column, book_count: Column) -> Column:
    return F.coalesce((6 - z) / 4, F.lit(0.5)) + 0.05 * F.least(book_count, F.lit(5))


def per_million(count: Column, total: Column) -> Column:
    return F.try_divide(count * 1e6, total)


def level(z: Column) -> Column:
    """A level by frequency band, where no graded list is at hand."""
    return (
        F.when(z >= 6, "A1").when(z >= 5.5, "A2").when(z >= 5, "B1").when(z >= 4.5, "B2").when(z >= 4, "C1").otherwise("C2")
    )
