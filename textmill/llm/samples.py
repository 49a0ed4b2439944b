"""Bounded training samples in which every drawn text takes part."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOWS = 8  # of a text that is longer than its share


def fair_length(sizes: Iterable[int], budget: int) -> int:
    """The largest length to which texts can be held so that together they
    have at most ``budget`` characters (at least one each); shorter texts
    leave the rest of their share to longer ones."""
    sizes = sorted(sizes)
    for i, n in enumerate(sizes):
        share = budget // (len(sizes) - i)
        if n > share:
            return max(1, share)
        budget -= n
    return max(sizes, default=1) or 1


def held_to(text: Column, most: Column) -> Column:
    """Texts of up to ``most`` characters whole, of longer ones windows spread
    from the first to the last character."""
    n, most = F.length(text), most.cast("int")
    width = F.greatest(F.lit(1), F.floor(most / WINDOWS).cast("int") - 1)
    at = [F.floor((n - width) * (i / (WINDOWS - 1))).cast("int") + 1 for i in range(WINDOWS)]
    return F.when(n <= most, text).otherwise(F.concat_ws("\n", *[F.substr(text, i, width) for i in at]))
