"""Character spans: half-open intervals of code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Intersection over union of two spans, by arithmetic on their ends; 0 if both are empty."""
    shared = F.greatest(F.least(end_a, end_b) - F.greatest(start_a, start_b), F.lit(0))
    total = F.greatest(end_a - start_a, F.lit(0)) + F.greatest(end_b - start_b, F.lit(0)) - shared
    return F.coalesce(F.try_divide(shared.cast("double"), total.cast("double")), F.lit(0.0))
