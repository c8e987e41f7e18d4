"""Price ranges and discount bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Left-closed price ranges; the last one is open-ended but excludes +Infinity.
PRICE_EDGES = [0.0, 50.0, 100.0, 200.0, 500.0, float("inf")]
PRICE_LABELS = ["<50", "50-100", "100-200", "200-500", "500+"]

# Discount histogram over [0, 100) in steps of 5.
BIN_WIDTH = 5
BIN_LIMIT = 100


def bucket_ord(price: Column) -> Column:
    """Position of the price range (0-based INT), NULL when negative, infinite or missing."""
    found = F.lit(None).cast("int")
    for i in reversed(range(len(PRICE_LABELS))):
        found = F.when((price >= PRICE_EDGES[i]) & (price < PRICE_EDGES[i + 1]), F.lit(i)).otherwise(found)
    return found


def bucket_label(ord_: Column) -> Column:
    """Label of a position given by :func:`bucket_ord`; NULL stays NULL."""
    return F.get(F.array(*[F.lit(x) for x in PRICE_LABELS]), ord_)


def discount_bin(discount: Column) -> Column:
    """Lower edge (INT) of the histogram bin; NULL outside [0, 100)."""
    return F.when(
        (discount >= 0) & (discount < BIN_LIMIT), (F.floor(discount / BIN_WIDTH) * BIN_WIDTH).cast("int")
    )
