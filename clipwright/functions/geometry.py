"""Boxes as four columns or as structs (x1, y1, x2, y2)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Added to every union before dividing.
EPSILON = 1e-6


def area(b) -> Column:
    """Sides below zero count as zero."""
    return F.greatest(F.lit(0.0), b["x2"] - b["x1"]) * F.greatest(F.lit(0.0), b["y2"] - b["y1"])


def signed_area(b) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def overlap(a, b) -> Column:
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)


def iou(a, b) -> Column:
    both = overlap(a, b)
    return both / (area(a) + area(b) - both + EPSILON)


def suppression_iou(a, b) -> Column:
    """As iou, with areas that may be negative."""
    both = overlap(a, b)
    return both / (signed_area(a) + signed_area(b) - both + EPSILON)


def columns(prefix: str = "") -> dict[str, Column]:
    return {k: F.col(prefix + k) for k in ("x1", "y1", "x2", "y2")}
