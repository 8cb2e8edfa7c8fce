"""Column functions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def matches(search: dict) -> Column:
    """All columns equal their values; None asks for null."""
    return all_of(F.col(k).isNull() if v is None else F.col(k) == F.lit(v) for k, v in search.items())


def truncated(c) -> Column:
    """Toward zero."""
    return col(c).cast("int")


def distance(a: dict, b: dict) -> Column:
    """Euclidean distance of two points given by name -> column."""
    return F.sqrt(sum((F.pow(a[k] - b[k], 2) for k in a), F.lit(0.0)))


def divided(a: Column, b: Column, empty=0.0) -> Column:
    """a / b, or ``empty`` where b is zero or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


# --- decisions on detector scores; each gives a Column, to be used like any other -----------


def decide_simple(mean, c: float = 1.5) -> Column:
    """By the mean alone: -2 up to -c, 0 up to c, else 2."""
    m = col(mean)
    return F.when(m <= -c, -2).when(m <= c, 0).otherwise(2)


def decide_margin(mean, std) -> Column:
    """By mean and spread: negative mean -2; mean within one spread of zero 0; clear of it 2; else null."""
    m, s = col(mean), col(std)
    return F.when(m < 0, -2).when((m > 0) & (m - s < 0), 0).when(m - s > 0, 2)


#: Corner points (mean, spread), fixed values: bottom, right, top and left of the diamond of unsure
#: detections, then the far ends of the lines that leave its left and right corners.
CORNERS_A = ((0, 3), (3, 4.5), (1, 6), (-3, 4), (-10, 7), (10, 7))
CORNERS_B = ((0, 0.8), (2, 2.5), (0, 3.3), (-2, 2.5), (-10, 4), (10, 4))


def decide_lines(mean, std, corners=CORNERS_A) -> Column:
    """By six lines: inside the diamond 0; outside, the sides of the outer lines give -2 or 2; else null."""
    m, s = col(mean), col(std)
    bottom, right, top, left, far_left, far_right = corners

    def above(p, q) -> Column:
        return s > p[1] + (m - p[0]) * ((q[1] - p[1]) / (q[0] - p[0]))

    inside = above(bottom, right) & ~above(right, top) & ~above(top, left) & above(left, bottom)
    above_left, above_right = above(left, far_left), above(right, far_right)
    return (
        F.when(inside, 0)
        .when(((m < 0) & ~above_left) | ((m > 0) & above_right), -2)
        .when(((m > 0) & ~above_right) | ((m < 0) & above_left), 2)
    )


# --- group predicates ---------------------------------------------------------------------


def group_matches(labels, include=(), exclude=(), least: int = 0, most: int | None = None) -> Column:
    """Labels have all of ``include``, none of ``exclude`` and a size between the bounds."""
    c, test = col(labels), F.lit(True)
    if include:
        test = test & (F.size(F.array_except(F.array(*map(F.lit, include)), c)) == 0)
    if exclude:
        test = test & ~F.arrays_overlap(c, F.array(*map(F.lit, exclude)))
    test = test & (F.size(c) >= least)
    return test if most is None else test & (F.size(c) <= most)


# The named groups of quality control, as labels to include, labels to exclude, least and most members.
QC_CATEGORIES = {
    "Computer Detected, Human Missed": (["computer_sure"], [], 0, 1),
    "total train": (["manual_train"], [], 0, None),
    "Human mind change": (["manual_negative", "manual_train"], [], 0, None),
    "original training set after mind change": (["manual_train"], ["manual_negative"], 0, None),
    "computer missed, human detected": (["manual_positive"], ["computer_sure", "computer_unsure"], 0, 1),
    "computer sure, human negative": (["computer_sure", "manual_negative"], [], 0, 2),
    "computer  UNsure, human negative": (["computer_unsure", "manual_negative"], [], 0, 2),
    "computer UNsure, human positive": (["computer_unsure", "manual_positive"], [], 0, 2),
    "Total computer UNsure": (["computer_unsure"], [], 0, 2),
    "computer UNsure, human unmarked": (["computer_unsure"], [], 0, 1),
    "computer sure, human unmarked": (["computer_sure"], [], 0, 1),
    "More than 2 labels": ([], ["manual_train"], 3, None),
}


def qc_categories(labels) -> Column:
    """The names of the quality-control groups that a group's labels belong to."""
    flags = [F.when(group_matches(labels, include, exclude, least, most), F.lit(name)) for name, (include, exclude, least, most) in QC_CATEGORIES.items()]
    return F.array_compact(F.array(*flags))
