"""Quartile scores and the customer label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label by total score, best customers first.
RFM_LABELS = (
    (3, "Champions"),
    (4, "Loyal Customers"),
    (5, "Potential Loyalist"),
    (6, "Promising"),
    (7, "About To Sleep"),
    (8, "Can’t Lose Them"),
    (9, "Hibernating"),
    (10, "Lost"),
)


def quartile_score(value: Column, cuts: Column, *, low_is_best: bool) -> Column:
    """1..4 by the three ascending cut points in ``cuts`` (an array column).

    A value equal to a cut belongs to the lower band. With ``low_is_best`` the lowest
    band scores 1, otherwise it scores 4.
    """
    bands = (1, 2, 3, 4) if low_is_best else (4, 3, 2, 1)
    score = F.when(value <= F.get(cuts, F.lit(0)), bands[0])
    for i in (1, 2):
        score = score.when(value <= F.get(cuts, F.lit(i)), bands[i])
    return score.otherwise(bands[3])


def rfm_label(score: Column) -> Column:
    """Customer label for a total score; below 4 champions, from 10 on lost."""
    (_, best), *middle, (lost_from, lost) = RFM_LABELS
    label = F.when(score >= lost_from, lost)
    for points, name in middle:
        label = label.when(score == points, name)
    return label.otherwise(best)
