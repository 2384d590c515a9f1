"""Labelled bins."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed bin edges and their labels.
SEASON_EDGES = (0, 3, 6, 9, 12)
SEASON_LABELS = ("Winter", "Spring", "Summer", "Fall")
WIND_EDGES = (0, 2, 5, 8, 11, float("inf"))
WIND_LABELS = ("Calm", "Light", "Moderate", "Fresh", "Strong")


def cut(
    col: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = False,
) -> Column:
    """Label of the bin holding `col`; null outside all bins and for null input.

    `right=True` closes bins on the right, `(a, b]`; `include_lowest` also admits the first edge.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("cut needs one label per bin")
    above = (lambda edge: col > edge) if right else (lambda edge: col >= edge)
    below = (lambda edge: col <= edge) if right else (lambda edge: col < edge)
    inside = above(F.lit(edges[0]))
    if include_lowest:
        inside = inside | (col == F.lit(edges[0] if right else edges[-1]))
    chain = None
    for edge, label in zip(edges[1:-1], labels):
        chain = (F if chain is None else chain).when(below(F.lit(edge)), F.lit(label))
    last = F.lit(labels[-1])
    chain = last if chain is None else chain.otherwise(last)
    top = below(F.lit(edges[-1]))
    if include_lowest and not right:
        top = top | (col == F.lit(edges[-1]))
    return F.when(inside & top, chain)


def season(ts: Column) -> Column:
    """Quarter of the year under its season label."""
    return cut(F.month(ts), SEASON_EDGES, SEASON_LABELS, include_lowest=True)


def wind_category(speed: Column) -> Column:
    return cut(speed, WIND_EDGES, WIND_LABELS)
