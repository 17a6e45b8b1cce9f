"""Set operations on rows and members."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from olapflow.operators.agg import concat_string
from olapflow.operators.join import cross


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def except_members(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose keys do not occur in ``b``."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def intersect_members(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both."""
    return a.intersect(b)


def generate(members: DataFrame, expand: Callable[[DataFrame], DataFrame], keep_all: bool = False) -> DataFrame:
    """Union of a set derived from each member; ``keep_all`` keeps repeats.

    ``expand`` is applied to all members at once (usually a join), not in a loop.
    """
    out = expand(members)
    return out if keep_all else out.distinct()


def generate_text(df: DataFrame, parent: Sequence[str], child: str, sep: str = "-") -> DataFrame:
    """Distinct child captions of each parent, joined in order."""
    members = df.select(*parent, child).distinct()
    return concat_string(members, parent, child, sep, [child], F.substring(child, 1, 2), "members")


def member_range(df: DataFrame, level: str, first, last) -> DataFrame:
    """Members from ``first`` to ``last`` in level order, both included."""
    return df.where(F.col(level).between(first, last))


def cross_members(
    a: DataFrame, b: DataFrame, cells: DataFrame | None = None, on: Sequence[str] = (), non_empty: bool = False
) -> DataFrame:
    """All tuples of two member sets, with their cell values when given.

    ``non_empty`` keeps the tuples that have a cell; those come from the cells by semi
    joins, so the product is never formed.
    """
    if cells is None:
        return cross(a, b)
    if non_empty:
        out = cells.join(a, a.columns, "left_semi")
        return out.join(b, b.columns, "left_semi")
    return cross(a, b).join(cells, list(on), "left")
