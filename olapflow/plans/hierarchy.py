"""Parent-child trees, level hierarchies and drill-down sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from olapflow.operators.agg import rollup_levels
from olapflow.operators.window import row_index
from olapflow.session import stored


def _cycle_error(pointer: DataFrame, span: int) -> ValueError:
    """The error that names nodes on a cycle, given the pointers that never reach a root."""
    left = pointer.count()
    while span < left:  # jumps as long as there are nodes left end on a cycle
        pointer = _doubled(pointer)
        span *= 2
    named = sorted(str(r.up) for r in pointer.select("up").distinct().limit(10).collect())
    return ValueError(f"the edges hold a cycle, among others of {', '.join(named)}")


def _doubled(pointer: DataFrame) -> DataFrame:
    onward = pointer.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("far").alias("further"))
    return stored(pointer.join(onward, "up").select("node", F.col("next").alias("up"), (F.col("far") + F.col("further")).alias("far")), "pointers")


def _pointers(links: DataFrame) -> list[DataFrame]:
    """Pointers (node, up, far) over 1, 2, 4, ... edges, until every node has met its root.

    A round moves one row per node that has ancestors so far away. In a tree some node is
    at every depth up to the deepest, so each round loses some nodes; a round that loses
    none has only nodes left that lead into a cycle.
    """
    found = [stored(links, "pointers")]
    size, parents = found[0].agg(F.count("node"), F.count_distinct("node")).first()
    tree, most = size == parents, size + 1
    while size:
        span = 1 << (len(found) - 1)
        further = _doubled(found[-1])
        after = further.count()
        if (tree and after == size) or 2 * span > most:
            if after:
                raise _cycle_error(further, 2 * span)
        found.append(further)
        size = after
    return found


def closure(edges: DataFrame, child: str, parent: str, distance: str | None = None) -> DataFrame:
    """All (ancestor, descendant, distance) pairs of a tree, each node with itself at 0.

    Every round doubles the distance covered: each node keeps one pointer to its
    ancestor 2^k levels up and takes over the pairs that ancestor already has. A tree
    of depth d needs about log2(d) rounds. The pointers are followed to their ends first,
    in rounds of one row per node at most, so that a cycle raises an error before any pair
    is made. ``distance`` names the length of each edge (1 without it). New pairs and
    pointers are written to the shared folder, so lost executors do not replay the loop.
    """
    far = F.col(distance).cast("int") if distance else F.lit(1)
    links = edges.where(F.col(parent).isNotNull() & (F.col(parent) != F.col(child)))
    pointers = _pointers(links.select(F.col(child).alias("node"), F.col(parent).alias("up"), far.alias("far")).distinct())
    nodes = edges.select(F.col(child).alias("n")).union(edges.select(F.col(parent))).where("n is not null").distinct()
    nodes = stored(nodes, "nodes")
    parts = [nodes.select(F.col("n").alias("ancestor"), F.col("n").alias("descendant"), F.lit(0).alias("distance"))]
    for pointer in pointers[:-1]:
        have = reduce(lambda a, b: a.union(b), parts)
        grown = pointer.join(have, F.col("up") == F.col("descendant")).select(
            "ancestor", F.col("node").alias("descendant"), (F.col("distance") + F.col("far")).alias("distance")
        )
        parts.append(stored(grown, "pairs"))
    return reduce(lambda a, b: a.union(b), parts)


def update_closure(tree: DataFrame, moves: DataFrame, child: str, parent: str) -> DataFrame:
    """The pairs after nodes are added or moved, each with all that is below it.

    ``moves`` has one row per node: a new node, or one to move, and its new parent (null
    makes it a root). Moved nodes may lie below each other, and new parents may be new or
    moved themselves; moving a node below itself raises the error of a cycle. Pairs that
    lead over a cut edge go; those between the ancestors of a new parent and the
    descendants of what is hung there come. Only pairs of the subtrees concerned are
    made: nothing else of the table is computed again.
    """
    asked = stored(moves.select(F.col(child).alias("m"), F.col(parent).alias("p")).distinct(), "moves")
    known = tree.where("distance = 0").select(F.col("descendant").alias("m"))
    mentioned = asked.select("m").union(asked.where("p is not null").select("p")).distinct()
    self_pairs = mentioned.join(known, "m", "left_anti").select(
        F.col("m").alias("ancestor"), F.col("m").alias("descendant"), F.lit(0).alias("distance")
    )
    # a pair is cut if a moved node lies below its ancestor and at or above its descendant
    below = tree.join(asked.select(F.col("m").alias("ancestor")), "ancestor", "left_semi")
    over = tree.where("distance > 0").join(asked.select(F.col("m").alias("descendant")), "descendant", "left_semi")
    cut = over.select("ancestor", F.col("descendant").alias("m")).join(
        below.select(F.col("ancestor").alias("m"), "descendant"), "m"
    ).select("ancestor", "descendant").distinct()
    kept = stored(tree.join(cut, ["ancestor", "descendant"], "left_anti").unionByName(self_pairs), "kept-pairs")
    # which moved subtree hangs, over how many levels, below which other moved node
    hung = asked.where("p is not null")
    above = kept.join(hung.select(F.col("p").alias("descendant"), "m"), "descendant").select(
        "ancestor", "m", (F.col("distance") + 1).alias("distance")
    )
    above = stored(above, "above-moved")
    among = above.join(asked.select(F.col("m").alias("ancestor")), "ancestor", "left_semi")
    if not among.where(F.col("ancestor") == F.col("m")).isEmpty():
        raise ValueError("the edges hold a cycle: a node is moved below itself")
    edges = asked.select("m").join(among, "m", "left")
    chains = closure(edges, "m", "ancestor", "distance")
    tops = above.select(F.col("ancestor").alias("top"), "m", F.col("distance").alias("d1"))
    tops = tops.join(asked.select(F.col("m").alias("top")), "top", "left_anti")  # chains start at what did not move
    first = tops.join(chains.select(F.col("ancestor").alias("m"), F.col("descendant").alias("n"), F.col("distance").alias("d2")), "m")
    starts = first.select("top", "n", (F.col("d1") + F.col("d2")).alias("d"))
    inner = chains.where("distance > 0").select(F.col("ancestor").alias("top"), F.col("descendant").alias("n"), F.col("distance").alias("d"))
    ends = kept.select(F.col("ancestor").alias("n"), "descendant", "distance")
    fresh = starts.unionByName(inner).join(ends, "n").select(
        F.col("top").alias("ancestor"), "descendant", (F.col("d") + F.col("distance")).alias("distance")
    )
    return kept.unionByName(fresh)


def rollup_tree(fact: DataFrame, tree: DataFrame, node: str, measures: Sequence[str]) -> DataFrame:
    """Totals per ancestor over all its descendants. Facts are summed per node first."""
    own = fact.groupBy(F.col(node).alias("descendant")).agg(*[F.sum(m).alias(m) for m in measures])
    return tree.join(own, "descendant").groupBy("ancestor").agg(*[F.sum(m).alias(m) for m in measures])


def rollup_edges(fact: DataFrame, edges: DataFrame, child: str, parent: str, node: str, measures: Sequence[str]) -> DataFrame:
    """Totals per ancestor straight from parent-child edges, without a table of pairs.

    Every node holds the totals of its descendants up to a distance and a pointer to the
    ancestor at that distance. A round adds to each node the totals of the nodes that
    point at it and doubles the pointers, so it moves one row per node. A cycle raises an
    error.
    """
    links = edges.where(F.col(parent).isNotNull() & (F.col(parent) != F.col(child)))
    pointer = stored(links.select(F.col(child).alias("node"), F.col(parent).alias("up")).distinct(), "pointers")
    sums = [F.sum(m).alias(m) for m in measures]
    held = fact.groupBy(F.col(node).alias("ancestor")).agg(*sums)
    kinds = {m: held.schema[m].dataType for m in measures}
    # only facts at nodes of the tree count
    known = edges.select(F.col(child).alias("ancestor")).union(edges.select(parent)).distinct()
    held = stored(held.join(known, "ancestor", "left_semi"), "totals")
    size = pointer.count()
    span, most = 1, size + 1
    while size:
        if span > most:
            raise ValueError("the edges hold a cycle")
        moved = pointer.join(held, F.col("node") == F.col("ancestor")).select(F.col("up").alias("ancestor"), *measures)
        held = held.unionByName(moved).groupBy("ancestor").agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])
        held = stored(held, "totals")
        onward = pointer.select(F.col("node").alias("up"), F.col("up").alias("next"))
        pointer = stored(pointer.join(onward, "up").select("node", F.col("next").alias("up")), "pointers")
        size = pointer.count()
        span *= 2
    return held


def rollup_set(fact: DataFrame, tree: DataFrame, node: str, ancestors: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One total for a set of ancestors (column ``ancestor``); shared descendants count once."""
    below = tree.join(ancestors, "ancestor", "left_semi").select(F.col("descendant").alias(node))
    return fact.join(below, node, "left_semi").agg(*[F.sum(m).alias(m) for m in measures])


def own_and_total(fact: DataFrame, tree: DataFrame, node: str, measure: str) -> DataFrame:
    """A node's own value next to the value rolled up over its subtree."""
    own = fact.groupBy(F.col(node).alias("descendant")).agg(F.sum(measure).alias("__v"))
    return tree.join(own, "descendant").groupBy("ancestor").agg(
        F.sum(F.when(F.col("distance") == 0, F.col("__v"))).alias("own"), F.sum("__v").alias("total")
    )


def descendants(
    tree: DataFrame, members: DataFrame, depth: int | None = None, self_and_before: bool = True
) -> DataFrame:
    """Descendants of the members (column ``ancestor``) down to ``depth``, or only at it."""
    out = tree.join(members, "ancestor", "left_semi")
    if depth is None:
        return out
    return out.where(F.col("distance") <= depth) if self_and_before else out.where(F.col("distance") == depth)


def ascendants(tree: DataFrame, members: DataFrame) -> DataFrame:
    """Ancestors of the members (column ``descendant``), themselves included."""
    return tree.join(members, "descendant", "left_semi")


def children(tree: DataFrame, members: DataFrame) -> DataFrame:
    return descendants(tree, members, 1, self_and_before=False)


def drill(rolled: DataFrame, levels: Sequence[str], expanded: DataFrame, base_level: int = 1) -> DataFrame:
    """Visible rows of a roll-up: all members down to ``base_level``, and below that the
    children of visible members listed in ``expanded`` (level columns, null below)."""
    levels = list(levels)
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in levels])
    opened = expanded.select(*levels).withColumn("__depth", filled)
    out = rolled
    for depth in range(base_level, len(levels)):
        path, mark = levels[:depth], f"__open{depth}"
        marks = opened.where(F.col("__depth") == depth).select(*path).distinct().withColumn(mark, F.lit(1))
        # a deeper row is visible only below a member that is open
        out = out.join(marks, path, "left").where((F.col("level_no") <= depth) | F.col(mark).isNotNull()).drop(mark)
    return out


def toggle(expanded: DataFrame, members: DataFrame) -> DataFrame:
    """Expand the collapsed and collapse the expanded: members found in one set only."""
    columns = expanded.columns
    both = expanded.distinct().unionByName(members.select(*columns).distinct())
    return both.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").drop("__n")


def _unique_name(levels: Sequence[str], depth: Column) -> Column:
    """Path down to ``depth``; a null member is written #null."""
    parts = [
        F.when(depth > i, F.concat(F.lit("["), F.coalesce(F.col(c).cast("string"), F.lit("#null")), F.lit("]")))
        for i, c in enumerate(levels)
    ]
    return F.concat_ws(".", F.lit("[All]"), *parts)


def members(dim: DataFrame, levels: Sequence[str]) -> DataFrame:
    """One row per member of a level hierarchy with its intrinsic properties.

    The level number tells a null member from a collapsed level.
    """
    levels = list(levels)
    rolled = rollup_levels(dim, levels, {"__rows": ("count", "*")})
    path = F.array(*[F.col(c).cast("string") for c in levels])
    named = rolled.withColumns(
        {
            "unique_name": _unique_name(levels, F.col("level_no")),
            "name": F.when(F.col("level_no") == 0, F.lit("All")).otherwise(
                F.coalesce(F.get(path, F.col("level_no") - 1), F.lit("#null"))
            ),
            "parent_unique_name": F.when(F.col("level_no") > 0, _unique_name(levels, F.col("level_no") - 1)),
        }
    )
    above = {f"__p{i}": F.when(F.col("level_no") - 1 > i, F.col(c)) for i, c in enumerate(levels)}
    counts = (
        named.where("level_no > 0")
        .groupBy((F.col("level_no") - 1).alias("__level"), *[v.alias(n) for n, v in above.items()])
        .agg(F.count(F.lit(1)).alias("__children"))
    )
    own = [F.col(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(levels)]
    out = named.join(counts, reduce(and_, own, F.col("level_no") == F.col("__level")), "left").withColumn(
        "child_count", F.coalesce("__children", F.lit(0))
    )
    # a collapsed level comes before its members, the null member first among them
    out = out.withColumns({f"__in{i}": F.col("level_no") > i for i in range(len(levels))})
    order = [name for i, c in enumerate(levels) for name in (f"__in{i}", c)]
    out = row_index(out, [], order, "ordinal")  # in ranges, however large a top member is
    return out.select("level_no", "level_name", "name", "unique_name", "parent_unique_name", "ordinal", "child_count")


def ragged_path(levels: Sequence[str]) -> Column:
    """Level values without the blank ones, so a child hangs below its nearest real ancestor."""
    return F.filter(F.array(*[F.col(c).cast("string") for c in levels]), lambda x: F.trim(x) != "")


def ragged_parent(levels: Sequence[str]) -> Column:
    """Nearest non-blank ancestor of the deepest member."""
    path = ragged_path(levels)
    return F.when(F.size(path) > 1, F.element_at(path, -2))
