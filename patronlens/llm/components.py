"""Connected components and the search for links inside cells of possibly linked nodes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlens.session import materialise

#: Nodes of a chunk of a cell. A group that is compared at once has two chunks.
CHUNK = 1024
#: What a group of a cell says of its pairs.
PAIRS = "cell bigint, i int, j int, a bigint, b bigint"


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with a link: label is the smallest node that links lead to.

    Each round takes the smallest label among neighbours and then the label of that label, and is written, until no
    label changes. Sums and minima are formed map-side, so a node with very many links is no burden to one task.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = materialise(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).filter("x <> y").distinct())
    labels = materialise(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        low = both.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("low"))
        nearer = labels.join(low, "node").select("node", "label", F.least("label", "low").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("jumped"))
        after = materialise(nearer.join(jump, "next", "left").select("node", F.least("next", F.coalesce("jumped", "next")).alias("new"), "label"))
        if after.filter("new <> label").isEmpty():
            return labels
        labels = after.select("node", F.col("new").alias("label"))


def shared_cells(rows: DataFrame) -> DataFrame:
    """(cell, node, leader) of the cells with two nodes or more; leader is the cell's smallest node.

    One sorted pass that holds one row, so a cell may have any number of rows. Repeated rows count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held_cell, held_node = none, none  # the last row seen, of length 0 or 1
        leader, told = 0, True  # leader of the open cell, and whether it has been emitted
        for batch in batches:
            cell = np.concatenate([held_cell, batch.column(0).to_numpy()])
            node = np.concatenate([held_node, batch.column(1).to_numpy()])
            fresh = np.append(len(held_cell) == 0, (cell[1:] != cell[:-1]) | (node[1:] != node[:-1]))
            old = len(held_cell)
            fresh[:old] = True
            cell, node = cell[fresh], node[fresh]
            if not len(cell):
                continue
            starts = np.append(not old, cell[1:] != cell[:-1])
            begin = np.maximum.accumulate(np.where(starts, np.arange(len(cell)), 0))
            leaders = node[begin]
            open_run = begin == 0 if old else np.zeros(len(cell), bool)
            if old:
                leaders = np.where(open_run & (cell == cell[0]), leader, leaders)
            follows = ~starts
            if old:
                follows[0] = False
            # a leader goes out once its cell has a second node
            lead = np.append(follows[1:], False) & starts
            out = np.flatnonzero(follows | lead)
            cells, nodes, heads = cell[out], node[out], leaders[out]
            if old and not told and len(cell) > 1 and follows[1]:
                cells, nodes, heads = np.append(cells, cell[0]), np.append(nodes, leader), np.append(heads, leader)
            last = begin[-1]
            if old and last == 0:
                told = told or len(cell) > 1
            else:
                leader, told = int(node[last]), bool(last < len(cell) - 1)
            held_cell, held_node = cell[-1:], node[-1:]
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(nodes), pa.array(heads)], names=["cell", "node", "leader"])

    return rows.select("cell", "node").repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "cell bigint, node bigint, leader bigint")


def least_crowded(cells: DataFrame, allowance: DataFrame | None) -> DataFrame:
    """The cells (cell, node, leader) that have to be looked at, with n, the nodes of the cell.

    allowance (node, part, spare): linked nodes share more cells of a part than either may spare, so each node leaves its
    ``spare`` most crowded cells of a part out; a cell's part is its last byte. All nodes order cells alike (crowded first,
    then by cell), so the last of two nodes' shared cells is left out by neither, and no link is lost.
    """
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    sized = cells.join(sizes, "cell")
    if allowance is None:
        return sized
    order = W.partitionBy("node", "part").orderBy(F.col("n").desc(), "cell")  # as many rows as a node has cells
    placed = sized.withColumn("part", F.expr("CAST(cell & 255 AS INT)")).withColumn("place", F.row_number().over(order))
    kept = placed.join(allowance, ["node", "part"]).filter("place > spare").select("cell", "node")
    # what is left of a cell has a leader of its own
    leaders = kept.groupBy("cell").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    return kept.join(leaders, "cell")


def links_in_cells(
    rows: DataFrame,
    describe: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame, DataFrame], DataFrame],
    pairs: Callable[[DataFrame, DataFrame, bool], DataFrame],
    allowance: DataFrame | None = None,
) -> DataFrame:
    """Links (a, b) that connect what the cells' true links connect.

    rows (cell, node): two nodes that are linked meet in a cell. ``describe`` gives what is to be compared for the nodes that
    share a cell which has to be looked at; ``verify`` keeps the linked ones of pairs (a, b), given that; ``pairs`` gives the pairs (cell, i, j, a, b) worth
    a trial in groups (cell, i, j) of nodes with label and chunk: those of different labels and, where i < j, of different chunks.
    With ``forest`` it gives only as many of them as connect what all of them connect.
    ``allowance`` of the nodes: see ``least_crowded``.

    First each node is tried with one node, the leader (smallest node) of most of its cells; then with the leaders that
    this has not connected it with. Where a cell still holds nodes of several components, pairs between
    different components are tried in groups of about 2 * CHUNK nodes at most: first a forest of those worth a trial, then, in
    the cells where not all of them were links, all that is not connected by then. Pairs within a component are not needed: they
    connect nothing new. So a large group of copies costs about one trial a copy, not all pairs.
    """
    shared = materialise(shared_cells(rows))
    cells = materialise(least_crowded(shared, allowance))
    described = describe(cells.select("node").distinct())
    led = materialise(cells.filter("node <> leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("n")))
    best = led.groupBy("b").agg(F.max(F.struct("n", "a")).alias("best")).select("best.a", "b")
    first = materialise(verify(best, described).select("a", "b"))
    labels = components(first)
    ends = [labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab"]
    apart = led.select("a", "b").join(best, ["a", "b"], "left_anti").join(ends[0], "a", "left").join(ends[1], "b", "left")
    apart = apart.filter("coalesce(label_a, a) <> coalesce(label_b, b)").select("a", "b")
    found = first.unionByName(materialise(verify(apart, described).select("a", "b")))
    labels = components(found)
    # the leader has been tried with all; the nodes that it is linked to are one component
    mixed = materialise(_mixed(cells.filter("node <> leader").select("cell", "node"), labels))
    dealt = _dealt(mixed)
    forest = materialise(pairs(dealt, described, True))
    found = found.unionByName(materialise(verify(forest.select("a", "b").distinct(), described).select("a", "b")))
    labels = materialise(components(found))
    ends = [labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab"]
    # where the whole forest is connected now, so is all that it stands for
    still = forest.join(ends[0], "a", "left").join(ends[1], "b", "left").filter("coalesce(label_a, a) <> coalesce(label_b, b)").select("cell").distinct()
    again = _dealt(materialise(_mixed(mixed.select("cell", "node").join(still, "cell"), labels)))
    last = pairs(again, described, False).select("a", "b").distinct().join(forest.select("a", "b").distinct(), ["a", "b"], "left_anti")
    return found.unionByName(materialise(verify(last, described).select("a", "b")))


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(cell, node, label, n) of the cells whose nodes are of several components."""
    labelled = rows.join(labels, "node", "left").select("cell", "node", F.coalesce("label", "node").alias("label"))
    kept = labelled.groupBy("cell").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return labelled.join(kept.select("cell", "n"), "cell")


def _dealt(rows: DataFrame) -> DataFrame:
    """(cell, node, label, i, j, chunk): cells in groups of two chunks of about CHUNK nodes, or of one.

    In a cell of more than CHUNK nodes the largest component has chunks of its own, after those of the rest, and no two of them
    meet: a large component costs the rest's chunks times its nodes, not its square.
    """
    sizes = rows.groupBy("cell", "label").agg(F.count("*").alias("m"), F.first("n").alias("n"))
    large = sizes.filter(F.col("n") > CHUNK).groupBy("cell").agg(F.max(F.struct("m", "label")).alias("large")).select("cell", "large.*")
    parts = rows.join(large.withColumnRenamed("label", "largest"), "cell", "left").withColumn("own", F.expr("coalesce(label = largest, false)"))
    parts = parts.withColumn("rest", F.expr(f"CAST(ceil((n - coalesce(m, 0)) / {CHUNK}) AS INT)")).withColumn("chunks", F.expr(f"rest + CAST(ceil(coalesce(m, 0) / {CHUNK}) AS INT)"))
    placed = parts.withColumn("chunk", F.expr("CAST(IF(own, rest + pmod(xxhash64(node), chunks - rest), pmod(xxhash64(node), rest)) AS INT)"))
    each = placed.select("cell", "node", "label", "chunk", F.explode(F.expr("sequence(0, IF(own, rest, chunks) - 1)")).alias("other"))
    return each.select("cell", "node", "label", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk")


def forest_of(x: np.ndarray, y: np.ndarray, label: np.ndarray, start: int = 0, tree: dict[int, int] | None = None) -> np.ndarray:
    """Numbers of the pairs (x, y) that join two trees as they come; nodes of one label are one tree from the start.

    ``label`` has the nodes from ``start`` on. ``tree`` carries the trees from call to call.
    """
    tree = {} if tree is None else tree

    def root(of: int) -> int:
        while of in tree:
            of = tree[of]
        return of

    taken = []
    for k, (a, b) in enumerate(zip(label[x - start].tolist(), label[y - start].tolist())):
        a, b = root(a), root(b)
        if a != b:
            tree[max(a, b)] = min(a, b)
            taken.append(k)
    return np.array(taken, np.int64)


def told(group: pa.Table, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """The pairs of a group, with the group's key."""
    key = {c: pa.array([group.column(c)[0].as_py()] * len(a), group.schema.field(c).type) for c in ("cell", "i", "j")}
    return pa.table({**key, "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def whole_groups(batches: Iterator[pa.RecordBatch], least: int = 1 << 13) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by (cell, i, j) as tables of whole groups, about ``least`` rows each, with the places where groups begin and the end."""

    def bounds(table: pa.Table) -> np.ndarray:
        keys = [table[c].to_numpy() for c in ("cell", "i", "j")]
        fresh = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))
        return np.append(np.flatnonzero(fresh), len(table))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held += [batch] if batch.num_rows else []
        if sum(b.num_rows for b in held) >= least:
            table = pa.Table.from_batches(held)
            at = bounds(table)
            if len(at) > 2:  # the last group may go on
                yield table.slice(0, int(at[-2])), at[:-1]
                held = table.slice(int(at[-2])).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, bounds(table)
