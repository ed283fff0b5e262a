"""N-gram Jaccard join with points of group counts.

A text's set of word shingles is hashed into groups; the counts in the groups are a point. Two sets share at most the sum
of the smaller coordinates, so a pair whose sum is below what the threshold asks for is no link. The survivors are
verified on the sets themselves.

Points alone cannot part a large corpus: unlike texts of equal length have similar counts. So the tree's upper levels are
dealt out by what the groups hold. With as many groups as two linked sets may differ in shingles, and one more, at least
one group is the same in both (pigeonhole); sets meet in the cells (length class, group, content of the group). Within a
cell the points are bounded as above. Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm import lm
from patronlens.llm.common import UPPER, sliced
from patronlens.llm.components import PAIRS, components, forest_of, links_in_cells, told, whole_groups
from patronlens.session import materialise, temporary_tables

WIDTH = 4
#: Link: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Least number of coordinates of a point; a point has about one for each shingle of its set, so that unlike sets differ.
GROUPS = 64
#: Points in a leaf of the tree.
LEAF = 16


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles: ``width`` lower-cased words, or all words if fewer."""
    hashes, docs = [], []
    for part in lm.stretches(texts):
        h, d = lm.word_hashes(part)
        word = h != lm.END_WORD
        hashes.append(h[word])
        docs.append(d[word])
    words = np.concatenate(hashes or [np.zeros(0, np.int64)]).view(np.uint64)
    doc = np.concatenate(docs or [np.zeros(0, np.int32)])
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    n = len(words) - width + 1
    full = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            full = _mix(full + words[k : k + len(full)] + np.uint64(k + 1))
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                out.append(np.unique(full[a : b - width + 1]))
            elif b > a:
                whole = np.zeros(1, np.uint64)
                for k in range(b - a):
                    whole = _mix(whole + words[a + k] + np.uint64(k + 1))
                out.append(_mix(whole + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def node_id(shingles: np.ndarray) -> int:
    """Identity of a set: 64 bits of all its shingles."""
    with np.errstate(over="ignore"):
        return int(_mix(np.array([_mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def point(shingles: np.ndarray, least: int = GROUPS) -> np.ndarray:
    """Counts in as many groups as the next power of two of the set's size; counts over 255 are cut (``bounded`` makes up for it)."""
    groups = max(least, 1 << (max(len(shingles), 1) - 1).bit_length())
    counts = np.bincount((shingles % np.uint64(groups)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8)


def folded(points: list[np.ndarray]) -> np.ndarray:
    """Points of different sizes side by side, in the groups of the smallest: a set's groups of half the number are sums of two."""
    groups = min(map(len, points), default=GROUPS)
    return np.stack([p.reshape(-1, groups).sum(axis=0, dtype=np.int32) for p in points]) if points else np.zeros((0, groups), np.int32)


def least_common(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least intersection of a linked pair whose sizes sum to ``sizes``."""
    return -(-percent * sizes // (100 + percent))


def length_classes(n: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(number, largest size) of the length class of a set of ``n`` shingles and of the next one.

    Class k ends where a set linked to its smallest member could end, so linked sets lie in one class or in neighbours, and
    each set is entered in its own class and in the next: any linked pair meets in one class.
    """
    k, low = 0, 1
    while True:
        high = low * 100 // percent
        if n <= high:
            following = (high + 1) * 100 // percent
            return [(k, high), (k + 1, following)]
        k, low = k + 1, high + 1


@cache
def most_different(high: int, percent: int = PERCENT) -> int:
    """Most shingles that two linked sets of at most ``high`` shingles differ in."""
    sizes = np.arange(2, 2 * high + 1)
    return int(np.max(sizes - 2 * least_common(sizes, percent), initial=0))


def spared(differ: int) -> int:
    """Cells that a set may leave out, as linked sets share so many and one more."""
    return 2 + differ // 4


def _grouped(shingles: np.ndarray, percent: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each class of a set: (class, groups, mixed shingles, their groups, empty groups left out, how many cells it may leave out besides)."""
    with np.errstate(over="ignore"):
        mixed = _mix(shingles + np.uint64(0x632BE59BD9B4E019))
    for k, high in length_classes(len(shingles), percent):
        differ = most_different(high, percent)
        if not differ:
            continue  # linked sets of this class are equal, and equal sets are one node
        spare = spared(differ)
        groups = differ + 1 + spare
        of = (mixed % np.uint64(groups)).astype(np.int64)
        empty = np.flatnonzero(np.bincount(of, minlength=groups) == 0)
        yield k, groups, mixed, of, empty[:spare], max(0, spare - len(empty))


def may_leave_out(shingles: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(class, spare) of ``cells`` for each class of a set, without the cells."""
    return [(k % 256, spare) for k, _, _, _, _, spare in _grouped(shingles, percent)]


def cells(shingles: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Cells of a set, hashes of (class, group, the group's shingles), and (class, spare) for each class.

    Two linked sets of a class differ in at most d shingles, so with d + 1 + s groups at least 1 + s are equal, and a set may
    leave s of its cells out. Empty groups are left out first, for they would be the most crowded cells; only what a set has
    beyond s of them is entered. The class is the cell's last byte.
    """
    out, parts = [], []
    for k, groups, mixed, of, empty, spare in _grouped(shingles, percent):
        with np.errstate(over="ignore"):
            content = np.zeros(groups, np.uint64)
            np.add.at(content, of, _mix(mixed))
            keys = _mix(_mix(content + np.uint64(k)) + (np.arange(groups) * (1 << 20) + k).astype(np.uint64))
        keys = np.delete(keys, empty)
        out.append(keys & ~np.uint64(255) | np.uint64(k % 256))
        parts.append((k % 256, spare))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), parts


def bounded(sizes_a, points_a, sizes_b, points_b, percent: int = PERCENT, cut: np.ndarray | int = 0) -> np.ndarray:
    """Whether each pair may be linked: the sum of coordinate minima reaches the least intersection.

    ``cut``: the most that two sets may share beyond their points.
    """
    return np.minimum(points_a, points_b).sum(axis=-1) + cut >= least_common(sizes_a + sizes_b, percent)


def tree_pairs(sizes: np.ndarray, points: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i < j) of points that may be linked, by a packed tree over the points, leaf by leaf.

    Leaves are runs of LEAF points in order of size; a leaf holds its coordinate maxima and smallest size. A pair of leaves
    whose maxima share too little is skipped with all its points.
    """
    order = np.argsort(sizes, kind="stable")
    starts = np.arange(0, len(order), LEAF)
    top = np.maximum.reduceat(points[order], starts, axis=0) if len(order) else points
    low = np.minimum.reduceat(sizes[order], starts) if len(order) else sizes
    cut = sizes - points.sum(axis=1)
    most_cut = np.maximum.reduceat(cut[order], starts) if len(order) else cut
    for x in range(len(starts)):
        may = np.flatnonzero(bounded(low[x], top[x], low[x:], top[x:], percent, np.minimum(most_cut[x], most_cut[x:]))) + x
        mine = order[starts[x] : starts[x] + LEAF]
        left, right = [], []
        for y in may:
            other = order[starts[y] : starts[y] + LEAF]
            i, j = (m.ravel() for m in np.meshgrid(mine, other, indexing="ij"))
            ok = bounded(sizes[i], points[i], sizes[j], points[j], percent, np.minimum(cut[i], cut[j])) & ((i < j) if x == y else True)
            left.append(np.minimum(i, j)[ok])
            right.append(np.maximum(i, j)[ok])
        if left:
            yield np.concatenate(left), np.concatenate(right)


def tree_join(sizes: np.ndarray, points: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``tree_pairs``."""
    none = np.zeros(0, np.int64)
    left, right = zip(*tree_pairs(sizes, points, percent), (none, none))
    return np.concatenate(left), np.concatenate(right)


DESCRIBED = "node bigint, text_hash bigint, n bigint, point binary, parts array<struct<part:int,spare:int>>"
_PARTS = pa.list_(pa.struct([("part", pa.int32()), ("spare", pa.int32())]))


def _described(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text_hash, text) -> (node, text_hash, n, point, how many cells of each class it may leave out)."""
        for batch in sliced(batches, 1):
            sets = shingle_sets(batch.column(1), width)
            parts = [[{"part": k, "spare": n} for k, n in may_leave_out(s, percent)] if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node_id(s) for s in sets], pa.int64()),
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([point(s).tobytes() for s in sets], pa.binary()),
                    pa.array(parts, _PARTS),
                ],
                names=["node", "text_hash", "n", "point", "parts"],
            )

    return run


def _in_cells(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text -> (cell, node), each node of a slice once."""
        for batch in sliced(batches, 0):
            cell, node = [], []
            seen: set[int] = set()
            for s in shingle_sets(batch.column(0), width):
                own = node_id(s)
                if len(s) and own not in seen:
                    seen.add(own)
                    cell.append(cells(s, percent)[0].view(np.int64))
                    node.append(np.full(len(cell[-1]), own, np.int64))
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cell or none)), pa.array(np.concatenate(node or none))], names=["cell", "node"])

    return run


def _with_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text -> (node, shingles as bytes)."""
        for batch in sliced(batches, 0):
            sets = shingle_sets(batch.column(0), width)
            yield pa.RecordBatch.from_arrays([pa.array([node_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    return run


def _near(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose points allow a link."""
        for batch in batches:
            ok = []
            for na, x, nb, y in zip(*(batch.column(c).to_pylist() for c in ("na", "pa", "nb", "pb"))):
                two = folded([np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)])
                ok.append(bool(bounded(na, two[0], nb, two[1], percent, min(na - two[0].sum(), nb - two[1].sum()))))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose sets are linked."""
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _tree_pairs(percent: int, forest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of different components in a group of a cell that the tree over their points does not rule out."""
        for table, bounds in whole_groups(batches):
            node, label, chunk, size = (table[c].to_numpy() for c in ("node", "label", "chunk", "n"))
            one = table["i"].to_numpy() == table["j"].to_numpy()
            points = [np.frombuffer(p.as_buffer(), np.uint8) for p in table["point"]]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if (label[a:b] == label[a]).all():
                    continue
                trees: dict[int, int] = {}
                for x, y in tree_pairs(size[a:b], folded(points[a:b]), percent):
                    x, y = x + a, y + a
                    ok = np.flatnonzero((label[x] != label[y]) & (one[a] | (chunk[x] != chunk[y])))
                    if forest:
                        ok = ok[forest_of(x[ok], y[ok], label, tree=trees)]
                    if len(ok):
                        yield from told(table.slice(a, 1), np.minimum(node[x], node[y])[ok], np.maximum(node[x], node[y])[ok]).to_batches()

    return run


def similar(docs: DataFrame, keep: list[str], text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Columns ``keep`` with node (identity of the shingle set), n_shingles and label (component of the node).

    Shingles have ``width`` words; sets are linked if 100 * intersection >= percent * union.
    A null text and one without words have an empty set, n_shingles 0 and a null label: they are linked with nothing.
    Equal sets have one node. Repeated rows are linked with each other like copies. All rows are returned; an empty table
    gives an empty one. Columns outside ``keep`` play no part; ``keep`` must not hold the three new names or ``text_hash``.
    """
    source = docs.select(*keep, F.col(text).alias("_text"), F.xxhash64(text).alias("text_hash"))
    with temporary_tables(docs.sparkSession):
        described = materialise(source.select("text_hash", "_text").mapInArrow(_described(width, percent), DESCRIBED).distinct())
        nodes = materialise(described.groupBy("node").agg(F.min("text_hash").alias("text_hash"), F.min("n").alias("n"), F.min("point").alias("point"), F.min("parts").alias("parts")))
        points = nodes.select("node", "n", "point")

        def describe(asked: DataFrame) -> DataFrame:
            wanted = nodes.join(asked, "node").select("text_hash").distinct()
            sets = source.join(wanted, "text_hash").select("_text").mapInArrow(_with_sets(width), "node bigint, shingles binary")
            return materialise(sets.dropDuplicates(["node"]))

        def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
            sides = [points.toDF(x, f"n{x}", f"p{x}") for x in "ab"]
            near = pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_near(percent), "a bigint, b bigint")
            full = [sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab"]
            return near.join(full[0], "a").join(full[1], "b").mapInArrow(_linked(percent), "a bigint, b bigint")

        def pairs(dealt: DataFrame, sets: DataFrame, forest: bool) -> DataFrame:
            groups = dealt.join(points, "node").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
            return groups.select("cell", "i", "j", "node", "label", "chunk", "n", "point").mapInArrow(_tree_pairs(percent, forest), PAIRS)

        entered = source.select("_text").mapInArrow(_in_cells(width, percent), "cell bigint, node bigint")
        found = links_in_cells(entered, describe, verify, pairs, nodes.select("node", F.inline("parts")))
        labels = components(found)
        label = F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label")
        named = materialise(described.join(labels, "node", "left").select("text_hash", "node", F.col("n").alias("n_shingles"), label), outlives=True)
    return source.drop("_text").join(named, "text_hash").drop("text_hash")


def digest(docs: DataFrame) -> DataFrame:
    """The result of the query: doc_id, n_shingles and component_id, the smallest doc_id of the component.

    A text that is linked with nothing has its own doc_id. Rows without an id have the component's smallest id, if any.
    """
    joined = materialise(similar(docs, ["doc_id"]))
    smallest = joined.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    linked = joined.filter("label IS NOT NULL").join(smallest, "label").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    return linked.unionByName(joined.filter("label IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def sql() -> str:
    """The digest in DuckDB's SQL: links by counting common shingles, components by recursion."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: array_to_string(w[i:i+{WIDTH - 1}], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {PERCENT} * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS least FROM w UNION SELECT b, least FROM r JOIN e ON a = node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least AS component_id FROM (SELECT node AS doc_id, min(least) AS least FROM r GROUP BY node) LEFT JOIN n USING (doc_id)"""

