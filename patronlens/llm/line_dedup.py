"""Line dedup by a segment-partition edit join.

Two lines within ``edits`` edits: of edits + 1 segments of the one, the other holds one unchanged, near its place. Lines are
grouped by length; segments are as long in all lines of a group, the first ones counted from the line's start, the others from its
end. Every line is entered under a few substrings of each segment, so many that lines meet wherever it has moved to
(``marks``). Lines that meet are verified with a banded bit-parallel edit distance, many pairs side by side.

How many edits link two lines follows from the length of the shorter one (``BANDS``); a line is entered in each group
that a shorter partner may be in, cut as that group asks for.

Linked lines form classes; of each class the first line stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm import lm
from patronlens.llm.common import sliced
from patronlens.llm.components import PAIRS, components, forest_of, links_in_cells, told, whole_groups
from patronlens.session import materialise, temporary_tables

#: Edits (code points inserted, deleted or replaced) between linked lines.
EDITS = 2
#: Shorter lines are linked only if equal.
LEAST = 40
#: (least length of the shorter line, edits) of the query and the pipeline: about one edit in 100 code points of longer lines.
#: Lines under the first length are linked only if equal.
BANDS = ((15, 1), (40, 2), (200, 3), (400, 4))
#: Buckets of line identities that tasks hold to leave out lines nobody asks for; a fixed size for any corpus.
BUCKETS = 1 << 22
#: Code points of line pairs compared at once.
BATCH = 1 << 20
#: Line pairs of many groups that are compared side by side.
PAIRS_AT_ONCE = 1 << 18

_U = np.uint64


Bands = tuple[tuple[int, int], ...]


def edits_for(lengths: np.ndarray, bands: Bands) -> np.ndarray:
    """Edits that a line of each length is linked within to a line as long or longer; -1 if to none."""
    least, edits = np.array(bands, np.int64).reshape(-1, 2).T
    return np.append(edits, -1)[np.searchsorted(least, lengths, side="right") - 1]


def _bands(edits: int | Bands) -> Bands:
    return ((0, edits),) if isinstance(edits, int) else edits


def length_groups(edits: int | Bands, most: int) -> Iterator[tuple[int, int, int]]:
    """(least length, end, edits) of groups of lengths up to ``most``; all lengths of a group are of one band."""
    bands = _bands(edits)
    for (low, e), (end, _) in zip(bands, [*bands[1:], (most + 1, 0)]):
        while low < end and low <= most:
            high = min(end, low + max(2 * (e + 1), low // 8))
            yield low, high, e
            low = high


def marks(least: int, edits: int) -> list[tuple[int, bool, int, int]]:
    """(segment, whether counted from the end, first place, length) of the substrings that stand for a line.

    The edits + 1 segments are as long as the shortest line of the group allows; the first ones are counted from the line's start, the
    others from its end. Of two lines within ``edits`` edits, some segment k of one is unchanged in the other, after at most k edits
    and before at most edits - k (the first k that as many edits precede). So it is moved by at most ``shift``, the smaller of
    both, from the end it is counted from; substrings ``shift`` shorter, from ``shift`` + 1 places in both lines, meet at any such move.
    """
    width, out = least // (edits + 1), []
    for k in range(edits + 1):
        shift, back = min(k, edits - k), k > edits - k
        first = (edits + 1 - k if back else k) * width
        if width <= shift:
            out.append((k, False, 0, 0))  # so short that all lines of the group meet
        else:
            out += [(k, back, first - at if back else first + at, width - shift) for at in range(shift + 1)]
    return out


def line_cells(lines: list[str], edits: int | Bands = EDITS) -> tuple[np.ndarray, np.ndarray]:
    """(number of line, cell) for all marks of all lines, from prefix sums of hashed code points.

    A line is entered in the group of its length and in those of shorter lines that may be linked with it.
    """
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(_U)
    first = np.concatenate([[0], np.cumsum(lengths)])
    with np.errstate(over="ignore"):
        codes = (codes + _U(1)) * _U(0xD6E8FEB86659FD93)
        codes ^= codes >> _U(32)
        codes *= _U(0xD6E8FEB86659FD93)
        total = np.append(_U(0), np.cumsum(codes * lm._powers(len(codes))[: len(codes)], dtype=_U))
        inverse = lm._inverse_powers(len(codes) + 1)
        owners, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for least, end, e in length_groups(edits, int(lengths.max(initial=-1))):
            mine = np.flatnonzero((lengths >= least) & (lengths < end + e))
            if not len(mine):
                continue
            segment, back, at, size = np.array(marks(least, e), np.int64).T
            start = np.where(back, first[mine + 1][:, None] - at, first[mine][:, None] + at)
            key = (total[start + size] - total[start]) * inverse[start]
            key = (key ^ (key >> _U(31))) + (least * 64 + segment).astype(_U) * _U(0x9E3779B97F4A7C15)
            key = (key ^ (key >> _U(29))) * _U(0xBF58476D1CE4E5B9)
            owners.append(np.repeat(mine, len(at)))
            cells.append((key ^ (key >> _U(32))).view(np.int64).ravel())
    return np.concatenate(owners), np.concatenate(cells)


def within(left: list[str], right: list[str], edits: int = EDITS) -> np.ndarray:
    """For each pair of lines whether at most ``edits`` edits part them.

    The band of 2 * edits + 1 diagonals is one machine word for each pair; vertical and horizontal differences of a
    column are updated with a few word operations, for all pairs at once, column by column.
    """
    out = np.zeros(len(left), bool)
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in zip(left, right)]
    order = sorted((i for i, (a, b) in enumerate(pairs) if len(a) - len(b) <= edits), key=lambda i: len(pairs[i][0]))
    while order:
        size = max(1, BATCH // max(1, len(pairs[order[-1]][0])))
        now, order = order[-size:], order[:-size]
        out[now] = _within([pairs[i][0] for i in now], [pairs[i][1] for i in now], edits)
    return out


def linked(left: list[str], right: list[str], bands: Bands) -> np.ndarray:
    """For each pair of lines whether they are within the edits of the shorter one."""
    out = np.zeros(len(left), bool)
    allowed = edits_for(np.array([min(len(a), len(b)) for a, b in zip(left, right)], np.int64), bands)
    for edits in np.unique(allowed[allowed >= 0]).tolist():
        now = np.flatnonzero(allowed == edits)
        out[now] = within([left[i] for i in now], [right[i] for i in now], edits)
    return out


def _padded(lines: list[str], before: int, width: int, fill: int) -> np.ndarray:
    """Code points by place and line, with ``before`` empty places first."""
    out = np.full((before + width, len(lines)), fill, np.int32)
    for i, line in enumerate(lines):
        out[before : before + len(line), i] = np.frombuffer(line.encode("utf-32-le"), "<u4")
    return out


def _within(long: list[str], short: list[str], edits: int) -> np.ndarray:
    """The word's top bit is the diagonal that starts ``edits`` below the main one; the band moves one place a column.

    Along that diagonal the distance grows by one where the diagonal difference is not zero; from the end of the pattern
    on, the last row is followed by horizontal differences.
    """
    n_long, n_short = np.array([len(x) for x in long]), np.array([len(x) for x in short])
    pattern = _padded(long, edits, int(n_long.max()) + 2 * edits + 1, -1)
    text = _padded(short, 0, int(n_short.max()), -2)
    top = 63
    vp = np.full(len(long), ((1 << 64) - 1) << (top - edits) & ((1 << 64) - 1), _U)
    vn = np.zeros(len(long), _U)
    distance = np.full(len(long), edits, np.int64)
    edge = np.full(len(long), 1 << (top - 1), _U)
    with np.errstate(over="ignore"):
        for i in range(len(text)):
            equal = np.zeros(len(long), _U)
            for d in range(-edits, edits + 1):
                equal |= (pattern[i + d + edits] == text[i]).astype(_U) << _U(top - edits + d)
            d0 = (((equal & vp) + vp) ^ vp) | equal | vn
            hp = vn | ~(d0 | vp)
            hn = d0 & vp
            open_ = i < n_short
            diagonal = i < n_long - edits
            along = open_ & diagonal
            distance += along & ((d0 >> _U(top)) == 0)
            below = open_ & ~diagonal
            distance += below & ((hp & edge) != 0)
            distance -= below & ((hn & edge) != 0)
            edge = np.where(below, edge >> _U(1), edge)
            vp = hn | ~((d0 >> _U(1)) | hp)
            vn = (d0 >> _U(1)) & hp
    return distance <= edits


def _in_cells(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, line) -> (cell, node), each node of a slice once."""
        for batch in sliced(batches, 1):
            node, at = np.unique(batch.column(0).to_numpy(), return_index=True)
            lines = batch.column(1).take(pa.array(at)).to_pylist()
            keep = [i for i, line in enumerate(lines) if len(line) >= bands[0][0]]
            for part in _sliced(keep, lines):
                owner, cell = line_cells([lines[i] for i in part], bands)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(node[np.array(part, np.int64)][owner])], names=["cell", "node"])

    return run


def _sliced(numbers: list[int], lines: list[str]) -> Iterator[list[int]]:
    """The line numbers in groups of about BATCH code points."""
    part, size = [], 0
    for i in numbers:
        if part and size + len(lines[i]) > BATCH:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(lines[i])
    if part:
        yield part


def _verified(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = linked(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), bands)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def _may(lines: list[str], label: np.ndarray, chunk: np.ndarray, one: bool, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group of a cell whose distance is worth a look.

    They have different labels, and different chunks if the group has two. An edit changes a line's counts of letters by
    two at most, so pairs whose counts differ by more are ruled out.
    """
    size = np.fromiter(map(len, lines), np.int32, len(lines))
    letters = np.stack([np.bincount(np.frombuffer(x.encode("utf-32-le"), "<u4") % 61, minlength=61) for x in lines]).astype(np.int32)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in range(len(lines) - 1):
        edits = edits_for(np.minimum(size[x + 1 :], size[x]), bands)
        may = (np.abs(size[x + 1 :] - size[x]) <= edits) & (label[x + 1 :] != label[x]) & (one | (chunk[x + 1 :] != chunk[x]))
        y = np.flatnonzero(may) + x + 1
        y = y[np.abs(letters[y] - letters[x]).sum(axis=1) <= 2 * edits[y - x - 1]]
        left.append(np.full(len(y), x))
        right.append(y)
    return np.concatenate(left), np.concatenate(right)


def _near_pairs(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Linked pairs that connect, in each group of a cell, all its different components that are linked.

        The distances of many groups' pairs are found side by side: first a forest of those worth a look, then what
        its links have not connected.
        """
        for table, bounds in whole_groups(batches):
            lines = table["line"].to_pylist()
            node, chunk, i, j = (table[c].to_numpy() for c in ("node", "chunk", "i", "j"))
            label = np.unique(table["label"].to_numpy(), return_inverse=True)[1]
            groups = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            found = []
            for a, b in groups:
                x, y = _may(lines[a:b], label[a:b], chunk[a:b], bool(i[a] == j[a]), bands)
                found.append((x + a, y + a))
            label = np.concatenate([np.unique(label[a:b], return_inverse=True)[1] + a for a, b in groups])  # apart in each group
            for forest in (True, False):
                tried = [k[forest_of(x[k], y[k], label)] if forest else k for x, y in found for k in [np.flatnonzero(label[x] != label[y])]]
                pairs = [(x[k], y[k]) for (x, y), k in zip(found, tried)]
                left, right = (np.concatenate(side) for side in zip(*pairs))
                cuts = [slice(k, k + PAIRS_AT_ONCE) for k in range(0, max(1, len(left)), PAIRS_AT_ONCE)]
                ok = np.concatenate([linked([lines[k] for k in left[cut].tolist()], [lines[k] for k in right[cut].tolist()], bands) for cut in cuts])
                ends = np.cumsum([0, *(len(x) for x, _ in pairs)])
                for (a, b), (x, y), start, stop in zip(groups, pairs, ends[:-1], ends[1:]):
                    x, y = x[ok[start:stop]], y[ok[start:stop]]
                    if len(x):
                        tree = forest_of(x, y, label[a:b], a)
                        for k in tree.tolist():
                            label[a:b][label[a:b] == label[y[k]]] = label[x[k]]
                        x, y = x[tree], y[tree]
                        yield from told(table.slice(a, 1), np.minimum(node[x], node[y]), np.maximum(node[x], node[y])).to_batches()

    return run


def _asked(buckets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines whose identity falls in a bucket that somebody asks for."""
        for batch in batches:
            yield batch.filter(pa.array(buckets[batch.column(0).to_numpy() & (BUCKETS - 1)]))

    return run


def document_key(text: str = "text") -> list[Column]:
    """Identity of a document: its id and text, so that rows without an id or with a repeated one stay apart."""
    return [F.col("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash")]


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_hash, pos, line, node) for each ``\\n``-split line with a word; node is the identity of equal lines."""
    split = docs.filter(F.col(text).isNotNull()).select(*document_key(text), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return split.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("node", F.xxhash64("line"))


def line_links(lines: DataFrame, bands: Bands = ((LEAST, EDITS),)) -> DataFrame:
    """Links (a, b) between different lines; what they connect is what all links within the edits of ``bands`` connect."""
    texts = lines.select("node", "line")

    def describe(nodes: DataFrame) -> DataFrame:
        used = nodes.select(F.col("node").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).distinct().toArrow()
        buckets = np.zeros(BUCKETS, bool)
        buckets[used.column("bucket").to_numpy()] = True
        return materialise(texts.mapInArrow(_asked(buckets), "node bigint, line string").dropDuplicates(["node"]).join(nodes, "node"))

    def verify(pairs: DataFrame, described: DataFrame) -> DataFrame:
        both = pairs.join(described.toDF("a", "sa"), "a").join(described.toDF("b", "sb"), "b")
        return both.mapInArrow(_verified(bands), "a bigint, b bigint")

    def pairs(dealt: DataFrame, described: DataFrame, forest: bool) -> DataFrame:
        groups = dealt.join(described, "node").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
        return groups.select("cell", "i", "j", "node", "label", "chunk", "line").mapInArrow(_near_pairs(bands), PAIRS)

    return links_in_cells(texts.mapInArrow(_in_cells(bands), "cell bigint, node bigint"), describe, verify, pairs)


def dedup(docs: DataFrame, text: str = "text", edits: int = EDITS, least: int = LEAST, bands: Bands | None = None) -> DataFrame:
    """``docs`` with the lines removed from ``text`` of which an equal or near line came before; adds n_lines and removed.

    Lines are near within ``edits`` edits if both have ``least`` code points or more, or, with ``bands`` (length, edits)
    from short to long, within the edits of the last band that the shorter line reaches; classes are what near and equal lines
    connect. Lines come in the order of doc_id (nulls last), identity of the text, place in the text; the first of a
    class stays. Lines without a word stay. removed: places of the removed lines. A null text stays null, an empty
    one empty. Repeated rows are one document: both lose the same lines. No row is dropped.
    """
    lines = lines_of(docs, text)
    with temporary_tables(docs.sparkSession):
        labels = components(line_links(lines, bands or ((least, edits),)))
        place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "pos")
        narrow = materialise(lines.select("doc_id", "text_hash", "pos", "node"))
        nodes = narrow.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("n")).join(labels, "node", "left")
        nodes = materialise(nodes.select("node", "first", "n", F.coalesce("label", "node").alias("label")))
        classes = nodes.groupBy("label").agg(F.min("first").alias("stays"), F.sum("n").alias("in_class")).filter("in_class > 1")
        later = nodes.join(classes, "label").select("node", "stays")
        gone = narrow.join(later, "node").filter(~place.eqNullSafe(F.col("stays")))
        counts = narrow.groupBy("doc_id", "text_hash").agg(F.countDistinct("pos").alias("n_lines"))
        removed = gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("removed"))
        told = counts.alias("c").join(removed.alias("r"), F.col("c.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("c.text_hash") == F.col("r.text_hash")), "left")
        told = materialise(told.select("c.doc_id", "c.text_hash", "n_lines", "removed").toDF("_id", "_hash", "n_lines", "removed"), outlives=True)
    clean = docs.drop("n_lines", "removed")
    keyed = clean.select("*", document_key(text)[1].alias("_key"))
    joined = keyed.join(told, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash")), "left")
    out = joined.select(*clean.columns, F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
    at = clean.columns.index(text)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at):
            texts = batch.column(at).to_pylist()
            for i, gone in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if gone:
                    lost = set(gone)
                    texts[i] = "\n".join(line for p, line in enumerate(texts[i].split("\n")) if p not in lost)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return out.mapInArrow(rebuild, out.schema)


def digest(docs: DataFrame) -> DataFrame:
    """The result of the query: doc_id, n_lines, n_removed, removed and the text that is left."""
    return dedup(docs, bands=BANDS).select("doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), "removed", "text")
