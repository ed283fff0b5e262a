"""Exact dedup by Patricia tries: texts that are equal byte for byte share a terminal, which knows its owner.

Copies within a task are merged first, so a text costs a task one row however often it holds it. What is left is dealt out
by length and content hash, and each partition inserts its whole byte strings into a radix trie whose edges are pieces of
the strings themselves. A terminal keeps the identifier of the row that stays, how many rows bear it and how many rows share
the text. When the strings of a trie outgrow the memory that it is given, a heavy subtree is handed on as rows of the
next round, and so is every later string below the same prefix. Equal strings always share length and hash, so they meet again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from patronlens.llm.common import sliced
from patronlens.session import materialise

#: Bytes of strings in a trie before a subtree is handed on.
MEMORY = 64 << 20
#: Classes with at least this share of all rows are joined apart: there can be no more than 1 / SHARE of them.
SHARE = 0.001
#: Bytes of text in a batch that a task hands on.
BATCH = 4 << 20


class Node:
    """A node and the edge that leads to it: bytes ``start`` to ``stop`` of ``string``."""

    __slots__ = ("string", "start", "stop", "children", "terminal", "gone")

    def __init__(self, string: bytes, start: int, stop: int):
        self.string, self.start, self.stop = string, start, stop
        self.children: dict[int, Node] = {}
        self.terminal: tuple | None = None
        self.gone = False  # a stub of one byte, whose subtree was handed on


def common(a: bytes, b: bytes, i: int, j: int, most: int) -> int:
    """Number of equal bytes of a from i and b from j, at most ``most``; compared in growing stretches."""
    done, step = 0, 32
    while done < most:
        n = min(step, most - done)
        x, y = a[i + done : i + done + n], b[j + done : j + done + n]
        if x != y:
            while n > 1:  # halve the stretch that holds the first difference
                half = n // 2
                if x[:half] == y[:half]:
                    done, x, y, n = done + half, x[half:], y[half:], n - half
                else:
                    x, y, n = x[:half], y[:half], half
            return done
        done, step = done + n, step * 4
    return done


class Trie:
    """Byte strings with what their terminals store. ``merge(old, new)`` combines two stored values."""

    def __init__(self, merge):
        self.root = Node(b"", 0, 0)
        self.merge, self.held = merge, 0

    def insert(self, string: bytes, value: tuple) -> bool:
        """False if the string belongs to a subtree that was handed on."""
        node, i, n = self.root, 0, len(string)
        while i < n:
            child = node.children.get(string[i])
            if child is None:
                child = Node(string, i, n)
                child.terminal = value
                node.children[string[i]] = child
                self.held += n
                return True
            if child.gone:
                return False
            length = child.stop - child.start
            same = common(string, child.string, i, child.start, min(length, n - i))
            if same < length:
                upper = Node(child.string, child.start, child.start + same)
                upper.children[child.string[child.start + same]] = child
                child.start += same
                node.children[string[i]] = upper
                child = upper
            node, i = child, i + same
        if node.terminal is None:
            node.terminal = value
            self.held += n
        else:
            node.terminal = self.merge(node.terminal, value)
        return True

    def terminals(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, tuple]]:
        """(string, value) of all strings below the node, which ``before`` leads to."""
        open_nodes = [(node or self.root, before)]
        while open_nodes:
            at, prefix = open_nodes.pop()
            string = prefix + at.string[at.start : at.stop]
            if at.terminal is not None:
                yield string, at.terminal
            open_nodes += [(child, string) for child in at.children.values()]

    def spill(self) -> list[tuple[bytes, tuple]] | None:
        """Take a heavy subtree out and return what it held; None if there is nothing to part.

        The way goes down the heaviest children to one that holds at most half of all bytes, or to a leaf.
        """
        node, before = self.root, b""
        total = sum(1 for _ in self.terminals())
        while True:
            found = {first: list(self.terminals(child, before)) for first, child in node.children.items() if not child.gone}
            if not found:
                return None
            first = max(found, key=lambda f: sum(len(s) for s, _ in found[f]))
            weight = sum(len(s) for s, _ in found[first])
            child = node.children[first]
            if len(found[first]) < total and (2 * weight <= self.held or not child.children):
                stub = node.children[first] = Node(bytes([first]), 0, 1)
                stub.gone = True
                self.held -= weight
                return found[first]
            node, before = child, before + child.string[child.start : child.stop]


def keeper(largest: bool):
    """Merge of two stored values (identifier of the row that stays, rows that bear it, rows of the text). Any identifier goes before none."""

    def merge(a: tuple, b: tuple) -> tuple:
        size = a[2] + b[2]
        if a[0] == b[0]:
            return a[0], a[1] + b[1], size
        if a[0] is None or b[0] is None:
            first = b if a[0] is None else a
        else:
            first = a if (a[0] > b[0]) == largest else b
        return first[0], first[1], size

    return merge


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def _schema(id_type: str) -> tuple[str, pa.Schema]:
    arrow = pa.string() if id_type == "string" else pa.int64()
    names = [("length", "bigint", pa.int64()), ("hash", "bigint", pa.int64()), ("sha256", "string", pa.string()), ("content", "binary", pa.binary()), ("owner", id_type, arrow), ("owners", "bigint", pa.int64()), ("size", "bigint", pa.int64())]
    return ", ".join(f"{n} {t}" for n, t, _ in names), pa.schema([(n, a) for n, _, a in names])


def distinct_texts(docs: DataFrame, text: str, id: str, largest: bool, bits: int = 64) -> DataFrame:
    """A row for each text that a stretch of a task holds: its length, hash and bytes, and what its terminal is to store."""
    ddl, schema = _schema(_id_type(docs, id))
    merge = keeper(largest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, 1, BATCH):
            found: dict[bytes, tuple] = {}
            for key, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                content, value = content or b"", (key, 1, 1)
                found[content] = merge(found[content], value) if content in found else value
            rows = []
            for content, value in found.items():
                digest = hashlib.sha256(content)
                hash64 = int.from_bytes(digest.digest()[:8], "big", signed=True) >> (64 - bits)
                rows.append((len(content), hash64, digest.hexdigest(), content, *value))
            yield _rows(rows, schema)

    return docs.select(F.col(id).cast(_id_type(docs, id)), F.col(text).cast("binary")).mapInArrow(run, ddl)


def _id_type(docs: DataFrame, id: str) -> str:
    kind = docs.schema[id].dataType
    if isinstance(kind, IntegralType):
        return "bigint"
    if kind.simpleString() != "string":
        raise TypeError(f"{id} must hold whole numbers or strings")
    return "string"


def _plant(rows: DataFrame, id_type: str, largest: bool, memory: int) -> DataFrame:
    """What the tries of all partitions hold at the end (content null), and the rows that they handed on (content kept)."""
    ddl, schema = _schema(id_type)
    merge = keeper(largest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(lambda a, b: (*a[:2], *merge(a[2:], b[2:])))
        for part in sliced(batches, 3, BATCH):
            later = []
            for length, hash64, sha256, content, *value in zip(*(c.to_pylist() for c in part.columns)):
                if not trie.insert(content, (hash64, sha256, *value)):
                    later.append((length, hash64, sha256, content, *value))
                while trie.held > memory and (taken := trie.spill()):
                    later += [(len(s), v[0], v[1], s, *v[2:]) for s, v in taken]
            if later:
                yield _rows(later, schema)
        done = [(len(s), v[0], v[1], None, *v[2:]) for s, v in trie.terminals()]
        if done:
            yield _rows(done, schema)

    return rows.repartition("length", "hash").mapInArrow(run, ddl)


def classes(docs: DataFrame, text: str = "text", id: str = "doc_id", largest: bool = False, memory: int = MEMORY, bits: int = 64) -> DataFrame:
    """(length, sha256, owner, owners, size) of every text: the identifier that stays, how many rows bear it, how many rows hold the text.

    Rounds go on while a trie hands subtrees on; every round settles what its tries hold, so the rest gets smaller.
    """
    id_type = _id_type(docs, id)
    rows, done = distinct_texts(docs, text, id, largest, bits), None
    while True:
        after = materialise(_plant(rows, id_type, largest, memory))
        settled = after.filter("content IS NULL").select("length", "sha256", "owner", "owners", "size")
        done = settled if done is None else done.unionByName(settled)
        rows = after.filter("content IS NOT NULL")
        if rows.isEmpty():
            return done


def mark(docs: DataFrame, keep: list[str], text: str = "text", id: str = "doc_id", largest: bool = False, memory: int = MEMORY, bits: int = 64) -> DataFrame:
    """Columns ``keep`` of every row with keep_id, group_size, kept and text_sha256.

    A null text counts as empty, and empty texts are equal. The row with the smallest id stays (``largest``: the largest);
    a row without an id stays only if none of its text has one. Of repeated rows that share the id that stays, one is kept.
    An empty table gives an empty one. Other columns of ``docs`` play no part; ``keep`` must not hold the four new names.

    Rows find their class by length and SHA-256; the tries have compared the bytes, and two texts that share both raise.
    """
    length, sha256 = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    light = materialise(docs.select(*keep, F.col(id).cast(_id_type(docs, id)).alias("_id"), length.alias("_length"), sha256.alias("text_sha256"), F.monotonically_increasing_id().alias("_row")))
    found = materialise(classes(docs, text, id, largest, memory, bits).select(F.col("length").alias("_length"), F.col("sha256").alias("text_sha256"), F.col("owner").alias("keep_id"), F.col("size").alias("group_size"), F.col("owners").alias("_owners")))
    on = ["_length", "text_sha256"]
    rows, most = found.agg(F.sum("group_size"), F.max("_owners")).first()
    is_hot = F.col("group_size") >= max(2, int((rows or 0) * SHARE))
    hot, rest = F.broadcast(found.filter(is_hot)), found.filter(~is_hot)  # at most 1 / SHARE classes are hot, once there are 2 / SHARE rows
    joined = light.join(hot, on).unionByName(light.join(hot.select(*on), on, "left_anti").join(rest, on))
    joined = joined.withColumn("kept", F.col("_id").eqNullSafe(F.col("keep_id")))
    if (most or 0) > 1:
        tied = joined.filter("kept AND _owners > 1").groupBy(*on).agg(F.min("_row").alias("_stays"))
        hot_tied = F.broadcast(tied.join(hot.select(*on), on, "left_semi"))
        twice = joined.filter("kept AND _owners > 1")
        of_twice = twice.join(hot_tied, on).unionByName(twice.join(hot.select(*on), on, "left_anti").join(tied, on))
        joined = joined.filter("NOT (kept AND _owners > 1)").unionByName(of_twice.withColumn("kept", F.expr("_row = _stays")).drop("_stays"))
    return joined.select(*keep, "keep_id", "group_size", "kept", "text_sha256")


def digest(docs: DataFrame) -> DataFrame:
    """The result of the query: of equal texts the row with the largest id stays."""
    return mark(docs, ["doc_id"], largest=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def sql() -> str:
    return """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))"""
