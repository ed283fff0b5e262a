"""Line dedup and the Jaccard join against all pairs, on small tables with nulls, copies and clashing columns."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from patronlens.llm import components, jaccard_join, line_dedup


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def closed(nodes, linked):
    """node -> smallest node that links lead to."""
    label = {n: n for n in nodes}
    pairs = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if linked(a, b)]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def edited(rng, line, edits):
    chars = list(line)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.random()
        chars[at : at + 1] = [rng.choice("äbc ")] if kind < 0.4 else [] if kind < 0.7 else [chars[at], rng.choice("xyö")]
    return "".join(chars)


def some_lines(seed, n=60):
    rng = random.Random(seed)
    lines = []
    for _ in range(n):
        base = "".join(rng.choices("abcdefgh é", k=rng.randint(30, 90)))
        lines.append(base)
        for _ in range(rng.randint(0, 4)):
            lines.append(edited(rng, base, rng.randint(0, 4)))
    return lines


def test_banded_distance_equals_the_plain_one():
    rng = random.Random(3)
    lines = some_lines(1)
    left = [rng.choice(lines) for _ in range(1500)] + ["", "a", "ab", "abc"]
    right = [edited(rng, x, rng.randint(0, 4)) if x and rng.random() < 0.7 else rng.choice(lines) for x in left[:-4]] + ["", "abc", "", "b"]
    for edits in (1, 2, 3):
        want = [edit_distance(a, b) <= edits for a, b in zip(left, right)]
        assert line_dedup.within(left, right, edits).tolist() == want


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_share_a_cell(edits):
    lines = some_lines(5)
    owner, cell = line_dedup.line_cells(lines, edits)
    cells = [set(cell[owner == i].tolist()) for i in range(len(lines))]
    for i, a in enumerate(lines):
        for j in range(i):
            if edit_distance(a, lines[j]) <= edits:
                assert cells[i] & cells[j]


def test_line_dedup_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 3)
    rng = random.Random(8)
    pool = some_lines(7, 25) + ["short", "short", " ", "", "tiny line"]
    docs = [(i if i % 9 else None, "\n".join(rng.choices(pool, k=rng.randint(1, 8))), "en", 5) for i in range(40)]
    docs += [docs[3], (1000, None, None, None), (1001, "", None, None), (1002, "\n\n", None, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, removed string, n_lines int")
    nodes = sorted({line for _, t, *_ in docs for line in (t or "").split("\n") if line.strip(" \t")})
    label = closed(nodes, lambda a, b: min(len(a), len(b)) >= line_dedup.LEAST and edit_distance(a, b) <= line_dedup.EDITS)
    hashes = {(r.doc_id, r.text): r.text_hash for r in df.select("text", *line_dedup.document_key()).collect()}
    seen, want = {}, []
    for doc, text in sorted({(d, t) for d, t, *_ in docs if t is not None}, key=lambda x: (x[0] is None, x[0] or 0, hashes[x])):
        for pos, line in enumerate(text.split("\n")):
            if line in label:
                seen.setdefault(label[line], (doc, text, pos))
    for doc, text, *_ in docs:
        kept = None
        if text is not None:
            kept = "\n".join(line for pos, line in enumerate(text.split("\n")) if line not in label or seen[label[line]] == (doc, text, pos))
        want.append((doc, kept))
    got = line_dedup.dedup(df)
    assert got.columns == ["doc_id", "text", "n_lines", "removed"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert line_dedup.dedup(df.limit(0)).count() == 0


def test_line_bands_against_all_pairs(spark):
    """Near copies of short and long lines, at the edges of the bands, as the query links them."""
    rng = random.Random(14)
    lines = ["Copyright 2023 by the river house press", "Copyright 2024 by the river house press"]
    for n in (10, 14, 15, 16, 38, 39, 40, 41, 120, 199, 200, 203, 350, 398, 400, 404, 900):
        base = "".join(rng.choices("abcdefgh é", k=n - 2)).strip() + "x"
        lines += [base] + [edited(rng, base, e) for e in (1, 2, 3, 4, 5)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    nodes = list(dict.fromkeys(lines))

    def near(a, b):
        n = min(len(a), len(b))
        return n >= 15 and abs(len(a) - len(b)) < 5 and edit_distance(a, b) <= (1 if n < 40 else 2 if n < 200 else 3 if n < 400 else 4)

    place = {x: i for i, x in reversed(list(enumerate(lines)))}
    label = closed(list(range(len(nodes))), lambda a, b: near(nodes[a], nodes[b]))
    want = {min(place[nodes[b]] for b in label if label[b] == label[a]) for a in label}
    got = {r.doc_id for r in line_dedup.digest(df).collect() if r.n_removed == 0}
    assert got == want and 1 not in got and len(got) < len(nodes) - 20


def some_docs(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "one", "ONE", "two words", "a b c d", "A  B c\nd", "a b c e"]
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([5, 8, 12, 30, 60, 200]))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
    return texts + texts[-3:]


def test_jaccard_join_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 4)
    texts = some_docs(2)
    rows = [(i if i % 13 else None, t, 1, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node int, label string")

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()

    sets = [shingles(t) for t in texts]
    nodes = list(range(len(texts)))
    label = closed(nodes, lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    want = []
    for i, (doc, *_) in enumerate(rows):
        ids = [rows[j][0] for j in nodes if label[j] == label[i] and rows[j][0] is not None]
        want.append((doc, len(sets[i]), min(ids, default=None)))
    got = jaccard_join.digest(df)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert jaccard_join.digest(df.limit(0)).count() == 0


def test_linked_sets_share_a_cell_and_pass_the_bound():
    """Also when every set leaves out as many of its cells as it may, in an order that all sets share."""
    rng = np.random.default_rng(4)
    tried = 0
    for _ in range(400):
        n = int(rng.integers(7, 300))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.08], rng.integers(0, 1 << 62, int(n * 0.07), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common) and len(a) != common:
            kept = []
            for s in (a, b):
                cells, parts = jaccard_join.cells(s)
                kept.append(set())
                for part, spare in parts:
                    mine = sorted(cells[cells % np.uint64(256) == part].tolist(), key=lambda c: (c >> 8) % 1009)
                    kept[-1] |= set(mine[spare:])
            assert kept[0] & kept[1]
            points = jaccard_join.folded([jaccard_join.point(a), jaccard_join.point(b)])
            assert jaccard_join.bounded(len(a), points[0], len(b), points[1])
            tried += 1
    assert tried > 50


def test_points_cut_and_folded_still_bound():
    same = np.arange(0, 64 * 3000, 64, dtype=np.uint64)  # one group of every point up to 64 groups holds all
    points = jaccard_join.folded([jaccard_join.point(same), jaccard_join.point(same[:2800])])
    cut = min(3000 - points[0].sum(), 2800 - points[1].sum())
    assert jaccard_join.bounded(3000, points[0], 2800, points[1], cut=cut)
    sizes = np.full(40, 3000)
    i, j = jaccard_join.tree_join(sizes, np.repeat(points[:1], 40, axis=0))
    assert len(i) == 40 * 39 // 2


def test_tree_join_loses_no_pair():
    rng = np.random.default_rng(6)
    points = rng.poisson(rng.choice([1, 3, 9], (120, 1)), (120, 16)).astype(np.int32)
    sizes = points.sum(axis=1)
    i, j = jaccard_join.tree_join(sizes, points)
    want = {(a, b) for a in range(120) for b in range(a + 1, 120) if np.minimum(points[a], points[b]).sum() >= jaccard_join.least_common(sizes[a] + sizes[b])}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_shared_cells_over_batches():
    rng = np.random.default_rng(1)
    rows = sorted(zip(rng.integers(0, 60, 300).tolist(), rng.integers(0, 20, 300).tolist()))
    want = set()
    for c in {c for c, _ in rows}:
        nodes = {v for x, v in rows if x == c}
        if len(nodes) > 1:
            want |= {(c, v, min(nodes)) for v in nodes}
    captured = {}

    class Rows:
        def __getattr__(self, name):
            return lambda *a, **k: captured.update(run=a[0]) if name == "mapInArrow" else self

    components.shared_cells(Rows())
    for size in (1, 2, 3, 7, 300):
        batches = (pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows[a : a + size]]), pa.array([v for _, v in rows[a : a + size]])], names=["cell", "node"]) for a in range(0, len(rows), size))
        got = [tuple(r.values()) for b in captured["run"](batches) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.label for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_groups_come_whole_over_batches():
    rng = np.random.default_rng(3)
    keys = sorted(zip(rng.integers(0, 6, 200).tolist(), rng.integers(0, 2, 200).tolist(), rng.integers(2, 4, 200).tolist()))
    table = pa.table({**{c: [k[n] for k in keys] for n, c in enumerate(("cell", "i", "j"))}, "row": list(range(200))})
    for size, least in ((1, 5), (7, 1), (50, 30), (200, 1000)):
        rows, groups = [], []
        for part, bounds in components.whole_groups(iter(table.to_batches(max_chunksize=size)), least):
            rows += part["row"].to_pylist()
            groups += [{(part["cell"][k].as_py(), part["i"][k].as_py(), part["j"][k].as_py()) for k in range(a, b)} for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        assert rows == list(range(200)) and all(len(g) == 1 for g in groups)
        assert len(groups) == len(set(keys)) == len({k for g in groups for k in g})


def test_forest_connects_what_the_pairs_connect():
    rng = np.random.default_rng(2)
    for _ in range(50):
        label = rng.integers(0, 12, 30)
        x, y = rng.integers(0, 30, 40) + 5, rng.integers(0, 30, 40) + 5
        tree = components.forest_of(x, y, label, 5)
        ends = [sorted({int(v) for v in label})] * 2

        def joined(pairs):
            return closed(ends[0], lambda a, b: any({a, b} == {int(label[p - 5]), int(label[q - 5])} for p, q in pairs))

        assert joined(list(zip(x, y))) == joined(list(zip(x[tree], y[tree]))) and len(tree) < len(ends[0])


def test_large_component_meets_only_the_rest(spark, monkeypatch):
    """A cell of one large component and few other nodes is dealt in proportion to its nodes, and each pair of different components meets."""
    monkeypatch.setattr(components, "CHUNK", 8)
    for large, rest in ((400, 5), (40, 30), (6, 2), (1, 30)):
        label = {node: 1 if node <= large else node for node in range(1, large + rest + 1)}
        n = len(label)
        rows = spark.createDataFrame([(7, node, of, n) for node, of in label.items()], "cell bigint, node bigint, label bigint, n bigint")
        groups = {}
        dealt = components._dealt(rows).collect()
        for r in dealt:
            groups.setdefault((r.cell, r.i, r.j), []).append(r)
        met = {frozenset((a.node, b.node)) for (_, i, j), g in groups.items() for a in g for b in g if a.node < b.node and (i == j or a.chunk != b.chunk)}
        assert met >= {frozenset((a, b)) for a in label for b in label if label[a] != label[b]}
        assert len(dealt) <= 2 * n + 2 * rest * (n // 8 + 2)
