"""The cells that near lines meet in: no link is lost, and a line has few."""

import random

import numpy as np
import pytest
from test_joins import edit_distance, edited, some_lines

from patronlens.llm import line_dedup


def test_lines_near_at_all_lengths_share_a_cell():
    """Pairs with as many edits as the shorter line allows, at the edges of bands and groups of lengths, moved to one side too."""
    rng = random.Random(31)
    edges = {n for low, end, _ in line_dedup.length_groups(line_dedup.BANDS, 700) for n in (low, low + 1, end - 1)}
    pairs = []
    for n in sorted(edges):
        base = "".join(rng.choices("abcdefgh é", k=n))
        most = int(line_dedup.edits_for(np.array([n]), line_dedup.BANDS)[0])
        others = [edited(rng, base, most) for _ in range(12)]
        for k in range(most + 1):
            others += ["z" * k + base[: n - (most - k)], base[most - k :] + "z" * k, "z" * k + base + "z" * (most - k)]
            cut = rng.randrange(n)
            others.append(base[:cut] + "z" * k + base[cut:])
        pairs += [(base, x) for x in others]
    lines = list(dict.fromkeys(x for pair in pairs for x in pair))
    owner, cell = line_dedup.line_cells(lines, line_dedup.BANDS)
    cells = {line: set() for line in lines}
    for o, c in zip(owner.tolist(), cell.tolist()):
        cells[lines[o]].add(c)
    tried = 0
    for (a, b), near in zip(pairs, line_dedup.linked(*map(list, zip(*pairs)), line_dedup.BANDS)):
        if near:
            assert cells[a] & cells[b], (a, b)
            tried += 1
    assert tried > 300


@pytest.mark.parametrize("edits", [1, 2, 3, 4, 6])
def test_short_lines_with_any_edits_share_a_cell(edits):
    lines = ["", "a", "ab", "abc", "bc", *some_lines(23, 12)] + [x[:n] for n, x in enumerate(some_lines(24, 8))]
    owner, cell = line_dedup.line_cells(lines, edits)
    cells = [set(cell[owner == i].tolist()) for i in range(len(lines))]
    for i, a in enumerate(lines):
        for j in range(i):
            if a != lines[j] and edit_distance(a, lines[j]) <= edits:
                assert cells[i] & cells[j]


@pytest.mark.parametrize(("length", "most"), [(30, 3), (150, 5), (300, 7), (450, 10), (3000, 10)])
def test_a_line_has_few_cells(length, most):
    """About as many as it has segments: 4, 12, 26 and 49 when each length had cells of its own."""
    rng = random.Random(length)
    lines = ["".join(rng.choices("abcdefgh é", k=length + k)) for k in range(length // 10)]
    owner, _ = line_dedup.line_cells(lines, line_dedup.BANDS)
    assert len(owner) <= most * len(lines)
