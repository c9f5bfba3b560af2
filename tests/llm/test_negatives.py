"""Hard negatives, against scoring of all pairs."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from depotlens.llm import negatives
from depotlens.llm.storage import fresh_folder


def by_hand(rows, every=5):
    """Every anchor against every row, in Python integers."""
    valid = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid.append((i, label, [math.floor(256 * Fraction(x)) for x in v]))
    out = []
    for i, label, v in valid:
        if i % every:
            continue
        met = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, c) for j, c, w in valid if j != i and len(w) == len(v))
        for minus, j, _ in [m for m in met if m[2] == label][: negatives.POSITIVES]:
            band = [m for m in met if m[2] != label and -50 * minus <= -100 * m[0] <= -95 * minus]
            out += [(i, j, rank, m[1], -minus, -m[0]) for rank, m in enumerate(band[: negatives.NEGATIVES], 1)]
    return sorted(out)


def mined(spark, rows, every=5, kind="float"):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"id bigint, label int, v array<{kind}>, row string, part int")
    return sorted(tuple(r) for r in negatives.mine(frame, fresh_folder(spark, "negatives"), every).collect())


def vectors(seed, n, dim, labels=4, near=0.0):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(labels, dim))
    label = pick.integers(0, labels, n)
    x = pick.normal(size=(n, dim)) * (1 - near) + centres[label] * near
    return [(i, int(c), [float(np.float32(a)) for a in v]) for i, (c, v) in enumerate(zip(label, x, strict=True))]


@pytest.mark.parametrize("seed, n, dim, near", [(1, 300, 8, 0.0), (2, 300, 16, 0.7), (3, 200, 2, 0.5), (4, 60, 1, 0.2)])
def test_all_pairs(spark, monkeypatch, seed, n, dim, near):
    monkeypatch.setattr(negatives, "SAMPLE", 50)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 40 * (8 * dim + 16))
    monkeypatch.setattr(negatives, "GROUP", 12)
    monkeypatch.setattr(negatives, "STRIP", 7)
    rows = vectors(seed, n, dim, near=near)
    found = mined(spark, rows)
    assert found == by_hand(rows)
    assert found


def test_nulls_lengths_repeats_and_copies(spark):
    rows = vectors(5, 80, 4, near=0.6)
    rows += [(None, 1, [1.0] * 4), (100, None, [1.0] * 4), (105, 1, None), (110, 1, [1.0, None, 1.0, 1.0])]
    rows += [(115, 1, [math.nan] * 4), (120, 2, [math.inf] * 4), (125, 1, []), (130, 2, []), (135, 1, [1.0, 2.0]), (136, 2, [0.5, 1.2])]
    rows += [(5, 3, rows[5][2]), rows[10], rows[10], (140, 1, [0.0] * 4), (141, 2, [0.0] * 4), (-5, 1, rows[15][2])]
    rows += [(1000 + k, 1, [0.5, 0.25, -0.5, 1.0]) for k in range(60)] + [(2000, 2, [0.4, 0.2, -0.4, 0.8])] * 12
    assert mined(spark, rows) == by_hand(rows)


def test_own_id_many_times(spark):
    """Rows of the anchor's id are left out, however many stand before the others."""
    same = [1.0, 0.5]
    rows = [(5, 1, same)] * 30 + [(k, 1, same) for k in range(6, 30)] + [(k, 2, [0.7, 0.4]) for k in range(40, 44)]
    assert mined(spark, rows) == by_hand(rows)


def test_large_components(spark):
    """Beyond 2^24, 2^53 and 2^63: exact scores, the nearest long where none holds them."""
    for size in (1e6, 1e9, 1e16):
        rows = [(i, c, [x * size for x in v]) for i, c, v in vectors(6, 60, 3, near=0.5)]
        found = mined(spark, rows, kind="double")
        exact = [(*r[:4], *(max(-(2**63), min(2**63 - 1, s)) for s in r[4:])) for r in by_hand(rows)]
        assert found == sorted(exact) and found
    huge = [(5, 1, [1e300, 1e300]), (6, 1, [1e300, 0.0]), (7, 2, [6e299, 1.0]), (8, 2, [1.7e308, 1.0]), (9, 2, [1e308, -1e308])]
    assert [r[:4] for r in mined(spark, huge, kind="double")] == [r[:4] for r in by_hand([h for h in huge if h[0] < 8])]


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []


def test_certified_termination_spares_products():
    """Rows that lie apart are neither read nor multiplied, and nothing is lost."""
    pick = np.random.default_rng(7)
    centres = np.eye(16)[:8]
    v = np.concatenate([256 * (c + 0.05 * pick.normal(size=(2000, 16))) for c in centres]).astype(np.int64).astype(float)
    ids, labels = np.arange(len(v)), np.arange(len(v)) % 3
    blocks = [negatives.Block.build(ids[k : k + 2000], labels[k : k + 2000], v[k : k + 2000]) for k in range(0, len(v), 2000)]
    summaries = negatives.Summaries(
        [str(k) for k in range(8)], np.stack([b.mean for b in blocks]), np.array([b.width for b in blocks]), np.array([b.norm for b in blocks])
    )
    anchors, stats = np.arange(0, 2000, 50), {}
    found = negatives.mined(
        ids[anchors], labels[anchors], v[anchors], summaries, lambda name: (blocks[int(name)].ids, blocks[int(name)].labels, blocks[int(name)].values), stats
    )
    assert stats["blocks"] == 2 and stats["products"] < len(anchors) * 2 * 2000
    scores = v[anchors] @ v.T
    for k, anchor in enumerate(anchors):
        mine = [r for r in found if r[0] == anchor]
        order = np.lexsort((ids, -scores[k]))
        first = [j for j in order if labels[j] == labels[anchor] and j != anchor][:5]
        assert sorted({r[1] for r in mine}) == sorted({j for j in first if any(labels[m] != labels[anchor] and 50 * scores[k, j] <= 100 * scores[k, m] <= 95 * scores[k, j] for m in order)})


def test_kept_copies():
    ids = np.array([3, 1, 1, 1, 1, 1, 1, 2, 9, 8, 7, 6, 5, 4, 1])
    labels = np.array([0] * 14 + [1])
    values = np.ones((15, 2))
    kept = negatives.kept_copies(ids, labels, values)
    assert sorted(ids[kept].tolist()) == [1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6]
