"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import stored

MOST_ROUNDS = 100


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of the
    edges ``a``, ``b`` (longs; loops and repeats allowed).

    Each round deals the edges, larger node first, by that node. A task replaces its edges
    by a star around the smallest node of each of their components, which joins the smaller
    neighbours of every node; then every edge jumps from its smaller node to that node's own
    smallest one. A node has few smaller neighbours, as repeats go; a smallest node may be
    shared by any number of edges, which only the join sees, and Spark splits that side. Rounds
    grow with the logarithm of the longest path, and each is written, which cuts lineage."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before = None
    for step in range(MOST_ROUNDS):
        starred = pairs.repartition("a").mapInArrow(_stars, "a bigint, b bigint, own boolean")
        starred = stored(starred, folder, f"{name}-star{step}")
        parents = starred.where("own").select(F.col("a").alias("b"), F.col("b").alias("up"))
        jumped = starred.join(parents, "b", "left").select("a", F.coalesce("up", "b").alias("b"))
        pairs = stored(jumped, folder, f"{name}-jump{step}")
        after = _mark(pairs)
        if after == before:
            # every edge now ends at a root, so each node but the roots has just one
            inner = pairs.where("a <> b").select(F.col("a").alias("node"), F.col("b").alias("root"))
            return inner.unionAll(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = after
    raise RuntimeError("components did not settle")


def _mark(pairs: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("mark")
    return tuple(pairs.agg(F.count("*").alias("n"), mark).first())


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one task as stars. ``own`` marks nodes that were dealt here as the larger
    end; each such node is dealt to one task only."""
    ends = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not ends:
        return
    a, b = (np.concatenate(c) for c in zip(*ends, strict=True))
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    up, down = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        # nodes are sorted, so the smallest number is the smallest node
        least = np.minimum(root[up], root[down])
        following = root.copy()
        np.minimum.at(following, root[up], least)
        np.minimum.at(following, root[down], least)
        following = np.minimum(following, following[following])
        if (following == root).all():
            break
        root = following
    owned = np.zeros(len(nodes), bool)
    owned[up[a > b]] = True
    inner = np.flatnonzero(root != np.arange(len(nodes)))
    loops = np.setdiff1d(up, np.concatenate([inner, root[inner]]))
    rows = np.concatenate([inner, loops])
    columns = [pa.array(nodes[rows]), pa.array(nodes[root[rows]]), pa.array(owned[rows])]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "own"])
