"""Near-duplicate vectors: a forest of random-projection trees with spill overlap, leaves compared, links unioned.

Rows with equal vectors are one class, of which the representative goes on. In each tree a node draws a random
direction and splits its vectors at a threshold of their projections; vectors within ``SPILL`` of the threshold go to
both sides, so a near pair is seldom torn apart, and several trees leave hardly any pair unseen. Thresholds are
fitted on a bounded sample of the node (``SAMPLE`` rows); every row is indexed. Nodes that still hold more than
``LEAF`` rows after ``LEVELS`` levels are split again in the next round, with a new sample, until all are leaves. A node
that no threshold divides (a dense ball) is a leaf of any size, compared in blocks of ``LEAF`` rows, pair of blocks by pair
of blocks, so it costs the square of its members but never leaves memory bounds and loses no link.

In a leaf all pairs are compared by cosine in double precision. No pair is written: a pair belongs to the first leaf
that its two vectors share, which counts it for both; what leaves a leaf is a count for each vector and a star of edges
for each local group. Components of the stars are the groups.

Defined results: null, empty and zero vectors and those with a null or non-finite component link with nothing; vectors of
different lengths do not link; repeated rows and rows with equal vectors are linked copies; classes under one least id
are one node; a null id counts as the greatest (a null component only for a component of nothing but null ids); an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import stored
from paritas.llm.graph import components

COSINE, TREES, LEVELS, ROUNDS = 0.95, 6, 7, 7
LEAF, SAMPLE = 1024, 8192
#: Half the distance of a pair at the limit, as the projection on a random direction shows it on average.
SPILL = 0.5
QUANTILES = (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9)
#: A split must leave at most this share of the node's pairs of vectors.
WORTH = 0.82
NODE, NO_ID = ["dim", "tree", "node"], (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Has a direction: finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@cache
def _direction(dim: int, tree: int, node: int, path: int) -> np.ndarray:
    x = np.random.default_rng([dim, tree, node, path]).standard_normal(dim)
    return x / np.linalg.norm(x)


def _margin(dim: int, cosine: float) -> float:
    return SPILL * np.sqrt((2 - 2 * cosine) / dim)


def fit(x: np.ndarray, dim: int, tree: int, node: int, rows: int, margin: float, leaf: int, levels: int) -> np.ndarray:
    """Thresholds of a subtree by heap place (root 1), NaN where it does not split; ``x`` samples the node's ``rows``."""
    out, stack = np.full(1 << levels, np.nan), [(1, np.arange(len(x)))]
    while stack:
        path, at = stack.pop()
        n = len(at)
        if path >= 1 << levels or n * rows <= leaf * len(x) or n < 16:
            continue
        place = x[at] @ _direction(dim, tree, node, path)
        cuts = np.quantile(place, QUANTILES)
        ordered = np.sort(place)
        left = np.searchsorted(ordered, cuts + margin, "right")
        right = n - np.searchsorted(ordered, cuts - margin, "left")
        pairs = left.astype(float) ** 2 + right.astype(float) ** 2
        best = int(np.argmin(pairs))
        if pairs[best] <= WORTH * n * n:
            out[path] = cuts[best]
            stack += [(2 * path, at[place <= cuts[best] + margin]), (2 * path + 1, at[place >= cuts[best] - margin])]
    return out


def route(x: np.ndarray, dim: int, tree: int, node: int, thresholds: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the heap places of the leaves they fall into; a row near a threshold falls into several."""
    rows, paths, stack = [], [], [(1, np.arange(len(x)))]
    while stack:
        path, at = stack.pop()
        if not len(at):
            continue
        if path >= len(thresholds) or np.isnan(thresholds[path]):
            rows.append(at)
            paths.append(np.full(len(at), path))
            continue
        place = x[at] @ _direction(dim, tree, node, path)
        stack += [(2 * path, at[place <= thresholds[path] + margin]), (2 * path + 1, at[place >= thresholds[path] - margin])]
    return np.concatenate(rows), np.concatenate(paths)


def _fitted(cosine: float, leaf: int, levels: int):
    def run(sample: pa.Table) -> pa.Table:
        dim, tree, node, rows = (sample[c][0].as_py() for c in (*NODE, "n"))
        found = fit(_units(sample["embedding"], dim), dim, tree, node, rows, _margin(dim, cosine), leaf, levels)
        return pa.table({"dim": [dim], "tree": [tree], "node": [node], "thresholds": [found.tolist()]},
                        pa.schema([(c, pa.int64()) for c in NODE] + [("thresholds", pa.list_(pa.float64()))]))
    return run


def _routed(cosine: float, levels: int):
    names = [*NODE, "id", "fp"]

    def run(batches):
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in NODE], axis=1)
            _, first, group = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            for g, at in enumerate(first):
                dim, tree, node = map(int, keys[at])
                own = np.flatnonzero(group.ravel() == g)
                part = batch.take(pa.array(own))
                rows, paths = route(_units(part.column("embedding"), dim), dim, tree, node,
                                    np.array(batch.column("thresholds")[int(at)].as_py()), _margin(dim, cosine))
                kept = part.select(["dim", "tree", "id", "fp"]).take(pa.array(rows))
                below = pa.array(np.int64(node << (levels + 1)) + paths)
                yield pa.RecordBatch.from_arrays([kept.column("dim"), kept.column("tree"), below, kept.column("id"), kept.column("fp"),
                                                  pa.array(paths == 1)], names=[*names, "dense"])
    return run


def _leaves(classes: DataFrame, cosine: float, trees: int, leaf: int, levels: int) -> DataFrame:
    """dim, tree, node, id, fp: the leaves that every class falls into."""
    keys = ["id", "fp"]
    pending = stored(classes.select("dim", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)).cast("array<bigint>")).alias("tree"),
                                    F.lit(0).cast("bigint").alias("node"), *keys), "forest")
    done = []
    for turn in range(ROUNDS):
        sizes = pending.groupBy(*NODE).agg(F.count("*").alias("n"))
        large = stored(sizes.where(F.col("n") > leaf), "forest-large")
        if large.isEmpty():
            break
        done.append(pending.join(large, NODE, "left_anti"))
        rows = stored(pending.join(large, NODE).join(classes.select("dim", *keys, "embedding"), ["dim", *keys]), "forest-open")
        drawn = F.pmod(F.xxhash64("fp", "id", "tree", "node", F.lit(turn)), F.lit(1 << 30)) < F.lit(float(SAMPLE << 30)) / F.col("n")
        fits = stored(rows.where(drawn).select(*NODE, "n", "embedding").groupBy(*NODE).applyInArrow(
            _fitted(cosine, leaf, levels), "dim bigint, tree bigint, node bigint, thresholds array<double>"), "forest-fits")
        kinds = "dim bigint, tree bigint, node bigint, id bigint, fp bigint, dense boolean"
        routed = stored(rows.join(fits, NODE).select(*NODE, *keys, "embedding", "thresholds").mapInArrow(_routed(cosine, levels), kinds), "forest")
        done.append(routed.where("dense").drop("dense"))
        pending = routed.where("NOT dense").drop("dense")
    return reduce(DataFrame.unionAll, [*(d.select(*NODE, *keys) for d in done), pending.select(*NODE, *keys)])


def _groups(linked: np.ndarray) -> np.ndarray:
    """The least member of each row's connected group."""
    label, n = np.arange(len(linked)), len(linked)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compared(cosine: float):
    """A leaf, or two blocks of one -> rows with links: how many of them belong here, and their local group's least row."""

    def run(cell: pa.Table) -> pa.Table:
        kind = pa.schema([("id", pa.int64()), ("fp", pa.int64()), ("n_links", pa.int64()), ("root_id", pa.int64()), ("root_fp", pa.int64())])
        x, block = _units(cell["embedding"], cell["dim"][0].as_py()), cell["block"].to_numpy()
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        if cell["i"][0] != cell["j"][0]:
            linked &= block[:, None] != block[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        if not len(some):
            return kind.empty_table()
        linked, cell = linked[np.ix_(some, some)], cell.take(pa.array(some))
        groups = _groups(linked)
        earlier = cell["earlier"].combine_chunks()
        leaves, rows = earlier.flatten().to_numpy(), np.repeat(np.arange(len(some)), np.asarray(earlier.value_lengths()))
        order = np.argsort(leaves, kind="stable")
        for shared in np.split(rows[order], np.flatnonzero(np.diff(leaves[order])) + 1):
            linked[np.ix_(shared, shared)] = False  # met in an earlier leaf, and counted there
        counts = linked @ cell["size"].to_numpy()
        return pa.table([cell["id"], cell["fp"], pa.array(counts), cell["id"].take(pa.array(groups)), cell["fp"].take(pa.array(groups))], schema=kind)
    return run


def links(classes: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """id, fp, n_links, root_id, root_fp from all leaves for ``classes(id, fp, size, embedding, dim)``; edges as stars."""
    held = stored(_leaves(classes, cosine, trees, leaf, levels).withColumn("leaf", F.col("node") * trees + F.col("tree")).select("dim", "leaf", "id", "fp"), "leaves")
    lists = held.groupBy("id", "fp").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    rows = classes.join(lists, ["id", "fp"]).select("*", F.posexplode("leaves").alias("at", "leaf")) \
        .withColumn("earlier", F.slice("leaves", F.lit(1), F.col("at"))).drop("leaves", "at")
    blocks = held.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / leaf).cast("int").alias("blocks"))
    rows = rows.join(blocks, ["dim", "leaf"]).withColumn("block", F.pmod(F.xxhash64("id", "fp"), F.col("blocks")).cast("int"))
    cell = lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j"))
    cells = rows.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), cell))).select(
        "dim", "leaf", "cell.i", "cell.j", "block", "id", "fp", "size", "embedding", "earlier")
    return cells.groupBy("dim", "leaf", "i", "j").applyInArrow(
        _compared(cosine), "id bigint, fp bigint, n_links bigint, root_id bigint, root_fp bigint")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id for every row of ``vectors(vec_id, embedding)``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    good = rows.where(usable(F.col("embedding")))
    classes = good.groupBy("embedding").agg(F.min(F.coalesce("vec_id", F.lit(NO_ID))).alias("id"), F.count("*").alias("size"))
    classes = stored(classes.select("id", F.xxhash64("embedding").alias("fp"), "size", "embedding", F.size("embedding").cast("long").alias("dim")), "vectors")
    found = stored(links(classes, cosine, trees, leaf, levels), "vector-links")
    node = lambda id_, fp: F.struct(F.col(id_).alias("id"), F.col(fp).alias("fp"))
    comps = components(found.select(node("id", "fp").alias("u"), node("root_id", "root_fp").alias("v")))
    comps = comps.select("node.id", "node.fp", F.col("component.id").alias("component_id"))
    counts = found.groupBy("id", "fp").agg(F.sum("n_links").alias("n_links"))
    labelled = classes.join(counts, ["id", "fp"], "left").join(comps, ["id", "fp"], "left").select(
        F.col("embedding").alias("of"), (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    known = good.join(labelled, F.col("embedding") == F.col("of")).select("vec_id", "n_links", F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))
    return known.unionAll(rows.where(~usable(F.col("embedding"))).select("vec_id", F.lit(0).cast("long"), "vec_id"))
