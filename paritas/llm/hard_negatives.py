"""Hard negatives by exact integer products: Strassen tiles, then mergeable heaps of positives and of score windows.

Every component x becomes ``floor(scale * x)``. Anchors meet all rows in cells of one block of anchors and one block
of candidates; a cell multiplies tile by tile with Strassen's recursion on int64 matrices, padded with zeros to sizes
that halve. Integer sums and products wrap alike in every order, so a score that fits 64 bits is exact. Two rounds
keep heaps that merge in any order (the first k of the union of two heaps is the heap of both): first an anchor's k
best rows of its own label, the positives; then, for each of them, the k best rows of other labels whose score lies
in the window ``[low% of the positive's score, the positive's score]``.

Blocks are dealt by a hash of the row, so no label and no id gathers in one of them; a cell holds at most about
``ANCHORS`` and ``CANDIDATES`` rows, and only heaps leave it.

Defined results: rows with a null label, a null vector or any null or non-finite component take no part; rows equal
in id, label and quantised vector are one row; a null id is never an anchor and comes last among ties; missing components of shorter vectors count as zero; a vector whose squared quantised length
reaches 2^62 ends the job with an error, as its scores might not fit 64 bits; no anchors or no rows give no result.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paritas.llm.common import stored

SCALE, HEAP, LOW = 256, 5, 80
ANCHORS, CANDIDATES, TILE, LEAF = 8192, 2048, 512, 16
WIDEST = 2.0**62
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The exact product of two int64 matrices (modulo 2^64)."""
    (m, k), n, halvings = a.shape, b.shape[1], 0
    while min(m, k, n) >> halvings > leaf:
        halvings += 1
    unit = 1 << halvings
    return _halved(_padded(a, unit), _padded(b.T, unit).T, halvings)[:m, :n]


def _padded(x: np.ndarray, unit: int) -> np.ndarray:
    return np.pad(x, [(0, -size % unit) for size in x.shape])


def _halved(a: np.ndarray, b: np.ndarray, halvings: int) -> np.ndarray:
    if not halvings:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    nw, ne, sw, se = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b_nw, b_ne, b_sw, b_se = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out, below = np.empty((2 * m, 2 * n), np.int64), halvings - 1
    corner_nw, corner_ne, corner_sw, corner_se = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    with np.errstate(over="ignore"):
        p = _halved(nw + se, b_nw + b_se, below)
        corner_nw[...] = p
        corner_se[...] = p
        p = _halved(sw + se, b_nw, below)
        corner_sw[...] = p
        corner_se -= p
        p = _halved(nw, b_ne - b_se, below)
        corner_ne[...] = p
        corner_se += p
        p = _halved(se, b_sw - b_nw, below)
        corner_nw += p
        corner_sw += p
        p = _halved(nw + ne, b_se, below)
        corner_nw -= p
        corner_ne += p
        corner_se += _halved(sw - nw, b_nw + b_ne, below)
        corner_nw += _halved(ne - se, b_sw + b_se, below)
    return out


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component; null for a vector with a null or non-finite one."""
    number = F.transform(vector, lambda x: x.cast("double"))
    whole = F.transform(number, lambda x: F.floor(x * scale))
    length = F.aggregate(number, F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_long = F.raise_error(F.lit("a vector is too long for scores of 64 bits")).cast("array<bigint>")
    return F.when(vector.isNotNull() & finite, F.when(length < WIDEST, whole).otherwise(too_long))


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = vectors.combine_chunks()
    lengths = np.asarray(lists.value_lengths())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores but ``NONE``, the greatest first, ties in the order they stand in."""
    at = np.flatnonzero(scores != NONE)
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    return at[np.argsort(-scores[at], kind="stable")][:k]


def _cell(heaps: Callable, names: list[str]):
    """A cell's anchors and candidates -> ids and fingerprints of both, with what ``heaps`` says of them, tile by tile."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = [np.empty((0, len(names) - 2), np.int64)]
        if anchors.num_rows and candidates.num_rows:
            candidates = candidates.sort_by([("id", "ascending"), ("fp", "ascending")])  # nulls come last
            widest = max(np.asarray(t["vector"].combine_chunks().value_lengths()).max() for t in (anchors, candidates))
            across, labels = _matrix(candidates["vector"], widest).T, candidates["label"].to_numpy()
            places = dict(zip(zip(candidates["id"].to_pylist(), candidates["fp"].to_pylist()), range(candidates.num_rows)))
            for begin in range(0, anchors.num_rows, TILE):
                tile = anchors.slice(begin, TILE)
                own = [places.get(key, -1) for key in zip(tile["id"].to_pylist(), tile["fp"].to_pylist())]
                rows = heaps(tile, labels, own, strassen(_matrix(tile["vector"], widest), across))
                if rows:
                    found.append(np.array(rows, np.int64) + ([begin] + [0] * (len(names) - 3)))
        at, *places, other, score = np.concatenate(found).T
        columns = [anchors["id"].take(pa.array(at)), anchors["fp"].take(pa.array(at)), *map(pa.array, places),
                   candidates["id"].take(pa.array(other)), candidates["fp"].take(pa.array(other)), pa.array(score)]
        return pa.table(dict(zip(names, columns)))
    return run


def _positives(k: int) -> Callable:
    def heaps(tile: pa.Table, labels: np.ndarray, own: list[int], scores: np.ndarray) -> list[tuple]:
        out = []
        for i, (row, label) in enumerate(zip(scores, tile["label"].to_numpy())):
            likely = labels == label
            if own[i] >= 0:
                likely[own[i]] = False
            out += [(i, j, row[j]) for j in _best(np.where(likely, row, NONE), k)]
        return out
    return heaps


def _windows(k: int, low: int) -> Callable:
    def heaps(tile: pa.Table, labels: np.ndarray, own: list[int], scores: np.ndarray) -> list[tuple]:
        out = []
        for i, (row, label, tops) in enumerate(zip(scores, tile["label"].to_numpy(), tile["tops"].to_pylist())):
            others = labels != label
            for place, top in enumerate(tops):
                inside = others & (row >= -(-low * top // 100)) & (row <= top)
                out += [(i, place, j, row[j]) for j in _best(np.where(inside, row, NONE), k)]
        return out
    return heaps


def _met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, heaps: Callable, names: list[str]) -> DataFrame:
    """``heaps`` over all cells; anchors and rows are copied to the cells of their block."""
    a_blocks, r_blocks = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))
    block = lambda n: F.pmod(F.xxhash64("fp", "id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"i": block(a_blocks), "j": every(r_blocks)}).groupBy("i", "j")
    right = rows.withColumns({"j": block(r_blocks), "i": every(a_blocks)}).groupBy("i", "j")
    return left.cogroup(right).applyInArrow(_cell(heaps, names), ", ".join(f"{n} bigint" for n in names))


def mine(vectors: DataFrame, is_anchor: Column, scale: int = SCALE, k: int = HEAP, low: int = LOW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``vectors(vec_id, label, embedding)``.

    ``is_anchor`` is a condition on those columns. ``k`` is the size of both heaps, ``low`` the window's lower end in percent.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                          quantised(F.col("embedding"), scale).alias("vector"), (F.col("vec_id").isNotNull() & F.coalesce(is_anchor, F.lit(False))).alias("anchors"))
    rows = rows.where("label IS NOT NULL AND vector IS NOT NULL").groupBy("id", "label", "vector").agg(F.bool_or("anchors").alias("anchors"))
    rows = stored(rows.withColumn("fp", F.xxhash64("label", "vector")), "negative-rows")
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if("anchors")).first()
    columns = ["id", "label", "vector", "fp"]
    anchors = rows.where("anchors").select(*columns)
    candidates = rows.select(*[F.col(c).alias(c) for c in columns])  # columns of their own: both sides of a cell come from one table

    heap = _met(anchors, candidates, n_anchors, n_rows, _positives(k), ["anchor_id", "anchor_fp", "positive_id", "positive_fp", "positive_score"])
    order = [F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), "positive_fp"]
    best = heap.withColumn("place", F.row_number().over(W.partitionBy("anchor_id", "anchor_fp").orderBy(*order)) - 1).where(F.col("place") < k)
    best = stored(best, "positives")

    tops = best.groupBy(F.col("anchor_id").alias("of_id"), F.col("anchor_fp").alias("of_fp")).agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("tops"))
    asking = anchors.join(tops, (F.col("id") == F.col("of_id")) & (F.col("fp") == F.col("of_fp"))) \
        .select("id", "label", "vector", "fp", F.transform("tops", lambda t: t["positive_score"]).alias("tops"))
    heap = _met(asking, candidates, n_anchors, n_rows, _windows(k, low), ["of_id", "of_fp", "of_place", "negative_id", "negative_fp", "negative_score"])
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), "negative_fp"]
    chosen = heap.withColumn("rank", F.row_number().over(W.partitionBy("of_id", "of_fp", "of_place").orderBy(*order))).where(F.col("rank") <= k)
    same = (F.col("anchor_id") == F.col("of_id")) & (F.col("anchor_fp") == F.col("of_fp")) & (F.col("place") == F.col("of_place"))
    return best.join(chosen, same).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
