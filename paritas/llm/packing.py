"""Pattern packing: sequences of at most ``length`` tokens, planned on the histogram of piece lengths.

Documents are tokenised and cut: only longer ones, into pieces of ``length`` tokens, of which the first may be shorter. Their
lengths make a histogram of at most ``length`` entries. The plan is made on it alone, so it costs the same for any corpus:

1. patterns of one, two or three lengths (in steps of ``STEP`` tokens) that fill a sequence are enumerated;
2. non-negative least squares fits how often each repeats, so that together they use up the histogram;
3. repeats are rounded down to what the histogram has;
4. what is left is packed by best fit, longest first, on the histogram too (any number of documents a sequence).

Pieces of one length are interchangeable: each gets its rank among them (ranks are counted in shards, so a very
common length is no single task), and the plan says which sequence holds the rank.

Defined results: null and empty texts are one piece, the end id alone; repeated rows are packed one by one; an
empty table gives an empty result; only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paritas.llm.common import stored, text_of
from paritas.llm.tokens import ByteEncoder, once_per_worker, text_groups

LENGTH, STEP, SHORT = 2048, 4, 128
VOCABULARY, END = "byte_bpe_50k.json", 0
PER_SHARD = 50_000


def cut_points(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, after a shorter first one if n is no multiple."""
    head = n % length
    starts = ([0] if head else []) + list(range(head, n, length))
    return [(s, (head if s == 0 and head else length)) for s in starts]


def _pieces(vocabulary: str, end: int, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = once_per_worker(f"bytes:{vocabulary}", lambda: ByteEncoder(public_tokenizers.path(vocabulary)))
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            ids, fps = batch.column("doc_id"), batch.column("fp").to_pylist()
            texts = batch.column("text").to_pylist()
            for first, group in text_groups(texts):
                rows = []
                for i, encoded in enumerate(map(encoder.encode, group), first):
                    encoded += tail
                    for k, (start, size) in enumerate(cut_points(len(encoded) // 4, length)):
                        part = encoded[4 * start:4 * (start + size)]
                        rows.append((i, fps[i], k, start, size, zlib.crc32(part), part if with_ids else None))
                index, fp, piece, start, size, crc, parts = map(list, zip(*rows, strict=True))
                columns = [ids.take(pa.array(index)), pa.array(fp, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names = ["doc_id", "fp", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[:len(columns)])
    return run


def tokenised(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, fp, piece, start, length, ids_crc32 (and ids) of every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = text_of(F.col("text"))
    schema = f"doc_id {kind}, fp bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.xxhash64(text).alias("fp"), text.alias("text")).mapInArrow(_pieces(vocabulary, end, length, with_ids), schema)


def patterns(units: int, least: int) -> np.ndarray:
    """Rows of three non-increasing lengths in units, 0 for none, that add up to ``units``; none shorter than ``least``."""
    found = [(units, 0, 0)]
    for a in range(units - least, 0, -1):
        rest = units - a
        if rest <= a:
            found.append((a, rest, 0))
        found += [(a, b, rest - b) for b in range(min(a, rest - least), (rest + 1) // 2 - 1, -1)]
    return np.array(found)


def fit(columns: np.ndarray, counts: np.ndarray, steps: int = 3000) -> np.ndarray:
    """Non-negative least squares by an active set: x >= 0 with the least |A x - counts|.

    A's columns count the lengths of each pattern; ``columns`` has their indices. Each step frees the pattern with the steepest descent
    and solves for the free ones, going back to the border where a value would turn negative.
    """
    n, size = len(columns), len(counts)
    scale = max(float(counts.max(initial=0)), 1.0)
    target = counts / scale
    x, free = np.zeros(n), []
    matrix = np.zeros((size, 0))

    def column(j: int) -> np.ndarray:
        out = np.zeros(size)
        np.add.at(out, columns[j], 1.0)
        out[0] = 0.0
        return out

    for _ in range(steps):
        rest = target - (matrix @ x[free] if free else 0.0)
        rest[0] = 0.0
        slope = rest[columns].sum(axis=1)
        slope[free] = -np.inf
        best = int(np.argmax(slope))
        if not slope[best] > 1e-5:
            break
        free.append(best)
        matrix = np.column_stack([matrix, column(best)])
        while True:
            gram = matrix.T @ matrix
            value = np.linalg.solve(gram + 1e-10 * np.eye(len(free)), matrix.T @ target)
            if value.min() > 0:
                x[free] = value
                break
            old = x[free]
            falling = value <= 0
            share = np.min(old[falling] / np.maximum(old[falling] - value[falling], 1e-300))
            now = old + share * (value - old)
            x[free] = np.maximum(now, 0.0)
            keep = ~(falling & (now <= 1e-12))
            x[np.array(free)[~keep]] = 0.0
            free = [j for j, k in zip(free, keep, strict=True) if k]
            matrix = matrix[:, keep]
            if not free:
                break
    return x * scale


def best_fit(counts: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use up ``counts``: longest first, into the fullest sequences that still have room."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in groups if r >= size and groups[r]), default=None)
            if room is None:
                groups[length - size].append(((size,), left))
                break
            held, repeats = groups[room].pop()
            used = min(repeats, left)
            if used < repeats:
                groups[room].append((held, repeats - used))
            groups[room - size].append(((*held, size), used))
            left -= used
    return [x for room in groups for x in groups[room] if x[1]]


def plan(histogram: dict[int, int], length: int = LENGTH, step: int = STEP, short: int = SHORT) -> list[tuple[tuple[int, ...], int]]:
    """(exact lengths, repeats) of sequences that hold every piece of the histogram once."""
    left = dict(histogram)
    out = []
    if left.get(length):
        out.append(((length,), left.pop(length)))
    units = length // step
    by_unit: dict[int, list[int]] = defaultdict(list)  # lengths of a unit, longest first
    for size in sorted(left, reverse=True):
        if size >= short:
            by_unit[-(-size // step)].append(size)
    counts = np.zeros(units + 1)
    for unit, sizes in by_unit.items():
        counts[unit] = sum(left[s] for s in sizes)
    columns = patterns(units, max(1, short // step))
    columns = columns[((counts[columns] > 0) | (columns == 0)).all(axis=1)]
    if len(columns):
        repeats = fit(columns, counts)
        for j in np.argsort(-repeats, kind="stable"):
            units_of = [int(u) for u in columns[j] if u]
            need = {u: units_of.count(u) for u in units_of}
            times = min([int(repeats[j]), *(int(counts[u]) // k for u, k in need.items())])
            while times > 0:  # runs of exact lengths, each slot taking its longest first
                taken, heads = [], defaultdict(int)
                for u in units_of:
                    taken.append(by_unit[u][0])
                    heads[by_unit[u][0]] += 1
                run = min([times, *(left[s] // k for s, k in heads.items())])
                if run == 0:  # the last ones of a length: one sequence, slot by slot
                    taken, run = [], 1
                    for u in units_of:
                        size = by_unit[u][0]
                        taken.append(size)
                        left[size] -= 1
                        if not left[size]:
                            by_unit[u].pop(0)
                else:
                    for size, k in heads.items():
                        left[size] -= run * k
                    for u in need:
                        if not left[by_unit[u][0]]:
                            by_unit[u].pop(0)
                out.append((tuple(taken), run))
                times -= run
                for u, k in need.items():
                    counts[u] -= run * k
    return out + best_fit({s: n for s, n in left.items() if n}, length)


def slots(sequences: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset), in order of rank, each reaching to the next row's rank."""
    rows, ranks, base = defaultdict(list), defaultdict(int), 0
    for sizes, repeats in sequences:
        offset = 0
        for size in sizes:
            rows[size].append((ranks[size], base, offset))
            ranks[size] += repeats
            offset += size
        base += repeats
    return {size: np.array(x, np.int64) for size, x in rows.items()}


def _placed(table: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = table[int(size)]
                row = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
                sequence[at], offset[at] = row[:, 1] + ranks[at] - row[:, 0], row[:, 2]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def place(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` (doc_id, fp, piece, start, length, ids_crc32) with sequence_id and offset."""
    kind = pieces.schema["doc_id"].dataType.simpleString()
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= length rows
    shards = 1 + sum(histogram.values()) // PER_SHARD
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "fp", "piece"), F.lit(shards)))
    ahead = sharded.groupBy(F.col("length").alias("of_length"), F.col("shard").alias("of_shard")).agg(F.count("*").alias("n"))
    earlier = W.partitionBy("of_length").orderBy("of_shard").rowsBetween(W.unboundedPreceding, -1)
    ahead = ahead.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    order = W.partitionBy("length", "shard").orderBy("doc_id", "fp", "piece")
    ranked = sharded.withColumn("own", F.row_number().over(order) - 1).join(
        ahead, (F.col("length") == F.col("of_length")) & (F.col("shard") == F.col("of_shard")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("ahead") + F.col("own")).alias("rank"))
    return ranked.mapInArrow(_placed(slots(plan(histogram, length))), f"doc_id {kind}, piece int, start bigint, length bigint, "
                             "ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    return place(stored(tokenised(docs, length, vocabulary, end), "pieces"), length)


def sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """sequence_id, ids, ends: the packed token sequences themselves, and where each piece in them ends."""
    pieces = stored(tokenised(docs, length, vocabulary, end, with_ids=True), "pieces")
    placed = place(pieces.drop("ids"), length)
    tokens = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "ids").dropDuplicates(["doc_id", "piece", "length", "ids_crc32"])
    keys = ["piece", "start", "length", "ids_crc32"]
    renamed = tokens.select(*[F.col(c).alias(f"t_{c}") for c in ("doc_id", *keys)], "ids")
    joined = placed.join(renamed, [F.col("doc_id").eqNullSafe(F.col("t_doc_id")), *[F.col(c) == F.col(f"t_{c}") for c in keys]])
    held = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return joined.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", F.flatten(F.col("held.ids")).alias("ids"),
        F.transform("held", lambda x: x["offset"] + x["length"]).alias("ends"))
