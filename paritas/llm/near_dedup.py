"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped edges.

A document's set holds the distinct hashes of its ``width``-word shingles (fewer words: the whole sequence). Equal
sets are one class, of which only the representative goes on. One hash per shingle splits the set over ``BINS``
bins; the least value in each bin is its sketch, and an empty bin copies the bin that a fixed hash sequence of
(bin, attempt) first finds filled. Runs of ``ROWS`` bins are the bands. In each bucket of a band, edges go from
every member to the bucket's least representative first: pairs stay linear in the rows. Candidates are confirmed on
the full sets by integer arithmetic. Then components are formed, and further rounds offer stars around other
centres (the greatest, and one drawn anew for each bucket) where a bucket still holds several components, one edge
for each component, so a link that one centre misses is found by another. Components grow from round to round. There are at least ``rounds`` of them, and they go on while they find links.
What the stars leave is tested exactly: every pair that shares a bucket and still lies in two components is compared on
the full sets, unless too few of a set's shingles stand in a second component for any link.

Defined results: null or wordless text has an empty set and links with nothing; null ids link like others (a null component id
only for a component of nothing but null ids); repeated rows are members of one class; an empty table gives an
empty result. Other columns pass through ``keep_one`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import dropped, fresh, stored, text_of
from paritas.llm.graph import components

BINS, ROWS = 128, 4
WIDTH, PERCENT = 5, 80
BROADCAST_NODES = 1_000_000
SAMPLED, CELL = (4, 1), 1_000_000
MULTIPLIER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes as the comparison sees them: A-Z lowered, every blank a space.
PLAIN = bytes(0x20 if b in b"\t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
BYTE_VALUES = scramble(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def word_hashes(text: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the rows that ``offsets`` cut from ``text``, and where each row's begin."""
    data = np.frombuffer(text.translate(PLAIN), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = data != 0x20
    begins, ends = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    edges = offsets[inside[offsets] & inside[offsets + 1]]  # words that would run over from row to row
    begins[edges] = ends[edges] = True
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data) + 1, MULTIPLIER, np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUES[data] * powers[:-1], dtype=np.uint64)])
        back = np.cumprod(np.full(len(data) + 1, INVERSE, np.uint64))
        value = (total[ends] - total[begins]) * back[begins] + (ends - begins).astype(np.uint64)
    return scramble(value), np.searchsorted(begins, offsets)


def shingle_sets(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and where each row's begin; ``words`` are word hashes."""
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(words)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    length = np.minimum(sizes, width)[rows]
    value = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        used = k < length
        value = np.where(used, scramble(value * MULTIPLIER + padded[k:k + len(words)] + np.uint64(1)), value)
    starts = within <= np.maximum(sizes - width, 0)[rows]
    value, rows = value[starts], rows[starts]
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[new], rows[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(sizes)))]).astype(np.int64)


def sketches(shingles: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation sketches, a row per set; rows of empty sets are zero."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets))
    hashed = scramble(shingles * MULTIPLIER)
    slot = rows * bins + (hashed % np.uint64(bins)).astype(np.int64)
    value = hashed // np.uint64(bins)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    flat = np.full(n * bins, empty)
    np.minimum.at(flat, slot, value)
    sketch = flat.reshape(n, bins)
    filled, column = sketch != empty, np.arange(bins, dtype=np.uint64)
    some, result, open_ = filled.any(axis=1), sketch.copy(), ~filled
    open_[~some] = False
    attempt = 0
    while open_.any():
        attempt += 1
        source = (scramble(column * MULTIPLIER + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        take = open_ & filled[:, source]
        result = np.where(take, sketch[:, source], result)
        open_ &= ~take
    result[~some] = 0
    return result


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    n, bins = sketch.shape
    bands = bins // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    cut = sketch.reshape(n, bands, rows)
    for k in range(rows):
        key = scramble(key * MULTIPLIER + cut[:, :, k])
    return key


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))


def _slices(batch: pa.RecordBatch, most: int = 1_500_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most`` bytes of text: the rows, their word hashes, and where each row's begin."""
    texts = batch.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data, row = memoryview(texts.buffers()[2] or b""), 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        words = word_hashes(bytes(data[offsets[row]:offsets[end]]), offsets[row:end + 1] - offsets[row])
        yield batch.slice(row, end - row), *words
        row = end


def _set_sums(shingles: np.ndarray, starts: np.ndarray) -> pa.Array:
    total = np.concatenate([[np.uint64(0)], np.cumsum(shingles, dtype=np.uint64)])
    return pa.array((total[starts[1:]] - total[starts[:-1]]).view(np.int64))


def _banded(width: int, bins: int, rows: int):
    """doc_id, fp, text -> doc_id, fp, n_shingles, two 64-bit sums that name the set, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, offsets in _slices(batch):
                shingles, starts = shingle_sets(words, offsets, width)
                keys = band_keys(sketches(shingles, starts, bins), rows)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("fp"), pa.array(np.diff(starts)),
                    _set_sums(scramble(shingles), starts), _set_sums(scramble(shingles ^ MIX), starts),
                    _lists(keys.ravel(), np.arange(len(keys) + 1) * keys.shape[1]),
                ], names=["doc_id", "fp", "n_shingles", "set_a", "set_b", "keys"])
    return run


def _sets(width: int):
    """node, text -> node, n, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, offsets in _slices(batch):
                shingles, starts = shingle_sets(words, offsets, width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(np.diff(starts)), _lists(shingles, starts)],
                    names=["node", "n", "shingles"])
    return run


def _sets_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node, n, shingles: the full sets of ``nodes(wanted)``, which are rebuilt from their texts.

    Up to ``BROADCAST_NODES`` ids (8 bytes each) go to where the texts are; more are joined, which moves the texts once.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    nodes = stored(nodes.distinct(), "nodes")
    wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    rows = docs.select(F.col("doc_id").alias("node"), text_of(F.col("text")).alias("text")).join(wanted, F.col("node") == F.col("wanted"))
    sets = stored(rows.select("node", "text").mapInArrow(_sets(width), f"node {kind}, n bigint, shingles array<bigint>"), "sets")
    dropped(nodes)
    return sets


def _confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """u, v of the ``pairs(u, v)`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("shingles").alias("set_u"))
    right = sets.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("shingles").alias("set_v"))
    near_size = 100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")
    both = pairs.join(left, "u").join(right, "v").where(near_size)
    shared = F.size(F.array_intersect("set_u", "set_v"))
    return both.where(100 * shared >= percent * (F.col("n_u") + F.col("n_v") - shared)).select("u", "v").distinct()


def _may_link(sets: DataFrame, percent: int, one_in: int) -> DataFrame:
    """Those of ``sets(node, n, shingles, part)`` that can link to another component; one shingle in ``one_in`` is looked at.

    A linked set has at most (100 - percent)% shingles that its partner lacks, so no more that stand in its own component alone.
    """
    rows = sets.withColumns({"set_id": F.xxhash64("shingles"), "drawn": F.filter("shingles", lambda x: F.pmod(x, F.lit(one_in)) == 0)})
    each = rows.select("node", "set_id", "part", F.explode("drawn").alias("shingle"))
    met = each.groupBy(F.col("shingle").alias("met")).agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("met")
    counts = each.join(met, F.col("shingle") == F.col("met")).groupBy(F.col("node").alias("met_node"), F.col("set_id").alias("met_id")) \
        .agg(F.count("*").alias("n_met"))
    alone = F.size("drawn") - F.coalesce("n_met", F.lit(0))
    return rows.join(counts, (F.col("node") == F.col("met_node")) & (F.col("set_id") == F.col("met_id")), "left") \
        .where(100 * alone <= (100 - percent) * F.col("n")).select(*sets.columns)


def _compared(percent: int):
    """The sets of one cell -> u, v: links between its ``rows`` and ``columns``, one for each two components they join."""

    def run(pdf):
        import pandas as pd

        sizes, lists = pdf["n"].to_numpy(), pdf["shingles"].to_list()
        starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        _, local = np.unique(np.concatenate(lists), return_inverse=True)
        holders = np.repeat(np.arange(len(sizes)), np.diff(starts))[np.argsort(local, kind="stable")]
        ends = np.cumsum(np.bincount(local))
        lengths = np.diff(ends, prepend=0)
        part, columns, nodes = pd.factorize(pdf["part"])[0], pdf["is_column"].to_numpy(), pdf["node"].to_list()
        found = []
        for x in np.flatnonzero(pdf["is_row"].to_numpy()):
            own = local[starts[x]:starts[x + 1]]
            until = np.cumsum(lengths[own])
            places = np.arange(until[-1]) + np.repeat(ends[own] - until, lengths[own])
            shared = np.bincount(holders[places], minlength=len(sizes))
            hits = np.flatnonzero(columns & (part != part[x]) & (100 * shared >= percent * (sizes[x] + sizes - shared)))
            joined, at = np.unique(part[hits], return_index=True)
            found += [(nodes[x], nodes[y]) for y in hits[at]]
            part[np.isin(part, joined)] = part[x]
        return pd.DataFrame({"u": [max(f) for f in found], "v": [min(f) for f in found]})
    return run


def _exact_links(shared: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame | None:
    """Links between the components ``comps`` from all pairs in the ``shared`` buckets; None where no set can have one.

    Sets whose buckets are connected form a cluster, its largest component apart from the others. Clusters are cut into
    blocks of about ``CELL`` shingles; a cell compares two blocks, of which at most one is of the largest component.
    ``shared`` and ``sets`` are dropped.
    """
    kind = sets.schema["node"].dataType.simpleString()
    labelled = shared.join(comps, F.col("class_id") == F.col("node"), "left").select("class_id", "key", F.coalesce("component", "class_id").alias("part"))
    several = lambda rows: rows.groupBy(F.col("key").alias("hub_key")).agg(F.min("class_id").alias("lo"), F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    open_rows = stored(labelled.join(several(labelled).select("hub_key"), F.col("key") == F.col("hub_key")).drop("hub_key"), "open")
    parts = open_rows.select(F.col("class_id").alias("wanted"), "part").distinct()
    left = stored(sets.join(parts, F.col("node") == F.col("wanted")).drop("wanted"), "open-sets")
    dropped(shared)
    dropped(sets)
    for one_in in SAMPLED:
        last, left = left, stored(_may_link(left, percent, one_in), "may-link")
        dropped(last)
    used_up = (open_rows, left)
    if left.isEmpty():
        for table in used_up:
            dropped(table)
        return None
    open_rows = open_rows.join(left.select("node"), F.col("class_id") == F.col("node"), "left_semi")
    edges = open_rows.join(several(open_rows).select("hub_key", "lo"), F.col("key") == F.col("hub_key")).select(F.col("class_id").alias("u"), F.col("lo").alias("v"))
    clusters = components(edges).withColumnRenamed("node", "member")
    left = left.join(clusters, F.col("node") == F.col("member"), "left").withColumn("cluster", F.coalesce("component", "node")).drop("member", "component")
    sizes = left.groupBy(F.col("cluster").alias("of"), F.col("part").alias("of_part")).agg(F.sum("n").alias("held"))
    sizes = sizes.groupBy("of").agg(F.max(F.struct("held", "of_part")).alias("most"), F.sum("held").alias("held"), F.count("*").alias("n_parts")).where("n_parts > 1")
    blocks = lambda held: F.ceil(held / CELL).cast("int")
    sizes = sizes.select("of", F.col("most.of_part").alias("main"), blocks(F.col("most.held")).alias("n_main"), blocks(F.col("held") - F.col("most.held")).alias("n_rest"))
    left = left.join(sizes, F.col("cluster") == F.col("of")).withColumn("is_main", F.col("part") == F.col("main"))
    left = left.withColumn("block", F.pmod(F.xxhash64("node", "n"), F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int"))
    cell = lambda i, j, with_main, is_row, is_column: F.struct(i.alias("i"), j.alias("j"), F.lit(with_main).alias("with_main"), is_row.alias("is_row"), is_column.alias("is_column"))
    up_to, own, yes = lambda n: F.sequence(F.lit(0), F.col(n) - 1), F.col("block"), F.lit(True)
    of_main = F.transform(up_to("n_rest"), lambda k: cell(k, own, True, ~yes, yes))
    of_rest = F.concat(F.transform(up_to("n_rest"), lambda k: cell(F.least(own, k), F.greatest(own, k), False, own <= k, own >= k)),
                       F.transform(up_to("n_main"), lambda k: cell(own, k, True, yes, ~yes)))
    cells = left.select("node", "n", "shingles", "part", "cluster", F.explode(F.when(F.col("is_main"), of_main).otherwise(of_rest)).alias("cell")) \
        .select("node", "n", "shingles", "part", "cluster", "cell.*")
    links = stored(cells.groupBy("cluster", "i", "j", "with_main").applyInPandas(_compared(percent), f"u {kind}, v {kind}"), "links")
    for table in used_up:
        dropped(table)
    return links


def _offers(shared: DataFrame, comps: DataFrame, turn: int) -> DataFrame:
    """u, v: in each bucket that holds several components one edge for each of them, from a drawn member to a centre outside it.

    The centre is a member drawn from the whole bucket, in the first turn also the least and the greatest. A component that fills a
    bucket sends one edge, not one for each member.
    """
    labelled = shared.join(comps, F.col("class_id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "class_id"))
    draw = F.struct(F.xxhash64("class_id", "key", F.lit(turn)).alias("draw"), F.col("class_id").alias("id"))
    parts = labelled.groupBy("key", "part").agg(F.min(draw).alias("some"), F.min("class_id").alias("least"), F.max("class_id").alias("most"))
    centre = lambda pick, *by: pick(F.struct(*by, F.col("part").alias("of")))
    some = centre(F.min, F.col("some.draw").alias("draw"), F.col("some.id").alias("id")).alias("some_centre")
    hubs = parts.groupBy(F.col("key").alias("hub_key")).agg(
        some, centre(F.min, F.col("least").alias("id")).alias("lo"), centre(F.max, F.col("most").alias("id")).alias("hi"),
        F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    as_centre = lambda name: F.struct(F.col(f"{name}.id").alias("id"), F.col(f"{name}.of").alias("of"))
    centres = F.array(*[as_centre(name) for name in (("lo", "hi", "some_centre") if turn == 0 else ("some_centre",))])
    offered = parts.join(hubs, F.col("key") == F.col("hub_key")).select("part", F.col("some.id").alias("from_id"), F.inline(centres)).where("part <> of")
    return offered.select(F.greatest("from_id", "id").alias("u"), F.least("from_id", "id").alias("v")).distinct()


def _grown(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after ``links(u, v)``; the stars of ``comps`` stand for the links before, and their table is dropped."""
    stars = comps.select(F.col("node").alias("u"), F.col("component").alias("v"))
    grown = components(stars.unionAll(links.select("u", "v")))
    dropped(comps)
    return grown


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bins: int = BINS, rows: int = ROWS,
                rounds: int = 3) -> DataFrame:
    """doc_id, fp, n_shingles, component_id for every row of ``docs`` (fp tells apart texts under one id)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    banded = docs.select("doc_id", F.xxhash64(text_of(F.col("text"))).alias("fp"), text_of(F.col("text")).alias("text")).mapInArrow(
        _banded(width, bins, rows),
        f"doc_id {kind}, fp bigint, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>")
    banded = stored(banded, "bands")
    same_set = ("n_shingles", "set_a", "set_b")
    classes = banded.where("n_shingles > 0").groupBy(*[F.col(c).alias(f"of_{c}") for c in same_set]).agg(F.min("doc_id").alias("class_id"))
    on = [F.col(c) == F.col(f"of_{c}") for c in same_set]
    members = stored(banded.join(classes, on, "left").drop(*[f"of_{c}" for c in same_set]), "members")
    dropped(banded)
    buckets = members.where("doc_id = class_id").select("class_id", F.explode("keys").alias("key"))
    hubs = buckets.groupBy(F.col("key").alias("hub_key")).agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo < hi")
    shared = stored(buckets.join(hubs, F.col("key") == F.col("hub_key")).drop("hub_key"), "buckets")
    sets = _sets_of(docs, shared.select(F.col("class_id").alias("wanted")), width)
    first = stored(shared.where("class_id > lo").groupBy("class_id").agg(F.min("lo").alias("v")).select(F.col("class_id").alias("u"), "v"), "offered")
    links = stored(_confirmed(sets, first, percent), "links")
    tested, found, turn, comps = first, 1, 0, components(links)
    while found or turn < rounds:
        offered = stored(_offers(shared, comps, turn).join(tested, ["u", "v"], "left_anti"), "offered")
        new = stored(_confirmed(sets, offered, percent), "links")
        found, turn, tested = new.count(), turn + 1, tested.unionAll(offered)
        if found:
            comps = _grown(comps, new)
    exact = _exact_links(shared, sets, comps, percent)
    if exact is not None and not exact.isEmpty():
        comps = _grown(comps, exact)
    return members.join(comps, F.col("class_id") == F.col("node"), "left").select(
        "doc_id", "fp", "n_shingles", F.coalesce("component", "class_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group: the one that gives the group its id; columns as in ``docs``."""
    fp, kept_id, kept_fp, times = fresh(docs, "near_fp", "kept_id", "kept_fp", "times")
    kept = near_groups(docs, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy(F.col("doc_id").alias(kept_id), F.col("fp").alias(kept_fp)).agg(F.count("*").alias(times))
    rows = docs.withColumn(fp, F.xxhash64(text_of(F.col("text")))).join(
        kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(fp) == F.col(kept_fp)))
    once, more = rows.where(F.col(times) == 1), rows.where(F.col(times) > 1).dropDuplicates(["doc_id", fp])
    return once.unionAll(more).select(*[F.col(f"`{c}`") for c in docs.columns])
