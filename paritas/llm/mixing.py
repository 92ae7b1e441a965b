"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its share by weight of all words, at most ``MOST`` times its own,
the excess reshared by weight (water filling). A document is expected to be taken ``m = target / source words``
times (scaled by ``weight``, if the caller names such a column): ``floor(m)`` whole copies are certain, and the
fraction is its inclusion probability p. Documents of a source are ranked by ``(u / (1 - u)) / (p / (1 - p))``, u
drawn from id and text by md5, and taken in that order as long as they fit into what the target lacks. That fixes
the sample's size in words, and reruns agree. Where more than ``SLACK`` of a target is still missing, which takes documents
longer than that, one document that did not fit is taken instead of the ranking's tail: the one that comes closest to the
target together with the head of the ranking that fits beside it. What is missing then is filled in ranking order as before.

Nothing sorts a whole source in one task: ranks fall into ``BINS`` bins, whose words are summed before the
shuffle; documents are put in order within their bin, and those that cannot be drawn pass by unsorted.

Defined results: null text has size 0 and a document of size 0 is taken by its certain copies alone; null sources
are one source, ordered last; rows equal in id, text and source are drawn together; an empty table gives an empty
result. Other columns pass through ``mix`` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paritas.llm.common import fresh, n_words_of, stored, text_of

WEIGHTS, MOST, BINS, SLACK = (1, 2, 3), 3, 4096, 0.01


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source_key, source_size, target per source of ``sizes(source_key, size)``.

    The windows run over one row per source. Sources below the water level get ``level * weight``; the level
    follows from sources in the order in which they reach their ceiling ``most * size``.
    """
    totals = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source_key").cast("binary").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = totals.withColumn("weight", F.get(cycle, (F.row_number().over(order) - 1) % len(weights)))
    rows = rows.withColumn("ceiling", (F.col("source_size") * most).cast("double"))
    filled = W.orderBy(F.col("ceiling") / F.col("weight"), F.col("source_key").cast("binary").asc_nulls_last())
    before, whole = filled.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    rows = rows.withColumns({
        "room": F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)),
        "rest": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    rows = rows.withColumn("level", F.col("room") / F.col("rest"))
    holds = F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))
    rows = rows.withColumn("level", F.first(holds, ignorenulls=True).over(
        filled.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return rows.select("source_key", "source_size", F.least("ceiling", F.col("level") * F.col("weight")).alias("target"))


def draw(doc_id: Column, fp: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 from id, text fingerprint and seed."""
    digest = F.md5(F.concat_ws("|", doc_id.cast("string"), fp, F.lit(seed)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def allocate(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, weight: str | None = None,
             seed: int = 5, passes: int = 3) -> DataFrame:
    """unit_id, unit_fp, unit_source, size, source_size, target, copies: one row per document, equal rows taken as one.

    ``weight`` names a column of relative inclusion weights (null as 1). The first pass takes the longest head of the
    ranking that fits into what is missing; each further pass does so among documents that still fit.
    """
    own = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(1.0)), F.lit(0.0))
    units = docs.select(
        F.col("doc_id").alias("unit_id"), F.md5(text_of(F.col("text")).cast("binary")).alias("unit_fp"), F.col("source").alias("unit_source"),
        n_words_of(F.col("text")).alias("size"), own.alias("own"))
    units = units.groupBy("unit_id", "unit_fp", "unit_source", "size").agg(F.count("*").alias("times"), F.max("own").alias("own"))
    units = stored(units.withColumn("words", F.col("size") * F.col("times")), "mix-units")
    targets = source_targets(units.select(F.col("unit_source").alias("source_key"), F.col("words").alias("size")), weights, most)
    means = units.groupBy(F.col("unit_source").alias("mean_key")).agg(
        F.try_divide(F.sum(F.col("own") * F.col("words")), F.sum("words")).alias("mean"))
    # stored: one row per source, which Spark broadcasts if its size allows, so that a hot source stays where it is
    targets = stored(targets.join(means, F.col("source_key").eqNullSafe(F.col("mean_key"))).drop("mean_key"), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.least(
        F.lit(float(most)), F.col("target") / F.col("source_size") * F.when(F.col("mean") > 0, F.col("own") / F.col("mean")).otherwise(1.0)))
    rows = units.join(targets, F.col("unit_source").eqNullSafe(F.col("source_key")))
    rows = rows.withColumn("expected", F.coalesce(expected, F.lit(0.0))).drop("source_key", "mean", "own") \
        .withColumn("certain", F.floor("expected"))
    chance, u = F.col("expected") - F.col("certain"), draw(F.col("unit_id"), F.col("unit_fp"), seed)
    odds = (u / (1 - u)) * ((1 - chance) / chance)
    rows = rows.withColumn("place", F.when(chance > 0, odds / (1 + odds))).drop("expected")
    rows = stored(rows.withColumn("bin", F.floor(F.col("place") * BINS).cast("int")).withColumn("extra", F.lit(0)), "mix-ranked")
    for _ in range(passes):
        rows = stored(_take(rows), "mix-taken")
    rows = stored(_exchange(rows), "mix-taken")
    for _ in range(passes - 1):
        rows = stored(_take(rows), "mix-taken")
    return rows.withColumn("copies", F.col("certain") + F.col("extra")).drop("times", "words", "certain", "place", "bin", "extra")


def _gaps(rows: DataFrame) -> DataFrame:
    """gap_source, gap, room (words wanted beside the certain copies), goal per source; stored, as it is joined without an exchange."""
    return stored(rows.groupBy(F.col("unit_source").alias("gap_source")).agg(
        (F.max("target") - F.sum((F.col("certain") + F.col("extra")) * F.col("words"))).alias("gap"),
        (F.max("target") - F.sum(F.col("certain") * F.col("words"))).alias("room"), F.max("target").alias("goal")), "mix-gaps")


def _drawable() -> Column:
    return F.col("place").isNotNull() & (F.col("words") > 0) & (F.col("words") <= F.col("room"))


def _exchange(rows: DataFrame) -> DataFrame:
    """``rows`` with another choice in sources that lack more than ``SLACK``: one document that did not fit, and the head beside it.

    No document left out is shorter than the gap, so a target has at most ``source words / (SLACK * target)`` of them; they
    meet the words up to each bin, at most ``BINS`` numbers a source.
    """
    lacking = stored(_gaps(rows).where(F.col("gap") > SLACK * F.col("goal")), "mix-lacking")
    of_lacking = rows.join(lacking, F.col("unit_source").eqNullSafe(F.col("gap_source"))).where(_drawable())
    bins = of_lacking.groupBy(F.col("unit_source").alias("bin_source"), F.col("bin").alias("bin_no")).agg(F.sum("words").alias("bin_words"))
    upto = F.sum("bin_words").over(W.partitionBy("bin_source").orderBy("bin_no"))
    heads = bins.withColumn("upto", upto).groupBy("bin_source").agg(F.array_sort(F.collect_list(F.struct("bin_no", "upto"))).alias("heads"))
    left_out = of_lacking.where("extra = 0").join(stored(heads, "mix-heads"), F.col("unit_source").eqNullSafe(F.col("bin_source")))
    beside = F.transform("heads", lambda h: F.struct(
        h["bin_no"].alias("bin_no"), (h["upto"] - F.when(h["bin_no"] >= F.col("bin"), F.col("words")).otherwise(0)).alias("upto")))
    fitting = F.filter(beside, lambda h: h["upto"] + F.col("words") <= F.col("room"))
    head = F.coalesce(F.get(fitting, F.size(fitting) - 1), F.struct(F.lit(-1).alias("bin_no"), F.lit(0).cast("bigint").alias("upto")))
    chosen = left_out.withColumn("head", head).withColumn("sum", F.col("head.upto") + F.col("words")).where(F.col("sum") > F.col("room") - F.col("gap"))
    first = F.max_by(F.struct(F.col("unit_id").alias("in_id"), F.col("unit_fp").alias("in_fp"), F.col("head.bin_no").alias("until")),
                     F.struct("sum", -F.col("place"), "unit_fp", "unit_id")).alias("in")
    chosen = stored(chosen.groupBy(F.col("unit_source").alias("in_source")).agg(first).join(
        lacking, F.col("in_source").eqNullSafe(F.col("gap_source"))).select("in_source", "in.*", "room"), "mix-chosen")
    found = rows.join(chosen, F.col("unit_source").eqNullSafe(F.col("in_source")), "left")
    is_in = F.col("unit_id").eqNullSafe(F.col("in_id")) & (F.col("unit_fp") == F.col("in_fp"))
    extra = F.when(F.col("until").isNull(), F.col("extra")).when(is_in, 1).when(_drawable() & (F.col("bin") <= F.col("until")), 1).otherwise(0)
    return found.withColumn("extra", extra).select(*rows.columns)


def _take(rows: DataFrame) -> DataFrame:
    """``rows`` with ``extra`` = 1 for the head of the ranking that fits into what each source still lacks."""
    open_rows = rows.join(_gaps(rows).drop("room", "goal"), F.col("unit_source").eqNullSafe(F.col("gap_source"))).drop("gap_source")
    fits = F.col("place").isNotNull() & (F.col("extra") == 0) & (F.col("words") > 0) & (F.col("words") <= F.col("gap"))
    open_rows = open_rows.withColumn("fit", F.when(fits, F.col("words")))
    idle, open_rows = open_rows.where(F.col("fit").isNull()).select(*rows.columns), open_rows.where(F.col("fit").isNotNull())
    bins = open_rows.groupBy(F.col("unit_source").alias("bin_source"), F.col("bin").alias("bin_no")).agg(F.sum("fit").alias("bin_words"))
    earlier = W.partitionBy("bin_source").orderBy("bin_no").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_words").over(earlier), F.lit(0))).drop("bin_words")
    within = W.partitionBy("unit_source", "bin").orderBy("place", "unit_fp", "unit_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = open_rows.withColumn("within", F.sum("fit").over(within)).join(
        bins, F.col("unit_source").eqNullSafe(F.col("bin_source")) & F.col("bin").eqNullSafe(F.col("bin_no")))
    now = F.col("before") + F.col("within") <= F.col("gap")
    return ranked.withColumn("extra", F.when(now, 1).otherwise(F.col("extra"))).select(*rows.columns).unionAll(idle)


def joined(docs: DataFrame, units: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with the ``wanted`` columns of their units, under names that do not clash."""
    fp, unit_id, unit_fp, unit_source, *names = fresh(docs, "mix_fp", "unit_id", "unit_fp", "unit_source", *wanted)
    renamed = units.select(*[F.col(a).alias(b) for a, b in zip(
        ("unit_id", "unit_fp", "unit_source", *wanted), (unit_id, unit_fp, unit_source, *names), strict=True)])
    rows = docs.withColumn(fp, F.md5(text_of(F.col("text")).cast("binary"))).join(
        renamed, F.col("doc_id").eqNullSafe(F.col(unit_id)) & (F.col(fp) == F.col(unit_fp))
        & F.col("source").eqNullSafe(F.col(unit_source)))
    return rows.drop(fp, unit_id, unit_fp, unit_source), names


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each as many times as it is taken, with the columns of ``docs``."""
    rows, (copies,) = joined(docs, allocate(docs, **options), "copies")
    again = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))
    repeat = fresh(rows, "repeat")[0]
    return rows.where(F.col(copies) > 0).withColumn(repeat, again).select(*[F.col(f"`{c}`") for c in docs.columns])
