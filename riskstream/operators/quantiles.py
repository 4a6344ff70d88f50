"""Exact quantiles per group that hold up when one group is most of the table.

The built-in ``percentile`` keeps every distinct value of a group in one task. Here
quantiles are found by rank, whatever the size of a group:

1. One pass takes each group's size, extremes and a KLL sketch (bounded in size), which gives
   a narrow bracket of values around each quantile, and cuts it into parts that hold about as many values.
2. One pass counts the rows: those between brackets collapse to one count per
   gap, those inside to one count per value, all before the shuffle.
3. The counts of gaps and parts, of which a group has a fixed number, give the rank at which each starts.
4. Only the parts in which a wanted rank falls are looked at value by value.

A bracket that misses its rank is noticed, and step 2 is repeated with brackets over all
values. The result is the same as that of ``percentile``.

Sketches can be merged: those that a summary of the rows holds (see ``measures``) give approximate quantiles without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskstream.functions import usable_amount
from riskstream.operators.measures import SKETCH
from riskstream.session import stored

#: The size of a sketch, and how far (as a share of the ranks) a bracket reaches: over three times the sketch's error.
SKETCH_SIZE, MARGIN = 4096, 0.004
#: The smallest reach with room for the ranks next to a quantile; those of small groups are wider, up to all ranks.
WIDTHS = tuple(1.25 * MARGIN * 2**j for j in range(9))
#: Parts of a bracket.
PARTS = 32
SALTS = 16


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    accuracy: int | None = None,
) -> DataFrame:
    """Per group: ``n``, ``low``, ``high`` and ``quantiles``, one per probability.

    Rows without a value or without a key are left out. Exact ones run at once and return
    a stored table. ``accuracy``, the size of a sketch, asks for approximate quantiles; a summary that holds sketches gives such.
    """
    keys = list(keys)
    if SKETCH in df.columns:
        merged = df.dropna(subset=keys).groupBy(*keys).agg(F.kll_merge_agg_double(SKETCH).alias("sketch"))
        return _approximate(merged, keys, probabilities)
    rows = df.select(*keys, usable_amount(value).alias("v")).dropna()
    if accuracy is not None:
        return _approximate(rows.groupBy(*keys).agg(F.kll_sketch_agg_double("v", accuracy).alias("sketch")), keys, probabilities)
    return _by_rank(rows, keys, probabilities)


def _at(sketch: str, ranks: Sequence[float]) -> str:
    """The values of a sketch at some ranks, from 0 to 1, as an expression."""
    inside = (min(max(float(r), 0.0), 1.0) for r in ranks)
    return f"kll_sketch_get_quantile_double({sketch}, array({', '.join(f'{r!r}D' for r in inside)}))"


def _approximate(sketches: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    found = sketches.withColumn("n", F.kll_sketch_get_n_double("sketch")).where(F.col("n") > 0)
    values = found.select(*keys, "n", F.expr(f"{_at('sketch', (0, 1, *probabilities))} AS values"))
    rest = F.slice("values", 3, len(probabilities)).alias("quantiles")
    return values.select(*keys, "n", F.col("values")[0].alias("low"), F.col("values")[1].alias("high"), rest)


def _extremes() -> tuple[Column, ...]:
    return (F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def _by_rank(rows: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    sketched = rows.groupBy(*keys).agg(*_extremes(), F.kll_sketch_agg_double("v", SKETCH_SIZE).alias("sketch"))
    # a bracket holds the two ranks next to the quantile, whatever the size of the group
    width = F.expr(f"CAST(least(greatest(ceil(log2(({MARGIN!r}D + 2 / n) / {WIDTHS[0]!r}D)), 0), {len(WIDTHS) - 1}) AS INT)")
    brackets = ", ".join(
        f"struct({_at('sketch', [p - w for w in WIDTHS])}[width] AS low, {_at('sketch', [p + w for w in WIDTHS])}[width] AS high, "
        f"{_at('sketch', [p + MARGIN * (2 * i / PARTS - 1) for i in range(1, PARTS)])} AS cuts)"
        for p in probabilities
    )
    bracketed = sketched.withColumn("width", width).select(*keys, "n", "low", "high", F.expr(f"array({brackets}) AS brackets"))
    groups = stored(bracketed, "quantile-groups")
    found = _select(rows, groups, keys, probabilities)
    if not found.where(F.exists("quantiles", F.isnull)).isEmpty():
        everything = F.expr("transform(brackets, b -> struct(low AS low, high AS high, b.cuts AS cuts))")
        found = _select(rows, groups.withColumn("brackets", everything), keys, probabilities)
    return found


def _counted(rows: DataFrame, groups: DataFrame, keys: list[str], brackets: int) -> DataFrame:
    """Rows as counts whose order by (slot, v) is the order of the values.

    A slot is a gap before or behind a bracket, whose rows lose their value, or a part of a bracket.

    Rows meet their brackets by key and salt: should there be too many groups to
    broadcast, a hot one is spread, and since the counts are not grouped by salt
    they are combined before a shuffle of their own.
    """
    # written as text: a driver builds a long expression faster from that than from parts
    gap = "struct({} AS slot, CAST(NULL AS DOUBLE) AS v)"
    cases = " ".join(
        f"WHEN v < brackets[{i}].low THEN {gap.format(i * (PARTS + 1))} "
        f"WHEN v <= brackets[{i}].high THEN struct(size(filter(brackets[{i}].cuts, cut -> cut < v)) + {i * (PARTS + 1) + 1} AS slot, v AS v)"
        for i in range(brackets)
    )
    place = F.expr(f"CASE {cases} ELSE {gap.format(brackets * (PARTS + 1))} END AS place")
    salts = F.expr(f"explode(sequence(0L, {SALTS - 1}L)) AS salt")
    salted = rows.withColumn("salt", F.expr(f"pmod(xxhash64(v), {SALTS})"))
    placed = salted.join(groups.select(*keys, "brackets", salts), [*keys, "salt"]).select(*keys, place)
    return placed.select(*keys, "place.*").groupBy(*keys, "slot", "v").agg(F.expr("count(1) AS copies"))


def _select(
    rows: DataFrame, groups: DataFrame, keys: list[str], probabilities: Sequence[float]
) -> DataFrame:
    """The values at the ranks each quantile needs, interpolated; null where a rank is outside its bracket."""
    counts = stored(_counted(rows, groups, keys, len(probabilities)), "quantile-counts")
    # as many rows for a group as there are slots
    in_order = Window.partitionBy(*keys).orderBy("slot")
    starts = (
        counts.groupBy(*keys, "slot")
        .agg(F.sum("copies").alias("inside"))
        .withColumn("before", F.sum("inside").over(in_order) - F.col("inside"))
    )
    places = [f"((n - 1) * {float(p)!r}D)" for p in probabilities]
    ranks = ", ".join(f"CAST({end}({place}) AS BIGINT)" for place in places for end in ("floor", "ceil"))
    # One row per group and wanted rank.
    targets = groups.select(*keys, F.expr(f"posexplode(array({ranks})) AS (nth, rank)"))
    hits = starts.join(targets, keys).where("rank >= before AND rank < before + inside")
    wanted = hits.groupBy(*keys, "slot", "before").agg(F.expr("collect_list(struct(nth, rank)) AS wanted"))
    in_slot = Window.partitionBy(*keys, "slot").orderBy("v")
    opened = (
        counts.where("v IS NOT NULL")
        .join(wanted, [*keys, "slot"])
        .withColumn("upto", F.col("before") + F.sum("copies").over(in_slot))
        .select(*keys, "v", "copies", "upto", F.explode("wanted").alias("hit"))
        .where("hit.rank < upto AND hit.rank >= upto - copies")
    )
    values = opened.groupBy(*keys).agg(F.expr("map_from_entries(collect_list(struct(hit.nth, v))) AS at"))
    interpolated = ", ".join(_between(f"at[{2 * i}]", f"at[{2 * i + 1}]", place) for i, place in enumerate(places))
    result = groups.join(values, keys, "left").select(*keys, "n", "low", "high", F.expr(f"array({interpolated}) AS quantiles"))
    return stored(result, "quantiles")


def _between(lower: str, upper: str, place: str) -> str:
    """Linear interpolation between two neighbouring values."""
    share = f"({place} - floor({place}))"
    return f"CASE WHEN {lower} = {upper} THEN {lower} ELSE {lower} * (1 - {share}) + {upper} * {share} END"
