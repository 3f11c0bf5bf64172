"""Exact ranks, running totals, score curves and order statistics without a single-task sort.

A running total over all rows of a group is split by a bin, a fixed monotone function of the
row itself: totals per bin are accumulated over the bins, and rows are only put in order inside
their bin. Bins do not come from samples, so any re-run of any task sees the same ones.

Places among equal scores go by (cutoff, id). There the bins are the digits of the id, from the
highest down: each digit has 2^16 values, so no window is longer than that, however the ids lie.

Medians are bracketed by a mergeable sketch first; what lies below a bracket is counted exactly,
and only the rows inside are put in order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil, floor, inf, pi
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_column, positive_hash

TIE_KEYS = ("cutoff", "customer_id")
#: A digit of an id; three of the four digits of a long lead to its block.
DIGIT_BITS = 16
#: Rows inside a bracket that are put in order; a bracket with more is narrowed again.
PIECE_ROWS = 1 << 18
# The sketch is good to 1/10,000 of the rows; a bracket goes one step of the grid further.
_ACCURACY, _GRID = 10_000, 512
_MOST_PASSES = 12


def running_totals(df: DataFrame, group: list[str], bin_key: Column, order: list[Column],
                   values: list[str], descending: bool = False,
                   totals: bool = False) -> DataFrame:
    """Add ``<value>_before`` for each value: its sum over all earlier rows of the group.

    Rows come by ``bin_key``, then by ``order``. One task at a time sees the bins of a group (a
    few hundred thousand at most) or the rows of a bin. ``totals`` also adds ``<value>_total``.
    """
    df = df.withColumn("_bin", bin_key)
    whole = Window.partitionBy(*group)
    earlier_bins = (whole.orderBy(F.col("_bin").desc() if descending else F.col("_bin").asc())
                    .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        df.groupBy(*group, "_bin").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        .select(*group, "_bin",
                *[F.coalesce(F.sum(f"_{v}").over(earlier_bins), F.lit(0)).alias(f"_{v}_offset")
                  for v in values],
                *[F.sum(f"_{v}").over(whole).alias(f"{v}_total") for v in values if totals]))
    earlier_rows = (Window.partitionBy(*group, "_bin").orderBy(*order)
                    .rowsBetween(Window.unboundedPreceding, -1))
    # As many rows as bins, so it is not sent to all tasks by way of the driver.
    joined = df.join(offsets.hint("merge"), [*group, "_bin"])
    return joined.select(
        *[F.col(c) for c in df.columns if c != "_bin"],
        *[(F.coalesce(F.sum(v).over(earlier_rows), F.lit(0)) + F.col(f"_{v}_offset"))
          .alias(f"{v}_before") for v in values],
        *[F.col(f"{v}_total") for v in values if totals])


def _score_bin(score: Column) -> Column:
    """2^18 equal steps of the arc tangent, which takes any score into a bounded interval in
    order; scores in [0, 1] spread over 65,536 of them."""
    return F.floor((F.atan(score) / F.lit(pi) + F.lit(0.5)) * F.lit(float(1 << 18)))


def score_curve(scored: DataFrame, keys: list[str], label: str = "label",
                score: str = "score", combined: bool = True) -> DataFrame:
    """One row per group and distinct score, from the highest score down.

    Columns: keys, ``score``, ``n`` rows and ``pos`` positives at this score, ``n_before`` and
    ``pos_before`` above it, ``n_total`` and ``pos_total`` of the group. Tied scores are one row,
    combined before the shuffle. Where hardly any are tied that saves nothing: with ``combined``
    off, rows travel once, straight to their bin, and are combined and summed up there.
    """
    counted = F.count(F.lit(1)).alias("n")
    value, bin_key = as_column(score).cast("double").alias("score"), _score_bin(F.col("score"))
    order = [F.col("score").desc()]
    if combined:
        counts = scored.groupBy(*keys, value).agg(
            counted, F.sum(as_column(label).cast("bigint")).alias("pos"))
        return running_totals(counts, keys, bin_key, order, ["n", "pos"], descending=True,
                              totals=True)
    # A bin is never null: a filter for that, on one of the two uses, would part their shuffles.
    placed = (scored.select(*keys, value, as_column(label).cast("bigint").alias("_label"))
              .withColumn("_bin", F.coalesce(bin_key, F.lit(-1).cast("bigint")))
              .repartition(*keys, "_bin"))
    counts = placed.groupBy(*keys, "_bin", "score").agg(counted, F.sum("_label").alias("pos"))
    return running_totals(counts, keys, F.col("_bin"), order, ["n", "pos"], descending=True,
                          totals=True).filter(F.col("score").isNotNull())


def _placed(rows: DataFrame, group: list[str], ties: tuple[str, str],
            starts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``_one_before``: the rows of the group that come first by (cutoff, id).

    Rows are counted per block of 2^16 consecutive ids, and blocks are rolled up digit by digit
    to cutoffs and groups. On the way back down every level adds what lies before it within the
    level above, so each window sees the values of one digit. Rows meet their block's total in
    one join on the finest key, which no group, score or cutoff can crowd.

    ``starts`` turns the counts per group (``n``) into a table of group and ``n_before``, rows
    that come before the whole group.
    """
    moment, identifier = ties
    levels = [f"_digits_{k}" for k in (3, 2, 1)]              # finest first
    keyed = rows.withColumn(levels[0], F.shiftright(F.col(identifier), DIGIT_BITS)) \
        .withColumn("_moment_key", F.col(moment))
    above = [*group, "_moment_key"]
    counts = [keyed.groupBy(*above, levels[0]).agg(F.count(F.lit(1)).alias("n"))]
    for finer, level in zip(levels, levels[1:]):
        counts.append(counts[-1].groupBy(*above, F.shiftright(finer, DIGIT_BITS).alias(level))
                      .agg(F.sum("n").alias("n")))
    per_moment = counts[-1].groupBy(*above).agg(F.sum("n").alias("n"))

    def earlier(table: DataFrame, within: list[str], by: str) -> DataFrame:
        window = (Window.partitionBy(*within).orderBy(by)
                  .rowsBetween(Window.unboundedPreceding, -1))
        return table.withColumn("_earlier", F.coalesce(F.sum("n").over(window), F.lit(0))).drop("n")

    totals = earlier(per_moment, group, "_moment_key").withColumnRenamed("_earlier", "_offset")
    if starts is not None:
        first = starts(per_moment.groupBy(*group).agg(F.sum("n").alias("n")))
        totals = totals.join(first, group).withColumn(
            "_offset", F.col("_offset") + F.col("n_before")).drop("n_before")
    within = above
    for level, table in zip(reversed(levels), reversed(counts)):
        # The digits above this one, by which it meets the level above.
        parent = [] if within == above else [within[-1]]
        if parent:
            table = table.withColumn(parent[0], F.shiftright(level, DIGIT_BITS))
        totals = (earlier(table, within, level).join(totals.hint("merge"), within)
                  .select(*above, level, (F.col("_offset") + F.col("_earlier")).alias("_offset")))
        within = [*above, level]
    in_block = (Window.partitionBy(*within).orderBy(F.col(identifier))
                .rowsBetween(Window.unboundedPreceding, -1))
    one = F.lit(1).cast("bigint")
    return keyed.join(totals.hint("merge"), within).select(
        *rows.columns,
        (F.col("_offset") + F.coalesce(F.sum(one).over(in_block), F.lit(0))).alias("_one_before"))


def global_rank(scored: DataFrame, keys: list[str], label: str = "label", score: str = "score",
                ties: tuple[str, str] = TIE_KEYS) -> DataFrame:
    """Add ``rank`` (1 = best) per group by score descending, then cutoff, then customer."""
    def better(counts: DataFrame) -> DataFrame:
        return running_totals(counts, keys, _score_bin(F.col("_score")),
                              [F.col("_score").desc()], ["n"], descending=True) \
            .select(*keys, "_score", F.col("n_before"))

    rows = scored.withColumn("_score", as_column(score).cast("double"))
    placed = _placed(rows, [*keys, "_score"], ties, better)
    return placed.withColumn("rank", F.col("_one_before") + 1).select(*scored.columns, "rank")


def top_rows(total: Column, share) -> Column:
    """Size of the top share: at least one, halves to the even number."""
    return F.greatest(F.lit(1).cast("bigint"), F.rint(total * F.lit(float(share))).cast("bigint"))


def cut_points(curve: DataFrame, keys: list[str], cuts: dict, extra=()) -> DataFrame:
    """Where lists of several lengths end on the curve: one row per group, one pass.

    ``cuts`` maps a name to a column expression over ``n_total`` giving the length; ``extra``
    are further aggregates over the curve. Use with ``hits_at``.
    """
    reached = F.col("n_before") + F.col("n")
    points = [F.max("n_total").alias("n_total"), F.max("pos_total").alias("pos_total")]
    for i, size in enumerate(cuts.values()):
        size = size.cast("bigint")
        here = (size > F.col("n_before")) & (size <= reached)
        for name, column in {"size": size, "score": F.col("score"),
                             "take": size - F.col("n_before"), "run": F.col("n"),
                             "run_pos": F.col("pos"), "pos_before": F.col("pos_before")}.items():
            points.append(F.max(F.when(here, column)).alias(f"_{name}_{i}"))
    return curve.groupBy(*keys).agg(*points, *extra)


def hits_at(points: DataFrame, scored: DataFrame, keys: list[str], cuts: dict,
            label: str = "label", score: str = "score",
            ties: tuple[str, str] = TIE_KEYS) -> DataFrame:
    """Positives among the first rows of each group, for each list of ``cut_points``.

    Returns one row per group and cut: ``cut``, ``size``, ``hits`` and all other columns of
    ``points``. Rows are looked at again only where a list ends inside a run of tied scores,
    and then only the rows of that run.
    """
    parts = ("size", "score", "take", "run", "run_pos", "pos_before")
    kept = [c for c in points.columns
            if c not in keys and not any(c == f"_{p}_{i}" for p in parts
                                         for i in range(len(cuts)))]
    ends = points.select(*keys, *kept, F.inline(F.array(*[
        F.struct(F.lit(name).alias("cut"), *[F.col(f"_{p}_{i}").alias(f"_{p}") for p in parts])
        for i, name in enumerate(cuts)])))
    moment, identifier = ties
    rows = scored.select(*keys, as_column(score).cast("double").alias("_score"),
                         as_column(label).cast("bigint").alias("_label"),
                         F.col(moment).alias("_moment"), F.col(identifier).alias("_id"))
    # At most one row per group and cut; how it is joined is decided from its measured size.
    split = (ends.filter(F.col("_take") < F.col("_run")).groupBy(*keys, "_score")
             .agg(F.collect_list(F.struct("cut", "_take")).alias("_ends")))
    runs = rows.join(split, [*keys, "_score"])
    from_run = (
        _placed(runs, [*keys, "_score"], ("_moment", "_id"))
        .select(*keys, "_one_before", "_label", F.inline("_ends"))
        .groupBy(*keys, "cut")
        .agg(F.sum(F.when(F.col("_one_before") < F.col("_take"), F.col("_label")))
             .alias("_from_run")))
    return (
        ends.join(from_run, [*keys, "cut"], "left")
        .select(*keys, *kept, "cut", F.col("_size").alias("size"),
                (F.col("_pos_before") + F.coalesce("_from_run", "_run_pos")).alias("hits")))


def row_positions(df: DataFrame, identity: list[str], seed: int, name: str = "position"
                  ) -> DataFrame:
    """Number the rows 0, 1, ... in the order of a seeded hash of their identity.

    Also adds ``<name>_total``, the number of rows. Hash bins are even by construction.
    """
    hashed = (df.withColumn("_hash", positive_hash(F.lit(seed), *identity))
              .withColumn(name, F.lit(1).cast("bigint")))
    order = [F.col("_hash").asc(), *[F.col(c).asc() for c in identity]]
    counted = running_totals(hashed, [], F.shiftright("_hash", 42), order, [name], totals=True)
    return counted.drop(name, "_hash").withColumnRenamed(f"{name}_before", name)


class Bracket(NamedTuple):
    """An open interval of a column's values, and how many of them lie around and in it."""

    low: float
    high: float
    below: int = 0              # rows under low
    at_low: int = 0
    inside: int = 0
    at_high: int = 0
    wanted: tuple[int, ...] = ()

    def place(self, position: int) -> str:
        """Where the value at a 0-based ascending position lies."""
        edge = self.below
        for where, rows in (("low", self.at_low), ("inside", self.inside),
                            ("high", self.at_high)):
            if edge <= position < edge + rows:
                return where
            edge += rows
        return "outside"

    def narrowed(self, grid: list[float]) -> Bracket:
        """The bracket of the wanted positions, going by a sketch of the values inside."""
        first = [p - self.below - self.at_low for p in self.wanted if self.place(p) == "inside"]
        step = _GRID / self.inside
        low, high = floor(min(first) * step) - 1, ceil((max(first) + 1) * step) + 1
        return Bracket(grid[low] if low >= 0 else self.low,
                       grid[high] if high <= _GRID else self.high)


def _pairs(df: DataFrame, brackets: dict[str, Bracket]) -> DataFrame:
    """(feature, value, low, high) of every value there is; NaN counts as missing."""
    rows = F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                 F.lit(b.low).alias("low"), F.lit(b.high).alias("high"))
        for c, b in brackets.items()]))
    return df.select(rows).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def brackets_of(df: DataFrame, columns: list[str], positions: Callable[[int], tuple[int, ...]]
                ) -> dict[str, Bracket]:
    """Per column with values a bracket whose edges or few inner rows hold the wanted positions.

    ``positions`` gives 0-based ascending positions for a number of rows. Every pass is one
    aggregation of all open columns, of which one row each reaches the driver. Counts are exact, so a sketch
    that errs costs a larger piece and never a wrong value.
    """
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    inside = (value > low) & (value < high)
    grid = [k / _GRID for k in range(_GRID + 1)]
    done: dict[str, Bracket] = {}
    last: dict[str, Bracket] = {}
    open_ones = {c: Bracket(-inf, inf) for c in columns}
    for _ in range(_MOST_PASSES):
        counted = (_pairs(df, open_ones).groupBy("feature").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(value < low).alias("below"),
            F.count_if(value == low).alias("at_low"), F.count_if(inside).alias("inside"),
            F.count_if(value == high).alias("at_high"),
            F.percentile_approx(F.when(inside, value), grid, _ACCURACY).alias("grid")))
        following = {}
        for row in counted.collect():
            name = row["feature"]
            bracket = open_ones[name]._replace(
                below=row["below"], at_low=row["at_low"], inside=row["inside"],
                at_high=row["at_high"], wanted=positions(row["n"]))
            where = {bracket.place(p) for p in bracket.wanted}
            if "outside" in where:
                done[name] = last[name]
            elif "inside" not in where or bracket.inside <= PIECE_ROWS:
                done[name] = bracket
            else:
                last[name], following[name] = bracket, bracket.narrowed(row["grid"])
        if not following:
            return done
        open_ones = following
    return done | {name: last[name] for name in open_ones}


def order_statistics(df: DataFrame, columns: list[str],
                     positions: Callable[[int], tuple[int, ...]]) -> DataFrame:
    """(feature, position, value) of the wanted positions of every column, missing left out."""
    found = brackets_of(df, columns, positions)
    edges = [(name, p, getattr(b, b.place(p))) for name, b in found.items()
             for p in b.wanted if b.place(p) != "inside"]
    result = df.sparkSession.createDataFrame(
        edges, "feature string, position bigint, value double")
    pieces = {name: b for name, b in found.items()
              if any(b.place(p) == "inside" for p in b.wanted)}
    if not pieces:
        return result
    within = (_pairs(df, pieces)
              .filter((F.col("value") > F.col("low")) & (F.col("value") < F.col("high")))
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    so_far = (Window.partitionBy("feature").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, 0))
    start = F.element_at(_by_feature({name: b.below + b.at_low for name, b in pieces.items()}),
                         F.col("feature"))
    wanted = F.element_at(_by_feature({
        name: F.array(*[F.lit(p).cast("bigint") for p in b.wanted if b.place(p) == "inside"])
        for name, b in pieces.items()}), F.col("feature"))
    placed = within.withColumn("_end", start + F.sum("n").over(so_far))
    here = F.filter(wanted, lambda p: (p >= F.col("_end") - F.col("n")) & (p < F.col("_end")))
    return result.unionByName(
        placed.select("feature", F.explode(here).alias("position"), "value"))


def _by_feature(values: dict) -> Column:
    return F.create_map(*[item for name, value in values.items()
                          for item in (F.lit(name), value if isinstance(value, Column)
                                       else F.lit(value).cast("bigint"))])


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, median) of every column, missing values left out; no row if all are missing."""
    middle = order_statistics(df, columns, lambda n: tuple(sorted({(n - 1) // 2, n // 2})))
    return middle.groupBy("feature").agg(F.avg("value").alias("median"))


def _value_bin(value: Column) -> Column:
    """A monotone step of the value: 0.4 % of it, or finer than 0.001 around zero."""
    steps = F.signum(value) * F.log1p(F.abs(value) * F.lit(1000.0)) * F.lit(256.0)
    return F.floor(steps)


def medians_by_group(df: DataFrame, columns: list[str], part: Column, groups: dict
                     ) -> dict[object, dict[str, float]]:
    """{group: {column: median}} for groups that share parts, as training folds do.

    ``groups`` maps a group to the values of ``part`` it is made of. Rows are counted once per part
    and bin of values, whatever the number of groups a part is in; bins then say where each
    median lies, and only values in those bins are put in order. A bin with too many of them is
    left to ``exact_medians``. One row per group and column reaches the driver.
    """
    spark, keys, columns = df.sparkSession, list(groups), list(dict.fromkeys(columns))
    if not columns:
        return {key: {} for key in keys}
    used = df.withColumn("_part", part).filter(
        F.col("_part").isin(sorted({p for parts in groups.values() for p in parts})))
    kind = used.schema["_part"].dataType.simpleString()
    members = spark.createDataFrame(
        [(i, p) for i, key in enumerate(keys) for p in dict.fromkeys(groups[key])],
        f"_group int, _part {kind}")
    per_column = Window.partitionBy("_group", "feature")
    binned = (
        used.select("_part", _values_of({c: F.lit(True) for c in columns}))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("_part", "feature", _value_bin(F.col("value")).alias("_bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"),
             F.max("value").alias("high"))
        .join(members, "_part").groupBy("_group", "feature", "_bin")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("_end", F.sum("n").over(
            per_column.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_first", F.floor((F.sum("n").over(per_column) - 1) / 2))
        .withColumn("_last", F.floor(F.sum("n").over(per_column) / 2)))
    around = binned.filter((F.col("_end") > F.col("_first"))
                           & (F.col("_end") - F.col("n") <= F.col("_last")))
    found = around.groupBy("_group", "feature").agg(
        F.min(F.col("_end") - F.col("n")).alias("below"), F.sum("n").alias("n"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.first("_first").alias("first"), F.first("_last").alias("last")).collect()

    medians: dict[object, dict[str, float]] = {key: {} for key in keys}
    pieces, crowded = [], {}
    for row in found:
        if row["low"] == row["high"]:
            medians[keys[row["_group"]]][row["feature"]] = row["low"]
        elif row["n"] <= PIECE_ROWS:
            pieces.append(row)
        else:
            crowded.setdefault(row["_group"], []).append(row["feature"])
    if pieces:
        for row in _medians_inside(used, members, pieces).collect():
            medians[keys[row["_group"]]][row["feature"]] = row["median"]
    for group, names in crowded.items():
        rows = used.filter(F.col("_part").isin(list(groups[keys[group]])))
        for row in exact_medians(rows, names).collect():
            medians[keys[group]][row["feature"]] = row["median"]
    return medians


def _values_of(wanted: dict[str, Column]) -> Column:
    """A row of (feature, value) per column, without a value where it is not wanted."""
    return F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.when(here, F.col(c).cast("double")).alias("value"))
        for c, here in wanted.items()]))


def _medians_inside(used: DataFrame, members: DataFrame, pieces: list) -> DataFrame:
    """(_group, feature, median), where the values between ``low`` and ``high`` hold it."""
    wanted: dict[str, Column] = {}
    for low, high, name in sorted({(r["low"], r["high"], r["feature"]) for r in pieces}):
        here = F.col(name).cast("double").between(low, high)
        wanted[name] = wanted[name] | here if name in wanted else here
    limits = used.sparkSession.createDataFrame(
        [(r["_group"], r["feature"], r["low"], r["high"], r["below"], r["first"], r["last"])
         for r in pieces], "_group int, feature string, low double, high double, below bigint, "
                           "first bigint, last bigint")
    # Most rows have no value near any median and are left out before the others are taken apart.
    counted = (
        used.filter(reduce(or_, wanted.values())).select("_part", _values_of(wanted))
        .filter(F.col("value").isNotNull())
        .groupBy("_part", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
        .join(members, "_part").join(limits, ["_group", "feature"])
        .filter(F.col("value").between(F.col("low"), F.col("high")))
        .groupBy("_group", "feature", "below", "first", "last", "value")
        .agg(F.sum("n").alias("n")))
    so_far = (Window.partitionBy("_group", "feature").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("_end", F.col("below") + F.sum("n").over(so_far))
    here = F.filter(F.array_distinct(F.array("first", "last")),
                    lambda p: (p >= F.col("_end") - F.col("n")) & (p < F.col("_end")))
    return (placed.select("_group", "feature", "value", F.explode(here))
            .groupBy("_group", "feature").agg(F.avg("value").alias("median")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
