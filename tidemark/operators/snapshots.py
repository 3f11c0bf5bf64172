"""Point-in-time snapshots: one row per (customer, cutoff), all cutoffs in one plan.

Features read only lines before the cutoff, labels only lines in ``[cutoff, cutoff + horizon)``.

How the work is laid out. The cutoffs cut time into *epochs*: a line of epoch ``e`` is past for
the cutoffs number ``e, e+1, ...`` in time order. So no line is copied once per cutoff. Lines are
shuffled once, by customer, to as many tasks as their number asks for; all that follows happens
in place. Only customers with very many lines take a longer way: they are spread over *cells*,
and what is left of them is shuffled again. Lines are reduced to *parts*: orders, countries and
(for spread customers) products, each per epoch, in one stream of rows. Parts become *facts*,
whose number per customer has a bound given by the calendar (days, cutoffs, countries) and not
by how much the customer buys:

* orders, per (customer, day): an order's date never changes once seen, and the gap between two
  orders on one day is zero whole days, so a day's orders can be merged without loss;
* products bought for the first time, per (customer, epoch);
* line sums per (customer, country, epoch), which also give the modal country;
* buyers per (customer, cutoff), for the label.

Facts of a customer are in one place. There they are merged by the range of
cutoffs they count for, and only the merged rows are fanned out to the cutoffs. A customer with
a third of all lines costs the same there as any other.
"""

from __future__ import annotations

from datetime import timedelta
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import MONEY_DECIMALS, WINDOW_DAYS, SnapshotSettings, parse_cutoffs
from tidemark.functions.scalars import at_least_one, count_reached, timestamp, whole_days
from tidemark.operators.ranking import union_all
from tidemark.session import tasks_for

# The public names of the 33 features, by block.
RFM = ["frequency", "monetary", "avg_order_value", "std_order_value", "max_order_value",
       "avg_items", "avg_products", "recency_days", "tenure_days", "revenue_per_tenure_day"]
CADENCE = ["mean_gap_days", "std_gap_days", "min_gap_days", "max_gap_days", "gap_cv",
           "recency_vs_gap"]
WINDOW = ([f"{name}_last_{days}d" for days in WINDOW_DAYS for name in ("orders", "revenue")]
          + ["order_momentum", "revenue_momentum", "orders_90d_vs_180d"])
BREADTH = ["distinct_products", "total_units", "avg_unit_price", "products_per_order"]
MARKET = ["is_uk", "is_export"]
FEATURE_BLOCKS = {"rfm": RFM, "cadence": CADENCE, "window": WINDOW,
                  "breadth": BREADTH, "market": MARKET}
FEATURES = RFM + CADENCE + WINDOW + BREADTH + MARKET
_COUNTS = {"frequency", "recency_days", "tenure_days", "min_gap_days", "max_gap_days",
           "distinct_products", "total_units", *[f"orders_last_{d}d" for d in WINDOW_DAYS]}
# Column types of a stored snapshot table.
SNAPSHOT_SCHEMA = "customer_id bigint, " + ", ".join(
    f"{name} {'int' if name in MARKET else 'bigint' if name in _COUNTS else 'double'}"
    for name in FEATURES) + ", label int, cutoff timestamp_ntz"
NOT_FEATURES = ("customer_id", "label", "cutoff")

_MINOR = 10 ** MONEY_DECIMALS

#: A customer with more lines is spread over several cells; this many customers at most are, those
#: with the most lines, so that their list stays small however long the table is.
CELL_LINES = 1 << 17
SPREAD_CUSTOMERS = 1000
# The smallest pieces of lines that may be merged, and how their measures combine.
GRAIN = ["customer_id", "invoice_no", "stock_code", "country", "epoch"]
CUSTOMER = ("customer_id",)
MEASURES = {"order_date": F.min, "value": F.sum, "items": F.sum, "lines": F.sum,
            "priced": F.sum, "prices": F.sum, "first_open": F.min}
_ORDER, _COUNTRY, _PRODUCT = 0, 1, 2


def feature_columns(snapshots: DataFrame) -> list[str]:
    """All columns but the identifiers and the label. The cutoff is no feature on purpose."""
    return [c for c in snapshots.columns if c not in NOT_FEATURES]


# ---------------------------------------------------------------------------------------------
# Slices of time
# ---------------------------------------------------------------------------------------------
def past_slice(transactions: DataFrame, cutoff) -> DataFrame:
    """Lines strictly before one cutoff."""
    [moment] = parse_cutoffs([cutoff])
    return transactions.filter(F.col("invoice_date") < timestamp(moment))


def outcome_slice(transactions: DataFrame, cutoff, horizon_days: int) -> DataFrame:
    """Lines in the half-open outcome window of one cutoff."""
    [moment] = parse_cutoffs([cutoff])
    date = F.col("invoice_date")
    return transactions.filter(
        (date >= timestamp(moment)) & (date < timestamp(moment + timedelta(days=horizon_days))))


def with_epoch(transactions: DataFrame, cutoffs) -> DataFrame:
    """Lines that are past for at least one cutoff, with their epoch."""
    moments = parse_cutoffs(cutoffs)
    return (transactions.filter(F.col("invoice_date") < timestamp(moments[-1]))
            .withColumn("epoch", count_reached("invoice_date", moments)))


def _cutoff_at(position, moments) -> Column:
    return F.element_at(F.array(*[timestamp(m) for m in moments]), position + F.lit(1))


# ---------------------------------------------------------------------------------------------
# From lines to parts
# ---------------------------------------------------------------------------------------------
def line_grains(transactions: DataFrame, cutoffs, horizon_days: int | None = None,
                also: tuple[str, ...] = ()) -> DataFrame:
    """Lines with their epoch and measures, as far as a cutoff or outcome window looks at them.
    Columns named in ``also`` are kept.

    ``first_open`` is the number of outcome windows that have ended: together with the epoch it
    gives the cutoffs for which the line counts as an outcome.
    """
    moments = parse_cutoffs(cutoffs)
    ends = [m + timedelta(days=horizon_days or 0) for m in moments]
    epoch = count_reached("invoice_date", moments)
    one = F.lit(1).cast("bigint")
    return transactions.filter(F.col("invoice_date") < timestamp(ends[-1])).select(
        "customer_id", *also, "invoice_no", "stock_code", "country", epoch.alias("epoch"),
        F.col("invoice_date").alias("order_date"),
        F.rint(F.col("line_revenue") * _MINOR).cast("bigint").alias("value"),
        F.col("quantity").alias("items"), one.alias("lines"),
        F.when(F.col("unit_price").isNotNull(), one).alias("priced"),
        F.col("unit_price").alias("prices"),
        (count_reached("invoice_date", ends) if horizon_days is not None else epoch)
        .alias("first_open"))


def placed(lines: DataFrame, copies: int = 1) -> list[tuple[DataFrame, bool]]:
    """Lines with every customer's brought together, and whether these customers are spread.

    Customers with very many lines, if there are any, are a frame of their own: equal parts of
    them lie together, numbered in ``cell``. Lines are counted first, so that a task gets no more
    of them in a longer table. ``copies`` is how many rows each is to become in its place.
    """
    spark, most = lines.sparkSession, max(1, CELL_LINES // copies)
    tasks = tasks_for(spark, lines.count() * copies)
    large = (lines.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_lines"))
             .filter(F.col("customer_id").isNotNull() & (F.col("_lines") > most))
             .orderBy(F.desc("_lines"), "customer_id").limit(SPREAD_CUSTOMERS).collect())
    if not large:
        return [(lines.repartition(tasks, "customer_id"), False)]
    # Bounded by its limit, so it can be sent to all tasks.
    cells = spark.createDataFrame(
        [(r["customer_id"], ceil(r["_lines"] / most)) for r in large],
        T.StructType([T.StructField("customer_id", lines.schema["customer_id"].dataType),
                      T.StructField("_cells", T.LongType())]))
    dealt = lines.join(F.broadcast(cells), "customer_id", "left")
    cell = F.pmod(F.xxhash64("invoice_no", "stock_code"), F.col("_cells"))
    return [(dealt.filter(F.col("_cells").isNull()).drop("_cells")
             .repartition(tasks, "customer_id"), False),
            (dealt.filter(F.col("_cells").isNotNull()).withColumn("cell", cell).drop("_cells")
             .repartition(tasks, "customer_id", "cell"), True)]


def _parts(grains: DataFrame, spread: bool, last: int, keys: tuple[str, ...]) -> DataFrame:
    """Orders, countries and products of every customer and epoch: one row per (customer, kind,
    id, epoch). The lines are ``placed``; only parts of spread customers are shuffled again."""
    place = [*keys, "cell"] if spread else [*keys]
    # A product counts once per order and once per customer, from the epoch of its first line on.
    # One order of rows serves both: a cell is sorted once.
    of_product = Window.partitionBy(*place, "stock_code")
    in_order = of_product.orderBy("invoice_no", "epoch")
    known = F.col("stock_code").isNotNull()
    numbered = grains.select(
        "*", F.row_number().over(in_order).alias("_row"),
        F.lag("invoice_no").over(in_order).alias("_previous"))
    # Earliest epoch first, and a single row of those.
    when_bought = F.shiftleft(F.col("epoch").cast("bigint"), 40) + F.col("_row")
    marked = numbered.select(
        "*", (known & (F.min(when_bought).over(of_product) == when_bought)).alias("_first_line"),
        (known & ((F.col("_row") == 1) | ~F.col("invoice_no").eqNullSafe(F.col("_previous"))))
        .cast("bigint").alias("products"))
    # A customer spread over cells may have bought a product in several of them: its products
    # travel on by name. A customer in one cell only needs their number. The rest is the same
    # for all lines of an order in an epoch.
    nothing = F.lit(None).cast("string")
    product = F.when(F.col("_first_line"), F.col("stock_code")) if spread else nothing
    by_product = [product.alias("product")] if spread else []
    merged = marked.groupBy(*place, "invoice_no", "country", "epoch", *by_product).agg(
        *[combine(name).alias(name) for name, combine in MEASURES.items()],
        F.sum("products").alias("products"),
        F.count_if(F.lit(False) if spread else F.col("_first_line")).alias("new_products"))
    if not spread:
        merged = merged.withColumn("product", nothing)
    kind, past = F.col("kind"), F.col("epoch") < last
    kinds = F.when(F.col("product").isNotNull(),
                   F.array(F.lit(_ORDER), F.lit(_COUNTRY), F.lit(_PRODUCT))) \
        .otherwise(F.array(F.lit(_ORDER), F.lit(_COUNTRY)))
    exists = (F.when(kind == _ORDER, past & F.col("invoice_no").isNotNull())
              .when(kind == _PRODUCT, past).otherwise(True))
    own = {"order_date": _ORDER, "value": _ORDER, "products": _ORDER, "lines": _COUNTRY,
           "priced": _COUNTRY, "prices": _COUNTRY, "first_open": _COUNTRY,
           "new_products": _COUNTRY}
    combined = {**MEASURES, "products": F.sum, "new_products": F.sum}
    sums = [combine(name).alias(name) for name, combine in combined.items()]
    key = [*keys, "kind", "id"]
    parts = (merged.withColumn("kind", F.explode(kinds)).filter(exists)
            .select(*place, "kind", "epoch",
                    F.when(kind == _ORDER, F.col("invoice_no"))
                    .when(kind == _COUNTRY, F.col("country")).otherwise(F.col("product"))
                    .alias("id"),
                    F.when(kind != _PRODUCT, F.col("items")).alias("items"),
                    *[F.when(kind == k, F.col(name)).alias(name) for name, k in own.items()])
            .groupBy(*place, "kind", "id", "epoch").agg(*sums))
    # Combined within each cell first, so that a customer's one country is no hot key.
    return parts.repartition(*key).groupBy(*key, "epoch").agg(*sums) if spread else parts


# ---------------------------------------------------------------------------------------------
# Orders
# ---------------------------------------------------------------------------------------------
def _states(parts: DataFrame, last: int, keys: tuple[str, ...]) -> DataFrame:
    """Parts with, for orders, their state from this epoch on and the epoch that replaces it."""
    # At most one row per cutoff in each window partition.
    by_epoch = Window.partitionBy(*keys, "kind", "id").orderBy("epoch")
    so_far = by_epoch.rowsBetween(Window.unboundedPreceding, 0)
    is_order = F.col("kind") == _ORDER

    def running(name: str, combined: Column) -> Column:
        return F.when(is_order, combined).otherwise(F.col(name)).alias(name)

    return parts.select(
        *keys, "kind", "id", F.col("epoch").alias("valid_from"),
        F.when(is_order, F.lead("epoch", 1, last).over(by_epoch)).otherwise(F.lit(last))
        .alias("valid_to"),
        (F.row_number().over(by_epoch) == 1).alias("is_first"),
        running("order_date", F.first("order_date").over(so_far)),
        *[running(c, F.sum(c).over(so_far)) for c in ("value", "items", "products")],
        "new_products", "lines", "priced", "prices", "first_open")


def order_versions(transactions: DataFrame, cutoffs) -> DataFrame:
    """Orders as they looked over time: one row per (customer, invoice, state).

    An invoice with lines on both sides of a cutoff has one state before and another after it.
    A state holds for cutoffs ``valid_from <= i < valid_to`` (positions in time order). Lines
    without an invoice number belong to no order.
    """
    moments = parse_cutoffs(cutoffs)
    last = len(moments)
    states = union_all([_states(_parts(grains, spread, last, CUSTOMER), last, CUSTOMER)
                        for grains, spread in placed(line_grains(transactions, moments))])
    return states.filter(F.col("kind") == _ORDER).select(
        "customer_id", F.col("id").alias("invoice_no"), "order_date", "valid_from", "valid_to",
        "is_first", "value", "items", "products")


def orders_at_cutoffs(transactions: DataFrame, cutoffs) -> DataFrame:
    """The order table of every cutoff: (cutoff, customer, invoice) with value, items, products."""
    moments = parse_cutoffs(cutoffs)
    versions = order_versions(transactions, moments)
    return (
        versions
        .withColumn("at", F.explode(F.sequence("valid_from", F.col("valid_to") - 1)))
        .select(_cutoff_at(F.col("at"), moments).alias("cutoff"), "customer_id", "invoice_no",
                "order_date", (F.col("value") / _MINOR).alias("order_value"),
                F.col("items").alias("order_items"), F.col("products").alias("order_products")))


# ---------------------------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------------------------
def _facts(grains: DataFrame, moments, windows) -> DataFrame:
    """The facts of lines that lie anywhere."""
    return union_all([_facts_of(lines, spread, moments, windows, CUSTOMER)
                      for lines, spread in placed(grains)])


def _facts_of(grains: DataFrame, spread: bool, moments, windows, keys: tuple[str, ...]
              ) -> DataFrame:
    """The parts as rows that hold for a range of cutoffs, merged per customer and day.

    Days are split at cutoffs and window edges that do not fall on midnight, so all orders of
    a row lie on one side of every edge.
    """
    last = len(moments)
    edges = sorted({m - timedelta(days=d) for m in moments for d in (0, *windows)})
    inner_edges = [e for e in edges if (e.hour, e.minute, e.second, e.microsecond) != (0, 0, 0, 0)]
    kind, one = F.col("kind"), F.lit(1).cast("bigint")
    is_order, is_country = kind == _ORDER, kind == _COUNTRY
    is_first_product = (kind == _PRODUCT) & F.col("is_first")
    states = _states(_parts(grains, spread, last, keys), last, keys)
    # The cutoffs at or before a line whose window has not ended follow one another. A line of
    # a country is a fact of its own if it is past for some cutoff.
    own = F.when(is_order | is_first_product | (is_country & (F.col("valid_from") < last)),
                 F.array(F.lit(-1))).otherwise(F.array().cast("array<int>"))
    bought = F.when(is_country & (F.col("first_open") < F.col("valid_from")), F.concat(
        own, F.sequence("first_open", F.col("valid_from") - 1))).otherwise(own)
    rows = states.withColumn("at", F.explode(bought))
    is_own = F.col("at") < 0

    def of(condition: Column, value) -> Column:
        return F.when(is_own & condition, value)

    return (
        rows
        .groupBy(*keys, "kind", of(is_country, F.col("id")).alias("country"),
                 of(is_order, F.to_date("order_date")).alias("day"),
                 of(is_order, count_reached("order_date", inner_edges)).alias("part"),
                 F.when(is_own, F.col("valid_from")).otherwise(F.col("at")).alias("valid_from"),
                 F.when(is_own, F.col("valid_to")).otherwise(F.col("at") + 1).alias("valid_to"),
                 F.when(~is_own, 1).alias("bought"))
        .agg(F.sum(of(is_order, one)).alias("orders"),
             F.sum(of(is_order, F.col("is_first").cast("bigint"))).alias("new_orders"),
             F.min(of(is_order, F.col("order_date"))).alias("first_date"),
             F.max(of(is_order, F.col("order_date"))).alias("last_date"),
             F.sum(of(is_order, F.col("value"))).alias("value"),
             F.max(of(is_order, F.col("value"))).alias("max_value"),
             (F.var_pop(of(is_order, F.col("value"))) * F.sum(of(is_order, one))).alias("spread"),
             F.sum(of(is_order, F.col("items"))).alias("items"),
             F.sum(of(is_order, F.col("products"))).alias("products"),
             F.sum(F.when(is_own, F.when(is_first_product, one).otherwise(F.col("new_products"))))
             .alias("new_products"),
             F.sum(of(is_country, F.col("lines"))).alias("country_lines"),
             F.sum(of(is_country, F.col("priced"))).alias("lines"),
             F.sum(of(is_country, F.col("items"))).alias("units"),
             F.sum(of(is_country, F.col("prices"))).alias("prices"))
        .drop("kind", "day", "part"))


def buyers(transactions: DataFrame, cutoffs, horizon_days: int) -> DataFrame:
    """Distinct (customer, cutoff position) with a line in that cutoff's outcome window."""
    moments = parse_cutoffs(cutoffs)
    ends = [m + timedelta(days=horizon_days) for m in moments]
    # The cutoffs at or before a line whose window has not ended follow one another.
    first, past = count_reached("invoice_date", ends), count_reached("invoice_date", moments)
    return (
        transactions
        .filter((F.col("invoice_date") >= timestamp(moments[0]))
                & (F.col("invoice_date") < timestamp(ends[-1])))
        .select("customer_id", first.alias("first"), past.alias("past"))
        .filter(F.col("first") < F.col("past"))
        .select("customer_id", F.explode(F.sequence("first", F.col("past") - 1)).alias("at"))
        .distinct())


# ---------------------------------------------------------------------------------------------
# From facts to features
# ---------------------------------------------------------------------------------------------
def _with_running_facts(facts: DataFrame, last: int, home_market: str, keys: tuple[str, ...]
                        ) -> DataFrame:
    """Facts, a customer's in one place, with what depends on the facts before: the gap to the
    previous order, an anchor for the variance, and the lines per country so far."""
    in_time = Window.partitionBy(*keys, "country").orderBy(
        "valid_from", F.col("first_date").asc_nulls_last(), "valid_to")
    before = in_time.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_time.rowsBetween(Window.unboundedPreceding, 0)
    is_country = F.col("country").isNotNull()
    previous = F.max("last_date").over(before)
    anchor = F.first(F.col("value") / F.col("orders"), ignorenulls=True).over(so_far)
    # The modal country is the home market if no other country has more lines, and none whose
    # name sorts first has as many; so three counts decide it and no name has to travel on.
    home = F.lit(home_market)
    sides = {"home_lines": F.col("country") == home,
             "lines_before_home": F.col("country") < home,
             "lines_after_home": F.col("country") > home}
    return facts.select(
        *[c for c in facts.columns if c != "country"],
        F.when(F.col("new_orders") > 0, whole_days(previous, F.col("first_date"))).alias("gap"),
        anchor.alias("anchor"),
        *[F.when(side, F.sum("country_lines").over(so_far)).alias(name)
          for name, side in sides.items()],
        F.when(is_country, F.lead("valid_from", 1, last).over(in_time))
        .otherwise(F.col("valid_to")).alias("holds_to"))


# How the columns of spans combine: those of an order state or country total, which end when it
# is replaced, and those that hold on.
_STATE = {"orders": F.sum, "value": F.sum, "items": F.sum, "products": F.sum, "shift_1": F.sum,
          "shift_2": F.sum, "max_value": F.max, "home_lines": F.max, "lines_before_home": F.max,
          "lines_after_home": F.max}
_LASTING = {"first_date": F.min, "last_date": F.max, "new_orders": F.sum, "gap_1": F.sum,
            "gap_2": F.sum, "gap_min": F.min, "gap_max": F.max, "new_products": F.sum,
            "units": F.sum, "prices": F.sum, "lines": F.sum, "bought": F.max}


def _spans(gathered: DataFrame, moments, windows, keys: tuple[str, ...]) -> DataFrame:
    """Merge a customer's facts by the range of cutoffs they count for.

    A fact gives one row for its whole range ``[starts, until)`` (its state columns only up to
    ``holds_to``), and, if it is an order, one more for each cutoff whose trailing windows it
    falls into. Old orders therefore cost one row, however many cutoffs follow.
    """
    last = len(moments)
    starts, holds_to = F.col("valid_from"), F.col("holds_to")
    in_windows = F.least(holds_to, F.coalesce(
        count_reached("first_date", [m - timedelta(days=max(windows)) for m in moments]),
        F.lit(0)))
    until = F.when((F.col("new_orders") > 0) | F.col("country_lines").isNotNull(), F.lit(last)) \
        .otherwise(holds_to)
    single = F.col("value") / F.col("orders") - F.col("anchor")
    gap, zero = F.col("gap"), F.lit(0).cast("bigint")
    # Further orders on the same day follow after zero days.
    same_day = F.when(F.col("new_orders") > 1, zero)
    whole_values = {
        "shift_1": F.col("orders") * single,
        "shift_2": F.col("spread") + F.col("orders") * single * single,
        "gap_1": gap, "gap_2": gap * gap, "gap_min": F.coalesce(same_day, gap),
        "gap_max": F.greatest(gap, same_day)}
    rows = gathered.withColumn("at", F.explode(F.sequence(
        starts - 1, F.greatest(starts, in_windows) - 1)))
    whole = F.col("at") < starts
    cutoff = _cutoff_at(F.greatest(F.col("at"), F.lit(0)), moments)

    def inside(days: int, name: str) -> Column:
        edge = cutoff - F.make_dt_interval(F.lit(days))
        return F.when(~whole & (F.col("first_date") >= edge), F.col(name))

    in_window = {f"{name}_{days}": inside(days, name)
                 for days in windows for name in ("orders", "value")}
    how = {**_STATE, **_LASTING}
    return (
        rows.groupBy(
            *keys, F.when(whole, starts).otherwise(F.col("at")).alias("starts"),
            F.when(whole, holds_to).otherwise(F.col("at") + 1).alias("holds_to"),
            F.when(whole, until).otherwise(F.col("at") + 1).alias("until"))
        .agg(*[combine(F.when(whole, whole_values.get(name, F.col(name)))).alias(name)
               for name, combine in how.items()],
             *[F.sum(column).alias(name) for name, column in in_window.items()]))


def _at_cutoffs(spans: DataFrame, moments, windows, keys: tuple[str, ...]) -> DataFrame:
    """Fan the merged spans out to their cutoffs: one row per (customer, cutoff)."""
    holds = F.col("at") < F.col("holds_to")
    return (
        spans
        .withColumn("at", F.explode(F.sequence(F.col("starts"), F.col("until") - 1)))
        .groupBy(*keys, "at")
        .agg(*[combine(F.when(holds, F.col(name))).alias(name)
               for name, combine in _STATE.items()],
             *[combine(name).alias(name) for name, combine in _LASTING.items()],
             *[F.coalesce(F.sum(f"{name}_{days}"), F.lit(0).cast("bigint"))
               .alias(f"{name}_{days}") for days in windows for name in ("orders", "value")])
        .filter(F.col("orders") > 0)
        .withColumn("cutoff", _cutoff_at(F.col("at"), moments)))


def _features(sums: DataFrame, windows, keys: tuple[str, ...]) -> DataFrame:
    n = F.col("orders").cast("double")
    gaps = (F.col("new_orders") - 1).cast("double")
    has_gap = F.col("new_orders") > 1
    g1 = F.coalesce(F.col("gap_1"), F.lit(0).cast("bigint")).cast("double")
    g2 = F.coalesce(F.col("gap_2"), F.lit(0).cast("bigint")).cast("double")
    order_spread = F.col("shift_2") - F.col("shift_1") * F.col("shift_1") / n
    gap_spread = g2 - g1 * g1 / gaps

    none = F.lit(0).cast("bigint")

    def std(spread: Column, count: Column) -> Column:
        return F.when(count > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (count - 1))) \
            .otherwise(F.lit(0.0))

    first = sums.select(
        "*",
        whole_days("last_date", "cutoff").alias("recency_days"),
        whole_days("first_date", "cutoff").alias("tenure_days"),
        (F.col("value") / _MINOR).alias("monetary"),
        F.when(has_gap, g1 / gaps).alias("mean_gap_days"),
        F.when(has_gap, std(gap_spread, gaps)).otherwise(F.lit(0.0)).alias("std_gap_days"),
        *[(F.col(f"value_{d}") / _MINOR).alias(f"revenue_last_{d}d") for d in windows],
        *[F.col(f"orders_{d}").alias(f"orders_last_{d}d") for d in windows],
        F.when((F.col("home_lines") > F.coalesce("lines_before_home", none))
               & (F.col("home_lines") >= F.coalesce("lines_after_home", none)), 1)
        .otherwise(0).alias("is_uk"))

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole).cast("double"), F.lit(1.0))

    derived = {
        "frequency": F.col("orders"),
        "avg_order_value": F.col("monetary") / n,
        "std_order_value": std(order_spread, n) / _MINOR,
        "max_order_value": F.col("max_value") / _MINOR,
        "avg_items": F.col("items") / n,
        "avg_products": F.col("products") / n,
        "revenue_per_tenure_day": share("monetary", "tenure_days"),
        "min_gap_days": F.when(has_gap, F.col("gap_min")),
        "max_gap_days": F.when(has_gap, F.col("gap_max")),
        "gap_cv": F.try_divide(F.col("std_gap_days"), F.col("mean_gap_days")),
        "recency_vs_gap": F.col("recency_days") / at_least_one("mean_gap_days"),
        "order_momentum": share("orders_last_30d", "orders_last_90d"),
        "revenue_momentum": share("revenue_last_30d", "revenue_last_90d"),
        "orders_90d_vs_180d": share("orders_last_90d", "orders_last_180d"),
        "distinct_products": F.coalesce(F.col("new_products"), F.lit(0).cast("bigint")),
        "total_units": F.col("units"),
        "avg_unit_price": F.try_divide(F.col("prices"), F.col("lines")),
        "products_per_order":
            F.coalesce(F.col("new_products"), F.lit(0).cast("bigint"))
            / F.greatest(n, F.lit(1.0)),
        "is_export": F.lit(1) - F.col("is_uk"),
    }
    return first.select(
        *keys,
        *[derived.get(name, F.col(name)).alias(name) for name in FEATURES],
        F.coalesce(F.col("bought"), F.lit(0)).alias("label"), "cutoff")


def build_snapshots(transactions: DataFrame, settings: SnapshotSettings = SnapshotSettings(),
                    require_history: bool = True, spread: bool | None = None,
                    keys: tuple[str, ...] = CUSTOMER) -> DataFrame:
    """All (customer, cutoff) rows with 33 features and the label.

    ``require_history`` checks first that every cutoff has past lines, and raises if not. Lines
    that are ``placed`` already come with what is known of them as ``spread``, and ``keys`` may
    tell several copies of a customer apart.
    """
    moments = settings.ordered_cutoffs()
    if require_history:
        check_history(transactions, moments)
    also = (*keys[1:], *(["cell"] if spread else []))
    return from_grains(line_grains(transactions, moments, settings.horizon_days, also), moments,
                       settings, spread, keys)


def from_grains(grains: DataFrame, moments, settings: SnapshotSettings,
                spread: bool | None = None, keys: tuple[str, ...] = CUSTOMER) -> DataFrame:
    """The snapshots of ``moments`` from lines, or merged lines, as ``line_grains`` gives them."""
    return _fold(grains, moments, settings.min_history_days, settings.home_market, spread, keys)


def _fold(grains: DataFrame, moments, min_history_days: int, home_market: str,
          spread: bool | None = None, keys: tuple[str, ...] = CUSTOMER) -> DataFrame:
    """Place lines by customer if they are not yet, turn them into facts, fan those out to
    cutoffs, and fold them into features."""
    return union_all([
        _fold_placed(lines, is_spread, moments, min_history_days, home_market, keys)
        for lines, is_spread in (placed(grains) if spread is None else [(grains, spread)])])


def _fold_placed(grains: DataFrame, spread: bool, moments, min_history_days: int,
                 home_market: str, keys: tuple[str, ...]) -> DataFrame:
    facts = _facts_of(grains, spread, moments, WINDOW_DAYS, keys)
    if spread:
        facts = facts.repartition("customer_id")
    gathered = _with_running_facts(facts, len(moments), home_market, keys)
    sums = _at_cutoffs(_spans(gathered, moments, WINDOW_DAYS, keys), moments, WINDOW_DAYS, keys)
    return (_features(sums, WINDOW_DAYS, keys)
            .filter(F.col("tenure_days") >= min_history_days))


def snapshot(transactions: DataFrame, cutoff, horizon_days: int = 30, min_history_days: int = 30,
             home_market: str = "United Kingdom", require_history: bool = True,
             spread: bool | None = None, keys: tuple[str, ...] = CUSTOMER) -> DataFrame:
    """The snapshot of one cutoff."""
    return build_snapshots(
        transactions,
        SnapshotSettings((cutoff,), horizon_days, min_history_days, home_market), require_history,
        spread, keys)


def build_features(transactions: DataFrame, cutoffs, home_market: str = "United Kingdom",
                   blocks=tuple(FEATURE_BLOCKS)) -> DataFrame:
    """Feature blocks for every customer with past orders, without label or history filter."""
    names = [name for block in blocks for name in FEATURE_BLOCKS[block]]
    moments = parse_cutoffs(cutoffs)
    return _fold(line_grains(transactions, moments), moments, 0, home_market).select(
        "customer_id", "cutoff", *names)


def build_labels(transactions: DataFrame, customers: DataFrame, cutoffs,
                 horizon_days: int) -> DataFrame:
    """``customers`` (customer_id, cutoff) with label 1 where the outcome window has a line."""
    moments = parse_cutoffs(cutoffs)
    bought = buyers(transactions, moments, horizon_days).select(
        "customer_id", _cutoff_at(F.col("at"), moments).alias("cutoff"), F.lit(1).alias("label"))
    return (customers.join(bought, ["customer_id", "cutoff"], "left")
            .withColumn("label", F.coalesce("label", F.lit(0))))


# ---------------------------------------------------------------------------------------------
# Guards
# ---------------------------------------------------------------------------------------------
def cutoff_history(transactions: DataFrame, cutoffs) -> DataFrame:
    """Past and outcome-side line counts per cutoff, from one aggregation."""
    moments = parse_cutoffs(cutoffs)
    date = F.col("invoice_date")
    counts = transactions.agg(
        F.count(F.lit(1)).alias("all_lines"),
        *[F.count_if(date < timestamp(m)).alias(f"past_{i}") for i, m in enumerate(moments)])
    rows = F.array(*[F.struct(timestamp(m).alias("cutoff"), F.col(f"past_{i}").alias("past_lines"),
                              (F.col("all_lines") - F.col(f"past_{i}")).alias("later_lines"))
                     for i, m in enumerate(moments)])
    return counts.select(F.inline(rows))


def check_history(transactions: DataFrame, cutoffs) -> None:
    """Raise if some cutoff has no line before it."""
    moments = parse_cutoffs(cutoffs)
    first = transactions.agg(F.min("invoice_date").alias("first")).first()["first"]
    for moment in moments:
        if first is None or first >= moment:
            raise ValueError(f"no history before {moment:%Y-%m-%d}")


def check_label_maturity(transactions: DataFrame, cutoffs, horizon_days: int) -> None:
    """Opt-in: raise if the data ends inside the last outcome window (labels would read 0)."""
    end = parse_cutoffs(cutoffs)[-1] + timedelta(days=horizon_days)
    last = transactions.agg(F.max("invoice_date").alias("last")).first()["last"]
    if last is None or last < end:
        raise ValueError(f"outcome window ends {end:%Y-%m-%d}, data ends {last}")
