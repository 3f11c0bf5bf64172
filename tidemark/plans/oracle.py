"""Plain SQL statements of the registered queries, written from the definitions.

They join every line with every later cutoff and use single-node windows freely: short to check
by eye, and a different route to each result than the Spark plans take.
"""

from __future__ import annotations

from tidemark.config import CAPACITIES, CONTACT_COST, INCREMENTAL_MARGIN, WINDOW_DAYS
from tidemark.operators.clean import NON_PRODUCT_CODES, NON_PRODUCT_PREFIXES
from tidemark.operators.snapshots import FEATURE_BLOCKS, FEATURES
from tidemark.sources.views import (EVENT_SETTINGS, HOME, ORDER_CUTOFFS, ORDER_DEV,
                                    ORDER_HOLDOUT, ORDER_SETTINGS)

# ---------------------------------------------------------------------------------------------
# Transactions
# ---------------------------------------------------------------------------------------------
_LINES = """lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

ORDER_TX = f"""tx AS (
  SELECT o_custkey AS customer_id, CAST(o_orderkey AS VARCHAR) AS invoice_no,
    o_orderdate AS invoice_date, CAST(l_partkey AS VARCHAR) AS stock_code,
    CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS unit_price,
    n_name AS country,
    round_even(l_quantity * (l_extendedprice / l_quantity) * 100, 0) / 100 AS line_revenue
  FROM {_LINES})"""

EVENT_TX = f"""tx AS (
  SELECT user_id AS customer_id, CAST(event_id AS VARCHAR) AS invoice_no, ts AS invoice_date,
    event_type AS stock_code, CAST(1 AS BIGINT) AS quantity, value AS unit_price,
    '{HOME}' AS country, round_even(value * 100, 0) / 100 AS line_revenue
  FROM events WHERE event_type = 'purchase')"""

SESSION_TX = f"""tx AS (
  SELECT user_id AS customer_id,
    CASE WHEN event_id % 17 <> 0 THEN
      CAST(user_id AS VARCHAR) || '-' || CAST(CAST(floor(dayofyear(ts) / 5) AS BIGINT) AS VARCHAR)
    END AS invoice_no,
    ts AS invoice_date, event_type || '-' || CAST(event_id % 4 AS VARCHAR) AS stock_code,
    event_id % 5 + 1 AS quantity, value AS unit_price,
    CASE WHEN event_type = 'click' THEN '{HOME}'
      ELSE 'NATION_' || CAST(event_id % 3 AS VARCHAR) END AS country,
    round_even((event_id % 5 + 1) * value * 100, 0) / 100 AS line_revenue
  FROM events)"""

_CODES = ", ".join(f"'{c}'" for c in NON_PRODUCT_CODES)
_NO_PREFIX = " AND ".join(f"NOT starts_with(stock_code, '{p}')" for p in NON_PRODUCT_PREFIXES)

DIRTY_TX = f"""extract AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR)
      AS invoice_no,
    CASE WHEN l_linenumber = 2 THEN chr(9) || code || ' ' ELSE code END AS padded_code,
    l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, o_orderdate AS invoice_date,
    l_extendedprice / l_quantity AS unit_price,
    CASE WHEN o_orderkey % 20 <> 0 THEN o_custkey END AS customer_id, n_name AS country
  FROM (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN 'POST' ELSE CAST(l_partkey AS VARCHAR) END
          AS code
        FROM {_LINES} JOIN part ON l_partkey = p_partkey)),
twice AS (SELECT * FROM extract UNION ALL SELECT * FROM extract WHERE l_linenumber = 1),
sales AS (
  SELECT DISTINCT customer_id, trim(invoice_no) AS invoice_no, invoice_date,
    regexp_replace(padded_code, '^\\s+|\\s+$', '', 'g') AS stock_code, quantity, unit_price,
    country
  FROM twice),
tx AS (
  SELECT *, round_even(quantity * unit_price * 100, 0) / 100 AS line_revenue FROM sales
  WHERE coalesce(stock_code NOT IN ({_CODES}) AND {_NO_PREFIX}, TRUE)
    AND coalesce(NOT starts_with(invoice_no, 'C'), TRUE)
    AND quantity > 0 AND unit_price > 0 AND customer_id IS NOT NULL)"""


# ---------------------------------------------------------------------------------------------
# Snapshots
# ---------------------------------------------------------------------------------------------
def cutoff_values(cutoffs) -> str:
    rows = ", ".join(f"(TIMESTAMP '{str(c).replace('T', ' ')}')" for c in cutoffs)
    return f"cutoffs AS (SELECT * FROM (VALUES {rows}) AS v(cutoff))"


ORDER_LEVEL = """past AS (SELECT * FROM tx JOIN cutoffs ON invoice_date < cutoff),
ord AS (
  SELECT cutoff, customer_id, invoice_no, min(invoice_date) AS order_date,
    CAST(sum(CAST(line_revenue AS DECIMAL(18, 2))) AS DOUBLE) AS order_value,
    CAST(sum(quantity) AS BIGINT) AS order_items, count(DISTINCT stock_code) AS order_products
  FROM past WHERE invoice_no IS NOT NULL GROUP BY ALL)"""


def _blocks(home: str) -> str:
    windows = ",\n    ".join(
        f"count(*) FILTER (WHERE {inside}) AS orders_last_{d}d,\n    "
        f"CAST(coalesce(sum(CAST(order_value AS DECIMAL(18, 2))) FILTER (WHERE {inside}), 0) "
        f"AS DOUBLE) AS revenue_last_{d}d"
        for d in WINDOW_DAYS for inside in [f"order_date >= cutoff - INTERVAL {d} DAY"])
    return f"""{ORDER_LEVEL},
rfm0 AS (
  SELECT cutoff, customer_id, count(*) AS frequency,
    CAST(sum(CAST(order_value AS DECIMAL(18, 2))) AS DOUBLE) AS monetary,
    coalesce(stddev_samp(order_value), 0) AS std_order_value,
    max(order_value) AS max_order_value,
    sum(order_items) / count(*) AS avg_items, sum(order_products) / count(*) AS avg_products,
    datesub('day', max(order_date), cutoff) AS recency_days,
    datesub('day', min(order_date), cutoff) AS tenure_days
  FROM ord GROUP BY cutoff, customer_id),
rfm AS (
  SELECT *, monetary / frequency AS avg_order_value,
    monetary / greatest(tenure_days, 1) AS revenue_per_tenure_day FROM rfm0),
gaps AS (
  SELECT cutoff, customer_id, datesub('day', lag(order_date) OVER (
      PARTITION BY cutoff, customer_id ORDER BY order_date, invoice_no), order_date) AS gap
  FROM ord),
cad AS (
  SELECT cutoff, customer_id, avg(gap) AS mean_gap_days,
    coalesce(stddev_samp(gap), 0) AS std_gap_days, min(gap) AS min_gap_days,
    max(gap) AS max_gap_days
  FROM gaps GROUP BY cutoff, customer_id),
win0 AS (
  SELECT cutoff, customer_id,
    {windows}
  FROM ord GROUP BY cutoff, customer_id),
win AS (
  SELECT *, orders_last_30d / greatest(orders_last_90d, 1) AS order_momentum,
    revenue_last_30d / greatest(revenue_last_90d, 1) AS revenue_momentum,
    orders_last_90d / greatest(orders_last_180d, 1) AS orders_90d_vs_180d FROM win0),
brd0 AS (
  SELECT cutoff, customer_id, count(DISTINCT stock_code) AS distinct_products,
    CAST(sum(quantity) AS BIGINT) AS total_units, avg(unit_price) AS avg_unit_price,
    count(DISTINCT invoice_no) AS invoices
  FROM past GROUP BY cutoff, customer_id),
brd AS (SELECT *, distinct_products / greatest(invoices, 1) AS products_per_order FROM brd0),
votes AS (
  SELECT cutoff, customer_id, country, count(*) AS n FROM past
  WHERE country IS NOT NULL GROUP BY ALL),
modal AS (
  SELECT cutoff, customer_id, country FROM votes QUALIFY row_number() OVER (
    PARTITION BY cutoff, customer_id ORDER BY n DESC, country) = 1)"""


def _feature_sql(home: str) -> dict[str, str]:
    special = {
        "gap_cv": "std_gap_days / nullif(mean_gap_days, 0)",
        "recency_vs_gap": "CASE WHEN mean_gap_days IS NOT NULL "
                          "THEN recency_days / greatest(mean_gap_days, 1) END",
        "is_uk": f"CAST(coalesce(modal.country = '{home}', FALSE) AS INTEGER)",
        "is_export": f"CAST(coalesce(modal.country <> '{home}', TRUE) AS INTEGER)",
    }
    return {name: special.get(name, name) for name in FEATURES}


def snapshot_ctes(tx: str, settings) -> str:
    """``tx`` CTE, then all blocks, then ``snap`` with unrounded features and the label."""
    features = ", ".join(f"{sql} AS {name}"
                         for name, sql in _feature_sql(settings.home_market).items())
    return f"""{tx}, {cutoff_values(settings.cutoffs)},
{_blocks(settings.home_market)},
snap AS (
  SELECT customer_id, {features},
    CAST(EXISTS (SELECT 1 FROM tx f WHERE f.customer_id = rfm.customer_id
      AND f.invoice_date >= cutoff
      AND f.invoice_date < cutoff + INTERVAL {settings.horizon_days} DAY) AS INTEGER) AS label,
    cutoff
  FROM rfm JOIN cad USING (cutoff, customer_id) JOIN win USING (cutoff, customer_id)
    JOIN brd USING (cutoff, customer_id) LEFT JOIN modal USING (cutoff, customer_id)
  WHERE tenure_days >= {settings.min_history_days})"""


ORDER_SNAP = snapshot_ctes(ORDER_TX, ORDER_SETTINGS)


def rounded(expression: str, digits: int) -> str:
    return f"round_even(({expression}) * 1e{digits}, 0) / 1e{digits}"


def rounded_columns(names, digits: dict[str, int]) -> str:
    return ", ".join(f"{rounded(n, digits[n])} AS {n}" if n in digits else n for n in names)


# ---------------------------------------------------------------------------------------------
# Scores of two fixed rules, and their curves
# ---------------------------------------------------------------------------------------------
RULES = {"recency_baseline": "recency_days", "overdue_rule": "recency_vs_gap"}
POOLED = "holdout"


def _rule(column: str) -> str:
    return f"1e0 / (1e0 + coalesce(CAST({column} AS DOUBLE), 999e0))"


def _days(cutoffs) -> str:
    return ", ".join(f"TIMESTAMP '{c}'" for c in cutoffs)


_RULE_ROWS = " UNION ALL ".join(
    f"SELECT '{model}' AS model, customer_id, cutoff, label, {_rule(column)} AS score FROM snap"
    for model, column in RULES.items())
SCORED = f"""{ORDER_SNAP},
rule_rows AS ({_RULE_ROWS}),
scored AS (SELECT * FROM rule_rows WHERE cutoff IN ({_days(ORDER_HOLDOUT)}))"""
_SPLITS = f"""splits AS (
  SELECT *, '{POOLED}' AS split FROM scored
  UNION ALL SELECT *, strftime(cutoff, '%Y-%m-%d') AS split FROM scored)"""


def ranked(source: str, keys: str, name: str = "ranked") -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, cutoff, customer_id)
      AS rank,
    count(*) OVER (PARTITION BY {keys}) AS n_total,
    sum(label) OVER (PARTITION BY {keys}) AS pos_total
  FROM {source})"""


def curve(source: str, keys: str, name: str = "curve") -> str:
    return f"""{name}_counts AS (
  SELECT {keys}, score, count(*) AS n, sum(label) AS pos FROM {source} GROUP BY ALL),
{name} AS (
  SELECT *, sum(n) OVER w AS n_through, sum(pos) OVER w AS pos_through,
    sum(n) OVER (PARTITION BY {keys}) AS n_total, sum(pos) OVER (PARTITION BY {keys}) AS pos_total
  FROM {name}_counts WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC))"""


_AP = ("coalesce(sum(pos * CAST(pos_through AS DOUBLE) / n_through) "
       "/ nullif(CAST(max(pos_total) AS DOUBLE), 0), 0)")


def average_precision(source: str, keys: str, name: str = "ap") -> str:
    return f"""{curve(source, keys, name + "_curve")},
{name} AS (SELECT {keys}, {_AP} AS pr_auc FROM {name}_curve GROUP BY {keys})"""


def _top_n(share: str) -> str:
    return f"greatest(1, CAST(round_even(n_total * CAST({share} AS DOUBLE), 0) AS BIGINT))"


def evaluation(source: str, keys: str, name: str = "metrics") -> str:
    """All twelve metrics per group as CTE ``name``, unrounded."""
    auc_pairs = ("sum(CAST(pos AS DOUBLE) * ((n_total - pos_total) - (n_through - pos_through) "
                 "+ (n - pos) / 2.0e0))")
    return f"""{ranked(source, keys, name + "_ranked")},
{average_precision(source, keys, name + "_ap")},
{name}_auc AS (
  SELECT {keys}, {auc_pairs}
    / nullif(CAST(max(pos_total) AS DOUBLE) * max(n_total - pos_total), 0) AS roc_auc
  FROM {name}_ap_curve GROUP BY {keys}),
{name}_counts AS (
  SELECT {keys}, count(*) AS n, sum(label) AS p, avg(label) AS base_rate,
    count(*) FILTER (WHERE (score >= 0.5) = (label = 1)) AS correct,
    count(*) FILTER (WHERE score >= 0.5) AS called,
    count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
    avg((score - label) * (score - label)) AS brier,
    sum(label) FILTER (WHERE rank <= {_top_n('0.2')}) AS hits,
    max({_top_n('0.2')}) AS size
  FROM {name}_ranked GROUP BY {keys}),
{name} AS (
  SELECT {keys}, base_rate, correct / n AS accuracy,
    greatest(base_rate, 1 - base_rate) AS majority_accuracy,
    coalesce(tp / nullif(called, 0), 0) AS precision, coalesce(tp / nullif(p, 0), 0) AS recall,
    coalesce(2 * tp / nullif(called + p, 0), 0) AS f1, roc_auc, pr_auc,
    hits / size AS precision_at_20, coalesce(hits / nullif(p, 0), 0) AS recall_at_20,
    (hits / size) / nullif(base_rate, 0) AS lift_at_20, brier
  FROM {name}_counts JOIN {name}_ap USING ({keys}) JOIN {name}_auc USING ({keys}))"""


METRICS = ["base_rate", "accuracy", "majority_accuracy", "precision", "recall", "f1", "roc_auc",
           "pr_auc", "precision_at_20", "recall_at_20", "lift_at_20", "brier"]
HOLDOUT = f"{SCORED},\n{_SPLITS},\n{evaluation('splits', 'model, split', 'holdout')}"


def _all_rounded(names, digits: int = 9) -> str:
    return rounded_columns(names, dict.fromkeys(names, digits))


# Folds of the development cutoffs, with the two rules.
_FOLDS = " UNION ALL ".join(
    f"SELECT {fold} AS fold, '{ORDER_DEV[i]}' AS valid_cutoff, * FROM rule_rows "
    f"WHERE cutoff = TIMESTAMP '{ORDER_DEV[i]}'"
    for fold, i in enumerate(range(3, len(ORDER_DEV)), start=1))
_CV = f"""{ORDER_SNAP},
rule_rows AS ({_RULE_ROWS}),
fold_rows AS ({_FOLDS}),
{evaluation('fold_rows', 'model, fold, valid_cutoff', 'scores')},
cv AS (
  SELECT *, (SELECT count(*) FROM snap WHERE cutoff < CAST(valid_cutoff AS TIMESTAMP)) AS n_train,
    (SELECT count(*) FROM snap WHERE cutoff = CAST(valid_cutoff AS TIMESTAMP)) AS n_valid
  FROM scores)"""

# Digits to which float columns that depend on summation order are compared.
ORDER_DIGITS = {"std_order_value": 3, "std_gap_days": 6, "gap_cv": 6, "avg_unit_price": 4}
EVENT_DIGITS = {"std_order_value": 6, "std_gap_days": 6, "gap_cv": 6, "avg_unit_price": 8}


def _block(name: str) -> str:
    source = {"rfm": "rfm", "cadence": "cad JOIN rfm USING (cutoff, customer_id)",
              "window": "win", "breadth": "brd",
              "market": "rfm LEFT JOIN modal USING (cutoff, customer_id)"}[name]
    sql = _feature_sql(HOME)
    columns = ", ".join(
        f"{rounded(sql[f], ORDER_DIGITS[f]) if f in ORDER_DIGITS else sql[f]} AS {f}"
        for f in FEATURE_BLOCKS[name])
    return (f"WITH {ORDER_TX}, {cutoff_values(ORDER_CUTOFFS)},\n{_blocks(HOME)}\n"
            f"SELECT customer_id, cutoff, {columns} FROM {source}")


def _snapshots(ctes: str, digits) -> str:
    return (f"WITH {ctes}\nSELECT customer_id, {rounded_columns(FEATURES, digits)}, label, cutoff "
            "FROM snap")


def _shares(shares) -> str:
    return ", ".join(f"(CAST({k} AS DOUBLE))" for k in shares)


_SWEEP = f"""{SCORED},
{ranked('scored', 'model')},
sweep0 AS (
  SELECT model, k, max({_top_n('k')}) AS contacted,
    sum(label) FILTER (WHERE rank <= {_top_n('k')}) AS hits,
    max(pos_total) AS pos_total, max(n_total) AS n_total
  FROM ranked, (VALUES {_shares(CAPACITIES)}) AS v(k) GROUP BY model, k),
sweep AS (
  SELECT model, k, contacted, CAST(hits AS BIGINT) AS hits, hits / contacted AS precision,
    hits * {INCREMENTAL_MARGIN}::DOUBLE AS revenue, contacted * {CONTACT_COST}::DOUBLE AS cost,
    hits * {INCREMENTAL_MARGIN}::DOUBLE - contacted * {CONTACT_COST}::DOUBLE AS net,
    (hits * {INCREMENTAL_MARGIN}::DOUBLE - contacted * {CONTACT_COST}::DOUBLE) / contacted
      AS net_per_contact,
    hits / pos_total AS recall, (hits / contacted) / (pos_total / n_total) AS lift
  FROM sweep0)"""
_MONEY = ["k", "precision", "revenue", "cost", "net", "net_per_contact"]

_GAINS = f"""{SCORED},
{ranked('scored', 'model')},
g0 AS (
  SELECT model, CAST((rank - 1) * 10 // n_total + 1 AS INTEGER) AS decile, count(*) AS customers,
    CAST(sum(label) AS BIGINT) AS returned, max(pos_total) AS pos_total, max(n_total) AS n_total
  FROM ranked GROUP BY 1, 2),
g AS (
  SELECT *, CAST(sum(returned) OVER w AS BIGINT) AS cumulative_returned,
    sum(customers) OVER w AS cumulative_customers
  FROM g0 WINDOW w AS (PARTITION BY model ORDER BY decile))"""

_CALIBRATION = f"""{SCORED},
edges AS (
  SELECT model, unnest(quantile_cont(score, [{', '.join(f'{j / 10}' for j in range(1, 10))}]))
    AS edge FROM scored GROUP BY model),
binned AS (
  SELECT s.*, (SELECT count(*) FROM edges e WHERE e.model = s.model AND e.edge < s.score) AS bin
  FROM scored s),
cal AS (
  SELECT model, CAST(bin AS INTEGER) AS bin, avg(score) AS predicted, avg(label) AS observed
  FROM binned GROUP BY ALL)"""

# How the older state that digests are compared with differs from the transactions.
MISSING_MONTH = "1999-03"
OTHER_QUANTITY = "stock_code = '13' and quantity > 25"

SCALED_DIGITS = {f: 4 if f in ORDER_DIGITS else 6 for f in FEATURES}
# The features of the small logistic regression that SQL fits as well.
FITTED = ["recency_days", "mean_gap_days"]
NEWTON_STEPS = 12
# Two trees of one split each, the penalties and the step of their leaf values.
STUMPS = {"recency_days": 60.0, "orders_last_90d": 0.0}
PENALTIES, LEAF_STEP = (0.0, 5.0, 500.0), 0.3


def _leaves(dev: str) -> str:
    """Leaf values of the two trees, the second given the first."""
    (a, at_a), (b, at_b) = STUMPS.items()
    penalties = ", ".join(f"({p!r}e0)" for p in PENALTIES)

    def value(margin: str) -> str:
        p = f"(1 / (1 + exp(-({margin}))))"
        return (f"-{LEAF_STEP!r}e0 * sum({p} - label) / (sum({p} * (1 - {p})) + reg_lambda)")

    def side(name: str, split: float) -> str:
        return f"CASE WHEN coalesce(CAST({name} AS DOUBLE), 0) <= {split!r}e0 THEN 1 ELSE 2 END"

    return f"""{ORDER_SNAP},
dev AS (SELECT label, reg_lambda, {side(a, at_a)} AS first, {side(b, at_b)} AS second
  FROM snap, (VALUES {penalties}) AS v(reg_lambda) WHERE cutoff IN ({dev})),
one AS (SELECT reg_lambda, first AS leaf, {value('0e0')} AS value FROM dev GROUP BY 1, 2),
two AS (
  SELECT dev.reg_lambda, second AS leaf, {value('one.value').replace('reg_lambda', 'dev.reg_lambda')} AS value
  FROM dev JOIN one ON one.reg_lambda = dev.reg_lambda AND one.leaf = first GROUP BY 1, 2)
SELECT reg_lambda, 0 AS tree, leaf, {rounded('value', 9)} AS value FROM one
UNION ALL SELECT reg_lambda, 1, leaf, {rounded('value', 9)} FROM two"""



def _newton(dev: str) -> str:
    """A logistic regression on two standardised features, by Newton's steps from sums."""
    x = ["1e0", "x1", "x2"]
    penalty = [0, 1, 1]
    h = {(i, j): f"h{min(i, j)}{max(i, j)}" for i in range(3) for j in range(3)}
    sums = [f"sum((p - label) * {x[i]}) + b{i} * {penalty[i]} AS g{i}" for i in range(3)]
    sums += [f"sum(p * (1 - p) * {x[i]} * {x[j]}) + {penalty[i] if i == j else 0} AS h{i}{j}"
             for i in range(3) for j in range(i, 3)]

    def determinant(column: int | None) -> str:
        """Of the matrix, with one column replaced by the gradient."""
        def cell(i: int, j: int) -> str:
            return f"g{i}" if j == column else h[i, j]
        even = [(0, 1, 2), (1, 2, 0), (2, 0, 1)]
        odd = [(0, 2, 1), (1, 0, 2), (2, 1, 0)]
        def products(orders) -> str:
            return " + ".join(" * ".join(cell(i, j) for i, j in enumerate(o)) for o in orders)
        return f"(({products(even)}) - ({products(odd)}))"

    a, b = FITTED
    return f"""{ORDER_SNAP},
med AS (SELECT median(CAST({a} AS DOUBLE)) AS m1, median(CAST({b} AS DOUBLE)) AS m2
  FROM snap WHERE cutoff IN ({dev})),
filled AS MATERIALIZED (
  SELECT customer_id, cutoff, label, coalesce(CAST({a} AS DOUBLE), m1) AS v1,
    coalesce(CAST({b} AS DOUBLE), m2) AS v2 FROM snap, med),
spread AS (SELECT avg(v1) AS a1, stddev_samp(v1) AS s1, avg(v2) AS a2, stddev_samp(v2) AS s2
  FROM filled WHERE cutoff IN ({dev})),
train AS MATERIALIZED (SELECT label, (v1 - a1) / s1 AS x1, (v2 - a2) / s2 AS x2
  FROM filled, spread WHERE cutoff IN ({dev})),
newton(step, b0, b1, b2) AS (
  SELECT 0, 0e0, 0e0, 0e0
  UNION ALL
  SELECT step + 1, {', '.join(f'b{i} - {determinant(i)} / {determinant(None)}' for i in range(3))}
  FROM (
    SELECT step, b0, b1, b2, {', '.join(sums)}
    FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM newton, train)
    WHERE step < {NEWTON_STEPS} GROUP BY step, b0, b1, b2)),
weights AS (
  SELECT b1 / s1 AS w1, b2 / s2 AS w2, b0 - b1 * a1 / s1 - b2 * a2 / s2 AS w0, m1, m2
  FROM newton, spread, med WHERE step = {NEWTON_STEPS})"""

# A scoring rule that reads several features: weight and filling value of each.
BLEND = {"recency_days": (-0.011, 200.0), "recency_vs_gap": (-0.35, 3.0),
         "frequency": (0.05, 0.0), "orders_last_90d": (0.4, 0.0), "gap_cv": (-0.6, 1.0),
         "distinct_products": (0.004, 0.0)}


def blend(values: dict[str, str]) -> str:
    return " + ".join(f"{weight!r}e0 * coalesce(CAST({values.get(name, name)} AS DOUBLE), "
                      f"{fill!r}e0)" for name, (weight, fill) in BLEND.items())


def _walk(rounds: int, steps: int, prime: int, factor: int) -> str:
    """CTEs that send ``place`` through the keyed permutation until it is below n."""
    def mixed(value: str, key: str) -> str:
        start = f"(({value} + {key}) % {prime})"
        return f"((({start} * {start} % {prime}) + {key}) % {prime}) * {factor} % {prime}"

    ctes = []
    for step in range(1, steps + 1):
        source = f"SELECT *, place // across AS r, place % across AS c FROM walk{step - 1}"
        for k in range(rounds):
            changed = (f"(c + {mixed('r', f'k{k}')}) % across AS c" if k % 2
                       else f"(r + {mixed('c', f'k{k}')}) % down AS r")
            source = f"SELECT * REPLACE ({changed}) FROM ({source})"
        inside = f"place < n AND {step} > 1"
        ctes.append(f"walk{step} AS (SELECT * EXCLUDE (r, c) REPLACE (CASE WHEN {inside} "
                    f"THEN place ELSE r * across + c END AS place) FROM ({source}))")
    return ",\n".join(ctes)


def _importance(rounds: int, steps: int, prime: int, factor: int, repeats: int, seed: int) -> str:
    """Features that the rule reads are permuted in copies of their own; others stay at zero."""
    hashed = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
    identity = hashed.format(f"'{seed}|' || customer_id || '|' || cutoff")
    keys = ", ".join(
        hashed.format(f"'{seed}|' || feature || '|' || repeat || '|{k}'") + f" % {prime} AS k{k}"
        for k in range(rounds))
    read = ", ".join(f"('{f}')" for f in BLEND)
    every = ", ".join(f"('{f}')" for f in FEATURES)
    values = " ".join(f"WHEN '{f}' THEN CAST({f} AS DOUBLE)" for f in BLEND)
    moved = {f: f"CASE WHEN feature = '{f}' THEN value ELSE {f} END" for f in BLEND}
    return f"""{ORDER_SNAP},
placed AS (
  SELECT *, row_number() OVER (ORDER BY {identity}, customer_id, cutoff) - 1 AS position,
    count(*) OVER () AS n
  FROM snap WHERE cutoff IN ({_days(ORDER_HOLDOUT)})),
keys AS (
  SELECT feature, repeat, {keys}
  FROM (VALUES {read}) AS f(feature), (SELECT unnest(range({repeats})) AS repeat)),
walk0 AS (
  SELECT *, (n + down - 1) // down AS across FROM (
    SELECT feature, repeat, k0, k1, k2, k3, n, position AS place,
      CASE feature {values} END AS value, CAST(ceil(sqrt(n)) AS BIGINT) AS down
    FROM placed, keys)),
{_walk(rounds, steps, prime, factor)},
shuffled AS (
  SELECT feature, repeat, label, {blend(moved)} AS score
  FROM walk{steps} JOIN placed ON place = position),
{average_precision('shuffled', 'feature, repeat', 'moved')},
plain AS (SELECT 'base' AS key, label, {blend({})} AS score FROM placed),
{average_precision('plain', 'key', 'base')},
drops AS (
  SELECT feature, {rounded('avg(base.pr_auc - moved.pr_auc)', 5)} AS pr_auc_drop,
    {rounded('stddev_pop(base.pr_auc - moved.pr_auc)', 5)} AS std
  FROM moved, base GROUP BY feature)
SELECT f.feature, coalesce(pr_auc_drop, 0e0) AS pr_auc_drop, coalesce(std, 0e0) AS std
FROM (VALUES {every}) AS f(feature) LEFT JOIN drops USING (feature)"""


def _audit() -> str:
    """Snapshots of changed lines, built per cutoff and change, beside those of the lines as they
    are. A change is told by the customer's number: even ones have no future, odd ones a large one."""
    changed = snapshot_ctes(ORDER_TX, ORDER_SETTINGS)
    changed = changed.replace(
        "past AS (SELECT * FROM tx JOIN cutoffs ON invoice_date < cutoff)",
        """copies AS (
  SELECT cutoff, 2 * customer_id AS customer_id, invoice_no, invoice_date, stock_code, quantity,
    unit_price, country, line_revenue FROM tx, cutoffs WHERE invoice_date < cutoff
  UNION ALL
  SELECT cutoff, 2 * customer_id + 1, invoice_no, invoice_date, stock_code, quantity * f,
    unit_price * f, country, line_revenue * f
  FROM (SELECT *, CASE WHEN invoice_date >= cutoff THEN 1000 ELSE 1 END AS f FROM tx, cutoffs)),
past AS (SELECT * FROM copies WHERE invoice_date < cutoff)""")
    changed = changed.replace("EXISTS (SELECT 1 FROM tx f WHERE",
                              "EXISTS (SELECT 1 FROM copies f WHERE f.cutoff = rfm.cutoff AND")
    changed = changed.replace("f.invoice_date >= cutoff", "f.invoice_date >= rfm.cutoff") \
        .replace("f.invoice_date < cutoff", "f.invoice_date < rfm.cutoff")
    equal = " AND ".join(
        f"((a.{f} IS NULL AND b.{f} IS NULL) OR coalesce(abs(a.{f} - b.{f}) "
        f"<= 1e-9 * greatest(abs(a.{f}), abs(b.{f}), 1), FALSE))" for f in FEATURES)
    return f"""WITH plain AS (WITH {ORDER_SNAP} SELECT * FROM snap),
b AS (
  WITH {changed}
  SELECT * EXCLUDE (customer_id), customer_id // 2 AS customer_id,
    CASE customer_id % 2 WHEN 0 THEN 'deleted' ELSE 'inflated' END AS change FROM snap),
a AS (SELECT * FROM plain, (VALUES ('deleted'), ('inflated')) AS c(change))
SELECT coalesce(a.cutoff, b.cutoff) AS cutoff, coalesce(a.change, b.change) AS change,
  count(*) AS rows_compared,
  count(*) FILTER (WHERE NOT (a.customer_id IS NOT NULL AND b.customer_id IS NOT NULL
    AND {equal})) AS rows_moved,
  CAST(sum(a.label) AS BIGINT) AS labels_before, CAST(sum(b.label) AS BIGINT) AS labels_after
FROM a FULL JOIN b ON a.cutoff = b.cutoff AND a.change = b.change
  AND a.customer_id = b.customer_id GROUP BY ALL"""


def statements(permutation, importance_repeats: int, seed: int, one_cutoff) -> dict[str, str]:
    """Query name to SQL."""
    tx_columns = ("customer_id, invoice_no, invoice_date, stock_code, quantity, unit_price, "
                  "country, line_revenue")
    fingerprint_text = " || '|' || ".join(
        f"coalesce(CAST({c} AS VARCHAR), '\\N')"
        for c in ("customer_id", "invoice_no", "stock_code", "quantity", "country"))
    dev, test = _days(ORDER_DEV), _days(ORDER_HOLDOUT)
    fold_roles = ", ".join(
        f"({fold}, 'train', TIMESTAMP '{c}')" for fold, i in enumerate(range(3, 7), start=1)
        for c in ORDER_DEV[:i])
    fold_roles += ", " + ", ".join(
        f"({fold}, 'valid', TIMESTAMP '{ORDER_DEV[i]}')"
        for fold, i in enumerate(range(3, 7), start=1))
    summary = {
        "pr_auc_mean": "avg(pr_auc)", "pr_auc_std": "stddev_samp(pr_auc)",
        "roc_auc_mean": "avg(roc_auc)", "lift_mean": "avg(lift_at_20)",
        "lift_std": "stddev_samp(lift_at_20)", "precision_at_20": "avg(precision_at_20)",
        "brier_mean": "avg(brier)", "accuracy_mean": "avg(accuracy)",
        "majority_accuracy": "avg(majority_accuracy)"}
    compared = ["pr_auc", "roc_auc", "precision_at_20", "lift_at_20", "brier"]
    headline = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {rounded('b.' + m, 9)} AS best, "
        + (f"{rounded('r.' + m, 9)}" if m != "majority_accuracy" else "CAST(NULL AS DOUBLE)")
        + " AS baseline, "
        + (f"{rounded(f'b.{m} - r.{m}', 9)}" if m in compared else "CAST(NULL AS DOUBLE)")
        + " AS difference FROM b, r"
        for m in [*compared, "accuracy", "majority_accuracy"])
    medians = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(median(CAST({f} AS DOUBLE)) AS DOUBLE) AS median FROM dev"
        for f in FEATURES)
    tuning_rows = " UNION ALL ".join(
        f"SELECT {i} AS config, {_rule(column)} AS score, label, cutoff FROM snap"
        for i, column in enumerate(RULES.values()))
    out = {
        "rule_precision_at_20": f"""WITH {SCORED}, {ranked('scored', 'model')}
SELECT model, count(*) FILTER (WHERE rank <= {_top_n('0.2')}) AS contacted,
  CAST(sum(label) FILTER (WHERE rank <= {_top_n('0.2')}) AS BIGINT) AS hits,
  {rounded(f"avg(label) FILTER (WHERE rank <= {_top_n('0.2')})", 9)} AS precision_at_20,
  {rounded(f"avg(label) FILTER (WHERE rank <= {_top_n('0.2')}) / avg(label)", 9)} AS lift_at_20
FROM ranked GROUP BY model""",
        "transactions": f"WITH {ORDER_TX} SELECT {tx_columns} FROM tx",
        "cleaned_transactions": f"WITH {DIRTY_TX} SELECT {tx_columns} FROM tx",
        "raw_csv_round_trip": f"""WITH {DIRTY_TX}
SELECT country, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units,
  count(*) FILTER (WHERE starts_with(invoice_no, 'C')) AS cancelled,
  count(*) FILTER (WHERE padded_code <> trim(padded_code, chr(9) || ' ')) AS padded,
  count(customer_id) AS known, min(invoice_date) AS first_date
FROM twice GROUP BY country""",
        "transaction_profile": f"""WITH {ORDER_TX}
SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS customers,
  min(invoice_date) AS first_date, max(invoice_date) AS last_date FROM tx""",
        "table_fingerprint": f"""WITH {ORDER_TX}
SELECT count(*) AS n_rows, CAST(coalesce(sum(CAST('0x' || substr(md5({fingerprint_text}), 1, 8)
  AS BIGINT)), 0) AS BIGINT) AS hash_sum FROM tx""",
        "partition_digests": f"""WITH {ORDER_TX},
hashed AS (SELECT strftime(invoice_date, '%Y-%m') AS part, md5({fingerprint_text}) AS h FROM tx)
SELECT part, count(*) AS n_rows,
  CAST(sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)) AS BIGINT) AS low_sum,
  CAST(sum(CAST('0x' || substr(h, 9, 8) AS BIGINT)) AS BIGINT) AS high_sum
FROM hashed GROUP BY part""",
        "changed_partitions": f"""WITH {ORDER_TX},
months AS (
  SELECT strftime(invoice_date, '%Y-%m') AS part,
    count(*) FILTER (WHERE {OTHER_QUANTITY}) AS others FROM tx GROUP BY 1)
SELECT part, CASE part WHEN '{MISSING_MONTH}' THEN 'added' ELSE 'changed' END AS change
FROM months WHERE part = '{MISSING_MONTH}' OR others > 0""",
        "refreshed_transactions": f"WITH {DIRTY_TX} SELECT {tx_columns} FROM tx",
        "incremental_snapshots": _snapshots(ORDER_SNAP, ORDER_DIGITS),
        "corrected_snapshots": _snapshots(ORDER_SNAP, ORDER_DIGITS),
        "orders_at_cutoffs": f"""WITH {ORDER_TX}, {cutoff_values(ORDER_CUTOFFS)},
{ORDER_LEVEL}
SELECT * FROM ord""",
        "straddling_orders_at_cutoffs":
            f"""WITH {SESSION_TX}, {cutoff_values(EVENT_SETTINGS.cutoffs)},
{ORDER_LEVEL}
SELECT * FROM ord""",
        **{f"{name}_block": _block(name) for name in FEATURE_BLOCKS},
        "outcome_labels": f"WITH {ORDER_SNAP} SELECT customer_id, cutoff, label FROM snap",
        "snapshots": _snapshots(ORDER_SNAP, ORDER_DIGITS),
        "event_snapshots": _snapshots(snapshot_ctes(EVENT_TX, EVENT_SETTINGS), EVENT_DIGITS),
        "straddling_snapshots": _snapshots(snapshot_ctes(SESSION_TX, EVENT_SETTINGS),
                                           EVENT_DIGITS),
        "one_cutoff_snapshot": _snapshots(snapshot_ctes(ORDER_TX, one_cutoff), ORDER_DIGITS),
        "cutoff_history": f"""WITH {ORDER_TX}, {cutoff_values(ORDER_CUTOFFS)}
SELECT cutoff, count(*) FILTER (WHERE invoice_date < cutoff) AS past_lines,
  count(*) FILTER (WHERE invoice_date >= cutoff) AS later_lines
FROM tx, cutoffs GROUP BY cutoff""",
        "fold_sizes": f"""WITH {ORDER_SNAP}
SELECT fold, role, count(DISTINCT cutoff) AS n_cutoffs, count(*) AS n_rows,
  CAST(sum(label) AS BIGINT) AS returned
FROM snap JOIN (VALUES {fold_roles}) AS f(fold, role, cutoff) USING (cutoff) GROUP BY fold, role""",
        "temporal_split": f"""WITH {ORDER_SNAP}
SELECT CASE WHEN cutoff IN ({test}) THEN 'holdout' ELSE 'development' END AS split, cutoff,
  count(*) AS n_rows FROM snap WHERE cutoff IN ({dev}, {test}) GROUP BY ALL""",
        "seasonality": f"""WITH {ORDER_SNAP}
SELECT strftime(cutoff, '%Y-%m-%d') AS cutoff, count(*) AS customers,
  CAST(sum(label) AS BIGINT) AS returned, {rounded('sum(label) / count(*) * 100', 1)} AS base_rate,
  CASE WHEN cutoff IN ({test}) THEN 'holdout' ELSE 'development' END AS split
FROM snap s GROUP BY s.cutoff""",
        "rule_scores": f"""WITH {SCORED}
SELECT model, customer_id, cutoff, label, {rounded('score', 12)} AS score FROM scored""",
        "global_rank": f"""WITH {SCORED}, {ranked('scored', 'model')}
SELECT model, customer_id, cutoff, label, rank FROM ranked""",
        "top_share": f"""WITH {_SWEEP}
SELECT model, k, contacted AS size, hits, {rounded('precision', 9)} AS precision_at,
  {rounded('recall', 9)} AS recall_at, {rounded('lift', 9)} AS lift_at FROM sweep""",
        "holdout_metrics":
            f"WITH {HOLDOUT}\nSELECT model, split, {_all_rounded(METRICS)} FROM holdout",
        "gains_table": f"""WITH {_GAINS}
SELECT model, decile, customers, returned, {rounded('returned / customers', 3)} AS precision,
  {rounded('(returned / customers) / (pos_total / n_total)', 3)} AS lift, cumulative_returned,
  {rounded('cumulative_returned / pos_total', 3)} AS cumulative_recall,
  {rounded('cumulative_returned / cumulative_customers', 3)} AS cumulative_precision FROM g""",
        "expected_value": f"""WITH {_SWEEP}
SELECT model, contacted, hits, {_all_rounded(_MONEY)} FROM sweep WHERE k = 0.2""",
        "capacity_sweep": f"""WITH {_SWEEP}
SELECT model, contacted, hits, {_all_rounded([*_MONEY, 'recall', 'lift'], 3)} FROM sweep""",
        "money_report": f"""WITH {_SWEEP}
SELECT model, k, '£' || format('{{:,}}', CAST(round_even(revenue, 0) AS BIGINT)) AS revenue,
  '£' || format('{{:,}}', CAST(round_even(cost, 0) AS BIGINT)) AS cost,
  '£' || format('{{:,}}', CAST(round_even(net, 0) AS BIGINT)) AS net FROM sweep""",
        "calibration_table": f"""WITH {_CALIBRATION}
SELECT model, bin, {_all_rounded(['predicted', 'observed'], 6)},
  {rounded('predicted - observed', 6)} AS gap FROM cal""",
        "pr_curve": f"""WITH {SCORED}, {curve('scored', 'model')}
SELECT model, {rounded('score', 12)} AS threshold, {rounded('pos_through / n_through', 9)}
  AS precision, {rounded('pos_through / pos_total', 9)} AS recall FROM curve
UNION ALL SELECT DISTINCT model, NULL, 1e0, 0e0 FROM scored""",
        "roc_curve": f"""WITH {SCORED}, {curve('scored', 'model')}
SELECT model, {rounded('score', 12)} AS threshold,
  {rounded('(n_through - pos_through) / (n_total - pos_total)', 9)} AS fpr,
  {rounded('pos_through / pos_total', 9)} AS tpr FROM curve
UNION ALL SELECT DISTINCT model, NULL, 0e0, 0e0 FROM scored""",
        "stability": f"""WITH {HOLDOUT},
means AS (SELECT model, split, avg(score) AS mean_predicted FROM splits GROUP BY ALL)
SELECT model, split AS cutoff,
  CAST(row_number() OVER (PARTITION BY model ORDER BY split) AS INTEGER) AS months_after_training,
  {rounded('base_rate', 3)} AS base_rate, {rounded('pr_auc', 4)} AS pr_auc,
  {rounded('lift_at_20', 3)} AS lift_at_20, {rounded('mean_predicted', 3)} AS mean_predicted
FROM holdout JOIN means USING (model, split) WHERE split <> '{POOLED}'""",
        "best_model": f"""WITH {HOLDOUT}
SELECT arg_max(model, pr_auc) AS model, {rounded('max(pr_auc)', 9)} AS pr_auc
FROM holdout WHERE split = '{POOLED}'""",
        "headline": f"""WITH {HOLDOUT},
b AS (SELECT * FROM holdout WHERE split = '{POOLED}' AND model = 'overdue_rule'),
r AS (SELECT * FROM holdout WHERE split = '{POOLED}' AND model = 'recency_baseline')
{headline}""",
        "cross_validation": f"""WITH {_CV}
SELECT model, CAST(fold AS INTEGER) AS fold, valid_cutoff, n_train, n_valid,
  {_all_rounded(METRICS)} FROM cv""",
        "cv_summary": f"""WITH {_CV}
SELECT model, {', '.join(f'{rounded(sql, 4)} AS {name}' for name, sql in summary.items())}
FROM cv GROUP BY model""",
        "cv_fold_series": f"""WITH {_CV}
SELECT model, valid_cutoff, {rounded('pr_auc', 9)} AS pr_auc FROM cv""",
        "cv_accuracy": f"""WITH {_CV}
SELECT model, {rounded('avg(accuracy)', 9)} AS accuracy,
  {rounded('avg(majority_accuracy)', 9)} AS majority_accuracy FROM cv GROUP BY model""",
        "tuning_summary": f"""WITH {ORDER_SNAP},
candidate_rows AS ({tuning_rows}),
valid_rows AS (SELECT * FROM candidate_rows WHERE cutoff IN ({_days(ORDER_DEV[3:])})),
{average_precision('valid_rows', 'config, cutoff')}
SELECT CAST(config AS INTEGER) AS config,
  CASE config WHEN 0 THEN 'recency_days' ELSE 'recency_vs_gap' END AS column_name,
  {rounded('avg(pr_auc)', 9)} AS pr_auc_mean, {rounded('stddev_pop(pr_auc)', 9)} AS pr_auc_std
FROM ap GROUP BY config""",
        "permutation_importance": "WITH " + _importance(
            *permutation, importance_repeats, seed),
        "leakage_audit": _audit(),
        "standardised_features": f"""WITH {ORDER_SNAP},
med AS (SELECT {', '.join(f'median(CAST({f} AS DOUBLE)) AS {f}_m' for f in FEATURES)}
  FROM snap WHERE cutoff IN ({dev})),
filled AS (
  SELECT customer_id, cutoff,
    {', '.join(f'coalesce(CAST({f} AS DOUBLE), {f}_m) AS {f}' for f in FEATURES)}
  FROM snap, med),
fitted AS (
  SELECT {', '.join(f'avg({f}) AS {f}_a, stddev_samp({f}) AS {f}_s' for f in FEATURES)}
  FROM filled WHERE cutoff IN ({dev}))
SELECT customer_id, cutoff,
  {', '.join(f"coalesce({rounded(f'({f} - {f}_a) / nullif({f}_s, 0)', SCALED_DIGITS[f])}, 0) AS {f}"
             for f in FEATURES)}
FROM filled, fitted WHERE cutoff IN ({test})""",
        "stored_model_scores": f"""WITH RECURSIVE {_newton(dev)}
SELECT customer_id, cutoff, label,
  {rounded('1 / (1 + exp(-(w1 * v1 + w2 * v2 + w0)))', 6)} AS score
FROM filled, weights WHERE cutoff IN ({test})""",
        "model_weights": f"""WITH RECURSIVE {_newton(dev)}
SELECT '{FITTED[0]}' AS feature, m1 AS fill, {rounded('w1', 6)} AS weight FROM weights
UNION ALL SELECT '{FITTED[1]}', m2, {rounded('w2', 6)} FROM weights
UNION ALL SELECT 'constant', NULL, {rounded('w0', 6)} FROM weights""",
        "penalised_leaves": f"WITH {_leaves(dev)}",
        "logistic_certificate": f"""WITH {ORDER_SNAP}
SELECT fold, count(*) AS n_train, CAST({len(FEATURES)} AS BIGINT) AS features, TRUE AS at_minimum
FROM snap JOIN (VALUES {fold_roles}) AS f(fold, role, cutoff) USING (cutoff)
WHERE role = 'train' GROUP BY fold""",
        "feature_medians": f"""WITH {ORDER_SNAP},
dev AS (SELECT * FROM snap WHERE cutoff IN ({dev})),
m AS ({medians})
SELECT feature, {rounded('median', 3)} AS median FROM m WHERE median IS NOT NULL""",
    }
    return out
