"""Budgets down a domain, language and source tree, and the documents that fill them.

The token budget is split among siblings by their weights. A node cannot take more than all its
leaves hold over ``max_epochs``; what it cannot take goes to its siblings by weight, and only
what all of them cannot take is left to their parent's siblings. That is a water level per set
of siblings, taken from the top: one window over the children of each node, in exact whole
numbers. A leaf repeats its documents for as many whole epochs as its budget holds and adds a
prefix of the next epoch, in that epoch's own seeded order.

The prefix of a leaf is found without ordering the leaf: order keys fall into 4,096 ranges, token
sums per range show in which one the budget ends, and only that range is ordered. Documents are
then kept or left by comparing their key with the leaf's last key. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import words_of
from tidemark.session import materialise

LEVELS = ("domain", "lang", "source")
DOMAINS = 4
RANGE_DIGITS = 3


@dataclass(frozen=True)
class MixSettings:
    """``weights`` holds whole numbers per level and node name; a node not named has weight 1."""

    budget_percent: int = 60
    max_epochs: int = 3
    seed: int = 17
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=lambda: {
        "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
        "lang": {"en": 4, "de": 3, "fr": 2, "es": 2}})


def domain_of(source: Column) -> Column:
    """Domain of a source: its number modulo four; ``other`` for sources without one."""
    number = F.regexp_extract(source, "([0-9]{1,9})", 1)
    return F.when(number != "", F.concat(F.lit("d"), number.cast("bigint") % DOMAINS)
                  ).otherwise("other")


def weight_of(level: str, settings: MixSettings) -> Column:
    chosen = settings.weights.get(level, {})
    out = F.lit(1).cast("bigint")
    for name, weight in chosen.items():
        out = F.when(F.col(level) == name, F.lit(weight).cast("bigint")).otherwise(out)
    return out


def with_leaf(docs: DataFrame) -> DataFrame:
    """Null languages and sources are nodes of their own, named ``none``."""
    return (docs.withColumn("domain", domain_of(F.coalesce("source", F.lit(""))))
            .withColumn("lang", F.coalesce("lang", F.lit("none")))
            .withColumn("source", F.coalesce("source", F.lit("none"))))


def text_digest() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def order_key(epoch: Column, digest: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), digest))


def sizes(docs: DataFrame) -> DataFrame:
    """The narrow table that all steps but the last work on: leaf, tokens and text digest."""
    tokens = F.size(words_of(F.coalesce(F.col("text"), F.lit("")))).cast("bigint")
    return (with_leaf(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang",
                                  "source"))
            .select("doc_id", *LEVELS, tokens.alias("n_tokens"), text_digest().alias("digest"))
            .where("n_tokens > 0"))


def share_out(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Give each child its part ``alloc`` of its parent's ``budget`` under its ``cap``.

    Children are taken in order of the water level that fills them. One is full if, with all
    before it full, its part of the rest reaches its capacity.
    """
    def wide(column: Column | str) -> Column:
        return F.coalesce(F.col(column) if isinstance(column, str) else column,
                          F.lit(0)).cast("decimal(19,0)")

    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.expr("try_divide(double(cap), double(weight))").asc_nulls_last(),
                           F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = (children
            .withColumn("_rest", wide("budget") - wide(F.sum("cap").over(before)))
            .withColumn("_weights", wide(F.sum("weight").over(family))
                        - wide(F.sum("weight").over(before)))
            .withColumn("_fits", F.expr(
                "cast(cap as decimal(19,0)) * cast(_weights as decimal(19,0))"
                " <= cast(_rest as decimal(19,0)) * cast(weight as decimal(19,0))"))
            .withColumn("_full", F.min("_fits").over(upto)))
    open_weight = F.when(~F.col("_full"), F.col("weight")).otherwise(0)
    step = (step.withColumn("_left", F.col("budget")
                            - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0))
                            .over(family))
            .withColumn("_open", F.greatest(F.sum(open_weight).over(family), F.lit(1)))
            .withColumn("_upto", F.sum(open_weight).over(upto)))
    part = ("cast(_left as decimal(19,0)) * cast({} as decimal(19,0))"
            " div cast(_open as decimal(19,0))")
    alloc = F.when(F.col("_full"), F.col("cap")).otherwise(
        F.expr(part.format("_upto")) - F.expr(part.format("(_upto - weight)")))
    return (step.withColumn("alloc", alloc)
            .drop(*(c for c in step.columns if c.startswith("_"))))


def budgets(table: DataFrame, settings: MixSettings) -> DataFrame:
    """One row per leaf: its tokens, capacity and budget ``alloc``."""
    leaves = table.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).withColumn(
        "cap", F.col("tokens") * settings.max_epochs)
    above = None
    for depth, level in enumerate(LEVELS):
        parents = list(LEVELS[:depth])
        nodes = (leaves.groupBy(*parents, level).agg(F.sum("cap").alias("cap"),
                                                     F.sum("tokens").alias("tokens"))
                 .withColumn("weight", weight_of(level, settings)))
        if above is None:
            whole = Window.partitionBy(F.lit(0))
            nodes = (nodes.withColumn("_all", F.sum("tokens").over(whole))
                     .withColumn("budget", F.least(
                         F.expr(f"_all * {settings.budget_percent} div 100"),
                         F.sum("cap").over(whole))).drop("_all"))
        else:
            nodes = nodes.join(above.select(*parents, F.col("alloc").alias("budget")), parents)
        above = share_out(nodes, parents, level)
    return above.select(*LEVELS, "tokens", "cap", "alloc")


def leaf_cuts(table: DataFrame, settings: MixSettings) -> DataFrame:
    """Per leaf: whole epochs ``full`` and the last order key ``cut`` of the epoch after them."""
    leaves = (budgets(table, settings)
              .withColumn("full", F.expr("alloc div tokens"))
              .withColumn("rest", F.expr("alloc % tokens")))
    leaves = materialise(leaves)
    keyed = (table.join(leaves.select(*LEVELS, "full", "rest"), list(LEVELS))
             .withColumn("key", order_key(F.col("full"), F.col("digest"), settings.seed))
             .withColumn("part", F.substring("key", 1, RANGE_DIGITS)))
    by_part = Window.partitionBy(*LEVELS).orderBy("part")
    ends = (keyed.groupBy(*LEVELS, "rest", "part").agg(F.sum("n_tokens").alias("n"))
            .withColumn("upto", F.sum("n").over(by_part))
            .where("upto > rest and upto - n <= rest")
            .select(*LEVELS, "part", (F.col("rest") - F.col("upto") + F.col("n")).alias("left")))
    by_key = (Window.partitionBy(*LEVELS).orderBy("key")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = (keyed.join(ends, [*LEVELS, "part"])
            .withColumn("upto", F.sum("n_tokens").over(by_key))
            .groupBy(*LEVELS, "part")
            .agg(F.coalesce(F.max(F.when(F.col("upto") <= F.col("left"), F.col("key"))),
                            F.col("part")).alias("cut")))
    return leaves.join(last.drop("part"), list(LEVELS), "left").select(
        *LEVELS, "tokens", "alloc", "full", F.coalesce("cut", F.lit("")).alias("cut"))


def copies(rows: DataFrame, cuts: DataFrame, digest: Column, settings: MixSettings) -> DataFrame:
    """The rows of the mix, one per epoch a document is taken in, with that ``epoch``."""
    taken = (order_key(F.col("full"), digest, settings.seed) <= F.col("cut")).cast("bigint")
    return (rows.join(cuts.select(*LEVELS, "full", "cut"), list(LEVELS))
            .withColumn("_times", F.col("full") + taken)
            .where("_times > 0")
            .withColumn("epoch", F.explode(F.expr("sequence(bigint(0), _times - 1)")))
            .drop("full", "cut", "_times"))


def mix(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix as doc_id, domain, lang, source, n_tokens and epoch; one row per copy taken.

    Tokens are the words of a text. Texts without words (null, empty, white space) are never
    taken. A missing language or source is the node ``none``, a source without a number is in
    the domain ``other``. A leaf's prefix never exceeds its budget; rows that repeat the same id
    and text share one place in the order and are taken together. Other columns are ignored; an
    empty table gives no rows.
    """
    table = materialise(sizes(docs))
    # Written, so that its known size decides the join: few leaves go to all tasks, and no leaf
    # has to fit one.
    cuts = materialise(leaf_cuts(table, settings))
    return copies(table, cuts, F.col("digest"), settings).select(
        "doc_id", *LEVELS, "n_tokens", "epoch")


def mixed_documents(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """All columns of the documents of the mix as they are, with ``domain`` and ``epoch``.

    An added column whose name is taken is called ``mix_domain`` or ``mix_epoch`` (and so on).
    Texts without words are never taken; missing ids, languages and sources stay missing, though
    they count as the node ``none``. Repeated rows of one id and text are taken together, each as a
    row. An empty table gives no rows.
    """
    def free(name: str) -> str:
        while name.lower() in {c.lower() for c in docs.columns}:
            name = f"mix_{name}"
        return name

    cuts = materialise(leaf_cuts(materialise(sizes(docs)), settings))
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = with_leaf(docs.where(F.size(words_of(F.coalesce(F.col("text"), F.lit("")))) > 0)
                     .select(whole, "doc_id", "text", "lang", "source"))
    return copies(rows, cuts, text_digest(), settings).select(
        "row.*", F.col("domain").alias(free("domain")), F.col("epoch").alias(free("epoch")))


def _weights_sql(level: str, settings: MixSettings) -> str:
    cases = " ".join(f"when {level} = '{n}' then {w}"
                     for n, w in settings.weights.get(level, {}).items())
    return f"(case {cases} else 1 end)" if cases else "1"


def _share_sql(name: str, source: str, depth: int, level: str) -> str:
    parents = ", ".join(LEVELS[:depth]) or "0"
    by = f"partition by {parents} order by cap::double / weight, {level}"
    return f"""
{name}a as (select *,
    budget - coalesce(sum(cap) over ({by} rows between unbounded preceding and 1 preceding), 0)
        as rest,
    sum(weight) over (partition by {parents}) - coalesce(sum(weight) over ({by}
        rows between unbounded preceding and 1 preceding), 0) as weights from {source}),
{name}b as (select *, min((cap::hugeint * weights::hugeint <= rest::hugeint * weight::hugeint)::int)
    over ({by} rows unbounded preceding) as is_full from {name}a),
{name}c as (select *, budget - sum(case when is_full = 1 then cap else 0 end)
        over (partition by {parents}) as remaining,
    greatest(sum(case when is_full = 1 then 0 else weight end) over (partition by {parents}), 1)
        as open,
    sum(case when is_full = 1 then 0 else weight end) over ({by} rows unbounded preceding) as upto
    from {name}b),
{name} as (select *, (case when is_full = 1 then cap else
    remaining::hugeint * upto::hugeint // open::hugeint
    - remaining::hugeint * (upto - weight)::hugeint // open::hugeint end)::bigint as alloc
    from {name}c)"""


def oracle_sql(settings: MixSettings = MixSettings()) -> str:
    leaf = ", ".join(LEVELS)
    key = ("md5(concat_ws(':', '{}', {}::varchar, coalesce(doc_id::varchar, 'none'), digest))"
           .format(settings.seed, "{}"))
    return f"""
with t as (
    select doc_id, case when regexp_extract(source, '[0-9]{{1,9}}') <> '' then 'd' ||
               (regexp_extract(source, '[0-9]{{1,9}}')::bigint % {DOMAINS})::varchar
               else 'other' end as domain,
           coalesce(lang, 'none') as lang, coalesce(source, 'none') as source,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint
               as n_tokens,
           md5(coalesce(text, '')) as digest
    from documents),
docs as (select * from t where n_tokens > 0),
leaves as (select {leaf}, sum(n_tokens)::bigint as tokens,
    sum(n_tokens)::bigint * {settings.max_epochs} as cap from docs group by all),
d0 as (select domain, sum(cap)::bigint as cap, {_weights_sql("domain", settings)} as weight,
    (select least(sum(tokens)::bigint * {settings.budget_percent} // 100, sum(cap)::bigint)
     from leaves) as budget from leaves group by domain),
{_share_sql("d", "d0", 0, "domain")},
l0 as (select x.*, d.alloc as budget from (select domain, lang, sum(cap)::bigint as cap,
    {_weights_sql("lang", settings)} as weight from leaves group by domain, lang) x
    join d using (domain)),
{_share_sql("l", "l0", 1, "lang")},
s0 as (select v.*, {_weights_sql("source", settings)} as weight, l.alloc as budget
    from leaves v join l using (domain, lang)),
{_share_sql("s", "s0", 2, "source")},
k as (select docs.*, s.alloc // s.tokens as whole, s.alloc % s.tokens as part,
    {key.format("(s.alloc // s.tokens)")} as ok from docs join s using ({leaf})),
r as (select *, sum(n_tokens) over (partition by {leaf} order by ok
    range between unbounded preceding and current row) as upto from k),
n as (select *, (whole + case when upto <= part then 1 else 0 end)::bigint as times from r)
select doc_id, {leaf}, n_tokens, epoch
from (select *, unnest(generate_series(0, times - 1)) as epoch from n where times > 0)
"""
