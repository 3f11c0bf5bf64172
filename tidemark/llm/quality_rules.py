"""Quality rules as a ledger of failure bits, judged by versioned policies.

``ledger`` measures every text once and sets one bit per failed rule. What a policy keeps is then
one mask test per row, and the effect of leaving a rule out of a policy follows from how many
rows have which bits, without looking at a text again. Everything is a narrow projection of
built-in functions: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 3


# ---------------------------------------------------------------------------------------------
# Measurements
# ---------------------------------------------------------------------------------------------
def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for a text of white space only."""
    plain = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def covered_words(words: Column, width: int = REPEAT_WIDTH) -> Column:
    """Words that lie in a window of ``width`` words found at least twice in the row.

    Windows are hashed to 64 bits and sorted with their place, so equal ones are neighbours;
    each place that has an equal neighbour covers its words up to the next such place. A chance
    collision within one text has a probability of n * n / 2**65 for n words.
    """
    def hashed(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.struct(
            F.xxhash64(*(F.get(w, i + k) for k in range(width))).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"])
                                         | F.get(s, i + 1)["h"].eqNullSafe(x["h"])))

    def union(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(
            F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    places = bound(F.array_sort(hashed(words)), lambda s: F.array_sort(
        F.transform(repeated(s), lambda x: x["i"])))
    return F.when(F.size(words) < width + 1, F.lit(0).cast("bigint")).otherwise(
        bound(places, union))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")


MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every text; a null text measures as an empty one."""
    text = F.col("text")
    seen = id_and_text(docs).select(
        "doc_id", words_of(text).alias("words"),
        F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")
        .alias("n_symbols"),
        bound(lines_with_words(text), lambda a: F.struct(
            F.size(a).cast("bigint").alias("n"),
            (F.size(a) - F.size(F.array_distinct(a))).cast("bigint").alias("dup")))
        .alias("lines"))
    return seen.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), "word_chars", "n_symbols",
        F.col("lines.n").alias("n_lines"), F.col("lines.dup").alias("n_dup_lines"),
        covered_words(F.col("words")).alias("n_repeat_words"))


# ---------------------------------------------------------------------------------------------
# Rules, ledger, policies
# ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; ``bit`` never changes once in use."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "100 * n_symbols > 20 * n_words"),
    Rule(3, "many_repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "long_words", "word_chars > 25 * n_words"),
    Rule(5, "short_words", "word_chars < 2 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the decision: a document goes if it fails any of these rules."""

    version: str
    rules: tuple[str, ...]


POLICIES = {p.version: p for p in (
    Policy("base", ("too_few_words", "repeated_windows")),
    Policy("v1", ("too_few_words", "repeated_windows", "many_symbols")),
    Policy("v2", tuple(r.name for r in RULES)),
)}
CURRENT = "v2"


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[name] for name in set(policy.rules))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measurements and ``failed_bits`` of every document, one row each.

    Null and empty texts have zero everywhere and fail by their word count; repeated rows are
    measured each; other columns are ignored; an empty table gives no rows. A text is held as an
    array of its words while it is measured.
    """
    bits = F.lit(0).cast("bigint")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit).cast("bigint"))
                              .otherwise(F.lit(0).cast("bigint")))
    return measure(docs).withColumn("failed_bits", bits)


def judge(entries: DataFrame, version: str = CURRENT, rules: tuple[Rule, ...] = RULES
          ) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` of one policy version."""
    def fails(name: str) -> Column:
        return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[name], rules))) != 0

    return (entries.withColumn("base_failed", fails("base"))
            .withColumn("kept", ~F.col("base_failed") & ~fails(version)))


def ablations(entries: DataFrame, version: str = CURRENT, rules: tuple[Rule, ...] = RULES
              ) -> DataFrame:
    """Per rule of a policy: rows that fail it, rows that fail nothing else, and rows kept
    without it. Rows are first counted per combination of bits, of which there are few."""
    policy = POLICIES[version]
    whole = mask(policy, rules)
    counts = entries.groupBy("failed_bits").agg(F.count("*").alias("rows"))
    chosen = [r for r in rules if r.name in policy.rules]
    table = F.array(*(F.struct(F.lit(r.bit).alias("bit"), F.lit(r.name).alias("rule"))
                      for r in chosen))
    each = counts.select("failed_bits", "rows", F.explode(table).alias("r")).select(
        "rows", "r.bit", "r.rule", F.col("failed_bits").bitwiseAND(F.lit(whole)).alias("bits"),
        F.expr("shiftleft(bigint(1), r.bit)").alias("own"))
    fails = F.col("bits").bitwiseAND(F.col("own")) != 0
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("own"))) != 0

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("rows")).otherwise(0)).alias(name)

    return (each.groupBy("bit", "rule")
            .agg(total(fails, "failing"), total(fails & ~others, "failing_only_this"),
                 total(~others, "kept_without")).orderBy("bit"))


ORACLE_SQL = r"""
with base as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
           row_number() over () as rid
    from documents),
grams as (
    select rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] as g
    from (select rid, w, unnest(generate_series(1, len(w) - 2)) as i from base where len(w) > 2)),
hits as (
    select rid, i from (select rid, i, count(*) over (partition by rid, g) as n from grams)
    where n > 1),
covered as (
    select rid, count(distinct i + k) as n
    from hits, (select unnest([0, 1, 2]) as k) group by rid),
m as (
    select b.doc_id, len(w)::bigint as n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint
               as n_symbols,
           len(l)::bigint as n_lines,
           (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
           coalesce(c.n, 0)::bigint as n_repeat_words
    from base b left join covered c using (rid)),
j as (
    select *, (case when n_words < 50 then 1 else 0 end)
        + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
        + (case when 100 * n_symbols > 20 * n_words then 4 else 0 end)
        + (case when n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines then 8 else 0 end)
        + (case when word_chars > 25 * n_words then 16 else 0 end)
        + (case when word_chars < 2 * n_words then 32 else 0 end) as failed_bits
    from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept,
       failed_bits::bigint as failed_bits
from j
"""
