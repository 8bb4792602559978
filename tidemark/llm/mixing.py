"""Mixing sources to target weights over a domain - language - source tree.

Every level has weights; a leaf (domain, language, source) can supply its tokens
``max_epochs`` times.  The token budget is handed down the tree: at each node it
is dealt to the children by weight; a child whose subtree can't use its share
takes what it can, and the rest is dealt to its siblings again, by weight.  As a
node never gets more than its subtree can supply, a leaf's shortage goes to its
siblings first and reaches other branches only when all of them are used up.

A leaf's budget is filled with whole epochs and the token prefix of one more:
in epoch e its documents stand in the order of md5("seed:e:doc_id"), and those
up to which (inclusive) the tokens fit the remaining budget are taken.

All in DataFrame operations.  The prefix needs no sort of a leaf: keys fall into
about sqrt(n) hash ranges, their totals give the range in which the cut lies,
and only that range's documents are ordered.  What remains is a small table with
one cut per leaf, against which each document decides by itself.

Odd input: tokens are words (runs of other characters than ASCII white space);
documents without tokens, or null texts, are never taken.  A null source or
language counts as "none".  Weights of 0 or less exclude a child.  Repeated rows
share one key and are taken or left together; a null doc_id counts as an empty
one.  Amounts are whole tokens, shares are rounded down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import _written
from tidemark.sources.tables import read_table

LEVELS = ("domain", "lang", "source")
WEIGHTS = {
    "domain": {"web": 5, "books": 3, "reference": 2},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
SHARE = 60  # percent of all tokens
MAX_EPOCHS = 3
SEED = 7

DOMAIN = (
    "CASE WHEN right(source, 1) IN ('0', '1', '2', '3', '4') THEN 'web' "
    "WHEN right(source, 1) IN ('5', '6', '7') THEN 'books' ELSE 'reference' END"
)


def _weight(level: str, weights: dict):
    value = F.lit(1)
    for name, w in weights.get(level, {}).items():
        value = F.when(F.col(level) == name, w).otherwise(value)
    return value.cast("long")


def deal(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``children`` (parent columns, child, weight, cap, budget of the parent)
    with the child's share as ``budget``."""
    group = Window.partitionBy(*parent)
    order = group.orderBy(F.col("cap").cast("double") / F.col("weight"), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    zero = F.lit(0).cast("long")
    left_weight = F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), zero)
    left_budget = F.col("budget") - F.coalesce(F.sum("cap").over(before), zero)
    full = F.col("cap").cast(big) * left_weight <= F.col("weight").cast(big) * left_budget
    rows = children.withColumn("full", full)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), zero)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(group)
    share = F.floor(F.col("weight").cast(big) * rest / open_weight).cast("long")
    return rows.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(share)).select(
        *parent, child, F.col("share").alias("budget")
    )


def budgets(leaves: DataFrame, weights: dict, share: int = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (domain, lang, source, n_docs, supply) with each one's budget."""
    leaves = leaves.where("supply > 0").withColumn("cap", F.col("supply") * max_epochs)
    for level in LEVELS:
        leaves = leaves.withColumn(f"w_{level}", _weight(level, weights))
    leaves = leaves.where("w_domain > 0 AND w_lang > 0 AND w_source > 0")
    leaves = _written(leaves, "mix-leaves")
    total = (leaves.agg(F.sum("supply")).first()[0] or 0) * share // 100
    budget, parent = None, []
    for level in LEVELS:
        path = [*parent, level]
        nodes = leaves.groupBy(*path).agg(F.max(f"w_{level}").alias("weight"), F.sum("cap").alias("cap"))
        nodes = nodes.join(budget, parent) if parent else nodes.withColumn("budget", F.lit(total))
        budget, parent = deal(nodes, parent, level), path
    return leaves.select(*LEVELS, "n_docs", "supply").join(budget, list(LEVELS))


def _md5(seed: int, epoch):
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), doc))


def _range(key, ranges):
    place = F.conv(F.substring(key, 1, 6), 16, 10).cast("long")
    return F.floor(place * ranges / F.lit(1 << 24)).cast("long")


def _tree(docs: DataFrame, domain: str) -> list:
    named = [F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in ("lang", "source")]
    return [F.expr(domain).alias("domain"), *named]


def _tokens():
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plan(
    docs: DataFrame,
    weights: dict = WEIGHTS,
    domain: str = DOMAIN,
    share: int = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(documents' tree columns and n_tokens; one row per leaf with its budget,
    ``whole`` epochs and the cut of the next: hash range and key)."""
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_tree(docs, domain), _tokens().alias("n_tokens"))
    sizes = _written(sizes.where("n_tokens > 0"), "mix-sizes")
    leaves = sizes.groupBy(*LEVELS).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("supply"))
    leaves = budgets(leaves, weights, share, max_epochs)
    leaves = leaves.withColumn("whole", F.floor(F.col("budget") / F.col("supply")))
    leaves = leaves.withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply"))
    leaves = _written(leaves.withColumn("ranges", F.ceil(F.sqrt("n_docs"))), "mix-budgets")

    placed = sizes.join(leaves.where("rest > 0").select(*LEVELS, "whole", "rest", "ranges"), list(LEVELS))
    placed = placed.withColumn("key", _md5(seed, F.col("whole")))
    placed = placed.withColumn("range", _range(F.col("key"), F.col("ranges")))
    totals = placed.groupBy(*LEVELS, "rest", "range").agg(F.sum("n_tokens").alias("t"))
    before = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0)))
    at = totals.where("before <= rest AND before + t > rest")
    at = at.select(*LEVELS, F.col("range").alias("cut"), (F.col("rest") - F.col("before")).alias("room"))
    at = _written(at, "mix-cuts")

    inside = placed.join(at, list(LEVELS)).where("range = cut")
    upto = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("sum", F.sum("n_tokens").over(upto))
    last = inside.where("sum <= room").groupBy(*LEVELS).agg(F.max("key").alias("cut_key"))
    cuts = leaves.join(at.select(*LEVELS, "cut"), list(LEVELS), "left").join(last, list(LEVELS), "left")
    return sizes, _written(cuts, "mix-plan")


def _epochs(seed: int):
    """The epochs in which a row (doc_id and its leaf's plan) is taken."""
    key = _md5(seed, F.col("whole"))
    place = _range(key, F.col("ranges"))
    partial = F.coalesce(
        (place < F.col("cut")) | ((place == F.col("cut")) & (key <= F.col("cut_key"))), F.lit(False)
    )
    count = F.col("whole") + F.when(partial, 1).otherwise(0)
    return F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def mix(docs: DataFrame, seed: int = SEED, domain: str = DOMAIN, **options) -> DataFrame:
    """The rows of ``docs``, all columns, once for every epoch they are taken in."""
    _, cuts = plan(docs, seed=seed, domain=domain, **options)
    names = [F.col(c).alias(f"_{c}") for c in LEVELS]
    cuts = cuts.select(*names, "whole", "ranges", "cut", "cut_key")
    rows = docs.where(_tokens() > 0).select(
        F.struct("*").alias("_row"), F.col("doc_id"), *[c.alias(f"_{n}") for n, c in zip(LEVELS, _tree(docs, domain))]
    )
    rows = rows.join(cuts, [f"_{c}" for c in LEVELS])
    return rows.select("_row", F.explode(_epochs(seed))).select("_row.*")


def selection(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens and epoch of everything taken."""
    sizes, cuts = plan(docs, seed=seed, **options)
    rows = sizes.join(cuts, list(LEVELS))
    return rows.select("doc_id", *LEVELS, "n_tokens", F.explode(_epochs(seed)).alias("epoch"))


def query(spark, sf_dir):
    """The mixture's documents: 60 % of all tokens by the weights above."""
    return selection(read_table(spark, sf_dir, "documents"))


def _deal_sql(out: str, nodes: str, parent: str, child: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    path = f"{parent}, {child}" if parent else child
    return f"""
{out}_o AS (
  SELECT *, cap::HUGEINT * (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER b, 0))
            <= weight * (budget - coalesce(sum(cap) OVER b, 0)) AS saturated
  FROM {nodes}
  WINDOW b AS ({by} ORDER BY CAST(cap AS DOUBLE) / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{out} AS (
  SELECT {path}, CAST(CASE WHEN saturated THEN cap ELSE
           weight * (budget - coalesce(sum(cap) FILTER (WHERE saturated) OVER ({by}), 0))
             // (sum(weight) FILTER (WHERE NOT saturated) OVER ({by})) END AS BIGINT) AS budget
  FROM {out}_o)"""


SQL = f"""
WITH sizes AS (
  SELECT * FROM (
    SELECT doc_id, {DOMAIN} AS domain, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
    FROM documents) WHERE n_tokens > 0),
leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS supply, CAST(3 * sum(n_tokens) AS BIGINT) AS cap,
         CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END AS w1,
         CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w2
  FROM sizes GROUP BY ALL),
total AS (SELECT CAST(sum(supply) * 60 // 100 AS BIGINT) AS budget FROM leaves),
n1 AS (SELECT domain, max(w1) AS weight, sum(cap) AS cap, (SELECT budget FROM total) AS budget FROM leaves GROUP BY domain),
{_deal_sql("d1", "n1", "", "domain")},
n2 AS (SELECT domain, lang, max(w2) AS weight, sum(cap) AS cap, any_value(d1.budget) AS budget
       FROM leaves JOIN d1 USING (domain) GROUP BY domain, lang),
{_deal_sql("d2", "n2", "domain", "lang")},
n3 AS (SELECT domain, lang, source, 1 AS weight, cap, d2.budget FROM leaves JOIN d2 USING (domain, lang)),
{_deal_sql("d3", "n3", "domain, lang", "source")},
leaf AS (SELECT l.domain, l.lang, l.source, budget // supply AS whole, budget % supply AS rest
         FROM leaves l JOIN d3 USING (domain, lang, source)),
keyed AS (SELECT s.*, whole, rest, md5('7:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) AS key
          FROM sizes s JOIN leaf USING (domain, lang, source)),
running AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, CAST(e AS BIGINT) AS epoch
FROM (SELECT *, unnest(range(0, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS e FROM running)
"""
