"""Baskets and association rules (AGG-25, AGG-26, ASC-1..3, JOI-9, TOP-1, STR-8, NST-1)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.io import materialize
from .demand import market
from .joins import sized_broadcast
from .order_stats import quantiles

RULE_COLUMNS = ("LHS", "RHS", "support", "confidence", "lift")


def basket_lines(sales: DataFrame, market_name: str = "UK", home: str = S.HOME_COUNTRY,
                 distinct: bool = True) -> DataFrame:
    """(invoice, item) pairs of one market, distinct unless the consumer
    de-duplicates itself; missing descriptions are no item."""
    lines = (sales.where((market("country", home) == market_name) & F.col("description").isNotNull())
                  .select("invoice_no", F.col("description").alias("item")))
    return lines.distinct() if distinct else lines


def baskets(lines: DataFrame) -> DataFrame:
    """AGG-25 / NST-1: one row per invoice with its sorted distinct items
    (``collect_set`` de-duplicates map-side, so raw lines may be passed)."""
    return (lines.groupBy("invoice_no").agg(F.sort_array(F.collect_set("item")).alias("items"))
                 .withColumn("n_items", F.size("items")))


def basket_sizes(lines: DataFrame) -> DataFrame:
    """AGG-26: distribution of basket sizes."""
    sizes = lines.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n_baskets"))


def item_frequency(lines: DataFrame) -> DataFrame:
    """AGG-26: baskets per item and item support (share of baskets)."""
    n = lines.select(F.countDistinct("invoice_no")).scalar()
    return (lines.groupBy("item").agg(F.count(F.lit(1)).alias("n_baskets"))
                 .withColumn("support", F.col("n_baskets") / n))


def frequent_itemsets(basket_df: DataFrame, min_count: int, max_len: int = S.RULE_MAX_LEN) -> DataFrame:
    """ASC-1: DF[items, freq]: every set of at most ``max_len`` items in ``min_count`` baskets or more, items sorted.

    Level by level: the occurrences of the frequent sets are extended by the
    later items of their basket and counted map-side, so a level shuffles its
    distinct sets and never the baskets; nothing holds a tree of them. Each level
    starts from the baskets again and drops what the levels before it found rare."""
    occurs = basket_df.select(F.array().cast("array<string>").alias("items"),
                              F.sort_array(F.array_distinct(F.array_compact("items"))).alias("rest")).where(F.size("rest") > 0)
    levels, single = [], None
    for length in range(1, max_len + 1):
        # a set goes on with the items that follow it in its basket
        longer = occurs.select("items", "rest", F.posexplode("rest").alias("at", "item"))
        if single is not None:
            longer = longer.join(single, "item", "left_semi")
        occurs = longer.select(F.concat("items", F.array("item")).alias("items"),
                               F.expr("slice(rest, at + 2, size(rest))").alias("rest"))
        counts = occurs.groupBy("items").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_count)
        counts = materialize(counts, f"itemsets-{length}")
        if counts.isEmpty():
            break
        levels.append(counts)
        keep = sized_broadcast(counts.select("items"))
        if single is None:
            single = sized_broadcast(counts.select(F.col("items")[0].alias("item")))
        occurs = occurs.join(keep, "items", "left_semi").where(F.size("rest") > 0)
    if not levels:
        return basket_df.sparkSession.createDataFrame([], "items array<string>, freq long")
    return reduce(DataFrame.unionByName, levels)


def association_rules(basket_df: DataFrame, min_support: float = S.RULE_MIN_SUPPORT,
                      min_confidence: float = S.RULE_MIN_CONFIDENCE, max_len: int = S.RULE_MAX_LEN,
                      num_partitions: int | None = None) -> DataFrame:
    """ASC-1: the rules of the frequent itemsets, with a one-item consequent and
    2 to ``max_len`` items overall.

    A rule per set and item of it: its antecedent is the rest of the set, whose
    count, like the item's, is joined from the itemsets. ``LHS`` joins the sorted
    antecedent with ',' (STR-8 export form) while ``antecedent`` keeps the array.
    """
    if num_partitions:
        basket_df = basket_df.repartition(num_partitions)
    total = basket_df.where(F.col("items").isNotNull()).count()
    sets = frequent_itemsets(basket_df, max(1, math.ceil(min_support * total)), max_len)
    made = (sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("RHS"))
            .select(F.array_except("items", F.array("RHS")).alias("antecedent"), "RHS", "freq"))
    left = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_left"))
    right = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("RHS"), F.col("freq").alias("_right"))
    confidence = F.col("freq").cast("double") / F.col("_left")
    return (made.join(left, "antecedent").join(right, "RHS").where(confidence >= min_confidence)
            .select("antecedent", F.concat_ws(",", "antecedent").alias("LHS"), "RHS",
                    (F.col("freq").cast("double") / F.lit(float(total))).alias("support"), confidence.alias("confidence"),
                    (confidence / (F.col("_right").cast("double") / F.lit(float(total)))).alias("lift")))


def top_rules(rules: DataFrame, n: int = S.TOP_RULES) -> DataFrame:
    """TOP-1: n strongest rules by lift (ties by LHS, RHS)."""
    return rules.orderBy(F.col("lift").desc(), "LHS", "RHS").limit(n)


def rules_summary(rules: DataFrame) -> DataFrame:
    """ASC-3: rule count and the spread of support, confidence and lift (medians by rank)."""
    measures = ("support", "confidence", "lift")
    aggs, columns = [F.count(F.lit(1)).alias("n_rules")], ["n_rules"]
    for m in measures:
        aggs += [F.round(F.min(m), 9).alias(f"min_{m}"), F.round(F.avg(m), 9).alias(f"mean_{m}"), F.round(F.max(m), 9).alias(f"max_{m}")]
        columns += [f"{x}_{m}" for x in ("min", "median", "mean", "max")]
    medians = quantiles(rules, measures, (0.5,)).agg(*[
        F.round(F.max(F.when(F.col("column") == m, F.col("value"))), 9).alias(f"median_{m}") for m in measures])
    return rules.agg(*aggs).join(medians, F.lit(True)).select(*columns)  # two one-row aggregates


def rule_lengths(rules: DataFrame) -> DataFrame:
    """ASC-3: rules per length (antecedent items + 1)."""
    return rules.groupBy((F.size("antecedent") + 1).alias("length")).agg(F.count(F.lit(1)).alias("n_rules"))


def rule_holdout_confidence(rules: DataFrame, holdout_lines: DataFrame, strict: bool = True) -> DataFrame:
    """JOI-9 / ASC-2: P(RHS | LHS) on other baskets and the drop against training.

    NULL when an item never occurs in the holdout baskets or the LHS never
    occurs; with ``strict`` a multi-item LHS is NULL as in the analysed
    workflow, otherwise its items must all be in the basket. The rule side is
    broadcast only when its counted size is small (a top-n list is).
    """
    from .joins import MAX_BROADCAST_BYTES, row_bytes
    r = rules.withColumn("_rid", F.concat_ws("\u0001", "LHS", "RHS")).persist()
    # rule-side tables hold a rule's id at most max_len + 1 times: broadcast them
    # only when that measured bound is small, else plain shuffle joins
    small = (r.agg(F.sum(row_bytes(r))).first()[0] or 0) * (S.RULE_MAX_LEN + 1) <= MAX_BROADCAST_BYTES
    bc = F.broadcast if small else (lambda d: d)
    ante = r.select("_rid", F.explode("antecedent").alias("item"), F.size("antecedent").alias("_k"))
    lhs_hits = (holdout_lines.join(bc(ante), "item")
                .groupBy("_rid", "invoice_no", "_k").agg(F.count(F.lit(1)).alias("_m"))
                .where(F.col("_m") == F.col("_k")).select("_rid", "invoice_no"))
    lhs_n = lhs_hits.groupBy("_rid").agg(F.count(F.lit(1)).alias("_lhs_n"))
    rhs = r.select("_rid", F.col("RHS").alias("item"))
    both_n = (lhs_hits.join(bc(rhs), "_rid")
              .join(holdout_lines, ["invoice_no", "item"], "left_semi")
              .groupBy("_rid").agg(F.count(F.lit(1)).alias("_both_n")))
    items = r.select("_rid", F.explode(F.array_distinct(F.array_union("antecedent", F.array("RHS"))))
                     .alias("item"))
    n_items = items.groupBy("_rid").agg(F.count(F.lit(1)).alias("_n_items"))
    # items of the rules that occur in the holdout: broadcast probe, then a
    # map-side distinct, so a hot item never gathers its rows in one task
    n_known = (holdout_lines.join(bc(items), "item").select("_rid", "item").distinct()
               .groupBy("_rid").agg(F.count(F.lit(1)).alias("_n_known")))
    out = (r.join(n_items, "_rid").join(lhs_n, "_rid", "left").join(both_n, "_rid", "left")
            .join(n_known, "_rid", "left"))
    ok = (F.coalesce("_n_known", F.lit(0)) == F.col("_n_items")) & F.col("_lhs_n").isNotNull()
    if strict:
        ok = ok & (F.size("antecedent") == 1)
    hold = F.when(ok, F.coalesce("_both_n", F.lit(0)).cast("double") / F.col("_lhs_n"))
    return out.select(*RULE_COLUMNS, hold.alias("nouk_confidence"),
                      (F.col("confidence") - hold).alias("confidence_drop"))
