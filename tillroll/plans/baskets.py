"""Queries for baskets, association rules, rule transfer and recommendations.

Rule queries mine the home-market baskets level by level. The test tables are too
sparse for the workflow's own thresholds (support .01 finds no pair at sf0.01,
whose most frequent pair has support ~.007), so besides the default-threshold
query the fixture-level queries use support .002 / confidence .05 (FIXTURES.md).
Category-level baskets (first words of the descriptions) have rules of several
items at the workflow's own thresholds. The DuckDB oracle finds the frequent
itemsets level by level, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import recommend as R
from ..operators import rules as A
from ..sources import fixtures
from ..sources.io import materialize
from . import oracle as O
from .catalog import register
from .stages import clean_sales

FIXTURE_SUPPORT = 0.002
FIXTURE_CONFIDENCE = 0.05
_HOME = O.q(S.HOME_COUNTRY)

O.CTES["uk_b"] = (f"""
  SELECT DISTINCT invoice_no, description AS item FROM sales
  WHERE country = {_HOME} AND description IS NOT NULL""", ("sales",))
O.CTES["nouk_b"] = (f"""
  SELECT DISTINCT invoice_no, description AS item FROM sales
  WHERE country <> {_HOME} AND description IS NOT NULL""", ("sales",))
O.CTES["item_cnt"] = ("SELECT item, count(*) AS c FROM uk_b GROUP BY item", ("uk_b",))
O.CTES["n_baskets"] = ("SELECT count(DISTINCT invoice_no) AS n FROM uk_b", ("uk_b",))


def _level_ctes(name: str, lines: str, support: float, confidence: float, max_len: int = S.RULE_MAX_LEN) -> None:
    """CTEs ``occ_<name>`` and ``rules_<name>``: frequent itemsets level by level, each basket's occurrences extended
    by its larger items and kept where the longer set is still frequent; a rule per set and item of it."""
    n = f"(SELECT count(DISTINCT invoice_no) FROM {lines})"
    often = f"CAST(count(*) OVER (PARTITION BY items) AS DOUBLE) / {n} >= {support}"
    O.CTES[f"occ_{name}"] = (f"""
  SELECT * FROM (SELECT [item] AS items, item AS last, invoice_no FROM {lines}) s QUALIFY {often}
  UNION ALL
  SELECT * FROM (SELECT list_append(o.items, b.item) AS items, b.item AS last, o.invoice_no
                 FROM occ_{name} o JOIN {lines} b ON b.invoice_no = o.invoice_no AND b.item > o.last
                 WHERE len(o.items) < {max_len}) s QUALIFY {often}""", (lines,))
    O.CTES[f"sets_{name}"] = (f"SELECT items, count(*) AS c FROM occ_{name} GROUP BY items", (f"occ_{name}",))
    O.CTES[f"rules_{name}"] = (f"""
  SELECT array_to_string(a.items, ',') AS LHS, s.rhs AS RHS, CAST(s.c AS DOUBLE) / {n} AS support,
         CAST(s.c AS DOUBLE) / a.c AS confidence, (CAST(s.c AS DOUBLE) / a.c) / (CAST(r.c AS DOUBLE) / {n}) AS lift,
         a.items AS antecedent
  FROM (SELECT items, c, unnest(items) AS rhs FROM sets_{name} WHERE len(items) > 1) s
  JOIN sets_{name} a ON a.items = list_filter(s.items, lambda x: x <> s.rhs)
  JOIN sets_{name} r ON r.items = [s.rhs]
  WHERE CAST(s.c AS DOUBLE) / a.c >= {confidence}""", (f"sets_{name}", lines))


# category level: a description's first word; dense enough for the workflow's own thresholds and for longer sets
O.CTES["uk_cat_b"] = (f"""
  SELECT DISTINCT invoice_no, split_part(description, ' ', 1) AS item FROM sales
  WHERE country = {_HOME} AND description IS NOT NULL""", ("sales",))
O.CTES["nouk_cat_b"] = (f"""
  SELECT DISTINCT invoice_no, split_part(description, ' ', 1) AS item FROM sales
  WHERE country <> {_HOME} AND description IS NOT NULL""", ("sales",))
_level_ctes("default", "uk_b", S.RULE_MIN_SUPPORT, S.RULE_MIN_CONFIDENCE)
_level_ctes("fx", "uk_b", FIXTURE_SUPPORT, FIXTURE_CONFIDENCE)
_level_ctes("cat", "uk_cat_b", S.RULE_MIN_SUPPORT, S.RULE_MIN_CONFIDENCE)
O.CTES["top50"] = (f"SELECT * FROM rules_fx ORDER BY lift DESC, LHS, RHS LIMIT {S.HOLDOUT_RULES}", ("rules_fx",))
O.CTES["terms"] = ("""
  SELECT DISTINCT term FROM (
    SELECT p_name AS term FROM part
    UNION ALL SELECT split_part(p_name, ' ', 1) FROM part
    UNION ALL SELECT translate(p_name, 'aeiou', 'eioua') FROM part) t
  WHERE term IS NOT NULL AND term <> ''""", ())
O.CTES["products"] = ("SELECT DISTINCT product FROM (SELECT LHS AS product FROM rules_fx UNION ALL "
                      "SELECT RHS FROM rules_fx) p WHERE product IS NOT NULL", ("rules_fx",))
O.CTES["matched"] = ("""
  SELECT term, arg_min(product, struct_pack(k := k, l := length(product), p := product)) AS product,
         CASE WHEN min(k) = 0 THEN 'exact' ELSE 'substring' END AS match_type
  FROM (SELECT t.term, p.product, CASE WHEN upper(p.product) = upper(t.term) THEN 0 ELSE 1 END AS k
        FROM terms t JOIN products p ON contains(upper(p.product), upper(t.term))) h
  GROUP BY term""", ("terms", "products"))
_PAIRS = "list_distinct(list_transform(range(1, length({0}) + 2), lambda i: substr(' ' || upper({0}) || ' ', i, 2)))"
O.CTES["alike"] = (f"""
  SELECT term, arg_min(product, struct_pack(s := -score, p := product)) AS product, 'fuzzy' AS match_type
  FROM (SELECT term, product, 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS score
        FROM (SELECT term, {_PAIRS.format('term')} AS a FROM terms WHERE term NOT IN (SELECT term FROM matched)) t
        CROSS JOIN (SELECT product, {_PAIRS.format('product')} AS b FROM products) p) x
  WHERE score >= {S.FUZZY_CUTOFF} GROUP BY term""", ("matched", "products"))
O.CTES["matched_all"] = ("""
  SELECT term, product, match_type FROM matched UNION ALL SELECT term, product, match_type FROM alike
  UNION ALL SELECT term, NULL, 'no_match' FROM terms
  WHERE term NOT IN (SELECT term FROM matched) AND term NOT IN (SELECT term FROM alike)""", ("matched", "alike"))
_RECS_SQL = f"""
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY term ORDER BY lift DESC, LHS, RHS) AS INTEGER) AS rank FROM (
      SELECT m.term, m.product, m.match_type, 'lhs' AS direction, r.RHS AS recommended,
             r.LHS, r.RHS, r.support, r.confidence, r.lift
      FROM matched m JOIN rules_fx r ON upper(r.LHS) = upper(m.product)
      UNION ALL
      SELECT m.term, m.product, m.match_type, 'rhs', r.LHS, r.LHS, r.RHS, r.support, r.confidence, r.lift
      FROM matched m JOIN rules_fx r ON upper(r.RHS) = upper(m.product)
      WHERE m.term NOT IN (SELECT m2.term FROM matched m2 JOIN rules_fx r2 ON upper(r2.LHS) = upper(m2.product))
    ) u) z
  WHERE rank <= {S.RECOMMEND_TOP_N}
  UNION ALL
  SELECT DISTINCT term, NULL, 'no_match', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM terms
  WHERE term IS NOT NULL AND term NOT IN (SELECT term FROM matched)"""
O.CTES["recs"] = (_RECS_SQL, ("matched", "terms"))
O.CTES["found_all"] = ("SELECT * FROM matched_all WHERE product IS NOT NULL", ("matched_all",))
O.CTES["recs_all"] = (_RECS_SQL.replace("FROM matched", "FROM found_all"), ("found_all", "terms"))


def uk_lines(spark, sf):
    # (invoice, item) pairs are near line-level: recomputed from the stage table, not cached
    return fixtures.stage(spark, ("uk_lines", sf.rstrip("/")), lambda: A.basket_lines(clean_sales(spark, sf), "UK"))


def nouk_lines(spark, sf):
    return fixtures.stage(spark, ("nouk_lines", sf.rstrip("/")),
                         lambda: A.basket_lines(clean_sales(spark, sf), "Non-UK"))


def uk_baskets(spark, sf):
    # a row per invoice grows with the lines: a stage table, not cached blocks; the miner scans it once per level
    return fixtures.stage(spark, ("uk_baskets", sf.rstrip("/")), lambda: materialize(
        A.baskets(A.basket_lines(clean_sales(spark, sf), "UK", distinct=False)), "uk_baskets"))


def rules(spark, sf, support=FIXTURE_SUPPORT, confidence=FIXTURE_CONFIDENCE):
    return fixtures.memo(spark, ("rules", sf.rstrip("/"), support, confidence),
                         lambda: A.association_rules(uk_baskets(spark, sf), support, confidence))


def search_terms(spark, sf):
    """Lookup terms derived from the part catalogue: full names (exact hits),
    first words (substring hits) and vowel-shifted names (fuzzy candidates)."""
    p = fixtures.read_table(spark, sf, "part").select("p_name")
    t = (p.select(F.col("p_name").alias("term"))
          .union(p.select(F.split("p_name", " ").getItem(0).alias("term")))
          .union(p.select(F.translate("p_name", "aeiou", "eioua").alias("term"))))
    return t.where(F.col("term").isNotNull() & (F.col("term") != "")).distinct()


_R = "LHS, RHS, support, confidence, lift"


@register("baskets", O.sql("SELECT invoice_no, array_to_string(list(item ORDER BY item), ' | ') AS items, "
                           "count(*) AS n_items FROM uk_b GROUP BY invoice_no", "uk_b"),
          ids=("AGG-25", "NST-1", "FLT-6"))
def q_baskets(spark, sf):
    # the operator keeps array<string> (FP-growth input); the registered query
    # shows the sorted items as text so any row hash can compare it
    return uk_baskets(spark, sf).select("invoice_no", F.array_join("items", " | ").alias("items"), "n_items")


@register("basket_sizes", O.sql("SELECT size, count(*) AS n_baskets FROM (SELECT invoice_no, count(*) AS size "
                                "FROM uk_b GROUP BY invoice_no) s GROUP BY size", "uk_b"), ids=("AGG-26",))
def q_basket_sizes(spark, sf):
    return A.basket_sizes(uk_lines(spark, sf))


@register("item_frequency", O.sql("SELECT item, c AS n_baskets, CAST(c AS DOUBLE) / (SELECT n FROM n_baskets) "
                                  "AS support FROM item_cnt", "item_cnt", "n_baskets"), ids=("AGG-26",))
def q_item_frequency(spark, sf):
    return A.item_frequency(uk_lines(spark, sf))


@register("association_rules", O.sql(f"SELECT {_R} FROM rules_default", "rules_default"), ids=("ASC-1",))
def q_association_rules(spark, sf):
    return rules(spark, sf, S.RULE_MIN_SUPPORT, S.RULE_MIN_CONFIDENCE).select(*A.RULE_COLUMNS)


@register("association_rules_fixture", O.sql(f"SELECT {_R} FROM rules_fx", "rules_fx"), ids=("ASC-1", "STR-8"))
def q_association_rules_fixture(spark, sf):
    return rules(spark, sf).select(*A.RULE_COLUMNS)


@register("top_rules", O.sql(f"SELECT {_R} FROM rules_fx ORDER BY lift DESC, LHS, RHS LIMIT {S.TOP_RULES}",
                             "rules_fx"), ids=("TOP-1", "TOP-4"))
def q_top_rules(spark, sf):
    return A.top_rules(rules(spark, sf), S.TOP_RULES).select(*A.RULE_COLUMNS)


@register("rules_summary", O.sql("""
SELECT count(*) AS n_rules,
       round(min(support), 9) AS min_support, round(quantile_cont(support, 0.5), 9) AS median_support,
       round(avg(support), 9) AS mean_support, round(max(support), 9) AS max_support,
       round(min(confidence), 9) AS min_confidence, round(quantile_cont(confidence, 0.5), 9) AS median_confidence,
       round(avg(confidence), 9) AS mean_confidence, round(max(confidence), 9) AS max_confidence,
       round(min(lift), 9) AS min_lift, round(quantile_cont(lift, 0.5), 9) AS median_lift,
       round(avg(lift), 9) AS mean_lift, round(max(lift), 9) AS max_lift
FROM rules_fx""", "rules_fx"), ids=("ASC-3",))
def q_rules_summary(spark, sf):
    return A.rules_summary(rules(spark, sf))


@register("rule_lengths", O.sql("SELECT CAST(len(antecedent) + 1 AS INTEGER) AS length, count(*) AS n_rules FROM rules_fx GROUP BY 1",
                                "rules_fx"), ids=("ASC-3",))
def q_rule_lengths(spark, sf):
    return A.rule_lengths(rules(spark, sf))


@register("rule_transfer", O.sql(f"""
SELECT t.LHS, t.RHS, t.support, t.confidence, t.lift,
       CASE WHEN li.item IS NOT NULL AND ri.item IS NOT NULL AND ln.n > 0
            THEN CAST(COALESCE(bn.n, 0) AS DOUBLE) / ln.n END AS nouk_confidence,
       t.confidence - CASE WHEN li.item IS NOT NULL AND ri.item IS NOT NULL AND ln.n > 0
            THEN CAST(COALESCE(bn.n, 0) AS DOUBLE) / ln.n END AS confidence_drop
FROM top50 t
LEFT JOIN (SELECT DISTINCT item FROM nouk_b) li ON li.item = t.LHS
LEFT JOIN (SELECT DISTINCT item FROM nouk_b) ri ON ri.item = t.RHS
LEFT JOIN (SELECT item, count(*) AS n FROM nouk_b GROUP BY item) ln ON ln.item = t.LHS
LEFT JOIN (SELECT a.item AS lhs, b.item AS rhs, count(*) AS n FROM nouk_b a JOIN nouk_b b
           ON a.invoice_no = b.invoice_no GROUP BY 1, 2) bn ON bn.lhs = t.LHS AND bn.rhs = t.RHS""",
    "top50", "nouk_b"), ids=("ASC-2", "JOI-9", "UDF-3"))
def q_rule_transfer(spark, sf):
    top = A.top_rules(rules(spark, sf), S.HOLDOUT_RULES)
    return A.rule_holdout_confidence(top, nouk_lines(spark, sf))


def category_lines(spark, sf, market="UK"):
    lines = A.basket_lines(clean_sales(spark, sf), market, distinct=False)
    return lines.withColumn("item", F.split("item", " ").getItem(0))


def category_rules(spark, sf):
    return fixtures.memo(spark, ("category_rules", sf.rstrip("/")), lambda: A.association_rules(
        A.baskets(category_lines(spark, sf)), S.RULE_MIN_SUPPORT, S.RULE_MIN_CONFIDENCE))


@register("category_rules", O.sql(f"SELECT {_R} FROM rules_cat", "rules_cat"), ids=("ASC-1", "STR-8"))
def q_category_rules(spark, sf):
    """Rules between categories at the workflow's own thresholds, several items on the left side included."""
    return category_rules(spark, sf).select(*A.RULE_COLUMNS)


@register("category_rule_lengths", O.sql("SELECT CAST(len(antecedent) + 1 AS INTEGER) AS length, count(*) AS n_rules FROM rules_cat GROUP BY 1",
                                         "rules_cat"), ids=("ASC-3",))
def q_category_rule_lengths(spark, sf):
    return A.rule_lengths(category_rules(spark, sf))


O.CTES["cat_top"] = (f"SELECT * FROM rules_cat ORDER BY lift DESC, LHS, RHS LIMIT {S.HOLDOUT_RULES}", ("rules_cat",))
O.CTES["cat_hits"] = ("""
  SELECT t.LHS, t.RHS, count(*) AS lhs_n, count_if(list_contains(b.items, t.RHS)) AS both_n
  FROM cat_top t JOIN (SELECT invoice_no, list(item) AS items FROM nouk_cat_b GROUP BY invoice_no) b
    ON list_has_all(b.items, t.antecedent)
  GROUP BY t.LHS, t.RHS""", ("cat_top", "nouk_cat_b"))
O.CTES["cat_known"] = ("SELECT list(DISTINCT item) AS items FROM nouk_cat_b", ("nouk_cat_b",))


@register("category_rule_transfer", O.sql("""
SELECT t.LHS, t.RHS, t.support, t.confidence, t.lift, CAST(h.both_n AS DOUBLE) / h.lhs_n AS nouk_confidence,
       t.confidence - CAST(h.both_n AS DOUBLE) / h.lhs_n AS confidence_drop
FROM cat_top t LEFT JOIN (
  SELECT h.* FROM cat_hits h JOIN cat_top u ON u.LHS = h.LHS AND u.RHS = h.RHS, cat_known k
  WHERE list_has_all(k.items, list_append(u.antecedent, u.RHS))) h ON h.LHS = t.LHS AND h.RHS = t.RHS""",
    "cat_top", "cat_hits", "cat_known"), ids=("ASC-2", "JOI-9", "UDF-3"))
def q_category_rule_transfer(spark, sf):
    """The strongest category rules on foreign baskets; a left side of several items counts where all of them are."""
    top = A.top_rules(category_rules(spark, sf), S.HOLDOUT_RULES)
    return A.rule_holdout_confidence(top, category_lines(spark, sf, "Non-UK").distinct(), strict=False)


@register("rule_products", O.sql("SELECT product FROM products", "products"), ids=("REC-1", "SET-3"))
def q_rule_products(spark, sf):
    return R.rule_products(rules(spark, sf))


@register("match_products_direct", O.sql("SELECT term, product, match_type FROM matched", "matched"),
          ids=("REC-2", "STR-6"))
def q_match_products_direct(spark, sf):
    return R.exact_or_substring(search_terms(spark, sf), R.rule_products(rules(spark, sf)))


def matches(spark, sf, fuzzy=True):
    """The matched terms, a row each: every recommendation query starts from them."""
    return fixtures.memo(spark, ("matches", sf.rstrip("/"), fuzzy), lambda: R.match_products(
        search_terms(spark, sf), R.rule_products(rules(spark, sf)), fuzzy=fuzzy))


@register("match_products", O.sql("SELECT term, product, match_type FROM matched_all", "matched_all"), ids=("REC-2", "UDF-5"))
def q_match_products(spark, sf):
    return matches(spark, sf)


def _recs(spark, sf, fuzzy=False):
    """Without ``fuzzy`` the first two steps only: 'no_match' then says that no exact or substring match exists."""
    return R.recommend(matches(spark, sf, fuzzy), rules(spark, sf))


@register("recommend", O.sql("SELECT * FROM recs", "recs"), ids=("REC-3", "JOI-11", "WIN-7"))
def q_recommend(spark, sf):
    return _recs(spark, sf)


_LEGEND_SQL = """
SELECT term, product, recommended, CAST(round_even(confidence * 100, 0) AS INTEGER) AS conf_pct,
       round_even(lift, 1) AS lift_1, round_even(support * 100, 1) AS support_pct_1
FROM recs WHERE rank = 1 OR rank IS NULL"""


@register("recommend_legend", O.sql(_LEGEND_SQL, "recs"), ids=("REC-5",))
def q_recommend_legend(spark, sf):
    return R.recommend_legend(_recs(spark, sf))


@register("recommend_fuzzy", O.sql("SELECT * FROM recs_all", "recs_all"), ids=("REC-2", "REC-3", "UDF-5"))
def q_recommend_fuzzy(spark, sf):
    """Recommendations after all three matching steps."""
    return _recs(spark, sf, fuzzy=True)


@register("recommend_legend_fuzzy", O.sql(_LEGEND_SQL.replace("FROM recs", "FROM recs_all"), "recs_all"), ids=("REC-5",))
def q_recommend_legend_fuzzy(spark, sf):
    return R.recommend_legend(_recs(spark, sf, fuzzy=True))


@register("browse_products", O.sql("""
SELECT k.keyword, p.product FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS keyword FROM part) k
JOIN products p ON contains(upper(p.product), upper(trim(k.keyword)))
WHERE k.keyword <> ''
ORDER BY k.keyword, p.product""", "products"), ids=("REC-4",))
def q_browse_products(spark, sf):
    kw = (fixtures.read_table(spark, sf, "part")
          .select(F.split("p_name", " ").getItem(0).alias("keyword")).where(F.col("keyword") != "").distinct())
    return R.browse_products(R.rule_products(rules(spark, sf)), kw)


@register("rules_export_roundtrip", O.sql(f"SELECT {_R} FROM rules_fx", "rules_fx"), ids=("SNK-3", "SRC-4", "SNK-1"))
def q_rules_export_roundtrip(spark, sf):
    """Export the rules as CSV into the shared folder and read them back."""
    from ..sources.io import read_rules, stage_path, write_rules
    path = stage_path(spark, "association_rules_csv")
    write_rules(rules(spark, sf), path)
    return read_rules(spark, path).select(*A.RULE_COLUMNS)
