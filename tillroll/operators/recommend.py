"""Product lookup and recommendations from rules (REC-1..5, JOI-11, WIN-7, UDF-5).

Matching a batch of search terms against the rule catalogue runs as joins over
posting tables, never term by term over the catalogue:

* exact and substring hits: every product is posted under its 1- to 3-character
  grams, at most 3 rows per character of its name; a term looks under its
  rarest gram only, and what it finds there is tested with ``contains``;
* terms without such a hit: a set-similarity join on the distinct character
  pairs of the padded names (Dice coefficient, at least ``cutoff``). Pairs are
  put in one order, rare ones first; two names that are similar enough share a
  pair within a prefix of that order, and their sizes lie within a factor, so
  only those candidates are tested, in Spark expressions.

The Dice coefficient is another measure than the ratio of matching blocks of the
analysed workflow, with the same form (twice the shared part over both sizes)
and cutoff; it can be joined on, and needs no comparison of all with all.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


def rule_products(rules: DataFrame) -> DataFrame:
    """REC-1: every product text in a rule (a composite LHS counts as one)."""
    return (rules.select(F.col("LHS").alias("product")).union(rules.select(F.col("RHS").alias("product")))
                 .where(F.col("product").isNotNull()).distinct())


def _grams(text: F.Column, length: int) -> F.Column:
    """The distinct substrings of ``length`` characters; none for a shorter text."""
    last = F.length(text) - length + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(length))))
                  ).otherwise(F.array().cast("array<string>"))


def gram_postings(products: DataFrame) -> DataFrame:
    """(product, _up, gram) for every gram of 1 to 3 characters of upper(product)."""
    up = F.upper("product")
    every = F.concat(_grams(up, 1), _grams(up, 2), _grams(up, 3))
    return products.select("product").distinct().select("product", up.alias("_up"), F.explode(every).alias("gram"))


def containing(keys: DataFrame, products: DataFrame) -> DataFrame:
    """DF[key, product, _up]: the products whose upper-cased name contains the key; ``keys`` holds distinct,
    upper-cased keys. An empty key finds nothing."""
    postings = gram_postings(products)
    parts = keys.select("key", F.explode(_grams(F.col("key"), 3)).alias("gram")).unionByName(
        keys.where(F.length("key").between(1, 2)).select("key", F.col("key").alias("gram")))
    sizes = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # a gram that no product has rules its key out: its n is NULL and sorts first
    rarest = (parts.join(sizes, "gram", "left").groupBy("key")
              .agg(F.min(F.struct("n", "gram")).alias("r")).where(F.col("r.n").isNotNull()).select("key", F.col("r.gram").alias("gram")))
    return rarest.join(postings, "gram").where(F.contains("_up", "key")).select("key", "product", "_up")


def exact_or_substring(terms: DataFrame, products: DataFrame) -> DataFrame:
    """REC-2 steps 1-2: exact case-blind match, else the shortest product that
    contains the term (ties by name). DF[term, product, match_type]."""
    keyed = terms.select("term", F.upper("term").alias("key")).where(F.col("term").isNotNull())
    hits = keyed.join(containing(keyed.select("key").distinct(), products), "key")
    kind = F.when(F.col("_up") == F.col("key"), F.lit(0)).otherwise(F.lit(1))
    best = (hits.groupBy("term")
                .agg(F.min(F.struct(kind.alias("k"), F.length("product").alias("l"), F.col("product").alias("p")))
                     .alias("b")))
    return best.select("term", F.col("b.p").alias("product"),
                       F.when(F.col("b.k") == 0, "exact").otherwise("substring").alias("match_type"))


def pair_set(text: F.Column) -> F.Column:
    """The distinct character pairs of the upper-cased text with a blank at both ends."""
    return _grams(F.concat(F.lit(" "), F.upper(text), F.lit(" ")), 2)


def similar_match(terms: DataFrame, products: DataFrame, cutoff: float = S.FUZZY_CUTOFF) -> DataFrame:
    """REC-2 step 3: per term the product with the highest Dice coefficient >= ``cutoff`` of the character pairs
    (ties by name). DF[term, product, score], terms with a match only.

    With a and b pairs a match shares at least cutoff * (a + b) / 2 of them, so b
    is at least a * cutoff / (2 - cutoff), and as many are shared at least: one of
    them stands among the first a - that + 1 pairs of either name."""
    least = Fraction(str(cutoff)) / (2 - Fraction(str(cutoff)))
    bound = lambda c: F.ceil(F.col(c) * F.lit(least.numerator) / F.lit(least.denominator))
    side = lambda df, name: df.select(name).where(F.col(name).isNotNull()).distinct().withColumn("pairs", pair_set(F.col(name)))
    left, right = side(terms, "term").persist(), side(products, "product").persist()
    size = (left.select(F.explode("pairs").alias("gram")).unionByName(right.select(F.explode("pairs").alias("gram")))
            .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))

    def prefix(df: DataFrame, name: str) -> DataFrame:
        ranked = (df.select(name, F.size("pairs").alias("size"), F.explode("pairs").alias("gram")).join(size, "gram")
                  .withColumn("_rank", F.row_number().over(Window.partitionBy(name).orderBy("n", "gram"))))
        return ranked.where(F.col("_rank") <= F.col("size") - bound("size") + 1).select(name, "gram", F.col("size").alias(f"{name}_size"))

    near = F.least("term_size", "product_size") * least.denominator >= F.greatest("term_size", "product_size") * least.numerator
    pairs = (prefix(left, "term").join(prefix(right, "product"), "gram").where(near).select("term", "product").distinct()
             .join(left.withColumnRenamed("pairs", "a"), "term").join(right.withColumnRenamed("pairs", "b"), "product"))
    score = 2.0 * F.size(F.array_intersect("a", "b")) / (F.size("a") + F.size("b"))
    best = (pairs.select("term", "product", score.alias("score")).where(F.col("score") >= cutoff)
            .groupBy("term").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("product").alias("p"))).alias("b")))
    return best.select("term", F.col("b.p").alias("product"), (-F.col("b.s")).alias("score"))


def match_products(terms: DataFrame, products: DataFrame, cutoff: float = S.FUZZY_CUTOFF,
                   fuzzy: bool = True) -> DataFrame:
    """REC-2: DF[term, product, match_type] with match_type exact / substring /
    fuzzy / no_match."""
    terms = terms.select("term").where(F.col("term").isNotNull()).distinct()
    direct = exact_or_substring(terms, products)
    rest = terms.join(direct.select("term"), "term", "left_anti")
    if fuzzy:
        found = rest.join(similar_match(rest, products, cutoff), "term", "left")
        fz = found.select("term", "product", F.when(F.col("product").isNotNull(), "fuzzy").otherwise("no_match").alias("match_type"))
    else:
        fz = rest.select("term", F.lit(None).cast("string").alias("product"), F.lit("no_match").alias("match_type"))
    return direct.unionByName(fz)


def recommend(matches: DataFrame, rules: DataFrame, n: int = S.RECOMMEND_TOP_N) -> DataFrame:
    """REC-3 / JOI-11 / WIN-7: top n rules by lift for each matched product:
    rules where it is the LHS (recommend the RHS), else where it is the RHS
    (show the LHS that predicts it). A term without a product stays as one row
    whose rule fields and rank are NULL."""
    m = matches.where(F.col("product").isNotNull()).withColumn("_key", F.upper("product"))
    r = rules.select("LHS", "RHS", "support", "confidence", "lift")
    by_lhs = (m.join(r.withColumn("_key", F.upper("LHS")), "_key")
               .select("term", "product", "match_type", F.lit("lhs").alias("direction"),
                       F.col("RHS").alias("recommended"), "LHS", "RHS", "support", "confidence", "lift"))
    no_lhs = m.join(by_lhs.select("term").distinct(), "term", "left_anti")
    by_rhs = (no_lhs.join(r.withColumn("_key", F.upper("RHS")), "_key")
                    .select("term", "product", "match_type", F.lit("rhs").alias("direction"),
                            F.col("LHS").alias("recommended"), "LHS", "RHS", "support", "confidence", "lift"))
    both = by_lhs.unionByName(by_rhs)
    w = Window.partitionBy("term").orderBy(F.col("lift").desc(), "LHS", "RHS")
    ranked = both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    unmatched = matches.where(F.col("product").isNull()).select(
        "term", "product", "match_type",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in ranked.schema.fields[3:]])
    return ranked.unionByName(unmatched)


def recommend_legend(recs: DataFrame) -> DataFrame:
    """REC-5: the rank-1 explanation fields per term (NULL for a term without a match)."""
    top = recs.where((F.col("rank") == 1) | F.col("rank").isNull())
    return top.select(
        "term", "product", "recommended",
        F.bround(F.col("confidence") * 100, 0).cast("int").alias("conf_pct"),
        F.bround("lift", 1).alias("lift_1"),
        F.bround(F.col("support") * 100, 1).alias("support_pct_1"))


def browse_products(products: DataFrame, keywords: DataFrame) -> DataFrame:
    """REC-4: products whose upper-cased name contains the upper-cased keyword,
    via the gram postings (an equi-join), sorted."""
    kw = keywords.select("keyword", F.upper(F.trim("keyword")).alias("key"))
    hits = containing(kw.select("key").distinct(), products)
    return kw.join(hits, "key").select("keyword", "product").distinct().orderBy("keyword", "product")
