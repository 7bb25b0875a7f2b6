"""Validation and split-decision profiles of the raw lines (VAL-*, FLT-1..5, AGG-2..14).

Each profile is one aggregate over one scan (``count_if`` columns), so a
profile costs a single pass whatever the number of checks. Inputs use the clean
column names (apply ``normalize_columns`` to a workbook-named extract first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import ratio, sign_bucket, try_numeric
from ..functions.text import full_match, icontains, invoice_prefix, starts, strip_code, strip_ws
from .order_stats import quantiles


def _n() -> F.Column:
    return F.count(F.lit(1))


def eda_frame(df: DataFrame) -> DataFrame:
    """STR-2: the EDA stage compares stock codes as stripped text."""
    return df.withColumn("stock_code", strip_code("stock_code"))


def is_special_stock(c="stock_code", pattern: str = S.STOCK_NORMAL_WIDE_PATTERN) -> F.Column:
    """VAL-5: anything but 5 digits plus up to two letters."""
    return ~full_match(c, pattern)


def code_family(c="stock_code") -> F.Column:
    """FLT-5: DCGS / GIFT / OTHER_SPECIAL / NORMAL."""
    return (F.when(icontains(c, S.DCGS_TOKEN), "DCGS").when(icontains(c, S.GIFT_TOKEN), "GIFT")
             .when(is_special_stock(c), "OTHER_SPECIAL").otherwise("NORMAL"))


# ----------------------------------------------------------------------------- VAL
def validate_invoice(df: DataFrame, pattern: str = S.INVOICE_PATTERN) -> DataFrame:
    """VAL-1: valid/invalid counts, rate and distinct keys of the bad rows."""
    bad = ~full_match("invoice_no", pattern)
    return df.agg(
        F.count_if(~bad).alias("valid_count"),
        F.count_if(bad).alias("invalid_count"),
        ratio(F.count_if(bad), _n()).alias("invalid_rate"),
        F.countDistinct(F.when(bad, F.col("stock_code"))).alias("invalid_unique_stock_codes"),
        F.countDistinct(F.when(bad, F.col("country"))).alias("invalid_unique_countries"),
        F.countDistinct(F.when(bad, F.col("customer_id"))).alias("invalid_unique_customers"),
    )


def invalid_rows(df: DataFrame, pattern: str = S.INVOICE_PATTERN, col: str = "invoice_no") -> DataFrame:
    """VAL-1: every row failing the format rule."""
    return df.where(~full_match(col, pattern))


def customer_text(c="customer_id") -> F.Column:
    """Customer id as integer text (NULL stays NULL)."""
    return F.col(c).try_cast("long").cast("string") if isinstance(c, str) else c.try_cast("long").cast("string")


def validate_customer(df: DataFrame, pattern: str = S.CUSTOMER_PATTERN) -> DataFrame:
    """VAL-2: missing count and rate; present ids must be 5 digits."""
    present = F.col("customer_id").isNotNull()
    ok = full_match(customer_text(), pattern)
    return df.agg(
        F.count_if(~present).alias("missing_count"),
        ratio(F.count_if(~present), _n()).alias("missing_rate"),
        F.count_if(present & ok).alias("valid_count"),
        F.count_if(present & ~ok).alias("invalid_count"),
    )


def customer_examples(df: DataFrame, n: int = 10, pattern: str = S.CUSTOMER_PATTERN) -> DataFrame:
    """VAL-2: the first n rows, in the total row order, whose customer id is present and not of the known form."""
    bad = df.where(F.col("customer_id").isNotNull() & ~F.coalesce(full_match(customer_text(), pattern), F.lit(False)))
    return bad.select(*S.RAW_COLUMNS).orderBy(*[F.col(c).asc_nulls_last() for c in S.RAW_COLUMNS]).limit(n)


def validate_amounts(df: DataFrame) -> DataFrame:
    """VAL-3 / NUM-1: non-numeric counts and sign breakdown of quantity and price, as text or as numbers."""
    q, p = try_numeric(F.col("quantity").cast("string")), try_numeric(F.col("price").cast("string"))
    return df.agg(
        F.count_if(q.isNull()).alias("quantity_non_numeric"),
        F.count_if(p.isNull()).alias("price_non_numeric"),
        F.count_if(q < 0).alias("quantity_neg"), F.count_if(q == 0).alias("quantity_zero"),
        F.count_if(q > 0).alias("quantity_pos"),
        F.count_if(p < 0).alias("price_neg"), F.count_if(p == 0).alias("price_zero"),
        F.count_if(p > 0).alias("price_pos"),
    )


def amount_examples(df: DataFrame, n: int = 10) -> DataFrame:
    """VAL-3: first n negative-price rows and first n zero-quantity rows in the
    total row order (one ordered limit each: top-n merge, no global sort)."""
    order = [F.col(x).asc_nulls_last() for x in S.RAW_COLUMNS]
    neg = df.where(F.col("price") < 0).orderBy(*order).limit(n).withColumn("kind", F.lit("negative_price"))
    zero = df.where(F.col("quantity") == 0).orderBy(*order).limit(n).withColumn("kind", F.lit("zero_quantity"))
    return neg.unionByName(zero)


def date_profile(df: DataFrame, col: str = "invoice_date") -> DataFrame:
    """DAT-1: parse with coercion; valid/invalid counts, rate, range."""
    parsed = F.col(col).cast("string").try_cast("timestamp_ntz")
    return df.agg(
        F.count(parsed).alias("valid_dates"),
        F.count_if(parsed.isNull()).alias("invalid_dates"),
        ratio(F.count_if(parsed.isNull()), _n()).alias("invalid_rate"),
        F.min(parsed).alias("min_date"),
        F.max(parsed).alias("max_date"),
    )


def stock_code_profile(df: DataFrame) -> DataFrame:
    """VAL-4 / AGG-2: code classes, distinct counts, ambiguous codes."""
    code = F.col("stock_code").cast("string")
    numeric = full_match(code, S.STOCK_NUMERIC_PATTERN)
    special = ~(numeric | full_match(code, S.STOCK_SUFFIX_PATTERN))
    return df.agg(
        F.count_if(numeric).alias("numeric_count"),
        F.count_if(~numeric).alias("non_numeric_count"),
        ratio(F.count_if(~numeric), _n()).alias("non_numeric_rate"),
        F.countDistinct(code).alias("unique_codes"),
        F.countDistinct(F.when(~numeric, code)).alias("unique_non_numeric"),
        F.count_if(special).alias("special_count"),
        F.countDistinct(F.when(special, code)).alias("unique_special"),
    )


def ambiguous_codes(df: DataFrame) -> DataFrame:
    """AGG-2: number of stock codes with more than one description."""
    return desc_per_code(df).agg(F.count_if(F.col("n_descriptions") > 1).alias("ambiguous_codes"))


def special_rows(df: DataFrame) -> DataFrame:
    """Rows whose code is neither 5 digits nor 5 digits + one letter (VAL-4)."""
    code = F.col("stock_code").cast("string")
    return df.where(~(full_match(code, S.STOCK_NUMERIC_PATTERN) | full_match(code, S.STOCK_SUFFIX_PATTERN)))


def desc_per_code(df: DataFrame) -> DataFrame:
    """AGG-2: distinct descriptions per stock code (NULL ignored)."""
    return (df.where(F.col("stock_code").isNotNull())
              .groupBy("stock_code").agg(F.countDistinct("description").alias("n_descriptions")))


def special_code_stats(df: DataFrame) -> DataFrame:
    """AGG-2/3/4 on special codes: descriptions, price min/max/mean, missing-customer share."""
    return (special_rows(df).groupBy("stock_code").agg(
        F.countDistinct("description").alias("n_descriptions"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        ratio(F.sum("price"), F.count("price")).alias("mean_price"),
        F.bround(ratio(F.count_if(F.col("customer_id").isNull()), _n()), 3).alias("missing_customer_share"),
    ))


def value_counts(df: DataFrame, col, n: int | None = None, name: str = "value") -> DataFrame:
    """AGG-5: frequency table, count-descending (ties by value), NULL dropped."""
    c = F.col(col) if isinstance(col, str) else col
    out = (df.select(c.alias(name)).where(F.col(name).isNotNull())
             .groupBy(name).agg(_n().alias("n"))
             .orderBy(F.col("n").desc(), F.col(name).asc()))
    return out.limit(n) if n else out


def country_profile(df: DataFrame) -> DataFrame:
    """VAL-6: missing, blank, 'Unspecified' counts and share; distinct countries."""
    c = F.col("country")
    stripped = strip_ws(c.cast("string"))
    return df.agg(
        F.count_if(c.isNull()).alias("missing_country"),
        F.count_if(stripped == "").alias("blank_country"),
        F.count_if(stripped == "Unspecified").alias("unspecified_country"),
        ratio(F.count_if(stripped == "Unspecified"), _n()).alias("unspecified_share"),
        F.countDistinct(c).alias("unique_countries"),
    )


def country_list(df: DataFrame) -> DataFrame:
    """VAL-6 / SET-3 / TOP-4: sorted distinct stripped country names."""
    return (df.where(F.col("country").isNotNull())
              .select(strip_ws(F.col("country").cast("string")).alias("country"))
              .distinct().orderBy("country"))


def missing_profile(df: DataFrame, col: str = "description") -> DataFrame:
    """VAL-7: missing count and share of one column."""
    miss = F.col(col).isNull()
    return df.agg(F.count_if(miss).alias("missing_count"), ratio(F.count_if(miss), _n()).alias("missing_share"))


def shape_profile(df: DataFrame) -> DataFrame:
    """VAL-8: rows and columns (column count is plan metadata)."""
    return df.agg(_n().alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def column_profile(df: DataFrame) -> DataFrame:
    """VAL-8: position, name, type and number of present values of every column, from one aggregate."""
    counts = df.agg(_n().alias("n_rows"), F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.count(F.col(f"`{f.name}`")).alias("non_null")) for i, f in enumerate(df.schema.fields)]).alias("c"))
    return counts.select("n_rows", F.inline("c")).select("position", "name", "type", "non_null", "n_rows")


# ----------------------------------------------------------------------------- FLT
def split_candidates(df: DataFrame) -> DataFrame:
    """FLT-1: returns / free / admin counts, shares and pairwise overlaps."""
    ret, free, admin = F.col("quantity") < 0, F.col("price") == 0, starts("invoice_no", "A")
    ret, free = F.coalesce(ret, F.lit(False)), F.coalesce(free, F.lit(False))
    return df.agg(
        F.count_if(ret).alias("returns"), ratio(F.count_if(ret), _n()).alias("returns_share"),
        F.count_if(free).alias("free"), ratio(F.count_if(free), _n()).alias("free_share"),
        F.count_if(admin).alias("admin"), ratio(F.count_if(admin), _n()).alias("admin_share"),
        F.count_if(ret & free).alias("return_and_free"),
        F.count_if(ret & admin).alias("return_and_admin"),
        F.count_if(free & admin).alias("free_and_admin"),
    )


#: The cross tables of the EDA: name -> its two columns.
EDA_TABLES = {"prefix_x_return": ("prefix", "ret"), "prefix_x_free": ("prefix", "free"), "special_x_return": ("special", "ret"),
              "special_x_free": ("special", "free"), "prefix_x_special": ("prefix", "special")}


def crosstabs(df: DataFrame, columns: dict[str, F.Column], tables: dict[str, tuple[str, str]]) -> DataFrame:
    """AGG-6: two-way tables in long form DF[table, a, b, n] (values as text), all from one scan.

    Rows are counted once by all columns; the tables are the grouping sets of those counts."""
    names = list(columns)
    counted = (df.select(*[c.cast("string").alias(f"_{name}") for name, c in columns.items()])
               .groupBy(*[f"_{name}" for name in names]).agg(_n().alias("_rows")))
    sets = [[F.col(f"_{x}") for x in pair] for pair in tables.values()]
    out = counted.groupingSets(sets, *[F.col(f"_{name}") for name in names]).agg(F.sum("_rows").alias("n"), F.grouping_id().alias("_set"))
    # a column's bit is set where the grouping set leaves it out, the first column's bit highest
    code = {t: sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in pair) for t, pair in tables.items()}

    def pick(of) -> F.Column:
        expr = None
        for t, pair in tables.items():
            hit = F.col("_set") == code[t]
            expr = F.when(hit, of(t, pair)) if expr is None else expr.when(hit, of(t, pair))
        return expr

    return out.select(pick(lambda t, _: F.lit(t)).alias("table"), pick(lambda _, p: F.col(f"_{p[0]}")).alias("a"),
                      pick(lambda _, p: F.col(f"_{p[1]}")).alias("b"), "n")


def eda_crosstabs(df: DataFrame) -> DataFrame:
    """The five invoice-type / return / free / special cross tables of the EDA."""
    return crosstabs(eda_frame(df), {"prefix": invoice_prefix("invoice_no"), "ret": F.col("quantity") < 0, "free": F.col("price") == 0,
                                     "special": is_special_stock()}, EDA_TABLES)


def invoice_qty_mismatch(df: DataFrame) -> DataFrame:
    """FLT-2: negative quantity on a non-C invoice, and C invoice without one."""
    c, neg = starts("invoice_no", "C"), F.coalesce(F.col("quantity") < 0, F.lit(False))
    return df.agg(F.count_if(neg & ~c).alias("negative_not_c"), F.count_if(c & ~neg).alias("c_not_negative"))


def mismatch_examples(df: DataFrame, n: int = 20) -> DataFrame:
    """FLT-2 / TOP-2: first n rows of each mismatch kind in the total row order.

    One ordered limit per kind (per-partition top n, then a merge of
    partitions x n rows), so the mismatching lines are never gathered in one
    window partition however many there are."""
    c, neg = starts("invoice_no", "C"), F.coalesce(F.col("quantity") < 0, F.lit(False))
    order = [F.col(x).asc_nulls_last() for x in S.RAW_COLUMNS]
    parts = []
    for kind, cond in (("negative_not_c", neg & ~c), ("c_not_negative", c & ~neg)):
        top = df.where(cond).orderBy(*order).limit(n)
        parts.append(top.withColumn("kind", F.lit(kind))
                        .withColumn("rk", F.row_number().over(Window.partitionBy("kind").orderBy(*order))))
    return parts[0].unionByName(parts[1])


def eda_groups(df: DataFrame) -> DataFrame:
    """FLT-3: admin rows dropped; C rows; clean sales; free items -> labelled rows."""
    admin, c = starts("invoice_no", "A"), starts("invoice_no", "C")
    q, p = F.col("quantity"), F.col("price")
    return df.withColumn("eda_group", F.when(admin, F.lit(None))
                                   .when(c, "c_invoice_rows")
                                   .when((q > 0) & (p > 0), "clean_sales")
                                   .when((q > 0) & (p == 0), "free_items"))


def group_top_codes(df: DataFrame, n: int = 10) -> DataFrame:
    """FLT-3 + AGG-5: top n stock codes per EDA group (ties by code)."""
    g = eda_groups(eda_frame(df)).where(F.col("eda_group").isNotNull())
    counts = g.groupBy("eda_group", "stock_code").agg(_n().alias("n"))
    w = Window.partitionBy("eda_group").orderBy(F.col("n").desc(), F.col("stock_code").asc())
    return counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)


def zero_price_subtypes(df: DataFrame) -> DataFrame:
    """FLT-4: zero-price rows with positive / negative quantity, not A/C."""
    not_ac = ~starts("invoice_no", "C") & ~starts("invoice_no", "A")
    zero = F.col("price") == 0
    return df.agg(F.count_if(not_ac & (F.col("quantity") > 0) & zero).alias("zero_price_positive_qty"),
                  F.count_if(not_ac & (F.col("quantity") < 0) & zero).alias("zero_price_negative_qty"))


# ----------------------------------------------------------------------------- AGG-8..14
def family_profile(df: DataFrame, families=("DCGS", "GIFT")) -> DataFrame:
    """AGG-8: per code family one long table DF[family, section, key, n].

    One scan: each row is stacked into its (section, key) cells, then a single
    group-by counts every cell; top-n sections are cut by rank afterwards.
    """
    e = eda_frame(df)
    fam = F.when(icontains("stock_code", S.DCGS_TOKEN), F.array(F.lit("DCGS"))).otherwise(F.array())
    fam = F.concat(fam, F.when(icontains("stock_code", S.GIFT_TOKEN), F.array(F.lit("GIFT"))).otherwise(F.array()))
    qb, pb = sign_bucket("quantity"), sign_bucket("price")
    def cell(section, key):
        return F.struct(F.lit(section).alias("section"), key.alias("key")).cast("struct<section:string,key:string>")

    cells = F.array(
        cell("rows", F.lit("all")),
        cell("invoice_type", invoice_prefix("invoice_no")),
        cell("quantity_bucket", qb),
        cell("price_bucket", pb),
        cell("quantity_x_price", F.when(qb.isNotNull() & pb.isNotNull(), F.concat_ws(" | ", qb, pb))),
        cell("customer", F.when(F.col("customer_id").isNotNull(), "present").otherwise("missing")),
        cell("country", F.col("country")),
        cell("stock_code", F.col("stock_code")),
        cell("description", F.col("description")),
    )
    stacked = (e.select(F.explode(fam).alias("family"), F.explode(cells).alias("cell"))
                .select("family", "cell.section", "cell.key")
                .where(F.col("key").isNotNull() & F.col("family").isin(list(families))))
    counts = stacked.groupBy("family", "section", "key").agg(_n().alias("n"))
    limits = {"country": 10, "stock_code": 20, "description": 20}
    w = Window.partitionBy("family", "section").orderBy(F.col("n").desc(), F.col("key").asc())
    limit = F.coalesce(F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
                       [F.col("section")], F.lit(1 << 30))
    top = counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= limit).drop("rk")
    # distinct codes = number of stock_code cells before the top-20 cut
    distinct_codes = (counts.where(F.col("section") == "stock_code").groupBy("family")
                      .agg(F.count(F.lit(1)).alias("n"))
                      .select("family", F.lit("distinct_codes").alias("section"), F.lit("all").alias("key"), "n"))
    return top.unionByName(distinct_codes)


def code_families(df: DataFrame) -> DataFrame:
    """FLT-5: rows, distinct codes and distinct invoices per code family."""
    e = eda_frame(df)
    return e.groupBy(code_family().alias("family")).agg(
        _n().alias("n_rows"), F.countDistinct("stock_code").alias("n_codes"), F.countDistinct("invoice_no").alias("n_invoices"))


def paid_family_checks(df: DataFrame) -> DataFrame:
    """AGG-9: description presence on paid gift/DCGS rows, ebay/update, zero-price DCGS."""
    e = eda_frame(df)
    paid = (F.col("quantity") > 0) & (F.col("price") > 0)
    gift, dcgs = icontains("stock_code", S.GIFT_TOKEN), icontains("stock_code", S.DCGS_TOKEN)
    blank = F.col("description").isNull() | (strip_ws("description") == "")
    return e.agg(
        F.count_if(gift & paid).alias("gift_paid_rows"),
        F.count_if(gift & paid & blank).alias("gift_paid_blank_description"),
        F.count_if(dcgs & paid).alias("dcgs_paid_rows"),
        F.count_if(dcgs & paid & blank).alias("dcgs_paid_blank_description"),
        F.count_if(dcgs & paid & F.coalesce(F.lower("description").isin("ebay", "update"), F.lit(False)))
         .alias("dcgs_paid_ebay_update"),
        F.count_if(dcgs & (F.col("quantity") > 0) & (F.col("price") == 0)).alias("dcgs_zero_price_positive_qty"),
    )


def sample_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """TOP-3: deterministic seeded sample of n rows (order by a hash of row+seed)."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("<null>"))
                                                     for c in df.columns]))
    return df.withColumn("_h", key).orderBy("_h", *df.columns).limit(n).drop("_h")


def describe(df: DataFrame, cols) -> DataFrame:
    """AGG-7: count, mean, sample std, min, linear quartiles, max per column: one aggregate over all columns, and
    the quartiles by rank."""
    cols, stats = list(cols), []
    for c in cols:
        x = F.col(c).cast("double")
        stats.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.round(F.avg(x), 6).alias("mean"),
                              F.round(F.stddev_samp(x), 6).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")))
    plain = df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    at = lambda p: F.round(F.max(F.when(F.col("p") == p, F.col("value"))), 6)
    ranks = quantiles(df, cols, (0.25, 0.5, 0.75)).groupBy("column").agg(
        at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    return plain.join(ranks, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def dcgs_paid(df: DataFrame) -> DataFrame:
    e = eda_frame(df)
    return e.where(icontains("stock_code", S.DCGS_TOKEN) & (F.col("quantity") > 0) & (F.col("price") > 0))


def shared_descriptions(df: DataFrame) -> DataFrame:
    """SET-2: descriptions of paid DCGS rows that also occur on paid normal rows
    (NULL counts as a value, as in a set intersection)."""
    e = eda_frame(df)
    paid = (F.col("quantity") > 0) & (F.col("price") > 0)
    dcgs = icontains("stock_code", S.DCGS_TOKEN)
    return (e.where(dcgs & paid).select("description")
              .intersect(e.where(~dcgs & paid).select("description")))


def special_code_summary(df: DataFrame, n: int = 20) -> DataFrame:
    """AGG-10 / UDF-2: per non-DCGS/gift special code: rows, distinct and most
    common description (mode ties by text), top n codes by rows."""
    e = eda_frame(df)
    sub = e.where(is_special_stock() & ~icontains("stock_code", S.DCGS_TOKEN)
                  & ~icontains("stock_code", S.GIFT_TOKEN))
    per_desc = (sub.where(F.col("description").isNotNull())
                   .groupBy("stock_code", "description").agg(_n().alias("dn")))
    mode = (per_desc.groupBy("stock_code")
                    .agg(F.min(F.struct((-F.col("dn")).alias("k"), F.col("description").alias("d")))
                         .getField("d").alias("top_description"),
                         F.count(F.lit(1)).alias("unique_descriptions")))
    counts = sub.groupBy("stock_code").agg(_n().alias("count"))
    out = (counts.join(mode, "stock_code", "left")
                 .select("stock_code", "count", F.coalesce("unique_descriptions", F.lit(0)).alias("unique_descriptions"),
                         "top_description"))
    return out.orderBy(F.col("count").desc(), F.col("stock_code").asc()).limit(n)


def descriptions_by_code(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """AGG-11: DF[stock_code, description, lines], a row per distinct description of a code: however many a code has,
    no row grows with them."""
    e = eda_frame(df)
    sub = e.where(is_special_stock() & ~icontains("stock_code", S.DCGS_TOKEN)
                  & ~icontains("stock_code", S.GIFT_TOKEN) & F.col("description").isNotNull())
    if codes is not None:
        sub = sub.join(codes.select("stock_code"), "stock_code", "left_semi")
    return sub.groupBy("stock_code", "description").agg(_n().alias("lines"))


def code_customer_presence(df: DataFrame, code: str = "DOT") -> DataFrame:
    """AGG-12: one code's rows with / without a customer id."""
    e = eda_frame(df).where(F.col("stock_code") == code)
    miss = F.col("customer_id").isNull()
    return e.agg(_n().alias("rows"), F.count_if(~miss).alias("with_customer"),
                 F.count_if(miss).alias("without_customer"), ratio(F.count_if(miss), _n()).alias("missing_rate"))


def exclusion_breakdown(df: DataFrame) -> DataFrame:
    """AGG-13: why non-DCGS/gift special rows leave the clean sales."""
    e = eda_frame(df)
    sub = e.where(is_special_stock() & ~icontains("stock_code", S.DCGS_TOKEN)
                  & ~icontains("stock_code", S.GIFT_TOKEN))
    c, a = starts("invoice_no", "C"), starts("invoice_no", "A")
    pq, pp = F.col("quantity") > 0, F.col("price") > 0
    return sub.agg(_n().alias("total"), F.count_if(c).alias("cancellations"), F.count_if(a).alias("admin"),
                   F.count_if(~pq).alias("quantity_le_0"), F.count_if(~pp).alias("price_le_0"),
                   F.count_if(~c & ~a & pq & pp).alias("clean_like"))


def shipping_invoice_share(df: DataFrame) -> DataFrame:
    """AGG-14: distinct POST/DOT invoices vs distinct clean-sale invoices."""
    e = eda_frame(df)
    special = is_special_stock() & ~icontains("stock_code", S.DCGS_TOKEN) & ~icontains("stock_code", S.GIFT_TOKEN)
    post_dot = special & F.col("stock_code").isin("POST", "DOT")
    clean = (~starts("invoice_no", "A") & ~starts("invoice_no", "C")
             & (F.col("quantity") > 0) & (F.col("price") > 0))
    a = F.countDistinct(F.when(post_dot, F.col("invoice_no")))
    b = F.countDistinct(F.when(clean, F.col("invoice_no")))
    return e.agg(a.alias("post_dot_invoices"), b.alias("clean_sales_invoices"),
                 ratio(a, b).alias("post_dot_share"))
