"""DuckDB SQL for the correctness oracle.

Written independently of the Spark plans and in the plain sequential order of
the analysed workflow (trim, fill, noise flag, canonical map, apply, masks), so
a Spark-side shortcut (e.g. the single per-code map) is checked against the
straightforward formulation. ``sql(body, *ctes)`` prepends the needed CTEs.
"""

from __future__ import annotations

from .. import schema as S
from ..functions.text import STRIP_PATTERN
from ..sources.fixtures import RETAIL_LINES_SQL


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qlist(values) -> str:
    return ", ".join(q(v) for v in values)


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {q(STRIP_PATTERN)}, '', 'g')"


def noise(expr: str) -> str:
    low = f"lower({strip(expr)})"
    return f"COALESCE({low} IN ({qlist(S.NOISE_WORDS)}) OR contains({low}, '?'), false)"


def starts(expr: str, prefix: str) -> str:
    return f"COALESCE(starts_with(CAST({expr} AS VARCHAR), {q(prefix)}), false)"


def icontains(expr: str, token: str) -> str:
    return f"COALESCE(contains(lower(CAST({expr} AS VARCHAR)), {q(token.lower())}), false)"


_MASKS = f"""
  SELECT *,
    {starts('invoice_no', 'A')} AS is_admin_invoice,
    {starts('invoice_no', 'C')} AS is_cancellation_invoice,
    COALESCE(quantity < 0 AND price = 0, false) AND NOT {starts('invoice_no', 'A')}
      AND NOT {starts('invoice_no', 'C')} AS is_inventory_adjustment,
    COALESCE(quantity > 0 AND price = 0, false) AND NOT {starts('invoice_no', 'A')}
      AND NOT {starts('invoice_no', 'C')} AS is_free_item,
    {icontains('stock_code', S.GIFT_TOKEN)} AS is_gift_voucher,
    {icontains('stock_code', S.DCGS_TOKEN)} AS is_dcgs,
    COALESCE(stock_code IN ({qlist(S.SHIPPING_CODES)}), false) AS is_shipping_fee,
    COALESCE(stock_code = {q(S.MANUAL_CODE)}, false) AS is_manual,
    COALESCE(stock_code IN ({qlist(S.OTHER_SPECIAL_CODES)}), false) AS is_other_special_code
  FROM described
"""

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw": (RETAIL_LINES_SQL, ()),
    "trimmed": (f"""
  SELECT invoice_no, stock_code, NULLIF({strip('description')}, '') AS description, quantity,
         invoice_date, price, customer_id, country
  FROM raw""", ("raw",)),
    "fill_map": ("""
  SELECT stock_code, min(description) AS fill_description
  FROM trimmed
  WHERE stock_code IS NOT NULL AND description IS NOT NULL
  GROUP BY stock_code
  HAVING count(DISTINCT description) = 1""", ("trimmed",)),
    "filled": ("""
  SELECT t.invoice_no, t.stock_code, COALESCE(t.description, f.fill_description) AS description,
         t.quantity, t.invoice_date, t.price, t.customer_id, t.country,
         (t.description IS NULL AND f.fill_description IS NOT NULL) AS description_filled
  FROM trimmed t LEFT JOIN fill_map f ON t.stock_code = f.stock_code""", ("fill_map",)),
    "noised": (f"""
  SELECT *, {noise('description')} AS is_noise_description FROM filled""", ("filled",)),
    "canon_freq": ("""
  SELECT stock_code, description, count(*) AS description_count
  FROM noised
  WHERE stock_code IS NOT NULL AND description IS NOT NULL AND NOT is_noise_description
  GROUP BY stock_code, description""", ("noised",)),
    "canon_map": ("""
  SELECT stock_code, canonical_description, description_count, num_valid_descriptions FROM (
    SELECT stock_code, description AS canonical_description, description_count,
           count(*) OVER (PARTITION BY stock_code) AS num_valid_descriptions,
           row_number() OVER (PARTITION BY stock_code
                              ORDER BY description_count DESC, description ASC) AS rk
    FROM canon_freq) z
  WHERE rk = 1""", ("canon_freq",)),
    "described": (f"""
  SELECT n.invoice_no, n.stock_code,
         CASE WHEN c.canonical_description IS NOT NULL THEN c.canonical_description
              ELSE n.description END AS description,
         n.quantity, n.invoice_date, n.price, n.customer_id, n.country,
         n.description_filled, n.is_noise_description,
         n.description AS description_original,
         c.canonical_description,
         c.canonical_description IS NOT NULL AS description_in_standardization_map,
         COALESCE(c.canonical_description IS NOT NULL
                  AND (n.description IS NULL OR n.description <> c.canonical_description), false)
           AS description_standardized,
         CASE WHEN c.canonical_description IS NULL THEN NULL
              WHEN n.description IS NULL THEN {q(S.REASON_FILLED)}
              WHEN n.description = c.canonical_description THEN NULL
              WHEN n.is_noise_description THEN {q(S.REASON_NOISE)}
              ELSE {q(S.REASON_VARIANT)} END AS description_standardization_reason
  FROM noised n LEFT JOIN canon_map c ON n.stock_code = c.stock_code""", ("noised", "canon_map")),
    "masked": (_MASKS, ("described",)),
    "cleaned": ("""
  SELECT *,
    is_manual AND NOT (is_admin_invoice OR is_cancellation_invoice OR is_inventory_adjustment
      OR is_free_item OR is_gift_voucher OR is_dcgs OR is_shipping_fee OR is_other_special_code)
      AS is_manual_product_like_sale,
    COALESCE(quantity > 0 AND price > 0, false) AND NOT (is_admin_invoice OR is_cancellation_invoice
      OR is_inventory_adjustment OR is_free_item OR is_gift_voucher OR is_dcgs OR is_shipping_fee
      OR is_manual OR is_other_special_code) AS is_clean_product_sale_candidate
  FROM masked""", ("masked",)),
    "sales": ("SELECT * FROM cleaned WHERE is_clean_product_sale_candidate", ("cleaned",)),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        sql_text, deps = CTES[n]
        for d in deps:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *ctes: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <ctes and their deps>, <extra> <body>``; extra CTEs go last in order."""
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in _order(ctes)]
    parts += [f"{n} AS ({text}\n)" for n, text in (extra or {}).items()]
    head = "WITH RECURSIVE " if any(p.startswith("occ_") for p in parts) else "WITH "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body
