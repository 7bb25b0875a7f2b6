"""Row-type masks (MSK-1..11) as boolean Columns; NULL inputs give false."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .text import icontains, starts


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def mask_columns(invoice="invoice_no", code="stock_code", quantity="quantity", price="price",
                 shipping_codes=S.SHIPPING_CODES, manual_code=S.MANUAL_CODE,
                 other_codes=S.OTHER_SPECIAL_CODES) -> dict[str, Column]:
    """All eleven masks, each built from the raw columns only (no ordering)."""
    inv, stock = F.col(invoice).cast("string"), F.col(code).cast("string")
    qty, prc = F.col(quantity), F.col(price)
    admin = starts(inv, S.ADMIN_PREFIX)
    cancel = starts(inv, S.CANCEL_PREFIX)
    not_ac = ~admin & ~cancel
    adjust = _false_if_null((qty < 0) & (prc == 0)) & not_ac
    free = _false_if_null((qty > 0) & (prc == 0)) & not_ac
    gift = icontains(stock, S.GIFT_TOKEN)
    dcgs = icontains(stock, S.DCGS_TOKEN)
    shipping = _false_if_null(stock.isin(list(shipping_codes)))
    manual = _false_if_null(stock == manual_code)
    other = _false_if_null(stock.isin(list(other_codes)))
    excluded = admin | cancel | adjust | free | gift | dcgs | shipping | other
    return {
        "is_admin_invoice": admin,
        "is_cancellation_invoice": cancel,
        "is_inventory_adjustment": adjust,
        "is_free_item": free,
        "is_gift_voucher": gift,
        "is_dcgs": dcgs,
        "is_shipping_fee": shipping,
        "is_manual": manual,
        "is_other_special_code": other,
        "is_manual_product_like_sale": manual & ~excluded,
        "is_clean_product_sale_candidate": _false_if_null((qty > 0) & (prc > 0)) & ~excluded & ~manual,
    }
