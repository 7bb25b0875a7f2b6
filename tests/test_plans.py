"""Plan shape guards: the properties PLANS.md / README claim."""
import io
import os
from contextlib import redirect_stdout

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_code_map_is_broadcast_to_the_fact_rows(spark):
    from tillroll.plans.stages import build_cleaned, raw_lines
    plan = _plan(build_cleaned(raw_lines(spark, SF)))
    assert "BroadcastHashJoin LeftOuter" in plan
    # only the (stock_code, description) columns are read for the map
    assert "ReadSchema: struct<stock_code:string,description:string>" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_clean_sales_filter_reaches_the_scan(spark):
    from tillroll.operators.segments import customer_lines
    from tillroll.plans.stages import clean_sales
    plan = _plan(customer_lines(clean_sales(spark, SF)))
    assert "EqualTo(is_clean_product_sale_candidate,true)" in plan
    assert "is_dcgs" not in plan.split("ReadSchema:")[1].split("\n")[0]   # pruned column


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_code_map_needs_no_window(spark):
    from tillroll.operators.clean import code_description_map
    from tillroll.plans.stages import raw_lines
    assert "Window" not in _plan(code_description_map(raw_lines(spark, SF)))
