"""Spark vs DuckDB on the smallest driver folder for every query with an oracle."""
import os

import pytest

from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_all_oracles_match_at_sf0001(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(SF)
    bad = []
    for name, sql in sqls.items():
        r = compare(spark, SF, name, qs[name], sql, con)
        if r["status"] != "match":
            bad.append(r)
    assert not bad, bad


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_rules_of_several_items_occur(spark):
    import __spark_entry__ as E
    lengths = {r["length"] for name in ("rule_lengths", "category_rule_lengths") for r in E.queries()[name](spark, SF).collect()}
    assert {2, 3, 4} <= lengths
