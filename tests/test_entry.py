"""The driver contract: smoke entry, and every registered query equals its SQL oracle."""

import __spark_entry__ as E
from netbaseline.plans import catalog
from tests.conftest import SF_SMALL
from tools.compare import compare


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "modeling_params_id", "src_id", "src_ip", "protocol", "flow", "up_down", "in_out",
                          "time"]


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(E.oracle_sql())
    assert not missing


def test_queries_match_oracle_small(spark):
    status = compare(spark, SF_SMALL, list(catalog.QUERIES), out=lambda s: None)
    bad = {k: v for k, v in status.items() if v != "OK"}
    assert not bad, bad
