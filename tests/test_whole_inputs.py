from __future__ import annotations

import pytest

from kestrel.sources.fixtures import ADAPTERS
from kestrel.sources.registry import build_adapter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["roster", "state_results_2324", "sbac_archive", "cast_archive", "intervention", "feed_pear_responses",
                                  "ixl_archive", "roster_snapshots"])
def test_input_has_every_row_of_its_table(spark, name):
    adapter = ADAPTERS[name]
    rows = sum(spark.read.parquet(f"{SF}/{b.table}.parquet").count() for b in adapter.branches)
    assert build_adapter(spark, SF, adapter).count() == rows > 0
