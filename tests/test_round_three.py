"""Cases where an operator did less than its whole job."""

import os

import pytest
from conftest import rows_of
from test_round_two import SF, four_files  # noqa: F401

from tidemark.plans import streams
from tidemark.sources.tables import stream_table


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name", ["stream_tx_reconcile", "stream_order_pay"])
def test_one_sided_rows_do_not_depend_on_the_cut_into_batches(spark, monkeypatch, four_files, name):  # noqa: F811
    whole = streams.QUERIES[name](spark, SF)
    monkeypatch.setattr(streams, "stream_table", lambda s, folder, table: stream_table(s, folder, table, files_per_batch=1))
    cut = streams.QUERIES[name](spark, four_files)
    assert rows_of(cut) == rows_of(whole) and whole.count() > 0
