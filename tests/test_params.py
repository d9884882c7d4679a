import pytest

from orderlens.params import DEFAULT_VIEW_FILTERS, BatchParams, ReportParams


def test_defaults():
    assert len(BatchParams().entity_ids) == 8
    assert ReportParams() == ReportParams(0.02, 5000)
    assert DEFAULT_VIEW_FILTERS.region == (None, "Asia")


@pytest.mark.parametrize("order_drop", [0.0, 0.02, 0.06, 0.14, 0.16])
def test_allowed_drop(order_drop):
    assert ReportParams(order_drop=order_drop).order_drop == order_drop


@pytest.mark.parametrize("bad", [
    {"order_drop": 0.18}, {"order_drop": -0.02}, {"order_drop": 0.03},
    {"gmv_bin_size": 500}, {"gmv_bin_size": 1500}, {"gmv_bin_size": 11000},
])
def test_refused_report_params(bad):
    with pytest.raises(ValueError):
        ReportParams(**bad)


def test_refused_batch_params():
    with pytest.raises(ValueError):
        BatchParams(entity_ids=[])
    with pytest.raises(ValueError):
        BatchParams(start_date="2022-09-01", end_date="2022-06-01")
