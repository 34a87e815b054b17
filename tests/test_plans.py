"""Plan shape: pushdown, pruning, no Python in the core operators."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tempora.plans.registry import load_all

SF = "/root/testdata/sf0.001"
# parsing, short transforms and small solves have no Spark operator
PYTHON_ALLOWED = {"a5_html_tables", "f12_dct_spectrum_full", "f12_dct_spectrum_full_by", "f17_fit_forecast", "f17_fit_ar",
                  "f17_fit_arma", "f17_arma_one_step", "f17_predict_one_step", "f17_ols_one", "h11_forecast_frame"}
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "PythonUDF", "MapInArrow", "MapInPandas", "PythonMapInArrow",
                "FlatMapGroupsInArrow", "FlatMapGroupsInPandas")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["b4_where_equal"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p
    p = plan(E.queries()["b1_select_columns"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


@pytest.mark.parametrize("name", sorted(set(load_all()) - PYTHON_ALLOWED))
def test_no_python_in_core(spark, name):
    if name in {"h7_correlation_frame", "f15_dct_swc", "f15_dct_swc_unfiltered", "d5_nearest_station", "d5_nearest_k3"}:
        pytest.skip("materialises intermediate results while building the plan")
    p = plan(E.queries()[name](spark, SF))
    assert not [n for n in PYTHON_NODES if n in p]
    assert "CartesianProduct" not in p
