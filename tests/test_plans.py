"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest

from dayledger import queries
from dayledger.operators.cleaning import clean, with_lineage
from dayledger.operators.splits import exact_sample, hash_split
from dayledger.plans.cycle import Store
from dayledger.sources import read_raw, training_set

# Training and the stream act while they are built; the others only describe a plan.
BUILDS_MODEL = {"rf_grid_search", "rf_predict", "rf_run_log", "rf_promotion"}
BANNED = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas")


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - BUILDS_MODEL))
def test_no_python_rows_and_no_cross_join(spark, sf_dir, key):
    text = plan(queries.QUERIES[key](spark, sf_dir))
    assert not [node for node in BANNED if node in text]


def test_cleaning_has_no_shuffle_and_pushes_filters(spark, sf_dir):
    rows = with_lineage(clean(read_raw(spark, queries.landing(spark, sf_dir))), "run")
    text = plan(rows)
    assert "Exchange" not in text
    for pushed in ("IsNotNull(tx_datetime)", "GreaterThan(tx_amount,0.0)", "GreaterThan(customer_id,0)"):
        assert pushed in text


def test_splits_do_not_shuffle_rows(spark, sf_dir):
    rows = queries.clean_tx(spark, sf_dir)
    assert all("Exchange" not in plan(part) for part in hash_split(rows, queries.KEY))
    sampled = plan(exact_sample(rows, queries.KEY))
    outer = sampled.split("Subquery")[0]
    assert "Exchange" not in outer and "Window" not in outer


def test_counts_read_only_their_columns(spark, sf_dir):
    text = plan(queries.QUERIES["clean_counts_per_day"](spark, sf_dir))
    assert "props" not in text and "event_type" not in text


def test_judged_documents_do_not_read_texts(spark, sf_dir):
    assert "text" not in plan(queries.judged_documents(spark, sf_dir)).replace("context", "")


def test_training_window_lists_its_days_only_and_pushes_the_label(spark, sf_dir):
    store: Store = queries.cleaned(spark, sf_dir)
    rows = training_set(spark, store.history, 5, store.ledger(spark))
    days = {f.split("src_date=")[1][:10] for f in rows.inputFiles()}
    assert days == {"2024-01-26", "2024-01-27", "2024-01-28", "2024-01-29", "2024-01-30"}
    assert "IsNotNull(tx_fraud)" in plan(rows)
