"""The plans are the ones we want."""

import os
import re

import pytest
import tables as t
from pyspark.sql import functions as F

from cardledger import catalog, roles
from cardledger.operators import ledger
from cardledger.operators.fold import _fold_pieces
from cardledger.plans.authorize import authorize
from cardledger.sources.scratch import saved

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", [n for n in catalog.QUERIES if not n.startswith(("stream_", "csv_"))]
)
def test_no_query_multiplies_rows_or_uses_one_task(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    if name != "distinct_count":
        assert "SinglePartition" not in text


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(catalog.credit_usage(spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double>", text)
    text = plan(roles.cards(spark, SF_DIR).filter("card_id = 5").select("card_id"))
    assert "EqualTo(o_orderkey,5)" in text


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id as at")
    text = plan(ledger.dedupe_first(df, "k", [F.col("at")]))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .*Partial", text)


def test_latest_is_combined_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id as i", "1.0d as v")
    text = plan(ledger.latest_by_key(df, "k", "i", "v"))
    assert re.search(r"HashAggregate.*max_by[\s\S]*Exchange[\s\S]*HashAggregate.*partial_max_by", text)


def test_running_limit_shuffles_transactions_once(spark, tmp_path):
    path = str(tmp_path / "tx")
    roles.transactions(spark, SF_DIR).write.parquet(path)
    updates = authorize(
        spark.read.parquet(path), roles.cards(spark, SF_DIR), roles.customers(spark, SF_DIR), True
    )
    text = plan(updates)
    # One for the transactions, one for the cards: join, window and fold share the first.
    assert text.count("Exchange hashpartitioning") == 2
    assert re.search(r"MapInArrow[^\n]*\n(?![\s\S]*(Exchange|Sort \[)[\s\S]*Window)", text)
    assert "amount:double" in text and "merchant_name" not in text


def test_batch_goes_over_the_transactions_once(spark):
    # What is planned here goes on from the saved balances, one row per card.
    text = plan(catalog.batch_cards(spark, SF_DIR))
    assert "lineitem" not in text and text.count("Exchange hashpartitioning") <= 6
    # Balances come from the rows as they are checked, not from a join of a table with itself.
    checked = plan(catalog._stream(spark, SF_DIR))
    assert checked.count("lineitem.parquet") == 1 and checked.count("transaction_id") > 0


@pytest.mark.parametrize("running_limit", [False, True])
def test_hot_cards_take_their_own_branch(spark, running_limit):
    c, u, x = t.random_tables(31, 200)
    updates = authorize(
        t.transactions(spark, x), t.cards(spark, c), t.customers(spark, u), running_limit, hot_rows=60
    )
    text = plan(updates)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert re.search(r"BroadcastHashJoin .*LeftAnti", text)
    if not running_limit:
        # The rows of hot cards were written with the number of their range; they are read back here.
        assert re.search(r"hashpartitioning\(card_id\S+, _range\S+, 8\)", text)


def test_later_rounds_read_few_folders(spark):
    rows = spark.range(400).selectExpr(
        "1L as card_id", "id as _chunk", "floor(id / 64) as _folder", "id as arrival_day",
        "1L as amount_micros", "9L as _room", "true as _guard", "true as _open",
    )
    rows = saved(rows, "chunks", "_folder")
    walked = saved(
        spark.sql("select 1L as card_id, 70L as chunk, 0L as start, 0 as settled"), "walk"
    )
    to_fold = walked.filter(F.col("settled") == 0).select("card_id", "chunk", "start")
    text = plan(_fold_pieces(rows, to_fold, ["arrival_day"]))
    assert "dynamicpruning" in text
