"""Tables stored in buckets: not shuffled again, and read the same by other sessions."""

import pytest
import tables as t

from cardledger.operators.lookup import card_profiles
from cardledger.plans.authorize import enrich
from cardledger.sources import tables
from cardledger.sources.bucketed import read_bucketed, save_bucketed
from cardledger.sources.messages import read_files, save_messages
from cardledger.streaming.table_state import SpeedLayer


@pytest.fixture(autouse=True)
def no_small_tables(conf):
    conf("spark.sql.shuffle.partitions", "3")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def profiles(spark, c, u):
    return card_profiles(t.cards(spark, c), t.customers(spark, u))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_profiles_are_not_shuffled_again(spark, tmp_path):
    c, u, x = t.random_tables(7, 80)
    stored = save_bucketed(profiles(spark, c, u), str(tmp_path / "p"), "card_id")
    joined = enrich(t.transactions(spark, x), stored)
    text = plan(joined)
    assert text.count("Exchange hashpartitioning") == 1  # the transactions
    assert "Bucketed: true" in text
    plain = enrich(t.transactions(spark, x), profiles(spark, c, u)).select(joined.columns)
    assert rows(joined) == rows(plain)


def test_another_session_reads_the_layout(spark, tmp_path):
    c, u, _ = t.random_tables(8, 30)
    path = str(tmp_path / "it's")
    stored = save_bucketed(profiles(spark, c, u), path, "card_id", buckets=5)
    want = rows(stored)
    for found in spark.catalog.listTables():
        if found.name.startswith("bucketed_"):
            spark.sql(f"drop table {found.name}")  # an external table: its files stay
    again = read_bucketed(spark, path)
    assert rows(again) == want
    assert "Exchange" not in plan(again.groupBy("card_id").count())


def test_stream_on_stored_profiles(spark, tmp_path):
    c, u, x = t.random_tables(9, 60)
    path = str(tmp_path / "p")
    save_bucketed(profiles(spark, c, u), path, "card_id")
    layer = SpeedLayer(spark, str(tmp_path / "state"), read_bucketed(spark, path), running_limit=True)
    save_messages(t.transactions(spark, x), str(tmp_path / "in"))
    layer.run(read_files(spark, str(tmp_path / "in"), linked=True), str(tmp_path / "checkpoint"))
    assert t.results(layer.updates()) == t.model(c, u, x, True)


def test_report_on_sorted_files(spark, tmp_path):
    ids = spark.range(50).selectExpr("id", "'a, b' as name")
    schema = ids.schema

    def report(df, name):
        tables.save_csv(df, str(tmp_path / name))
        return [tuple(r) for r in tables.sorted_report(spark, str(tmp_path / name), schema, "id").collect()]

    assert report(ids.repartitionByRange(4, "id").sortWithinPartitions("id"), "sorted") == [(50, 0)]
    assert report(ids.coalesce(1).orderBy(ids["id"].desc()).coalesce(1), "falling") == [(50, 49)]
    assert report(ids.repartition(1).sortWithinPartitions("id").union(ids.coalesce(1)), "twice") == [(100, 1)]
    assert report(ids.limit(0), "empty") == []
