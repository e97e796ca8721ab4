"""What has to grow with the input, or must not: files of messages, pieces of hot cards, parsing of messages."""

import pandas as pd
import pytest
import tables as t
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from cardledger import catalog, roles, schemas
from cardledger.operators import checks, hot as hot_keys
from cardledger.operators.running import n_ranges
from cardledger.plans import authorize as authorize_plan, whole_run
from cardledger.plans.authorize import authorize
from cardledger.plans.whole_run import run_all
from cardledger.sources import files, messages, scratch, tables
from cardledger.streaming import speed
from cardledger.streaming.table_state import SpeedLayer


def test_scattered_messages_lie_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """With two files whatever the size, one task reads half of all messages."""
    c, u, x = t.random_tables(41, 200)
    path = str(tmp_path / "in")
    messages.save_messages(t.transactions(spark, x), path)
    monkeypatch.setattr(catalog, "STREAM_FILE_ROWS", 20)
    seen = []
    stream = catalog._scattered(spark, path).writeStream.foreachBatch(
        lambda batch, number: seen.extend(
            (number, r["n"]) for r in batch.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()
        )
    )
    stream.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert sum(n for _, n in seen) == 200 and max(n for _, n in seen) <= 40
    assert {number for number, _ in seen} == {0, 1}


@pytest.mark.parametrize("running_limit", [False, True])
def test_pieces_of_hot_cards_are_bounded(spark, monkeypatch, running_limit):
    """pieces of `hot_rows` rows each are as many as the rows, where `hot_rows` is small."""
    monkeypatch.setattr(hot_keys, "PIECES", 4)
    c, u, x = t.random_tables(42, 300)
    for row in x[::2]:
        row["card_id"] = c[0]["card_id"]
    tx = t.transactions(spark, x)
    found = hot_keys.find_hot(tx, "card_id", 5)
    assert n_ranges(found) <= 8
    got = authorize(tx, t.cards(spark, c), t.customers(spark, u), running_limit, hot_rows=5)
    assert t.results(got) == t.model(c, u, x, running_limit)


def test_pieces_grow_beyond_hot_rows_only_where_there_are_many(spark):
    many = spark.createDataFrame([(1, 72_000_000, 2500)], "_hot_key long, _n long, _over long")
    few = spark.createDataFrame([(1, 20_000, 2500)], "_hot_key long, _n long, _over long")
    huge = spark.createDataFrame([(1, 10**12, 2_000_000)], "_hot_key long, _n long, _over long")
    assert hot_keys.piece_rows(many) == (72_000_000, 281_250) and n_ranges(many) == 512
    assert hot_keys.piece_rows(few) == (20_000, 2500)
    assert hot_keys.piece_rows(huge) == (10**12, 2_000_000)


def test_a_message_is_parsed_once(spark):
    """a filter on decoded fields parsed the message again for each mention of one."""
    sent = spark.createDataFrame([('{"transaction_id": 1}',), (None,), ("junk",)], "value string")
    decoded = messages.from_messages(sent)
    fit = decoded.filter(checks.unfit_cause().isNull())
    plan = fit._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert [r["transaction_id"] for r in decoded.collect()] == [1, None, None]


def test_verdicts_on_their_own_in_arrays_equal_the_fold():
    rows = pd.DataFrame(
        {
            "_card": [1, 1, 1, 2, 5],
            "transaction_id": [7, 3, 9, 4, 1],
            "amount_micros": [5, 9, 2, -3, 4],
            "_room": [6, 9, 20, 1, 5],
            "_open": [True, True, True, True, False],
        }
    )
    balance, first = {1: 100, 8: 1}, {1: 5, 8: 2}
    after, failed = speed._each_alone(rows, [0, 3, 4, 5], balance, first)
    assert after.tolist() == [105, 105, 107, -3, 0]
    assert failed.tolist() == [False, True, False, False, False]
    assert balance == {1: 107, 8: 1, 2: -3, 5: 0} and first == {1: 3, 8: 2, 2: 4, 5: 1}
    assert speed._sums_fit(rows["amount_micros"].to_numpy(), [])
    assert not speed._sums_fit(rows["amount_micros"].to_numpy(), [-9 * 10**18])


def test_tables_read_again_are_compressed(spark):
    """As Spark's default has them, they were a third larger."""
    rows = spark.range(5)
    path = scratch.saved(rows, "rows").inputFiles()
    assert path and all(p.endswith(".zstd.parquet") for p in path)


def test_move_folder(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "in" / "b")
    spark.range(3).write.parquet(a)
    files.move_folder(spark, a, b)
    assert spark.read.parquet(b).count() == 3 and not files.exists(spark, a)
    files.move_folder(spark, a, f"{b}2")  # there is none any more
    assert files.names(spark, f"{b}2") == []
    with pytest.raises(FileExistsError):
        files.move_folder(spark, b, f"{b}2")


@pytest.fixture
def moved(monkeypatch):
    """The DataFrames that are sorted and dealt by ranges, by the columns they are dealt by."""
    found = []
    for name in ("orderBy", "repartitionByRange"):
        plain = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, *c, plain=plain: found.append(c[-1]) or plain(self, *c))
    return found


def test_results_of_transactions_are_sorted_once_and_compressed(spark, tmp_path, moved):
    """two sorts and two sets of plain files."""
    c, u, x = t.random_tables(43, 60)
    store = tables.ParquetStore(spark, str(tmp_path / "store"))
    for name, df in (("cards", t.cards(spark, c)), ("customers", t.customers(spark, u)), ("transactions", t.transactions(spark, x))):
        store.write(df, name)
    store.write(spark.createDataFrame([], schemas.TABLES["credit_card_types"][0]), "credit_card_types")
    results = tmp_path / "results"
    run_all(store, str(results))
    assert sum(by == "transaction_id" for by in moved if isinstance(by, str)) == 1
    model = t.model(c, u, x, False)
    for name, approved in (("stream_transactions", False), ("batch_transactions", True)):
        parts = sorted(p.name for p in (results / name).glob("part-*"))
        assert parts and all(p.endswith(".csv.gz") for p in parts) and (results / name / "_SUCCESS").exists()
        got = tables.read_typed_csv(spark, str(results / name), schemas.STREAM_TRANSACTIONS).collect()
        want = {i: "approved" if approved and s == "pending" else s for i, (s, _, _) in model.items()}
        assert len(got) == len(want) and {r["transaction_id"]: r["status"] for r in got} == want
        report = tables.sorted_report(spark, str(results / name), schemas.STREAM_TRANSACTIONS, "transaction_id").first()
        assert (report["n_rows"], report["n_misplaced"]) == (len(x), 0)
    assert sorted(p.name for p in results.iterdir()) == sorted(
        ["stream_transactions", "batch_transactions", "cards_updated", "customers_updated", "transactions_aside"]
    )


def test_sorted_results_of_no_rows_are_a_header(spark, tmp_path):
    path = tmp_path / "out"
    rows = spark.createDataFrame([], "id long, name string")
    tables.save_sorted(rows, "id", str(path), {"a": {}, "b": {"name": F.lit("x")}})
    assert [p.read_text() for p in (path / "b").glob("part-*")] == ["id,name\n"]
    full = spark.createDataFrame([(2, "y"), (None, "z"), (1, None)], "id long, name string")
    tables.save_sorted(full, "id", str(path), {"a": {}, "b": {"name": F.lit("x")}}, single_file=True)
    assert [p.read_text() for p in (path / "a").glob("part-*")] == ["id,name\n,z\n1,\n2,y\n"]
    assert [p.read_text() for p in (path / "b").glob("part-*")] == ["id,name\n,x\n1,x\n2,x\n"]


def test_first_copies_are_not_stored_where_they_are_read_once(spark, monkeypatch):
    """every transaction was written once more between the choice of first copies and the checks."""
    c, u, x = t.random_tables(44, 60)
    stored, plain = [], whole_run.saved
    monkeypatch.setattr(whole_run, "saved", lambda df, name: stored.append(name) or plain(df, name))
    frames = {"cards": t.cards(spark, c), "customers": t.customers(spark, u), "transactions": t.transactions(spark, x + x[:9])}
    run = whole_run.run_tables(frames, dedupe=True)
    assert stored == ["checked"]
    want = {i: status for i, (status, _, _) in t.model(c, u, x, False).items()}
    assert {r["transaction_id"]: r["status"] for r in run.stream.collect()} == want and run.stream.count() == len(x)


def test_checked_columns_travel_once(spark):
    """what the checks make of a column was shuffled beside the column itself."""
    c, u, x = t.random_tables(45, 40)
    rows = authorize_plan.checked_whole(t.transactions(spark, x), t.cards(spark, c).hint("merge"), t.customers(spark, u))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line and "card_id" in line)
    below = "\n".join(plan.splitlines()[join:])
    assert "merchant_zip" not in below and "arrival_day" not in below


def test_a_resent_refund_is_made_beside_the_refund(spark):
    """the transactions were made twice."""
    _, _, x = t.random_tables(46, 30)
    tx = t.transactions(spark, x).withColumn("transaction_type", F.expr("case transaction_id % 3 when 0 then 'refund' when 1 then 'purchase' end"))
    got = roles.with_resent_refunds(tx)
    again = tx.filter("transaction_type = 'refund'").withColumns(
        {"timestamp": F.col("timestamp") + F.expr("interval 1 day"), "amount": F.col("amount") - 1}
    )
    assert got.columns == tx.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, tx.unionByName(again).collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0


def test_whole_messages_are_not_joined_by_the_message_before(spark, tmp_path):
    """All columns of all messages were shuffled twice to tell which of them wait."""
    sent = [("1", 2, 1), ("1", 3, 2), ("1", 5, 4), ("1", 6, 5), ("2", 1, 0), ("2", 2, 1), (None, 1, 7), ("3", None, 9), ("3", 4, 0), ("4", 8, None)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSACTIONS.fields)
    rows = spark.createDataFrame([(None,) * len(schemas.TRANSACTIONS) + s for s in sent], f"{fields}, key string, arrival long, previous long")
    layer = SpeedLayer(spark, str(tmp_path / "speed"), rows.limit(0))
    rows.write.parquet(f"{layer.root}/incoming/batch=0")
    pool = layer._pool(0, len(sent))
    ready = {(r["key"], r["arrival"]) for r in pool.collect() if r["ready"]}
    assert pool.count() == len(sent)
    assert ready == {("2", 1), ("2", 2), (None, 1), ("4", 8)}  # 1 has not come; card 3 waits from its first on
    plan = pool._jdf.queryExecution().optimizedPlan().toString().splitlines()
    anti = next(i for i, line in enumerate(plan) if "LeftAnti" in line)
    assert not any("merchant_name" in line for line in plan[anti:] if "Relation" not in line)


@pytest.mark.parametrize("name", ["stream_counts", "stream_table", "stream_hot_card", "stream_merged", "stream_restarted"])
def test_transactions_of_a_stream_are_made_once(spark, monkeypatch, name):
    """Each reader of the transactions numbered them again."""
    c, u, x = t.random_tables(47, 10)
    for role, rows in (("transactions", t.transactions(spark, x)), ("cards", t.cards(spark, c)), ("customers", t.customers(spark, u))):
        monkeypatch.setattr(roles, role, lambda *a, rows=rows: rows)
    made, plain = [], catalog.saved
    monkeypatch.setattr(catalog, "saved", lambda df, name: made.append(name) or plain(df, name))
    monkeypatch.setattr(catalog, "_send", lambda *a: made.append("sent") or 1 / 0)
    monkeypatch.setattr(messages, "save_messages", lambda *a, **k: made.append("sent") or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        catalog.QUERIES[name](spark, "")
    assert "transactions" in made[: made.index("sent")]
