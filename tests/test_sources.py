import json

import pytest
import tables as t

from cardledger import schemas
from cardledger.operators.ledger import distinct_count
from cardledger.plans.authorize import authorize
from cardledger.plans.whole_run import run_all
from cardledger.sources import messages, tables
from cardledger.sources.scratch import checkpoint_root, saved, scratch_path


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


TX_CSV = (
    "card_id,transaction_id,merchant_name,timestamp,amount,location,related_transaction_id\r\n"
    '1,10,"Shop, ""A""",2024-01-02 03:04:05,12.50,"Main, NY 10001",  \r\n'
    "1,11,too,few\r\n"
    "\r\n"
    "1,12,Shop,2024-01-02 03:04:05,1.00,NY 10001,10,extra\r\n"
    "2,13,Shop,2024-01-02 03:04:06,-1.00,NY 10001,10\r\n"
)


def test_csv_by_name_without_damaged_lines(spark, tmp_path):
    path = write(tmp_path / "t.csv", TX_CSV)
    rows = tables.read_csv(spark, path, schemas.TRANSACTIONS)
    assert rows.schema == schemas.TRANSACTIONS
    got = {r["transaction_id"]: r for r in rows.collect()}
    assert set(got) == {10, 13}
    assert got[10]["merchant_name"] == 'Shop, "A"' and got[10]["related_transaction_id"] is None
    assert got[10]["transaction_type"] is None and got[10]["amount"] == 12.5
    assert got[13]["related_transaction_id"] == 10 and got[13]["card_id"] == 2
    assert rows.select("transaction_id").count() == 2
    lines = {r["line"] for r in tables.skipped_lines(spark, path, schemas.TRANSACTIONS).collect()}
    assert {line.split(",")[1] for line in lines} == {"11", "12"}


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "c.csv", 'customer_id,address\n1,"Rye\nNY 10580"\n')
    rows = tables.read_csv(spark, path, schemas.CUSTOMERS, multi_line=True)
    assert rows.first()["address"] == "Rye\nNY 10580"


def test_csv_with_unknown_column(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,shoe_size\n1,44\n")
    with pytest.raises(ValueError, match="shoe_size"):
        tables.read_csv(spark, path, schemas.CUSTOMERS)


def test_load_table_replaces_and_counts(spark, tmp_path):
    store = tables.ParquetStore(spark, str(tmp_path / "tables"))
    path = write(tmp_path / "t.csv", TX_CSV)
    for _ in range(2):
        table, skipped = tables.load_table(store, path, "transactions")
        assert (table.count(), skipped) == (2, 2)


def test_load_table_wants_a_primary_key(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,name\n1,a\n1,b\n")
    with pytest.raises(ValueError, match="customer_id"):
        tables.load_table(tables.ParquetStore(spark, str(tmp_path)), path, "customers")


def test_empty_status_survives_csv(spark, tmp_path):
    schema = schemas.STREAM_TRANSACTIONS
    df = t.make(spark, schema, [{"transaction_id": 1, "pending_balance": 0.5, "status": ""}])
    tables.save_csv(df, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    got = tables.read_typed_csv(spark, str(tmp_path / "out"), schema).first()
    assert (got["status"], got["pending_balance"], got["location"]) == ("", 0.5, None)


def test_messages_carry_all_fields(spark):
    rows = t.transactions(spark, [t.tx(1, 12.5, related_transaction_id=7), t.tx(2, -1.0, location=None)])
    sent = messages.to_messages(rows)
    first = json.loads(sent.filter("value like '%\"transaction_id\":1,%'").first()["value"])
    assert first == {
        "transaction_id": 1, "card_id": 1, "merchant_name": None, "timestamp": "2024-01-01 09:30:00",
        "amount": 12.5, "location": "Shop 10001", "transaction_type": "purchase",
        "related_transaction_id": 7,
    }
    assert {r["key"] for r in sent.collect()} == {"1"}
    assert sorted(messages.from_messages(sent).collect()) == sorted(rows.collect())


def test_message_without_a_field(spark):
    df = spark.createDataFrame([('{"transaction_id": 3}',)], "value string")
    got = messages.transaction_info(messages.from_messages(df)).first()
    assert got["txn_id"] == 3 and got["amount"] is None


def test_kafka_options():
    assert messages.kafka_options("h:1", per_trigger=5) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "transactions",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "cards", {"user": "u"}, ("card_id", 1, 99, 4)) == {
        "url": "jdbc:x", "dbtable": "cards", "user": "u", "partitionColumn": "card_id",
        "lowerBound": "1", "upperBound": "99", "numPartitions": "4",
    }


def test_messages_are_numbered_in_replay_order(spark, tmp_path):
    rows = t.transactions(spark, [t.tx(i, 1.0, card_id=i % 3, day=i % 7) for i in range(200)] + [t.tx(None, 1.0)])
    messages.save_messages(rows, str(tmp_path / "m"))
    messages.save_messages(rows.limit(20), str(tmp_path / "m"), wave=1)
    sent = spark.read.parquet(str(tmp_path / "m")).collect()
    assert len(sent) == 221 and len({(r["key"], r["arrival"]) for r in sent}) == 221
    for key in ("0", "1", "2"):
        mine = sorted((r for r in sent if r["key"] == key and r["arrival"] < 1 << 40), key=lambda r: r["arrival"])
        told = [json.loads(r["value"]) for r in mine]
        order = [(m["timestamp"][:10], m["transaction_id"] or -1) for m in told]
        assert order == sorted(order)


def test_ids_and_amounts_as_text(spark):
    value = '{"transaction_id": "batch:18", "card_id": "7", "amount": " 5.0 ", "timestamp": "x"}'
    got = messages.from_messages(spark.createDataFrame([(value,)], "value string")).first()
    assert (got["transaction_id"], got["card_id"], got["amount"], got["timestamp"]) == (18, 7, 5.0, None)


def test_failed_load_keeps_the_old_table(spark, tmp_path):
    store = tables.ParquetStore(spark, str(tmp_path / "tables"))
    good = write(tmp_path / "good.csv", 'customer_id,name,address\n1,"A\nB",\n2,C,D\n')
    table, skipped = tables.load_table(store, good, "customers")
    assert skipped == 0
    assert {(r["name"], r["address"]) for r in table.collect()} == {("A\nB", ""), ("C", "D")}
    bad = write(tmp_path / "bad.csv", "customer_id,name\n1,A\n1,B\n")
    with pytest.raises(ValueError, match="primary key"):
        tables.load_table(store, bad, "customers")
    assert store.read("customers").count() == 2


def test_bad_numbers_in_result_files_are_errors(spark, tmp_path):
    write(tmp_path / "c.csv", "customer_id,name\nmany,A\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_typed_csv(spark, str(tmp_path / "c.csv"), schemas.CUSTOMERS).collect()


def test_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    found = {(r["k"], r["n_rows"]) for r in schemas.duplicate_keys(df, "k").collect()}
    assert found == {(1, 2), (None, 1)}
    assert distinct_count(df, "k").first()["n_distinct"] == 2


def test_scratch_space(spark):
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root) and checkpoint_root(spark) == root
    empty = spark.range(0).selectExpr("id", "id as part")
    assert saved(empty, "empty").count() == 0
    assert sorted(saved(spark.range(9), "nine").toPandas()["id"]) == list(range(9))
    assert saved(spark.range(9).selectExpr("id", "id % 3 as f"), "n", folders="f").count() == 9


@pytest.mark.parametrize("given", [False, True])
@pytest.mark.parametrize("running_limit", [False, True])
def test_whole_run(spark, tmp_path, given, running_limit):
    c, u, x = t.random_tables(11, 200)
    aside = [t.tx(0, None)]
    u[0]["address"] = u[0]["address"].replace(", ", "\n", 1)
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    t.cards(spark, c).write.parquet(f"{root}/cards")
    t.customers(spark, u).write.parquet(f"{root}/customers")
    t.transactions(spark, x + aside).write.parquet(f"{root}/transactions")
    t.make(spark, schemas.CREDIT_CARD_TYPES, [{"card_type_id": 1}]).write.parquet(
        f"{root}/credit_card_types"
    )
    store = tables.ParquetStore(spark, root)
    updates = None
    if given:
        frames = (t.transactions(spark, x), t.cards(spark, c), t.customers(spark, u))
        updates = authorize(*frames, running_limit)
    run = run_all(store, results, running_limit, updates=updates)
    assert run.n_aside == 1 and run.aside.first()["cause"] == "no amount"

    model = t.model(c, u, x, running_limit)
    stream = tables.read_typed_csv(spark, f"{results}/stream_transactions", schemas.STREAM_TRANSACTIONS)
    got = {r["transaction_id"]: (r["status"], t.cents(r["pending_balance"])) for r in stream.collect()}
    assert got.pop(0) == ("", 0)  # never checked
    assert got == {i: (status, cents) for i, (status, _, cents) in model.items()}
    homes = {r["customer_id"]: r["address"] for r in tables.load_all(store)["customers"].collect()}
    assert homes == {r["customer_id"]: r["address"] for r in u}

    latest = {}
    for r in sorted(x, key=lambda r: r["transaction_id"]):
        latest[r["card_id"]] = model[r["transaction_id"]][2]
    published = tables.load_all(store)["cards"]
    balances = {r["card_id"]: t.cents(r["current_balance"]) for r in published.collect()}
    assert balances == {
        k["card_id"]: t.cents(k["current_balance"]) + latest.get(k["card_id"], 0) for k in c
    }
    done = tables.read_typed_csv(spark, f"{results}/batch_transactions", schemas.STREAM_TRANSACTIONS)
    assert {r["status"] for r in done.select("status").collect()} <= {"approved", "declined", ""}
