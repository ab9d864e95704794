import json
import os

from ledgerline import cli
from ledgerline.plans.customer_transactions import compare_join_strategies
from ledgerline.plans.orders import run_generated_orders, run_orders_json


def test_generated_orders_job(spark, scratch):
    out = os.path.join(scratch, "daily")
    res = run_generated_orders(spark, 20_000, partitions=6, preview_rows=5, parquet_path=out)
    assert res.rows == 20_000
    assert len(res.partitions) == 6 and sum(r.rows for r in res.partitions) == 20_000
    assert len(res.preview) == 5
    days = [r.trade_date_str for r in res.preview]
    assert days == sorted(days)
    assert spark.read.parquet(out).count() > 0


def test_orders_json_job(spark, scratch):
    docs = [{"security_id": 1, "price": 2.0, "quantity": 3, "timestamp": "2025-05-05T01:00:00.000000Z"},
            {"security_id": 1, "price": 4.0, "quantity": 5, "timestamp": "2025-05-05T02:00:00.000000Z"}]
    with open(os.path.join(scratch, "o.json"), "w") as fh:
        json.dump(docs, fh, indent=1)
    res = run_orders_json(spark, scratch)
    assert [(r.total_volume, r.avg_price) for r in res.preview] == [(8, 3.0)]


def test_orders_json_accepts_any_iso_timestamp(spark, scratch):
    from ledgerline.plans.orders import orders_daily, read_orders_json
    docs = [{"security_id": 1, "price": 2.0, "quantity": 3, "timestamp": "2025-05-05T01:00:00Z"},
            {"security_id": 1, "price": 4.0, "quantity": 5, "timestamp": "2025-05-05T02:00:00.123+02:00"},
            {"security_id": 2, "price": 4.0, "quantity": 5, "timestamp": "2025-05-06 03:00:00"}]
    folder = os.path.join(scratch, "iso")
    os.makedirs(folder)
    with open(os.path.join(folder, "o.json"), "w") as fh:
        json.dump(docs, fh, indent=1)
    orders = read_orders_json(spark, folder)
    assert orders.filter("timestamp IS NULL").count() == 0
    daily = {(r.security_id, r.trade_date_str): (r.total_volume, r.avg_price) for r in orders_daily(orders).collect()}
    assert daily == {("1", "2025-05-05"): (8, 3.0), ("2", "2025-05-06"): (5, 4.0)}


def test_join_comparison(spark, scratch):
    c = spark.createDataFrame([("a", "n", "s", "c"), ("b", "m", "s", "c")],
                              "customer_id string, customer_name string, segment string, city string")
    t = spark.createDataFrame([("t1", "a", "d", "1", "x", "p"), ("t2", "a", "d", "2", "x", "p"),
                               ("t3", "z", "d", "3", "x", "p")],
                              "transaction_id string, customer_id string, txn_date string, "
                              "txn_amount string, channel string, product string")
    res = compare_join_strategies(spark, c, t, buckets=2, base_path=os.path.join(scratch, "tables"))
    assert res.plain_rows == res.bucketed_rows == 2


def test_cli_ticks_and_joins(spark, scratch):
    raw = os.path.join(scratch, "raw", "year=2025", "month=01", "day=01")
    os.makedirs(raw)
    with open(os.path.join(raw, "t.ndjson"), "w") as fh:
        fh.write(json.dumps({"trade_ts": "2025-01-01T00:00:00Z", "pair": "EUR/USD", "bid": 1.0, "ask": 1.1,
                             "venue": "v", "sequence_id": "s", "instrument_id": "i",
                             "recv_ts": "2025-01-01T00:00:00Z"}) + "\n")
    res = cli.main(["ticks", "--raw", os.path.join(scratch, "raw"), "--out", os.path.join(scratch, "out"),
                    "--export", os.path.join(scratch, "export")], spark=spark)
    assert res["written"] and res["rows"] == 1
    for name, text in [("c.csv", "customer_id,customer_name,segment,city\na,n,s,c\n"),
                       ("t.csv", "transaction_id,customer_id,txn_date,txn_amount,channel,product\nt1,a,d,1,x,p\n")]:
        with open(os.path.join(scratch, name), "w") as fh:
            fh.write(text)
    res = cli.main(["joins", "--customers", os.path.join(scratch, "c.csv"),
                    "--transactions", os.path.join(scratch, "t.csv"), "--buckets", "2",
                    "--base-path", os.path.join(scratch, "bk")], spark=spark)
    assert res["plain_rows"] == res["bucketed_rows"] == 1
    res = cli.main(["joins", "--customers", os.path.join(scratch, "c.csv"),
                    "--transactions", os.path.join(scratch, "t.csv"), "--buckets", "2",
                    "--base-path", os.path.join(scratch, "bk2"), "--min-share", "0.5"], spark=spark)
    assert res["plain_rows"] == res["bucketed_rows"] == 1          # the one customer is hot


def test_properties_file(scratch):
    path = os.path.join(scratch, "db.properties")
    with open(path, "w") as fh:
        fh.write("# comment\nuser = someone\npassword=secret=x\n\n")
    assert cli.read_properties(path) == {"user": "someone", "password": "secret=x"}


def test_cli_orders_prints_rows_as_objects(spark, capsys):
    res = cli.main(["orders", "--generate", "5000", "--partitions", "4", "--preview", "2"], spark=spark)
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed == res and res["rows"] == 5000
    assert [p["partition"] for p in res["partitions"]] == [0, 1, 2, 3]
    assert sum(p["rows"] for p in res["partitions"]) == 5000
    assert set(res["preview"][0]) == {"security_id", "trade_date_str", "total_volume", "avg_price"}
    even = cli.main(["orders", "--generate", "5000", "--partitions", "4", "--preview", "2", "--layout", "even"],
                    spark=spark)
    assert sum(p["rows"] for p in even["partitions"]) == 5000
    key_of = lambda r: (r["trade_date_str"], r["security_id"], r["total_volume"])
    assert [key_of(r) for r in even["preview"]] == [key_of(r) for r in res["preview"]]
    assert all(abs(a["avg_price"] - b["avg_price"]) < 1e-9 for a, b in zip(even["preview"], res["preview"]))
