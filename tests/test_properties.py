"""Property tests: operators against brute force on small random inputs."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.aggregate import daily_volume_price
from ledgerline.operators.dedup import latest_per_key, latest_per_key_agg
from ledgerline.operators.joins import inner_join, skew_join

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

keys = st.one_of(st.none(), st.integers(0, 4))
tick_rows = st.lists(
    st.tuples(keys, st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 10_000)),
    min_size=0, max_size=40, unique_by=lambda r: r[2])


def brute_latest(rows, null_keys):
    groups = defaultdict(list)
    out = []
    for k, ts, tb in rows:
        if k is None and null_keys == "keep":
            out.append((k, ts, tb))
        elif k is None and null_keys == "drop":
            continue
        else:
            groups[k].append((k, ts, tb))
    for grp in groups.values():
        # descending, nulls last: a null ts ranks below every value
        out.append(max(grp, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2])))
    return sorted(out, key=repr)


@SETTINGS
@given(rows=tick_rows, null_keys=st.sampled_from(["collapse", "keep", "drop"]), parts=st.integers(1, 5))
def test_latest_per_key_matches_brute_force(spark, rows, null_keys, parts):
    df = spark.createDataFrame(rows, "k int, ts int, tb int").repartition(parts)
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["ts"], ["tb"], null_keys).collect()), key=repr)
    assert got == brute_latest(rows, null_keys)
    out_keys = [r[0] for r in got if r[0] is not None]
    assert len(out_keys) == len(set(out_keys))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6), st.integers(0, 10_000)),
                     max_size=40, unique_by=lambda r: r[2]))
def test_max_by_form_matches_window_form(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, tb int")
    a = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts"], ["tb"]).collect())
    b = sorted(tuple(r) for r in latest_per_key_agg(df, ["k"], ["ts"], ["tb"]).collect())
    assert a == b


join_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 99)), max_size=30)


@SETTINGS
@given(left=join_rows, right=join_rows, min_share=st.sampled_from([0.05, 0.2, 0.5, 1.0]),
       salts=st.integers(1, 6))
def test_salted_join_equals_plain_join(spark, left, right, min_share, salts):
    lf = spark.createDataFrame(left, "k int, a int")
    rf = spark.createDataFrame(right, "k int, b int")
    brute = sorted((lk, a, b) for lk, a in left for rk, b in right if lk is not None and lk == rk)
    plain = sorted(tuple(r) for r in inner_join(lf, rf, "k").collect())
    salted = sorted(tuple(r) for r in skew_join(lf, rf, "k", min_share=min_share, salt_buckets=salts).collect())
    assert plain == brute
    assert salted == brute


order_rows = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 3),
              st.one_of(st.none(), st.integers(0, 500)), st.one_of(st.none(), st.integers(1, 100))),
    max_size=40)


@SETTINGS
@given(rows=order_rows, parts=st.integers(1, 4))
def test_daily_aggregate_matches_brute_force(spark, rows, parts):
    data = [(s, f"2025-01-0{d + 1}", None if p is None else p / 4, q) for s, d, p, q in rows]
    df = spark.createDataFrame(data, "security_id int, trade_date_str string, price double, quantity int")
    clean = df.filter("price IS NOT NULL AND quantity IS NOT NULL").repartition(parts)
    got = {(r.security_id, r.trade_date_str): (r.total_volume, r.avg_price)
           for r in daily_volume_price(clean).collect()}
    groups = defaultdict(list)
    for s, d, p, q in data:
        if p is not None and q is not None:
            groups[(s, d)].append((p, q))
    want = {k: (sum(q for _, q in v), sum(p for p, _ in v) / len(v)) for k, v in groups.items()}
    assert got.keys() == want.keys()
    for k, (vol, avg) in want.items():
        assert got[k][0] == vol and abs(got[k][1] - avg) < 1e-9


sort_rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "hot"])), st.integers(0, 3)),
                     max_size=40)


@SETTINGS
@given(rows=sort_rows, parts=st.integers(1, 5))
def test_tie_split_sort_keeps_order_and_rows(spark, rows, parts):
    from ledgerline.operators.aggregate import sort_by
    df = spark.createDataFrame(rows, "k string, v int").repartition(parts)
    got = [tuple(r) for r in sort_by(df, ["k"]).collect()]
    # ascending, nulls first; the multiset of rows is unchanged
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or ""))
    assert sorted(got, key=repr) == sorted(rows, key=repr)


@SETTINGS
@given(rows=order_rows, parts=st.integers(2, 6))
def test_even_and_key_layouts_agree(spark, rows, parts):
    from ledgerline.plans.orders import run_orders
    data = [(s, None if p is None else p / 4, q, f"2025-01-0{d + 1} 10:00:00") for s, d, p, q in rows]
    df = spark.createDataFrame(data, "security_id int, price double, quantity int, ts string").selectExpr(
        "security_id", "price", "quantity", "CAST(ts AS TIMESTAMP) AS timestamp")
    a = sorted(tuple(r) for r in run_orders(df, parts, preview_rows=0, layout="even").daily.collect())
    b = sorted(tuple(r) for r in run_orders(df, parts, preview_rows=0, layout="key").daily.collect())
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert all(abs(x[3] - y[3]) < 1e-9 for x, y in zip(a, b))


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(left=join_rows, right=join_rows, min_share=st.sampled_from([0.1, 0.3, 1.0]))
def test_bucketed_hot_split_equals_brute_force(spark, left, right, min_share):
    from ledgerline.operators.joins import bucketed_join
    from ledgerline.operators.layout import write_bucketed
    from ledgerline.session import fresh_dir
    from ledgerline.sources.catalog import drop_table, ensure_database
    base = fresh_dir(spark, "prop_bucketed")
    ensure_database(spark, "ledgerline_prop", location=f"{base}/db")
    for name, rows, schema in (("l", left, "k int, a int"), ("r", right, "k int, b int")):
        drop_table(spark, f"ledgerline_prop.{name}")
        write_bucketed(spark.createDataFrame(rows, schema), f"ledgerline_prop.{name}", "k", buckets=3,
                       path=f"{base}/{name}")
    brute = sorted((lk, a, b) for lk, a in left for rk, b in right if lk is not None and lk == rk)
    got = bucketed_join(spark, "ledgerline_prop.l", "ledgerline_prop.r", "k", hot_side="right",
                        min_share=min_share, salt_buckets=3)
    assert sorted(tuple(r) for r in got.collect()) == brute


ts_orders = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 400)), st.one_of(st.none(), st.integers(1, 50)),
              st.integers(0, 4 * 86_400 - 1)),
    max_size=40)


@SETTINGS
@given(rows=ts_orders, parts=st.integers(1, 4))
def test_orders_daily_matches_brute_force(spark, rows, parts):
    import datetime as dt
    from ledgerline.plans.orders import orders_daily
    base = dt.datetime(2025, 3, 1)
    data = [(s, None if p is None else p / 8, q, base + dt.timedelta(seconds=sec)) for s, p, q, sec in rows]
    df = spark.createDataFrame(data, "security_id int, price double, quantity int, timestamp timestamp_ntz")
    got = {(r.security_id, r.trade_date_str): (r.total_volume, r.avg_price)
           for r in orders_daily(df.repartition(parts)).collect()}
    groups = defaultdict(list)
    for s, p, q, ts in data:
        if p is not None and q is not None:
            groups[(s, ts.strftime("%Y-%m-%d"))].append((p, q))
    want = {k: (sum(q for _, q in v), sum(p for p, _ in v) / len(v)) for k, v in groups.items()}
    assert got.keys() == want.keys()
    for k, (vol, avg) in want.items():
        assert got[k][0] == vol and abs(got[k][1] - avg) < 1e-9
