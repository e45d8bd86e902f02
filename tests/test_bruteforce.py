"""Random small inputs: Spark operators against a brute-force Python computation."""

import datetime as dt
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import AS_OF, frame, telemetry
from vantage.functions.time import AsOf
from vantage.operators.pricing import price_usage
from vantage.plans import views

T0 = dt.datetime(2024, 1, 1)
hours = st.integers(min_value=0, max_value=60)
price_rows = st.lists(st.tuples(st.sampled_from(["A", "B"]), hours, st.one_of(st.none(), st.integers(1, 30)),
                                st.integers(1, 9)), max_size=6)
usage_rows = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), hours, st.integers(1, 5)), max_size=12)
SETTINGS = settings(max_examples=14, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(prices=price_rows, usage=usage_rows, how=st.sampled_from(["left", "inner"]))
def test_price_join_matches_brute_force(spark, prices, usage, how):
    p = [dict(sku_name=s, price_start_time=T0 + dt.timedelta(hours=h),
              price_end_time=None if n is None else T0 + dt.timedelta(hours=h + n), pricing=((Decimal(v),),))
         for s, h, n, v in prices]
    u = [dict(sku_name=s, usage_end_time=T0 + dt.timedelta(hours=h), usage_quantity=Decimal(q),
              workspace_id=str(i)) for i, (s, h, q) in enumerate(usage)]
    if u:  # a row with a null SKU and one with a null end time
        u.append(dict(sku_name=None, usage_end_time=T0, usage_quantity=Decimal(1), workspace_id="n1"))
        u.append(dict(sku_name="A", usage_end_time=None, usage_quantity=Decimal(1), workspace_id="n2"))
    t = telemetry(spark, usage=u, list_prices=p)
    got = Counter((r.workspace_id, r.list_price) for r in
                  price_usage(t.usage, t.list_prices, how=how).collect())
    want = Counter()
    for row in u:
        hits = [x["pricing"][0][0] for x in p
                if row["sku_name"] is not None and row["usage_end_time"] is not None
                and x["sku_name"] == row["sku_name"] and row["usage_end_time"] >= x["price_start_time"]
                and (x["price_end_time"] is None or row["usage_end_time"] < x["price_end_time"])]
        for h in hits:
            want[(row["workspace_id"], h)] += 1
        if not hits and how == "left":
            want[(row["workspace_id"], None)] += 1
    assert got == want


events = st.lists(st.tuples(st.sampled_from(["1", "2"]), st.sampled_from(["a@x.com", "System-User-3", None]),
                            st.integers(0, 47), st.sampled_from(["deleteJob", "deleteTable", "getTable"])),
                  max_size=40)


@SETTINGS
@given(rows=events, min_ops=st.integers(0, 3))
def test_delete_bursts_match_brute_force(spark, rows, min_ops):
    day = dt.datetime(2024, 1, 30)
    audit = [dict(event_id=i, workspace_id=w, user_identity=(e,), action_name=a,
                  event_time=day + dt.timedelta(minutes=m * 20), event_date=(day + dt.timedelta(minutes=m * 20)).date())
             for i, (w, e, m, a) in enumerate(rows)]
    t = telemetry(spark, audit=audit)
    got = Counter((r.workspace_id, r.user_email, r.detail, r.event_time) for r in
                  views.destructive_bursts(t, AsOf(AS_OF), min_ops=min_ops).collect())
    groups: dict = {}
    for x in audit:
        email = x["user_identity"][0]
        if not x["action_name"].startswith("delete") or email is None or "System-User" in email:
            continue
        key = (x["workspace_id"], email, x["event_time"].replace(minute=0))
        groups.setdefault(key, []).append(x["event_time"])
    want = Counter((w, e, f"{len(ts)} delete operations in 1 hour", max(ts))
                   for (w, e, _), ts in groups.items() if len(ts) > min_ops)
    assert got == want
    assert frame is not None


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 400))), max_size=60),
       p=st.sampled_from([0.0, 0.5, 0.95, 1.0]), width=st.sampled_from([1, 7, 1000]))
def test_exact_percentile_matches_the_function(spark, rows, p, width):
    from pyspark.sql import functions as F

    from vantage.operators.percentiles import exact_percentile

    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: r.x for r in exact_percentile(df, ["k"], "v", p, width, "x").collect()}
    want = {r.k: r.x for r in df.groupBy("k").agg(F.percentile("v", p).alias("x")).collect() if r.x is not None}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


states = st.sampled_from([None, "SUCCESS", "FAILED", "CANCELED", "TIMEDOUT", "RUNNING"])


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1, 3), st.one_of(st.none(), st.integers(0, 4)), states), min_size=1, max_size=25))
def test_run_state_is_that_of_the_latest_finished_period(spark, rows):
    from vantage.plans import summary

    start = dt.datetime(2024, 1, 20)
    t = telemetry(spark, job_run_timeline=[
        dict(run_id=run, result_state=state, period_start_time=start,
             period_end_time=None if end is None else start + dt.timedelta(hours=end)) for run, end, state in rows])
    got = {r.run_id: (r.succeeded, r.failed) for r in summary.run_summaries(t, AsOf(AS_OF)).collect()}
    want = {}
    for run in {r for r, _, _ in rows}:
        done = [(-1 if end is None else end, state) for r, end, state in rows if r == run and state is not None]
        last = max(done)[1] if done else None
        want[run] = (last == "SUCCESS", last == "FAILED")
    assert got == want
