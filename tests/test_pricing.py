"""Price-at-time join rules."""

from tests.conftest import AS_OF, money, telemetry, ts
from vantage.functions.time import AsOf
from vantage.operators.pricing import price_overlaps, price_usage
from vantage.plans import summary

PRICES = [
    dict(sku_name="SKU_1", price_start_time=ts("2023-01-01 00:00:00"), price_end_time=ts("2024-01-15 00:00:00"),
         pricing=((money(1),),)),
    dict(sku_name="SKU_1", price_start_time=ts("2024-01-15 00:00:00"), price_end_time=None, pricing=((money(2),),)),
]


def _priced(spark, usage_rows, how="left", prices=PRICES):
    t = telemetry(spark, usage=usage_rows, list_prices=prices)
    return price_usage(t.usage, t.list_prices, how=how)


def test_boundary_start_in_end_out(spark):
    rows = [dict(usage_end_time=ts("2024-01-15 00:00:00"), usage_quantity=money(10))]
    out = _priced(spark, rows).collect()
    assert len(out) == 1 and out[0].list_price == money(2)  # end == next start -> next version


def test_before_boundary_uses_old_version(spark):
    rows = [dict(usage_end_time=ts("2024-01-14 23:59:59"), usage_quantity=money(10))]
    assert _priced(spark, rows).collect()[0].cost == money(10)


def test_open_price_matches_later_usage(spark):
    rows = [dict(usage_end_time=ts("2030-01-01 00:00:00"), usage_quantity=money(3))]
    assert _priced(spark, rows).collect()[0].cost == money(6)


def test_missing_price_left_keeps_inner_drops(spark):
    rows = [dict(sku_name="SKU_X", usage_quantity=money(5))]
    left = _priced(spark, rows, "left").collect()
    assert len(left) == 1 and left[0].cost is None and left[0].usage_quantity == money(5)
    assert _priced(spark, rows, "inner").count() == 0


def test_overlapping_prices_multiply_and_are_reported(spark):
    overlap = PRICES + [dict(sku_name="SKU_1", price_start_time=ts("2024-01-20 00:00:00"), price_end_time=None,
                             pricing=((money(3),),))]
    rows = [dict(usage_end_time=ts("2024-01-25 00:00:00"), usage_quantity=money(1))]
    assert _priced(spark, rows, prices=overlap).count() == 2
    t = telemetry(spark, list_prices=overlap)
    assert price_overlaps(t.list_prices).count() == 1
    assert price_overlaps(telemetry(spark, list_prices=PRICES).list_prices).count() == 0


def test_inner_cost_equals_left_cost(spark):
    rows = [dict(usage_quantity=money(q), sku_name=s) for q, s in [(1, "SKU_1"), (2, "SKU_X"), (3, "SKU_1")]]
    left = _priced(spark, rows, "left").agg({"cost": "sum"}).collect()[0][0]
    inner = _priced(spark, rows, "inner").agg({"cost": "sum"}).collect()[0][0]
    assert left == inner == money(8)


def test_cost_daily_keeps_unpriced_with_null_cost(spark):
    rows = [dict(sku_name="SKU_X", usage_quantity=money(5)), dict(usage_quantity=money(2))]
    t = telemetry(spark, usage=rows, list_prices=PRICES)
    got = {r.sku_name: r for r in summary.cost_daily(t, AsOf(AS_OF)).collect()}
    assert got["SKU_X"].estimated_cost_usd is None and got["SKU_X"].total_dbus == money(5)
    assert got["SKU_1"].estimated_cost_usd == money(4)


def test_money_type_keeps_small_costs(spark):
    """38-digit decimals: the product keeps six fraction digits; the documented cast keeps what is lost."""
    usage = spark.range(1).selectExpr("'S' AS sku_name", "timestamp'2024-01-01 00:00:00' AS usage_end_time",
                                      "CAST(0.000123456 AS DECIMAL(38,18)) AS usage_quantity")
    prices = spark.range(1).selectExpr(
        "'S' AS sku_name", "timestamp'2023-01-01 00:00:00' AS price_start_time", "CAST(NULL AS TIMESTAMP) AS price_end_time",
        "named_struct('effective_list', named_struct('default', CAST(0.0007 AS DECIMAL(38,18)))) AS pricing")
    assert float(price_usage(usage, prices).first().cost) == 0.0
    assert abs(float(price_usage(usage, prices, money="decimal(18,9)").first().cost) - 0.000123456 * 0.0007) < 1e-15


def test_usage_columns_come_back_as_they_were(spark):
    t = telemetry(spark, usage=[dict(usage_quantity=money(1))], list_prices=PRICES)
    assert price_usage(t.usage, t.list_prices).columns == [*t.usage.columns, "list_price", "cost"]
