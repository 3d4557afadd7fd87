from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from conftest import rows

from spendlake.operators import amounts
from spendlake.plans import prices, snapshot
from spendlake.sources.tables import read_table


@pytest.fixture(scope="module")
def tables(spark):
    d = Decimal
    return SimpleNamespace(
        users=spark.createDataFrame([(1,), (2,)], "user_seq bigint"),
        stock_type=spark.createDataFrame(
            [(1, "KRX", "KRW"), (2, "NAS", "USD"), (3, "NYS", "USD")],
            "market_seq bigint, market_alias string, currency_code string",
        ),
        stock=spark.createDataFrame(
            [(1, 1, d("10.5")), (2, 2, None), (3, 3, d("2.25"))],
            "stock_seq bigint, market_seq bigint, stock_price decimal(18,4)",
        ),
        stock_asset=spark.createDataFrame(
            [(1, 1, 2), (1, 1, 3), (1, 2, 9), (2, 2, 4)], "user_seq bigint, stock_seq bigint, stock_cnt bigint"
        ),
        crypto=spark.createDataFrame(
            [(1, d("100"), "USD"), (2, d("5"), "EUR")], "crypto_seq bigint, crypto_price decimal(18,4), currency_code string"
        ),
        crypto_asset=spark.createDataFrame(
            [(2, 1, d("0.00000001")), (2, 2, d("1"))], "user_seq bigint, crypto_seq bigint, crypto_cnt decimal(18,8)"
        ),
        currency_code=spark.createDataFrame([("USD",), ("KRW",)], "currency_code string"),
        cash_asset=spark.createDataFrame(
            [(1, d("7"), "KRW"), (3, d("1"), "KRW"), (1, d("2"), "EUR")],
            "user_seq bigint, cash decimal(18,4), currency_code string",
        ),
        deposit_asset=spark.createDataFrame(
            [(1, d("3"), "KRW", True)],
            "user_seq bigint, deposit_amount decimal(18,4), currency_code string, is_terminated boolean",
        ),
        saving_asset=spark.createDataFrame(
            [(2, d("4"), "USD", True)],
            "user_seq bigint, accum_saving_amount decimal(18,4), currency_code string, is_terminated boolean",
        ),
    )


def test_a_user_with_only_unpriced_stock_has_no_amount(tables):
    held = amounts.amount_per_user(amounts.stock_rows(tables.stock_asset, tables.stock, tables.stock_type))
    assert rows(held) == [(1, "KRW", Decimal("52.5000"))]


def test_coins_of_unknown_currency_do_not_count(tables):
    held = amounts.amount_per_user(amounts.crypto_rows(tables.crypto_asset, tables.crypto, tables.currency_code))
    assert rows(held) == [(2, "USD", Decimal("0.000001000000"))]


def test_snapshot_has_one_row_per_user_and_market_currency(tables):
    kinds = [f"{kind}_amount" for kind in snapshot.KINDS]
    frame = snapshot.asset_snapshot(tables, datetime(2024, 1, 1))
    found = {row[:2]: tuple(map(float, row[2:])) for row in rows(frame, "user_seq", "currency_code", *kinds)}
    # cash, stock, crypto, deposit, saving; ended deposits and savings count.
    assert found == {
        (1, "KRW"): (7, 52.5, 0, 3, 0),
        (1, "USD"): (0, 0, 0, 0, 0),
        (2, "KRW"): (0, 0, 0, 0, 0),
        (2, "USD"): (0, 0, 0.000001, 0, 4),
    }


def test_users_and_cash_of_one_file_are_combined_in_many_tasks(spark, tables, tmp_path):
    users = spark.range(1, 20_001).selectExpr("id as user_seq").unionByName(spark.createDataFrame([(1,)], "user_seq bigint"))
    users.coalesce(1).write.parquet(f"{tmp_path}/users")
    cash = spark.range(20_000).selectExpr(
        "1 + id % 4000 as user_seq", "cast(id as decimal(18,4)) as cash", "if(id % 2 = 0, 'KRW', 'USD') as currency_code"
    )
    cash.coalesce(1).write.parquet(f"{tmp_path}/cash")
    read = spark.read.parquet
    large = SimpleNamespace(**vars(tables) | {"users": read(f"{tmp_path}/users"), "cash_asset": read(f"{tmp_path}/cash")})
    frame = snapshot.asset_snapshot(large, datetime(2024, 1, 1)).select("user_seq", "currency_code", "cash_amount")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2  # below the explode of the users, and below the cash
    found = rows(frame)
    assert len(found) == 40_000 and found[0] == (1, "KRW", Decimal(sum(range(0, 20_000, 4000))))
    assert {row[2] for row in found if row[0] > 4000} == {0}


def _above(plan: str, column: str) -> list[str]:
    """The operators above the scan that reads ``column``, nearest first."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Relation [" in line and f"{column}#" in line)
    found, depth = [], lines[at].index("Relation")
    for line in reversed(lines[:at]):
        start = len(line) - len(line.lstrip(" :+-"))
        if start < depth:
            found.append(line[start:])
            depth = start
    return found


def test_deposits_and_savings_of_one_file_are_combined_in_many_tasks(spark, tables, tmp_path):
    for kind, amount in (("deposit", "deposit_amount"), ("saving", "accum_saving_amount")):
        held = spark.range(20_000).selectExpr(
            "if(id < 100, 7, id) as user_seq", f"cast(if(id = 1, null, id) as decimal(18,4)) as {amount}",
            "if(id % 2 = 0, 'KRW', 'USD') as currency_code", "id % 3 = 0 as is_terminated",
        )
        held.unionByName(held.filter("user_seq >= 19990")).coalesce(1).write.parquet(f"{tmp_path}/{kind}")
    own = {f"{kind}_asset": spark.read.parquet(f"{tmp_path}/{kind}") for kind in ("deposit", "saving")}
    users = spark.range(20_000).selectExpr("id as user_seq")
    large = SimpleNamespace(**vars(tables) | own | {"users": users})
    frame = snapshot.asset_snapshot(large, datetime(2024, 1, 1)).select(
        "user_seq", "currency_code", "deposit_amount", "saving_amount"
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    for column in ("deposit_amount", "accum_saving_amount"):
        names = [line.split()[0] for line in _above(plan, column)]
        assert names.index("RepartitionByExpression") < names.index("Aggregate")
    found = {row[:2]: row[2:] for row in rows(frame)}
    assert len(found) == 40_000
    assert found[7, "KRW"] == (sum(range(0, 100, 2)),) * 2 and found[7, "USD"] == (sum(range(3, 100, 2)),) * 2
    assert found[19_990, "KRW"] == (2 * 19_990,) * 2 and found[19_990, "USD"] == (0, 0) and found[500, "KRW"] == (500, 500)


def test_rates_become_decimals_and_unfetched_rows_stay(spark):
    rates = spark.createDataFrame(
        [(1, Decimal("1"), None, None), (2, Decimal("2"), None, None)],
        "exchange_rate_snapshot_seq bigint, exchange_rate decimal(18,8), updated_at timestamp_ntz, updated_by string",
    )
    fetched = spark.createDataFrame([(1, 1300.123456789)], "exchange_rate_snapshot_seq bigint, rate double")
    result = prices.update_rates(rates, fetched, "2024-01-01 00:00:00")
    assert rows(result) == [
        (1, Decimal("1300.12345679"), datetime(2024, 1, 1), "batch"), (2, Decimal("2.00000000"), None, None)
    ]


def test_history_is_stored_by_day(spark, tmp_path):
    fetched = spark.createDataFrame(
        [(1, "S1", "KRW", "one", Decimal("10.5"))],
        "stock_seq bigint, api_symbol string, currency_code string, stock_name string, current_price decimal(18,4)",
    )
    for day in ("2024-01-01 10:00:00", "2024-01-02 10:00:00", "2024-01-02 11:00:00"):
        prices.append_history(prices.price_history(fetched, "stock_seq", "stock_name", day), str(tmp_path / "history"))
    assert sorted(path.name for path in (tmp_path / "history").glob("recorded_date=*")) == [
        "recorded_date=2024-01-01", "recorded_date=2024-01-02"
    ]
    assert spark.read.parquet(str(tmp_path / "history")).select("price").distinct().first()[0] == 10.5


def test_tables_are_read_with_their_declared_schema(spark, tmp_path):
    spark.createDataFrame([("KRW", True)], "currency_code string, is_active boolean").write.parquet(
        str(tmp_path / "currency_code")
    )
    found = read_table(spark, str(tmp_path), "currency_code")
    assert rows(found, "currency_code", "country_code", "is_active") == [("KRW", None, True)]


def test_of_two_prices_of_one_symbol_the_last_one_counts(spark):
    stock = spark.createDataFrame(
        [(1, Decimal("1.0000"), None, None), (2, Decimal("2.0000"), None, None)],
        "stock_seq bigint, stock_price decimal(18,4), updated_at timestamp_ntz, updated_by string",
    )
    fetched = spark.createDataFrame(
        [(1, Decimal("5"), 2), (1, Decimal("9"), 1), (1, Decimal("4"), 2)],
        "stock_seq bigint, current_price decimal(18,4), landed_at int",
    )
    updated = prices.update_prices(stock, fetched, "stock_seq", "stock_price", "2024-01-01 00:00:00", "landed_at")
    # Of two that landed together the greater one, whatever their order.
    assert rows(updated, "stock_seq", "stock_price") == [(1, Decimal("5.0000")), (2, Decimal("2.0000"))]
    with pytest.raises(Exception, match="repeats without an order"):
        prices.update_prices(stock, fetched.drop("landed_at"), "stock_seq", "stock_price", "2024-01-01 00:00:00").collect()


def test_of_two_rates_of_one_row_the_last_one_counts(spark):
    rates = spark.createDataFrame(
        [(1, Decimal("1"), None, None)],
        "exchange_rate_snapshot_seq bigint, exchange_rate decimal(18,8), updated_at timestamp_ntz, updated_by string",
    )
    fetched = spark.createDataFrame([(1, 3.0, 1), (1, 2.0, 2)], "exchange_rate_snapshot_seq bigint, rate double, landed_at int")
    updated = prices.update_rates(rates, fetched, "2024-01-01 00:00:00", "landed_at")
    assert rows(updated, "exchange_rate") == [(Decimal("2.00000000"),)]
