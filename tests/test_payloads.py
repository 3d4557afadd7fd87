from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

from conftest import rows

from spendlake.sources import payloads


def landed(spark, *documents):
    texts = [document if isinstance(document, str) else json.dumps(document) for document in documents]
    return spark.createDataFrame(list(enumerate(texts)), "id int, payload string")


def domestic(price="100", status="0", volume="7"):
    output = {"stck_prpr": price, "stck_sdpr": "99", "prdy_ctrt": " -0.5 ", "stck_hgpr": "101", "stck_lwpr": "98",
              "acml_vol": volume}
    return {"rt_cd": status, "msg_cd": "", "msg1": "", "output": output}


def overseas(rate):
    output = {"last": " 12.3456 ", "base": "12", "diff": "0.3456", "rate": rate, "tvol": "5"}
    return {"rt_cd": "0", "msg_cd": "", "msg1": "", "output": output}


def test_domestic_quotes(spark):
    frame = landed(
        spark, domestic(" 100.5 "), domestic(status="1"), domestic("n/a"), domestic(volume="-3"), "not json"
    )
    result = payloads.domestic_quotes(frame)
    assert rows(result, "id", "current_price", "change_rate", "volume") == [(0, Decimal("100.5000"), -0.5, 7)]


def test_overseas_rate_loses_leading_plus_signs(spark):
    result = payloads.overseas_quotes(landed(spark, overseas("+1.50"), overseas(" ++2 "), overseas("-3"), overseas("x")))
    assert rows(result, "id", "change_rate") == [(0, 1.5), (1, 2.0), (2, -3.0)]


def test_crypto_prices(spark):
    result = payloads.crypto_prices(
        landed(spark, {"price": "64000.12"}, {"code": 404, "message": "no"}, {"price": "n/a"}, {"price": " 1"})
    )
    assert rows(result) == [(0, Decimal("64000.1200"))]


def test_exchange_rates(spark):
    result = payloads.exchange_rates(landed(spark, {"rate": 1300.5}, {"code": 400, "message": "no"}))
    assert rows(result) == [(0, 1300.5)]


def holidays(spark, *documents):
    return rows(payloads.holiday_dates(spark.createDataFrame([(d,) for d in documents], "payload string")))


def document(items, code="00", total=None):
    body = "".join(f"<item><locdate>{day}</locdate><isHoliday>{flag}</isHoliday></item>" for day, flag in items)
    count = len(items) if total is None else total
    return (
        f"<response><header><resultCode>{code}</resultCode><resultMsg>x</resultMsg></header>"
        f"<body><items>{body}</items><totalCount>{count}</totalCount></body></response>"
    )


def test_holiday_documents(spark):
    new_year = ("20240101", "Y")
    found = holidays(
        spark,
        document([new_year, ("20240105", "N"), ("20240230", "Y")]),
        document([new_year]),
        document([("20240301", "Y")], code="99"),
        document([("20240401", "Y")], total=0),
        document([]),
    )
    assert found == [(date(2024, 1, 1),)]
