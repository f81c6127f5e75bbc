from __future__ import annotations

import pytest

from orderlayers.operators import currency
from orderlayers.operators.currency import with_standard_currency


@pytest.mark.parametrize("limit", [100_000, 0])
def test_aliases(spark, monkeypatch, limit):
    monkeypatch.setattr(currency, "BROADCAST_ALIASES", limit)
    rows = [(1, " kroner "), (2, "US$"), (3, "gbp"), (4, " "), (5, None), (6, "Dirham")]
    orders = spark.createDataFrame(rows, "k int, currency string")
    names = [("Kroner", "nok"), ("KRONER", "DKK"), (None, "X"), ("gbp", None), ("dirham", " "), ("", "Y")]
    found = with_standard_currency(orders, spark.createDataFrame(names, "alias string, code string"))
    assert found.columns == ["k", "currency", "standard_currency"]
    assert {r["k"]: r["standard_currency"] for r in found.collect()} == {
        1: "DKK", 2: "USD", 3: "GBP", 4: None, 5: None, 6: "DIRHAM",
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == bool(limit)
