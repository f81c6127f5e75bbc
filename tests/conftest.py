from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlayers import schema as S
from orderlayers.session import build_session

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "layers")


@pytest.fixture
def small():
    return f"{DATA}/sf0.001"


GOOD = {
    "order_id": "ORD-1",
    "order_date": "2024-01-15 10:00:00",
    "status": "مؤكد",
    "customer_id": "C1",
    "customer_name": "Name",
    "customer_phone": "+2000000001",
    "customer_email": "a@example.com",
    "city": "Cairo",
    "district": "D",
    "delivery_type": "standard",
    "delivery_cost": "1.50",
    "payment_method": "card",
    "payment_status": "paid",
    "payment_amount": "10.00",
    "currency": "USD",
    "total_amount": "10.00",
    "items_json": '[{"sku":"P1","qty":2,"price":5.00}]',
}


@pytest.fixture
def orders(spark):
    """A frame of order rows, each like a good one but for the given fields."""

    def make(*changes: dict):
        rows = [tuple({**GOOD, **change}[f] for f in S.ORDER_FIELDS) for change in changes]
        return spark.createDataFrame(rows, S.RAW_SCHEMA)

    return make
