from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerlens.session import pin_session  # noqa: E402

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin_session(session)
    session.stop()


TRANSFER_TYPES = (
    "txn_id bigint, ts timestamp, from_bank int, from_account string, to_bank int, "
    "to_account string, amount_received decimal(20,4), receiving_currency string, "
    "amount_paid decimal(20,4), payment_currency string, payment_format string, "
    "is_laundering int, txn_date date"
)


@pytest.fixture(scope="session")
def make_ledger(spark):
    """Ledger from short dicts: second (epoch), src, dst, amount, flag and optional columns."""
    from datetime import datetime, timezone
    from decimal import Decimal

    def build(rows):
        full = []
        for number, row in enumerate(rows, start=1):
            moment = datetime.fromtimestamp(row.get("s", 0), timezone.utc).replace(tzinfo=None)
            amount = Decimal(str(row.get("amount", 10)))
            currency = row.get("currency", "US Dollar")
            full.append(
                (
                    row.get("id", number), moment, row.get("fb", 1), row.get("src", "A"),
                    row.get("tb", 2), row.get("dst", "B"), amount,
                    row.get("received", currency), amount, currency,
                    row.get("format", "Cash"), row.get("flag", 0), moment.date(),
                )
            )
        return spark.createDataFrame(full, TRANSFER_TYPES)

    return build
