"""Rows and settings that the tests share."""

from contextlib import contextmanager
from datetime import datetime
from decimal import Decimal

RAW = (
    "invoice string, stock_code string, description string, quantity int, "
    "invoice_date timestamp_ntz, price decimal(10,2), customer_id int, country string"
)


@contextmanager
def settings(spark, **values):
    """Set options for a block; underscores stand for dots."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def line(
    invoice="536365",
    stock_code="85123",
    description="white heart",
    quantity=1,
    when="2010-12-01 08:26:00",
    price="2.55",
    customer_id=1,
    country="France",
):
    return (
        invoice,
        stock_code,
        description,
        quantity,
        when and datetime.fromisoformat(when),
        price and Decimal(price),
        customer_id,
        country,
    )


def counted(df):
    """``df`` and a counter of its rows, which grows each time they are computed."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen
