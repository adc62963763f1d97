import math

import pytest

from kelvane.operators import codec


def read(spark, *values):
    frame = spark.createDataFrame([(v,) for v in values], "value binary")
    return [tuple(r) for r in codec.read_messages(frame).collect()]


def test_missing_numbers_read_zero_and_text_numbers_are_taken(spark):
    rows = read(spark, b'{"room":"r","bucket_ms":5}',
                b'{"room":"r","bucket_ms":"7","max_temp":"1.5","avg_temp":null}',
                b'{"room":"r","bucket_ms":5.9,"max_temp":"NaN"}')
    assert rows[0] == ("r", 5, 0.0, 0.0, 0.0, 0.0)
    assert rows[1] == ("r", 7, 1.5, 0.0, 0.0, 0.0)
    assert rows[2][1] == 5 and math.isnan(rows[2][2])


@pytest.mark.parametrize("value", [
    b"not json", b"", None, b"null", b"[1]", b'{"room":"r","bucket_ms":"x"}',
    b'{"room":"r","bucket_ms":1,"colour":"red"}', b'{"room":"r","max_temp":NaN}',
    b"{'room':'r'}",
])
def test_bad_documents_fail_the_query(spark, value):
    with pytest.raises(Exception):
        read(spark, b'{"room":"r","bucket_ms":5}', value)


def test_round_trip_of_special_values(spark):
    from kelvane import schemas
    rows = [("r", 1, float("nan"), 1e-7, None, 123456789.125)]
    frame = spark.createDataFrame(rows, schemas.WINDOW_RESULT)
    (message,) = codec.window_messages(frame).collect()
    assert '"max_humidity":null' in message.value
    assert message.ordinal == 1
    (row,) = codec.read_messages(codec.window_messages(frame)).collect()
    assert math.isnan(row.max_temp) and row.avg_temp == 1e-7 and row.avg_humidity == 123456789.125
