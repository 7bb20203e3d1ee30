"""What a Python worker is handed at a time is bounded by bytes, not by rows alone."""

import pyarrow as pa
from pyspark.sql import functions as F

from orderwell.llm import shipping

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_and_smaller_bounds_hold(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    texts = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("abcdefghij"), 200).alias("text"))

    def handed():
        return texts.mapInArrow(sizes, "n long, size long").agg(F.sum("n"), F.max("size")).first()

    before = spark.conf.get(SETTING, None)
    try:
        spark.conf.unset(SETTING)
        shipping.ship(spark)
        rows, largest = handed()
        assert rows == 8000 and largest < 1.1 * shipping.BATCH_BYTES
        spark.conf.set(SETTING, "1m")
        shipping.ship(spark)
        assert spark.conf.get(SETTING) == f"{1 << 20}b"
        rows, largest = handed()
        assert rows == 8000 and largest < 1.1 * (1 << 20)
    finally:
        if before is None:
            spark.conf.unset(SETTING)
        else:
            spark.conf.set(SETTING, before)
