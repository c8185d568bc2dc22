"""What the driver holds while it gathers the bit map that all tasks get."""

import tracemalloc

from pyspark.sql import functions as F

from tarifa.llm import decontaminate
from tarifa.session import settings


def test_full_bit_map_is_gathered_without_row_objects(spark):
    prints = spark.range(1 << 20).select(F.xxhash64("id").alias("print"))
    with settings(spark, {"spark.sql.execution.arrow.pyspark.enabled": "false"}):
        tracemalloc.start()
        try:
            bits = decontaminate._bit_map(prints)
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
    wanted = {r[0] & ((1 << decontaminate.MAP_BITS) - 1) for r in prints.limit(1000).collect()}
    assert all(bits[at >> 5] >> (at & 31) & 1 for at in wanted)
    assert peak < 48 << 20
