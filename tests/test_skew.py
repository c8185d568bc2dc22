"""Queries over tables in which one key holds a third of all rows."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from check import TABLES, compare, open_tables


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    """A copy of the tables with a third of the line items on one order, line and supplier."""
    target = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        table = pq.read_table(f"{folder}/{name}.parquet")
        if name == "lineitem":
            hot = np.arange(table.num_rows) % 3 == 0
            for column in ("l_orderkey", "l_linenumber", "l_suppkey"):
                values = table[column].to_numpy()
                i = table.column_names.index(column)
                changed = pa.array(np.where(hot, 1, values), table.schema.field(i).type)
                table = table.set_column(i, table.schema.field(i), changed)
        pq.write_table(table, f"{target}/{name}.parquet")
    return str(target)


@pytest.mark.parametrize(
    "name",
    [
        "dim_airlines", "dim_routes", "incremental_upsert", "late_data_policy", "clustered_write", "iqr_trim",
        "encoder_classes", "dq_unique", "ml_flight_pricing",
    ],
)
def test_hot_key(spark, skewed, name):
    with open_tables(skewed) as connection:
        assert compare(spark, connection, skewed, name).startswith("ok")


def test_hot_key_without_broadcast(spark, skewed):
    """The same result when every join shuffles."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with open_tables(skewed) as connection:
            for name in ("ml_flight_pricing", "incremental_upsert", "encode_categories"):
                assert compare(spark, connection, skewed, name).startswith("ok")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
