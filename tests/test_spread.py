from __future__ import annotations

from pyspark.sql import functions as F

from lodgeframe.queries import Tables
from lodgeframe.queries.gold import listings_gold
from tests.helpers import rows
from tests.test_queries import SF


def test_listings_of_one_file_are_worked_on_by_many_tasks(spark):
    tables = Tables(spark, SF)
    assert tables.customer.select(F.spark_partition_id()).distinct().count() == 1
    gold = listings_gold(tables).select("id", "description", F.spark_partition_id().alias("task"))
    parts = rows(gold.groupBy("task").agg(F.count("*").alias("n")), "n")
    assert len(parts) >= 8
    assert sum(n for _, n in parts) == tables.customer.count() and parts[-1][1] <= 3 * parts[0][1] + 20
