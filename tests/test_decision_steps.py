"""What is made of each customer is dealt over tasks, however few files customers are read from."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.plans import queries


def test_customers_of_one_file_are_dealt(spark, tmp_path):
    k = F.col("id")
    rows = spark.range(1, 401).select(k.alias("c_custkey"), F.when(k % 2 == 0, "BUILDING").otherwise("MACHINERY").alias("c_mktsegment"), (k * 17.5 - 900).alias("c_acctbal"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for made, n in ((queries._answers(spark, str(tmp_path)).where("answer LIKE '{%'"), 379), (queries._customer_features(spark, str(tmp_path)), 1200)):
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and sum(sizes) == n
