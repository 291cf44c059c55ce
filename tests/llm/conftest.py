import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Tiny tables: two shuffle partitions keep the many small jobs short."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
