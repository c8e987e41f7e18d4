import pytest


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    """Reader of the driver's tables at the smallest scale."""
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
