import pytest

from tierhouse.session import REQUIRED_CONF


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    home = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{home}/checkpoint")
        .config("spark.sql.warehouse.dir", f"file://{home}/warehouse")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """All rows as a sorted list of tuples, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
