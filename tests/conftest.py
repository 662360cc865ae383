import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rxlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def by_key():
    """Rows of a DataFrame as dicts, by one of the columns."""

    def collect(df, key):
        return {row[key]: row.asDict() for row in df.collect()}

    return collect


@pytest.fixture
def partitions(spark):
    """Run a function under several shuffle widths and return all results."""

    def run(fn, widths=(1, 3, 7)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            results = []
            for n in widths:
                spark.conf.set("spark.sql.shuffle.partitions", str(n))
                results.append(fn(n))
            return results
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    return run
