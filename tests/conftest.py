import pytest
from pyspark.sql import SparkSession

from gaugeworks.session import configure

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("gaugeworks-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def series_a(spark):
    """Event types by six hours: the series of the cross-engine goldens."""
    from gaugeworks.plans import adapters
    from gaugeworks.session import cut_lineage

    return cut_lineage(adapters.one_series(spark, SF, "A", prefix=False))


@pytest.fixture
def make_series(spark):
    def make(**stations):
        rows = [(s, 2000 + i, float(x)) for s, xs in stations.items() for i, x in enumerate(xs)]
        return spark.createDataFrame(rows, "station_code string, t int, x double")
    return make


def by_key(df, key="station_code"):
    return {r[key]: r for r in df.collect()}
