import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared.as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def six_points(spark):
    points = [(0, 0), (10, 10), (21, 21), (33, 33), (5, 27), (28, 6)]
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "id bigint, v array<double>")
