import pytest

from areaflow.runtime import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small DataFrame from a DDL schema and rows."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build
