import pytest

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        app="ledgerloom-tests",
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.catalogImplementation": "in-memory",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples in the given column order."""

    def collect(df, *columns):
        got = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in got.collect()), key=repr)

    return collect
