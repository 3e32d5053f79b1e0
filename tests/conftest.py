import pytest

from civica.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="civica-tests",
        master="local[4]",
        spark_sql_shuffle_partitions="4",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, columns in the order given."""

    def collect(df, *columns):
        wanted = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in wanted.collect()), key=repr)

    return collect
