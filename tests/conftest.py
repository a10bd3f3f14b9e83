import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from epigrid.session import local_session, tune  # noqa: E402
from epigrid.sources.fixture import fixture_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    shared = str(tmp_path_factory.mktemp("checkpoint"))
    settings = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": shared}
    session = tune(local_session("8", app="tests", settings=settings))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def views_end_with_their_test(request):
    """Temporary views live as long as the session, which all tests share."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for view in session.sql("SHOW VIEWS IN default").filter("isTemporary").collect():
            session.catalog.dropTempView(view["viewName"])


@pytest.fixture(scope="session")
def small(spark):
    return fixture_tables(spark)


@pytest.fixture(scope="session")
def located(small):
    from epigrid.operators.regions import assign_region

    return assign_region(small["cases"], small["regions"])


def rows(df, *columns):
    """Sorted tuples of a result."""
    return sorted(tuple(r) for r in df.select(*columns).collect())
