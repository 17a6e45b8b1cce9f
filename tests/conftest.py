import pytest

from olapflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "8", **{"spark.checkpoint.dir": str(shared), "spark.sql.shuffle.partitions": "2"})
    yield session
    session.stop()
