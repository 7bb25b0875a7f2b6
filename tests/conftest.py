import pytest


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session
    s = build_session(master="local[4]", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()
