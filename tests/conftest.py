import pytest

from tierwork.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(8, shuffle_partitions=4, **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()
