import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tunesmith.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(8, app="tests", **{"spark.checkpoint.dir": shared})
