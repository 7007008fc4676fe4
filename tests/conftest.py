import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lonja.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # The shared folder is set as on a cluster; pytest removes it with the runs before the last ones.
    return build_session("tests", "8", 4, str(tmp_path_factory.mktemp("shared")))
