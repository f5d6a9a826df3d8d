import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from siltworks.runtime import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("tests", 4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
