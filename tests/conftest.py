from __future__ import annotations

import pytest

from tessella.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "tessella-tests", spark__sql__shuffle__partitions="4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    return "/root/testdata/sf0.001"
