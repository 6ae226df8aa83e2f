from __future__ import annotations

import pytest

from cellwise.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", memory="8g", shuffle="4", shared=shared)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples of the named columns."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple(map(str, t)))

    return collect
