import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="6g", spark__sql__autoBroadcastJoinThreshold="10485760")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def get(df, *columns):
        out = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple(map(str, r)))

    return get
