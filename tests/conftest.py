import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wardline.session import get_session

    s = get_session("local[4]", spark__sql__shuffle__partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ts(s: str):
    import datetime as dt

    return dt.datetime.fromisoformat(s)
