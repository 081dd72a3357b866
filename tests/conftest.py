import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabfit.session import build_session, shared_dir
    s = build_session(master="local[4]", app="tabfit-tests", shuffle_partitions=8)
    shared_dir(s)  # registers a checkpoint folder only if the session names none
    yield s
    s.stop()


@pytest.fixture
def write_text(tmp_path):
    def _w(name, text):
        p = tmp_path / name
        p.write_text(text)
        return str(p)
    return _w
