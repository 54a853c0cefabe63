import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from popcenter.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="popcenter-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_text(tmp_path):
    def write(lines, name="data.txt"):
        p = tmp_path / name
        p.write_text("\n".join(lines) + "\n")
        return str(p)

    return write
