import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session("strata-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def dirs(tmp_path):
    d = {k: str(tmp_path / k) for k in ("landing", "bronze", "state", "silver", "out")}
    os.makedirs(d["landing"])
    return d


def write_lines(path, name, lines, mtime=None):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    if mtime is not None:
        os.utime(p, (mtime, mtime))
    return p
