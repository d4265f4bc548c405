import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
REPO = os.path.dirname(HERE)
sys.path.insert(0, REPO)
# Python workers import functions defined in the package and in test modules.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [REPO, HERE] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

from cadenza.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cadenza-tests-")
    session = build_session(
        "local[4]", 8, app_name="cadenza-tests",
        extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
               "spark.local.dir": scratch, "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="cadenza-case-")


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
