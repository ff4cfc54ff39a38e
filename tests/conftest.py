import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from velocart.session import build_session

    scratch = tempfile.mkdtemp(prefix="velocart-tests-")
    s = build_session(
        "local[4]",
        app_name="velocart-tests",
        shuffle_partitions=4,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


def sf_dir(sf: str) -> str:
    return f"{TESTDATA}/sf{sf}"


def rows(df, *cols):
    """Sorted list of tuples (None sorts first) for order-insensitive checks."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
