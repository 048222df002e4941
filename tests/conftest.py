import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from geoincident.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", "geoincident-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="gi-test-ckpt-")})
    yield s
    s.stop()
