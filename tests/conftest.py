import json
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from strata.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "strata-tests",
        master="local[*]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "8"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def write_lines(path: Path, lines) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path


def write_records(path: Path, records) -> Path:
    return write_lines(path, [json.dumps(r) for r in records])


@pytest.fixture
def tmp_uri(tmp_path):
    """A fresh local directory as a URI, the way a cluster path looks."""

    def make(name: str) -> str:
        return "file://" + os.path.join(str(tmp_path), name)

    return make
