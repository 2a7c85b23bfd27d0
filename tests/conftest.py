from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from scorebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny tables: compiling code costs more than it saves.
    small = {
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
    }
    return local_session(8, app="scorebook-tests", **small)


@pytest.fixture
def lake(spark, tmp_path):
    from scorebook.sources.tables import Lake

    return Lake(spark, f"file:{tmp_path}/lake")
