import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfstar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(8, 8, **{"spark.sql.warehouse.dir": str(root / "warehouse")})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Result rows as a sorted list of tuples."""

    def collect(df, *cols):
        return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)

    return collect
