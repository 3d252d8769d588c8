from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from muster.schemas import SCHEMAS  # noqa: E402
from muster.session import local_session  # noqa: E402
from muster.sources.local import local_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "*",
        shuffle_partitions=4,
        # A zone other than UTC: results must not depend on it.
        spark__sql__session__timeZone="America/New_York",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture
def crm(spark):
    """Hand-made CRM tables: ``crm(contact=[{"id": 1}])``; columns left out are NULL, tables left out empty."""

    def build(**given):
        unknown = set(given) - set(SCHEMAS)
        assert not unknown, unknown
        tables = {}
        for name, schema in SCHEMAS.items():
            rows = [tuple(row.get(field.name) for field in schema) for row in given.get(name, [])]
            tables[name] = local_rows(spark, rows, schema)
        return tables

    return build

