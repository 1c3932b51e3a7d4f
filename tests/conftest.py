from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugeworks.session import build_session  # noqa: E402
from gaugeworks.sinks.tables import Namespace, create_namespaces  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="10000",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def names(spark, tmp_path) -> Namespace:
    """Schemas of their own in a fresh folder."""
    return create_namespaces(spark, Namespace(f"t{uuid.uuid4().hex[:10]}_"), str(tmp_path / "db"))


@pytest.fixture
def sf_dir() -> str:
    return SF_DIR


def as_set(df, *columns):
    picked = df.select(*columns) if columns else df
    return {tuple(row) for row in picked.collect()}


def as_list(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=str)
