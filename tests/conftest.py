import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from holdfast.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # its own warehouse: tables of a run that was stopped must not stand in the way of the next
    session = local_session(8, "holdfast-tests", str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def telco(spark, sf_dir):
    from holdfast.plans.registry import telco as build

    return build(spark, sf_dir)
