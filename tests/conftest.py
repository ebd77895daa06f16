import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlake.session import local_session, shared_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g", tempfile.mkdtemp(prefix="tests-"))
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def folder(spark):
    """A new folder below the shared one."""
    path = f"{shared_dir(spark)}/tests/{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


@pytest.fixture
def table_name():
    return f"t_{uuid.uuid4().hex[:12]}"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted(map(tuple, chosen.collect()), key=str)
