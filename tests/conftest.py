import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from campusgrid.session import build_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(spark__ui__showConsoleProgress="false", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture(params=[1, 8], ids=["one-partition", "eight-partitions"])
def spread(request):
    """Results must not depend on how rows are partitioned."""
    return lambda df: df.repartition(request.param)


def rows(df, *order):
    """Rows as tuples in a fixed order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
