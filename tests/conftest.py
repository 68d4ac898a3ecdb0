import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallycrest.session import local_session

    return local_session(8, shuffle_partitions=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))})


@pytest.fixture(scope="session")
def views(spark):
    from tallycrest.sources.testviews import TestViews

    return TestViews(spark, "/root/testdata/sf0.001")
