import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from convforge.session import get_spark
    s = get_spark("local[4]", app="convforge-tests", shuffle_partitions=8,
                  extra={"spark.ui.enabled": "false",
                         "spark.ui.showConsoleProgress": "false",
                         "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session names none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="convforge-test-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="convforge-t-")


def lines_df(spark, lines, key="k"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], f"{key} int, value string")
