import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from applens.session import build_session

    scratch = tempfile.mkdtemp(prefix="applens-tests-")
    spark = build_session(
        app_name="applens-tests", master="local[4]", shuffle_partitions=8,
        extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
               "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
               "spark.driver.memory": "4g"})
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), in order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
