import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from queuelake import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "queuelake-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def landed(spark):
    """Bronze rows from `(path, body)` pairs; a body may be text or an object to dump as JSON."""

    def build(*responses, status=200, content_type="application/json", at="2026-04-14 12:00:00"):
        rows = [
            (i, path, body if isinstance(body, str) or body is None else json.dumps(body))
            for i, (path, body) in enumerate(responses)
        ]
        frame = spark.createDataFrame(rows, "seq bigint, path string, body string")
        return frame.selectExpr(
            "seq",
            "path",
            f"timestamp'{at}' AS fetched_at",
            f"{status} AS status",
            f"'{content_type}' AS content_type",
            "body",
        )

    return build


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of one column expression over a list of rows."""

    def run(rows, schema, expression):
        return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]

    return run
