import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def json_records(spark):
    """Values or raw texts to a record table; ``seq`` is the position."""

    def make(*values):
        rows = [
            (i, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, "seq bigint, raw string")

    return make


@pytest.fixture
def conversations(spark):
    """Lists of (role, content) to conversations; ``seq`` is the position."""

    def make(*dialogs):
        return spark.createDataFrame(
            list(enumerate(dialogs)),
            "seq bigint, messages array<struct<role:string,content:string>>",
        )

    return make


@pytest.fixture
def pairs(spark):
    def make(*rows):
        full = [(i, *(r if len(r) == 3 else (None, *r))) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            full, "seq bigint, system string, user string, assistant string"
        )

    return make


def by_seq(df, *columns):
    return {r["seq"]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns)) for r in df.collect()}


def talks(df):
    """seq -> list of (role, content), None where there are no messages."""
    return {
        r["seq"]: None if r["messages"] is None else [tuple(m) for m in r["messages"]]
        for r in df.collect()
    }
