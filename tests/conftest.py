import gzip
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierline import VersionedTable, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(shared),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def table(spark, folder):
    return VersionedTable(spark, f"{folder}/table")


def rows(df, *order):
    """Rows as sorted tuples, nulls first."""
    picked = df.select(*order) if order else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def drop_json(folder, name, lines):
    """One gzip JSON-lines part; a string line is written as it is."""
    os.makedirs(folder, exist_ok=True)
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
    with gzip.open(f"{folder}/{name}.json.gz", "wt") as out:
        out.write(text)
