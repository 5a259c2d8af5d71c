import json

import pytest

from rungworks.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def write_json(tmp_path):
    """Write a document under a given file name and return its path."""

    def write(name, document, folder="bronze"):
        path = tmp_path / folder
        path.mkdir(exist_ok=True)
        file = path / name
        file.write_text(json.dumps(document), encoding="utf-8")
        return str(file)

    return write
