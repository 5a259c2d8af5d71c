import os

import duckdb
import pytest

from rungworks.session import session

DATA = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels embeddings conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def tables(tmp_path):
    """Write tables given as rows, and return their folder."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = {
        "documents": [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())],
        "pages": [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())],
        "embeddings": [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())],
        "conversations": [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())],
        "labels": [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())],
    }

    def write(**given):
        for name, rows in given.items():
            schema = pa.schema(kinds[name])
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            pq.write_table(pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema), tmp_path / f"{name}.parquet")
        return str(tmp_path)

    return write


def answers(sql, folder):
    """Rows of the SQL over a folder's tables, and the column names."""
    connection = duckdb.connect()
    for table in TABLES:
        if os.path.exists(f"{folder}/{table}.parquet"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = connection.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def same(df, sql, folder):
    names, theirs = answers(sql, folder)
    ours = [tuple(r) for r in df.select(*names).collect()]
    show = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert set(df.columns) == set(names)
    assert show(ours) == show(theirs)
    return ours
