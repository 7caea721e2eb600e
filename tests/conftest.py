import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from fireledger.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")
TABLES = ["region", "nation", "supplier", "part", "lineitem"]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def run(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
        con = duckdb.connect()
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        cursor = con.execute(sql)
        return [d[0] for d in cursor.description], cursor.fetchall()

    return run
