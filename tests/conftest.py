import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from adtally.session import configure

    ckpt = tempfile.mkdtemp(prefix="adtally-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("adtally-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            p = os.path.join(sf_dir, f"{t}.parquet")
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        return con
    return connect
