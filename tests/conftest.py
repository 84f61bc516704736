import pytest
from pyspark.sql import SparkSession

from tidelog.session import prepare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = prepare(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "out")


def event(file, pos, op, rows=None, ts=0, table="t", txn=None, gtid=None):
    """One routed log event."""
    return (file, pos, ts, op, "app", table, gtid[0] if gtid else None, gtid[1] if gtid else None, rows, txn)


EVENT_SCHEMA = (
    "binlog_file string, log_pos bigint, event_ts_s bigint, op string, source_db string, source_table string, "
    "gtid_uuid string, gtid_no bigint, rows array<array<string>>, txn_id string"
)


def events_of(spark, events, with_txn=False):
    df = spark.createDataFrame(events, EVENT_SCHEMA)
    return df if with_txn else df.drop("txn_id")
