import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from rowcast.session import configure

    spark = (SparkSession.builder.master("local[*]").appName("rowcast-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    if not (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rowcast-test-ckpt-"))
    yield spark


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rowcast-test-")


IMG = "struct<event_id:bigint,text_col:string,user_id:bigint,value:double>"
LOG_DDL = (f"schema string, table string, action string, rows array<{IMG}>, pk_columns array<string>, "
           "gtid_uuid string, gtid_seq bigint, pos bigint")


def row(event_id, text, user_id=1, value=1.0):
    return (event_id, text, user_id, value)


@pytest.fixture()
def make_log(spark):
    def make(entries, ddl=LOG_DDL):
        return spark.createDataFrame(entries, ddl)
    return make
