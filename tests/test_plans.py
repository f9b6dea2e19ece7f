"""Shapes of physical plans: no cross joins, no Python rows, filters and columns at the scan."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tidemark.operators import logs
from tidemark.plans import registry
from tidemark.plans.views import Tables
from tidemark.sources.log import read_log, write_log

registry.load()
SF = "/root/testdata/sf0.001"
BATCH = sorted(n for n, fn in registry.QUERIES.items() if not fn.__module__.endswith("q_streams"))


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(registry.QUERIES[name](Tables(spark, SF)))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_topic_pattern_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(Tables(spark, SF).log, path, rebalance=True)
    text = plan(read_log(spark, path, pattern="^events[.]click$").select("offset"))
    assert "PartitionFilters" in text and "RLIKE" in text.split("PartitionFilters")[1].split("\n")[0]
    assert "ReadSchema: struct<offset:bigint>" in text


def test_projection_reaches_the_scan(spark):
    t = Tables(spark, SF)
    text = plan(logs.partition_distribution(t.log_rows))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_latest_by_key_combines_before_the_shuffle(spark):
    text = plan(logs.latest_by_key(Tables(spark, SF).klog_rows, order="event_id"))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("Aggregate") == 2


def test_running_shuffles_the_rows_once(spark):
    """One exchange for the rows; the other two carry combined totals."""
    t = Tables(spark, SF)
    tree = plan(t.log.select("topic", "partition", "offset", "key")).split("\n\n")[0]
    assert tree.count("Exchange") == 3 and "Join" not in tree


def test_values_are_parsed_once(spark):
    from tidemark.operators import cdc
    from tidemark.schema import USER_IMAGE

    df = spark.createDataFrame([("cdc.public.users", "{}")], "topic string, value string")
    images = cdc.cdc_row_image(cdc.parse_cdc(df, USER_IMAGE)).select(F.col("image.id"), "_deleted", "cdc_lsn")
    assert plan(images).count("from_json") == 1
