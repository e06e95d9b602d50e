"""Streams over tables that are folders of part files."""

import os

import pytest

from tabwatch.plans import stream_queries
from tabwatch.plans.stream_queries import QUERIES

SF = "/root/testdata/sf0.001"


def copy_as_folders(spark, path):
    for name in os.listdir(SF):
        if name in ("events.parquet", "lineitem.parquet"):
            spark.read.parquet(f"{SF}/{name}").repartition(3).write.parquet(f"{path}/{name}")
        else:
            os.symlink(f"{SF}/{name}", f"{path}/{name}")
    return str(path)


@pytest.mark.parametrize("name", ["stream_score", "stream_drift_batch", "stream_drift_window"])
def test_folder_table_streams_whole(spark, tmp_path, name):
    def got(sf):
        return sorted(map(str, QUERIES[name](spark, sf).collect()))
    want = got(SF)
    if name == "stream_score":
        assert len(want) == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert want and got(copy_as_folders(spark, tmp_path)) == want


def test_stream_that_saw_nothing_raises(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "file_stream", lambda spark, sf, name, schema: spark.readStream.schema(schema).option("pathGlobFilter", "none").parquet(sf))
    with pytest.raises(RuntimeError, match="read no rows"):
        QUERIES["stream_drift_batch"](spark, SF)
