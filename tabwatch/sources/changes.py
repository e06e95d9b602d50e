"""A table that grows by numbered changes, safe for several writers.

A change is a folder ``change=<n>`` of Parquet files.  Its rows are written to
a folder of their own first and that is renamed to its number: a rename does not
replace a folder that has files, so of several writers that prepare the same
number one succeeds, whole, and the others read again.  Readers see whole
changes alone.  Plain files beside the folders are read as well.

The rename must be atomic, as it is on a local or network file system and on
HDFS; object stores without one need another commit service.
"""

from __future__ import annotations

import errno
import os
import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.session import local_frame

CHANGE = "change"


def missing(error: AnalysisException) -> bool:
    """Whether the error says that there is no such table."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_changes(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all changes that are there now; none before the first one.  The
    list of changes is taken once: what is read from the result is one state."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as e:
        if not missing(e):
            raise
        return local_frame(spark, [], schema)


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(conf)
    return jvm, conf, fs, fs.makeQualified(there)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder its name; False if there is one of that name already."""
    jvm, conf, fs, old = _hadoop(spark, source)
    new = _hadoop(spark, target)[3]
    if fs.getScheme() == "file":
        try:
            fs.mkdirs(new.getParent())
            os.rename(*(unquote(urlparse(p.toUri().toString()).path) for p in (old, new)))
            return True
        except OSError as e:
            if e.errno in (errno.EEXIST, errno.ENOTEMPTY):
                return False
            raise
    none = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    none[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        fs.mkdirs(new.getParent())
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(old, new, none)
        return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether there is a plain file of that name."""
    _, _, fs, there = _hadoop(spark, path)
    return bool(fs.exists(there)) and bool(fs.getFileStatus(there).isFile())


def drop_folder(spark: SparkSession, path: str) -> None:
    _, _, fs, there = _hadoop(spark, path)
    fs.delete(there, True)


def last_number(spark: SparkSession, path: str, name: str) -> int:
    """The greatest n of the folders ``<name>=<n>`` in ``path``; 0 without any."""
    _, _, fs, there = _hadoop(spark, path)
    if not fs.exists(there):
        return 0
    found = [re.fullmatch(name + r"=(\d+)", f.getPath().getName()) for f in fs.listStatus(there)]
    return max((int(m[1]) for m in found if m), default=0)


def append_change(spark: SparkSession, path: str, schema: str, rows_after: Callable[[DataFrame, int], DataFrame]) -> int:
    """Append one change; its number is returned.

    ``rows_after(state, n)`` gives the rows of change n from all rows before it.  It is called again
    with the new state whenever another writer took the number first, so no
    change is ever made from a state that is not the latest."""
    path = path.rstrip("/")
    while True:
        state = read_changes(spark, path, schema)
        n = int(state.agg(F.max(CHANGE)).first()[0] or 0) + 1
        staged = f"{path}/_staged-{uuid.uuid4().hex}"         # readers pass over names that begin so
        rows_after(state, n).withColumn(CHANGE, F.lit(n).cast("bigint")).coalesce(1).write.parquet(staged)
        if rename_new(spark, staged, f"{path}/{CHANGE}={n}"):
            return n
        drop_folder(spark, staged)
