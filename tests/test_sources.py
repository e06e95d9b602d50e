import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.operators.prep import require_columns
from tabwatch.session import scratch_path
from tabwatch.sources.baseline import load_baseline, save_baseline, save_legacy
from tabwatch.sources.csv import read_csv, write_csv


def test_csv_doubled_quotes_and_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write('id,name,age,fare\n')
        f.write('1,"Johnston, Miss. Catherine Helen ""Carrie""",NA,23.45\n')
        f.write('2,plain,,7.25\n')
        f.write('3,n/a,22.0,oops\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("age", T.DoubleType()), T.StructField("fare", T.DoubleType())])
    with pytest.raises(Exception, match="oops"):
        read_csv(spark, p, schema).collect()
    rows = read_csv(spark, p, schema, bad_values="null").orderBy("id").collect()
    assert rows[0]["name"] == 'Johnston, Miss. Catherine Helen "Carrie"'
    assert rows[0]["age"] is None and rows[1]["age"] is None
    assert rows[2]["name"] is None and rows[2]["fare"] is None   # token and bad number
    out = scratch_path(spark, "csv_rt")
    df = spark.createDataFrame(rows)
    write_csv(df, out)
    back = read_csv(spark, out, schema).orderBy("id").collect()
    assert back == rows


def _edges(spark):
    return spark.createDataFrame(
        [("Age", 0, [float("-inf"), 14.0, 28.0, float("inf")]), ("SibSp", 1, [float("-inf"), float("inf")])],
        "feature string, pos int, bin_edges array<double>")


def test_baseline_roundtrip_keeps_infinities_and_order(spark):
    p = scratch_path(spark, "bl")
    save_baseline(_edges(spark), p, 10)
    back = load_baseline(spark, p).orderBy("pos").collect()
    assert [r["feature"] for r in back] == ["Age", "SibSp"]
    assert back[0]["bin_edges"] == [float("-inf"), 14.0, 28.0, float("inf")]
    assert back[1]["n_bins"] == 10


def test_reads_indented_json_with_bare_infinity_tokens(spark):
    d = tempfile.mkdtemp(prefix="tw-bl-")
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('{\n  "num_cols": ["Fare"],\n  "bins": {\n    "Fare": {\n      "bin_edges": [\n'
                '        -Infinity,\n        7.55,\n        Infinity\n      ]\n    }\n  },\n  "n_bins": 10\n}\n')
    r = load_baseline(spark, d).first()
    assert r["bin_edges"] == [float("-inf"), 7.55, float("inf")]


def test_legacy_migration_and_rejection(spark):
    p = scratch_path(spark, "legacy")
    save_legacy(_edges(spark), p)
    got = load_baseline(spark, p, n_bins=7).orderBy("pos").collect()
    assert [r["feature"] for r in got] == ["Age", "SibSp"] and got[0]["n_bins"] == 7
    bad = tempfile.mkdtemp(prefix="tw-bad-")
    with open(os.path.join(bad, "b.json"), "w") as f:
        f.write('{"distributions": {"Age": [1, 2, 3]}}')
    with pytest.raises(ValueError):
        load_baseline(spark, bad, n_bins=10)


def test_required_columns_lists_missing(spark):
    df = spark.createDataFrame([(1.0,)], "Age double")
    with pytest.raises(ValueError, match=r"\['Fare', 'Parch'\]"):
        require_columns(df, ["Age", "Fare", "Parch"])


def test_migrate_legacy_rewrites_the_current_shape(spark):
    from tabwatch.sources.baseline import migrate_legacy
    legacy, out = scratch_path(spark, "mig_in"), scratch_path(spark, "mig_out")
    save_legacy(_edges(spark), legacy)
    migrate_legacy(spark, legacy, out, n_bins=10)
    back = load_baseline(spark, out).orderBy("pos").collect()
    assert [r["feature"] for r in back] == ["Age", "SibSp"] and back[0]["n_bins"] == 10
    assert back[0]["bin_edges"] == [float("-inf"), 14.0, 28.0, float("inf")]


def test_passenger_schema_is_declared(spark):
    from tabwatch.spec import PASSENGER_SPEC, passenger_schema
    assert len(passenger_schema(True).fields) == 12 and len(passenger_schema(False).fields) == 11
    assert set(PASSENGER_SPEC.columns) <= set(passenger_schema(True).fieldNames())


def test_csv_is_read_by_header_name(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('fare,age,cls,note\n7.25,22.0,3.0,"two\nlines"\n,NA,1,x\n')
    schema = T.StructType([T.StructField("age", T.IntegerType()), T.StructField("cls", T.IntegerType()), T.StructField("fare", T.DoubleType()),
                           T.StructField("note", T.StringType())])
    got = sorted(map(tuple, read_csv(spark, str(p), schema).collect()), key=lambda r: r[1])
    assert got == [(None, 1, None, "x"), (22, 3, 7.25, "two\nlines")]
    with pytest.raises(ValueError, match="sex"):
        read_csv(spark, str(p), T.StructType([T.StructField("sex", T.StringType())]))
    free = read_csv(spark, str(p))
    assert [f.dataType.simpleString() for f in free.schema] == ["double", "double", "double", "string"]


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def test_csv_without_breaks_is_read_in_splits(spark, tmp_path):
    path = _file(tmp_path / "a b [1]", "x.csv", "id,text\n" + "".join(f'{i},"row ""{i}"" here, and more"\n' for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = read_csv(spark, path.replace("[", "\\[").replace("]", "\\]"), ROW)
        assert df.rdd.getNumPartitions() > 3
        assert df.count() == 20_000 and df.where("text = 'row \"77\" here, and more' and id = 77").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_files_with_breaks_are_read_whole(spark, tmp_path):
    from tabwatch.sources.csv import files_with_breaks
    folder = tmp_path / "é x"
    _file(folder, "plain.csv", "id,text\n" + "".join(f"{i},t{i}\n" for i in range(1000)))
    _file(folder, "broken.csv", 'id,text\n5000,"first\nsecond, ""third\n\nfourth"""\n5001,x\n')
    _file(folder, "odd.csv", 'id,text\n6000,5" pipe\n')
    _file(folder, "head.csv", "id,text\n")
    path = str(folder)
    whole, split = files_with_breaks(spark, path)
    assert [w.rsplit("/", 1)[1] for w in whole] == ["broken.csv", "odd.csv"] and len(split) == 2
    got = {r.id: r.text for r in read_csv(spark, path, ROW).collect()}
    assert len(got) == 1003 and got[5000] == 'first\nsecond, "third\n\nfourth"' and got[5001] == "x" and got[6000] == '5" pipe' and got[999] == "t999"
    assert {r.id for r in read_csv(spark, path).collect()} == set(got)


def _old_and_new(spark):
    new = spark.createDataFrame([("Age", 0, [float("-inf"), 1.0, float("inf")])], "feature string, pos int, bin_edges array<double>")
    return _edges(spark), new


@pytest.mark.parametrize("kind", ["version", "folder", "file"])
def test_a_failed_writer_leaves_the_baseline(spark, tmp_path, kind):
    """Whatever lies there before: a saved version, a folder of plain JSON, one plain file."""
    old, new = _old_and_new(spark)
    path = str(tmp_path / "bl")
    if kind == "version":
        save_baseline(old, path, 10)
    else:
        legacy = str(tmp_path / "made")
        save_legacy(old, legacy)
        text = "".join(r.value for r in spark.read.text(legacy).collect())
        _file(tmp_path / "bl", "b.json", text) if kind == "folder" else (tmp_path / "bl").write_text(text)
    failing = new.withColumn("pos", F.when(F.rand() < 2, F.raise_error(F.lit("lost"))).cast("int"))
    with pytest.raises(Exception, match="lost"):
        save_baseline(failing, path, 10)
    assert load_baseline(spark, path, 10).count() == 2
    assert [f for f in os.listdir(tmp_path) if "staged" in f] == []
    save_baseline(new, path, 3)
    rows = load_baseline(spark, path, 10).collect()
    assert [(r.feature, r.n_bins) for r in rows] == [("Age", 3)]
    save_baseline(old, path, 10)
    assert load_baseline(spark, path).count() == 2


def test_a_plain_file_is_read_until_the_new_baseline_is_there(spark, tmp_path, monkeypatch):
    """A writer that is lost between moving the file and naming its own version."""
    from tabwatch.sources import baseline
    old, new = _old_and_new(spark)
    save_legacy(old, str(tmp_path / "made"))
    (tmp_path / "bl").write_text("".join(r.value for r in spark.read.text(str(tmp_path / "made")).collect()))
    plain = baseline.rename_new

    def lost(spark, source, target):
        if "version=" in target:
            raise RuntimeError("lost")
        return plain(spark, source, target)

    monkeypatch.setattr(baseline, "rename_new", lost)
    with pytest.raises(RuntimeError):
        save_baseline(new, str(tmp_path / "bl"), 3)
    monkeypatch.undo()
    assert load_baseline(spark, str(tmp_path / "bl"), 10).count() == 2
    save_baseline(new, str(tmp_path / "bl"), 3)
    assert load_baseline(spark, str(tmp_path / "bl")).count() == 1
