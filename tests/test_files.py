import gzip

import pytest
from pyspark.errors import AnalysisException

from riskweave import schemas as S
from riskweave.session import materialize, scratch_dir
from riskweave.sources import delimited, files


def test_bom_crlf_missing_tokens_and_column_order(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿age,extra,smoke,BMI\r\n39,x,1,26.97\r\n46,y,NA,\r\n48,z,0.0,NaN\r\n".encode())
    df = files.read_delimited(spark, str(path), {"BMI": "double", "age": "double", "smoke": "int"})
    assert df.dtypes == [("BMI", "double"), ("age", "double"), ("smoke", "int")]
    assert [tuple(r) for r in df.orderBy("age").collect()] == [(26.97, 39.0, 1), (None, 46.0, None), (None, 48.0, 0)]


def test_semicolon_and_missing_column(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("age;gender\n18393;2\n")
    assert files.read_delimited(spark, str(path), {"gender": "int"}, ";").first()["gender"] == 2
    with pytest.raises(ValueError):
        files.read_delimited(spark, str(path), S.CARDIO_COLUMNS, ";")


def test_text_that_is_no_number_fails(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("age\nabc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_delimited(spark, str(path), {"age": "double"}).collect()


def test_write_read_counts_and_missing_path(spark, tmp_path):
    df = spark.range(5).toDF("n")
    path = files.write_table(df, str(tmp_path / "t"))
    files.write_table(df.limit(3), path)  # overwrites
    assert files.read_table(spark, path).count() == 3
    csv = files.write_table(df, str(tmp_path / "csv"), "csv", ";")
    assert files.read_delimited(spark, csv, {"n": "int"}, ";").count() == 5
    counts = files.source_counts({"a": df, "b": df.limit(0)}).collect()
    assert [tuple(r) for r in counts] == [("a", 5), ("b", 0)]
    with pytest.raises(AnalysisException):
        files.read_table(spark, str(tmp_path / "absent"))


def test_scaler_roundtrip(spark, tmp_path):
    stats = {"age": (52.5, 8.29), "BMI": (25.0, 0.0)}
    files.save_scaler(spark, stats, str(tmp_path / "s"))
    assert files.load_scaler(spark, str(tmp_path / "s")) == stats
    with pytest.raises(AnalysisException):
        files.load_scaler(spark, str(tmp_path / "none"))


def test_scratch_follows_the_session_setting(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = materialize(spark.range(10).repartition(1), "t", spread=True)
    assert copy.count() == 10 and scratch_dir(spark) in copy.inputFiles()[0]


def test_ranges_cover_every_line_once(spark, tmp_path):
    text = "b;a\r\n" + "".join(f"{i};{'x' * (i % 37)}{i}\r\n" for i in range(500)) + "last;z"
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "one.csv").write_bytes(("\ufeff" + text).encode())
    (tmp_path / "d" / "two.csv").write_text("a;c;b\nq;w;7\n")
    (tmp_path / "d" / "_SUCCESS").write_text("")
    (tmp_path / "d" / ".hidden.csv").write_text("nothing")
    (tmp_path / "d" / "empty.csv").write_text("")
    want = sorted([(f"{'x' * (i % 37)}{i}", str(i)) for i in range(500)] + [("z", "last"), ("q", "7")])
    for size in (1, 7, 64, 1000, 1 << 20):
        read = delimited.DelimitedReader({"path": str(tmp_path / "d"), "sep": ";", "columns": '["a", "b"]', "part_bytes": str(size)})
        got = [tuple(r.values()) for p in read.partitions() for b in read.read(p) for r in b.to_pylist()]
        assert sorted(got) == want, size
    df = files.read_delimited(spark, str(tmp_path / "d"), {"a": "string", "b": "string"}, ";")
    assert sorted(map(tuple, df.collect())) == want


def test_packed_files_short_lines_and_quotes(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('n,t\n1,"x, ""y"""\n2\n\n3,z\n')
    df = files.read_delimited(spark, str(tmp_path / "a.csv.gz"), {"t": "string", "n": "int"})
    assert sorted((r["n"], r["t"]) for r in df.collect() if r["t"]) == [(1, 'x, "y"'), (3, "z")] and df.where("n = 2 AND t IS NULL").count() == 1
    (tmp_path / "b.csv").write_text("n,t\n1,2,3\n")
    with pytest.raises(Exception, match="more fields"):
        files.read_delimited(spark, str(tmp_path / "b.csv"), {"n": "int"}).collect()
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, str(tmp_path / "absent"), {"n": "int"})


def test_spark_readers_serve_other_file_systems(spark, tmp_path, monkeypatch):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "one.csv").write_text("n,t\n1,x\n")
    (tmp_path / "e" / "two.csv").write_text("t,n\ny,2\n")
    monkeypatch.setattr(delimited, "SCHEMES", set())
    got = files.read_delimited(spark, str(tmp_path / "e"), {"n": "int", "t": "string"}).collect()
    assert sorted(map(tuple, got)) == [(1, "x"), (2, "y")]
