"""Readers of exports: CSV records over range borders."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from echoloom import schemas as S
from echoloom.session import scratch
from echoloom.sources import exports as X, records

NAMES = S.RAW_SUPPORT.names


def local(spark, name):
    import os
    path = scratch(spark, name).removeprefix("file:")
    os.makedirs(path)
    return path


def write(path, rows, name="a.csv", line="\n", header=NAMES):
    with open(f"{path}/{name}", "w", newline="") as f:
        out = csv.writer(f, lineterminator=line)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that quoted fields cross their borders."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sample(n, seed=1, longest=30):
    r = random.Random(seed)
    bits = ["text", "\n", '"', ",", "é", '""', "\r\n", "a longer run of words", "\n\n", " "]
    return [[f"T{i}", f"u{i}@x.org", *("".join(r.choices(bits, k=r.randint(1, longest))) + "." for _ in range(2)),
             str(i), "open", "web"] for i in range(n)]


def rows_of(df):
    return sorted(tuple(x or "" for x in r) for r in df.collect())


@pytest.mark.parametrize("line", ["\n", "\r\n"])
def test_breaks_within_quotes(spark, small_ranges, line):
    path, rows = local(spark, "csv"), sample(150)
    write(path, rows, line=line)
    write(path, rows[:1], "b.csv", line=line)
    write(path, [], "c.csv", line=line)
    df = X.read_csv_export(spark, path, S.RAW_SUPPORT)
    assert rows_of(df) == sorted(tuple(r) for r in [*rows, rows[0]])
    lines = spark.read.option("lineSep", "\n").text(f"{path}/a.csv")
    assert lines.rdd.getNumPartitions() > 20 and df.rdd.getNumPartitions() > 20


def test_field_over_many_ranges(spark, small_ranges):
    """A field of several ranges, a header of several lines, a last line without a break."""
    path = local(spark, "csv")
    rows = [["1", "a", "line\n" * 500, "m", "0", "s", "c"], ["2", "b", "x", 'say "so"\n' * 300, "0", "s", "c"], *sample(20, 3, 400)]
    write(path, rows, header=["ticket\n" * 100, *NAMES[1:]])
    text = open(f"{path}/a.csv", newline="").read()
    open(f"{path}/a.csv", "w", newline="").write(text.rstrip("\n"))
    assert rows_of(X.read_csv_export(spark, path, S.RAW_SUPPORT)) == sorted(tuple(r) for r in rows)


def test_one_state_per_range(spark, small_ranges):
    path = local(spark, "csv")
    write(path, sample(60))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    (states,) = records.ranges(lines).values()
    data = open(f"{path}/a.csv", "rb").read()
    for start, (begins, _) in states.items():
        # lines belong to the range in which they start
        at = data.find(b"\n", start - 1) + 1 if start else 0
        assert begins == (data[:at].count(b'"') % 2 == 1)
    assert any(b for b, _ in states.values())


@pytest.mark.parametrize("bad", ["short,row", 'T,"u", "never closed', "a,b,c,d,e,f,g,h,i"])
def test_malformed_rows_fail(spark, small_ranges, bad):
    path = local(spark, "csv")
    write(path, sample(30))
    with open(f"{path}/a.csv", "a") as f:
        f.write(bad + "\n")
    with pytest.raises(Exception):
        X.read_csv_export(spark, path, S.RAW_SUPPORT).collect()


def test_without_breaks(spark):
    path = local(spark, "csv")
    rows = [[str(i), "u", 'a "b", c', "m", "0", "s", "w"] for i in range(20)]
    write(path, rows)
    for breaks in (True, False):
        assert rows_of(X.read_csv_export(spark, path, S.RAW_SUPPORT, line_breaks=breaks)) == sorted(tuple(r) for r in rows)


def test_types_and_rescued_values(spark, small_ranges):
    path = local(spark, "raw")
    header = ["id", "n", "big", "x", "flag", "day", "at", "word", "none"]
    rows = [[str(i), f"{i:03d}", str(i * 10**10), f"{i}.5e1", "TRUE" if i % 2 else "false", f"2026-01-{i + 1:02d}",
             f"2026-01-01 10:{i:02d}:00", f'a "word",\n{i}', ""] for i in range(28)]
    write(path, rows, header=header)
    df = X.load_raw(spark, path, "csv")
    assert [t for _, t in df.dtypes] == ["int", "int", "bigint", "double", "boolean", "date", "timestamp", "string", "string",
                                         "map<string,string>"]
    assert sorted(r.word for r in df.collect()) == sorted(r[7] for r in rows) and df.where("_rescued is not null").count() == 0
    # one value that does not fit widens a column, or is rescued where the type is named
    write(path, [["x", "1", "2", "3", "maybe", "2026-01-01", "", "w", "q"]], "b.csv", header=header)
    with open(f"{path}/b.csv", "a") as f:
        f.write("5,6\n")
    wide = X.load_raw(spark, path, "csv")
    assert dict(wide.dtypes) | {"id": "string", "flag": "string", "x": "double"} == dict(wide.dtypes)
    assert [dict(r._rescued) for r in wide.where("_rescued is not null").collect()] == [{"_record": "5,6"}]
    named = X.load_raw(spark, path, "csv", types={"id": "int", "flag": "boolean"})
    got = [dict(r._rescued) for r in named.where("_rescued is not null").collect()]
    assert sorted(got, key=len) == [{"_record": "5,6"}, {"id": "x", "flag": "maybe"}]
    assert named.where("id is null").count() == 1 and named.count() == 30


def test_load_of_an_empty_table(spark):
    path = local(spark, "none")
    write(path, [])
    df = X.load_raw(spark, path, "csv")
    assert df.columns == [*NAMES, "_rescued"] and df.count() == 0
