"""CSV records across byte ranges, rows set aside, and published versions."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.plans import etl
from bazaar.session import shared_dir, stored, tables_dropped
from bazaar.sources.io import csv_reader, drop_versions, publish, read_published, read_table, versions
from bazaar.sources.records import convert, parsed, records
from bazaar.sources.schemas import RAW_SCHEMAS
from tests.fixtures import CSV, write_raw

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def random_csv(seed, rows, end="\n"):
    rnd, out = random.Random(seed), ["id,text,n"]
    for i in range(rows):
        text = "".join(rnd.choice(["a", "word ", '""', "\n", "\n\n", ",", "é", " ", "\n\",\"".replace('"', '""')])
                       for _ in range(rnd.choice([0, 1, 3, 12, 60])))
        out.append(f'{i},"{text}",{rnd.choice(["", str(i % 7)])}')
        if rnd.random() < 0.05:
            out.append("")
    return end.join(out) + rnd.choice(["", end])


def write(folder, name, *files):
    os.makedirs(f"{folder}/{name}.csv")
    for i, text in enumerate(files):
        with open(f"{folder}/{name}.csv/part-{i}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return f"{folder}/{name}.csv"


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed, size, end", [(1, 64, "\n"), (2, 257, "\n"), (3, 1 << 20, "\n"), (4, 100, "\r\n")])
def test_equal_to_the_reader_of_one_task(spark, tmp_dir, small_ranges, seed, size, end):
    path = write(tmp_dir, "t", random_csv(seed, 60, end), random_csv(seed + 100, 25, end))
    want = as_rows(csv_reader(spark, True).schema(SCHEMA).csv(path))
    small_ranges(size)
    df = parsed(spark, tmp_dir, "t", SCHEMA, multi_line=True)
    assert as_rows(df.select("id", "text", "n")) == want and len(want) == 85
    assert df.where("__bad_record is not null").count() == 0
    assert size > 1000 or spark.read.text(path).rdd.getNumPartitions() > 4


def test_a_quote_that_spans_many_ranges_and_one_never_closed(spark, tmp_dir, small_ranges):
    long = "line, and more\n" * 300
    path = write(tmp_dir, "t", f'id,text,n\n1,"{long}",2\n3,x,4\n')
    small_ranges(50)
    assert as_rows(parsed(spark, tmp_dir, "t", SCHEMA, True).select("id", "text", "n")) == [(1, long, 2), (3, "x", 4)]
    path = write(tmp_dir, "open", 'id,text,n\n1,"never closed,2\n3,x,4\n')
    got = [r.record for r in records(spark, path).where("not first").collect()]
    assert got == ['1,"never closed,2\n3,x,4\n'.rstrip("\n")]


def test_empty_files_and_headers_alone(spark, tmp_dir):
    write(tmp_dir, "t", "id,text,n\n", "id,text,n\n5,x,6\n")
    assert as_rows(parsed(spark, tmp_dir, "t", SCHEMA, True).select("id", "text", "n")) == [(5, "x", 6)]
    write(tmp_dir, "u", "id,text,n")
    for multi_line in (True, False):
        assert parsed(spark, tmp_dir, "u", SCHEMA, multi_line).count() == 0
    write(tmp_dir, "w", "id,text,n\n1,a,2\n", "text,id,n\na,1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        parsed(spark, tmp_dir, "w", SCHEMA, True)


def test_bad_rows_are_set_aside(spark, tmp_dir):
    lines = ["id,text,n"] + [f"{i},t{i},{i}" for i in range(100)]
    bad = ["x,bad id,1", "7,too,many,fields", "8,too few", '9,"two\nlines",not a number']
    path = write(tmp_dir, "t", "\n".join(lines[:50] + bad[:2] + lines[50:]) + "\n", "\n".join([lines[0]] + bad[2:]) + "\n")
    good, aside = f"{tmp_dir}/good", f"{tmp_dir}/bad"
    assert convert(spark, tmp_dir, "t", good, aside, 0.1, SCHEMA, True) == {"rows": 100, "bad": 4}
    assert as_rows(spark.read.parquet(good)) == sorted([(i, f"t{i}", i) for i in range(100)], key=repr)
    found = spark.read.parquet(aside).collect()
    assert sorted(r.record for r in found) == sorted(bad) and all(path in r.file for r in found)
    with pytest.raises(ValueError, match="4 of 104"):
        convert(spark, tmp_dir, "t", good, aside, 0.01, SCHEMA, True)
    assert spark.read.parquet(good).count() == 100
    lines_only = f"{tmp_dir}/lines"
    assert convert(spark, tmp_dir, "t", lines_only, aside, 0.1, SCHEMA, False)["rows"] == 100


def test_raw_tables_convert_as_they_are_read(spark, tmp_dir):
    write_raw(tmp_dir)
    for name in CSV:
        if name in RAW_SCHEMAS:
            convert(spark, tmp_dir, name, f"{tmp_dir}/pq/{name}.parquet", f"{tmp_dir}/bad/{name}", 0.0)
            want = read_table(spark, tmp_dir, name)
            assert as_rows(read_table(spark, f"{tmp_dir}/pq", name, fmt="parquet").select(want.columns)) == as_rows(want), name


def test_readers_see_the_last_whole_version(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a,\n\"b\"", None), (2, "", "x")], "n int, s string, t string")
    with pytest.raises(ValueError, match="no published version"):
        read_published(spark, tmp_dir, "m")
    for fmt in ("parquet", "csv"):
        publish(df, f"{tmp_dir}/{fmt}", "m", fmt)
        want = df if fmt == "parquet" else df.withColumn("s", F.nullif("s", F.lit("")))  # CSV has no empty texts
        assert as_rows(read_published(spark, f"{tmp_dir}/{fmt}", "m")) == as_rows(want)
    home = f"{tmp_dir}/parquet"
    broken = df.withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        publish(broken, home, "m")
    assert as_rows(read_published(spark, home, "m")) == as_rows(df) and len(versions(spark, home, "m")) == 1
    for i in range(3, 6):
        publish(df.withColumn("n", F.lit(i)), home, "m")
    assert {r.n for r in read_published(spark, home, "m").collect()} == {5}
    assert {r.n for r in read_published(spark, home, "m", 2).collect()} == {3}
    assert len(drop_versions(spark, home, "m")) == 2
    assert read_published(spark, home, "m").count() == 2 and not os.path.exists(versions(spark, home, "m")[-1]["path"])


def test_marts_stay_readable_while_they_are_rebuilt(spark, tmp_dir):
    write_raw(tmp_dir)
    out = etl.run_marts(spark, tmp_dir, f"{tmp_dir}/marts", state_codes=None)
    old = read_published(spark, f"{tmp_dir}/marts", etl.MART_FILES["on_time_by_month"])
    again = etl.run_marts(spark, tmp_dir, f"{tmp_dir}/marts", state_codes=None)
    assert out["on_time_by_month"] != again["on_time_by_month"]
    assert as_rows(old) == as_rows(read_published(spark, f"{tmp_dir}/marts", etl.MART_FILES["on_time_by_month"]))


def test_stored_tables_end_with_their_block(spark):
    with tables_dropped(spark):
        df = stored(spark.range(5), "within")
        path = df.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert os.path.isdir(path) and df.count() == 5
    assert not os.path.exists(path) and os.path.isdir(shared_dir(spark).removeprefix("file:"))


def test_marts_of_converted_files_are_those_of_the_raw_ones(spark, tmp_dir):
    write_raw(tmp_dir)
    names = [n for n in RAW_SCHEMAS if os.path.exists(f"{tmp_dir}/{n}.csv")]
    counts = etl.convert_raw(spark, tmp_dir, f"{tmp_dir}/good", f"{tmp_dir}/bad", names)
    assert all(c["bad"] == 0 for c in counts.values()) and counts["orders"]["rows"] == 6
    raw = etl.run_marts(spark, tmp_dir, f"{tmp_dir}/m1", state_codes=None)
    converted = etl.run_marts(spark, f"{tmp_dir}/good", f"{tmp_dir}/m2", raw_fmt="parquet", state_codes=None)
    for mart in raw:
        a, b = spark.read.parquet(raw[mart]), spark.read.parquet(converted[mart])
        assert as_rows(a) == as_rows(b.select(a.columns)), mart


def test_parsed_rows_are_not_written_once_more(spark, tmp_dir, monkeypatch):
    from bazaar.sources import records as R

    names, real = [], R.stored
    monkeypatch.setattr(R, "stored", lambda df, name: names.append(name) or real(df, name))
    os.makedirs(f"{tmp_dir}/t.csv")
    with open(f"{tmp_dir}/t.csv/a.csv", "w") as f:
        f.write('id,text,n\n1,"a\nb",2\n3,c,x\n4,d,5\n')
    got = R.convert(spark, tmp_dir, "t", f"{tmp_dir}/good", f"{tmp_dir}/bad", 0.5, SCHEMA, True)
    assert got == {"rows": 2, "bad": 1} and "csv-parsed" not in names
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/good").select("id", "text", "n").collect()) == [(1, "a\nb", 2), (4, "d", 5)]
    assert [r.record for r in spark.read.parquet(f"{tmp_dir}/bad").collect()] == ["3,c,x"]
