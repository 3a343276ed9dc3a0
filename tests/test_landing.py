"""Days by their shape, files under any number of headers by one scan."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import landing as LD
from ledgerlens.sources import io

D = dt.date

DAYS = {
    # three numbers: year first, month first, and turned where the month would be over 12
    "2024-01-07": D(2024, 1, 7), "2024/1/7": D(2024, 1, 7), "2024.01.07": D(2024, 1, 7), "2024 1 7": D(2024, 1, 7),
    "01/02/2024": D(2024, 1, 2), "1-2-2024": D(2024, 1, 2), "7.1.2024": D(2024, 7, 1), "1 2 2024": D(2024, 1, 2),
    "13/01/2024": D(2024, 1, 13), "31.12.2024": D(2024, 12, 31), "2024/13/01": D(2024, 1, 13), "12/13/2024": D(2024, 12, 13),
    "99-01-07": D(1999, 1, 7), "24-01-07": D(2007, 1, 24), "01/07/24": D(2024, 1, 7), "1/7/75": D(1975, 1, 7),
    # digits alone
    "20240107": D(2024, 1, 7), "240107": D(2024, 1, 7),
    # months by name
    "7-Jan-2024": D(2024, 1, 7), "07 JAN 24": D(2024, 1, 7), "7 January 2024": D(2024, 1, 7), "January 7, 2024": D(2024, 1, 7),
    "Jan 7 2024": D(2024, 1, 7), "Sept 7, 2024": D(2024, 9, 7), "2024-Jan-07": D(2024, 1, 7), "7jan2024": D(2024, 1, 7),
    "Sunday, 7 January 2024": D(2024, 1, 7), "Sun, January 7, 2024": D(2024, 1, 7), "7th of January 2024": D(2024, 1, 7), "Jan. 7, 2024": D(2024, 1, 7),
    # times of day
    "2024-01-07T10:20:30Z": D(2024, 1, 7), "2024-01-07 10:20:30.123456 +02:00": D(2024, 1, 7), "1/7/2024 9:05 PM": D(2024, 1, 7),
    "20240107 10:00": D(2024, 1, 7), "7 Jan 2024 10:00:00": D(2024, 1, 7), "  2024-01-07  ": D(2024, 1, 7), "1/7/2024 9 pm": D(2024, 1, 7),
    "2024-02-29": D(2024, 2, 29),
    # no days
    "2023-02-29": None, "not a date": None, "": None, "2024-00-07": None, "2024-13-13": None, "32/01/2024": None, "7 Foo 2024": None,
    "1/2": None, "2024": None, "123456789": None, "1-2-3-4": None, "12/2024/01": None, "2024-01-07x": None, "ja 7 2024": None, "1#2#2024": None,
    "99999999999-1-1": None, None: None,
}


def test_days_of_every_shape(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(DAYS)], "i int, t string")
    got = {r["t"]: r["d"] for r in df.select("t", LD.parse_date("t").alias("d")).collect()}
    assert got == DAYS


def test_a_day_is_parsed_once(spark):
    text = spark.range(1).select(LD.parse_date(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in text.lower() and "to_timestamp" not in text.lower()


def land(folder, files):
    os.makedirs(folder)
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w", newline="") as f:
            f.write(text)


FILES = {
    "a.csv": 'x,y\n1,"two, too"\n\n3,\n',
    "b.csv": "y,x,z\nb,4,zz\nlong,5,6,7,8\nshort\n",
    "sub/c.csv": "﻿X,w\r\n7,eight\r\n",
    "d.csv": "",
    "e.csv": "x,y\n",
    "f.csv": "x,y,y\n9,first,second\n",
    "g.txt": "x\nno\n",
}


def test_files_under_their_own_headers(spark, scratch):
    land(f"{scratch}/land", FILES)
    df = io.read_landing(spark, f"{scratch}/land")
    assert sorted(df.columns) == sorted(["X", "y", "z", "w", "_header", "source_file"])
    got = sorted(tuple(str(r[c]) for c in ("X", "y", "z", "w")) + (r["source_file"].rsplit("/", 1)[1],) for r in df.collect())
    assert got == sorted([
        ("1", "two, too", "None", "None", "a.csv"), ("3", "None", "None", "None", "a.csv"), ("4", "b", "zz", "None", "b.csv"),
        ("5", "long", "6", "None", "b.csv"), ("None", "short", "None", "None", "b.csv"), ("7", "None", "None", "eight", "c.csv"),
        ("9", "first", "None", "None", "f.csv"),
    ])


@pytest.mark.parametrize("block", [None, 64])
def test_large_files_have_one_header(spark, scratch, block):
    """A file read in many splits: only its first line is a header, also where a later one looks like it."""
    lines = [f"{i},{i * i}" for i in range(500)]
    lines[250] = "a,b"
    land(f"{scratch}/land", {"x.csv": "a,b\n" + "\n".join(lines) + "\n", "y.csv": "b,a\n" + "\n".join(lines[:100]) + "\n"})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if block:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        rows = io.read_landing(spark, f"{scratch}/land").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    x = sorted((r["a"], r["b"]) for r in rows if r["source_file"].endswith("x.csv"))
    y = sorted((r["b"], r["a"]) for r in rows if r["source_file"].endswith("y.csv"))
    assert x == sorted(tuple(ln.split(",")) for ln in lines) and y == sorted(tuple(ln.split(",")) for ln in lines[:100])


def test_landed_text_is_read_once(spark, scratch):
    """However many headers there are, the result reads the kept lines, and splits them in one expression."""
    land(f"{scratch}/land", {f"f{i}.csv": f"k,c{i}\n{i},v{i}\n" for i in range(12)})
    df = io.read_landing(spark, f"{scratch}/land")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert " text" not in text and text.count("from_csv") == 1 and "Union" not in text
    assert sorted((r["k"], r[f"c{r['k']}"]) for r in df.collect()) == sorted((str(i), f"v{i}") for i in range(12))


def test_two_tables_are_loaded(spark, scratch):
    from ledgerlens.plans import refresh

    head = ",".join(f'"{n}"' for n in LD.DEFAULT_MAPPING)
    land(f"{scratch}/a", {"x.csv": f"{head}\n13/01/2024,1,p,2.5,s\n"})
    land(f"{scratch}/b", {"x.csv": f"{head}\n7.1.2024,2,p,3.5,s\nnever,3,p,1,s\n"})
    out = refresh.load_landing_tables(spark, {f"{scratch}/one": f"{scratch}/a", f"{scratch}/two": f"{scratch}/b"}, f"{scratch}/rejects")
    assert out == {f"{scratch}/one": {"written": 1, "rejected": 0}, f"{scratch}/two": {"written": 1, "rejected": 1}}
    got = [spark.read.parquet(f"{scratch}/{t}").first() for t in ("one", "two")]
    assert [(r.date_created, r.account_id, r.total) for r in got] == [(D(2024, 1, 13), 1, 2.5), (D(2024, 7, 1), 2, 3.5)]
