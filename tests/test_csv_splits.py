"""Files in many splits against the reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from prosopon.sources.csv_splits import csv_lines, csv_split_scan
from prosopon.sources.files import CSV_COLUMNS, csv_scan

HEAD = "name,email,phone,current_company,title\n"
FIXED = {
    "plain": HEAD + "".join(f"n{i},e{i}@x.org,{i},c,t\n" for i in range(60)),
    "quoted newlines": HEAD + "".join(f'"n{i}\nsecond ""line""\r\nthird","e,{i}",{i},c,t\n' for i in range(40)),
    "blank and short": HEAD + "\n\na\n\r\nb,c\n\nd,e,f,g,h,i,j\n" * 9 + "last",
    "quotes inside": HEAD + 'a"b,c"",""d,"e"f"g,\n" x",y"\n"z"",q",r\n' * 12,
    "returns": HEAD.replace("\n", "\r\n") + "a,b\rc,d\r\n\re,\"f\rg\"\r\n" * 11,
    "open": HEAD + "a,b\n" * 9 + 'c,"never closed\n' + "x,y\n" * 30,
    "long field": HEAD + 'a,"' + "line of a long field\n" * 60 + '",z\nb,c\n',
    "one quote a line": HEAD + '"\n' * 31 + "a,b\n",
    "mark": "﻿" + HEAD + "ä,ö\n" * 20,
    "twice": "name,name,email\n" + "a,b,c\nd\ne,f\n" * 15,
    "unknown": "foo,bar\n" + "1,2\n" * 10,
    "blank head": "\n" + HEAD + "a,b\n",
    "empty": "",
    "head only": HEAD,
    "quoted head": '"name","email\nx","email"\n' + "a,b,c\n" * 20,
    "above the limit": HEAD + "a,b\n" * 4 + "x" * 140_000 + ",y\n" + "c,d\n" * 5,
    "above the limit, quoted": HEAD + 'a,"' + ("y" * 999 + "\n") * 140 + '"\nc,d\n',
}


def random_file(rng):
    return HEAD + "".join(rng.choices(['"', '""', ",", "\n", "\r\n", "\r", "a", "bc", " ", "é", '"x\ny"', '",'], k=rng.randrange(1, 200)))


@pytest.mark.parametrize("size", [37, 300, 1 << 20])
def test_splits_give_what_whole_files_give(spark, tmp_path, size):
    rng = random.Random(size)
    texts = list(FIXED.values()) + [random_file(rng) for _ in range(25)]
    names = list(FIXED) + [f"random {k}" for k in range(25)]
    if size < 100:  # these would be thousands of splits
        texts, names = zip(*((t, n) for t, n in zip(texts, names) if not n.startswith("above")))
    paths = [str(tmp_path / f"{k} +{n}.csv".replace(" ", "_" if k % 2 else " ")) for k, n in enumerate(names)]
    for p, t in zip(paths, texts):
        open(p, "w", encoding="utf-8", newline="").write(t)
    ordered = [(k, p, p.rsplit("/", 1)[-1]) for k, p in enumerate(paths)]
    files = spark.createDataFrame(ordered, "file_ord int, given string, name string")
    whole = csv_scan(spark.createDataFrame([(k, n, bytearray(open(p, "rb").read())) for k, p, n in ordered], "file_ord int, name string, content binary"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = csv_lines(spark, files, paths).cache()
        n = lines.select("file_ord", "start").distinct().count()
        got = csv_split_scan(lines, files, CSV_COLUMNS)
        rows = lambda df: sorted((tuple(r) for r in df.select("file_ord", "ok", "pos", *(f"c_{c}" for c in CSV_COLUMNS)).collect()), key=repr)
        mine, theirs = rows(got), rows(whole)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert size > 1000 or n > 3 * len(paths)
    assert mine == theirs
    errors = lambda df: {(r["file_ord"], r["error"]) for r in df.where("NOT ok").collect()}
    assert errors(got) == errors(whole)


def test_not_utf8_and_no_files(spark, tmp_path):
    p = str(tmp_path / "a.csv")
    open(p, "wb").write(HEAD.encode() + b"a,b\n" * 50 + b"\xff,c\n" + b"a,b\n" * 50)
    files = spark.createDataFrame([(0, p, "a.csv")], "file_ord int, given string, name string")
    (r,) = csv_split_scan(csv_lines(spark, files, [p]), files, CSV_COLUMNS).collect()
    assert not r["ok"] and r["error"] == "failed to read CSV: not valid UTF-8"
    none = csv_lines(spark, files, [p]).where(F.lit(False))
    assert csv_split_scan(none, files.limit(0), CSV_COLUMNS).collect() == []
