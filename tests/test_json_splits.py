"""Documents in many splits against the reader of whole documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from prosopon.sources.files import json_scan, text_scan
from prosopon.sources.json_splits import json_parts, json_split_scan

ROW = {"candidate_name": 'A "quoted" } name]', "contact_email": "a\\b{@x.org", "skill_tags": ["Go", {"deep": [[]]}, "\\\\", '\\"'], "n": 1.5}
ROWS = [{**ROW, "k": k} for k in range(25)]
GOOD = json.dumps({"candidates": ROWS})
FIXED = {
    "plain": GOOD,
    "indented": json.dumps({"candidates": ROWS}, indent=3) + "\n\n",
    "others": json.dumps({"a": [1, "]", {"b": [2]}], "m": {"candidates": [3, {"x": []}]}, "candidates": ROWS, "z": [[], {}, "x"], "e": []}),
    "kinds": '{"candidates": [1, null, "}", "a,b", [1, [2, "]"]], {}, true, -1.5e3, "\\"", "\\\\", "é ü 日本 \\u00e9"]}',
    "empty list": '{"candidates": [  \n ]}',
    "empty lists": '{"x": [], "candidates": [], "y": []}',
    "list last": '{"candidates": [{"a": "}}}}}}}}}}}}}}}}}}}}}}}}}}"}], "candidate": {"candidates": [5]}}',
    "number": '{"candidates": 1}',
    "object": '{"candidates": {"a": [1, 2]}}',
    "none": '{"other": [1, 2, {"a": 3}]}',
    "top list": '[{"candidates": [1, {"a": 2}]}, {"b": 3}]',
    "scalar": "5",
    "empty": "",
    "blank": " \n ",
    "cut": GOOD[:-2],
    "cut in string": GOOD[: len(GOOD) // 2 - 3] + '"',
    "cut after brace": GOOD[: GOOD.rindex("}]}") + 1],
    "late": GOOD[:-4] + ",}]}",
    "missing comma": GOOD.replace('}, {"candidate_name"', '} {"candidate_name"', 1),
    "two commas": GOOD.replace('}, {"candidate_name"', '},, {"candidate_name"', 1),
    "last comma": '{"candidates": [1, 2,]}',
    "first comma": '{"candidates": [,1]}',
    "only comma": '{"candidates": [,]}',
    "fault in other": '{"candidates": [1], "other": [{"a": tru}]}',
    "mixed brackets": '{"candidates": [{"a": 1]}, 2}',
    "backslash outside": '{"candidates": [1, \\"a", 2, "b"]}',
    "backslash brace": '{"candidates": ["a\\}", 2]}',
    "closed twice": GOOD + "}",
    "zero": '{"candidates\x00": [\x00], "candidates": [1]}',
    "twice": '{"candidates": [1], "candidates": [2, 3]}',
    "entry twice": '{"candidates": [{"a": 1, "a": 2}]}',
    "mark": "﻿" + GOOD,
    "no key": '{"candidates": [1], [2]}',
}


def random_document(rng):
    text = json.dumps({"a": rng.choice([[], [1, "x}"], {"b": "]"}]), "candidates": rng.choices([ROW, 1, "}", [], {}, None, "a\\"], k=rng.randrange(9))}, indent=rng.choice([None, 1]))
    for _ in range(rng.choice([0, 0, 1, 2])):
        k = rng.randrange(len(text))
        text = text[:k] + rng.choice(["", '"', "}", "{", "[", "]", ",", "\\", " "]) + text[k + 1 :]
    return text


@pytest.mark.parametrize("size", [23, 400, 1 << 20])
def test_splits_give_what_whole_documents_give(spark, tmp_path, size):
    rng = random.Random(size)
    names = list(FIXED) + [f"random {k}" for k in range(60)]
    texts = list(FIXED.values()) + [random_document(rng) for _ in range(60)]
    if size < 100:  # these would be thousands of splits
        names, texts = zip(*((n, t) for n, t in zip(names, texts) if len(t) < 1000))
    paths = [str(tmp_path / f"{k} +{n}.json".replace(" ", "_" if k % 2 else " ")) for k, n in enumerate(names)]
    for p, t in zip(paths, texts):
        open(p, "w", encoding="utf-8", newline="").write(t)
    ordered = [(k, p, n) for k, (p, n) in enumerate(zip(paths, names))]
    files = spark.createDataFrame(ordered, "file_ord int, given string, name string")
    whole = json_scan(text_scan(spark.createDataFrame([(k, n, bytearray(t.encode())) for k, (n, t) in enumerate(zip(names, texts))], "file_ord int, name string, content binary")))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        parts = json_parts(spark, files, paths).cache()
        n = parts.select("file_ord", "start").distinct().count()
        got = json_split_scan(parts, files)
        state = lambda df: sorted((tuple(r) for r in df.select("name", "ok", "error").collect()), key=repr)
        rows = lambda df: sorted((tuple(r) for r in df.select("name", "pos", F.to_json("e")).collect()), key=repr)
        assert state(got.where("pos IS NULL")) == state(whole)
        assert rows(got.where("pos IS NOT NULL")) == rows(whole.where("ok").select("name", F.posexplode("entries").alias("pos", "e")))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert size > 1000 or n > 2 * len(paths)


def test_not_utf8_and_no_files(spark, tmp_path):
    p = str(tmp_path / "a.json")
    open(p, "wb").write(b'{"candidates": [{"a": 1}, "\xff"]}')
    files = spark.createDataFrame([(0, p, "a.json")], "file_ord int, given string, name string")
    (r,) = json_split_scan(json_parts(spark, files, [p]), files).collect()
    assert not r["ok"] and r["error"] == "failed to decode as UTF-8"
    assert json_split_scan(json_parts(spark, files, [p]).where(F.lit(False)), files.limit(0)).collect() == []
