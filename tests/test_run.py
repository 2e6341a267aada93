"""Whole runs over small files of every kind, good and bad."""

import contextlib
import json
import zlib
from pathlib import Path

import pytest

from prosopon import cli
from prosopon.plans.paths import Token, tokenize
from prosopon.plans.run import from_files, run_partials
from prosopon.plans.shape import DEFAULT_CONFIG, load_config, parse_config
from prosopon.sources.pdf import extract_text


@pytest.fixture(scope="module")
def samples(tmp_path_factory):
    d = tmp_path_factory.mktemp("samples")
    (d / "a.json").write_text(json.dumps({"candidates": [
        {"candidate_name": "Ann Ray", "contact_email": "ANN@x.org", "mobile_number": "+1 415 222 0142", "employer": "Initech", "job_title": "Engineer", "city": " Paris ", "state": None, "country_name": "France", "skill_tags": ["postgres", "Docker"]},
        {"candidate_name": "", "contact_email": "only@x.org", "mobile_number": "nope", "skill_tags": []},
        {"candidate_name": "", "contact_email": ""}, "odd",
    ]}))
    (d / "b.csv").write_text("name,email,phone,current_company,title\nAnn  Ray,ann@x.org,(415) 222-0142,Initech,engineer\nBob Lee,b1@x.org,+1 628 555 0110,A,B\nBob Lee,b2@x.org,+1 917 555 0133,C,D\n,,1,2,3\nCarl Solo,,,,\n")
    (d / "bad.csv").write_text("nothing,known\n1,2\n")
    (d / "bad.json").write_text('{"candidates": [')
    (d / "wrong.json").write_text('{"candidates": [{"candidate_name": "X Y", "contact_email": 5}]}')
    (d / "n.txt").write_text("Ann, 2026-06-18: mail ann@x.org. Likes kubernetes and some python.\n")
    (d / "scan.pdf").write_bytes(b"%PDF")
    (d / "x.docx").write_text("?")
    return d


@pytest.fixture(scope="module")
def report(spark, samples):
    return from_files(spark, sorted(str(p) for p in samples.iterdir()), DEFAULT_CONFIG)


def test_records(report):
    docs = [json.loads(r["document"]) for r in report.candidates.orderBy("cluster_ord").collect()]
    assert [d["full_name"] for d in docs] == ["Ann Ray", None, "Bob Lee", "Bob Lee", "Carl Solo"]
    ann = docs[0]
    assert ann["emails"] == ["ann@x.org"]
    assert ann["location"] == {"city": "Paris", "region": None, "country": "FR"}
    assert [s["name"] for s in ann["skills"]] == ["PostgreSQL", "Docker", "Python", "Kubernetes"]
    assert len(ann["experience"]) == 1 and ann["experience"][0]["title"] == "Engineer"
    assert {p["confidence"] for p in ann["provenance"] if p["field"] == "emails[0]"} == {1.0}
    assert all(0 <= d["overall_confidence"] <= 1 for d in docs)
    assert list(ann) == ["full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education", "overall_confidence", "provenance"]


def test_errors(report, samples):
    rows = report.source_errors.collect()
    assert all(r["path"].startswith(str(samples)) for r in rows)
    got = {(r["path"].rsplit("/", 1)[-1], r["stage"]) for r in rows}
    assert got == {("bad.csv", "load"), ("bad.json", "load"), ("wrong.json", "parse"), ("scan.pdf", "load"), ("x.docx", "load")}
    assert report.metrics()["candidates_in_output"] == 5


def test_order_of_input_does_not_matter(spark, report):
    """Another order of rows in the frame gives the same clusters."""
    from prosopon.operators.resolve import resolve

    a = {tuple(r) for r in resolve(report.partials).select("rec_ord", "cluster_ord").collect()}
    b = {tuple(r) for r in resolve(report.partials.repartition(3, "source_id").orderBy("source_id", ascending=False)).select("rec_ord", "cluster_ord").collect()}
    assert a == b


def test_example_config(report):
    r = run_partials(report.partials, report.source_errors, load_config(str(Path(__file__).resolve().parent.parent / "configs" / "directory_entry.json")))
    d = json.loads(r.candidates.orderBy("cluster_ord").head()["document"])
    assert list(d) == ["person", "town", "employer", "tools", "provenance"]
    assert d["person"] == "Ann Ray" and d["town"] == "Paris" and d["employer"] == "Initech" and d["tools"][0] == "PostgreSQL"


def _pdf(lines, pack=False, hexed=False):
    """A small PDF of one page. pack: pressed, with the other objects in an object stream. hexed: a font with a ToUnicode map."""
    show = lambda x: "<" + "".join(f"{ord(c):04x}" for c in x) + ">" if hexed else "(" + x.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)") + ")"
    code = ("BT /F1 11 Tf 14 TL 72 720 Td " + " ".join(f"{show(x)} Tj T*" for x in lines) + " ET").encode("cp1252")
    cmap = b"1 begincodespacerange <0000> <ffff> endcodespacerange 1 beginbfrange <0020> <ffff> <0020> endbfrange"
    body = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [3 0 R] /Count 1 /Resources << /Font << /F1 4 0 R >> >> >>", 3: b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>",
        4: b"<< /Type /Font /Subtype /Type0 /ToUnicode 6 0 R >>" if hexed else b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>",
    }

    def stream(raw, extra=b""):
        raw, how = (zlib.compress(raw), b"/Filter /FlateDecode ") if pack else (raw, b"")
        return b"<< " + extra + how + b"/Length %d >>\nstream\n%s\nendstream" % (len(raw), raw)

    out = {5: stream(code), 6: stream(cmap)}
    if pack:
        at, heads = 0, []
        for k, v in body.items():
            heads.append(b"%d %d" % (k, at))
            at += len(v) + 1
        head = b" ".join(heads) + b" "
        out[7] = stream(head + b" ".join(body.values()), b"/Type /ObjStm /N %d /First %d " % (len(body), len(head)))
    else:
        out |= body
    return b"%PDF-1.5\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % kv for kv in out.items()) + b"\ntrailer << /Root 1 0 R >>\n%%EOF"


RESUME = [
    "Zoe (Z.) Quill", "zoe@x.org | +44 20 7946 0958", "HEADLINE", "Builds things", "EXPERIENCE", "Initech -- Engineer", "Jan 2020 - Present", "Made it work",
    "EDUCATION", "MIT -- BSc Physics, 2019", "SKILLS", "Python, Go",
]


@pytest.mark.parametrize("how", [{}, {"pack": True}, {"hexed": True}, {"pack": True, "hexed": True}])
def test_text_of_pdfs(how):
    assert extract_text(_pdf(RESUME, **how)).split("\n") == RESUME
    for bad in (b"", b"%PDF", b"%PDF-1.4 1 0 obj << /Encrypt 2 0 R >> endobj", b"no pdf at all"):
        with contextlib.suppress(ValueError):
            assert extract_text(bad) == ""


def test_resume_through_the_command_line(spark, tmp_path):
    (tmp_path / "cv.pdf").write_bytes(_pdf(RESUME, pack=True))
    (tmp_path / "scanned.pdf").write_bytes(_pdf([]))
    out = tmp_path / "out.json"
    assert cli.main(["--dir", str(tmp_path), "--output", str(out)], spark) == 0
    doc = json.loads(out.read_text())
    (zoe,) = doc["candidates"]
    assert zoe["full_name"] == "Zoe (Z.) Quill" and zoe["emails"] == ["zoe@x.org"] and zoe["phones"] == ["+442079460958"] and zoe["headline"] == "Builds things"
    assert zoe["experience"] == [{"company": "Initech", "title": "Engineer", "start": "2020-01", "end": None, "summary": "Made it work"}]
    assert zoe["education"][0]["institution"] == "MIT" and zoe["education"][0]["end_year"] == 2019 and [s["name"] for s in zoe["skills"]] == ["Python", "Go"]
    assert [(e["path"].rsplit("/", 1)[-1], e["message"]) for e in doc["run_metadata"]["source_errors"]] == [("scanned.pdf", "no usable text extracted")]


def test_command_line(spark, samples, tmp_path, capsys):
    out = tmp_path / "deep" / "out.json"
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"fields": [{"path": "full_name"}], "include_provenance": False}))
    assert cli.main(["--dir", str(samples), "--config", str(config), "--output", str(out)], spark) == 0
    doc = json.loads(out.read_text())
    assert len(doc["candidates"]) == 5 and doc["run_metadata"]["partial_records_loaded"] == 7
    assert out.read_text() == json.dumps(doc, indent=2, ensure_ascii=False) + "\n"
    assert [len(doc["run_metadata"][k]) for k in ("source_errors", "candidate_errors")] == [4, 0]
    assert cli.scan_directories(spark, [str(tmp_path / "none")]) == []
    assert cli.scan_directories(spark, [f"file://{samples}/"]) == [f"file://{samples}/{x}" for x in ("a.json", "b.csv", "bad.csv", "bad.json", "n.txt", "scan.pdf", "wrong.json")]
    assert cli.main(["--files", str(samples / "bad.csv"), str(samples / "bad.json"), "--config", str(config), "--no-metadata"], spark) == 1
    assert cli.main(["--files", "x.csv", "--config", str(tmp_path / "none.json")], spark) == 1
    with pytest.raises(SystemExit):
        cli.main([], spark)


def test_paths():
    k = lambda v: Token("key", v)
    assert tokenize("a..b[0].c[]") == [k("a"), k("b"), Token("index", 0), k("c"), Token("each")]
    assert tokenize("emails[-1]") == [k("emails")]
    assert tokenize("") == []


def test_configs(tmp_path):
    c = parse_config({"_comment": "x", "fields": [{"path": "a", "from": "b", "required": True}]})
    assert c.fields[0].source_path == "b" and c.on_missing == "null" and c.include_confidence
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "no.json"))
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(ValueError):
        load_config(str(tmp_path / "bad.json"))


def test_components_of_a_chain(spark):
    from prosopon.operators.components import connected_components

    edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 100 != 99] + [(7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {i: i // 100 * 100 for i in range(300)}
    assert connected_components(edges.limit(0)).count() == 0


def test_components_with_hot_roots(spark):
    """A star, a star of stars and small components, with hot roots looked up apart; the same as without."""
    from prosopon.operators.components import connected_components

    star = [(0, i) for i in range(1, 3000)]
    nested = [(10_000 + 100 * i, 10_000 + 100 * i + k) for i in range(30) for k in range(1, 60)] + [(10_050 + 100 * i, 10_100 + 100 * i) for i in range(29)]
    pairs = [(50_000 + 2 * i, 50_001 + 2 * i) for i in range(200)]
    edges = spark.createDataFrame([(b, a) if (a + b) % 3 else (a, b) for a, b in star + nested + pairs], "a long, b long")
    want = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    got = {r["node"]: r["component"] for r in connected_components(edges, least=100).collect()}
    assert got == want
    assert {got[i] for i in range(3000)} == {0} and {v for k, v in got.items() if 10_000 <= k < 50_000} == {10_000}
    assert all(got[50_001 + 2 * i] == 50_000 + 2 * i for i in range(200))


def test_hot_keys_are_spread(spark):
    """A key of half the rows: the same join, no task with more than twice the rows of the median one."""
    from pyspark.sql import functions as F

    from prosopon.operators.durable import write_table
    from prosopon.operators.hot import Lookups

    rows = write_table(spark.range(200_000, numPartitions=8).select("id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 1001 != 0, F.col("id") % 5000).alias("k")), "rows")
    table = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    look = Lookups(least=10_000)
    hot = look.hot_keys(rows, "k")
    assert [r["k"] for r in hot.collect()] == [7]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = look.left(rows, "k", table, hot)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert out.exceptAll(rows.join(table, "k", "left").select(out.columns)).count() == 0 and out.count() == 200_000
    look.drop()
    assert Lookups().hot_keys(rows.limit(10), "k") is None


def test_stream_of_notes(spark, tmp_path):
    from prosopon.streaming.notes import note_stream, write_stream

    src = tmp_path / "in"
    spark.createDataFrame([("n1", "mail a@b.org"), ("n2", " ")], "name string, text string").write.parquet(str(src))
    s = note_stream(spark.readStream.schema("name string, text string").parquet(str(src)))
    write_stream(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r["emails"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [["a@b.org"]]


def test_resumes_are_taken_apart_once(spark, sf_dir):
    """The optimizer copies expressions into the filters it pushes down; the sections were computed anew for every use of a line."""
    from prosopon import adapters
    from prosopon.sources import partials

    p = partials.numbered([partials.resume_partials(adapters.resumes(spark, sf_dir))]).select("rec_ord", "experience").where("size(experience) > 0")
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("x0c") <= 4  # the pattern of line breaks
    assert p.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_records_are_fused_in_small_plans(spark, sf_dir):
    """A plan of all fields at once took the driver's memory."""
    from prosopon import adapters
    from prosopon.operators.durable import write_table
    from prosopon.operators.fuse import canonical
    from prosopon.operators.resolve import resolve

    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    clustered = write_table(resolve(adapters.partials(spark, sf_dir)), "clustered")
    between = store.executionsCount()
    records = canonical(clustered)
    plans = [store.execution(i).get().physicalPlanDescription() for i in range(between, store.executionsCount())]
    assert between > before and len(plans) >= 8
    assert max(map(len, plans)) < 150_000
    assert records._written_to and records.count() == clustered.select("cluster_ord").distinct().count()


def test_records_are_not_broadcast(spark, sf_dir, monkeypatch):
    """Files of numbers are so compact that Spark's estimate let the driver broadcast a million rows of the components and look-ups."""
    from pyspark.sql import functions as F

    from prosopon import adapters
    from prosopon.operators import resolve
    from prosopon.operators.components import connected_components
    from prosopon.operators.durable import write_table

    store = spark._jsparkSession.sharedState().statusStore()

    def plans(after):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        known = store.executionsList()
        every = [known.apply(i) for i in range(known.size())]
        return {x.executionId(): x.physicalPlanDescription() for x in every if x.executionId() > after}

    p = write_table(adapters.partials(spark, sf_dir), "partials")
    label = write_table(connected_components(resolve.identity_edges(p)), "given")
    want = sorted(map(tuple, resolve.resolve(p).select("rec_ord", "cluster_ord").collect()))

    before = max(plans(-1))
    links = connected_components(spark.range(1000).select((2 * F.col("id")).alias("a"), (2 * F.col("id") + 1).alias("b")), least=1000)
    assert {(r["node"], r["component"]) for r in links.collect()} == {(k, k // 2 * 2) for k in range(2000)}
    write_table(resolve.identity_edges(p), "links")
    monkeypatch.setattr(resolve, "connected_components", lambda edges: label)
    got = sorted(map(tuple, resolve.resolve(p).select("rec_ord", "cluster_ord").collect()))
    ran = plans(before)
    assert got == want and sum("SortMergeJoin" in x for x in ran.values()) >= 5
    assert not [x for x in ran.values() if "BroadcastExchange" in x]

    plan = adapters.records(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 2  # nations and regions, not customers


def test_read_directory(spark, tmp_path):
    """Known files directly in a folder, by name, in few tasks however many there are."""
    from prosopon.sources import files

    for k in range(300):
        (tmp_path / f"n{k:03d}.txt").write_text(f"note {k}")
    (tmp_path / "odd.docx").write_text("?")
    found = files.read_directory(spark, f"file://{tmp_path}")
    rows = files.text_scan(found).orderBy("file_ord").collect()
    assert [r["text"] for r in rows] == [f"note {k}" for k in range(300)]
    assert rows[0]["path"] == f"{tmp_path}/n000.txt" and len({r["file_ord"] for r in rows}) == 300
