"""One query for each operator, over the driver's tables, and the SQL that it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosopon import adapters
from prosopon.functions import phones, scoring, text
from prosopon.operators import checks, fuse, resolve
from prosopon.operators.durable import shared_dir, write_table
from prosopon.plans import run as plan
from prosopon.plans.shape import DEFAULT_CONFIG, Config, Field, project, projected_columns
from prosopon.sources import csv_splits, files, json_splits, partials

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_kept: dict[tuple[str, str, str], DataFrame] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _once(what: str, spark: SparkSession, sf_dir: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What several queries share is written once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _clustered(spark, sf_dir):
    return _once("clustered", spark, sf_dir, lambda: write_table(resolve.resolve(adapters.partials(spark, sf_dir)), "clustered"))


def _records(spark, sf_dir):
    return _once("records", spark, sf_dir, lambda: fuse.canonical(_clustered(spark, sf_dir)))


# ---- scalar functions -------------------------------------------------------------------------------------------------


def _scalar(table: str, key: str, raw: str, f: Callable[[Column], Column], spark, sf_dir) -> DataFrame:
    """raw: SQL of the input; the same text stands in the oracle."""
    return _t(spark, sf_dir, table).select(key, F.expr(raw).alias("raw")).select(key, f(F.col("raw")).alias("value"))


_NAME = "CASE p_partkey % 6 WHEN 0 THEN concat('  ', p_name, ' \t', p_brand, '  ') WHEN 1 THEN '   ' WHEN 2 THEN NULL ELSE p_name END"
_STRIP = lambda x: f"trim({x}, ' \t\n\r')"


@query(f"SELECT p_partkey, nullif(regexp_replace({_STRIP(_NAME)}, '\\s+', ' ', 'g'), '') AS value FROM part")
def normalize_name(spark, sf_dir):
    return _scalar("part", "p_partkey", _NAME, text.normalize_name, spark, sf_dir)


@query(f"SELECT p_partkey, nullif(lower(regexp_replace({_STRIP(_NAME)}, '\\s+', ' ', 'g')), '') AS value FROM part")
def name_key(spark, sf_dir):
    return _scalar("part", "p_partkey", _NAME, text.name_key, spark, sf_dir)


@query(f"SELECT p_partkey, CASE WHEN x IS NULL THEN 'candidate' ELSE coalesce(nullif(trim(regexp_replace(lower(x), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'candidate') END AS value FROM (SELECT p_partkey, {_NAME} AS x FROM part)")
def slugify(spark, sf_dir):
    return _scalar("part", "p_partkey", _NAME, text.slugify, spark, sf_dir)


_EMAIL = "CASE o_orderkey % 5 WHEN 0 THEN concat(' User', CAST(o_custkey AS string), '@Example.COM ') WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE concat('a', CAST(o_orderkey AS string), '@b.org') END"


@query(f"SELECT o_orderkey, nullif(lower({_STRIP(_EMAIL)}), '') AS value FROM orders")
def email_key(spark, sf_dir):
    return _scalar("orders", "o_orderkey", _EMAIL, text.email_key, spark, sf_dir)


_PHONE = (
    "CASE o_orderkey % 6 WHEN 0 THEN concat('+1 (415) 2', lpad(CAST(o_custkey AS string), 6, '0')) WHEN 1 THEN concat('9', lpad(CAST(o_custkey AS string), 9, '0')) "
    "WHEN 2 THEN '12-34' WHEN 3 THEN 'not-a-number' WHEN 4 THEN NULL ELSE concat('0044 2', lpad(CAST(o_custkey AS string), 9, '0')) END"
)


@query(f"SELECT o_orderkey, CASE WHEN length(d) >= 7 THEN right(d, 10) END AS value FROM (SELECT o_orderkey, regexp_replace({_PHONE}, '[^0-9]', '', 'g') AS d FROM orders)")
def phone_key(spark, sf_dir):
    return _scalar("orders", "o_orderkey", _PHONE, text.phone_key, spark, sf_dir)


@query(
    "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN concat('+14152', lpad(CAST(o_custkey AS string), 6, '0')) WHEN 1 THEN concat('+919', lpad(CAST(o_custkey AS string), 9, '0')) "
    "WHEN 5 THEN concat('+442', lpad(CAST(o_custkey AS string), 9, '0')) END AS value FROM orders"
)
def normalize_phone(spark, sf_dir):
    return _scalar("orders", "o_orderkey", _PHONE, phones.normalize_phone, spark, sf_dir)


#: The published example of a mobile number for each of these countries, as calling code and national number.
_EXAMPLES = (
    "55 11961234567", "7 9123456789", "27 711234567", "52 2221234567", "54 91123456789", "56 221234567", "57 3211234567", "51 912345678", "58 4121234567", "20 1001234567",
    "234 8021234567", "254 712123456", "233 231234567", "212 650123456", "213 551234567", "216 20123456", "90 5012345678", "966 512345678", "971 501234567", "972 502345678",
    "92 3012345678", "880 1812345678", "94 712345678", "977 9841234567", "66 812345678", "84 912345678", "60 123456789", "62 812345678", "63 9051234567", "82 1020000000",
    "81 9012345678", "86 13123456789", "852 51234567", "886 912345678", "64 211234567", "48 512345678", "420 601123456", "46 701234567", "47 40612345", "45 32123456",
    "358 412345678", "351 912345678", "30 6912345678", "41 781234567", "43 664123456", "32 470123456", "36 201234567", "40 712034567", "380 501234567", "359 43012345",
    "33 612345678", "49 15123456789", "39 3123456789", "34 612345678", "31 612345678", "61 412345678", "65 81234567", "353 850123456", "44 7400123456", "91 8123456789", "1 2015550123",
)
_EXAMPLE = f"{{}}([{', '.join(repr(x) for x in _EXAMPLES)}], CAST(1 + o_orderkey % {len(_EXAMPLES)} AS int))"


@query(
    f"SELECT o_orderkey, CASE o_orderkey % 7 WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE concat('+', replace({_EXAMPLE.format('list_extract')}, ' ', '')) END AS value FROM orders"
)
def normalize_phone_world(spark, sf_dir):
    """Numbers of 61 calling codes: plain, with spaces, after 00, with a trunk 0 and with an extension; too short and too long ones are null."""
    x = _EXAMPLE.format("element_at").replace("[", "array(").replace("]", ")")
    code, rest = f"substring_index({x}, ' ', 1)", f"substring_index({x}, ' ', -1)"
    raw = (
        f"CASE o_orderkey % 7 WHEN 0 THEN concat('+', {x}) WHEN 1 THEN concat(' 00', {code}, '-', {rest}) WHEN 2 THEN concat('+', {code}, ' ', left({rest}, 3), ' ', substring({rest}, 4)) "
        f"WHEN 3 THEN concat('+', {x}, ' ext. 12') WHEN 4 THEN concat('+', {code}, CASE WHEN {code} IN ('1', '7', '39') THEN ' ' ELSE ' (0)' END, {rest}) WHEN 5 THEN concat('+', {code}, ' ', left({rest}, 2)) ELSE concat('+', {x}, '123456') END"
    )
    return _scalar("orders", "o_orderkey", raw, phones.normalize_phone, spark, sf_dir)


_DATE = (
    "CASE o_orderkey % 9 WHEN 0 THEN concat(' Mar ', CAST(2000 + o_orderkey % 20 AS string), '.') WHEN 1 THEN concat('september ', CAST(2000 + o_orderkey % 20 AS string)) "
    "WHEN 2 THEN concat(CAST(2000 + o_orderkey % 20 AS string), '-', lpad(CAST(o_orderkey % 99 AS string), 2, '0')) WHEN 3 THEN CAST(2000 + o_orderkey % 20 AS string) "
    "WHEN 4 THEN 'Present' WHEN 5 THEN 'Foo 2010' WHEN 6 THEN '' WHEN 7 THEN NULL ELSE concat('Dec. ', CAST(2000 + o_orderkey % 20 AS string)) END"
)


@query(
    "SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN concat(CAST(2000 + o_orderkey % 20 AS string), '-03') WHEN 1 THEN concat(CAST(2000 + o_orderkey % 20 AS string), '-09') "
    "WHEN 2 THEN concat(CAST(2000 + o_orderkey % 20 AS string), '-', lpad(CAST(o_orderkey % 99 AS string), 2, '0')) WHEN 3 THEN CAST(2000 + o_orderkey % 20 AS string) "
    "WHEN 8 THEN concat(CAST(2000 + o_orderkey % 20 AS string), '-12') END AS value FROM orders"
)
def normalize_date(spark, sf_dir):
    return _scalar("orders", "o_orderkey", _DATE, text.normalize_date, spark, sf_dir)


_SKILL = "CASE p_partkey % 8 WHEN 0 THEN ' js ' WHEN 1 THEN 'K8S' WHEN 2 THEN 'ab testing' WHEN 3 THEN 'o''neil a/b web3dev' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'Google Cloud' ELSE lower(p_brand) END"


@query(
    "SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'JavaScript' WHEN 1 THEN 'Kubernetes' WHEN 2 THEN 'A/B Testing' WHEN 3 THEN 'O''Neil A/B Web3Dev' WHEN 6 THEN 'GCP' "
    "WHEN 7 THEN concat(upper(left(p_brand, 1)), lower(substr(p_brand, 2))) END AS value FROM part"
)
def normalize_skill(spark, sf_dir):
    return _scalar("part", "p_partkey", _SKILL, text.normalize_skill, spark, sf_dir)


_COUNTRY = "CASE c_custkey % 7 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN 'uk' WHEN 3 THEN ' United States ' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'Netherlands' END"
_COUNTRY_OUT = (
    "CASE c_custkey % 7 WHEN 2 THEN 'UK' WHEN 3 THEN 'US' WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN 'NL' ELSE "
    "CASE lower(n_name) WHEN 'united states' THEN 'US' WHEN 'canada' THEN 'CA' WHEN 'united kingdom' THEN 'GB' WHEN 'india' THEN 'IN' WHEN 'germany' THEN 'DE' WHEN 'france' THEN 'FR' END END"
)


@query(f"SELECT c_custkey, {_COUNTRY_OUT} AS value FROM customer JOIN nation ON c_nationkey = n_nationkey")
def normalize_country(spark, sf_dir):
    j = _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", text.normalize_country(F.expr(_COUNTRY)).alias("value"))


@query(
    f"SELECT c_custkey, city, region, country, CASE WHEN city IS NULL AND region IS NULL AND country IS NULL THEN 0 ELSE 1 END AS present FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS city, "
    f"CASE WHEN c_custkey % 4 = 0 THEN c_name END AS region, {_COUNTRY_OUT} AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)"
)
def normalize_location(spark, sf_dir):
    j = _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    loc = F.struct(F.expr("CASE WHEN c_custkey % 3 = 0 THEN concat(' ', c_mktsegment, ' ') ELSE ' ' END").alias("city"), F.expr("CASE WHEN c_custkey % 4 = 0 THEN c_name END").alias("region"), F.expr(_COUNTRY).alias("country"))
    v = j.select("c_custkey", text.normalize_location(loc).alias("v"))
    return v.select("c_custkey", "v.city", "v.region", "v.country", F.col("v").isNotNull().cast("int").alias("present"))


# Unicode classes, since the extractors take letters and digits of any script.
_W = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"


@query(rf"SELECT doc_id, nullif(rtrim(regexp_extract(text, '{_W}.+-]+@{_W}-]+\.{_W}.-]+', 0), '.,;:)'), '') AS value FROM documents")
def extract_email(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.extract_email(F.col("text")).alias("value"))


@query(r"SELECT doc_id, trim(list_filter(regexp_extract_all(text, '(\+?\d[\d\-\s().]{7,}\d)', 1), lambda x: NOT regexp_full_match(x, '\d{4}-\d{2}-\d{2}'))[1]) AS value FROM documents")
def extract_phone(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.extract_phone(F.col("text"), skip_dates=True).alias("value"))


_VOCABULARY = ", ".join("'" + s + "'" for s in text.NOTE_SKILLS)


@query(f"SELECT doc_id, array_to_string(list_filter([{_VOCABULARY}], lambda x: contains(lower(text), lower(x))), '|') AS value FROM documents")
def extract_skills(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(text.extract_skills(F.col("text")), "|").alias("value"))


_METHOD = "CASE o_orderkey % 6 WHEN 0 THEN 'direct' WHEN 1 THEN 'regex' WHEN 2 THEN 'heuristic' WHEN 3 THEN 'merged' WHEN 4 THEN 'failed_normalize' ELSE 'other' END"
_TYPE = "CASE o_orderkey % 5 WHEN 0 THEN 'ats_json' WHEN 1 THEN 'csv' WHEN 2 THEN 'resume_pdf' WHEN 3 THEN 'recruiter_notes' ELSE 'other' END"


@query(
    "SELECT o_orderkey, floor(least(b * w + 0.1::DOUBLE * (o_orderkey % 4), 1::DOUBLE) * 1000 + 0.5) / 1000 AS value FROM (SELECT o_orderkey, "
    "CASE o_orderkey % 6 WHEN 0 THEN 0.9 WHEN 1 THEN 0.7 WHEN 2 THEN 0.5 WHEN 3 THEN 0.7 WHEN 4 THEN 0.1 ELSE 0.5 END::DOUBLE AS b, "
    "CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0.85 WHEN 3 THEN 0.7 ELSE 0.7 END::DOUBLE AS w FROM orders)"
)
def field_confidence(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", scoring.field_confidence(F.expr(_METHOD), F.expr(_TYPE), F.col("o_orderkey") % 4).alias("value"))


# ---- sources ----------------------------------------------------------------------------------------------------------


_PATH = "concat('dir.x/f', CAST(event_id AS string), CASE event_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.JSON' WHEN 2 THEN '.pdf' WHEN 3 THEN '.txt' WHEN 4 THEN '.docx' ELSE '' END)"


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'csv' WHEN 1 THEN 'ats_json' WHEN 2 THEN 'resume_pdf' WHEN 3 THEN 'recruiter_notes' END AS source_type FROM events")
def source_type_infer(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", files.infer_source_type(F.expr(_PATH)).alias("source_type"))


def _csv_files(spark, sf_dir):
    """One file for each nation; nation 4's has a header without any known column."""
    line = F.expr("concat('\"', c_name, '\",', CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('u', c_custkey, '@x.org') END, ',', 5550000 + c_custkey, ', ', c_mktsegment, ' ,')")
    line = F.when(F.col("c_custkey") % 13 == 0, F.lit(' ,,"1,2",x,y')).otherwise(line)
    g = _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))).alias("v"))
    head = F.when(F.col("c_nationkey") == 4, "foo,bar").otherwise("name,email,phone,current_company,title")
    body = F.array_join(F.transform("v", lambda x: x["line"]), "\n")
    return g.select(F.col("c_nationkey").alias("file_ord"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(".csv")).alias("name"), F.encode(F.concat(head, F.lit("\n"), body, F.lit("\n")), "UTF-8").alias("content"))


_CSV_ROWS = """(SELECT concat('n', c_nationkey, '.csv') AS file, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos, CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE c_name END AS n,
    CASE WHEN c_custkey % 13 = 0 OR c_custkey % 11 = 0 THEN '' ELSE concat('u', c_custkey, '@x.org') END AS e, CASE WHEN c_custkey % 13 = 0 THEN '1,2' ELSE CAST(5550000 + c_custkey AS VARCHAR) END AS p,
    CASE WHEN c_custkey % 13 = 0 THEN 'x' ELSE concat(' ', c_mktsegment, ' ') END AS c, CASE WHEN c_custkey % 13 = 0 THEN 'y' ELSE '' END AS t FROM customer WHERE c_nationkey <> 4)"""


@query(f"SELECT file, CAST(pos AS INTEGER) AS pos, n, e, p, c, t FROM {_CSV_ROWS}")
def csv_scan(spark, sf_dir):
    r = files.csv_scan(_csv_files(spark, sf_dir)).where("pos IS NOT NULL")
    return r.select(F.col("name").alias("file"), "pos", F.col("c_name").alias("n"), F.col("c_email").alias("e"), F.col("c_phone").alias("p"), F.col("c_current_company").alias("c"), F.col("c_title").alias("t"))


@query(
    f"SELECT concat('csv:', file, '#row=', pos + 2) AS source_id, nullif(trim(n), '') AS full_name, nullif(trim(e), '') AS email, nullif(trim(p), '') AS phone, nullif(trim(c), '') AS company, nullif(trim(t), '') AS title "
    f"FROM {_CSV_ROWS} WHERE trim(n) <> '' OR trim(e) <> ''"
)
def csv_partial(spark, sf_dir):
    p = partials.csv_partials(files.csv_scan(_csv_files(spark, sf_dir)))
    return p.select("source_id", "full_name", F.get("emails", F.lit(0)).alias("email"), F.get("phones", F.lit(0)).alias("phone"), F.get("experience", F.lit(0))["company"].alias("company"), F.get("experience", F.lit(0))["title"].alias("title"))


_ORDER_LINE = "concat(CASE WHEN o_orderkey % 7 = 0 THEN concat('\"', o_orderpriority, chr(10), 'and \"\"more\"\"\"') ELSE o_orderpriority END, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(',o', CAST(o_orderkey AS string), '@x.org') END, CASE WHEN o_orderkey % 3 = 0 THEN concat(chr(13), chr(10), chr(13)) ELSE '' END)"


def _order_files(spark, sf_dir):
    """Sixteen files written from the orders, by their keys: quoted line breaks, short rows, blank lines and carriage returns."""
    o = _t(spark, sf_dir, "orders").select((F.col("o_orderkey") % 16).cast("int").alias("part"), F.col("o_orderkey").alias("k"), F.expr(_ORDER_LINE).alias("value"))
    o = o.unionByName(o.select("part").distinct().select("part", F.lit(-1).cast("long").alias("k"), F.lit("title,email").alias("value")))
    folder = f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}"
    o.repartition("part").sortWithinPartitions("part", "k").select("part", "value").write.partitionBy("part").text(folder)
    found = spark.read.format("binaryFile").load(folder).select("path").distinct()
    found = found.select(F.col("path").alias("given"), F.regexp_extract("path", "part=([0-9]+)/", 1).alias("name"))
    return folder, write_table(found.select(F.col("name").cast("int").alias("file_ord"), "given", "name"), "order-files")


@query(
    "SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY k) - 1 AS INTEGER) AS pos, title, email FROM (SELECT CAST(o_orderkey % 16 AS VARCHAR) AS name, o_orderkey AS k, "
    "CASE WHEN o_orderkey % 7 = 0 THEN concat(o_orderpriority, chr(10), 'and \"more\"') ELSE o_orderpriority END AS title, CASE WHEN o_orderkey % 5 <> 0 THEN concat('o', o_orderkey, '@x.org') END AS email FROM orders)"
)
def csv_split_scan(spark, sf_dir):
    folder, found = _order_files(spark, sf_dir)
    r = csv_splits.csv_split_scan(csv_splits.csv_lines(spark, found, [folder]), found, files.CSV_COLUMNS).where("pos IS NOT NULL")
    return r.select("name", "pos", F.col("c_title").alias("title"), F.col("c_email").alias("email"))


def _document_files(spark, sf_dir):
    """Sixteen JSON files written from the documents, by their keys: whole texts, another list and braces in strings before them."""
    d = _t(spark, sf_dir, "documents").select(F.pmod("doc_id", F.lit(16)).cast("int").alias("part"), F.col("doc_id").alias("k"), F.concat(F.lit(","), F.to_json(F.struct("doc_id", "text"))).alias("value"))
    line = lambda k, text: d.select("part").distinct().select("part", F.lit(k).cast("long").alias("k"), F.lit(text).alias("value"))
    d = d.unionByName(line(-1, '{"about": {"list": ["}", "\\\\"]}, "other": [1, {"a": []}], "candidates": [null')).unionByName(line((1 << 63) - 1, "]}"))
    folder = f"{shared_dir(spark)}/documents-{uuid.uuid4().hex}"
    d.repartition("part").sortWithinPartitions("part", "k").select("part", "value").write.partitionBy("part").text(folder)
    found = spark.read.format("binaryFile").load(folder).select("path").distinct()
    found = found.select(F.col("path").alias("given"), F.regexp_extract("path", "part=([0-9]+)/", 1).alias("name"))
    return folder, write_table(found.select(F.col("name").cast("int").alias("file_ord"), "given", "name"), "document-files")


@query("SELECT CAST(doc_id % 16 AS VARCHAR) AS name, CAST(row_number() OVER (PARTITION BY doc_id % 16 ORDER BY doc_id) AS INTEGER) AS pos, doc_id, md5(text) AS text_md5 FROM documents")
def json_split_scan(spark, sf_dir):
    folder, found = _document_files(spark, sf_dir)
    r = json_splits.json_split_scan(json_splits.json_parts(spark, found, [folder]), found).where("pos > 0")
    return r.select("name", "pos", F.try_variant_get("e", "$.doc_id", "long").alias("doc_id"), F.md5(F.try_variant_get("e", "$.text", "string").cast("binary")).alias("text_md5"))


def _json_files(spark, sf_dir):
    """One document for each nation; nation 3's is cut off, 5's has no list, in 6's an email is a number."""
    entry = F.expr(
        "concat('{\"candidate_name\": \"', CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END, '\", \"contact_email\": ', CASE WHEN c_nationkey = 6 THEN '7' WHEN c_custkey % 10 = 0 THEN 'null' ELSE concat('\"e', c_custkey, '@x.org\"') END, "
        "', \"city\": \"', c_mktsegment, '\", \"skill_tags\": ', CASE WHEN c_custkey % 3 = 0 THEN '[]' ELSE '[\"Go\", \"\", null, 5]' END, '}')"
    )
    entry = F.when(F.col("c_custkey") % 17 == 0, F.lit('"not an object"')).otherwise(entry)
    g = _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", entry.alias("e")))).alias("v"))
    body = F.concat(F.lit('{"candidates": ['), F.array_join(F.transform("v", lambda x: x["e"]), ", "), F.lit("]}"))
    g = g.withColumn("body", body)
    cut = F.when(F.col("c_nationkey") == 3, F.expr("left(body, length(body) - 3)")).when(F.col("c_nationkey") == 5, '{"candidates": 1}').otherwise(F.col("body"))
    return g.select(F.col("c_nationkey").alias("file_ord"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(".json")).alias("name"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"), cut.alias("text"))


@query("SELECT concat('n', c_nationkey, '.json') AS file, c_nationkey NOT IN (3, 5) AS ok, CASE WHEN c_nationkey NOT IN (3, 5) THEN count(*) END::INTEGER AS n_entries FROM customer GROUP BY c_nationkey")
def json_scan(spark, sf_dir):
    return files.json_scan(_json_files(spark, sf_dir)).select(F.col("name").alias("file"), "ok", F.when(F.col("ok"), F.size("entries")).alias("n_entries"))


@query(
    "SELECT concat('ats_json:n', c_nationkey, '.json#entry=', pos) AS source_id, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS full_name, CASE WHEN c_custkey % 10 <> 0 THEN concat('e', c_custkey, '@x.org') END AS email, "
    "c_mktsegment AS city, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Go|5' END AS skills FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer WHERE c_nationkey NOT IN (3, 5, 6)) "
    "WHERE c_custkey % 17 <> 0 AND c_custkey % 10 <> 0"
)
def json_partial(spark, sf_dir):
    p = partials.json_partials(files.json_scan(_json_files(spark, sf_dir)))[0]
    return p.select("source_id", "full_name", F.get("emails", F.lit(0)).alias("email"), "location.city", F.array_join("skills", "|").alias("skills"))


def _texts(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("int").alias("file_ord"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.encode("text", "UTF-8").alias("content"))


@query("SELECT concat('d', doc_id, '.txt') AS file, true AS ok, CAST(length(text) AS INTEGER) AS n_chars FROM documents")
def text_scan(spark, sf_dir):
    return files.text_scan(_texts(spark, sf_dir)).select(F.col("name").alias("file"), "ok", F.length("text").alias("n_chars"))


@query(
    rf"SELECT concat('recruiter_notes:d', doc_id, '.txt') AS source_id, nullif(rtrim(regexp_extract(text, '{_W}.+-]+@{_W}-]+\.{_W}.-]+', 0), '.,;:)'), '') AS email, "
    rf"array_to_string(list_filter([{_VOCABULARY}], lambda x: contains(lower(text), lower(x))), '|') AS skills FROM documents WHERE trim(text, ' ' || chr(10)) <> ''"
)
def text_partial(spark, sf_dir):
    p = partials.note_partials(files.text_scan(_texts(spark, sf_dir)).where("ok"))
    return p.select("source_id", F.get("emails", F.lit(0)).alias("email"), F.array_join("skills", "|").alias("skills"))


@query("SELECT conv_id, turn, length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) >= 20 AS ok FROM conversations")
def pdf_text_gate(spark, sf_dir):
    return files.text_gate(_t(spark, sf_dir, "conversations").select("conv_id", "turn", "text")).select("conv_id", "turn", "ok")


@query("SELECT 'default_config.json' AS name, 'ats_json' AS source_type UNION ALL SELECT 'directory_entry.json', 'ats_json'")
def dir_listing(spark, sf_dir):
    return files.dir_listing(spark, f"file://{Path(__file__).resolve().parent.parent}/configs").select("name", "source_type")


@query("SELECT 'recruiter_notes' AS source_type, concat(s_suppkey, ' ', s_name) AS text FROM supplier UNION ALL SELECT 'ats_json', concat('{\"n\":', n_nationkey, '}') FROM nation")
def dir_scan(spark, sf_dir):
    """A folder with a note for each supplier, a document for each nation and files of no known kind: listed by name, read in that order."""
    folder = f"{shared_dir(spark)}/folder-{uuid.uuid4().hex}"
    # Files are made by all tasks, which put them in place themselves (version 2): the driver would rename them one by one.
    notes = _t(spark, sf_dir, "supplier").select(F.concat_ws(" ", "s_suppkey", "s_name").alias("value")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    notes.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).option("maxRecordsPerFile", 1).option("lineSep", " ").text(folder)
    _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n")).write.mode("append").option("maxRecordsPerFile", 1).option("lineSep", " ").json(folder)
    _t(spark, sf_dir, "region").select("r_name").write.mode("append").option("compression", "gzip").text(folder)
    return files.text_scan(files.read_directory(spark, folder)).where("ok").select("source_type", F.trim("text").alias("text"))


@query("SELECT 'csv' AS source_type, count(*) AS n_records FROM customer UNION ALL SELECT 'resume_pdf', count(*) FROM part UNION ALL SELECT 'recruiter_notes', count(*) FROM documents WHERE trim(text, ' ' || chr(10)) <> ''")
def source_union(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("file_ord"), F.lit("c.csv").alias("name"), F.lit(True).alias("ok"), F.lit(0).alias("pos"), F.col("c_name"), *(F.lit("").alias(f"c_{x}") for x in files.CSV_COLUMNS[1:]))
    notes = files.text_scan(_texts(spark, sf_dir)).where("ok")
    return partials.source_counts(partials.numbered([partials.csv_partials(c), partials.resume_partials(adapters.resumes(spark, sf_dir)), partials.note_partials(notes)]))


@query(
    "SELECT concat('p', p_partkey, '.pdf') AS file, section, count(*)::INTEGER AS n_lines FROM part, (VALUES ('HEADER'), ('HEADER'), ('HEADLINE'), ('EXPERIENCE'), ('EXPERIENCE'), ('EXPERIENCE'), ('EXPERIENCE'), ('EDUCATION'), ('SKILLS'), ('SKILLS')) s(section) GROUP BY ALL"
)
def resume_sections(spark, sf_dir):
    r = adapters.resumes(spark, sf_dir).select(F.col("name").alias("file"), F.explode(partials.resume_sections(F.col("text"))).alias("s"))
    return r.groupBy("file", "s.section").agg(F.count("*").cast("int").alias("n_lines"))


def _resume_lines(spark, sf_dir, section):
    return adapters.resumes(spark, sf_dir).select(F.col("name").alias("file"), partials.section(partials.resume_sections(F.col("text")), section).alias("lines"))


@query(
    "SELECT concat('p', p_partkey, '.pdf') AS file, 0 AS pos, p_brand AS company, 'Maker' AS title, CASE p_partkey % 3 WHEN 0 THEN 'Jan 2019' WHEN 1 THEN 'March 2015' ELSE '2015' END AS start_text, CASE p_partkey % 3 WHEN 1 THEN 'Dec. 2018' WHEN 2 THEN '2018' END AS end_text, concat('Made ', p_name) AS summary FROM part "
    "UNION ALL SELECT concat('p', p_partkey, '.pdf'), 1, 'Second Co', 'Helper', NULL, NULL, NULL FROM part"
)
def resume_experience(spark, sf_dir):
    r = _resume_lines(spark, sf_dir, "EXPERIENCE").select("file", F.posexplode(partials.resume_experience(F.col("lines"))).alias("pos", "e"))
    return r.select("file", "pos", "e.company", "e.title", F.col("e.start").alias("start_text"), F.col("e.end").alias("end_text"), "e.summary")


@query("SELECT concat('p', p_partkey, '.pdf') AS file, concat('University ', p_size) AS institution, 'BSc' AS degree, CAST(1980 + p_size AS INTEGER) AS end_year FROM part")
def resume_education(spark, sf_dir):
    r = _resume_lines(spark, sf_dir, "EDUCATION").select("file", F.explode(partials.resume_education(F.col("lines"))).alias("e"))
    return r.select("file", "e.institution", "e.degree", "e.end_year")


@query("SELECT concat('p', p_partkey, '.pdf') AS file, concat('python|go|', p_type) AS skills FROM part")
def resume_skills(spark, sf_dir):
    return _resume_lines(spark, sf_dir, "SKILLS").select("file", F.array_join(partials.resume_skills(F.col("lines")), "|").alias("skills"))


@query("SELECT concat('resume_pdf:p', p_partkey, '.pdf') AS source_id, p_name AS full_name, concat('p', p_partkey, '@example.org') AS email, p_type AS headline, 2 AS n_experience FROM part")
def resume_partial(spark, sf_dir):
    p = partials.resume_partials(adapters.resumes(spark, sf_dir))
    return p.select("source_id", "full_name", F.get("emails", F.lit(0)).alias("email"), "headline", F.size("experience").alias("n_experience"))


# ---- identity ---------------------------------------------------------------------------------------------------------

#: rec: the records; cl: each with its cluster. Order keys chain customers to their neighbours, so clusters are intervals.
_CL = f"""WITH rec AS ({adapters.RECORDS}),
brk AS (SELECT c_custkey AS c, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 20 = 0 AND o_custkey + 1 = c_custkey) AND lag(c_custkey) OVER (ORDER BY c_custkey) = c_custkey - 1 THEN 0 ELSE 1 END AS b FROM customer),
grp AS (SELECT c, sum(b) OVER (ORDER BY c) AS g FROM brk),
bears AS (SELECT rec.*, g, email IS NOT NULL OR phone IS NOT NULL AS ident FROM rec JOIN grp ON person = c),
low AS (SELECT g, min(rec_ord) AS low FROM bears WHERE ident GROUP BY g),
strong AS (SELECT bears.*, CASE WHEN ident THEN low ELSE rec_ord END AS root FROM bears JOIN low USING (g)),
name_one AS (SELECT rec_ord, CASE WHEN ident OR full_name IS NOT NULL THEN low ELSE rec_ord END AS r FROM bears JOIN low USING (g)),
cl AS (SELECT bears.*, min(bears.rec_ord) OVER (PARTITION BY r) AS cluster_ord FROM bears JOIN name_one USING (rec_ord)) """


@query(
    f"WITH rec AS ({adapters.RECORDS}), k AS (SELECT rec_ord, concat('e', lower(trim(email))) AS key FROM rec WHERE email IS NOT NULL UNION SELECT rec_ord, concat('p', right(regexp_replace(phone, '[^0-9]', '', 'g'), 10)) FROM rec "
    "WHERE length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 7) SELECT DISTINCT a, rec_ord AS b FROM (SELECT *, min(rec_ord) OVER (PARTITION BY key) AS a FROM k) WHERE a <> rec_ord"
)
def identity_edges(spark, sf_dir):
    return resolve.identity_edges(adapters.partials(spark, sf_dir))


@query(_CL + "SELECT rec_ord, root FROM strong")
def identity_clusters(spark, sf_dir):
    return resolve.identity_clusters(adapters.partials(spark, sf_dir))


@query(_CL + "SELECT rec_ord, cluster_ord FROM cl")
def identity_name_fallback(spark, sf_dir):
    return _clustered(spark, sf_dir).select("rec_ord", "cluster_ord")


@query(_CL + "SELECT cluster_ord, count(*) AS n_records FROM cl GROUP BY cluster_ord")
def cluster_sizes(spark, sf_dir):
    return _clustered(spark, sf_dir).groupBy("cluster_ord").agg(F.count("*").alias("n_records"))


_ID = """cid AS (SELECT cluster_ord, concat(coalesce(trim(regexp_replace(lower(arg_min(full_name, rec_ord) FILTER (WHERE full_name IS NOT NULL)), '[^a-z0-9]+', '-', 'g'), '-'), 'unknown'), '-', left(sha1(string_agg(source_id, '|' ORDER BY source_id)), 6)) AS candidate_id FROM cl GROUP BY cluster_ord)"""


@query(f"{_CL}, {_ID} SELECT cluster_ord, candidate_id FROM cid")
def candidate_id(spark, sf_dir):
    return resolve.candidate_ids(_clustered(spark, sf_dir)).select("cluster_ord", "candidate_id")


# ---- fusion -----------------------------------------------------------------------------------------------------------


def _flat(c: str) -> Column:
    """Provenance as one text, confidences in thousandths."""
    return F.array_join(F.transform(c, lambda p: F.concat_ws("~", p["field"], p["source"], p["method"], F.round(p["confidence"] * 1000).cast("long").cast("string"))), ";")


_RANK = "CASE source_type WHEN 'ats_json' THEN 0 ELSE 1 END * 1000000000000 + rec_ord"
_COUNTRIES = "CASE lower(country) WHEN 'united states' THEN 'US' WHEN 'canada' THEN 'CA' WHEN 'united kingdom' THEN 'GB' WHEN 'india' THEN 'IN' WHEN 'germany' THEN 'DE' WHEN 'france' THEN 'FR' END"


@query(
    f"{_CL} SELECT cluster_ord, regexp_replace(arg_min(full_name, {_RANK}) FILTER (WHERE full_name IS NOT NULL), ' +', ' ', 'g') AS full_name, arg_min(city, {_RANK}) FILTER (WHERE country IS NOT NULL) AS city, "
    f"arg_min(coalesce({_COUNTRIES}, '-'), {_RANK}) FILTER (WHERE country IS NOT NULL) AS country, arg_min(source_id, {_RANK}) FILTER (WHERE full_name IS NOT NULL) AS name_source FROM cl GROUP BY cluster_ord"
)
def pick_scalar(spark, sf_dir):
    p = fuse.pick_scalars(_clustered(spark, sf_dir))
    return p.select("cluster_ord", "full_name", "location.city", F.when(F.col("location").isNotNull(), F.coalesce("location.country", F.lit("-"))).alias("country"), F.get("prov_name", F.lit(0))["source"].alias("name_source"))


def _agreed_sql(key: str, where: str, field: str) -> str:
    return (
        f"v AS (SELECT cluster_ord, rec_ord, source_id, {key} AS key FROM cl WHERE {where}), k AS (SELECT cluster_ord, key, min(rec_ord) AS fst, CAST(least(900 + 100 * (count(*) - 1), 1000) AS BIGINT) AS conf FROM v GROUP BY ALL), "
        f"n AS (SELECT *, row_number() OVER (PARTITION BY cluster_ord ORDER BY fst) - 1 AS i FROM k), "
        f"flat AS (SELECT cluster_ord, string_agg(concat('{field}[', i, ']~', source_id, '~direct~', conf), ';' ORDER BY fst, rec_ord) AS prov FROM v JOIN n USING (cluster_ord, key) GROUP BY cluster_ord), "
        f"vals AS (SELECT cluster_ord, string_agg(key, '|' ORDER BY fst) AS vals FROM n GROUP BY cluster_ord)"
    )


_E164 = "concat('+', regexp_replace(phone, '[^0-9]', '', 'g'))"


@query(f"{_CL}, {_agreed_sql('lower(trim(email))', 'email IS NOT NULL', 'emails')} SELECT cluster_ord, vals AS emails, prov FROM vals JOIN flat USING (cluster_ord)")
def merge_emails(spark, sf_dir):
    return fuse.merge_emails(_clustered(spark, sf_dir)).select("cluster_ord", F.array_join("emails", "|").alias("emails"), _flat("prov_emails").alias("prov"))


_FAILED = "failed AS (SELECT cluster_ord, string_agg(concat('phones~', source_id, '~failed_normalize~100'), ';' ORDER BY rec_ord) AS failed FROM cl WHERE phone LIKE 'bad%' GROUP BY cluster_ord)"


_PHONES = "phone LIKE '+%'"


@query(f"{_CL}, {_agreed_sql(_E164, _PHONES, 'phones')}, {_FAILED} SELECT cluster_ord, vals AS phones, prov, failed FROM vals JOIN flat USING (cluster_ord) FULL JOIN failed USING (cluster_ord)")
def merge_phones(spark, sf_dir):
    p = fuse.merge_phones(_clustered(spark, sf_dir))
    return p.select("cluster_ord", *(F.when(F.col(c).isNotNull(), x).alias(n) for c, x, n in (("phones", F.array_join("phones", "|"), "phones"), ("prov_phones", _flat("prov_phones"), "prov"), ("prov_phones_failed", _flat("prov_phones_failed"), "failed"))))


_SK = """m AS (SELECT cluster_ord, rec_ord, 0 AS pos, source_id, CASE skill1 WHEN 'js' THEN 'JavaScript' WHEN 'K8S' THEN 'Kubernetes' WHEN 'web dev' THEN 'Web Dev' END AS key FROM cl WHERE skill1 IS NOT NULL
UNION ALL SELECT cluster_ord, rec_ord, CASE WHEN skill1 IS NULL THEN 0 ELSE 1 END, source_id, CASE skill2 WHEN 'docker' THEN 'Docker' ELSE skill2 END FROM cl WHERE skill2 IS NOT NULL),
sk AS (SELECT cluster_ord, key, min(rec_ord * 2 + pos) AS fst, CAST(least(900 + 100 * (count(*) - 1), 1000) AS BIGINT) AS conf FROM m GROUP BY ALL)"""


@query(
    f"{_CL}, {_SK} SELECT cluster_ord, string_agg(concat(key, '=', conf), '|' ORDER BY fst) AS skills, max(prov) AS prov FROM sk JOIN "
    "(SELECT cluster_ord, string_agg(concat('skills[', key, ']~', source_id, '~direct~', conf), ';' ORDER BY fst, rec_ord * 2 + pos) AS prov FROM m JOIN sk USING (cluster_ord, key) GROUP BY cluster_ord) USING (cluster_ord) GROUP BY cluster_ord"
)
def merge_skills(spark, sf_dir):
    s = fuse.merge_skills(_clustered(spark, sf_dir))
    return s.select("cluster_ord", F.array_join(F.transform("skills", lambda x: F.concat_ws("=", x["name"], F.round(x["confidence"] * 1000).cast("long").cast("string"))), "|").alias("skills"), _flat("prov_skills").alias("prov"))


@query(
    f"{_CL}, x AS (SELECT cluster_ord, company, title, min({_RANK}) AS fst FROM cl GROUP BY ALL) SELECT cluster_ord, string_agg(concat(company, '/', title), '|' ORDER BY fst) AS jobs, max(prov) AS prov FROM x JOIN "
    f"(SELECT cluster_ord, string_agg(concat('experience[', lower(company), '|', lower(title), ']~', source_id, '~direct~900'), ';' ORDER BY {_RANK}) AS prov FROM cl GROUP BY cluster_ord) USING (cluster_ord) GROUP BY cluster_ord"
)
def merge_experience(spark, sf_dir):
    e = fuse.merge_experience(_clustered(spark, sf_dir))
    return e.select("cluster_ord", F.array_join(F.transform("experience", lambda x: F.concat_ws("/", x["company"], x["title"])), "|").alias("jobs"), _flat("prov_experience").alias("prov"))


def _resume_clusters(spark, sf_dir):
    """Résumés of parts of one size are taken for one person's. A table: fusion reads it twice, and its filters would take the texts apart again."""
    numbered = lambda: partials.numbered([partials.resume_partials(adapters.resumes(spark, sf_dir))])
    p = _once("resumes", spark, sf_dir, lambda: write_table(numbered(), "resumes"))
    return p.withColumn("cluster_ord", F.get("education", F.lit(0))["end_year"].cast("long"))


@query(
    "WITH x AS (SELECT CAST(1980 + p_size AS BIGINT) AS cluster_ord, p_partkey * 2 AS ord, p_brand AS company, 'Maker' AS title, CASE p_partkey % 3 WHEN 0 THEN '2019-01' WHEN 1 THEN '2015-03' ELSE '2015' END AS first, "
    "CASE p_partkey % 3 WHEN 1 THEN '2018-12' WHEN 2 THEN '2018' END AS last, CASE WHEN p_partkey % 2 = 1 THEN concat('Made ', p_name) END AS summary FROM part "
    "UNION ALL SELECT CAST(1980 + p_size AS BIGINT), p_partkey * 2 + 1, 'Second Co', 'Helper', NULL, NULL, NULL FROM part), "
    "g AS (SELECT cluster_ord, company, title, min(ord) AS ord, arg_min(summary, ord) FILTER (WHERE summary IS NOT NULL) AS filled FROM x GROUP BY ALL) "
    "SELECT cluster_ord, string_agg(concat(company, '/', title, '/', coalesce(first, '-'), '/', coalesce(last, '-'), '/', coalesce(filled, '-')), '|' ORDER BY ord) AS jobs FROM g JOIN x USING (cluster_ord, company, title, ord) GROUP BY cluster_ord"
)
def merge_experience_dates(spark, sf_dir):
    """Dates, and summaries that the best source lacks and another has."""
    summary = lambda x: F.when(F.pmod(F.shiftright("rec_ord", 32), F.lit(2)) == 1, x["summary"])
    c = _resume_clusters(spark, sf_dir).withColumn("experience", F.transform("experience", lambda x: x.withField("summary", summary(x))))
    shown = lambda x: F.concat_ws("/", *(F.coalesce(x[k], F.lit("-")) for k in ("company", "title", "start", "end", "summary")))
    return fuse.merge_experience(c).select("cluster_ord", F.array_join(F.transform("experience", shown), "|").alias("jobs"))


@query(
    "WITH x AS (SELECT CAST(1980 + p_size AS BIGINT) AS cluster_ord, p_partkey AS ord, concat('University ', p_size) AS place, CASE WHEN p_partkey % 2 = 0 THEN 'MSc' ELSE 'BSc' END AS degree, 1980 + p_size + p_partkey % 3 AS year FROM part), "
    "g AS (SELECT cluster_ord, place, degree, min(ord) AS ord, arg_min(year, ord) AS year FROM x GROUP BY ALL) SELECT cluster_ord, string_agg(concat(place, '/', degree, '/', year), '|' ORDER BY ord) AS education, n_prov FROM g JOIN "
    "(SELECT cluster_ord, count(*)::INTEGER AS n_prov FROM x GROUP BY ALL) USING (cluster_ord) GROUP BY cluster_ord, n_prov"
)
def merge_education(spark, sf_dir):
    """Sources that agree in place and degree but not in the year: the whole entry of the best one stays."""
    k = F.shiftright("rec_ord", 32)
    of = lambda x: x.withField("degree", F.when(k % 2 == 0, "MSc").otherwise("BSc")).withField("end_year", (x["end_year"] + k % 3).cast("int"))
    e = fuse.merge_education(_resume_clusters(spark, sf_dir).withColumn("education", F.transform("education", of)))
    return e.select("cluster_ord", F.array_join(F.transform("education", lambda x: F.concat_ws("/", x["institution"], x["degree"], x["end_year"].cast("string"))), "|").alias("education"), F.size("prov_education").alias("n_prov"))


_OVERALL = (
    f"{_CL}, {_agreed_sql('lower(trim(email))', 'email IS NOT NULL', 'emails')}, {_SK}, ph AS (SELECT cluster_ord, {_E164} AS key, least(0.9::DOUBLE + 0.1::DOUBLE * (count(*) - 1), 1::DOUBLE) AS conf, count(*) AS n FROM cl WHERE {_PHONES} GROUP BY ALL), "
    "pf AS (SELECT cluster_ord, count(*) AS n FROM cl WHERE phone LIKE 'bad%' GROUP BY cluster_ord), "
    "score AS (SELECT cluster_ord, max(CASE WHEN full_name IS NOT NULL THEN 0.9::DOUBLE ELSE 0 END) AS name, max(CASE WHEN country IS NOT NULL THEN 0.9::DOUBLE ELSE 0 END) AS loc FROM cl GROUP BY cluster_ord), "
    "em AS (SELECT cluster_ord, sum(conf / 1000.0::DOUBLE * c) / sum(c) AS s FROM k JOIN (SELECT cluster_ord, key, count(*) AS c FROM v GROUP BY ALL) USING (cluster_ord, key) GROUP BY cluster_ord), "
    "ss AS (SELECT cluster_ord, sum(conf / 1000.0::DOUBLE * c) / sum(c) AS s FROM sk JOIN (SELECT cluster_ord, key, count(*) AS c FROM m GROUP BY ALL) USING (cluster_ord, key) GROUP BY cluster_ord), "
    "ps AS (SELECT cluster_ord, (sum(conf * ph.n) + 0.1::DOUBLE * coalesce(max(pf.n), 0)) / (sum(ph.n) + coalesce(max(pf.n), 0)) AS s FROM ph LEFT JOIN pf USING (cluster_ord) GROUP BY cluster_ord), "
    "overall AS (SELECT cluster_ord, 0.7::DOUBLE * (name + coalesce(em.s, 0) + coalesce(ss.s, 0)) / 3 + 0.3::DOUBLE * (coalesce(ps.s, 0) + loc + 0.9::DOUBLE) / (1 + (coalesce(ps.s, 0) > 0)::INTEGER + (loc > 0)::INTEGER) AS x "
    "FROM score LEFT JOIN em USING (cluster_ord) LEFT JOIN ss USING (cluster_ord) LEFT JOIN ps USING (cluster_ord)) "
)


@query(_OVERALL + "SELECT cluster_ord, floor(round(x * 1000, 6) + 0.5) / 1000 AS overall_confidence FROM overall")
def overall_confidence(spark, sf_dir):
    return _records(spark, sf_dir).select("cluster_ord", "overall_confidence")


# ---- shaping ----------------------------------------------------------------------------------------------------------

_VALUES = (
    f"{_CL}, {_ID}, e AS (SELECT cluster_ord, arg_min(lower(trim(email)), rec_ord) FILTER (WHERE email IS NOT NULL) AS email FROM cl GROUP BY cluster_ord), p AS (SELECT cluster_ord, arg_min({_E164}, rec_ord) FILTER (WHERE {_PHONES}) AS phone FROM cl GROUP BY cluster_ord), "
    f"f AS (SELECT cluster_ord, regexp_replace(arg_min(full_name, {_RANK}) FILTER (WHERE full_name IS NOT NULL), ' +', ' ', 'g') AS full_name, arg_min(company, {_RANK}) AS company, arg_min({_COUNTRIES}, {_RANK}) FILTER (WHERE country IS NOT NULL) AS dummy FROM cl GROUP BY cluster_ord), "
    f"{_SK}, s AS (SELECT cluster_ord, string_agg(key, '|' ORDER BY fst) AS skills FROM sk GROUP BY cluster_ord), "
    "out AS (SELECT cluster_ord, candidate_id, full_name, email, phone, company, coalesce(skills, '') AS skills FROM cid JOIN e USING (cluster_ord) JOIN p USING (cluster_ord) JOIN f USING (cluster_ord) LEFT JOIN s USING (cluster_ord)) "
)


_LISTS = (
    "all_emails AS (SELECT cluster_ord, string_agg(x, '|' ORDER BY fst) AS emails FROM (SELECT cluster_ord, lower(trim(email)) AS x, min(rec_ord) AS fst FROM cl WHERE email IS NOT NULL GROUP BY ALL) GROUP BY cluster_ord), "
    f"all_phones AS (SELECT cluster_ord, string_agg(x, '|' ORDER BY fst) AS phones FROM (SELECT cluster_ord, {_E164} AS x, min(rec_ord) AS fst FROM cl WHERE {_PHONES} GROUP BY ALL) GROUP BY cluster_ord), "
    f"all_jobs AS (SELECT cluster_ord, string_agg(x, '|' ORDER BY fst) AS jobs FROM (SELECT cluster_ord, concat(company, '/', title) AS x, min({_RANK}) AS fst FROM cl GROUP BY ALL) GROUP BY cluster_ord), "
    "n_prov AS (SELECT cluster_ord, (max((full_name IS NOT NULL)::INTEGER) + max((country IS NOT NULL)::INTEGER) + count(email) + count(phone) + count(skill1) + count(skill2) + count(*))::INTEGER AS n_provenance FROM cl GROUP BY cluster_ord)"
)


@query(
    _VALUES.rstrip() + ", " + _LISTS + " SELECT cluster_ord, candidate_id, full_name, coalesce(emails, '') AS emails, coalesce(phones, '') AS phones, jobs, skills, n_provenance FROM out "
    "LEFT JOIN all_emails USING (cluster_ord) LEFT JOIN all_phones USING (cluster_ord) LEFT JOIN all_jobs USING (cluster_ord) LEFT JOIN n_prov USING (cluster_ord)"
)
def canonical_records(spark, sf_dir):
    """Names, all list values in order, and the number of provenance entries (each of which the merge_* queries compare)."""
    jobs = F.transform("experience", lambda x: F.concat_ws("/", x["company"], x["title"]))
    return _records(spark, sf_dir).select(
        "cluster_ord", "candidate_id", "full_name", F.array_join("emails", "|").alias("emails"), F.array_join("phones", "|").alias("phones"), F.array_join(jobs, "|").alias("jobs"),
        F.array_join("skills.name", "|").alias("skills"), F.size("provenance").alias("n_provenance"),
    )


@query(_VALUES + "SELECT cluster_ord, email AS first_email, CAST(NULL AS VARCHAR) AS ninth_email, skills AS names, company, CAST(NULL AS VARCHAR) AS nothing, '' AS no_keys FROM out")
def project_paths(spark, sf_dir):
    c = Config([Field("first_email", source="emails[0]"), Field("ninth_email", source="emails[99]"), Field("names", source="skills[].name"), Field("company", source="experience[0]..company"), Field("nothing", source="nothing.x"), Field("no_keys", source="skills[].nothing")], False, False)
    p = projected_columns(_records(spark, sf_dir), c)
    return p.select("cluster_ord", "first_email", "ninth_email", F.array_join("names", "|").alias("names"), "company", "nothing", F.array_join("no_keys", "|").alias("no_keys"))


@query(_VALUES + "SELECT cluster_ord, full_name AS person, company AS employer, CAST(NULL AS VARCHAR) AS pitch, skills AS tools FROM out")
def project_custom(spark, sf_dir):
    c = Config([Field("person", source="full_name"), Field("employer", source="experience[0].company"), Field("pitch", source="headline"), Field("tools", "string[]", source="skills[].name")], False, False)
    return projected_columns(_records(spark, sf_dir), c).withColumn("tools", F.array_join("tools", "|"))


@query(_VALUES + "SELECT cluster_ord, full_name, email, phone, skills, company FROM out")
def project_default(spark, sf_dir):
    schema = "full_name string, emails array<string>, phones array<string>, skills array<struct<name:string>>, experience array<struct<company:string>>"
    d = project(_records(spark, sf_dir), DEFAULT_CONFIG).select("cluster_ord", F.from_json("document", schema).alias("d"))
    return d.select("cluster_ord", "d.full_name", F.get("d.emails", F.lit(0)).alias("email"), F.get("d.phones", F.lit(0)).alias("phone"), F.array_join("d.skills.name", "|").alias("skills"), F.get("d.experience", F.lit(0))["company"].alias("company"))


@query(_VALUES + "SELECT cluster_ord, concat('{', array_to_string(list_filter([CASE WHEN full_name IS NOT NULL THEN concat('\"full_name\":\"', full_name, '\"') END, CASE WHEN phone IS NOT NULL THEN concat('\"phone\":\"', phone, '\"') END], lambda x: x IS NOT NULL), ','), '}') AS document FROM out")
def project_on_missing(spark, sf_dir):
    c = Config([Field("full_name"), Field("headline"), Field("phone", source="phones[0]")], False, False, "omit")
    return project(_records(spark, sf_dir), c).select("cluster_ord", "document")


@query(_VALUES + "SELECT cluster_ord, phone AS call, skills AS tools, CAST(NULL AS VARCHAR) AS since FROM out")
def project_normalize(spark, sf_dir):
    c = Config([Field("since", source="full_name", normalize="YYYY-MM"), Field("tools", "string[]", source="skills[].name", normalize="canonical"), Field("call", source="phones[0]", normalize="E164")], False, False)
    return projected_columns(_records(spark, sf_dir), c).select("cluster_ord", "call", F.array_join("tools", "|").alias("tools"), "since")


@query(_VALUES + "SELECT candidate_id, CASE WHEN full_name IS NULL THEN 'field ''full_name'' (from ''full_name'') is missing' ELSE 'field ''email'' (from ''emails[0]'') is missing' END AS message FROM out WHERE full_name IS NULL OR email IS NULL")
def project_errors(spark, sf_dir):
    c = Config([Field("full_name"), Field("email", source="emails[0]")], on_missing="error")
    return project(_records(spark, sf_dir), c).where("project_error IS NOT NULL").select("candidate_id", F.col("project_error").alias("message"))


# ---- checks, errors, counts -------------------------------------------------------------------------------------------


def _spoiled(spark, sf_dir):
    """Records of which some break a rule."""
    r = _records(spark, sf_dir)
    stray = F.array(F.struct(F.lit("skilz[x]").alias("field"), F.lit("s").alias("source"), F.lit("direct").alias("method"), F.lit(0.5).alias("confidence")))
    return r.withColumn("overall_confidence", F.when(F.col("cluster_ord") % 5 == 0, 1.5).otherwise(F.col("overall_confidence"))).withColumn(
        "provenance", F.when(F.col("cluster_ord") % 5 == 1, F.concat("provenance", stray)).otherwise(F.col("provenance"))
    )


@query(f"{_CL}, {_ID} SELECT cluster_ord, cluster_ord % 5 >= 2 AS good FROM cid")
def validate_canonical(spark, sf_dir):
    return _spoiled(spark, sf_dir).select("cluster_ord", checks.canonical_fault().isNull().alias("good"))


@query(f"{_CL}, {_ID} SELECT cluster_ord, CASE WHEN cluster_ord % 5 = 1 THEN 'skilz[x]' ELSE '' END AS orphans FROM cid")
def validate_orphans(spark, sf_dir):
    return _spoiled(spark, sf_dir).select("cluster_ord", F.array_join(checks.orphan_fields(), "|").alias("orphans"))


@query(_VALUES + "SELECT cluster_ord, CASE WHEN full_name IS NOT NULL THEN 'schema violation at ''dated''' END AS violation FROM out")
def validate_projection(spark, sf_dir):
    c = Config([Field("full_name"), Field("dated", source="full_name", normalize="date"), Field("odd", "unheard", source="emails")], on_missing="omit")
    return project(_records(spark, sf_dir), c).select("cluster_ord", "violation")


@query("SELECT concat('n', n_nationkey, '.json') AS file, CASE WHEN n_nationkey = 6 THEN 'parse' ELSE 'load' END AS stage FROM nation WHERE n_nationkey IN (3, 5, 6) UNION ALL SELECT 'n4.csv', 'load'")
def source_errors(spark, sf_dir):
    scanned = files.json_scan(_json_files(spark, sf_dir))
    rows = files.csv_scan(_csv_files(spark, sf_dir)).where("NOT ok").select(F.col("name").alias("file"), F.lit("load").alias("stage"))
    load = scanned.where("NOT ok").select(F.col("name").alias("file"), F.lit("load").alias("stage"))
    return rows.unionByName(load).unionByName(partials.json_partials(scanned)[1].select(F.col("name").alias("file"), F.lit("parse").alias("stage")))


@query(_VALUES + "SELECT candidate_id, 'validate_canonical' AS stage FROM out WHERE cluster_ord % 5 < 2 UNION ALL SELECT candidate_id, 'project' FROM out WHERE cluster_ord % 5 >= 2 AND full_name IS NULL")
def candidate_errors(spark, sf_dir):
    good, bad = checks.validate_canonical(_spoiled(spark, sf_dir))
    shaped = project(good, Config([Field("full_name")], on_missing="error")).where("project_error IS NOT NULL")
    return bad.select("candidate_id", "stage").unionByName(shaped.select("candidate_id", F.lit("project").alias("stage")))


@query(f"{_CL} SELECT 'partials' AS metric, count(*) AS n FROM cl UNION ALL SELECT 'records', count(DISTINCT cluster_ord) FROM cl UNION ALL SELECT 'candidates', count(DISTINCT cluster_ord) FROM cl UNION ALL SELECT 'candidate_errors', 0")
def run_metrics(spark, sf_dir):
    none = spark.createDataFrame([], plan.SOURCE_ERROR)
    r = plan.run_partials(adapters.partials(spark, sf_dir), none, DEFAULT_CONFIG)
    done = F.count_if(F.col("stage") == plan.DONE)
    counts = r.outcomes.agg(F.count("*").alias("records"), done.alias("candidates"), (F.count("*") - done).alias("candidate_errors"))
    rows = counts.unpivot([], ["records", "candidates", "candidate_errors"], "metric", "n")
    return r.partials.agg(F.count("*").alias("n")).select(F.lit("partials").alias("metric"), "n").unionByName(rows)


@query(
    _VALUES + "SELECT candidate_id, CASE WHEN cluster_ord % 5 < 2 THEN 'validate_canonical' WHEN full_name IS NULL THEN 'project' WHEN phone IS NOT NULL THEN 'validate_projection' ELSE 'output' END AS stage, "
    "CASE WHEN cluster_ord % 5 = 0 THEN 'overall_confidence is outside [0, 1]' WHEN cluster_ord % 5 = 1 THEN 'provenance of unknown fields: skilz[x]' WHEN full_name IS NULL THEN 'field ''full_name'' (from ''full_name'') is missing' "
    "WHEN phone IS NOT NULL THEN 'schema violation at ''calls''' END AS message, cluster_ord % 5 > 1 AND full_name IS NOT NULL AND phone IS NULL AS has_document FROM out"
)
def run_outcomes(spark, sf_dir):
    """Where every record ends, with its message: faulty records, missing fields, broken types and output."""
    c = Config([Field("full_name"), Field("calls", "number[]", source="phones")], on_missing="error")
    o = write_table(plan.outcomes(_spoiled(spark, sf_dir), c), "outcomes", "stage")
    return o.select("candidate_id", "stage", "message", F.col("document").isNotNull().alias("has_document"))
