"""The driver's tables in the shape of people records. The same SQL text runs in Spark and in other engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosopon.operators.hot import shuffled
from prosopon.schemas import EDUCATION, LOCATION

#: One row per customer (as from a tabular export) and per order (as from nested JSON); order keys chain customers.
RECORDS = """
SELECT 100000000 + c_custkey AS rec_ord, concat('csv:customer.csv#row=', CAST(c_custkey + 1 AS string)) AS source_id, 'csv' AS source_type, c_custkey AS person,
    concat('Customer  ', CAST(c_custkey AS string)) AS full_name, concat('user', CAST(c_custkey AS string), '@example.com') AS email,
    concat('+1 415 2', lpad(CAST(c_custkey AS string), 6, '0')) AS phone, c_mktsegment AS company, 'Buyer' AS title,
    CAST(NULL AS string) AS city, CAST(NULL AS string) AS country, CAST(NULL AS string) AS skill1, CAST(NULL AS string) AS skill2
FROM customer
UNION ALL
SELECT o_orderkey, concat('ats_json:orders.json#entry=', CAST(o_orderkey AS string)), 'ats_json', o_custkey,
    CASE WHEN o_orderkey % 7 <> 0 THEN concat('Customer ', CAST(o_custkey AS string)) END,
    CASE WHEN o_orderkey % 10 <> 3 THEN concat(' USER', CAST(o_custkey AS string), '@EXAMPLE.COM') END,
    CASE WHEN o_orderkey % 20 = 0 THEN concat('+1 (415) 2', lpad(CAST(o_custkey + 1 AS string), 6, '0')) WHEN o_orderkey % 20 = 1 THEN 'bad 12' END,
    o_orderpriority, o_orderstatus, r_name, n_name,
    CASE o_orderkey % 4 WHEN 0 THEN 'js' WHEN 1 THEN 'web dev' WHEN 2 THEN 'K8S' END, CASE o_orderkey % 3 WHEN 0 THEN 'JavaScript' WHEN 1 THEN 'docker' END
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

#: Résumé texts made of parts.
RESUMES = """
SELECT p_partkey, concat(p_name, chr(10), 'mail: p', CAST(p_partkey AS string), '@example.org.', chr(10), 'HEADLINE', chr(10), p_type, chr(10), chr(10), 'EXPERIENCE', chr(10),
    p_brand, ' -- Maker', chr(10), CASE p_partkey % 3 WHEN 0 THEN 'Jan 2019 - Present' WHEN 1 THEN 'March 2015 - Dec. 2018' ELSE '2015 - 2018' END, chr(10), 'Made ', p_name, chr(10),
    'Second Co -- Helper', chr(10), 'EDUCATION', chr(10), 'University ', CAST(p_size AS string), ' -- BSc, ', CAST(1980 + p_size AS string), chr(10), 'Skills', chr(10), 'python, go,', chr(10), p_type) AS text
FROM part
"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """A query over some of the tables; they are bound to the text, not registered by name."""
    frames = tables(spark, sf_dir, *names)
    return spark.sql(_bound(text, names), **frames)


def _bound(text: str, names: tuple[str, ...]) -> str:
    import re

    return re.sub(r"\b(FROM|JOIN) (" + "|".join(names) + r")\b", r"\1 {\2}", text)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = tables(spark, sf_dir, "customer", "orders", "nation", "region")
    frames["customer"] = shuffled(frames["customer"])
    return spark.sql(_bound(RECORDS, tuple(frames)), **frames)


def partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    some = lambda *cs: F.filter(F.array(*cs), lambda x: x.isNotNull())
    none = F.lit(None).cast("string")
    place = F.when(F.col("country").isNotNull(), F.struct("city", none.alias("region"), "country")).cast(LOCATION)
    job = F.array(F.struct("company", "title", none.alias("start"), none.alias("end"), none.alias("summary")))
    return r.select(
        "rec_ord", "source_id", "source_type", "full_name", some("email").alias("emails"), some("phone").alias("phones"), place.alias("location"), none.alias("headline"),
        some("skill1", "skill2").alias("skills"), job.alias("experience"), F.array().cast(EDUCATION).alias("education"),
        F.create_map(*(F.lit(x) for k in ("full_name", "emails", "phones", "location", "skills", "experience") for x in (k, "direct"))).alias("methods"),
    )


def resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt to all tasks: a small file of parts, which one task would read, makes much text to take apart."""
    r = sql(spark, sf_dir, RESUMES, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return r.select(F.col("p_partkey").cast("int").alias("file_ord"), F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("name"), "text")
