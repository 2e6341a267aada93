"""From scanned rows to partial records, one function per kind of source. All but the order of files is decided by row.

Each result has the columns of prosopon.schemas.PARTIAL without rec_ord, and file_ord and pos to number by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosopon.functions.text import blank_to_null, extract_email, extract_phone, extract_skills, let, strip
from prosopon.schemas import EDUCATION, EXPERIENCE, LOCATION

_KINDS = dict(x.strip().split(" ", 1) for x in [
    "source_id string", "source_type string", "full_name string", "emails array<string>", "phones array<string>", f"location {LOCATION}", "headline string",
    "skills array<string>", f"experience {EXPERIENCE}", f"education {EDUCATION}", "methods map<string,string>",
])


def _list(value: Column) -> Column:
    """One value, or none if it is null."""
    return F.when(value.isNotNull(), F.array(value)).otherwise(F.array().cast("array<string>"))


def _partial(df: DataFrame, keep: list[str], **fields: Column) -> DataFrame:
    """Fields that are not given are null or empty. methods: for each field how it was found, kept where the field has a value."""
    empty = {k: F.array().cast(t) if t.startswith("array") else F.lit(None).cast(t) for k, t in _KINDS.items()}
    methods = fields.pop("methods")
    cols = {k: fields.get(k, empty[k]).cast(t) for k, t in _KINDS.items() if k != "methods"}
    full = df.select(*keep, *(c.alias(k) for k, c in cols.items()))
    has = lambda k: F.size(k) > 0 if _KINDS[k].startswith("array") else F.col(k).isNotNull()
    entries = F.filter(F.array(*(F.when(has(k), F.struct(F.lit(k).alias("k"), F.lit(m).alias("v"))) for k, m in methods.items())), lambda e: e.isNotNull())
    return full.withColumn("methods", F.map_from_entries(entries))


def _text(c: Column) -> Column:
    return blank_to_null(strip(F.coalesce(c.cast("string"), F.lit(""))))


def _job(company: Column, title: Column) -> Column:
    none = F.lit(None).cast("string")
    e = F.struct(company.alias("company"), title.alias("title"), none.alias("start"), none.alias("end"), none.alias("summary"))
    return F.when(F.coalesce(company, title).isNotNull(), F.array(e)).otherwise(F.array().cast(EXPERIENCE))


def csv_partials(rows: DataFrame) -> DataFrame:
    """rows of csv_scan. A row with neither name nor email is dropped but counts in the row numbers."""
    r = rows.where("ok AND pos IS NOT NULL")
    name, email, phone, company, title = (_text(F.col(f"c_{x}")) for x in ("name", "email", "phone", "current_company", "title"))
    out = _partial(
        r, ["file_ord", "pos"], source_id=F.concat(F.lit("csv:"), "name", F.lit("#row="), (F.col("pos") + 2).cast("string")), source_type=F.lit("csv"),
        full_name=name, emails=_list(email), phones=_list(phone), experience=_job(company, title),
        methods={k: "direct" for k in ("full_name", "emails", "phones", "experience")},
    )
    return out.where(F.col("full_name").isNotNull() | (F.size("emails") > 0))


_FALSY = ["null", "0", "false", '""', "[]", "{}", "0.0", "-0.0"]


def json_partials(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(partials, errors) of the rows of json_scan, or of json_split_scan. Entries that are not objects are skipped but count. A value of a wrong kind in a
    text field, or a number as skill_tags, makes the whole file an error. A city, state or country that is not text is left out."""
    e = scanned.where("ok").select("file_ord", "name", F.posexplode("entries").alias("pos", "e")) if "entries" in scanned.columns else scanned.where("ok AND pos IS NOT NULL").select("file_ord", "name", "pos", "e")
    e = e.where(F.expr("schema_of_variant(e)").startswith("OBJECT"))
    texts = ["candidate_name", "contact_email", "mobile_number", "employer", "job_title", "city", "state", "country_name"]
    get = lambda k: f"try_variant_get(e, '$.{k}', 'variant')"
    kind = lambda k: F.expr(f"schema_of_variant({get(k)})")
    falsy = lambda k: F.coalesce(F.expr(f"to_json({get(k)})").isin(_FALSY), F.lit(True))
    e = e.select("*", *(F.when(kind(k) == "STRING", F.expr(f"try_variant_get(e, '$.{k}', 'string')")).alias(k) for k in texts), F.expr(get("skill_tags")).alias("tags"))
    wrong = F.lit(False)
    for k in texts[:5]:
        wrong = wrong | (~falsy(k) & F.coalesce(kind(k) != "STRING", F.lit(False)))
    tag_kind = F.coalesce(kind("skill_tags"), F.lit("VOID"))
    listed = tag_kind.startswith("ARRAY")
    wrong = wrong | (~falsy("skill_tags") & ~(listed | (tag_kind == "STRING") | tag_kind.startswith("OBJECT")))
    truthy = F.filter(F.expr("try_variant_get(tags, '$', 'array<variant>')"), lambda x: ~F.coalesce(F.to_json(x).isin(_FALSY), F.lit(True)))
    as_text = F.transform(truthy, lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)))
    letters = F.filter(F.split(F.try_variant_get("tags", "$", "string"), ""), lambda x: x != "")
    skills = F.when(listed, as_text).when(tag_kind == "STRING", letters).when(tag_kind.startswith("OBJECT"), F.map_keys(F.try_variant_get("tags", "$", "map<string,variant>")))
    e = e.withColumn("wrong", wrong).withColumn("skill_list", F.coalesce(skills, F.array().cast("array<string>")))
    bad = e.where("wrong").groupBy("file_ord", "name").agg(F.min("pos").alias("pos"))
    errors = bad.select("file_ord", "name", F.concat(F.lit("entry "), F.col("pos").cast("string"), F.lit(": a field has a value of the wrong kind")).alias("error"))
    place = F.struct(*(F.when(F.col(k) != "", F.col(k)).alias(n) for k, n in (("city", "city"), ("state", "region"), ("country_name", "country"))))
    some = F.coalesce(*(F.when(F.col(k) != "", F.col(k)) for k in ("city", "state", "country_name"))).isNotNull()
    kept = e.join(bad.select("file_ord"), "file_ord", "left_anti")
    out = _partial(
        kept, ["file_ord", "pos"], source_id=F.concat(F.lit("ats_json:"), "name", F.lit("#entry="), F.col("pos").cast("string")), source_type=F.lit("ats_json"),
        full_name=_text(F.col("candidate_name")), emails=_list(_text(F.col("contact_email"))), phones=_list(_text(F.col("mobile_number"))),
        location=F.when(some, place), skills=F.col("skill_list"), experience=_job(_text(F.col("employer")), _text(F.col("job_title"))),
        methods={k: "direct" for k in ("full_name", "emails", "phones", "location", "skills", "experience")},
    )
    return out.where(F.col("full_name").isNotNull() | (F.size("emails") > 0)), errors


def note_partials(texts: DataFrame) -> DataFrame:
    """file_ord, name, text: one record per text that is not blank; a note never names the person."""
    t = F.col("text")
    return _partial(
        texts.where(strip(F.coalesce(t, F.lit(""))) != ""), ["file_ord", F.lit(0).alias("pos")], source_id=F.concat(F.lit("recruiter_notes:"), "name"), source_type=F.lit("recruiter_notes"),
        emails=_list(extract_email(t)), phones=_list(extract_phone(t, skip_dates=True)), skills=extract_skills(t),
        methods={"emails": "regex", "phones": "regex", "skills": "heuristic"},
    )


#: The lines that begin a section.
HEADERS = ["HEADLINE", "EXPERIENCE", "EDUCATION", "SKILLS"]


def resume_sections(text: Column) -> Column:
    """Array of (section, line): lines that are not blank under the last header line before them, HEADER before the first. The text is
    cut at its header lines, so its length costs in proportion."""
    breaks = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
    lines = F.filter(F.transform(F.split(text, breaks), strip), lambda x: x != "")
    # \x00 stands before each header, which no stripped line can hold once those of the text are gone.
    marked = F.transform(lines, lambda x: F.when(F.upper(x).isin(HEADERS), F.concat(F.lit("\x00"), F.upper(x))).otherwise(F.regexp_replace(x, "\x00", "")))
    blocks = F.split(F.concat(F.lit("HEADER\n"), F.array_join(marked, "\n")), "\n?\x00")

    def rows(parts):
        return F.transform(F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x != ""), lambda x: F.struct(F.get(parts, F.lit(0)).alias("section"), x.alias("line")))

    return F.flatten(F.transform(F.transform(blocks, lambda block: F.split(block, "\n")), rows))


def section(sections: Column, name: str) -> Column:
    return F.transform(F.filter(sections, lambda s: s["section"] == name), lambda s: s["line"])


def _halves(x: Column, at: str) -> tuple[Column, Column]:
    """Before and after the first `at`; all and nothing if it does not occur."""
    k = F.instr(x, at)
    return F.when(k > 0, F.substring(x, F.lit(1), k - 1)).otherwise(x), F.when(k > 0, F.substring(x, k + len(at), F.lit(1 << 30))).otherwise("")


def resume_experience(lines: Column) -> Column:
    """Threes of lines: company -- title, start - end, summary. An end that says present is null."""

    def entry(lines, i):
        head, dates = F.get(lines, i), F.coalesce(F.get(lines, i + 1), F.lit(""))
        (company, title), (start, end) = _halves(head, "--"), _halves(dates, "-")
        return F.struct(
            blank_to_null(strip(company)).alias("company"), blank_to_null(strip(title)).alias("title"), blank_to_null(strip(start)).alias("start"),
            F.when(~F.lower(end).contains("present"), blank_to_null(strip(end))).alias("end"), F.get(lines, i + 2).alias("summary"),
        )

    def entries(lines):
        return F.when(F.size(lines) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.size(lines) - 1, F.lit(0)), F.lit(3)), lambda i: entry(lines, i))).otherwise(F.array().cast(EXPERIENCE))

    return let(lines, entries)


def resume_education(lines: Column) -> Column:
    """Institution -- degree, year."""

    def entry(x):
        place, rest = _halves(x, "--")
        comma = F.length(rest) - F.length(F.substring_index(rest, ",", -1))  # place of the last comma, 0 if none
        degree, year = F.when(comma > 0, F.substring(rest, F.lit(1), comma - 1)).otherwise(""), F.substring_index(rest, ",", -1)
        return F.struct(
            blank_to_null(strip(place)).alias("institution"), F.coalesce(blank_to_null(strip(degree)), blank_to_null(strip(rest))).alias("degree"),
            F.lit(None).cast("string").alias("field"), F.regexp_extract(year, r"\d{4}", 0).try_cast("int").alias("end_year"),
        )

    return F.transform(lines, entry)


def resume_skills(lines: Column) -> Column:
    return F.filter(F.transform(F.split(F.array_join(lines, ", "), ","), strip), lambda x: x != "")


def resume_partials(texts: DataFrame) -> DataFrame:
    """file_ord, name, text (not blank): one record per text."""
    r = texts.where(F.coalesce("text", F.lit("")) != "").withColumn("sections", resume_sections(F.col("text")))
    of = lambda n: section(F.col("sections"), n)
    return _partial(
        r, ["file_ord", F.lit(0).alias("pos")], source_id=F.concat(F.lit("resume_pdf:"), "name"), source_type=F.lit("resume_pdf"),
        full_name=F.get(of("HEADER"), F.lit(0)), emails=_list(extract_email(F.col("text"))), phones=_list(extract_phone(F.col("text"), skip_dates=False)),
        headline=F.get(of("HEADLINE"), F.lit(0)), experience=resume_experience(of("EXPERIENCE")), education=resume_education(of("EDUCATION")), skills=resume_skills(of("SKILLS")),
        methods={"full_name": "heuristic", "emails": "regex", "phones": "regex", "headline": "direct", "experience": "heuristic", "education": "heuristic", "skills": "direct"},
    )


def numbered(partials: list[DataFrame]) -> DataFrame:
    """All kinds in one frame, with rec_ord by file and position. The number is made of both, so no task has to see all rows."""
    union = partials[0]
    for p in partials[1:]:
        union = union.unionByName(p)
    return union.select((F.col("file_ord").cast("long") * (1 << 32) + F.col("pos")).alias("rec_ord"), *_KINDS)


def source_counts(partials: DataFrame) -> DataFrame:
    return partials.groupBy("source_type").agg(F.count("*").alias("n_records"))

