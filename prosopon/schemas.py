"""Schemas and constants that the operators share."""

from __future__ import annotations

LOCATION = "struct<city:string,region:string,country:string>"
LINKS = "struct<linkedin:string,github:string,portfolio:string,other:array<string>>"
EXPERIENCE = "array<struct<company:string,title:string,start:string,end:string,summary:string>>"
EDUCATION = "array<struct<institution:string,degree:string,field:string,end_year:int>>"
SKILLS = "array<struct<name:string,confidence:double,sources:array<string>>>"
PROVENANCE = "array<struct<field:string,source:string,method:string,confidence:double>>"

#: One source's view of one person; rec_ord is the order of input.
PARTIAL = (
    f"rec_ord bigint, source_id string, source_type string, full_name string, emails array<string>, phones array<string>, location {LOCATION}, "
    f"headline string, skills array<string>, experience {EXPERIENCE}, education {EDUCATION}, methods map<string,string>"
)

#: One person; cluster_ord (the smallest rec_ord) gives the order of output.
CANONICAL = {
    "candidate_id": "string", "full_name": "string", "emails": "array<string>", "phones": "array<string>", "location": LOCATION, "links": LINKS,
    "headline": "string", "years_experience": "double", "skills": SKILLS, "experience": EXPERIENCE, "education": EDUCATION,
    "provenance": PROVENANCE, "overall_confidence": "double",
}

# Fixed values of the fusion rules.
SOURCE_PRIORITY = ["ats_json", "csv", "resume_pdf", "recruiter_notes"]
BASE_SCORE = {"direct": 0.9, "regex": 0.7, "heuristic": 0.5, "merged": 0.7, "failed_normalize": 0.1}
UNKNOWN_SCORE = 0.5
TIER_WEIGHT = {"ats_json": 1.0, "csv": 1.0, "resume_pdf": 0.85, "recruiter_notes": 0.7}
UNKNOWN_WEIGHT = 0.7
AGREEMENT_BONUS = 0.1
METHODS = ["direct", "regex", "heuristic", "merged", "failed_normalize"]
PROVENANCE_FIELDS = ["candidate_id", "full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education"]
EXTENSIONS = {"csv": "csv", "json": "ats_json", "pdf": "resume_pdf", "txt": "recruiter_notes"}
