"""Schemas of every layer and the contracts of the eight warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TEXT = T.StringType()
_TEXTS = T.ArrayType(_TEXT)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(names: str) -> dict[str, T.DataType]:
    return {name: _TEXT for name in names.split()}


RAW_POSTING = _struct(
    **_texts(
        "hash source source_id url job_title company_name location posted_date full_text_jd"
    ),
    update_date=T.TimestampNTZType(),
)
RAW_POSTING_ALT = _struct(
    **_texts("url title date_post company_name company_field company_scope experience requirements")
)
LISTING_A = _struct(
    data=T.ArrayType(
        _struct(
            **_texts("id title"),
            company=_struct(display_name=_TEXT),
            detail_url=_TEXT,
            refreshed=_struct(date=_TEXT),
            addresses=_struct(sort_addresses=_TEXT),
        )
    ),
    meta=_struct(last_page=T.LongType()),
)
LISTING_B = _struct(
    data=T.ArrayType(
        _struct(
            **_texts("jobTitle companyName jobUrl alias jobId approvedOn"),
            workingLocations=T.ArrayType(_struct(cityNameVI=_TEXT)),
        )
    ),
    meta=_struct(nbPages=T.LongType()),
)
PARSED_POSTING = _struct(
    **_texts("_id job_title company_name location posted_date url update_date salary"),
    seniority_level=_TEXTS,
    job_position=_TEXT,
    tech_stack=_TEXTS,
    soft_skills=_TEXTS,
    major=_TEXTS,
)
VOCAB = _struct(category=_TEXT, value=_TEXT, ord=T.LongType(), key=_TEXT)
REQUEST = _struct(
    request_id=T.LongType(),
    job_title=_TEXT,
    locations=_TEXTS,
    levels=_TEXTS,
    updated_after=_TEXT,
    last_freq=T.DoubleType(),
    last_name=_TEXT,
    limit=T.IntegerType(),
)

# The closed list of seniority levels.
SENIORITY_LEVELS = [
    "Intern", "Fresher", "Junior", "Middle", "Senior", "Lead", "Principal", "Staff Engineer",
    "Engineering Manager", "Director", "VP", "CTO", "Else",
]

# The alias rows (job word, keyword) the alias table starts with.
KEYWORD_ALIAS = [
    ("Software Engineer", "swe"),
    ("Software Engineer", "se"),
    ("Backend Developer", "be"),
    ("Frontend Developer", "fe"),
    ("Fullstack Developer", "fsd"),
    ("DevOps Engineer", "dev ops"),
    ("QA/QC Engineer", "qa"),
    ("QA/QC Engineer", "qc"),
    ("Automation Tester", "auto tester"),
    ("Performance QA Engineer", "perf tester"),
    ("Mobile Developer (Android/iOS/Flutter)", "flutter dev"),
    ("Mobile Developer (Android/iOS/Flutter)", "ios dev"),
    ("Mobile Developer (Android/iOS/Flutter)", "android dev"),
    ("Data Engineer", "de"),
    ("Data Scientist", "ds"),
    ("System Administrator", "sysadmin"),
    ("System Administrator", "system admin"),
    ("Network Engineer", "neteng"),
    ("Project Manager (IT PM)", "pm"),
    ("UI/UX Designer", "ux designer"),
    ("Business Analyst (BA)", "ba"),
    ("IT Support / Helpdesk", "helpdesk"),
    ("Cybersecurity Engineer", "cybersec"),
    ("Cybersecurity Engineer", "infosec"),
    ("Cybersecurity Engineer", "pentester"),
]


@dataclass(frozen=True)
class Contract:
    """Columns and key of one warehouse table."""

    columns: tuple[str, ...]
    key: tuple[str, ...]

    def conform(self, df: DataFrame) -> DataFrame:
        extra = ["month"] if "month" in df.columns else []
        return df.select(*[df[c].cast("string") for c in self.columns], *extra)


_DIM = Contract(("id", "name"), ("id",))


def _bridge(member: str) -> Contract:
    return Contract(("job_id", member), ("job_id", member))


WAREHOUSE = {
    "job_description_table": Contract(
        (
            "id", "job_title", "company_name", "posted_date", "url", "update_date", "salary",
            "location", "seniority_level", "position_id",
        ),
        ("id", "seniority_level"),
    ),
    "tech_skill_table": _DIM,
    "job_tech_skill_mapping": _bridge("tech_skill_id"),
    "soft_skill_table": _DIM,
    "job_soft_skill_mapping": _bridge("soft_skill_id"),
    "major_table": _DIM,
    "job_major_mapping": _bridge("major_id"),
    "job_position_table": _DIM,
}
