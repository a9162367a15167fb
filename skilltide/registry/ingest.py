"""I-1..I-22 over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skilltide.functions import postings as p
from skilltide.operators import ingest as i
from skilltide.registry.core import query, shape, table, with_shapes
from skilltide.registry.expressions import STRIP
from skilltide.session import saved, scratch_dir
from skilltide.sources import files, listings
from skilltide.sources.dumps import scan_dump
from skilltide.streaming.ingest import dedupe_stream, ingest_stream, read_ingested

_ITEMS_SQL = r"""
WITH links AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)) AS card FROM pages),
cards AS (
  SELECT page_id, regexp_extract(card, '(?s)<a[^>]*href="([^"]*)"', 1) AS href,
         regexp_extract(card, '(?s)<a[^>]*>(.*?)</a>', 1) AS label
  FROM links WHERE regexp_matches(card, '(?s)<a[^>]*href="([^"]*)"'))
"""
_TEXT_SQL = (
    "replace(replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]+>', '', 'g'),"
    " '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"
)


def _text_sql(text: str) -> str:
    return STRIP.format(_TEXT_SQL.format(text))


_LINK_FIELDS = {
    "href": r'(?s)<a[^>]*href="([^"]*)"',
    "label": r"(?s)<a[^>]*>(.*?)</a>",
}


def _cards(spark, sf_dir):
    return listings.from_listing_html(
        table(spark, sf_dir, "pages"), fields=_LINK_FIELDS, keep=("page_id",)
    )


@query(
    "i1_scan",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000.0",
)
def i1(spark, sf_dir):
    return files.scan(
        spark,
        f"{sf_dir}/orders.parquet",
        where="o_orderstatus = 'F' AND o_totalprice > 1000.0",
        columns=["o_orderkey", "o_custkey"],
    )


@query("i2_count_where", "SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def i2(spark, sf_dir):
    recent = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return i.count_where(table(spark, sf_dir, "orders"), recent)


_HASHED_SQL = """
WITH hashed AS (SELECT md5(concat(user_id, CAST(ts AS DATE))) AS hash, event_id, event_type, ts FROM events)
"""
_WINNERS_SQL = """
SELECT hash, event_id, event_type FROM hashed WHERE event_type <> 'signup'
  AND hash NOT IN (SELECT hash FROM hashed WHERE event_type = 'signup')
QUALIFY row_number() OVER (PARTITION BY hash ORDER BY ts, event_id) = 1
"""


def _hashed(spark, sf_dir):
    day = F.col("ts").cast("date").cast("string")
    return table(spark, sf_dir, "events").select(
        F.md5(F.concat(F.col("user_id").cast("string"), day)).alias("hash"), "event_id", "event_type", "ts"
    )


_DUMP = (
    T.StructType().add("_id", "string").add("key", "long").add("status", "string").add("price", "double").add("day", "timestamp")
    .add("tags", T.ArrayType(T.StringType())).add("priority", "string")
)


@query(
    "i1_scan_dump",
    """
    SELECT 'k' || CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey AS key, o_orderpriority AS priority, o_totalprice AS price,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def i1_dump(spark, sf_dir):
    """Orders as documents of a store, written a JSON object a line, and read back with a pushed condition."""
    wrapped = lambda name, c: F.struct(c.alias(name))
    documents = table(spark, sf_dir, "orders").select(
        wrapped("$oid", F.concat(F.lit("k"), "o_orderkey")).alias("_id"), wrapped("$numberLong", F.col("o_orderkey").cast("string")).alias("key"),
        F.col("o_orderstatus").alias("status"), wrapped("$numberDouble", F.col("o_totalprice").cast("string")).alias("price"),
        wrapped("$date", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("day"), F.array("o_orderpriority").alias("tags"),
        F.col("o_orderpriority").alias("priority"),
    )
    path = scratch_dir(spark, "dump")
    documents.select(F.to_json(F.struct(*documents.columns))).write.text(path)
    read = scan_dump(spark, path, _DUMP, "status = 'F' AND priority IN ('1-URGENT', '5-LOW')")
    return read.select("_id", "key", "priority", "price", F.col("day").cast("date").cast("string").alias("day"))


@query("i3_insert_if_absent", _HASHED_SQL + _WINNERS_SQL)
def i3(spark, sf_dir):
    events = _hashed(spark, sf_dir)
    new = events.filter("event_type <> 'signup'")
    stored = events.filter("event_type = 'signup'")
    return i.insert_if_absent(new, stored, "hash", ["ts", "event_id"]).drop("ts")


@query("i3_insert_if_absent_fetched", _HASHED_SQL + _WINNERS_SQL)
def i3_fetched(spark, sf_dir):
    events = _hashed(spark, sf_dir)
    new = events.filter("event_type <> 'signup'")
    stored = events.filter("event_type = 'signup'")
    return i.insert_if_absent(new, stored, "hash", ["ts", "event_id"], fetch_payload=True).drop("ts")


@query(
    "i4_posting_hash",
    with_shapes(
        "raw",
        """
        SELECT _id, md5(concat(coalesce(nullif(company_name, 'src3'), 'None'), job_title, posted_date)) AS hash,
               md5(concat(job_title, company_name, posted_date)) AS legacy_hash FROM raw""",
    ),
)
def i4(spark, sf_dir):
    company = F.nullif(F.col("company_name"), F.lit("src3"))
    return shape(spark, sf_dir, "raw").select(
        "_id",
        p.posting_hash(company, "job_title", "posted_date").alias("hash"),
        p.posting_hash("company_name", "job_title", "posted_date", legacy_order=True).alias("legacy_hash"),
    )


@query(
    "i5_months",
    """
    WITH days AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders)
    SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS month, (SELECT count(*) FROM orders
      WHERE date_trunc('month', o_orderdate) = m) AS n
    FROM days, unnest(generate_series(CAST(date_trunc('month', a) AS TIMESTAMP),
      CAST(date_trunc('month', b) + INTERVAL 1 MONTH AS TIMESTAMP), INTERVAL 1 MONTH)) AS t(m)
    """,
)
def i5(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    first, last = orders.agg(F.trunc(F.min("d"), "month"), F.max("d")).first()
    per_month = orders.groupBy(F.trunc("d", "month").alias("month")).agg(F.count("*").alias("n"))
    return (
        i.months(spark, first, last)
        .join(per_month, "month", "left")
        .select(F.col("month").cast("string").alias("month"), F.coalesce("n", F.lit(0)).alias("n"))
    )


@query(
    "i6_bronze_slice",
    with_shapes(
        "jobs",
        """
        SELECT id, job_title FROM jobs
        WHERE posted_date >= DATE '1998-12-01' AND posted_date < DATE '1999-01-01'""",
    ),
)
def i6(spark, sf_dir):
    return i.bronze_slice(shape(spark, sf_dir, "jobs"), "1998-12-01").select("id", "job_title")


@query("i7_normalize_id", "SELECT p_partkey, concat(p_brand, '-', p_partkey) AS id FROM part")
def i7(spark, sf_dir):
    plain = F.concat("p_brand", F.lit("-"), "p_partkey")
    wrapped = F.concat(F.lit('{"$oid": "'), plain, F.lit('"}'))
    given = F.when(F.col("p_size") > 25, wrapped).otherwise(plain)
    return table(spark, sf_dir, "part").select("p_partkey", p.normalize_id(given).alias("id"))


@query(
    "i8_layer_round_trip",
    with_shapes("jobs", "SELECT id, CAST(date_trunc('month', posted_date) AS DATE) AS month FROM jobs"),
)
def i8(spark, sf_dir):
    root = scratch_dir(spark, "layer")
    jobs = shape(spark, sf_dir, "jobs").select("id", F.trunc("posted_date", "month").alias("month"))
    files.write_layer(jobs, root, "bronze", "jobs")
    return files.read_layer(spark, root, "bronze", "jobs")


@query("i9_jsonl_round_trip", "SELECT doc_id, text, nullif(lang, 'en') AS lang FROM documents")
def i9(spark, sf_dir):
    path = scratch_dir(spark, "jsonl")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.nullif(F.col("lang"), F.lit("en")).alias("lang")
    )
    files.write_jsonl(docs, path)
    return files.read_jsonl(spark, path, docs.schema)


@query(
    "i10_listing_a",
    """
    SELECT p_name AS job_title, CASE WHEN p_size > 40 THEN '' ELSE p_brand END AS company_name,
           concat('https://jobs.example.com/', p_partkey) AS url,
           CASE WHEN p_type = 'PROMO' THEN '' ELSE '2001-07-15' END AS posted_date,
           CAST(p_partkey AS VARCHAR) AS source_id,
           CASE WHEN p_type = 'SMALL' THEN 'Unknown' ELSE p_type END AS location, 'a' AS source
    FROM part
    """,
)
def i10(spark, sf_dir):
    company = F.when(F.col("p_size") <= 40, F.struct(F.col("p_brand").alias("display_name")))
    date = F.when(F.col("p_type") != "PROMO", F.struct(F.lit("2001-07-15 10:30:00").alias("date")))
    address = F.when(F.col("p_type") == "SMALL", F.lit(" ")).otherwise(
        F.concat(F.lit("1 Road, "), "p_type")
    )
    job = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        company.alias("company"),
        F.concat(F.lit("https://jobs.example.com/"), "p_partkey").alias("detail_url"),
        date.alias("refreshed"),
        F.struct(address.alias("sort_addresses")).alias("addresses"),
    )
    body = F.to_json(F.struct(F.array(job).alias("data")))
    return listings.from_listing_a(table(spark, sf_dir, "part").select(body.alias("body")))


@query(
    "i11_listing_b",
    """
    SELECT p_name AS job_title, p_brand AS company_name,
           CASE WHEN p_size > 25 THEN concat('https://jobs.example.com/', p_type, p_partkey, '-jv')
                ELSE concat('http://b.example.com/', p_partkey) END AS url,
           '2001-07-15' AS posted_date, CAST(p_partkey AS VARCHAR) AS source_id,
           CASE p_type WHEN 'SMALL' THEN 'Unknown' WHEN 'LARGE' THEN 'Unknown' ELSE p_brand END AS location,
           'b' AS source
    FROM part
    """,
)
def i11(spark, sf_dir):
    kind = F.col("p_type")
    city = F.struct(F.when(kind != "SMALL", F.col("p_brand")).alias("cityNameVI"))
    places = F.when(kind != "LARGE", F.array(city, F.struct(F.lit("second").alias("cityNameVI"))))
    url = F.when(F.col("p_size") <= 25, F.concat(F.lit("http://b.example.com/"), "p_partkey"))
    empty = F.when(kind == "PROMO", F.lit(""))
    job = F.struct(
        F.col("p_name").alias("jobTitle"),
        F.col("p_brand").alias("companyName"),
        F.coalesce(url, empty).alias("jobUrl"),
        kind.alias("alias"),
        F.col("p_partkey").alias("jobId"),
        F.lit("2001-07-15T09:00:00").alias("approvedOn"),
        places.alias("workingLocations"),
    )
    body = F.to_json(F.struct(F.array(job).alias("data")))
    return listings.from_listing_b(
        table(spark, sf_dir, "part").select(body.alias("body")), "https://jobs.example.com"
    )


@query(
    "i12_listing_html",
    _ITEMS_SQL + f"SELECT page_id, {_text_sql('href')} AS href, {_text_sql('label')} AS label FROM cards",
)
def i12(spark, sf_dir):
    return _cards(spark, sf_dir)


# Landed pages of the other sources are built from the words of ``pages``: the plain text of a page, cut in
# pieces, stands where such a page has its fields, in nested blocks and with attributes in several orders.
_PIECES = "string_split(trim(regexp_replace(regexp_replace(html, '<[^>]*>|&[a-z]+;|[<>&]', ' ', 'g'), '\\s+', ' ', 'g')), ' ')"


def _pieces(spark, sf_dir):
    """page_id, url, first word, second word, all words as one text."""
    plain = F.regexp_replace("html", "<[^>]*>|&[a-z]+;|[<>&]", " ")
    words = F.split(F.trim(F.regexp_replace(plain, r"\s+", " ")), " ")
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.get(words, 0).alias("w1"), F.get(words, 1).alias("w2"), F.array_join(words, " ").alias("whole")
    )


def _said(*parts):
    return F.concat(*[F.lit(p) if p[:1] == "<" or p[-1:] == ">" or " " in p else F.col(p) for p in parts])


@query(
    "i13_job_html",
    f"""
    WITH p AS (SELECT page_id, w[1] AS w1, w[2] AS w2, array_to_string(w, ' ') AS whole FROM (SELECT page_id, {_PIECES} AS w FROM pages))
    SELECT page_id, w1 AS title, w2 AS company_name, CASE WHEN page_id % 2 = 0 THEN w1 ELSE '' END AS company_field,
           '100 people' AS company_scope, concat(w2, ' years') AS experience,
           concat('Yêu cầu ứng viên', chr(10), whole, chr(10), w1, chr(10), w2, chr(10), 'end') AS requirements
    FROM p
    """,
)
def i13(spark, sf_dir):
    field = F.when(F.col("page_id") % 2 == 0, _said('<div id="v" class="x company-value">', "w1", "</div>")).otherwise(F.lit(""))
    html = F.concat(
        _said("<title> ", "w1", " làm việc tại here</title><div class='big company-name'>", "w2", "</div>"),
        F.lit('<div class="job-detail__company--information-item company-field">'), field, F.lit("</div>"),
        F.lit('<div data-x="1" class="company-scale job-detail__company--information-item"><div class="company-value">100 people</div></div>'),
        F.lit('<div class="job-detail__info--section-content"><div class="job-detail__info--section-content-title">Mức lương</div>'),
        F.lit('<div class="job-detail__info--section-content-value">no</div></div><div class="b job-detail__info--section-content">'),
        F.lit('<div><div class="job-detail__info--section-content-title a">Kinh nghiệm</div></div><p></p>'),
        F.lit('<div><div class="job-detail__info--section-content-value"><div>'),
        _said("w2", "</div><div> years</div></div></div></div>", '<div class="job-description__item"><h3>Mô tả</h3><div>no</div></div>'),
        _said('<div id="r" class="a job-description__item b"><h3>Yêu cầu ứng viên</h3><div><p>', "whole", "</p><div>", "w1", "</div></div><div>", "w2", "</div>"),
        F.lit('<p>end</p></div><div class="job-description__item"><h3>Quyền lợi</h3>no</div>'),
    )
    pages = _pieces(spark, sf_dir).select("page_id", html.alias("html"))
    return listings.from_job_html(pages, keep=("page_id",))


@query(
    "i12_listing_cards",
    f"""
    WITH p AS (SELECT page_id, url, w[1] AS w1, w[2] AS w2 FROM (SELECT page_id, url, {_PIECES} AS w FROM pages))
    SELECT page_id, w1 AS job_title, w2 AS company_name, 'Ha Noi' AS location, '2001-08-01' AS posted_date,
           unnest([concat('https://jobs.example.com/', page_id), concat('https://jobs.example.com/second-', page_id)]) AS url
    FROM p WHERE w1 <> '' AND w2 IS NOT NULL
    """,
)
def i12_cards(spark, sf_dir):
    def card(link):
        return F.concat(
            F.lit("<li>"), link, _said('<h3 id="t" class="base-search-card__title x">', "w1", "</h3><h4 class='a base-search-card__subtitle'><b>", "w2", "</b></h4>"),
            F.lit('<span class="job-search-card__location">Ha Noi</span><time class="t" datetime="2001-08-01">now</time></li>'),
        )

    first = F.concat(F.lit('<a class="base-card__full-link z" href="https://jobs.example.com/'), "page_id", F.lit('">x</a>'))
    second = F.concat(F.lit('<a href="https://jobs.example.com/second-'), "page_id", F.lit('" class="q base-card__full-link">x</a>'))
    html = F.concat(F.lit("<ul>"), card(first), F.lit("<li>nothing</li>"), card(second), F.lit("</ul>"))
    pages = _pieces(spark, sf_dir).filter("w1 <> '' AND w2 IS NOT NULL").select("page_id", html.alias("html"))
    return listings.from_listing_html(pages, keep=("page_id",))


@query(
    "i13_detail_page",
    f"""
    WITH p AS (SELECT page_id, w[1] AS w1, w[2] AS w2, array_to_string(w, ' ') AS whole FROM (SELECT page_id, {_PIECES} AS w FROM pages))
    SELECT page_id, concat('https://jobs.example.com/a-', page_id) AS url, CAST(page_id AS VARCHAR) AS source_id,
           w1 AS job_title, w2 AS company_name, 'Ha Noi' AS location,
           '2001-07-30' AS posted_date,
           concat('Job description:', chr(10), 'Job description', chr(10), whole, chr(10), w1, chr(10), chr(10),
                  'Your skills:', chr(10), 'Your skills', chr(10), w2) AS full_text_jd,
           concat(whole, chr(10), w2) AS text_a, concat(w1, chr(10), chr(10), whole) AS text_b, concat(w1, chr(10), w2) AS text_c
    FROM p WHERE w1 <> '' AND w2 IS NOT NULL
    """,
)
def i13_detail(spark, sf_dir):
    html = F.concat(
        F.lit('<h3 class="c" data-url="https://jobs.example.com/a-'), "page_id", F.lit('?x=1"></h3>'),
        _said('<div class="job-header-info w"><h1>', "w1", '</h1><div><a href="#" class="employer-name">', "w2", "</a></div></div>"),
        F.lit('<div><svg><use href="x#map-pin"></use></svg><span> 1 Road, Ha Noi </span></div><span>Posted 2 days ago</span>'),
        _said('<section><div class="imy-5 paragraph"><h2>Top reasons</h2>no</div><div class="paragraph imy-5"><h2>Job description</h2><div>', "whole", "</div><div><div>", "w1", "</div></div></div>"),
        _said('<div id="k" class="imy-5 paragraph"><h2>Your skills</h2>', "w2", "</div></section>"),
        _said('<div class="x" id="JobDescription"><div>', "whole", "<svg>no</svg></div><i>no</i><p>", "w2", "</p></div>"),
        _said('<div class="vnwLayout__col">', "w1", '</div><div class="vnwLayout__col"><div>', "whole", "</div></div>"),
        _said('<div class="show-more-less-html__markup a">', "w1", "<br><br>", "w2", "</div>"),
    )
    pages = _pieces(spark, sf_dir).filter("w1 <> '' AND w2 IS NOT NULL").select("page_id", html.alias("html"), F.lit("2001-08-01 00:00:00").alias("update_date"))
    pages = saved(pages, "pages")  # read three times
    details = listings.from_detail_html(pages, keep=("page_id",))
    cards = listings.from_card_html(pages, keep=("page_id",))
    texts = pages.select(
        "page_id", listings.description_text("html", "a").alias("text_a"),
        listings.blocks_text("html", "div", "vnwLayout__col").alias("text_b"), listings.description_text("html", "c").alias("text_c"),
    )
    return cards.join(details, "page_id").join(texts, "page_id")


@query(
    "i14_jsonld_date",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
    FROM orders
    """,
)
def i14(spark, sf_dir):
    status = F.col("o_orderstatus")
    day = F.when(status == "O", F.col("o_orderdate").cast("date").cast("string")).otherwise(
        F.lit("2025-02-30")
    )
    block = F.concat(F.lit('{"@type": "JobPosting", "datePosted": "'), day, F.lit('"}'))
    body = F.when(status == "P", F.lit('{"broken')).otherwise(block)
    html = F.concat(
        F.lit('<html>\n<script type="application/ld+json">\n'), body, F.lit("\n</script><p>x</p></html>")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", p.jsonld_date(html).cast("string").alias("day")
    )


@query(
    "i15_assemble_sections",
    f"""
    WITH p AS (SELECT page_id, w[1] AS w1, w[2] AS w2, array_to_string(w, ' ') AS whole FROM (SELECT page_id, {_PIECES} AS w FROM pages))
    SELECT page_id, concat('Job description:', chr(10), 'Job description', chr(10), whole, chr(10), w1, chr(10), chr(10),
           'Your SKILLS:', chr(10), 'Your SKILLS', chr(10), w2) AS body
    FROM p WHERE w1 <> '' AND w2 IS NOT NULL
    """,
)
def i15(spark, sf_dir):
    html = F.concat(
        F.lit('<div class="imy-5 paragraph"><h2>Top 3 reasons</h2><div>no</div></div>'),
        _said('<div id="j" class="a paragraph imy-5"><h2> Job description</h2><div><div>', "whole", "</div></div><p>", "w1", "</p></div> outside"),
        _said('<div class="imy-5 paragraph"><h2>Your SKILLS</h2><div>', "w2", "</div></div>"),
    )
    pages = _pieces(spark, sf_dir).filter("w1 <> '' AND w2 IS NOT NULL")
    return pages.select("page_id", p.assemble_sections(listings.page_blocks(html)).alias("body"))


@query(
    "i16_union_sources",
    """
    SELECT c_name AS company_name, CAST(c_nationkey AS BIGINT) AS place, c_mktsegment AS experience FROM customer
    UNION ALL SELECT s_name, CAST(s_nationkey AS BIGINT), NULL FROM supplier
    """,
)
def i16(spark, sf_dir):
    first = i.conform(
        table(spark, sf_dir, "customer"),
        {"company_name": "c_name", "place": F.col("c_nationkey").cast("bigint"), "experience": "c_mktsegment"},
    )
    second = i.conform(
        table(spark, sf_dir, "supplier"),
        {"place": F.col("s_nationkey").cast("bigint"), "company_name": "s_name"},
    )
    return i.union_sources(first, second)


_GAPS_SQL = """
  gaps AS (SELECT _id, nullif(company_name, 'src3') AS company_name, job_title,
                  CASE WHEN location = 'de' THEN concat('ftp', url) ELSE url END AS url,
                  CASE WHEN location = 'es' THEN concat(chr(10), ' ') ELSE full_text_jd END AS full_text_jd
           FROM raw)
"""


def _gaps(spark, sf_dir):
    place = F.col("location")
    return shape(spark, sf_dir, "raw").select(
        "_id",
        F.nullif(F.col("company_name"), F.lit("src3")).alias("company_name"),
        "job_title",
        F.when(place == "de", F.concat(F.lit("ftp"), "url")).otherwise(F.col("url")).alias("url"),
        F.when(place == "es", F.lit("\n ")).otherwise(F.col("full_text_jd")).alias("full_text_jd"),
    )


@query(
    "i17_valid_postings",
    with_shapes(
        "raw",
        f"""WITH {_GAPS_SQL} SELECT _id FROM gaps WHERE company_name <> '' AND job_title <> ''
            AND url LIKE 'http%' AND length(trim(full_text_jd, concat(' ', chr(10)))) > 0""",
    ),
)
def i17(spark, sf_dir):
    return i.valid_postings(_gaps(spark, sf_dir)).select("_id")


@query(
    "i17_rejected_postings",
    with_shapes(
        "raw",
        f"""WITH {_GAPS_SQL} SELECT _id FROM gaps WHERE company_name IS NULL OR job_title = ''
            OR url LIKE 'ftp%' OR length(trim(full_text_jd, concat(' ', chr(10)))) = 0""",
    ),
)
def i17_rejects(spark, sf_dir):
    return _gaps(spark, sf_dir).filter(~i.posting_is_valid()).select("_id")


@query(
    "i18_stamp_update",
    "SELECT doc_id, '2001-08-01 12:00:00' AS update_date FROM documents",
)
def i18(spark, sf_dir):
    docs = i.stamp_update(table(spark, sf_dir, "documents").select("doc_id"), "2001-08-01 12:00:00")
    return docs.withColumn("update_date", F.col("update_date").cast("string"))


@query(
    "i19_batch_slice",
    """
    SELECT url, html, CAST(batch AS BIGINT) AS batch FROM (
      SELECT url, html, page_id, (row_number() OVER (ORDER BY url, page_id) - 1) // 10 AS batch FROM pages)
    WHERE batch >= 2 AND batch < 5
    """,
)
def i19(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return i.batch_slice(pages, ["url", "page_id"], 10, 2, 3).select("url", "html", "batch")


@query("i19_batch_count", "SELECT CAST(ceil(count(*) / 30) AS BIGINT) AS batches FROM pages")
def i19_count(spark, sf_dir):
    return i.batch_count(table(spark, sf_dir, "pages"), 30)


@query(
    "i20_concat",
    "SELECT n_name AS name, 'n' AS kind FROM nation UNION ALL SELECT r_name, 'r' FROM region"
    " UNION ALL SELECT s_name, 's' FROM supplier",
)
def i20(spark, sf_dir):
    def named(name, column, kind):
        return table(spark, sf_dir, name).select(F.col(column).alias("name"), F.lit(kind).alias("kind"))

    return i.concat(
        named("nation", "n_name", "n"),
        named("region", "r_name", "r").select("kind", "name"),
        named("supplier", "s_name", "s"),
    )


@query(
    "i21_keep_links",
    _ITEMS_SQL
    + f"SELECT page_id, {_text_sql('href')} AS href FROM cards WHERE href <> '' AND label <> 'the'",
)
def i21(spark, sf_dir):
    cards = _cards(spark, sf_dir)
    branded = F.when(F.col("label") == "the", F.concat(F.lit("/brand/"), "href"))
    links = cards.select("page_id", F.coalesce(branded, "href").alias("href"))
    return i.keep_links(links)


_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _event_stream(spark, sf_dir):
    files_of = spark.readStream.schema(_EVENTS).option("pathGlobFilter", "events.parquet")
    stream = files_of.parquet(sf_dir)
    day = F.col("ts").cast("date").cast("string")
    return stream.select(
        F.md5(F.concat(F.col("user_id").cast("string"), day)).alias("hash"), "event_id", "event_type", "ts"
    )


@query(
    "i22_ingest_stream",
    _HASHED_SQL
    + """SELECT hash, event_id, event_type FROM hashed
         QUALIFY row_number() OVER (PARTITION BY hash ORDER BY ts, event_id) = 1""",
)
def i22(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    stream = _event_stream(spark, sf_dir)
    run = ingest_stream(stream, f"{root}/postings", "hash", ["ts", "event_id"], f"{root}/checkpoint")
    run.awaitTermination()
    return read_ingested(spark, f"{root}/postings").drop("ts")


@query("i22_dedupe_stream", _HASHED_SQL + "SELECT DISTINCT hash FROM hashed")
def i22_watermark(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    stream = _event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    run = (
        dedupe_stream(stream, "ts", "2 days", "hash")
        .select("hash")
        .writeStream.format("parquet")
        .option("path", f"{root}/hashes")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{root}/hashes")
