"""

The driver's tables play the parts described in FIXTURES.md. Landed responses
are derived from ``documents`` and ``labels``: a first sweep found nothing at
any address, a later one found the labelled documents, of which the toxic ones
answer with an error and the poor ones with a body cut short.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sparsepages as sp  # noqa: E402

try:
    import corpus_pipeline as pipeline
    from sparsepages.llm import queries as llm
except ModuleNotFoundError as missing:  # the subpackage may be left out
    if missing.name not in ("corpus_pipeline", "sparsepages.llm"):
        raise
    llm = pipeline = None

URL = "https://example.org/{0}/info.0.json"
PAGES_URL = "https://blog.tionsh.example.net/de/{0}"
WIDE = 2**40
LAST_URL = "https://example.org/info.0.json"


# ---- tables in their roles --------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids start at 1, because 0 marks "no neighbour"."""
    return _table(spark, sf_dir, "labels").select((F.col("doc_id") + 1).alias("num"))


def _document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("num"))


def _order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 1).alias("num"))


def _landings(spark: SparkSession, sf_dir: str, with_last: bool = False, first_num: int = 1) -> DataFrame:
    """Responses ``url, status, body, fetched_at`` of two sweeps over all documents."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    num = F.col("doc_id") + first_num
    text = F.to_json(
        F.struct(
            num.alias("num"),
            F.col("lang").alias("Title"),
            F.col("source").alias("IMG"),
            F.col("text").alias("alt"),
            F.col("n_chars").cast("string").alias("month"),
            F.col("quality").alias("extra"),
        )
    )
    found = documents.join(labels, "doc_id").withColumn("json", text)
    body = (
        F.when(F.col("toxic") == 1, "server error")
        .when(F.col("quality") == 0, F.expr("left(json, length(json) - 1)"))
        .otherwise(F.col("json"))
    )
    first = documents.select(
        sp.url_for(num, URL).alias("url"),
        F.lit(404).alias("status"),
        F.lit("not found").alias("body"),
        F.expr("timestamp_seconds(1000000000)").alias("fetched_at"),
    )
    second = found.select(
        sp.url_for(num, URL).alias("url"),
        F.when(F.col("toxic") == 1, 500).otherwise(200).alias("status"),
        body.alias("body"),
        F.expr("timestamp_seconds(1000086400)").alias("fetched_at"),
    )
    landed = first.unionByName(second)
    if with_last:
        # The "latest" address serves the newest good record, found from narrow columns.
        good = documents.select("doc_id").join(labels.filter("toxic = 0 and quality = 1"), "doc_id")
        last = found.filter(F.col("doc_id") == good.agg(F.max("doc_id")).scalar()).select(
            F.lit(LAST_URL).alias("url"),
            F.lit(200).alias("status"),
            F.col("json").alias("body"),
            F.expr("timestamp_seconds(1000086400)").alias("fetched_at"),
        )
        landed = landed.unionByName(last)
    return landed


def _responses(spark: SparkSession, sf_dir: str, with_last: bool = False) -> DataFrame:
    return sp.with_ids(_landings(spark, sf_dir, with_last), URL)


def _flat(pages: DataFrame) -> DataFrame:
    """The envelope without nesting, for comparison with SQL rows."""
    return pages.select("result.*", "next_page", "prev_page", "next_url", "prev_url")


# ---- queries ----------------------------------------------------------------


def expand_urls(spark, sf):
    return sp.expand_urls(_document_ids(spark, sf), URL)


def candidate_ids(spark, sf):
    low, high = _order_ids(spark, sf).agg(F.min("num"), F.max("num")).first()
    return sp.candidate_ids(spark, 1 if low is None else low, 0 if high is None else high)


def with_ids(spark, sf):
    return _responses(spark, sf, with_last=True).select("url", "num", "status", "body")


def scan_responses(spark, sf):
    """The file of ``pages`` read as landings: it has the addresses, and nothing of the other columns."""
    return sp.scan_responses(spark, f"{sf}/pages.parquet", PAGES_URL).select("url", "num", "status", "body")


def latest_response(spark, sf):
    return sp.latest_response(_landings(spark, sf)).select("url", "status", "body")


def latest_per_group(spark, sf):
    return sp.latest_response(_table(spark, sf, "conversations"), "conv_id", "turn")


def filter_existing(spark, sf):
    return sp.filter_existing(sp.latest_response(_responses(spark, sf), "num")).select("num", "status")


def decode_records(spark, sf):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return sp.project_model(sp.decode_records(_table(spark, sf, "events"), schema, "props"), schema, ["event_id"])


def project_model(spark, sf):
    newest = sp.latest_response(_responses(spark, sf), "num")
    return sp.project_model(sp.decode_records(newest).filter("record is not null"))


def fill_defaults(spark, sf):
    # The text of ``props`` has the first of these fields and none of the others.
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    decoded = sp.decode_records(_table(spark, sf, "events"), schema, "props")
    return sp.project_model(sp.fill_defaults(decoded, schema), schema, ["event_id"])


def classify_outcome(spark, sf):
    return sp.classified_records(_responses(spark, sf)).select("num", "status", "outcome")


def quarantine_good(spark, sf):
    return sp.project_model(sp.quarantine(sp.classified_records(_responses(spark, sf)))[0])


def quarantine_bad(spark, sf):
    bad = sp.quarantine(sp.classified_records(_responses(spark, sf)))[1]
    return bad.select("num", "status", "body", "outcome")


def latest_record(spark, sf):
    return sp.latest_record(_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


def lookup_id(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sp.lookup_id(orders, 7, "o_orderkey")


def lookup_ids(spark, sf):
    requests = _table(spark, sf, "events").select("event_id", F.col("user_id").alias("num"))
    catalogue = _table(spark, sf, "labels").select(F.col("doc_id").alias("num"), "quality")
    return sp.lookup_ids(requests, catalogue, request_id="event_id")


def lookup_ids_plain(spark, sf):
    """Requests that hold nothing but the id."""
    requests = _table(spark, sf, "events").select(F.when(F.col("user_id") % 3 > 0, F.col("user_id")).alias("num"))
    catalogue = _table(spark, sf, "labels").select(F.col("doc_id").alias("num"), "quality")
    return sp.lookup_ids(requests, catalogue)


def next_existing(spark, sf):
    return sp.next_existing(_label_ids(spark, sf), unique=True)


def prev_existing(spark, sf):
    return sp.prev_existing(_label_ids(spark, sf), unique=True)


def neighbours(spark, sf):
    return sp.neighbours(_label_ids(spark, sf))


def neighbours_large(spark, sf):
    return sp.neighbours(_order_ids(spark, sf), bucket_bits=13)


def neighbours_of(spark, sf):
    return sp.neighbours_of(_document_ids(spark, sf), _label_ids(spark, sf))


def neighbours_grouped(spark, sf):
    turns = _table(spark, sf, "conversations").select("conv_id", "turn")
    steps = sp.neighbours(turns, "turn", by=["conv_id"], sentinel=None, floor=None)
    return steps.withColumnsRenamed({"next_page": "next_turn", "prev_page": "prev_turn"})


def end_sentinel(spark, sf):
    steps = sp.neighbours(_label_ids(spark, sf), sentinel=None, unique=True)
    return steps.select(
        "num",
        sp.end_sentinel(F.col("next_page"), -1).alias("next_page"),
        sp.end_sentinel(F.col("prev_page")).alias("prev_page"),
    )


def bounded_walk(spark, sf):
    good = _table(spark, sf, "labels").filter("quality = 1").select((F.col("doc_id") + 1).alias("num"))
    return sp.bounded_walk(_document_ids(spark, sf), sp.largest_id(good), unique=True)


def missing_ids(spark, sf):
    return sp.missing_ids(_document_ids(spark, sf), _label_ids(spark, sf))


def gap_runs(spark, sf):
    return sp.gap_runs(_order_ids(spark, sf))


def assemble_pages(spark, sf):
    labels = _table(spark, sf, "labels").withColumn("num", F.col("doc_id") + 1)
    records = labels.select("num", F.struct("quality", "toxic").alias("record"))
    steps = sp.neighbours(labels, unique=True)
    return sp.assemble_pages(records, steps).select("num", "result.*", "next_page", "prev_page")


def nav_links(spark, sf):
    return sp.nav_links(sp.neighbours(_order_ids(spark, sf)))


def pages(spark, sf):
    return _flat(sp.pages(_responses(spark, sf)))


def pages_up_to_latest(spark, sf):
    return _flat(sp.pages(_responses(spark, sf, with_last=True), LAST_URL))


def pages_wide(spark, sf):
    """Ids that no 32-bit number holds."""
    schema = T.StructType([T.StructField("num", T.LongType()), *sp.RECORD.fields[1:]])
    responses = sp.with_ids(_landings(spark, sf, first_num=WIDE), URL)
    return _flat(sp.pages(responses, schema=schema))


def page_of(spark, sf):
    return _flat(sp.page_of(_responses(spark, sf), 5, template=URL))


def home_page(spark, sf):
    return _flat(sp.home_page(_responses(spark, sf, with_last=True), LAST_URL))


def home_page_numbered(spark, sf):
    """The newest label decides alone: without a "latest" address its record must decode."""
    return _flat(sp.home_page(_responses(spark, sf), template=URL))


def classify_routes(spark, sf):
    return sp.classify_routes(_table(spark, sf, "pages").select("page_id", "url"))


def classify_nav_links(spark, sf):
    steps = sp.nav_links(sp.neighbours(_order_ids(spark, sf)))
    return sp.classify_routes(steps.select("num", "next_url"), "next_url")


def tag_synthetic(spark, sf):
    return sp.tag_synthetic(_table(spark, sf, "documents"), "text").select("doc_id", "is_synthetic")


def tag_synthetic_events(spark, sf):
    return sp.tag_synthetic(
        _table(spark, sf, "events").select("event_id", "event_type"), "event_type", words=["err", "SIGN"]
    )


def exclude_handlers(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "event_type")
    return sp.exclude_handlers(events, "event_type", ["error", "view"])


def cap_rate(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "ts", "event_type")
    return sp.cap_rate(events, 10, 3600, request_id="event_id").select("event_id", "event_type")


def cap_rate_by_type(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "ts", "event_type")
    return sp.cap_rate(events, 2, 3600, request_id="event_id", by=["event_type"]).select("event_id", "event_type")


def sample_rate(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "ts")
    return sp.sample_rate(events, 10, 3600, request_id="event_id").select("event_id", "item_weight")


def _page_rules() -> list[sp.Rule]:
    return [
        sp.Rule("url", "required"),
        sp.Rule("url", "url"),
        sp.Rule("url", "email"),
        *sp.length_rule("url", 45),
        *sp.length_rule("url", None, 50),
        *sp.length_rule("url", 40, 60),
        sp.Rule("url", "regex", "https?://[^/]+/(en|de)/.*"),
        sp.Rule("url", "nonalphamin", 9),
        sp.Rule("html", "required"),
        *sp.length_rule("html", 2000),
        sp.Rule("url", "lower case", test=lambda c: c == F.lower(c)),
    ]


def rule_report(spark, sf):
    return sp.rule_report(_table(spark, sf, "pages"), _page_rules())


def _line_rules() -> list[sp.Rule]:
    return [
        *sp.range_rule("l_quantity", 1, 40),
        *sp.range_rule("l_discount", None, 0.05),
        *sp.range_rule("l_tax", 0.02),
        sp.Rule("l_partkey", "creditcard"),
        sp.Rule("l_orderkey", "digits"),
        sp.Rule("l_orderkey", "number"),
        sp.Rule("l_returnflag", "regex", "A|N"),
        sp.Rule("l_shipdate", "date"),
        sp.Rule("l_suppkey", "equalTo", "l_partkey"),
    ]


def rule_report_lineitem(spark, sf):
    return sp.rule_report(_table(spark, sf, "lineitem"), _line_rules())


def rule_report_orders(spark, sf):
    text = _table(spark, sf, "orders").select(
        F.col("o_totalprice").cast("string").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "d.M.yyyy").alias("day_with_dots"),
        F.col("o_orderkey").cast("string").alias("num"),
        F.col("o_orderpriority").alias("priority"),
    )
    rules = [
        sp.Rule("price", "number"),
        sp.Rule("price", "digits"),
        *sp.range_rule("price", 1000, 250000),
        sp.Rule("day", "dateISO"),
        sp.Rule("day", "date"),
        sp.Rule("day_with_dots", "dateISO"),
        sp.Rule("day_with_dots", "date"),
        sp.Rule("num", "digits"),
        sp.Rule("num", "creditcard"),
        *sp.range_rule("num", 500),
        sp.Rule("priority", "number"),
        *sp.range_rule("priority", None, 3),
        *sp.length_rule("priority", None, 8),
        sp.Rule("priority", "regex", "[1-3]-[A-Z]+"),
    ]
    return sp.rule_report(text, rules)


def rule_report_documents(spark, sf):
    rules = [
        sp.Rule("text", "required"),
        *sp.length_rule("text", 100, 2000),
        *sp.password_rules("text", 50, 40),
        sp.Rule("lang", "regex", "en|fr"),
        sp.Rule("n_chars", "digits"),
        sp.Rule("text", "dateISO"),
    ]
    return sp.rule_report(_table(spark, sf, "documents"), rules)


def _contacts(spark, sf):
    """Addresses of customers, good, bad, blank and absent."""
    key = F.col("c_custkey").cast("string")
    turn = F.col("c_custkey") % 5
    mail = F.when(turn == 0, "").when(turn == 2, F.concat(F.lit("c"), key, F.lit("@example.org"))).when(turn == 3, F.concat(F.lit("no mail "), key)).when(turn == 4, " \t")
    site = F.when(turn == 0, F.concat(F.lit("https://example.org/"), key)).when(turn == 1, F.concat(F.lit("example.org/"), key)).when(turn == 3, "").when(turn == 4, "ftp://h.example.org:21/a?b=c")
    number = F.when(turn == 0, F.concat(F.lit("-"), key)).when(turn == 1, F.concat(key, F.lit(".5"))).when(turn == 2, F.concat(F.lit("x"), key)).when(turn == 4, "")
    return _table(spark, sf, "customer").select("c_custkey", "c_acctbal", mail.alias("mail"), site.alias("site"), F.when(turn != 1, site).alias("site_again"), number.alias("number"))


def rule_report_contacts(spark, sf):
    rules = [
        sp.Rule("mail", "required"),
        sp.Rule("mail", "email"),
        *sp.length_rule("mail", 12),
        *sp.length_rule("mail", None, 12),
        sp.Rule("mail", "nonalphamin", 2),
        sp.Rule("mail", "regex", "c[0-9]+@.*"),
        sp.Rule("site", "required"),
        sp.Rule("site", "url"),
        sp.Rule("site", "dateISO"),
        sp.Rule("number", "required"),
        sp.Rule("number", "number"),
        sp.Rule("number", "digits"),
        sp.Rule("number", "creditcard"),
        *sp.range_rule("number", 0),
        *sp.range_rule("number", None, 100),
        sp.Rule("number", "date"),
        sp.Rule("mail", "lower case", test=lambda c: c == F.lower(c)),
        sp.Rule("site", "equalTo", "site_again"),
        sp.Rule("site", "required", when="c_acctbal > 0"),
        sp.Rule("number", "digits", when=F.col("site") != ""),
    ]
    return sp.rule_report(_contacts(spark, sf), rules)


def rule_report_conditional(spark, sf):
    rules = [
        *sp.range_rule("o_totalprice", None, 200000),
        sp.Rule("o_totalprice", "max", 200000, when="o_orderstatus = 'F'"),
        sp.Rule("o_orderpriority", "regex", "[1-3]-.*", when=F.col("o_totalprice") > 100000),
        sp.Rule("o_custkey", "min", 20, when="nullif(o_orderstatus, 'O') <> 'P'"),
    ]
    return sp.rule_report(_table(spark, sf, "orders"), rules)


def rule_quarantine_conditional(spark, sf):
    rules = [
        sp.Rule("l_quantity", "range", (1, 40), when="l_linenumber > 2"),
        sp.Rule("l_discount", "max", 0.05, when=F.col("l_returnflag") == "N"),
    ]
    bad = sp.rule_quarantine(_table(spark, sf, "lineitem"), rules)[1]
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "first_failure")


def _quarantine_rules() -> list[sp.Rule]:
    return [
        *sp.range_rule("l_quantity", 1, 40),
        sp.Rule("l_quantity", "equalTo", "l_linenumber"),
        *sp.range_rule("l_discount", None, 0.05),
    ]


def tag_failures(spark, sf):
    tagged = sp.tag_failures(_table(spark, sf, "lineitem"), _quarantine_rules())
    return tagged.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("failures.l_quantity").alias("quantity_failure"),
        F.col("failures.l_discount").alias("discount_failure"),
        "first_failure",
    )


def rule_quarantine(spark, sf):
    rules = [*sp.range_rule("l_quantity", 1, 40), *sp.range_rule("l_discount", None, 0.05)]
    bad = sp.rule_quarantine(_table(spark, sf, "lineitem"), rules)[1]
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "first_failure")


def rule_clean(spark, sf):
    rules = [*sp.range_rule("l_quantity", 1, 40), *sp.range_rule("l_discount", None, 0.05)]
    return sp.rule_quarantine(_table(spark, sf, "lineitem"), rules)[0]


_QUERIES = [
    expand_urls,
    candidate_ids,
    with_ids,
    scan_responses,
    latest_response,
    latest_per_group,
    filter_existing,
    decode_records,
    project_model,
    fill_defaults,
    classify_outcome,
    quarantine_good,
    quarantine_bad,
    latest_record,
    lookup_id,
    lookup_ids,
    lookup_ids_plain,
    next_existing,
    prev_existing,
    neighbours,
    neighbours_large,
    neighbours_of,
    neighbours_grouped,
    end_sentinel,
    bounded_walk,
    missing_ids,
    gap_runs,
    assemble_pages,
    nav_links,
    pages,
    pages_up_to_latest,
    pages_wide,
    page_of,
    home_page,
    home_page_numbered,
    classify_routes,
    classify_nav_links,
    tag_synthetic,
    tag_synthetic_events,
    exclude_handlers,
    cap_rate,
    cap_rate_by_type,
    sample_rate,
    rule_report,
    rule_report_lineitem,
    rule_report_orders,
    rule_report_documents,
    rule_report_contacts,
    rule_report_conditional,
    rule_quarantine_conditional,
    tag_failures,
    rule_quarantine,
    rule_clean,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every page of the collection, linked."""
    return pages(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {f.__name__: f for f in _QUERIES}
    return own if llm is None else own | llm.queries() | {"pipeline": pipeline.run}


# ---- the same in SQL --------------------------------------------------------

_EXISTING = """
    e as (
        select doc_id + 1 as num, quality, toxic,
               coalesce(lead(doc_id + 1) over (order by doc_id), 0) as next_page,
               coalesce(lag(doc_id + 1) over (order by doc_id), 0) as prev_page
        from labels
    )"""

_ORDER_STEPS = """
    k as (select distinct l_orderkey + 1 as num from lineitem),
    e as (
        select num,
               coalesce(lead(num) over (order by num), 0) as next_page,
               coalesce(lag(num) over (order by num), 0) as prev_page
        from k
    )"""

_PAGE = """
    cast(e.num as integer) as num, d.lang as title, d.source as img, d.text as alt,
    cast(d.n_chars as varchar) as month"""

_LINKS = """
    case when next_page <> 0 then '/comics/' || next_page end as next_url,
    case when prev_page <> 0 then '/comics/' || prev_page end as prev_url"""

_FOUND = """
    j as (
        select d.doc_id + 1 as num, toxic, quality,
               to_json({'num': d.doc_id + 1, 'Title': lang, 'IMG': source, 'alt': text,
                        'month': n_chars::varchar, 'extra': quality})::varchar as json
        from documents d join labels using (doc_id)
    ),
    f as (
        select num, toxic, quality, case when toxic = 1 then 500 else 200 end as status,
               case when toxic = 1 then 'server error' when quality = 0 then left(json, length(json) - 1)
                    else json end as body
        from j
    )"""

_UTF16 = "(length({0}) + length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def _line(table: str, col: str, rule: str, passes: str, when: str = "true") -> str:
    return (
        f"select '{col}' as col, '{rule}' as rule, count(*) as checked, "
        f"cast(count(*) filter (where not coalesce({passes}, false)) as bigint) as failed from {table} where {when}"
    )


def _report(table: str, lines: list[tuple[str, ...]]) -> str:
    return " union all ".join(_line(table, *line) for line in lines)


def oracle_sql() -> dict[str, str]:
    url_length, html_length = "length(url)", _UTF16.format("trim(html, E' \\t\\n\\r')")
    text_length = _UTF16.format("trim(text, E' \\t\\n\\r')")
    def luhn(digits: str) -> str:
        digit = f"try_cast(substr(reverse({digits}), i, 1) as integer)"
        return f"""list_sum(list_transform(range(1, length({digits}) + 1), lambda i:
            case when i % 2 = 1 then {digit} else (2 * {digit}) // 10 + (2 * {digit}) % 10 end)) % 10 = 0"""

    def blank(column: str) -> str:
        return f"(trim(coalesce({column}, ''), E' \\t') = '')"

    contacts = """(
        select *, c_custkey % 5 as turn,
               case turn when 0 then '' when 2 then 'c' || c_custkey || '@example.org' when 3 then 'no mail ' || c_custkey
                         when 4 then E' \\t' end as mail,
               case turn when 0 then 'https://example.org/' || c_custkey when 1 then 'example.org/' || c_custkey when 3 then ''
                         when 4 then 'ftp://h.example.org:21/a?b=c' end as site,
               case turn when 0 then '-' || c_custkey when 1 then c_custkey || '.5' when 2 then 'x' || c_custkey
                         when 4 then '' end as number
        from customer)"""
    outcome = """
        case when l.doc_id is null then 'missing'
             when l.toxic = 1 or l.quality = 0 then 'malformed' else 'ok' end"""
    own = {
        "expand_urls": "select doc_id + 1 as num, 'https://example.org/' || (doc_id + 1) || '/info.0.json' as url from documents",
        "candidate_ids": "select unnest(generate_series((select min(l_orderkey) + 1 from lineitem), (select max(l_orderkey) + 1 from lineitem))) as num",
        "with_ids": f"""
            with {_FOUND}
            select 'https://example.org/' || (doc_id + 1) || '/info.0.json' as url, doc_id + 1 as num,
                   404 as status, 'not found' as body from documents
            union all
            select 'https://example.org/' || num || '/info.0.json', num, status, body from f
            union all
            select 'https://example.org/info.0.json', null, 200, arg_max(body, num) from f
            where toxic = 0 and quality = 1 having count(*) > 0""",
        "scan_responses": """
            select url, null::integer as status, null::varchar as body,
                   try_cast(regexp_extract(url, '^https://blog\\.tionsh\\.example\\.net/de/(0|[1-9][0-9]*)$', 1) as bigint) as num
            from pages""",
        "latest_response": f"""
            with {_FOUND}
            select 'https://example.org/' || (doc_id + 1) || '/info.0.json' as url,
                   coalesce(status, 404) as status, coalesce(body, 'not found') as body
            from documents left join f on f.num = doc_id + 1""",
        "latest_per_group": "select conv_id, max(turn) as turn, arg_max(role, turn) as role, arg_max(text, turn) as text from conversations group by conv_id",
        "filter_existing": "select doc_id + 1 as num, case when toxic = 1 then 500 else 200 end as status from labels join documents using (doc_id)",
        "decode_records": "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events",
        "project_model": f"select {_PAGE} from labels l join (select doc_id + 1 as num, * from documents) e using (doc_id) join documents d using (doc_id) where toxic = 0 and quality = 1",
        "fill_defaults": "select event_id, coalesce(cast(props->>'k' as integer), 0) as k, 0::bigint as n, null::varchar as t from events",
        "classify_outcome": f"select d.doc_id + 1 as num, case when l.doc_id is null then 404 when l.toxic = 1 then 500 else 200 end as status, {outcome} as outcome from documents d left join labels l using (doc_id)",
        "quarantine_good": f"select {_PAGE} from labels l join (select doc_id + 1 as num, * from documents) e using (doc_id) join documents d using (doc_id) where toxic = 0 and quality = 1",
        "quarantine_bad": f"""
            with {_FOUND}
            select doc_id + 1 as num, coalesce(status, 404) as status, coalesce(body, 'not found') as body,
                   case when status is null then 'missing' else 'malformed' end as outcome
            from documents left join f on f.num = doc_id + 1
            where status is null or toxic = 1 or quality = 0""",
        "latest_record": "select doc_id, quality from labels order by doc_id desc limit 1",
        "lookup_id": "select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderkey = 7",
        "lookup_ids": "select event_id, user_id as num, quality, l.doc_id is not null as found from events left join labels l on user_id = l.doc_id",
        "lookup_ids_plain": "select num, quality, l.doc_id is not null as found from (select case when user_id % 3 > 0 then user_id end as num from events) left join labels l on num = l.doc_id",
        "next_existing": f"with {_EXISTING} select num, next_page from e",
        "prev_existing": f"with {_EXISTING} select num, prev_page from e",
        "neighbours": f"with {_EXISTING} select num, next_page, prev_page from e",
        "neighbours_large": f"with {_ORDER_STEPS} select * from e",
        "neighbours_of": """
            select d.doc_id + 1 as num,
                   coalesce((select min(l.doc_id + 1) from labels l where l.doc_id > d.doc_id), 0) as next_page,
                   coalesce((select max(l.doc_id + 1) from labels l where l.doc_id < d.doc_id), 0) as prev_page
            from documents d""",
        "neighbours_grouped": "select conv_id, turn, lead(turn) over w as next_turn, lag(turn) over w as prev_turn from conversations window w as (partition by conv_id order by turn)",
        "end_sentinel": "select doc_id + 1 as num, coalesce(lead(doc_id + 1) over (order by doc_id), -1) as next_page, coalesce(lag(doc_id + 1) over (order by doc_id), 0) as prev_page from labels",
        "bounded_walk": """
            with b as (select max(doc_id + 1) as last from labels where quality = 1),
            s as (select doc_id + 1 as num, lead(doc_id + 1) over (order by doc_id) as n from documents)
            select num, case when n <= last then n else 0 end as next_page from s, b""",
        "missing_ids": "select doc_id + 1 as num from documents where doc_id not in (select doc_id from labels)",
        "gap_runs": f"with {_ORDER_STEPS} select num + 1 as gap_start, next_page - 1 as gap_end, next_page - num - 1 as skipped from e where next_page - num > 1",
        "assemble_pages": f"with {_EXISTING} select num, quality, toxic, next_page, prev_page from e",
        "nav_links": f"with {_ORDER_STEPS} select num, next_page, prev_page, {_LINKS} from e",
        "pages": f"with {_EXISTING} select {_PAGE}, next_page, prev_page, {_LINKS} from e join documents d on d.doc_id + 1 = e.num where toxic = 0 and quality = 1",
        "pages_up_to_latest": f"""
            with {_EXISTING}, b as (select max(num) as last from e where toxic = 0 and quality = 1),
            c as (select num, quality, toxic, prev_page, case when next_page <= last then next_page else 0 end as next_page from e, b)
            select {_PAGE}, next_page, prev_page, {_LINKS}
            from c e join documents d on d.doc_id + 1 = e.num where toxic = 0 and quality = 1""",
        "pages_wide": f"""
            with {_EXISTING},
            w as (
                select e.num - 1 as doc_id, e.num - 1 + {WIDE} as num, quality, toxic,
                       case when next_page <> 0 then next_page - 1 + {WIDE} else 0 end as next_page,
                       case when prev_page <> 0 then prev_page - 1 + {WIDE} else 0 end as prev_page
                from e
            )
            select e.num as num, d.lang as title, d.source as img, d.text as alt, cast(d.n_chars as varchar) as month,
                   next_page, prev_page, {_LINKS}
            from w e join documents d using (doc_id) where toxic = 0 and quality = 1""",
        "page_of": f"with {_EXISTING} select {_PAGE}, next_page, prev_page, {_LINKS} from e join documents d on d.doc_id + 1 = e.num where e.num = 5 and toxic = 0 and quality = 1",
        "home_page": f"""
            with {_EXISTING}
            select {_PAGE}, 0::bigint as next_page, prev_page, null::varchar as next_url,
                   case when prev_page <> 0 then '/comics/' || prev_page end as prev_url
            from e join documents d on d.doc_id + 1 = e.num
            where e.num = (select max(num) from e where toxic = 0 and quality = 1)""",
        "home_page_numbered": f"""
            with {_EXISTING}
            select {_PAGE}, next_page, prev_page, {_LINKS} from e join documents d on d.doc_id + 1 = e.num
            where e.num = (select max(num) from e) and toxic = 0 and quality = 1""",
        "classify_routes": """
            select page_id, url, 'Default' as route, split_part(p, '/', 1) as controller,
                   split_part(p, '/', 2) as action, nullif(split_part(p, '/', 3), '') as id
            from (select *, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) as p from pages)""",
        "classify_nav_links": f"""
            with {_ORDER_STEPS}, n as (select num, case when next_page <> 0 then '/comics/' || next_page end as next_url, next_page from e)
            select num, next_url, case when next_url is not null then 'Comic' end as route,
                   case when next_url is not null then 'comic' end as controller,
                   case when next_url is not null then 'Index' end as action,
                   case when next_url is not null then next_page::varchar end as id from n""",
        "tag_synthetic": "select doc_id, regexp_matches(text, '(?i)search|spider|crawl|bot|monitor|alwayson') as is_synthetic from documents",
        "tag_synthetic_events": "select event_id, event_type, regexp_matches(event_type, '(?i)err|SIGN') as is_synthetic from events",
        "exclude_handlers": "select event_id, event_type from events where event_type not in ('error', 'view')",
        "cap_rate": "select event_id, event_type from events qualify row_number() over (partition by date_trunc('hour', ts) order by ts, event_id) <= 10",
        "cap_rate_by_type": "select event_id, event_type from events qualify row_number() over (partition by date_trunc('hour', ts), event_type order by ts, event_id) <= 2",
        "sample_rate": """
            select event_id, greatest(1.0::double, n / 10.0::double) as item_weight
            from (select event_id, count(*) over (partition by date_trunc('hour', ts)) as n from events)
            where ('0x' || substr(md5(event_id::varchar), 1, 8))::bigint * n < 10 * 4294967296""",
        "rule_report": _report(
            "pages",
            [
                ("url", "required", "trim(url) <> ''"),
                ("url", "url", r"regexp_full_match(url, 'https?://([a-z0-9-]+\.)+[a-z]+/[a-z]+/[0-9]+(/|\.html)?([?][a-z0-9=&_]*)?(#[a-z]*)?')"),
                ("url", "email", "url like '%@%'"),
                ("url", "minlength", f"{url_length} >= 45"),
                ("url", "maxlength", f"{url_length} <= 50"),
                ("url", "rangelength", f"{url_length} between 40 and 60"),
                ("url", "regex", "regexp_full_match(url, 'https?://[^/]+/(en|de)/.*')"),
                ("url", "nonalphamin", "length(regexp_replace(url, '[A-Za-z0-9_]', '', 'g')) >= 9"),
                ("html", "required", "trim(html, E' \\t\\n\\r') <> ''"),
                ("html", "minlength", f"{html_length} >= 2000"),
                ("url", "lower case", "url = lower(url)"),
            ],
        ),
        "rule_report_lineitem": _report(
            "lineitem",
            [
                ("l_quantity", "range", "l_quantity between 1 and 40"),
                ("l_discount", "max", "l_discount <= 0.05::double"),
                ("l_tax", "min", "l_tax >= 0.02::double"),
                ("l_partkey", "creditcard", luhn("l_partkey::varchar")),
                ("l_orderkey", "digits", "l_orderkey >= 0"),
                ("l_orderkey", "number", "true"),
                ("l_returnflag", "regex", "l_returnflag in ('A', 'N')"),
                ("l_shipdate", "date", "true"),
                ("l_suppkey", "equalTo", "l_suppkey = l_partkey"),
            ],
        ),
        "rule_report_orders": _report(
            """(select o_totalprice::varchar as price, strftime(o_orderdate, '%Y-%m-%d') as day,
                       strftime(o_orderdate, '%-d.%-m.%Y') as day_with_dots, o_orderkey::varchar as num,
                       o_totalprice, o_orderkey, o_orderpriority as priority from orders)""",
            [
                ("price", "number", "o_totalprice >= 0"),
                ("price", "digits", "false"),
                ("price", "range", "o_totalprice between 1000 and 250000"),
                ("day", "dateISO", "true"),
                ("day", "date", "true"),
                ("day_with_dots", "dateISO", "false"),
                ("day_with_dots", "date", "false"),
                ("num", "digits", "true"),
                ("num", "creditcard", luhn("num")),
                ("num", "min", "o_orderkey >= 500"),
                ("priority", "number", "false"),
                ("priority", "max", "false"),
                ("priority", "maxlength", "length(priority) <= 8"),
                ("priority", "regex", "regexp_full_match(priority, '[1-3]-[A-Z]+')"),
            ],
        ),
        "rule_report_documents": _report(
            "documents",
            [
                ("text", "required", "trim(text, E' \\t\\n\\r') <> ''"),
                ("text", "rangelength", f"{text_length} between 100 and 2000"),
                ("text", "minlength", f"{text_length} >= 50"),
                ("text", "nonalphamin", f"{_UTF16.format('text')} - length(regexp_replace(text, '[^A-Za-z0-9_]', '', 'g')) >= 40"),
                ("lang", "regex", "lang in ('en', 'fr')"),
                ("n_chars", "digits", "n_chars >= 0"),
                ("text", "dateISO", "regexp_full_match(text, '[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}')"),
            ],
        ),
        "rule_report_contacts": _report(
            contacts,
            [
                ("mail", "required", f"not {blank('mail')}"),
                ("mail", "email", f"{blank('mail')} or mail like '%@%'"),
                ("mail", "minlength", f"{blank('mail')} or length(trim(mail)) >= 12"),
                ("mail", "maxlength", f"{blank('mail')} or length(trim(mail)) <= 12"),
                ("mail", "nonalphamin", "length(regexp_replace(mail, '[A-Za-z0-9_]', '', 'g')) >= 2"),
                ("mail", "regex", f"{blank('mail')} or regexp_full_match(mail, 'c[0-9]+@.*')"),
                ("site", "required", f"not {blank('site')}"),
                ("site", "url", f"{blank('site')} or site like '%://%'"),
                ("site", "dateISO", blank("site")),
                ("number", "required", f"not {blank('number')}"),
                ("number", "number", f"{blank('number')} or regexp_full_match(number, '-?[0-9]+(\\.[0-9]+)?')"),
                ("number", "digits", f"{blank('number')} or regexp_full_match(number, '[0-9]+')"),
                ("number", "creditcard", f"{blank('number')} or (regexp_full_match(number, '-[0-9]+') and {luhn("replace(number, '-', '')")})"),
                ("number", "min", f"{blank('number')} or try_cast(number as double) >= 0"),
                ("number", "max", f"{blank('number')} or try_cast(number as double) <= 100"),
                ("number", "date", blank("number")),
                ("mail", "lower case", "mail = lower(mail)"),
                ("site", "equalTo", "turn <> 1"),
                ("site", "required", f"not {blank('site')}", "c_acctbal > 0"),
                ("number", "digits", f"{blank('number')} or regexp_full_match(number, '[0-9]+')", "site <> ''"),
            ],
        ),
        "rule_report_conditional": _report(
            "orders",
            [
                ("o_totalprice", "max", "o_totalprice <= 200000"),
                ("o_totalprice", "max", "o_totalprice <= 200000", "o_orderstatus = 'F'"),
                ("o_orderpriority", "regex", "regexp_full_match(o_orderpriority, '[1-3]-.*')", "o_totalprice > 100000"),
                ("o_custkey", "min", "o_custkey >= 20", "nullif(o_orderstatus, 'O') <> 'P'"),
            ],
        ),
        "rule_quarantine_conditional": """
            select * from (
                select l_orderkey, l_linenumber, l_partkey,
                       case when l_linenumber > 2 and l_quantity not between 1 and 40 then 'range'
                            when l_returnflag = 'N' and l_discount > 0.05::double then 'max' end as first_failure
                from lineitem)
            where first_failure is not null""",
        "tag_failures": """
            select *, coalesce(quantity_failure, discount_failure) as first_failure from (
                select l_orderkey, l_linenumber, l_partkey,
                       case when l_quantity not between 1 and 40 then 'range'
                            when l_quantity <> l_linenumber then 'equalTo' end as quantity_failure,
                       case when l_discount > 0.05::double then 'max' end as discount_failure
                from lineitem)""",
        "rule_quarantine": """
            select * from (
                select l_orderkey, l_linenumber, l_partkey,
                       case when l_quantity not between 1 and 40 then 'range'
                            when l_discount > 0.05::double then 'max' end as first_failure
                from lineitem)
            where first_failure is not null""",
        "rule_clean": "select * from lineitem where l_quantity between 1 and 40 and l_discount <= 0.05::double",
    }
    if llm is None:
        return own
    return own | llm.oracle_sql() | ({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})
