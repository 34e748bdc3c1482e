"""Text to numbers and categories, label lines, HTML pages.

Raw texts that the tables do not hold are spelled from their columns by CASE
expressions, which Spark and the checking SQL evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keypanel.functions.rules import LOOKBACK_WORDS, RuleSet, classify
from keypanel.functions.text import duration_days, first_amount, last_amount, mentions, normalized, years_back
from keypanel.functions.rates import flag
from keypanel.operators.aggregate import profile_by_key
from keypanel.operators.needles import classify_by_table
from keypanel.plans.attributes import enforcement_attributes, page_attributes, penalties
from keypanel.sources import html
from keypanel.sources.lines import label_values, with_line_pairs
from workload.registry import query, table

# ---------------------------------------------------------------------------
# Texts spelled from the columns of `part`
# ---------------------------------------------------------------------------

FINE_TEXT = """CASE p_type WHEN 'PROMO' THEN 'varies'
  WHEN 'MEDIUM' THEN concat('$', {price}, '+') ELSE concat('$', {price}, '–$', {high}) END"""
FINE_SPARK = FINE_TEXT.format(price="format_number(floor(p_retailprice), 0)",
                              high="format_number(floor(p_retailprice) * p_size, 0)")
FINE_DUCK = FINE_TEXT.format(price="format('{:,}', CAST(floor(p_retailprice) AS BIGINT))",
                             high="format('{:,}', CAST(floor(p_retailprice) AS BIGINT) * p_size)")

JAIL_TEXT = """CASE p_type WHEN 'STANDARD' THEN concat(CAST(p_size AS STRING), '–180 days')
  WHEN 'ECONOMY' THEN concat(CAST(p_size AS STRING), ' hrs') WHEN 'MEDIUM' THEN concat('Up to ', CAST(p_size AS STRING), ' year')
  WHEN 'PROMO' THEN 'None (standard)' WHEN 'SMALL' THEN concat(CAST(p_size AS STRING), ' months min.')
  WHEN 'LARGE' THEN concat(CAST(p_size AS STRING), ' hrs–6 months') END"""

LOOKBACK_TEXT = """CASE WHEN p_size <= 20 THEN concat(CAST(p_size AS STRING), ' years') WHEN p_size <= 30 THEN 'Lifetime'
  WHEN p_size <= 40 THEN 'varies' END"""

DEVICE_TEXT = """CASE p_type WHEN 'STANDARD' THEN 'All offenders' WHEN 'ECONOMY' THEN 'Repeat only'
  WHEN 'MEDIUM' THEN 'High BAC' WHEN 'PROMO' THEN 'Judge' END"""

LOOKBACK_WORDS_TEXT = """CASE WHEN p_size <= 5 THEN 'Five years' WHEN p_size <= 10 THEN 'Fifty five years'
  WHEN p_size <= 15 THEN 'Seventy Five Years' WHEN p_size <= 20 THEN 'ten years' WHEN p_size <= 25 THEN 'Seven years'
  WHEN p_size <= 30 THEN ' Lifetime ' WHEN p_size <= 35 THEN 'fifteen years' WHEN p_size <= 40 THEN 'none stated' END"""

# Wordings that the attribute rules look for.
ENFORCEMENT_TEXT = {
    "sobriety_checkpoints": """CASE p_type WHEN 'STANDARD' THEN ' Permitted ' WHEN 'ECONOMY' THEN 'Prohibited by case law'
      WHEN 'MEDIUM' THEN 'No statutory authority' WHEN 'PROMO' THEN 'ALTERNATIVE programs' WHEN 'SMALL' THEN 'pending' END""",
    "no_refusal_programs": """CASE p_type WHEN 'STANDARD' THEN 'State utilizes a program' WHEN 'ECONOMY' THEN 'State has legal authority'
      WHEN 'MEDIUM' THEN 'State lacks authority' WHEN 'PROMO' THEN 'under review' END""",
    "roadside_preliminary_breath_test_pbt_laws": """CASE p_type WHEN 'STANDARD' THEN 'Statute permits tests'
      WHEN 'ECONOMY' THEN 'Statute doesn''t explicitly permit' WHEN 'MEDIUM' THEN 'not explicitly named' WHEN 'PROMO' THEN 'silent' END""",
    "ignition_interlocks": """CASE p_type WHEN 'STANDARD' THEN 'Mandatory all offender' WHEN 'ECONOMY' THEN 'Mandatory high-BAC and repeat'
      WHEN 'MEDIUM' THEN 'Mandatory repeat' WHEN 'PROMO' THEN 'Incentivized first, mandatory repeat'
      WHEN 'SMALL' THEN 'Discretionary' WHEN 'LARGE' THEN 'none' END""",
    "felony_dui": """CASE p_type WHEN 'STANDARD' THEN 'Second offense' WHEN 'ECONOMY' THEN 'Third offense'
      WHEN 'MEDIUM' THEN 'Fourth offense' WHEN 'PROMO' THEN 'No felony DUI for a third offense' WHEN 'SMALL' THEN 'varies' END""",
    "dui_look_back_periods": LOOKBACK_WORDS_TEXT,
    "enhanced_penalties_for_high_bac": """CASE WHEN p_size <= 10 THEN '0.15' WHEN p_size <= 20 THEN ' .2 '
      WHEN p_size <= 30 THEN 'No enhanced penalties' WHEN p_size <= 40 THEN 'abc' END""",
    "open_container_alcohol": """CASE p_type WHEN 'STANDARD' THEN 'In compliance' WHEN 'ECONOMY' THEN 'Does not meet' WHEN 'MEDIUM' THEN 'x' END""",
    "duid_implied_consent_testing_methods": """CASE p_type WHEN 'STANDARD' THEN 'Blood, Oral Fluids' WHEN 'ECONOMY' THEN 'Blood' END""",
    "administrative_license_suspension_revocation": "CASE WHEN p_size <= 25 THEN 'Law ENACTED' WHEN p_size <= 40 THEN 'none' END",
}


def _duck(expression: str) -> str:
    return expression.replace("AS STRING", "AS VARCHAR")


DURATION_SQL = """CASE WHEN starts_with({t}, 'none') THEN CAST(0 AS DOUBLE)
  WHEN contains({t}, '–180') THEN TRY_CAST(regexp_extract({t}, '^([0-9]+)', 1) AS DOUBLE)
  WHEN contains({t}, 'up to') THEN TRY_CAST(regexp_extract({t}, 'up to ([0-9]+)', 1) AS DOUBLE) * 365
  WHEN contains({t}, 'hrs') THEN TRY_CAST(regexp_extract({t}, '^([0-9]+) hrs', 1) AS DOUBLE) / 24
  WHEN contains({t}, 'months') THEN TRY_CAST(regexp_extract({t}, '^([0-9]+) months', 1) AS DOUBLE) * 30 END"""

LOOKBACK_SQL = """CASE WHEN regexp_matches({t}, '[0-9]+ *year') THEN CAST(regexp_extract({t}, '([0-9]+) *year', 1) AS INTEGER)
  WHEN contains({t}, 'lifetime') THEN 99 END"""

FIRST_SQL = r"TRY_CAST(replace(nullif(regexp_extract({t}, '\$([0-9,]+)', 1), ''), ',', '') AS DOUBLE)"
LAST_SQL = r"TRY_CAST(replace(list_extract(regexp_extract_all({t}, '\$([0-9,]+)', 1), -1), ',', '') AS DOUBLE)"


@query(f"""
SELECT p_partkey, {FIRST_SQL.format(t='t')} AS first_amount, {LAST_SQL.format(t='t')} AS last_amount
FROM (SELECT p_partkey, {FINE_DUCK} AS t FROM part)
""")
def money_text(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.expr(FINE_SPARK).alias("t"))
    return parts.select("p_partkey", first_amount(F.col("t")).alias("first_amount"),
                        last_amount(F.col("t")).alias("last_amount"))


@query(f"""
SELECT p_partkey, round({DURATION_SQL.format(t='j')}, 2) AS days, {LOOKBACK_SQL.format(t='b')} AS lookback_years
FROM (SELECT p_partkey, lower({_duck(JAIL_TEXT)}) AS j, lower({_duck(LOOKBACK_TEXT)}) AS b FROM part)
""")
def duration_text(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.expr(JAIL_TEXT).alias("j"), F.expr(LOOKBACK_TEXT).alias("b"))
    return parts.select("p_partkey", F.round(duration_days(F.col("j")), 2).alias("days"),
                        years_back(F.col("b")).alias("lookback_years"))


@query(f"""
WITH a AS (SELECT p_partkey, {FINE_DUCK} AS f, lower({_duck(JAIL_TEXT)}) AS j, lower({DEVICE_TEXT}) AS d
           FROM part WHERE p_type <> 'LARGE'),
     b AS (SELECT p_partkey, lower({_duck(LOOKBACK_TEXT)}) AS l FROM part WHERE p_type <> 'SMALL')
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, {FIRST_SQL.format(t='f')} AS fine_min_dollars,
  {LAST_SQL.format(t='f')} AS fine_max_dollars, round({DURATION_SQL.format(t='j')}, 2) AS jail_min_days,
  round({DURATION_SQL.format(t='j')}, 2) AS suspension_days,
  CASE WHEN a.p_partkey IS NULL THEN NULL WHEN d IS NULL THEN 'unknown' WHEN contains(d, 'all') THEN 'all_offenders'
       WHEN contains(d, 'repeat') THEN 'repeat_only' WHEN contains(d, 'high bac') THEN 'high_bac' ELSE 'other' END AS device_category,
  {LOOKBACK_SQL.format(t='l')} AS lookback_years
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey
""")
def penalty_texts(spark, sf):
    parts = table(spark, sf, "part")
    amounts = parts.filter("p_type <> 'LARGE'").select(
        "p_partkey", F.expr(FINE_SPARK).alias("fines"), F.expr(JAIL_TEXT).alias("jail"),
        F.expr(JAIL_TEXT).alias("suspension"), F.expr(DEVICE_TEXT).alias("device"))
    windows = parts.filter("p_type <> 'SMALL'").select("p_partkey", F.expr(LOOKBACK_TEXT).alias("lookback"))
    merged = penalties(amounts, windows, "p_partkey")
    return merged.withColumns({c: F.round(c, 2) for c in ("jail_min_days", "suspension_days")})


WORDS_SQL = """CASE WHEN contains({t}, 'seventy five years') THEN 75 WHEN contains({t}, 'fifty five years') THEN 55
  WHEN contains({t}, 'fifteen years') THEN 15 WHEN contains({t}, 'twelve years') THEN 12
  WHEN contains({t}, 'seven years') THEN 7 WHEN contains({t}, 'five years') THEN 5
  WHEN contains({t}, 'ten years') THEN 10 WHEN contains({t}, 'lifetime') THEN 99 END"""


@query(f"""
SELECT years, count(*) AS n FROM (
  SELECT {WORDS_SQL.format(t='t')} AS years FROM (SELECT lower({LOOKBACK_WORDS_TEXT}) AS t FROM part)) GROUP BY 1
""")
def longest_needle_first(spark, sf):
    parts = table(spark, sf, "part").select(classify(F.expr(LOOKBACK_WORDS_TEXT), LOOKBACK_WORDS).alias("years"))
    return profile_by_key(parts, ["years"], {"n": F.count("*")}, drop_null_keys=False)


NAME_RULES = RuleSet(((("small",), "compact"), (("red", "hot"), "warm"), (("old",), "aged")),
                     default="other", missing="unknown")


@query("""
SELECT CASE WHEN name IS NULL THEN 'unknown' WHEN contains(name, 'small') THEN 'compact'
            WHEN contains(name, 'red') OR contains(name, 'hot') THEN 'warm' WHEN contains(name, 'old') THEN 'aged'
            ELSE 'other' END AS category, count(*) AS n
FROM (SELECT CASE WHEN p_type <> 'PROMO' THEN lower(p_name) END AS name FROM part) GROUP BY 1
""")
def classify_text(spark, sf):
    name = F.when(F.col("p_type") != "PROMO", F.upper("p_name"))
    parts = table(spark, sf, "part").select(classify(name, NAME_RULES).alias("category"))
    return profile_by_key(parts, ["category"], {"n": F.count("*")})


NEEDLE = "substring(t, CAST(1 + (doc_id * 7 + i * 131) % (length(t) - 16) AS INT), CAST(10 + i % 7 AS INT))"


@query(f"""
WITH texts AS (SELECT doc_id, trim(lower(text), {"concat(' ', chr(9), chr(10), chr(13), chr(12), chr(11))"}) AS t FROM documents),
rules AS (SELECT {NEEDLE} AS needle, doc_id * 10 + i AS rank FROM texts, range(10) AS r(i) WHERE length(t) > 16),
found AS (SELECT t, min(rank) AS rank FROM (SELECT DISTINCT t FROM texts) JOIN rules ON contains(t, needle) GROUP BY t)
SELECT doc_id, CASE WHEN texts.t IS NULL THEN 'unknown' WHEN rank IS NULL THEN 'other' ELSE concat('rule ', rank) END AS category
FROM texts LEFT JOIN found ON texts.t = found.t
""")
def needle_table_rules(spark, sf):
    """Ten needles from every document: 10,000 rules at the size that is checked."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    texts = documents.select("doc_id", normalized(F.col("text")).alias("t")).where("length(t) > 16")
    rules = texts.select("doc_id", "t", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).select(
        F.expr(NEEDLE).alias("needle"), F.expr("doc_id * 10 + i").alias("rank"), F.expr("concat('rule ', doc_id * 10 + i)").alias("result"))
    return classify_by_table(documents, "text", rules, default="other", missing="unknown").select("doc_id", "category")


def _enforcement_sql() -> str:
    raw = ", ".join(f"trim(lower({e})) AS r{i}" for i, e in enumerate(ENFORCEMENT_TEXT.values()))
    methods = ENFORCEMENT_TEXT["duid_implied_consent_testing_methods"]

    def cases(t, rules, default):
        whens = " ".join(f"WHEN {' OR '.join(f'contains({t}, {n!r})' for n in needles)} THEN {result}"
                         for needles, result in rules)
        return f"CASE WHEN {t} IS NULL THEN NULL {whens} ELSE {default} END"

    checkpoints = cases("r0", [(["permitted"], "'permitted'"), (["prohibited"], "'prohibited'"),
                               (["no statutory"], "'no_authority'"), (["alternative"], "'alternative'")], "'unknown'")
    refusal = cases("r1", [(["utilizes"], "'active'"), (["has legal authority"], "'authorized'"),
                           (["lacks"], "'not_authorized'")], "'unknown'")
    breath = ("CASE WHEN r2 IS NULL THEN NULL WHEN contains(r2, 'statute permits') THEN 'authorized' "
              "WHEN contains(r2, 'doesn''t explicitly') OR contains(r2, 'not explicitly') THEN 'not_explicit' ELSE 'unknown' END")
    interlock = cases("r3", [(["mandatory all offender"], "'mandatory_all'"),
                             (["mandatory high-bac and repeat"], "'mandatory_high_bac_repeat'"),
                             (["mandatory repeat"], "'mandatory_repeat'"),
                             (["incentivized"], "'incentivized_first_mandatory_repeat'"),
                             (["discretionary"], "'discretionary'")], "'unknown'")
    felony = cases("r4", [(["no felony"], "NULL"), (["second"], "2"), (["third"], "3"), (["fourth"], "4")], "NULL")
    container = cases("r7", [(["in compliance"], "'federal_compliant'"), (["does not meet"], "'non_compliant'")], "'unknown'")
    return f"""
WITH raw AS (SELECT p_partkey, {raw}, {methods} AS testing_methods FROM part),
coded AS (SELECT p_partkey, testing_methods, {checkpoints} AS checkpoints, {refusal} AS no_refusal_status, {breath} AS pbt_law,
  {interlock} AS iid_mandate, {felony} AS felony_dui_threshold, {WORDS_SQL.format(t='r5')} AS lookback_years,
  TRY_CAST(r6 AS DOUBLE) AS high_bac_threshold, {container} AS open_container,
  CAST(coalesce(contains(r8, 'oral'), false) AS INTEGER) AS allows_oral_fluid,
  CAST(coalesce(contains(r9, 'enacted'), false) AS INTEGER) AS als_alr_enacted FROM raw)
SELECT *, CAST(coalesce(checkpoints = 'permitted', false) AS INTEGER) AS checkpoints_permitted,
  CAST(coalesce(no_refusal_status = 'active', false) AS INTEGER) AS no_refusal_active,
  CAST(coalesce(pbt_law = 'authorized', false) AS INTEGER) AS pbt_authorized,
  CAST(coalesce(iid_mandate = 'mandatory_all', false) AS INTEGER) AS iid_all_offender,
  CAST(felony_dui_threshold IS NOT NULL AS INTEGER) AS has_felony_dui,
  CAST(high_bac_threshold IS NOT NULL AS INTEGER) AS has_high_bac_penalty,
  CAST(coalesce(open_container = 'federal_compliant', false) AS INTEGER) AS open_container_compliant
FROM coded"""


@query(_enforcement_sql())
def standard_attributes(spark, sf):
    # Spark reads a doubled quote inside a literal as the end of one literal and
    # the start of the next; an escaped quote is the same text.
    raw = table(spark, sf, "part").select(
        "p_partkey", *[F.expr(e.replace("doesn''t", "doesn\\'t")).alias(name) for name, e in ENFORCEMENT_TEXT.items()])
    return enforcement_attributes(raw, ["p_partkey"])


@query("""
SELECT lang, count(*) AS documents, CAST(sum(CAST(coalesce(quality = 1, false) AS INTEGER)) AS BIGINT) AS good,
  CAST(sum(CAST(coalesce(toxic = 1, false) AS INTEGER)) AS BIGINT) AS toxic,
  CAST(sum(CAST(contains(lower(text), 'license') AS INTEGER)) AS BIGINT) AS licensed
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
""")
def flag_totals(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", mentions(F.col("text"), "license").alias("licensed"))
    labelled = documents.join(table(spark, sf, "labels"), "doc_id", "left")
    return profile_by_key(labelled, ["lang"], {
        "documents": F.count("*"), "good": F.sum(flag(F.col("quality") == 1)),
        "toxic": F.sum(flag(F.col("toxic") == 1)), "licensed": F.sum("licensed")})


# ---------------------------------------------------------------------------
# Lines and pages
# ---------------------------------------------------------------------------

SPACE_SQL = "concat(' ', chr(9), chr(10), chr(13), chr(12), chr(11))"


def _lines_sql(text: str) -> str:
    return (f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, {SPACE_SQL})), "
            "lambda x: x <> '')")


def _label_sql(label: str, lines: str = "lines") -> str:
    """Line after the last occurrence of a label that is not the last line."""
    return f"""{lines}[list_extract(list_filter(range(1, len({lines})), lambda i: {lines}[i] = '{label}'), -1) + 1]"""


@query(f"""
SELECT doc_id, CAST(greatest(len(lines) - 1, 0) AS INTEGER) AS pairs, CAST(list_max(list_transform(lines[2:], lambda x: length(x))) AS INTEGER) AS longest_value
FROM (SELECT doc_id, {_lines_sql('text')} AS lines FROM documents)
""")
def label_value_lines(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    paired = with_line_pairs(documents, "text", "pairs")
    return paired.select("doc_id", F.size("pairs").alias("pairs"), F.array_max(
        F.transform("pairs", lambda pair: F.length(pair["next"]))).alias("longest_value"))


# A line that many documents share.
COMMON_LINE = "The and attion to thanedble the, anea. Eriner thanea."


@query(f"""
SELECT doc_id, {_label_sql(COMMON_LINE)} AS the_and_attion_to_thanedble_the_anea_eriner_thanea, {_label_sql('Of.')} AS of, {_label_sql('And ornd.')} AS and_ornd
FROM (SELECT doc_id, {_lines_sql('text')} AS lines FROM documents)
""")
def label_values_by_document(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return label_values(documents, "text", [COMMON_LINE, "Of.", "And ornd."]).drop("text")


PAGE_TEXT_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '<script\b.*?</script\s*>', chr(10), 'gsi'), '<style\b.*?</style\s*>', chr(10), 'gsi'), '<!--.*?-->', chr(10), 'gs'),
  '<[^>]*>', chr(10), 'gs')"""
for _entity, _sign in (("&nbsp;", "' '"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
                       ("&amp;", "'&'")):
    PAGE_TEXT_SQL = f"replace({PAGE_TEXT_SQL}, '{_entity}', {_sign})"


@query(f"""
SELECT page_id, {_label_sql('and')} AS and, {_label_sql('The')} AS the, {_label_sql('to')} AS to
FROM (SELECT page_id, {_lines_sql(PAGE_TEXT_SQL)} AS lines FROM pages)
""".replace(" AS and,", ' AS "and",').replace(" AS to", ' AS "to"').replace(" AS the,", ' AS "the",'))
def page_label_table(spark, sf):
    return page_attributes(table(spark, sf, "pages"), "html", ["page_id"], ["The", "and", "to"])


@query("""
SELECT page_id, count(*) AS links, CAST(sum(length(replace(replace(replace(label, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'))) AS BIGINT) AS label_chars
FROM (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a [^>]*>([^<]*)</a>', 1)) AS label FROM pages)
GROUP BY 1
""")
def html_records(spark, sf):
    records = html.page_records(table(spark, sf, "pages"), "nav li", {"label": "a", "whole": "", "absent": "a.none"})
    records = records.filter("error IS NULL")
    return profile_by_key(records, ["page_id"], {
        "links": F.count("*"), "label_chars": F.sum(F.length("label")).cast("bigint")})


@query("SELECT page_id, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS heading FROM pages")
def html_headings(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.heading(F.col("html")).alias("heading"))


PART_PAGE = """concat('<html><body><table><tr><th>Key</th></tr></table><table><thead><tr><th> Part Name </th><th>Part-Size</th></tr></thead>',
  '<tr><td>', p_name, '<td>', CAST(p_size AS STRING), '<tr><td><b>', p_brand, '</b></td><td>', p_type, ' &amp; more</td></tr></table>',
  '<table><tr><td>end</td></tr></table></body></html>')"""


def part_pages(spark, sf):
    """One page per part: three tables, the second with the part's columns.

    Parts are short, so a file of millions has few row groups; they are dealt out before they become pages.
    """
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_brand", "p_type")
    return html.dealt(parts).select(F.col("p_partkey").alias("page_id"), F.expr(PART_PAGE).alias("html"))


@query("""
SELECT p_partkey AS page_id, p_name AS part_name, CAST(p_size AS VARCHAR) AS part_size FROM part
UNION ALL SELECT p_partkey, p_brand, concat(p_type, ' & more') FROM part
""")
def html_table_by_index(spark, sf):
    return html.named_table(html.page_tables(part_pages(spark, sf), table_index=1), ["part_name", "part_size"])


@query("SELECT p_partkey AS page_id, CAST(1 AS INTEGER) AS table_idx, 3 AS table_rows, concat_ws('|', 'Part Name', 'Part-Size') AS header FROM part")
def html_largest_table(spark, sf):
    rows = html.page_tables(part_pages(spark, sf), largest=True)
    return profile_by_key(rows, ["page_id", "table_idx"], {
        "table_rows": F.count("*").cast("int"),
        "header": F.max(F.when(F.col("row_idx") == 0, F.concat_ws("|", "cells")))})
