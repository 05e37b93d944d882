"""Independent SQL (DuckDB dialect) for the registered queries.

Each statement restates a query's semantics directly (windows, NOT EXISTS,
CASE) rather than mirroring the Spark plan, so an agreement between the two
is evidence about the operator, not about a shared implementation.  Tables
``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are views over the same
parquet files.
"""

from __future__ import annotations

from lakefold.plans import derived as d
from lakefold.plans import queries as q

# Expected literals, written out here so that a wrong pattern in the library
# cannot pass on both sides (fixed values of the feeds and of the public grok
# definitions).
KEYWORD_PATTERN = "[가-힣a-zA-Z0-9]+"
USERNAME = "([a-zA-Z0-9._-]+)"
LOGLEVEL = (
    "([Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|"
    "[Ii]nfo?(?:rmation)?|INFO?(?:RMATION)?|[Ww]arn?(?:ing)?|WARN?(?:ING)?|"
    "[Ee]rr?(?:or)?|ERR?(?:OR)?|[Cc]rit?(?:ical)?|CRIT?(?:ICAL)?|[Ff]atal|"
    "FATAL|[Ss]evere|SEVERE|EMERG(?:ENCY)?|[Ee]merg(?:ency)?)"
)
DATESTAMP = (
    "((?:(?:0?[1-9]|1[0-2])[/-](?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])[/-](?:[0-9][0-9]){1,2}"
    "|(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])[./-](?:0?[1-9]|1[0-2])[./-](?:[0-9][0-9]){1,2})"
    "[- ](?:2[0123]|[01]?[0-9]):(?:[0-5][0-9])(?::(?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)))(?:[^0-9]|$)"
)
STATS_PARAMS = "method=getList&orgId=101&tblId=DT_1B040A3&itmId=T20&loadGubun=2&prdSe=M&format=json&jsonVD=Y"
LISTING_HREF, LISTING_TITLE = '<a href="([^"]*)">', '<a href="[^"]*">(.*?)</a>'
LINE_START = "^[A-Z]"


#: Raw pages read by a stack, one token of every page per recursion step.
LISTING_TREE = r"""
WITH RECURSIVE cut AS (SELECT page_id, regexp_extract_all(html, '(?is)<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)|<[!?][^>]*>|</[a-z][^>]*>|<[a-z][^>]*>|[^<]+|<') AS t FROM pages),
named AS (SELECT page_id, unnest(t) AS raw, generate_subscripts(t, 1) AS i FROM cut),
tok AS (SELECT *, lower(regexp_extract(raw, '^</?([a-zA-Z][^\s/>]*)', 1)) AS name FROM named),
kinds AS (SELECT *, CASE WHEN raw[1] <> '<' OR raw = '<' THEN 'text' WHEN name = '' THEN 'skip' WHEN raw[2] = '/' THEN 'close'
    WHEN name IN ('br', 'meta', 'script', 'style', 'img', 'link', 'input', 'hr') OR raw[-2:] = '/>' THEN 'void' ELSE 'open' END AS kind FROM tok),
walk AS (
    SELECT page_id, CAST(0 AS BIGINT) AS i, 'skip' AS kind, '' AS name, '' AS raw,
           CAST([] AS STRUCT(no BIGINT, name VARCHAR)[]) AS up, CAST([] AS STRUCT(no BIGINT, name VARCHAR)[]) AS stack FROM cut
    UNION ALL
    SELECT w.page_id, k.i, k.kind, k.name, k.raw, w.stack,
        CASE WHEN k.kind = 'open' THEN list_append(w.stack, {'no': k.i, 'name': k.name})
             WHEN k.kind = 'close' AND list_contains([x.name for x in w.stack], k.name)
             THEN w.stack[1:len(w.stack) - list_position(list_reverse([x.name for x in w.stack]), k.name)]
             ELSE w.stack END
    FROM walk w JOIN kinds k ON k.page_id = w.page_id AND k.i = w.i + 1),
placed AS (SELECT *, [x.no for x in up] AS ids, '/' || array_to_string([x.name for x in up], '/') || '/' AS path FROM walk),
items AS (SELECT page_id, i, ids, 'nav' AS listing FROM placed WHERE kind = 'open' AND name = 'li' AND path LIKE '%/nav/ul/'
    UNION ALL SELECT page_id, i, ids, 'article' FROM placed WHERE kind = 'open' AND name = 'p' AND path LIKE '%/article/%'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY page_id, listing ORDER BY i) AS item_no FROM items),
texts AS (SELECT page_id, i, ids, regexp_replace(replace(replace(replace(replace(replace(replace(raw, '&copy;', '©'), '&middot;', '·'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS t FROM placed WHERE kind = 'text'),
inside AS (SELECT n.page_id, n.i, string_agg(x.t, '' ORDER BY x.i) AS text FROM items n JOIN texts x
    ON n.page_id = x.page_id AND list_contains(x.ids, n.i) GROUP BY n.page_id, n.i, n.listing),
links AS (SELECT n.page_id, n.i, arg_min(regexp_extract(a.raw, 'href="([^"]*)"', 1), a.i) AS extra FROM items n JOIN placed a
    ON n.page_id = a.page_id AND n.listing = 'nav' AND a.name = 'a' AND a.kind = 'open' AND list_contains(a.ids, n.i) GROUP BY n.page_id, n.i),
bolds AS (SELECT n.page_id, n.i, min(b.i) AS b FROM items n JOIN placed b
    ON n.page_id = b.page_id AND n.listing = 'article' AND b.name = 'b' AND b.kind = 'open' AND b.ids[-1] = n.i GROUP BY n.page_id, n.i),
leads AS (SELECT s.page_id, s.i, coalesce(string_agg(x.t, '' ORDER BY x.i), '') AS extra FROM bolds s LEFT JOIN texts x
    ON s.page_id = x.page_id AND list_contains(x.ids, s.b) GROUP BY s.page_id, s.i)
SELECT n.page_id, n.listing, CAST(n.item_no AS INTEGER) AS item_no,
    CAST((SELECT max(o.item_no) FROM numbered o WHERE o.page_id = n.page_id AND o.listing = n.listing AND list_contains(n.ids, o.i)) AS INTEGER) AS parent_no,
    coalesce(x.text, '') AS text, coalesce(l.extra, b.extra) AS extra
FROM numbered n LEFT JOIN inside x USING (page_id, i) LEFT JOIN links l USING (page_id, i) LEFT JOIN leads b USING (page_id, i)
"""


def _date_minus(day: str, n: int) -> str:
    return f"CAST(DATE '{day}' - INTERVAL {n} DAY AS TIMESTAMP)"


# -- derived inputs ----------------------------------------------------------------

LEVEL_CASE = (
    "CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in d.LOG_LEVELS.items())
    + f" ELSE '{d.LOG_DEFAULT_LEVEL}' END"
)
LOG_LINE = (
    "'[host' || CAST(user_id % 5 AS VARCHAR) || '] ' || strftime(ts, '%y/%m/%d %H:%M:%S') || ' ' || "
    + LEVEL_CASE
    + " || ' App: ' || props"
)
LOG_JUNK = (
    "CASE WHEN event_id % 4 = 0 THEN chr(10) || chr(9) || 'at App.run(App.java:' || "
    "CAST(event_id % 100 AS VARCHAR) || ')' || chr(92) ELSE '' END"
)
CLEAN_RE = r"[\x00\n\\]"
HOUR24_TEXT = (
    "CASE WHEN hour({ts}) = 0 THEN strftime({ts} - INTERVAL 1 DAY, '%Y-%m-%d') || ' 24:' || {m} "
    "ELSE strftime({ts}, '%Y-%m-%d %H:') || {m} END"
)


def news_ctes() -> str:
    kw = KEYWORD_PATTERN

    def transform(src: str) -> str:
        return (
            "SELECT CAST(try_strptime(publish_date, '%Y.%m.%d') AS DATE) AS publish_date, publisher, title, url, "
            f"description, regexp_extract(keyword, '{kw}', 0) AS keyword FROM (SELECT DISTINCT * FROM {src})"
        )

    def purge(target: str, source: str, n: int) -> str:
        return f"""
dk{n} AS (SELECT url, keyword FROM {target} WHERE url IS NOT NULL AND keyword IS NOT NULL
          GROUP BY url, keyword HAVING count(*) > 1),
kp{n} AS (SELECT * FROM {target} x WHERE NOT EXISTS
          (SELECT 1 FROM dk{n} WHERE dk{n}.url = x.url AND dk{n}.keyword = x.keyword)),
r{n} AS (SELECT * FROM kp{n} UNION ALL SELECT * FROM {source} y WHERE NOT EXISTS
          (SELECT 1 FROM kp{n} WHERE kp{n}.url = y.url AND kp{n}.keyword = y.keyword))"""

    return f"""
nb AS (SELECT strftime(DATE '{d.NEWS_FIRST_DAY}' + CAST(doc_id % {d.NEWS_DAYS} AS INTEGER), '%Y.%m.%d') AS publish_date,
              source AS publisher, split_part(text, chr(10), 1) AS title,
              '{d.NEWS_BASE_URL}' || lang || '/' || sha256(text) AS url, text AS description,
              '"' || lang || ' news"' AS keyword, CAST(doc_id % {d.NEWS_DAYS} AS INTEGER) AS cycle_day
       FROM documents),
nb1 AS (SELECT * EXCLUDE (cycle_day) FROM nb WHERE cycle_day <= {d.NEWS_RUN1_LAST_DAY}),
nb2 AS (SELECT * EXCLUDE (cycle_day) FROM nb),
s1 AS ({transform('nb1')}),
s2 AS ({transform('nb2')}),{purge('s1', 's1', 1)},{purge('r1', 's2', 2)}"""


AIR_KEYS_EQ = "t.sidoName = s.sidoName AND t.cityName = s.cityName AND t.dataTime = s.dataTime"


def air_ctes(cumulative: bool = False) -> str:
    def bronze(name: str, where: str, rev: int) -> str:
        return f"""
{name}h AS (SELECT event_type AS sidoName, user_id % 10 AS city_no, date_trunc('hour', ts) AS hour_ts,
               count(*) AS n, max(user_id) AS umax, min(user_id) AS umin FROM events {where} GROUP BY ALL),
{name} AS (SELECT sidoName,
              CASE WHEN city_no = 0 THEN NULL ELSE 'city' || CAST(city_no AS VARCHAR) END AS cityName,
              'City ' || CAST(city_no AS VARCHAR) AS cityNameEng, 'D' || CAST(city_no AS VARCHAR) AS districtCode,
              {HOUR24_TEXT.format(ts='hour_ts', m="'00'")} AS dataTime,
              CAST(n AS VARCHAR) AS coValue, CAST(umax AS VARCHAR) AS no2Value,
              CASE WHEN n = 1 THEN '-' ELSE CAST(umin AS VARCHAR) END AS o3Value,
              CAST(n * 10 + {rev} AS VARCHAR) AS pm10Value, CAST(umax + {rev} AS VARCHAR) AS pm25Value,
              CAST(umin + {rev} AS VARCHAR) AS so2Value FROM {name}h)"""

    def transform(src: str) -> str:
        return f"""SELECT sidoName, cityName, cityNameEng, districtCode,
              try_strptime(replace(dataTime, '24:00', '00:00'), '%Y-%m-%d %H:%M') AS dataTime,
              TRY_CAST(coValue AS FLOAT) AS coValue, TRY_CAST(no2Value AS FLOAT) AS no2Value,
              TRY_CAST(o3Value AS FLOAT) AS o3Value, pm10Value, pm25Value, TRY_CAST(so2Value AS FLOAT) AS so2Value
       FROM (SELECT DISTINCT sidoName, cityName, cityNameEng, districtCode, dataTime, coValue, no2Value,
                    o3Value, pm10Value, pm25Value, so2Value FROM {src})"""

    def latest(old: str, new: str) -> str:
        """Both landings; per full key the row of the second, else the first."""
        return f"""SELECT * EXCLUDE (landed) FROM (SELECT *, 1 AS landed FROM ({transform(old)})
                   UNION ALL SELECT *, 2 AS landed FROM ({transform(new)}))
       QUALIFY cityName IS NULL OR sidoName IS NULL OR dataTime IS NULL
               OR row_number() OVER (PARTITION BY sidoName, cityName, dataTime ORDER BY landed DESC) = 1"""

    def upd(c: str) -> str:
        return f"CASE WHEN s.hit THEN s.{c} ELSE t.{c} END AS {c}"

    def merge(target: str, source: str, n: int) -> str:
        return f"""
r{n} AS (SELECT t.sidoName, t.cityName, t.cityNameEng, t.districtCode, t.dataTime,
               {upd('coValue')}, {upd('no2Value')}, {upd('o3Value')}, {upd('pm10Value')},
               {upd('pm25Value')}, {upd('so2Value')}
        FROM {target} t LEFT JOIN (SELECT *, true AS hit FROM {source}) s ON {AIR_KEYS_EQ}
        UNION ALL
        SELECT * FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {AIR_KEYS_EQ}))"""

    return (
        bronze("ab1", f"WHERE ts < TIMESTAMP '{d.AIR_RUN1_END}'", 0) + ","
        + bronze("ab2", "", 1) + ","
        + f"\ns1 AS ({transform('ab1')}),\ns2 AS ({latest('ab1', 'ab2') if cumulative else transform('ab2')}),"
        + merge("s1", "s1", 1) + "," + merge("r1", "s2", 2)
    )


def census_bronze_ctes(prefix: str, tbl_id: str, before: str | None) -> str:
    where = f"WHERE o.o_orderdate < TIMESTAMP '{before}'" if before else ""
    return f"""
{prefix}pn AS (SELECT strftime(o.o_orderdate, '%Y%m') AS PRD_DE, c.c_nationkey, count(*) AS n
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey {where} GROUP BY 1, 2),
{prefix}pnn AS (SELECT p.*, nn.n_name, nn.n_regionkey FROM {prefix}pn p JOIN nation nn ON p.c_nationkey = nn.n_nationkey),
{prefix} AS (
  SELECT PRD_DE, lpad(CAST(n_regionkey + 11 AS VARCHAR), 2, '0') || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS C1,
         n_name AS C1_NM, lower(n_name) AS C1_NM_ENG, '{tbl_id}' AS TBL_ID, CAST(n AS VARCHAR) AS DT
  FROM {prefix}pnn
  UNION ALL
  SELECT PRD_DE, lpad(CAST(r.r_regionkey + 11 AS VARCHAR), 2, '0'), r.r_name, lower(r.r_name), '{tbl_id}',
         CAST(sum(n) AS VARCHAR)
  FROM {prefix}pnn JOIN region r ON {prefix}pnn.n_regionkey = r.r_regionkey
  GROUP BY PRD_DE, r.r_regionkey, r.r_name)"""


def census_transform_ctes(src: str, out: str) -> str:
    return f"""
{out}d AS (SELECT DISTINCT PRD_DE, C1, C1_NM, C1_NM_ENG, TBL_ID, DT FROM {src}),
{out}c AS (SELECT CAST(try_strptime(PRD_DE || '01', '%Y%m%d') AS DATE) AS PRD_DE, C1, C1_NM, C1_NM_ENG, TBL_ID,
              TRY_CAST(trunc(TRY_CAST(DT AS DOUBLE)) AS INTEGER) AS DT, substr(C1, 1, 2) AS C1_SIDO FROM {out}d),
{out} AS (SELECT a.*, b.C1_NM AS C1_NM_SIDO FROM {out}c a
          LEFT JOIN (SELECT * FROM {out}c WHERE length(C1) = 2) b ON a.PRD_DE = b.PRD_DE AND a.C1_SIDO = b.C1_SIDO)"""


def census_merge_cte(target: str, source: str, out: str) -> str:
    eq = "t.PRD_DE = s.PRD_DE AND t.C1 = s.C1"

    def upd(c: str) -> str:
        return f"CASE WHEN s.hit THEN s.{c} ELSE t.{c} END AS {c}"

    return f"""
{out} AS (SELECT t.PRD_DE, t.C1, {upd('C1_NM')}, {upd('C1_NM_ENG')}, {upd('TBL_ID')}, {upd('DT')}, t.C1_SIDO,
                {upd('C1_NM_SIDO')}
          FROM {target} t LEFT JOIN (SELECT *, true AS hit FROM {source}) s ON {eq}
          UNION ALL SELECT * FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {eq}))"""


ORDERS_SPLIT = f"""
t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{q.ORDERS_TARGET_END}'),
s AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.5 AS o_totalprice, o_orderdate,
             lower(o_orderpriority) AS o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '{q.ORDERS_SOURCE_START}')"""

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINEITEM_ORDER = ", ".join(
    f"{c} DESC" for c in ["l_shipdate"] + [c for c in LINEITEM_COLS if c != "l_shipdate"]
)
LINEITEM_SOURCE = (
    "SELECT DISTINCT " + ", ".join("l_quantity + 1 AS l_quantity" if c == "l_quantity" else c for c in LINEITEM_COLS)
    + f" FROM lineitem WHERE l_shipdate >= TIMESTAMP '{q.LINEITEM_SOURCE_START}'"
)
LI_EQ = "{a}.l_orderkey = {b}.l_orderkey AND {a}.l_linenumber = {b}.l_linenumber"
LI_INSERT = (
    "SELECT * FROM k UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM k WHERE "
    + LI_EQ.format(a="k", b="s") + ")"
)

EVENTS_LATEST = """
SELECT * FROM ({src}) WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC, props DESC) = 1
UNION ALL SELECT * FROM ({src}) WHERE user_id IS NULL"""


def _events_latest(where: str) -> str:
    return EVENTS_LATEST.format(src=f"SELECT * FROM events {where}")


UPSERT_INPUTS = f"""
t AS ({_events_latest(f"WHERE ts < TIMESTAMP '{q.UPSERT_CUT}'")}),
sr AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{q.UPSERT_CUT}'),
s AS ({EVENTS_LATEST.format(src='SELECT * FROM sr')})"""


def listing_sql() -> str:
    href, title = LISTING_HREF, LISTING_TITLE
    return f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '{href}', 1) AS href,
                  regexp_extract_all(html, '{title}', 1) AS title FROM pages),
n AS (SELECT page_id, href, title, unnest(range(1, least(len(href), len(title)) + 1)) AS i FROM x)
SELECT page_id, CAST(i AS INTEGER) AS item_no, href[i] AS href,
       trim(regexp_replace(title[i], '<[^>]*>', '', 'g')) AS title FROM n"""


def plan_sql(daily: bool) -> str:
    enc = "replace(url_encode(keyword), '%20', '+')"
    if daily:
        lo, hi = q.PLAN_DAILY
        series = f"generate_series(DATE '{lo}', DATE '{hi}', INTERVAL 1 DAY)"
        fmt, pages = "%Y.%m.%d", 2
        url = (f"'{q.PLAN_BASE_URL}?where=news&query=' || {enc} || '&sort=1&pd=3&ds=' || period || '&de=' || period"
               " || '&start=' || CAST(1 + 10 * page AS VARCHAR)")
    else:
        lo, hi = q.PLAN_MONTHLY
        series = f"generate_series(DATE '{lo}', DATE '{hi}', INTERVAL 1 MONTH)"
        fmt, pages = "%Y%m", 1
        url = (f"'{q.PLAN_BASE_URL}?{STATS_PARAMS}&objL1=' || {enc} || '&startPrdDe=' || period"
               " || '&endPrdDe=' || period")
    return f"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark),
k AS (SELECT '"' || word || ' news"' AS keyword FROM w),
p AS (SELECT keyword, CAST(unnest({series}) AS DATE) AS d FROM k),
pg AS (SELECT keyword, strftime(d, '{fmt}') AS period, CAST(unnest(range(0, {pages})) AS INTEGER) AS page FROM p)
SELECT keyword, period, page, {url} AS url FROM pg"""


def oracle_sql() -> dict[str, str]:
    kw = KEYWORD_PATTERN
    sql: dict[str, str] = {}
    langs = ", ".join(f"'{x}'" for x in q.ALLOWED_LANGS)
    sql["distinct_projection"] = f"SELECT DISTINCT lang, source FROM documents WHERE lang IN ({langs})"
    sql["keyword_extract"] = f"SELECT doc_id, regexp_extract(text, '{kw}', 0) AS keyword FROM documents"
    sql["dotted_date"] = r"""
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y.%-m.%-d')
                                   ELSE strftime(o_orderdate, '%Y.%m.%d') END AS dotted FROM orders)
SELECT o_orderkey, dotted,
       CASE WHEN regexp_full_match(dotted, '[0-9]{4}\.[0-9]{2}\.[0-9]{2}')
            THEN CAST(try_strptime(dotted, '%Y.%m.%d') AS DATE) END AS publish_date FROM x"""
    half_hour = HOUR24_TEXT.format(ts="ts", m="m")
    hour_base = f"""
WITH x AS (SELECT event_id, {half_hour} AS data_time_text
           FROM (SELECT *, CASE WHEN minute(ts) < 30 THEN '00' ELSE '30' END AS m FROM events)),
y AS (SELECT event_id, data_time_text,
             try_strptime(replace(data_time_text, '24:00', '00:00'), '%Y-%m-%d %H:%M') AS p FROM x)"""
    sql["hour24_fix"] = hour_base + "\nSELECT event_id, data_time_text, p AS data_time FROM y"
    sql["hour24_roll"] = hour_base + (
        "\nSELECT event_id, data_time_text, CASE WHEN contains(data_time_text, '24:00') "
        "THEN p + INTERVAL 1 DAY ELSE p END AS data_time FROM y"
    )
    sql["safe_numeric_cast"] = """
WITH x AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '-'
                              WHEN doc_id % 11 = 0 THEN CAST(n_chars AS VARCHAR) || '.7'
                              WHEN doc_id % 13 = 0 THEN '-' || CAST(n_chars AS VARCHAR) || '.7'
                              ELSE CAST(n_chars AS VARCHAR) END AS raw FROM documents)
SELECT doc_id, raw, CAST(TRY_CAST(raw AS FLOAT) AS DOUBLE) AS as_float,
       TRY_CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS INTEGER) AS as_int FROM x"""
    sql["month_period"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS prd_de,
       CAST(try_strptime(strftime(o_orderdate, '%Y%m') || '01', '%Y%m%d') AS DATE) AS period FROM orders"""
    sql["hierarchy_label"] = (
        "WITH " + census_bronze_ctes("cb", "DT_1", None).strip() + ","
        + census_transform_ctes("cb", "ct") + "\nSELECT * FROM ct"
    )
    ref = q.LOOKBACK_REF
    sql["lookback_window"] = f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, 'days' AS lookback FROM orders
WHERE o_orderdate >= {_date_minus(ref, 3)} AND o_orderdate < CAST(DATE '{ref}' AS TIMESTAMP)
UNION ALL
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, 'months' AS lookback FROM orders
WHERE o_orderdate >= CAST(date_trunc('month', DATE '{ref}') - INTERVAL 3 MONTH AS TIMESTAMP)
  AND o_orderdate < CAST(date_trunc('month', DATE '{ref}') AS TIMESTAMP)"""

    sql["merge_update_insert"] = f"""
WITH {ORDERS_SPLIT.strip()}
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN s.hit THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.hit THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM t LEFT JOIN (SELECT *, true AS hit FROM s) s ON t.o_orderkey = s.o_orderkey
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"""
    sql["merge_insert_only"] = f"""
WITH {ORDERS_SPLIT.strip()}
SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"""
    sql["merge_delete"] = f"""
WITH {ORDERS_SPLIT.strip()}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE t.o_orderkey = s.o_orderkey)"""

    cols = ", ".join(LINEITEM_COLS)
    sql["duplicate_rows"] = f"""
SELECT DISTINCT {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINEITEM_ORDER}) AS rn
  FROM lineitem) WHERE rn > 1"""
    sql["purge_reference"] = f"""
WITH s AS ({LINEITEM_SOURCE}),
dk AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
       GROUP BY ALL HAVING count(*) > 1),
k AS (SELECT * FROM lineitem x WHERE NOT EXISTS (SELECT 1 FROM dk WHERE {LI_EQ.format(a='dk', b='x')}))
{LI_INSERT}"""
    sql["purge_keep_latest"] = f"""
WITH s AS ({LINEITEM_SOURCE}),
k AS (SELECT * FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINEITEM_ORDER}) = 1
      UNION ALL SELECT * FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL)
{LI_INSERT}"""
    sql["merge_null_keys"] = f"""
WITH e AS (SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS event_id, ts, user_id, event_type, value
           FROM events),
t AS (SELECT * FROM e WHERE ts < TIMESTAMP '{q.EVENTS_TARGET_END}'),
s AS (SELECT * FROM e WHERE ts >= TIMESTAMP '{q.EVENTS_SOURCE_START}')
SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.event_id = s.event_id)"""
    sql["upsert_last_write"] = f"""
WITH {UPSERT_INPUTS.strip()}
SELECT * FROM s
UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id)"""
    sql["merge_conflict"] = f"""
WITH {UPSERT_INPUTS.strip()}
SELECT user_id, count(*) AS n_source_rows FROM sr
WHERE user_id IS NOT NULL AND user_id IN (SELECT user_id FROM t WHERE user_id IS NOT NULL)
GROUP BY user_id HAVING count(*) > 1"""
    sql["schema_evolution"] = f"""
WITH t AS (SELECT * FROM customer WHERE c_acctbal < {q.ACCTBAL_TARGET_END}),
s AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment,
             CASE WHEN c_acctbal >= 8000 THEN 'gold' ELSE 'std' END AS c_tier
      FROM customer WHERE c_acctbal >= {q.ACCTBAL_SOURCE_START})
SELECT t.c_custkey,
       CASE WHEN s.hit THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.hit THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN s.hit THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.hit THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
       s.c_tier AS c_tier
FROM t LEFT JOIN (SELECT *, true AS hit FROM s) s ON t.c_custkey = s.c_custkey
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey)"""

    sql["run_dataset_news"] = "WITH " + news_ctes().strip() + "\nSELECT * FROM r2"
    air_out = (
        "\nSELECT sidoName, cityName, cityNameEng, districtCode, dataTime, CAST(coValue AS DOUBLE) AS coValue,"
        " CAST(no2Value AS DOUBLE) AS no2Value, CAST(o3Value AS DOUBLE) AS o3Value, pm10Value, pm25Value,"
        " CAST(so2Value AS DOUBLE) AS so2Value FROM r2"
    )
    sql["run_dataset_air"] = "WITH " + air_ctes().strip() + air_out
    sql["run_dataset_air_cumulative"] = "WITH " + air_ctes(cumulative=True).strip() + air_out
    sql["stream_run_census"] = (
        "WITH " + census_bronze_ctes("cb", "DT_S", None).strip() + ","
        + census_transform_ctes("cb", "ct") + "\nSELECT * FROM ct"
    )
    sql["stream_run_census_late"] = sql["stream_run_census"]
    sql["run_dataset_census"] = (
        "WITH " + census_bronze_ctes("ca", "DT_A", d.CENSUS_RUN1_END).strip() + ","
        + census_bronze_ctes("cb", "DT_B", None) + ","
        + census_transform_ctes("ca", "s1") + "," + census_transform_ctes("cb", "s2") + ","
        + census_merge_cte("s1", "s1", "r1") + "," + census_merge_cte("r1", "s2", "r2")
        + "\nSELECT * FROM r2"
    )

    sql["topic_drain"] = "SELECT event_type, count(*) AS n_messages FROM events GROUP BY event_type"
    as_text = ("CAST(c_custkey AS VARCHAR) AS c_custkey", "c_name", "CAST(c_nationkey AS VARCHAR) AS c_nationkey")
    sql["csv_scan"] = f"SELECT {', '.join(as_text)} FROM customer"
    sql["csv_scan_one_column"] = f"SELECT {as_text[0]} FROM customer"
    sql["json_scan"] = """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(NULL AS VARCHAR) AS _corrupt_record FROM customer
UNION ALL
SELECT NULL, NULL, NULL, '{bad json ' || CAST(c_custkey AS VARCHAR) FROM customer"""
    sql["text_scan"] = (
        "SELECT CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || CAST(c_nationkey AS VARCHAR) AS value FROM customer"
    )
    seoul_day = "CAST(ts + INTERVAL 9 HOUR AS DATE)"
    sql["bronze_landing"] = f"SELECT {seoul_day} AS ingest_date, count(*) AS n_rows FROM events GROUP BY 1"
    sql["partition_arrival"] = f"""
WITH b AS (SELECT {seoul_day} AS d FROM events),
cal AS (SELECT CAST(unnest(generate_series(min(d) - 2, max(d) + 2, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
c AS (SELECT d AS day, count(*) AS n FROM b GROUP BY d)
SELECT cal.day, coalesce(c.n, 0) AS n_rows, coalesce(c.n, 0) > 0 AS arrived FROM cal LEFT JOIN c ON cal.day = c.day"""
    sql["log_assemble"] = f"""
WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS line,
                  generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS ln FROM documents),
s AS (SELECT *, sum(CASE WHEN ln = 1 OR regexp_matches(line, '{LINE_START}') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY doc_id ORDER BY ln ROWS UNBOUNDED PRECEDING) AS event_no FROM l)
SELECT doc_id, CAST(event_no AS INTEGER) AS event_no, CAST(min(ln) AS INTEGER) AS first_line,
       CAST(count(*) AS INTEGER) AS n_lines, string_agg(line, chr(10) ORDER BY ln) AS event
FROM s GROUP BY doc_id, event_no"""
    clean_cte = f"""
WITH l AS (SELECT event_id, {LOG_LINE} || {LOG_JUNK} AS line FROM events),
c AS (SELECT event_id, regexp_replace(line, '{CLEAN_RE}', '', 'g') AS message FROM l)"""
    sql["log_clean"] = clean_cte + "\nSELECT * FROM c"
    sql["log_parse"] = clean_cte + f""",
p AS (SELECT event_id, NULLIF(regexp_extract(message, ' {LOGLEVEL}', 1), '') AS log_level,
             NULLIF(regexp_extract(message, '{USERNAME}', 1), '') AS host_name,
             NULLIF(regexp_extract(message, '{DATESTAMP}', 1), '') AS spark_datestamp FROM c)
SELECT *, try_strptime(spark_datestamp, '%y/%m/%d %H:%M:%S') AS log_ts FROM p"""
    sql["log_stream_append"] = f"SELECT ts AS timestamp, {LOG_LINE} AS value FROM events"
    sql["stream_merge"] = _events_latest("")
    sql["listing_extract"] = listing_sql()
    sql["listing_items"] = """
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS item_no,
       trim(regexp_replace(line, '[<>]', '', 'g') || chr(10) || 'no. ' || CAST(i AS VARCHAR)) AS title,
       'https://news.example.com/' || CAST(doc_id AS VARCHAR) || '/' || CAST(i AS VARCHAR) AS url,
       CASE WHEN i % 3 <> 0 THEN trim(source) END AS publisher, 'line ' || CAST(i AS VARCHAR) AS description FROM l"""
    sql["json_envelope"] = """
SELECT event_id, 1 AS item_no, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
WHERE coalesce(event_type, '') NOT IN ('error', 'view')
UNION ALL
SELECT event_id, 2 AS item_no, user_id AS k FROM events WHERE coalesce(event_type, '') NOT IN ('error', 'view')"""
    sql["api_result"] = """
WITH ok AS (SELECT * FROM events WHERE coalesce(event_type, '') NOT IN ('error', 'signup'))
SELECT event_id, 'ok' AS status, 1 AS item_no, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM ok
UNION ALL SELECT event_id, 'ok', 2, user_id FROM ok
UNION ALL SELECT event_id, 'ok', 3, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM ok
UNION ALL SELECT event_id, 'error', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT) FROM events WHERE event_type = 'error'"""
    sql["api_result_broken"] = """
WITH ok AS (SELECT * FROM events WHERE coalesce(event_type, '') NOT IN ('error', 'signup'))
SELECT event_id, false AS cut, 'ok' AS status, 1 AS item_no, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM ok
UNION ALL SELECT event_id, false, 'ok', 2, user_id FROM ok
UNION ALL SELECT event_id, false, 'ok', 3, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM ok
UNION ALL SELECT event_id, false, 'error', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT) FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, true, 'error', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT) FROM events"""
    sql["request_plan_daily"] = plan_sql(True)
    sql["request_plan_monthly"] = plan_sql(False)
    sql["request_backfill"] = """
WITH RECURSIVE k AS (SELECT DISTINCT concat_ws(' ', source, lang) AS keyword FROM documents),
known AS (SELECT DISTINCT concat_ws(' ', source, lang) AS keyword, DATE '2024-01-01' + CAST((doc_id * 7919) % 67 AS INTEGER) AS day FROM documents),
days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-29', INTERVAL 1 DAY)) AS DATE) AS day),
missing AS (SELECT k.keyword, d.day FROM k, days d WHERE NOT EXISTS (SELECT 1 FROM known n WHERE n.keyword = k.keyword AND n.day = d.day)),
r AS (SELECT keyword, day AS first_day, day AS last_day FROM missing m
      WHERE NOT EXISTS (SELECT 1 FROM missing o WHERE o.keyword = m.keyword AND o.day = m.day - 1)
      UNION ALL
      SELECT r.keyword, r.first_day, m.day FROM r JOIN missing m ON m.keyword = r.keyword AND m.day = r.last_day + 1),
w AS (SELECT keyword, first_day, max(last_day) AS last_day FROM r GROUP BY keyword, first_day)
SELECT keyword, first_day, last_day, CAST(last_day - first_day + 1 AS INTEGER) AS n_days,
       'https://search.example.com/news?where=news&query=%22' || replace(keyword, ' ', '+') || '%22&sort=1&pd=3&ds=' || strftime(first_day, '%Y.%m.%d')
       || '&de=' || strftime(last_day, '%Y.%m.%d') || '&start=1' AS url FROM w"""
    sql["topic_drain_offsets"] = """
WITH n AS (SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
                  row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY event_id) - 1 AS o FROM events),
kept AS (SELECT * FROM n WHERE o % 50 NOT IN (7, 8, 9) AND o NOT BETWEEN 100 AND 120),
ends AS (SELECT topic, partition, count(*) AS n_messages, min(o) AS first_offset, max(o) AS last_offset FROM kept GROUP BY ALL),
holes AS (SELECT topic, partition, o + 1 AS lo, lead(o) OVER (PARTITION BY topic, partition ORDER BY o) - 1 AS hi FROM kept),
lost AS (SELECT topic, partition, sum(hi - lo + 1) AS n, string_agg(lo || '-' || hi, ',' ORDER BY lo) AS r FROM holes WHERE hi >= lo GROUP BY ALL)
SELECT e.*, CAST(coalesce(l.n, 0) AS BIGINT) AS n_lost, coalesce(l.r, '') AS lost_ranges FROM ends e LEFT JOIN lost l USING (topic, partition)"""
    sql["replayed_messages"] = "SELECT * FROM events"
    sql["contract_check"] = """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS c_name,
                  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer),
r AS (SELECT concat_ws(',', CASE WHEN c_custkey IS NULL THEN 'missing:c_custkey' END,
                             CASE WHEN c_name IS NULL THEN 'missing:c_name' END,
                             CASE WHEN c_mktsegment IS NULL THEN 'missing:c_mktsegment' END) AS reasons FROM c)
SELECT CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS status, reasons, count(*) AS n_rows
FROM r GROUP BY ALL"""
    sql["message_key"] = "SELECT count(*) AS n_rows, count(*) AS n_keys FROM events"
    sql["topic_records"] = """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS c_name,
                  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
                  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)
SELECT CAST(json_object('c_custkey', CAST(c_custkey AS VARCHAR), 'c_name', c_name,
                        'c_nationkey', CAST(c_nationkey AS VARCHAR), 'c_mktsegment', c_mktsegment) AS VARCHAR) AS value,
       36 AS key_len
FROM c WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_mktsegment IS NOT NULL"""
    sql["json_landing"] = f"""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       count(*) AS n_rows, count(*) FILTER (WHERE ({LEVEL_CASE}) = 'ERROR') AS n_error
FROM events GROUP BY ALL"""
    sql["landing_stream"] = "SELECT * FROM events"
    sql["open_or_create"] = "SELECT c_custkey, c_name, c_nationkey FROM customer"
    sql["register_table"] = "SELECT CAST(c_nationkey AS INTEGER) AS c_nationkey, count(*) AS n_customers FROM customer GROUP BY c_nationkey"
    sql["log_tail"] = f"""
WITH l AS (SELECT coalesce(source, '') || '-' || CAST(doc_id // 500 AS VARCHAR) || '.log' AS file, doc_id,
                  unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents),
p AS (SELECT file, regexp_replace(raw, '\\r$', '') AS line,
             sum(strlen(raw) + 1) OVER (PARTITION BY file ORDER BY doc_id, ln) - strlen(raw) - 1 AS first FROM l),
s AS (SELECT *, sum(CASE WHEN first = 0 OR regexp_matches(line, '{LINE_START}') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY file ORDER BY first) AS event_no FROM p)
SELECT file, CAST(min(first) AS BIGINT) AS start, CAST(count(*) AS INTEGER) AS n_lines,
       string_agg(line, chr(10) ORDER BY first) AS event FROM s GROUP BY file, event_no"""
    sql["listing_tree"] = LISTING_TREE
    sql["schema_merge"] = """
WITH t AS (SELECT c_custkey, c_name AS name, c_nationkey AS nation, CAST(NULL AS VARCHAR) AS tier,
                  CAST(c_custkey % 100 AS VARCHAR) AS visits, c_mktsegment AS tags, CAST(c_nationkey AS BIGINT) AS attr, c_acctbal FROM customer),
w AS (SELECT c_custkey, upper(c_name) AS name, c_nationkey AS nation, 'new' AS tier, CAST(c_custkey * 10000000000 AS VARCHAR) AS visits,
             c_mktsegment || ':7' AS tags, c_custkey * 10000000000 AS attr FROM customer WHERE c_acctbal >= 2000 AND c_custkey % 4 <> 3),
one AS (SELECT * FROM w UNION ALL
        SELECT t.* EXCLUDE (c_acctbal) FROM t WHERE c_acctbal < 5000 AND c_custkey NOT IN (SELECT c_custkey FROM w)),
m AS (SELECT * EXCLUDE (c_acctbal) REPLACE ('many' AS visits) FROM t WHERE c_custkey % 12 = 0),
two AS (SELECT * FROM m UNION ALL SELECT * FROM one WHERE c_custkey NOT IN (SELECT c_custkey FROM m)),
both_steps AS (SELECT 1 AS step, * FROM one UNION ALL SELECT 2, * FROM two)
SELECT step, CAST(c_custkey AS BIGINT) AS c_custkey, name, CAST(nation AS INTEGER) AS nation, tier, visits, tags,
       CAST(attr AS BIGINT) AS attr FROM both_steps"""
    sql["discover_tables"] = """
SELECT 'news' AS table_name, 'doc_id bigint, text string, lang string, extra string, batch int' AS columns,
       CAST(doc_id % 3 AS VARCHAR) AS partition_value, count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys FROM documents GROUP BY ALL
UNION ALL SELECT 'air', 'event_id bigint, event_type string, reading bigint, partition_0 date',
       '2024-01-0' || CAST(event_id % 2 + 1 AS VARCHAR), count(*), count(DISTINCT event_id) FROM events GROUP BY ALL
UNION ALL SELECT 'customers', 'c_custkey bigint, c_name string, partition_0 string',
       'part' || CAST(c_custkey % 2 AS VARCHAR), count(*), count(DISTINCT c_custkey) FROM customer GROUP BY ALL"""
    sql["compaction"] = "SELECT * FROM events"
    sql["compaction_report"] = """
SELECT event_type, count(DISTINCT event_id % 5) AS files_before, CAST(1 AS BIGINT) AS files_after, true AS no_larger, count(*) AS n_rows
FROM events GROUP BY event_type"""
    return sql
