"""DuckDB SQL oracle for the registered queries.

Over the raw test tables, in months as numbers and conditional sums over one
month-distance relation, so it is independent of the window form of the Spark
operators.  Each query is ``WITH <fixture views>, <model CTEs> SELECT ...``;
DuckDB only evaluates the CTEs a query references.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-01'"

#: The names of the size bands.
BANDS = [
    "1. Strategic (>$2.5m)", "2. Very Large ($1m - $2.5m)", "3. Large ($250k - $1m)",
    "4. Medium ($100k - $250k)", "5. Small ($25k - $100k)", "6. Very Small ($10k - $25k)",
    "7. Micro ($1 - $10k)", "8. Non Active (<= $0)",
]
_BAND_VALUES = ", ".join(f"({i}, '{b}')" for i, b in enumerate(BANDS))

FIXTURE_CTES = f"""
cal_days AS (
  SELECT CAST(range AS DATE) AS full_date, CAST(dayofmonth(range) AS INTEGER) AS month_day_number
  FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-02', INTERVAL 1 DAY)
),
tx AS (
  SELECT l.l_suppkey AS account_id, l.l_partkey AS form_id, o.o_custkey AS gateway_id,
         substr(o.o_orderpriority, 1, 1) AS currency, l.l_shipdate AS date_created,
         CASE WHEN l.l_returnflag = 'R' THEN 2 ELSE 1 END AS transaction_type,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amount,
         CASE o.o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
acct AS (
  SELECT s.s_suppkey AS id, s.s_name AS name, n.n_regionkey AS organization_id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
form AS (SELECT p_partkey AS id, p_type AS product FROM part),
gateway AS (
  SELECT c_custkey AS id,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'wepay' WHEN 'BUILDING' THEN 'stripe'
                           WHEN 'FURNITURE' THEN 'adyen' ELSE c_mktsegment END AS type
  FROM customer
),
mgr_link AS (SELECT s_suppkey AS account_id, s_suppkey AS account_manager_id FROM supplier),
mgr AS (
  SELECT s.s_suppkey AS id, n.n_name AS first_name, r.r_name AS last_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
fx AS (
  SELECT d.full_date AS date, c.currency,
         CAST(1 + CAST(c.currency AS INTEGER) * CAST(0.1 AS DECIMAL(4,1)) AS DECIMAL(4,1)) AS rate
  FROM cal_days d, (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) AS c(currency)
  WHERE NOT (c.currency = '5' AND d.full_date = last_day(d.full_date))
),
take AS (
  SELECT g.gateway_group, d.full_date AS date, p.product, CAST(0.01 AS DECIMAL(20,10)) AS rate
  FROM (SELECT DISTINCT p_type AS product FROM part) p,
       (VALUES ('WePay'), ('Stripe'), ('Adyen'), ('Other')) AS g(gateway_group),
       cal_days d
  WHERE d.month_day_number = 1
    AND NOT (g.gateway_group = 'Other' AND month(d.full_date) % 2 = 0)
),
attribution_in AS (
  SELECT s_suppkey AS account_id,
         CASE s_suppkey % 7 WHEN 0 THEN 'paid_social' WHEN 1 THEN 'paid_social'
              WHEN 2 THEN 'paid_social' WHEN 3 THEN 'cpc' WHEN 5 THEN 'email' END AS utm_medium,
         CASE s_suppkey % 7 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'fb' WHEN 2 THEN 'Instagram'
              WHEN 3 THEN 'google' WHEN 4 THEN 'Bing' END AS utm_source
  FROM supplier WHERE s_suppkey % 7 <> 6
),
industry_in AS (
  SELECT s_suppkey AS account_id,
         CASE s_suppkey % 4 WHEN 0 THEN 'Education' WHEN 1 THEN 'Nonprofit'
              WHEN 2 THEN 'Religious' END AS industry
  FROM supplier WHERE s_suppkey % 4 <> 3
),
band_names(idx, band) AS (VALUES {_BAND_VALUES}),
max_ttm_in AS (
  SELECT s.s_suppkey AS account_id, p.p_type AS product, b.band AS product_max_ttm_size
  FROM supplier s JOIN part p ON s.s_suppkey = p.p_partkey
  JOIN band_names b ON b.idx = s.s_suppkey % 8
),
size_py_in AS (
  SELECT s.s_suppkey AS account_id, p.p_type AS product, CAST(y.yr AS INTEGER) AS year,
         b.band AS customer_size_py
  FROM supplier s JOIN part p ON s.s_suppkey = p.p_partkey
  CROSS JOIN (SELECT range AS yr FROM range(1995, 2002)) y
  JOIN band_names b ON b.idx = (s.s_suppkey + y.yr) % 8
)
"""

def _month(d: str) -> str:
    """Months since year 0, so that differences are month distances."""
    return f"(year({d}) * 12 + month({d}) - 1)"


_SERIES = "account_id, product, gateway_group"
_AS_OF_MONTH = _month(AS_OF)
#: The size bands with the totals that they lie above; the last one has no floor.
_BAND_TABLE = ", ".join(f"({i}, {f}, '{b}')" for i, (f, b) in enumerate(zip([2500000, 1000000, 250000, 100000, 25000, 10000, 0, "NULL"], BANDS)))

# One relation for every question:
#   series numbered keys (sid), whole: no key is NULL; pid numbers account and product, NULL if one is
#   cell   a series and month number with its amount (0 unless whole)
#   reach  each cell with the amounts of the 24 months that end in it, by distance
#   wide   the measures of a cell, all conditional sums over its reach
#   long   one row for each cell and horizon: total, prior, new, change, start
#   judged long with the sums over the product and the status rule
MODEL_CTES = f"""
who AS (
  SELECT a.id AS account_id, a.name AS account_name, m.first_name || ' ' || m.last_name AS account_manager_name,
         a.organization_id
  FROM acct a LEFT JOIN mgr_link ml ON ml.account_id = a.id LEFT JOIN mgr m ON m.id = ml.account_manager_id
),
facts AS (
  SELECT t.account_id, f.product,
         CASE WHEN g.type IN ('wepay', 'stripe', 'adyen')
              THEN MAP {{'wepay': 'WePay', 'stripe': 'Stripe', 'adyen': 'Adyen'}}[g.type]
              WHEN g.type IS NOT NULL THEN 'Other' END AS gateway_group,
         {_month('t.date_created')} AS mi,
         CASE WHEN t.transaction_type IN (1, 2) THEN (3 - 2 * t.transaction_type) * t.amount * x.rate ELSE 0 END AS worth
  FROM tx t LEFT JOIN form f ON f.id = t.form_id LEFT JOIN gateway g ON g.id = t.gateway_id
  LEFT JOIN fx x ON x.currency = t.currency AND x.date = CAST(t.date_created AS DATE)
  WHERE t.status = 6
),
totals AS (
  SELECT s.*, s.worth * COALESCE(k.rate, CAST(CASE s.gateway_group WHEN 'WePay' THEN 0.005373 ELSE 0.001075 END AS DECIMAL(20,10)))
                AS monthly_total
  FROM (SELECT {_SERIES}, mi, CAST(SUM(worth) AS DECIMAL(25,3)) AS worth FROM facts GROUP BY ALL) s
  LEFT JOIN take k ON k.gateway_group = s.gateway_group AND k.product = s.product AND {_month('k.date')} = s.mi
),
spans AS (SELECT {_SERIES}, MIN(mi) AS low, MAX(mi) AS high FROM totals GROUP BY ALL),
series AS (
  SELECT *, row_number() OVER (ORDER BY {_SERIES}) AS sid, product || account_id || gateway_group IS NOT NULL AS whole,
         CASE WHEN product || account_id IS NOT NULL THEN dense_rank() OVER (ORDER BY account_id, product) END AS pid
  FROM spans
),
cell AS (
  SELECT c.sid, c.pid, c.mi, CAST(COALESCE(t.monthly_total, 0) AS DECIMAL(20,5)) AS v
  FROM (SELECT *, unnest(range(low, least(high + 24, {_AS_OF_MONTH}) + 1)) AS mi FROM series) c
  LEFT JOIN totals t ON c.whole AND t.account_id = c.account_id AND t.product = c.product AND t.gateway_group = c.gateway_group AND t.mi = c.mi
),
reach AS (
  SELECT a.sid, a.pid, a.mi, b.mi AS mj, a.mi - b.mi AS back, b.v, CAST(b.v AS DECIMAL(20,3)) AS v3
  FROM cell a JOIN cell b USING (sid) WHERE b.mi BETWEEN a.mi - 23 AND a.mi
),
sums AS (
  SELECT sid, pid, mi,
         SUM(v) FILTER (back = 0) AS m_now, COALESCE(SUM(v3) FILTER (back = 12), 0) AS m_before,
         SUM(v) FILTER (back < 12) AS t_now, CAST(COALESCE(SUM(v) FILTER (back >= 12), 0) AS DECIMAL(38,3)) AS t_before,
         SUM(v3) FILTER (mj // 12 = mi // 12) AS y_now,
         COALESCE(SUM(v3) FILTER (mj // 12 = mi // 12 - 1 AND back >= 12), 0) AS y_before
  FROM reach GROUP BY ALL
),
starts AS (
  SELECT pid, MIN(mi) FILTER (t_now > 0) AS t_start, MIN(mi) FILTER (y_now > 0) AS y_start
  FROM sums WHERE pid IS NOT NULL GROUP BY ALL
),
m_starts AS (
  SELECT account_id, product, MIN(mi) AS m_start FROM totals
  WHERE monthly_total > 0 AND account_id IS NOT NULL AND product IS NOT NULL GROUP BY ALL
),
firsts AS (
  SELECT sid, mi,
         SUM(v) FILTER (back < 12 AND mj < t_start + 12) AS t_first,
         SUM(v) FILTER (back < 12 AND mj < y_start + 12 AND mj // 12 = y_start // 12 + 1) AS y_first
  FROM reach LEFT JOIN starts USING (pid) GROUP BY ALL
),
wide AS (
  SELECT s.*, m_start, t_start, y_start, whole,
         CASE WHEN mi - t_start < 12 THEN CAST(t_now AS DECIMAL(38,5))
              WHEN mi - t_start < 24 THEN CAST(COALESCE(t_first, 0) AS DECIMAL(38,5)) ELSE 0 END AS t_new,
         CASE WHEN mi - y_start < 12 THEN CAST(y_now AS DECIMAL(38,5))
              WHEN mi // 12 = y_start // 12 + 1 THEN CAST(COALESCE(y_first, 0) AS DECIMAL(38,5)) ELSE 0 END AS y_new
  FROM sums s JOIN firsts USING (sid, mi) JOIN series k USING (sid) LEFT JOIN starts t ON t.pid = s.pid
  LEFT JOIN m_starts m ON m.account_id = k.account_id AND m.product = k.product
),
long AS (
  SELECT sid, pid, mi, whole, horizon, CAST(t AS DECIMAL(38,5)) AS t, CAST(p AS DECIMAL(38,5)) AS p, n,
         CAST(t AS DECIMAL(38,5)) - CASE WHEN keep = 1 THEN n ELSE 0 END - CAST(p AS DECIMAL(38,5)) AS d, start
  FROM (
    SELECT sid, pid, mi, whole,
           unnest(['monthly', 'ttm', 'ytd']) AS horizon,
           unnest([CAST(m_now AS DECIMAL(38,5)), CAST(t_now AS DECIMAL(38,5)), CAST(y_now AS DECIMAL(38,5))]) AS t,
           unnest([CAST(m_before AS DECIMAL(38,5)), CAST(t_before AS DECIMAL(38,5)), CAST(y_before AS DECIMAL(38,5))]) AS p,
           unnest([NULL, t_new, y_new]) AS n, unnest([0, 1, 1]) AS keep, unnest([m_start, t_start, y_start]) AS start
    FROM wide)
),
by_product AS (
  SELECT pid, mi, horizon, SUM(t) AS pt, SUM(p) AS pp FROM long WHERE pid IS NOT NULL GROUP BY ALL
),
last_active AS (
  SELECT pid, horizon, MAX(mi) AS mi_last FROM by_product WHERE pt > 0 GROUP BY ALL
),
judged AS (
  SELECT l.*, pt, pp, CASE WHEN mi_last > l.mi THEN mi_last END AS later,
         CASE WHEN NOT whole THEN NULL
              WHEN pt > 0 AND pp <= 0 AND l.mi - start < 12 THEN 'new'
              WHEN pt <= 0 AND pp > 0 THEN CASE WHEN mi_last > l.mi THEN 'lapsed' ELSE 'lost' END
              WHEN pt > 0 AND pp <= 0 AND l.mi - start >= 12 THEN 'recovered'
              WHEN t > 0 AND d >= 0 AND greatest(pp, COALESCE(n, 0)) > 0 THEN 'upsell'
              WHEN pt > 0 AND greatest(p, COALESCE(n, 0)) > 0 AND (d < 0 OR (l.horizon <> 'monthly' AND t <= 0)) THEN 'downsell'
              WHEN pt <= 0 AND pp <= 0 THEN 'negative or null'
              ELSE 'unknown' END AS status
  FROM long l LEFT JOIN by_product b ON b.pid = l.pid AND b.mi = l.mi AND b.horizon = l.horizon
  LEFT JOIN last_active a ON a.pid = l.pid AND a.horizon = l.horizon
),
bands(idx, floor_total, band) AS (VALUES {_BAND_TABLE}),
peaks AS (
  SELECT pid, max_total,
         (SELECT band FROM bands WHERE idx = COALESCE((SELECT MIN(b.idx) FROM bands b WHERE max_total > b.floor_total), 7)) AS processing_max_ttm_size
  FROM (SELECT pid, MAX(t) AS max_total FROM long WHERE horizon = 'ttm' AND pid IS NOT NULL GROUP BY ALL)
),
named AS (
  SELECT sid, c.pid, mi, v, {_SERIES}, account_name, account_manager_name,
         make_date(CAST(mi // 12 AS INTEGER), CAST(mi % 12 + 1 AS INTEGER), 1) AS date,
         CAST(mi % 12 + 1 AS SMALLINT) AS month, CAST(mi // 12 AS SMALLINT) AS year,
         COALESCE(MAP {{1: 'org_one', 2: 'org_two', 3: 'org_three'}}[organization_id], 'unknown') AS org_label
  FROM cell c JOIN series USING (sid) LEFT JOIN who USING (account_id)
)
"""

#: The measures by their names in the report: (horizon, column of ``judged``, name).
_MEASURES = [
    ("monthly", "t", "monthly_total"), ("monthly", "p", "monthly_trailing_total"), ("monthly", "d", "change_in_existing_monthly"),
    ("ttm", "t", "ttm_total"), ("ttm", "n", "ttm_total_new"), ("ttm", "t - n", "ttm_total_existing"),
    ("ttm", "p", "ttm_trailing_total"), ("ttm", "d", "change_in_existing_ttm"),
    ("ytd", "t", "ytd_total"), ("ytd", "n", "ytd_total_new"), ("ytd", "t - n", "ytd_total_existing"),
    ("ytd", "p", "ytd_trailing_total"), ("ytd", "d", "change_in_existing_ytd"),
    ("monthly", "pt", "monthly_total_product"), ("monthly", "pp", "monthly_trailing_total_product"),
    ("ttm", "pt", "ttm_total_product"), ("ttm", "pp", "ttm_trailing_total_product"),
    ("ytd", "pt", "ytd_total_product"), ("ytd", "pp", "ytd_trailing_total_product"),
]
_HORIZONS = ["monthly", "ttm", "ytd"]


def _as_date(month: str) -> str:
    return f"CASE WHEN {month} IS NOT NULL THEN make_date(CAST({month} // 12 AS INTEGER), CAST({month} % 12 + 1 AS INTEGER), 1) END"


def _pivot() -> str:
    """``flat``: one row a cell again, the measures, cohorts, later months and statuses of all horizons side by side."""
    picks = [f"CAST(any_value({c}) FILTER (horizon = '{h}') AS DECIMAL(38,5)) AS {n}" for h, c, n in _MEASURES]
    for h in _HORIZONS:
        at = f"any_value({{}}) FILTER (horizon = '{h}')"
        picks += [
            f"{_as_date(at.format('start'))} AS {h}_cohort", f"{_as_date(at.format('later'))} AS {h}_future_date",
            f"{at.format('status')} AS {h}_status",
        ]
    return f"flat AS (SELECT sid, mi, {', '.join(picks)} FROM judged GROUP BY ALL)"


MODEL_CTES += "," + _pivot() + f""",
aux AS (SELECT n.*, n.org_label AS organization_id, f.* EXCLUDE (sid, mi) FROM flat f JOIN named n USING (sid, mi)),
report AS (
  SELECT a.*, i.industry, COALESCE(ap.utm_medium, 'organic') AS attribution_type,
         CASE WHEN ap.utm_source IS NULL THEN 'unknown'
              WHEN list_contains(['facebook', 'fb', 'instagram'], lower(ap.utm_source)) THEN 'meta' ELSE ap.utm_source END AS attribution_source,
         mt.product_max_ttm_size, COALESCE(pk.processing_max_ttm_size, '{BANDS[7]}') AS processing_max_ttm_size,
         COALESCE((SELECT ANY_VALUE(z.customer_size_py) FROM size_py_in z
                   WHERE z.account_id = a.account_id AND z.product = a.product AND z.year = a.year), '{BANDS[7]}') AS customer_size_py
  FROM aux a LEFT JOIN peaks pk ON pk.pid = a.pid
  LEFT JOIN max_ttm_in mt ON mt.account_id = a.account_id AND mt.product = a.product
  LEFT JOIN attribution_in ap ON ap.account_id = a.account_id LEFT JOIN industry_in i ON i.account_id = a.account_id
)
"""

M = "DECIMAL(38,5)"


def _money(*cols: str, src: str = "") -> str:
    pre = f"{src}." if src else ""
    return ", ".join(f"CAST({pre}{c} AS {M}) AS {c}" for c in cols)


AUX_MONEY = [
    "monthly_total", "monthly_trailing_total", "change_in_existing_monthly",
    "ttm_total", "ttm_total_new", "ttm_total_existing", "ttm_trailing_total",
    "change_in_existing_ttm", "ytd_total", "ytd_total_new", "ytd_total_existing",
    "ytd_trailing_total", "change_in_existing_ytd",
]
PRODUCT_MONEY = [
    "monthly_total_product", "monthly_trailing_total_product", "ttm_total_product",
    "ttm_trailing_total_product", "ytd_total_product", "ytd_trailing_total_product",
]
KEYS = "account_id, product, gateway_group, date"

RETENTION_SELECTS = {
    "priced_monthly_totals": f"""
        SELECT account_id, account_name, account_manager_name, organization_id, product, gateway_group,
               {_as_date('mi')} AS date, CAST(monthly_total AS DECIMAL(38,13)) AS monthly_total
        FROM totals LEFT JOIN who USING (account_id)""",
    "series_extent": f"SELECT {_SERIES}, {_as_date('low')} AS min_date, {_as_date('high')} AS max_date FROM spans",
    "dense_base": """
        SELECT account_id, account_name, account_manager_name, product, gateway_group, org_label AS organization_id,
               month, year, date, v AS monthly_total FROM named""",
    "monthly_metrics": f"""
        SELECT {KEYS}, monthly_cohort, monthly_trailing_total, change_in_existing_monthly FROM aux""",
    "ttm_rolling": f"SELECT {KEYS}, ttm_total FROM aux",
    "ttm_trailing": f"SELECT {KEYS}, ttm_trailing_total FROM aux",
    "ttm_cohort": f"SELECT DISTINCT account_id, product, {_as_date('t_start')} AS ttm_cohort FROM starts JOIN series USING (pid) WHERE t_start IS NOT NULL",
    "ytd_cohort": f"SELECT DISTINCT account_id, product, {_as_date('y_start')} AS ytd_cohort FROM starts JOIN series USING (pid) WHERE y_start IS NOT NULL",
    "monthly_cohort": f"SELECT account_id, product, {_as_date('m_start')} AS monthly_cohort FROM m_starts",
    "ttm_new_existing": f"SELECT {KEYS}, ttm_total_new, ttm_total_existing FROM aux",
    "ytd_running": f"SELECT {KEYS}, ytd_total FROM aux",
    "ytd_trailing": f"SELECT {KEYS}, ytd_trailing_total FROM aux",
    "ytd_new_existing": f"SELECT {KEYS}, ytd_total_new, ytd_total_existing FROM aux",
    "aux_report": f"""
        SELECT account_id, account_name, account_manager_name, product, gateway_group,
               monthly_cohort, ttm_cohort, ytd_cohort, organization_id, date, month, year, {', '.join(AUX_MONEY)} FROM aux""",
    "product_totals": f"SELECT DISTINCT account_id, product, date, {', '.join(PRODUCT_MONEY)} FROM aux",
    "future_activity": f"""
        SELECT DISTINCT account_id, product, date, {', '.join(f'{h}_future_date' for h in _HORIZONS)} FROM aux""",
    **{f"{h}_status": f"SELECT {KEYS}, {h}_status FROM aux" for h in _HORIZONS},
    "status_counts": f"""
        SELECT {_as_date('mi')} AS date, horizon, status, COUNT(*) AS n_rows FROM judged GROUP BY ALL""",
    "max_ttm_band": f"SELECT DISTINCT account_id, product, {_money('max_total')}, processing_max_ttm_size FROM peaks JOIN series USING (pid)",
    "attribution": """
        SELECT DISTINCT account_id, attribution_type, attribution_source, industry FROM report""",
    "size_py_distinct": """
        SELECT DISTINCT account_id, product, year, customer_size_py FROM report""",
    "retention_report": f"""
        SELECT account_id, account_name, account_manager_name, product, monthly_cohort, ttm_cohort, ytd_cohort,
               organization_id, gateway_group, industry, date, month, year, {', '.join(AUX_MONEY + PRODUCT_MONEY)},
               monthly_status, ttm_status, ytd_status, attribution_type, attribution_source,
               product_max_ttm_size, processing_max_ttm_size, customer_size_py
        FROM report""",
}


# In whole units: cents, rates of 24 decimals by the text of the double, take rates of six decimals.
RETENTION_SELECTS["priced_monthly_totals_double"] = f"""
        SELECT account_id, product, gateway_group, {_as_date('mi')} AS date,
               CAST(CAST(sign(units) AS HUGEINT) * ((abs(units) + 500000000000000000000000000) // 1000000000000000000000000000) AS DECIMAL(32,0))
               * 0.00001::DECIMAL(6,5) AS monthly_total
        FROM (
          SELECT s.*, s.part * CAST(COALESCE(k.rate, CASE s.gateway_group WHEN 'WePay' THEN 0.005373 ELSE 0.001075 END) * 1000000 AS HUGEINT) AS units
          FROM (
            SELECT account_id, product, gateway_group, mi,
                   SUM((3 - 2 * transaction_type) * CAST(amount * 100 AS HUGEINT) * rate24) AS part
            FROM (
              SELECT t.*, f.product, {_month('t.date_created')} AS mi,
                     CASE WHEN g.type IN ('wepay', 'stripe', 'adyen') THEN MAP {{'wepay': 'WePay', 'stripe': 'Stripe', 'adyen': 'Adyen'}}[g.type]
                          WHEN g.type IS NOT NULL THEN 'Other' END AS gateway_group,
                     CAST(replace(CAST(CAST(CAST(
                       1.0::DOUBLE / ((16345 + 10 * date_diff('day', DATE '1995-01-01', x.date) + CAST(x.currency AS INTEGER)) / 1000.0::DOUBLE)
                       AS VARCHAR) AS DECIMAL(38,24)) AS VARCHAR), '.', '') AS HUGEINT) AS rate24
              FROM tx t LEFT JOIN form f ON f.id = t.form_id LEFT JOIN gateway g ON g.id = t.gateway_id
              LEFT JOIN fx x ON x.currency = t.currency AND x.date = CAST(t.date_created AS DATE) WHERE t.status = 6)
            GROUP BY ALL) s
          LEFT JOIN take k ON k.gateway_group = s.gateway_group AND k.product = s.product AND {_month('k.date')} = s.mi)"""
RETENTION_SELECTS["retention_report_incremental"] = RETENTION_SELECTS["retention_report"]


def retention_sql(name: str) -> str:
    return "WITH " + FIXTURE_CTES.strip() + ",\n" + MODEL_CTES.strip() + "\n" + RETENTION_SELECTS[name]



# ------------------------------------------------------------------ jobs

_KEYED_GAPS = """
WITH cal AS (
  SELECT CAST(range AS DATE) AS missing_date
  FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-02', INTERVAL 1 {step})
),
ks AS (SELECT DISTINCT {key} FROM orders),
seen AS (SELECT DISTINCT {key}, CAST({trunc} AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)
SELECT ks.*, cal.missing_date FROM ks CROSS JOIN cal
WHERE ({key}, missing_date) NOT IN (SELECT ({key}, d) FROM seen)
"""

_QUOTES = """
WITH quotes AS (
  SELECT CAST(o_orderdate AS DATE) AS date, left(o_orderpriority, 1) AS currency, max(o_orderkey) AS top
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, o_orderstatus
),
priced AS (
  SELECT date, currency, CASE WHEN top % 41 = 0 THEN NULL WHEN top % 37 = 0 THEN 0.0 ELSE (top % 16 + 1) / 8.0 END AS quoted FROM quotes
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date, currency ORDER BY quoted DESC) AS place
  FROM (SELECT DISTINCT date, currency, quoted FROM priced WHERE quoted <> 0)
)"""

_LANDING = """
WITH raw AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderkey % 53 = 0 THEN 'not a date'
              WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
              WHEN o_orderkey % 11 = 0 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
              WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00')
              WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%m/%d/%Y 10:00')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d_txt,
         CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 37 = 0 THEN NULL
              WHEN o_orderkey % 211 = 0 THEN 'abc'
              WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0'
              ELSE CAST(o_custkey AS VARCHAR) END AS a_txt,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderpriority END AS product,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END AS amt_txt,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderstatus END AS source
  FROM orders
),
typed AS (
  SELECT *,
         CAST(try_strptime(d_txt, ['%Y-%m-%d', '%m/%d/%Y', '%Y-%m-%dT%H:%M:%S', '%m/%d/%Y %H:%M']) AS DATE) AS d,
         CAST(trunc(TRY_CAST(a_txt AS DECIMAL(38,10))) AS BIGINT) AS a,
         TRY_CAST(amt_txt AS DOUBLE) AS amt
  FROM raw
  WHERE NOT (d_txt IS NULL AND a_txt IS NULL AND product IS NULL AND amt_txt IS NULL AND source IS NULL)
),
judged AS (
  SELECT *, CASE WHEN a_txt IS NULL THEN 'null_account_id'
                 WHEN a IS NULL THEN 'bad_account_id'
                 WHEN d_txt IS NOT NULL AND d IS NULL THEN 'bad_date'
                 WHEN amt_txt IS NOT NULL AND amt IS NULL THEN 'bad_amount' END AS reason
  FROM typed
)
"""

_FLAGS = """
SELECT event_id AS id, user_id AS form_id,
       CAST(CASE WHEN props LIKE '%"k": 7%' THEN 1 ELSE 0 END AS INTEGER) AS pp_enabled,
       ts AS date_created
FROM events
"""

_PROJECTS = "('click', 'purchase', 'signup', 'view')"

_GRANTS = """
WITH ev AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events),
spans AS (SELECT user_id, MIN(day) AS d0, MAX(day) AS d1 FROM ev GROUP BY 1),
objs AS (
  SELECT user_id,
         CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM spans
),
states AS (
  SELECT o.day || ' in user ' || o.user_id AS object, g.grantee,
         bool_or(e.event_type = g.grantee AND g.grantee <> 'error') AS granted, count(e.event_type) > 0 AS present
  FROM objs o CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS g(grantee)
  LEFT JOIN ev e ON e.user_id = o.user_id AND e.day = o.day
  GROUP BY 1, 2
),
lacking AS (SELECT object, grantee FROM states WHERE present AND NOT granted)
"""

JOB_SQL = {
    "missing_dates": _KEYED_GAPS.format(step="DAY", key="o_orderpriority, o_orderstatus", trunc="o_orderdate"),
    "missing_months_by_customer": _KEYED_GAPS.format(
        step="MONTH", key="o_custkey", trunc="date_trunc('month', o_orderdate)"),
    "missing_days_any": """
        WITH cal AS (
          SELECT CAST(range AS DATE) AS missing_date
          FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-02', INTERVAL 1 DAY))
        SELECT missing_date FROM cal
        WHERE missing_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders
                                   WHERE o_orderdate IS NOT NULL)""",
    "rates_ingest": _QUOTES + """
        SELECT date, currency, 1.0 / CAST(quoted AS DOUBLE) AS rate FROM ranked
        WHERE place = 1 AND (date, currency) NOT IN (
          SELECT (CAST(o_orderdate AS DATE), left(o_orderpriority, 1)) FROM orders WHERE o_orderdate IS NOT NULL AND o_orderkey % 3 = 0)""",
    "rates_rejects": _QUOTES + """
        SELECT date, currency, CASE WHEN quoted IS NULL THEN 'null_rate' ELSE 'zero_rate' END AS reason
        FROM priced WHERE quoted IS NULL OR quoted = 0
        UNION ALL SELECT date, currency, 'duplicate_key' FROM ranked WHERE place > 1""",
    "landing_clean": _LANDING + """
        SELECT d AS date_created, a AS account_id, product, amt AS total, source
        FROM judged WHERE reason IS NULL""",
    "landing_rejects": _LANDING + """
        SELECT reason, COUNT(*) AS n_rows FROM judged WHERE reason IS NOT NULL GROUP BY 1""",
    "flag_full": _FLAGS,
    "flag_increment": _FLAGS,
    "flag_stream": _FLAGS,
    "freshness": f"""
        SELECT * FROM (
          SELECT CAST(floor((epoch_us(TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 7 HOUR)
                             - epoch_us(COALESCE(updated_at, TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 7 HOUR)))
                            / 86400000000.0) AS INTEGER) AS days_since_refresh,
                 name AS extract, CAST(updated_at AS DATE) AS updated_at, project
          FROM (SELECT 'user ' || CAST(user_id AS VARCHAR) AS name, event_type AS project,
                       MAX(ts) AS updated_at, COUNT(*) > 1 AS has_extracts
                FROM events GROUP BY user_id, event_type) inv
          WHERE has_extracts AND project IN {_PROJECTS}
        ) x WHERE days_since_refresh > 0""",
    "missing_grants": _GRANTS + "SELECT object, grantee FROM lacking",
    "missing_grants_listed": _GRANTS + """
        SELECT object, COUNT(*) AS n_missing, string_agg(grantee, ', ' ORDER BY grantee) AS missing_grantees
        FROM lacking GROUP BY object""",
    "absent_objects": _GRANTS + "SELECT DISTINCT object FROM states WHERE NOT present",
    "schedule_outside_window": f"""
        SELECT 'user ' || CAST(user_id AS VARCHAR) AS datasource_name, event_type AS project_name,
               value >= 1.0 AS refreshed_daily, strftime(ts, '%H:%M:%S.%f') AS start_time,
               false AS in_range
        FROM events
        WHERE event_type IN {_PROJECTS}
          AND NOT ((epoch_us(ts) - epoch_us(date_trunc('day', ts)))
                   BETWEEN 7200000000 AND 10800000000)""",
}


JOB_SQL["rates_append"] = """
    WITH quotes AS (
      SELECT CAST(o_orderdate AS DATE) AS date, left(o_orderpriority, 1) AS currency, o_orderstatus = 'F' AS first, max(o_orderkey) AS top
      FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, o_orderstatus),
    priced AS (SELECT *, (top % 16 + 1) / 8.0 AS quoted FROM quotes WHERE top % 41 <> 0 AND top % 37 <> 0),
    best AS (SELECT date, currency, coalesce(max(quoted) FILTER ("first"), max(quoted)) AS quoted FROM priced GROUP BY 1, 2)
    SELECT date, currency, 1.0 / CAST(quoted AS DOUBLE) AS rate FROM best"""
JOB_SQL["landing_files"] = JOB_SQL["landing_clean"]
# the month comes first unless it is over 12; only three of the layouts leave that open
JOB_SQL["landing_dates"] = """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 14 IN (1, 2, 12) AND day(o_orderdate) <= 12
                THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
                ELSE CAST(o_orderdate AS DATE) END AS day
    FROM orders"""
JOB_SQL["flag_stream_late"] = """
    WITH ev AS (SELECT *, epoch_us(ts) AS us FROM events),
    ends AS (SELECT min(us) AS low, max(us) - min(us) + 1 AS span FROM ev),
    placed AS (SELECT ev.*, least(3, (us - low) * 4 // span) AS own FROM ev, ends),
    deliveries AS (
      SELECT *, CASE WHEN event_id % 11 = 0 THEN least(own + 1, 3) ELSE own END AS n FROM placed
      UNION ALL SELECT *, own + 1 FROM placed WHERE event_id % 3 = 0 AND event_id % 11 <> 0 AND own < 3),
    marks AS (SELECT n, (SELECT max(us) FROM deliveries b WHERE b.n < a.n) // 1000 * 1000 - 86400000000 AS mark FROM (SELECT DISTINCT n FROM deliveries) a)
    SELECT DISTINCT event_id AS id, user_id AS form_id, CAST(CASE WHEN props LIKE '%"k": 7%' THEN 1 ELSE 0 END AS INTEGER) AS pp_enabled, ts AS date_created
    FROM deliveries JOIN marks USING (n) WHERE mark IS NULL OR us > mark"""
JOB_SQL["missing_grants_paged"] = _GRANTS + """
    SELECT object, place // 2 + 1 AS page, COUNT(*) AS n_missing, string_agg(grantee, ', ' ORDER BY grantee) AS missing_grantees
    FROM (SELECT *, row_number() OVER (PARTITION BY object ORDER BY grantee) - 1 AS place FROM lacking) GROUP BY ALL"""
JOB_SQL["missing_days_ordered"] = (
    "SELECT missing_date, row_number() OVER (ORDER BY missing_date DESC) AS position FROM (" + JOB_SQL["missing_days_any"] + ") x"
)
JOB_SQL["freshness_ordered"] = (
    "SELECT *, row_number() OVER (ORDER BY days_since_refresh DESC, extract, project) AS position FROM (" + JOB_SQL["freshness"] + ") x"
)
JOB_SQL["schedule_ordered"] = (
    "SELECT *, row_number() OVER (ORDER BY lower(datasource_name) NULLS FIRST, project_name NULLS FIRST, start_time NULLS FIRST,"
    " refreshed_daily NULLS FIRST, datasource_name NULLS FIRST) AS position FROM (" + JOB_SQL["schedule_outside_window"] + ") x"
)
JOB_SQL["audit_summary"] = (
    "SELECT 'stale_extracts' AS audit, COUNT(*) AS n_rows FROM (" + JOB_SQL["freshness"] + ") a"
    " UNION ALL SELECT 'missing_grants', COUNT(*) FROM (" + JOB_SQL["missing_grants"] + ") b"
    " UNION ALL SELECT 'absent_objects', COUNT(*) FROM (" + JOB_SQL["absent_objects"] + ") c"
    " UNION ALL SELECT 'outside_window', COUNT(*) FROM (" + JOB_SQL["schedule_outside_window"] + ") d"
)


def all_oracle_sql() -> dict[str, str]:
    out = {name: retention_sql(name) for name in RETENTION_SELECTS}
    out.update(JOB_SQL)
    return out
