"""The catalogue's queries once more, as plain SQL over the same test tables.

Written for an engine with DuckDB's functions. Each statement is formulated on its own
terms (ordinary windows, joins and quantiles), not after the Spark plan, so that agreement
means something.
"""

from __future__ import annotations

import re

from basketlens.plans import forecast

# --- views over the test tables ----------------------------------------------------------

_VIEWS = {
    "product": """
  SELECT p_partkey AS k, CAST(p_size AS VARCHAR) AS CATEGORY_ID,
    CASE WHEN p_partkey % 7 = 0 THEN NULL
         WHEN p_partkey % 3 = 0 THEN lower(p_type)
         WHEN p_partkey % 5 = 0 THEN lower(p_type) || '.' || replace(p_name, ' ', '.') || '.' || p_size
         ELSE lower(p_type) || '.' || replace(p_name, ' ', '.') END AS CATEGORY_CODE,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS BRAND
  FROM part""",
    "log": """
  SELECT e.ts AS EVENT_TIME,
    CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS EVENT_TYPE,
    CAST(e.k AS VARCHAR) AS PRODUCT_ID, p.CATEGORY_ID, p.CATEGORY_CODE, p.BRAND,
    CASE WHEN e.event_id % 53 = 0 THEN 0.0::DOUBLE ELSE e.value END AS PRICE,
    CAST(e.user_id AS VARCHAR) AS USER_ID,
    e.user_id || '-' || strftime(e.ts, '%Y%m%d') AS USER_SESSION,
    CAST(CASE WHEN day(e.ts) <= 15 THEN 1 ELSE 2 END AS INTEGER) AS BATCHNUMBER, e.event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN product p ON p.k = e.k""",
    "dirty": """
  SELECT l.* REPLACE (
      CASE WHEN event_id % 97 = 0 THEN NULL ELSE USER_ID END AS USER_ID,
      CASE WHEN event_id % 101 = 0 THEN NULL ELSE PRODUCT_ID END AS PRODUCT_ID)
  FROM (SELECT * FROM log UNION ALL SELECT * FROM log WHERE event_id % 41 = 0) l""",
    "fact": """
  SELECT EVENT_TIME AS EVENT_DATETIME, CAST(EVENT_TIME AS DATE) AS EVENT_DATE, EVENT_TYPE,
    PRODUCT_ID, PRICE, USER_ID, USER_SESSION
  FROM log WHERE EVENT_TYPE <> 'purchase' OR PRICE > 0""",
    "sales": """
  SELECT CAST(l_shipdate AS DATE) AS EVENT_DATE, 'purchase' AS EVENT_TYPE,
    CAST(l_partkey % 10 AS VARCHAR) AS PRODUCT_ID, l_extendedprice / l_quantity AS PRICE
  FROM lineitem""",
    "target": """
  SELECT n_name AS COUNTRY,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS YEARMONTH,
    round(sum(o_totalprice), 2) AS TARGET,
    CASE WHEN year(o_orderdate) < 2000 THEN 1 ELSE 2 END AS BATCHNUMBER
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name, year(o_orderdate), month(o_orderdate)""",
    "ledger": """
  SELECT batchID, strftime(min(o_orderdate), '%Y%m%d') AS "date",
    strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS startTime, item,
    CASE WHEN sum(o_orderkey) % 4 = 0 THEN 'running' ELSE 'complete' END AS status
  FROM (SELECT CAST((year(o_orderdate) - 1990) * 12 + month(o_orderdate) AS INTEGER) AS batchID,
          ['Start', 'hist_behaviour_log', 'hist_sales_target', 'cur_dim_date',
           'cur_dim_product', 'cur_fact_behaviour', 'cur_fact_target'][o_custkey % 7 + 1] AS item,
          o_orderdate, o_orderkey FROM orders)
  GROUP BY batchID, item""",
    "copies": """
  SELECT item, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS endTime,
    CASE WHEN sum(l_linenumber) % 3 = 0 THEN 'failed' ELSE 'complete' END AS status
  FROM (SELECT ['behaviour_log', 'sales_target', 'other'][l_orderkey % 3 + 1] AS item,
          l_shipdate, l_linenumber FROM lineitem)
  GROUP BY item, l_shipdate""",
    # usable events, repeated views removed, numbered
    "usable": """
  SELECT * FROM dirty WHERE USER_ID IS NOT NULL AND USER_SESSION IS NOT NULL""",
    "unique_views": """
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY USER_ID, USER_SESSION, EVENT_TIME, EVENT_TYPE, PRODUCT_ID ORDER BY PRICE) AS nth
    FROM usable) WHERE nth = 1 OR EVENT_TYPE <> 'view'""",
    "latest_views": """
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY USER_ID, USER_SESSION, EVENT_TIME, EVENT_TYPE, PRODUCT_ID ORDER BY PRICE) AS nth
    FROM usable WHERE BATCHNUMBER = (SELECT max(BATCHNUMBER) FROM dirty))
  WHERE nth = 1 OR EVENT_TYPE <> 'view'""",
    "numbered": """
  SELECT *, row_number() OVER (PARTITION BY USER_ID, USER_SESSION
      ORDER BY EVENT_TIME, EVENT_TYPE, PRODUCT_ID NULLS LAST, PRICE) AS ACTION_ITEMS
  FROM latest_views""",
    # segmentation
    "basket": """
  SELECT USER_SESSION, max(EVENT_DATETIME) AS DATETIME_ORDER,
    string_agg(DISTINCT USER_ID, ', ' ORDER BY USER_ID) AS USER_ID, count(*) AS QUANTITY,
    sum(PRICE) AS SPENT_MONEY
  FROM fact WHERE EVENT_TYPE = 'purchase' GROUP BY USER_SESSION""",
    "users": """
  SELECT USER_ID,
    CAST(min(date_diff('day', CAST(DATETIME_ORDER AS DATE),
      CAST((SELECT max(DATETIME_ORDER) FROM basket) AS DATE) + 1)) AS INTEGER) AS RECENCY,
    count(*) AS FREQUENCY, CAST(sum(SPENT_MONEY) AS DECIMAL(30,2)) AS MONETARY
  FROM basket GROUP BY USER_ID""",
    "cuts": """
  SELECT quantile_disc(RECENCY, [0.25, 0.5, 0.75]) AS r,
    quantile_disc(FREQUENCY, [0.25, 0.5, 0.75]) AS f,
    quantile_disc(MONETARY, [0.25, 0.5, 0.75]) AS m FROM users""",
    "scored": """
  SELECT *, R_QUARTILE + F_QUARTILE + M_QUARTILE AS RFM_SCORE FROM (
    SELECT users.*,
      CASE WHEN RECENCY <= r[1] THEN 1 WHEN RECENCY <= r[2] THEN 2
           WHEN RECENCY <= r[3] THEN 3 ELSE 4 END AS R_QUARTILE,
      CASE WHEN FREQUENCY <= f[1] THEN 4 WHEN FREQUENCY <= f[2] THEN 3
           WHEN FREQUENCY <= f[3] THEN 2 ELSE 1 END AS F_QUARTILE,
      CASE WHEN MONETARY <= m[1] THEN 4 WHEN MONETARY <= m[2] THEN 3
           WHEN MONETARY <= m[3] THEN 2 ELSE 1 END AS M_QUARTILE
    FROM users, cuts)""",
    "labelled": """
  SELECT *, CASE WHEN RFM_SCORE >= 10 THEN 'Lost' WHEN RFM_SCORE = 9 THEN 'Hibernating'
      WHEN RFM_SCORE = 8 THEN 'Can’t Lose Them' WHEN RFM_SCORE = 7 THEN 'About To Sleep'
      WHEN RFM_SCORE = 6 THEN 'Promising' WHEN RFM_SCORE = 5 THEN 'Potential Loyalist'
      WHEN RFM_SCORE = 4 THEN 'Loyal Customers' ELSE 'Champions' END AS RFM_LABEL
  FROM scored""",
}

# Segmentation once more where two users share a session.
_VIEWS["pair_fact"] = """
  SELECT * REPLACE (USER_ID::BIGINT // 2 || '-' || day(EVENT_DATETIME) % 8 AS USER_SESSION) FROM fact"""
for _name in ("basket", "users", "cuts", "scored", "labelled"):
    _VIEWS[f"pair_{_name}"] = re.sub(r"\b(fact|basket|users|cuts|scored)\b", r"pair_\1", _VIEWS[_name])


def _weeks(source: str) -> str:
    return f"""
  SELECT *, CAST(week(EVENT_DATE) AS INTEGER) AS WEEK_NUMBER,
    CAST(year(EVENT_DATE) AS INTEGER) AS YEAR,
    CAST(CASE WHEN year(EVENT_DATE) = (SELECT min(year(EVENT_DATE)) FROM {source})
          AND NOT (month(EVENT_DATE) = 12 AND week(EVENT_DATE) = 1) THEN 1 ELSE 2 END AS INTEGER)
      AS WEEK_NUMBER_CYCLE
  FROM {source}"""


def _weekly(source: str, cycle: bool = False) -> str:
    more = ", WEEK_NUMBER_CYCLE" if cycle else ""
    most = ", max(WEEK_NUMBER_CYCLE) AS WEEK_NUMBER_CYCLE" if cycle else ""
    return f"""
  SELECT *, CAST(CASE WHEN WEEK_NUMBER = 1 THEN 52 ELSE WEEK_NUMBER - 1 END AS INTEGER)
      AS PREVIOUS_WEEK_NUMBER
  FROM (SELECT PRODUCT_ID, WEEK_NUMBER{more}, count(*) AS DAYS_PURCHASED,
          avg(AVG_PRICE) AS AVG_PRICE, sum(SALES) / count(*) * 7 AS SALES
        FROM (SELECT PRODUCT_ID, EVENT_DATE, max(WEEK_NUMBER) AS WEEK_NUMBER{most},
                count(*) AS SALES, avg(PRICE) AS AVG_PRICE
              FROM {source} WHERE EVENT_TYPE = 'purchase' GROUP BY PRODUCT_ID, EVENT_DATE)
        GROUP BY PRODUCT_ID, WEEK_NUMBER{more})"""


def _demand(weekly: str, join: str, extra: str = "") -> str:
    return f"""
  SELECT a.*, b.SALES AS PREVIOUS_WEEK_SALES, b.AVG_PRICE AS PREVIOUS_WEEK_AVG_PRICE
  FROM {weekly} a {join} JOIN {weekly} b
    ON a.PRODUCT_ID = b.PRODUCT_ID AND a.PREVIOUS_WEEK_NUMBER = b.WEEK_NUMBER{extra}"""


def _perspective(kind: str, count: str, stem: str, source: str) -> str:
    price = "avg(PRICE) AS MEAN_PRICE, " if kind == "purchase" else ""
    sums = ", ".join(
        f"sum({count}) OVER (PARTITION BY PRODUCT_ID ORDER BY WEEK_NUMBER_CYCLE, WEEK_NUMBER "
        f"ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) - {count} AS {stem}_PREV_{n}W"
        for n in (1, 2, 4)
    )
    return f"""
  SELECT *, {sums}
  FROM (SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER, {price}count(*) AS {count}
        FROM {source} WHERE EVENT_TYPE = '{kind}'
        GROUP BY PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER)"""


_KINDS = {
    "purchase": ("SALES_OCCURRENCE", "SALES_OCC", "SALES"),
    "view": ("VIEW_COUNT", "VIEW_CNT", "VIEWS"),
    "cart": ("CART_COUNT", "CART_CNT", "CARTS"),
}


def _features() -> str:
    columns = ["PRODUCT_ID", "WEEK_NUMBER_CYCLE", "WEEK_NUMBER"]

    def logged(c: str) -> str:
        return f"CASE WHEN {c} > 0 THEN ln({c}) END AS {c}"

    columns.append(logged("SALES_OCCURRENCE"))
    for _, stem, _ in _KINDS.values():
        columns += [logged(f"{stem}_PREV_{n}W") for n in (1, 2, 4)]
    for _, stem, name in _KINDS.values():
        for label, a, b in (("1W2W", 1, 2), ("2W2W", 2, 4), ("1W4W", 1, 4)):
            columns.append(
                f"{stem}_PREV_{a}W / nullif({stem}_PREV_{b}W, 0) AS {name}_{label}_RATIO"
            )
    return f"""
  SELECT {', '.join(columns)}
  FROM purchases LEFT JOIN views USING (PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER)
    LEFT JOIN carts USING (PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER)"""


_VIEWS |= {
    "sale_weeks": _weeks("sales"),
    "fact_weeks": _weeks("fact"),
    "sale_weekly": _weekly("sale_weeks"),
    "undated_weeks": "SELECT * FROM sale_weeks WHERE day(EVENT_DATE) <> 13",
    "undated_weekly": _weekly("undated_weeks"),
    "sale_weekly_cycle": _weekly("sale_weeks", cycle=True),
    "fact_weekly": _weekly("fact_weeks"),
    "sale_demand": _demand("sale_weekly", "INNER"),
    "purchases": _perspective("purchase", "SALES_OCCURRENCE", "SALES_OCC", "fact_weeks"),
    "views": _perspective("view", "VIEW_COUNT", "VIEW_CNT", "fact_weeks"),
    "carts": _perspective("cart", "CART_COUNT", "CART_CNT", "fact_weeks"),
    "features": _features(),
    "top10": """
  SELECT PRODUCT_ID, count(*) AS PURCHASES FROM fact WHERE EVENT_TYPE = 'purchase'
  GROUP BY PRODUCT_ID ORDER BY PURCHASES DESC, PRODUCT_ID LIMIT 10""",
    "last_week": """
  SELECT max((WEEK_NUMBER_CYCLE, WEEK_NUMBER)) AS w FROM purchases""",
    # Slope of ln sales on ln price with its standard error.
    "line": """
  SELECT PRODUCT_ID, count(*) AS n, regr_slope(y, x) AS slope, regr_r2(y, x) AS r2,
    sqrt((1 - regr_r2(y, x)) * regr_syy(y, x) / (count(*) - 2) / regr_sxx(y, x)) AS se
  FROM (SELECT PRODUCT_ID, ln(SALES) AS y, ln(AVG_PRICE) AS x FROM sale_demand)
  GROUP BY PRODUCT_ID""",
    # The same with two controls, by partialling the controls out of price and sales.
    "logs": """
  SELECT PRODUCT_ID, ln(SALES) AS y, ln(AVG_PRICE) AS x, ln(PREVIOUS_WEEK_SALES + 1) AS c1,
    ln(PREVIOUS_WEEK_AVG_PRICE + 1) AS c2 FROM sale_demand""",
    "without_c1": """
  SELECT l.PRODUCT_ID, y - (y_m + y_b * (c1 - c_m)) AS y, x - (x_m + x_b * (c1 - c_m)) AS x,
    c2 - (d_m + d_b * (c1 - c_m)) AS c2
  FROM logs l JOIN (SELECT PRODUCT_ID, avg(y) AS y_m, avg(x) AS x_m, avg(c2) AS d_m,
      avg(c1) AS c_m, regr_slope(y, c1) AS y_b, regr_slope(x, c1) AS x_b,
      regr_slope(c2, c1) AS d_b FROM logs GROUP BY PRODUCT_ID) f USING (PRODUCT_ID)""",
    "without_controls": """
  SELECT w.PRODUCT_ID, y - y_b * c2 AS y, x - x_b * c2 AS x
  FROM without_c1 w JOIN (SELECT PRODUCT_ID, regr_slope(y, c2) AS y_b, regr_slope(x, c2) AS x_b
      FROM without_c1 GROUP BY PRODUCT_ID) f USING (PRODUCT_ID)""",
    "plane": """
  SELECT PRODUCT_ID, n, slope, 1 - rss / syy AS r2, sqrt(rss / (n - 4) / sxx) AS se
  FROM (SELECT PRODUCT_ID, count(*) AS n, regr_slope(y, x) AS slope, regr_sxx(y, x) AS sxx,
          regr_syy(y, x) * (1 - regr_r2(y, x)) AS rss
        FROM without_controls GROUP BY PRODUCT_ID)
    JOIN (SELECT PRODUCT_ID, regr_syy(y, x) AS syy FROM logs GROUP BY PRODUCT_ID)
      USING (PRODUCT_ID)""",
}


def _views_for(body: str) -> list[str]:
    """The views a statement needs, each after the ones it uses itself."""
    order = list(_VIEWS)
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & _VIEWS.keys() - needed:
            needed.add(name)
            pending.append(_VIEWS[name])
    return [name for name in order if name in needed]


def _sql(body: str) -> str:
    views = [f"{name} AS ({_VIEWS[name]})" for name in _views_for(body)]
    return (f"WITH {', '.join(views)}\n" if views else "") + body.strip()


def _time(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column}"


def _parts(column: str) -> str:
    return ", ".join(
        f"CAST({f}({column}) AS INTEGER) AS PARTITION{n}"
        for f, n in (("year", "YEAR"), ("month", "MONTH"), ("day", "DAY"))
    )


def _p_value(t: str, v: str) -> str:
    """Two-sided Student-t tail by the finite sum, coefficients from the gamma function."""
    theta = f"atan(abs({t}) / sqrt({v}))"
    even = (
        f"sin({theta}) * list_sum(list_transform(range(0, ({v} // 2)::BIGINT), "
        f"lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1)) * pow(cos({theta}), 2 * k)))"
    )
    odd = (
        f"2 / pi() * ({theta} + sin({theta}) * coalesce(list_sum(list_transform("
        f"range(0, ({v} // 2)::BIGINT), lambda k: exp(lgamma(1.5) + lgamma(k + 1) - lgamma(k + 1.5)) "
        f"* pow(cos({theta}), 2 * k + 1))), 0))"
    )
    return f"1 - CASE WHEN {v} % 2 = 0 THEN {even} ELSE {odd} END"


def _report(error: str, table: str, fields: str, value: str, pk: str, pk_value: str, text: str) -> str:
    return f"""
  SELECT '20240201' AS dataDate, '{error}' AS errorType, '{table}' AS checkTable,
    '{fields}' AS checkField, {value} AS checkFieldValue, '{pk}' AS primaryKey,
    {pk_value} AS primaryKeyValue, {text} AS errorMessage,
    '2024-02-01 00:00:00.000000' AS runDate"""


_HISTORY = f"""
SELECT {_time('EVENT_TIME')}, EVENT_TYPE, PRODUCT_ID, CATEGORY_ID, CATEGORY_CODE, BRAND,
  round(PRICE, 4) AS PRICE, USER_ID, USER_SESSION, 7 AS BATCHNUMBER, {_parts('EVENT_TIME')}
FROM log"""

_EVENT = f"{_time('EVENT_TIME')}, EVENT_TYPE, PRODUCT_ID, round(PRICE, 4) AS PRICE, USER_ID, USER_SESSION"

_DAYS = """
SELECT COUNTRY, YEARMONTH, TARGET, CAST(day(last_day(first)) AS INTEGER) AS n,
  CAST(unnest(range(first, first + INTERVAL 1 MONTH, INTERVAL 1 DAY)) AS DATE) AS d
FROM (SELECT *, strptime(CAST(YEARMONTH AS VARCHAR) || '01', '%Y%m%d') AS first FROM {})"""

_RFM = """
SELECT USER_ID, RECENCY, FREQUENCY, CAST(MONETARY AS DOUBLE) AS MONETARY, R_QUARTILE, F_QUARTILE,
  M_QUARTILE, concat(R_QUARTILE, F_QUARTILE, M_QUARTILE) AS RFM_SEGMENTATION, RFM_SCORE, RFM_LABEL
FROM labelled"""

_MALFORMED = """
SELECT EVENT_TYPE, BRAND, count(*) AS N, CAST(sum(PRODUCT_ID::BIGINT) AS BIGINT) AS PRODUCTS
FROM log WHERE event_id % 9 <> 4 GROUP BY ALL
UNION ALL SELECT 'Malformed row', NULL, count(*), NULL FROM log WHERE event_id % 9 = 4"""

_DIM = """
SELECT PRODUCT_ID, CATEGORY_ID, coalesce(levels[1], 'N/A') AS CATEGORY,
  coalesce(levels[2], 'N/A') AS SUBCATEGORY1, coalesce(levels[3], 'N/A') AS SUBCATEGORY2,
  coalesce(levels[4], 'N/A') AS SUBCATEGORY3, coalesce(BRAND, 'N/A') AS BRAND{more}
FROM (SELECT PRODUCT_ID, any_value(CATEGORY_ID) AS CATEGORY_ID, any_value(BRAND) AS BRAND,
        string_split(any_value(CATEGORY_CODE), '.') AS levels, max(BATCHNUMBER) AS batch
      FROM log {where} GROUP BY PRODUCT_ID)"""

_STAMP = ", CASE WHEN batch = 2 THEN '2024-02-02 00:00:00.000000' ELSE '2024-02-01 00:00:00.000000' END AS ETLUPDATEDDATETIME"

_BASKET = f"""
SELECT USER_SESSION, {_time('DATETIME_ORDER')}, USER_ID, QUANTITY, round(SPENT_MONEY, 4) AS SPENT_MONEY
FROM basket"""

_LABEL_DUP = "The Column(s) USER_SESSION,EVENT_TYPE,PRODUCT_ID of the Table history.behaviour_log have duplicated value: ["

_DUPLICATE_ROWS = """
SELECT *, concat_ws(',', USER_SESSION, EVENT_TYPE, PRODUCT_ID) AS shown
FROM (SELECT *, count(*) OVER (PARTITION BY USER_SESSION, EVENT_TYPE, PRODUCT_ID) AS n FROM dirty)
WHERE n > 1"""


def _demand_out(source: str, cycle: bool = False) -> str:
    more = "WEEK_NUMBER_CYCLE, " if cycle else ""
    return f"""
SELECT PRODUCT_ID, {more}WEEK_NUMBER, DAYS_PURCHASED, round(AVG_PRICE + 1e-7, 4) AS AVG_PRICE,
  round(SALES + 1e-7, 4) AS SALES, PREVIOUS_WEEK_NUMBER, round(PREVIOUS_WEEK_SALES + 1e-7, 4) AS PREVIOUS_WEEK_SALES,
  round(PREVIOUS_WEEK_AVG_PRICE + 1e-7, 4) AS PREVIOUS_WEEK_AVG_PRICE
FROM ({source})"""


def _perspective_out(view: str, kind: str) -> str:
    count, stem, _ = _KINDS[kind]
    price = "round(MEAN_PRICE + 1e-7, 4) AS MEAN_PRICE, " if kind == "purchase" else ""
    sums = ", ".join(f"CAST({stem}_PREV_{n}W AS BIGINT) AS {stem}_PREV_{n}W" for n in (1, 2, 4))
    return f"SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER, {price}{count}, {sums} FROM {view}"


def _features_out() -> str:
    names = ["SALES_OCCURRENCE"]
    names += [f"{stem}_PREV_{n}W" for _, stem, _ in _KINDS.values() for n in (1, 2, 4)]
    names += [f"{s}_{r}_RATIO" for _, _, s in _KINDS.values() for r in ("1W2W", "2W2W", "1W4W")]
    rounded = ", ".join(f"round({n} + 1e-7, 4) AS {n}" for n in names)
    return f"SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER, {rounded} FROM features"


def _elasticity(fit: str, lost: int) -> str:
    return f"""
SELECT PRODUCT_ID, round(slope + 1e-7, 4) AS ELASTICITY, round(r2 + 1e-7, 4) AS R2_SCORE,
  round({_p_value('(slope / se)', f'(n - {lost})')} + 1e-7, 4) AS COEFFICIENT_PVALUE FROM {fit}"""


def _first_splits(name: str, train: str, fold: str, folds: int, holdout: str, learns: str) -> str:
    """The best first split of every drawn setting and fold, by trying all of them."""
    settings = ", ".join(
        f"({i}, {s.penalty}::DOUBLE, {s.least_gain}::DOUBLE, {s.child_rows}, {s.split_rows})"
        for i, s in enumerate(forecast.grown_settings(name))
    )
    names = [f"{stem}_PREV_{n}W" for _, stem, _ in _KINDS.values() for n in (1, 2, 4)]
    names += [f"{s}_{r}_RATIO" for _, _, s in _KINDS.values() for r in ("1W2W", "2W2W", "1W4W")]
    listed = ", ".join(f"{n}::DOUBLE" for n in names)
    part = "{0} / 1048576.0::DOUBLE * ({0} / 1048576.0::DOUBLE) / ({1} + penalty)".format
    return f"""
SELECT * FROM (
WITH train AS (SELECT *, {fold} AS fold FROM ({train}) WHERE NOT ({holdout})),
bases AS (SELECT k, sum(round(y * 1048576)) / 1048576.0::DOUBLE / count(*) AS base
  FROM (SELECT fold, SALES_OCCURRENCE AS y FROM train) JOIN range({folds}) r(k) ON {learns} GROUP BY k),
cells AS (SELECT fold, SALES_OCCURRENCE AS y, unnest([{listed}]) AS x, unnest(range({len(names)})) AS j FROM train),
bounds AS (SELECT j, list_sort(list_distinct(quantile_disc(x, {[i / 16 for i in range(1, 16)]}))) AS c FROM cells GROUP BY j)
SELECT DRAW::INTEGER AS DRAW, FOLD::INTEGER AS FOLD, {names}[j + 1] AS FEATURE,
  round(CASE WHEN b > 0 THEN c[b] END + 1e-7, 4) AS THRESHOLD,
  missing_left AS MISSING_LEFT, round(gain + 1e-7, 4) AS GAIN, nl::BIGINT AS LEFT_ROWS, nr::BIGINT AS RIGHT_ROWS,
  round(-(gl / 1048576.0::DOUBLE) / (nl + penalty) + 1e-7, 4) AS LEFT_VALUE,
  round(-(gr / 1048576.0::DOUBLE) / (nr + penalty) + 1e-7, 4) AS RIGHT_VALUE
FROM (
  SELECT *, row_number() OVER (PARTITION BY DRAW, FOLD ORDER BY gain DESC, j, b, missing_left DESC) AS pick
  FROM (
    SELECT *, 0.5::DOUBLE * ({part("gl", "nl")} + {part("gr", "nr")} - {part("gt", "nt")}) - least AS gain
    FROM (
      SELECT *, gt - gl AS gr, nt - nl AS nr FROM (
        SELECT FOLD, j, b, missing_left, gt, nt, CASE WHEN missing_left THEN gu ELSE gu - gm END AS gl,
          CASE WHEN missing_left THEN nu ELSE nu - nm END AS nl
        FROM (
          SELECT FOLD, j, b, sum(g) OVER upto AS gu, sum(n) OVER upto AS nu, sum(g) OVER here AS gt, sum(n) OVER here AS nt,
            coalesce(sum(g) FILTER (b = 0) OVER here, 0) AS gm, coalesce(sum(n) FILTER (b = 0) OVER here, 0) AS nm
          FROM (
            SELECT k AS FOLD, j, b, sum(round((base - y) * 1048576))::DOUBLE AS g, count(*) AS n
            FROM (SELECT cells.*, CASE WHEN x IS NULL THEN 0 ELSE 1 + len(list_filter(c, lambda v: v < x)) END AS b
                  FROM cells JOIN bounds USING (j)) JOIN bases ON {learns}
            GROUP BY ALL)
          WINDOW here AS (PARTITION BY FOLD, j), upto AS (PARTITION BY FOLD, j ORDER BY b))
        CROSS JOIN (SELECT unnest([true, false]) AS missing_left)))
    CROSS JOIN (VALUES {settings}) s(DRAW, penalty, least, child, split)
    WHERE nl >= greatest(child, 1) AND nr >= greatest(child, 1) AND nt >= split)
  WHERE gain > 0) JOIN bounds USING (j)
WHERE pick = 1)"""


def _bits(salt: str) -> str:
    text = f"concat_ws('|', '{salt}', PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER)"
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


_BODIES = {
    "hist_behaviour_log": _HISTORY,
    "csv_roundtrip": _HISTORY,
    "hist_sales_target": """
SELECT COUNTRY, YEARMONTH, TARGET, 3 AS BATCHNUMBER, 2024 AS PARTITIONYEAR, 3 AS PARTITIONMONTH,
  9 AS PARTITIONDAY FROM target""",
    "latest_batch_events": f"""
SELECT {_EVENT}, BATCHNUMBER, event_id
FROM log WHERE BATCHNUMBER = (SELECT max(BATCHNUMBER) FROM log)""",
    "dim_date": f"""
SELECT {_time('d', 'Date_Key')}, CAST(year(d) AS INTEGER) AS "Year",
  CASE WHEN month(d) < 6 THEN 1 ELSE 2 END AS HalfYear, CAST(quarter(d) AS INTEGER) AS "Quarter",
  CAST(month(d) AS INTEGER) AS "Month", strftime(d, '%b') AS MonthName,
  CAST(strftime(d, '%Y%m') AS INTEGER) AS YearMonth, CAST(strftime(d, '%U') AS INTEGER) AS Week,
  CAST(day(d) AS INTEGER) AS "Day", CAST(strftime(d, '%w') AS INTEGER) AS Weekday,
  {_time('d', '"Date"')}
FROM (SELECT unnest(range(date_trunc('year', min(o_orderdate)),
        date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS d FROM orders)""",
    "dim_product": _DIM.format(more="", where="WHERE BATCHNUMBER = (SELECT max(BATCHNUMBER) FROM log)"),
    "upsert_dim_product": _DIM.format(more=_STAMP, where=""),
    "rewrite_dim_product": _DIM.format(more=_STAMP, where=""),
    "fact_behaviour_log": f"""
SELECT {_time('EVENT_TIME', 'EVENT_DATETIME')}, strftime(EVENT_TIME, '%Y-%m-%d') AS EVENT_DATE,
  strftime(EVENT_TIME, '%H:%M:%S') AS EVENT_TIME,
  CAST(dayofweek(EVENT_TIME) + 1 AS INTEGER) AS EVENT_WEEKDAY, EVENT_TYPE, PRODUCT_ID,
  round(PRICE, 4) AS PRICE, USER_ID, USER_SESSION, CAST(ACTION_ITEMS AS INTEGER) AS ACTION_ITEMS,
  'America' AS SALES_BRANCH, {_parts('EVENT_TIME')}
FROM (SELECT *, row_number() OVER (PARTITION BY EVENT_TIME, EVENT_TYPE, USER_ID, ACTION_ITEMS
        ORDER BY USER_SESSION, PRODUCT_ID NULLS LAST, PRICE NULLS LAST) AS pick FROM numbered)
WHERE pick = 1 AND NOT (EVENT_TYPE = 'purchase' AND PRICE <= 0)""",
    "fact_behaviour_view_dedupe": f"SELECT {_EVENT} FROM unique_views",
    "action_sequence": f"""
SELECT {_EVENT}, CAST(row_number() OVER (PARTITION BY USER_ID, USER_SESSION
    ORDER BY EVENT_TIME, EVENT_TYPE, PRODUCT_ID NULLS LAST, PRICE) AS INTEGER) AS ACTION_ITEMS
FROM unique_views""",
    "action_sequence_batches": """
SELECT USER_SESSION, PRODUCT_ID, PRICE, CAST(row_number() OVER (PARTITION BY USER_SESSION
    ORDER BY EVENT_TIME, PRODUCT_ID NULLS LAST, PRICE) AS INTEGER) AS ACTION_ITEMS
FROM (SELECT USER_ID || '-' || EVENT_TYPE AS USER_SESSION, EVENT_TIME, PRODUCT_ID, PRICE FROM log)""",
    "purchase_filter": """
SELECT EVENT_TYPE, count(*) AS N, min(PRICE) AS LOWEST_PRICE
FROM log WHERE NOT (EVENT_TYPE = 'purchase' AND PRICE <= 0) GROUP BY EVENT_TYPE""",
    "fact_target_daily": f"""
SELECT COUNTRY, strftime(d, '%Y-%m-%d') AS "DATE", YEARMONTH, CAST(year(d) AS INTEGER) AS "YEAR",
  CAST(month(d) AS INTEGER) AS "MONTH", CAST(day(d) AS INTEGER) AS "DAY",
  round(TARGET / n + 1e-7, 2) AS DAILYTARGET, TARGET
FROM ({_DAYS.format('target')}) WHERE YEARMONTH >= 200001""",
    "fact_target_deduped": """
SELECT COUNTRY, YEARMONTH,
  CAST(day(last_day(strptime(CAST(YEARMONTH AS VARCHAR) || '01', '%Y%m%d'))) AS BIGINT) AS DAYS,
  round(TARGET, 2) AS MONTH_TOTAL, round(TARGET, 2) AS TARGET
FROM target WHERE BATCHNUMBER = (SELECT max(BATCHNUMBER) FROM target)""",
    "fact_user_session": f"""
SELECT {_time("date_trunc('day', last)", 'DATE_KEY')}, USER_SESSION,
  {_time('last', 'MAX_EVENT_DATETIME')}, {_time('first', 'MIN_EVENT_DATETIME')},
  round((floor(epoch(last)) - floor(epoch(first))) / 60 + 1e-7, 4) AS USER_SESSION_DURATION, {_parts('last')}
FROM (SELECT USER_SESSION, max(EVENT_DATETIME) AS last, min(EVENT_DATETIME) AS first
      FROM fact GROUP BY USER_SESSION)""",
    "hash_keys": """
SELECT PRODUCT_ID, 1::BIGINT AS PRODUCT_KEYS, CASE WHEN PRODUCT_ID IS NULL THEN '42' END AS KEY_OF_NULL,
  CASE WHEN PRODUCT_ID IS NULL THEN 1
    ELSE count(DISTINCT (EVENT_TIME, EVENT_TYPE, USER_ID, USER_SESSION, ACTION_ITEMS)) END AS ROW_KEYS, count(*) AS N
FROM (SELECT *, row_number() OVER (PARTITION BY EVENT_TIME, EVENT_TYPE, USER_ID, ACTION_ITEMS
        ORDER BY USER_SESSION, PRODUCT_ID NULLS LAST, PRICE NULLS LAST) AS pick FROM numbered)
WHERE pick = 1 AND NOT (EVENT_TYPE = 'purchase' AND PRICE <= 0) GROUP BY PRODUCT_ID""",
    "hash_key_consistency": """
SELECT coalesce(split_part(CATEGORY_CODE, '.', 1), 'N/A') AS CATEGORY, EVENT_TYPE, count(*) AS N
FROM log WHERE BATCHNUMBER = 2 AND NOT (EVENT_TYPE = 'purchase' AND PRICE <= 0)
GROUP BY ALL""",
    "session_baskets": _BASKET,
    "shared_session_baskets": f"""
SELECT strftime(EVENT_DATE, '%Y-%m-%d') AS USER_SESSION, {_time('max(EVENT_DATETIME)', 'DATETIME_ORDER')},
  count(DISTINCT USER_ID) AS USERS, count(*) AS QUANTITY,
  round(sum(PRICE), 2) AS SPENT_MONEY
FROM fact WHERE EVENT_TYPE = 'purchase' GROUP BY EVENT_DATE""",
    "rfm_users": """
SELECT USER_ID, RECENCY, FREQUENCY, CAST(MONETARY AS DOUBLE) AS MONETARY FROM users""",
    "rfm_segments": _RFM,
    "rfm_end_to_end": _RFM,
    "rfm_batches": _RFM.replace("USER_ID,", "len(string_split(USER_ID, ', ')) AS USERS,", 1).replace("labelled", "pair_labelled"),
    "rfm_quartiles_batches": "SELECT " + ", ".join(
        f"CAST({v}[{i}] AS DOUBLE) AS {n}_Q{i}"
        for n, v in (("RECENCY", "r"), ("FREQUENCY", "f"), ("MONETARY", "m")) for i in (1, 2, 3)
    ) + " FROM pair_cuts",
    "rfm_quartiles": "SELECT " + ", ".join(
        f"CAST({v}[{i}] AS DOUBLE) AS {n}_Q{i}"
        for n, v in (("RECENCY", "r"), ("FREQUENCY", "f"), ("MONETARY", "m")) for i in (1, 2, 3)
    ) + " FROM cuts",
    "rfm_quartiles_approx": "SELECT " + ", ".join(
        f"{v}[{i}] IS NOT NULL AS {n}_Q{i}"
        for n, v in (("RECENCY", "r"), ("FREQUENCY", "f"), ("MONETARY", "m")) for i in (1, 2, 3)
    ) + " FROM cuts",
    "rfm_label_counts": """
SELECT RFM_LABEL, count(*) AS CUSTOMERS, CAST(min(RFM_SCORE) AS INTEGER) AS LOWEST_SCORE
FROM labelled GROUP BY RFM_LABEL""",
    "check_null": _report(
        "Null value", "history.behaviour_log", "EVENT_TIME,USER_ID,USER_SESSION",
        "concat_ws(',', strftime(EVENT_TIME, '%Y-%m-%d %H:%M:%S.%f'), USER_ID, USER_SESSION)",
        "EVENT_TIME,USER_ID,USER_SESSION",
        "concat_ws(',', strftime(EVENT_TIME, '%Y-%m-%d %H:%M:%S.%f'), USER_ID, USER_SESSION)",
        "'The Column(s) EVENT_TIME,USER_ID,USER_SESSION of the Table history.behaviour_log is null'",
    ) + " FROM dirty WHERE USER_ID IS NULL",
    "check_duplicate": _report(
        "Duplicated value", "history.behaviour_log", "USER_SESSION,EVENT_TYPE,PRODUCT_ID", "shown",
        "event_id", "CAST(event_id AS VARCHAR)", f"'{_LABEL_DUP}' || shown || ']'",
    ) + f" FROM ({_DUPLICATE_ROWS})",
    "dedupe_latest": f"""
SELECT USER_SESSION, EVENT_TYPE, PRODUCT_ID, {_time('EVENT_TIME')}, round(PRICE, 4) AS PRICE
FROM (SELECT *, row_number() OVER (PARTITION BY USER_SESSION, EVENT_TYPE, PRODUCT_ID
        ORDER BY EVENT_TIME DESC, event_id) AS pick FROM dirty) WHERE pick = 1""",
    "dedupe_dimension": """
SELECT PRODUCT_ID, BRAND, event_id FROM (SELECT *, row_number() OVER (
  PARTITION BY PRODUCT_ID ORDER BY event_id) AS pick FROM log) WHERE pick = 1""",
    "check_mapping": _report(
        "Field mapping", "fact_behaviour_log", "PRODUCT_Key", "PRODUCT_ID", "event_id",
        "CAST(event_id AS VARCHAR)",
        "'The Column(s) PRODUCT_Key of the Table fact_behaviour_log is invalid'",
    ) + """ FROM dirty WHERE PRODUCT_ID IS NOT NULL
  AND PRODUCT_ID NOT IN (SELECT PRODUCT_ID FROM log WHERE BRAND IS NOT NULL)""",
    "quarantine": f"""
SELECT 'Null value' AS errorType, 'USER_ID' AS checkField, count(*) AS N FROM dirty
WHERE USER_ID IS NULL HAVING count(*) > 0
UNION ALL SELECT 'Duplicated value', 'USER_SESSION,EVENT_TYPE,PRODUCT_ID', count(*)
FROM ({_DUPLICATE_ROWS}) HAVING count(*) > 0""",
    "upsert_conditional": f"""
SELECT USER_ID, PRODUCT_ID,
  CASE WHEN a.USER_ID IS NULL OR a.SPENT <= b.SPENT THEN b.SPENT ELSE a.SPENT END AS SPENT,
  {_time("CASE WHEN a.USER_ID IS NULL OR a.SPENT <= b.SPENT THEN b.last ELSE a.last END", 'LAST_EVENT')}
FROM (SELECT USER_ID, PRODUCT_ID, round(sum(PRICE), 2) AS SPENT, max(EVENT_TIME) AS last
      FROM log WHERE BATCHNUMBER = 1 GROUP BY ALL) a
FULL JOIN (SELECT USER_ID, PRODUCT_ID, round(sum(PRICE), 2) AS SPENT, max(EVENT_TIME) AS last
      FROM log WHERE BATCHNUMBER = 2 GROUP BY ALL) b USING (USER_ID, PRODUCT_ID)""",
    "upsert_user_session": f"""
SELECT {_time("date_trunc('day', last)", 'DATE_KEY')}, USER_SESSION,
  {_time('last', 'MAX_EVENT_DATETIME')}, {_time('first', 'MIN_EVENT_DATETIME')},
  round((floor(epoch(last)) - floor(epoch(first))) / 60 + 1e-7, 4) AS USER_SESSION_DURATION,
  {_parts('last')}, CASE WHEN batch = 2 THEN '2024-02-02 00:00:00.000000'
    ELSE '2024-02-01 00:00:00.000000' END AS ETLUPDATEDDATETIME
FROM (SELECT USER_ID || '-' || EVENT_TYPE AS USER_SESSION, BATCHNUMBER AS batch,
        max(EVENT_TIME) AS last, min(EVENT_TIME) AS first,
        row_number() OVER (PARTITION BY USER_ID, EVENT_TYPE ORDER BY BATCHNUMBER DESC) AS pick
      FROM log GROUP BY USER_ID, EVENT_TYPE, BATCHNUMBER) WHERE pick = 1""",
    "session_batches": f"""
SELECT {_time("date_trunc('day', last)", 'DATE_KEY')}, USER_SESSION,
  {_time('last', 'MAX_EVENT_DATETIME')}, {_time('first', 'MIN_EVENT_DATETIME')},
  round((floor(epoch(last)) - floor(epoch(first))) / 60 + 1e-7, 4) AS USER_SESSION_DURATION, {_parts('last')}
FROM (SELECT USER_ID || '-' || EVENT_TYPE AS USER_SESSION, max(EVENT_TIME) AS last, min(EVENT_TIME) AS first
      FROM log GROUP BY USER_ID, EVENT_TYPE)""",
    "upsert_moving_partitions": """
SELECT USER_ID, count(*) AS N, CASE USER_ID::BIGINT % 4 WHEN 1 THEN 'y' WHEN 2 THEN 'x:1' ELSE 'a/b 100%' END AS "LABEL"
FROM log WHERE BATCHNUMBER = 2 AND USER_ID::BIGINT % 4 < 3 GROUP BY USER_ID
UNION ALL
SELECT USER_ID, count(*), CASE USER_ID::BIGINT % 4 WHEN 1 THEN 'x:1' WHEN 2 THEN 'a/b 100%' WHEN 3 THEN 'c=d' END
FROM log WHERE BATCHNUMBER = 1
  AND USER_ID NOT IN (SELECT USER_ID FROM log WHERE BATCHNUMBER = 2 AND USER_ID::BIGINT % 4 < 3) GROUP BY USER_ID""",
    "upsert_fact_partitions": f"""
SELECT {_parts('EVENT_TIME')}, CASE WHEN BATCHNUMBER = 2 THEN 'Europe' ELSE 'America' END
    AS SALES_BRANCH, count(*) AS N
FROM log WHERE NOT (EVENT_TYPE = 'purchase' AND PRICE <= 0) GROUP BY ALL""",
    "upsert_null_partitions": """
SELECT CASE WHEN event_id % 3 > 0 THEN strftime(EVENT_TIME, '%Y-%m-%d') END AS "DAY",
  CASE WHEN BATCHNUMBER = 2 THEN 'new' ELSE 'old' END AS STATE, count(*) AS N,
  CAST(sum(event_id) AS BIGINT) AS IDS
FROM log GROUP BY ALL""",
    "replace_by_year": f"""
SELECT COUNTRY, strftime(d, '%Y-%m-%d') AS "DATE",
  round(CASE WHEN year(d) >= 2000 THEN 2 ELSE 1 END * TARGET / n + 1e-7, 2) AS DAILYTARGET,
  CASE WHEN year(d) >= 2000 THEN '2024-02-02 00:00:00.000000'
    ELSE '2024-02-01 00:00:00.000000' END AS ETLUPDATEDDATETIME
FROM ({_DAYS.format('target')})""",
    "week_cycle": """
SELECT YEAR, WEEK_NUMBER_CYCLE, WEEK_NUMBER, count(*) AS N FROM sale_weeks GROUP BY ALL""",
    "weekly_sales": """
SELECT PRODUCT_ID, WEEK_NUMBER, DAYS_PURCHASED, round(AVG_PRICE + 1e-7, 4) AS AVG_PRICE,
  round(SALES + 1e-7, 4) AS SALES, PREVIOUS_WEEK_NUMBER FROM sale_weekly""",
    "previous_week_join": _demand_out(_demand("fact_weekly", "LEFT")),
    "previous_week_batches": _demand_out(_demand("fact_weekly", "LEFT")),
    "feature_matrix_batches": _features_out(),
    "weekly_demand": _demand_out("SELECT * FROM sale_demand"),
    "weekly_demand_undated": _demand_out(_demand("undated_weekly", "INNER")),
    "weekly_demand_by_cycle": _demand_out(
        _demand(
            "sale_weekly_cycle", "INNER",
            " AND b.WEEK_NUMBER_CYCLE = a.WEEK_NUMBER_CYCLE"
            " - CASE WHEN a.WEEK_NUMBER = 1 THEN 1 ELSE 0 END",
        ),
        cycle=True,
    ),
    "elasticity_simple": _elasticity("line", 2),
    "elasticity_controlled": _elasticity("plane", 4),
    "sales_features": _perspective_out("purchases", "purchase"),
    "view_features": _perspective_out("views", "view"),
    "cart_features": _perspective_out("carts", "cart"),
    "feature_matrix": _features_out(),
    "top_products": "SELECT * FROM top10",
    "top_product_features": _features_out()
    + " WHERE PRODUCT_ID IN (SELECT PRODUCT_ID FROM top10)",
    "time_split": """
SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER,
  CASE WHEN (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w THEN 'test' ELSE 'train' END AS SPLIT
FROM purchases, last_week WHERE (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w OR WEEK_NUMBER IN (1, 2, 3, 4)""",
    "time_split_recent": """
SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER,
  CASE WHEN age = 1 THEN 'test' ELSE 'train' END AS SPLIT
FROM (SELECT *, dense_rank() OVER (ORDER BY WEEK_NUMBER_CYCLE DESC, WEEK_NUMBER DESC) AS age
      FROM (SELECT DISTINCT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER FROM sale_weeks))
WHERE age <= 4""",
    "first_splits_xg": _first_splits(
        "XG",
        "SELECT f.* FROM features f, last_week WHERE (WEEK_NUMBER_CYCLE, WEEK_NUMBER) <> w AND WEEK_NUMBER IN (1, 2, 3, 4)",
        f"{_bits('fold42')} % 5",
        5,
        f"{_bits('holdout42')} % 5 = 0",
        "fold <> k",
    ),
    "first_splits_gb": _first_splits(
        "GB",
        """SELECT *, 5 - age AS stretch FROM (
    SELECT *, dense_rank() OVER (ORDER BY WEEK_NUMBER_CYCLE DESC, WEEK_NUMBER DESC) AS age FROM features)
  WHERE age BETWEEN 2 AND 5""",
        "stretch",
        3,
        "false",
        "fold <= k",
    ),
    "search_scores_xg": """
SELECT d::INTEGER AS DRAW, f::INTEGER AS FOLD, n > 0 AS JUDGED, n > 0 AS NO_WORSE
FROM range(20) a(d), range(5) b(f), (SELECT count(*) AS n FROM features)""",
    "rmse_of_previous_week": """
SELECT 'LAST' AS MODEL, round(sqrt(avg(pow(SALES_OCCURRENCE - SALES_OCC_PREV_1W, 2))), 4) AS RMSE
FROM features""",
    "forecast_xg_fixed": """
SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER, SALES_OCCURRENCE AS ACTUAL_SALES, true AS SALES_PREDICTION_XG
FROM purchases, last_week WHERE (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w""",
    "forecast_gb_fixed": """
SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER, SALES_OCCURRENCE AS ACTUAL_SALES, true AS SALES_PREDICTION_GB
FROM purchases, last_week WHERE (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w""",
    "forecast_rf_fixed": """
SELECT PRODUCT_ID, WEEK_NUMBER_CYCLE, WEEK_NUMBER, SALES_OCCURRENCE AS ACTUAL_SALES, true AS SALES_PREDICTION_RF
FROM purchases, last_week WHERE (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w""",
    "forecast_rmse_fixed": """
SELECT 2::BIGINT AS MODELS, count(*) > 0 AS BETTER FROM purchases""",
    "prediction_table_fixed": """
SELECT CAST(WEEK_NUMBER_CYCLE AS BIGINT) AS WEEK_NUMBER_CYCLE, CAST(WEEK_NUMBER AS BIGINT) AS WEEK_NUMBER,
  p.PRODUCT_ID, round(MEAN_PRICE + 1e-7, 4) AS MEAN_PRICE, SALES_OCCURRENCE AS ACTUAL_SALES,
  CAST(NULL AS BIGINT) AS SALES_PREDICTION_XG, CAST(NULL AS BIGINT) AS SALES_PREDICTION_GB,
  CASE WHEN test THEN true END AS SALES_PREDICTION_RF,
  CASE WHEN test THEN ELASTICITY END AS ELASTICITY, CASE WHEN test THEN R2_SCORE END AS LR_R2_SCORE,
  CASE WHEN test THEN COEFFICIENT_PVALUE END AS COEFFICIENT_PVALUE
FROM (SELECT *, (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w AS test FROM purchases, last_week) p
LEFT JOIN (""" + _elasticity("line", 2) + """) e ON e.PRODUCT_ID = p.PRODUCT_ID""",
    "prediction_table_history": """
SELECT CAST(WEEK_NUMBER_CYCLE AS BIGINT) AS WEEK_NUMBER_CYCLE, CAST(WEEK_NUMBER AS BIGINT) AS WEEK_NUMBER,
  p.PRODUCT_ID, round(MEAN_PRICE + 1e-7, 4) AS MEAN_PRICE, SALES_OCCURRENCE AS ACTUAL_SALES,
  CAST(CASE WHEN test THEN SALES_OCC_PREV_1W END AS BIGINT) AS SALES_PREDICTION_XG,
  CAST(CASE WHEN test THEN SALES_OCC_PREV_1W END AS BIGINT) AS SALES_PREDICTION_GB,
  CAST(CASE WHEN test THEN SALES_OCC_PREV_1W END AS BIGINT) AS SALES_PREDICTION_RF,
  CASE WHEN test THEN ELASTICITY END AS ELASTICITY, CASE WHEN test THEN R2_SCORE END AS LR_R2_SCORE,
  CASE WHEN test THEN COEFFICIENT_PVALUE END AS COEFFICIENT_PVALUE
FROM (SELECT *, (WEEK_NUMBER_CYCLE, WEEK_NUMBER) = w AS test FROM purchases, last_week) p
LEFT JOIN (""" + _elasticity("line", 2) + ") e ON e.PRODUCT_ID = p.PRODUCT_ID",
    "ledger_latest_batch": """
SELECT coalesce(max(batchID), 0) AS batchID FROM ledger WHERE item = 'cur_dim_product'""",
    "ledger_next_batch": """
SELECT CASE WHEN a >= b THEN a + 1 ELSE b END AS batchID
FROM (SELECT coalesce(max(batchID) FILTER (item = 'cur_dim_product'), 0) AS a,
        coalesce(max(batchID) FILTER (item = 'Start'), 0) AS b FROM ledger)""",
    "ledger_next_batches": """
SELECT item, CASE WHEN max(batchID) >= b THEN max(batchID) + 1 ELSE b END AS batchID
FROM ledger, (SELECT max(batchID) AS b FROM ledger WHERE item = 'Start') GROUP BY item, b""",
    "ledger_gate": """
SELECT bool_and(status = 'complete') AS passed
FROM (SELECT item, arg_max(status, batchID) AS status FROM ledger
      WHERE item IN ('hist_behaviour_log', 'cur_dim_product') GROUP BY item)""",
    "ledger_latest_status": """
SELECT item, max(batchID) AS batchID, arg_max(status, batchID) AS status FROM ledger GROUP BY item""",
    "ledger_complete": """
SELECT batchID, "date", startTime, item, CASE WHEN item = 'cur_dim_product'
  AND batchID = (SELECT max(batchID) FROM ledger) THEN 'complete' ELSE status END AS status
FROM ledger""",
    "ledger_close": """
SELECT batchID, "date", startTime, item, CASE WHEN item = 'Start' AND batchID = b
    AND NOT EXISTS (SELECT 1 FROM ledger r WHERE r.batchID = b AND r.item <> 'Start'
                    AND r.status = 'running') THEN 'complete' ELSE status END AS status
FROM ledger, (SELECT max(batchID) AS b FROM ledger WHERE item = 'Start')""",
    "ledger_success_watermark": """
SELECT source, replace(coalesce(CASE WHEN startTime >= endTime THEN endTime END, startTime), ' ', 'T')
    || '.00Z' AS endTime, batchID
FROM (SELECT source, min(startTime) AS startTime, min(batchID) AS batchID
      FROM (SELECT CASE WHEN item = 'cur_dim_date' THEN 'self' WHEN item = 'cur_fact_target'
                THEN 'sales_target' ELSE 'behaviour_log' END AS source,
              max(startTime) AS startTime, max(batchID) AS batchID
            FROM ledger WHERE status = 'complete' AND starts_with(item, 'cur_') GROUP BY item)
      GROUP BY source)
LEFT JOIN (SELECT item AS source, max(endTime) AS endTime FROM copies
           WHERE status = 'complete' GROUP BY item) USING (source)""",
    "ledger_batch_summary": """
SELECT batchID, "date", startTime, item, status FROM ledger
WHERE batchID = (SELECT max(batchID) FROM ledger) ORDER BY startTime""",
    "new_data_guard": """
SELECT (SELECT max(BATCHNUMBER) FROM log) >= (SELECT max(batchID) FROM ledger) AS has_new_data""",
    "json_roundtrip": "SELECT EVENT_TYPE AS event_type, BRAND AS brand, count(*) AS n FROM log GROUP BY ALL",
    "source_audit": """
SELECT '7' AS batchID, '20240201' AS "date", '2024-02-01 00:00:00' AS startTime,
  'hist_behaviour_log' AS notebook, CAST(count(*) AS VARCHAR) AS "count", 'events' AS file, 'Y' AS exist
FROM events
UNION ALL SELECT '7', '20240201', '2024-02-01 00:00:00', 'hist_behaviour_log', 'N/A', 'no_such_table', 'N'""",
    "landing_folders": """
SELECT '7' AS batchID, '20240201' AS "date", '2024-02-01 00:00:00' AS startTime,
  'hist_behaviour_log' AS notebook, CAST(count(*) AS VARCHAR) AS "count", 'full' AS file, 'Y' AS exist
FROM events
UNION ALL SELECT '7', '20240201', '2024-02-01 00:00:00', 'hist_behaviour_log', 'N/A', 'empty', 'N'
UNION ALL SELECT '7', '20240201', '2024-02-01 00:00:00', 'hist_behaviour_log', 'N/A', 'missing', 'N'""",
    "catalog_tables": """
SELECT 'audit' AS NAME, 2 * count(*) AS N FROM log
UNION ALL SELECT 'overwritten', count(*) FILTER (BATCHNUMBER = 2) FROM log
UNION ALL SELECT 'quarantine', count(*) FILTER (USER_ID IS NULL) FROM dirty
UNION ALL SELECT 'empty', 0 FROM log WHERE event_id = 0
UNION ALL SELECT 'created', 1 FROM log WHERE event_id = 0""",
    "malformed_csv": _MALFORMED,
    "malformed_json": _MALFORMED,
    "landing_once": f"""
SELECT {_parts('EVENT_TIME')}, BATCHNUMBER, EVENT_TYPE, count(*) AS N FROM log GROUP BY ALL""",
    "runs_with_copy": """
SELECT r.item, r.batchID, r.startTime, r.source, c.endTime
FROM (SELECT item, batchID, startTime, CASE WHEN item = 'cur_dim_date' THEN 'self'
          WHEN item IN ('hist_sales_target', 'cur_fact_target') THEN 'sales_target' ELSE 'behaviour_log' END AS source
      FROM ledger WHERE status = 'complete' AND item <> 'Start') r
ASOF LEFT JOIN (SELECT * FROM copies WHERE status = 'complete') c ON r.source = c.item AND r.startTime >= c.endTime""",
    "event_before_purchase": f"""
SELECT p.event_id, p.USER_ID, {_time('p.EVENT_TIME', 'EVENT_TIME')}, {_time('v.EVENT_TIME', 'VIEWED_AT')}, v.event_id AS VIEW_ID
FROM log p ASOF LEFT JOIN (SELECT USER_ID, EVENT_TIME, max(event_id) AS event_id FROM log
    WHERE EVENT_TYPE = 'view' GROUP BY ALL) v
  ON p.USER_ID = v.USER_ID AND p.EVENT_TIME >= v.EVENT_TIME
WHERE p.EVENT_TYPE = 'purchase'""",
    "log_files": "SELECT item, count(*) AS n, max(endTime) AS endTime FROM copies GROUP BY item",
    "partitioned_append": f"""
SELECT {_parts('EVENT_TIME')}, b.BATCHNUMBER, count(*) AS N
FROM log, (VALUES (1), (2)) b(BATCHNUMBER) GROUP BY ALL""",
    "parsed_times": f"""
SELECT event_id, {_time("date_trunc('second', EVENT_TIME)", 'DAY_FIRST')},
  {_time('EVENT_TIME', 'MICROS')}, CAST(NULL AS VARCHAR) AS NO_TIME FROM log""",
    "latest_event_per_user": f"""
SELECT USER_ID, event_id, {_time('EVENT_TIME')}, EVENT_TYPE, round(PRICE, 4) AS PRICE
FROM (SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY EVENT_TIME DESC, event_id) AS pick
      FROM log) WHERE pick = 1""",
}
SQL: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
