"""DuckDB SQL for the fixture views, used by the oracle strings in the catalog.

These mirror :mod:`tonetide.sources.fixtures` one for one; each constant is a
comma-separated list of CTE definitions to put after ``WITH``.
"""

CAT = """
cat AS (
  SELECT s.s_suppkey AS Stock, r.r_name AS Category
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

BARS = CAT + """,
bars AS (
  SELECT d.Date, d.Stock, c.Category, d.Open, d.High, d.Low, d.Close, d.Volume, d.VWAP
  FROM (SELECT CAST(l_shipdate AS DATE) AS Date, l_suppkey AS Stock,
               arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS Open,
               max(l_extendedprice) AS High,
               min(l_extendedprice) AS Low,
               arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS Close,
               sum(l_quantity) AS Volume,
               sum(l_extendedprice * l_quantity) / sum(l_quantity) AS VWAP
        FROM lineitem GROUP BY 1, 2) d
  LEFT JOIN cat c ON d.Stock = c.Stock)"""

TICKS = CAT + """,
ticks AS (
  SELECT CAST(l_shipdate AS DATE) AS Date, l_suppkey AS Stock, c.Category,
         l_extendedprice AS Price, l_quantity AS Quantity, l_orderkey, l_linenumber
  FROM lineitem LEFT JOIN cat c ON l_suppkey = c.Stock)"""

NEWS = """
news AS (
  SELECT d.doc_id,
         CASE WHEN d.doc_id % 50 = 0 THEN 'n/a'
              ELSE strftime(DATE '1998-01-01' + CAST(d.doc_id % 366 AS INTEGER), '%Y-%m-%d') END AS date,
         array_to_string(list_transform(string_split(r.r_name, ' '),
             lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS category,
         d.source,
         split_part(d.text, chr(10), 1) AS headline,
         substring(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS short_description
  FROM documents d
  LEFT JOIN region r
    ON r.r_regionkey = CAST(regexp_extract(d.source, '(\\d+)$', 1) AS INTEGER) % 5)"""

EVENTS = """
events_in AS (
  SELECT event_id,
         CAST(strftime(CAST(ts AS DATE) - INTERVAL 312 MONTH, '%Y%m%d') AS INTEGER) AS Day,
         CAST(strftime(CAST(ts AS DATE) - INTERVAL 312 MONTH, '%Y%m%d') AS INTEGER) AS DATEADDED,
         value - 50.0 AS AvgTone,
         event_type AS CAMEOCodeDescription,
         'u/' || CAST(user_id AS VARCHAR) || '/' || json_extract_string(props, '$.k') AS SOURCEURL,
         CASE WHEN user_id % 2 = 0 THEN 'US' ELSE 'FR' END AS ActionGeo_CountryCode
  FROM events)"""


def r4(expr: str, digits: int = 4) -> str:
    """SQL side of :func:`tonetide.functions.scalar.stable_round`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def sig(expr: str, digits: int = 9) -> str:
    """SQL side of :func:`tonetide.functions.scalar.sig_round`."""
    x = f"({expr})"
    n = f"({digits - 1} - floor(log10(abs({x}))))"
    scaled = f"CASE WHEN {n} >= 0 THEN {x} * pow(10.0, {n}) ELSE {x} / pow(10.0, -{n}) END"
    k = f"CAST(round(CAST({scaled} AS DECIMAL(38,4)), 0) AS DOUBLE)"
    res = f"CASE WHEN {n} >= 0 THEN {k} / pow(10.0, {n}) ELSE {k} * pow(10.0, -{n}) END"
    return f"CASE WHEN {x} = 0 OR {x} IS NULL OR isnan({x}) THEN {x} ELSE {res} END"
