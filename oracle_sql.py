"""DuckDB oracle SQL for every registered query (``oracle_sql()`` in ``__spark_entry__``).

Written independently of the Spark code from the same specification: feeds derived from the test
tables, typing, benchmarks, upserts (surrogate keys via ``row_number``), the star and the reports.
Averages of decimal(10,3) values are rebuilt in exact integer arithmetic so they round exactly like
Spark's ``avg`` (to 7 decimals, then to 3 where cast).
"""

from __future__ import annotations

# --- fixed test parameters (same values as qualmart.catalog / qualmart.sources.fixtures) --------
REGION_STATE = "af"
REGION_COUNTIES = ("nation_0", "nation_5", "nation_10")
CAL_START, CAL_END = "1994-01-01", "2002-12-31"
DEFAULT_START, DEFAULT_END = "2015-01-01", "2030-01-01"
POINT_FACILITY = "supplier#000000007"
REPORT_MEASURE = "2-HIGH"      # the registered queries ask for "2-High"
SPLIT_DATE = "1999-01-01"
BETTER = ("better than the national benchmark", "better than the national rate",
          "better than the national value")
WORSE = ("worse than the national benchmark", "worse than the national rate",
         "worse than the national value")
SAME = ("no different than the national benchmark", "no different than the national rate",
        "no different than the national value")
# crosstab columns at the checked scale: every part brand and order priority of the test tables
CROSSTAB_MEMBERS = sorted([f"Outcome Brand#{i}" for i in range(1, 26)]
                          + ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
TODAY = "1999-07-01"
YEARS = (1995, 1996)
DAYS = ("sunday, march 5, 1995", "monday, march 4, 1996")
COMPARED = ("d.FacilityName", "d.FacilityCountyName", "d.FacilityCity", "f.MeasureName", "f.MeasureSortOrderName")
COUNTED = ("FacilityCity", "FacilityCountyName", "FacilityState", "FacilityZipCode")
# attributes that reports total, and whether they are texts
TOTALLED = {
    "FacilityID": False, "FacilityName": True, "FacilityAddress": True, "FacilityCity": True, "FacilityState": True,
    "FacilityZipCode": True, "FacilityCountyName": True, "FacilityPhoneNumber": True, "FacilityFullAddress": True,
    "Date": False, "DayOfMonth": False, "MonthNumber": False, "MonthName": True, "Year": False,
    "DayOfWeekName": True, "DayOfWeekNumber": False, "IsWeekend": False, "MonthDescription": True,
    "DayOfWeekDescription": True, "DayLongDescription": True, "IsWeekendLabel": True, "MeasureName": True,
    "MeasureSortOrderName": True, "MeasureTypeName": True, "ScoreComparedToNational": True, "DaysRecorded": False}
# labels of the two test feeds: better, worse, no different
FEED_LABELS = {
    "a": ("Better Than the National Rate", "Worse Than the National Rate", "No Different Than the National Rate"),
    "b": ("Better than the National Benchmark", "Worse than the National Benchmark",
          "No Different than the National Benchmark")}
LAYERS = ("landing", "us", "wi", "star")
# ---------------------------------------------------------------------------------------------------


def ck(x: str) -> str:
    return f"lower(rtrim({x}))"


def lst(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def q7(x: str) -> str:
    """round-half-up(sum/count, 7 decimals) as a scaled integer (x is decimal(10,3))."""
    s = f"CAST(sum({x}) * 1000 AS HUGEINT)"
    n = f"count({x})"
    return f"(sign({s}) * ((abs({s}) * 20000 + {n}) // (2 * {n})))"


def avg7(x: str) -> str:
    return f"(CAST({q7(x)} AS DECIMAL(18,0)) * 0.0000001)"


def avg3_of_q7(q: str) -> str:
    return f"CAST(CAST(sign({q}) * ((abs({q}) + 5000) // 10000) AS DECIMAL(18,0)) * 0.001 AS DECIMAL(10,3))"


def avg3(x: str) -> str:
    return avg3_of_q7(q7(x))


def avg7_dec(x: str) -> str:
    return f"CAST({avg7(x)} AS DECIMAL(14,7))"


def dec(col: str, sentinels, mode: str = "strict") -> str:
    cast = "TRY_CAST" if mode == "lenient" else "CAST"
    return (f"CASE WHEN {ck(col)} IN ({lst(sentinels)}) THEN NULL "
            f"ELSE {cast}({col} AS DECIMAL(10,3)) END")


def fdate(col: str, lenient: bool = False) -> str:
    fn = "try_strptime" if lenient else "strptime"
    return f"CAST({fn}({col}, '%m/%d/%Y') AS DATE)"


NA = ("not available",)
BOTH = ("not available", "--")
REGION_PRED = f"{ck('State')} = '{REGION_STATE}' AND {ck('CountyName')} IN ({lst(REGION_COUNTIES)})"

FEED_COLS_A = ["FacilityID", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
               "PhoneNumber", "MeasureID", "MeasureName", "ComparedToNational", "Denominator",
               "Score", "LowerEstimate", "HigherEstimate", "Footnote", "StartDate", "EndDate"]
FEED_COLS_B = [c for c in FEED_COLS_A if c not in ("Denominator", "LowerEstimate",
                                                    "HigherEstimate")]
TYPED = ["FacilityCode", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
         "PhoneNumber", "MeasureCode", "MeasureName", "MeasureTypeID", "ComparedToNational",
         "Denominator", "Score", "LowerEstimate", "HigherEstimate", "Footnote", "StartDate",
         "EndDate", "StatScore"]
FAC_COLS = ["FacilityCode", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
            "PhoneNumber"]
FM_VALUES = ["ComparedToNational", "Denominator", "Score", "LowerEstimate", "HigherEstimate",
             "Footnote", "StartDate", "EndDate"]


# ------------------------------------------------------------------------------------ feeds
def money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(10,2)) AS VARCHAR)"


FEEDS = f"""
fac AS (
  SELECT s.s_suppkey AS fac_key, CAST(s.s_suppkey AS VARCHAR) AS FacilityID,
         s.s_name AS FacilityName, 'Dock ' || CAST(s.s_suppkey AS VARCHAR) AS Address,
         CASE WHEN s.s_suppkey % 4 = 2 THEN n.n_name || ' ' ELSE n.n_name END AS City,
         substr(r.r_name, 1, 2) AS State,
         lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS ZipCode,
         CASE WHEN s.s_suppkey % 3 = 1 THEN upper(substr(n.n_name, 1, 1)) || lower(substr(n.n_name, 2))
              ELSE n.n_name END AS CountyName,
         CAST(NULL AS VARCHAR) AS PhoneNumber
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey),
feed_a AS (
  SELECT f.FacilityID, f.FacilityName, f.Address, f.City, f.State, f.ZipCode, f.CountyName,
         f.PhoneNumber,
         'A_' || regexp_extract(p.p_brand, '(\\d+)', 1) AS MeasureID,
         'Outcome ' || p.p_brand AS MeasureName,
         CASE WHEN l.l_returnflag = 'A' THEN 'Better Than the National Rate'
              WHEN l.l_returnflag = 'R' THEN 'Worse Than the National Rate'
              WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Not Available'
              WHEN l.l_returnflag = 'N' THEN 'No Different Than the National Rate' END
           AS ComparedToNational,
         CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Not Available'
              ELSE {money('l.l_quantity')} END AS Denominator,
         CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Not Available'
              ELSE {money('l.l_extendedprice')} END AS Score,
         CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Not Available'
              ELSE {money('l.l_discount')} END AS LowerEstimate,
         CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Not Available'
              ELSE {money('l.l_tax')} END AS HigherEstimate,
         CASE WHEN l.l_linenumber = 7 THEN '1, 2' END AS Footnote,
         strftime(CAST(l.l_shipdate AS DATE) - 90, '%m/%d/%Y') AS StartDate,
         strftime(CAST(l.l_shipdate AS DATE), '%m/%d/%Y') AS EndDate
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN fac f ON l.l_suppkey = f.fac_key),
feed_b AS (
  SELECT f.FacilityID, f.FacilityName, f.Address, f.City, f.State, f.ZipCode, f.CountyName,
         f.PhoneNumber,
         'B_' || substr(o.o_orderpriority, 1, 1) AS MeasureID,
         o.o_orderpriority AS MeasureName,
         CASE o.o_orderstatus WHEN 'F' THEN 'Better than the National Benchmark'
                              WHEN 'O' THEN 'Worse than the National Benchmark'
                              WHEN 'P' THEN 'No Different than the National Benchmark' END
           AS ComparedToNational,
         CASE WHEN o.o_orderkey % 11 = 0 THEN '--'
              WHEN o.o_orderkey % 13 = 0 THEN 'Not Available'
              ELSE {money('o.o_totalprice')} END AS Score,
         CAST(NULL AS VARCHAR) AS Footnote,
         strftime(CAST(o.o_orderdate AS DATE), '%m/%d/%Y') AS StartDate,
         strftime(CAST(o.o_orderdate AS DATE) + 90, '%m/%d/%Y') AS EndDate
  FROM orders o JOIN fac f ON o.o_custkey % (SELECT count(*) FROM supplier) = f.fac_key)"""


def typed_sql(name: str, src: str, kind: str) -> str:
    outcomes = kind == "a"
    row_sent = NA if outcomes else BOTH

    def num(c):
        return dec(c, NA) if outcomes else "CAST(NULL AS DECIMAL(10,3))"

    return f"""
{name} AS (
  SELECT FacilityID AS FacilityCode, FacilityName, Address, City, State, ZipCode, CountyName,
         PhoneNumber, MeasureID AS MeasureCode, MeasureName,
         CAST({1 if outcomes else 2} AS SMALLINT) AS MeasureTypeID,
         CASE WHEN {ck('ComparedToNational')} IN ({lst(NA)}) THEN NULL
              ELSE ComparedToNational END AS ComparedToNational,
         {num('Denominator')} AS Denominator,
         {dec('Score', row_sent)} AS Score,
         {num('LowerEstimate')} AS LowerEstimate,
         {num('HigherEstimate')} AS HigherEstimate,
         Footnote, {fdate('StartDate')} AS StartDate, {fdate('EndDate')} AS EndDate,
         {dec('Score', BOTH)} AS StatScore
  FROM {src})"""


def grain_sql(name: str, src: str, kind: str) -> str:
    """One feed row per (facility, measure), aggregated from all its rows."""
    cols = FEED_COLS_A if kind == "a" else FEED_COLS_B
    better, worse, same = FEED_LABELS[kind]
    b, w, n = (f"count_if(ComparedToNational = '{x}')" for x in (better, worse, same))

    def num(c):
        return dec(c, BOTH, "lenient")

    def text(x):
        return f"coalesce(CAST(CAST({x} AS DECIMAL(10,2)) AS VARCHAR), 'Not Available')"

    q = q7("num_score")
    made = {
        "ComparedToNational": f"CASE WHEN {b} + {w} + {n} = 0 THEN 'Not Available' WHEN {b} >= {w} AND {b} >= {n} "
                              f"THEN '{better}' WHEN {w} >= {n} THEN '{worse}' ELSE '{same}' END",
        "Score": text(f"CAST(sign({q}) * ((abs({q}) + 50000) // 100000) AS DECIMAL(18,0)) * 0.01"),
        "Footnote": "CASE WHEN count(Footnote) > 0 THEN '1, 2' END",
        "StartDate": f"strftime(min({fdate('StartDate', True)}), '%m/%d/%Y')",
        "EndDate": f"strftime(max({fdate('EndDate', True)}), '%m/%d/%Y')",
        "Denominator": "CAST(count(*) AS VARCHAR)",
        "LowerEstimate": text(f"min({num('LowerEstimate')})"),
        "HigherEstimate": text(f"max({num('HigherEstimate')})"),
    }
    keys = [c for c in cols if c not in made]
    return f"""
{name} AS (
  SELECT {', '.join(f'{made[c]} AS {c}' if c in made else c for c in cols)}
  FROM (SELECT *, {num('Score')} AS num_score FROM {src}) GROUP BY {', '.join(keys)})"""


def split_sql(name_old: str, name_new: str, src: str) -> str:
    end = fdate("EndDate", True)
    return f"""
{name_old}_raw AS (SELECT * FROM {src} WHERE {end} < DATE '{SPLIT_DATE}'
                      AND upper(rtrim(CountyName)) <> 'NATION_10'),
{name_new}_raw AS (SELECT * FROM {src} WHERE {end} >= DATE '{SPLIT_DATE}'
                      AND upper(rtrim(CountyName)) <> 'NATION_5')"""


def ci_distinct_sql(src: str, cols, text) -> str:
    sel = ", ".join(cols)
    grp = ", ".join(ck(c) if c in text else c for c in cols)
    order = ", ".join(c for c in cols if c in text)
    return (f"SELECT {sel} FROM (SELECT DISTINCT {sel} FROM ({src})) "
            f"QUALIFY row_number() OVER (PARTITION BY {grp} ORDER BY {order}) = 1")


# ------------------------------------------------------------------------------------ benchmarks
def bench_sql(p: str, ta: str, kind_id: int) -> str:
    """CTEs {p}_stats (by code+name), {p}_us (by code), {p}_ca, {p}_dir, {p}_mea, {p}_rmea."""
    cls = (f"CASE WHEN {ck('ComparedToNational')} IN ({lst(BETTER)}) THEN 'better' "
           f"WHEN {ck('ComparedToNational')} IN ({lst(WORSE)}) THEN 'worse' "
           f"WHEN {ck('ComparedToNational')} IN ({lst(SAME)}) THEN 'no_different' END")
    dirx = ("CASE WHEN b IS NOT NULL AND w IS NOT NULL THEN (CASE WHEN b > w THEN 0 ELSE 1 END) "
            "WHEN b IS NULL THEN (CASE WHEN n > w THEN 0 ELSE 1 END) "
            "WHEN w IS NULL THEN (CASE WHEN b > n THEN 0 ELSE 1 END) ELSE 2 END")
    return f"""
{p}_stats AS (
  SELECT {ck('MeasureCode')} AS code_key, {ck('MeasureName')} AS name_key,
         min(MeasureCode) AS MeasureCode, min(MeasureName) AS MeasureName,
         max(StatScore) AS NationalScoreMax, min(StatScore) AS NationalScoreMin,
         {avg3('StatScore')} AS NationalScoreAverage
  FROM {ta} GROUP BY 1, 2),
{p}_us AS (
  SELECT {ck('MeasureCode')} AS code_key, min(MeasureCode) AS MeasureCode,
         max(StatScore) AS NationalScoreMax, min(StatScore) AS NationalScoreMin,
         {avg3('StatScore')} AS NationalScoreAverage
  FROM {ta} GROUP BY 1),
{p}_ca AS (
  SELECT {ck('MeasureName')} AS name_key, {ck('ComparedToNational')} AS label_key,
         min(MeasureName) AS MeasureName, min(ComparedToNational) AS ComparedToNational,
         min({cls}) AS label_class, {avg7_dec('StatScore')} AS average_score
  FROM {ta} WHERE {cls} IS NOT NULL GROUP BY 1, 2),
{p}_names AS (SELECT {ck('MeasureName')} AS name_key, min(MeasureName) AS MeasureName
              FROM {ta} GROUP BY 1),
{p}_dir AS (
  SELECT DISTINCT name_key, MeasureName, b AS AverageScoreBetter, w AS AverageScoreWorse,
         n AS AverageScoreNoDifferent, CAST({dirx} AS SMALLINT) AS SortOrderID
  FROM (SELECT nm.name_key, nm.MeasureName, cb.average_score AS b, cw.average_score AS w,
               cn.average_score AS n
        FROM {p}_names nm
        LEFT JOIN (SELECT * FROM {p}_ca WHERE label_class = 'better') cb USING (name_key)
        LEFT JOIN (SELECT * FROM {p}_ca WHERE label_class = 'worse') cw USING (name_key)
        LEFT JOIN (SELECT * FROM {p}_ca WHERE label_class = 'no_different') cn USING (name_key))),
{p}_mea AS (
  SELECT s.MeasureCode, s.MeasureName, CAST({kind_id} AS SMALLINT) AS MeasureTypeID,
         d.SortOrderID, s.NationalScoreMax, s.NationalScoreMin, s.NationalScoreAverage
  FROM {p}_stats s LEFT JOIN (SELECT DISTINCT name_key, SortOrderID FROM {p}_dir) d USING (name_key)),
{p}_rmea AS (
  SELECT DISTINCT r.MeasureCode, r.MeasureName, CAST({kind_id} AS SMALLINT) AS MeasureTypeID,
         d.SortOrderID, u.NationalScoreMax, u.NationalScoreMin, u.NationalScoreAverage
  FROM (SELECT {ck('MeasureCode')} AS code_key, {ck('MeasureName')} AS name_key,
               min(MeasureCode) AS MeasureCode, min(MeasureName) AS MeasureName
        FROM {ta} WHERE {REGION_PRED} GROUP BY 1, 2) r
  LEFT JOIN (SELECT code_key, NationalScoreMax, NationalScoreMin, NationalScoreAverage
             FROM {p}_us) u USING (code_key)
  LEFT JOIN (SELECT DISTINCT name_key, SortOrderID FROM {p}_dir) d USING (name_key))"""


# ------------------------------------------------------------------------------------- upsert
def upsert_sql(name: str, prev: str | None, src: str, on, mapping: dict, update: set,
               key: str, key_type: str, order, types: dict) -> str:
    """MERGE as SQL: mapping = target col → source col (all non-key target cols, in order);
    update = target cols refreshed on match; on = (target col, source col, is_text)."""
    cols = list(mapping)
    ordx = ", ".join(f"s.{mapping[c]} ASC NULLS FIRST" for c in order)

    def cond(t, s):
        return " AND ".join(f"{ck(t + '.' + a)} = {ck(s + '.' + b)}" if txt
                            else f"{t}.{a} = {s}.{b}" for a, b, txt in on)

    ins_cols = ", ".join(f"CAST(s.{mapping[c]} AS {types[c]}) AS {c}" for c in cols)
    if prev is None:
        return f"""
{name} AS (
  SELECT CAST(row_number() OVER (ORDER BY {ordx}) AS {key_type}) AS {key}, {ins_cols}
  FROM {src} s)"""
    kept_cols = ", ".join(
        (f"CAST(CASE WHEN s._hit THEN s.{mapping[c]} ELSE t.{c} END AS {types[c]}) AS {c}"
         if c in update else f"t.{c}") for c in cols)
    return f"""
{name} AS (
  SELECT t.{key}, {kept_cols}
  FROM {prev} t LEFT JOIN (SELECT *, true AS _hit FROM {src}) s ON {cond('t', 's')}
  UNION ALL
  SELECT CAST((SELECT coalesce(max({key}), 0) FROM {prev}) + row_number() OVER (ORDER BY {ordx})
              AS {key_type}) AS {key}, {ins_cols}
  FROM {src} s WHERE NOT EXISTS (SELECT 1 FROM {prev} t WHERE {cond('t', 's')}))"""


T_FAC = {"FacilityCode": "VARCHAR", "FacilityName": "VARCHAR", "Address": "VARCHAR",
         "City": "VARCHAR", "State": "VARCHAR", "ZipCode": "VARCHAR", "CountyName": "VARCHAR",
         "PhoneNumber": "VARCHAR"}
T_MEA = {"MeasureCode": "VARCHAR", "MeasureName": "VARCHAR", "MeasureTypeID": "SMALLINT",
         "SortOrderID": "SMALLINT", "NationalScoreMax": "DECIMAL(10,3)",
         "NationalScoreMin": "DECIMAL(10,3)", "NationalScoreAverage": "DECIMAL(10,3)"}
T_FM = {"FacilityID": "BIGINT", "MeasureID": "SMALLINT", "ComparedToNational": "VARCHAR",
        "Denominator": "DECIMAL(10,3)", "Score": "DECIMAL(10,3)",
        "LowerEstimate": "DECIMAL(10,3)", "HigherEstimate": "DECIMAL(10,3)",
        "Footnote": "VARCHAR", "StartDate": "DATE", "EndDate": "DATE"}
T_DIM = {"FacilityID": "BIGINT", "FacilityName": "VARCHAR", "FacilityAddress": "VARCHAR",
         "FacilityCity": "VARCHAR", "FacilityState": "VARCHAR", "FacilityZipCode": "VARCHAR",
         "FacilityCountyName": "VARCHAR", "FacilityPhoneNumber": "VARCHAR"}
T_FACT = {"MeasureID": "SMALLINT", "FacilityKey": "BIGINT", "FacilityID": "BIGINT",
          "FacilityMeasureID": "BIGINT", "MeasureName": "VARCHAR",
          "ScoreComparedToNational": "VARCHAR", "Score": "DECIMAL(10,3)",
          "NationalScoreHigh": "DECIMAL(10,3)", "NationalScoreLow": "DECIMAL(10,3)",
          "NationalScoreAverage": "DECIMAL(10,3)", "MeasureSortOrderName": "VARCHAR",
          "MeasureSortOrderNumber": "SMALLINT", "MeasureTypeName": "VARCHAR",
          "StartDate": "DATE", "EndDate": "DATE", "StartDateKey": "INTEGER",
          "EndDateKey": "INTEGER"}


def dim_date_sql(name: str, start: str, end: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS Date,
         CAST(day(d) AS SMALLINT) AS DayOfMonth, CAST(month(d) AS SMALLINT) AS MonthNumber,
         strftime(d, '%B') AS MonthName, CAST(year(d) AS SMALLINT) AS Year,
         strftime(d, '%A') AS DayOfWeekName, CAST(dayofweek(d) + 1 AS SMALLINT) AS DayOfWeekNumber,
         (dayofweek(d) + 1) IN (1, 7) AS IsWeekend
  FROM (SELECT DATE '1900-01-01' AS d UNION ALL SELECT DATE '9999-01-01'
        UNION ALL
        SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY)) AS DATE)))"""


def run_sql(p: str, ta: str, tb: str, prev: str | None) -> str:
    """One refresh: CTEs {p}us_fac, {p}us_mea, {p}us_fm, {p}wi_fac, {p}wi_mea, {p}wi_fm,
    {p}dim_fac, {p}fact (prev = prefix of the previous run or None)."""
    pv = (lambda n: f"{prev}{n}") if prev else (lambda n: None)
    fac_text = set(FAC_COLS)
    fac_on = [("FacilityName", "FacilityName", True)]
    fac_map = {c: c for c in FAC_COLS}
    fac_order = ["FacilityName", "FacilityCode", "Address", "City", "State", "ZipCode",
                 "CountyName", "PhoneNumber"]
    fac_upd = set(FAC_COLS) - {"FacilityName"}
    mea_cols = list(T_MEA)
    mea_on = [("MeasureName", "MeasureName", True)]
    mea_order = ["MeasureCode", "MeasureName", "MeasureTypeID", "SortOrderID"]
    fm_on = [("MeasureID", "MeasureID", False), ("FacilityID", "FacilityID", False)]
    fm_order = ["FacilityID", "MeasureID", "StartDate", "EndDate", "ComparedToNational",
                "Denominator", "Score", "LowerEstimate", "HigherEstimate", "Footnote"]
    fm_cols = ["FacilityID", "MeasureID"] + FM_VALUES
    fm_text = {"ComparedToNational", "Footnote"}
    ctes = []

    def fac_src(where):
        w = f" WHERE {where}" if where else ""
        u = (f"SELECT {', '.join(FAC_COLS)} FROM {ta}{w} UNION ALL "
             f"SELECT {', '.join(FAC_COLS)} FROM {tb}{w}")
        return ci_distinct_sql(u, FAC_COLS, fac_text)

    def fm_src(fac, mea, where):
        w = f" WHERE {where}" if where else ""
        parts = []
        for t in (ta, tb):
            parts.append(
                f"SELECT f.FacilityID, m.MeasureID, {', '.join('x.' + c for c in FM_VALUES)} "
                f"FROM (SELECT * FROM {t}{w}) x "
                f"JOIN {fac} f ON {ck('x.FacilityCode')} = {ck('f.FacilityCode')} "
                f"JOIN {mea} m ON {ck('x.MeasureCode')} = {ck('m.MeasureCode')}")
        return ci_distinct_sql(" UNION ALL ".join(parts), fm_cols, fm_text)

    for layer, where in (("us_", None), ("wi_", REGION_PRED)):
        ctes.append(f"{p}{layer}fac_src AS ({fac_src(where)})")
        ctes.append(upsert_sql(f"{p}{layer}fac", pv(f"{layer}fac"), f"{p}{layer}fac_src", fac_on,
                               fac_map, fac_upd, "FacilityID", "BIGINT", fac_order, T_FAC))
        m = "mea" if layer == "us_" else "rmea"
        msrc = (f"SELECT * FROM {p}a_{m} UNION ALL SELECT * FROM {p}b_{m}")
        ctes.append(f"{p}{layer}mea_src AS ({ci_distinct_sql(msrc, mea_cols, {'MeasureCode', 'MeasureName'})})")
        ctes.append(upsert_sql(f"{p}{layer}mea", pv(f"{layer}mea"), f"{p}{layer}mea_src", mea_on,
                               {c: c for c in mea_cols}, set(mea_cols) - {"MeasureName"},
                               "MeasureID", "SMALLINT", mea_order, T_MEA))
        ctes.append(f"{p}{layer}fm_src AS ({fm_src(f'{p}{layer}fac', f'{p}{layer}mea', where)})")
        ctes.append(upsert_sql(f"{p}{layer}fm", pv(f"{layer}fm"), f"{p}{layer}fm_src", fm_on,
                               {c: c for c in fm_cols}, set(FM_VALUES), "FacilityMeasureID",
                               "BIGINT", fm_order, T_FM))
    dim_map = {"FacilityID": "FacilityID", "FacilityName": "FacilityName",
               "FacilityAddress": "Address", "FacilityCity": "City", "FacilityState": "State",
               "FacilityZipCode": "ZipCode", "FacilityCountyName": "CountyName",
               "FacilityPhoneNumber": "PhoneNumber"}
    ctes.append(upsert_sql(f"{p}dim_fac", pv("dim_fac"), f"{p}wi_fac",
                           [("FacilityName", "FacilityName", True)], dim_map,
                           set(dim_map) - {"FacilityName"}, "FacilityKey", "BIGINT",
                           ["FacilityName", "FacilityID"], T_DIM))
    ctes.append(f"""{p}fact_src AS (
  SELECT fm.FacilityMeasureID, fm.MeasureID, df.FacilityKey, fm.FacilityID, m.MeasureName,
         fm.ComparedToNational, fm.Score, m.NationalScoreMax, m.NationalScoreMin,
         m.NationalScoreAverage, so.MeasureSortOrderName, so.MeasureSortOrderID,
         mt.MeasureTypeName, fm.StartDate, fm.EndDate, ds.DateKey AS StartDateKey,
         de.DateKey AS EndDateKey
  FROM {p}wi_fm fm JOIN {p}wi_mea m ON fm.MeasureID = m.MeasureID
       JOIN measure_types mt ON m.MeasureTypeID = mt.MeasureTypeID
       JOIN sort_orders so ON m.SortOrderID = so.MeasureSortOrderID
       JOIN {p}dim_fac df ON fm.FacilityID = df.FacilityID
       JOIN dim_date ds ON fm.StartDate = ds.Date
       JOIN dim_date de ON fm.EndDate = de.Date)""")
    fact_map = {"MeasureID": "MeasureID", "FacilityKey": "FacilityKey",
                "FacilityID": "FacilityID", "FacilityMeasureID": "FacilityMeasureID",
                "MeasureName": "MeasureName", "ScoreComparedToNational": "ComparedToNational",
                "Score": "Score", "NationalScoreHigh": "NationalScoreMax",
                "NationalScoreLow": "NationalScoreMin",
                "NationalScoreAverage": "NationalScoreAverage",
                "MeasureSortOrderName": "MeasureSortOrderName",
                "MeasureSortOrderNumber": "MeasureSortOrderID",
                "MeasureTypeName": "MeasureTypeName", "StartDate": "StartDate",
                "EndDate": "EndDate", "StartDateKey": "StartDateKey", "EndDateKey": "EndDateKey"}
    fact_upd = {"ScoreComparedToNational", "Score", "NationalScoreHigh", "NationalScoreLow",
                "NationalScoreAverage", "StartDate", "EndDate", "StartDateKey", "EndDateKey"}
    ctes.append(upsert_sql(f"{p}fact", pv("fact"), f"{p}fact_src",
                           [("FacilityID", "FacilityID", False), ("MeasureID", "MeasureID", False),
                            ("FacilityMeasureID", "FacilityMeasureID", False)],
                           fact_map, fact_upd, "MeasureKey", "BIGINT",
                           ["FacilityMeasureID", "FacilityID", "MeasureID"], T_FACT))
    return ",\n".join([bench_sql(f"{p}a", ta, 1).strip(), bench_sql(f"{p}b", tb, 2).strip()]
                      + ctes)


LOOKUPS = """
measure_types AS (SELECT CAST(1 AS SMALLINT) AS MeasureTypeID, 'Complications and Deaths' AS MeasureTypeName
                  UNION ALL SELECT 2, 'Healthcare Associated Infections'),
sort_orders AS (SELECT CAST(0 AS SMALLINT) AS MeasureSortOrderID, 'Descending - Largest Score Is High Rank' AS MeasureSortOrderName
                UNION ALL SELECT 1, 'Ascending - Largest Score Is Low Rank'
                UNION ALL SELECT 2, 'Unknown')"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts if p.strip())


BASE = with_(FEEDS, typed_sql("ta", "feed_a", "a"), typed_sql("tb", "feed_b", "b"))
BENCH = with_(FEEDS, typed_sql("ta", "feed_a", "a"), typed_sql("tb", "feed_b", "b"),
              bench_sql("a", "ta", 1), bench_sql("b", "tb", 2))
STAR = with_(FEEDS, typed_sql("ta", "feed_a", "a"), typed_sql("tb", "feed_b", "b"), LOOKUPS,
             dim_date_sql("dim_date", CAL_START, CAL_END), run_sql("r_", "ta", "tb", None))
TWICE = with_(FEEDS, grain_sql("ua", "feed_a", "a"), grain_sql("ub", "feed_b", "b"),
              typed_sql("ta", "ua", "a"), typed_sql("tb", "ub", "b"), LOOKUPS,
              dim_date_sql("dim_date", CAL_START, CAL_END), run_sql("r_", "ta", "tb", None))
TWO_LOADS = with_(FEEDS, split_sql("a_old", "a_new", "feed_a"), split_sql("b_old", "b_new", "feed_b"),
                  grain_sql("ua_old", "a_old_raw", "a"), grain_sql("ua_new", "a_new_raw", "a"),
                  grain_sql("ub_old", "b_old_raw", "b"), grain_sql("ub_new", "b_new_raw", "b"),
                  typed_sql("ta_old", "ua_old", "a"), typed_sql("tb_old", "ub_old", "b"),
                  typed_sql("ta_new", "ua_new", "a"), typed_sql("tb_new", "ub_new", "b"),
                  LOOKUPS, dim_date_sql("dim_date", CAL_START, CAL_END),
                  run_sql("o_", "ta_old", "tb_old", None), run_sql("n_", "ta_new", "tb_new", "o_"))
DESCRIBED = """
    *, CAST(MonthNumber AS VARCHAR) || ' - ' || MonthName AS MonthDescription,
    CAST(DayOfWeekNumber AS VARCHAR) || ' - ' || DayOfWeekName AS DayOfWeekDescription,
    DayOfWeekName || ', ' || MonthName || ' ' || CAST(DayOfMonth AS VARCHAR) || ', ' || CAST(Year AS VARCHAR)
      AS DayLongDescription,
    CASE WHEN IsWeekend THEN 'Weekend' ELSE 'Weekday' END AS IsWeekendLabel"""
ALL_MEASURES = (f"max(f.Score) AS wi_high_score, min(f.Score) AS wi_low_score, "
                f"{avg7_dec('f.Score')} AS wi_average_score, sum(f.Score) AS measure_score, "
                f"max(f.MeasureSortOrderNumber) AS measure_sort_number, "
                f"max(f.NationalScoreHigh) AS us_high_score, min(f.NationalScoreLow) AS us_low_score, "
                f"{avg7_dec('f.NationalScoreAverage')} AS us_average_score")
MEASURE_COLS = ["wi_high_score", "wi_low_score", "wi_average_score", "measure_score",
                "measure_sort_number", "us_high_score", "us_low_score", "us_average_score"]
FACT_FAC = "r_fact f LEFT JOIN r_dim_fac d ON f.FacilityKey = d.FacilityKey"


def _typed_cols(t: str) -> str:
    return f"SELECT {', '.join(TYPED)} FROM {t}"


FEED_LENGTHS = [
    ("FacilityID", 10), ("FacilityName", 100), ("Address", 100), ("City", 50), ("State", 2), ("ZipCode", 5),
    ("CountyName", 50), ("PhoneNumber", 20), ("MeasureID", 50), ("MeasureName", 100), ("ComparedToNational", 50),
    ("Denominator", 20), ("Score", 20), ("LowerEstimate", 20), ("HigherEstimate", 20), ("Footnote", 10),
    ("StartDate", 10), ("EndDate", 10)]


def lens_of(feed: str) -> list[tuple[str, int]]:
    """Declared text lengths of a feed's columns."""
    return [x for x in FEED_LENGTHS if feed == "outcomes" or x[0] in FEED_COLS_B]


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_feed_a"] = f"{BASE} {_typed_cols('ta')}"
    q["clean_feed_b"] = f"{BASE} {_typed_cols('tb')}"
    # damaged feeds: text that is neither a number (or the feed's own marker) nor a date
    bad = {
        "Score": "CASE WHEN ends_with(Score, '3') THEN '{score}' ELSE Score END",
        "StartDate": "CASE WHEN StartDate LIKE '02/%' THEN '30' || substr(StartDate, 3, 8) ELSE StartDate END",
        "EndDate": "CASE WHEN EndDate LIKE '03/%' THEN '2018-03-31' ELSE EndDate END",
        "Denominator": "CASE WHEN Denominator LIKE '1%' THEN 'about ' || Denominator ELSE Denominator END",
        "LowerEstimate": "CASE WHEN ends_with(LowerEstimate, '7') THEN 'low' ELSE LowerEstimate END",
        "HigherEstimate": "CASE WHEN ends_with(HigherEstimate, '7') THEN 'high' ELSE HigherEstimate END",
    }
    rej = []
    for feed, src, score, marks, cols in (
            ("outcomes", "feed_a", "--", ["not available"],
             ["Denominator", "Score", "LowerEstimate", "HigherEstimate"]),
            ("infections", "feed_b", "n/a", ["not available", "--"], ["Score"])):
        for c in [*cols, "StartDate", "EndDate"]:
            fails = (f"try_strptime(v, '%m/%d/%Y') IS NULL" if c.endswith("Date") else
                     f"{ck('v')} NOT IN ({lst(marks)}) AND TRY_CAST(v AS DECIMAL(10,3)) IS NULL")
            rej.append(f"SELECT '{c}' AS column_name, count_if(v IS NOT NULL AND {fails}) AS reject_count, "
                       f"'{feed}' AS feed FROM (SELECT {bad[c].format(score=score)} AS v FROM {src})")
    q["reject_profile"] = f"{with_(FEEDS)} {' UNION ALL '.join(rej)}"
    q["landing_feed_a"] = f"{with_(FEEDS)} SELECT * FROM feed_a"
    q["landing_feed_b"] = f"{with_(FEEDS)} SELECT * FROM feed_b"
    q["region_slice_b"] = f"{with_(FEEDS)} SELECT * FROM feed_b WHERE {REGION_PRED}"
    q["region_slice"] = f"{with_(FEEDS)} SELECT * FROM feed_a WHERE {REGION_PRED}"
    pl = [f"SELECT FacilityName, MeasureName, Score FROM {t} WHERE {ck('FacilityName')} = "
          f"'{POINT_FACILITY}'" for t in ("feed_a", "feed_b")]
    q["facility_point_lookup"] = (f"{with_(FEEDS)} " + ci_distinct_sql(
        " UNION ALL ".join(pl), ["FacilityName", "MeasureName", "Score"],
        {"FacilityName", "MeasureName", "Score"}))
    fu = " UNION ALL ".join(f"SELECT {', '.join(FAC_COLS)} FROM {t}" for t in ("ta", "tb"))
    q["facilities_union"] = f"{BASE} " + ci_distinct_sql(fu, FAC_COLS, set(FAC_COLS))
    q["national_stats_by_id"] = (
        f"{BENCH} SELECT MeasureCode, NationalScoreMax, NationalScoreMin, NationalScoreAverage, "
        f"CAST(1 AS SMALLINT) AS MeasureTypeID FROM a_us UNION ALL SELECT MeasureCode, "
        f"NationalScoreMax, NationalScoreMin, NationalScoreAverage, CAST(2 AS SMALLINT) FROM b_us")
    q["national_stats_by_direction"] = (
        f"{BENCH} " + ci_distinct_sql("SELECT * FROM a_mea UNION ALL SELECT * FROM b_mea",
                                      list(T_MEA), {"MeasureCode", "MeasureName"}))
    q["class_averages"] = (
        f"{BENCH} SELECT MeasureName, ComparedToNational, label_class, "
        f"CAST(average_score AS DECIMAL(10,3)) AS average_score FROM a_ca UNION ALL "
        f"SELECT MeasureName, ComparedToNational, label_class, "
        f"CAST(average_score AS DECIMAL(10,3)) FROM b_ca")
    sd = ("SELECT MeasureName, CAST(AverageScoreBetter AS DECIMAL(10,3)) AS AverageScoreBetter, "
          "CAST(AverageScoreWorse AS DECIMAL(10,3)) AS AverageScoreWorse, "
          "CAST(AverageScoreNoDifferent AS DECIMAL(10,3)) AS AverageScoreNoDifferent, SortOrderID "
          "FROM {t}_dir")
    q["score_direction"] = f"{BENCH} {sd.format(t='a')} UNION ALL {sd.format(t='b')}"
    q["direction_rank"] = f"""{BENCH},
mea AS ({ci_distinct_sql("SELECT * FROM a_mea UNION ALL SELECT * FROM b_mea", list(T_MEA),
                         {"MeasureCode", "MeasureName"})}),
pf AS (SELECT FacilityName, MeasureCode, {avg3('StatScore')} AS Score
       FROM (SELECT FacilityName, MeasureCode, StatScore FROM ta UNION ALL
             SELECT FacilityName, MeasureCode, StatScore FROM tb) GROUP BY 1, 2),
j AS (SELECT pf.*, m.SortOrderID AS MeasureSortOrderNumber FROM pf
      JOIN mea m ON {ck('pf.MeasureCode')} = {ck('m.MeasureCode')})
SELECT MeasureCode, FacilityName, Score, MeasureSortOrderNumber,
       CASE WHEN Score IS NULL THEN NULL ELSE CAST(rank() OVER (PARTITION BY MeasureCode
            ORDER BY CASE WHEN Score IS NULL THEN 1 ELSE 0 END,
                     CASE WHEN MeasureSortOrderNumber = 0 THEN -Score ELSE Score END) AS BIGINT)
       END AS facility_rank
FROM j"""
    q["measures_us"] = f"{STAR} SELECT * FROM r_us_mea"
    q["measures_regional"] = f"{STAR} SELECT * FROM r_wi_mea"
    q["facility_measures_us"] = f"{STAR} SELECT * FROM r_us_fm"
    q["facility_measures_regional"] = f"{STAR} SELECT * FROM r_wi_fm"
    q["earliest_dates"] = (f"{BASE} SELECT min(StartDate) AS EarliestStartDate, "
                           f"min(EndDate) AS EarliestEndDate FROM (SELECT StartDate, EndDate "
                           f"FROM ta UNION ALL SELECT StartDate, EndDate FROM tb)")
    q["upsert_facilities"] = f"{TWO_LOADS} SELECT * FROM n_us_fac"
    q["upsert_measures"] = f"{TWO_LOADS} SELECT * FROM n_us_mea"
    q["upsert_facility_measures"] = f"{TWO_LOADS} SELECT * FROM n_us_fm"
    q["upsert_fact"] = f"{TWO_LOADS} SELECT * FROM n_fact"
    q["upsert_regional_facilities"] = f"{TWO_LOADS} SELECT * FROM n_wi_fac"
    q["upsert_regional_measures"] = f"{TWO_LOADS} SELECT * FROM n_wi_mea"
    q["upsert_regional_facility_measures"] = f"{TWO_LOADS} SELECT * FROM n_wi_fm"
    q["upsert_dim_facility"] = f"{TWO_LOADS} SELECT * FROM n_dim_fac"
    st = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, sum(CAST({k} AS BIGINT)) AS key_sum, "
        f"count(DISTINCT {k}) AS distinct_keys FROM {c}"
        for n, c, k in (("us_facilities", "r_us_fac", "FacilityID"),
                        ("us_measures", "r_us_mea", "MeasureID"),
                        ("us_facility_measures", "r_us_fm", "FacilityMeasureID"),
                        ("regional_facilities", "r_wi_fac", "FacilityID"),
                        ("regional_measures", "r_wi_mea", "MeasureID"),
                        ("regional_facility_measures", "r_wi_fm", "FacilityMeasureID"),
                        ("dim_facility", "r_dim_fac", "FacilityKey"),
                        ("fact_measure", "r_fact", "MeasureKey")))
    q["refresh_idempotent_state"] = f"{TWICE} {st}"
    q["dim_facility"] = f"{STAR} SELECT * FROM r_dim_fac"
    q["fact_measure"] = f"{STAR} SELECT * FROM r_fact"
    q["refresh_idempotent"] = f"{TWICE} SELECT * FROM r_fact"
    q["fact_out_of_calendar"] = (
        f"{STAR}, dflt AS (SELECT CAST(unnest(generate_series(DATE '{DEFAULT_START}', "
        f"DATE '{DEFAULT_END}', INTERVAL 1 DAY)) AS DATE) AS Date UNION ALL "
        f"SELECT DATE '1900-01-01' UNION ALL SELECT DATE '9999-01-01') "
        f"SELECT count(*) AS dropped_rows FROM (SELECT DISTINCT * FROM r_wi_fm fm WHERE "
        f"NOT EXISTS (SELECT 1 FROM dflt WHERE dflt.Date = fm.StartDate) OR "
        f"NOT EXISTS (SELECT 1 FROM dflt WHERE dflt.Date = fm.EndDate))")
    q["flat_report_star"] = (
        f"{STAR} SELECT f.MeasureKey, d.FacilityName, f.MeasureName, f.Score, "
        f"s.Year AS StartYear, s.MonthName AS StartMonthName, e.Year AS EndYear, "
        f"e.DayOfWeekName AS EndDayOfWeekName FROM r_fact f "
        f"JOIN r_dim_fac d ON f.FacilityKey = d.FacilityKey "
        f"JOIN dim_date s ON f.StartDateKey = s.DateKey JOIN dim_date e ON f.EndDateKey = e.DateKey")
    q["flat_report_staging"] = (
        f"{STAR} SELECT f.FacilityName, m.MeasureName, fm.Score FROM r_wi_fm fm "
        f"JOIN r_wi_fac f ON fm.FacilityID = f.FacilityID "
        f"JOIN r_wi_mea m ON fm.MeasureID = m.MeasureID")
    q["flat_report_staging_us"] = (
        f"{STAR} SELECT f.FacilityName, m.MeasureName, fm.Score FROM r_us_fm fm "
        f"JOIN r_us_fac f ON fm.FacilityID = f.FacilityID "
        f"JOIN r_us_mea m ON fm.MeasureID = m.MeasureID")
    q["fact_dim_left"] = (f"{STAR} SELECT d.FacilityName, f.MeasureName, f.Score FROM {FACT_FAC} "
                          f"ORDER BY d.FacilityName NULLS FIRST, f.MeasureName")
    q["facility_full_address"] = (
        f"{STAR} SELECT FacilityKey, FacilityName, coalesce(FacilityAddress, '') || ' ' || "
        f"coalesce(FacilityCity, '') || ', ' || coalesce(FacilityState, '') || ' ' || "
        f"coalesce(FacilityZipCode, '') AS FacilityFullAddress FROM r_dim_fac")
    q["days_recorded"] = (f"{STAR} SELECT MeasureKey, StartDate, EndDate, "
                          f"CAST(EndDate - StartDate AS BIGINT) AS DaysRecorded FROM r_fact")
    q["measure_summary"] = (f"{STAR} SELECT min(f.MeasureName) AS MeasureName, {ALL_MEASURES} FROM r_fact f "
                            f"GROUP BY {ck('f.MeasureName')}")
    unp = " UNION ALL ".join(
        f"SELECT MeasureName, '{m}' AS measure, CAST({m} AS DECIMAL(24,7)) AS value FROM ms"
        for m in MEASURE_COLS)
    q["measure_summary_long"] = (f"{STAR}, ms AS (SELECT f.MeasureName, {ALL_MEASURES} "
                                 f"FROM r_fact f GROUP BY 1) {unp}")
    q["county_report"] = (
        f"{STAR} SELECT min(d.FacilityState) AS FacilityState, min(d.FacilityCountyName) AS FacilityCountyName, "
        f"{avg7_dec('f.Score')} AS wi_average_score FROM {FACT_FAC} WHERE f.MeasureName = '{REPORT_MEASURE}' "
        f"GROUP BY {ck('d.FacilityState')}, {ck('d.FacilityCountyName')} HAVING {avg7_dec('f.Score')} IS NOT NULL")
    q["facility_comparison"] = (
        f"{STAR} SELECT {', '.join(f'min({c}) AS {c[2:]}' for c in COMPARED)}, max(f.Score) AS wi_high_score "
        f"FROM {FACT_FAC} WHERE f.MeasureName = '{REPORT_MEASURE}' GROUP BY {', '.join(map(ck, COMPARED))} "
        f"HAVING max(f.Score) IS NOT NULL ORDER BY wi_high_score, FacilityName, FacilityCountyName")
    ct = ", ".join(f"sum(CASE WHEN f.MeasureName = '{m}' THEN f.Score END) AS \"{m}\""
                   for m in CROSSTAB_MEMBERS)
    q["facility_measure_crosstab"] = (f"{STAR} SELECT min(d.FacilityName) AS FacilityName, {ct} FROM {FACT_FAC} "
                                      f"GROUP BY {ck('d.FacilityName')} HAVING sum(f.Score) IS NOT NULL")
    q["calendar_rollup"] = (
        f"{STAR} SELECT dt.Year, dt.MonthName, dt.DayOfWeekName, dt.DayOfMonth, "
        f"sum(f.Score) AS measure_score, "
        f"CAST(GROUPING(dt.Year, dt.MonthName, dt.DayOfWeekName, dt.DayOfMonth) AS INTEGER) "
        f"AS grouping_level FROM r_fact f LEFT JOIN dim_date dt ON f.StartDateKey = dt.DateKey "
        f"GROUP BY ROLLUP (dt.Year, dt.MonthName, dt.DayOfWeekName, dt.DayOfMonth) "
        f"HAVING sum(f.Score) IS NOT NULL")
    q["attribute_total"] = (
        f"{STAR} SELECT CASE WHEN GROUPING(k) = 0 THEN min(FacilityCountyName) END AS FacilityCountyName, "
        f"{avg7_dec('f.Score')} AS wi_average_score, GROUPING(k) = 1 AS is_total "
        f"FROM (SELECT f.*, d.FacilityCountyName, {ck('d.FacilityCountyName')} AS k FROM {FACT_FAC}) f "
        f"GROUP BY ROLLUP (k) HAVING {avg7_dec('f.Score')} IS NOT NULL")
    q["by_end_date"] = (
        f"{STAR} SELECT dt.Year, dt.MonthName, sum(f.Score) AS measure_score FROM r_fact f "
        f"LEFT JOIN dim_date dt ON f.EndDateKey = dt.DateKey GROUP BY 1, 2 "
        f"HAVING sum(f.Score) IS NOT NULL")
    q["facility_rank"] = (
        f"{STAR} SELECT f.MeasureName, d.FacilityName, f.Score, f.MeasureSortOrderNumber, "
        f"CASE WHEN f.Score IS NULL THEN NULL ELSE CAST(rank() OVER (PARTITION BY f.MeasureID "
        f"ORDER BY CASE WHEN f.Score IS NULL THEN 1 ELSE 0 END, CASE WHEN "
        f"f.MeasureSortOrderNumber = 0 THEN -f.Score ELSE f.Score END) AS BIGINT) END "
        f"AS facility_rank FROM {FACT_FAC}")
    card = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, count(DISTINCT {ck(a)}) AS member_count FROM r_dim_fac"
        for a in COUNTED)
    q["dimension_cardinality"] = f"{STAR} {card}"
    q["composite_key_outer_chain"] = """
SELECT a.o_orderkey, a.o_orderdate, c.l_linenumber AS c_linenumber, c.l_partkey AS c_partkey,
       x.p_brand, x.s_name, k2.l_linenumber AS k2_linenumber, k2.l_suppkey AS k2_suppkey
FROM (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F') a
LEFT JOIN lineitem c ON a.o_orderkey = c.l_orderkey
LEFT JOIN (SELECT k.l_orderkey AS k_orderkey, k.l_linenumber AS k_linenumber,
                  k.l_partkey AS k_partkey, n.p_brand, r.s_name
           FROM lineitem k JOIN part n ON k.l_partkey = n.p_partkey
           LEFT JOIN supplier r ON k.l_suppkey = r.s_suppkey) x
  ON c.l_orderkey = x.k_orderkey AND c.l_linenumber = x.k_linenumber
     AND c.l_partkey = x.k_partkey
LEFT JOIN lineitem k2 ON x.k_orderkey = k2.l_orderkey AND k2.l_linenumber = x.k_linenumber + 1"""
    pk = []
    for t, k in (("r_us_fac", "FacilityID"), ("r_us_mea", "MeasureID"),
                 ("r_us_fm", "FacilityMeasureID"), ("r_wi_fac", "FacilityID"),
                 ("r_wi_mea", "MeasureID"), ("r_wi_fm", "FacilityMeasureID"),
                 ("r_dim_fac", "FacilityKey"), ("r_fact", "MeasureKey"),
                 ("dim_date", "DateKey"), ("measure_types", "MeasureTypeID"),
                 ("sort_orders", "MeasureSortOrderID")):
        pk.append(f"SELECT '{t}' AS table_name, CAST({k} AS BIGINT) AS key_value, "
                  f"count(*) AS row_count FROM {t} GROUP BY {k} HAVING count(*) > 1 OR {k} IS NULL")
    q["pk_violations"] = f"{STAR} {' UNION ALL '.join(pk)}"
    views = {"us_facilities": "r_us_fac", "us_measures": "r_us_mea", "us_facility_measures": "r_us_fm",
             "regional_facilities": "r_wi_fac", "regional_measures": "r_wi_mea", "regional_facility_measures": "r_wi_fm",
             "dim_facility": "r_dim_fac", "fact_measure": "r_fact", "dim_date": "dim_date",
             "measure_types": "measure_types", "sort_orders": "sort_orders"}
    refs = [("fact_measure", "FacilityKey", "dim_facility", "FacilityKey"),
            ("fact_measure", "StartDateKey", "dim_date", "DateKey"),
            ("fact_measure", "EndDateKey", "dim_date", "DateKey")]
    for layer in ("us", "regional"):
        refs += [(f"{layer}_facility_measures", "FacilityID", f"{layer}_facilities", "FacilityID"),
                 (f"{layer}_facility_measures", "MeasureID", f"{layer}_measures", "MeasureID"),
                 (f"{layer}_measures", "MeasureTypeID", "measure_types", "MeasureTypeID")]
    fk = [f"SELECT '{child}' AS table_name, '{col}' AS column_name, count(*) AS violations "
          f"FROM {views[child]} c WHERE c.{col} IS NOT NULL AND "
          f"NOT EXISTS (SELECT 1 FROM {views[parent]} p WHERE p.{pcol} = c.{col})"
          for child, col, parent, pcol in refs]
    q["fk_violations"] = f"{STAR} {' UNION ALL '.join(fk)}"
    measure = ["MeasureID", *T_MEA]
    fm = ["FacilityMeasureID", "FacilityID", "MeasureID", "StartDate", "EndDate"]
    required = {
        "us_facilities": ["FacilityID", "FacilityName", "State", "CountyName"],
        "us_measures": measure, "us_facility_measures": fm,
        "dim_facility": ["FacilityKey", "FacilityID", "FacilityName", "FacilityState", "FacilityCountyName"],
        "fact_measure": ["MeasureKey", *[c for c in T_FACT if c not in ("ScoreComparedToNational", "Score")]],
        "dim_date": ["DateKey", "Date", "DayOfMonth", "MonthNumber", "MonthName", "Year", "DayOfWeekName",
                     "DayOfWeekNumber", "IsWeekend"],
        "measure_types": ["MeasureTypeID", "MeasureTypeName"],
        "sort_orders": ["MeasureSortOrderID", "MeasureSortOrderName"],
    }
    fac_lens = [("FacilityName", 100), ("Address", 100), ("City", 50), ("State", 2), ("ZipCode", 5),
                ("CountyName", 50), ("PhoneNumber", 20)]
    lens = {
        "us_facilities": [("FacilityCode", 10), *fac_lens],
        "us_measures": [("MeasureCode", 50), ("MeasureName", 100)],
        "us_facility_measures": [("ComparedToNational", 100), ("Footnote", 10)],
        "dim_facility": [(c if c == "FacilityName" else f"Facility{c}", n) for c, n in fac_lens],
        "fact_measure": [("MeasureName", 100), ("ScoreComparedToNational", 100),
                         ("MeasureSortOrderName", 100), ("MeasureTypeName", 100)],
        "dim_date": [("MonthName", 10), ("DayOfWeekName", 10)],
        "measure_types": [("MeasureTypeName", 100)], "sort_orders": [("MeasureSortOrderName", 100)],
    }
    for n in ("facilities", "measures", "facility_measures"):
        required[f"regional_{n}"], lens[f"regional_{n}"] = required[f"us_{n}"], lens[f"us_{n}"]
    nn = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count_if({c} IS NULL) AS null_count "
        f"FROM {views[t]}" for t, cs in required.items() for c in cs)
    q["null_violations"] = f"{STAR} {nn}"
    views |= {"outcomes": "feed_a", "infections": "feed_b"}
    lens["outcomes"], lens["infections"] = lens_of("outcomes"), lens_of("infections")
    lv = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_allowed, max(length({c})) AS max_length, "
        f"count(*) FILTER (WHERE length({c}) > {n}) AS over_limit FROM {views[t]}"
        for t, cs in lens.items() for c, n in cs)
    q["length_violations"] = f"{STAR} {lv}"
    # the model's calendar: facts of days that it leaves out have no attributes
    described = f"described AS (SELECT {DESCRIBED} FROM dim_date)"
    axes = ["Date", "MonthDescription", "DayOfWeekDescription", "DayLongDescription", "IsWeekend", "IsWeekendLabel"]
    q["model_calendar"] = (
        f"{STAR}, {described}, shown AS (SELECT * FROM described WHERE Date < DATE '{TODAY}' AND Date <> DATE "
        f"'1900-01-01') SELECT {', '.join('s.' + a for a in axes)}, sum(f.Score) AS measure_score FROM r_fact f "
        f"LEFT JOIN shown s ON f.StartDateKey = s.DateKey GROUP BY {', '.join('s.' + a for a in axes)} "
        f"HAVING sum(f.Score) IS NOT NULL ORDER BY Date NULLS FIRST")
    q["calendar_usage"] = (
        f"{STAR}, {described} SELECT d.*, (SELECT count(*) FROM r_fact f WHERE f.StartDateKey = d.DateKey) AS "
        f"start_facts, (SELECT count(*) FROM r_fact f WHERE f.EndDateKey = d.DateKey) AS end_facts "
        f"FROM described d ORDER BY d.Date")
    q["year_slicer"] = (
        f"{STAR} SELECT min(f.MeasureName) AS MeasureName, sum(f.Score) AS measure_score, {avg7_dec('f.Score')} AS "
        f"wi_average_score FROM r_fact f WHERE year(f.StartDate) IN {YEARS} GROUP BY {ck('f.MeasureName')} "
        f"HAVING count(f.Score) > 0")
    q["month_slicer"] = (
        f"{STAR}, {described} SELECT min(d.FacilityCountyName) AS FacilityCountyName, s.Year, sum(f.Score) AS "
        f"measure_score FROM {FACT_FAC} JOIN described s ON f.StartDateKey = s.DateKey "
        f"WHERE {ck('s.DayLongDescription')} IN ({lst(DAYS)}) "
        f"GROUP BY {ck('d.FacilityCountyName')}, s.Year HAVING sum(f.Score) IS NOT NULL")
    q["cardinality_by_sketch"] = (
        f"{STAR} " + " UNION ALL ".join(
            f"SELECT '{a}' AS attribute, y AS StartYear, count(DISTINCT k)::BIGINT AS member_count FROM "
            f"(SELECT year(f.StartDate)::INT AS y, {ck('d.' + a)} AS k FROM {FACT_FAC}) GROUP BY {by}"
            for a in COUNTED for by in ("GROUPING SETS ((y), ())",)))
    q["cardinality_over_loads"] = (
        f"{TWO_LOADS}, seen AS (SELECT f.StartDate, f.MeasureName, d.* FROM o_fact f LEFT JOIN o_dim_fac d "
        f"ON f.FacilityKey = d.FacilityKey UNION ALL SELECT f.StartDate, f.MeasureName, d.* FROM n_fact f "
        f"LEFT JOIN n_dim_fac d ON f.FacilityKey = d.FacilityKey) " + " UNION ALL ".join(
            f"SELECT '{a}' AS attribute, y AS StartYear, count(DISTINCT k)::BIGINT AS member_count FROM "
            f"(SELECT year(StartDate)::INT AS y, {ck(a)} AS k FROM seen) GROUP BY GROUPING SETS ((y), ())"
            for a in ("FacilityName", *COUNTED, "MeasureName")))
    facts = (f"facts AS (SELECT f.*, s.* EXCLUDE (DateKey), d.* EXCLUDE (FacilityKey, FacilityID, FacilityName), "
             f"d.FacilityName, coalesce(FacilityAddress, '') || ' ' || coalesce(FacilityCity, '') || ', ' || "
             f"coalesce(FacilityState, '') || ' ' || coalesce(FacilityZipCode, '') AS FacilityFullAddress, "
             f"f.EndDate - f.StartDate AS DaysRecorded FROM {FACT_FAC} "
             f"LEFT JOIN described s ON f.StartDateKey = s.DateKey)")
    measures = f"sum(f.Score) AS measure_score, {avg7_dec('f.Score')} AS wi_average_score"
    totals = [f"SELECT '(All)' AS attribute, NULL AS member, true AS is_total, {measures} FROM facts f"]
    for a, text in TOTALLED.items():
        value = f"CAST(f.{a} AS VARCHAR)"
        totals.append(f"SELECT '{a}', min({value}), false, {measures} FROM facts f GROUP BY "
                      f"{ck(value) if text else value}")
    q["attribute_totals"] = f"{STAR}, {described}, {facts} {' UNION ALL '.join(totals)}"
    # damaged landing files
    quarantine, accepted = [], []
    for feed, src, score, marks, cols in (
            ("outcomes", "feed_a", "--", ["not available"], ["Denominator", "Score", "LowerEstimate", "HigherEstimate"]),
            ("infections", "feed_b", "n/a", ["not available", "--"], ["Score"])):
        names = FEED_COLS_A if feed == "outcomes" else FEED_COLS_B
        fields = [(f"coalesce('\"' || {c} || '\"', '')" if c == "Footnote" else f"coalesce({c}, '')") for c in names]
        damage = {c: bad[c].format(score=score) for c in [*cols, "StartDate", "EndDate"]}
        lines = (f"SELECT {', '.join(f'{damage[c]} AS {c}' if c in damage else c for c in names)}, "
                 f"StartDate LIKE '05/1%' AS cut, EndDate LIKE '07/1%' AS more FROM {src}")
        whole = " || ',' || ".join(fields)
        short = " || ',' || ".join(fields[:10])
        why = [f"CASE WHEN {ck(c)} NOT IN ({lst(marks)}) AND TRY_CAST({c} AS DECIMAL(10,3)) IS NULL "
               f"THEN '{c} is not a number' END" for c in cols]
        why += [f"CASE WHEN try_strptime({c}, '%m/%d/%Y') IS NULL THEN '{c} is not a date' END"
                for c in ("StartDate", "EndDate")]
        why += [f"CASE WHEN length({c}) > {n} THEN '{c} is longer than {n}' END" for c, n in lens_of(feed)]
        rows = (f"SELECT *, cut OR more AS broken, CASE WHEN cut THEN {short} WHEN more THEN {whole} || ',and more' "
                f"END AS line, CASE WHEN cut OR more THEN 'wrong number of fields' ELSE concat_ws('; ', {', '.join(why)}) END "
                f"AS reasons FROM ({lines})")
        quarantine.append(f"SELECT '{feed}' AS feed, line, " + ", ".join(
            f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in ("FacilityID", "MeasureID", "Score", "StartDate",
                                                                  "EndDate"))
            + f", reasons FROM ({rows}) WHERE reasons <> ''")
        accepted.append(f"SELECT '{feed}' AS feed, MeasureID AS MeasureCode, {dec('Score', marks)} AS Score, "
                        f"{fdate('EndDate', True)} AS EndDate FROM ({rows}) WHERE reasons = ''")
    q["landing_quarantine"] = f"{with_(FEEDS)} {' UNION ALL '.join(quarantine)}"
    q["landing_accepted"] = (
        f"{with_(FEEDS)} SELECT feed, MeasureCode, count(*) AS row_count, sum(Score) AS score_sum, "
        f"max(EndDate) AS last_end FROM ({' UNION ALL '.join(accepted)}) GROUP BY feed, MeasureCode")
    q["landing_replaced"] = f"{with_(FEEDS)} SELECT * FROM feed_b"
    # damaged copies of the published tables
    damaged = f"""{STAR},
dfm AS (SELECT * REPLACE (CASE WHEN FacilityMeasureID % 89 = 0 THEN FacilityID + 1000000 ELSE FacilityID END AS FacilityID,
                          CASE WHEN FacilityMeasureID % 83 = 0 THEN NULL ELSE StartDate END AS StartDate) FROM r_us_fm
        UNION ALL SELECT * FROM r_us_fm WHERE FacilityMeasureID % 97 = 0),
dfact AS (SELECT * REPLACE (CASE WHEN FacilityMeasureID % 79 = 0 THEN 20201231 ELSE EndDateKey END AS EndDateKey,
                            CASE WHEN FacilityMeasureID % 73 = 0 THEN NULL ELSE NationalScoreLow END AS NationalScoreLow,
                            CASE WHEN FacilityMeasureID % 61 = 0 THEN NULL ELSE MeasureKey END AS MeasureKey) FROM r_fact)"""
    copies = {"us_facility_measures": "dfm", "fact_measure": "dfact"}
    q["damaged_keys"] = f"{damaged} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k}::BIGINT AS key_value, count(*) AS row_count FROM {copies[t]} GROUP BY {k} "
        f"HAVING count(*) > 1 OR {k} IS NULL" for t, k in (("us_facility_measures", "FacilityMeasureID"),
                                                           ("fact_measure", "MeasureKey")))
    q["damaged_references"] = f"{damaged} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, c.{c}::BIGINT AS key_value, count(*) AS row_count FROM "
        f"{copies[t]} c WHERE c.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {views[parent]} p WHERE p.{pc} = c.{c}) "
        f"GROUP BY c.{c}" for t, c, parent, pc in refs if t in copies)
    q["damaged_nulls"] = f"{damaged} SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count_if({c} IS NULL) AS null_count FROM {copies[t]}"
        for t in copies for c in required[t]) + ") WHERE null_count > 0"
    q["lost_facts"] = f"""{STAR},
layers AS (SELECT 'regional' AS layer, f.FacilityName, m.MeasureName, fm.Score FROM r_wi_fm fm
             JOIN r_wi_fac f ON fm.FacilityID = f.FacilityID JOIN r_wi_mea m ON fm.MeasureID = m.MeasureID
           UNION ALL SELECT 'star', d.FacilityName, f.MeasureName, f.Score FROM {FACT_FAC} WHERE FacilityMeasureID % 41 <> 0),
per_score AS (SELECT {ck('FacilityName')} AS facility_key, {ck('MeasureName')} AS measure_key, Score,
              count_if(layer = 'regional') AS r, count_if(layer = 'star') AS s FROM layers GROUP BY 1, 2, 3),
pairs AS (SELECT facility_key, measure_key, sum(r)::BIGINT AS regional_rows, max(CASE WHEN r > 0 THEN Score END) AS regional_score,
          sum(s)::BIGINT AS star_rows, max(CASE WHEN s > 0 THEN Score END) AS star_score,
          count_if(r <> s) AS differing_scores FROM per_score GROUP BY 1, 2)
SELECT * FROM (SELECT *, CASE WHEN regional_rows = 0 OR star_rows = 0 THEN 'missing' WHEN regional_rows <> star_rows THEN 'count'
               WHEN differing_scores > 0 THEN 'value' ELSE 'match' END AS status FROM pairs) WHERE status <> 'match'"""
    q["layer_reconciliation"] = f"""{STAR},
landing AS (SELECT FacilityName, MeasureName, Score FROM ta WHERE {REGION_PRED}
            UNION ALL SELECT FacilityName, MeasureName, Score FROM tb WHERE {REGION_PRED}),
us AS (SELECT f.FacilityName, m.MeasureName, fm.Score FROM r_us_fm fm
       JOIN r_us_fac f ON fm.FacilityID = f.FacilityID JOIN r_us_mea m ON fm.MeasureID = m.MeasureID
       WHERE f.FacilityName IN (SELECT FacilityName FROM r_wi_fac)),
wi AS (SELECT f.FacilityName, m.MeasureName, fm.Score FROM r_wi_fm fm
       JOIN r_wi_fac f ON fm.FacilityID = f.FacilityID JOIN r_wi_mea m ON fm.MeasureID = m.MeasureID),
st AS (SELECT d.FacilityName, f.MeasureName, f.Score FROM {FACT_FAC}),
layers AS (SELECT 'landing' AS layer, * FROM landing UNION ALL SELECT 'us', * FROM us
           UNION ALL SELECT 'wi', * FROM wi UNION ALL SELECT 'star', * FROM st),
per_score AS (SELECT {ck('FacilityName')} AS facility_key, {ck('MeasureName')} AS measure_key, Score,
              {', '.join(f"count_if(layer = '{n}') AS {n}_rows" for n in LAYERS)}
              FROM layers GROUP BY 1, 2, 3),
pairs AS (SELECT facility_key, measure_key,
          {', '.join(f"CAST(sum({n}_rows) AS BIGINT) AS {n}_rows, max(CASE WHEN {n}_rows > 0 THEN Score END) AS {n}_score" for n in LAYERS)},
          count_if({' OR '.join(f"{n}_rows <> landing_rows" for n in LAYERS[1:])}) AS differing_scores
          FROM per_score GROUP BY 1, 2)
SELECT *, CASE WHEN {' OR '.join(f"{n}_rows = 0" for n in LAYERS)} THEN 'missing'
               WHEN {' OR '.join(f"{n}_rows <> landing_rows" for n in LAYERS[1:])} THEN 'count'
               WHEN differing_scores > 0 THEN 'value' ELSE 'match' END AS status
FROM pairs"""
    return q
