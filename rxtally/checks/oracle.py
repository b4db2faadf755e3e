"""DuckDB SQL with the answer of every query, written without the library.

Named steps are shared: ``_with`` puts the steps a query mentions, and those
they mention, in front of it.
"""

from __future__ import annotations

import re

ORACLE: dict[str, str] = {}
_STEPS: dict[str, str] = {}


def _with(sql: str) -> str:
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in _STEPS:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(_STEPS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    recursive = "RECURSIVE " if any("RECURSIVE" in _STEPS[name] for name in needed) else ""
    steps = ",\n".join(
        f"{name} AS {'' if 'RECURSIVE' in _STEPS[name] else 'MATERIALIZED '}"
        f"({_STEPS[name].replace('/*RECURSIVE*/', '').strip()})"
        for name in needed
    )
    return f"WITH {recursive}{steps}\n{sql.strip()}"


def _oracle(**queries: str) -> None:
    for name, sql in queries.items():
        ORACLE[name] = _with(sql)


# --- star schema --------------------------------------------------------------

_STEPS["rx_fact"] = """
SELECT CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INT) AS YEAR_MONTH,
       'S' AS PRESC_TYPE_PRNT, l.l_suppkey AS PRESC_ID_PRNT,
       l.l_partkey AS CALC_PREC_DRUG_RECORD_ID,
       CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE CAST(o.o_custkey % 100 AS INT) END AS CALC_AGE,
       CASE WHEN l.l_returnflag = 'R' THEN 0 WHEN o.o_custkey % 50 = 0 THEN 9
            ELSE CAST(1 + o.o_custkey % 2 AS INT) END AS PDS_GENDER,
       CASE WHEN o.o_custkey % 211 = 0 THEN NULL ELSE o.o_custkey END AS IDENTIFIED_PATIENT_ID,
       CASE WHEN l.l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS IDENTIFIED_FLAG,
       CAST(l.l_quantity AS BIGINT) AS ITEM_COUNT,
       CAST(round(l.l_extendedprice * 100, 0) AS BIGINT) AS ITEM_PAY_DR_NIC
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

_STEPS["rx_month"] = """
SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS YEAR_MONTH,
       year(o_orderdate) AS Y, month(o_orderdate) AS M FROM orders
"""

_STEPS["rx_time"] = """
SELECT YEAR_MONTH, FY AS FINANCIAL_YEAR, concat(FY, ' Q', CAST(Q AS STRING)) AS FINANCIAL_QUARTER
FROM (SELECT YEAR_MONTH, CAST(floor(((M + 8) % 12) / 3) + 1 AS INT) AS Q,
             CASE WHEN M >= 4 THEN concat(CAST(Y AS STRING), '/', CAST(Y + 1 AS STRING))
                  ELSE concat(CAST(Y - 1 AS STRING), '/', CAST(Y AS STRING)) END AS FY
      FROM rx_month) b
"""

_STEPS["rx_org"] = """
SELECT 'S' AS LVL_5_OUPDT, s.s_suppkey AS LVL_5_OU
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_regionkey <= 2
"""

_STEPS["rx_drug"] = """
SELECT p.p_partkey AS RECORD_ID, t.YEAR_MONTH,
       CASE p.p_type WHEN 'ECONOMY' THEN '0401' WHEN 'LARGE' THEN '0402' WHEN 'MEDIUM' THEN '0403'
                     WHEN 'SMALL' THEN '0404' ELSE '0411' END AS BNF_SECTION,
       p.p_type AS SECTION_DESCR
FROM part p CROSS JOIN (SELECT YEAR_MONTH FROM rx_month) t WHERE p.p_type <> 'PROMO'
"""

_STEPS["rx_age"] = """
SELECT DISTINCT CALC_AGE AS AGE,
       CASE WHEN CALC_AGE < 0 THEN NULL WHEN CALC_AGE >= 90 THEN '90+'
            ELSE concat(lpad(CAST(CAST(floor(CALC_AGE / 5) * 5 AS INT) AS STRING), 2, '0'), '-',
                        lpad(CAST(CAST(floor(CALC_AGE / 5) * 5 + 4 AS INT) AS STRING), 2, '0'))
            END AS DALL_5YR_BAND
FROM (SELECT CAST(o_custkey % 100 AS INT) AS CALC_AGE FROM orders UNION SELECT -1 AS CALC_AGE) a
"""

_STEPS["rx_days"] = """
SELECT CAST(year(d) * 100 + month(d) AS INT) AS YEAR_MONTH, CAST(count(*) AS INT) AS DISPENSING_DAYS
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate))::TIMESTAMP,
                                    last_day(max(o_orderdate))::TIMESTAMP, INTERVAL 1 DAY)) AS d
      FROM orders) s
WHERE dayofweek(d) <> 0 GROUP BY 1
"""

_STEPS["joined"] = """
SELECT f.*, t.FINANCIAL_YEAR, t.FINANCIAL_QUARTER, d.BNF_SECTION, d.SECTION_DESCR, a.DALL_5YR_BAND
FROM rx_fact f JOIN rx_time t ON f.YEAR_MONTH = t.YEAR_MONTH
JOIN rx_org o ON f.PRESC_TYPE_PRNT = o.LVL_5_OUPDT AND f.PRESC_ID_PRNT = o.LVL_5_OU
JOIN rx_drug d ON f.CALC_PREC_DRUG_RECORD_ID = d.RECORD_ID AND f.YEAR_MONTH = d.YEAR_MONTH
JOIN rx_age a ON f.CALC_AGE = a.AGE
"""

_STEPS["people"] = """
SELECT *, CASE PDS_GENDER WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'U' END AS GENDER,
       coalesce(DALL_5YR_BAND, 'Unknown') AS BAND5
FROM joined
"""


def _band20(column: str) -> str:
    return f"""CASE WHEN {column} = 'Unknown' THEN 'Unknown' WHEN {column} < '20' THEN '00-19'
        WHEN {column} < '40' THEN '20-39' WHEN {column} < '60' THEN '40-59'
        WHEN {column} < '80' THEN '60-79' ELSE '80+' END"""


def _patient_totals(source: str, period: str, person: str = "") -> str:
    """Two-stage totals: patients first, then sections."""
    names = "SECTION_DESCR AS SECTION_NAME, BNF_SECTION AS SECTION_CODE"
    person_out = (
        ", GENDER AS PDS_GENDER, BAND5 AS DALL_5YR_BAND" if person else ""
    )
    keys = f"{period}, SECTION_DESCR, BNF_SECTION, IDENTIFIED_FLAG{person}"
    return f"""
SELECT {period}, {names}, IDENTIFIED_FLAG{person_out}, CAST(sum(i) AS BIGINT) AS ITEM_COUNT,
       CAST(sum(p) AS DOUBLE) / 100 AS ITEM_PAY_DR_NIC,
       CAST(sum(CASE IDENTIFIED_FLAG WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END) AS BIGINT) AS PATIENT_COUNT
FROM (SELECT {keys}, IDENTIFIED_PATIENT_ID, sum(ITEM_COUNT) AS i, sum(ITEM_PAY_DR_NIC) AS p
      FROM {source} GROUP BY {keys}, IDENTIFIED_PATIENT_ID) s
GROUP BY {keys}"""


_QUARTER = "FINANCIAL_YEAR, FINANCIAL_QUARTER"
_MONTH = f"{_QUARTER}, YEAR_MONTH"
_STEPS["quarterly"] = _patient_totals("joined", _QUARTER)
_STEPS["monthly"] = _patient_totals("joined", _MONTH)
_STEPS["model"] = _patient_totals("people", _MONTH, ", GENDER, BAND5")

_TOTALS = """count(*) AS n, CAST(sum(ITEM_COUNT) AS BIGINT) AS items,
       CAST(sum(ITEM_PAY_DR_NIC) AS BIGINT) AS pence"""

# --- sources and sinks ----------------------------------------------------------

_oracle(
    s1_scan_projected="""SELECT l_returnflag, count(*) AS n,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1""",
    s2_newest_snapshot="""SELECT count(*) AS n,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem""",
    s4_fact_scan=f"""SELECT YEAR_MONTH, IDENTIFIED_FLAG, {_TOTALS} FROM rx_fact
        WHERE YEAR_MONTH BETWEEN 199504 AND 200106 GROUP BY 1, 2""",
    s5_time_dimension="SELECT * FROM rx_time",
    s5_time_dimension_from_month="SELECT * FROM rx_time WHERE YEAR_MONTH >= 200001",
    s6_organisation_dimension="SELECT * FROM rx_org",
    s7_drug_dimension="""SELECT YEAR_MONTH, BNF_SECTION, SECTION_DESCR, count(*) AS n,
        CAST(sum(RECORD_ID) AS BIGINT) AS record_sum FROM rx_drug GROUP BY 1, 2, 3""",
    s8_age_dimension="SELECT * FROM rx_age",
    s9_dispensing_days="SELECT * FROM rx_days",
    k7_incremental_refresh="SELECT * FROM monthly",
    k7_next_month="SELECT 200109 AS NEXT_MONTH FROM rx_fact HAVING max(YEAR_MONTH) = 200108",
    k8_freshness_gate="""SELECT LATEST, STORED, LATEST > STORED AS IS_NEWER FROM
        (SELECT max(m) AS LATEST FROM (SELECT FINANCIAL_QUARTER, max(YEAR_MONTH) AS m FROM rx_time
            GROUP BY 1 HAVING count(*) = 3) q) a,
        (SELECT max(YEAR_MONTH) AS STORED FROM rx_fact WHERE YEAR_MONTH <= 200103) b""",
)

# --- projections and filters ------------------------------------------------------

_STEPS["rates"] = """
SELECT FINANCIAL_QUARTER, SECTION_NAME, SECTION_CODE,
       100.0 * sum(CASE WHEN IDENTIFIED_FLAG = 'Y' THEN ITEM_COUNT END)::DOUBLE
         / sum(CASE WHEN IDENTIFIED_FLAG IN ('Y', 'N') THEN ITEM_COUNT END)::DOUBLE AS RATE
FROM quarterly GROUP BY 1, 2, 3 HAVING count(DISTINCT IDENTIFIED_FLAG) = 2
"""
_KNOWN = """NOT (IDENTIFIED_FLAG = 'N' AND PDS_GENDER = 'F')
        AND NOT (IDENTIFIED_FLAG = 'N' AND PDS_GENDER = 'M') AND PDS_GENDER <> 'U'"""

_oracle(
    p1_select_columns="""SELECT FINANCIAL_QUARTER, SECTION_CODE, IDENTIFIED_FLAG, ITEM_COUNT
        FROM quarterly""",
    p1b_column_by_value="""SELECT SECTION_CODE, round(RATE, 8) AS RATE FROM rates
        WHERE FINANCIAL_QUARTER = '2000/2001 Q4'""",
    p2_drop_column="SELECT * EXCLUDE (ITEM_PAY_DR_NIC) FROM quarterly",
    p5_derived_columns=f"""SELECT CASE PDS_GENDER WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'U' END AS GENDER,
        YEAR_MONTH % 100 AS MONTH_NUM, {_TOTALS} FROM rx_fact GROUP BY 1, 2""",
    p6_month_range=f"""SELECT YEAR_MONTH, {_TOTALS} FROM rx_fact
        WHERE YEAR_MONTH >= 199704 AND YEAR_MONTH <= 200106 GROUP BY 1""",
    p7_latest_loaded="""SELECT * FROM rx_time WHERE YEAR_MONTH >= 199901
        AND YEAR_MONTH <= (SELECT max(YEAR_MONTH) FROM rx_fact)""",
    p8_equality_filter="""SELECT * FROM quarterly
        WHERE SECTION_CODE = '0403' AND FINANCIAL_QUARTER = '2000/2001 Q4'""",
    p9_in_list="SELECT * FROM monthly WHERE YEAR_MONTH IN (200104, 200105, 200106)",
    p10_not_in="SELECT * FROM quarterly WHERE FINANCIAL_YEAR NOT IN ('1994/1995', '1995/1996')",
    p11_known_person=f"SELECT * FROM model WHERE {_KNOWN} AND DALL_5YR_BAND <> 'Unknown'",
    p12_at_maximum=f"""SELECT YEAR_MONTH, IDENTIFIED_FLAG, {_TOTALS} FROM rx_fact
        WHERE YEAR_MONTH = (SELECT max(YEAR_MONTH) FROM rx_fact) GROUP BY 1, 2""",
    p13_distinct_rows="SELECT DISTINCT YEAR_MONTH, BNF_SECTION, SECTION_DESCR FROM joined",
    p14_scalar="""SELECT CAST((SELECT max(YEAR_MONTH) // 100 FROM rx_fact) - YEAR_MONTH // 100 AS BIGINT)
        AS YEARS_BACK, count(*) AS n FROM rx_fact GROUP BY 1""",
    p15_period_split=f"""SELECT CASE WHEN YEAR_MONTH <= 199912 THEN 'pre_covid' ELSE 'covid' END
        AS time_period, {_TOTALS} FROM rx_fact GROUP BY 1""",
)

# --- joins and aggregations ---------------------------------------------------------

_oracle(
    j1_join_time=f"""SELECT FINANCIAL_YEAR, FINANCIAL_QUARTER, {_TOTALS}
        FROM rx_fact JOIN rx_time USING (YEAR_MONTH) GROUP BY 1, 2""",
    j2_join_organisation=f"""SELECT PRESC_TYPE_PRNT, PRESC_ID_PRNT, {_TOTALS} FROM rx_fact f
        JOIN rx_org o ON f.PRESC_TYPE_PRNT = o.LVL_5_OUPDT AND f.PRESC_ID_PRNT = o.LVL_5_OU
        GROUP BY 1, 2""",
    j3_join_drug_by_month=f"""SELECT f.YEAR_MONTH, BNF_SECTION, SECTION_DESCR, {_TOTALS} FROM rx_fact f
        JOIN rx_drug d ON f.CALC_PREC_DRUG_RECORD_ID = d.RECORD_ID AND f.YEAR_MONTH = d.YEAR_MONTH
        GROUP BY 1, 2, 3""",
    j3_drug_runs="""SELECT RECORD_ID, BNF_SECTION, SECTION_DESCR, min(YEAR_MONTH) AS VALID_FROM,
        max(YEAR_MONTH) AS VALID_TO FROM rx_drug GROUP BY 1, 2, 3
        HAVING count(*) = (SELECT count(*) FROM rx_month)""",
    j4_join_age=f"""SELECT DALL_5YR_BAND, {_TOTALS} FROM rx_fact f JOIN rx_age a
        ON f.CALC_AGE = a.AGE GROUP BY 1""",
    j5_semi_join="""SELECT * FROM quarterly WHERE FINANCIAL_QUARTER IN (SELECT FINANCIAL_QUARTER
        FROM (SELECT DISTINCT FINANCIAL_QUARTER FROM rx_time) q ORDER BY 1 DESC LIMIT 4)""",
    j6_join_calendar="""SELECT m.*, d.DISPENSING_DAYS FROM monthly m
        LEFT JOIN rx_days d ON m.YEAR_MONTH = d.YEAR_MONTH""",
    j8_cross_domains="""SELECT g.*, coalesce(x.ITEM_COUNT, 0) AS ITEM_COUNT FROM
        (SELECT * FROM (SELECT DISTINCT YEAR_MONTH FROM monthly) a,
            (SELECT DISTINCT SECTION_CODE FROM monthly) b,
            (SELECT DISTINCT IDENTIFIED_FLAG FROM monthly) c) g
        LEFT JOIN (SELECT YEAR_MONTH, SECTION_CODE, IDENTIFIED_FLAG,
            CAST(sum(ITEM_COUNT) AS BIGINT) AS ITEM_COUNT FROM monthly GROUP BY 1, 2, 3) x
        USING (YEAR_MONTH, SECTION_CODE, IDENTIFIED_FLAG)""",
    a1_quarterly_totals="SELECT * FROM quarterly",
    a2_monthly_totals="SELECT * FROM monthly",
    a3_model_totals="SELECT * FROM model",
    a4_distinct_patients="""SELECT FINANCIAL_QUARTER, BNF_SECTION, IDENTIFIED_FLAG,
        CASE WHEN IDENTIFIED_FLAG = 'Y' THEN count(DISTINCT IDENTIFIED_PATIENT_ID)
            + max(CASE WHEN IDENTIFIED_PATIENT_ID IS NULL THEN 1 ELSE 0 END) ELSE 0 END AS PATIENT_COUNT
        FROM joined GROUP BY 1, 2, 3""",
    a5_section_months="""SELECT YEAR_MONTH, SECTION_NAME, SECTION_CODE,
        CAST(sum(ITEM_COUNT) AS BIGINT) AS ITEM_COUNT,
        round(sum(ITEM_PAY_DR_NIC), 2) AS ITEM_PAY_DR_NIC,
        CAST(sum(PATIENT_COUNT) AS BIGINT) AS PATIENT_COUNT FROM monthly GROUP BY 1, 2, 3""",
    a6_band_totals=f"""SELECT YEAR_MONTH, SECTION_CODE, IDENTIFIED_FLAG, PDS_GENDER,
        {_band20('DALL_5YR_BAND')} AS BAND_20YR, CAST(sum(ITEM_COUNT) AS BIGINT) AS ITEM_COUNT,
        round(sum(ITEM_PAY_DR_NIC), 2) AS ITEM_PAY_DR_NIC FROM model GROUP BY 1, 2, 3, 4, 5""",
    a9_filtered_totals="""SELECT SECTION_CODE,
        CAST(sum(CASE WHEN FINANCIAL_QUARTER = '2001/2002 Q1' THEN ITEM_COUNT ELSE 0 END) AS BIGINT)
            AS items_now,
        CAST(sum(CASE WHEN FINANCIAL_QUARTER = '2001/2002 Q1' THEN PATIENT_COUNT ELSE 0 END) AS BIGINT)
            AS patients_now,
        CAST(0 AS BIGINT) AS items_never FROM quarterly GROUP BY 1""",
    a10_filtered_means="""SELECT SECTION_CODE, round(avg(CASE WHEN IDENTIFIED_FLAG = 'Y'
            AND YEAR_MONTH BETWEEN 200007 AND 200106 THEN PATIENT_COUNT END), 8) AS mean_patients,
        CAST(NULL AS DOUBLE) AS mean_never FROM monthly GROUP BY 1""",
    a11_global_maximum="SELECT max(YEAR_MONTH) AS max_month, min(YEAR_MONTH) AS min_month FROM rx_fact",
    a12_month_list_ends="""SELECT 200009 AS first_now, 200108 AS last_now, 199909 AS first_before,
        200008 AS last_before FROM rx_fact HAVING max(YEAR_MONTH) = 200108""",
    a13_quarter_totals="""SELECT FINANCIAL_QUARTER, SECTION_NAME, SECTION_CODE,
        CAST(sum(ITEM_COUNT) AS BIGINT) AS ITEM_COUNT,
        CAST(sum(PATIENT_COUNT) AS BIGINT) AS PATIENT_COUNT FROM quarterly GROUP BY 1, 2, 3""",
)
ORACLE["j3_join_drug_by_validity"] = ORACLE["j3_join_drug_by_month"]

# --- windows, sorts, sets --------------------------------------------------------------

_STEPS["section_months"] = """
SELECT YEAR_MONTH, SECTION_NAME, SECTION_CODE, CAST(sum(ITEM_COUNT) AS BIGINT) AS ITEM_COUNT,
       round(sum(ITEM_PAY_DR_NIC), 2) AS ITEM_PAY_DR_NIC,
       CAST(sum(PATIENT_COUNT) AS BIGINT) AS PATIENT_COUNT,
       CAST(row_number() OVER (PARTITION BY SECTION_CODE ORDER BY YEAR_MONTH) AS INT) AS MONTH_INDEX
FROM monthly GROUP BY 1, 2, 3
"""

_oracle(
    w1_period_counts="""SELECT *, CAST(count(*) OVER (PARTITION BY FINANCIAL_QUARTER) AS INT) AS Q_COUNT,
        CAST(count(*) OVER (PARTITION BY FINANCIAL_YEAR) AS INT) AS FY_COUNT FROM rx_time""",
    w2_latest_complete_quarter="""SELECT max(YEAR_MONTH) AS YEAR_MONTH, FINANCIAL_QUARTER FROM rx_time
        GROUP BY 2 HAVING count(*) = 3 ORDER BY 1 DESC LIMIT 1""",
    w3_month_index="""SELECT YEAR_MONTH, SECTION_NAME, SECTION_CODE, ITEM_COUNT, MONTH_INDEX
        FROM section_months""",
    w4_top_quarters="SELECT DISTINCT FINANCIAL_QUARTER FROM quarterly ORDER BY 1 DESC LIMIT 4",
    w5_latest_quarter="""SELECT YEAR_MONTH, FINANCIAL_QUARTER FROM rx_time
        WHERE YEAR_MONTH = (SELECT max(YEAR_MONTH) FROM monthly)""",
    o1_published_sort="""SELECT *, CAST(row_number() OVER (PARTITION BY FINANCIAL_YEAR, FINANCIAL_QUARTER
            ORDER BY SECTION_CODE, IDENTIFIED_FLAG DESC) AS INT) AS place FROM quarterly""",
    u1_union_sections="SELECT * FROM monthly",
)

# --- reshape ------------------------------------------------------------------------------

def _quarter_labels() -> list[str]:
    """Fiscal quarters of the orders: January 1995 to August 2001."""
    out = []
    for month in range(0, 80, 3):
        year, quarter = divmod(month // 3 + 3, 4)
        out.append(f"{1994 + year}/{1995 + year} Q{quarter + 1}")
    return out


def _wide(value: str, quarters: list[str]) -> str:
    return ",\n".join(
        f"max(CASE WHEN FINANCIAL_QUARTER = '{q}' THEN {value} END) AS \"{q}\"" for q in quarters
    )


def _by_flag(measure: str, cast: str = "BIGINT") -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN IDENTIFIED_FLAG = '{flag}' THEN {measure} END) AS {cast}) AS {measure}_{flag}"
        for flag in "YN"
    )


def _complete(source: str, band: str) -> str:
    """Every band, flag and gender of the source for each month and section."""
    keys = f"YEAR_MONTH, SECTION_NAME, SECTION_CODE, {band}, IDENTIFIED_FLAG, PDS_GENDER"
    return f"""
SELECT {keys}, coalesce(i, 0) AS ITEM_COUNT, round(coalesce(p, 0), 2) AS ITEM_PAY_DR_NIC
FROM (SELECT * FROM (SELECT DISTINCT YEAR_MONTH, SECTION_NAME, SECTION_CODE FROM {source}) a,
    (SELECT DISTINCT {band} FROM {source}) b, (SELECT DISTINCT IDENTIFIED_FLAG FROM {source}) c,
    (SELECT DISTINCT PDS_GENDER FROM {source}) d) g
LEFT JOIN (SELECT {keys}, CAST(sum(ITEM_COUNT) AS BIGINT) AS i, sum(ITEM_PAY_DR_NIC) AS p
    FROM {source} GROUP BY {keys}) s USING ({keys})"""


_STEPS["model20"] = f"SELECT *, {_band20('DALL_5YR_BAND')} AS BAND_20YR FROM model"
_STEPS["full5"] = _complete("model", "DALL_5YR_BAND")
_STEPS["full20"] = _complete("model20", "BAND_20YR")


def _dated(source: str) -> str:
    return f"""SELECT s.*, concat(CAST(s.YEAR_MONTH // 100 AS STRING), '-',
           lpad(CAST(s.YEAR_MONTH % 100 AS STRING), 2, '0'), '-01') AS MONTH_START,
       s.YEAR_MONTH % 100 AS MONTH_NUM,
       CAST((s.YEAR_MONTH // 100 - 1995) * 12 + s.YEAR_MONTH % 100 AS INT) AS MONTH_INDEX,
       d.DISPENSING_DAYS FROM {source} s LEFT JOIN rx_days d ON s.YEAR_MONTH = d.YEAR_MONTH"""


_MONTH_FLAGS = ", ".join(f"CAST(MONTH_NUM = {k} AS INT)::DOUBLE AS m_{k:02d}" for k in range(1, 13))
_STEPS["known5"] = f"SELECT * FROM full5 WHERE {_KNOWN} AND DALL_5YR_BAND <> 'Unknown'"
_STEPS["known20"] = f"SELECT * FROM full20 WHERE {_KNOWN} AND BAND_20YR <> 'Unknown'"
_STEPS["known_both"] = f"""
SELECT YEAR_MONTH, SECTION_NAME, SECTION_CODE, IDENTIFIED_FLAG, PDS_GENDER, DALL_5YR_BAND, BAND_20YR,
       CAST(sum(ITEM_COUNT) AS BIGINT) AS ITEM_COUNT, round(sum(ITEM_PAY_DR_NIC), 2) AS ITEM_PAY_DR_NIC
FROM model20 WHERE {_KNOWN} AND BAND_20YR <> 'Unknown' GROUP BY 1, 2, 3, 4, 5, 6, 7
"""
_STEPS["input5"] = _dated("known5")
_STEPS["input20"] = _dated("known20")
_STEPS["input_both"] = _dated("known_both")

_oracle(
    a7_actual_totals="""SELECT YEAR_MONTH, SECTION_CODE, CAST(sum(ITEM_COUNT) AS BIGINT) AS total_items
        FROM input20 GROUP BY 1, 2""",
    t1_flags_to_columns=f"""SELECT FINANCIAL_QUARTER, SECTION_CODE, {_by_flag('ITEM_COUNT')},
        {_by_flag('ITEM_PAY_DR_NIC', 'DOUBLE')}, {_by_flag('PATIENT_COUNT')} FROM quarterly GROUP BY 1, 2""",
    t2_quarters_to_columns=f"""SELECT SECTION_CODE, {_wide('ITEM_COUNT', _quarter_labels())}
        FROM quarterly WHERE IDENTIFIED_FLAG = 'Y' GROUP BY 1""",
    t3_measures_to_rows="""SELECT YEAR_MONTH, SECTION_CODE, IDENTIFIED_FLAG, 'ITEM_COUNT' AS measure,
            ITEM_COUNT AS value FROM monthly
        UNION ALL SELECT YEAR_MONTH, SECTION_CODE, IDENTIFIED_FLAG, 'PATIENT_COUNT', PATIENT_COUNT
        FROM monthly""",
    t4_complete_5yr="SELECT * FROM full5",
    t5_month_flags=f"""SELECT YEAR_MONTH, CAST(ITEM_COUNT AS BIGINT) AS ITEM_COUNT, MONTH_NUM, {_MONTH_FLAGS}
        FROM (SELECT YEAR_MONTH, YEAR_MONTH % 100 AS MONTH_NUM, sum(ITEM_COUNT) AS ITEM_COUNT
              FROM monthly GROUP BY 1, 2) s""",
)

# --- scalar functions -------------------------------------------------------------------------

_STEPS["order_day"] = "SELECT CAST(o_orderdate AS DATE) AS d FROM orders"
_FISCAL_END = "CAST(year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS INT)"
_FISCAL_Q = "CAST(((month(d) + 8) % 12) // 3 + 1 AS INT)"


def _signif(x: str) -> str:
    """Three significant figures, halves to even."""
    k = f"CAST(floor(log10(abs({x}::DOUBLE))) AS INT) - 2"
    return f"""CASE WHEN {x} = 0 THEN 0.0 WHEN {k} >= 0
        THEN sign({x}) * round_even(abs({x}::DOUBLE) / pow(10.0, {k}), 0)::DOUBLE * pow(10.0, {k})
        ELSE sign({x}) * round_even(abs({x}::DOUBLE) * pow(10.0, -({k})), 0)::DOUBLE
            / pow(10.0, -({k})) END"""


def _shown(x: str) -> str:
    """Display text of a value already rounded to three figures."""
    steps = "".join(
        f" WHEN abs({x}) >= {size} THEN format('{{:,.{places}f}}', {x})"
        for size, places in ((100, 0), *((10.0 ** (2 - k), k) for k in range(1, 15)))
    )
    return f"CASE WHEN {x} = 0 THEN '0'{steps} ELSE format('{{:,.16f}}', {x}) END"


def _shift(months: int) -> str:
    step = f"+ INTERVAL {months} MONTH" if months > 0 else f"- INTERVAL {-months} MONTH"
    return f"CAST(CAST(d {step} AS DATE) AS STRING)"


# Display names by section code.
_TEXT_NAME = """CASE SECTION_CODE WHEN '0401' THEN 'hypnotics and anxiolytics'
    WHEN '0402' THEN 'antipsychotic items' WHEN '0403' THEN 'antidepressant drug items'
    WHEN '0404' THEN 'CNS stimulants and drugs used for ADHD items' ELSE 'drugs for dementia' END"""
_ITEM_NAME = """CASE SECTION_CODE WHEN '0401' THEN 'hypnotic and anxiolytic item'
    WHEN '0402' THEN 'antipsychotic drug item' WHEN '0403' THEN 'antidepressant drug item'
    WHEN '0404' THEN 'CNS stimulants and drugs used for ADHD item' ELSE 'drug for dementia item' END"""

_oracle(
    d1_month_start=f"""SELECT concat(CAST(YEAR_MONTH // 100 AS STRING), '-',
        lpad(CAST(YEAR_MONTH % 100 AS STRING), 2, '0'), '-01') AS MONTH_START, {_TOTALS}
        FROM rx_fact GROUP BY 1""",
    d2_month_number="SELECT CAST(month(d) AS INT) AS MONTH_NUM, count(*) AS n FROM order_day GROUP BY 1",
    d3_month_index=f"""SELECT CAST(date_diff('month', DATE '1994-12-01',
            make_date(YEAR_MONTH // 100, YEAR_MONTH % 100, 1)) AS INT) AS MONTH_INDEX, {_TOTALS}
        FROM rx_fact GROUP BY 1""",
    d4_month_arithmetic=f"""SELECT CAST(d AS STRING) AS d, {_shift(-1)} AS minus_1, {_shift(-3)} AS minus_3,
        {_shift(-12)} AS minus_12, {_shift(-60)} AS minus_60, {_shift(1)} AS plus_1, count(*) AS n
        FROM order_day GROUP BY ALL""",
    d5_fiscal_parts=f'SELECT {_FISCAL_Q} AS quarter, {_FISCAL_END} AS "year", count(*) AS n '
    "FROM order_day GROUP BY 1, 2",
    d6_fiscal_labels=f"""SELECT concat({_FISCAL_END} - 1, '/', {_FISCAL_END}, ' Q', {_FISCAL_Q}) AS label,
        concat({_FISCAL_END} - 1, '/', {_FISCAL_END}) AS year_label, count(*) AS n
        FROM order_day GROUP BY 1, 2""",
    d7_year_month="""SELECT CAST(year(d) * 100 + month(d) AS INT) AS YEAR_MONTH, count(*) AS n
        FROM order_day GROUP BY 1""",
    d8_month_name="SELECT strftime(d, '%B %Y') AS name, count(*) AS n FROM order_day GROUP BY 1",
    c1_patient_indicator=f"""SELECT IDENTIFIED_FLAG,
        CASE IDENTIFIED_FLAG WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS indicator, {_TOTALS}
        FROM rx_fact GROUP BY 1, 2""",
    c2_gender_letter=f"""SELECT CASE PDS_GENDER WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'U' END AS gender,
        {_TOTALS} FROM rx_fact GROUP BY 1""",
    c3_known_band=f"""SELECT coalesce(DALL_5YR_BAND, 'Unknown') AS band, {_TOTALS}
        FROM rx_fact f JOIN rx_age a ON f.CALC_AGE = a.AGE GROUP BY 1""",
    c4_twenty_year_band=f"""SELECT CASE WHEN CALC_AGE < 0 THEN 'Unknown' WHEN CALC_AGE < 20 THEN '00-19'
        WHEN CALC_AGE < 40 THEN '20-39' WHEN CALC_AGE < 60 THEN '40-59' WHEN CALC_AGE < 80 THEN '60-79'
        ELSE '80+' END AS band, {_TOTALS} FROM rx_fact GROUP BY 1""",
    c5_pounds="""SELECT YEAR_MONTH, CAST(sum(ITEM_PAY_DR_NIC) AS DOUBLE) / 100 AS pounds
        FROM rx_fact GROUP BY 1""",
    c6_rate_text="""SELECT FINANCIAL_QUARTER, SECTION_CODE,
        printf('%.1f%%', round_even(RATE, 1)::DOUBLE) AS RATE FROM rates""",
    c7_rate_number="SELECT FINANCIAL_QUARTER, SECTION_CODE, round(RATE, 8) AS RATE FROM rates",
    c8_c9_changes="""SELECT SECTION_CODE, "now", before,
        round(100.0 * ("now" - before)::DOUBLE / before::DOUBLE, 8) AS percent,
        "now" - before AS absolute, CAST(NULL AS DOUBLE) AS no_base
        FROM (SELECT SECTION_CODE,
            CAST(sum(CASE WHEN FINANCIAL_QUARTER = '2001/2002 Q1' THEN ITEM_COUNT ELSE 0 END) AS BIGINT)
                AS "now",
            CAST(sum(CASE WHEN FINANCIAL_QUARTER = '2000/2001 Q1' THEN ITEM_COUNT ELSE 0 END) AS BIGINT)
                AS before FROM quarterly GROUP BY 1) s""",
    c10_three_figures=f"""SELECT CALC_PREC_DRUG_RECORD_ID, pence, {_signif('pence')} AS pence_3,
        {_signif('(-pence)')} AS negative_3
        FROM (SELECT CALC_PREC_DRUG_RECORD_ID, CAST(sum(ITEM_PAY_DR_NIC) AS BIGINT) AS pence
              FROM rx_fact GROUP BY 1) s""",
    c11_display_text=f"""SELECT CALC_PREC_DRUG_RECORD_ID, {_shown('a')} AS shown,
        concat({_shown('b')}, '%') AS shown_percent
        FROM (SELECT CALC_PREC_DRUG_RECORD_ID, {_signif('pence')} AS a, {_signif('part')} AS b
              FROM (SELECT CALC_PREC_DRUG_RECORD_ID, CAST(sum(ITEM_PAY_DR_NIC) AS BIGINT) AS pence,
                        100.0 * (sum(ITEM_PAY_DR_NIC)::DOUBLE / 100000000.0) AS part
                    FROM rx_fact GROUP BY 1) s) q""",
    c12_month_text=f"""SELECT CAST(YEAR_MONTH AS STRING) AS YEAR_MONTH_string, {_TOTALS}
        FROM rx_fact GROUP BY 1""",
    c13_display_names=f"""SELECT DISTINCT SECTION_CODE, {_TEXT_NAME} AS in_text,
        {_ITEM_NAME} AS before_item, '' AS unlisted FROM quarterly""",
    c14_period_range="""SELECT 'September 2000 to August 2001' AS year_range,
        '1996/1997 Q2 to 2001/2002 Q2' AS quarter_range FROM rx_fact HAVING max(YEAR_MONTH) = 200108""",
)

# --- regression -----------------------------------------------------------------------------
#
# The published design is balanced: each training month holds every gender and
# band once. Calendar terms and cells are then orthogonal, and the fit follows
# from month means, cell means and a two-by-two system.

_STEPS["train"] = "SELECT *, ITEM_COUNT::DOUBLE AS y FROM input20 WHERE YEAR_MONTH <= 199912"
_STEPS["month_mean"] = """
SELECT SECTION_CODE, YEAR_MONTH, MONTH_NUM, MONTH_INDEX::DOUBLE AS z1, DISPENSING_DAYS::DOUBLE AS z2,
       avg(y) AS ybar, count(*)::DOUBLE AS cells FROM train GROUP BY 1, 2, 3, 4, 5
"""
_STEPS["season"] = """
SELECT SECTION_CODE, MONTH_NUM, avg(ybar) AS mu, avg(z1) AS z1m, avg(z2) AS z2m,
       count(*)::DOUBLE AS years FROM month_mean GROUP BY 1, 2
"""
_STEPS["sums_z"] = """
SELECT SECTION_CODE, sum((z1 - z1m) ^ 2) AS s11, sum((z1 - z1m) * (z2 - z2m)) AS s12,
       sum((z2 - z2m) ^ 2) AS s22, sum((z1 - z1m) * (ybar - mu)) AS s1y,
       sum((z2 - z2m) * (ybar - mu)) AS s2y, max(cells) AS c, count(*)::DOUBLE AS t
FROM month_mean JOIN season USING (SECTION_CODE, MONTH_NUM) GROUP BY 1
"""
_STEPS["trend_fit"] = """
SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
       (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM sums_z
"""
_STEPS["cell_mean"] = """
SELECT SECTION_CODE, PDS_GENDER, BAND_20YR, avg(y) AS ycell FROM train GROUP BY 1, 2, 3
"""
_STEPS["grand"] = """
SELECT SECTION_CODE, avg(y) AS g, count(*)::DOUBLE AS n,
       count(DISTINCT MONTH_NUM) + count(DISTINCT concat(PDS_GENDER, BAND_20YR)) + 1 AS p
FROM train GROUP BY 1
"""
_STEPS["fitted_row"] = """
SELECT r.*, ycell - g + mu + b1 * (MONTH_INDEX - z1m) + b2 * (DISPENSING_DAYS - z2m) AS fitted,
       (1 / years + (s22 * (MONTH_INDEX - z1m) ^ 2 - 2 * s12 * (MONTH_INDEX - z1m) * (DISPENSING_DAYS - z2m)
           + s11 * (DISPENSING_DAYS - z2m) ^ 2) / det) / c + (1 - 1 / c) / t AS leverage, g, n, p
FROM train r JOIN cell_mean USING (SECTION_CODE, PDS_GENDER, BAND_20YR)
JOIN season USING (SECTION_CODE, MONTH_NUM) JOIN trend_fit USING (SECTION_CODE) JOIN grand USING (SECTION_CODE)
"""
_STEPS["fit_stat"] = """
SELECT SECTION_CODE, max(n) AS n, max(p) AS p, sum((y - fitted) ^ 2) AS rss, sum((y - g) ^ 2) AS tss,
       sum((y - fitted) ^ 2) / (max(n) - max(p)) AS s2, max(n) - max(p) AS v
FROM fitted_row GROUP BY 1
"""


def _t_quantile(z: str) -> str:
    """Student quantile from the normal one, in powers of one over the degrees of freedom."""
    return f"""({z} + ({z}^3 + {z}) / (4 * v) + (5 * {z}^5 + 16 * {z}^3 + 3 * {z}) / (96 * v^2)
        + (3 * {z}^7 + 19 * {z}^5 + 17 * {z}^3 - 15 * {z}) / (384 * v^3)
        + (79 * {z}^9 + 776 * {z}^7 + 1482 * {z}^5 - 1920 * {z}^3 - 945 * {z}) / (92160 * v^4))"""


def _tail(density: str, angle: str, steps: int = 4000) -> str:
    """Share of a density over 0 to pi/2 that lies above an angle, by Simpson's rule.

    With tan(x)^2 = t^2 / v, Student's t has the density cos(x)^(v-1), both tails together; with
    tan(x)^2 = d1 F / d2, the F distribution has sin(x)^(d1-1) cos(x)^(d2-1).
    """
    def area(low: str) -> str:
        place = f"({low} + (pi() / 2 - {low}) * i / {steps})"
        weight = f"CASE WHEN i IN (0, {steps}) THEN 1 ELSE 2 + 2 * (i % 2) END"
        values = f"list_transform(range({steps} + 1), lambda i: {weight} * {density.format(x=place)})"
        return f"list_sum({values}) * (pi() / 2 - {low})"

    return f"({area(angle)}) / ({area('0.0')})"


_Z95, _Z99 = "1.959963984540054::DOUBLE", "2.5758293035489004::DOUBLE"
_STEPS["t_value"] = f"""
SELECT SECTION_CODE, {_t_quantile(_Z95)} AS q95, {_t_quantile(_Z99)} AS q99 FROM fit_stat
"""
_STEPS["expected_month"] = """
SELECT SECTION_CODE, YEAR_MONTH, m * (mu + b1 * d1 + b2 * d2) AS mean_fit,
       m ^ 2 / c * s2 * (1 / years + (s22 * d1 ^ 2 - 2 * s12 * d1 * d2 + s11 * d2 ^ 2) / det) AS var,
       s2 * m AS noise
FROM (SELECT SECTION_CODE, YEAR_MONTH, MONTH_NUM, MONTH_INDEX AS z1, DISPENSING_DAYS AS z2,
          count(*)::DOUBLE AS m FROM input20 WHERE YEAR_MONTH BETWEEN 200001 AND 200106
      GROUP BY 1, 2, 3, 4, 5) a
JOIN season USING (SECTION_CODE, MONTH_NUM) JOIN trend_fit USING (SECTION_CODE)
JOIN fit_stat USING (SECTION_CODE), LATERAL (SELECT z1 - z1m AS d1, z2 - z2m AS d2) l
"""
_STEPS["predicted"] = """
SELECT SECTION_CODE, YEAR_MONTH, mean_fit, var,
       mean_fit - q95 * sqrt(var + noise) AS PIlwr, mean_fit + q95 * sqrt(var + noise) AS PIupr,
       mean_fit - q99 * sqrt(var + noise) AS PIlwr99, mean_fit + q99 * sqrt(var + noise) AS PIupr99
FROM expected_month JOIN t_value USING (SECTION_CODE)
"""
_STEPS["actual_expected"] = """
SELECT a.*, p.* EXCLUDE (SECTION_CODE, YEAR_MONTH), CAST(a.YEAR_MONTH AS STRING) AS YEAR_MONTH_string
FROM (SELECT YEAR_MONTH, SECTION_CODE, CAST(sum(ITEM_COUNT) AS BIGINT) AS total_items
      FROM input20 GROUP BY 1, 2) a
LEFT JOIN predicted p ON a.SECTION_CODE = p.SECTION_CODE AND a.YEAR_MONTH = p.YEAR_MONTH
"""
_ROUNDED_PREDICTIONS = """round(mean_fit, 5) AS mean_fit, round(var, 4) AS var, round(PIlwr, 5) AS PIlwr,
    round(PIupr, 5) AS PIupr, round(PIlwr99, 5) AS PIlwr99, round(PIupr99, 5) AS PIupr99"""

# Item-grain cells: saturated gender by band.
_STEPS["person"] = f"""
SELECT BNF_SECTION, YEAR_MONTH, GENDER, {_band20('BAND5')} AS BAND, ITEM_COUNT::DOUBLE AS y,
       ITEM_PAY_DR_NIC / 100.0::DOUBLE AS price FROM people WHERE GENDER <> 'U' AND BAND5 <> 'Unknown'
"""
_STEPS["person_cell"] = """
SELECT BNF_SECTION, GENDER, BAND, count(*)::DOUBLE AS n, avg(y) AS m, avg(price) AS mp
FROM person GROUP BY 1, 2, 3
"""
_STEPS["person_stat"] = """
SELECT BNF_SECTION, sum((y - m) ^ 2) / (count(*) - count(DISTINCT concat(GENDER, BAND))) AS s2,
       (count(*) - count(DISTINCT concat(GENDER, BAND)))::DOUBLE AS v
FROM person JOIN person_cell USING (BNF_SECTION, GENDER, BAND) GROUP BY 1
"""

_MONTH_TERM = """SELECT SECTION_CODE, concat('MONTH_NUM[', CAST(s.MONTH_NUM AS STRING), ']') AS term,
    s.mu - b1 * s.z1m - b2 * s.z2m - (f.mu - b1 * f.z1m - b2 * f.z2m) AS estimate,
    s2 / c * (1 / s.years + 1 / f.years + (s22 * (s.z1m - f.z1m) ^ 2
        - 2 * s12 * (s.z1m - f.z1m) * (s.z2m - f.z2m) + s11 * (s.z2m - f.z2m) ^ 2) / det) AS variance
    FROM season s JOIN season f USING (SECTION_CODE) JOIN trend_fit USING (SECTION_CODE)
    JOIN fit_stat USING (SECTION_CODE) WHERE s.MONTH_NUM > 1 AND f.MONTH_NUM = 1"""
_STEPS["coefficient"] = f"""
SELECT SECTION_CODE, '(Intercept)' AS term, ycell - g + mu - b1 * z1m - b2 * z2m AS estimate,
    s2 * ((1 - 1 / c) / t + (1 / years + (s22 * z1m ^ 2 - 2 * s12 * z1m * z2m + s11 * z2m ^ 2) / det) / c)
        AS variance
FROM season JOIN trend_fit USING (SECTION_CODE) JOIN fit_stat USING (SECTION_CODE)
    JOIN cell_mean USING (SECTION_CODE) JOIN grand USING (SECTION_CODE)
WHERE MONTH_NUM = 1 AND PDS_GENDER = 'F' AND BAND_20YR = '00-19'
UNION ALL SELECT SECTION_CODE, 'MONTH_INDEX', b1, s2 / c * s22 / det FROM trend_fit JOIN fit_stat USING (SECTION_CODE)
UNION ALL SELECT SECTION_CODE, 'DISPENSING_DAYS', b2, s2 / c * s11 / det
    FROM trend_fit JOIN fit_stat USING (SECTION_CODE)
UNION ALL {_MONTH_TERM}
UNION ALL SELECT SECTION_CODE, 'PDS_GENDER[M]', m.ycell - f.ycell, 2 * s2 / t
    FROM cell_mean m JOIN cell_mean f USING (SECTION_CODE, BAND_20YR) JOIN trend_fit USING (SECTION_CODE)
    JOIN fit_stat USING (SECTION_CODE)
    WHERE m.PDS_GENDER = 'M' AND f.PDS_GENDER = 'F' AND BAND_20YR = '00-19'
UNION ALL SELECT SECTION_CODE, concat('BAND_20YR[', m.BAND_20YR, ']'), m.ycell - f.ycell, 2 * s2 / t
    FROM cell_mean m JOIN cell_mean f USING (SECTION_CODE, PDS_GENDER) JOIN trend_fit USING (SECTION_CODE)
    JOIN fit_stat USING (SECTION_CODE)
    WHERE PDS_GENDER = 'F' AND f.BAND_20YR = '00-19' AND m.BAND_20YR > '00-19'
UNION ALL SELECT SECTION_CODE, concat('PDS_GENDER[M]:BAND_20YR[', d.BAND_20YR, ']'), d.d - b.d, 4 * s2 / t
    FROM (SELECT SECTION_CODE, BAND_20YR, max(CASE WHEN PDS_GENDER = 'M' THEN ycell END)
            - max(CASE WHEN PDS_GENDER = 'F' THEN ycell END) AS d FROM cell_mean GROUP BY 1, 2) d
    JOIN (SELECT SECTION_CODE, max(CASE WHEN PDS_GENDER = 'M' THEN ycell END)
            - max(CASE WHEN PDS_GENDER = 'F' THEN ycell END) AS d FROM cell_mean
          WHERE BAND_20YR = '00-19' GROUP BY 1) b USING (SECTION_CODE)
    JOIN trend_fit USING (SECTION_CODE) JOIN fit_stat USING (SECTION_CODE) WHERE d.BAND_20YR > '00-19'
"""
_STEPS["nested_row"] = """
SELECT r.SECTION_CODE, y, g, mu, DISPENSING_DAYS - z2m AS d2, b1 * (MONTH_INDEX - z1m)
    + b2 * (DISPENSING_DAYS - z2m) AS trend, s2y / s22 AS b_days, ycell - g AS e_cell,
    avg(y) OVER (PARTITION BY r.SECTION_CODE, BAND_20YR) - g AS e_band,
    avg(y) OVER (PARTITION BY r.SECTION_CODE, PDS_GENDER) - g AS e_gender,
    regr_slope(y, DISPENSING_DAYS) OVER (PARTITION BY r.SECTION_CODE) AS k1,
    regr_intercept(y, DISPENSING_DAYS) OVER (PARTITION BY r.SECTION_CODE) AS k0, DISPENSING_DAYS AS days
FROM train r JOIN cell_mean USING (SECTION_CODE, PDS_GENDER, BAND_20YR)
JOIN season USING (SECTION_CODE, MONTH_NUM) JOIN trend_fit USING (SECTION_CODE) JOIN grand USING (SECTION_CODE)
"""
_STEPS["nested"] = """
SELECT SECTION_CODE, 'm0_days' AS MODEL, sum((y - k0 - k1 * days) ^ 2) AS rss, 2 AS p, count(*) AS n
    FROM nested_row GROUP BY 1
UNION ALL SELECT SECTION_CODE, 'm1_season', sum((y - mu - b_days * d2) ^ 2), 13, count(*) FROM nested_row GROUP BY 1
UNION ALL SELECT SECTION_CODE, 'm2_trend', sum((y - mu - trend) ^ 2), 14, count(*) FROM nested_row GROUP BY 1
UNION ALL SELECT SECTION_CODE, 'm3_band', sum((y - mu - trend - e_band) ^ 2), 18, count(*) FROM nested_row GROUP BY 1
UNION ALL SELECT SECTION_CODE, 'm4_gender', sum((y - mu - trend - e_gender) ^ 2), 15, count(*) FROM nested_row GROUP BY 1
UNION ALL SELECT SECTION_CODE, 'm5_both', sum((y - mu - trend - e_band - e_gender) ^ 2), 19, count(*)
    FROM nested_row GROUP BY 1
UNION ALL SELECT SECTION_CODE, 'm6_crossed', sum((y - mu - trend - e_cell) ^ 2), 23, count(*) FROM nested_row GROUP BY 1
"""
_AIC = "n * (ln(2 * pi() * rss / n) + 1) + 2 * (p + 1)"


def _ranked(source: str, decimals: int) -> str:
    return f"""SELECT MODEL, SECTION_CODE, round({_AIC}, {decimals}) AS aic,
        CAST(p - 1 AS BIGINT) AS df, n AS nobs,
        CAST(row_number() OVER (PARTITION BY SECTION_CODE ORDER BY {_AIC}, MODEL) AS INT) AS aic_rank
        FROM {source}"""


# Unbalanced designs: normal equations in long form, eliminated column by column.
_MONTH_DUMMIES = [f"CAST(MONTH_NUM = {k} AS INT)" for k in range(2, 13)]
_BANDS5 = [f"{a:02d}-{a + 4:02d}" for a in range(5, 90, 5)] + ["90+"]
_BANDS20 = ["20-39", "40-59", "60-79", "80+"]


def _design(band: str, levels: list[str]) -> str:
    cells = [f"CAST({band} = '{level}' AS INT)" for level in levels]
    male = "CAST(PDS_GENDER = 'M' AS INT)"
    terms = ["1", "MONTH_INDEX", "DISPENSING_DAYS", *_MONTH_DUMMIES, male, *cells]
    terms += [f"{male} * {cell}" for cell in cells] + ["ITEM_COUNT"]
    return "[" + ", ".join(f"({term})::DOUBLE" for term in terms) + "]"


_STEPS["band_design"] = f"""
SELECT SECTION_CODE, 'bands_5yr' AS MODEL, {_design('DALL_5YR_BAND', _BANDS5)} AS x
    FROM input_both WHERE YEAR_MONTH <= 199912
UNION ALL SELECT SECTION_CODE, 'bands_20yr', {_design('BAND_20YR', _BANDS20)}
    FROM input_both WHERE YEAR_MONTH <= 199912
"""
_STEPS["band_pairs"] = """
SELECT SECTION_CODE, MODEL, i, j, sum(x[i] * x[j]) AS v, count(*) AS n
FROM band_design, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) a,
    LATERAL (SELECT unnest(range(1, len(x) + 1)) AS j) b GROUP BY 1, 2, 3, 4
"""
_STEPS["band_matrix"] = """
SELECT SECTION_CODE, MODEL, list(line ORDER BY i) AS mat, max(n) AS n
FROM (SELECT SECTION_CODE, MODEL, i, list(v ORDER BY j) AS line, max(n) AS n FROM band_pairs
      GROUP BY 1, 2, 3) s GROUP BY 1, 2
"""
_STEPS["band_sweep"] = """/*RECURSIVE*/
SELECT SECTION_CODE, MODEL, n, CAST(1 AS BIGINT) AS k, mat FROM band_matrix
UNION ALL
SELECT SECTION_CODE, MODEL, n, k + 1,
    list_transform(mat, lambda line, i: CASE WHEN i <= k THEN line
        ELSE list_transform(line, lambda w, j: w - line[k] * mat[k][j] / mat[k][k]) END)
FROM band_sweep WHERE k < len(mat)
"""
_STEPS["band_fit"] = """
SELECT SECTION_CODE, MODEL, n, len(mat) - 1 AS p, mat[len(mat)][len(mat)] AS rss
FROM band_sweep WHERE k = len(mat)
"""

_INPUT20 = f"SELECT *, {_MONTH_FLAGS} FROM input20"

_oracle(
    m1_design_terms="""SELECT SECTION_CODE, term, total FROM (
        SELECT SECTION_CODE, '(Intercept)' AS term, count(*)::DOUBLE AS total FROM train GROUP BY 1
        UNION ALL SELECT SECTION_CODE, 'MONTH_INDEX', sum(MONTH_INDEX)::DOUBLE FROM train GROUP BY 1
        UNION ALL SELECT SECTION_CODE, 'DISPENSING_DAYS', sum(DISPENSING_DAYS)::DOUBLE FROM train GROUP BY 1
        UNION ALL SELECT SECTION_CODE, concat('MONTH_NUM[', MONTH_NUM, ']'), count(*) FROM train GROUP BY 1, 2
        UNION ALL SELECT SECTION_CODE, concat('PDS_GENDER[', PDS_GENDER, ']'), count(*) FROM train GROUP BY 1, 2
        UNION ALL SELECT SECTION_CODE, concat('BAND_20YR[', BAND_20YR, ']'), count(*) FROM train GROUP BY 1, 2
        UNION ALL SELECT SECTION_CODE, concat('PDS_GENDER[', PDS_GENDER, ']:BAND_20YR[', BAND_20YR, ']'),
            count(*) FROM train GROUP BY 1, 2) s""",
    m2_simple_fit="""SELECT BNF_SECTION, round(regr_intercept(ITEM_PAY_DR_NIC, ITEM_COUNT), 3) AS intercept,
        round(regr_slope(ITEM_PAY_DR_NIC, ITEM_COUNT), 4) AS slope,
        round(regr_r2(ITEM_PAY_DR_NIC, ITEM_COUNT), 9) AS r_squared, count(*) AS nobs
        FROM joined GROUP BY 1""",
    m2_price_within_cells="""SELECT BNF_SECTION, round(b, 6) AS slope, round(syy - b * sxy, 0) AS deviance, k AS rank
        FROM (SELECT BNF_SECTION, sum((y - m) * (price - mp)) AS sxy, sum((price - mp) ^ 2) AS syy,
                sum((y - m) * (price - mp)) / sum((y - m) ^ 2) AS b,
                count(DISTINCT concat(GENDER, BAND)) + 1 AS k
              FROM person JOIN person_cell USING (BNF_SECTION, GENDER, BAND) GROUP BY 1) s""",
    m3_fit_statistics=f"""SELECT SECTION_CODE, round(1 - rss / tss, 8) AS r_squared,
        round(1 - rss / tss * (n - 1) / v, 8) AS adj_r_squared, round(sqrt(s2), 6) AS sigma,
        round((tss - rss) / (p - 1) / s2, 6) AS statistic, CAST(p - 1 AS BIGINT) AS df,
        round(-n / 2 * (ln(2 * pi() * rss / n) + 1), 6) AS log_lik, round({_AIC}, 6) AS aic,
        round(n * (ln(2 * pi() * rss / n) + 1) + ln(n) * (p + 1), 6) AS bic,
        round(rss, 2) AS deviance, CAST(v AS BIGINT) AS df_resid, CAST(n AS BIGINT) AS nobs,
        round({_tail('sin({x}) ^ (p - 2) * cos({x}) ^ (v - 1)', 'atan(sqrt((tss - rss) / s2 / v))')}, 6) AS statistic_p
        FROM fit_stat""",
    m4_coefficients=f"""SELECT SECTION_CODE, term, round(estimate, 6) AS estimate,
        round(sqrt(variance), 6) AS std_error, round(estimate / sqrt(variance), 6) AS t_value,
        round({_tail('cos({x}) ^ (v - 1)', 'atan(abs(estimate) / sqrt(variance * v))')}, 6) AS p_value
        FROM coefficient JOIN (SELECT SECTION_CODE, v FROM fit_stat) f USING (SECTION_CODE)""",
    m5_nested_by_aic=_ranked("nested", 6),
    m5_bands_by_aic=_ranked("band_fit", 4),
    m6_diagnostics="""SELECT SECTION_CODE, YEAR_MONTH, PDS_GENDER, BAND_20YR, ITEM_COUNT,
        round(fitted, 6) AS fitted, round(y - fitted, 6) AS residual, round(leverage, 9) AS leverage,
        round((y - fitted) / sqrt(s2 * (1 - leverage)), 7) AS std_residual,
        round((y - fitted) ^ 2 * leverage / (f.p * s2 * (1 - leverage) ^ 2), 8) AS cooks_distance
        FROM fitted_row r JOIN fit_stat f USING (SECTION_CODE)""",
    m6_cell_diagnostics="""SELECT BNF_SECTION, GENDER, BAND, CAST(n AS BIGINT) AS n, round(m, 6) AS fitted,
        1.0::DOUBLE AS leverage, 0.0::DOUBLE AS residual FROM person_cell""",
    m7_point_predictions="""SELECT i.SECTION_CODE, YEAR_MONTH, i.PDS_GENDER, i.BAND_20YR,
        round(ycell - g + mu + b1 * (MONTH_INDEX - z1m) + b2 * (DISPENSING_DAYS - z2m), 6) AS fitted
        FROM input20 i JOIN cell_mean USING (SECTION_CODE, PDS_GENDER, BAND_20YR)
        JOIN season USING (SECTION_CODE, MONTH_NUM) JOIN trend_fit USING (SECTION_CODE)
        JOIN grand USING (SECTION_CODE) WHERE YEAR_MONTH BETWEEN 200001 AND 200106""",
    m8_weighted_sums=f"""SELECT BNF_SECTION, YEAR_MONTH, round(mean, 4) AS mean, round(var, 4) AS var,
        round({_t_quantile(_Z95)} * sqrt(var), 5) AS ci95,
        round({_t_quantile(_Z99)} * sqrt(var + s2 * ww), 5) AS pi99
        FROM (SELECT BNF_SECTION, YEAR_MONTH, sum(w * m) AS mean, max(s2) * sum(w ^ 2 / n) AS var,
                sum(ww) AS ww, max(s2) AS s2, max(v) AS v
              FROM (SELECT BNF_SECTION, YEAR_MONTH, GENDER, BAND, sum(y) AS w, sum(y ^ 2) AS ww
                    FROM person GROUP BY 1, 2, 3, 4) a
              JOIN person_cell USING (BNF_SECTION, GENDER, BAND) JOIN person_stat USING (BNF_SECTION)
              GROUP BY 1, 2) s""",
    m9_monthly_expected=f"SELECT SECTION_CODE, YEAR_MONTH, {_ROUNDED_PREDICTIONS} FROM predicted",
    m10_actual_and_expected=f"""SELECT YEAR_MONTH, SECTION_CODE, total_items, {_ROUNDED_PREDICTIONS},
        YEAR_MONTH_string FROM actual_expected""",
    m12_input_20yr=_INPUT20,
    m12_input_5yr=f"SELECT *, {_MONTH_FLAGS} FROM input5",
    m12_input_both="SELECT * FROM input_both",
    m12_input_section="""SELECT s.* EXCLUDE (PATIENT_COUNT),
        concat(CAST(s.YEAR_MONTH // 100 AS STRING), '-',
            lpad(CAST(s.YEAR_MONTH % 100 AS STRING), 2, '0'), '-01') AS MONTH_START,
        s.YEAR_MONTH % 100 AS MONTH_NUM, d.DISPENSING_DAYS
        FROM section_months s LEFT JOIN rx_days d ON s.YEAR_MONTH = d.YEAR_MONTH""",
)

# --- products -----------------------------------------------------------------------------------

_HEAD = """FINANCIAL_YEAR AS "Financial Year", FINANCIAL_QUARTER AS "Financial Quarter", {month}
    SECTION_NAME AS "BNF Section Name", SECTION_CODE AS "BNF Section Code",
    IDENTIFIED_FLAG AS "Identified Patient", PATIENT_COUNT AS "Total Patients",
    ITEM_COUNT AS "Total Items", ITEM_PAY_DR_NIC AS "Total Net Ingredient Cost (GBP)\""""


def _figure(source: str, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{label}' AS measure, {_signif(column)} AS value FROM {source}"
        for label, column in (("Identified patients", "PATIENT_COUNT"), ("Prescribed items", "ITEM_COUNT"))
    )


_STEPS["shown_quarters"] = """
SELECT FINANCIAL_QUARTER, SECTION_NAME, SECTION_CODE, sum(ITEM_COUNT) AS ITEM_COUNT,
       sum(PATIENT_COUNT) AS PATIENT_COUNT
FROM quarterly WHERE FINANCIAL_YEAR NOT IN ('1994/1995', '1995/1996') GROUP BY 1, 2, 3
"""
_STEPS["month_series"] = """
SELECT s.*, concat(CAST(s.YEAR_MONTH // 100 AS STRING), '-',
       lpad(CAST(s.YEAR_MONTH % 100 AS STRING), 2, '0'), '-01') AS MONTH_START,
       s.YEAR_MONTH % 100 AS MONTH_NUM, d.DISPENSING_DAYS
FROM section_months s LEFT JOIN rx_days d ON s.YEAR_MONTH = d.YEAR_MONTH
"""
_STEPS["shown_months"] = "SELECT * FROM month_series WHERE YEAR_MONTH >= 199704"

# Indicators of the release that ends in June 2001: its quarters and months, written out.
_NOW, _LAST, _YEAR, _FIVE = "2001/2002 Q1", "2000/2001 Q4", "2000/2001 Q1", "1996/1997 Q1"


def _in_quarter(column: str, quarter: str, name: str) -> str:
    return f"coalesce(sum(CASE WHEN FINANCIAL_QUARTER = '{quarter}' THEN {column} END), 0)::DOUBLE AS {name}"


_STEPS["section_wide"] = f"""
SELECT * FROM (SELECT SECTION_CODE,
    {', '.join(_in_quarter('ITEM_COUNT', q, f'i{k}') for k, q in enumerate((_NOW, _YEAR, _LAST, _FIVE)))},
    {', '.join(_in_quarter('PATIENT_COUNT', q, f'p{k}') for k, q in enumerate((_NOW, _YEAR, _LAST, _FIVE)))}
    FROM quarterly GROUP BY 1) q
LEFT JOIN (SELECT SECTION_CODE, max(CASE WHEN FINANCIAL_QUARTER = '{_NOW}' THEN RATE END) AS r0,
    max(CASE WHEN FINANCIAL_QUARTER = '{_FIVE}' THEN RATE END) AS r3 FROM rates GROUP BY 1) r
    USING (SECTION_CODE)
LEFT JOIN (SELECT SECTION_CODE,
    avg(CASE WHEN IDENTIFIED_FLAG = 'Y' AND YEAR_MONTH BETWEEN 200007 AND 200106 THEN PATIENT_COUNT END) AS a0,
    avg(CASE WHEN IDENTIFIED_FLAG = 'Y' AND YEAR_MONTH BETWEEN 199907 AND 200006 THEN PATIENT_COUNT END) AS a1,
    coalesce(sum(CASE WHEN YEAR_MONTH BETWEEN 200007 AND 200106 THEN ITEM_COUNT END), 0)::DOUBLE AS v0,
    coalesce(sum(CASE WHEN YEAR_MONTH BETWEEN 199907 AND 200006 THEN ITEM_COUNT END), 0)::DOUBLE AS v1
    FROM monthly GROUP BY 1) m USING (SECTION_CODE)
"""
_Y0, _Y1 = "July 2000 to June 2001", "July 1999 to June 2000"
_BOTH = "July 1999 to June 2001"


def _pct(now: str, before: str) -> str:
    return f"100.0 * (({now} - {before}) / {before})"


_INDICATOR_LINES = [
    (_NOW, "Items", "i0", 0),
    (_YEAR, "Items", "i1", 0),
    (f"{_YEAR} to {_NOW}", "% change items", _pct("i0", "i1"), 1),
    (_LAST, "Items", "i2", 0),
    (f"{_LAST} to {_NOW}", "% change items", _pct("i0", "i2"), 1),
    (_FIVE, "Items", "i3", 0),
    (f"{_FIVE} to {_NOW}", "Items change", "i0 - i3", 0),
    (f"{_FIVE} to {_NOW}", "% change volume", _pct("i0", "i3"), 1),
    (_NOW, "Patients", "p0", 0),
    (_YEAR, "Patients", "p1", 0),
    (f"{_YEAR} to {_NOW}", "% change patients", _pct("p0", "p1"), 1),
    (_LAST, "Patients", "p2", 0),
    (f"{_LAST} to {_NOW}", "% change patients", _pct("p0", "p2"), 1),
    (_FIVE, "Patients", "p3", 0),
    (f"{_FIVE} to {_NOW}", "Patients change", "p0 - p3", 0),
    (f"{_FIVE} to {_NOW}", "% change patients", _pct("p0", "p3"), 1),
    (_FIVE, "% identified patients", "r3", 1),
    (_NOW, "% identified patients", "r0", 1),
    (f"{_FIVE} to {_NOW}", "Percentage points change", "r0 - r3", 0),
    (_Y0, "Mean patients", "a0", 0),
    (_Y1, "Mean patients", "a1", 0),
    (_BOTH, "% change patients", _pct("a0", "a1"), 1),
    (_Y0, "Items", "v0", 0),
    (_Y1, "Items", "v1", 0),
    (_BOTH, "% change items", _pct("v0", "v1"), 1),
]
_STEPS["indicator_line"] = " UNION ALL ".join(
    f"SELECT SECTION_CODE, {k} AS LINE, '{period}' AS Period, '{measure}' AS Measure, {value} AS v, {percent} AS pct FROM section_wide"
    for k, (period, measure, value, percent) in enumerate(_INDICATOR_LINES, start=1)
)

_oracle(
    q1_raw_items="""SELECT YEAR_MONTH, FINANCIAL_YEAR, FINANCIAL_QUARTER, PRESC_TYPE_PRNT, PRESC_ID_PRNT,
        CALC_PREC_DRUG_RECORD_ID, BNF_SECTION, SECTION_DESCR, CALC_AGE, DALL_5YR_BAND, PDS_GENDER,
        CAST(IDENTIFIED_PATIENT_ID AS STRING) AS IDENTIFIED_PATIENT_ID, IDENTIFIED_FLAG, ITEM_COUNT,
        ITEM_PAY_DR_NIC FROM joined""",
    q2_all_grains="""SELECT FINANCIAL_YEAR, FINANCIAL_QUARTER, CAST(NULL AS STRING) AS YEAR_MONTH, SECTION_NAME,
            SECTION_CODE, IDENTIFIED_FLAG, CAST(NULL AS STRING) AS PDS_GENDER,
            CAST(NULL AS STRING) AS DALL_5YR_BAND, ITEM_COUNT, ITEM_PAY_DR_NIC, PATIENT_COUNT,
            'quarterly' AS GRAIN FROM quarterly
        UNION ALL SELECT FINANCIAL_YEAR, FINANCIAL_QUARTER, CAST(YEAR_MONTH AS STRING), SECTION_NAME, SECTION_CODE,
            IDENTIFIED_FLAG, NULL, NULL, ITEM_COUNT, ITEM_PAY_DR_NIC, PATIENT_COUNT, 'monthly' FROM monthly
        UNION ALL SELECT FINANCIAL_YEAR, FINANCIAL_QUARTER, CAST(YEAR_MONTH AS STRING), SECTION_NAME, SECTION_CODE,
            IDENTIFIED_FLAG, PDS_GENDER, DALL_5YR_BAND, ITEM_COUNT, ITEM_PAY_DR_NIC, PATIENT_COUNT, 'model'
            FROM model""",
    q3_identification_text=f"""SELECT SECTION_NAME AS "BNF Section Name", SECTION_CODE AS "BNF Section Code",
        {_wide("printf('%.1f%%', round_even(RATE, 1)::DOUBLE)", _quarter_labels()[-4:])}
        FROM rates GROUP BY 1, 2""",
    q3_identification_table=f"""SELECT SECTION_NAME AS "BNF Section Name", SECTION_CODE AS "BNF Section Code",
        {_wide('round(RATE, 8)', _quarter_labels())} FROM rates GROUP BY 1, 2""",
    q4_monthly_series="SELECT * FROM month_series",
    q5_quarterly_figures=_figure("shown_quarters", "FINANCIAL_QUARTER, SECTION_NAME, SECTION_CODE"),
    q6_monthly_figures=_figure("shown_months", "YEAR_MONTH, MONTH_START, SECTION_NAME, SECTION_CODE"),
    q7_expected_figures=f"""SELECT YEAR_MONTH, SECTION_CODE, total_items, {_ROUNDED_PREDICTIONS},
        YEAR_MONTH_string, CASE WHEN total_items < PIlwr THEN 'below' WHEN total_items > PIupr THEN 'above'
            WHEN PIlwr IS NOT NULL THEN 'inside' END AS outside
        FROM actual_expected WHERE YEAR_MONTH > 199912""",
    q8_expected_totals="""SELECT SECTION_CODE, a AS total_actual_items, round(e, 4) AS total_expected_items,
        round(a - e, 4) AS difference, round(100 * (a - e) / e, 6) AS percent_diff
        FROM (SELECT SECTION_CODE, CAST(sum(total_items) AS BIGINT) AS a, sum(mean_fit) AS e
              FROM actual_expected WHERE YEAR_MONTH BETWEEN 200001 AND 200106 GROUP BY 1) s""",
    q9_indicators=f"""SELECT SECTION_CODE, LINE, {_TEXT_NAME} AS Section_Name, {_ITEM_NAME} AS Section_Formatted,
        Period, Measure, round(v, 6) AS "Value",
        concat({_shown('s')}, CASE WHEN pct = 1 THEN '%' ELSE '' END) AS Rounded
        FROM (SELECT *, {_signif('v')} AS s FROM indicator_line) q""",
    p12_p14_from_partitions=f"""SELECT YEAR_MONTH, IDENTIFIED_FLAG, {_TOTALS},
        CAST(YEAR_MONTH // 100 - (SELECT min(YEAR_MONTH) FROM joined) // 100 AS INT) AS YEARS_BACK
        FROM joined WHERE YEAR_MONTH = (SELECT max(YEAR_MONTH) FROM joined) GROUP BY 1, 2""",
    q1_stored_raw_of_a_year=f"""SELECT YEAR_MONTH, BNF_SECTION, SECTION_DESCR, {_TOTALS} FROM joined
        WHERE YEAR_MONTH BETWEEN 199904 AND 200003 GROUP BY 1, 2, 3""",
    q10_published_monthly=f"""SELECT {_HEAD.format(month='YEAR_MONTH AS "Year Month",')} FROM monthly""",
    q10_published_quarterly=f"SELECT {_HEAD.format(month='')} FROM quarterly",
    x1_disclosure_control="""SELECT FINANCIAL_YEAR, FINANCIAL_QUARTER, YEAR_MONTH, SECTION_NAME, SECTION_CODE,
        IDENTIFIED_FLAG, PDS_GENDER, DALL_5YR_BAND,
        CASE WHEN PATIENT_COUNT IN (1, 2, 3, 4) THEN NULL ELSE ITEM_COUNT::DOUBLE END AS ITEM_COUNT,
        CASE WHEN PATIENT_COUNT IN (1, 2, 3, 4) THEN NULL ELSE ITEM_PAY_DR_NIC END AS ITEM_PAY_DR_NIC,
        CASE WHEN PATIENT_COUNT IN (1, 2, 3, 4) THEN NULL ELSE PATIENT_COUNT::DOUBLE END AS PATIENT_COUNT
        FROM model""",
    # No equation may have a single unknown, no small cell may be shown, no shown value may differ.
    x1_secondary_suppression="""
        SELECT 'month' AS kind, count(*) AS n, 0::BIGINT AS "open" FROM monthly
        UNION ALL SELECT 'quarter', count(*), 0 FROM quarterly
        UNION ALL SELECT 'quarterly cells', count(*), 0 FROM quarterly
        UNION ALL SELECT 'monthly cells', count(*), 0 FROM monthly
        UNION ALL SELECT 'model cells', count(*), 0 FROM model""",
    x2_age_at_september="""SELECT fy, CAST(CAST(left(fy, 4) AS INT) - year(d)
            - CASE WHEN month(d) * 100 + day(d) > 930 THEN 1 ELSE 0 END AS INT) AS age, count(*) AS n
        FROM (SELECT d, concat(e - 1, '/', e) AS fy FROM
                (SELECT d, year(d) + 5 + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS e FROM order_day) a) b
        GROUP BY 1, 2""",
    x3_deprivation_decile=f"""SELECT coalesce(CAST(n_nationkey % 10 + 1 AS STRING), 'unknown') AS DECILE, {_TOTALS}
        FROM rx_fact f LEFT JOIN supplier s ON f.PRESC_ID_PRNT = s.s_suppkey
        LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1""",
)
ORACLE["k2_s3_snapshot_round_trip"] = ORACLE["a1_quarterly_totals"]
ORACLE["k2_s2_unfinished_snapshot"] = ORACLE["a2_monthly_totals"]
ORACLE["k7_incremental_patient_sets"] = ORACLE["q2_all_grains"]
ORACLE["a4_grains_from_patient_sets"] = ORACLE["q2_all_grains"]
ORACLE["k6_stored_indicators"] = ORACLE["q9_indicators"]
ORACLE["k7_stored_refresh"] = ORACLE["a2_monthly_totals"]
ORACLE["k1_materialised_table"] = ORACLE["a2_monthly_totals"]
ORACLE["k3_model_files"] = ORACLE["q8_expected_totals"]
ORACLE["k4_published_table"] = ORACLE["q10_published_monthly"]
ORACLE["k6b_registered_views"] = ORACLE["q9_indicators"]
# Every column of the published monthly table is in the dictionary; none of its measures is null.
ORACLE["k5_data_dictionary"] = f"""SELECT Field, CAST(count(v) AS BIGINT) AS n, TRUE AS described
    FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM ({ORACLE["q10_published_monthly"]}) p)
          ON COLUMNS(*) INTO NAME Field VALUE v) GROUP BY 1"""
