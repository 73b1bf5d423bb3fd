"""Bindings of the driver's test tables to the engine's roles.

The test data is a TPC-H-like star schema; the engine works on committees,
candidates and payments. Each role is declared once as a list of
``(column, SQL expression)`` over the test tables. The Spark side applies
the expressions with ``selectExpr`` on the joined source frames; the DuckDB
oracle uses the very same text inside CTEs. Only date formatting differs
between the two dialects. Every role grows with the scale factor (part keys
span twenty times the supplier keys, so every committee has a candidate and
every transfer target is a committee).

Roles
  committee    supplier        com_id 'C'||s_suppkey, cand_id 'H'||s_suppkey
  candidate    part            cand_id 'H'||p_partkey, cycles as list text
  individual   lineitem+orders+customer (donor = customer)
  pas2         lineitem        committee 'C'||l_suppkey -> candidate 'H'||l_partkey, code per flag
  direct       pas2 with code 24K;  independent: pas2 with 24E/24A
  transfers    lineitem        committee 'C'||l_suppkey -> committee 'C'||floor(l_partkey/20)
  raw_*        text-shaped sources for the silver layer
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .joins import dealt

SPARK, DUCK = "spark", "duckdb"

# ---------------------------------------------------------------- helpers


def _iso(x: str, d: str) -> str:
    return f"date_format({x}, 'yyyy-MM-dd')" if d == SPARK else f"strftime({x}, '%Y-%m-%d')"


def _mdy(x: str, d: str) -> str:
    return f"date_format({x}, 'MMddyyyy')" if d == SPARK else f"strftime({x}, '%m%d%Y')"


def _state(k: str) -> str:
    return (f"CASE {k} % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' "
            f"WHEN 3 THEN 'FL' WHEN 4 THEN 'WA' ELSE 'ZZ' END")


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


NULL = "CAST(NULL AS STRING)"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
SIGNED = f"CASE WHEN l_returnflag = 'R' THEN -{PRICE} ELSE {PRICE} END"
AMOUNT = f"CAST({SIGNED} AS DOUBLE)"
# on a few orders: an amount that no total can hold, a very large one, and one below the cent
WILD_AMOUNT = (f"CASE WHEN l_orderkey % 1000 = 7 THEN CAST('inf' AS DOUBLE) "
               f"WHEN l_orderkey % 1000 = 13 THEN CAST('1e30' AS DOUBLE) "
               f"WHEN l_orderkey % 1000 = 3 THEN CAST('25000000000001.25' AS DOUBLE) "
               f"WHEN l_orderkey % 1000 = 5 THEN CAST('0.004' AS DOUBLE) ELSE {AMOUNT} END")
AMOUNT_TEXT = _s(SIGNED)
ORDER_AMOUNT_TEXT = _s("CAST(o_totalprice AS DECIMAL(18,2))")
TRANS_TYPE = ("CASE WHEN l_linenumber = 7 THEN '24Z' "
              "WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN ' 24K' "
              "WHEN l_returnflag = 'A' THEN '24K' WHEN l_returnflag = 'R' THEN '24E' ELSE '24A' END")
# donor state with blanks: '' for BUILDING, NULL for MACHINERY
CONTRIB_STATE = (f"CASE WHEN c_mktsegment = 'BUILDING' THEN '' "
                 f"WHEN c_mktsegment = 'MACHINERY' THEN {NULL} ELSE {_state('c_nationkey')} END")
CYCLE_TEXT = ("CASE WHEN p_partkey % 50 = 49 THEN '' "
              "WHEN p_partkey % 5 = 0 THEN '[2022, 2024]' "
              "WHEN p_partkey % 5 = 1 THEN '2024' "
              "WHEN p_partkey % 5 = 2 THEN '[' || chr(39) || '2024' || chr(39) || ', ' || chr(39) || '2026' || chr(39) || ']' "
              "WHEN p_partkey % 5 = 3 THEN '2025, nan' "
              "WHEN p_partkey % 10 = 4 THEN '[\"2026\"]' ELSE '2026,' END")
OFFICE = "CASE p_size % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'S' ELSE 'P' END"
CAND_NAME = f"upper(p_name) || ' #' || {_s('p_partkey')}"
TRANSFER_TARGET = _s("CAST(FLOOR(l_partkey / 20) AS BIGINT)")


def _raw_date(x: str, d: str) -> str:
    """Date text in the forms the bulk files carry, plus malformed ones."""
    unpadded = f"{_s(f'year({x})')} || '-' || {_s(f'month({x})')} || '-' || {_s(f'day({x})')}"
    return (f"CASE l_linenumber % 3 WHEN 0 THEN {_iso(x, d)} WHEN 1 THEN {_mdy(x, d)} "
            f"ELSE CASE l_orderkey % 6 WHEN 0 THEN 'junk' WHEN 1 THEN {unpadded} "
            f"WHEN 3 THEN {_iso(x, d)} || 'T00:00:00' WHEN 4 THEN {_iso(x, d)} || ' 23:59:59.5+01:00' "
            f"WHEN 2 THEN ' ' || {_mdy(x, d)} ELSE '0230' || {_s(f'year({x})')} END END")


# ---------------------------------------------------------------- sources

FROM = {
    "supplier": "supplier",
    "part": "part",
    "lineitem": "lineitem",
    "orders_customer": "orders JOIN customer ON o_custkey = c_custkey",
    "lineitem_orders_customer": ("lineitem JOIN orders ON l_orderkey = o_orderkey "
                                 "JOIN customer ON o_custkey = c_custkey"),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    if source in ("supplier", "part", "lineitem"):
        return _table(spark, sf_dir, source)
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    oc = orders.join(customer, orders.o_custkey == customer.c_custkey)
    if source == "orders_customer":
        return oc
    li, oc = dealt(_table(spark, sf_dir, "lineitem"), oc, ["l_orderkey"], ["o_orderkey"])
    return li.join(oc, li.l_orderkey == oc.o_orderkey)


# ---------------------------------------------------------------- roles
# Each role: (source, where-clause or None, columns(dialect) -> [(name, expr)])


def _committee(d):
    return [
        ("cand_id", f"'H' || {_s('s_suppkey')}"),
        ("com_city", f"'CITY ' || {_s('s_nationkey')}"),
        ("com_design", "CASE WHEN s_suppkey % 2 = 0 THEN 'P' ELSE 'U' END"),
        ("com_id", f"'C' || {_s('s_suppkey')}"),
        ("com_name", "s_name"),
        ("com_party", "CASE s_nationkey % 3 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' ELSE '' END"),
        ("com_state", _state("s_nationkey")),
        ("com_type", "CASE s_suppkey % 3 WHEN 0 THEN 'Q' WHEN 1 THEN 'N' ELSE 'H' END"),
        ("com_zip", _s("10000 + s_suppkey % 90000")),
    ]


def _candidate(d):
    return [
        ("cand_el_yr", CYCLE_TEXT),
        ("cand_id", f"'H' || {_s('p_partkey')}"),
        ("cand_name", CAND_NAME),
        ("cand_off", OFFICE),
        ("cand_off_state", _state("p_partkey")),
        ("cand_party", "CASE WHEN p_partkey % 2 = 0 THEN 'DEM' ELSE 'REP' END"),
        ("com_id", f"'C' || {_s('p_partkey')}"),
    ]


def _individual(d):
    return [
        ("com_id", f"'C' || {_s('l_suppkey')}"),
        ("contrib_city", f"'CITY ' || {_s('c_nationkey')}"),
        ("contrib_emp", f"CASE WHEN c_custkey % 3 = 0 THEN 'NOT SPECIFIED' ELSE 'ACME ' || {_s('c_custkey % 7')} END"),
        ("contrib_name", "c_name"),
        ("contrib_occ", "o_orderpriority"),
        ("contrib_state", CONTRIB_STATE),
        ("contrib_zip", _s("10000 + c_custkey % 90000")),
        ("election_type", "CASE WHEN l_linenumber % 2 = 0 THEN 'P2026' ELSE 'G2026' END"),
        ("other_com_id", "''"),
        ("trans_amt", WILD_AMOUNT),
        ("trans_date", _iso("l_shipdate", d)),
    ]


def _pas2(d):
    return [
        ("cand_id", f"'H' || {_s('l_partkey')}"),
        ("com_id", f"'C' || {_s('l_suppkey')}"),
        ("trans_amt", AMOUNT),
        ("trans_type", TRANS_TYPE),
    ]


def _transfers(d):
    return [
        ("com_id", f"'C' || {_s('l_suppkey')}"),
        ("other_com_id", f"'C' || {TRANSFER_TARGET}"),
        ("trans_amt", AMOUNT),
    ]


def _payment_text(d):
    """Raw text of individual payments (for the scalar rules)."""
    return [
        ("l_orderkey", "l_orderkey"),
        ("l_linenumber", "l_linenumber"),
        ("raw_date", _raw_date("l_shipdate", d)),
        ("raw_amount", (f"CASE l_linenumber % 5 WHEN 0 THEN 'None' WHEN 1 THEN 'nan' WHEN 2 THEN '' "
                        f"WHEN 3 THEN {NULL} ELSE CASE l_orderkey % 9 WHEN 0 THEN 'inf' WHEN 1 THEN '1e30' "
                        f"WHEN 2 THEN '1,000.00' WHEN 3 THEN '$5' ELSE {AMOUNT_TEXT} END END")),
        ("raw_id", f"'  ' || lower(s_name) || ' '"),
        ("raw_label", f"CASE WHEN s_suppkey % 3 = 0 THEN {NULL} ELSE ' ' || lower(s_name) END"),
    ]


def _raw_cm(d):
    """cm.txt layout (text) from supplier, with dirty identifiers."""
    return [
        ("CMTE_ID", f"'  c' || {_s('s_suppkey')} || ' '"),
        ("CMTE_NM", "s_name"),
        ("TRES_NM", NULL),
        ("CMTE_ST1", NULL),
        ("CMTE_ST2", NULL),
        ("CMTE_CITY", f"'CITY ' || {_s('s_nationkey')}"),
        ("CMTE_ST", _state("s_nationkey")),
        ("CMTE_ZIP", _s("10000 + s_suppkey % 90000")),
        ("CMTE_DSGN", "CASE WHEN s_suppkey % 2 = 0 THEN 'P' ELSE 'U' END"),
        ("CMTE_TP", "CASE s_suppkey % 3 WHEN 0 THEN 'Q' WHEN 1 THEN 'N' ELSE 'H' END"),
        ("CMTE_PTY_AFFILIATION", f"CASE s_nationkey % 3 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' ELSE {NULL} END"),
        ("CMTE_FILING_FREQ", "'Q'"),
        ("ORG_TP", NULL),
        ("CONNECTED_ORG_NM", NULL),
        ("CAND_ID", f"'h' || {_s('s_suppkey')}"),
    ]


def _raw_cm_api(d):
    """Committee snapshot fields (text) from supplier; ``party_full`` is
    absent, ``cycles`` is an extra unmapped field."""
    return [
        ("committee_id", f"'C' || {_s('s_suppkey')}"),
        ("name", "upper(s_name)"),
        ("designation_full", "CASE WHEN s_suppkey % 2 = 0 THEN 'Principal campaign committee' ELSE 'Unauthorized' END"),
        ("committee_type_full", "CASE WHEN s_suppkey % 5 = 0 THEN 'None' ELSE 'PAC' END"),
        ("candidate_ids", f"'[' || chr(39) || 'H' || {_s('s_suppkey')} || chr(39) || ']'"),
        ("cycles", "'[2024, 2026]'"),
    ]


def _raw_cn(d):
    """cn.txt layout (text) from part."""
    return [
        ("CAND_ID", f"'h' || {_s('p_partkey')}"),
        ("CAND_NAME", CAND_NAME),
        ("CAND_PTY_AFFILIATION", "CASE WHEN p_partkey % 2 = 0 THEN 'DEM' ELSE 'REP' END"),
        ("CAND_ELECTION_YR", CYCLE_TEXT),
        ("CAND_OFFICE_ST", _state("p_partkey")),
        ("CAND_OFFICE", OFFICE),
        ("CAND_OFFICE_DISTRICT", "'01'"),
        ("CAND_ICI", "'C'"),
        ("CAND_STATUS", "'C'"),
        ("CAND_PCC", f"'C' || {_s('p_partkey')}"),
        ("CAND_ST1", NULL),
        ("CAND_ST2", NULL),
        ("CAND_CITY", NULL),
        ("CAND_ST", _state("p_partkey")),
        ("CAND_ZIP", NULL),
    ]


def _raw_itoth(d):
    """itoth.txt layout (text) from lineitem: committee-to-committee transfers."""
    return [
        ("CMTE_ID", f"'C' || {_s('l_suppkey')}"),
        ("AMNDT_IND", "'N'"),
        ("RPT_TP", "'Q3'"),
        ("TRANSACTION_PGI", "'G2026'"),
        ("IMAGE_NUM", _s("l_orderkey")),
        ("TRANSACTION_TP", "'24G'"),
        ("ENTITY_TP", "'PAC'"),
        ("NAME", f"'COMMITTEE ' || {TRANSFER_TARGET}"),
        ("CITY", NULL),
        ("STATE", _state("l_suppkey")),
        ("ZIP_CODE", NULL),
        ("EMPLOYER", NULL),
        ("OCCUPATION", NULL),
        ("TRANSACTION_DT", _mdy("l_shipdate", d)),
        ("TRANSACTION_AMT", AMOUNT_TEXT),
        ("OTHER_ID", f"'c' || {TRANSFER_TARGET}"),
        ("TRAN_ID", f"'O' || {_s('l_orderkey')} || '-' || {_s('l_linenumber')}"),
        ("FILE_NUM", NULL),
        ("MEMO_CD", NULL),
        ("MEMO_TEXT", NULL),
        ("SUB_ID", _s("l_orderkey * 8 + l_linenumber")),
    ]


def _raw_itcont(d):
    """itcont.txt layout (text) from lineitem + orders + customer."""
    return [
        ("CMTE_ID", f"'  c' || {_s('l_suppkey')} || ' '"),
        ("AMNDT_IND", "'N'"),
        ("RPT_TP", "'Q1'"),
        ("TRANSACTION_PGI", "CASE WHEN l_linenumber % 2 = 0 THEN 'P2026' ELSE 'G2026' END"),
        ("IMAGE_NUM", _s("l_orderkey")),
        ("TRANSACTION_TP", "'15'"),
        ("ENTITY_TP", "'IND'"),
        ("NAME", "c_name"),
        ("CITY", f"'CITY ' || {_s('c_nationkey')}"),
        ("STATE", CONTRIB_STATE),
        ("ZIP_CODE", _s("10000 + c_custkey % 90000")),
        ("EMPLOYER", f"CASE WHEN c_custkey % 3 = 0 THEN {NULL} ELSE ' acme ' || {_s('c_custkey % 7')} END"),
        ("OCCUPATION", "o_orderpriority"),
        ("TRANSACTION_DT", _raw_date("l_shipdate", d)),
        ("TRANSACTION_AMT", f"CASE l_linenumber WHEN 5 THEN 'nan' WHEN 6 THEN 'None' ELSE {AMOUNT_TEXT} END"),
        ("OTHER_ID", NULL),
        ("TRAN_ID", f"'T' || {_s('l_orderkey')} || '-' || {_s('l_linenumber')}"),
        ("FILE_NUM", NULL),
        ("MEMO_CD", NULL),
        ("MEMO_TEXT", NULL),
        ("SUB_ID", _s("l_orderkey * 8 + l_linenumber")),
    ]


def _raw_itcont_api(d):
    """Individual-receipt snapshot fields (text) from orders + customer;
    ``contributor_zip`` is absent, ``memo_text`` is extra."""
    return [
        ("committee_id", f"'c' || {_s('o_custkey % 100')}"),
        ("election_type_full", "CASE WHEN o_orderkey % 2 = 0 THEN 'P2026' ELSE 'G2026' END"),
        ("contributor_name", "c_name"),
        ("contributor_city", f"CASE WHEN c_custkey % 5 = 0 THEN 'None' ELSE 'CITY ' || {_s('c_nationkey')} END"),
        ("contributor_state", CONTRIB_STATE),
        ("contributor_employer", f"CASE WHEN c_custkey % 3 = 0 THEN 'nan' ELSE 'acme ' || {_s('c_custkey % 7')} END"),
        ("contributor_occupation", "o_orderstatus"),
        ("contribution_receipt_date", _iso("o_orderdate", d)),
        ("contribution_receipt_amount", ORDER_AMOUNT_TEXT),
        ("contributor_id", f"CASE WHEN o_orderkey % 7 = 0 THEN 'None' ELSE 'c' || {_s('o_custkey')} END"),
        ("memo_text", "'api'"),
    ]


def _raw_itpas2(d):
    """itpas2.txt layout (text) from lineitem."""
    return [
        ("CMTE_ID", f"'C' || {_s('l_suppkey')}"),
        ("AMNDT_IND", "'N'"),
        ("RPT_TP", "'Q2'"),
        ("TRANSACTION_PGI", "'G2026'"),
        ("IMAGE_NUM", _s("l_orderkey")),
        ("TRANSACTION_TP", TRANS_TYPE),
        ("ENTITY_TP", "'PAC'"),
        ("NAME", f"'ENTITY ' || {_s('l_partkey')}"),
        ("CITY", NULL),
        ("STATE", _state("l_partkey")),
        ("ZIP_CODE", NULL),
        ("EMPLOYER", NULL),
        ("OCCUPATION", NULL),
        ("TRANSACTION_DT", _mdy("l_shipdate", d)),
        ("TRANSACTION_AMT", AMOUNT_TEXT),
        ("OTHER_ID", NULL),
        ("CAND_ID", f"'h' || {_s('l_partkey')}"),
        ("TRAN_ID", f"'P' || {_s('l_orderkey')} || '-' || {_s('l_linenumber')}"),
        ("FILE_NUM", NULL),
        ("MEMO_CD", NULL),
        ("MEMO_TEXT", NULL),
        ("SUB_ID", _s("l_orderkey * 8 + l_linenumber")),
    ]


def _raw_disb_api(d):
    """Committee-disbursement snapshot fields (text) from orders."""
    return [
        ("committee_id", f"'C' || {_s('o_custkey % 100')}"),
        ("candidate_id", f"'H' || {_s('o_custkey')}"),
        ("election_type_full", "'G2026'"),
        ("transaction_type", "CASE o_orderstatus WHEN 'F' THEN '24K' WHEN 'O' THEN '24E' ELSE '24Z' END"),
        ("entity_type", "'PAC'"),
        ("recipient_name", f"'RECIPIENT ' || {_s('o_custkey')}"),
        ("disbursement_date", _iso("o_orderdate", d)),
        ("disbursement_amount", ORDER_AMOUNT_TEXT),
        ("transaction_id", f"'B' || {_s('o_orderkey')}"),
    ]


def _raw_ie_api(d):
    """Independent-expenditure snapshot fields (text) from orders."""
    return [
        ("committee_id", f"'C' || {_s('o_custkey % 100')}"),
        ("candidate_id", f"'H' || {_s('o_custkey')}"),
        ("election_type_full", "'G2026'"),
        ("transaction_type", "CASE o_orderstatus WHEN 'F' THEN '24K' WHEN 'O' THEN '24A' ELSE '24E' END"),
        ("entity_type", "'SUPERPAC'"),
        ("contributor_name", f"'SPENDER ' || {_s('o_custkey')}"),
        ("contribution_receipt_date", _iso("o_orderdate", d)),
        ("contribution_receipt_amount", ORDER_AMOUNT_TEXT),
        ("transaction_id", f"'E' || {_s('o_orderkey')}"),
    ]


ROLES = {
    "committee": ("supplier", None, _committee),
    "candidate": ("part", None, _candidate),
    "individual": ("lineitem_orders_customer", None, _individual),
    "pas2": ("lineitem", None, _pas2),
    "direct": ("lineitem", f"({TRANS_TYPE}) = '24K'", _pas2),
    "independent": ("lineitem", f"({TRANS_TYPE}) IN ('24E', '24A')", _pas2),
    "transfers": ("lineitem", None, _transfers),
    "payment_text": ("lineitem_supplier", None, _payment_text),
    "raw_cm": ("supplier", None, _raw_cm),
    "raw_cm_api": ("supplier", None, _raw_cm_api),
    "raw_cn": ("part", None, _raw_cn),
    "raw_itoth": ("lineitem", None, _raw_itoth),
    "raw_itcont": ("lineitem_orders_customer", None, _raw_itcont),
    "raw_itcont_api": ("orders_customer", None, _raw_itcont_api),
    "raw_itpas2": ("lineitem", None, _raw_itpas2),
    "raw_disb_api": ("orders", None, _raw_disb_api),
    "raw_ie_api": ("orders", None, _raw_ie_api),
}
FROM["lineitem_supplier"] = "lineitem JOIN supplier ON l_suppkey = s_suppkey"
FROM["orders"] = "orders"


def columns(role: str) -> list[str]:
    return [n for n, _ in ROLES[role][2](SPARK)]


def frame(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """Spark DataFrame of a bound role."""
    source, where, cols = ROLES[role]
    if source == "lineitem_supplier":
        li, su = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "supplier")
        base = li.join(su, li.l_suppkey == su.s_suppkey)
    elif source == "orders":
        base = _table(spark, sf_dir, "orders")
    else:
        base = _source(spark, sf_dir, source)
    if where:
        base = base.where(where)
    return base.selectExpr(*[f"{expr} AS `{name}`" for name, expr in cols(SPARK)])


def sql(role: str) -> str:
    """DuckDB SELECT of a bound role."""
    source, where, cols = ROLES[role]
    items = ", ".join(f'{expr} AS "{name}"' for name, expr in cols(DUCK))
    w = f" WHERE {where}" if where else ""
    return f"SELECT {items} FROM {FROM[source]}{w}"


def land_bronze(spark: SparkSession, sf_dir: str, bronze_root: str, landing_root: str) -> None:
    """Write the five bulk files and the snapshot files derived from the
    test tables (used by the end-to-end job tests)."""
    from ..sources import delimited, snapshots

    for role, name in (("raw_cm", "cm.txt"), ("raw_cn", "cn.txt"), ("raw_itcont", "itcont.txt"),
                       ("raw_itoth", "itoth.txt"), ("raw_itpas2", "itpas2.txt")):
        delimited.write_delimited(frame(spark, sf_dir, role), f"{bronze_root}/{name}")
    for role, prefix in (("raw_cm_api", "api_raw_committees"), ("raw_itcont_api", "api_raw_individual_contribs"),
                         ("raw_disb_api", "api_raw_committee_disbursements"),
                         ("raw_ie_api", "api_raw_independent_expenditures")):
        snapshots.write_snapshot(frame(spark, sf_dir, role), landing_root, prefix, "20260101_000000")


def silver_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six gold inputs, keyed by silver dataset name."""
    return {
        "candidate_master": frame(spark, sf_dir, "candidate"),
        "committee_master": frame(spark, sf_dir, "committee"),
        "individual_contributions": frame(spark, sf_dir, "individual"),
        "committee_contributions_to_candidates": frame(spark, sf_dir, "direct"),
        "inter_committee_transactions": frame(spark, sf_dir, "transfers"),
        "independent_expenditures": frame(spark, sf_dir, "independent"),
    }
