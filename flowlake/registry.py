"""Dataset registry: raw layouts, source -> canonical column mappings and the
silver task list.

Mappings are data, not code: ``project_mapping`` turns them into one
``select``. Target columns of a dataset are the sorted union of the values of
its two mappings, so silver columns are alphabetical.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: column layouts of the headerless bulk files -------------
BULK_LAYOUTS = {
    "cm.txt": ["CMTE_ID", "CMTE_NM", "TRES_NM", "CMTE_ST1", "CMTE_ST2", "CMTE_CITY", "CMTE_ST",
               "CMTE_ZIP", "CMTE_DSGN", "CMTE_TP", "CMTE_PTY_AFFILIATION", "CMTE_FILING_FREQ",
               "ORG_TP", "CONNECTED_ORG_NM", "CAND_ID"],
    "cn.txt": ["CAND_ID", "CAND_NAME", "CAND_PTY_AFFILIATION", "CAND_ELECTION_YR", "CAND_OFFICE_ST",
               "CAND_OFFICE", "CAND_OFFICE_DISTRICT", "CAND_ICI", "CAND_STATUS", "CAND_PCC",
               "CAND_ST1", "CAND_ST2", "CAND_CITY", "CAND_ST", "CAND_ZIP"],
    "itcont.txt": ["CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM",
                   "TRANSACTION_TP", "ENTITY_TP", "NAME", "CITY", "STATE", "ZIP_CODE", "EMPLOYER",
                   "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT", "OTHER_ID", "TRAN_ID",
                   "FILE_NUM", "MEMO_CD", "MEMO_TEXT", "SUB_ID"],
    "itoth.txt": ["CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM",
                  "TRANSACTION_TP", "ENTITY_TP", "NAME", "CITY", "STATE", "ZIP_CODE", "EMPLOYER",
                  "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT", "OTHER_ID", "TRAN_ID",
                  "FILE_NUM", "MEMO_CD", "MEMO_TEXT", "SUB_ID"],
    "itpas2.txt": ["CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM",
                   "TRANSACTION_TP", "ENTITY_TP", "NAME", "CITY", "STATE", "ZIP_CODE", "EMPLOYER",
                   "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT", "OTHER_ID", "CAND_ID",
                   "TRAN_ID", "FILE_NUM", "MEMO_CD", "MEMO_TEXT", "SUB_ID"],
}

# --- fixed values: source column -> canonical column, per dataset ----------
MAPPINGS = {
    "committee_master": {
        "bulk": {"CMTE_ID": "com_id", "CMTE_NM": "com_name", "CMTE_CITY": "com_city", "CMTE_ST": "com_state", "CMTE_ZIP": "com_zip", "CMTE_DSGN": "com_design", "CMTE_TP": "com_type", "CMTE_PTY_AFFILIATION": "com_party", "CAND_ID": "cand_id"},
        "api": {"committee_id": "com_id", "name": "com_name", "designation_full": "com_design", "committee_type_full": "com_type", "party_full": "com_party", "candidate_ids": "cand_id"},
    },
    "candidate_master": {
        "bulk": {"CAND_ID": "cand_id", "CAND_NAME": "cand_name", "CAND_PTY_AFFILIATION": "cand_party", "CAND_ELECTION_YR": "cand_el_yr", "CAND_OFFICE_ST": "cand_off_state", "CAND_OFFICE": "cand_off", "CAND_PCC": "com_id"},
        "api": {"candidate_id": "cand_id", "name": "cand_name", "party_full": "cand_party", "election_years": "cand_el_yr", "state": "cand_off_state", "office_full": "cand_off", "principal_committees": "com_id"},
    },
    "individual_contributions": {
        "bulk": {"CMTE_ID": "com_id", "TRANSACTION_PGI": "election_type", "NAME": "contrib_name", "CITY": "contrib_city", "STATE": "contrib_state", "ZIP_CODE": "contrib_zip", "EMPLOYER": "contrib_emp", "OCCUPATION": "contrib_occ", "TRANSACTION_DT": "trans_date", "TRANSACTION_AMT": "trans_amt", "OTHER_ID": "other_com_id"},
        "api": {"committee_id": "com_id", "election_type_full": "election_type", "contributor_name": "contrib_name", "contributor_city": "contrib_city", "contributor_state": "contrib_state", "contributor_zip": "contrib_zip", "contributor_employer": "contrib_emp", "contributor_occupation": "contrib_occ", "contribution_receipt_date": "trans_date", "contribution_receipt_amount": "trans_amt", "contributor_id": "other_com_id"},
    },
    "candidate_committee_linkages": {
        "bulk": {"CAND_ID": "cand_id", "CAND_ELECTION_YR": "cand_el_yr", "FEC_ELECTION_YR": "fec_el_yr", "CMTE_ID": "com_id", "CMTE_TP": "com_type", "CMTE_DSGN": "com_design"},
        "api": {"candidate_id": "cand_id", "election_year": "cand_el_yr", "cycles": "fec_el_yr", "committee_id": "com_id", "committee_type_full": "com_type", "designation_full": "com_design"},
    },
    "inter_committee_transactions": {
        "bulk": {"CMTE_ID": "com_id", "TRANSACTION_PGI": "election_type", "TRANSACTION_TP": "trans_type", "ENTITY_TP": "entity_tp", "NAME": "entity_name", "CITY": "contrib_city", "STATE": "contrib_state", "ZIP_CODE": "contrib_zip", "TRANSACTION_DT": "trans_date", "TRANSACTION_AMT": "trans_amt", "OTHER_ID": "other_com_id", "SUB_ID": "sub_id"},
        "api": {"committee_id": "com_id", "election_type_full": "election_type", "transaction_type": "trans_type", "entity_type": "entity_tp", "contributor_name": "entity_name", "contributor_city": "contrib_city", "contributor_state": "contrib_state", "contributor_zip": "contrib_zip", "contribution_receipt_date": "trans_date", "contribution_receipt_amount": "trans_amt", "contributor_id": "other_com_id", "transaction_id": "sub_id"},
    },
    "committee_contributions_to_candidates": {
        "bulk": {"CMTE_ID": "com_id", "CAND_ID": "cand_id", "TRANSACTION_PGI": "election_type", "TRANSACTION_TP": "trans_type", "ENTITY_TP": "entity_tp", "NAME": "entity_name", "CITY": "contrib_city", "STATE": "contrib_state", "ZIP_CODE": "contrib_zip", "TRANSACTION_DT": "trans_date", "TRANSACTION_AMT": "trans_amt", "OTHER_ID": "other_com_id", "SUB_ID": "sub_id"},
        "api": {"committee_id": "com_id", "candidate_id": "cand_id", "election_type_full": "election_type", "transaction_type": "trans_type", "entity_type": "entity_tp", "recipient_name": "entity_name", "recipient_city": "contrib_city", "recipient_state": "contrib_state", "recipient_zip": "contrib_zip", "disbursement_date": "trans_date", "disbursement_amount": "trans_amt", "recipient_committee_id": "other_com_id", "transaction_id": "sub_id"},
    },
    "independent_expenditures": {
        "bulk": {"CMTE_ID": "com_id", "TRANSACTION_PGI": "election_type", "TRANSACTION_TP": "trans_type", "ENTITY_TP": "entity_tp", "NAME": "entity_name", "CITY": "contrib_city", "STATE": "contrib_state", "ZIP_CODE": "contrib_zip", "TRANSACTION_DT": "trans_date", "TRANSACTION_AMT": "trans_amt", "OTHER_ID": "other_com_id", "CAND_ID": "cand_id", "SUB_ID": "sub_id"},
        "api": {"committee_id": "com_id", "election_type_full": "election_type", "transaction_type": "trans_type", "entity_type": "entity_tp", "contributor_name": "entity_name", "contributor_city": "contrib_city", "contributor_state": "contrib_state", "contributor_zip": "contrib_zip", "contribution_receipt_date": "trans_date", "contribution_receipt_amount": "trans_amt", "contributor_id": "other_com_id", "candidate_id": "cand_id", "transaction_id": "sub_id"},
    },
    "pac_summary": {
        "bulk": {"CMTE_ID": "com_id", "TTL_RECEIPTS": "total_receipts", "INDV_CONTRIB": "total_indv_contrib", "OTHER_POL_CMTE_CONTRIB": "total_pac_contrib", "TTL_DISB": "total_disbursements", "COH_COP": "cash_on_hand", "IND_EXP": "independent_exp", "NET_CONTRIB": "net_contrib", "CVG_END_DT": "coverage_end_date"},
        "api": {"committee_id": "com_id", "committee_name": "com_name", "receipts": "total_receipts", "individual_itemized_contributions": "total_indv_contrib", "other_political_committee_contributions": "total_pac_contrib", "disbursements": "total_disbursements", "cash_on_hand_end_period": "cash_on_hand", "independent_expenditures": "independent_exp", "net_contributions": "net_contrib", "coverage_end_date": "coverage_end_date"},
    },
}

# --- fixed values: silver tasks (dataset, bulk file, snapshot prefix) ------
SILVER_TASKS = [
    ("committee_master", "cm.txt", "api_raw_committees"),
    ("candidate_master", "cn.txt", "api_raw_candidates"),
    ("individual_contributions", "itcont.txt", "api_raw_individual_contribs"),
    ("inter_committee_transactions", "itoth.txt", "api_raw_inter_committee"),
    ("committee_contributions_to_candidates", "itpas2.txt", "api_raw_committee_disbursements"),
    ("independent_expenditures", "itpas2.txt", "api_raw_independent_expenditures"),
]

# --- fixed values: row filters on the raw transaction type -----------------
# (dataset -> allowed raw codes; datasets not listed keep every row)
DATASET_CODES = {
    "committee_contributions_to_candidates": ("24K",),
    "independent_expenditures": ("24E", "24A"),
}

# --- fixed values: cleaning rule per canonical column ----------------------
DATE_COLUMNS = ("trans_date",)
AMOUNT_COLUMNS = ("trans_amt",)
ID_COLUMNS = ("cand_id", "com_id", "other_com_id", "sub_id")
LABEL_COLUMNS = ("contrib_emp",)

# Silver tables read by the gold job.
GOLD_INPUTS = (
    "candidate_master",
    "committee_master",
    "individual_contributions",
    "committee_contributions_to_candidates",
    "inter_committee_transactions",
    "independent_expenditures",
)


def target_columns(dataset: str) -> list[str]:
    """Sorted union of the canonical names of both mappings."""
    m = MAPPINGS[dataset]
    return sorted(set(m["bulk"].values()) | set(m["api"].values()))


def header_schema(names: list[str]) -> StructType:
    """All-string schema for a headerless delimited file."""
    return StructType([StructField(n, StringType(), True) for n in names])

