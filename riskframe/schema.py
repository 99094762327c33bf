"""Raw loan-application schema and the column groups the library works with.

Every list in this module is a fixed value: the names must equal the column
names of the public accepted-loans file (and its sample applications CSV) for
the operators to find their inputs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw column names, in file order (151) ---------------------
RAW_COLUMNS = [
    "id", "member_id", "loan_amnt", "funded_amnt", "funded_amnt_inv", "term", "int_rate",
    "installment", "grade", "sub_grade", "emp_title", "emp_length", "home_ownership",
    "annual_inc", "verification_status", "issue_d", "loan_status", "pymnt_plan", "url", "desc",
    "purpose", "title", "zip_code", "addr_state", "dti", "delinq_2yrs", "earliest_cr_line",
    "fico_range_low", "fico_range_high", "inq_last_6mths", "mths_since_last_delinq",
    "mths_since_last_record", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc",
    "initial_list_status", "out_prncp", "out_prncp_inv", "total_pymnt", "total_pymnt_inv",
    "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "recoveries",
    "collection_recovery_fee", "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d",
    "last_credit_pull_d", "last_fico_range_high", "last_fico_range_low",
    "collections_12_mths_ex_med", "mths_since_last_major_derog", "policy_code",
    "application_type", "annual_inc_joint", "dti_joint", "verification_status_joint",
    "acc_now_delinq", "tot_coll_amt", "tot_cur_bal", "open_acc_6m", "open_act_il",
    "open_il_12m", "open_il_24m", "mths_since_rcnt_il", "total_bal_il", "il_util",
    "open_rv_12m", "open_rv_24m", "max_bal_bc", "all_util", "total_rev_hi_lim", "inq_fi",
    "total_cu_tl", "inq_last_12m", "acc_open_past_24mths", "avg_cur_bal", "bc_open_to_buy",
    "bc_util", "chargeoff_within_12_mths", "delinq_amnt", "mo_sin_old_il_acct",
    "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "mort_acc",
    "mths_since_recent_bc", "mths_since_recent_bc_dlq", "mths_since_recent_inq",
    "mths_since_recent_revol_delinq", "num_accts_ever_120_pd", "num_actv_bc_tl",
    "num_actv_rev_tl", "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl",
    "num_rev_accts", "num_rev_tl_bal_gt_0", "num_sats", "num_tl_120dpd_2m", "num_tl_30dpd",
    "num_tl_90g_dpd_24m", "num_tl_op_past_12m", "pct_tl_nvr_dlq", "percent_bc_gt_75",
    "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim", "total_bal_ex_mort",
    "total_bc_limit", "total_il_high_credit_limit", "revol_bal_joint", "sec_app_fico_range_low",
    "sec_app_fico_range_high", "sec_app_earliest_cr_line", "sec_app_inq_last_6mths",
    "sec_app_mort_acc", "sec_app_open_acc", "sec_app_revol_util", "sec_app_open_act_il",
    "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med", "sec_app_mths_since_last_major_derog",
    "hardship_flag", "hardship_type", "hardship_reason", "hardship_status", "deferral_term",
    "hardship_amount", "hardship_start_date", "hardship_end_date", "payment_plan_start_date",
    "hardship_length", "hardship_dpd", "hardship_loan_status",
    "orig_projected_additional_accrued_interest", "hardship_payoff_balance_amount",
    "hardship_last_payment_amount", "disbursement_method", "debt_settlement_flag",
    "debt_settlement_flag_date", "settlement_status", "settlement_date", "settlement_amount",
    "settlement_percentage", "settlement_term",
]

# Raw columns holding text (everything else is a measure read as DOUBLE).
RAW_STRING_COLUMNS = [
    "id", "member_id", "term", "grade", "sub_grade", "emp_title", "emp_length",
    "home_ownership", "verification_status", "issue_d", "loan_status", "pymnt_plan", "url",
    "desc", "purpose", "title", "zip_code", "addr_state", "earliest_cr_line",
    "initial_list_status", "last_pymnt_d", "next_pymnt_d", "last_credit_pull_d",
    "application_type", "verification_status_joint", "sec_app_earliest_cr_line",
    "hardship_flag", "hardship_type", "hardship_reason", "hardship_status",
    "hardship_start_date", "hardship_end_date", "payment_plan_start_date",
    "hardship_loan_status", "disbursement_method", "debt_settlement_flag",
    "debt_settlement_flag_date", "settlement_status", "settlement_date",
]

# --- fixed values: date columns in "Mon-YYYY" text ----------------------------
DATE_COLUMNS = [
    "issue_d", "earliest_cr_line", "last_pymnt_d", "next_pymnt_d",
    "last_credit_pull_d", "sec_app_earliest_cr_line",
]

# --- fixed values: loan_status vocabulary -------------------------------------
BAD_STATUSES = [
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
]
GOOD_STATUSES = ["Fully Paid"]

# --- fixed values: columns removed before modelling (ids, free text, constant,
# post-origination leakage, secondary applicant, hardship / settlement) ---------
LEAKAGE_COLUMNS = [
    "id", "member_id", "url", "desc", "title", "emp_title", "zip_code", "policy_code",
    "pymnt_plan", "hardship_flag", "debt_settlement_flag", "out_prncp", "out_prncp_inv",
    "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "recoveries", "collection_recovery_fee", "last_pymnt_d",
    "last_pymnt_amnt", "next_pymnt_d", "last_credit_pull_d", "last_fico_range_high",
    "last_fico_range_low",
    "sec_app_fico_range_low", "sec_app_fico_range_high", "sec_app_earliest_cr_line",
    "sec_app_inq_last_6mths", "sec_app_mort_acc", "sec_app_open_acc", "sec_app_revol_util",
    "sec_app_open_act_il", "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med", "sec_app_mths_since_last_major_derog",
    "revol_bal_joint",
    "hardship_type", "hardship_reason", "hardship_status", "deferral_term", "hardship_amount",
    "hardship_start_date", "hardship_end_date", "payment_plan_start_date", "hardship_length",
    "hardship_dpd", "hardship_loan_status", "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount",
    "debt_settlement_flag_date", "settlement_status", "settlement_date",
    "settlement_amount", "settlement_percentage", "settlement_term",
]

# Columns that no drop rule may remove.
PROTECTED_COLUMNS = ["is_bad", "loan_status", "issue_d", "earliest_cr_line", "issue_year",
                     "issue_month_yr"]

# Columns removed from the feature frame X (label, raw status, split helpers).
NON_FEATURE_COLUMNS = ["is_bad", "loan_status", "issue_year", "issue_month_yr"]

# --- fixed values: the 69 raw model inputs -----------------------------------
MODEL_FEATURES = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "term", "int_rate", "installment", "grade",
    "sub_grade", "emp_length", "home_ownership", "annual_inc", "verification_status",
    "issue_d", "purpose", "addr_state", "dti", "delinq_2yrs", "earliest_cr_line",
    "fico_range_low", "fico_range_high", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal",
    "revol_util", "total_acc", "initial_list_status", "collections_12_mths_ex_med",
    "application_type", "acc_now_delinq", "tot_coll_amt", "tot_cur_bal", "total_rev_hi_lim",
    "acc_open_past_24mths", "avg_cur_bal", "bc_open_to_buy", "bc_util",
    "chargeoff_within_12_mths", "delinq_amnt", "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op",
    "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "mort_acc", "mths_since_recent_bc",
    "mths_since_recent_inq", "num_accts_ever_120_pd", "num_actv_bc_tl", "num_actv_rev_tl",
    "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl", "num_rev_accts",
    "num_rev_tl_bal_gt_0", "num_sats", "num_tl_120dpd_2m", "num_tl_30dpd",
    "num_tl_90g_dpd_24m", "num_tl_op_past_12m", "pct_tl_nvr_dlq", "percent_bc_gt_75",
    "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim", "total_bal_ex_mort",
    "total_bc_limit", "total_il_high_credit_limit", "disbursement_method",
]

# --- fixed values: feature-engineering vocabularies ---------------------------
EMP_LENGTH_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}
COUNT_BINARY_COLUMNS = ["pub_rec", "mort_acc", "pub_rec_bankruptcies"]
ORDINAL_COLUMNS = ["grade", "sub_grade"]

# --- fixed values: thresholds -------------------------------------------------
MISSING_THRESHOLD_PCT = 40.0       # drop when missing % is strictly above
EDA_SKEW_THRESHOLD = 1.0           # |G1| (bias-adjusted) above -> "highly skewed"
PLAN_SKEW_THRESHOLD = 0.75         # |g1| (population) above -> Yeo-Johnson group
NEAR_ZERO_STD = 1e-6
HIGH_CORR_THRESHOLD = 0.85
PSI_STABLE, PSI_MINOR = 0.1, 0.25
DAYS_PER_YEAR = 365.25


def raw_schema() -> T.StructType:
    """Declared schema of the raw application file; never inferred."""
    strings = set(RAW_STRING_COLUMNS)
    return T.StructType([
        T.StructField(c, T.StringType() if c in strings else T.DoubleType(), True)
        for c in RAW_COLUMNS
    ])
