
import __spark_entry__ as entry

SURVEY_QUERIES = (
    "accounts_prepared", "ledger_prepared", "mappings_prepared", "ledger_row_count", "batches_combined",
    "debit_credit_split", "report_projection", "tally_per_transaction", "account_activity", "enrich_customer",
    "enrich_mapped_date", "pair_own_credit", "account_effective_date", "account_rollup", "account_rollup_boundary",
    "ledger_sequence", "pair_next_credit", "pair_prev_debit", "account_activity_shifted", "pair_classes_forward",
    "pair_classes_backward", "effective_date", "tally_per_transaction_sorted", "tally_report_sorted", "ledger_slice",
    "extract_txn_number", "pair_next_credit_bucketed", "stream_pairing", "stream_tally",
    "stream_late_rows", "stream_pairing_event_time", "ledger_sequence_sparse", "ledger_from_csv", "customers_from_csv",
    "mappings_from_csv", "account_rollup_list_parts", "account_rollup_sorted",
    "tally_per_transaction_split", "enrich_mapped_date_pruned",
)


def test_survey_queries_registered_with_oracle():
    queries, sql = entry.queries(), entry.oracle_sql()
    missing = [q for q in SURVEY_QUERIES if q not in queries]
    no_oracle = [q for q in SURVEY_QUERIES if q not in sql]
    assert missing == [] and no_oracle == []
