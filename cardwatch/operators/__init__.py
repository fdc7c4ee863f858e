from .facts import append_new, load_transactions, seed_to_hist
from .report import HISTORY_ALL, HISTORY_AS_OF, report_view, restrict_day
from .rules import (first_per_passport, fraud_report, lag_chain, rule_account,
                    rule_brute_force, rule_cities, rule_hit_counts, rule_passport)
from .scd2 import dim_current, first_load, scd2_diff, scd2_merge
from .scd2_log import series_log, state_of
from .windows import with_lags

__all__ = ["append_new", "load_transactions", "seed_to_hist", "HISTORY_ALL", "HISTORY_AS_OF",
           "report_view", "restrict_day", "first_per_passport", "fraud_report", "lag_chain",
           "rule_account", "rule_brute_force", "rule_cities", "rule_hit_counts",
           "rule_passport", "dim_current", "first_load", "scd2_diff", "scd2_merge",
           "series_log", "state_of", "with_lags"]
