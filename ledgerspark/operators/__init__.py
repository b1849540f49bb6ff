from ledgerspark.operators.aggregates import (
    grouped_sum,
    monthly_trend,
    plan_vs_actual,
    signed_rollup,
    top_groups,
    totals,
)
from ledgerspark.operators.joins import (
    Lookup,
    decorate,
    dedupe_on_key,
    one_name_per_key,
    orphan_keys,
    orphan_rows,
    pack,
    star_join,
    unpack,
    weighted_sum,
)
from ledgerspark.operators.profiling import (
    merge_profiles,
    profile_sketches,
    table_profile,
    table_shape,
)
from ledgerspark.operators.quality import (
    ContractField,
    Expectation,
    SuiteFailed,
    apply_contract,
    contract_violations,
    failures,
    gate,
    read_suite,
    run_suite,
    split_by_contract,
    statistics,
    suite_from_json,
    suite_to_json,
    write_results,
    write_suite,
)
from ledgerspark.operators.rules import (
    allowed_pairs,
    duplicate_values,
    expression_violations,
    reconcile,
    unexpected_values,
    unequal_columns,
)
from ledgerspark.operators.series import (
    missing_from,
    missing_periods,
    period_scaffold,
    prior_period_delta,
)

__all__ = [
    "ContractField",
    "Expectation",
    "Lookup",
    "SuiteFailed",
    "allowed_pairs",
    "apply_contract",
    "contract_violations",
    "decorate",
    "dedupe_on_key",
    "duplicate_values",
    "expression_violations",
    "failures",
    "gate",
    "grouped_sum",
    "merge_profiles",
    "missing_from",
    "missing_periods",
    "monthly_trend",
    "one_name_per_key",
    "orphan_keys",
    "orphan_rows",
    "pack",
    "period_scaffold",
    "plan_vs_actual",
    "prior_period_delta",
    "profile_sketches",
    "read_suite",
    "reconcile",
    "run_suite",
    "signed_rollup",
    "split_by_contract",
    "star_join",
    "statistics",
    "suite_from_json",
    "suite_to_json",
    "table_profile",
    "table_shape",
    "top_groups",
    "totals",
    "unequal_columns",
    "unexpected_values",
    "unpack",
    "weighted_sum",
    "write_results",
    "write_suite",
]
