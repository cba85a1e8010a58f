"""The four fraud rules as boolean columns (never NULL: an unknown predicate is false)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardlake.schemas import PROBE_MIN_COUNT, RESULT_REJECT, RESULT_SUCCESS

RULES = {
    # Passport blacklisted (any date, Q8) or expired before the operation (a date compares as its midnight, Q3)
    "bad_passport": "black_list_dt IS NOT NULL OR coalesce(passport_valid_to < trans_date, FALSE)",
    # R2: the account's contract ended before the operation
    "bad_contract": "coalesce(valid_to < trans_date, FALSE)",
    # Two known cities within the preceding hour
    "city_hop": "city_change_1h",
    # More than three operations in 20 minutes, amounts strictly falling over three, results REJECT, REJECT, SUCCESS
    "amount_probe": f"coalesce(ops_20m > {PROBE_MIN_COUNT} AND amt < prev_amt AND prev_amt < prev2_amt "
                    f"AND oper_result = '{RESULT_SUCCESS}' AND prev_result = '{RESULT_REJECT}' "
                    f"AND prev2_result = '{RESULT_REJECT}', FALSE)",
}


def with_flags(windowed: DataFrame) -> DataFrame:
    return windowed.selectExpr("*", *[f"{sql} AS {name}" for name, sql in RULES.items()])
