"""The engine-neutral rendering used by every registered query."""

from cardlake.plans.present import for_check


def test_dates_timestamps_decimals_render_as_plain_values(spark):
    df = spark.sql("SELECT DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 03:04:05.5' AS ts, "
                   "CAST(10.5 AS DECIMAL(18,2)) AS amt, 7L AS n, 'x' AS s, TRUE AS b, "
                   "CAST(NULL AS DATE) AS nd")
    r = for_check(df).first()
    assert (r.d, r.ts, r.amt, r.n, r.s, r.b, r.nd) == \
        ("2024-01-02", "2024-01-02 03:04:05.500000", 10.5, 7, "x", True, None)
    assert for_check(df).columns == df.columns
