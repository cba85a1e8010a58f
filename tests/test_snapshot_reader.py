"""The snapshot reader over a catalog table and over files."""

from cardlake.sources.staging import snapshot_reader, stage_accounts


def test_table_and_file_snapshots_stage_alike(spark, tmp_path):
    src = spark.sql("SELECT 'A1' AS account, DATE'2030-01-01' AS valid_to, 'K1' AS client, "
                    "TIMESTAMP'2020-01-01 00:00:00' AS create_dt, "
                    "CAST(NULL AS TIMESTAMP) AS update_dt")
    src.createOrReplaceTempView("ops_accounts")
    src.write.option("header", True).csv(str(tmp_path / "accounts_csv"))
    from_table = stage_accounts(snapshot_reader(spark, "table", "ops_accounts"))
    from_csv = stage_accounts(snapshot_reader(spark, "csv", str(tmp_path / "accounts_csv"),
                                              header="true"))
    assert from_table.columns == ["account_num", "valid_to", "client", "create_dt", "update_dt"]
    assert [tuple(r) for r in from_table.collect()] == [tuple(r) for r in from_csv.collect()]
