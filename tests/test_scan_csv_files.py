"""The CSV round trip is written by as many tasks as read the table."""
from tabclass.plans import queries as Q


def test_scan_csv_records_writes_a_file_a_partition(spark, tmp_dir, monkeypatch):
    rows = [(i, f'line "{i}"\nand another, of {i}', "en", "s", 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(128 << 20))  # a split for each file
    try:
        got = Q.q_scan_csv_records(spark, tmp_dir)
    finally:
        spark.conf.set(key, before)
    assert sorted(map(tuple, got.collect())) == rows
    assert len(spark.read.text(f"{tmp_dir}/scan_csv_records").inputFiles()) == 4
