import os

import pytest

from tabclass.operators.partitioning import persisted, repartition_rows, set_shuffle_partitions
from tabclass.plans import recipes
from tabclass.plans.smoke import ok_profiles, smoke
from tabclass.sources.catalog import REFERENCE_DATASETS, DatasetSpec
from tabclass.sources.metrics_store import run_folder


def test_smoke_reports_missing_files_and_keeps_going(spark, tmp_dir):
    path = os.path.join(tmp_dir, "s.csv")
    with open(path, "w") as f:
        f.write("age,gender,country,daily_usage_hours,primary_platform,num_platforms_used,purpose,"
                "avg_session_minutes,night_usage,mental_health_score,addiction_level,screen_time_before_sleep\n"
                "21,M,IN,5.5,TT,3,Fun,30,1,6.5,High,1.5\n")
    good = DatasetSpec("gen_z_social", path, "addiction_level", "medium", normalize=recipes.normalize_social)
    rep = smoke(spark, [REFERENCE_DATASETS[1], good], root=tmp_dir)
    rows = {r.dataset: r for r in rep.profiles.collect()}
    assert rows["fraud_detection"].status == "error"
    assert rows["gen_z_social"].rows == 1 and rows["gen_z_social"].columns == 12
    assert rep.samples["gen_z_social"].count() == 1
    assert ok_profiles(rep).count() == 1
    with pytest.raises(ValueError):
        smoke(spark, [good], dataset_filter="nope")


def test_partitioning_helpers(spark):
    with pytest.raises(ValueError):
        repartition_rows(spark.range(3), 0)
    with pytest.raises(ValueError):
        set_shuffle_partitions(spark, 0)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    set_shuffle_partitions(spark, 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert repartition_rows(spark.range(10), 4).rdd.getNumPartitions() == 4
    df = spark.range(100)
    with persisted(df) as d:
        assert d.storageLevel.useMemory and d.count() == 100
    assert not df.storageLevel.useMemory


def test_run_folder_name():
    assert run_folder("/x/results/", 4, 8) == "/x/results/experiments_w4_p8"


def test_balance_partitions(spark):
    from tabclass.operators.partitioning import balance_partitions

    one = spark.range(100).coalesce(1)
    assert balance_partitions(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert balance_partitions(many, 4) is many


def test_scratch_lives_under_the_configured_checkpoint_dir(spark):
    from tabclass.operators.partitioning import materialize
    from tabclass.session import ensure_checkpoint_dir, scratch_path

    configured = spark.conf.get("spark.checkpoint.dir")
    ckpt = ensure_checkpoint_dir(spark)
    assert configured.rstrip("/") in ckpt  # the session's folder is used, not a new one
    assert scratch_path(spark, "x").startswith(ckpt.rstrip("/"))
    copy = materialize(spark.range(10), "parquet")
    assert copy.count() == 10 and configured.rstrip("/") in copy.inputFiles()[0]
