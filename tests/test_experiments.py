import pytest
from pyspark.sql import functions as F

from tabclass.plans import standins as S
from tabclass.plans.experiments import RunConfig, experiment_grid, run_experiments
from tabclass.plans.models import ClassifierRegistry, decision_tree, default_classifiers, naive_bayes
from tabclass.plans.results import sweep_speedup, time_by_classifier, total_time
from tabclass.session import scratch_path
from tabclass.sources.metrics_store import MetricsSink, metrics_frame, read_metrics

from conftest import SF001


def _boom():
    raise RuntimeError("factory failed")


def test_grid_order():
    assert experiment_grid(["a", "b"], ["x", "y"]) == [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")]


def test_run_and_error_policy(spark):
    reg = ClassifierRegistry({"naive_bayes": naive_bayes, "broken": _boom, "decision_tree": decision_tree})
    rows = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig())
    by = {r["classifier"]: r for r in rows}
    assert by["broken"]["status"] == "error" and "factory failed" in by["broken"]["error"]
    for name in ("naive_bayes", "decision_tree"):
        r = by[name]
        assert r["status"] == "ok" and 0.0 <= r["accuracy"] <= 1.0 and 0.0 <= r["f1"] <= 1.0
        assert abs(r["total_time_s"] - r["train_time_s"] - r["predict_time_s"]) < 1e-9
    # the part recipe is learnable: better than the majority class
    assert by["decision_tree"]["accuracy"] > 0.5


def test_unknown_names_raise(spark):
    with pytest.raises(ValueError):
        run_experiments(spark, [S.salary_experiment(SF001)], dataset_filter="nope")
    with pytest.raises(ValueError):
        run_experiments(spark, [S.salary_experiment(SF001)], classifier_filter="nope")
    with pytest.raises(ValueError):
        RunConfig(partitions=0)


def test_failing_dataset_is_recorded(spark):
    from tabclass.plans.experiments import ExperimentDataset

    bad = ExperimentDataset("bad", lambda s: s.range(3).withColumn("t", F.lit("a")), target="missing", keys=("id",))
    rows = run_experiments(spark, [bad, S.salary_experiment(SF001)], ClassifierRegistry({"naive_bayes": naive_bayes}))
    assert rows[0]["status"] == "error" and rows[1]["status"] == "ok"


def test_nb_same_at_any_partitioning(spark):
    reg = ClassifierRegistry({"naive_bayes": naive_bayes})
    accs = {
        p: run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(partitions=p))[0]["accuracy"]
        for p in (1, 4)
    }
    assert abs(accs[1] - accs[4]) < 1e-12


def test_random_split_and_train_scope_options(spark):
    reg = ClassifierRegistry({"naive_bayes": naive_bayes})
    r1 = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(split_method="random"))
    r2 = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(fit_scope="train"))
    r3 = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(split_method="stratified", materialize="checkpoint"))
    r4 = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(materialize="parquet"))
    r5 = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig())
    assert all(r[0]["status"] == "ok" for r in (r1, r2, r3, r4))
    assert r4[0]["accuracy"] == r5[0]["accuracy"]


def test_sink_roundtrip_and_union(spark):
    base = scratch_path(spark, "test-runs")
    reg = ClassifierRegistry({"naive_bayes": naive_bayes})
    for p in (1, 2):
        cfg = RunConfig(partitions=p, sink=MetricsSink(spark, f"{base}/experiments_w1_p{p}", "csv"))
        run_experiments(spark, [S.salary_experiment(SF001)], reg, config=cfg)
    back = read_metrics(spark, f"{base}/experiments_w*", "csv")
    rows = back.orderBy("partitions").collect()
    assert [r.partitions for r in rows] == [1, 2] and rows[0].accuracy == rows[1].accuracy
    pq = MetricsSink(spark, f"{base}/pq", "parquet")
    pq.append({"dataset": "d", "classifier": "c", "workers": 1, "partitions": 1, "accuracy": 0.5})
    assert pq.read().first().accuracy == 0.5


FIXED = [
    # dataset, classifier, workers, partitions, acc, f1, train, predict
    ("d1", "random_forest", 1, 1, 0.9, 0.9, 10.0, 2.0),
    ("d1", "naive_bayes", 1, 1, 0.8, 0.8, 1.0, 1.0),
    ("d1", "random_forest", 4, 4, 0.9, 0.9, 4.0, 2.0),
    ("d1", "naive_bayes", 4, 4, 0.8, 0.8, 0.5, 0.5),
    ("d2", "random_forest", 1, 1, 0.7, 0.6, 20.0, 4.0),
    ("d2", "random_forest", 8, 8, 0.7, 0.6, 5.0, 1.0),
]


def _fixed(spark):
    rows = [
        dict(zip(["dataset", "classifier", "workers", "partitions", "accuracy", "f1", "train_time_s", "predict_time_s"], r))
        for r in FIXED
    ]
    return total_time(metrics_frame(spark, rows).drop("total_time_s"))


def test_result_operators(spark):
    res = _fixed(spark)
    assert [r.total_time_s for r in res.collect()] == [12.0, 2.0, 6.0, 1.0, 24.0, 6.0]
    tbc = time_by_classifier(res).collect()
    assert [(r.classifier, r.total_time_s) for r in tbc] == [("random_forest", 48.0), ("naive_bayes", 3.0)]
    sp = {(r.dataset, r.classifier, r.partitions): r.speedup for r in sweep_speedup(res).collect()}
    assert sp[("d1", "random_forest", 4)] == 2.0 and sp[("d2", "random_forest", 8)] == 4.0
    assert sp[("d1", "naive_bayes", 1)] == 1.0


def test_registry_defaults():
    reg = default_classifiers()
    assert reg.names() == ["random_forest", "decision_tree", "naive_bayes"]
    rf = reg.create("random_forest")
    assert rf.getNumTrees() == 100 and rf.getMaxDepth() == 10 and rf.getSeed() == 42
    assert reg.create("naive_bayes").getModelType() == "gaussian"


def test_single_pass_scores_equal_mllib_evaluators(spark):
    from tabclass.operators.split import split_frames
    from tabclass.plans.experiments import prepare
    from tabclass.plans.training import train_and_evaluate

    table, _ = prepare(spark, S.salary_experiment(SF001), RunConfig())
    train, test = split_frames(table)
    a = train_and_evaluate(train, test, naive_bayes(), "confusion")
    b = train_and_evaluate(train, test, naive_bayes(), "mllib")
    assert abs(a.scores.accuracy - b.scores.accuracy) < 1e-12
    assert abs(a.scores.weighted_f1 - b.scores.weighted_f1) < 1e-12
    table.unpersist()


def test_train_scoped_cut_points(spark):
    from tabclass.operators.columns import cast_double
    from tabclass.operators.quantiles import TERCILE_LABELS, bin_by_cut_points, exact_quantiles
    from tabclass.operators.split import hash_split_flag

    train = hash_split_flag(["p_partkey"]) == "train"
    raw = cast_double(S.salary_raw(spark, SF001), ["salary"])
    cuts = exact_quantiles(raw.where(train), "salary", [1 / 3, 2 / 3])
    got = S.recipe_salary(spark, SF001, fit_filter=train).join(raw.select("p_partkey", "salary"), "p_partkey")
    want = got.withColumn("w", bin_by_cut_points("salary", cuts, TERCILE_LABELS))
    assert want.where("w <> price_tercile").count() == 0
    rows = run_experiments(spark, [S.salary_experiment(SF001)], ClassifierRegistry({"naive_bayes": naive_bayes}),
                           config=RunConfig(fit_scope="train"))
    assert rows[0]["status"] == "ok"


def test_per_class_report(spark):
    from tabclass.plans.results import per_class_report

    rows = run_experiments(spark, [S.salary_experiment(SF001)], ClassifierRegistry({"naive_bayes": naive_bayes}))
    rep = per_class_report(spark, rows).collect()
    assert len(rep) == 3 and sum(r.support for r in rep) == sum(n for _, _, n in rows[0]["confusion"])
    wf1 = sum(r.f1 * r.support for r in rep) / sum(r.support for r in rep)
    assert abs(wf1 - rows[0]["f1"]) < 1e-12


def _interrupt():
    raise KeyboardInterrupt  # not an Exception: the run stops, like a crash


def test_sink_keeps_finished_rows_after_a_crash(spark):
    base = scratch_path(spark, "crash")
    reg = ClassifierRegistry({"naive_bayes": naive_bayes, "crash": _interrupt})
    cfg = RunConfig(sink=MetricsSink(spark, base, "csv"))
    with pytest.raises(KeyboardInterrupt):
        run_experiments(spark, [S.salary_experiment(SF001)], reg, config=cfg)
    rows = read_metrics(spark, base, "csv").collect()
    assert [r.classifier for r in rows] == ["naive_bayes"] and rows[0].status == "ok"


def test_keep_predictions(spark):
    from tabclass.operators.split import split_frames
    from tabclass.plans.experiments import prepare
    from tabclass.plans.training import train_and_evaluate

    table, _ = prepare(spark, S.salary_experiment(SF001), RunConfig())
    train, test = split_frames(table)
    res = train_and_evaluate(train, test, naive_bayes(), keep_predictions=True)
    assert res.predictions is not None and res.predictions.count() == test.count() == res.scores.rows
    res.predictions.unpersist()
    table.unpersist()


def test_keyless_dataset_with_hash_and_stratified_splits(spark):
    from tabclass.plans.experiments import ExperimentDataset

    keyless = ExperimentDataset(
        "part_keyless", lambda s: S.recipe_salary(s, SF001).drop("p_partkey"), target="price_tercile"
    )
    reg = ClassifierRegistry({"naive_bayes": naive_bayes})
    for method in ("hash", "stratified"):
        rows = run_experiments(spark, [keyless], reg, config=RunConfig(split_method=method))
        assert rows[0]["status"] == "ok", rows[0]["error"]
        assert 0.3 < rows[0]["accuracy"] <= 1.0
