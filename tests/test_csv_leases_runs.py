"""Parallel CSV records, leases on durable tables, atomic and resumable runs."""
import random

import pytest
from pyspark.sql import functions as F

from tabclass.plans import standins as S
from tabclass.plans.experiments import RunConfig, run_experiments
from tabclass.plans.models import ClassifierRegistry, naive_bayes
from tabclass.session import scratch_path
from tabclass.sources.catalog import DatasetSpec
from tabclass.sources.csv_records import cut_records, read_csv_records, split_parity
from tabclass.sources.files import header_names, read_csv, write_csv
from tabclass.sources.leases import Lease, file_system, leased_table, leases, leases_released, release, sweep
from tabclass.sources.metrics_store import MetricsSink, pair_key

from conftest import SF001


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def odd_rows(n, seed=0):
    rng = random.Random(seed)
    texts = ["", None, "plain", "two\nlines", 'a "quoted" word', '"', '""\n"', "\n\n", "comma, comma", "  spaced  ", "x\n" * 700, "end\r\nof", "é\n𝒳"]
    return [(i, rng.choice(texts), rng.choice(texts)) for i in range(n)]


def test_records_equal_the_one_task_reader(spark, small_splits):
    df = spark.createDataFrame(odd_rows(300), "id long, `a b` string, c string")
    path = scratch_path(spark, "records")
    write_csv(df.coalesce(1), path)
    write_csv(df.where("id < 0").coalesce(1), path, mode="append")  # a file of a header alone, or none
    write_csv(df.where("id < 5").coalesce(1), path, mode="append")
    got = read_csv_records(spark, path, df.schema)
    want = read_csv(spark, path, schema=df.schema, multi_line=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 305
    assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 50  # far more tasks than files
    release(got)


def test_records_of_crlf_files_and_headers_over_lines(spark, tmp_dir, small_splits):
    rows = "".join(f'{i},"v{i}\r\nw ""{i}"""\r\n' for i in range(200))
    with open(f"{tmp_dir}/a.csv", "wb") as f:
        f.write(b'id,"my\r\nname"\r\n' + rows.encode() + b"\r\n200,last")
    got = {r[0]: r[1] for r in read_csv_records(spark, tmp_dir).collect()}
    assert header_names(spark, tmp_dir) == ["id", "my\r\nname"]
    assert got == {str(i): f'v{i}\r\nw "{i}"' for i in range(200)} | {"200": "last"}


def test_files_without_newlines_in_fields_are_not_copied(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('x,y\n1,"a ""b"" c"\n2,\n')
    before = len(leases(spark))
    got = read_csv_records(spark, tmp_dir)
    assert sorted(map(tuple, got.collect())) == [("1", 'a "b" c'), ("2", None)] and len(leases(spark)) == before


def test_header_and_schema_must_agree(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("x,y\n1,2\n")
    from pyspark.sql.types import StringType, StructField, StructType

    with pytest.raises(ValueError, match="header"):
        read_csv_records(spark, tmp_dir, StructType([StructField("x", StringType()), StructField("z", StringType())]))


def test_cut_records_of_any_split_of_a_file():
    text = 'h\n1,"a\nb"\n2,x\n3,"c\n\nd ""e""\n"\n4,y'.split("\n")
    whole, _ = cut_records(text, 0)
    for i in range(len(text) + 1):
        for j in range(i, len(text) + 1):
            inside, out, open_ = 0, [], ""
            for part in (text[:i], text[i:j], text[j:]):
                found, inside = cut_records(part, inside)
                for kind, piece in found:
                    if kind in (0, 2):
                        out.append(piece)
                    else:
                        out[-1] += "\n" + piece
            assert out == [t for _, t in whole]


def test_split_parity_is_a_prefix_by_file(spark):
    rows = [(1, 0, 'a"'), (1, 9, "b"), (1, 20, 'c"d"e"'), (2, 0, "f"), (2, 5, "g")]
    got = {(r.file, r.split): r.inside for r in split_parity(spark.createDataFrame(rows, "file long, split long, value string")).collect()}
    assert got == {(1, 0): 0, (1, 9): 1, (1, 20): 1, (2, 0): 0, (2, 5): 0}


def test_catalog_reads_quoted_newlines_and_booleans(spark, tmp_dir):
    from tabclass.operators.columns import cast_columns

    with open(f"{tmp_dir}/d.csv", "w") as f:
        f.write('flag,mixed,none,note,y\nTrue,True,,"a\nb",1\nfalse,1,,c,0\n,x,,d,1\n')
    casts = {"flag": "int", "mixed": "long", "none": "double", "y": "double"}
    spec = DatasetSpec("d", "d.csv", "y", "small", normalize=lambda df: cast_columns(df, casts))
    got = sorted(map(tuple, spec.run(spark, tmp_dir).collect()), key=str)
    assert got == sorted([(1, None, None, "a\nb", 1.0), (0, 1, None, "c", 0.0), (None, None, None, "d", 1.0)], key=str)
    inferred = DatasetSpec("d", "d.csv", "y", "small", infer_types=True, normalize=spec.normalize)
    assert sorted(map(tuple, inferred.run(spark, tmp_dir).collect()), key=str) == got
    seen = []
    custom = DatasetSpec("e", "d.csv", "y", "small", loader=lambda s, sp: seen.append(sp.path) or s.range(1))
    custom.load(spark, tmp_dir)
    assert seen == [f"{tmp_dir}/d.csv"]


# ------------------------------------------------------------------ leases
def exists(spark, path):
    fs, at = file_system(spark, path)
    return fs.exists(at)


def test_a_lease_deletes_its_table_once(spark):
    df = leased_table(spark.range(5), "lease")
    path = df._lease.path
    assert exists(spark, path) and path in [x["path"] for x in leases(spark)]
    release(df)
    release(df)
    assert not exists(spark, path) and path not in [x["path"] for x in leases(spark)]


def test_a_failed_write_leaves_nothing(spark):
    before = len(leases(spark))
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        leased_table(bad, "bad")
    assert len(leases(spark)) == before


def test_sweep_takes_only_old_leases_of_others(spark, monkeypatch):
    import json

    from tabclass.sources import leases as module

    mine, others = leased_table(spark.range(2), "mine"), leased_table(spark.range(2), "theirs")
    record = json.loads(module.read_text(spark, others._lease.marker)) | {"owner": "another", "made": 0}
    module.write_text(spark, others._lease.marker, json.dumps(record))
    assert sweep(spark, 1e12) == []
    assert sweep(spark, 60) == [others._lease.path]
    assert exists(spark, mine._lease.path) and not exists(spark, others._lease.path)
    release(mine)


@pytest.mark.parametrize("how", ["parquet", "checkpoint", "persist"])
@pytest.mark.parametrize("fails", [False, True])
def test_runs_leave_no_durable_copy(spark, how, fails):
    def broken():
        raise KeyboardInterrupt

    before = {x["path"] for x in leases(spark)}
    reg = ClassifierRegistry({"naive_bayes": naive_bayes} | ({"stop": broken} if fails else {}))
    run = lambda: run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(materialize=how, split_method="stratified"))
    if fails:
        with pytest.raises(KeyboardInterrupt):
            run()
    else:
        assert run()[0]["status"] == "ok"
    assert {x["path"] for x in leases(spark)} == before


def test_leases_released_when_the_block_fails(spark):
    with pytest.raises(ZeroDivisionError):
        with leases_released():
            df = leased_table(spark.range(1), "block")
            1 / 0
    assert not exists(spark, df._lease.path)


def test_a_lease_is_there_before_its_table(spark):
    lease = Lease(spark, scratch_path(spark, "never"))
    assert lease.path in [x["path"] for x in leases(spark)]
    lease.release()


# -------------------------------------------------------------------- runs
class Counted:
    def __init__(self, stop_at=None, fail_at=()):
        self.made, self.stop_at, self.fail_at = 0, stop_at, fail_at

    def __call__(self):
        self.made += 1
        if self.made == self.stop_at:
            raise KeyboardInterrupt
        if self.made in self.fail_at:
            raise RuntimeError("fails")
        return naive_bayes()


def test_a_stopped_run_resumes_after_its_last_pair(spark):
    path = scratch_path(spark, "resume")
    datasets = [S.salary_experiment(SF001), S.social_experiment(SF001)]
    first = Counted(stop_at=4)
    names = ("a", "b")
    with pytest.raises(KeyboardInterrupt):
        run_experiments(spark, datasets, ClassifierRegistry({n: first for n in names}), config=RunConfig(sink=MetricsSink(spark, path)))
    stored = {pair_key(r.asDict()): r.asDict() for r in MetricsSink(spark, path).read().collect()}
    assert len(stored) == 3
    second = Counted()
    sink = MetricsSink(spark, path)
    rows = run_experiments(spark, datasets, ClassifierRegistry({n: second for n in names}), config=RunConfig(sink=sink), resume=True)
    assert second.made == 1 and len(rows) == 4
    after = {pair_key(r.asDict()): r.asDict() for r in sink.read().collect()}
    assert len(after) == 4 == sink.read().count() and all(after[k] == v for k, v in stored.items())
    third = Counted()
    run_experiments(spark, datasets, ClassifierRegistry({n: third for n in names}), config=RunConfig(sink=sink), resume=True)
    assert third.made == 0


def test_a_failed_pair_runs_again_and_its_row_is_replaced(spark):
    path = scratch_path(spark, "again")
    for made, status in ((Counted(fail_at=(1,)), "error"), (Counted(), "ok")):
        run_experiments(spark, [S.salary_experiment(SF001)], ClassifierRegistry({"a": made}), config=RunConfig(sink=MetricsSink(spark, path, "csv")), resume=True)
        assert [r.status for r in MetricsSink(spark, path, "csv").read().collect()] == [status]


def test_rows_aside_are_not_read(spark):
    sink = MetricsSink(spark, scratch_path(spark, "aside"))
    sink.start()
    sink.append({"dataset": "d", "classifier": "c", "status": "ok"})
    sink.read().write.parquet(f"{sink.path}/_aside/half")  # a writer that died before its rename
    assert sink.read().count() == 1
    sink.start(resume=True)
    assert not exists(spark, f"{sink.path}/_aside") and sink.read().count() == 1


def test_resume_needs_a_sink(spark):
    with pytest.raises(ValueError, match="sink"):
        run_experiments(spark, [S.salary_experiment(SF001)], config=RunConfig(), resume=True)


# ------------------------------------------------------------ side by side
def test_fits_side_by_side_give_the_serial_rows(spark):
    import threading
    import time

    from tabclass.plans.models import decision_tree

    at_once, most, lock = 0, 0, threading.Lock()

    class Slow:
        """Naive Bayes that is seen to run beside another."""

        def fit(self, df):
            nonlocal at_once, most
            with lock:
                at_once += 1
                most = max(most, at_once)
            time.sleep(0.5)
            model = naive_bayes().fit(df)
            with lock:
                at_once -= 1
            return model

    def broken():
        raise RuntimeError("fails")

    reg = ClassifierRegistry({"a": Slow, "tree": decision_tree, "b": Slow, "broken": broken, "c": Slow})
    sink = MetricsSink(spark, scratch_path(spark, "together"))
    pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    together = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig(side_by_side=2, sink=sink))
    assert most == 2  # no more than were asked for
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == pool  # the caller's thread keeps its own
    serial = run_experiments(spark, [S.salary_experiment(SF001)], reg, config=RunConfig())
    strip = lambda rows: [{k: v for k, v in r.items() if not k.endswith("_s")} for r in rows]
    cells = lambda rows: [dict(r, confusion=sorted(r.get("confusion") or [])) for r in strip(rows)]
    assert cells(together) == cells(serial) and sink.read().count() == 5
    assert [r["status"] for r in together] == ["ok", "ok", "ok", "error", "ok"]
    with pytest.raises(ValueError, match="at a time"):
        RunConfig(side_by_side=0)
