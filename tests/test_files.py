import os

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import balance as B
from tallygrid.plans import collect as P, launch, merge as M
from tallygrid.schema import STATS
from tallygrid.session import broadcast_if_small, clear_work, materialize, shared_dir
from tallygrid.sinks.stats import write_batches, write_stats
from tallygrid.sources import catalogue as Cat, fragments as S

HEADER = "     shots,    errors,  discards, seconds,decoder,strong_id,json_metadata,custom_counts\n"


def line(shots, errors, strong_id, counts='"{""n"":1}"'):
    return f'{shots:10d},{errors:10d},         0,    1.50,m,{strong_id},"{{""d"":3,""p"":""0.1""}}",{counts}\n'


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def totals(df):
    return {r.strong_id: (r.shots, r.errors) for r in M.merge(df).collect()}


def test_padded_quoted_blank_and_truncated_rows(spark, tmp_path):
    write(f"{tmp_path}/batch_0/stats.csv", HEADER + line(10, 1, "a") + "\n" + line(20, 2, "b") + "10")
    raw = S.read_raw(spark, str(tmp_path))
    assert totals(S.good_rows(raw)) == {"a": (10, 1), "b": (20, 2)}
    assert S.quarantine(raw).count() == 1
    counts = M.merge(S.good_rows(raw), with_counters=True)
    assert {r.strong_id: r.custom_counts for r in counts.collect()} == {"a": {"n": 1}, "b": {"n": 1}}


def test_row_cut_inside_its_json(spark, tmp_path):
    write(f"{tmp_path}/batch_0/stats.csv", HEADER + line(10, 1, "a") + line(20, 2, "b", '"{""n"":').rstrip("\n"))
    raw = S.read_raw(spark, str(tmp_path))
    assert totals(S.good_rows(raw)) == {"a": (10, 1)}
    assert S.quarantine(raw).count() == 1


def test_files_without_named_counters(spark, tmp_path):
    header = HEADER.replace(",custom_counts", "")
    seven = [line(n, 1, i, "").rstrip(",\n") for n, i in ((10, "a"), (20, "b"))]
    cut = line(30, 1, "c", "").rstrip(",\n")[:-4]
    write(f"{tmp_path}/batch_0/stats.csv", header + "\n".join([*seven, cut]))
    write(f"{tmp_path}/batch_1/stats.csv", HEADER + line(5, 1, "a"))
    raw = S.read_raw(spark, str(tmp_path))
    assert totals(S.good_rows(raw)) == {"a": (15, 2), "b": (20, 1)}
    assert S.quarantine(raw).count() == 1
    merged = M.merge(S.good_rows(raw), with_counters=True)
    assert {r.strong_id: r.custom_counts for r in merged.collect()} == {"a": {"n": 1}, "b": {}}


def test_missing_counts_are_good(spark, tmp_path):
    write(f"{tmp_path}/stats.csv", HEADER + line(10, 1, "a", ""))
    assert totals(S.read_fragments(spark, str(tmp_path))) == {"a": (10, 1)}


def test_stats_files_come_before_other_csv_files(spark, tmp_path):
    write(f"{tmp_path}/x/deep/stats.csv", HEADER + line(10, 1, "a"))
    write(f"{tmp_path}/y/other.csv", HEADER + line(99, 9, "b"))
    root = str(tmp_path)
    assert totals(S.read_fragments(spark, root)) == {"a": (10, 1)}
    assert totals(S.read_fragments(spark, root, "auto")) == {"a": (10, 1)}
    assert totals(S.read_fragments(spark, root, "any")) == {"a": (10, 1), "b": (99, 9)}
    assert totals(S.read_fragments(spark, f"{root}/y", "auto")) == {"b": (99, 9)}
    with pytest.raises(FileNotFoundError):
        S.read_fragments(spark, f"{root}/y")
    with pytest.raises(ValueError):
        S.read_fragments(spark, root, "other")


@pytest.fixture
def snapshots(tmp_path):
    write(f"{tmp_path}/batch_0/stats.partial.csv", HEADER + line(10, 1, "a"))
    write(f"{tmp_path}/batch_0/stats.csv", HEADER + line(10, 1, "a") + line(20, 2, "a"))
    write(f"{tmp_path}/batch_1/stats.partial.3.csv", HEADER + line(1, 0, "a") + line(2, 0, "b"))
    write(f"{tmp_path}/batch_1/stats.partial.12.csv", HEADER + line(1, 0, "a") + line(2, 0, "b") + line(4, 0, "b"))
    return str(tmp_path)


def test_newest_snapshot_of_each_batch(spark, snapshots):
    assert totals(S.read_latest(spark, snapshots)) == {"a": (31, 3), "b": (6, 0)}
    merged = M.merge_folder(spark, snapshots)
    assert {r.strong_id: r.shots for r in merged.collect()} == {"a": 31, "b": 6}


def test_long_choices_are_joined(spark, snapshots, monkeypatch):
    monkeypatch.setattr(S, "MAX_EXPLICIT_PATHS", 1)
    assert totals(S.read_latest(spark, snapshots)) == {"a": (31, 3), "b": (6, 0)}


def test_only_the_chosen_files_are_scanned(spark, snapshots):
    assert len(S.read_latest(spark, snapshots).inputFiles()) == 2


def test_copied_file_is_summed_and_reported(spark, tmp_path):
    same = HEADER + line(10, 1, "a") + line(10, 1, "a")
    write(f"{tmp_path}/batch_0/stats.csv", same)
    write(f"{tmp_path}/batch_1/stats.csv", same)
    write(f"{tmp_path}/batch_2/stats.csv", HEADER + line(10, 1, "a"))
    raw = S.read_raw(spark, str(tmp_path))
    assert totals(S.good_rows(raw)) == {"a": (50, 5)}
    copy = S.duplicate_files(raw).first()
    assert (copy.n_files, copy.n_rows) == (2, 2) and copy.first_file.endswith("batch_0/stats.csv")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_written_counters_read_back(spark, tmp_path, fmt):
    rows = [(7, 1, 0, 0.25, "m", "b", '{"d":3,"x":"a,\\"q\\""}', '{"n":1}'), (5, 0, 0, 0.5, "m", "a", None, None)]
    df = spark.createDataFrame(rows, STATS)
    out = f"{tmp_path}/deep/er/out"
    write_stats(df, out, fmt)
    back = S.read_fragments(spark, out, "any").drop("file_path") if fmt == "csv" else spark.read.schema(STATS).parquet(out)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_merge_writes_a_header_and_sorted_ids(spark, snapshots, tmp_path):
    M.merge_folder(spark, snapshots, f"{tmp_path}/merged")
    lines = [x for name in sorted(os.listdir(f"{tmp_path}/merged")) if name.endswith(".csv") for x in open(f"{tmp_path}/merged/{name}")]
    assert lines[0].startswith("shots,errors,discards,seconds,decoder,strong_id")
    assert [x.split(",")[5] for x in lines if not x.startswith("shots")] == ["a", "b"]


def test_rewriting_a_run_leaves_the_others(spark, tmp_path):
    out = f"{tmp_path}/batches"
    rows = spark.createDataFrame([("x", 0), ("y", 1)], "path string, batch_id long")
    write_batches(rows, out, "r1")
    write_batches(rows, out, "r2")
    write_batches(rows.filter("batch_id = 0").withColumn("path", F.lit("z")), out, "r2")
    got = {(r.run_id, r.batch_id, r.path) for r in spark.read.parquet(out).collect()}
    assert got == {("r1", 0, "x"), ("r1", 1, "y"), ("r2", 0, "z"), ("r2", 1, "y")}


@pytest.fixture
def sweep(tmp_path):
    for k in (1, 2):
        for p in ("0.001", "0.01"):
            write(f"{tmp_path}/sweep/family_K={k}_p={p}.circuit", "M 0\n" * k)
    write(f"{tmp_path}/sweep/notes.txt", "no")
    return str(tmp_path)


def test_catalogue_and_plans(spark, sweep):
    files = Cat.read_catalogue(spark, f"{sweep}/sweep", "circuit")
    assert sorted(r.stem for r in files.collect())[0] == "family_K=1_p=0.001"
    assert {r.text for r in files.collect()} == {"M 0\n", "M 0\nM 0\n"}
    with pytest.raises(FileNotFoundError):
        Cat.read_catalogue(spark, f"{sweep}/sweep", "other")

    sizes = launch.plan_by_count(spark, f"{sweep}/sweep", "circuit", f"{sweep}/out", per_batch=3)
    assert {r.batch_id: r.n_items for r in sizes.collect()} == {0: 2, 1: 2}

    write(f"{sweep}/timings.csv", "K,p,seconds\n1,0.001,9\n1,0.001,5\n1,0.01,4\n2,0.001,3\n2,0.01,3\n")
    timings = Cat.read_timings(spark, f"{sweep}/timings.csv")
    assert timings.filter("K = 1 and p = 0.001").first().seconds == 5
    loads = launch.plan_by_cost(spark, f"{sweep}/sweep", "circuit", timings, 2, f"{sweep}/cost", run_id="r")
    assert {r.batch_id: r.load for r in loads.collect()} == {0: 8.0, 1: 7.0}
    written = spark.read.parquet(f"{sweep}/cost")
    assert written.select("path").distinct().count() == 4 and B.shared_items(written).count() == 0
    with pytest.raises(ValueError):
        launch.plan_by_cost(spark, f"{sweep}/sweep", "circuit", timings.filter("K = 1"), 2, f"{sweep}/cost2")


def test_bad_names_stop_the_plan(spark, sweep):
    write(f"{sweep}/sweep/family_K=x_p=0.1.circuit", "M 0")
    with pytest.raises(ValueError, match="K and p"):
        launch.with_grid_keys(Cat.read_catalogue(spark, f"{sweep}/sweep", "circuit"))


def test_collection_resumes_and_checks_names(spark):
    def sample(frames):
        import pandas as pd

        for t in frames:
            yield pd.DataFrame(
                {"shots": t["remaining_shots"], "errors": 1, "discards": 0, "seconds": 1.0, "decoder": t["decoder"],
                 "strong_id": t["strong_id"], "json_metadata": "{}", "custom_counts": "{}"}
            )

    tasks = spark.createDataFrame([("a", "m", 10, 5), ("b", "m", 10, 5)], "strong_id string, decoder string, max_shots long, max_errors long")
    prior = spark.createDataFrame([(4, 1, 0, 1.0, "m", "a", "{}", "{}"), (9, 5, 0, 1.0, "m", "b", "{}", "{}")], STATS)
    done = P.resume(tasks, prior, {"m": sample}, parallelism=2)
    assert {r.strong_id: (r.shots, r.errors) for r in done.collect()} == {"a": (10, 2), "b": (9, 5)}
    assert [(r.strong_id, r.rule) for r in P.invalid_counters(done, 9).collect()] == [("a", "shots above budget")]
    with pytest.raises(ValueError, match="known"):
        P.collect(tasks.withColumn("decoder", F.lit("other")), {"m": sample})


def test_shot_tables_are_a_source_too(spark):
    shots = spark.createDataFrame([("t", [True], [False], [False]), ("t", [False], [True], [False])], "task_id string, det array<boolean>, obs array<boolean>, pred array<boolean>")
    tasks = spark.createDataFrame([("t", "m")], "task_id string, decoder string")
    row = P.collect_shots(shots, tasks).first()
    assert (row.strong_id, row.decoder, row.shots, row.errors, row.detection_events) == ("t", "m", 2, 1, 1)


def test_broadcast_only_below_the_bound(spark):
    small, large = broadcast_if_small(spark.range(10), 10), broadcast_if_small(spark.range(11), 10)

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(small) and not hinted(large)


def test_materialized_tables_lie_in_the_shared_folder(spark):
    table = materialize(spark.range(5), "test")
    assert shared_dir(spark) in table.inputFiles()[0] and table.count() == 5
    clear_work(spark)
    assert not os.path.exists(table.inputFiles()[0].removeprefix("file://"))
