"""Hand-made cases that no registered query shows."""

import os

import pytest
from pyspark.sql import functions as F

from tallygrid.functions.ids import content_id
from tallygrid.operators import balance as B, combine as C, detectors as D, grid, ordered as O, profile, progress, shots as S
from tallygrid.plans import collect as P, launch, merge as M
from tallygrid.schema import STATS
from tallygrid.session import broadcast_if_small
from tallygrid.sources import catalogue as Cat, fragments as Fr
from tallygrid.streaming import collect as St

from test_files import HEADER, line, totals, write


def test_runs_and_files_outside_the_layout_stay_apart(spark, tmp_path):
    write(f"{tmp_path}/run1/batch_0/stats.csv", HEADER + line(10, 1, "a"))
    write(f"{tmp_path}/run2/batch_0/stats.partial.csv", HEADER + line(7, 1, "a"))
    write(f"{tmp_path}/expA/stats.partial.csv", HEADER + line(1, 0, "a"))
    write(f"{tmp_path}/expB/stats.csv", HEADER + line(2, 0, "a"))
    assert totals(Fr.read_latest(spark, str(tmp_path))) == {"a": (20, 2)}


def test_only_counter_files_count_and_a_second_merge_changes_nothing(spark, tmp_path):
    root = f"{tmp_path}/in"
    write(f"{root}/batch_0/stats.csv", HEADER + line(10, 1, "a"))
    write(f"{root}/batch_0/notes.csv", HEADER + line(99, 9, "a"))
    for again in ("merged", "merged2"):
        M.merge_folder(spark, root, f"{root}/{again}")
        assert totals(Fr.read_latest(spark, root)) == {"a": (10, 1)}
    loose = f"{tmp_path}/loose"
    write(f"{loose}/x.csv", HEADER + line(5, 0, "b"))
    first = M.merge_folder(spark, loose, f"{loose}/merged", latest=False).collect()
    assert first == M.merge_with_quarantine(spark, loose, latest=False, out=None)[0].collect() or first[0].shots == 5


def test_any_json_is_good_and_the_quarantine_comes_with_the_totals(spark, tmp_path):
    rows = [line(1, 0, i, "").replace('"{""d"":3,""p"":""0.1""}"', text) for i, text in (("a", "null"), ("b", "[1]"), ("c", "7"), ("d", '"{}"'))]
    write(f"{tmp_path}/batch_0/stats.csv", HEADER + "".join(rows) + line(5, 0, "e", '"{""n"":').rstrip("\n"))
    merged, bad = M.merge_with_quarantine(spark, str(tmp_path))
    assert {r.strong_id for r in merged.collect()} == {"a", "b", "c", "d"}
    assert [r.shots for r in bad.collect()] == [5] and bad.first().file_path.endswith("batch_0/stats.csv")
    seven = HEADER.replace(",custom_counts", "")
    write(f"{tmp_path}/batch_1/stats.csv", seven + line(2, 0, "f", "").rstrip(",\n").replace('"{""d"":3,""p"":""0.1""}"', "{}"))
    assert totals(Fr.read_latest(spark, str(tmp_path)))["f"] == (2, 0)


def test_paths_with_blanks_and_glob_signs(spark, tmp_path):
    write(f"{tmp_path}/my run+1/batch_[0]/stats.csv", HEADER + line(10, 1, "a"))
    write(f"{tmp_path}/my run+1/batch_{{1}}/stats.csv", HEADER + line(5, 1, "a"))
    assert totals(Fr.read_latest(spark, str(tmp_path))) == {"a": (15, 2)}
    write(f"{tmp_path}/c/f amily_K=1_p=0.1.circuit", "M 0")
    assert [r.name for r in Cat.read_catalogue(spark, f"{tmp_path}/c", "circuit").collect()] == ["f amily_K=1_p=0.1.circuit"]


def test_folder_order_and_prefix(spark, tmp_path):
    for name in ("a/x", "a-b/x", "a/y"):
        write(f"{tmp_path}/in/{name}.circuit", "M 0")
    launch.plan_by_count(spark, f"{tmp_path}/in", "circuit", f"{tmp_path}/out", batches=3, prefix="q")
    read = spark.read.schema("path string, batch_id string").parquet(f"{tmp_path}/out").collect()
    assert {r.path.split("/in/")[1]: r.batch_id for r in read} == {"a/x.circuit": "q0", "a/y.circuit": "q1", "a-b/x.circuit": "q2"}


TASKS = "strong_id string, decoder string, max_shots long, max_errors long"


def test_resume_checks_null_decoders_and_keeps_counters(spark):
    def sampler(frames):  # inside the test, so that workers get the code itself
        import pandas as pd

        for t in frames:
            yield pd.DataFrame(
                {"shots": t["remaining_shots"].fillna(50).astype("int64"), "errors": 1, "discards": 0, "seconds": 1.0, "decoder": t["decoder"],
                 "strong_id": t["strong_id"], "json_metadata": "{}", "custom_counts": '{"n":1}'}
            )

    tasks = spark.createDataFrame([("a", "m", 10, 5), ("b", "m", None, 5), ("c", "m", 10, None)], TASKS)
    prior = spark.createDataFrame([(4, 1, 0, 1.0, "m", "a", "{}", '{"n":3}')], STATS)
    for old in (prior, M.merge(prior, with_counters=True)):
        done = {r.strong_id: (r.shots, r.custom_counts) for r in P.resume(tasks, old, {"m": sampler}).collect()}
        assert done == {"a": (10, {"n": 4}), "b": (50, {"n": 1}), "c": (10, {"n": 1})}
    with pytest.raises(ValueError, match="known"):
        P.collect(spark.createDataFrame([("a", None, 1, 1)], TASKS), {"m": sampler})


def test_shot_tables_become_records_that_combine(spark):
    shots = spark.createDataFrame([("t", [True], [False], [False]), ("u", [False], [True], [False])], "task_id string, det array<boolean>, obs array<boolean>, pred array<boolean>")
    rows = P.collect_shots(shots, spark.createDataFrame([("t", "m")], "task_id string, decoder string"))
    assert {r.strong_id: (r.decoder, r.shots, r.custom_counts) for r in rows.collect()} == {
        "t": ("m", 1, '{"detection_events":1,"detectors_checked":1}'),
        "u": (None, 1, '{"detection_events":0,"detectors_checked":1,"obs_mistake_mask=E":1}'),
    }
    assert C.combine(rows).count() == 2


def test_predictions_with_a_further_byte_or_without_bits(spark):
    schema = "task_id string, shot_id long, det array<boolean>, obs array<boolean>, pred array<boolean>"
    eight, flag = [False] * 7, [False, True] + [False] * 6
    rows = [("t", 0, [False], [True], [True] + eight + flag), ("t", 1, [False], [True], [True] + eight + [False] * 8)]
    assert [r.outcome for r in S.label_shots(spark.createDataFrame(rows, schema)).orderBy("shot_id").collect()] == ["discard", "ok"]
    for pred in (None, []):
        with pytest.raises(Exception, match="shorter than the observables"):
            S.label_shots(spark.createDataFrame([("t", 0, [False], [True], pred)], schema)).collect()
    tasks = spark.createDataFrame([("t", "m")], "task_id string, decoder string")
    both = spark.createDataFrame([("t", 0, [False], [True], None), ("x", 1, [False], [True], [True])], schema)
    assert sorted(map(tuple, S.shot_problems(both, tasks).collect())) == [("t", 0, "no prediction"), ("x", 1, "unknown task")]
    assert S.with_tasks(both, tasks).count() == 2


def test_detectors_keep_their_places(spark):
    text = "M 0 1\nDETECTOR rec[-1]\nDETECTOR\nDETECTOR rec[-2]\nOBSERVABLE_INCLUDE(2) rec[-1]"
    texts = spark.createDataFrame([("t", text)], "task_id string, text string")
    targets = D.parse_targets(texts)
    measured = spark.createDataFrame([("t", 0, [False, True])], "task_id string, shot_id long, measured array<boolean>")
    row = D.evaluate(measured, D.task_targets(targets, 2)).first()
    assert row.det == [True, False, False] and row.obs == [False, False, True]
    long = measured.select("task_id", "shot_id", F.posexplode("measured").alias("idx", "b")).withColumn("bit", F.col("b").cast("int"))
    fired = {(r.kind, r.id): r.fired for r in D.evaluate_long(long, targets, 2).collect()}
    assert fired == {("det", 0): True, ("det", 1): False, ("det", 2): False, ("obs", 2): True}


@pytest.mark.parametrize("text, problem", [("M 0\nDETECTOR rec[-1]\nMR 1", "follows"), ("REPEAT 2 {\nM 0\n}", "repeat")])
def test_text_that_cannot_be_read_is_refused(spark, text, problem):
    texts = spark.createDataFrame([("t", text), ("u", "M 0\nDETECTOR rec[-1]")], "task_id string, text string")
    assert [r.task_id for r in D.unsupported_texts(texts).collect()] == ["t"]
    with pytest.raises(Exception, match=problem):
        D.parse_targets(texts).collect()


def test_records_outside_the_measurements_are_refused(spark):
    targets = D.parse_targets(spark.createDataFrame([("t", "M 0\nDETECTOR rec[-3]")], "task_id string, text string"))
    with pytest.raises(Exception, match="outside"):
        D.task_targets(targets, 1).collect()


def test_all_measuring_words_are_counted(spark):
    texts = spark.createDataFrame([("a", "MR 0 1\nMX 2\nM 3\nMXX 0 1 2 3"), ("b", "MYSTERY 1\nM 0"), ("c", "HERALDED_ERASE(0.1) 0\nM 0"), ("d", "# M 1\nH 0\nM 0")], "task_id string, text string")
    assert {r.task_id: r.n_measurements for r in profile.profile(texts).collect()} == {"a": 6, "b": None, "c": None, "d": 1}


def test_null_axes_and_ids(spark):
    rows = spark.createDataFrame([(3, 0.1, 5), (3, None, 7), (None, 0.1, 9)], "d int, p double, shots long")
    got = {(r.d, r.p): r.shots for r in grid.grid_coverage(rows, "d", "p").collect()}
    assert got == {(3, 0.1): 5, (3, None): 7, (None, 0.1): 9, (None, None): 0}
    pairs = spark.createDataFrame([(None, "x"), ("x", None)], "t string, d string").select(content_id(F.col("t"), F.col("d")).alias("i"))
    assert pairs.distinct().count() == 2


def test_decoder_and_metadata_come_from_one_fragment(spark):
    rows = spark.createDataFrame([(1, 0, 0, 1.0, "a", "i", "z", None), (1, 0, 0, 1.0, "b", "i", "y", None)], STATS)
    row = C.combine(rows).first()
    assert (row.decoder, row.json_metadata) == ("a", "z")
    assert C.combine_with_counters(C.counts_as_map(rows)).first().json_metadata == "z"


def test_plans_have_a_few_numbers_per_batch(spark):
    classes = spark.range(1).select(F.lit(0).alias("g"), F.lit(7).cast("long").alias("_w"), F.lit(10**6).alias("_n"), F.lit(0).cast("long").alias("_start"))
    heavy = spark.range(1000).select(F.lit(0).alias("g"), (F.lit(10**6) + F.col("id") * 13).alias("_w"), F.lit(1).cast("long").alias("_n"), F.lit(0).cast("long").alias("_start"))
    plan = B._fold_classes(classes.unionByName(heavy), ["g"], 1000).filter("_w = 7").first()
    assert len(plan._slots) <= 1000 and len(plan._circle) == 1000


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_assignment_against_the_plain_greedy(spark, batches):
    import heapq
    import random

    rng = random.Random(batches)
    weights = sorted((w for w in [rng.choice([5.0, 3.0, 2.5, 1.0]) for _ in range(400)] + [rng.random() * 9 for _ in range(15)]), reverse=True)
    items = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "i long, w double")
    loads, want = [(0, b) for b in range(batches)], {}
    for i, w in enumerate(weights):
        load, b = heapq.heappop(loads)
        want[i] = b
        heapq.heappush(loads, (load + round(w / B.WEIGHT_UNIT), b))
    assert {r.i: r.batch_id for r in B.longest_first(items, "w", ["i"], batches).collect()} == want


def test_weight_unit_makes_ties(spark):
    items = spark.createDataFrame([(i, 1 + i * 1e-6) for i in range(6)], "i long, w double")
    got = {r.i: r.batch_id for r in B.longest_first(items, "w", ["i"], 2, weight_unit=0.1).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 1}


def test_rates_from_arithmetic_find_their_timings(spark):
    catalogue = spark.createDataFrame([("a", 1, 0.1 + 0.2)], "path string, K int, p double")
    timings = spark.createDataFrame([(1, 0.3, 5.0)], "K int, p double, seconds double")
    assert launch.assign_by_cost(catalogue, timings, 1).first().seconds == 5.0


def test_only_finished_and_few_epochs(spark, tmp_path):
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i in range(6):
        write(f"{root}/batch_{i}/stats.csv", HEADER + line(10, 1, "a"))
    stream = St.stream_fragments(spark, root, files_per_trigger=1)
    St.start_combine(stream, out, f"{tmp_path}/ck", 50, 9).awaitTermination()
    assert len(St.finished_epochs(spark, out)) == St.KEPT_EPOCHS
    row = St.latest_epoch(spark, out).first()
    assert (row.shots, row.custom_counts) == (60, {"n": 6})
    os.makedirs(f"{out}/epoch=99")
    assert St.latest_epoch(spark, out).first().shots == 60
    with pytest.raises(ValueError, match="checkpoint"):
        St.start_combine(stream, out, f"{tmp_path}/other", 50, 9)


def test_snapshot_streams_keep_counters_and_few_epochs(spark, tmp_path):
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i in range(5):
        write(f"{root}/run1/batch_0/stats.partial.{i}.csv", HEADER + line(10 + i, 1, "a"))
    write(f"{root}/run2/batch_0/stats.csv", HEADER + line(3, 1, "a"))
    St.start_snapshots(St.stream_fragments(spark, root, files_per_trigger=1), out, f"{tmp_path}/ck").awaitTermination()
    row = St.latest_epoch(spark, f"{out}/totals").first()
    assert (row.shots, row.errors, row.custom_counts) == (17, 2, {"n": 2})
    assert len(St.finished_epochs(spark, f"{out}/state")) == St.KEPT_EPOCHS


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(wide)) and not hinted(broadcast_if_small(wide, max_bytes=50_000))


def test_limits_that_are_missing(spark):
    tasks = spark.createDataFrame([("a", "m", None, 5)], TASKS)
    have = spark.createDataFrame([("a", 100, 2)], "strong_id string, shots long, errors long")
    row = progress.remaining_work(tasks, have).first()
    assert (row.remaining_shots, row.remaining_errors, row.end_reason) == (None, 3, None)
    assert O.HOT_ROWS > 0


def test_only_whole_json_and_whole_counters(spark):
    texts = ['{"a":1', '{"d": 3}}', '1] x', "1} x", "1,2", '{"k":"x"}', "[1]", '{"k":2}', "null", None, '{"k":null}', '{"k":1.5}', "{}", "", '"a"']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", Fr.valid_json("t").alias("whole"), Fr.is_counter_map("t").alias("counts")).collect()
    assert {r.t for r in rows if r.whole} == {'{"k":"x"}', "[1]", '{"k":2}', "null", '{"k":null}', '{"k":1.5}', "{}", '"a"'}
    assert {r.t for r in rows if r.whole and r.counts} == {'{"k":2}', "null", "{}"}


def test_every_damaged_row_has_a_reason(spark, tmp_path):
    from tallygrid.sources import checked as K

    id_first = "strong_id, shots, errors, discards, seconds, decoder, json_metadata\n"
    write(f"{tmp_path}/batch_0/stats.csv", HEADER + line(10, 1, "a") + "10,x,0,0.5,m,b,{},\n" + "30,-1,0,abc,m,c,{},\n" + "10\n" + "1,0,0,nan,m,d,{},\n" + "1,0,0,1,m,,{},\n")
    write(f"{tmp_path}/batch_1/stats.csv", id_first + 'e, 7, 2, 0, 0.5, m, "{""d"":3}"\n' + "f, 1.5, 2, 0, 0.5, m, {}\n" + 'g, 1, 0, 0, 1, m, "{""d"":"\n')
    write(f"{tmp_path}/batch_2/stats.csv", "1,0,0,1,m,h,{},\n")
    write(f"{tmp_path}/batch_3/stats.csv", "shots,errors\n1,0\n")
    merged, bad = M.merge_with_quarantine(spark, str(tmp_path))
    assert {r.strong_id: (r.shots, r.errors) for r in merged.collect()} == {"a": (10, 1), "e": (7, 2)}
    want = [("errors", "not a whole number"), ("errors", "negative"), ("", "fields"), ("seconds", "not a number"), ("strong_id", "missing")]
    want += [("shots", "not a whole number"), ("json_metadata", "not JSON"), ("", "no header"), ("", "unknown header")]
    assert sorted((r.column, r.reason) for r in bad.collect()) == sorted(want)


def test_results_are_told_by_whole_folders(spark, tmp_path):
    root = f"{tmp_path}/in"
    write(f"{root}/run_merged/batch_0/stats.csv", HEADER + line(20, 1, "a"))
    write(f"{root}/run/batch_0/stats.csv", HEADER + line(10, 1, "a"))
    write(f"{root}/merged/batch_0/stats.csv", HEADER + line(99, 1, "a"))
    assert M.merge_folder(spark, root, f"{root}/merged/totals").first().shots == 129
    files, _ = M.input_files(spark, root, f"{root}/merged")
    assert sorted(r.path.split("/in/")[1].split("/")[0] for r in files.collect()) == ["run", "run_merged"]
    with pytest.raises(ValueError, match="at or above"):
        M.merge_folder(spark, root, str(tmp_path))
    write(f"{tmp_path}/other/x.csv", HEADER + line(5, 0, "b"))
    assert M.merge_folder(spark, f"{tmp_path}/other").first().shots == 5


def test_many_small_files_become_one_partition(spark, tmp_path):
    for k in range(2_000):
        write(f"{tmp_path}/in/d{k % 7}/n{k:05d}.circuit", f"M {k}")
    out = f"{tmp_path}/packed"
    assert Cat.compact(spark, f"{tmp_path}/in", "circuit", out) == 2_000
    packed = Cat.read_compacted(spark, out)
    assert packed.rdd.getNumPartitions() == 1 and packed.count() == 2_000
    write(f"{tmp_path}/in/d0/more.circuit", "M 1")
    assert (Cat.compact(spark, f"{tmp_path}/in", "circuit", out), Cat.compact(spark, f"{tmp_path}/in", "circuit", out)) == (1, 0)
    index = Cat.compacted_index(spark, out).collect()
    assert sorted(r.n_texts for r in index) == [1, 2_000]
    assert sorted(Cat.read_compacted(spark, out).collect()) == sorted(Cat.read_catalogue(spark, f"{tmp_path}/in", "circuit").collect())
    assert {(r.name, r.text) for r in Cat.read_compacted(spark, out).filter("name like 'n0001%'").collect()} == {(f"n{k:05d}.circuit", f"M {k}") for k in range(10, 20)}
