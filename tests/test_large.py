"""Steps that once cost more than their input, on rows made here."""

import time

from pyspark.sql import functions as F

from tallygrid.operators import detectors as D, profile
from tallygrid.streaming import collect as St, deltas
from tallygrid.workload import files, names

from test_files import HEADER, line, write


def write_parts(spark, root, n):
    spark.range(n).selectExpr("id AS p_partkey", "cast(id % 50 AS int) AS p_size").coalesce(1).write.parquet(f"{root}/part.parquet")
    return str(root)


def test_a_long_text_is_read_in_one_pass(spark):
    n = 20_000
    text = "M 0 1\n" + "\n".join(["DETECTOR rec[-1] rec[-2]"] * n + ["TICK"] * n + ["OBSERVABLE_INCLUDE(7) rec[-2]"])
    texts = spark.createDataFrame([("t", text), ("late", text + "\nM 1"), ("again", "REPEAT 2 {\n" + text)], "task_id string, text string")
    start = time.perf_counter()
    assert sorted((r.task_id, r.problem[:6]) for r in D.unsupported_texts(texts).collect()) == [("again", "repeat"), ("late", "a meas")]
    targets = D.parse_targets(texts.filter("task_id = 't'")).groupBy("kind").agg(F.count("*").alias("n"), F.max("id").alias("top")).collect()
    assert sorted(map(tuple, targets)) == [("det", 2 * n, n - 1), ("obs", 1, 7)]
    assert time.perf_counter() - start < 60


def test_only_whole_words_at_the_start_of_a_line_count(spark):
    rows = [
        ("word inside a line", "DETECTOR rec[-1] M 0\n# REPEAT 2\nMYSTERY 1\nX M"), ("longer word", "REPEATED 2\nDETECTORS\nM 0"), ("before", "M 0\nDETECTOR"),
        ("no text", None), ("bracket", "OBSERVABLE_INCLUDE(0)\nM(0.1) 0"), ("bare", "DETECTOR\nM"), ("last line", "M 0\nREPEAT"),
    ]
    texts = spark.createDataFrame(rows, "task_id string, text string")
    assert sorted(r.task_id for r in D.unsupported_texts(texts).collect()) == ["bare", "bracket", "last line"]
    targets = D.parse_targets(texts.filter("task_id IN ('word inside a line', 'longer word', 'before', 'no text')")).collect()
    assert sorted((r.task_id, r.kind, r.id, r.rec_offset) for r in targets) == [
        ("before", "det", 0, None), ("longer word", "det", 0, None), ("word inside a line", "det", 0, -1),
    ]


def test_texts_of_one_small_file_are_read_by_several_tasks(spark, tmp_path):
    texts = names.sequence_texts(spark, write_parts(spark, tmp_path, 25_000))
    per_task = [r["count"] for r in texts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 3 and sum(per_task) == 25_000


def test_the_layout_of_a_long_text_is_laid_in_one_pass(spark):
    n = 30_000
    text = "M 0 1\n" + "\n".join(["DETECTOR rec[-1] rec[-2]", "DETECTOR"] * (n // 2) + [f"OBSERVABLE_INCLUDE({i}) rec[-2]" for i in (n, 2, 2)])
    texts = spark.createDataFrame([("t", text), ("u", "M 0 1\nDETECTOR rec[-2]"), ("v", "M 0 1\nOBSERVABLE_INCLUDE(0)")], "task_id string, text string")
    start = time.perf_counter()
    got = {r.task_id: (r.det_positions, r.obs_positions) for r in D.task_targets(D.parse_targets(texts), 2).collect()}
    assert time.perf_counter() - start < 30
    assert got == {"t": ([[0, 1], []] * (n // 2), [[], [], [0, 0]] + [[]] * (n - 3) + [[0]]), "u": ([[0]], []), "v": ([], [[]])}


def test_the_catalogue_of_one_small_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    per_task, plain = [], profile.profile

    def counted(texts):
        per_task.extend(r["count"] for r in texts.groupBy(F.spark_partition_id()).count().collect())
        return plain(texts)

    monkeypatch.setattr(profile, "profile", counted)
    rows = files.catalogue_scan(spark, write_parts(spark, tmp_path, 25_000)).collect()
    assert len(per_task) == 3 and sum(r.n_files for r in rows) == 25_000


def test_an_epoch_without_good_rows_is_counted(spark, tmp_path):
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    write(f"{root}/a.csv", HEADER + line(10, 1, "a") + line(7, 1, "b"))
    write(f"{root}/b.csv", HEADER + "1\n2\n3\n")
    write(f"{root}/c.csv", HEADER)
    deltas.follow_totals(St.stream_raw(spark, root, files_per_trigger=1), out, f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted((r.good, r.quarantined, r.files) for r in deltas.read_metrics(spark, out).collect()) == [(0, 0, 0), (0, 3, 1), (2, 0, 1)]
    (row,) = deltas.job_progress(spark, {"job": out}).collect()
    assert (row.epochs, row.files, row.good, row.quarantined, row.experiments, row.shots, row.errors) == (3, 2, 2, 3, 2, 17, 2)


def test_the_profile_of_one_small_file_is_made_by_several_tasks(spark, tmp_path):
    rows = names.instruction_profile(spark, write_parts(spark, tmp_path, 25_000))
    per_task = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("n_observables").alias("obs")).collect()
    assert len(per_task) == 3 and (sum(r.n for r in per_task), sum(r.obs for r in per_task)) == (25_000, 75_000)
