import os

import pytest
from pyspark.sql import functions as F

from tallygrid.operators.combine import combine
from tallygrid.sources import fragments as S
from tallygrid.streaming import collect as St, deltas as D

from test_files import HEADER, line, write


def published(spark, out):
    return {r.strong_id: (r.shots, r.errors) for r in St.latest_epoch(spark, out).collect()}


def run_combine(spark, root, base):
    St.start_combine(St.stream_fragments(spark, root), f"{base}/out", f"{base}/ck", 50, 5).awaitTermination()


def test_totals_grow_over_restarts_and_equal_the_batch_result(spark, tmp_path):
    root = f"{tmp_path}/in"
    write(f"{root}/batch_0/d1.csv", HEADER + line(10, 1, "a") + line(5, 0, "b"))
    run_combine(spark, root, tmp_path)
    assert published(spark, f"{tmp_path}/out") == {"a": (10, 1), "b": (5, 0)}

    write(f"{root}/batch_1/d2.csv", HEADER + line(45, 1, "a") + line(5, 5, "b") + "7")
    run_combine(spark, root, tmp_path)
    latest = {r.strong_id: r for r in St.latest_epoch(spark, f"{tmp_path}/out").collect()}
    assert (latest["a"].shots, latest["a"].end_reason, latest["b"].end_reason) == (55, "max_shots", "max_errors")

    batch = combine(S.read_fragments(spark, root, "any"))
    assert published(spark, f"{tmp_path}/out") == {r.strong_id: (r.shots, r.errors) for r in batch.collect()}

    epochs = sorted(os.listdir(f"{tmp_path}/out"))
    run_combine(spark, root, tmp_path)  # nothing new: nothing is published
    assert sorted(os.listdir(f"{tmp_path}/out")) == epochs


def run_snapshots(spark, root, base):
    files = St.stream_fragments(spark, root, files_per_trigger=1)
    St.start_snapshots(files, f"{base}/out", f"{base}/ck").awaitTermination()


def test_a_newer_snapshot_replaces_the_older_one(spark, tmp_path):
    root = f"{tmp_path}/in"
    write(f"{root}/batch_0/stats.partial.1.csv", HEADER + line(10, 1, "a"))
    write(f"{root}/batch_1/stats.partial.1.csv", HEADER + line(5, 0, "a") + line(1, 0, "b"))
    run_snapshots(spark, root, tmp_path)
    assert published(spark, f"{tmp_path}/out/totals") == {"a": (15, 1), "b": (1, 0)}

    # A newer snapshot with several rows of one id, then the final file of the other batch.
    write(f"{root}/batch_0/stats.partial.2.csv", HEADER + line(10, 1, "a") + line(15, 2, "a"))
    run_snapshots(spark, root, tmp_path)
    assert published(spark, f"{tmp_path}/out/totals") == {"a": (30, 3), "b": (1, 0)}

    write(f"{root}/batch_1/stats.csv", HEADER + line(7, 0, "a") + line(2, 0, "b"))
    run_snapshots(spark, root, tmp_path)
    assert published(spark, f"{tmp_path}/out/totals") == {"a": (32, 3), "b": (2, 0)}
    assert published(spark, f"{tmp_path}/out/totals") == {
        r.strong_id: (r.shots, r.errors) for r in combine(S.read_latest(spark, root)).collect()
    }


def test_a_late_older_snapshot_changes_nothing(spark):
    rows = spark.createDataFrame(
        [("batch_0/stats.partial.2.csv", "a", 10, 1, 0, 1.0, "m", "{}")],
        "file_path string, strong_id string, shots long, errors long, discards long, seconds double, decoder string, json_metadata string",
    )
    known = St.newest_snapshots(St.snapshot_entries(rows))
    late = rows.withColumn("file_path", F.lit("batch_0/stats.partial.1.csv")).withColumn("shots", F.lit(3).cast("long"))
    assert St.newest_snapshots(St.snapshot_entries(late).unionByName(known)).collect() == known.collect()


def test_a_paced_query_keeps_publishing(spark, tmp_path):
    root = f"{tmp_path}/in"
    write(f"{root}/batch_0/d1.csv", HEADER + line(10, 1, "a"))
    query = St.start_combine(St.stream_fragments(spark, root), f"{tmp_path}/out", f"{tmp_path}/ck", 50, 5, every="1 second")
    try:
        query.processAllAvailable()
        assert published(spark, f"{tmp_path}/out") == {"a": (10, 1)}
        write(f"{root}/batch_1/d2.csv", HEADER + line(5, 0, "a"))
        query.processAllAvailable()
        assert published(spark, f"{tmp_path}/out") == {"a": (15, 1)}
    finally:
        query.stop()


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def batch_file(root, batch, rows, name="stats.csv"):
    write(f"{root}/batch_{batch}/{name}", HEADER + "".join(line(n, 1, i) for i, n in rows))


def test_an_epoch_writes_only_what_is_new(spark, tmp_path):
    root, out, ck = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"

    def drain():
        D.follow_snapshots(St.stream_raw(spark, root), out, ck).awaitTermination()
        return {r.strong_id: r.shots for r in D.read_snapshot_totals(spark, out).collect()}

    for batch in range(4):
        batch_file(root, batch, [(f"x{batch}-{k}", k) for k in range(3000)], "stats.partial.1.csv")
    assert len(drain()) == 12_000
    first = size_of(f"{out}/deltas/epoch=0")
    batch_file(root, 2, [("late", 5)], "stats.partial.2.csv")  # replaces the older snapshot of its batch
    totals = drain()
    assert len(totals) == 9_001 and totals["late"] == 5
    assert size_of(f"{out}/deltas/epoch=1") < first / 10 and not os.path.exists(f"{out}/base")
    assert totals == {r.strong_id: r.shots for r in combine(S.read_latest(spark, root)).collect()}


def test_bases_follow_the_deltas_and_replays_change_nothing(spark, tmp_path):
    root, out, ck = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"
    for k in range(9):
        batch_file(root, k, [("a", 10), (f"b{k % 2}", 1)])
    write(f"{root}/batch_9/stats.csv", HEADER + line(3, 1, "a") + "7")

    def drain(folder, checkpoint):
        D.follow_totals(St.stream_raw(spark, root, files_per_trigger=1), folder, checkpoint, least_bytes=1).awaitTermination()

    drain(out, ck)
    want = {"a": 93, "b0": 5, "b1": 4}
    assert {r.strong_id: r.shots for r in D.read_totals(spark, out).collect()} == want
    bases = St.finished_epochs(spark, f"{out}/base")
    assert len(bases) == 2 and all(n > bases[0] for n in St.finished_epochs(spark, f"{out}/deltas"))
    # The last epoch again: its delta and its base are written once more.
    last = max(St.finished_epochs(spark, f"{out}/metrics"))
    os.remove(f"{ck}/commits/{last}")
    if os.path.exists(f"{ck}/commits/.{last}.crc"):
        os.remove(f"{ck}/commits/.{last}.crc")
    drain(out, ck)
    assert {r.strong_id: r.shots for r in D.read_totals(spark, out).collect()} == want
    seen = D.read_metrics(spark, out).agg(F.sum("good"), F.sum("quarantined"), F.sum("files"), F.count("*")).first()
    assert tuple(seen) == (19, 1, 10, 10)


def test_a_marker_left_by_a_crash_is_written_again(spark, tmp_path):
    os.makedirs(f"{tmp_path}/out/_checkpoint_of")
    for _ in range(2):
        St.claim(spark, f"{tmp_path}/out", "one")
    with pytest.raises(ValueError):
        St.claim(spark, f"{tmp_path}/out", "two")
