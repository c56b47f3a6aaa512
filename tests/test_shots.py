import pytest
from pyspark.sql import functions as F

from tallygrid.functions import bits as B
from tallygrid.operators import combine as C, detectors as D, grid, profile, shots as S
from tallygrid.schema import SHOTS, TASKS


def shots(spark, rows):
    return spark.createDataFrame([("t", i, *r) for i, r in enumerate(rows)], SHOTS)


T, X = True, False


def test_one_outcome_per_shot_in_order(spark):
    rows = [
        ([T, X], [X, X], [X, X], False),  # masked detector
        ([X, T], [X, X], [X, X], True),   # decoder gave up
        ([X, X], [X, T], [X, X], False),  # post-selected observable mispredicted
        ([X, X], [T, X], [X, X], False),  # error
        ([X, T], [T, T], [T, T], False),  # ok
        ([T, X], [T, T], [X, X], True),   # all causes at once count once
    ]
    masked = shots(spark, rows).withColumns(
        {"postselection_mask": F.array(F.lit(T), F.lit(X)), "postselected_obs_mask": F.array(F.lit(X), F.lit(T))}
    )
    assert [r.outcome for r in S.label_shots(masked).orderBy("shot_id").collect()] == ["discard"] * 3 + ["error", "ok", "discard"]
    got = S.classify_shots(masked).first()
    assert (got.shots, got.discards, got.errors, got.detectors_checked, got.detection_events) == (6, 4, 1, 12, 4)


def test_no_mask_discards_nothing(spark):
    got = S.classify_shots(shots(spark, [([T, T], [X], [X], None), ([X, X], [T], [X], False)])).first()
    assert (got.shots, got.discards, got.errors) == (2, 0, 1)


def test_full_mask_discards_but_counts_events(spark):
    rows = shots(spark, [([X, T], [X], [X], False), ([X, X], [X], [X], False)])
    got = S.classify_shots(rows.withColumn("postselection_mask", F.array_repeat(F.lit(True), 2))).first()
    assert (got.shots, got.discards, got.detection_events, got.detectors_checked) == (2, 1, 1, 4)


def test_combos_count_errors_only(spark):
    rows = [([X], [T, X], [X, X], False)] * 3 + [([X], [T, T], [X, X], False), ([X], [T, T], [T, T], False)]
    got = {r.counter: r.n for r in S.error_combos(shots(spark, rows)).collect()}
    assert got == {"obs_mistake_mask=E_": 3, "obs_mistake_mask=EE": 1}


def test_detector_rates(spark):
    rows = shots(spark, [([T, X, T, X, T], [X], [X], False), ([T, X, X, X, T], [X], [X], False)])
    counts = {r.det_id: (r.shots, r.fired, r.rate) for r in S.detector_rates(rows).collect()}
    assert counts == {0: (2, 2, 1.0), 1: (2, 0, 0.0), 2: (2, 1, 0.5), 3: (2, 0, 0.0), 4: (2, 2, 1.0)}


def test_tasks_bring_their_masks(spark):
    tasks = spark.createDataFrame([("t", "m", 1, 1, [True], None, 10, 10)], TASKS)
    got = S.classify_shots(S.with_tasks(shots(spark, [([T], [X], [X], False)]), tasks)).first()
    assert got.discards == 1


def test_reference_flag(spark):
    df = spark.range(1).select(F.array(F.lit(T), F.lit(X)).alias("d"), F.array(F.lit(T), F.lit(T)).alias("r"))
    row = df.select(S.apply_reference(F.col("d"), F.col("r")).alias("on"), S.apply_reference(F.col("d"), F.col("r"), False).alias("off")).first()
    assert row.on == [X, T] and row.off == [T, X]


FLAT = "R 0 1\nT 0\nM 0 1\n\nDETECTOR rec[-1] rec[-2]\nOBSERVABLE_INCLUDE(2) rec[-2]\nOBSERVABLE_INCLUDE(0) rec[-1]"


def test_targets_and_parities(spark):
    texts = spark.createDataFrame([("t", FLAT)], "task_id string, text string")
    targets = D.parse_targets(texts)
    assert sorted((r.kind, r.id, r.rec_offset) for r in targets.collect()) == [
        ("det", 0, -2), ("det", 0, -1), ("obs", 0, -1), ("obs", 2, -2),
    ]
    measured = spark.createDataFrame([("t", 0, [T, X]), ("t", 1, [T, T])], "task_id string, shot_id long, measured array<boolean>")
    got = {r.shot_id: (r.det, r.obs) for r in D.evaluate(measured, D.task_targets(targets, 2)).collect()}
    assert got == {0: ([T], [X, X, T]), 1: ([X], [T, X, T])}  # each observable at the place of its id


def test_row_and_long_parities_agree(spark):
    text = grid.sequence_text(F.lit(2), F.lit(0.01))
    texts = spark.range(1).select(F.lit("t").alias("task_id"), text.alias("text"))
    targets = D.parse_targets(texts)
    records = [("t", s, [bool((s * 7 + i * i) % 3 == 0) for i in range(18)]) for s in range(20)]
    measured = spark.createDataFrame(records, "task_id string, shot_id long, measured array<boolean>")
    long = measured.select("task_id", "shot_id", F.posexplode("measured").alias("idx", "b")).withColumn("bit", F.col("b").cast("int"))
    from_long = {(r.shot_id, r.kind, r.id): r.fired for r in D.evaluate_long(long, targets, 18).collect()}
    in_row = {}
    for r in D.evaluate(measured, D.task_targets(targets, 18)).collect():
        in_row.update({(r.shot_id, "det", i): b for i, b in enumerate(r.det)})
        in_row.update({(r.shot_id, "obs", i): b for i, b in enumerate(r.obs)})
    assert from_long == in_row and len(in_row) == 20 * 10


def test_profile_counts_flat_text_and_flags_repeats(spark):
    texts = spark.createDataFrame(
        [("a", FLAT), ("b", "REPEAT 3 {\nM 0\n}"), ("c", "H 0\nM 0")], "task_id string, text string"
    )
    got = {r.task_id: r for r in profile.profile(texts).collect()}
    a = got["a"]
    assert (a.n_lines, a.n_detectors, a.n_observables, a.n_measurements, a.t_count, a.non_clifford) == (6, 1, 2, 2, 1, True)
    assert got["b"].has_repeat and got["b"].n_measurements is None
    assert not got["c"].non_clifford and got["c"].t_count == 0


def test_sequence_of_one_round(spark):
    text = spark.range(1).select(grid.sequence_text(F.lit(1), F.lit(0.003)).alias("t")).first().t.split("\n")
    assert text[0] == "R 0 1 2 3 4"
    assert text[1] == "R_X(-0.3040867239846964) 0 1 2 3 4"
    assert text[3] == "DEPOLARIZE1(0.003) 0 1 2 3 4"
    assert text[14] == "R_X(0.3040867239846964) 0"
    assert text[16:19] == ["R 5 6 7 8", "X 5 7 8", "M 5 6 7 8"]
    assert text[19:] == [
        "DETECTOR rec[-8] rec[-4]", "DETECTOR rec[-7] rec[-3]", "DETECTOR rec[-6] rec[-2]", "DETECTOR rec[-5] rec[-1]",
        "OBSERVABLE_INCLUDE(0) rec[-9]",
    ]
    assert spark.range(1).select(grid.sequence_text(F.lit(0), F.lit(0.003)).alias("t")).first().t is None


def test_standard_sequence_grid(spark):
    rows = grid.parameter_grid(spark, K=list(grid.ROUNDS), p=list(grid.SEQUENCE_RATES))
    texts = rows.select("K", grid.sequence_name(F.col("K"), F.col("p"), "family").alias("name"), grid.sequence_text(F.col("K"), F.col("p")).alias("text"))
    got = profile.profile(texts).collect()
    assert len(got) == 25
    assert all((r.n_detectors, r.n_observables, r.n_measurements, r.t_count) == (4 * r.K, r.K, 9 * r.K, 12 * r.K) for r in got)
    assert {r.name for r in got if r.K == 1} == {f"family_K=1_p={p}.circuit" for p in grid.SEQUENCE_RATES}


def test_event_rate_from_counters(spark):
    long = S.shot_counters(shots(spark, [([T, X], [X], [X], False)] * 3))
    maps = C.counters_to_map(long, "task_id")
    row = maps.select("custom_counts", C.event_rate().alias("rate")).first()
    assert row.custom_counts == {"detectors_checked": 6, "detection_events": 3} and row.rate == 0.5


def test_packed_words_equal_the_bits(spark):
    """Random vectors of many lengths, classified as arrays and as bytes."""
    import random

    rng, rows = random.Random(4), []
    for k in range(400):
        n_det, n_obs = rng.choice([1, 7, 8, 55, 56, 57, 64, 130]), rng.choice([1, 2, 8, 9])
        bits = lambda n, p=0.5: [rng.random() < p for _ in range(n)]
        pred = bits(n_obs, 0.2)
        if rng.random() < 0.3:
            pred += [False] * (-n_obs % 8) + [rng.random() < 0.05 for _ in range(8)]
        rows.append((f"t{k % 5}", k, bits(n_det, 0.1), bits(n_obs, 0.2), pred, n_det, n_obs, rng.choice([None, bits(n_det, 0.05)]), rng.choice([None, bits(n_obs, 0.1)])))
    kinds = "task_id string, shot_id long, det array<boolean>, obs array<boolean>, pred array<boolean>, num_det int, num_obs int, postselection_mask array<boolean>, postselected_obs_mask array<boolean>"
    plain = spark.createDataFrame(rows, kinds)
    vectors = ("det", "obs", "pred", "postselection_mask", "postselected_obs_mask")
    packed = plain.withColumns({c: F.when(F.col(c).isNotNull(), B.to_binary(B.pack_bits(F.col(c)))) for c in vectors})
    assert sorted(S.classify_packed(packed).collect()) == sorted(S.classify_shots(plain).collect())
    assert S.packed_problems(packed).count() == 0


def test_lengths_of_packed_vectors(spark):
    rows = [
        (1, b"\x01\x01", b"\x01", b"\x01", None), (2, b"", b"\x01", b"\x01", None), (3, b"\x01\x01", b"", b"\x01", None), (4, b"\x01\x01", b"\x01", None, None),
        (5, b"\x01\xf0", b"\x01", b"\x01\x01", None), (6, b"\x01\x01", b"\x01", b"\x01\x01\x01", b"\x01\x01\x01"), (7, b"\x01\x01", b"\x01", b"\x01", b"\x00\x10"),
    ]
    shots = spark.createDataFrame(rows, "shot_id long, det binary, obs binary, pred binary, postselection_mask binary").selectExpr("'a' AS task_id", "*", "12 AS num_det", "2 AS num_obs")
    found = {(r.shot_id, r.problem) for r in S.packed_problems(shots).collect()}
    assert found == {(2, "short detectors"), (3, "short observables"), (4, "no prediction"), (5, "bits behind the detectors"), (6, "long prediction"), (6, "long mask"), (7, "bits behind the mask")}
    assert S.classify_packed(shots.filter("shot_id = 1")).first().shots == 1
    for bad in range(2, 8):
        with pytest.raises(Exception, match="declared length"):
            S.classify_packed(shots.filter(f"shot_id = {bad}")).collect()


def test_missing_bits_and_long_masks_are_problems(spark):
    kinds = "task_id string, shot_id long, det binary, obs binary, pred binary, postselection_mask array<boolean>"
    rows = [("a", 1, b"\x01", b"\x00", b"\x00", None), ("a", 2, b"", b"\x00", b"\x00", [True] * 3), ("a", 3, b"\x01", b"", b"\x00", None), ("a", 4, b"\x01", b"\x00", b"\x00", [False] * 3 + [True])]
    shots = S.unpack_shots(spark.createDataFrame(rows, kinds), 3, 1)
    tasks = spark.createDataFrame([("a",)], "task_id string")
    assert {(r.shot_id, r.problem) for r in S.shot_problems(shots, tasks).collect()} == {(2, "missing detectors"), (3, "missing observables"), (4, "mask behind the detectors")}
    assert [r.outcome for r in S.label_shots(shots.filter("shot_id = 1")).collect()] == ["ok"]
    for bad in (2, 3, 4):
        with pytest.raises(Exception, match="missing bits"):
            S.label_shots(shots.filter(f"shot_id = {bad}")).collect()
