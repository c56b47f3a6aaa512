"""Shot-level classification of bit vectors into discards, errors and detection events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions import bits as B
from tallygrid.session import broadcast_if_small

# Counter names as they stand in existing counter files.
CHECKED = "detectors_checked"
EVENTS = "detection_events"
COMBO_PREFIX = "obs_mistake_mask="


def apply_reference(raw: Column, reference: Column, use_reference: Column | bool = True) -> Column:
    """Detector bits relative to the noiseless reference shot, or as sampled."""
    flag = F.lit(use_reference) if isinstance(use_reference, bool) else use_reference
    return F.when(flag, B.xor_bits(raw, reference)).otherwise(raw)


def with_tasks(shots: DataFrame, tasks: DataFrame, derived: bool = False) -> DataFrame:
    """Attach task columns (masks, sizes) to shots. `derived` tells that `tasks` is not a stored table.

    A shot of an unknown task stays, with NULL columns; `shot_problems` lists it.
    Runs a job to measure `tasks`.
    """
    return shots.join(broadcast_if_small(tasks, derived=derived), "task_id", "left")


def unpack_shots(shots: DataFrame, num_det: Column | int, num_obs: Column | int) -> DataFrame:
    """Shots whose `det`, `obs` and `pred` are packed little-endian bytes, as bit vectors.

    A prediction keeps all its bytes: one more than the observables need is the
    decoder's sign that it gave up.
    """
    return shots.withColumns(
        {
            "det": B.unpack_binary(F.col("det"), num_det),
            "obs": B.unpack_binary(F.col("obs"), num_obs),
            "pred": B.unpack_binary(F.col("pred"), F.octet_length("pred") * 8),
        }
    )


def join_predictions(shots: DataFrame, predictions: DataFrame) -> DataFrame:
    """Shots and predictions that are stored apart; the pair of keys is unique, so it has no hot value.

    A shot without a prediction stays, with a NULL one, which the classification refuses.
    """
    return shots.join(predictions, ["task_id", "shot_id"], "left")


def shot_problems(shots: DataFrame, tasks: DataFrame) -> DataFrame:
    """`(task_id, shot_id, problem)`: unknown tasks, vectors with missing bits, masks that name bits behind
    the end, and predictions that are missing, too short or too long."""
    known = tasks.select("task_id").distinct().withColumn("_known", F.lit(True))
    rows = shots.join(broadcast_if_small(known, derived=True), "task_id", "left")
    padded = F.ceil(F.size("obs") / 8) * 8
    mask, observable_mask = _masks(shots)
    problems = F.array_compact(
        F.array(
            F.when(F.col("_known").isNull(), F.lit("unknown task")),
            F.when(B.has_gaps(F.col("det")), F.lit("missing detectors")),
            F.when(B.has_gaps(F.col("obs")), F.lit("missing observables")),
            F.when(B.reaches_behind(mask, F.col("det")), F.lit("mask behind the detectors")),
            F.when(B.reaches_behind(observable_mask, F.col("obs")), F.lit("mask behind the observables")),
            F.when(F.col("pred").isNull(), F.lit("no prediction")),
            F.when(F.size("pred") < F.size("obs"), F.lit("too few predictions")),
            F.when(F.size("pred") > padded + 8, F.lit("too many predictions")),
        )
    )
    return rows.select("task_id", "shot_id", F.explode(problems).alias("problem"))


def _column(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def _masks(shots: DataFrame) -> tuple[Column, Column]:
    none = F.lit(None).cast("array<boolean>")
    return _column(shots, "postselection_mask", none), _column(shots, "postselected_obs_mask", none)


def label_shots(shots: DataFrame) -> DataFrame:
    """Add `mistakes` (mispredicted observables) and `outcome`.

    Each shot gets one outcome, in this order: a masked detector fired ->
    discard; the decoder gave up -> discard; a post-selected observable was
    mispredicted -> discard; another observable was -> error; else ok.

    A prediction may be one byte longer than the bytes of the observables; a bit in
    that byte says that the decoder gave up. A shot whose prediction is missing or
    shorter than its observables is an error, and so are vectors with missing bits and
    masks that name bits behind the end (see `shot_problems`).
    """
    mask, observable_mask = _masks(shots)
    gave_up = F.coalesce(_column(shots, "pred_discard", F.lit(False)), F.lit(False))
    n_obs = F.size("obs")
    padded = (F.ceil(n_obs / 8) * 8).cast("int")
    gave_up = gave_up | F.coalesce(F.exists(F.slice("pred", padded + 1, F.lit(8)), lambda b: b), F.lit(False))
    missing = F.raise_error(F.lit("a prediction is missing or shorter than the observables")).cast("array<boolean>")
    pred = F.when(F.coalesce(F.size("pred") >= n_obs, F.lit(False)), F.slice("pred", F.lit(1), n_obs)).otherwise(missing)
    mistakes = B.xor_bits(F.col("obs"), pred)
    discard = B.any_masked(F.col("det"), mask) | gave_up | B.any_masked(mistakes, observable_mask)
    broken = B.has_gaps(F.col("det")) | B.has_gaps(F.col("obs")) | B.reaches_behind(mask, F.col("det")) | B.reaches_behind(observable_mask, F.col("obs"))
    outcome = (
        F.when(broken, F.raise_error(F.lit("a vector has missing bits, or a mask names bits behind its end")).cast("string"))
        .when(discard, F.lit("discard"))
        .when(F.exists(mistakes, lambda m: m), F.lit("error"))
        .otherwise(F.lit("ok"))
    )
    return shots.select("*", mistakes.alias("mistakes"), outcome.alias("outcome"))


def classify_shots(shots: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counters per task in one pass: in-row array functions, then a partial aggregate.

    Detectors are counted before post-selection and `shots` includes the discarded.
    """
    outcome = F.col("outcome")
    return (
        label_shots(shots)
        .groupBy(*(keys or ["task_id"]))
        .agg(
            F.count("*").alias("shots"),
            F.count_if(outcome == "discard").alias("discards"),
            F.count_if(outcome == "error").alias("errors"),
            F.sum(F.size("det").cast("bigint")).alias(CHECKED),
            F.sum(B.popcount(F.col("det"))).alias(EVENTS),
        )
    )


def packed_problems(shots: DataFrame) -> DataFrame:
    """`(task_id, shot_id, problem)` of packed shots with their task columns: every vector against its declared length."""
    return shots.select("task_id", "shot_id", F.explode(F.array_compact(F.array(*_packed_checks(shots)))).alias("problem"))


def _packed_checks(shots: DataFrame) -> list[Column]:
    none = F.lit(None).cast("binary")
    n_det, n_obs = F.col("num_det"), F.col("num_obs")
    masks = _column(shots, "postselection_mask", none), _column(shots, "postselected_obs_mask", none)

    def own(name: str, bits: Column, count: Column, more: int = 0, optional: bool = False) -> list[Column]:
        size = F.octet_length(bits)
        short, long = size < B.bytes_for(count), size > B.bytes_for(count) + more
        absent = [] if optional else [F.when(bits.isNull(), F.lit(f"no {name}"))]
        return [*absent, F.when(short, F.lit(f"short {name}")), F.when(long, F.lit(f"long {name}")), F.when(~short & ~long & ~B.ends_clean(bits, count), F.lit(f"bits behind the {name}"))]

    checks = [F.when(n_det.isNull() | n_obs.isNull(), F.lit("unknown task"))]
    checks += own("detectors", F.col("det"), n_det) + own("observables", F.col("obs"), n_obs) + own("prediction", F.col("pred"), n_obs, more=1)
    return checks + own("mask", masks[0], n_det, optional=True) + own("observable mask", masks[1], n_obs, optional=True)


def classify_packed(shots: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """`classify_shots` on BINARY vectors and masks, little-endian, without making them arrays of bits.

    Needs `num_det` and `num_obs`; every vector has to have the bytes that its length
    needs, with no bit set behind it, a prediction one more if the decoder may give
    up. Anything else stops the job (`packed_problems` lists it).
    """
    none = F.lit(None).cast("binary")
    fine = F.coalesce(*_packed_checks(shots)).isNull()
    wanted = {
        "_det": B.words(F.col("det")),
        "_mistakes": B.xor_words(B.words(F.col("obs")), B.words(F.substring("pred", F.lit(1), B.bytes_for(F.col("num_obs"))))),
        "_mask": B.words(_column(shots, "postselection_mask", none)),
        "_obs_mask": B.words(_column(shots, "postselected_obs_mask", none)),
        "_further": F.substring("pred", B.bytes_for(F.col("num_obs")) + 1, F.lit(1)),
    }
    rows = shots.withColumns(wanted)
    gave_up = F.coalesce(_column(shots, "pred_discard", F.lit(False)), F.lit(False)) | F.coalesce(F.exists(B.words(F.col("_further")), lambda w: w != 0), F.lit(False))
    discard = B.any_masked_words(F.col("_det"), F.col("_mask")) | gave_up | B.any_masked_words(F.col("_mistakes"), F.col("_obs_mask"))
    error = F.exists("_mistakes", lambda w: w != 0)
    problem = F.raise_error(F.lit("a packed vector or mask does not have its declared length")).cast("string")
    outcome = F.when(~fine, problem).when(discard, F.lit("discard")).when(error, F.lit("error")).otherwise(F.lit("ok"))
    return (
        rows.withColumn("_outcome", outcome)
        .groupBy(*(keys or ["task_id"]))
        .agg(
            F.count("*").alias("shots"),
            F.count_if(F.col("_outcome") == "discard").alias("discards"),
            F.count_if(F.col("_outcome") == "error").alias("errors"),
            F.sum(F.col("num_det").cast("bigint")).alias(CHECKED),
            F.sum(B.popcount_words(F.col("_det"))).alias(EVENTS),
        )
    )


def _combo() -> Column:
    """Counter name of the pattern of mispredicted observables."""
    flags = F.transform("mistakes", lambda m: F.when(m, F.lit("E")).otherwise(F.lit("_")))
    return F.concat(F.lit(COMBO_PREFIX), F.array_join(flags, ""))


def error_combos(shots: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Errors per pattern of mispredicted observables, as long counters."""
    errors = label_shots(shots).filter("outcome = 'error'")
    return errors.groupBy(*(keys or ["task_id"]), _combo().alias("counter")).agg(F.count("*").alias("n"))


def shot_counters(shots: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Event counters and error patterns of each task in the long counter form, from one pass."""
    keys = keys or ["task_id"]
    patterns = (
        label_shots(shots)
        .groupBy(*keys, F.when(F.col("outcome") == "error", _combo()).alias("combo"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.size("det").cast("bigint")).alias("checked"),
            F.sum(B.popcount(F.col("det"))).alias("events"),
        )
    )

    def entry(name: Column, n: str) -> Column:
        return F.struct(name.alias("counter"), F.col(n).alias("n"))

    entries = F.array(entry(F.lit(CHECKED), "checked"), entry(F.lit(EVENTS), "events"), entry(F.col("combo"), "n"))
    return patterns.select(*keys, F.inline(entries)).filter("counter is not null").groupBy(*keys, "counter").agg(F.sum("n").alias("n"))


def detector_rates(shots: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Shots, fired shots and rate of each detector.

    The long rows live only until the partial aggregate of their own task: what
    is shuffled is one row per task and detector.
    """
    keys = keys or ["task_id"]
    counts = (
        shots.select(*keys, F.posexplode("det").alias("det_id", "_fired"))
        .groupBy(*keys, F.col("det_id").cast("bigint").alias("det_id"))
        .agg(F.count("*").alias("shots"), F.count_if("_fired").alias("fired"))
    )
    return counts.withColumn("rate", F.try_divide("fired", "shots"))


def rate_range(rates: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Smallest and largest detector rate, and the event total."""
    return rates.groupBy(*(keys or ["task_id"])).agg(
        F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"), F.sum("fired").alias("events")
    )
