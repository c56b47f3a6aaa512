"""Detectors and observables as parities of the measurements they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.profile import MEASURE_WORDS, REPEAT
from tallygrid.session import broadcast_if_small

# Instruction words that define detectors and observables.
DETECTOR_LINE = "DETECTOR"
OBSERVABLE_LINE = "OBSERVABLE_INCLUDE"
RECORD = r"rec\[(-\d+)\]"
# What comes before the word of a line.
LINE = r"(?:\A|\n)"


def parse_targets(texts: DataFrame, text: str = "text") -> DataFrame:
    """`(task_id, kind, id, rec_offset)` rows from instruction text.

    A detector or observable without targets is one row whose offset is NULL. Offsets
    count from the last measurement, so only flat text with all its measurements
    before its detectors can be read: other text (see `unsupported_texts`) is an error.
    """
    problem = _problem(F.col(text))
    checked = F.when(problem.isNull(), F.col(text)).otherwise(F.raise_error(F.concat(F.lit("task "), F.coalesce("task_id", F.lit("NULL")), F.lit(": "), problem)).cast("string"))

    def lines(word: str) -> Column:
        return F.regexp_extract_all("_text", F.lit(rf"{LINE}({word}[^\n]*+)"), 1)

    detectors = F.transform(lines(DETECTOR_LINE), lambda s, i: F.struct(F.lit("det").alias("kind"), i.alias("id"), s.alias("line")))
    observables = F.transform(
        lines(OBSERVABLE_LINE),
        lambda s: F.struct(
            F.lit("obs").alias("kind"),
            F.regexp_extract(s, r"\((\d+)\)", 1).cast("int").alias("id"),
            s.alias("line"),
        ),
    )
    return (
        texts.select("task_id", checked.alias("_text"))
        .select("task_id", F.explode(F.concat(detectors, observables)).alias("t"))
        .select("task_id", "t.kind", "t.id", F.explode_outer(F.regexp_extract_all("t.line", F.lit(RECORD), 1)).alias("offset"))
        .select("task_id", "kind", "id", F.col("offset").cast("int").alias("rec_offset"))
    )


def _word(words: list[str]) -> str:
    """Pattern of one of the words, whole."""
    return rf"(?:{'|'.join(words)})(?=[ (\n]|\z)"


def _problem(text: Column) -> Column:
    """Why the targets of a text cannot be read; NULL if they can. Looks at every line once."""
    after = F.regexp_extract(text, rf"(?s){LINE}{_word([DETECTOR_LINE, OBSERVABLE_LINE])}(.*)\z", 1)
    return F.when(text.rlike(LINE + _word([REPEAT])), F.lit("repeat blocks are not counted through")).when(
        after.rlike(r"\n" + _word(MEASURE_WORDS)), F.lit("a measurement follows a detector")
    )


def unsupported_texts(texts: DataFrame, text: str = "text") -> DataFrame:
    """`(task_id, problem)` of the texts that `parse_targets` refuses."""
    return texts.select("task_id", _problem(F.col(text)).alias("problem")).filter("problem IS NOT NULL")


def _position(total: Column, offset: Column) -> Column:
    """Place of a record; one outside of the record is an error and not a silent zero."""
    place = total + offset
    return F.when((place < 0) | (place >= total), F.raise_error(F.concat(F.lit("record outside the measurements: "), offset.cast("string"))).cast("int")).otherwise(place)


def _index_lists(targets: DataFrame, kind: str, total: Column) -> DataFrame:
    """Per task, the measurement positions of each detector (or observable), at the place of its id.

    An id that no line names has an empty list. The lists hold one circuit's
    definitions, so their size does not depend on the shots.
    """
    one = targets.filter(F.col("kind") == kind).groupBy("task_id", "id").agg(
        F.sort_array(F.collect_list(_position(total, F.col("rec_offset")))).alias("positions")
    )
    by_id = one.groupBy("task_id").agg(F.sort_array(F.collect_list(F.struct("id", "positions"))).alias("_named"))
    empty = F.array().cast("array<int>")

    def after_gap(entry: Column, i: Column) -> Column:
        """The entry's list behind an empty one for each id between it and the entry before."""
        before = F.coalesce(F.get("_named", i - 1)["id"], F.lit(-1))
        return F.concat(F.array_repeat(empty, entry["id"] - before - 1), F.array(entry["positions"]))

    return by_id.select("task_id", F.flatten(F.transform("_named", after_gap)).alias(f"{kind}_positions"))


def task_targets(targets: DataFrame, total: Column | int) -> DataFrame:
    """One row per task with the positions named by its detectors and observables."""
    n = F.lit(total) if isinstance(total, int) else total
    empty = F.array().cast("array<array<int>>")
    joined = _index_lists(targets, "det", n).join(_index_lists(targets, "obs", n), "task_id", "full")
    return joined.select(
        "task_id",
        F.coalesce("det_positions", empty).alias("det_positions"),
        F.coalesce("obs_positions", empty).alias("obs_positions"),
    )


def parities(measured: Column, positions: Column) -> Column:
    """Parity of the named measurements, one boolean per position list."""
    return F.transform(
        positions,
        lambda named: F.aggregate(named, F.lit(False), lambda acc, i: acc != F.get(measured, i)),
    )


def evaluate(measured_shots: DataFrame, per_task: DataFrame, measured: str = "measured") -> DataFrame:
    """`det` and `obs` vectors of shots that hold their measurement record as one array.

    Nothing is shuffled by shot: the definitions are joined per task and each
    parity is computed inside the row.
    """
    return measured_shots.join(broadcast_if_small(per_task, derived=True), "task_id").select(
        *[c for c in measured_shots.columns if c != measured],
        parities(F.col(measured), F.col("det_positions")).alias("det"),
        parities(F.col(measured), F.col("obs_positions")).alias("obs"),
    )


def evaluate_long(measurements: DataFrame, targets: DataFrame, total: Column | int) -> DataFrame:
    """The same for records stored as one row per measurement; a definition without targets never fires."""
    n = F.lit(total) if isinstance(total, int) else total
    named = targets.filter("rec_offset IS NOT NULL").select("task_id", "kind", "id", _position(n, F.col("rec_offset")).alias("idx"))
    fired = (
        measurements.join(broadcast_if_small(named, derived=True), ["task_id", "idx"])
        .groupBy("task_id", "shot_id", "kind", "id")
        .agg((F.bit_xor("bit") == 1).alias("fired"))
    )
    empty = targets.filter("rec_offset IS NULL").select("task_id", "kind", "id")
    silent = measurements.select("task_id", "shot_id").distinct().join(broadcast_if_small(empty, derived=True), "task_id")
    return fired.unionByName(silent.withColumn("fired", F.lit(False)))
