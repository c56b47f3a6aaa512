"""Line profile of instruction text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Instruction words.
NON_CLIFFORD = ["T", "T_DAG", "R_X", "R_Y", "R_Z", "U3"]
MEASURE_EACH = ["M", "MX", "MY", "MZ", "MR", "MRX", "MRY", "MRZ", "MPAD", "MPP"]
MEASURE_PAIRS = ["MXX", "MYY", "MZZ"]
MEASURE_WORDS = MEASURE_EACH + MEASURE_PAIRS
# Words that neither measure nor hold other lines; any word that is in none of the lists might measure.
SILENT = (
    ["DETECTOR", "OBSERVABLE_INCLUDE", "TICK", "QUBIT_COORDS", "SHIFT_COORDS", "R", "RX", "RY", "RZ", "I", "X", "Y", "Z", "H", "H_XY", "H_XZ", "H_YZ", "S", "S_DAG"]
    + ["SQRT_X", "SQRT_X_DAG", "SQRT_Y", "SQRT_Y_DAG", "SQRT_Z", "SQRT_Z_DAG", "C_XYZ", "C_ZYX", "CX", "CNOT", "ZCX", "CY", "ZCY", "CZ", "ZCZ", "XCX", "XCY", "XCZ", "YCX", "YCY", "YCZ"]
    + ["SWAP", "ISWAP", "ISWAP_DAG", "CXSWAP", "SWAPCX", "SQRT_XX", "SQRT_YY", "SQRT_ZZ", "X_ERROR", "Y_ERROR", "Z_ERROR", "DEPOLARIZE1", "DEPOLARIZE2", "PAULI_CHANNEL_1", "PAULI_CHANNEL_2"]
    + ["E", "CORRELATED_ERROR", "ELSE_CORRELATED_ERROR"]
)
REPEAT = "REPEAT"


def profile(texts: DataFrame, text: str = "text") -> DataFrame:
    """Detectors, observables, measurements and T-count per text, computed inside the row.

    Flat text only: a text with repeat blocks is flagged and its counts are NULL. So is
    the number of measurements where a word is unknown, which might measure; comments
    are no words.
    """
    lines = F.filter(F.transform(F.split(text, "\n"), F.trim), lambda s: s != "")
    parsed = F.transform(
        lines, lambda s: F.struct(F.substring_index(F.substring_index(s, " ", 1), "(", 1).alias("word"), s.alias("line"))
    )

    def count(word: str) -> Column:
        return F.size(F.filter("_lines", lambda x: x["word"] == word)).cast("bigint")

    def target_sum(words: list[str]) -> Column:
        named = F.filter("_lines", lambda x: x["word"].isin(words))
        return F.aggregate(named, F.lit(0).cast("bigint"), lambda acc, x: acc + F.size(F.split(x["line"], " +")) - 1)

    flat = ~F.col("has_repeat")
    other = F.exists("_lines", lambda x: ~x["word"].isin(MEASURE_WORDS + NON_CLIFFORD + SILENT) & ~x["word"].startswith("#"))
    return (
        texts.withColumn("_lines", parsed)
        .withColumn("has_repeat", F.exists("_lines", lambda x: x["word"] == REPEAT))
        .select(
            *texts.columns,
            "has_repeat",
            F.size("_lines").cast("bigint").alias("n_lines"),
            F.when(flat, count("DETECTOR")).alias("n_detectors"),
            F.when(flat, count("OBSERVABLE_INCLUDE")).alias("n_observables"),
            F.when(flat & ~other, target_sum(MEASURE_EACH) + F.floor(target_sum(MEASURE_PAIRS) / 2)).alias("n_measurements"),
            F.when(flat, target_sum(NON_CLIFFORD)).alias("t_count"),
            F.exists("_lines", lambda x: x["word"].isin(NON_CLIFFORD)).alias("non_clifford"),
        )
    )
