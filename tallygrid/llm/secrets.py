"""Secret scan: candidates by shape, and a random forest that removes false positives.

Everything is DataFrame functions and Spark's own forest. A candidate is a run of key
characters with a digit in it, or any value that is assigned to a credential's name.
Its features are its length, the transitions between
kinds of characters, how much of its letters a dictionary of the corpus covers, what
of it looks like a path, and the words beside it. The forest learns from labelled
findings; it trains on a sample of them that is bounded by a parameter.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.session import materialize

LEAST_LENGTH = 16
# Labelled findings that the forest is trained on at most, words of the dictionary, trees and their depth.
TRAIN_ROWS, DICTIONARY, TREES, DEPTH = 20_000, 20_000, 20, 6

_BLANK = "[\\\\x20\\\\x09-\\\\x0D]+"
_RUN = "[A-Za-z0-9+/_=-]"

# Names that a credential is assigned to.
KEY_NAMES = "token secret key passwd password pwd auth bearer credential credentials apikey api_key access_key secret_key private_key client_secret access_token".split()

FEATURES = [
    "n_chars", "n_distinct", "share_digit", "share_lower", "share_upper", "share_other", "longest_digits", "hex_only", "digits_only",
    "lower_digit", "digit_lower", "upper_lower", "lower_upper", "digit_digit", "changes", "coverage", "slashes", "path_like",
    "assigned_inside", "assigned_before", "quoted", "before_is_word", "after_is_word", "before_ends_sentence",
]

# What label_by_name decides by: the place of an assigned value, and the shapes that no secret has.
LABEL_DEFINING = {"assigned_inside", "assigned_before", "quoted", "before_is_word", "before_ends_sentence", "digits_only", "path_like"}

_NAMES = f"(?i:{'|'.join(KEY_NAMES)})[\"'`]?"
_ASSIGN = "(?::=|=>|==|[=:])"
_VALUE = "(?:\"[^\"]+\"|'[^']+'|`[^`]+`|[\"'`]?[^\"'`\\s,;&(){}\\[\\]]+)"


def dictionary(docs: DataFrame, n_words: int = DICTIONARY) -> DataFrame:
    """The most frequent lower-case words of at least three letters: (part), bounded by n_words; ties by the word."""
    words = docs.select(F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)")).alias("part"))
    return materialize(words.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "part").limit(n_words).select("part"), "dictionary")


def _assigned(word: Column, before: Column, before2: Column, tail: Column) -> Column:
    """The values assigned to a credential's name that begin in a word, without quotes; tail is the word and some after it.

    The name and the sign may be in the word or in the two before it. A quoted value
    goes on to its closing quote, with one blank between words.
    """
    inside = F.regexp_extract_all(word, F.lit(f"({_NAMES}{_ASSIGN}{_VALUE})"), F.lit(1))
    across = F.regexp_extract(tail, f"^(\\S*?{_NAMES}{_ASSIGN}(?:\"[^\"]+\"|'[^']+'|`[^`]+`))", 1)
    inside = F.when((F.size(inside) < 2) & (across != ""), F.array(F.regexp_extract(across, f"({_NAMES}{_ASSIGN}{_VALUE})$", 1))).otherwise(inside)
    sign = before.rlike(f"{_NAMES}{_ASSIGN}$") | (before.rlike(f"^{_ASSIGN}$") & before2.rlike(f"{_NAMES}$"))
    first = F.when(sign, F.regexp_extract(tail, f"^({_VALUE})", 1))
    first = F.when(before.rlike(f"{_NAMES}$") & word.rlike(f"^{_ASSIGN}"), F.regexp_extract(tail, f"^{_ASSIGN}({_VALUE})", 1)).otherwise(first)
    every = F.concat(F.array(F.coalesce(first, F.lit(""))), F.transform(inside, lambda x: F.regexp_replace(x, f"^{_NAMES}{_ASSIGN}", "")))
    bare = F.transform(every, lambda x: F.when(x.rlike("^[\"'`]"), F.regexp_replace(x, "^[\"'`]|[\"'`]$", "")).otherwise(F.regexp_replace(x, "[.:]+$", "")))
    # What only repeats the sign (`token ==`) is no value.
    return F.filter(F.array_distinct(bare), lambda x: x.rlike("[^=:>]"))


def candidates(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, row, word_no, run_no, candidate, word, before, before2, after, named) of each run of at least `least` key
    characters with a digit, and of each value assigned to a credential's name, of any length; those follow the runs of their word."""
    run = f"{_RUN}{{{least},}}"
    near_name = F.col("text").rlike(f"{_NAMES}\\s*{_ASSIGN}")
    some = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9]") | near_name)
    split = some.select("doc_id", F.xxhash64("text").alias("row"), near_name.alias("near_name"), F.expr(f"split(text, '{_BLANK}')").alias("ws"))
    get = lambda at: F.coalesce(F.get("ws", at), F.lit(""))
    name_here = lambda x: (
        x["w"].rlike(f"{_NAMES}{_ASSIGN}.|^{_ASSIGN}.") | get(x["i"] - 1).rlike(f"{_NAMES}{_ASSIGN}$|^{_ASSIGN}$")
    )
    each = F.transform("ws", lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    hit = F.filter(each, lambda x: (x["w"].rlike(run) & x["w"].rlike("[0-9]")) | (F.col("near_name") & name_here(x)))
    words = split.select("doc_id", "row", "ws", F.explode(hit).alias("x"))
    at = F.col("x.i")
    near = lambda d: get(at + d)
    # An open quote takes the words up to the one with its partner, however many; without a partner the word stands alone.
    quote = F.regexp_extract("x.w", f"(?:^|{_ASSIGN})([\"'`])(?:(?!\\1).)*$", 1)
    partner = F.array_position(F.transform(F.slice("ws", at + 2, F.size("ws")), lambda w: w.contains(quote)), F.lit(True)).cast("int")
    tail = F.array_join(F.slice("ws", at + 1, F.when(quote != "", partner + 1).otherwise(1)), " ")
    each = words.select(
        "doc_id", "row", at.alias("word_no"), F.col("x.w").alias("word"), near(-2).alias("before2"), near(-1).alias("before"), near(1).alias("after"), tail.alias("tail")
    )
    values = _assigned(F.col("word"), F.col("before"), F.col("before2"), F.col("tail"))
    both = each.withColumn("runs", F.expr(f"regexp_extract_all(word, '{run}', 0)")).withColumn("values", values).drop("tail")
    listed = F.concat("runs", F.array_except("values", "runs"))
    found = both.select("*", F.posexplode(listed).alias("run_no", "candidate"))
    found = found.withColumn("named", F.exists("values", lambda v: v.contains(F.col("candidate"))))
    return found.filter(F.col("candidate").rlike("[0-9]") | F.array_contains("values", F.col("candidate"))).drop("runs", "values")


def _count(pattern: str) -> Column:
    return F.regexp_count(F.col("candidate"), F.lit(pattern)).cast("double")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with their FEATURES; the dictionary is joined part by part."""
    n = F.length("candidate").cast("double")
    base = materialize(found.withColumn("at", F.xxhash64("doc_id", "row", "word_no", "run_no")), "candidates")
    parts = base.select("at", F.explode(F.expr("regexp_extract_all(lower(candidate), '[a-z]{3,}', 0)")).alias("part"))
    covered = parts.join(words, "part").groupBy("at").agg(F.sum(F.length("part")).alias("covered"))
    covered = covered.join(base.groupBy("at").agg(F.count(F.lit(1)).alias("copies")), "at").select("at", (F.col("covered") / F.col("copies")).alias("covered"))
    runs = F.expr("regexp_extract_all(candidate, '[0-9]+', 0)")
    kinds = F.expr("regexp_replace(regexp_replace(regexp_replace(candidate, '[a-z]+', 'l'), '[A-Z]+', 'u'), '[0-9]+', 'd')")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    word_like = lambda c: flag(F.col(c).rlike("^[\\p{L}]+[.,;:]?$"))
    return base.join(covered, "at", "left").select(
        *base.columns,
        n.alias("n_chars"),
        F.size(F.array_distinct(F.split("candidate", ""))).cast("double").alias("n_distinct"),
        (_count("[0-9]") / n).alias("share_digit"),
        (_count("[a-z]") / n).alias("share_lower"),
        (_count("[A-Z]") / n).alias("share_upper"),
        (_count("[^A-Za-z0-9]") / n).alias("share_other"),
        F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0)).cast("double").alias("longest_digits"),
        flag(F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex_only"),
        flag(F.col("candidate").rlike("^[0-9-]+$")).alias("digits_only"),
        (_count("[a-z](?=[0-9])") / n).alias("lower_digit"),
        (_count("[0-9](?=[a-z])") / n).alias("digit_lower"),
        (_count("[A-Z](?=[a-z])") / n).alias("upper_lower"),
        (_count("[a-z](?=[A-Z])") / n).alias("lower_upper"),
        (_count("[0-9](?=[0-9])") / n).alias("digit_digit"),
        (F.length(kinds) / n).alias("changes"),
        (F.coalesce("covered", F.lit(0.0)) / n).alias("coverage"),
        _count("/").alias("slashes"),
        flag(F.col("word").rlike("(^[./~]|://|/[^/]+/|[.][a-z]{2,4}$)")).alias("path_like"),
        flag(F.col("word").rlike("[=:][\"']?[A-Za-z0-9+/_=-]+")).alias("assigned_inside"),
        flag(F.col("before").rlike("[=:]$")).alias("assigned_before"),
        flag(F.col("word").rlike("[\"'`]")).alias("quoted"),
        word_like("before").alias("before_is_word"),
        word_like("after").alias("after_is_word"),
        flag(F.col("before").rlike("[.!?]$")).alias("before_ends_sentence"),
    )


def label_by_name(found: DataFrame) -> DataFrame:
    """Findings with a label where the text itself settles it, null otherwise.

    1 where the value is assigned to a credential's name; 0 where it is not and is a
    number, a path of dictionary words or a run whose letters are all in dictionary
    words, quoted or not. A plain word of a sentence after a name and a colon is 0.
    """
    letters = F.col("share_lower") + F.col("share_upper")
    covered = (letters > 0) & (F.col("coverage") >= letters - 1e-9)
    path = F.col("word").rlike("^[\"'`(]*(~?[.]{0,2}/|[A-Za-z][A-Za-z0-9+.-]*://)") & (F.col("coverage") >= letters / 2)
    prose = covered & F.col("candidate").rlike("^[A-Za-z]+$") & F.col("before").rlike(":$") & (F.col("word") == F.col("candidate")) & (F.col("after_is_word") > 0)
    negative = F.when(F.col("named"), prose).otherwise((F.col("digits_only") > 0) | path | covered)
    return found.withColumn("label", F.when(negative, 0.0).when(F.col("named"), 1.0))


def train(
    labelled: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH, columns: list[str] = FEATURES
) -> RandomForestClassificationModel | None:
    """A forest from findings with the feature `columns` and a label; None if the labels are not of both kinds.

    Each label keeps at most half of `train_rows`, by a hash of the finding, so both
    are learned from; equal findings count as often as they occur up to there.
    """
    known = labelled.filter("label IS NOT NULL")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.lit(1.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, train_rows / 2 / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", "row", "word_no", "run_no"), F.lit(1_000_003)) / 1_000_003
    sample = materialize(VectorAssembler(inputCols=columns, outputCol="x").transform(known.filter(place < share)).select("x", "label"), "labelled")
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=7).fit(sample)


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5, columns: list[str] = FEATURES) -> DataFrame:
    """The findings with `probability` of being a secret and `secret`; without a model every finding stays."""
    if model is None:
        return found.withColumn("probability", F.lit(None).cast("double")).withColumn("secret", F.lit(True))
    assembled = VectorAssembler(inputCols=columns, outputCol="x").transform(found)
    scored = model.transform(assembled).withColumn("probability", F.round(vector_to_array("probability")[1], 9))
    return scored.withColumn("secret", F.col("probability") >= threshold)


def scan(docs: DataFrame, labelled: DataFrame | None = None, least: int = LEAST_LENGTH, n_words: int = DICTIONARY, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per candidate: doc_id, row, word_no, run_no, candidate, probability, secret.

    `labelled` holds findings with (doc_id, row, word_no, run_no, label), for example
    from reviewers; without it, findings label each other by name (`label_by_name`),
    and the forest does not see the LABEL_DEFINING features.
    word_no counts the words between ASCII white space from 0 (a leading blank makes an
    empty word 0), run_no the runs in a word and after them its assigned values. Null and empty texts have no candidates,
    a null doc_id is kept. Rows that repeat a document repeat its findings. No documents
    give no rows. The dictionary is of all documents; runs jobs and writes tables.
    """
    found = materialize(features(candidates(docs, least), dictionary(docs, n_words)), "findings")
    keys = ["doc_id", "row", "word_no", "run_no"]
    columns = FEATURES
    if labelled is None:
        known, columns = label_by_name(found), [c for c in FEATURES if c not in LABEL_DEFINING]
    else:
        side = labelled.select(*(F.col(c).alias(f"l_{c}") for c in keys), F.col("label").cast("double").alias("label"))
        known = found.join(side, [found[c].eqNullSafe(side[f"l_{c}"]) for c in keys])
    return judge(found, train(known, train_rows, columns=columns), columns=columns).select(*keys, "candidate", "probability", "secret")
