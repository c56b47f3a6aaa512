"""Experiment names, metadata and labels as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def has_extension(path: Column, extension: str) -> Column:
    return basename(path).endswith("." + extension.lstrip("."))


def _pairs(text: Column, separator: str) -> Column:
    """`k=v` pairs to a map; NULL when a part has no `=` or a key comes twice."""
    key, value = f"[^={separator}]+", f"[^{separator}]*"
    well_formed = f"^{key}={value}({separator}{key}={value})*$"
    repeated = f"(^|{separator})({key})=.*{separator}\\2="
    return F.when(text.rlike(well_formed) & ~text.rlike(repeated), F.str_to_map(text, F.lit(separator), F.lit("=")))


def parse_comma_name(path: Column) -> Column:
    """`d=3,p=0.01,b=X,type=memory.ext` to a string map, NULL when malformed."""
    return _pairs(stem(path), ",")


def parse_underscore_name(path: Column) -> Column:
    """`family_K=3_p=0.01.ext` to a string map: the first token is dropped, NULL when malformed."""
    return _pairs(F.regexp_replace(stem(path), r"^[^_]*_", ""), "_")


def meta_value(meta: Column, key: str, to: str = "string") -> Column:
    """One metadata field, typed; NULL when absent or not of that type."""
    return F.element_at(meta, F.lit(key)).try_cast(to)


def parse_json_metadata(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def display_label(path: Column, prefix: str, extension: str) -> Column:
    """Short label of a file: without the family prefix and the extension."""
    return F.replace(F.replace(basename(path), F.lit(prefix), F.lit("")), F.lit("." + extension), F.lit(""))


def series_label(kind: Column, d: Column) -> Column:
    """Legend text of one curve."""
    return F.concat(kind.cast("string"), F.lit(" d="), d.cast("string"))


def backend_key(decoder: Column, backend: str) -> Column:
    """Registration key of a decoder that reads shots of one sampling backend."""
    return F.concat_ws("_", decoder, F.lit(backend))


def rate_text(p: Column) -> Column:
    """A rate as the shortest decimal text, as it stands in file names: 0.0005, 1e-05."""
    shortest = p.cast("string")
    positional = F.regexp_replace(shortest.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(shortest, "E", 1), r"\.0$", "")
    exponent = F.substring_index(shortest, "E", -1).try_cast("int")
    scientific = F.concat(mantissa, F.format_string("e-%02d", F.abs(exponent)))
    return F.when((p == 0) | (F.abs(p) >= 1e-4), positional).otherwise(scientific)
