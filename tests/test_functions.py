import math

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import bits as B, ids, layout as L, names as N, rates as R, zscores as Z


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def bools(*bits):
    return F.array(*[F.lit(bool(b)) for b in bits])


@pytest.mark.parametrize(
    "path, expected",
    [
        ("a/d=3,p=0.01,b=X,type=memory.circuit", {"d": "3", "p": "0.01", "b": "X", "type": "memory"}),
        ("d=3,p=0.0005.x", {"d": "3", "p": "0.0005"}),
        ("d=3,p=a=b.x", {"d": "3", "p": "a=b"}),
        ("d3,p=0.01.x", None),
        ("d=3,d=5.x", None),
        ("=3.x", None),
    ],
)
def test_comma_names(spark, path, expected):
    assert value(spark, N.parse_comma_name(F.lit(path))) == expected


def test_underscore_names(spark):
    meta = N.parse_underscore_name(F.lit("dir/family_K=3_p=0.01.circuit"))
    assert value(spark, meta) == {"K": "3", "p": "0.01"}
    assert value(spark, N.meta_value(meta, "K", "int")) == 3
    assert value(spark, N.meta_value(meta, "p", "double")) == 0.01
    assert value(spark, N.meta_value(meta, "absent")) is None
    assert value(spark, N.parse_underscore_name(F.lit("family_K3_p=0.01.circuit"))) is None
    assert value(spark, N.meta_value(N.parse_underscore_name(F.lit("f_K=x_p=1.c")), "K", "int")) is None


def test_path_parts(spark):
    path = F.lit("s3a://b/x.y/file.name.circuit")
    assert value(spark, N.basename(path)) == "file.name.circuit"
    assert value(spark, N.stem(path)) == "file.name"
    assert value(spark, N.stem(F.lit("x/plain"))) == "plain"
    assert value(spark, N.has_extension(path, "circuit")) is True
    assert value(spark, N.has_extension(path, ".csv")) is False
    assert value(spark, N.display_label(F.lit("q/fam_K=1_p=0.1.circuit"), "fam_", "circuit")) == "K=1_p=0.1"


@pytest.mark.parametrize("p", [0.0005, 0.001, 0.01, 0.05, 1e-4, 9.9e-5, 1e-5, 2.5e-7, 1e-12, 0.0, 1.0, 12.5, 0.1 + 0.2])
def test_rate_text_is_the_shortest_decimal(spark, p):
    assert value(spark, N.rate_text(F.lit(p))) == repr(p)


def test_pack_known_bytes(spark):
    assert value(spark, B.pack_bits(bools(1, 0, 1, 1, 0, 0, 0, 0, 1))) == [13, 1]
    assert value(spark, B.pack_bits(F.array().cast("array<boolean>"))) == []


@pytest.mark.parametrize("length", [1, 7, 8, 9, 16, 61])
def test_pack_and_unpack_are_inverse(spark, length):
    vector = [bool((i * i + length) % 3 == 0) for i in range(length)]
    packed = B.to_binary(B.pack_bits(bools(*vector)))
    assert value(spark, B.unpack_bits(B.to_bytes(packed), length)) == vector
    assert value(spark, B.unpack_binary(packed, length)) == vector
    assert value(spark, F.octet_length(packed)) == math.ceil(length / 8)
    assert value(spark, B.popcount_bytes(B.pack_bits(bools(*vector)))) == sum(vector)
    assert value(spark, B.popcount(bools(*vector))) == sum(vector)


def test_masks(spark):
    none = F.lit(None).cast("array<boolean>")
    assert value(spark, B.any_masked(bools(0, 1), bools(1, 0))) is False
    assert value(spark, B.any_masked(bools(0, 1), bools(0, 1))) is True
    assert value(spark, B.any_masked(bools(1, 1), none)) is False
    assert value(spark, B.full_mask(3)) == [True] * 3
    assert value(spark, B.xor_bits(bools(1, 0, 1), bools(1, 1, 0))) == [False, True, True]


def test_rates_without_survivors_or_shots(spark):
    lit = lambda n: F.lit(n).cast("bigint")
    assert value(spark, R.postselected_error_rate(lit(0), lit(5), lit(5))) is None
    assert value(spark, R.postselection_rate(lit(5), lit(5))) == 0.0
    assert value(spark, R.error_rate(lit(0), lit(0))) is None
    assert value(spark, R.postselection_rate(lit(0), lit(0))) == 0.0
    assert value(spark, R.relative_deviation(lit(0), lit(3))) == 0.0
    assert value(spark, R.relative_deviation(lit(4), lit(3))) == 0.25


def test_report_texts(spark):
    assert value(spark, R.percent_text(F.lit(-0.0362))) == "-3.62%"
    assert value(spark, R.percent_text(F.lit(0.5))) == "+50.00%"
    assert value(spark, R.rate_report(F.lit(0.06821))) == "0.0682"


def test_sigma_definitions(spark):
    a, b, n = F.lit(60), F.lit(40), F.lit(100)
    pooled = 20 / math.sqrt(2 * 100 * 0.5 * 0.5)
    first = 20 / math.sqrt(2 * 100 * 0.6 * 0.4)
    assert value(spark, Z.z_totals(a, b, n)) == pytest.approx(pooled)
    assert value(spark, Z.z_totals(b, a, n)) == pytest.approx(-pooled)
    assert value(spark, Z.z_totals(a, b, n, "first")) == pytest.approx(first)
    assert value(spark, Z.z_first_p(b, a, n)) == pytest.approx(20 / math.sqrt(2 * 100 * 0.4 * 0.6))
    assert value(spark, Z.z_max_p(F.lit(0.6), F.lit(0.4), n)) == pytest.approx(0.2 / math.sqrt(0.6 * 0.4 / 100))
    unpooled = 0.2 / math.sqrt(0.6 * 0.4 / 100 + 0.4 * 0.6 / 200)
    assert value(spark, Z.z_unpooled(F.lit(0.6), n, F.lit(0.4), F.lit(200))) == pytest.approx(unpooled)
    with pytest.raises(ValueError):
        Z.z_totals(a, b, n, "other")


def test_no_events_is_no_disagreement(spark):
    zero, n = F.lit(0), F.lit(100)
    assert value(spark, Z.z_totals(zero, zero, n)) == 0
    assert value(spark, Z.z_totals(zero, zero, zero)) == 0
    assert value(spark, Z.z_unpooled(F.lit(0.0), n, F.lit(0.0), n)) == 0
    assert value(spark, Z.z_max_p(F.lit(0.0), F.lit(0.0), n)) == 0


def test_verdicts(spark):
    assert value(spark, Z.bias_verdict(F.lit(1.6))) == "systematic: a above b"
    assert value(spark, Z.bias_verdict(F.lit(-1.6))) == "systematic: a below b"
    assert value(spark, Z.bias_verdict(F.lit(1.5))) == "statistical"
    assert value(spark, Z.agreement_verdict(F.lit(2.9), F.lit(0.5))) == "agree"
    assert value(spark, Z.agreement_verdict(F.lit(3.0), F.lit(0.07))) == "mechanical only"
    assert value(spark, Z.agreement_verdict(F.lit(3.0), F.lit(0.08))) == "unusable"
    assert [value(spark, Z.confirmation_verdict(F.lit(z))) for z in (-5.1, 5.0, 3.0)] == ["confirmed", "likely", "none"]
    assert value(spark, Z.usability_verdict(F.lit(None).cast("double"))) == "no flips"
    assert value(spark, Z.usability_verdict(F.lit(0.049))) == "usable"


def test_record_offsets_of_one_round(spark):
    one, first = F.lit(1), F.lit(0)
    assert [value(spark, L.data_offset(one, first, i)) for i in range(5)] == [-9, -8, -7, -6, -5]
    assert [value(spark, L.check_offset(one, first, j)) for j in range(4)] == [-4, -3, -2, -1]
    assert value(spark, L.theta()) == pytest.approx(L.THETA, abs=1e-15)


def test_content_id_separates_its_parts(spark):
    a = value(spark, ids.content_id(F.lit("ab"), F.lit("c")))
    b = value(spark, ids.content_id(F.lit("a"), F.lit("bc")))
    c = value(spark, ids.content_id(F.lit("ab"), F.lit("c"), F.lit("FF")))
    assert len({a, b, c}) == 3 and len(a) == 64
    assert value(spark, ids.id_prefix(F.lit(a))) == a[:16]
