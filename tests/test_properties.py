"""Property tests: the Spark column rules against plain-Python statements of the same rules."""

from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultline.functions import columns as C

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
NAMEISH = st.text(alphabet="abcXYZ' -  \t1", max_size=14)
BOOLISH = st.sampled_from(["yes", "YES", " Yes ", "true", "TRUE", "1", "t", "T", "y", "Y", "no", "None", "",
                           "n/a", "maybe", "0", "f", " t", "yes!", "tru"])
NUMBERISH = st.text(alphabet="0123456789.,- ", max_size=18)


def py_title_case(s):
    if s is None:
        return None
    words = [w for w in s.strip(" ").split(" ") if w != ""]
    return " ".join(w[0].upper() + w[1:].lower() for w in words) or None


def py_bool(s):
    return s is not None and s.strip(" ").lower() in C.TRUE_TOKENS


def py_balance(s):
    if s is None:
        return None
    try:
        d = Decimal(s.strip(" ").replace(",", ""))
    except InvalidOperation:
        return None
    if not d.is_finite():
        return None
    q = d.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return q if abs(q) < Decimal(10) ** 13 else None


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", fn("v")).collect())]


@SETTINGS
@given(st.lists(st.one_of(st.none(), NAMEISH), min_size=1, max_size=60))
def test_title_case_matches_rule(spark, values):
    assert _apply(spark, values, C.title_case) == [py_title_case(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), BOOLISH), min_size=1, max_size=60))
def test_standardize_boolean_matches_rule(spark, values):
    assert _apply(spark, values, C.standardize_boolean) == [py_bool(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), NUMBERISH), min_size=1, max_size=60))
def test_parse_balance_matches_rule(spark, values):
    assert _apply(spark, values, C.parse_balance) == [py_balance(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-5_000_000, 5_000_000), st.one_of(st.none(), st.booleans())),
                min_size=1, max_size=60))
def test_interest_rate_and_amounts_match_rule(spark, pairs):
    rows = [(i, Decimal(c) / 100, loan) for i, (c, loan) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, b decimal(15,2), l boolean")
    rate = C.interest_rate("b", "l")
    out = df.select("i", rate.alias("r"), C.annual_interest("b", C.Sql(C.interest_rate_sql("b", "l"))).alias("a"))
    got = [(r["r"], r["a"]) for r in sorted(out.collect())]
    want = []
    for _, b, loan in rows:
        base = Decimal("0.01") if b < 10000 else Decimal("0.015") if b <= 20000 else Decimal("0.02")
        r = base + (Decimal("0.005") if loan else 0)
        want.append((r.quantize(Decimal("0.0001")), (b * r).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)))
    assert got == want
