"""Property tests: the one-shuffle plans equal the reference's join plans on random rows."""

from collections import defaultdict
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adlens.operators.combine import totals
from adlens.operators.reports import _keyword_as_written

KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
HOUR = st.sampled_from(["h1", "h2"])
COUNT = st.one_of(st.none(), st.integers(-3, 5))
MONEY = st.one_of(st.none(), st.integers(-500, 2000).map(lambda c: D(c) / 100))

TRAFFIC = st.lists(st.tuples(KEY, KEY, HOUR, st.sampled_from(["k1", "k2"]), COUNT, COUNT, MONEY), max_size=12)
CONVERSION = st.lists(st.tuples(KEY, KEY, HOUR, COUNT, MONEY, COUNT), max_size=12)

T_SCHEMA = ("campaign_id string, ad_group_id string, time_window_start string, keyword_id string, "
            "impressions bigint, clicks bigint, cost decimal(18,4)")
C_SCHEMA = ("campaign_id string, ad_group_id string, time_window_start string, conversions bigint, "
            "sales decimal(18,4), units bigint")
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=list(HealthCheck))


def _sum(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def expected_left_join(traffic, conversion):
    """Aggregate each side by (campaign, ad group), then left join: the reference's shape."""
    t, c = defaultdict(list), defaultdict(list)
    for row in traffic:
        t[(row[0], row[1])].append(row)
    for row in conversion:
        c[(row[0], row[1])].append(row)
    out = {}
    for key, rows in t.items():
        match = c.get(key) if None not in key else None     # null keys never match
        out[key] = (_sum(r[4] for r in rows), _sum(r[5] for r in rows), _sum(r[6] for r in rows),
                    _sum(r[3] for r in match) if match else None,
                    _sum(r[4] for r in match) if match else None,
                    _sum(r[5] for r in match) if match else None)
    return out


@SETTINGS
@given(traffic=TRAFFIC, conversion=CONVERSION)
def test_union_aggregate_equals_left_join(spark, traffic, conversion):
    t = spark.createDataFrame(traffic, T_SCHEMA)
    c = spark.createDataFrame(conversion, C_SCHEMA)
    got = {(r.campaign_id, r.ad_group_id): (r.total_impressions, r.total_clicks, r.total_cost,
                                             r.total_orders, r.total_sales, r.total_units)
           for r in totals(t, c, ["campaign_id", "ad_group_id"]).collect()}
    assert got == expected_left_join(traffic, conversion)


def expected_pairs(traffic, conversion):
    """Every traffic row paired with every matching conversion row, then summed by keyword."""
    out = defaultdict(lambda: [[], [], [], [], []])
    for t in traffic:
        matches = [c for c in conversion
                   if None not in (t[0], t[1]) and (c[0], c[1], c[2]) == (t[0], t[1], t[2])]
        acc = out[(t[0], t[3])]
        for c in (matches or [None]):
            acc[0].append(t[4])
            acc[1].append(t[5])
            acc[2].append(t[6])
            acc[3].append(c[3] if c else None)
            acc[4].append(c[4] if c else None)
    return {k: tuple(_sum(v) for v in vals) for k, vals in out.items()}


@SETTINGS
@given(traffic=TRAFFIC, conversion=CONVERSION)
def test_fan_out_algebra_equals_pairwise_join(spark, traffic, conversion):
    t = (spark.createDataFrame(traffic, T_SCHEMA)
         .selectExpr("*", "'kw' as keyword_text", "'EXACT' as match_type"))
    c = spark.createDataFrame(conversion, C_SCHEMA)
    got = {(r.campaign_id, r.keyword_id): (r.impressions, r.clicks, r.cost, r.conversions, r.sales)
           for r in _keyword_as_written(t, c).collect()}
    assert got == expected_pairs(traffic, conversion)


# --- rule conditions: compiled Spark predicate == the reference's substitute-and-evaluate -----

from adlens.operators import rules  # noqa: E402

NAMES = st.sampled_from(["acos", "roas", "conversion", "ctr"])
OPS = st.sampled_from(["<", "<=", ">", ">=", "==", "!="])
NUMS = st.sampled_from(["0", "1.0", "2.5", "3", "10.0", "40.0", ".5"])


def _atom():
    return st.builds(lambda n, o, v: f"{n} {o} {v}", NAMES, OPS, NUMS)


CONDITIONS = st.recursive(
    _atom(),
    lambda inner: st.one_of(
        st.builds(lambda a, b: f"{a} and {b}", inner, inner),
        st.builds(lambda a, b: f"{a} or {b}", inner, inner),
        st.builds(lambda a: f"not {a}", inner),
        st.builds(lambda a: f"({a})", inner)),
    max_leaves=4)
METRIC = st.one_of(st.none(), st.sampled_from([0.0, 0.5, 1.0, 2.5, 3.0, 4.0, 10.0, 12.5, 40.0, 55.5]))
ROWS = st.lists(st.tuples(METRIC, METRIC, METRIC, METRIC), min_size=1, max_size=8)


def python_semantics(condition, row):
    values = {"acos": row[0], "roas": row[1], "conversion": row[2], "ctr": row[3]}
    text = condition
    for name, value in values.items():          # missing values count as 0
        text = text.replace(name, str(float(value) if value is not None else 0))
    return bool(eval(text))  # noqa: S307 - test oracle over generated, whitelisted text


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(condition=CONDITIONS, rows=ROWS)
def test_compiled_rules_match_substitute_and_evaluate(spark, condition, rows):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)],
                               "campaign_id string, acos double, roas double, conversion double, ctr double")
    rule = [{"condition": condition, "action": "x", "percentage": 1}]
    fired = {r.campaign_id for r in rules.bid_recommendations(df, rule).collect()}
    expected = {str(i) for i, r in enumerate(rows) if python_semantics(condition, r)}
    assert fired == expected, condition
