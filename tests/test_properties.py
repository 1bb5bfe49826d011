"""Property checks of the bin helpers against a plain-Python statement of the rules."""

import bisect

from hypothesis import given, settings
from hypothesis import strategies as st

from citybeat.constants import BIKE_DURATION_EDGES, BIKE_DURATION_LABELS, TIP_EDGES, TIP_LABELS
from citybeat.functions.bins import left_closed_bin, right_closed_bin

values = st.lists(
    st.one_of(st.floats(min_value=-10, max_value=20000, allow_nan=False), st.sampled_from([0.0, 5.0, 10.0, 20.0, 25.0, 40.0, 10000.0])),
    min_size=1,
    max_size=60,
)


def py_left(v, edges, labels):
    if v < edges[0] or v >= edges[-1]:
        return None
    return labels[bisect.bisect_right(edges, v) - 1]


def py_right_lowest(v, edges, labels):
    if v < edges[0] or v > edges[-1]:
        return None
    if v == edges[0]:
        return labels[0]
    return labels[bisect.bisect_left(edges, v) - 1]


@settings(max_examples=15, deadline=None)
@given(values)
def test_bins_match_reference_rules(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    rows = df.select(
        "v",
        left_closed_bin("v", TIP_EDGES, TIP_LABELS).alias("a"),
        right_closed_bin("v", BIKE_DURATION_EDGES, BIKE_DURATION_LABELS).alias("b"),
    ).collect()
    for r in rows:
        assert r.a == py_left(r.v, TIP_EDGES, TIP_LABELS)
        assert r.b == py_right_lowest(r.v, BIKE_DURATION_EDGES, BIKE_DURATION_LABELS)
