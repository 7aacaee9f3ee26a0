"""Property tests: unpivot layouts against brute force on random slot tables."""

import itertools
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from landstage.operators import unpivot_cross, unpivot_positional

VALUES = st.sampled_from(["a", "b", "c", None])
ROW = st.tuples(st.sampled_from(["m1", "m2", "m3", None]), VALUES, VALUES, VALUES, VALUES)
SCHEMA = "m string, x_1 string, x_2 string, y_1 string, y_2 string"
GROUPS = {"x": ["x_1", "x_2"], "y": ["y_1", "y_2"]}


def brute_cross(data):
    xs, ys = defaultdict(set), defaultdict(set)
    for m, x1, x2, y1, y2 in data:
        if m is None:
            continue
        xs[m] |= {x1, x2}
        ys[m] |= {y1, y2}
    return sorted(((m, x, y) for m in xs for x, y in itertools.product(xs[m], ys[m])), key=repr)


def brute_positional(data):
    out = set()
    for m, x1, x2, y1, y2 in data:
        for x, y in ((x1, y1), (x2, y2)):
            if x is not None or y is not None:
                out.add((m, x, y))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None)
@given(st.lists(ROW, max_size=25), st.integers(1, 4))
def test_unpivot_layouts_match_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    cross = sorted((tuple(r) for r in unpivot_cross(df, "m", GROUPS).collect()), key=repr)
    assert cross == brute_cross(data)
    pos = sorted((tuple(r) for r in unpivot_positional(df, "m", GROUPS).collect()), key=repr)
    assert pos == brute_positional(data)
