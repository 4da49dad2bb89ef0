"""The click account-id parse against an independent statement of its rules."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from racestream.operators.clicks import parse_clicks
from racestream.schemas import CLICK_SCHEMA
from tests.test_clicks import T0

KEY = "user.accountId"
INT_MIN, INT_MAX = -2 ** 31, 2 ** 31 - 1


def expected(doc: dict):
    """A number in int32 range, truncated toward zero; anything else gives None."""
    v = doc.get(KEY)
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return None
    if isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
        return None
    if not (INT_MIN <= v <= INT_MAX):
        return None
    return int(v)


values = st.one_of(
    st.integers(min_value=-2 ** 40, max_value=2 ** 40),
    st.floats(min_value=-3e9, max_value=3e9, allow_nan=False, allow_infinity=False),
    st.sampled_from([INT_MIN, INT_MAX, INT_MIN - 1, INT_MAX + 1, 2147483647.5, -2147483648.5, -0.5, 0.999]),
    st.text(max_size=5), st.booleans(), st.none(),
    st.dictionaries(st.sampled_from(["accountId", "x"]), st.integers(), max_size=2),
)
docs = st.dictionaries(st.sampled_from([KEY, "user.ip", "page", "user"]), values, max_size=4)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(docs, min_size=1, max_size=40))
def test_account_id_rules(spark, batch):
    rows = [(json.dumps(d), T0, i) for i, d in enumerate(batch)]
    got = {r.seq: r.account_id for r in parse_clicks(spark.createDataFrame(rows, CLICK_SCHEMA)).collect()}
    for i, d in enumerate(batch):
        assert got[i] == expected(d), rows[i][0]
