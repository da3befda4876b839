"""Property checks against small pure-Python models (Hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablekit.operators.joins import join_on
from tablekit.operators.upsert import update_matched, upsert

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_t = st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.text("ab", max_size=2))),
                  max_size=8, unique_by=lambda r: r[0])
rows_c = st.lists(st.tuples(st.integers(0, 14), st.one_of(st.none(), st.text("xy", max_size=2)),
                            st.integers(0, 3)), max_size=8)


def _model_upsert(target, changes, insert=True):
    # Largest (ver, v) wins; as in Spark's struct ordering NULL sorts lowest.
    def rank(v, ver):
        return (ver, v is not None, v or "")

    latest = {}
    for k, v, ver in changes:
        if k not in latest or rank(v, ver) > rank(*latest[k]):
            latest[k] = (v, ver)
    out = {k: v for k, v in target}
    for k, (v, _) in latest.items():
        if k in out or insert:
            out[k] = v
    return sorted(out.items(), key=repr)


@SETTINGS
@given(target=rows_t, changes=rows_c)
def test_upsert_matches_model(spark, target, changes):
    t = spark.createDataFrame(target, "k int, v string")
    c = spark.createDataFrame(changes, "k int, v string, ver int")
    got = sorted((tuple(r) for r in upsert(t, c, "k", order_by=["ver", "v"]).collect()), key=repr)
    assert got == _model_upsert(target, changes)
    got_u = sorted((tuple(r) for r in update_matched(t, c, "k", order_by=["ver", "v"]).collect()), key=repr)
    assert got_u == _model_upsert(target, changes, insert=False)


keys = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 99)), max_size=10)


@SETTINGS
@given(left=keys, right=keys)
def test_skew_safe_joins_match_plain(spark, left, right):
    l_df = spark.createDataFrame(left, "k int, a int")
    r_df = spark.createDataFrame(right, "rk int, b int")
    for how in ("left", "right", "full", "left_semi", "left_anti"):
        ours = sorted((tuple(r) for r in join_on(l_df, r_df, "k", "rk", how).collect()), key=repr)
        plain = sorted((tuple(r) for r in join_on(l_df, r_df, "k", "rk", how, skew_safe=False).collect()),
                       key=repr)
        assert ours == plain, how
