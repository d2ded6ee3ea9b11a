"""Generated inputs: dense keys and merges against brute-force Python results."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattage.operators.keys import dense_key
from wattage.operators.upsert import dedupe_batch, upsert

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 50), st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))),
    min_size=0,
    max_size=60,
)


@SETTINGS
@given(rows, st.integers(1, 5))
def test_dense_key_matches_sorted_position(spark, data, parts):
    data = [(a, b, i, v) for i, (a, b, v) in enumerate(data)]
    df = spark.createDataFrame(data, "a int, b int, i int, v double")
    got = {r.i: r.k for r in dense_key(df, ["a", "b", "i"], "k", partitions=parts).collect()}
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))  # NULLs first
    assert got == {r[2]: pos + 1 for pos, r in enumerate(order)}


keyed = st.lists(st.tuples(st.integers(0, 8), st.floats(-3, 3, allow_nan=False)), max_size=25)


@SETTINGS
@given(keyed, keyed)
def test_upsert_matches_dict_merge(spark, target, batch):
    target = list({k: (k, v) for k, v in target}.values())
    t = spark.createDataFrame(target, "k int, v double") if target else spark.createDataFrame([], "k int, v double")
    b_rows = [(k, v, i) for i, (k, v) in enumerate(batch)]
    b = spark.createDataFrame(b_rows, "k int, v double, seq int") if b_rows else spark.createDataFrame([], "k int, v double, seq int")
    b = dedupe_batch(b, ["k"], ["seq"]).drop("seq")
    merged = {r.k: r.v for r in upsert(t, b, ["k"], ["v"]).collect()}
    want = dict(target)
    latest = {}
    for k, v, i in b_rows:
        latest[k] = v  # the last row of a key wins (largest seq)
    want.update(latest)
    assert merged == want


readings = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "cold"]), st.integers(0, 30), st.sampled_from(["D", "DF", "NG", "TI"])),
    max_size=80,
    unique=True,
)


@SETTINGS
@given(readings, st.integers(1, 40))
def test_newest_per_region_matches_brute_force(spark, data, n):
    import datetime as dt

    from wattage.sources.pages import newest_per_region

    rows = [(r, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), t) for r, h, t in data]
    df = spark.createDataFrame(rows, "respondent string, period_date timestamp_ntz, data_type string") if rows else spark.createDataFrame([], "respondent string, period_date timestamp_ntz, data_type string")
    got = sorted(tuple(r) for r in newest_per_region(df, n=n).collect())
    want = []
    for region in {r for r, _, _ in rows}:
        mine = sorted((x for x in rows if x[0] == region), key=lambda x: (x[1], x[2]), reverse=True)
        want += mine[:n]
    assert got == sorted(want)


snapshot = st.dictionaries(st.sampled_from(list("ABCDEF")), st.sampled_from(["x", "y", "z"]), max_size=6)


@SETTINGS
@given(snapshot, snapshot)
def test_scd2_matches_brute_force(spark, first, second):
    import datetime as dt

    from wattage.operators.history import scd2

    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    schema = "respondent string, respondent_name string, created_at timestamp_ntz"
    a = spark.createDataFrame([(k, v, t1) for k, v in first.items()], schema)
    b = spark.createDataFrame([(k, v, t2) for k, v in second.items()], schema)
    got = [tuple(r) for r in scd2(scd2(None, a, "respondent", as_of=t1), b, "respondent", as_of=t2).collect()]
    want = []
    for k, v in first.items():
        if k in second and second[k] != v:
            want.append((k, v, t1, t1, t2, False))
        else:  # unchanged, or missing from the second snapshot: stays open
            want.append((k, v, t1, t1, None, True))
    for k, v in second.items():
        if k not in first or first[k] != v:
            want.append((k, v, t2, t2, None, True))
    assert sorted(got, key=str) == sorted(want, key=str)
