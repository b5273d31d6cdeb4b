"""Operators against plain Python on generated rows."""

import random
from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions.dates import intervals, parse_utc
from lakemart.operators.latest import latest
from lakemart.operators.quality import missing_keys
from lakemart.operators.upsert import merged

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEY = st.one_of(st.none(), st.integers(0, 4))
ROW = st.tuples(KEY, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9))
ROWS = st.lists(ROW, max_size=25)
DDL = "k int, t int, v int"


def newest(values):
    """Null before every number, so that it is never the newest beside one."""
    return max(values, key=lambda r: (-1 if r[1] is None else r[1], r[2]))


def by_key(data):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    return groups


@FEW
@given(ROWS)
def test_latest(spark, rows, data):
    df = spark.createDataFrame(data, DDL)
    groups = by_key(data).values()
    one = sorted((newest(group) for group in groups), key=repr)
    assert rows(latest(df, ["k"], ["t"])) == one
    ties = [row for group in groups for row in group if row[1] == newest(group)[1]]
    assert rows(latest(df, ["k"], ["t"], ties="all")) == sorted(ties, key=repr)


@FEW
@given(ROWS, ROWS)
def test_merged_and_missing_keys(spark, rows, target, source):
    source = [newest(group) for group in by_key(source).values()]
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    replaced = {row[0] for row in source}
    expected = [row for row in target if row[0] not in replaced] + source
    once = merged(t, s, ["k"])
    assert rows(once) == sorted(expected, key=repr)
    assert rows(merged(once, s, ["k"])) == rows(once)
    lacking = replaced - {row[0] for row in target}
    assert rows(missing_keys(s, t, ["k"])) == sorted(((k,) for k in lacking), key=repr)


@given(
    st.datetimes(datetime(2000, 1, 1), datetime(2003, 1, 1)),
    st.timedeltas(timedelta(hours=1), timedelta(days=900)),
    st.sampled_from(["year", "month", "day", timedelta(days=11)]),
)
def test_intervals_cover_the_span_without_gaps(start, length, step):
    pairs = list(intervals(start, start + length, step))
    assert pairs[0][0] == start and pairs[-1][1] == start + length
    assert all(a < b for a, b in pairs)
    assert all(left[1] == right[0] for left, right in zip(pairs, pairs[1:]))


def test_parse_utc_on_many_offsets(spark, conf):
    conf(spark__sql__session__timeZone="America/Sao_Paulo")
    random.seed(7)
    cases = {}
    for _ in range(600):
        at = datetime(1990, 1, 1) + timedelta(seconds=random.randrange(40 * 365 * 86400))
        zone = timezone(timedelta(minutes=random.randrange(-14 * 60, 14 * 60 + 1)))
        text = at.replace(tzinfo=zone).isoformat(sep=random.choice(" T"))
        cases[text] = at - zone.utcoffset(None)
        cases[at.isoformat() + random.choice(["", "Z", " UTC"])] = at
    df = spark.createDataFrame([(text,) for text in cases], "text string")
    assert dict(df.select("text", parse_utc(F.col("text"))).collect()) == cases
