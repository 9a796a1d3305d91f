"""Random wide lines: region fan-out vs a plain-Python model of the row split."""
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sigshape.conf import RegionSplitConf
from sigshape.operators.explode import region_fanout
from test_split_props import csv_model, java_split_limit0
from conftest import records

TOKEN = st.text(st.sampled_from(list("ab1;")), max_size=3)
CONF = RegionSplitConf(topic_in="IN", topic_out="OUT")


def _cell(elems, trailing):
    return "|".join(elems) + "|" * trailing


@st.composite
def wide_line(draw):
    f = [draw(TOKEN) for _ in range(34 + draw(st.integers(0, 2)))]
    n_in, n_out = draw(st.integers(0, 4)), draw(st.integers(0, 4))
    def lst(n, extra):
        return [draw(TOKEN.filter(lambda t: t != "")) for _ in range(n + extra)]
    f[9] = _cell(lst(n_in, 0), draw(st.integers(0, 2)))
    for i in (28, 29):
        f[i] = _cell(lst(n_in, draw(st.integers(0, 2))), draw(st.integers(0, 2)))
    f[30] = _cell(lst(n_out, 0), draw(st.integers(0, 2)))
    for i in (31, 32, 33):
        f[i] = _cell(lst(n_out, draw(st.integers(0, 2))), draw(st.integers(0, 2)))
    return ",".join(f)


def model(line):
    """The reference's per-line algorithm, in order."""
    a = csv_model(line)
    out = []
    regions, t_in, flag = (java_split_limit0(a[i], "|") for i in (9, 28, 29))
    for i in range(len(regions)):
        row = [a[0], regions[i], a[1], *a[10:18], t_in[i], flag[i]]
        out.append(("IN", a[0], ",".join(row)))
    regions, d_in, d_out, stay = (java_split_limit0(a[i], "|") for i in (30, 31, 32, 33))
    for i in range(len(regions)):
        row = [a[0], regions[i], a[1], d_in[i], d_out[i], stay[i], a[24], a[25]]
        out.append(("OUT", a[0], ",".join(row)))
    return out


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(wide_line(), min_size=1, max_size=25))
def test_fanout_matches_model(spark, lines):
    expected, invalid = {}, []
    for i, line in enumerate(lines):
        try:
            expected[i] = model(line)
        except IndexError:                    # the reference indexes past a short companion
            invalid.append(line)
    df = records(spark, [(i, lines[i]) for i in expected])
    got_by_line = {}
    for off, topic, key, value in region_fanout(df, CONF, keep=("offset",)).collect():
        got_by_line.setdefault(off, []).append((topic, key, value))
    for i, want in expected.items():
        assert got_by_line.get(i, []) == want     # same messages, same order per line
    if invalid:
        with pytest.raises(Exception, match="shorter than driver"):
            region_fanout(records(spark, [(0, invalid[0])]), CONF).collect()


LISTS = st.lists(st.tuples(st.lists(TOKEN, max_size=4), st.lists(TOKEN, max_size=5),
                           st.lists(TOKEN, max_size=5)), min_size=1, max_size=20)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(LISTS)
def test_parallel_explode_matches_model(spark, rows):
    from sigshape.operators.explode import parallel_explode
    df = spark.createDataFrame([(i, d, a, b) for i, (d, a, b) in enumerate(rows)],
                               "id int, d array<string>, a array<string>, b array<string>")
    good, bad = parallel_explode(df, "d", {"a": "a", "b": "b"}, keep=("id",), on_short="quarantine")
    want_good, want_bad = [], []
    for i, (d, a, b) in enumerate(rows):
        if len(a) < len(d) or len(b) < len(d):
            want_bad.append(i)
            continue
        want_good += [(i, k, d[k], a[k], b[k]) for k in range(len(d))]
    assert sorted(map(tuple, good.collect())) == sorted(want_good)
    assert sorted(r.id for r in bad.collect()) == sorted(want_bad)
    ok_rows = [(i, d, a, b) for i, (d, a, b) in enumerate(rows) if i not in set(want_bad)]
    if ok_rows:
        ok_df = spark.createDataFrame(ok_rows, "id int, d array<string>, a array<string>, b array<string>")
        strict = parallel_explode(ok_df, "d", {"a": "a", "b": "b"}, keep=("id",))
        assert sorted(map(tuple, strict.collect())) == sorted(want_good)
