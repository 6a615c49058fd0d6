"""Nested and unclosed tables, and smoothing of whole series by pieces."""

import numpy as np

from wattframe.operators import repair
from wattframe.sources import documents


def cells(spark, html):
    df = spark.createDataFrame([(1, html, "x")], "page int, html string, cell string")
    return [tuple(r)[1:] for r in documents.html_tables(df, "html", ["page"]).orderBy("table_no", "row_no", "col_no").collect()]


def test_nested_tables(spark):
    html = "<p>a</p><table><tr><td>one<table id=x><tr><td>in</td><td></td></tr></table>two</td><td>three</td></tr><tr><th>four</th></tr></table><TABLE><tr><td>&amp; five</td></tr></TABLE>"
    assert cells(spark, html) == [
        (0, 0, 0, "one two"), (0, 0, 1, "three"), (0, 1, 0, "four"), (1, 0, 0, "in"), (1, 0, 1, "NA"), (2, 0, 0, "& five"),
    ]
    deep = "<table><tr><td>0" * 5 + "</table>" * 2
    assert [c[:2] for c in cells(spark, deep)] == [(t, 0) for t in range(5)]


def test_unclosed_and_odd_tables(spark):
    assert cells(spark, "<table><tr><td>a<td>b<tr><td>c") == [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "c")]
    assert cells(spark, "<td>lost</td></table><table><td>no row</td><tr><td>x<!-- <td>not</td> --></td></tr></table><tr><td>lost") == [(0, 0, 0, "no row"), (0, 1, 0, "x")]
    assert cells(spark, "<table><script>'<td>'</script><tr><td>s</td></tr>") == [(0, 0, 0, "s")]
    assert cells(spark, None) == [] and cells(spark, "") == [] and cells(spark, "<p>none</p>") == [] and cells(spark, "<table></table>") == []
    assert len(cells(spark, "<table>" + "<tr><td>1</td><td>2</td></tr>" * 500 + "</table>")) == 1000


def plain(values, target, tol, most=100):
    def mean5(v):
        out = np.full(len(v), np.nan)
        for i in range(2, len(v) - 2):
            out[i] = v[i - 2 : i + 3].mean()
        return out

    now, last = mean5(np.array(values, float)), None
    for _ in range(most):
        now = mean5(now)
        error = np.nanmean(np.abs(np.array(target) / now - 1))
        if last is not None and abs(last - error) <= tol:
            break
        last = error
    return now


def test_smoothing_over_pieces(spark):
    draw = np.random.default_rng(4)
    values = 50 + np.cumsum(draw.normal(0, 1, 700)) + draw.normal(0, 5, 700)
    target = values + draw.normal(0, 1, 700)
    rows = [(i // 96, i % 96, float(v), float(t)) for i, (v, t) in enumerate(zip(values, target))]
    df = spark.createDataFrame(rows, "day int, block int, v double, t double")
    for size in (64, 10_000):
        got = repair.smooth_until(df, [], ["day", "block"], "v", "t", tol=0.0005, size=size).orderBy("day", "block").toPandas()["smooth"]
        want = plain(values, target, 0.0005)
        assert np.allclose(got.to_numpy(float), want, equal_nan=True) and len(got) == 700
        edge = int(np.isnan(want).sum() // 2)
        assert got[edge:-edge].notna().all()
    short = df.where("day = 0 AND block < 4")
    assert repair.smooth_until(short, [], ["day", "block"], "v", "t").where("smooth IS NOT NULL").count() == 0
    assert repair.smooth_until(df.limit(0), [], ["day", "block"], "v", "t").count() == 0
