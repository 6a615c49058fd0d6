"""Search, archives and mixing against SQL, embedding links against all pairs, page text and the chain on small cases."""

import duckdb
import numpy as np
import pytest

from wattframe.llm import queries as q
from wattframe.llm.embed_dedup import embedding_dedup
from wattframe.llm.main_text import main_text, page_blocks
from wattframe.llm.mixing import mix_sources
from wattframe.llm.topk import topk_search
from wattframe.llm.toxicity import Examples, best_threshold, fit_logistic, score_toxicity
from wattframe.llm.warc import MAGIC, archived_pages, candidates, reachable

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = q.queries()[name](spark, SF)
    want = con.execute(q.oracle_sql()[name]).fetchall()
    order = [d[0] for d in con.execute(q.oracle_sql()[name] + " LIMIT 0").description]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r) for r in df.select(*order).collect()), key=key) == sorted(want, key=key)


def test_embedding_links(spark):
    draw = np.random.default_rng(3)
    v = draw.standard_normal((150, 16))
    v[50:120] = v[draw.integers(0, 10, 70)] + draw.standard_normal((70, 16)) * 0.15
    v[120:140] = v[5]
    rows = [(i, x.tolist(), int(i % 7 == 0)) for i, x in enumerate(v)]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, v[5].tolist(), None), (504, [None] * 16, 1), (None, v[5].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(df).collect()}
    fit = [(i, np.array(x), lab) for i, x, lab in rows if x is not None and lab is not None and None not in x and np.isfinite(x).all() and any(x)]
    link = {i: set() for i, _, _ in fit}
    for a, x, m in fit:
        for b, y, n in fit:
            if a != b and m == n and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                link[a].add(b)
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for b in link.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min((x for x in seen if x is not None), default=None)
        assert got[i] == (len(link.get(i, ())), least, i == least)
    assert embedding_dedup(df.limit(0)).collect() == []


def test_search_leaves_out_broken_vectors(spark):
    rows = [(0, [1.0, 0.5], 9), (1, None, 9), (2, [float("inf"), 1.0], 9), (3, [1.0, 1.0], 9), (4, [1.0, 1.0], 9), (None, [9.0, 9.0], 9), (5, [1.0], 9)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")
    got = [(r.query_id, r["rank"], r.vec_id) for r in topk_search(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 4)]
    assert topk_search(df.limit(0), df).collect() == []


def test_magic_in_payloads(spark):
    trap = "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3
    rows = [(1, "http://a/", trap), (2, None, None), (3, "http://b/\n", "x" * 1500), (4, "http://c/", "x" * 1500), (5, "u", "é" + trap + "y" * 1000), (6, "u", "é" + trap + "y" * 1000), (None, "u", "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in archived_pages(df).collect()}
    n = len(("é" + trap + "y" * 1000).encode())
    assert got == {
        1: (len(trap), "response", None), 2: (0, "response", None), 3: (1500, "revisit", 4), 4: (1500, "response", None),
        5: (n, "revisit", 6), 6: (n, "response", None), None: (1, "response", None),
    }
    assert archived_pages(df.limit(0)).collect() == []
    one = MAGIC + b"Content-Length: 40\r\n\r\n" + (MAGIC + b"Content-Length: 0\r\n\r\n\r\n\r\n").ljust(40) + b"\r\n\r\n"
    offset, after, _ = candidates(one * 2)
    assert offset[reachable(offset, after)].tolist() == [0, len(one)]


def test_mixing_cases(spark):
    rows = [(1, None, "a"), (2, " ", "a"), (3, "w " * 10, None), (3, "w " * 10, None), (None, "w", "b"), (4, "w " * 50, "c")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, size int")
    got = mix_sources(df).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r["size"] for r in got)
    assert mix_sources(df.limit(0)).collect() == []


def test_mixing_without_ids_comes_near_its_target(spark):
    draw = np.random.default_rng(8)
    rows = [(None if i % 3 == 0 else int(i), "w " * int(draw.integers(1, 60)) + f"x{i}", "ab"[i % 2]) for i in range(3000)]
    rows += [(None, "one and the same text", "a")] * 900 + [(7, "again and again", "b")] * 500 + [(i, f"x{i} " * 9, "c") for i in range(50)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, size int").repartition(6)
    got = mix_sources(df).collect()
    sums, least = {}, {}
    for r in got:
        sums[r.source] = sums.get(r.source, 0) + r.taken
        least[r.source] = min(least.get(r.source, 10**9), r["size"])
        assert r.taken <= 2 * r["size"]
    for r in got:
        assert r.target - least[r.source] < sums[r.source] <= r.target
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    order = ["doc_id", "size", "source_size", "target", "taken"]
    want = con.execute(f"select {', '.join(order)} from ({q.oracle_sql()['op10_mixing']})").fetchall()
    assert sorted((tuple(r[c] for c in order) for r in got), key=str) == sorted(want, key=str)


def test_page_structure(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><li>menu<div class='ad'>x</div></nav><div id=cookie-notice>ok</div><article><h1>A &amp; B</h1>"
        "<p>one\n two<br>three<p>four <script>var a='</p>'</script><b>five</b><div class=comments><p>nice</div><p>six</article><footer>f</footer>"
    )
    assert page_blocks(page) == ["A & B", "one two three", "four five", "six"]
    rows = [(i, f"http://h/{i}", f"<p>Alpha beta {i} gamma</p><p>one two three four five six seven eight nine</p>") for i in range(20)] + [(99, None, None)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[99] == "" and all(got[i] == f"Alpha beta {i} gamma" for i in range(20))


def test_chain(spark):
    docs = [(i, f"plain words number{i % 9} {'stinker ' if i % 3 == 0 else ''}{'junk' if i % 4 == 0 else ''}", 0.5) for i in range(240)] + [(None, None, 0.0), (999, "", 0.0)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, p_bad double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), int(i % 3 == 0)) for i in range(200)] + [(5, None, 1), (7777, 1, 1)], "doc_id bigint, low int, bad int")
    got = score_toxicity(df, labels, ["low", "bad"]).collect()
    assert len(got) == len(docs) and all(r.rejected == (r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0) for r in got)
    assert not any(r.rejected for r in score_toxicity(df, labels.limit(0), ["low", "bad"]).collect())


def test_weighted_rows_fit_like_repeated_rows():
    draw = np.random.default_rng(5)
    at = [np.flatnonzero(draw.random(6) < 0.4) for _ in range(60)]
    labels = np.array([float((0 in a) ^ (draw.random() < 0.1)) for a in at])
    weights = draw.integers(1, 4, 60)
    again = np.repeat(np.arange(60), weights)
    earlier = draw.random((60, 1))
    whole = fit_logistic(Examples(at, earlier, labels, weights.astype(float), 6))
    repeated = fit_logistic(Examples([at[i] for i in again], earlier[again], labels[again], np.ones(len(again)), 6))
    assert np.allclose(whole, repeated, atol=1e-3)
    scores = draw.random(60).round(1)
    assert best_threshold(scores, labels, weights.astype(float)) == best_threshold(scores[again], labels[again], np.ones(len(again)))
    # At the optimum the penalised slope vanishes.
    x = np.zeros((60, 8))
    x[:, 0], x[:, 7] = 1, earlier[:, 0]
    for i, a in enumerate(at):
        x[i, 1 + a] = 1
    slope = x.T @ (weights / weights.sum() * (1 / (1 + np.exp(-x @ whole)) - labels)) + np.append(0, 1e-4 * whole[1:])
    assert np.abs(slope).max() < 1e-3
