"""Boilerplate of small hosts."""

from wattframe.llm.main_text import main_text

SCHEMA = "page_id bigint, url string, html string"
NOTE = "all prices are shown without any tax and can change"


def texts(spark, rows):
    return {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_small_hosts(spark):
    article = lambda i: " ".join(f"word{i}x{k}" for k in range(12))
    rows, want = [], {}

    def add(url, parts, left):
        rows.append((len(rows), url, "".join(f"<p>{x}</p>" for x in parts)))
        want[len(rows) - 1] = "\n\n".join(left)

    for n in (2, 3, 5, 7, 8):  # what all pages of a host share goes, on small hosts as on others
        for i in range(n):
            add(f"http://h{n}/{i}", [article(i), NOTE], [article(i)])
    for i in range(7):  # what three of seven share stays, what four share goes
        add(f"http://some/{i}", [article(i), *[NOTE] * (i < 3), *[NOTE.upper()] * (i < 4)], [article(i), *[NOTE] * (i < 3)])
    for url in ("http://copies/1", "http://copies/2", "http://copies/3"):  # one article, told again
        add(url, [article(1), NOTE], [article(1), NOTE])
    for i in range(9):
        add(f"http://mirror/{i}", [article(1), NOTE], [article(1), NOTE])
    add("http://alone/1", [article(1), NOTE], [article(1), NOTE])
    for i in range(3):
        add(None, [article(i), NOTE], [article(i), NOTE])
    assert texts(spark, rows) == want


def test_short_blocks(spark):
    article = lambda i: " ".join(f"word{i}x{k}" for k in range(12))
    rows = [(i, f"http://h/{i}", f"<p>{article(i)}</p><p>Read more</p><p>Read more</p><div>Number {i}</div><p>{'Few' if i < 9 else 'Many'} words</p>") for i in range(20)]
    rows += [(20, "http://two/0", "<p>Read more</p><p>one</p>"), (21, "http://two/1", "<p>Read more</p><p>two</p>"), (22, "http://one/1", "<p>Read more</p>")]
    got = texts(spark, rows)
    assert all(got[i] == "\n\n".join([article(i), f"Number {i}", *["Few words"] * (i < 9)]) for i in range(20))
    assert (got[20], got[21], got[22]) == ("one", "two", "Read more")
