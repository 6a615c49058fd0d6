"""Main text of web pages: page structure first, then what a host repeats.

A page is cut into blocks; blocks inside page furniture (menus, footers, forms, scripts, elements named as adverts
or comments and the like) are left out, and where a page marks its article only that is kept. What remains of a
host's pages is concatenated as token streams, a few dozen pages at a time, and a suffix array finds the runs of at
least RUN tokens that distinct pages share. Runs on half of a host's pages or more (on small hosts: on four, or on all
of fewer) are its boilerplate and are removed where they cover them, unless all these pages have one and the same
text; unique runs stay. A block of fewer than RUN tokens is one run of its own length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.session import cut_lineage

#: Tokens of a repeated run at least, pages of one suffix array, share of a host's pages that makes boilerplate. Smaller hosts
#: than LEAST_PAGES need as many pages as one of LEAST_PAGES, or all they have.
RUN, GROUP_PAGES, SHARE, LEAST_PAGES = 8, 64, 0.5, 8
#: Hosts up to which the table of hosts (one narrow row each) is broadcast; more are joined by shuffle.
BROADCAST_HOSTS = 20_000
BREAK = "\n\n"
# Elements that never hold article text, elements that end a block, words that name furniture.
FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "select", "iframe", "noscript", "template", "svg", "canvas", "object", "menu", "dialog", "head", "title"}
RAW = {"script", "style", "textarea"}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6",
    "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    r"notice|pagination|popup|promo|promoted|related|replies|reply|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
PART = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")


def page_blocks(page: str) -> list[str]:
    """Text blocks of the article in page order: of every article or main element, else of the whole body."""
    blocks: list[tuple[str, bool]] = []
    words: list[str] = []
    skipped: list[str] = []  # open elements from the first furniture on
    inside = 0
    at = 0

    def close() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(words))).strip()
        if text:
            blocks.append((text, inside > 0))
        words.clear()

    while at < len(page):
        m = PART.search(page, at)
        if not m:
            if not skipped:
                words.append(page[at:])
            break
        if not skipped:
            words.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, ending, rest = m[2].lower(), bool(m[1]), m[3]
        if name in RAW:
            if not ending and not rest.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        landmark = name in ("article", "main")
        if landmark and not ending and skipped and inside == 0 and skipped[0] not in ("article", "main"):
            skipped = []  # furniture left open before the article
        if skipped:
            if ending and name in skipped:
                while skipped.pop() != name:
                    pass
                if name in BLOCK:
                    words.append(" ")
            elif ending and landmark and inside:
                skipped, inside = [], inside - 1
            elif not ending and name not in VOID and not rest.endswith("/") and (name == skipped[0] or name in ("div", "section", "ul", "ol", "table")):
                skipped.append(name)
            continue
        furniture = name in FURNITURE and not (name == "header" and inside)
        if not ending and not furniture and not landmark and name not in VOID and name not in ("body", "html") and rest:
            furniture = any(NAMED.search(a or b or c) for a, b, c in ATTRIBUTE.findall(rest)) or bool(HIDDEN.search(rest))
        if furniture and not ending and not rest.endswith("/"):
            close()
            skipped.append(name)
            continue
        if name == "br":
            words.append(" ")
        elif name in BLOCK or name in FURNITURE:
            close()
        if landmark:
            inside = max(0, inside + (-1 if ending else 1))
    close()
    marked = [t for t, own in blocks if own]
    return marked or [t for t, _ in blocks]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("html")
        text = [BREAK.join(page_blocks(h or "")) for h in batch.column(at).to_pylist()]
        rest = [n for n in batch.schema.names if n != "html"]
        yield pa.record_batch([*[batch.column(n) for n in rest], pa.array(text, pa.string())], names=[*rest, "text"])


def repeated_runs(streams: list[np.ndarray], owner: list[int], articles: np.ndarray, run: int = RUN) -> tuple[np.ndarray, ...]:
    """Fingerprints of the runs of ``run`` tokens on two or more pages, on how many, and the least and greatest text of these.

    From a suffix array. ``streams`` are the tokens of blocks, ``owner`` their pages, ``articles`` fingerprints of the
    pages' texts; no run crosses a block."""
    lengths = [len(s) for s in streams]
    tokens = np.concatenate([np.append(s, np.uint64(0)) for s in streams]) if streams else np.zeros(0, np.uint64)
    page = np.repeat(np.array(owner, int), [n + 1 for n in lengths])
    end = np.repeat(np.cumsum([n + 1 for n in lengths]) - 1, [n + 1 for n in lengths]) if streams else np.zeros(0, int)
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    depth = 1
    while depth < run:
        step = min(depth, run - depth)
        _, rank = np.unique(rank.astype(np.int64) * (n + 1) + rank[np.minimum(np.arange(n) + step, end)], return_inverse=True)
        depth += step
    usable = np.flatnonzero(np.arange(n) + run <= end)
    order = usable[np.lexsort((page[usable], rank[usable]))]  # the suffix array, as far as runs go
    if not len(order):
        return (np.zeros(0, np.int64),) * 4
    new = np.append(True, rank[order][1:] != rank[order][:-1])
    fresh = new | np.append(True, page[order][1:] != page[order][:-1])
    edge = np.flatnonzero(new)
    pages = np.add.reduceat(fresh.astype(np.int64), edge)
    some = pages > 1
    text = articles[page[order]]
    return run_prints(tokens, order[edge[some]], run), pages[some], np.minimum.reduceat(text, edge)[some], np.maximum.reduceat(text, edge)[some]


def run_prints(tokens: np.ndarray, starts: np.ndarray, run: int = RUN) -> np.ndarray:
    raw = tokens.tobytes()
    return np.array([xxhash.xxh3_64_intdigest(raw[8 * s : 8 * (s + run)]) for s in starts.tolist()], np.uint64).view(np.int64)


def repeated_blocks(streams: list[np.ndarray], owner: list[int], articles: np.ndarray, run: int = RUN) -> tuple[np.ndarray, ...]:
    """As ``repeated_runs``, of whole blocks of fewer than ``run`` tokens; each is a run of its own length."""
    short = [i for i, s in enumerate(streams) if 0 < len(s) < run]
    cells = np.unique(np.array([(block_print(streams[i]), owner[i]) for i in short], np.int64).reshape(-1, 2), axis=0)
    if not len(cells):
        return (np.zeros(0, np.int64),) * 4
    edge = np.flatnonzero(np.append(True, cells[1:, 0] != cells[:-1, 0]))
    pages, text = np.diff(np.append(edge, len(cells))), articles[cells[:, 1]]
    some = pages > 1
    return cells[edge, 0][some], pages[some], np.minimum.reduceat(text, edge)[some], np.maximum.reduceat(text, edge)[some]


def block_print(tokens: np.ndarray) -> int:
    return int(run_prints(tokens, np.zeros(1, int), len(tokens))[0])


def _stream(text: str) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) | 1 for w in text.split()], np.uint64)


def _runs(table: pa.Table) -> pa.Table:
    # Hosts of one page, and pages without a host, are left out here and not before, so that all uses share one exchange.
    lone = not len(table) or table.column("host")[0].as_py() == "" or table.column("total")[0].as_py() < 2
    table = table.slice(0, 0) if lone else table
    pages, texts = table.num_rows, table.column("text").to_pylist()
    blocks = [(i, b) for i, t in enumerate(texts) for b in t.split(BREAK)]
    articles = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
    streams, owner = [_stream(b) for _, b in blocks], [i for i, _ in blocks]
    found = zip(repeated_runs(streams, owner, articles), repeated_blocks(streams, owner, articles))
    prints, n, low, high = (np.concatenate(x) for x in found)
    often = n >= max(2, SHARE / 2 * pages)
    host = table.column("host")[0].as_py() if pages else ""
    columns = {"run": prints, "pages": n, "low": low, "high": high}
    return pa.table({"host": pa.array([host] * int(often.sum()), pa.string())} | {k: pa.array(v[often], pa.int64()) for k, v in columns.items()})


def without_runs(text: str, runs: set[int], run: int = RUN) -> str:
    """Blocks without the tokens that the runs cover; blocks with nothing left, and short ones that are a run, go."""
    known, out = np.array(sorted(runs), np.int64), []
    for block in text.split(BREAK):
        tokens = _stream(block)
        if 0 < len(tokens) < run and block_print(tokens) in runs:
            continue
        starts = np.arange(max(0, len(tokens) - run + 1))
        hit = starts[np.isin(run_prints(tokens, starts, run), known)]
        step = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + run, -1)
        gone = (np.cumsum(step[:-1]) > 0).tolist()
        kept = [w for w, g in zip(block.split(), gone) if not g]
        if kept:
            out.append(block if len(kept) == len(gone) else " ".join(kept))
    return BREAK.join(out)


def _cleaned(table: pa.Table, bad: pa.Table) -> pa.Table:
    runs = set(bad.column("run").to_pylist()) if len(bad) else set()
    text = table.column("text").to_pylist()
    text = [without_runs(t, runs) for t in text] if runs else text
    return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(text, pa.string()), "n_chars": pa.array([len(t) for t in text], pa.int64())})


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of ``pages``.

    Blocks are joined by two line feeds; white space inside a block is one space. A null or empty html gives an empty
    text. A run counts as boilerplate when SHARE of its host's pages have it, and no fewer than SHARE * LEAST_PAGES or, on
    hosts of fewer pages, all of them; two of these pages must have different texts, so an article that a few pages, or
    all, repeat whole stays. Pages alone on their host or without a host in the url are only read by structure. Rows that repeat a
    page_id are pages each. An empty table gives an empty result; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("total")).withColumn("parts", F.ceil(F.col("total") / GROUP_PAGES).cast("int"))
    sizes = cut_lineage(sizes)
    side = F.broadcast(sizes) if sizes.count() <= BROADCAST_HOSTS else sizes
    rows = rows.join(side, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), "parts").cast("int"))
    parsed = rows.select("page_id", "url", "host", "part", "total", "html").mapInArrow(_parsed, "page_id bigint, url string, host string, part int, total bigint, text string")
    shared = parsed.groupBy("host", "part").applyInArrow(_runs, "host string, run bigint, pages bigint, low bigint, high bigint")
    bad = shared.groupBy("host", "run").agg(F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high")).join(side, "host")
    least = F.greatest(SHARE * F.col("total"), F.least(F.lit(SHARE * LEAST_PAGES), F.col("total")))
    bad = bad.where((F.col("pages") >= least) & (F.col("low") < F.col("high")))
    bad = bad.select("host", "run", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    cells = parsed.groupBy("host", "part").cogroup(bad.groupBy("host", "part"))
    return cells.applyInArrow(_cleaned, "page_id bigint, url string, text string, n_chars bigint")
