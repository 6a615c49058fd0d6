"""Nested payloads, web tables and spreadsheet grids to rows, in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.functions.scalars import nullify, sentinel_to_null
from wattframe.operators.windows import fill_down

MISSING = -9999.0


def flatten_payload(df: DataFrame, json_col: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Weather payload {metadata: {...}, forecasts: [{fcst_valid: epoch seconds, ...}]} to one row per
    forecast. Payloads without forecasts (errors) give no rows; -9999 becomes null."""
    inner = ", ".join(f"{n}: {t}" for n, t in fields.items())
    schema = (
        "struct<metadata: struct<latitude: double, longitude: double, status_code: int>,"
        f" forecasts: array<struct<fcst_valid: bigint, {inner}>>>"
    )
    parsed = df.select(*keep, F.from_json(json_col, schema).alias("_p"))
    rows = parsed.select(
        *keep,
        F.col("_p.metadata.latitude").alias("latitude"),
        F.col("_p.metadata.longitude").alias("longitude"),
        F.explode("_p.forecasts").alias("_f"),
    )
    numeric = {"double", "float", "int", "bigint"}
    return rows.select(
        *keep,
        "latitude",
        "longitude",
        F.timestamp_seconds("_f.fcst_valid").alias("datetime_gmt"),
        *[
            (sentinel_to_null(F.col(f"_f.{n}"), MISSING) if t in numeric else F.col(f"_f.{n}")).alias(n)
            for n, t in fields.items()
        ],
    )


#: Tables still open: number, row, cell, place of the open cell among the cells so far (-1: none is open).
_OPEN = "array<struct<t:int,r:int,c:int,at:int>>"
_CELLS = "array<struct<table_no:int,row_no:int,col_no:int,cell:string>>"


def _table_cells(html: Column) -> Column:
    """Cells of all tables of a page, from one fold over its table, row and cell tags with a stack of open tables."""
    clean = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)", "")
    parts = F.split(clean, r"(?i)(?=</?(?:table|tr|td|th)\b)")
    entry = lambda t, r, c, at: F.struct(t.cast("int").alias("t"), r.cast("int").alias("r"), c.cast("int").alias("c"), at.cast("int").alias("at"))
    start = F.struct(F.lit(0).alias("tables"), F.array().cast(_OPEN).alias("open"), F.array().cast(_CELLS).alias("cells"))

    def step(acc: Column, part: Column) -> Column:
        tag = F.lower(F.regexp_extract(part, r"(?i)^<(/?(?:table|tr|td|th))\b", 1))
        text = F.regexp_replace(part, r"(?i)^</?(?:table|tr|td|th)\b[^>]*>?", "")
        held, cells = acc["open"], acc["cells"]
        depth = F.size(held)
        inside = depth > 0
        under = F.slice(held, F.lit(1), F.greatest(depth - 1, F.lit(0)))
        top = F.element_at(held, -1)
        none = F.lit(-1)
        opens = inside & tag.isin("td", "th")
        row = F.greatest(top["r"], F.lit(0))  # a cell before any row tag begins the first row
        next_open = (
            F.when(tag == "table", F.concat(held, F.array(entry(acc["tables"], none, none, none))))
            .when(inside & (tag == "/table"), under)
            .when(inside & (tag == "tr"), F.concat(under, F.array(entry(top["t"], top["r"] + 1, none, none))))
            .when(opens, F.concat(under, F.array(entry(top["t"], row, top["c"] + 1, F.size(cells)))))
            .when(inside & tag.isin("/tr", "/td", "/th"), F.concat(under, F.array(entry(top["t"], top["r"], top["c"], none))))
            .otherwise(held)
        ).cast(_OPEN)
        new = F.struct(top["t"].alias("table_no"), row.cast("int").alias("row_no"), (top["c"] + 1).cast("int").alias("col_no"), text.alias("cell"))
        # What follows an inner table goes on with the outer cell.
        back = F.when((tag == "/table") & (depth > 1), F.element_at(held, -2)["at"]).otherwise(none)
        longer = F.transform(
            cells, lambda x, i: F.struct(x["table_no"].alias("table_no"), x["row_no"].alias("row_no"), x["col_no"].alias("col_no"), F.when(i == back, F.concat(x["cell"], F.lit(" "), text)).otherwise(x["cell"]).alias("cell"))
        )
        next_cells = F.when(opens, F.concat(cells, F.array(new))).when(back >= 0, longer).otherwise(cells).cast(_CELLS)
        return F.struct((acc["tables"] + (tag == "table").cast("int")).cast("int").alias("tables"), next_open.alias("open"), next_cells.alias("cells"))

    found = F.aggregate(parts, start, step, lambda acc: acc["cells"])
    return F.when(html.rlike(r"(?i)<table\b"), found)


def html_tables(df: DataFrame, html_col: str, keep: Sequence[str], missing: str = "NA") -> DataFrame:
    """Cells of every table of a page: (keep, table_no, row_no, col_no, cell); empty cells hold a token.

    Tables are numbered as they open. A cell belongs to the table and row it opens in; the text of a table inside it
    stands in that table's cells alone. Rows and cells end where the next begins, so end tags may be missing;
    tables that never end reach to the end of the page. A null page, or one without tables, has no cells.
    """
    cells = df.select(*keep, F.inline(_table_cells(F.col(html_col).cast("string"))))
    plain = F.trim(F.regexp_replace(F.regexp_replace("cell", r"<[^>]*>", ""), r"\s+", " "))
    plain = F.replace(F.replace(F.replace(plain, F.lit("&nbsp;"), F.lit(" ")), F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    plain = F.trim(F.replace(plain, F.lit("&amp;"), F.lit("&")))
    return cells.select(
        *keep, "table_no", "row_no", "col_no", F.when(plain == "", missing).otherwise(plain).alias("cell")
    )


def extract_anchored(cells: DataFrame, page: Sequence[str], position: str, anchors: Mapping[str, tuple[str, int]]) -> DataFrame:
    """One wide record per page: for each output name, the cell ``offset`` places after the label cell.

    ``position`` numbers the cells of a page without gaps. Labels point at positions and join there, so a
    page of any length is spread over tasks and never sorted.
    """
    wanted = F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(label).alias("l"), F.lit(k).alias("k")) for n, (label, k) in anchors.items()
    ])
    labels = (
        cells.filter(F.col("cell").isin([label for label, _ in anchors.values()]))
        .withColumn("_w", F.explode(wanted))
        .filter(F.col("_w.l") == F.col("cell"))
        .select(*page, (F.col(position) + F.col("_w.k")).alias(position), F.col("_w.n").alias("_name"))
    )
    found = labels.join(cells.select(*page, position, "cell"), [*page, position])
    return found.groupBy(*page).agg(*[F.max(F.when(F.col("_name") == n, F.col("cell"))).alias(n) for n in anchors])


def split_compound(df: DataFrame, name: str, value: str) -> DataFrame:
    """'A(I+II)' with 'x+y' becomes two rows A(I), A(II); plain names pass through."""
    stem = F.regexp_extract(name, r"^(.*?)\(", 1)
    members = F.split(F.regexp_extract(name, r"\(([^)]*)\)", 1), r"\+")
    compound = F.col(name).rlike(r"\([^)]*\+[^)]*\)")
    pairs = F.arrays_zip(members.alias("m"), F.split(F.col(value), r"\+").alias("v"))
    expanded = F.transform(
        pairs,
        lambda p: F.struct(
            F.concat(F.trim(stem), F.lit("("), F.trim(p["m"]), F.lit(")")).alias(name), F.trim(p["v"]).alias(value)
        ),
    )
    single = F.array(F.struct(F.trim(name).alias(name), F.trim(value).alias(value)))
    rest = [c for c in df.columns if c not in (name, value)]
    return df.select(*rest, F.inline(F.when(compound, expanded).otherwise(single)))


def promote_header(grid: DataFrame, sheet: Sequence[str], keyword: str, drop_last: int = 0) -> DataFrame:
    """Rows under the header row found by keyword, as (sheet, row_no, header, value).

    ``grid`` holds (sheet, row_no, cells). An empty header cell takes the text of the row above (a header
    in two rows), both texts are joined when both are set; the last ``drop_last`` columns are cut.
    """
    holds = F.exists("cells", lambda c: F.contains(F.lower(c), F.lit(keyword.lower())))
    found = grid.filter(holds).groupBy(*sheet).agg(F.min("row_no").alias("_h"), F.min_by("cells", "row_no").alias("_low"))
    # The header of a sheet is one row and the one above it, so it is joined, not windowed.
    above = grid.select(*sheet, (F.col("row_no") + 1).alias("_h"), F.col("cells").alias("_up"))
    header = found.join(above, [*sheet, "_h"], "left")
    merged = F.zip_with(
        F.coalesce("_up", F.array().cast("array<string>")),
        "_low",
        lambda u, low: F.concat_ws(" ", F.nullif(F.trim(u), F.lit("")), F.nullif(F.trim(low), F.lit(""))),
    )
    header = header.select(*sheet, "_h", merged.alias("_names"))
    width = F.greatest(F.lit(0), F.size("_names") - drop_last)
    body = grid.join(header, list(sheet)).filter(F.col("row_no") > F.col("_h"))
    pairs = F.slice(F.arrays_zip(F.col("_names").alias("header"), F.col("cells").alias("value")), F.lit(1), width)
    return body.select(*sheet, "row_no", F.inline(pairs))


def price_sheet(grid: DataFrame, sheet: Sequence[str], cell: str, exchange: str, first_row: int = 5) -> DataFrame:
    """Price rows of an exchange sheet: 96 rows from ``first_row`` become blocks 1..96, dashes become null."""
    block = (F.col("row_no") - first_row + 1).cast("int")
    return grid.filter(block.between(1, 96)).select(
        *sheet, block.alias("block_no"), nullify(F.col(cell), ("-", "--", "")).try_cast("double").alias("price"), F.lit(exchange).alias("exchange_name")
    )


def flatten_header(df: DataFrame, levels: Sequence[str], sep: str = "^", out: str = "header") -> DataFrame:
    """Several header levels joined into one text, empty levels left out."""
    return df.withColumn(out, F.concat_ws(sep, *[F.nullif(F.trim(c), F.lit("")) for c in levels]))


# Text in a header and the drawl type it stands for, last match wins.
DRAWL_TYPES = {
    "BILAT": "BILATERAL",
    "PXI": "PXIL",
    "IEX": "IEX",
    "MTOA": "LTOA_MTOA",
    "REGULATED": "REGULATION",
}


def classify_header(header: Column, default: str = "ISGS") -> Column:
    from wattframe.functions.scalars import classify_contains

    return classify_contains(F.upper(header), dict(reversed(DRAWL_TYPES.items())), default)


def fill_down_header(grid: DataFrame, sheet: Sequence[str], col: str) -> DataFrame:
    """Merged cells: a blank takes the value above it on the sheet."""
    filled = fill_down(grid, "row_no", [col], sheet)
    return filled.drop(col).withColumnRenamed(f"{col}_filled", col)
