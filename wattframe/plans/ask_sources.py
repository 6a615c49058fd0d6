"""Registered queries: scans and parsers.

Text inputs are rendered from the given tables by Spark and parsed back, so their volume follows the
tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.functions import scalars
from wattframe.plans.registry import query
from wattframe.sources import documents, tables


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


@query("table_scan", "l_orderkey:i l_linenumber:i l_quantity:f", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount > 0.05""")
def _(t):
    where = (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_discount") > 0.05)
    return tables.read_table(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"], where)


@query("csv_day_first", "order_key:i delivery:d price:g", "SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS delivery, round(o_totalprice, 2) AS price FROM orders")
def _(t):
    line = _text(F.col("o_orderkey").cast("string"), ",", F.date_format("o_orderdate", "dd-MM-yyyy"), ",", F.format_string("%.2f", "o_totalprice"))
    return tables.parse_csv(t.orders.select(line.alias("line")), "line", "order_key bigint, delivery date, price double")


@query("scada_lines", "event_id:i datetime:t reading:f", """
SELECT event_id, date_trunc('second', ts) AS datetime, value AS reading FROM events""")
def _(t):
    line = _text("  ", F.date_format("ts", "dd-MM-yyyy   HH:mm:ss"), "   ", F.col("event_id").cast("string"), " \t", F.col("value").cast("string"), " ")
    return tables.parse_scada(t.events.select(line.alias("line")), "line", ["event_id", "reading"])


@query("station_observations", "station:s rainfall:f temperature:f local_ts:t", """
SELECT CAST(event_id AS VARCHAR) AS station, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS rainfall,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 10 END AS temperature, date_trunc('minute', ts) + INTERVAL 330 MINUTE AS local_ts FROM events WHERE event_id % 11 <> 0""")
def _(t):
    k = F.col("event_id")
    full = _text(
        k.cast("string"), ";", F.date_format("ts", "yyyy-MM-dd"), ";", F.date_format("ts", "HH:mm"), ";",
        F.when(k % 3 == 0, "NA").otherwise(F.col("value").cast("string")), ";", F.when(k % 5 == 0, "----").otherwise((F.col("value") / 10).cast("string")),
    )
    lines = t.events.select(F.when(k % 11 == 0, "; ; ;;").otherwise(full).alias("line"))
    names = ["station", "obs_date", "time_utc", "rainfall", "temperature"]
    return tables.parse_station_obs(lines, "line", names)


@query("files_by_name", "file_name:s n:i total:g", "SELECT 'orders.parquet' AS file_name, count(*) AS n, sum(o_totalprice) AS total FROM orders")
def _(t):
    df = tables.read_many(t.spark, t.sf_dir, "o_orderkey bigint, o_totalprice double", prefix="ord", suffix=".parquet", fmt="parquet")
    return df.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("weather_payload", "event_id:i latitude:f datetime_gmt:t temp:f gust:f", """
SELECT event_id, 20.5 + user_id % 8 AS latitude, date_trunc('second', ts) + h * INTERVAL 1 HOUR AS datetime_gmt, value + h AS temp,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 2 END AS gust FROM events CROSS JOIN (SELECT unnest([0, 1]) AS h) WHERE event_type <> 'error'""")
def _(t):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    one = lambda h: _text(
        '{"fcst_valid": ', (seconds + 3600 * h).cast("string"), ', "temp": ', (F.col("value") + h).cast("string"), ', "gust": ',
        F.when(F.col("event_id") % 4 == 0, "-9999").otherwise((F.col("value") * 2).cast("string")), "}",
    )
    good = _text('{"metadata": {"latitude": ', (20.5 + F.col("user_id") % 8).cast("string"), ', "longitude": 75.0, "status_code": 200}, "forecasts": [', one(0), ", ", one(1), "]}")
    bad = F.lit('{"success": false, "errors": [{"code": "NDF-0001"}]}')
    payload = t.events.select("event_id", F.when(F.col("event_type") == "error", bad).otherwise(good).alias("payload"))
    return documents.flatten_payload(payload, "payload", {"temp": "double", "gust": "double"}, ["event_id"])


@query("event_properties", "event_id:i k:i", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.k")


@query("html_table_cells", "o_orderkey:i table_no:i row_no:i col_no:i cell:s", """
WITH c AS (SELECT o_orderkey, unnest([0, 0, 1, 1]) AS row_no, unnest([0, 1, 0, 1]) AS col_no, unnest(['Block', 'Price & tax', o_orderpriority,
 CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE CAST(o_custkey AS VARCHAR) END]) AS cell FROM orders)
SELECT o_orderkey, 0 AS table_no, row_no, col_no, cell FROM c""")
def _(t):
    html = _text(
        "<html><body><p>x</p><TABLE class='a'><tr><th>Block</th><th> Price &amp; <b>tax</b></th></tr>\n<tr><td align=left>", F.col("o_orderpriority"),
        "</td><td>", F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_custkey").cast("string")), "</td></tr></TABLE></body></html>",
    )
    return documents.html_tables(t.orders.select("o_orderkey", html.alias("html")), "html", ["o_orderkey"])


@query("page_table_cells", "page_id:i table_no:i row_no:i col_no:i cell:s", """
WITH c AS (SELECT page_id, unnest([0, 0, 0, 0, 1, 1, 1]) AS table_no, unnest([0, 0, 1, 1, 0, 0, 1]) AS row_no, unnest([0, 1, 0, 1, 0, 1, 0]) AS col_no,
 unnest(['Page', 'Address', CAST(page_id AS VARCHAR), url || ' tail', 'in ' || page_id, 'NA', CAST(length(html) AS VARCHAR)]) AS cell FROM pages)
SELECT page_id, table_no, row_no, col_no, cell FROM c""")
def _(t):
    # Each page with a table in front that holds a table, most end tags left out.
    html = _text(
        "<table border=1><tr><th>Page<th>Address<TR><td>", F.col("page_id").cast("string"), "<td>", F.col("url"), " <!-- <td> --><table><tr><td>in <b>", F.col("page_id").cast("string"),
        "</b></td><td> </td></tr><tr><td>", F.length("html").cast("string"), "</table> tail</table>", F.col("html"),
    )
    return documents.html_tables(t.pages.select("page_id", html.alias("html")), "html", ["page_id"])


@query("anchored_record", "o_orderkey:i demand:s frequency:s", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS demand, o_orderstatus AS frequency FROM orders""")
def _(t):
    cells = t.orders.select("o_orderkey", F.posexplode(F.array(F.lit("Demand"), F.lit("MW"), F.col("o_custkey").cast("string"), F.lit("Freq"), F.col("o_orderstatus"))).alias("pos", "cell"))
    return documents.extract_anchored(cells, ["o_orderkey"], "pos", {"demand": ("Demand", 2), "frequency": ("Freq", 1)})


@query("split_compound_cells", "s_suppkey:i unit:s reading:s", """
SELECT s_suppkey, 'UNIT(I)' AS unit, CAST(s_nationkey AS VARCHAR) AS reading FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, 'UNIT(II)', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, 'SOLO', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 2 = 1""")
def _(t):
    even = F.col("s_suppkey") % 2 == 0
    raw = t.supplier.select(
        "s_suppkey", F.when(even, "UNIT(I+II)").otherwise("SOLO").alias("unit"),
        F.when(even, _text(F.col("s_nationkey").cast("string"), "+", F.col("s_suppkey").cast("string"))).otherwise(F.col("s_suppkey").cast("string")).alias("reading"),
    )
    return documents.split_compound(raw, "unit", "reading")


@query("promoted_header", "sheet:i row_no:i header:s value:s", """
WITH b AS (SELECT l_orderkey AS sheet, l_linenumber + 2 AS row_no, CAST(max(l_quantity) AS INT) AS q, max(l_returnflag) AS f FROM lineitem GROUP BY 1, 2)
SELECT sheet, row_no, 'Plant Name' AS header, f AS value FROM b UNION ALL SELECT sheet, row_no, 'Gen MW', CAST(q AS VARCHAR) FROM b""")
def _(t):
    body = t.lineitem.groupBy(F.col("l_orderkey").alias("sheet"), (F.col("l_linenumber") + 2).alias("row_no")).agg(
        F.array(F.max("l_returnflag"), F.max("l_quantity").cast("int").cast("string"), F.lit("total")).alias("cells")
    )
    sheets = t.lineitem.select(F.col("l_orderkey").alias("sheet")).distinct()
    head = lambda n, *names: sheets.select("sheet", F.lit(n).alias("row_no"), F.array(*[F.lit(x) for x in names]).alias("cells"))
    grid = body.unionByName(head(0, "Report", "", "")).unionByName(head(1, "Plant", "Gen", "Sum")).unionByName(head(2, "Name", "MW", ""))
    return documents.promote_header(grid, ["sheet"], "name", drop_last=1)


@query("price_sheet", "date:d block_no:i price:g exchange_name:s", """
SELECT date, block_no, CASE WHEN value > 150 THEN NULL ELSE value END AS price, 'IEX' AS exchange_name FROM v_grid""")
def _(t):
    cell = F.when((F.col("value") > 150) | F.col("value").isNull(), F.when(F.col("block_no") % 2 == 0, "--").otherwise("-")).otherwise(F.col("value").cast("string"))
    grid = t.grid.select("date", (F.col("block_no") + 4).alias("row_no"), cell.alias("cell"))
    heads = t.grid.select("date").distinct().select("date", F.lit(1).alias("row_no"), F.lit("Price").alias("cell"))
    return documents.price_sheet(grid.unionByName(heads), ["date"], "cell", "IEX")


@query("flattened_headers", "o_orderkey:i header:s drawl_type:s", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'BILAT' WHEN o_orderpriority = '2-HIGH' THEN 'IEX' WHEN o_orderpriority = '3-MEDIUM' THEN 'MTOA' ELSE 'ISGS' END
 || '^' || o_orderstatus AS header, CASE o_orderpriority WHEN '1-URGENT' THEN 'BILATERAL' WHEN '2-HIGH' THEN 'IEX' WHEN '3-MEDIUM' THEN 'LTOA_MTOA' ELSE 'ISGS' END AS drawl_type FROM orders""")
def _(t):
    p = F.col("o_orderpriority")
    top = F.when(p == "1-URGENT", "BILAT").when(p == "2-HIGH", "IEX").when(p == "3-MEDIUM", "MTOA").otherwise("ISGS")
    flat = documents.flatten_header(t.orders.select("o_orderkey", top.alias("a"), F.lit(" ").alias("b"), F.col("o_orderstatus").alias("c")), ["a", "b", "c"])
    return flat.withColumn("drawl_type", documents.classify_header(F.col("header")))


@query("header_cells_filled", "sheet:i row_no:i label:s", """
WITH g AS (SELECT l_orderkey AS sheet, l_linenumber AS row_no, CASE WHEN max(l_quantity) > 25 THEN max(l_returnflag) ELSE ' ' END AS label FROM lineitem GROUP BY 1, 2)
SELECT sheet, row_no, last_value(nullif(trim(label), '') IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS label FROM g""")
def _(t):
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").alias("row_no")).agg(F.when(F.max("l_quantity") > 25, F.max("l_returnflag")).otherwise(" ").alias("label"))
    return documents.fill_down_header(g, ["sheet"], "label")


@query("dms_coordinates", "s_suppkey:i lat:f", """
SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE (CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END) * (s_nationkey + (s_suppkey % 60) / 60 + 30.5 / 3600) END AS lat FROM supplier""")
def _(t):
    k = F.col("s_suppkey")
    text = F.when(k % 7 == 0, "unknown").otherwise(
        _text(F.col("s_nationkey").cast("string"), "° ", (k % 60).cast("string"), "' 30.5\" ", F.when(k % 2 == 0, "N").otherwise("S"))
    )
    return t.supplier.select("s_suppkey", scalars.dms_to_decimal(text).alias("lat"))
