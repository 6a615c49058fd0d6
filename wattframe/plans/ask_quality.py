"""Registered queries: record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.operators import quality
from wattframe.plans.registry import query

FIELDS = ("order", "customer", "status", "price", "date")
PROBLEM = "code:s message:s row:i column:i field:s value:s"


def _problem_sql(where: str, code: int, name: str, column: int) -> str:
    message = quality.MESSAGES[code]
    return f"""SELECT '{code}' AS code, '{message}' AS message, row_no + 1 AS "row", {column} AS "column", '{name}' AS field, cells[{column}] AS value
FROM v_records WHERE cells[{column}] IS NOT NULL AND ({where})"""


def _record_sql(where: str, code: int, message: str | None = None) -> str:
    return f"""SELECT '{code}' AS code, '{message or quality.MESSAGES[code]}' AS message, row_no + 1 AS "row", NULL AS "column", NULL AS field, NULL AS value
FROM v_records WHERE {where}"""


def _rules() -> quality.Rules:
    return quality.Rules(FIELDS)


@query("value_type_checks", PROBLEM, _problem_sql("try_cast(trim(cells[2]) AS BIGINT) IS NULL", 1, "customer", 2))
def _(t):
    return _rules().value_check("customer", quality.castable("bigint")).validate(t.records)


UNREAD_SQL = """SELECT '0' AS code, 'Unexpected exception [ValueError]: cannot read the value as bigint' AS message, row_no + 1 AS "row", 2 AS "column", 'customer' AS field, cells[2] AS value
FROM v_records WHERE cells[2] IS NOT NULL AND try_cast(trim(cells[2]) AS BIGINT) IS NULL UNION ALL """


@query("unreadable_values", PROBLEM, UNREAD_SQL + _problem_sql("try_cast(trim(cells[2]) AS BIGINT) % 5 = 0", 4, "customer", 2))
def _(t):
    return _rules().value_predicate("customer", lambda c: c % 5 != 0, reads="bigint").validate(t.records)


@query("value_predicates", PROBLEM, _problem_sql("CAST(cells[4] AS DOUBLE) < 0", 4, "price", 4))
def _(t):
    return _rules().value_predicate("price", lambda c: c.try_cast("double") >= 0).validate(t.records)


@query("record_length_checks", PROBLEM, _record_sql("len(cells) <> 5", 3))
def _(t):
    return _rules().length_check().validate(t.records)


@query("enumeration_checks", PROBLEM, _problem_sql("cells[3] NOT IN ('O', 'F', 'P')", 1, "status", 3))
def _(t):
    return _rules().value_check("status", quality.enumeration("O", "F", "P")).validate(t.records)


@query("pattern_checks", PROBLEM, _problem_sql("NOT regexp_matches(cells[2], '^(?:[0-9]+)')", 1, "customer", 2) + " UNION ALL "
       + _problem_sql("NOT regexp_matches(cells[5], '-0[1-9]-')", 1, "date", 5))
def _(t):
    rules = _rules().value_check("customer", quality.match_pattern("[0-9]+")).value_check("date", quality.search_pattern("-0[1-9]-"))
    return rules.validate(t.records)


@query("number_range_checks", PROBLEM, _problem_sql("NOT (try_cast(cells[4] AS DOUBLE) BETWEEN 0 AND 400000)", 1, "price", 4) + " UNION ALL "
       + _problem_sql("coalesce(NOT (try_cast(cells[2] AS DOUBLE) > 5 AND try_cast(cells[2] AS DOUBLE) < 1000), true)", 1, "customer", 2))
def _(t):
    rules = _rules().value_check("price", quality.number_range(0, 400000)).value_check("customer", quality.number_range(5, 1000, inclusive=False))
    return rules.validate(t.records)


@query("datetime_checks", PROBLEM, _problem_sql("try_strptime(cells[5], '%d-%m-%Y') IS NULL", 1, "date", 5) + " UNION ALL "
       + _problem_sql("coalesce(NOT (try_strptime(cells[5], '%d-%m-%Y') BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'), true)", 4, "date", 5))
def _(t):
    rules = _rules().value_check("date", quality.datetime_format("dd-MM-yyyy"))
    return rules.value_predicate("date", quality.datetime_range("01-01-1996", "31-12-2000", "dd-MM-yyyy")).validate(t.records)


@query("record_checks", PROBLEM, _record_sql("NOT (cells[3] <> 'F' OR CAST(cells[4] AS DOUBLE) > 1000)", 6) + " UNION ALL "
       + _record_sql("NOT (cells[3] <> 'P' OR CAST(cells[4] AS DOUBLE) < 450000)", 5, "pending order too large"))
def _(t):
    price = lambda f: f("price").try_cast("double")
    rules = _rules().record_predicate(lambda f: (f("status") != "F") | (price(f) > 1000))
    return rules.record_check(lambda f: (f("status") != "P") | (price(f) < 450000), message="pending order too large").validate(t.records)


@query("unique_checks", PROBLEM, """
SELECT '7' AS code, 'Unique check failed.' AS message, row_no + 1 AS "row", 2 AS "column", 'customer' AS field, cells[2] AS value
FROM (SELECT *, row_number() OVER (PARTITION BY cells[2] ORDER BY row_no) AS r FROM v_records) WHERE r > 1
UNION ALL SELECT '7', 'Unique check failed.', row_no + 1, NULL, 'customer,status', cells[2] || ',' || cells[3]
FROM (SELECT *, row_number() OVER (PARTITION BY cells[2], cells[3] ORDER BY row_no) AS r FROM v_records) WHERE r > 1""")
def _(t):
    return quality.Rules(FIELDS).unique_check("customer").unique_check(["customer", "status"]).validate(t.records.distinct())


@query("skipped_records", PROBLEM, _problem_sql("cells[3] <> 'Q' AND try_cast(cells[2] AS BIGINT) IS NULL", 1, "customer", 2))
def _(t):
    return _rules().skip(lambda f: f("status") == "Q").value_check("customer", quality.castable("bigint")).validate(t.records)


@query("sampled_checks", PROBLEM, _problem_sql("row_no % 5 = 0 AND try_cast(cells[2] AS BIGINT) IS NULL", 1, "customer", 2))
def _(t):
    return _rules().value_check("customer", quality.castable("bigint"), modulus=5).validate(t.records)


@query("expectations", PROBLEM, _record_sql("NOT (CAST(cells[1] AS BIGINT) = row_no AND CAST(cells[4] AS DOUBLE) >= 0)", 8, "price is not negative")
       + """ UNION ALL SELECT '9', 'more than a billion in all', NULL, NULL, NULL, NULL WHERE NOT (SELECT sum(CAST(cells[4] AS DOUBLE)) > 1e15 FROM v_records)""")
def _(t):
    rules = _rules().expect("price is not negative", lambda f: (f("order").try_cast("bigint") == F.col("row_no")) & (f("price").try_cast("double") >= 0))
    rules.expect_total("more than a billion in all", F.sum(rules.cell("price").try_cast("double")) > 1e15)
    return rules.validate(t.records)


@query("header_checks", "missing:s unexpected:s row:i", """
SELECT 'customer' AS missing, 'client' AS unexpected, min(o_orderkey) + 1 AS "row" FROM orders""")
def _(t):
    first = t.orders.select(F.min("o_orderkey")).scalar()
    head = F.array(*[F.lit(v) for v in ("order", "client", "status", "price", "date")])
    table = t.records.withColumn("cells", F.when(F.col("row_no") == first, head).otherwise(F.col("cells")))
    return quality.header_check(table.withColumn("row_no", F.col("row_no") - first), FIELDS).withColumn("row", F.col("row") + first)


SUMMARY_SQL = " UNION ALL ".join(
    [_problem_sql("try_cast(trim(cells[2]) AS BIGINT) IS NULL", 1, "customer", 2), _record_sql("len(cells) <> 5", 3), _problem_sql("CAST(cells[4] AS DOUBLE) < 0", 4, "price", 4)]
)


def _several(t):
    rules = _rules().value_check("customer", quality.castable("bigint")).length_check().value_predicate("price", lambda c: c.try_cast("double") >= 0)
    return rules.validate(t.records)


@query("problem_summary", "code:s message:s n:i", f"SELECT code, message, count(*) AS n FROM ({SUMMARY_SQL}) GROUP BY 1, 2")
def _(t):
    return quality.problem_summary(_several(t))


@query("first_problems", PROBLEM, f"""SELECT * FROM ({SUMMARY_SQL}) ORDER BY "row", code, "column" LIMIT 20""")
def _(t):
    return quality.limit_problems(_several(t), 20)
