"""Record validation: rules over delimited records, problems out.

A record is an ARRAY of text cells with an explicit row index. Rules become columns of one projection, so
any number of them costs a single pass; only uniqueness and totals need a shuffle. A predicate that is
null counts as a failure, a value check on a missing cell is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default problem codes and their messages.
UNEXPECTED_EXCEPTION = 0
VALUE_CHECK_FAILED = 1
HEADER_CHECK_FAILED = 2
RECORD_LENGTH_CHECK_FAILED = 3
VALUE_PREDICATE_FALSE = 4
RECORD_CHECK_FAILED = 5
RECORD_PREDICATE_FALSE = 6
UNIQUE_CHECK_FAILED = 7
ASSERT_CHECK_FAILED = 8
FINALLY_ASSERT_CHECK_FAILED = 9
MESSAGES = {
    UNEXPECTED_EXCEPTION: "Unexpected exception [%s]: %s",
    VALUE_CHECK_FAILED: "Value check failed.",
    HEADER_CHECK_FAILED: "Header check failed.",
    RECORD_LENGTH_CHECK_FAILED: "Record length check failed.",
    VALUE_PREDICATE_FALSE: "Value predicate returned false.",
    RECORD_CHECK_FAILED: "Record check failed.",
    RECORD_PREDICATE_FALSE: "Record predicate returned false.",
    UNIQUE_CHECK_FAILED: "Unique check failed.",
    ASSERT_CHECK_FAILED: "Assertion check failed.",
    FINALLY_ASSERT_CHECK_FAILED: "Final assertion check failed.",
}


def _message(code, message: str | None) -> str:
    return message or MESSAGES.get(code, f"Problem {code}.")


def castable(type_name: str) -> Callable[[Column], Column]:
    return lambda c: F.trim(c).try_cast(type_name).isNotNull()


def enumeration(*values: str) -> Callable[[Column], Column]:
    return lambda c: c.isin(list(values))


def match_pattern(pattern: str) -> Callable[[Column], Column]:
    """The pattern matches from the start of the value."""
    return lambda c: c.rlike(f"^(?:{pattern})")


def search_pattern(pattern: str) -> Callable[[Column], Column]:
    return lambda c: c.rlike(pattern)


def number_range(low: float, high: float, inclusive: bool = True, type_name: str = "double") -> Callable[[Column], Column]:
    def test(c: Column) -> Column:
        v = F.trim(c).try_cast(type_name)
        return v.between(low, high) if inclusive else (v > low) & (v < high)

    return test


def datetime_format(fmt: str) -> Callable[[Column], Column]:
    return lambda c: F.try_to_timestamp(c, F.lit(fmt)).isNotNull()


def datetime_range(low: str, high: str, fmt: str, inclusive: bool = True) -> Callable[[Column], Column]:
    def test(c: Column) -> Column:
        v = F.try_to_timestamp(c, F.lit(fmt))
        a, b = F.to_timestamp(F.lit(low), fmt), F.to_timestamp(F.lit(high), fmt)
        return v.between(a, b) if inclusive else (v > a) & (v < b)

    return test


@dataclass
class Rules:
    """A rule set over named fields; ``add``-style methods return the set itself."""

    fields: Sequence[str]
    cells: str = "cells"
    row: str = "row_no"
    _rules: list = field(default_factory=list)
    _uniques: list = field(default_factory=list)
    _skips: list = field(default_factory=list)
    _totals: list = field(default_factory=list)

    def cell(self, name: str) -> Column:
        return F.try_element_at(F.col(self.cells), F.lit(list(self.fields).index(name) + 1))

    def _sampled(self, ok: Column, modulus: int) -> Column:
        due = F.col(self.row) % modulus == 0 if modulus > 1 else F.lit(True)
        return due & ~F.coalesce(ok, F.lit(False))

    def _problem(self, bad: Column, code, message: str | None, name: str | None = None) -> Column:
        place = list(self.fields).index(name) + 1 if name else None
        value = self.cell(name) if name else F.lit(None).cast("string")
        return F.when(
            bad,
            F.struct(
                F.lit(str(code)).alias("code"),
                F.lit(_message(code, message)).alias("message"),
                (F.col(self.row) + 1).cast("long").alias("row"),
                F.lit(place).cast("int").alias("column"),
                F.lit(name).cast("string").alias("field"),
                value.alias("value"),
            ),
        )

    def value_check(self, name: str, test: Callable[[Column], Column], code=VALUE_CHECK_FAILED, message: str | None = None, modulus: int = 1, reads: str | None = None) -> Rules:
        """``test`` receives the cell's text, or its value as the type ``reads``. A cell that cannot be read as that
        type is an unexpected exception (code 0) and is not tested; no cast throws, in ANSI mode either."""
        c = self.cell(name)
        if reads is not None:
            c, text = F.trim(c).try_cast(reads), c
            unread = f"cannot read the value as {reads}"
            self._rules.append(self._problem(text.isNotNull() & self._sampled(c.isNotNull(), modulus), UNEXPECTED_EXCEPTION, MESSAGES[UNEXPECTED_EXCEPTION] % ("ValueError", unread), name))
        self._rules.append(self._problem(c.isNotNull() & self._sampled(test(c), modulus), code, message, name))
        return self

    def value_predicate(self, name: str, test: Callable[[Column], Column], code=VALUE_PREDICATE_FALSE, message: str | None = None, modulus: int = 1, reads: str | None = None) -> Rules:
        return self.value_check(name, test, code, message, modulus, reads)

    def length_check(self, code=RECORD_LENGTH_CHECK_FAILED, message: str | None = None, modulus: int = 1) -> Rules:
        ok = F.size(self.cells) == len(self.fields)
        self._rules.append(self._problem(self._sampled(ok, modulus), code, message))
        return self

    def record_predicate(self, test: Callable[[Callable[[str], Column]], Column], code=RECORD_PREDICATE_FALSE, message: str | None = None, modulus: int = 1) -> Rules:
        """``test`` receives a function from field name to column and may combine fields."""
        self._rules.append(self._problem(self._sampled(test(self.cell), modulus), code, message))
        return self

    def record_check(self, test: Callable[[Callable[[str], Column]], Column], code=RECORD_CHECK_FAILED, message: str | None = None, modulus: int = 1) -> Rules:
        """A cross-field check with a code of its own."""
        return self.record_predicate(test, code, message, modulus)

    def expect(self, name: str, test: Callable[[Callable[[str], Column]], Column], modulus: int = 1) -> Rules:
        """A named expectation over the record; its name is the message."""
        return self.record_predicate(test, ASSERT_CHECK_FAILED, name, modulus)

    def expect_total(self, name: str, test: Column) -> Rules:
        """An expectation over an aggregate of the whole table, checked once at the end."""
        self._totals.append((name, test))
        return self

    def unique_check(self, keys: str | Sequence[str], code=UNIQUE_CHECK_FAILED, message: str | None = None) -> Rules:
        self._uniques.append(([keys] if isinstance(keys, str) else list(keys), code, message))
        return self

    def skip(self, test: Callable[[Callable[[str], Column]], Column]) -> Rules:
        self._skips.append(test)
        return self

    # -- evaluation -------------------------------------------------------------------------------------

    def kept(self, df: DataFrame) -> DataFrame:
        for test in self._skips:
            df = df.filter(~F.coalesce(test(self.cell), F.lit(False)))
        return df

    def validate(self, df: DataFrame) -> DataFrame:
        """All problems of the data records: code, message, row, column, field, value."""
        df = self.kept(df)
        parts = []
        if self._rules:
            found = F.filter(F.array(*self._rules), lambda p: p.isNotNull())
            parts.append(df.select(F.inline(found)))
        if self._uniques:
            parts.append(self._repeats(df))
        if self._totals:
            # One aggregate for all of them.
            failed = [F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in self._totals]
            names = df.agg(F.array(*failed).alias("_f")).select(F.explode(F.filter("_f", lambda n: n.isNotNull())).alias("message"))
            parts.append(
                names.select(
                    F.lit(str(FINALLY_ASSERT_CHECK_FAILED)).alias("code"), "message", F.lit(None).cast("long").alias("row"),
                    F.lit(None).cast("int").alias("column"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"),
                )
            )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _repeats(self, df: DataFrame) -> DataFrame:
        """Second and later occurrences of a key, for all unique rules at once.

        First rows are found by a partial aggregate and taken out by row number, which is unique: a value
        repeated in a third of the records never meets in one task.
        """
        entries, said = [], []
        for i, (keys, code, message) in enumerate(self._uniques):
            entries.append(F.struct(F.lit(i).alias("_u"), F.array(*[self.cell(k) for k in keys]).alias("_k")))
            said.append(F.struct(
                F.lit(str(code)).alias("code"),
                F.lit(_message(code, message)).alias("message"),
                F.lit(list(self.fields).index(keys[0]) + 1 if len(keys) == 1 else None).cast("int").alias("column"),
                F.lit(",".join(keys)).alias("field"),
            ))
        keyed = df.select(self.row, F.inline(F.array(*entries))).filter(~F.exists("_k", lambda k: k.isNull()))
        firsts = keyed.groupBy("_u", "_k").agg(F.min(self.row).alias(self.row)).select("_u", self.row)
        repeats = keyed.join(firsts, ["_u", self.row], "left_anti").withColumn("_p", F.element_at(F.array(*said), F.col("_u") + 1))
        return repeats.select(
            "_p.code", "_p.message", (F.col(self.row) + 1).cast("long").alias("row"), "_p.column", "_p.field",
            F.array_join("_k", ",").alias("value"),
        )


def header_check(df: DataFrame, fields: Sequence[str], cells: str = "cells", header_row: int = 0, row: str = "row_no") -> DataFrame:
    """One problem when the header differs: what is missing and what is unexpected."""
    wanted = F.array(*[F.lit(f) for f in fields])
    head = df.filter(F.col(row) == header_row)
    return head.filter(F.col(cells) != wanted).select(
        F.lit(str(HEADER_CHECK_FAILED)).alias("code"),
        F.array_join(F.array_sort(F.array_except(wanted, F.col(cells))), ",").alias("missing"),
        F.array_join(F.array_sort(F.array_except(F.col(cells), wanted)), ",").alias("unexpected"),
        (F.col(row) + 1).cast("long").alias("row"),
    )


def problem_summary(problems: DataFrame, limit: int | None = None) -> DataFrame:
    """Problems per code and message, most frequent first."""
    counts = problems.groupBy("code", "message").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "code", "message").limit(limit) if limit else counts


def limit_problems(problems: DataFrame, limit: int) -> DataFrame:
    """The first problems in row order."""
    return problems.orderBy("row", "code", "column").limit(limit) if limit else problems
