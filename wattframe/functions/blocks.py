"""Block, hour and calendar expressions. A block is 15 minutes, 1..96 in a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKS_PER_DAY = 96
MINUTES_PER_BLOCK = 15


def block_of(ts: Column) -> Column:
    """Block number of a timestamp; blocks are half open, so a boundary belongs to one block only."""
    return (F.floor((F.hour(ts) * 60 + F.minute(ts)) / MINUTES_PER_BLOCK) + 1).cast("int")


def block_start(block: Column) -> Column:
    minutes = (block - 1) * MINUTES_PER_BLOCK
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"))


def block_end(block: Column) -> Column:
    """End of the block; the last block of the day closes at 24:00."""
    return block_start(block + 1)


def hour_of_block(block: Column) -> Column:
    """Hour 1..24 of a block."""
    return F.ceil(block / 4).cast("int")


def day_number(date: Column) -> Column:
    """Days since 1970-01-01, an integer that range joins can bucket."""
    return F.unix_date(date)


def calendar_columns(date: Column) -> dict[str, Column]:
    """Year, month and weekday with Monday = 0."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "weekday": F.weekday(date),
    }


def weekday_flags(date: Column) -> dict[str, Column]:
    """0/1 indicators for Monday, Saturday and Sunday."""
    day = F.weekday(date)
    return {
        "is_monday": (day == 0).cast("int"),
        "is_saturday": (day == 5).cast("int"),
        "is_sunday": (day == 6).cast("int"),
    }


# Intraday gates as (block up to which the gate serves, day shift, first block it opens), in two forms.
GATES = (
    (4, 0, 1), (9, 0, 13), (15, 0, 19), (21, 0, 25), (27, 0, 31), (33, 0, 37), (39, 0, 43), (45, 0, 49),
    (51, 0, 55), (57, 0, 61), (63, 0, 67), (69, 0, 73), (75, 0, 79), (81, 0, 85), (87, 0, 91), (93, 1, 1),
)
GATES_SECOND_FORM = (
    (2, 0, 7), (9, 0, 13), (15, 0, 19), (21, 0, 25), (27, 0, 31), (33, 0, 37), (39, 0, 43), (45, 0, 49),
    (51, 0, 55), (57, 0, 61), (63, 0, 67), (69, 0, 73), (75, 0, 79), (81, 0, 85), (87, 0, 91), (93, 1, 1),
)
AFTER_LAST_GATE = (1, 1)


def revision_gate(block: Column, gates: Sequence[tuple[int, int, int]] = GATES, after: tuple[int, int] = AFTER_LAST_GATE) -> Column:
    """Struct (day_shift, first_block) of the first gate of the table that serves the block; ``after`` behind the last."""
    opened = lambda shift, first: F.struct(F.lit(shift).cast("int").alias("day_shift"), F.lit(first).cast("int").alias("first_block"))
    chosen = opened(*after)
    for upto, shift, first in sorted(gates, reverse=True):
        chosen = F.when(block <= upto, opened(shift, first)).otherwise(chosen)
    return chosen
