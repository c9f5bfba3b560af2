"""Small column expressions shared by the sources and operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from depotlens.schema import SOURCE_SYSTEMS


def padded_code(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and a number padded with zeros to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def source_name(index: Column, names: Sequence[str] = SOURCE_SYSTEMS) -> Column:
    """Name at a zero-based index; any other index, or none, gives the last name."""
    lookup = F.array(*[F.lit(name) for name in names])
    return F.coalesce(F.get(lookup, index.cast("int")), F.lit(names[-1]))


IDS_PER_MILLISECOND = 100_000


def time_ordered_id(moment: Column, number: Column, span_ms: int = 1) -> Column:
    """Ids that grow with the batch time (an instant).

    A batch owns ``span_ms`` milliseconds of ids, so batches at least that far apart
    never share one. A ``number`` that does not fit fails the job."""
    room = span_ms * IDS_PER_MILLISECOND
    fits = (number >= 0) & (number < room)
    message = F.concat(F.lit(f"id number outside 0..{room - 1}: "), number.cast("string"))
    checked = F.when(number.isNull() | fits, number).otherwise(F.raise_error(message))
    return (F.unix_millis(moment) * F.lit(IDS_PER_MILLISECOND) + checked).cast("bigint")


def time_stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMddHHmmss")


def first_match(first: tuple[Column, str], *more: tuple[Column, str], otherwise: str) -> Column:
    """Label of the first condition that is true. A NULL condition is not true."""
    chain = F.when(first[0], F.lit(first[1]))
    for condition, label in more:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def sql_quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("'", "''") + "'"
