"""CSV rows to JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.functions import scalar as S
from millpulse.schemas import CSV_COLUMNS, EVENT

_NUMERIC = [n for n in CSV_COLUMNS.values() if n not in ("timestamp", "fault_label")]


def _cell(header: str) -> Column:
    return F.trim(F.col(f"`{header}`"))


def _missing(cell: Column) -> Column:
    return cell.isNull() | (cell == "")


def typed_rows(
    rows: DataFrame,
    *keep: str,
    timestamp_format: str | None = None,
    missing_as_nan: bool = False,
) -> DataFrame:
    """Typed fields of every CSV row, plus ``raw`` and ``reject_reason``.

    A row is rejected (reason not NULL) when a filled cell cannot be read, or
    when the time or the fault label is missing. A missing measure is NULL, or
    NaN with ``missing_as_nan`` for consumers that expect the CSV reader's NaN.
    """
    cells = {name: _cell(header) for header, name in CSV_COLUMNS.items()}
    fields: dict[str, Column] = {"row_time": S.parse_timestamp(cells["timestamp"], timestamp_format)}
    for name in _NUMERIC:
        number = cells[name].try_cast("double")
        if missing_as_nan:
            number = F.when(_missing(cells[name]), F.lit(float("nan"))).otherwise(number)
        fields[name] = number
    # Through double: a label written as 1.0 is still the label 1.
    fields["fault_label"] = cells["fault_label"].try_cast("double").try_cast("int")

    # Expanded from a one-element array, the typed fields are computed once; a
    # filter on the reason stays above them.
    typed = rows.select(
        "*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in fields.items()])))
    )
    reason = F.when(F.col("row_time").isNull(), "timestamp")
    for name in _NUMERIC:
        reason = reason.when(~_missing(cells[name]) & F.col(name).isNull(), name)
    reason = reason.when(F.col("fault_label").isNull(), "fault_label")
    raw = F.to_json(F.struct(*[F.col(f"`{header}`") for header in CSV_COLUMNS]))
    return typed.select(*keep, *fields, reason.alias("reject_reason"), raw.alias("raw"))


def accepted_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def rejected_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("reject_reason").isNotNull()).select("reject_reason", "raw")


def assign_machine(rows: DataFrame, machines: int, *key: str) -> DataFrame:
    """Add ``machine_id`` (``machine_1`` .. ``machine_<n>``) by a hash of ``key``.

    A hash, not a random number: a task that is run again gives the same row
    the same machine.
    """
    number = F.pmod(F.xxhash64(*key), F.lit(machines)) + 1
    return rows.withColumn("machine_id", F.concat(F.lit("machine_"), number.cast("string")))


def encode_messages(rows: DataFrame, *keep: str, keep_nulls: bool = True) -> DataFrame:
    """One JSON message per row in ``value``, fields in message order.

    ``rows`` carries ``row_time``, ``machine_id`` and the measures.
    """
    fields = [
        S.iso_text(F.col("row_time")).alias(name) if name == "timestamp" else F.col(name)
        for name in EVENT.names
    ]
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return rows.select(*keep, F.to_json(F.struct(*fields), options).alias("value"))


def display_rows(rows: DataFrame) -> DataFrame:
    """The per-row progress line of a publisher, as a column."""
    return rows.withColumn("fault_flag", S.fault_display(S.is_fault(F.col("fault_label"))))
