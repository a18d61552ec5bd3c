"""Line parsers (P1-P6) with a reject output.

A line is split by position and every field is typed; a line with the wrong
number of fields or a field that does not parse is flagged ``_rejected``
instead of failing the job.  :func:`split_rejects` separates the
two outputs.  Everything is JVM-side column expressions: no Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.eventtime import to_event_time


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"          # Spark SQL type name, or "time"
    trim: bool = False
    unit: str = "s"               # for type == "time": raw epoch unit


_SQL_TYPE = {"string": "STRING", "long": "BIGINT", "int": "INT", "double": "DOUBLE", "time": "BIGINT"}


def parse_delimited(lines: DataFrame, fields: list[Field], sep: str = ",",
                    value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Split ``value`` on ``sep`` and type each field by position.

    One ``from_csv`` call per line (Spark's CSV tokenizer, JVM-side) with
    quoting switched off, so a line splits exactly as a plain string split
    does.  Empty inner fields stay "" (P5).  Fields beyond the layout are
    ignored.  A line is rejected when it has too few fields or a numeric field
    is empty or does not parse.
    Output: ``keep`` columns, the typed fields, the raw line and ``_rejected``.
    """
    trim = any(f.trim for f in fields)
    schema = ", ".join(f"`{f.name}` {_SQL_TYPE[f.type]}" for f in fields) + ", `_corrupt` STRING"
    opts = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt",
            "quote": "\u0000", "nullValue": "\u0000", "emptyValue": "",
            "ignoreLeadingWhiteSpace": str(trim).lower(), "ignoreTrailingWhiteSpace": str(trim).lower()}
    # The one-element explode is a Generate node: filters on its output (the
    # reject split) stay above it, so the line is parsed once, not once per
    # referenced field after predicate pushdown inlines the parse.
    parsed = lines.select(*keep, F.col(value).alias("_line"),
                          F.explode(F.array(F.from_csv(F.substring_index(F.col(value), sep, len(fields)), schema, opts))).alias("_r"))
    typed = []
    rejected = F.col("_r._corrupt").isNotNull() | F.col("_line").isNull()
    for f in fields:
        c = F.col(f"_r.`{f.name}`")
        if f.type == "string":
            typed.append(F.coalesce(c, F.lit("")).alias(f.name))
            continue
        rejected = rejected | c.isNull()
        typed.append((to_event_time(c, f.unit) if f.type == "time" else c).alias(f.name))
    return parsed.select(*keep, *typed, "_line", rejected.alias("_rejected"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the bookkeeping columns, rejected raw lines)."""
    good = parsed.where(~F.col("_rejected")).drop("_line", "_rejected")
    bad = parsed.where(F.col("_rejected")).select(F.col("_line").alias("line"))
    return good, bad


# Field layouts of the reference's feeds (positions are fixed by its format).
def parse_behaviour(lines: DataFrame, trim: bool = False, unit: str = "s", **kw) -> DataFrame:
    """P1 (no trim) / P2 (trim): user,item,category,behavior,ts."""
    return parse_delimited(lines, [
        Field("user_id", "long", trim), Field("item_id", "long", trim),
        Field("category_id", "int", trim), Field("behavior", "string", trim),
        Field("ts", "time", trim, unit)], **kw)


def parse_login(lines: DataFrame, unit: str = "s", **kw) -> DataFrame:
    """User,ip,event_type,ts."""
    return parse_delimited(lines, [
        Field("user_id", "long"), Field("ip"), Field("event_type"), Field("ts", "time", unit=unit)], **kw)


def parse_order(lines: DataFrame, unit: str = "s", **kw) -> DataFrame:
    """P5: order_id,event_type,tx_id,ts; an empty tx_id stays ''."""
    return parse_delimited(lines, [
        Field("order_id", "long"), Field("event_type"), Field("tx_id"), Field("ts", "time", unit=unit)], **kw)


def parse_receipt(lines: DataFrame, unit: str = "s", **kw) -> DataFrame:
    """tx_id,pay_channel,ts."""
    return parse_delimited(lines, [
        Field("tx_id"), Field("pay_channel"), Field("ts", "time", unit=unit)], **kw)


# Fixed value: the access-log time pattern of the reference's web log.
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Space-separated log line; 0 ip, 1 user, 3 time, 4 zone, 5 method, 6 url.

    The zone field is honoured when present (D19); without it the time is UTC.
    """
    # Split once (one-element explode keeps the split from being inlined per field).
    split = lines.select(*keep, F.col(value).alias("_line"),
                         F.explode(F.array(F.split(F.col(value), " ", -1))).alias("_p"))
    parts = F.col("_p")
    zone = F.trim(parts.getItem(4))
    with_zone = F.try_to_timestamp(F.concat_ws(" ", parts.getItem(3), zone),
                                   F.lit(ACCESS_LOG_TIME + " Z"))
    no_zone = F.try_to_timestamp(parts.getItem(3), F.lit(ACCESS_LOG_TIME))
    ts = F.when(zone.rlike("^[+-][0-9]{4}$"), with_zone).otherwise(no_zone)
    return split.select(
        *keep,
        parts.getItem(0).alias("ip"),
        F.trim(parts.getItem(1)).alias("user_id"),
        ts.alias("ts"),
        F.trim(parts.getItem(5)).alias("method"),
        F.trim(parts.getItem(6)).alias("url"),
        "_line",
        ((F.size(parts) < 7) | ts.isNull()).alias("_rejected"),
    )
