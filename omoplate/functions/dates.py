"""Date parsing by configured format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime directives and the Spark datetime pattern letters
# they correspond to.
STRFTIME_TO_SPARK = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm",
    "%S": "ss", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM", "%a": "EEE",
    "%A": "EEEE", "%j": "DDD", "%z": "Z", "%%": "%",
}

# Patterns tried, in order, for the "ISO8601" format name.
ISO8601_PATTERNS = ("yyyyMMdd", "yyyy/MM/dd", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss",
                    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS",
                    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def to_spark_pattern(fmt: str) -> str:
    """Translate a strftime format into a Spark datetime pattern."""
    out, literal, i = [], [], 0

    def flush():
        if literal:
            text = "".join(literal).replace("'", "''")
            out.append(text if all(not ch.isalpha() for ch in text) else f"'{text}'")
            literal.clear()

    while i < len(fmt):
        token = fmt[i:i + 2]
        if fmt[i] == "%" and token in STRFTIME_TO_SPARK:
            flush()
            out.append(STRFTIME_TO_SPARK[token])
            i += 2
        else:
            literal.append(fmt[i])
            i += 1
    flush()
    return "".join(out)


def try_parse_datetime(c: Column | str, fmt: str) -> Column:
    """Parse with the format; unparseable -> null."""
    col = (F.col(c) if isinstance(c, str) else c).cast("string")
    if fmt.upper() == "ISO8601":
        return F.coalesce(*[F.try_to_timestamp(col, F.lit(p)) for p in ISO8601_PATTERNS]).cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(to_spark_pattern(fmt))).cast("timestamp_ntz")


def parse_datetime(c: Column | str, fmt: str, errors: str = "raise") -> Column:
    """D1 (``errors='raise'``): a non-null value that does not parse fails
    the job; D2 (``errors='coerce'``): it becomes null."""
    col = (F.col(c) if isinstance(c, str) else c).cast("string")
    parsed = try_parse_datetime(col, fmt)
    if errors == "coerce":
        return parsed
    return F.when(col.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"value does not match format {fmt}: "), col))).otherwise(parsed)


def floor_to_date(c: Column | str) -> Column:
    """The calendar day of a timestamp."""
    return (F.col(c) if isinstance(c, str) else c).cast("date")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.datediff(e, s)
