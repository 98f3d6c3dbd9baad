"""Safe parsing of semi-structured text: bad input becomes NULL, never an error and never a lost row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"  # fixed value


def json_field(variant: Column | str, path: str, as_type: str = "string") -> Column:
    """Value at ``path`` of a VARIANT column, NULL when absent or not convertible."""
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path, as_type)


def safe_timestamp(text: Column) -> Column:
    """Zone-less timestamp; an offset in the text is dropped, not applied."""
    return text.try_cast("timestamp_ntz")


def safe_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal rounded half up to ``scale``; bad text and overflow become NULL."""
    return text.try_cast(f"decimal({precision},{scale})")


def is_valid_email(email: Column) -> Column:
    return email.rlike(EMAIL_PATTERN)


def strip_timezone(df: DataFrame) -> DataFrame:
    """Every zoned timestamp column as TIMESTAMP_NTZ with the same wall-clock reading in UTC."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns(
        {c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")) for c in zoned}
    )
