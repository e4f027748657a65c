"""User job: JSON messages to typed records, kept under an age, to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline import schemas
from dripline.operators import rows

AGE_LIMIT = 30


def young_users(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Users under the age limit; a missing age does not pass."""
    users = rows.parse_json(messages, schemas.USER, strict=strict)
    return users.filter(F.col("age") < AGE_LIMIT)
