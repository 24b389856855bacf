"""How many tasks an exchange of packed rows is dealt to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text whose packed rows one task takes.
CHARS_PER_TARGET = 24 << 20
#: The same where a task sorts its rows, some twice the text, and needs as much again for that.
SORTED_CHARS_PER_TARGET = 8 << 20


def targets_for(documents: DataFrame, text_col: str = "text", share: int = CHARS_PER_TARGET) -> int:
    """As many as the session asks for, and enough that a task's share does not grow with the input."""
    wanted = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = documents.agg(F.sum(F.length(text_col))).first()[0] or 0
    return max(1, wanted, -(-int(chars) // share))
