"""Row-wise operators on streams.

The reference workload is batch only.  The expressions gathered here hold no
state, so the same function serves a table and a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_text, difficulty, is_adversarial
from ..operators.rules import lower_with, rule_escalation


def with_message_columns(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Clean text, difficulty, adversarial flag and rule escalation per message."""
    cleaned = messages.withColumn("clean", clean_text(F.col(text_col)))
    profiled = cleaned.withColumns({
        "difficulty": difficulty(F.col("clean"), F.lit(0)),
        "is_adversarial": is_adversarial(F.col("clean")),
    })
    return lower_with(profiled, "clean", rule=rule_escalation)
