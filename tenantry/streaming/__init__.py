"""Anonymizing rows as they arrive.

The keyed strategies are stateless projections, so a streaming DataFrame takes
them as it is.  Tokens are numbered over the whole of the data, and a stored map
is looked up in a table that grows; both are batch only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenantry.operators.anonymize import Anonymizer, matched_columns


def anonymize_stream(df: DataFrame, anonymizer: Anonymizer) -> DataFrame:
    if not df.isStreaming:
        raise ValueError("not a streaming DataFrame")
    if anonymizer.stored is not None:
        raise ValueError("a stored map needs a batch")
    if any(rule.strategy == "tokenize" for _, rule in matched_columns(df, anonymizer.rules)):
        raise ValueError("tokenizing needs a batch")
    return anonymizer.table(df)
