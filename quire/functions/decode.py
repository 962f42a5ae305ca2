"""Lenient UTF-8 decoding of file bytes (Arrow-batched, the one Python step on content).

Spark's own ``decode(content, 'UTF-8')`` raises on malformed input, and its
"make valid" variants substitute U+FFFD, which cannot be told apart from a
genuine U+FFFD afterwards. Text-mode reading with ``errors="ignore"`` *drops*
malformed bytes and translates ``\\r\\n`` / ``\\r`` to ``\\n``; this UDF does
exactly that per Arrow batch.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_bytes(b: bytes | None) -> str | None:
    if b is None:
        return None
    return bytes(b).decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")


@F.pandas_udf(T.StringType())
def _decode_utf8_ignore(content: pd.Series) -> pd.Series:
    return content.map(decode_bytes)


def decode_utf8_lenient(content: Column) -> Column:
    """``binary`` → ``string``: drop malformed UTF-8, normalise newlines, keep a BOM."""
    from quire.session import ship_package

    ship_package()
    return _decode_utf8_ignore(content)
