"""HTML table rows as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_text(value: Column, scale: int) -> Column:
    """Decimal text without trailing zeros but one: ``12.5``, ``7.0``.

    Goes through a decimal, since a double's own text may be in exponent form.
    """
    digits = value.cast(f"decimal(38,{scale})").cast("string")
    return F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")


def escape(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def html_row(*cells: Column, escaped: bool = False) -> Column:
    """``<tr><td>..</td>..</tr>``; a null cell reads ``None``."""
    texts = [F.coalesce(cell.cast("string"), F.lit("None")) for cell in cells]
    if escaped:
        texts = [escape(text) for text in texts]
    return F.concat(
        F.lit("<tr><td>"), F.concat_ws("</td><td>", *texts), F.lit("</td></tr>")
    )
