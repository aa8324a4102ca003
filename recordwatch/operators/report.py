"""Reports as ordered rows, rendered to Markdown; sections of a text replaced or inserted."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwatch.functions.text import table_cell


def markdown_rows(df: DataFrame, order: list) -> DataFrame:
    """``pos, line``: the lines of a Markdown table of ``df``, in order. For reports of bounded size."""
    from pyspark.sql import Window

    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[table_cell(F.col(c).cast("string")) for c in df.columns]), F.lit(" |"))
    body = df.select((F.row_number().over(Window.orderBy(*order)) + 1).cast("long").alias("pos"), cells.alias("line"))
    spark = df.sparkSession
    head = spark.createDataFrame([(0, "| " + " | ".join(df.columns) + " |"), (1, "|" + " --- |" * len(df.columns))], "pos long, line string")
    return head.unionByName(body)


def to_markdown(df: DataFrame, order: list) -> str:
    return "\n".join(r.line for r in markdown_rows(df, order).orderBy("pos").collect())


def upsert_section(text: str, heading: str, section: str, before: str | None = None) -> str:
    """``text`` with the ``##`` section of that heading replaced, else put before another heading, else at the end."""
    body = f"## {heading}\n\n{section.strip()}\n"
    found = re.search(rf"(?ms)^## {re.escape(heading)}[ \t]*\n.*?(?=^## |\Z)", text)
    if found:
        return text[: found.start()] + body + ("\n" if text[found.end() :] else "") + text[found.end() :]
    at = re.search(rf"(?m)^## {re.escape(before)}[ \t]*$", text) if before else None
    if at:
        return text[: at.start()] + body + "\n" + text[at.start() :]
    return text.rstrip("\n") + "\n\n" + body
