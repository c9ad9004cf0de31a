"""Scripts of several queries, each below a line `-- @name title`."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

MARK = re.compile(r"^--[ \t]*@name[ \t]+(.*?)[ \t]*$", re.M)


def split_queries(text: str) -> dict[str, str]:
    """Bodies by title. Text before the first mark and empty bodies are dropped."""
    marks = list(MARK.finditer(text))
    ends = [m.start() for m in marks[1:]] + [len(text)]
    found = {m[1]: text[m.end() : end].strip().rstrip(";").strip() for m, end in zip(marks, ends, strict=False)}
    return {k: v for k, v in found.items() if v}


def run_script(spark: SparkSession, text: str, show: bool = False) -> dict[str, DataFrame]:
    """Each query of the script as a DataFrame; show prints them, or a note for an empty one."""
    out = {title: spark.sql(body) for title, body in split_queries(text).items()}
    if show:
        for title, df in out.items():
            print(f"\n{title}")
            print("(no rows)") if df.isEmpty() else df.show(truncate=False)
    return out
