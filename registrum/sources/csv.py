"""CSV after RFC 4180 with the physical line of each record; broken records are kept with a reason.

Spark's own reader gives no line numbers and takes text behind a closing quote, so whole files are split in Python, each by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

TOKENS = re.compile(r'["\r\n,]|[^"\r\n,]+')


def records(text: str) -> Iterator[tuple[int, list[str], str | None]]:
    """(line, values, reason) of each record, the header first. reason: unterminated_quote, junk_after_closing_quote or None."""
    values: list[str] = []
    field, line, begin, reason = "", 1, 1, None
    quoted = closed = touched = False
    tokens = TOKENS.finditer(text.removeprefix("﻿"))
    waiting = None
    while (m := waiting or next(tokens, None)) is not None:
        waiting, t = None, m[0]
        if quoted:
            if t == '"':
                after = next(tokens, None)
                if after is not None and after[0] == '"':
                    field += '"'
                else:
                    quoted, closed, waiting = False, True, after
            else:
                line += t == "\n"
                field += t
        elif t == '"' and not field:
            quoted = touched = True
        elif t == ",":
            values.append(field)
            field, closed, touched = "", False, True
        elif t == "\n":
            yield begin, [*values, field], reason
            line += 1
            values, field, begin, reason, closed, touched = [], "", line, None, False, False
        elif t != "\r":
            if closed:
                reason, closed = reason or "junk_after_closing_quote", False
            field += t
            touched = True
    if quoted:
        reason = reason or "unterminated_quote"
    if touched or field or values or reason:
        yield begin, [*values, field], reason


def parse(text: str) -> tuple[list[str], list[tuple[int, list[str], str | None]]]:
    """The header and the records, those of another length than the header's with the reason column_count_N_expected_M."""
    found = records(text)
    header = [h.strip() for h in next(found, (1, [], None))[1]]
    return header, [(n, v, r or (None if len(v) == len(header) else f"column_count_{len(v)}_expected_{len(header)}")) for n, v, r in found]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """source_file, source_row (physical line), header, values, reason (null for sound records). A file has 2 GB at most and is held by one task."""
    files = spark.read.format("binaryFile").load(path)
    return split_files(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))


def split_files(files: DataFrame) -> DataFrame:
    """As read_csv(), of files (name, content) that are in a table."""

    def split(batches):
        for b in batches:
            for name, content in zip(b.column("name").to_pylist(), b.column("content").to_pylist(), strict=True):
                header, rows = parse(content.decode("utf-8", "replace"))
                for k in range(0, len(rows), 10_000):
                    part = rows[k : k + 10_000]
                    columns = [[name] * len(part), [r[0] for r in part], [header] * len(part), [r[1] for r in part], [r[2] for r in part]]
                    kinds = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["source_file", "source_row", "header", "values", "reason"])

    return files.select("name", "content").mapInArrow(split, "source_file string, source_row int, header array<string>, values array<string>, reason string")


def csv_rows(found: DataFrame) -> DataFrame:
    """The shape of page_items() with reason and blank (all values are white space): values by header, raw as JSON."""
    sound = F.when(F.col("reason").isNull(), F.map_from_entries(F.arrays_zip(F.col("header").alias("key"), F.col("values").alias("value"))))
    broken = F.to_json(F.struct("values"))
    return found.select(
        "source_file",
        "source_row",
        F.coalesce(F.to_json(sound), broken).alias("raw"),
        sound.alias("fields"),
        F.lit(False).alias("rating_is_number"),
        F.lit(False).alias("reviews_is_number"),
        "reason",
        F.forall("values", lambda v: strip(v) == "").alias("blank"),
    )
