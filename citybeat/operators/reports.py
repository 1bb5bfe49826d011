"""Irregular report sheets -> tidy records.

Input is a long cell table ``(file, sheet, row, col, value)`` - one row per
non-empty spreadsheet cell (decoding the workbook format is outside this
library).  The table is read once: its cells meet as sheet rows, and what a
reader remembers while going down a sheet (metadata, section title, header,
length of the run below it) is carried by running windows over one sort of
``(file, sheet, row)``.  One sheet is the largest unit that is ever processed
together, so the work spreads over all sheets of all files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citybeat.constants import DAY_LABELS, HEADER_LABEL, SECTION_BOARD, SECTION_BOROUGH, SECTION_DAY
from citybeat.functions.text import collapse_whitespace, metadata_value, normalize_borough, quarter_from_name

KEYS = ["file", "sheet"]

#: section -> (title, rows below the title in which its header must be)
SECTIONS = {"day_of_week": (SECTION_DAY, 6), "borough": (SECTION_BOROUGH, 4), "community_board": (SECTION_BOARD, 4)}


def _cells(cells: DataFrame) -> DataFrame:
    """Trimmed values, blank cells dropped, 'Reject Category' sheets skipped."""
    c = cells.withColumn("value", F.trim(F.col("value").cast("string")))
    c = c.filter(F.col("value").isNotNull() & (F.col("value") != ""))
    return c.filter(~F.lower(F.col("sheet")).startswith("reject category"))


def sheet_rows(cells: DataFrame) -> DataFrame:
    """(file, sheet, row) -> first cell and the cells right of it, by column.

    The rows of a sheet stay in one partition for the windows that follow.
    A cell given twice counts twice; of two first cells the smaller one is read.
    """
    c = _cells(cells).repartition(*KEYS)
    return c.groupBy(*KEYS, "row").agg(
        F.min(F.when(F.col("col") == 0, F.col("value"))).alias("first"),
        F.sort_array(F.collect_list(F.when(F.col("col") >= 1, F.struct("col", "value")))).alias("cells"),
    )


def _label(col: Column, day: Column | None = None, time: Column | None = None, borough: Column | None = None, board: Column | None = None) -> Column:
    """A labelled column of a section; what a section lacks is ''."""
    parts = {"day": day, "time_window": time, "borough": borough, "community_board": board}
    return F.struct(col.alias("col"), *[(F.lit("") if v is None else v).alias(k) for k, v in parts.items()])


def _columns(section: str) -> Column:
    """The labelled columns a header row gives (U2-U4).  Day labels sit in the row above,
    over the first column of each day, and are carried right across the columns."""
    if section == "borough":
        return F.transform("cells", lambda c: _label(c["col"], borough=normalize_borough(c["value"])))
    if section == "community_board":
        return F.transform("cells", lambda c: _label(c["col"], board=collapse_whitespace(c["value"])))
    days = F.filter("above", lambda d: F.upper(d["value"]).isin(DAY_LABELS))

    def day_of(c: Column) -> Column:
        left = F.filter(days, lambda d: d["col"] <= c["col"])
        return F.upper(F.get(left, F.size(left) - 1)["value"])

    labelled = F.transform("cells", lambda c: _label(c["col"], day=day_of(c), time=c["value"]))
    return F.filter(labelled, lambda c: c["day"].isNotNull())


def section_state(cells: DataFrame, sections: Sequence[str] = tuple(SECTIONS)) -> DataFrame:
    """Sheet rows with what the rows above them say.

    Per section: ``start``, the first row whose first cell holds the title;
    ``header``, the first 'Reject Reason' row within the section's search rows;
    ``columns``, its labels; ``run``, the rows with a first cell since then.
    Metadata comes from the first six rows, the last value of each.
    """
    by_row = Window.partitionBy(*KEYS).orderBy("row")
    so_far = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sheet = by_row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row, first = F.col("row"), F.col("first")
    top = lambda key: F.last(F.when(row < 6, metadata_value("first", key)), ignorenulls=True).over(sheet)
    state = sheet_rows(cells).withColumns(
        {
            "violation_type": F.coalesce(top("VIO TYPE"), F.lit("Unknown")),
            "month": F.coalesce(top("MONTH"), F.lit("Unknown")),
            "above": F.when(F.lag("row").over(by_row) == row - 1, F.lag("cells").over(by_row)),
            **{
                f"start_{s}": F.min(F.when(F.lower(first).contains(SECTIONS[s][0].lower()), row)).over(so_far)
                for s in sections
            },
        }
    )
    found = {}
    for s in sections:
        start = F.col(f"start_{s}")
        is_header = (first == HEADER_LABEL) & (row >= start) & (row < start + SECTIONS[s][1])
        found[f"header_{s}"] = F.min(F.when(is_header, row)).over(so_far)
        found[f"columns_{s}"] = F.first(F.when(is_header, _columns(s)), ignorenulls=True).over(so_far)
    state = state.withColumns(found)
    return state.withColumns(
        {f"run_{s}": F.sum(F.when(first.isNotNull() & (row > F.col(f"header_{s}")), 1)).over(so_far) for s in sections}
    )


def _records(section: str) -> Column:
    """Counts of a body row at the section's labelled columns; none for any other row.

    The body is the run of rows right below the header with a non-blank
    first cell: it ends at the first blank one.
    """
    labels = F.col(f"columns_{section}")
    values = F.transform(
        "cells",
        lambda c: F.struct(
            F.lit(section).alias("section"),
            F.filter(labels, lambda h: h["col"] == c["col"]).alias("at"),
            c["value"].try_cast("double").try_cast("long").alias("count"),
        ),
    )
    below = F.col("row") - F.col(f"header_{section}")
    in_body = (below > 0) & (F.col(f"run_{section}") == below) & (F.lower("first") != HEADER_LABEL.lower())
    return F.when(in_body, F.filter(values, lambda v: v["count"].isNotNull()))


def tidy_reports(cells: DataFrame, sections: Sequence[str] = tuple(SECTIONS)) -> DataFrame:
    """The named sections of all sheets as tidy rows with sheet metadata."""
    state = section_state(cells, sections)
    none = F.array().cast("array<struct<section:string,at:array<struct<col:int,day:string,time_window:string,borough:string,community_board:string>>,count:bigint>>")
    every = F.concat(*[F.coalesce(_records(s), none) for s in sections])
    rows = state.select(*KEYS, "month", "violation_type", F.col("first").alias("reject_reason"), F.inline(every))
    rows = rows.withColumn("label", F.explode("at"))
    return rows.select(
        F.col("file").alias("source_file"), quarter_from_name("file").alias("quarter"), "sheet", "month", "violation_type",
        "section", "reject_reason", "label.day", "label.time_window", "label.borough", "label.community_board", "count",
    )
