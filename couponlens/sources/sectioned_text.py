"""Sectioned report text: a title, then numbered sections separated by blank lines.

A section begins with a line ``<n>. <title>`` behind a blank line or at the top. It holds a tab-separated table, whose first
line is the header, and loose lines, which may begin with an arrow; blank lines inside it change nothing. Lines before
the first section are the document's title.

Files of any size are read by line and split by bytes. What a line means depends on the lines before it, so every block
of a file reports its last title with the rows since then, and a pass over these reports, one row per block, hands each
block what stands open at its beginning. No task sees more than a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TITLE = r"^(\d+)\.\s*(.*)$"
_NOTE_MARK = "→"
_BLOCK = ["file", "block"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: file, block (first byte of the part of the file that a task read), at (ascending within the
    block) and line. Lines end with a line feed, a carriage return, or both."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Adds ``line_no``, from 1 on in each file, and ``after_blank``, whether a blank line or nothing stands before."""
    blank = F.trim("line") == ""
    reports = lines.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("n"), F.max_by(blank, "at").alias("ends_blank"))
    order = Window.partitionBy("file").orderBy("block")
    before = reports.select(
        *_BLOCK, (F.sum("n").over(order) - F.col("n")).alias("_base"), F.lag("ends_blank", 1, True).over(order).alias("_open")
    )
    inside = Window.partitionBy(*_BLOCK).orderBy("at")
    return lines.join(before, _BLOCK).withColumns({
        "line_no": F.col("_base") + F.row_number().over(inside),
        "after_blank": F.coalesce(F.lag(blank).over(inside), F.col("_open")),
    }).drop("_base", "_open")


def _marked(lines: DataFrame) -> DataFrame:
    """Lines with what they are, and their section as far as the block itself tells: ``nth`` titles of the block stand up to
    the line, ``title`` is the last of them, ``rows`` and ``notes`` count since then, ``head`` is the first table line."""
    line = F.col("line")
    is_title = F.col("after_blank") & line.rlike(_TITLE) & ~line.contains("\t")
    title = F.struct(
        F.regexp_extract(line, _TITLE, 1).cast("int").alias("section_no"), F.regexp_extract(line, _TITLE, 2).alias("section"))
    kind = (
        F.when(is_title, "section").when(F.trim(line) == "", "blank")
        .when(line.contains("\t") & ~line.startswith(_NOTE_MARK), "data").otherwise("note")
    )
    upto = Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since = Window.partitionBy(*_BLOCK, "nth").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = numbered_lines(lines).withColumn("kind", kind).withColumn("nth", F.count_if(F.col("kind") == "section").over(upto))
    return counted.withColumns({
        "title": F.last(F.when(F.col("kind") == "section", title), ignorenulls=True).over(upto),
        "rows": F.count_if(F.col("kind") == "data").over(since),
        "notes": F.count_if(F.col("kind") == "note").over(since),
        "head": F.first(F.when(F.col("kind") == "data", line), ignorenulls=True).over(since),
    })


def _carried(marked: DataFrame) -> DataFrame:
    """What stands open at the beginning of each block: title, rows, notes and head of the section that goes on."""
    parts = ("title", "rows", "notes", "head")
    tails = marked.groupBy(*_BLOCK).agg(F.max_by(F.struct("nth", *parts), "at").alias("tail")).select(*_BLOCK, "tail.*")
    order = Window.partitionBy("file").orderBy("block")
    # blocks from one with a title up to the next such block share a section
    run = tails.withColumn("_run", F.count_if(F.col("nth") > 0).over(order))
    upto = Window.partitionBy("file", "_run").orderBy("block")
    out = run.withColumns({
        "title": F.first("title", ignorenulls=True).over(upto), "head": F.first("head", ignorenulls=True).over(upto),
        "rows": F.sum("rows").over(upto), "notes": F.sum("notes").over(upto),
    })
    return out.select(*_BLOCK, *[F.lag(c).over(order).alias(f"_{c}") for c in parts])


def section_cells(lines: DataFrame) -> DataFrame:
    """Long form of the lines of ``read_lines``: file, line_no, section_no, section, kind (title, data or note), row, col,
    header, value.

    Data rows, notes and the lines of a document's title are numbered from 1 in their section; the title's section has
    the number 0 and no name. A table line before the first section is data of that section 0. Header lines and section titles give no row of
    their own; every other line that is not blank does.
    """
    marked = _marked(lines)
    opening = F.col("nth") == 0
    known = marked.join(_carried(marked), _BLOCK).withColumns({
        "title": F.when(opening, F.col("_title")).otherwise(F.col("title")),
        "rows": F.col("rows") + F.when(opening, F.coalesce("_rows", F.lit(0))).otherwise(0),
        "notes": F.col("notes") + F.when(opening, F.coalesce("_notes", F.lit(0))).otherwise(0),
        "headers": F.split(F.coalesce(F.when(opening, F.col("_head")), F.col("head")), "\t"),
    })
    data = F.col("kind") == "data"
    free = F.array(F.trim(F.regexp_replace("line", "^" + _NOTE_MARK, "")))
    shown = known.filter((data & (F.col("rows") > 1)) | (F.col("kind") == "note")).select(
        "file", "line_no", F.coalesce("title.section_no", F.lit(0)).alias("section_no"), F.col("title.section").alias("section"),
        F.when(~data & F.col("title").isNull(), "title").otherwise(F.col("kind")).alias("kind"),
        F.when(data, F.col("rows") - 1).otherwise(F.col("notes")).cast("int").alias("row"), "headers",
        F.posexplode(F.when(data, F.split("line", "\t")).otherwise(free)).alias("_at", "value"),
    )
    return shown.select(
        "file", "line_no", "section_no", "section", "kind", "row", (F.col("_at") + 1).alias("col"),
        F.when(F.col("kind") == "data", F.get("headers", F.col("_at"))).alias("header"), "value",
    )


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """Report files in the long form of ``section_cells``."""
    return section_cells(read_lines(spark, path))


def split_sectioned_text(df: DataFrame, file_col: str, text_col: str) -> DataFrame:
    """The same for documents in a column; rows that share a name follow each other in one document."""
    lines = df.select(
        F.col(file_col).alias("file"), F.monotonically_increasing_id().alias("block"),
        F.posexplode(F.split(text_col, "\r\n|\r|\n")).alias("at", "line"))
    return section_cells(lines)


def render_sections(df: DataFrame, file_col: str, order: str, title: str, sections: dict[str, dict[str, Column]]) -> DataFrame:
    """The reverse: one document per ``file_col`` with a table per section; for reports of bounded length.

    ``sections`` maps a section title to its columns (header to string expression).
    """
    parts = []
    for number, (name, columns) in enumerate(sections.items(), start=1):
        line = F.concat_ws("\t", *columns.values())
        listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line"))))
        table = F.concat_ws("\n", F.transform(listed, lambda x: x["line"]))
        parts.append(F.concat_ws("\n", F.lit(f"{number}. {name}"), F.lit("\t".join(columns)), table))
    return df.groupBy(F.col(file_col).alias("file")).agg(F.concat_ws("\n\n", F.lit(title), *parts).alias("text"))
