"""Code lists out of label text.

A label text holds sections::

      value $name
       'CODE'  =  'LABEL'
       ...
    ;

A section ends at the first ``;`` at the end of a line, or where the next begins.
Every text is parsed by built-in functions on its own row: no shuffle, no state
carried from line to line, and as many texts at a time as there are tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starquay.functions.columns import text_before_comma, unquote
from starquay.staging import stage

# Section marker, end of a section, and entry of a label text.
SECTION_START = r"(?m)(?=^[ \t]*value[ \t]+\$?\w)"
SECTION_NAME = r"^[ \t]*value[ \t]+\$?(\w+)"
SECTION_END = r"(?m);[ \t]*\r?$"
ENTRY = r"(?m)^[ \t]*(?:'([^'\r\n]*)'|(\d+))[ \t]*=[ \t]*'([^'\r\n]*(?:''[^'\r\n]*)*)'"

# Section names of the three code lists.
COUNTRY_SECTION = "i94cntyl"
CITY_SECTION = "i94prtl"
STATE_SECTION = "i94addrl"

# How labels that stand for no real place begin.
PLACEHOLDER = r"^(INVALID|No Country Code|No PORT Code|Collapsed)"


def label_entries(texts: DataFrame) -> DataFrame:
    """(file, text) -> (file, section, position, code, label), padding removed.

    ``position`` rises through the text.
    """
    blocks = texts.select("file", F.posexplode(F.split("text", SECTION_START))).select(
        "file",
        F.col("pos").alias("block"),
        F.regexp_extract("col", SECTION_NAME, 1).alias("section"),
        F.split("col", SECTION_END, 2)[0].alias("body"),
    )
    found = blocks.where(F.col("section") != "").select(
        "file",
        "section",
        F.posexplode(F.regexp_extract_all("body", F.lit(ENTRY), F.lit(0))).alias(
            "line", "entry"
        ),
        "block",
    )
    position = F.col("block").cast("bigint") * F.lit(1 << 32) + F.col("line")
    return found.select("file", "section", position.alias("position"), *_parts(F.col("entry")))


def _parts(entry: Column) -> list[Column]:
    quoted, bare = F.regexp_extract(entry, ENTRY, 1), F.regexp_extract(entry, ENTRY, 2)
    return [
        F.trim(F.concat(quoted, bare)).alias("code"),
        unquote(F.regexp_extract(entry, ENTRY, 3)).alias("label"),
    ]


def label_entries_of_splits(lines: DataFrame) -> DataFrame:
    """(file, split, row, line) -> the entries of ``label_entries``, for texts too long for
    one task. ``split`` is the byte at which a part of a file begins, and ``row`` rises with the
    lines of a part; see ``readers.read_text_splits``.

    An entry belongs to the section that the last marker before it began, unless that
    has ended. Within a split that is a window over its lines. What a split hands on to
    those behind it is one row, its last marker or end, so the carrying over splits is a
    window over one row per split, and no task sees a whole file.
    """
    line = F.regexp_replace("line", r"\r$", "")
    body = F.regexp_replace(line, r";[ \t]*$", "")
    name = F.regexp_extract(line, SECTION_NAME, 1)
    ends = line.rlike(r";[ \t]*$")
    # What holds behind a line, where that changes: a section, or none.
    event = F.when(ends, F.lit("")).when(name != "", name)
    entry = F.when(body.rlike(ENTRY), body)
    marked = lines.select("file", "split", "row", event.alias("event"), entry.alias("entry"))
    marked = marked.where(F.col("event").isNotNull() | F.col("entry").isNotNull())
    in_split = Window.partitionBy("file", "split").orderBy("row")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(
        marked.select(
            "file", "split", "event", "entry",
            F.row_number().over(in_split).alias("nth"),
            F.last("event", ignorenulls=True).over(before).alias("inner"),
        ),
        "label_lines",
    )
    over_splits = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy("file", "split")
        .agg(F.max_by("event", F.when(F.col("event").isNotNull(), F.col("nth"))).alias("last"))
        .select("file", "split", F.last("last", ignorenulls=True).over(over_splits).alias("outer"))
    )
    section = F.coalesce("inner", "outer", F.lit(""))
    # A split has fewer lines than bytes, so positions rise from split to split as well.
    return (
        placed.where(F.col("entry").isNotNull())
        .join(carried, ["file", "split"])
        .withColumn("section", section)
        .where(F.col("section") != "")
        .select("file", "section", (F.col("split") + F.col("nth")).alias("position"), *_parts(F.col("entry")))
    )


def entries_of(raw: DataFrame) -> DataFrame:
    """The entries of whole texts (file, text), or of lines by split."""
    return label_entries(raw) if "text" in raw.columns else label_entries_of_splits(raw)


# What decides between entries of a section and code: the last of these wins.
ENTRY_ORDER = ["file", "position", "label"]


def last_entries(entries: DataFrame) -> DataFrame:
    """One entry per section and code of the code lists, the last one, with all its columns.

    ``max_by`` combines on the map side, so a code that is repeated in many files
    is reduced before the shuffle.
    """
    rest = [c for c in entries.columns if c not in ("section", "code")]
    lists = F.col("section").isin(COUNTRY_SECTION, CITY_SECTION, STATE_SECTION)
    last = F.max_by(F.struct(*rest), F.struct(*ENTRY_ORDER)).alias("last")
    return entries.where(lists).groupBy("section", "code").agg(last).select("section", "code", "last.*")


def code_list(entries: DataFrame, section: str) -> DataFrame:
    """(code, label) of one section; the last entry of a code wins.

    ``max_by`` combines on the map side, so a code that is repeated in many files
    is reduced before the shuffle.
    """
    return (
        entries.where(F.col("section") == section)
        .groupBy("code")
        .agg(F.max_by("label", F.struct("file", "position", "label")).alias("label"))
    )


def country_codes(entries: DataFrame) -> DataFrame:
    return code_list(entries, COUNTRY_SECTION).withColumnsRenamed({"label": "country"})


def city_codes(entries: DataFrame) -> DataFrame:
    """City of a port: the label up to its first comma."""
    return code_list(entries, CITY_SECTION).select(
        "code", text_before_comma(F.col("label")).alias("city")
    )


def state_codes(entries: DataFrame) -> DataFrame:
    return code_list(entries, STATE_SECTION).withColumnsRenamed({"label": "state"})


def is_placeholder(label: Column) -> Column:
    """True for labels that stand for no real place. They are kept in the tables."""
    return label.rlike(PLACEHOLDER)
