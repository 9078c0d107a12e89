"""Fuzzy line dedup: MinHash over character shingles, exact check, one line per class."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import drop_tables, shared_table
from ledgerday.llm.minhash import CharRuns
from ledgerday.llm.near import near_classes, small

#: Code points in a shingle, and the similarity from which two lines are near copies: an edited
#: character breaks seven shingles, so a line of 34 code points may have one, a line of 270 nine.
SHINGLE = 7
SIMILARITY = 0.6
#: A pair of similarity 0.6 is missed with probability (1 - 0.6^4)^24 = 0.04, one of 0.65 with 0.009, of
#: 0.7 with 0.002.  Of the test tables' unrelated lines about one pair in eight million meets.
BANDS, ROWS = 24, 4
BLANKS = " \t\n\x0b\f\r"


def _shingler():
    return CharRuns(SHINGLE)


def _trimmed(line: Column) -> Column:
    """``line`` without blanks at its ends.  Spaces go by the quick trim; few lines need the one that takes a set of characters."""
    plain = F.trim(line)
    other = reduce(or_, (end(F.lit(c)) for c in BLANKS.strip(" \n") for end in (plain.startswith, plain.endswith)))
    return F.when(other, F.btrim(line, F.lit(BLANKS))).otherwise(plain)


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, line_no, text, id`` of every ``\n``-split line that isn't blank; ``row`` tells input rows with
    equal ids apart, ``text`` is the line without blanks at its ends and ``id`` its hash."""
    # The row's hash is worked out before its lines are dealt, not for each of them.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row"), F.split(F.col(text_col), "\n").alias("lines"))
    lines = rows.select("doc_id", "row", F.posexplode("lines").alias("line_no", "line"))
    lines = lines.select("doc_id", "row", "line_no", _trimmed(F.col("line")).alias("text")).where("text <> ''")
    return lines.withColumn("id", F.xxhash64("text"))


def fuzzy_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, line_no, line_class, kept`` of every line that isn't blank.

    Lines (without blanks at their ends) are near copies if the Jaccard
    similarity of their sets of runs of 7 code points is 0.6 or more, whatever
    their length; classes are the connected components, equal lines included.
    Of each class the first line by (doc_id, row, line_no) is kept.  Lines are told apart by a 64-bit hash:
    different ones share it with a probability of n^2 / 2^65.

    A null text has no lines; blank lines are left out; null ids come first;
    rows repeated in full have the same lines, of which one occurrence each is
    kept.  Lines of any length are compared as a whole.
    """
    lines = lines_of(docs, id_col, text_col)
    classes, shared = near_classes(lines.select("id", "text"), _shingler, SIMILARITY, BANDS, ROWS, "lines")
    drop_tables(shared)
    placed = lines.select("doc_id", "row", "line_no", "id").join(small(classes), "id", "left")
    placed = shared_table(placed.select("doc_id", "row", "line_no", F.coalesce("class", "id").alias("line_class")), "line-places")
    # Most classes are one line in one place, which is kept: only the others' first places are sought and joined back.
    several = shared_table(placed.groupBy("line_class").count().where("count > 1").select("line_class"), "line-classes")
    place = F.struct("doc_id", "row", "line_no")
    first = placed.join(small(several), "line_class", "left_semi").groupBy("line_class").agg(F.min(place).alias("first"))
    first = shared_table(first, "line-firsts")
    drop_tables(several)
    return placed.join(small(first), "line_class", "left").select(
        "doc_id", "row", "line_no", "line_class", (F.col("first").isNull() | place.eqNullSafe(F.col("first"))).alias("kept")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", emptied: bool = True) -> DataFrame:
    """``docs`` with every row and column, their texts without the lines that aren't kept.

    Blank lines stay, a null text stays null.  A row of which only blank lines are left stays with
    ``emptied``, else it goes: each of its lines stands in another text.  A row that had no other lines
    stays.  Rows repeated in full keep their lines once in each.
    """
    marked = fuzzy_lines(docs, id_col, text_col).where("not kept")
    dropped = marked.groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("dropped"))
    rows = docs.withColumn("__row", F.xxhash64(F.col(text_col)))
    joined = rows.alias("d").join(
        dropped.alias("x"), F.col(f"d.{id_col}").eqNullSafe(F.col("x.doc_id")) & (F.col("d.__row") == F.col("x.row")), "left"
    )
    lines = F.split(F.col(f"d.{text_col}"), "\n")
    left = F.filter(lines, lambda _, i: ~F.array_contains(F.col("x.dropped"), i))
    text = F.when(F.col("x.dropped").isNull(), F.col(f"d.{text_col}")).otherwise(F.array_join(left, "\n"))
    if not emptied:
        joined = joined.where(F.col("x.dropped").isNull() | (F.length(F.btrim(text, F.lit(BLANKS))) > 0))
    return joined.select(*(text.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns))
