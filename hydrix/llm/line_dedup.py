"""Line dedup: lines that many documents share stay in one of them only.

1. Every line of every text is exploded with its position, normalised (blanks stripped at both ends, A-Z
   lower-cased) and hashed to 128 bits; keys shorter than ``least_chars`` never leave.  This narrow table
   (no text) is written once.
2. Distinct documents are counted per hash, and the largest id among them taken.  Spark counts a distinct
   aggregate in two steps, by (hash, document) and then by hash, so a line of a third of all documents is
   spread first and reaches its reducer as one partial count a task.
3. The positions to drop are those whose hash is in ``least_docs`` documents or more and whose document is
   not the largest.  Common lines are joined apart (``heavy.join_by_key``).
4. A document's dropped positions are gathered and its text is put together again from the runs between them.

Documents are told apart by id; rows that share an id are one document in the count, each keeps its own lines.
Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.heavy import join_by_key
from hydrix.llm.names import free
from hydrix.session import Scratch

# Fixed values of the contract: blanks, least code points of a key, least documents.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_DOCS = 20, 3


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    # in ASCII text the two agree and lower is much cheaper
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def wide_hash(c: Column) -> tuple[Column, Column]:
    """128 bits of hash as two numbers of independent seeds."""
    return F.xxhash64(c), F.xxhash64(F.lit(0x5EED), c)


def text_lines(text: Column) -> Column:
    """All lines of a text, the empty one after a final newline included; a null text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """(doc, text1, text2, pos, line1, line2) of every line whose key is long enough; positions from 0."""
    body = F.col(f"`{text}`")
    text1, text2 = wide_hash(body)
    rows = docs.select(F.col(f"`{key}`").alias("doc"), text1.alias("text1"), text2.alias("text2"), F.posexplode(text_lines(body)).alias("pos", "line"))
    rows = rows.select("doc", "text1", "text2", "pos", line_key(F.col("line")).alias("key"))
    line1, line2 = wide_hash(F.col("key"))
    return rows.where(F.char_length("key") >= least_chars).select(
        "doc", "text1", "text2", "pos", line1.alias("line1"), line2.alias("line2")
    )


def shared_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """(line1, line2, last, rows): hashes in ``least_docs`` documents or more, with the largest id that holds
    each (null ids are one document, smaller than all others) and the number of lines."""
    null_doc = F.max(F.col("doc").isNull().cast("long"))
    found = lines.groupBy("line1", "line2").agg(
        (F.count_distinct("doc") + null_doc).alias("docs"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    return found.where(F.col("docs") >= least_docs).select("line1", "line2", "last", "rows")


def without_lines(text: Column, positions: Column) -> Column:
    """The text without the lines at the given ascending positions; linear in the text."""

    def runs(both: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(both["drop"], lambda p: p + 1))
        ends = F.concat(both["drop"], F.array(F.size(both["lines"])))
        return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(both["lines"], a + 1, b - a)))

    # the struct is bound once, so the text is split once and not for every run
    once = F.array(F.struct(text_lines(text).alias("lines"), positions.alias("drop")))
    return F.array_join(F.transform(once, runs)[0], "\n")


def drop_shared_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    out: str = "lines",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """``docs`` with shared lines removed from ``text`` and the struct column ``out``: n_lines (before) and
    n_dropped.

    Every row and column stays; an input column named ``out`` is replaced.  A null text has one empty line and
    stays null; a text that loses all lines is empty; blank and short lines never leave; repeated rows come
    out alike; an empty table gives an empty result.
    """
    with Scratch(docs.sparkSession, "lines") as scratch:
        lines = scratch.stage(line_hashes(docs, key, text, least_chars), "hashes")
        shared = scratch.stage(shared_lines(lines, least_docs), "shared")
        found = join_by_key(lines, shared, ["line1", "line2"], F.col("rows"), lines.count(), F.struct("text1", "pos"))
        dropped = found.where(F.col("rows").isNotNull() & ~F.col("doc").eqNullSafe(F.col("last")))
        # a set, so that rows that are alike in id and text give their positions once a task, not once a row
        dropped = dropped.groupBy("doc", "text1", "text2").agg(F.collect_set("pos").alias("drop"))
        dropped = scratch.stage(dropped, "dropped", keep=True)
    body = F.col(f"`{text}`")
    side = free("dropped", docs)
    text1, text2 = wide_hash(body)
    same = (
        F.col(f"`{key}`").eqNullSafe(F.col(f"{side}.doc")) & (text1 == F.col(f"{side}.text1")) & (text2 == F.col(f"{side}.text2"))
    )
    rows = docs.join(dropped.select(F.struct("doc", "text1", "text2", F.array_sort("drop").alias("drop")).alias(side)), same, "left")
    drop = F.col(f"{side}.drop")
    kept = F.when(drop.isNull(), body).otherwise(without_lines(body, drop))
    counts = F.struct(
        F.size(text_lines(body)).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"),
    )
    columns = [kept.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != out]
    return rows.select(*columns, counts.alias(out))
