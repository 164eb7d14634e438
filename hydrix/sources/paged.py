"""Paged API envelopes landed as files.

A page is ``{"data": [row, ...], "next": <link or null>}``.  Instead of a driver-side fetch loop,
pages are landed as files (one envelope per line, or one pretty-printed document per file with
``multiline=True``) and read in parallel:

* ``page_rows``  -- every ``data`` element as a row (``inline``); empty or NULL ``data`` adds nothing.
  When the landing recorded the page number (``with_page``), ``page_rows(pages, page_col="page")``
  follows the source's paging rules: one envelope per page number (a re-requested page is read
  once), and nothing after the first page that is empty or has no ``next`` link (``crawl_pages``).
* ``page_stats`` -- page and row totals, empty and malformed pages, and whether the last page (no
  ``next``) is there; with page numbers also the end page, repeated, missing, unnumbered and late pages.
* a malformed envelope stops the job or, if the caller says so, is skipped; it never counts as a page.
* where page numbers decide, so does an envelope without one: its place in the crawl cannot be known.
* ``write_pages`` -- lands a table as page envelopes (pages of ``page_size`` consecutive key values);
  used to build fixtures and to re-page data.

JSON Lines of envelopes are splittable, so pages spread over tasks; ``multiline`` files are read one
task per file (a page is bounded by the API page size, 10,000 rows in the source system).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from hydrix._util import require_columns
from hydrix.session import stage
from hydrix.sources.files import ON_MALFORMED, only_parsed, read_json, write_json

DATA, NEXT, PAGE = "data", "next", "page"
#: Text of an envelope that does not parse; NULL in a good one.
CORRUPT = "_corrupt_page"
#: Manifest columns of a landed page: number of rows, hash of the rows.
PAGE_SIZE, PAGE_HASH = "_page_size", "_page_hash"


def envelope_schema(row_schema: StructType, with_page: bool = False, corrupt: bool = False) -> StructType:
    fields = [StructField(DATA, ArrayType(row_schema)), StructField(NEXT, StringType())]
    if corrupt:
        fields.append(StructField(CORRUPT, StringType()))
    if with_page:
        fields.insert(0, StructField(PAGE, LongType()))
    return StructType(fields)


def read_pages(
    spark: SparkSession,
    path: str,
    row_schema: StructType | None = None,
    *,
    multiline: bool = False,
    on_missing: str = "raise",
    with_page: bool = False,
) -> DataFrame | None:
    """Envelope DataFrame (``data``, ``next``[, ``page``], and the text of malformed envelopes in
    ``_corrupt_page``); a declared row schema avoids an inference pass."""
    schema = envelope_schema(row_schema, with_page) if row_schema is not None else None
    return read_json(spark, path, schema, multiline=multiline, on_missing=on_missing, corrupt_column=CORRUPT)


def _malformed(pages: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in pages.columns else F.lit(False)


def well_formed(pages: DataFrame, on_malformed: str = "raise") -> DataFrame:
    """The envelopes that parsed.  ``raise`` fails the job on the first other one, ``skip`` leaves it
    out (``page_stats`` counts them)."""
    if CORRUPT in pages.columns:
        return only_parsed(pages, CORRUPT, on_malformed, "page envelope")
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}, got {on_malformed!r}")
    return pages


def numbered(pages: DataFrame, page_col: str = PAGE, on_malformed: str = "raise") -> DataFrame:
    """The envelopes with a page number.  ``raise`` fails the job on the first other one, ``skip`` leaves
    it out (``page_stats`` counts them)."""
    if on_malformed == "skip":
        return pages.filter(F.col(page_col).isNotNull())
    text = F.concat(F.lit("page envelope without a number, rows: "), _described(pages)[0].cast("string"))
    return pages.filter(F.when(F.col(page_col).isNull(), F.raise_error(text).cast("boolean")).otherwise(True))


def with_manifest(pages: DataFrame) -> DataFrame:
    """The envelopes with their size and content hash, so that later readers need not open the rows.

    Written as Parquet these are narrow columns of their own: ``crawl_pages`` and ``page_stats`` then decide
    from page, next, size and hash, and read ``data`` only to give out the rows.
    """
    return pages.withColumns({PAGE_SIZE: _size(), PAGE_HASH: F.xxhash64(F.to_json(F.col(DATA)))})


def _described(pages: DataFrame) -> tuple[Column, Column]:
    """(size, hash) of a page: those of its manifest, else computed."""
    if {PAGE_SIZE, PAGE_HASH} <= set(pages.columns):
        return F.col(PAGE_SIZE), F.col(PAGE_HASH)
    return _size(), F.xxhash64(F.to_json(F.col(DATA)))


def _size(data: str = DATA):
    n = F.coalesce(F.size(data), F.lit(0))
    return F.when(n < 0, F.lit(0)).otherwise(n)  # size(NULL) is -1 in legacy mode


def _page_index(pages: DataFrame, page_col: str) -> tuple[DataFrame, Column]:
    """(one narrow row per page number, number of the end page as a scalar subquery).

    The copy that counts is the one with the most rows, then the one with a ``next`` link, then the
    highest content hash; ``ends`` says that the crawl stops there (no rows, or no link).  Only
    numbers cross the shuffle, never the page's rows.
    """
    has_next = F.coalesce(F.col(NEXT) != "", F.lit(False))
    size, content = _described(pages)
    copy = F.struct(size.alias("n"), has_next.alias("has_next"), content.alias("hash"))
    narrow = pages.select(F.col(page_col).alias("_page"), copy.alias("_copy"))
    same = narrow.groupBy("_page", "_copy").agg(F.count(F.lit(1)).alias("_same"))
    index = same.groupBy("_page").agg(
        F.max(F.struct("_copy", "_same")).alias("_best"), F.sum("_same").alias("_copies"),
        F.sum(F.col("_copy.n") * F.col("_same")).alias("_rows"),
        F.sum(F.when(F.col("_copy.n") == 0, F.col("_same")).otherwise(0)).alias("_empty"),
        F.sum(F.when(~F.col("_copy.has_next"), F.col("_same")).otherwise(0)).alias("_last"),
    )
    index = index.select("_page", F.col("_best._copy").alias("_copy"), F.col("_best._same").alias("_same"), "_copies", "_rows", "_empty", "_last")
    ends = ((F.col("_copy.n") == 0) | ~F.col("_copy.has_next")) & F.col("_page").isNotNull()
    return index, index.filter(ends).select(F.min("_page")).scalar()


def crawl_pages(
    pages: DataFrame, page_col: str = PAGE, *, end_page: int | None = None, on_malformed: str = "raise"
) -> DataFrame:
    """The envelopes the paging loop would have used.

    One envelope per page number (see ``_page_index`` for the copy that counts).  Pages after the end
    page -- the first whose chosen copy is empty or has no ``next`` -- are dropped; if none has landed
    yet, every page is kept.  Pass ``end_page`` if the landing step already knows it.  An envelope without
    a page number is malformed here: it stops the job, or is skipped if the caller says so.

    Page numbers, sizes and hashes decide first (those of the manifest, if the pages were landed with one:
    then the pages are read once); the pages themselves stay where they were read, and only the numbers that landed more than once (a list that is left to Spark's size check) are joined
    and made single.
    """
    require_columns(pages, [DATA, NEXT, page_col])
    pages = numbered(well_formed(pages, on_malformed), page_col, on_malformed)
    index, found_end = _page_index(pages, page_col)
    end = F.lit(int(end_page)) if end_page is not None else found_end
    kept = pages.filter(end.isNull() | (F.col(page_col) <= end))
    repeated = stage(index.filter("_copies > 1").select(F.col("_page").alias("_rp"), "_copy"), "repeated-pages")
    cond = F.col(page_col).eqNullSafe(F.col("_rp"))
    once = kept.join(repeated, cond, "left_anti")
    size, content = _described(pages)
    more = kept.join(repeated, cond).filter(
        (size == F.col("_copy.n")) & (F.coalesce(F.col(NEXT) != "", F.lit(False)) == F.col("_copy.has_next"))
        & (content == F.col("_copy.hash"))
    )
    return once.unionByName(more.select(*pages.columns).dropDuplicates([page_col]))


def crawl_landed(
    landed: DataFrame, page_col: str = PAGE, *, end_page: int | None = None, on_malformed: str = "raise"
) -> DataFrame:
    """``crawl_pages`` over a Parquet landing with manifest (``streaming.land_pages``): ``data`` is scanned once.

    The manifest columns decide.  Of the equal copies of a page the one that is last by file and row number
    counts, so the wanted copy is known by its place and needs no second look at the rows.
    """
    require_columns(landed, [DATA, NEXT, page_col, PAGE_SIZE, PAGE_HASH])
    number, file, row = "_number", "_file", "_row"
    pages = numbered(landed, page_col, on_malformed).withColumns({file: F.col("_metadata.file_path"), row: F.col("_metadata.row_index")})
    has_next = F.coalesce(F.col(NEXT) != "", F.lit(False)).alias("has_next")
    copy = F.struct(F.col(PAGE_SIZE).alias("n"), has_next, F.col(PAGE_HASH).alias("hash"), F.col(file), F.col(row))
    index = pages.select(F.col(page_col).alias(number), copy.alias("_copy")).groupBy(number).agg(
        F.max("_copy").alias("_copy"), F.count(F.lit(1)).alias("_copies")
    )
    ends = (F.col("_copy.n") == 0) | ~F.col("_copy.has_next")
    end = F.lit(int(end_page)) if end_page is not None else index.filter(ends).select(F.min(number)).scalar()
    repeated = stage(index.filter("_copies > 1").select(number, "_copy"), "repeated-pages")
    kept = pages.filter(end.isNull() | (F.col(page_col) <= end)).join(repeated, F.col(page_col) == F.col(number), "left")
    wanted = F.col(number).isNull() | ((F.col(file) == F.col(f"_copy.{file}")) & (F.col(row) == F.col(f"_copy.{row}")))
    return kept.filter(wanted).select(*landed.columns)


def page_rows(pages: DataFrame, page_col: str | None = None, *, on_malformed: str = "raise") -> DataFrame:
    """Flatten envelopes to rows (inside the scan stage, no shuffle); with ``page_col``, only the
    pages ``crawl_pages`` keeps."""
    require_columns(pages, [DATA])
    pages = crawl_pages(pages, page_col, on_malformed=on_malformed) if page_col is not None else well_formed(pages, on_malformed)
    return pages.select(F.inline(DATA))


def page_stats(pages: DataFrame, page_col: str | None = None) -> DataFrame:
    """One row: ``n_pages``, ``n_rows``, ``n_empty_pages``, ``has_last_page``, ``n_malformed``; with
    ``page_col`` also ``end_page`` (first page whose chosen copy is empty or link-less),
    ``n_repeated_pages``, ``n_pages_after_end``, ``n_unnumbered`` (envelopes without a page number: they count
    in the page and row totals, but cannot be placed) and ``n_missing_pages`` (numbers between the first and
    the end page, or the highest one, that no landed page accounts for: an unnumbered page may be any of
    them).  A malformed envelope counts in ``n_malformed`` only."""
    require_columns(pages, [DATA, NEXT] + ([page_col] if page_col else []))
    bad = _malformed(pages)
    if page_col is None:
        n = _described(pages)[0]
        return pages.agg(
            F.count_if(~bad).alias("n_pages"),
            F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n_rows"),
            F.count_if(~bad & (n == 0)).alias("n_empty_pages"),
            (F.count_if(~bad & (F.col(NEXT).isNull() | (F.col(NEXT) == ""))) > 0).alias("has_last_page"),
            F.count_if(bad).alias("n_malformed"),
        )
    malformed = pages.agg(F.count_if(bad & (_described(pages)[0] >= 0))).scalar()  # Spark wants a data column read too
    index, end = _page_index(pages.filter(~bad), page_col)
    inside = (end.isNull() | (F.col("_page") <= end)) & F.col("_page").isNotNull()
    first, last = F.min("_page"), F.coalesce(end, F.max("_page"))
    known = F.col("_page").isNotNull()
    unnumbered = F.coalesce(F.sum(F.when(~known, F.col("_copies"))), F.lit(0)).cast("long")
    gaps = F.coalesce(last - first + 1 - F.count_if(inside), F.lit(0))
    return index.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("long").alias("n_pages"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum("_empty"), F.lit(0)).cast("long").alias("n_empty_pages"),
        (F.coalesce(F.sum("_last"), F.lit(0)) > 0).alias("has_last_page"),
        malformed.alias("n_malformed"),
        end.alias("end_page"),
        F.coalesce(F.sum(F.when(known, F.col("_copies") - 1)), F.lit(0)).cast("long").alias("n_repeated_pages"),
        F.count_if(F.col("_page") > end).alias("n_pages_after_end"),
        unnumbered.alias("n_unnumbered"),
        F.greatest(gaps - unnumbered, F.lit(0)).cast("long").alias("n_missing_pages"),
    )


def write_pages(
    df: DataFrame, path: str, page_size: int, key: str, *, link: str = "page={}", with_page: bool = False
) -> str:
    """Land ``df`` as JSON Lines of envelopes: page ``p`` holds rows with ``key div page_size == p``.

    ``key`` should be a unique integer key so a page holds at most ``page_size`` rows (the group is
    bounded).  ``next`` links to page ``p + 1``; the highest page has no ``next``.  The highest page
    number comes from a scalar subquery (one global max), not from a driver round trip.
    ``with_page`` also records the page number, as a landing step that knows its request would.
    """
    if page_size <= 0:
        raise ValueError(f"page_size must be positive, got {page_size}")
    require_columns(df, [key])
    page = F.expr(f"`{key}` div {int(page_size)}")
    rows = F.struct(*[F.col(c) for c in df.columns])
    pages = (
        df.withColumn("_page", page)
        .groupBy("_page")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("_k"), rows.alias("_r")))).alias("_rows"))
        .select("_page", F.col("_rows._r").alias(DATA))
    )
    last = df.select(F.max(page)).scalar()
    nxt = F.when(F.col("_page") < last, F.format_string(link.replace("{}", "%d"), F.col("_page") + 1))
    cols = ([F.col("_page").cast("long").alias(PAGE)] if with_page else []) + [F.col(DATA), nxt.alias(NEXT)]
    return write_json(pages.select(*cols), path)
