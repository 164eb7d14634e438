"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: every source's weight share of ``budget`` times all words; a target stops at ``max_repeat``
times its source and the excess is reshared by weight (solved at once: sources sorted by cap over
weight are capped while the remaining budget still fills them).  The budget is then a whole number of
blocks of ``block`` words, awarded to sources by the highest quotients target / (2 s + 1); cumulative
apportionments for each output shard give integer quotas per shard (the method is house monotone, so
they never fall).  Selection: a source's documents form one word stream in a seeded order, cut into
blocks; shard after shard takes as many of the stream's next blocks as its quota says, and the stream
wraps round into a second copy.  ``mix_sources`` names the block in which a document starts and the shard
that takes it.

Which documents are taken needs no sorted source: a histogram over the leading bits of the order key
finds the bucket in which the quota ends, a window over that one bucket finds the document, and every
other document is decided by comparing its key with the boundary key.  Where a document starts is the sum
of the buckets before its own and of the keys before it in the bucket.  Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrix.llm.heavy import join_by_key
from hydrix.llm.names import free
from hydrix.session import Scratch

# Fixed values of the mixing contract: the word pattern, the repeating weights, the budget and cap.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]*"
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MAX_REPEAT = 2.0

BLOCK = 128
SHARDS = 16
SEED = 17
#: Bits of the order key; four a digit.
KEY_BITS = 60
#: Leading bits of the order key in the histogram; its rows are bounded by sources x 2^BITS.
BITS = 14


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(key: str, text: str, seed: int) -> Column:
    """A non-negative number of 60 bits: the leading digits of the MD5 of seed, id and text."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"`{key}`").cast("string"), F.col(f"`{text}`")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT
) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``, one row per source.

    The windows here run over the list of sources, which is as long as the mixing recipe.
    """
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int")))
    weighted = weighted.withColumn("cap", F.col("source_size") * F.lit(max_repeat))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").cast("binary").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(budget) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = weighted.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # the first source that is not capped fixes the level of all that follow it
    final = F.max(F.when(~F.col("capped"), F.struct(-F.col("cap") / F.col("weight"), "level"))).over(everything)
    return levels.withColumn("final", final["level"]).select(
        "source", F.col("source_size").cast("long").alias("source_size"), "weight",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target"),
    )


def shard_quotas(targets: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """``(source, shard, quota, first_block)``: blocks that a source gives to each output shard.

    For shard k the first k shards' seats are apportioned together, and the quota is the growth.
    Rounding every share at the common divisor is the highest-quotient result for as many seats as it
    awards; the few seats that are over or missing go back or out by their quotients.
    """
    total = F.sum("target").over(Window.partitionBy("shard"))
    rows = targets.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards)))).withColumn("total", total)
    seats = F.round(F.col("total") / block * F.col("shard") / shards)
    rows = rows.withColumn("seats", seats.cast("long"))
    share = F.when(F.col("total") > 0, F.col("target") / F.col("total") * F.col("seats")).otherwise(0.0)
    rows = rows.withColumn("base", F.floor(share + 0.5).cast("long"))
    rows = rows.withColumn("missing", F.col("seats") - F.sum("base").over(Window.partitionBy("shard")))
    # candidates: the next seats of each source where some are missing, its last ones where some are over
    step = F.when(F.col("missing") > 0, F.sequence(F.lit(1).cast("long"), F.col("missing"))).when(
        (F.col("missing") < 0) & (F.col("base") > 0),
        F.transform(F.sequence(F.lit(1).cast("long"), F.least(-F.col("missing"), F.col("base"))), lambda j: 1 - j),
    )
    moves = rows.withColumn("step", F.explode(step)).withColumn(
        "quotient", F.col("target") / (2 * (F.col("base") + F.col("step")) - 1)
    )
    name = F.col("source").cast("binary").asc_nulls_last()
    high = F.row_number().over(Window.partitionBy("shard").orderBy(F.col("quotient").desc(), name, "step"))
    last = F.col("source").cast("binary").desc_nulls_first()  # ties go back in the reverse order
    low = F.row_number().over(Window.partitionBy("shard").orderBy(F.col("quotient").asc(), last, "step"))
    moves = moves.withColumn("high", high).withColumn("low", low)
    moved = moves.where(
        F.when(F.col("missing") > 0, F.col("high") <= F.col("missing")).otherwise(F.col("low") <= -F.col("missing"))
    )
    moved = moved.groupBy("source", "shard").agg(F.sum(F.signum("missing")).cast("long").alias("extra"))
    kept = rows.alias("r").join(
        moved.alias("m"), F.expr("r.source <=> m.source and r.shard = m.shard"), "left"
    ).select("r.source", "r.shard", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("upto"))
    first = F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy("shard")), F.lit(0))
    return kept.withColumn("first_block", first).select(
        "source", "shard", (F.col("upto") - F.col("first_block")).alias("quota"), "first_block"
    )


def _boundaries(words: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: copies that every document gives, and the key at which the last copy ends."""
    words = words.withColumn("bucket", F.shiftrightunsigned("okey", KEY_BITS - BITS))
    hist = words.groupBy("source", "bucket").agg(F.sum("size").alias("bsize"))
    upto = F.sum("bsize").over(Window.partitionBy("source").orderBy("bucket"))
    ends = hist.withColumn("upto", upto).alias("h").join(plan.alias("p"), F.expr("h.source <=> p.source")).where(
        (F.col("rest") > 0) & (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("bsize") < F.col("rest"))
    ).select("p.source", F.col("bucket").alias("end_bucket"), (F.col("rest") - F.col("upto") + F.col("bsize")).alias("left"))
    inside = words.alias("w").join(F.broadcast(ends).alias("e"), F.expr("w.source <=> e.source and bucket = end_bucket"))
    inside = inside.groupBy("e.source", "end_bucket", "left", "okey").agg(
        F.sum("size").alias("ksize"), F.count(F.lit(1)).alias("rows")
    )
    upto = F.sum("ksize").over(Window.partitionBy("source").orderBy("okey"))
    return inside.withColumn("kupto", upto).where(
        (F.col("kupto") >= F.col("left")) & (F.col("kupto") - F.col("ksize") < F.col("left"))
    ).select(
        "source", "end_bucket", F.col("okey").alias("end_key"),
        F.floor((F.col("left") - F.col("kupto") + F.col("ksize")) / F.col("rows")).cast("long").alias("end_words"),
    )


def mix_plan(
    docs: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    max_repeat: float = MAX_REPEAT,
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(words, plan, quotas)``, all staged: one narrow row per document, one row per source, and the
    blocks of every source and output shard.

    ``words``: doc_id, source, okey, size.  ``plan``: source, source_size, weight, target, taken_words
    (quota times block, at most ``max_repeat`` times the source), copies (whole copies of the source),
    end_bucket / end_key / end_words (where the last, partial copy ends; null if there is none).
    """
    words = scratch.stage(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
            order_key(key, text, seed).alias("okey"), word_count(F.col(f"`{text}`")).alias("size"),
        ),
        "words", keep=True,
    )
    sizes = words.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = scratch.stage(source_targets(sizes, weights, budget, max_repeat).coalesce(1), "targets")
    quotas = scratch.stage(shard_quotas(targets, block, shards).coalesce(1), "quotas", keep=True)
    blocks = quotas.groupBy("source").agg(F.sum("quota").alias("blocks"))
    plan = targets.alias("t").join(blocks.alias("b"), F.expr("t.source <=> b.source"), "left").select(
        "t.source", "source_size", "weight", "target",
        F.least(F.coalesce("blocks", F.lit(0)) * block, F.floor(F.col("source_size") * max_repeat)).alias("taken_words"),
    )
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("taken_words") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("copies", copies.cast("long")).withColumn(
        "rest", F.col("taken_words") - F.col("copies") * F.col("source_size")
    )
    plan = scratch.stage(plan.coalesce(1), "plan")
    ends = _boundaries(words, plan)
    plan = scratch.stage(
        plan.alias("p").join(ends.alias("e"), F.expr("p.source <=> e.source"), "left")
        .select("p.*", "end_bucket", "end_key", "end_words").coalesce(1), "ends", keep=True,
    )
    return words, plan, quotas


def stream_starts(words: DataFrame) -> DataFrame:
    """``(source, okey, rows, start)``: words of the source's stream before each order key.

    Rows that share a key are one entry.  A window sees one of 2^BITS buckets of a source.
    """
    keys = words.groupBy("source", "okey").agg(F.sum("size").alias("ksize"), F.count(F.lit(1)).alias("rows"))
    keys = keys.withColumn("bucket", F.shiftrightunsigned("okey", KEY_BITS - BITS))
    sums = keys.groupBy("source", "bucket").agg(F.sum("ksize").alias("bsize"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("bsize").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source", "bucket").orderBy("okey").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("own", F.coalesce(F.sum("ksize").over(inside), F.lit(0)))
    placed = keys.alias("k").join(sums.alias("s"), F.expr("k.source <=> s.source and k.bucket = s.bucket"))
    return placed.select("k.source", "okey", "rows", (F.col("base") + F.col("own")).alias("start"))


def shard_ends(quotas: DataFrame) -> DataFrame:
    """``(source, ends)``: per source, the blocks that are taken up to the end of each shard, in order."""
    upto = (F.col("first_block") + F.col("quota")).alias("upto")
    listed = quotas.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", upto))).alias("listed"))
    return listed.select("source", F.col("listed.upto").alias("ends"))


def taken_words(size: Column, okey: Column) -> Column:
    """Words that the mix takes of a document, given its source's plan columns."""
    bucket = F.shiftrightunsigned(okey, KEY_BITS - BITS)
    before = (bucket < F.col("end_bucket")) | ((bucket == F.col("end_bucket")) & (okey < F.col("end_key")))
    part = F.when(before, size).when(okey == F.col("end_key"), F.least(size, F.col("end_words"))).otherwise(0)
    return (F.col("copies") * size + F.coalesce(part, F.lit(0))).cast("long")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken, source, block, shard.

    ``block`` is the block of its source's stream in which the document starts, ``shard`` (from 1) the output
    shard whose quota takes that block; both are null where nothing of it is taken.  A null or blank text has size 0 and gives nothing; a null source is a source of its own, listed
    last; rows that repeat the same id and text share their words evenly; an empty table gives an empty
    result; extra columns are ignored.  The result depends only on the rows and the seed.
    """
    with Scratch(docs.sparkSession, "mix") as scratch:
        words, plan, quotas = mix_plan(docs, scratch, **options)
        ends = shard_ends(quotas)
        plan = scratch.stage(
            plan.alias("p").join(ends.alias("e"), F.expr("p.source <=> e.source"), "left").select("p.*", "ends").coalesce(1),
            "recipe", keep=True,
        )
        starts = scratch.stage(stream_starts(words), "starts", keep=True)
    placed = join_by_key(words, starts, ["source", "okey"], F.col("rows"), words.count(), F.col("doc_id"))
    # one row per source of the recipe: small, but left to Spark's size check
    rows = placed.alias("w").join(plan.alias("p"), F.expr("w.source <=> p.source"), "left")
    taken = taken_words(F.col("w.size"), F.col("w.okey"))
    at = F.floor(F.col("w.start") / options.get("block", BLOCK)).cast("long")
    shard = F.size(F.filter("p.ends", lambda e: e <= at)) + 1
    return rows.select(
        "w.doc_id", "w.size", "p.source_size", "p.target", taken.alias("taken"), "w.source",
        F.when(taken > 0, at).alias("block"), F.when(taken > 0, shard).cast("long").alias("shard"),
    )


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED, **options
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per copy that the mix takes of a document.

    A document on a quota's boundary (one per source, with each row that repeats it) also gives a row
    under its own id that is cut after its last taken word: a prefix of the text as it stands, or all of
    it where every word is taken.  ``n_chars``, where it is a column, follows the text.
    """
    with Scratch(docs.sparkSession, "mix") as scratch:
        _, plan, _ = mix_plan(docs, scratch, key=key, source=source, text=text, seed=seed, **options)
    own, okey, piece = free("plan", docs), free("okey", docs), free("piece", docs)
    plan = plan.select(F.struct("copies", "end_bucket", "end_key", "end_words", "source").alias(own))
    rows = docs.withColumn(okey, order_key(key, text, seed))
    rows = rows.join(plan, F.col(f"`{source}`").eqNullSafe(F.col(f"{own}.source")), "left")
    bucket = F.shiftrightunsigned(okey, KEY_BITS - BITS)
    before = (bucket < F.col(f"{own}.end_bucket")) | (
        (bucket == F.col(f"{own}.end_bucket")) & (F.col(okey) < F.col(f"{own}.end_key"))
    )
    whole = (F.coalesce(f"{own}.copies", F.lit(0)) + F.coalesce(before.cast("long"), F.lit(0))).cast("int")
    words = F.when(F.col(okey) == F.col(f"{own}.end_key"), F.col(f"{own}.end_words")).otherwise(0)
    body = F.col(f"`{text}`")
    pieces = F.regexp_extract_all(body, F.lit(f"({BLANKS}{WORD})"))
    part = F.array_join(F.slice(pieces, 1, F.greatest(words, F.lit(1)).cast("int")), "")
    part = F.when(words >= F.size(pieces), body).otherwise(part)
    cut = F.when(F.coalesce(words, F.lit(0)) > 0, F.array(part)).otherwise(F.array().cast("array<string>"))
    has_words = F.regexp_like(body, F.lit(WORD))
    texts = F.when(has_words, F.concat(F.array_repeat(body, whole), cut)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn(piece, F.explode(texts))
    out = {text: F.col(piece)}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.char_length(piece).cast(docs.schema["n_chars"].dataType)
    return rows.select(*(out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns))
