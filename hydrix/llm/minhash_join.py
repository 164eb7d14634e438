"""MinHash near-dedup by an inverted join over signature coordinates.

1. Every text becomes its set of word shingles; equal sets are one *class*, and only classes go on.
   A class has a signature of ``COORDINATES`` minima; two sets agree in a coordinate with a
   probability equal to their similarity.
2. Classes are posted under each (coordinate, value).  A value that only one class has can match
   nothing.  Pairs must agree in ``MATCHES`` coordinates, so with a class's values sorted from rare to
   frequent, two such classes share a value within the first COORDINATES - MATCHES + 1 of either
   (prefix); only those are joined, and the frequent lists at the end are skipped: the matches of a
   joined pair are counted from the two signatures.  At the least similarity, 0.75, fewer than MATCHES
   of COORDINATES agree with a chance of about 3e-6.
3. Pairs are formed without listing a group's pairs: each class is tried with two leaders of its lists;
   then every posted pair that is not yet under one leader is compared, in long lists block by block
   inside tasks.  Pairs under one leader are connected already and cannot change the result.
4. A pair is a link only if the full shingle sets confirm it.

The sets of classes that share a posting are recomputed from the texts and shuffled once; texts that
cannot have a partner are dropped before that by a fixed-size key filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.components import connected_components
from hydrix.llm.keyfilter import key_filter, may_match
from hydrix.llm.names import free
from hydrix.llm.words import LOWER, NOT_BLANK, buffers, gram_hashes, mix, release_memory, row_chunks, seeds, word_hashes, word_spans
from hydrix.session import Scratch

SHINGLE = 5
#: Least similarity, as a percentage.
PERCENT = 75
COORDINATES, MATCHES = 64, 32
PREFIX = COORDINATES - MATCHES + 1
#: Pairs of a list that go one by one; members of a block of a longer list, and shingles counted at once.
SHORT_LIST, BLOCK, COLUMNS = 64, 256, 8192

_U = np.uint64
_FLIP, _TURN = seeds(COORDINATES, 11), seeds(COORDINATES, 12) | _U(1)
_SHORT = seeds(SHINGLE + 1, 13)


def _text_sets(texts: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(rows, shingle fingerprints, row bounds) for runs of rows; fingerprints sorted and distinct per row.

    A text of fewer words than a shingle is one shingle of the whole sequence, marked by its length.
    """
    data, offsets = buffers(texts)
    for lo, hi in row_chunks(offsets):
        part = LOWER[data[offsets[lo] : offsets[hi]]]
        starts, ends, first = word_spans(part, offsets[lo : hi + 1] - offsets[lo], NOT_BLANK)
        words = word_hashes(part, starts, ends)
        grams = gram_hashes(words, shingle)
        sets = []
        for d in range(hi - lo):
            n = first[d + 1] - first[d]
            if n >= shingle:
                own = np.sort(grams[first[d] : first[d + 1] - shingle + 1])
                sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif n:
                sets.append(mix(gram_hashes(words[first[d] : first[d + 1]], int(n)) ^ _SHORT[n]))
            else:
                sets.append(np.zeros(0, _U))
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        yield hi - lo, np.concatenate(sets), bounds


def _signatures(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(rows, COORDINATES) posting keys: the coordinate in the top bits, then its minimum."""
    out = np.empty((len(starts), COORDINATES), _U)
    for j in range(COORDINATES):
        least = np.minimum.reduceat((grams ^ _FLIP[j]) * _TURN[j], starts)
        out[:, j] = (least >> _U(6)) | (_U(j) << _U(58))
    return out


def _class_of(grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each (non-empty) set."""
    return mix(np.add.reduceat(mix(grams ^ _FLIP[0]), starts) ^ mix(sizes.astype(_U) * _TURN[1]))


def _signature_pieces(batches: Iterator[pa.Array], shingle: int) -> Iterator[pa.Array]:
    """Rows of ``signatures``, one array for each run of rows of ``_text_sets``."""
    for texts in batches:
        for _, grams, bounds in _text_sets(texts, shingle):
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            cls, keys = np.zeros(len(n), np.int64), np.zeros((0, COORDINATES), np.int64)
            if len(full):
                cls[full] = _class_of(grams, bounds[full], n[full]).view(np.int64)
                keys = _signatures(grams, bounds[full]).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum((n > 0) * COORDINATES)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1), pa.int64()))
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(cls, pa.int64(), mask=n == 0), lists], ["n", "cls", "keys"]
            )
    texts = None
    release_memory()


def signatures(text: Column, shingle: int = SHINGLE) -> Column:
    """Struct column (n: set size, cls: the set's fingerprint, keys: its posting keys); an empty set
    has n = 0 and nulls."""

    @F.arrow_udf("struct<n:bigint,cls:bigint,keys:array<bigint>>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _signature_pieces(batches, shingle)

    return apply(text)


def _set_pieces(batches: Iterator[pa.Array], shingle: int) -> Iterator[pa.Array]:
    """Rows of ``shingle_sets``, one array for each run of rows of ``_text_sets``."""
    for texts in batches:
        for rows, grams, bounds in _text_sets(texts, shingle):
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            cls = np.zeros(rows, np.int64)
            if len(full):
                cls[full] = _class_of(grams, bounds[full], n[full]).view(np.int64)
            blobs = [grams[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]
            yield pa.StructArray.from_arrays(
                [pa.array(cls, pa.int64(), mask=n == 0), pa.array(blobs, pa.binary())], ["cls", "grams"]
            )
    texts = blobs = None
    release_memory()


def shingle_sets(text: Column, shingle: int = SHINGLE) -> Column:
    """Struct column (cls, grams: the sorted set as packed 64-bit fingerprints)."""

    @F.arrow_udf("struct<cls:bigint,grams:binary>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _set_pieces(batches, shingle)

    return apply(text)


def common_size(left: Column, right: Column) -> Column:
    """Size of the intersection of two packed sorted sets."""

    @F.arrow_udf("bigint")
    def apply(lefts: pa.Array, rights: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(lefts, rights):
            both = np.sort(np.concatenate([np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)]))
            out.append(int(np.count_nonzero(both[1:] == both[:-1])))
        return pa.array(out, pa.int64())

    return apply(left, right)


def postings(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(key, cls, rank)``: the prefix postings of every class that can have a partner.

    ``rank`` orders classes by how many postings they share in all: the original of a group of edited
    copies has the values that most of the group kept, so it ranks first in the lists of the group.
    """
    posted = classes.select("cls", F.explode("keys").alias("key"))
    shared = scratch.stage(
        posted.groupBy("key").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1"), "shared"
    )
    near = may_match(posted, F.col("key"), key_filter(shared, "key")).where("__may").select("cls", "key")
    counted = near.join(shared, "key").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("freq", "key"))).alias("v"))
    # values that no other class has come first in the order: they use up the prefix but post nothing
    room = F.lit(PREFIX) - (F.lit(COORDINATES) - F.size("v"))
    shared_by = F.aggregate("v", F.lit(0).cast("long"), lambda acc, x: acc + x["freq"])
    kept = counted.where(room > 0).withColumn("shared", shared_by).select(
        F.struct("shared", "cls").alias("rank"), F.explode(F.slice("v", 1, room)).alias("p")
    )
    return scratch.stage(kept.select(F.col("p.key").alias("key"), "rank.cls", "rank"), "postings")


def confirm(pairs: DataFrame, classes: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """The links among ``(a, b)`` pairs: enough matching coordinates, then the full sets.  Further
    columns of the pairs stay."""
    keys = classes.select("cls", "keys")
    counted = pairs.join(keys.withColumnsRenamed({"cls": "a", "keys": "ka"}), "a").join(
        keys.withColumnsRenamed({"cls": "b", "keys": "kb"}), "b"
    )
    matches = F.size(F.filter(F.zip_with("ka", "kb", lambda x, y: x == y), lambda same: same))
    close = scratch.stage(counted.where(matches >= MATCHES).select(*pairs.columns), "close")
    full = close.join(sets.withColumnsRenamed({"cls": "a", "grams": "ga"}), "a").join(
        sets.withColumnsRenamed({"cls": "b", "grams": "gb"}), "b"
    )
    common = full.select(*pairs.columns, common_size(F.col("ga"), F.col("gb")).alias("i"), ((F.octet_length("ga") + F.octet_length("gb")) / 8).cast("long").alias("s"))
    return scratch.stage(common.where(100 * F.col("i") >= PERCENT * (F.col("s") - F.col("i"))).select(*pairs.columns), "links")


def _labelled(posted: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings with a label that only connected classes share: the leader's leader, where confirmed.

    A leader ranks above its followers, so there are no loops.
    """
    up = links.groupBy("b").agg(F.max(F.struct("w", "a")).alias("m")).select(F.col("b").alias("cls"), F.col("m.a").alias("up"))
    up = scratch.stage(up, "up")
    above = up.select(F.col("cls").alias("up"), F.col("up").alias("top"))
    top = scratch.stage(up.join(above, "up", "left").select("cls", F.coalesce("top", "up").alias("comp")), "top")
    rows = posted.join(top, "cls", "left").select("key", "cls", "rank", F.coalesce("comp", "cls").alias("comp"))
    return scratch.stage(rows, "labelled")


def link_components(posted: DataFrame, classes: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` over classes, from prefix postings and confirmed links."""
    # each class with two leaders of its lists: the first in rank, and the one it shares most lists with
    leader = scratch.stage(posted.groupBy("key").agg(F.max("rank").alias("leader")), "leaders")
    tried = posted.join(leader, "key").where(F.col("cls") != F.col("leader.cls")).groupBy("cls", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = tried.groupBy("cls").agg(F.max("leader").alias("x"), F.max(F.struct("n", "leader")).alias("y"))
    best = best.select("cls", F.explode(F.array_distinct(F.array("x", "y.leader"))).alias("l"))
    links = confirm(best.select(F.col("l.cls").alias("a"), F.col("cls").alias("b"), F.col("l.shared").alias("w")), classes, sets, scratch)
    more = _open_links(_labelled(posted, links, scratch), classes, sets, scratch)
    return connected_components(links.select("a", "b").unionByName(more), scratch)


def _open_links(rows: DataFrame, classes: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Links among all posted pairs with different labels.

    Lists with the same leader are taken together.  Members outside such a list's largest label
    meet all members of other labels: pair by pair in a short list, and in blocks of ``BLOCK`` by
    ``BLOCK`` sets in a long one, where a task counts the common shingles of whole blocks and returns
    at most one link for two labels.
    """
    mixed = rows.groupBy("key").agg(F.max("rank").alias("top"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    mixed = scratch.stage(mixed.where("c0 <> c1").select("key", F.col("top.cls").alias("leader")), "mixed")
    members = scratch.stage(rows.join(mixed, "key").select("leader", "cls", "comp").distinct(), "members")
    sizes = members.groupBy("leader", "comp").agg(F.count(F.lit(1)).alias("n"))
    plan = sizes.groupBy("leader").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("n_all"))
    plan = plan.select("leader", F.col("m.comp").alias("largest"), (F.col("n_all") - F.col("m.n")).alias("n_open"), "n_all")
    plan = scratch.stage(plan.withColumn("short", F.col("n_open") * F.col("n_all") <= SHORT_LIST), "plan")
    open_ = scratch.stage(members.join(plan, "leader"), "open")
    x = open_.where("short and comp <> largest").select("leader", F.col("cls").alias("x"), F.col("comp").alias("cx"))
    y = open_.where("short").select("leader", F.col("cls").alias("y"), F.col("comp").alias("cy"))
    pairs = x.join(y, "leader").where("cx <> cy").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    found = confirm(pairs, classes, sets, scratch)
    long_ = open_.where("not short").join(sets, "cls")
    chunks = {side: F.ceil(F.col(n) / BLOCK).cast("long") for side, n in (("x", "n_open"), ("y", "n_all"))}
    own = {side: F.pmod(F.xxhash64("cls"), n) for side, n in chunks.items()}
    xs = long_.where("comp <> largest").select(
        "leader", own["x"].alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), chunks["y"] - 1)).alias("j"),
        F.lit(True).alias("open"), "cls", "comp", "grams",
    )
    ys = long_.select(
        "leader", F.explode(F.sequence(F.lit(0).cast("long"), chunks["x"] - 1)).alias("i"), own["y"].alias("j"),
        F.lit(False).alias("open"), "cls", "comp", "grams",
    )
    blocks = xs.unionByName(ys).groupBy("leader", "i", "j").applyInPandas(_block_links, "a bigint, b bigint")
    return scratch.stage(found.unionByName(blocks), "open-links")


def _block_links(block: pd.DataFrame) -> pd.DataFrame:
    """Links between a block's open members and its other members, one for every two labels."""
    sides = []
    for mask in (block["open"].to_numpy(), ~block["open"].to_numpy()):
        part = block[mask]
        grams = [np.frombuffer(g, _U) for g in part["grams"]]
        row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        flat = np.concatenate([*grams, np.zeros(0, _U)])
        sides.append((part["cls"].to_numpy(), part["comp"].to_numpy(), flat, row, np.bincount(row, minlength=len(grams))))
    (xc, xk, xg, xr, xn), (yc, yk, yg, yr, yn) = sides
    shared = np.intersect1d(xg, yg)
    common = np.zeros((len(xc), len(yc)), np.float32)  # counts below 2^24 are exact
    for lo in range(0, len(shared), COLUMNS):
        part = shared[lo : lo + COLUMNS]
        common += _incidence(xg, xr, len(xc), part) @ _incidence(yg, yr, len(yc), part).T
    link = 100 * common >= PERCENT * (xn[:, None] + yn[None, :] - common)
    i, j = np.nonzero(link & (xk[:, None] != yk[None, :]))
    _, first = np.unique(np.stack([xk[i], yk[j]]), axis=1, return_index=True)
    return pd.DataFrame({"a": xc[i[first]], "b": yc[j[first]]})


def _incidence(grams: np.ndarray, rows: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
    """Dense 0/1 matrix: which row's set holds which of the given (sorted) shingles."""
    at = np.minimum(np.searchsorted(columns, grams), len(columns) - 1)
    held = columns[at] == grams
    out = np.zeros((n, len(columns)), np.float32)
    out[rows[held], at[held]] = 1
    return out


def near_duplicates(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``, both kept: one row per document (doc_id, n, cls, thash), and for every class
    (cls, comp, component_id, rows): the smallest doc_id of its component."""
    body = F.col(f"`{text}`")
    rows = scratch.stage(
        docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(body).alias("thash"), signatures(body, shingle).alias("s"))
        .select("doc_id", "thash", "s.n", "s.cls", "s.keys"), "rows", keep=True,
    )
    classes = scratch.stage(
        rows.where("n > 0").groupBy("cls").agg(
            F.min("doc_id").alias("min_id"), F.min("thash").alias("thash"), F.first("keys").alias("keys")
        ), "classes",
    )
    posted = postings(classes, scratch)
    wanted = scratch.stage(posted.select("cls").distinct().join(classes.select("cls", "thash"), "cls"), "wanted")
    found = may_match(docs.select(body.alias("text"), F.xxhash64(body).alias("thash")), F.col("thash"), key_filter(wanted, "thash"))
    sets = found.where("__may").select(shingle_sets(F.col("text"), shingle).alias("s")).select("s.cls", "s.grams")
    # a text without words has no class: dropped from the written table, as a filter on the function's result
    # before that is pushed below it and evaluates it a second time
    sets = scratch.stage(sets.groupBy("cls").agg(F.first("grams").alias("grams")), "sets").where("cls is not null")
    linked = scratch.stage(link_components(posted, classes, sets, scratch), "linked")
    placed = classes.select("cls", "min_id").join(linked, F.col("cls") == F.col("node"), "left").select(
        "cls", "min_id", F.coalesce("component", "cls").alias("comp")
    )
    placed = scratch.stage(placed, "placed")
    least = scratch.stage(placed.groupBy("comp").agg(F.min("min_id").alias("component_id")), "least")
    return rows, scratch.stage(placed.join(least, "comp").select("cls", "comp", "component_id"), "result", keep=True)


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A null, empty or blank text has no shingles and is linked with nothing (component_id is its own
    id, kept is true).  Rows that repeat an id and text get the same result; a null id takes part, and
    is kept where its whole component has no id.  Equal shingle sets always link.  Whole texts count;
    an empty table gives an empty result; extra columns are ignored.  Classes are 64-bit fingerprints
    of the sets, links are confirmed on the sets' 64-bit shingle fingerprints.
    """
    with Scratch(docs.sparkSession, "minhash") as scratch:
        rows, classes = near_duplicates(docs, scratch, key, text, shingle)
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n", "cls").join(classes, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the near copies: of each component the row with the smallest id stays.

    Among rows with that id and different texts the one with the least text hash stays, among equal
    rows any one.  Texts without words all stay.  Only rows that may have to go are shuffled.
    """
    with Scratch(docs.sparkSession, "minhash") as scratch:
        rows, classes = near_duplicates(docs, scratch, key, text, shingle)
        members = rows.where("n > 0").select("doc_id", "thash", "cls").join(classes, "cls")
        counted = members.groupBy("comp", "component_id", "doc_id", "thash").agg(F.count(F.lit(1)).alias("n"))
        counted = scratch.stage(counted, "counted")
        stays = counted.where("doc_id <=> component_id").groupBy("comp").agg(F.min("thash").alias("best"))
        stays = scratch.stage(stays, "stays")
        judged = counted.join(stays, "comp").withColumn("stay", F.expr("doc_id <=> component_id and thash = best"))
        special = scratch.stage(
            judged.where("not stay or n > 1").select(F.xxhash64("doc_id", "thash").alias("rkey"), "doc_id", "thash", "stay"),
            "special", keep=True,
        )
    rkey, maybe, found = (free(n, docs) for n in ("rkey", "maybe", "found"))
    marked = docs.withColumn(rkey, F.xxhash64(F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))))
    marked = may_match(marked, F.col(rkey), key_filter(special, "rkey"), maybe)
    listed = special.select(F.struct("rkey", "stay").alias(found))
    doubtful = marked.where(F.col(maybe)).join(listed, F.col(rkey) == F.col(f"{found}.rkey"), "left")
    doubtful = doubtful.where(F.col(found).isNull() | F.col(f"{found}.stay"))
    repeated = doubtful.where(F.col(found).isNotNull()).dropDuplicates([rkey])
    names = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~F.col(maybe)).select(*names).unionByName(
        doubtful.where(F.col(found).isNull()).select(*names)
    ).unionByName(repeated.select(*names))
