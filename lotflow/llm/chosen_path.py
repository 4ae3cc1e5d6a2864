"""Similarity join of documents by word shingles: all texts whose shingle sets have a Jaccard index of 0.8 or more.

Texts with equal sets are one representative first. Then chosen paths find candidates: in each run a set
picks, by a hash of the path so far, each of its shingles with probability ``1 / (threshold * size)`` and goes
down all picked ones, so two sets as similar as the threshold share a picked shingle at each step once in
expectation. Sets that meet at a path's end form a bucket. Small buckets are searched by brute force over
sketches; larger ones are split by the next step of their paths, and what is still large after the last step is
searched in blocks, pair of blocks by pair of blocks. Runs are repeated until the target recall. Sets that look
similar are joined to groups, and within each group every pair is checked on the whole sets, again by brute
force in blocks; so a pair that met in no bucket is still found where others tie it to its group.

Words are taken in lower case without punctuation at their ends; a text of fewer words than the width is one
shingle. A text without a word is linked to none. Rows with equal texts are linked like any others; rows with a
null id take no part and have no class; different texts under one id are tied together. Each row gives one row: id, class_id (least id of all texts tied
together by links), n_links (rows of other texts or copies at or above the threshold).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import WordCache, checkpointed, mix, rows_of, runs_of, shingles, sized, word_hash
from lotflow.shipping import ship

WIDTH, THRESHOLD, RECALL, STEPS = 5, 0.8, 0.998, 2
#: Sets of a bucket that one task compares at a time, and sets and shingles of a block in the exact check.
BUCKET, BLOCK_SETS, BLOCK_SHINGLES = 256, 400, 2_000_000
#: Places of a sketch; a pair is looked at closely from this share of equal places on (four standard deviations below 0.8).
SKETCH, LOOKS_SIMILAR = 64, 0.6
#: Bits of the map of candidate ids that the second reading of the texts is thinned by (2 MiB).
ID_BITS = 1 << 24


def runs_needed(recall: float = RECALL, steps: int = STEPS) -> int:
    """Runs until a pair at the threshold meets at the end of a path of ``steps`` with probability ``recall``.

    The shared picks are a branching process with one child on average: it lives on to step n with
    probability ``q(n) = 1 - exp(-q(n - 1))``.
    """
    alive = 1.0
    for _ in range(steps):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def _picked(values: np.ndarray, path: int, threshold: float) -> list[int]:
    """Ends of the paths that go on from ``path``: a key for each picked shingle."""
    seed = np.array([path, path + 1], dtype=np.uint64)
    factor, shift = mix(seed * np.uint64(0x9E3779B97F4A7C15))
    drawn = (values * (factor | np.uint64(1)) + shift) >> np.uint64(32)
    chance = min(1.0, 1 / (threshold * len(values)))
    chosen = values[drawn < np.uint64(int(chance * (1 << 32)))]
    return mix(chosen ^ shift).tolist()


def sketch(values: np.ndarray) -> bytes:
    """One byte of the least hash in each of ``SKETCH`` ranges, 0 where a range is empty."""
    edges = np.arange(SKETCH + 1, dtype=np.float64) * 2.0 ** (64 - 6)
    places = np.searchsorted(values, edges[:-1].astype(np.uint64))
    ends = np.append(places[1:], len(values))
    out = np.zeros(SKETCH, dtype=np.uint8)
    filled = places < ends
    least = mix(values[places[filled]])
    out[filled] = (least % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


_SETS = "id long, sig string, size int, sketch binary, first array<long>, parents array<long>, children array<long>"
_SETS_ARROW = pa.schema(
    [("id", pa.int64()), ("sig", pa.string()), ("size", pa.int32()), ("sketch", pa.binary())]
    + [(name, pa.list_(pa.int64())) for name in ("first", "parents", "children")]
)


def _signed(values: list[int]) -> list[int]:
    return np.array(values, dtype=np.uint64).view(np.int64).tolist()


def sets_of(docs: DataFrame, width: int, threshold: float, runs: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, signature of its set (null without words), size, sketch and the keys of its paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordCache(word_hash)

        def rows() -> Iterator[tuple]:
            for number, text in (row for rows in rows_of(batches, "id", "text") for row in rows):
                values = shingles(text, hashes, width)
                if not len(values):
                    yield number, None, 0, None, None, None, None
                    continue
                first = [key for n in range(runs) for key in _picked(values, n + 1, threshold)]
                further = [(key, child) for key in first for child in _picked(values, key, threshold)]
                yield (
                    number, xxhash.xxh3_128_hexdigest(values.tobytes()), len(values), sketch(values),
                    _signed(first), _signed([key for key, _ in further]), _signed([child for _, child in further]),
                )

        yield from sized(rows(), _SETS_ARROW, 1000)

    ship(docs.sparkSession)
    source = docs.selectExpr(f"CAST(`{id_col}` AS LONG) AS id", f"`{text_col}` AS text").where("id IS NOT NULL")
    return source.mapInArrow(run, _SETS)


def buckets(reps: DataFrame) -> DataFrame:
    """Rows (key, i, j, rep) of the buckets to search: pairs of blocks where a bucket is large (i = j = 0 elsewhere)."""

    def counted(paths: DataFrame) -> DataFrame:
        return paths.join(paths.groupBy("key").count().where("count > 1"), "key")

    first = counted(reps.select("rep", F.explode("first").alias("key")).distinct())
    large = first.where(F.col("count") > BUCKET).select(F.col("key").alias("parent"), "rep")
    further = reps.select("rep", F.explode(F.arrays_zip("parents", "children")).alias("path"))
    further = further.select("rep", F.col("path.parents").alias("parent"), F.col("path.children").alias("key"))
    second = counted(further.join(large, ["parent", "rep"]).select("rep", "key").distinct())
    rows = first.where(F.col("count") <= BUCKET).unionByName(second)
    return in_blocks(rows, "key", "rep", F.ceil(F.col("count") / BUCKET))


def in_blocks(rows: DataFrame, group: str, member: str, blocks) -> DataFrame:
    """Rows (group, i, j, block, member): each member goes to all pairs of blocks that its own block is part of."""
    block = F.pmod(F.xxhash64(member, F.lit(3)), F.col("n_blocks")).cast("int")
    rows = rows.withColumn("n_blocks", blocks.cast("int")).withColumn("block", block)
    rows = rows.select(group, member, "block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other"))
    return rows.select(group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", member)


def roots(alike: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least member of its connected part."""
    label = np.arange(len(alike))
    linked = alike | np.eye(len(alike), dtype=bool)
    while True:
        least = np.where(linked, label[None, :], len(alike)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _looks_alike(sizes: np.ndarray, sketches: np.ndarray, threshold: float) -> np.ndarray:
    filled = sketches != 0
    equal = np.stack([((sketches == row) & on).sum(axis=1) for row, on in zip(sketches, filled)])
    either = np.stack([(filled | on).sum(axis=1) for on in filled])
    ratio = np.minimum.outer(sizes, sizes) / np.maximum.outer(sizes, sizes)
    return (equal >= LOOKS_SIMILAR * either) & (ratio >= threshold - 1e-9)


_EDGES = "a long, b long"
_EDGES_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def candidate_edges(places: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) from each set that looks like others of a bucket to the least of those it is tied to there."""
    rows = places.join(reps.select("rep", "size", "sketch"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges() -> Iterator[tuple[int, int]]:
            for _, held in runs_of(batches, ("key", "i", "j"), ("rep", "size", "sketch")):
                if len(held) < 2:
                    continue
                ids, sizes = np.array([row[0] for row in held]), np.array([row[1] for row in held], dtype=float)
                sketches = np.frombuffer(b"".join([row[2] for row in held]), np.uint8).reshape(len(held), SKETCH)
                root = roots(_looks_alike(sizes, sketches, threshold))
                for n in np.flatnonzero(root != np.arange(len(held))):
                    yield int(ids[n]), int(ids[root[n]])

        yield from sized(edges(), _EDGES_ARROW)

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, _EDGES).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label): the least node that is tied to it by edges; nodes without an edge are not in it.

    Each round every node points at the least node in reach of one edge and then follows the pointers
    to their end; the graph shrinks to these ends and the edges left between different ones, until no
    edge is left.
    """
    left = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = None
    while not left.isEmpty():
        down = left.select(F.col("b").alias("node"), F.col("a").alias("label"))
        ends = left.select(F.col("a").alias("node"), F.col("a").alias("label"))
        step = checkpointed(down.unionAll(ends).groupBy("node").agg(F.min("label").alias("label")))
        moving = True
        while moving:  # each label's own label, until all are ends: chains halve each time
            onward = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            jumped = checkpointed(step.join(onward, "label").select("node", "label", "next"))
            moving = not jumped.where("label <> next").isEmpty()
            step = jumped.select("node", F.col("next").alias("label"))
        if labels is None:
            labels = step
        else:
            onward = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = checkpointed(labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
        to_a = step.select(F.col("node").alias("a"), F.col("label").alias("new_a"))
        to_b = step.select(F.col("node").alias("b"), F.col("label").alias("new_b"))
        moved = left.join(to_a, "a").join(to_b, "b").where("new_a <> new_b")
        left = checkpointed(moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct())
    return edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0) if labels is None else labels


def _id_map(ids: DataFrame, column: str) -> dict[int, int]:
    """Words of a bitmap over hashed ids that are not zero; bounded by the bitmap's size."""
    bit = ids.select(F.expr(f"xxhash64({column}) & {ID_BITS - 1}").alias("bit"))
    words = bit.groupBy(F.expr("CAST(bit >> 6 AS INT)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("bits"))
    return {row["word"]: row["bits"] for row in words.collect()}


def whole_sets(docs: DataFrame, ids: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (rep, shingles) of the documents in ``ids`` (column rep): texts that are in none are left out in the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(_id_map(ids, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordCache(word_hash)
        bits = np.zeros(ID_BITS // 64, dtype=np.uint64)
        bits[list(sent.value)] = np.array([word & (1 << 64) - 1 for word in sent.value.values()], dtype=np.uint64)

        def rows() -> Iterator[tuple]:
            for number, hashed, text in (row for rows in rows_of(batches, "id", "hashed", "text") for row in rows):
                bit = hashed & ID_BITS - 1
                if int(bits[bit >> 6]) >> (bit & 63) & 1:
                    values = shingles(text, hashes, width)
                    if len(values):
                        yield number, xxhash.xxh3_128_hexdigest(values.tobytes()), values.tobytes()

        yield from sized(rows(), pa.schema([("rep", pa.int64()), ("sig", pa.string()), ("shingles", pa.binary())]), 500)

    source = docs.selectExpr(f"CAST(`{id_col}` AS LONG) AS id", f"`{text_col}` AS text").where("id IS NOT NULL")
    found = source.selectExpr("id", "xxhash64(id) AS hashed", "text").mapInArrow(run, "rep long, sig string, shingles binary")
    # ids that repeat with other texts are told apart by the signature; equal rows bring the set once
    return found.join(ids.select("rep", "sig"), ["rep", "sig"]).groupBy("rep").agg(F.first("shingles").alias("shingles"))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Number of shared shingles of each pair of sets."""
    joined = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(values) for values in sets])
    distinct, place, times = np.unique(joined, return_inverse=True, return_counts=True)
    common = times > 1  # a shingle of one set alone adds to no pair
    renumbered = np.cumsum(common) - 1
    keep = common[place]
    owner, place = owner[keep], renumbered[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for begin in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(place, [begin, begin + width])
        member = np.zeros((len(sets), width), dtype=np.float32)
        member[owner[lo:hi], place[lo:hi] - begin] = 1
        total += member @ member.T
    return total


_LINKS_ARROW = pa.schema([("rep", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def verified(groups: DataFrame, reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Rows (rep, root, links): a tie to the least set it is linked to in a block pair, and rows it is linked to there."""
    members = groups.join(reps.select(F.col("rep").alias("node"), "size", "copies"), "node")
    shape = members.groupBy("label").agg(F.count("*").alias("n_sets"), F.sum("size").alias("n_shingles"))
    blocks = F.greatest(F.ceil(F.col("n_sets") / BLOCK_SETS), F.ceil(F.col("n_shingles") / BLOCK_SHINGLES))
    rows = in_blocks(members.join(shape, "label"), "label", "node", blocks).withColumnRenamed("node", "rep")
    rows = rows.join(sets, "rep").join(reps.select("rep", "copies"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ties() -> Iterator[tuple[int, int, int]]:
            for (_, i, j), held in runs_of(batches, ("label", "i", "j"), ("rep", "block", "copies", "shingles")):
                ids, copies = np.array([row[0] for row in held]), np.array([row[2] for row in held], dtype=np.int64)
                block = np.array([row[1] for row in held])
                sets = [np.frombuffer(row[3], np.uint64) for row in held]
                sizes = np.array([len(values) for values in sets], dtype=np.float64)
                shared = shared_counts(sets).astype(np.float64)
                either = sizes[:, None] + sizes[None, :] - shared
                linked = shared >= threshold * either - 1e-9
                np.fill_diagonal(linked, False)
                if i != j:  # pairs inside a block are checked where it meets itself
                    linked &= block[:, None] != block[None, :]
                links = linked @ copies
                root = roots(linked)
                for n in np.flatnonzero(links):
                    yield int(ids[n]), int(ids[root[n]]), int(links[n])

        yield from sized(ties(), _LINKS_ARROW)

    ordered = rows.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    return ordered.select("label", "i", "j", "rep", "block", "copies", "shingles").mapInArrow(run, "rep long, root long, links long")


def similarity_classes(
    docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, class_id, n_links."""
    found = checkpointed(sets_of(docs, width, threshold, runs_needed(recall), id_col, text_col))
    least = F.min(F.struct("id", "size", "sketch", "first", "parents", "children")).alias("least")
    grouped = found.where("sig IS NOT NULL").groupBy("sig").agg(F.count("*").alias("copies"), least)
    reps = checkpointed(grouped.select("sig", "copies", F.col("least.id").alias("rep"), "least.size", "least.sketch", "least.first", "least.parents", "least.children"))
    edges = candidate_edges(buckets(reps), reps, threshold)
    groups = components(edges)
    ids = reps.join(groups.select(F.col("node").alias("rep")), "rep", "left_semi").select("rep", "sig")
    sets = whole_sets(docs, ids, width, id_col, text_col)
    ties = checkpointed(verified(groups, reps, sets, threshold))
    classes = components(ties.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    links = ties.groupBy("rep").agg(F.sum("links").alias("links"))
    of_sig = reps.select("sig", "rep", "copies").join(links, "rep", "left").join(classes, "rep", "left")
    of_sig = of_sig.select(
        "sig", F.coalesce("label", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    linked = found.select("id", "sig").join(of_sig, "sig", "left")
    linked = linked.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    without = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias(id_col), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionAll(without)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with all their columns, one of each class: one with the least id (null only if there is no other).

    Rows are told apart by id and text, so null ids and different texts under one id are documents like any others.
    """
    key = F.xxhash64(id_col, text_col)
    rows = docs.withColumn("__row", key)
    classes = similarity_classes(rows, id_col="__row", text_col=text_col).select("__row", "class_id").distinct()
    first = F.min(F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.col("__row").alias("row")))
    kept = rows.select(id_col, "__row").join(classes, "__row").groupBy("class_id").agg(first.alias("first")).select(F.col("first.row").alias("__kept"))
    return rows.join(kept, rows["__row"] == kept["__kept"], "left_semi").dropDuplicates(["__row"]).drop("__row")
