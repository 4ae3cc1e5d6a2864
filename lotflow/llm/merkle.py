"""Merkle manifest of a table: a digest per row, a tree per source, a tree over the sources, and a proof for every row.

A leaf is the digest of a row's fields; leaves of a source ascend by id. While a tree has several nodes, each run of
three (the last may be shorter, even one) becomes the digest of its digests. What remains of a source is its subroot;
the subroots, by source, form one more tree, whose root stands for the whole table.

Trees are built four levels at a time from blocks of 81 nodes, so no group is larger. Proofs come by pointer
jumping: every node holds the sibling digests on its way to an ancestor, one level up at first; each self-join takes
the ancestor's own ancestor and its siblings, so the way doubles until all leaves reach the root. Only nodes whose
level is a multiple of the way walked so far are ancestors of a leaf later on, so the joined side shrinks fast.

Null fields are marked, so null and empty differ; null ids and the null source come first. Equal ids ascend by leaf
digest; repeated rows are leaves of their own. An empty table has no root and gives no row; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import checkpointed

FANOUT, LEVELS = 3, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tree number of the tree over the sources; sources count from 0.
TOP = -1
_STEP = "struct<left:binary,right:binary>"


def digest(*values: Column, null: str = "-") -> Column:
    """SHA-256 in hex of values, each with its UTF-8 length before it, or the mark of null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")), F.lit(":"), v.cast("string")), F.lit(null)) for v in values]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, *order: str, name: str = "nth") -> DataFrame:
    """Rows with their place, from 0, in ascending order over the whole table, without a task that sees them all."""
    placed = checkpointed(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, before = F.shiftright("__at", 33), 0
    offsets = []
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        offsets.append((row["part"], before))
        before += row["count"]
    starts = placed.sparkSession.createDataFrame(offsets, "__part long, __before long")
    joined = placed.join(F.broadcast(starts), part == F.col("__part"))
    return joined.withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at", "__part", "__before")


def _left(level: int) -> Column:
    """Nodes of a tree of ``n`` leaves at a level."""
    return F.expr(f"(n + {FANOUT**level - 1}L) div {FANOUT**level}L")


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda k: F.sha2(F.array_join(F.slice(nodes, k * FANOUT + 1, F.lit(FANOUT)), ""), 256))


def _siblings(nodes: Column, level: int, first: Column) -> Column:
    """Per node of a block at one level: its level, place and the digests left and right of it in its run."""

    def entry(_: Column, place: Column) -> Column:
        at = place % FANOUT
        left = F.array_join(F.slice(nodes, place - at + 1, at), "")
        right = F.array_join(F.slice(nodes, place + 2, F.lit(FANOUT - 1) - at), "")
        way = F.struct(F.unhex(left).alias("left"), F.unhex(right).alias("right"))
        return F.struct(F.lit(level).alias("level"), (first + place).alias("idx"), (_left(level + 1) == 1).alias("below_root"), way.alias("way"))

    return F.transform(nodes, entry)


def climb(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From leaves (tree, n, idx, digest): nodes (tree, level, idx, below_root, way) below the roots, and roots (tree, digest)."""
    most = leaves.agg(F.max("n")).head()[0] or 1
    nodes, roots, rows, level, block = [], [], leaves, 0, FANOUT**LEVELS
    while True:
        ordered = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        blocks = rows.groupBy("tree", "n", F.expr(f"idx div {block}L").alias("block")).agg(F.transform(ordered, lambda node: node["digest"]).alias("d0"))
        for k in range(LEVELS):
            blocks = blocks.withColumn(f"d{k + 1}", F.when(_left(level + k) > 1, _parents(F.col(f"d{k}"))))
        blocks = checkpointed(blocks)
        entries = [_siblings(F.col(f"d{k}"), level + k, F.col("block") * FANOUT ** (LEVELS - k)) for k in range(LEVELS)]
        kept = [F.when(_left(level + k) > 1, entries[k]).otherwise(F.slice(entries[k], 1, 0)) for k in range(LEVELS)]
        kept[1:] = [F.coalesce(entry, F.slice(entries[0], 1, 0)) for entry in kept[1:]]
        nodes.append(blocks.select("tree", F.explode(F.concat(*kept)).alias("node")).select("tree", "node.*"))
        last = F.coalesce(*[F.when(_left(level + k) == 1, F.col(f"d{k}")[0]) for k in range(LEVELS + 1)])
        roots.append(blocks.where(_left(level + LEVELS) == 1).select("tree", last.alias("digest")))
        level += LEVELS
        if most <= FANOUT**level:
            break
        rows = blocks.where(_left(level) > 1).select("tree", "n", F.col("block").alias("idx"), F.col(f"d{LEVELS}")[0].alias("digest"))
    for more_nodes, more_roots in zip(nodes[1:], roots[1:]):
        nodes[0], roots[0] = nodes[0].unionAll(more_nodes), roots[0].unionAll(more_roots)
    return nodes[0], roots[0]


def height(n: int) -> int:
    levels = 0
    while FANOUT**levels < n:
        levels += 1
    return levels


def _pointers(nodes: DataFrame, above: Column) -> DataFrame:
    """Nodes with a pointer one level up (``above`` where the tree's root is there) and the siblings on the way."""
    parent = F.struct("tree", (F.col("level") + 1).alias("level"), F.expr(f"idx div {FANOUT}L").alias("idx"))
    return nodes.select("tree", "level", "idx", F.when(F.col("below_root"), above).otherwise(parent).alias("up"), F.array("way").alias("way"))


def _jump(walkers: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each walker's pointer replaced by that of the node it points at, and its way lengthened by that node's."""
    further = nodes.select(F.struct("tree", "level", "idx").alias("up"), F.col("up").alias("__up"), F.col("way").alias("__way"))
    joined = walkers.join(further, "up", "left")
    way = F.when(F.col("__way").isNull(), F.col("way")).otherwise(F.concat("way", "__way"))
    return joined.select(*[c for c in walkers.columns if c not in ("up", "way")], F.col("__up").alias("up"), way.alias("way"))


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: id, source, leaf, subroot, root, proof (sibling digests left and right of the way, from the leaf to the root).

    ``docs`` may bring a column ``__kept`` that is passed on as ``kept``.
    """
    kept = [F.col("__kept").alias("kept")] if "__kept" in docs.columns else []
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), digest(*[F.col(f) for f in fields]).alias("leaf"), *kept)
    placed = numbered(slim, "source", "id", "leaf")
    sources = placed.groupBy("source").agg(F.count("*").alias("n"), F.min("nth").alias("start"))
    sources = numbered(sources, "start", name="tree").select("source", "n", "start", "tree")
    same = placed["source"].eqNullSafe(sources["source"])
    leaves = placed.join(sources, same).select(placed["*"], "n", "tree", (F.col("nth") - F.col("start")).alias("idx"))

    nodes, subroots = climb(leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")))
    subroots = checkpointed(subroots)
    shape = sources.agg(F.count("*").alias("n"), F.max("n").alias("most")).head()
    top_leaves = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(shape["n"]).alias("n"), F.col("tree").alias("idx"), "digest")
    top_nodes, roots = climb(top_leaves)
    root = roots.head()

    place = lambda tree, level, idx: F.struct(tree.cast("long").alias("tree"), F.lit(level).alias("level"), idx.cast("long").alias("idx"))
    subroot = place(F.lit(TOP), 0, F.col("tree"))
    everywhere = _pointers(nodes, subroot).unionAll(_pointers(top_nodes, F.lit(None).cast("struct<tree:bigint,level:int,idx:bigint>")))
    everywhere = checkpointed(everywhere)
    # a leaf that is its source's subroot starts in the tree over the sources
    start = F.when(F.col("n") == 1, subroot).otherwise(place(F.col("tree"), 0, F.col("idx")))
    walkers = leaves.select("id", "source", "leaf", *["kept"] * len(kept), "tree", start.alias("up"), F.array().cast(f"array<{_STEP}>").alias("way"))
    walkers = _jump(walkers, everywhere)
    ancestors, walked = everywhere.where(f"level > 0 OR tree = {TOP}"), 1
    while walked < height(shape["most"] or 1) + height(shape["n"] or 1):
        walkers = _jump(walkers, ancestors)
        walked *= 2
        ancestors = checkpointed(_jump(ancestors.where(f"tree = {TOP} OR level % {walked} = 0"), ancestors))
    subroots = subroots.withColumnRenamed("digest", "subroot")
    proven = walkers.join(subroots, "tree").withColumn("root", F.lit(root["digest"] if root else None))
    return proven.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "leaf", "subroot", "root", F.col("way").alias("proof"), *["kept"] * len(kept))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.lower(F.hex(F.concat(step["left"], step["right"])))), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(below: Column, step: Column) -> Column:
        return F.sha2(F.concat(F.lower(F.hex(step["left"])), below, F.lower(F.hex(step["right"]))), 256)

    return F.aggregate(proof, leaf, up)


def tampered_text(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, without its line ends where 2 divides the CRC-32 of the id in decimal digits (rows without an id stay)."""
    chosen = F.crc32(F.col(id_col).cast("string")) % 2 == 0
    return F.when(chosen, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))


def tamper_check(docs: DataFrame) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, and what the tampered row folds to with the proof of the original."""
    fields = [tampered_text() if name == "text" else F.col(name) for name in FIELDS]
    proven = manifest(docs.withColumn("__kept", digest(*fields)))
    root = folded(F.col("kept"), F.col("proof"))
    shown = proven.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), root.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
