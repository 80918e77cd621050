"""Merkle manifest of a dataset, in DataFrame expressions only.

Rows are leaves; each group (a source) is a tree of runs of 16 nodes, and the groups' roots are the leaves of one more tree.  Leaves get
their place by ranges and counts per range, so a group of any size is never in one task.  Blocks of 256 places are ordered arrays that
two levels of ``sequence``, ``transform`` and ``slice`` collapse at once, kept by ``aggregate``; the blocks' tops are the nodes of
the next round, so the rounds are the logarithm of the largest group's size.  A leaf's proof is the siblings inside its block, joined
with the proof of its block's top and that of its group's root: no row carries more of the tree than its own path.

Defined results: a null field is ``-``; a null group is a group of its own before all others; a null order value comes first, and its
decimal text counts as empty; rows of equal order value go by their leaf, so repeated rows are leaves side by side; very long texts
are hashed whole; an empty table gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, crc_mod, drop_tables, materialise, small

RUN, HEIGHT = 16, 2
BLOCK = RUN**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A proof holds at most 15 digests a level, under 1 KB, and a tree of 10^12 leaves has ten levels: 8,000 proofs are below 80 MB.
BROADCAST_PROOFS = 8_000
PROOF = "array<struct<left: string, right: string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(*fields: Column) -> Column:
    """The digest of the fields, each with its length in bytes before it."""
    sized = lambda s: F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(F.concat(*[sized(f.cast("string")) for f in fields]))


def collapse(nodes: Column) -> Column:
    """The level above: a digest for each run of 16 neighbours."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / RUN).cast("int") - 1)
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * RUN + 1, RUN), "")))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, int, list[DataFrame]]:
    """``rows`` with ``pos`` (place in the group, from 0) and ``total`` (rows of the group); the largest total; working tables.

    Ranges are counted and their counts added up; a group has at most one count a range, so the window over them stays small.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    # Written with its numbers: a task that runs again after this must not number anew.
    placed = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), f"{name}-placed").withColumn("_part", F.shiftright("_at", 33))
    w = Window.partitionBy(group)
    counts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = materialise(counts.select(group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("total")), f"{name}-counts")
    most = counts.agg(F.max("total")).first()[0] or 0
    out = placed.join(small(counts), [group, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
    return out, most, [placed, counts]


def climb(nodes: DataFrame, payload: list[str], most: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Blocks of the trees over ``nodes`` (g, pos, total, node and ``payload``): g, block, members, levels, up (the proof of its top) and root."""
    height = F.when(F.col("total") == 1, 0).when(F.col("total") <= RUN, 1).otherwise(HEIGHT)
    blocks = nodes.groupBy("g", "total", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "node", *payload))).alias("members"))
    leaves = F.array(F.transform("members", lambda m: m["node"]))
    levels = F.aggregate(F.slice(F.sequence(F.lit(1), F.lit(HEIGHT)), 1, height), leaves, lambda below, _: F.concat(below, F.array(collapse(F.element_at(below, -1)))))
    blocks = materialise(blocks.withColumn("levels", levels), f"{name}-blocks")
    top, working = F.element_at(F.element_at("levels", -1), 1), [blocks]
    if most <= BLOCK:
        return blocks.withColumns({"up": F.array().cast(PROOF), "root": top}), working
    tops = blocks.where(F.col("total") > BLOCK).select("g", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).alias("total"), top.alias("node"))
    above, more = climb(tops, [], -(-most // BLOCK), name)
    ups = materialise(unfold(above, lambda m, proof: F.struct(m["pos"].alias("block"), proof.alias("up")), "g", "root"), f"{name}-proofs")
    joined = blocks.join(small(ups, BROADCAST_PROOFS), ["g", "block"], "left")
    return joined.withColumns({"up": F.coalesce("up", F.array().cast(PROOF)), "root": F.coalesce("root", top)}), [*working, *more, ups]


def proof_of(i: Column) -> Column:
    """The siblings, left and right, of a block's member ``i`` at each level of the block, and those above."""

    def siblings(nodes: Column, k: Column) -> Column:
        at = F.floor(i / F.pow(F.lit(RUN), k)).cast("int")
        some = lambda start, n: F.array_join(F.slice(nodes, start, n), "")
        return F.struct(some(at - at % RUN + 1, at % RUN).alias("left"), some(at + 2, RUN - 1 - at % RUN).alias("right"))

    inside = F.slice("levels", 1, F.size("levels") - 1)
    return F.concat(F.transform(inside, siblings), F.col("up"))


def unfold(blocks: DataFrame, view: Callable[[Column, Column], Column], *keep: str) -> DataFrame:
    """A row for each member: ``keep``, and the fields of ``view(member, proof)``."""
    once = lambda m, i: F.get(F.transform(F.array(proof_of(i)), lambda proof: view(m, proof)), F.lit(0))
    # Outer: else Spark would compute the array a second time in a filter on its size.
    return blocks.select(*keep, F.inline_outer(F.transform("members", once)))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, start, lambda below, s: digest(F.concat(s["left"], below, s["right"])))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(rows: DataFrame, payload: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """The forest of ``rows`` (g: group, '' before all others; id: order; node: leaf; ``payload``): blocks with subroot, root and full ``up``."""
    placed, most, working = numbered(rows, "g", ["id", "node"], "merkle")
    blocks, more = climb(placed, ["id", *payload], most, "merkle")
    roots = materialise(blocks.where("block = 0").select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("root").alias("node")), "merkle-subroots")
    placed, most, some = numbered(roots, "g", ["key"], "merkle-top")
    tops, others = climb(placed, ["key"], most, "merkle-top")
    view = lambda m, proof: F.struct(m["key"].alias("g"), m["node"].alias("subroot"), proof.alias("above"))
    tops = materialise(unfold(tops, view, F.col("root").alias("whole")), "merkle-tops")
    joined = blocks.join(small(tops, BROADCAST_PROOFS), "g").select("g", "members", "levels", F.concat("up", "above").alias("up"), "subroot", F.col("whole").alias("root"))
    return joined, [*working, *more, roots, *some, *others, tops]


def documents_manifest(docs: DataFrame, view: Callable[[Column, Column], Column], *, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id", also: dict[str, Column] | None = None) -> DataFrame:
    """A row for each document: subroot, root and the fields of ``view(member, proof)``.

    ``member`` has id (the order value), node (the leaf) and ``also`` (columns made of the document); ``proof`` is an array of the left
    and right siblings, from the leaf's level up.
    """
    also = also or {}
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(key.alias("g"), F.col(order).alias("id"), leaf(*[F.col(f) for f in fields]).alias("node"), *[c.alias(n) for n, c in also.items()])
    rows = materialise(rows, "merkle-leaves")
    blocks, working = manifest(rows, list(also))
    out = materialise(unfold(blocks, view, "subroot", "root"), "merkle-rows")
    drop_tables(rows, *working)
    return out


def proofs(docs: DataFrame, **how) -> DataFrame:
    """The manifest with whole proofs: id, leaf, proof, subroot, root."""
    return documents_manifest(docs, lambda m, proof: F.struct(m["id"], m["node"].alias("leaf"), proof.alias("proof")), **how)


def tamper_check(docs: DataFrame) -> DataFrame:
    """Each document's leaf, digest of its proof, and whether it verifies after texts of ids whose crc32 5 divides were lower-cased."""
    changed = [ascii_lower(F.col("text").cast("string")) if f == "text" else F.col(f) for f in FIELDS]
    tampered = F.when(crc_mod(F.col("doc_id"), 5) == 0, leaf(*changed))

    def view(m: Column, proof: Column) -> Column:
        return F.struct(m["id"].alias("doc_id"), m["node"].alias("leaf"), proof_digest(proof).alias("proof_sha256"), fold(F.coalesce(m["tampered"], m["node"]), proof).alias("folded_root"))

    out = documents_manifest(docs, view, also={"tampered": tampered})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
