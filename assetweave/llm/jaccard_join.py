"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Texts become sets of word n-grams.  The global order sorts n-grams by the number of texts that hold them (then by
hash); an n-gram of a single text can be in no overlap, so it only counts for a set's size.  The order is cut
into fragments.  Candidate pairs share a rare n-gram of their prefixes and pass a length filter and a
symmetric-difference bound (both lose nothing); their overlaps are counted fragment by fragment, each on its own, and
summed for the pair; the exact sum decides.

Only the components are asked for, so no group is expanded into all its pairs: equal sets are one class; then, round
after round, each n-gram's texts are compared with one hub text, until a round joins next to nothing; only texts that are still in
different components and pass all bounds are compared among themselves.  The hub is the text with the fewest n-grams of its own,
which in a group of copies is the one nearest to what they were copied from.

A set's identity is a 128-bit sum over its n-grams; an n-gram is a 64-bit hash.

Defined results: null or empty texts have an empty set and link with nothing; very long texts are whole sets like others; equal
texts and repeated rows are one class; ties in the global order go to the smaller hash; a null ``doc_id`` takes no part and has
no component; rows that repeat a ``doc_id`` are one vertex, with the links of all its texts; an empty table gives an empty
table; columns other than ``doc_id`` and ``text`` are not looked at, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keycount as K
from .common import drop_tables, materialise, small

SKETCH_WORDS = 16
#: Lower ends of the fragments of the global order, as (document frequency, half of the hash range).
FRAGMENTS = ((2, 0), (2, 1), (3, 0), (4, 0), (6, 0), (9, 0), (17, 0), (65, 0))
LIST_BLOCK = 2048
#: Rounds of one hub for each list at most, before what is left is compared pair by pair.  A round that joins less than one in
#: ``WORTH`` of the classes in its lists is the last.  Neither can change a result.
HUB_ROUNDS, WORTH = 6, 200


def shingle_sets(lens: np.ndarray, vocab: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text of a block, sorted by (text, hash): hashes and the texts' numbers.

    A shorter text that has words is one n-gram as a whole.
    """
    word = vocab[ids] if len(ids) else np.zeros(0, "u8")
    ends = np.cumsum(lens)
    starts = ends - lens
    doc = np.repeat(np.arange(len(lens)), lens)
    powers = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(n)]
    full = np.flatnonzero(ends[doc] - np.arange(len(word)) >= n) if len(word) else np.zeros(0, "i8")
    h = np.zeros(len(full), "u8")
    for k in range(n):
        h += word[full + k] * powers[k]
    h, d = K.mix(h), doc[full]
    short = np.flatnonzero((lens > 0) & (lens < n))
    if len(short):
        whole = []
        for s in short:
            own = word[starts[s] : ends[s]]
            whole.append((own * np.array(powers[: len(own)], "u8")).sum(dtype="u8") + np.uint64(lens[s] * 0x51ED27))
        h, d = np.concatenate([h, K.mix(np.array(whole, "u8"))]), np.concatenate([d, short])
    order = np.argsort(h)
    order = order[np.argsort(d[order], kind="stable")]
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]


def _distinct_texts(lens: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Marks the first of equal texts in a block."""
    seen, out, at = set(), np.zeros(len(lens), bool), 0
    raw = ids.astype("<u4")
    for i, n in enumerate(lens.tolist()):
        k = xxhash.xxh3_64_intdigest(raw[at : at + n].tobytes())
        at += n
        out[i] = k not in seen
        seen.add(k)
    return out


def _frequency_keys(n: int, bits: int):
    shift = np.uint64(64 - bits)

    def keys(row: dict) -> dict:
        _, lens, vocab, ids = K.block_arrays(row)
        h, d = shingle_sets(lens, vocab, ids, n)
        h = h[_distinct_texts(lens, ids)[d]]
        k, c = np.unique(h >> shift, return_counts=True)
        return {"df": (k << shift, [c])}

    return keys


#: Bounds what a task holds of texts and n-grams at once.
BLOCK_TOKENS = 1_000_000
PROFILE = "doc_id long, set_id binary, n long, alone long, sketch array<long>, prefix array<long>, segments array<array<long>>"
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("i4"))


def _lists(ok: np.ndarray, counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list for each text, null where it isn't ``ok``; ``counts`` and ``values`` are those of the others."""
    every = np.zeros(len(ok), "i8")
    every[ok] = counts
    return pa.ListArray.from_arrays(_offsets(every), values, mask=pa.array(~ok))


def _sketches(h: np.ndarray, text: np.ndarray, n: int, at_once: int = 2048) -> np.ndarray:
    """For each of ``n`` texts, whether an odd number of its n-grams fall on each bit, as words of 64 bits."""
    bits, out = SKETCH_WORDS * 64, []
    bit = (h % np.uint64(bits)).astype("i8")
    for lo in range(0, n, at_once):
        hi = min(n, lo + at_once)
        i, j = np.searchsorted(text, [lo, hi])
        odd = (np.bincount((text[i:j] - lo) * bits + bit[i:j], minlength=(hi - lo) * bits) & 1).astype("u1")
        out.append(np.packbits(odd, bitorder="little").view("<i8"))
    return np.concatenate(out) if out else np.zeros(0, "<i8")


def _set_ids(h: np.ndarray, first: np.ndarray, ends: np.ndarray) -> pa.Array:
    """16 bytes for each text's set: two sums of differently mixed hashes."""
    halves = []
    for x in (K.mix(h), K.mix(h ^ SECOND)):
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(x, dtype="u8")])
        halves.append(sums[ends] - sums[first])
    raw = np.column_stack(halves).astype(">u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(ends), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _profiles(n: int, percent: int, bits: int):
    """For each text: the size of its set, how many of its n-grams no other text has, its parity sketch, its prefix and its segments of shared n-grams."""
    shift = np.uint64(64 - bits)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], K.Answers(right)
        for row in left.to_pylist():
            doc_ids, lens, vocab, ids = K.block_arrays(row)
            h, d = shingle_sets(lens, vocab, ids, n)
            distinct = _distinct_texts(lens, ids)
            keys = np.unique(h[distinct[d]] >> shift)
            (df,) = told.counts("df", 1)
            f = df[np.searchsorted(keys, h >> shift)].astype("i8")
            size = np.bincount(d, minlength=len(lens))
            order = np.argsort(h)
            order = order[np.argsort(f[order], kind="stable")]
            order = order[np.argsort(d[order], kind="stable")]
            h, f, d = h[order], f[order], d[order]
            ends = np.cumsum(size)
            first = ends - size
            place = np.arange(len(h)) - first[d]
            need = -(-percent * size // 100)
            in_prefix = (f > 1) & (place < (size - need + 1)[d])
            frag = np.searchsorted([a * 2 + b for a, b in FRAGMENTS], f * 2 + np.where(f == 2, (h >> np.uint64(63)).astype("i8"), 0), side="right") - 1
            known = np.array([i is not None for i in doc_ids], bool)
            ok = known & (np.bincount(d[in_prefix], minlength=len(lens)) > 0)
            signed, mine, rank, n_ok = h.view("i8"), ok[d], np.cumsum(ok) - 1, int(ok.sum())
            # In this order the fragments of a text lie one behind the other.
            shared = mine & (f > 1)
            inner = np.bincount(rank[d[shared]] * len(FRAGMENTS) + frag[shared], minlength=n_ok * len(FRAGMENTS))
            parts = pa.ListArray.from_arrays(_offsets(inner), pa.array(signed[shared]))
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "set_id": _set_ids(h, first, ends),
                        "n": pa.array(size.astype("i8")),
                        "alone": pa.array(np.bincount(d[f <= 1], minlength=len(lens)).astype("i8")),
                        "sketch": _lists(ok, np.full(n_ok, SKETCH_WORDS), pa.array(_sketches(h[mine], rank[d[mine]], n_ok))),
                        "prefix": _lists(ok, np.bincount(rank[d[mine & in_prefix]], minlength=n_ok), pa.array(signed[mine & in_prefix])),
                        "segments": _lists(ok, np.full(n_ok, len(FRAGMENTS)), parts),
                    }
                )
            )
        return pa.concat_tables(out)

    return run


def may_link(percent: int, a: str = "a", b: str = "b") -> Column:
    """Bounds that keep every link of sides a and b: on the lengths, on what each side could share at all, and on the symmetric difference of their parity sketches."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(na - F.col(f"{a}.alone"), nb - F.col(f"{b}.alone"))
    word = lambda i: F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i]))
    differ = sum((word(i) for i in range(1, SKETCH_WORDS)), word(0))
    return (most * (100 + percent) >= (na + nb) * percent) & (differ * (100 + percent) <= (na + nb) * (100 - percent))


def verify(pairs: DataFrame, profiles: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link: partial overlaps for each fragment, summed for the pair.

    Only the segments of classes that are in some pair are moved, once for a class.
    """
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct().join(classes, "set_id").select("set_id", F.col("class_id").alias("doc_id"))
    mine = profiles.where(F.col("prefix").isNotNull()).select("doc_id", "set_id", "n", "segments").join(wanted, ["doc_id", "set_id"], "left_semi").dropDuplicates(["set_id"])
    seg = materialise(mine.select(F.col("set_id").alias("node"), "n", F.posexplode("segments").alias("fragment", "segment")).where(F.size("segment") > 0), "segments")
    left = seg.select(F.col("node").alias("a"), F.col("n").alias("na"), "fragment", F.col("segment").alias("sa"))
    right = seg.select(F.col("node").alias("b"), F.col("n").alias("nb"), "fragment", F.col("segment").alias("sb"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("overlap"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    return total.where(F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * percent).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that can be reached over ``edges`` (a, b); labels spread and jump until none changes."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    label = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), name)
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = label.join(near, "node").select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        jump = label.select(F.col("node").alias("to"), F.col("component").alias("further"))
        new = materialise(step.join(jump, "to", "left").select("node", F.least("to", F.coalesce("further", "to")).alias("component"), "was"), name)
        changed = new.where(F.col("component") != F.col("was")).limit(1).count()
        label = new.select("node", "component")
        if not changed:
            return label


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """For each doc_id: n_shingles, class_id (smallest id with the same set) and component_id.

    Two texts link if 100 * overlap >= percent * union of their sets of word n-grams.
    """
    blocks = materialise(K.token_blocks(docs, BLOCK_TOKENS), "blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    bits = min(64, max(32, int(total).bit_length() + 9))
    asked = K.ask(blocks, _frequency_keys(n, bits), K.shards_for(total))
    told = K.answers(asked)
    profiles = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_profiles(n, percent, bits), PROFILE)
    profiles = materialise(profiles, "profiles")
    drop_tables(blocks)
    members = profiles.select("doc_id", "set_id", "n").where("n > 0 and doc_id is not null")
    classes = materialise(members.groupBy("set_id").agg(F.min("doc_id").alias("class_id")), "classes")
    own = classes.select("set_id", F.col("class_id").alias("doc_id"))
    lead = profiles.where(F.col("prefix").isNotNull()).join(own, ["doc_id", "set_id"], "left_semi").select(F.col("set_id").alias("node"), "n", "alone", "sketch", "prefix").dropDuplicates(["node"])
    lead = materialise(lead, "leads")
    bounds = lead.select("node", F.struct("n", "alone", "sketch").alias("side"))
    posts = lead.select("node", "alone", F.explode("prefix").alias("shingle"))
    side = lambda name: bounds.select(F.col("node").alias(name), F.col("side").alias(f"s{name}"))

    lists = posts.groupBy("shingle").agg(F.count("*").alias("size")).where("size > 1")
    member = materialise(posts.join(lists, "shingle").select("shingle", "size", "node", "alone", F.col("node").alias("component"), F.lit(False).alias("used")), "members")
    links = label = None
    for _ in range(HUB_ROUNDS):
        # A hub for each list that has several components: the least of those that were none before.
        hubs = member.where(~F.col("used")).groupBy("shingle").agg(F.min(F.struct("alone", "node", "component")).alias("hub"))
        star = member.join(hubs, "shingle").where(F.col("component") != F.col("hub.component")).select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
        star = star.join(side("a"), "a").join(side("b"), "b").where(may_link(percent, "sa", "sb"))
        tried = materialise(star.select("a", "b"), "star-pairs")
        if tried.isEmpty():
            break
        found = materialise(verify(tried, profiles, classes, percent), "star-links")
        links = found if links is None else links.union(found)
        label = components(links, "star-components")
        # What shares a prefix n-gram and is not in one component yet.
        marked = member.join(hubs.select("shingle", F.col("hub.node").alias("hub")), "shingle", "left").join(label.withColumnRenamed("component", "now"), "node", "left")
        marked = marked.select("shingle", "size", "node", "alone", F.coalesce("now", "node").alias("component"), F.coalesce(F.col("used") | (F.col("node") == F.col("hub")), F.col("used")).alias("used"))
        still = marked.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle")
        there, joined = member.select("node").distinct().count(), found.count()
        before, member = member, materialise(marked.join(still, "shingle"), "members")
        drop_tables(before, tried)
        if joined * WORTH < there:
            break
    parts = F.ceil(F.col("size") / LIST_BLOCK).cast("int")
    open_posts = materialise(member.select("node", "shingle", "component", parts.alias("parts")).join(bounds, "node"), "open-posts")
    drop_tables(member)
    left = open_posts.withColumn("part", F.pmod(F.hash("node"), F.col("parts")))
    right = open_posts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    same_list = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.node") < F.col("b.node"))
    cross = left.alias("a").join(right.alias("b"), same_list & (F.col("a.component") != F.col("b.component")) & may_link(percent, "a.side", "b.side"))
    more = materialise(cross.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "cross-pairs")
    drop_tables(open_posts)
    # Texts that share a doc_id are one vertex.
    several = members.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("hi")).where("a < hi").select("doc_id", "a")
    same_id = members.join(several, "doc_id").select("a", F.col("set_id").alias("b")).where("a != b")
    more = [t for t in (more, same_id) if not t.isEmpty()]
    if more:
        rest = [verify(t, profiles, classes, percent) if t is not same_id else t for t in more]
        links = materialise(reduce(DataFrame.union, rest if links is None else [links, *rest]), "links")
        label = components(links)
    if label is None:
        label = classes.select(F.col("set_id").alias("node"), F.col("set_id").alias("component"))

    placed = classes.join(label.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    named = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    of_class = materialise(placed.join(named, "component").select("set_id", "class_id", "component_id"), "class-components")
    own_set = F.when(F.col("n") > 0, F.col("set_id"))
    out = profiles.select("doc_id", "n", own_set.alias("set_id")).join(of_class, "set_id", "left")
    out = out.groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("class_id").alias("class_id"), F.min("component_id").alias("component_id"))
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", "n_shingles", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"), F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the rows of one ``doc_id`` of each component: the id that names it (all its rows, if it repeats).  Rows without an id all stay."""
    gone = jaccard_components(docs.select("doc_id", "text"), n, percent).where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    # An anti-join: rows without an id match nothing and stay.
    return docs.join(small(materialise(gone, "near-copies")), "doc_id", "left_anti").select(*docs.columns)
