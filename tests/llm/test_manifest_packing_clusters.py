"""The Merkle manifest, harmonic packing and centroid clustering against plain versions, and the cases that their docstrings define."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from assetweave.llm import byte_pairs, harmonic_packing, merkle_manifest, queries, sql, yinyang_clusters

from .brute import UP

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, g string, pos long, members string, ids string"
LONG = " ".join(f"Word{i % 97}" for i in range(30_000))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """Root of a list of digests and, for each, its proof as (left, right) by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            lo = p - p % 16
            proofs[i].append(("".join(nodes[lo:p]), "".join(nodes[p + 1 : lo + 16])))
            at[i] = p // 16
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0] if nodes else None, proofs


def brute_manifest(rows):
    """A sorted list of the query's rows; ``rows``: (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in r))
    groups = defaultdict(list)
    for r in rows:
        changed = leaf((*r[:4], r[4] and r[4].translate(UP))) if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0 else leaf(r)
        groups[r[1]].append((r[0], leaf(r), changed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    forest = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        forest[s] = tree([x[1] for x in groups[s]])
    root, above = tree([forest[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (i, h, changed), own in zip(groups[s], forest[s][1]):
            folded = changed
            for left, right in own + up:
                folded = sha(left + folded + right)
            out.append((i, h, forest[s][0], root, sha("".join(a + b for a, b in own + up)), folded, folded == root))
    return sorted(map(repr, out))


COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_rows(df):
    return sorted(repr(tuple(r[c] for c in COLS)) for r in df.collect())


def edge_docs(n=700):
    rng = random.Random(5)
    rows = [(i, f"Text {i} ÄB\n{rng.random()}" if i % 7 else None, rng.choice(["en", None]), None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 20}", i) for i in range(n)]
    rows += [(None, "A", None, "hot", None), (None, None, None, None, None), (3, "Twice", "en", "hot", 1), (3, "Twice", "en", "hot", 1), (3, "Other", "en", "hot", 1)]
    return [*rows, (10_000, LONG, "en", "alone", len(LONG)), (10_001, "", "", "", 0), (10_002, "x", "en", "ü", 0), (10_003, "x", "en", "\U0001f600", 0), (-5, "X", "en", "hot", -1)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_manifest_of_edge_rows(spark, partitions):
    docs = edge_docs()
    df = spark.createDataFrame([(*r, "clash", "clash", -1, "clash", "clash") for r in docs], DOCS).repartition(partitions)
    assert manifest_rows(merkle_manifest.tamper_check(df)) == brute_manifest([(i, s, lang, n, t) for i, t, lang, s, n in docs])


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 600])
def test_manifest_of_one_source(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("T"), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(2).alias("n_chars"))
    assert manifest_rows(merkle_manifest.tamper_check(docs)) == brute_manifest([(i, "s", "en", 2, f"T{i}") for i in range(n)])


def test_manifest_of_many_sources(spark):
    """More sources than a block holds, so that the tree of subroots has blocks of its own."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), "id").alias("source"), F.lit(2).alias("n_chars"))
    assert manifest_rows(merkle_manifest.tamper_check(docs)) == brute_manifest([(i, f"s{i}", "en", 2, "t") for i in range(300)])


def test_whole_proofs_lead_to_the_root(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for r in merkle_manifest.proofs(docs).collect():
        h = r["leaf"]
        for s in r["proof"]:
            h = sha(s["left"] + h + s["right"])
        assert h == r["root"]


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_yinyang_clusters"])
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    got = con.execute(f"select {', '.join(df.columns)} from ({sql.SQL[name]})")
    assert sorted(map(tuple, df.collect())) == sorted(got.fetchall())


def test_manifest_equals_brute_force(spark):
    docs = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert manifest_rows(queries.op11_merkle_manifest(spark, SF)) == brute_manifest(docs)


def check_packing(pieces, docs, capacity=2048, waste=0.01):
    """Each id lies in one piece; sequences are gapless, within the capacity and a power of two or nearly full; ``docs``: lists of all ids by row."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    want = defaultdict(list)
    for i, ids in docs:
        want[i, len(ids)].append(ids)
    assert by_doc.keys() == want.keys()
    for key, held in by_doc.items():
        copies = len(want[key])
        assert sum(p["length"] for p in held) == key[1] * copies
        spans = defaultdict(set)
        for p in held:
            spans[p["start"]].add(p["ids_crc32"])
            ends = {zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for ids in want[key]}
            assert p["length"] > 0 and p["ids_crc32"] in ends
        if copies == 1:
            at = 0
            for p in sorted(held, key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
            assert at == key[1]
    pads = total = 0
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert all(p["sequence_tokens"] == at for p in held) and at <= capacity
        pad = 0 if at & (at - 1) == 0 else capacity - at
        assert pad <= 2 * waste * capacity + math.sqrt(capacity)
        pads, total = pads + pad, total + at
    assert pads <= 2 * waste * total


def encoded(rows):
    t = tokenizers.Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [1]) for i, x in rows]


def test_packing_of_all_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packing(queries.op12_harmonic_packing(spark, SF).collect(), encoded(rows))


@pytest.mark.parametrize("partitions", [1, 4])
def test_packing_of_edge_rows(spark, tmp_path, partitions):
    rows = [(1, None), (2, ""), (3, LONG), (4, "one two"), (4, "one two"), (None, "no id"), (5, "<|endoftext|> x"), (6, "word " * 2047)]
    spark.createDataFrame([(i, t, "clash", -1, "clash") for i, t in rows], "doc_id long, text string, ids string, start long, sequence_id string").repartition(partitions).write.parquet(f"file://{tmp_path}/documents.parquet")
    check_packing(queries.op12_harmonic_packing(spark, str(tmp_path)).collect(), encoded(rows))


def test_rank_encoder_gives_the_librarys_ids():
    path = queries.tokenizer_file("byte_bpe_50k.json")
    e, t = byte_pairs.RankEncoder(path), tokenizers.Tokenizer.from_file(path)
    assert e.by_rank is not None
    letters = [*map(chr, range(0x250)), *map(chr, range(0x2010, 0x203B)), "\u20ac", "\u0416", "\U0001f600", "\u4e2d", "\u3000"]
    texts = [f.format(c) for c in letters for f in ("a{0}b", "{0}", " {0} {0}  {0}{0}\n{0}", "x{0}'s{0}'{0}s", "1{0}1 {0}a\t{0}.", "  {0}a")]
    rng = random.Random(6)
    texts += ["".join(rng.choices(letters + [" "] * 60 + ["\n"] * 20, k=rng.randint(0, 40))) for _ in range(5000)]
    texts += ["", "<|endoftext|> a", "a " * 30_000, " " * 30_000 + "x", "ab" * 100_000]
    for x in texts:
        assert e.encode(x).tolist() == t.encode(x, add_special_tokens=False).ids, x[:50]
    assert byte_pairs.ranks_of(queries.tokenizer_file("word_bpe_49k.json")) is None


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_cut_covers_every_length_with_nearly_full_pieces(capacity):
    for n in range(3 * capacity):
        pieces = harmonic_packing.cut(n, capacity)
        assert sum(pieces) == n and all(0 < p <= capacity for p in pieces)
        assert all(p >= 0.99 * (capacity // (capacity // p)) for p in pieces)
        last = harmonic_packing.last_lengths(n, capacity)
        assert sum(last) == n and all(x & (x - 1) == 0 or x == capacity or x >= 0.99 * capacity for x in last)


def test_full_sequences_of_a_class_take_its_count():
    bins = harmonic_packing.Bins(2048, 0.01, 0)
    rng = random.Random(3)
    for i in range(3000):
        bins.add(i, np.zeros(rng.randint(1, 5000), "<u4"))
    for s in {p[5] for p in bins.done}:
        lengths = [p[2] for p in bins.done if p[5] == s]
        assert {2048 // n for n in lengths} == {len(lengths)}
    assert all(len(held) < j for j, held in bins.open.items())


def brute_clusters(vectors, k=40, rounds=5):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), sorted; ``vectors``: (vec_id, components)."""
    kept = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in vectors if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda v: (sha(f"2:{'' if v[0] is None else v[0]}"), v[1]))
    cs = [v[1] for v in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        held = defaultdict(list)
        for _, x in kept:
            held[near(x)[1]].append(x)
        cs = [[sum(col) // len(held[j]) for col in zip(*held[j])] if j in held else c for j, c in enumerate(cs)]
    last = [(i, *near(x)) for i, x in kept]
    inertia = defaultdict(int)
    for _, d, j in last:
        inertia[j] += d
    return sorted(map(repr, ((i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, cs[j])))) for i, d, j in last)))


CLUSTERS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def cluster_rows(df):
    return sorted(repr(tuple(r[c] for c in CLUSTERS)) for r in df.collect())


def test_clusters_equal_brute_force(spark):
    some = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(200).collect()]
    df = spark.createDataFrame(some, "vec_id long, embedding array<float>").repartition(3)
    assert cluster_rows(yinyang_clusters.clusters_with_inertia(df)) == brute_clusters(some)


def tied_vectors(n, width=2, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.randint(-width, width) / 256 for _ in range(3)] + [0.0] * 61) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ties_go_to_the_smaller_number(spark, seed):
    some = tied_vectors(250, seed=seed)
    df = spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(2)
    assert cluster_rows(yinyang_clusters.clusters_with_inertia(df)) == brute_clusters(some)


def test_bounds_skip_groups_of_far_clusters(spark):
    rng = random.Random(4)
    some = [(i, [10.0 * (i % 20 == d) + rng.random() / 8 for d in range(64)]) for i in range(400)]
    df = spark.createDataFrame(some, "vec_id long, embedding array<double>")
    out = yinyang_clusters.clusters_with_inertia(df)
    assert cluster_rows(out) == brute_clusters(some)
    assert out.agg(F.avg("scans")).first()[0] < 12  # of 24


def test_clusters_of_edge_rows(spark):
    ok = [0.5] * 64
    some = [(1, ok), (1, ok), (None, [0.25] * 64), (2, None), (3, []), (4, ok[:63]), (5, [*ok, 0.1]), (6, [None, *ok[1:]]), (7, [math.nan, *ok[1:]]), (8, [math.inf, *ok[1:]]), (9, [-200_000.0, *ok[1:]]), (10, [200_000.0, *ok[1:]])]
    df = spark.createDataFrame([(i, e, "clash", -1) for i, e in some], "vec_id long, embedding array<double>, cluster string, x long")
    assert cluster_rows(yinyang_clusters.clusters_with_inertia(df)) == brute_clusters(some)
    far = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        yinyang_clusters.clusters_with_inertia(far).collect()


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_harmonic_packing", "op13_yinyang_clusters"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], DOCS).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"file://{tmp_path}/embeddings.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).count() == 0
