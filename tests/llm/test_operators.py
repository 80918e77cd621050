"""Each operator against its brute-force version, and the edge cases that its docstring defines."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from assetweave.llm import chat_format, jaccard_join, line_dedup, lm_scoring, media_audio, queries, sentencepiece_codec, sql, token_counts, token_output, toxicity, winnowing

from . import brute as B

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, _w string, th string, class_id long, media string"
LONG = " ".join(f"word{i % 97}" for i in range(30_000))
EDGES = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "one"),
    (5, "A shared line of text here\nanother line\n\nA shared line of text here"),
    (6, "  a SHARED line of text here\t\nanother line"),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (8, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (9, LONG),
    (10, LONG + " tail"),
    (11, "naïve café \U0001f600 ▁mark  two  spaces\u00a0nbsp <|endoftext|> \x00 <s>"),
    (12, "\n"),
    (13, "one"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", -1, "clash") for i, t in EDGES], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def edge_dir(spark, edges, tmp_path_factory):
    """A folder with the edge rows as ``documents`` and items that occur in them."""
    at = tmp_path_factory.mktemp("edges")
    edges.write.parquet(f"file://{at}/documents.parquet")
    items = [(1, EDGES[6][1]), (2, "another line"), (3, ""), (4, None), (5, "never there at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{at}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{at}/labels.parquet")
    return str(at), items


def tokenizer(name):
    return queries.tokenizer_file(name)


CASES = {
    "op1_lm_scoring": (["held_out", "n_tokens", "n_known", "train_tokens", "base_score"], lambda r, i: B.lm_base(r)),
    "op2_ngram_jaccard_join": (["n_shingles", "component_id"], lambda r, i: B.jaccard(r)),
    "op4_token_counts": (["n_bytes", "n_tokens", "over_limit"], lambda r, i: B.token_counts(r, tokenizer("word_bpe_49k.json"))),
    "op5_sentencepiece": (["n_tokens", "ids_sha256", "decoded_sha256"], lambda r, i: B.sentencepiece(r, tokenizer("piece_bpe_32k.model"))),
    "op6_token_files": (["start", "n_tokens", "ids_crc32"], lambda r, i: B.token_files(r, tokenizer("byte_bpe_50k.json"))),
    "op7_media_columns": (["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32"], lambda r, i: B.media(r)),
    "op9_line_dedup": (["n_lines", "n_dropped", "kept_sha256"], lambda r, i: B.line_dedup(r)),
    "op10_benchmark_decontamination": (["n_words", "n_hit", "n_items", "items_sha256", "contaminated"], B.contamination),
}


def same(got, want):
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert all(x == pytest.approx(y, rel=1e-9) if isinstance(y, float) else x == y for x, y in zip(got[k], w, strict=True)), (k, got[k], w)


def result(spark, name, at):
    cols = CASES[name][0]
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in queries.queries()[name](spark, at).collect()}


@pytest.mark.parametrize("name", CASES)
def test_query_equals_brute_force(spark, rows, name):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    same(result(spark, name, SF), CASES[name][1](rows, items))


@pytest.mark.parametrize("name", CASES)
def test_query_on_edge_rows(spark, edge_dir, name):
    at, items = edge_dir
    same(result(spark, name, at), CASES[name][1](EDGES, items))


@pytest.mark.parametrize("name", [n for n in sql.SQL if n in CASES])
@pytest.mark.parametrize("edge", [False, True])
def test_sql_twin(spark, rows, edge_dir, name, edge):
    at, items = edge_dir if edge else (SF, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    con, cols = duckdb.connect(), CASES[name][0]
    for table in ("documents", "benchmark"):
        files = f"{at}/{table}.parquet" + "/*.parquet" * edge
        con.execute(f"create view {table} as select * from '{files}'")
    got = con.execute(f"select doc_id, {', '.join(cols)} from ({sql.SQL[name]})").fetchall()
    same({r[0]: r[1:] for r in got}, CASES[name][1](EDGES if edge else rows, items))


@pytest.mark.parametrize("name", [*CASES, "op3_toxicity"])
def test_query_on_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).count() == 0


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "x y z"), (2, "p q r s t")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in jaccard_join.jaccard_components(docs, 4, 85).collect()}
    assert out[None]["component_id"] is None and out[1]["component_id"] == 1 and out[2]["component_id"] == 2
    assert jaccard_join.keep_one(docs).count() == 5
    assert line_dedup.dedup_lines(docs).count() == 5


def test_lm_scores_beat_unigrams_on_held_out(spark):
    held = queries.op1_lm_scoring(spark, SF).where("held_out").toPandas()
    assert (held.score < 0).all() and held.score.sum() > held.base_score.sum()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_equal_brute_force(spark, rows, order):
    some = rows[:120] + EDGES[:8]
    some = [(i, t) for i, (_, t) in enumerate(some)]
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs, order).collect()}
    want = B.lm_scores(some, order)
    assert got.keys() == want.keys()
    for i, x in want.items():
        assert got[i] == pytest.approx(x, rel=1e-6), i


def test_lm_mixture_sums_to_one():
    """Over all words after any context, seen or not, together with one unknown word."""
    words = {"a": 6, "b": 3, None: 1}
    texts, tokens, types = 1, 10, len(words)
    weights = lm_scoring.next_weights(np.random.default_rng(1).random((4 * lm_scoring.BUCKETS, 4)) * (lm_scoring.start_weights(3) > 0), 3)
    follow = {"seen": {"a": 4, "b": 2}, "never": {}}
    for context, after in follow.items():
        total = 0.0
        for w in [*words, "unknown"]:
            # Two tokens: the context's word, then w; their counts as a block would be told.
            c1 = np.array([sum(after.values()), words.get(w, 0)])
            c2, c3 = np.array([1, after.get(w, 0)]), np.array([1, after.get(w, 0)])
            c2[0] = c1[0] if c1[0] else 0
            which, f = lm_scoring.estimates({1: c1, 2: c2, 3: c3}, np.array([True, False]), tokens, texts, types)
            total += float((f * weights[which]).sum(axis=1)[1])
        assert total == pytest.approx(1.0), context


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op3_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    bad, good = scored[scored.toxic == 1].score, scored[scored.toxic == 0].score
    assert np.mean([(b > good).mean() + (b == good).mean() / 2 for b in bad]) > 0.85
    assert (good >= 0.7).mean() < 0.03


def test_toxicity_clauses():
    m = toxicity.Matcher(toxicity.Grammar())
    assert m.score("You are an idiot.") > m.score("She said: you called me an idiot.") > m.score("A fine day.")
    assert m.score("You are not an idiot.") < m.score("You are an idiot.")
    assert m.score(None) == m.score("")


def test_toxicity_fit_does_not_depend_on_partitions(spark):
    name = lambda i: chr(97 + i % 26) + chr(97 + i // 26)
    clean = [(i, f"the weather in {name(i)} was fine and quiet", 0) for i in range(300)]
    toxic = [(1000 + i, f"you are {name(i)} zorgle really", 1) for i in range(60)]
    copies = [(2000 + i, "what other zorgle folk and quiet fine company of them", 1) for i in range(600)] + [(3000 + i, "a fine frumple of quiet weather", 0) for i in range(600)]
    once = [(2000, copies[0][1], 1), (3000, copies[600][1], 0), (3001, copies[600][1], 0), (2001, copies[0][1], 1)]

    def model(rows, parts):
        docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(parts, "doc_id")
        g = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
        return g.words, g.stems, g.suspects, g.suspect_stems, g.weights.tolist(), g.bias, g.rows

    one = model(clean + toxic + copies, 1)
    assert "zorgle" in one[0]
    assert one == model(clean + toxic + copies, 50) == model(clean + toxic + once, 3)


def test_toxicity_without_labels(spark, edge_dir):
    assert queries.op3_toxicity(spark, edge_dir[0]).where("score is null or score < 0 or score > 1").count() == 0


def test_chat_costs_and_parts(spark):
    roles = ["user", "user", "assistant", "system", "tool", None, "assistant", "user", "assistant", "assistant", "user"] * 3
    chats = spark.createDataFrame([(1, i, r, f"t{i}") for i, r in enumerate(roles)] + [(2, 0, "user", None), (None, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    for part in (4, 256):
        out = chat_format.format_chats(chats, part).toPandas()
        want = B.chat_cost([r or "" for r in roles], chat_format)
        assert set(out[out.conv_id == 1].cost) == {want}
        assert out[out.conv_id == 2].rendered.tolist() == ["<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"]
    assert out.n_turns.sum() == len(roles) + 2


def test_chat_query(spark):
    chats = spark.read.parquet(f"{SF}/conversations.parquet").distinct().orderBy("conv_id", "turn", "role", "text").toPandas()
    want = {c: B.chat_cost([(r or "").strip().lower() for r in g.role], chat_format) for c, g in chats.groupby("conv_id")}
    assert {r["conv_id"]: r["cost"] for r in queries.op8_chat_formatting(spark, SF).collect()} == want


def test_chat_rendering(spark):
    """Whatever the parts, the repaired conversation is legal, keeps all texts in order, and its counts add up to the least cost."""
    rng = np.random.default_rng(5)
    names = ["system", "user", "assistant", "tool", None, " User\t"]
    chats = {c: [(t // 2 if c % 3 else None, names[rng.integers(6)], f"{c}.{t:03d}") for t in range(int(rng.integers(1, 40)))] for c in range(40)}
    chats[None] = [(1, "user", "n.000"), (1, "user", "n.000"), (2, "user", "n.001")]
    rows = [(c, t, r, x, "clash") for c, turns in chats.items() for t, r, x in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(5)
    texts = {}
    for part in (3, 256):
        out = chat_format.format_chats(df, part).toPandas().sort_values("part")
        assert out.groupby("conv_id", dropna=False).part.count().max() > (10 if part == 3 else 0)
        for c, turns in chats.items():
            mine = out[out.conv_id.isna()] if c is None else out[out.conv_id == c]
            text = "".join(mine.rendered)
            clean = lambda r: (r or "").strip().lower()
            ordered = sorted({(-1 if t is None else t, clean(r), x) for t, r, x in turns})
            assert text.endswith("<|end|>\n")
            blocks = [b.split("\n", 1) for b in text.removesuffix("<|end|>\n").split("<|end|>\n")]
            roles = [b[0].strip("<|>") for b in blocks]
            body = roles[1:] if roles[0] == "system" else roles
            assert body == ["user", "assistant"] * (len(body) // 2) and body
            assert [x for b in blocks for x in b[1].split("\n") if x] == [x for _, _, x in ordered]
            assert set(mine.cost) == {B.chat_cost([r for _, r, _ in ordered], chat_format)}
            assert mine.n_turns.sum() == len(ordered)
            assert texts.setdefault(c, sum(mine.n_inserted)) == sum(mine.n_inserted)


def test_chat_turns_that_differ_as_they_came_all_stay(spark):
    rows = [(1, 0, "User", "hi"), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "user", None), (1, 1, "user", ""), (1, None, "user", "hi"), (2, 0, None, None), (2, 0, "", ""), (2, 0, " ", "")]
    out = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).toPandas()
    assert out.groupby("conv_id").n_turns.sum().to_dict() == {1: 5, 2: 3}
    assert out[out.conv_id == 1].rendered.tolist() == ["<|user|>\nhi\nhi\nhi\n\n<|end|>\n<|assistant|>\n<|end|>\n"]


@pytest.mark.parametrize("part", [5, 256])
def test_chat_rows_do_not_depend_on_partitions(spark, part):
    rng = np.random.default_rng(8)
    rows = [(c, t, ["user", "assistant", "system", None][rng.integers(4)], f"{c}.{t}") for c in range(25) for t in range(int(rng.integers(1, 30)) if c else 700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 4, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(tuple, chat_format.format_chats(df.repartition(n), part).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    parts = [r[1] for r in found[0] if r[0] == 0]
    assert parts == list(range(0, 700, part))


def test_chats_of_an_empty_table(spark):
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_filters_keep_columns_whatever_their_names(spark):
    schema = "doc_id long, text string, _key string, _d long, _t long, _th string, _doc long, _dropped long, _lines string, _toxicity double, line_kept string, component_id long"
    text = "a shared line of some length\nmore words here to keep it going on and on and on until there are thirteen of them"
    own = ("k", 1, 2, "th", 3, 4, "lines", 0.5, "kept", 9)
    docs = spark.createDataFrame([(i, text if i < 3 else t, *own) for i, t in [(1, ""), (2, ""), (3, None), (4, "")]], schema)
    items = spark.createDataFrame([(1, "more words here to keep it going on and on and on until there are thirteen of them")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = {
        "toxicity": (toxicity.reject_toxic(docs, labels), {1, 2, 3, 4}),
        "lines": (line_dedup.drop_repeated_lines(docs), {1, 2, 3, 4}),
        "copies": (jaccard_join.keep_one(docs), {1, 3, 4}),
        "benchmark": (winnowing.drop_contaminated(docs, items), {3, 4}),
    }
    for name, (df, ids) in made.items():
        rows = df.collect()
        assert df.columns == docs.columns, name
        assert {r["doc_id"] for r in rows} == ids and all(tuple(r)[2:] == own for r in rows), name


def test_arrow_file_random_access(tmp_path):
    path = str(tmp_path / "shard.arrow")
    with pa.OSFile(path, "wb") as sink:
        w = token_output.ShardWriter(sink, 8, "<u2", rows=2)
        docs = [(i, np.arange(i * 5, dtype="<u2")) for i in range(1, 9)]
        for i, ids in docs:
            w.add(i, ids.tobytes())
        w.close()
    flat = np.concatenate([x for _, x in docs])
    with pa.memory_map(path) as source:
        ids, mask = token_output.sequence_at(source, 3, rows=2)
        assert ids.tolist() == flat[24:32].tolist() and mask.all()
    with open(path, "rb") as f:
        again = dict(token_output.documents_of(f))
    assert all((again[i] == x).all() for i, x in docs)


def test_byte_level_encoder_equals_library():
    path = tokenizer("byte_bpe_50k.json")
    e, library = token_output.ByteLevelEncoder(path), token_output.load(path)
    texts = ["Word, word. word!! it's its' 'tis don't, don't", "été, Ünï... naïve$$$\n12, a1, 1a. x\u0301, \u4e2d, ?!", "(word) [a], , . ... word'", " word,  word", "a<|endoftext|>, b", ""]
    for _ in range(2):  # the second time from the cache
        got = [np.frombuffer(x, e.type).tolist() for x in e.encode(texts)]
        assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_token_files_take_ids_by_ranks_and_only_doubtful_texts_in_parts(monkeypatch):
    path = tokenizer("byte_bpe_50k.json")
    e, library = token_output.encoder_of(path), token_output.load(path)
    texts = ["Word, word. it's 'tis\n\n  a", "\u0416\u0416 a", "\u00e9t\u00e9  \u20ac5", "a<|endoftext|>, b", "", " " * 30_000 + "x", "\u4e2d, \U0001f600"]
    seen, encode = [], e.parts.encode
    monkeypatch.setattr(e.parts, "encode", lambda some: seen.extend(some) or encode(some))
    assert [np.frombuffer(x, e.type).tolist() for x in e.encode(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert seen == [texts[i] for i in (1, 3, 5, 6)]


def test_worker_lengths_equal_library_and_stay_bounded():
    path = tokenizer("word_bpe_49k.json")
    w, library = token_counts.WorkerLengths(path, ("the of", bytes([1, 1]))), token_counts.load(path)
    texts = ["The of\nthe", "x" * 1000 + " of", "x" * 1000 + " " + "y" * 500, "<|endoftext|> a<|endoftext|>b", "\u00a0 a\tb", ""]
    for _ in range(2):
        assert w.count(texts) == [len(library.encode(x, add_special_tokens=False).ids) for x in texts]
    assert max(map(len, w.cache)) <= token_counts.LONGEST


def test_telephony_codings():
    codes = np.arange(256, dtype="u1").tobytes()
    for tag, table in ((media_audio.MULAW, media_audio.MULAW_PCM), (media_audio.ALAW, media_audio.ALAW_PCM)):
        assert (media_audio.samples(media_audio.wav(codes, tag))[1] == table).all()
    # Codes of full size and the smallest, as the published tables have them.
    assert media_audio.MULAW_PCM[[0x00, 0x80, 0xFF, 0x7F]].tolist() == [-32124, 32124, 0, 0]
    assert media_audio.ALAW_PCM[[0xD5, 0x55, 0xAA, 0x2A]].tolist() == [8, -8, 32256, -32256]
    block = bytes([0, 0, 0, 0]) + bytes([0x77] * 12)
    one = media_audio.decode_adpcm(np.frombuffer(block, "u1"), 16)
    assert (media_audio.decode_adpcm(np.frombuffer(block * 3, "u1"), 16) == np.tile(one, 3)).all() and one[0] == 0 and one[1] == 11
    assert media_audio.samples(b"junk") is None


def adpcm_one_by_one(data, block):
    out = []
    for lo in range(0, len(data), block):
        b = data[lo : lo + block]
        if len(b) < 4:
            break
        value, index = int.from_bytes(b[:2], "little", signed=True), min(b[2], 88)
        out.append(value)
        for c in (x for byte in b[4:] for x in (byte & 15, byte >> 4)):
            step = int(media_audio.STEP[index])
            diff = (step >> 3) + (step >> 2) * (c & 1) + (step >> 1) * (c >> 1 & 1) + step * (c >> 2 & 1)
            value = max(-32768, min(32767, value - diff if c & 8 else value + diff))
            index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[c & 7]))
            out.append(value)
    return out


def test_store_pcm_of_each_coding_with_short_and_padded_last_blocks(spark):
    block, raw = 32, bytes((i * 37 + i // 7) % 89 for i in range(32 * 3))
    law = bytes(range(256))
    padded = (block - 4) * 2 * 2 + 2 + 9  # two whole blocks, and nine samples of the third
    adpcm = lambda data, count: media_audio.wav(data, media_audio.IMA_ADPCM, 8000, 4, block, count)
    cases = [
        (media_audio.wav(law, media_audio.MULAW), media_audio.MULAW_PCM.tolist()),
        (media_audio.wav(law[:255], media_audio.ALAW), media_audio.ALAW_PCM.tolist()[:255]),
        (adpcm(raw, 57 * 3), adpcm_one_by_one(raw, block)),
        (adpcm(raw[:77], 57 * 2 + 19), adpcm_one_by_one(raw[:77], block)),
        (adpcm(raw[:20], 33), adpcm_one_by_one(raw[:20], block)),
        (adpcm(raw, padded), adpcm_one_by_one(raw, block)[:padded]),
        (adpcm(raw[:77], 0), adpcm_one_by_one(raw[:77], block)),
        (media_audio.wav(law, media_audio.MULAW, rate=0), None),
        (b"junk", None),
        (None, None),
    ]
    assert [len(x) for _, x in cases[3:6]] == [133, 33, padded]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(cases)], "doc_id long, media binary").repartition(3)
    got = {r["doc_id"]: r["media"] for r in media_audio.store_pcm(df, "media", 8000).collect()}
    high = {r["doc_id"]: r["media"] for r in media_audio.store_pcm(df, "media").collect()}
    for i, (_, want) in enumerate(cases):
        if want is None:
            assert got[i] is None and high[i] is None
        else:
            rate, pcm = media_audio.samples(bytes(got[i]))
            assert (rate, pcm.tolist()) == (8000, want)
            rate, pcm = media_audio.samples(bytes(high[i]))
            assert (rate, pcm[::2].tolist(), len(pcm)) == (16_000, want, 2 * len(want))


def test_sentencepiece_agenda_agrees_with_library(rows):
    e = sentencepiece_codec.Encoder(tokenizer("piece_bpe_32k.model"))
    e.encode([t or "" for _, t in rows] + [t or "" for _, t in EDGES])
    assert e.differ == 0


def test_winnowing_keeps_a_fingerprint_of_every_span(spark):
    span = [f"s{i}" for i in range(13)]
    a, b = ["x", *span, "y", "z"], [*"pqr", *span]
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, _w array<string>")
    prints = {i: {r["fp"] for r in winnowing.fingerprints(df.where(f"doc_id = {i}"), ["doc_id"]).collect()} for i in (1, 2)}
    assert prints[1] & prints[2]
