"""Brute-force versions, round trips, held-out accuracy and edge cases of the llm operators."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fwdcurve.llm import byte_cnn, common, fair_mix, license_scan, media_chunks, nb_svm, registry, reply_trees, simhash, token_files, warc_revisits, winnowing
from fwdcurve.llm.common import work_dir
from twins import agree

WORDS = "the of and in that est une Été straße ünter license mit apache version don't x1 3.14 ... --- ñandú 中文 🙂 \\".split()


def texts(n=60, seed=4):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", "!!", "\n"]) for _ in range(rng.choice([1, 3, 5, 12, 40, 300]))) for _ in range(n)]
    base = " ".join(rng.choice(WORDS) for _ in range(200))
    near = [base + f" end{k}" for k in range(6)] + [base] * 3
    return [None, "", " \n\t ", "a", "!!!", "A" * 100_000, "word " * 20_000, *near, *made]


@pytest.fixture(scope="module")
def docs(spark):
    """Edge cases, repeated rows, null keys, and columns named like the operators' own."""
    rows = [(k, t, ["en", "fr", None][k % 3], [None, "b", "a"][k % 3]) for k, t in enumerate(texts())]
    rows += [rows[10], rows[10], (None, "no id", "en", None), (5_000_000_000, "big id", "de", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for clash in ("words", "hash", "fp", "row_key", "digest", "size", "draw", "score", "held_out", "tie", "copies", "kept", "seq"):
        table = table.withColumn(clash, F.lit("clash"))
    return table.repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# 1. media columns


def test_gear_hash_equals_the_recurrence_and_cuts_move_locally():
    table, data = media_chunks.gear_table(), random.Random(1).randbytes(60_000)
    h, want = 0, []
    for b in data[:500]:
        h = (2 * h + int(table[b])) % (1 << 32)
        want.append(h)
    assert media_chunks.rolling_gear(data, table)[:500].tolist() == want
    cutter = media_chunks.Cutter(256, 9, 4096)

    def pieces(d):
        ends = media_chunks.cuts(d, cutter, table)
        return [d[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    before, after = pieces(data), pieces(data[:30_000] + b"inserted" + data[30_000:])
    assert b"".join(after) == data[:30_000] + b"inserted" + data[30_000:]
    assert all(len(p) <= cutter.most for p in after) and all(len(p) >= cutter.least for p in after[:-1])
    assert len(set(after) - set(before)) <= 4


def test_media_round_trip(spark, docs, empty):
    media = media_chunks.ingest(docs, work_dir(spark, "m"))
    got = {r["doc_id"]: r for r in media_chunks.reconstruct(media).collect()}
    assert len(got) == docs.select("doc_id").distinct().count() and media_chunks.reconstruct(media).count() == docs.count()
    assert media.store.count() == media.store.select("recipe_id").distinct().count()
    lists = {r["recipe_id"]: r["digests"] for r in media.recipes.collect()}
    digests = [d for r in media.store.collect() for d in (*(lists[r["recipe_id"]][f["seq"]] for f in r["own"]), *(f["digest"] for f in r["shared"]))]
    assert len(set(digests)) == len(digests) and {d for x in lists.values() for d in x} == set(digests)
    for r in docs.collect():
        payload = (r["text"] or "").encode()
        n = len(payload)
        payload += bytes(-n % 64 or 64 * (n == 0))
        g = got[r["doc_id"]]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert media_chunks.reconstruct(media_chunks.ingest(empty, work_dir(spark, "m"))).count() == 0


def test_hot_chunks_take_the_salted_way(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 1)
    # many payloads that share their middle and differ at the end
    rng = random.Random(2)
    middle = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    table = spark.createDataFrame([(k, middle + str(k)) for k in range(6)], "doc_id long, text string")
    media = media_chunks.ingest(table, work_dir(spark, "m"))
    got = {r["doc_id"]: r["n_bytes"] for r in media_chunks.reconstruct(media).collect()}
    assert got == {k: 40_001 for k in range(6)}
    own, shared = (media.store.agg(F.sum(F.size(c))).first()[0] for c in ("own", "shared"))
    assert shared >= 40_000 // 4096 and own <= 6 * 2


def test_most_texts_have_several_chunks_and_shared_ones_are_stored_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    media = media_chunks.ingest(docs, work_dir(spark, "m"))
    sizes = media.recipes.select(F.size("digests").alias("n"), "n_bytes").toPandas()
    assert (sizes["n"] == 1).mean() < 0.25 and sizes["n_bytes"].sum() / sizes["n"].sum() < 1024
    assert media.references.count() > media.references.where("first").count() > 0


def test_a_hot_row_is_sampled_once(spark):
    table = spark.createDataFrame([(1, "the same words again " * 40)] * 10_000, "doc_id long, text string")
    media = media_chunks.ingest(table, work_dir(spark, "m"))
    assert media.store.count() == 1 and media_chunks.reconstruct(media).count() == 10_000


# 2. token files


def encoded(texts_):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.tokenizer_file())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts_]


def test_token_files_match_whole_text_encoding(spark, docs, empty):
    got = token_files.token_output(docs, length=64)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for (doc, _), ids in zip(rows, encoded([t for _, t in rows]), strict=True):
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    assert token_files.token_output(empty).count() == 0


def test_pieces_encode_like_whole_texts():
    rng = random.Random(9)
    alphabet = ["é", "é", "A", "İ", "Σ", "ß", "'s", "'", " ", "  ", "\n", "\x1c", "\x1f", "\x85", "　", "​", "1", "²", "<|endoftext|>", "!", "…", "中", "🙂", "́", "_", "\xa0"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(600)]
    encoder = token_files.Encoder(token_files.tokenizer_file())
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.texts(made)] == encoded(made)


def test_token_rows_are_views_found_by_arithmetic(spark, docs, tmp_path):
    folder = f"{tmp_path}/tokens"
    manifest = token_files.write_tokens(docs, folder, token_files.tokenizer_file(), length=32)
    one = manifest.orderBy("part").first()
    first = docs.select("doc_id", "text").repartition(1).sortWithinPartitions("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).limit(one["n_docs"]).collect()
    stream = [i for ids in encoded([r["text"] for r in first]) for i in ids]
    with token_files.TokenFile(f"{folder}/{one['file']}.arrow") as tokens:
        mapped = np.frombuffer(tokens.source.read_buffer(), np.uint8)
        assert tokens.length == 32 and tokens.n_rows == -(-one["n_tokens"] // 32) and tokens.n_batches > 1 and len(stream) == one["n_tokens"]
        for r in {0, 1, 127, 128, tokens.n_rows // 2, tokens.n_rows - 2, tokens.n_rows - 1} & set(range(tokens.n_rows)):
            ids, mask = tokens.sequence(r)
            part = stream[r * 32 : r * 32 + 32]
            assert ids.tolist() == part + [0] * (32 - len(part)) and mask.tolist() == [1] * len(part) + [0] * (32 - len(part))
            assert np.shares_memory(ids, mapped) and mask.dtype == np.uint8 and not ids.flags.owndata and not mask.flags.owndata
        with pytest.raises(IndexError):
            tokens.sequence(tokens.n_rows)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = token_files.Encoder(path, 50256), Tokenizer.from_file(path)
    made = ["two  words", " led by blanks", "a\n\nb", "", None]
    assert not encoder.by_piece
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.texts(made)] == [[*plain.encode(t or "", add_special_tokens=False).ids, 50256] for t in made]


def test_memo_keeps_the_latest_values():
    asked = []
    memo = token_files.Memo(lambda k: asked.append(k) or k.encode(), 3)
    for k in "abcdabcdeabcd":
        assert memo[k] == k.encode()
        memo.tidy()
        assert len(memo) <= 3 and len(memo.older) <= 4
    # the fourth value was last asked for three generations ago
    assert asked == list("abcded")


# 3. reply trees


def test_trees_give_every_ranked_path_and_read_back(spark):
    rows = [("c", 1, None, "user", "### hi </turn> \\s", 0.0), ("c", 2, 1, "assistant", "a\\e", 1.0), ("c", 3, 1, "assistant", None, 3.0), ("c", 4, 2, "us:er", "", None), ("c", 5, 3, "user", "ok\n", 1.0), ("c", 6, 5, "assistant", "###", 5.0), ("d", 9, 77, None, "orphan", 1.0), ("x", 1, 2, "u", "cycle", 0.0), ("x", 2, 1, "u", "cycle", 0.0)]
    messages = spark.createDataFrame(rows, "conv_id string, msg_id long, parent_id long, role string, text string, score double")
    reach = reply_trees.paths(messages, work_dir(spark, "t"))
    ranked = reply_trees.rank_branches(reach, messages, None)
    read = reply_trees.parse(reply_trees.format_paths(reach, ranked, messages))
    got = {(r["conv_id"], r["branch"]): ([(t["role"], t["text"]) for t in r["turns"]], r["loss"]) for r in read.collect()}
    by_id = {r[1]: (r[3] or "", r[4] or "") for r in rows if r[0] == "c"}
    assert got[("c", 1)] == ([by_id[k] for k in (1, 3, 5, 6)], "###")
    assert got[("c", 2)] == ([by_id[k] for k in (1, 2, 4)], "a\\e")
    assert got[("d", 1)] == ([("", "orphan")], "") and len(got) == 3
    assert reply_trees.rank_branches(reach, messages, 1).count() == 2


def test_leaves_below_cycles_have_no_path(spark):
    rows = [("c", 1, 2), ("c", 2, 1), ("c", 3, 1), ("c", 4, 3), ("c", 5, 5), ("c", 6, 5), ("d", 1, None), ("d", 2, 1)]
    messages = spark.createDataFrame(rows, "conv_id string, msg_id long, parent_id long")
    assert rows_of(reply_trees.paths(messages, work_dir(spark, "t")), "conv_id", "leaf", "msg_id", "up") == [("d", 2, 1, 1), ("d", 2, 2, 0)]
    chain = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("msg_id"), (F.col("id") - 1).alias("parent_id"))
    assert rows_of(reply_trees.paths(chain, work_dir(spark, "t")), "msg_id", "up") == sorted(((k, 299 - k) for k in range(300)), key=str)


def test_of_messages_with_one_id_the_least_counts(spark):
    rows = [("c", 1, None, "user", "a", 1.0), ("c", 1, None, "user", "a", 1.0), ("c", 1, None, "user", "b", 0.0), ("c", 2, 1, "assistant", "x", None), ("c", 2, 1, "assistant", "x", None)]
    messages = spark.createDataFrame(rows, "conv_id string, msg_id long, parent_id long, role string, text string, score double")
    got = reply_trees.conversations(messages, work_dir(spark, "t")).collect()
    assert [r["text"] for r in got] == ["### user: a </turn>\n### assistant: x </turn>\n"]
    assert reply_trees.conversations(messages.where("false"), work_dir(spark, "t")).count() == 0


def test_op3_on_empty_repeated_and_clashing_tables(spark, tmp_path):
    schema = "conv_id long, turn int, role string, text string, msg_id string, score string, turns string, up string"
    rows = [(1, 0, "user", "hi", "m", "s", "t", "u")] * 2 + [(1, 1, "assistant", None, "m", "s", "t", "u"), (None, 0, None, "x", "m", "s", "t", "u"), (2, 0, "assistant", "é" * 50_000, "m", "s", "t", "u")]
    for name, table in (("none", rows[:0]), ("some", rows)):
        spark.createDataFrame(table, schema).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    assert rows_of(reply_trees.op3_reply_trees(spark, f"{tmp_path}/none"), "conv_id", "n_turns", "loss_chars") == [(-7, 2, len(reply_trees.PROBE))]
    got = reply_trees.op3_reply_trees(spark, f"{tmp_path}/some")
    assert rows_of(got, "conv_id", "n_turns", "loss_chars") == sorted([(-7, 2, len(reply_trees.PROBE)), (1, 3, 0), (2, 1, 50_000), (None, 1, 0)], key=str)


def test_escape_is_reversible(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice(["\\", "s", "e", "h", "c", "#", "##", "</turn>", " </turn>\n", ":", "é"]) for _ in range(rng.randrange(12))) for _ in range(300)]
    table = spark.createDataFrame([(t,) for t in made], "t string").select("t", reply_trees.escape(F.col("t")).alias("e"))
    assert table.where(reply_trees.unescape(F.col("e")) != F.col("t")).count() == 0
    assert table.where(F.col("e").contains("</turn>") | F.col("e").contains("###")).count() == 0


# 4. byte network


def test_languages_are_told_apart_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = byte_cnn.op4_byte_cnn(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_byte_network_edges(spark, docs, empty):
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", F.lit(False))
    model = byte_cnn.fit(rows)
    got = {r["doc_id"]: r for r in byte_cnn.predict(rows, model).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (0, 1, 2, 4))
    assert got[5]["lang_pred"] in model.languages and len(got) == docs.select("doc_id").distinct().count()
    nothing = byte_cnn.fit(rows.where("false"))
    assert {r["lang_pred"] for r in byte_cnn.predict(rows, nothing).collect()} == {"und"}
    assert byte_cnn.predict(rows.where("false"), model).count() == 0


def test_every_language_and_place_is_sampled(spark):
    rows = [(k, f"text {k}", f"l{k % 230}") for k in range(460)]
    windows, _, languages = byte_cnn.sample_windows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10)
    assert len(languages) == 230 and len(windows) == 460
    drawn = [byte_cnn.sampled_places(f"text {k}", 10) for k in range(300)]
    assert {p for d in drawn for p in d} == set(range(10)) and all(len(set(d)) == 2 for d in drawn)


def test_pair_tables_give_the_plain_sums():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (5, byte_cnn.WINDOW)).astype(np.uint8)
    model = byte_cnn.train(windows, np.array([0, 1, 0, 1, 0]), ["a", "b"], steps=1)
    pooled = np.concatenate([total.max(axis=1) for _, total in byte_cnn._maps(windows, model)], axis=1)
    z = np.maximum(pooled + model.bias, 0) @ model.out + model.out_bias
    want = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(byte_cnn.probabilities(windows, model, byte_cnn._pairs(model)), want / want.sum(axis=1, keepdims=True), atol=1e-4)


def float64_values(rng, languages):
    n = len(byte_cnn.WIDTHS) * byte_cnn.FILTERS
    return {("t", w): rng.normal(0, 0.3, (w, 256, byte_cnn.FILTERS)) for w in byte_cnn.WIDTHS} | {"b": rng.normal(0, 0.1, n), "o": rng.normal(0, 0.2, (n, languages)), "c": rng.normal(0, 0.1, languages)}


def test_gradient_equals_the_difference_quotient():
    rng = np.random.default_rng(3)
    x, target = rng.integers(97, 123, (6, byte_cnn.WINDOW)).astype(np.uint8), rng.integers(0, 3, 6)
    values = float64_values(rng, 3)
    _, grads = byte_cnn.loss_and_gradient(x, target, values)
    for key, g in grads.items():
        # places of the greatest gradients and some at random
        flat = np.concatenate([np.argsort(-np.abs(g).reshape(-1))[:4], rng.integers(0, g.size, 4)])
        for at in flat.tolist():
            ends = []
            for step in (1e-6, -1e-6):
                moved = {k: v.copy() for k, v in values.items()}
                moved[key].reshape(-1)[at] += step
                ends.append(byte_cnn.loss_and_gradient(x, target, moved)[0])
            assert abs((ends[0] - ends[1]) / 2e-6 - g.reshape(-1)[at]) < 1e-6, key


def test_network_equals_a_convolution_over_one_hot_bytes():
    rng = np.random.default_rng(4)
    x, values = rng.integers(0, 256, (2, byte_cnn.WINDOW)).astype(np.uint8), float64_values(rng, 2)
    model = byte_cnn._model(values, ["a", "b"])
    for row, got in zip(x, byte_cnn.probabilities(x, model, byte_cnn._pairs(model)), strict=True):
        one_hot, pooled = np.eye(256)[row], []
        for w in byte_cnn.WIDTHS:
            for f in range(byte_cnn.FILTERS):
                pooled.append(max(float((one_hot[p : p + w] * values["t", w][:, :, f]).sum()) for p in range(byte_cnn.WINDOW - w + 1)))
        z = np.maximum(np.array(pooled) + values["b"], 0) @ values["o"] + values["c"]
        assert np.allclose(got, np.exp(z) / np.exp(z).sum())


def test_letters_are_those_of_the_letter_category():
    model = byte_cnn.train(np.zeros((2, byte_cnn.WINDOW), np.uint8), np.array([0, 1]), ["a", "b"], steps=1)
    lang, score = byte_cnn.predict_texts(["½ ² ① Ⅷ", "_1_", "12 ª", "中"], model, byte_cnn._pairs(model))
    assert lang[:2] == ["und", "und"] and score[:2] == [0.0, 0.0] and "und" not in lang[2:]


def test_hot_rows_are_sampled_once(spark):
    rows = [(None, "the same text", "en")] * 10_000 + [(7, "un autre texte", "fr")] * 3 + [(None, f"text {k}", "fr") for k in range(50)]
    windows, target, languages = byte_cnn.sample_windows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 20_000)
    assert languages == ["en", "fr"] and (target == 0).sum() == 1 and (target == 1).sum() == 51


# 5. winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(text, items, span=13):
    words, hit, met = lower(text), set(), set()
    for item, body in items:
        it = lower(body)
        m = min(span, len(it))
        windows = {tuple(it[k : k + m]) for k in range(len(it) - m + 1)} if m else set()
        for k in range(len(words) - m + 1):
            if tuple(words[k : k + m]) in windows:
                hit |= set(range(k, k + m))
                met.add(str(item))
    return len(words), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("short", [True, False])
def test_winnowing_matches_brute_force(spark, docs, few, short):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([13, 14, 20, 50])))) for k in range(6)] + [(7, None), (8, "...")]
    if short:
        items += [(9, "w1 W2"), (10, "w3 w4 w5 w6 w7 w8"), (11, "Straße")]
    made = []
    for k in range(40):
        body = [rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 30, 80]))]
        piece = items[k % 6][1].split()
        a = rng.randrange(len(piece))
        made.append((1000 + k, " ".join(body + piece[a : a + rng.choice([5, 12, 13, 30])] + body[:7])))
    table = docs.select("doc_id", "text", "words", "hash").unionByName(spark.createDataFrame(made, "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.decontaminate(table, bench, broadcast_rows=10**6 if few else 0)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = [(r["doc_id"], *contaminated(r["text"], items)) for r in table.collect()]
    assert rows_of(got, *columns) == sorted(want, key=str)


@pytest.mark.parametrize("few", [True, False])
def test_short_long_and_repeated_items(spark, few):
    rng = random.Random(16)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40))
    shared = " ".join(word() for _ in range(20))
    items = [(k, shared if k % 2 else f"{shared} tail{k % 5} x{k}") for k in range(1, 3001)] + [(-1, "lonely"), (-2, "six words make one whole window"), (-3, " ".join(word() for _ in range(50)))]
    made = ["", None, shared, f"some words before {shared} and after", " ".join(shared.split()[3:16]), " ".join(shared.split()[3:15]), f"a lonely word {items[-1][1]}", "six words make one whole", "so six words make one whole window then", f"{shared} tail3 x3"]
    docs = [(k, t) for k, t in enumerate(made)] * 3
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = {k: (k, *contaminated(t, items)) for k, t in enumerate(made)}
    assert rows_of(winnowing.decontaminate(table, bench, broadcast_rows=10**6 if few else 0), *columns) == sorted([want[k] for k, _ in docs], key=str)
    kept = winnowing.clean(table, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, _ in docs if not want[k][-1])


def test_winnowing_of_empty_tables(spark, docs, empty):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert winnowing.decontaminate(empty, bench).count() == 0
    assert winnowing.decontaminate(docs, bench.where("false")).where("n_hit > 0 OR contaminated").count() == 0


# 6. simhash


def brute_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_components(fingerprints):
    ids = sorted(fingerprints, key=lambda d: (d is None, d))
    parent = {d: d for d in ids}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash_matches_brute_force(spark, docs, empty):
    table = docs.where("doc_id IS NOT NULL")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in table.collect()}
    want = brute_components(prints)
    got = {(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(table).collect()}
    assert got == {(d, prints[d], want[d]) for d in prints}
    assert simhash.near_duplicates(docs).count() == docs.count() and simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(table)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values())) and kept.columns == table.columns


def test_keep_one_keeps_one_row_of_each_component_whatever_its_ids(spark):
    base = " ".join(f"w{k}" for k in range(400))
    other, third = (" ".join(f"{c}{k}" for k in range(400)) for c in "xy")
    rows = [(None, base), (None, base), (7, other), (7, third), (3, third + " end"), (None, "alone here"), (9, "alone there"), (12, other)]
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = brute_components(dict(enumerate(prints)))
    want = {min((k for k in groups if groups[k] == g), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)) for g in groups.values()}
    assert len(want) == 5
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(simhash.keep_one(table), "doc_id", "text") == sorted((rows[k] for k in want), key=str)
    ids = {(r["doc_id"], r["fp"] % (1 << 64)): r["component_id"] for r in simhash.near_duplicates(table).collect()}
    assert ids == {(rows[k][0], prints[k]): min((rows[j][0] for j in groups if groups[j] == groups[k] and rows[j][0] is not None), default=None) for k in groups}


def test_links_find_every_near_pair(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base:
        for d in range(1, 7):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), d)))
    signed = [(k, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(sorted(fps))]
    got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(spark.createDataFrame(signed, "node long, fp long")).collect()}
    want = {(a, b) for a, x in signed for b, y in signed if a < b and ((x ^ y) % (1 << 64)).bit_count() <= 4}
    assert got == want


@pytest.mark.parametrize("segments", [2, 3])
def test_links_are_complete_at_every_distance(spark, segments):
    rng = random.Random(12)
    base = [rng.getrandbits(64) for _ in range(8)]
    fps = sorted(set(base) | {b ^ sum(1 << k for k in rng.sample(range(64), d)) for b in base for d in range(1, 10) for _ in range(4)})
    nodes = spark.createDataFrame([(k, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(fps)], "node long, fp long").cache()
    for distance in (1, 2, 4, 5) if segments == 2 else (1, 2, 3, 4, 5, 6, 8):
        cut = simhash.segments_for(distance, segments)
        assert sum(s.bits for s in cut) == 64 and sum(s.radius + 1 for s in cut) == distance + 1
        got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(nodes, distance, segments).collect()}
        assert got == {(a, b) for a, x in enumerate(fps) for b, y in enumerate(fps) if a < b and (x ^ y).bit_count() <= distance}, distance


def test_distances_without_a_complete_search_are_refused():
    for distance, segments in ((0, 3), (9, 3), (4, 1)):
        with pytest.raises(ValueError):
            simhash.segments_for(distance, segments)


def test_hot_stars_and_fingerprints_take_the_salted_way(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    edges = spark.createDataFrame([(0, k) for k in range(1, 30)] + [(29, 40), (40, 41)], "a long, b long")
    got = {r["node"]: r["component"] for r in simhash.components(edges, work_dir(spark, "c")).collect()}
    assert got == {**{k: 0 for k in range(1, 30)}, 40: 0, 41: 0}
    table = spark.createDataFrame([(k, "same words here now") for k in range(5, 20)] + [(None, None), (1, "")], "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(table), "doc_id", "component_id") == sorted([(k, 5) for k in range(5, 20)] + [(None, 1), (1, 1)], key=str)


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200)]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["component"] for r in simhash.components(edges, work_dir(spark, "c")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 130)}}
    assert simhash.components(edges.where("false"), work_dir(spark, "c")).count() == 0


# 7. mixing


def test_mix_meets_targets_and_reruns_agree(spark, docs, empty):
    rng = random.Random(3)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["hot"] * 20 + ["a", "b", None, "tiny"][: 1 + k % 4])) for k in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = fair_mix.mix(table).toPandas()
    again = fair_mix.mix(table.repartition(5)).toPandas()
    key = ["doc_id", "copies"]
    assert got.sort_values(key)[key].values.tolist() == again.sort_values(key)[key].values.tolist()
    got["taken"] = got["size"] * got["copies"]
    for source, part in got.groupby("source", dropna=False):
        target, size = part["target"].iloc[0], part["source_size"].iloc[0]
        assert target <= 3 * size + 1e-6 and abs(part["taken"].sum() - target) <= 2 * 60, source
    assert got["copies"].max() <= 3 and abs(got.drop_duplicates("source")["target"].sum() - got["size"].sum()) < 1e-3
    assert fair_mix.mix(empty).count() == 0
    edge = fair_mix.mix(docs)
    assert edge.count() == docs.count() and edge.where("size = 0 AND copies > 0").count() == 0
    mixed = fair_mix.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixed.count() == edge.agg(F.sum("copies")).first()[0]


# 8. licenses


def test_phrases_and_templates(spark, docs, empty):
    rows = [(1, "Released under the MIT License. under the mit  license"), (2, "CC-BY-NC 4.0, and cc by nc"), (3, "under mit the license"), (4, "this work IS licensed under the GNU general public license, version 3."), (5, "Licensed under the Apache License, Version 2.0 (the License); you may really not use this file except in compliance with the License. You may obtain a copy of the License at"), (6, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(table).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 1, 5, "mit")
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"]) == (2, 0, 6)
    assert (got[3]["n_base"], got[3]["labels"], got[3]["first_word"]) == (0, "", None)
    assert got[4]["labels"] == "gpl-3" and got[4]["base_labels"] == "" and got[5]["labels"] == "apache-2" and got[6]["n_words"] == 0
    every = license_scan.scan(docs)
    assert every.count() == docs.count() and license_scan.scan(empty).count() == 0
    want = []
    for r in docs.collect():
        w = lower(r["text"])
        n = sum(w[k : k + len(p.split())] == p.split() for _, p in license_scan.PHRASES for k in range(len(w)))
        want.append((r["doc_id"], len(w), n))
    assert rows_of(every, "doc_id", "n_words", "n_base") == sorted(want, key=str)


def test_templates_are_a_table_and_both_ways_agree(spark, docs):
    labels = {label for label, _, phrase, _ in license_scan.notice_rows() if not phrase}
    assert len(labels) >= 25
    mit = license_scan.notice_rows()[3][1]
    rows = [(1, mit), (2, mit.replace("without restriction", "with no restriction at all")), (3, "own words of a house rule"), (4, " ".join(mit.split()[:20])), (5, None)] * 2
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    own = license_scan.notices(spark).unionByName(spark.createDataFrame([("house", "Own words of a house rule", True, None)], "label string, text string, phrase boolean, family string"))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    near = rows_of(license_scan.scan(table, own), *columns)
    assert near == rows_of(license_scan.scan(table, own, broadcast_grams=0), *columns)
    found = {r[0]: r[6] for r in near if r[1] in (6, len(lower(mit)), len(lower(mit)) + 3)}
    assert found[1] == "mit" and found[2] == "mit" and found[3] == "house"
    assert license_scan.scan(table, own.where("false")).where("labels <> ''").count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(table, spark.createDataFrame([("x", "two words", True, None)], "label string, text string, phrase boolean, family string"))


def test_each_notice_is_told_from_its_family(spark):
    rows = [r for r in license_scan.notice_rows() if not r[2]]
    table = spark.createDataFrame([(k, f"Some words before. {text} And some after it.") for k, (_, text, _, _) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in license_scan.scan(table).collect()}
    for k, (label, _, _, family) in enumerate(rows):
        assert label in got[k] and {f for x, _, _, f in rows if x in got[k]} <= {family, "apache", "mit"}, label
        assert len(got[k]) <= 2, (label, got[k])


# 9. quality


def brute_indicators(text):
    """Sets of buckets by plain loops and Python integers."""
    def code(data):
        return 2 + zlib.crc32(data) % (2**31 - 2)

    def bucket(x, buckets):
        return (x * 0x9E3779B97F4A7C15 % 2**64 >> 33) % buckets

    words = (text or "").split()
    named = [code("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w).encode()) for w in words]
    shapes = [code(nb_svm.shape(w).encode()) for w in words]
    shapes = [1 if k and (named[k], shapes[k]) == (named[k - 1], shapes[k - 1]) else x for k, x in enumerate(shapes)]
    found = {0}
    for n in (1, 2):
        grams = [tuple(shapes[k : k + n]) for k in range(len(words) - n + 1)]
        for g in set(grams):
            x = g[0] if n == 1 else g[0] * 1_000_003 + g[1] * 7 + 3
            for k, share in enumerate((0, 0.02, 0.1, 0.4)):
                if grams.count(g) > share * len(grams):
                    found.add(1 + bucket(x * 4 + k, nb_svm.BUCKETS - 1))
        for k in range(len(words) - n + 1):
            x = named[k] if n == 1 else named[k] * 1_000_003 + named[k + 1] * 7 + 3
            found.add(nb_svm.BUCKETS + bucket(x, nb_svm.WORD_BUCKETS))
    return sorted(found)


def test_indicators_match_brute_force():
    of = nb_svm.Indicators()
    for text in ["", None, "one", "one One ONE one one", "a" * 5000 + " $$$ 12,5 ###x### don't Été ÉTÉ", *(t for t in texts() if t is None or len(t) < 3000)]:
        assert of(text).tolist() == brute_indicators(text), text
    assert nb_svm.shape("ab" * 40 + "-" + "cd1" * 9) == "x-" + "x9" * 9 and nb_svm.shape("McDonald") == "X" and nb_svm.shape("Ab!!!!!") == "Xx!!"


def test_ratios_and_dual_descent_reach_the_best_objective():
    rng = np.random.default_rng(7)
    rows = [np.unique(np.concatenate([[0], rng.integers(1, 30, 6), nb_svm.BUCKETS + rng.integers(0, 20, 4)])) for _ in range(60)]
    good = (rng.random(60) < np.array([0.2 + 0.6 * (3 in r or 7 in r) for r in rows])).astype(np.int64)
    ratios = nb_svm.log_ratios(rows, good)
    size = nb_svm.BUCKETS + nb_svm.WORD_BUCKETS
    for bucket in (3, 7, nb_svm.BUCKETS + 5, 40):
        n = [1 + sum(bucket in r.tolist() for r, g in zip(rows, good, strict=True) if g == c) for c in (1, 0)]
        total = [size + sum(len(r) for r, g in zip(rows, good, strict=True) if g == c) for c in (1, 0)]
        assert abs(ratios[bucket] - np.log(n[0] / total[0] / (n[1] / total[1]))) < 1e-9
    assert ratios[0] == 1
    sign, used = np.where(good == 1, 1.0, -1.0), np.unique(np.concatenate(rows))
    x = np.zeros((len(rows), len(used)))
    for k, r in enumerate(rows):
        words = (r >= nb_svm.BUCKETS).sum()
        for b in r:
            x[k, np.searchsorted(used, b)] = ratios[b] * (1 / np.sqrt(words) if b >= nb_svm.BUCKETS else 1)
    objective = lambda w: w @ w / 2 + 0.1 * (np.maximum(0, 1 - sign * (x @ w)) ** 2).sum()
    w = np.zeros(len(used))
    for _ in range(20_000):
        w -= 0.01 * (w - 0.2 * x.T @ (sign * np.maximum(0, 1 - sign * (x @ w))))
    got = nb_svm.dual_descent(rows, sign, ratios, rounds=500)[used] / ratios[used]
    assert abs(objective(got) - objective(w)) < 1e-4 * objective(w)


def test_words_alone_tell_classes_apart(spark):
    rng = random.Random(21)
    good, bad = "river stone window garden letter".split(), "casino jackpot pills winner cheap".split()
    rows = [(k, " ".join(rng.choice((good, bad)[k % 2] if rng.random() < 0.3 else ["some", "plain", "words", "here"]) for _ in range(40)), 1 - k % 2) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(2)
    model = nb_svm.fit(docs.where("doc_id < 300"), docs.select("doc_id", "quality"))
    got = nb_svm.scored(docs.where("doc_id >= 300"), model, ["doc_id", "quality"]).toPandas()
    assert ((got["score"] >= 0.5) == (got["quality"] == 1)).mean() > 0.97


def test_a_hot_document_is_learned_once(spark):
    rows = [(1, "the same good text")] * 5_000 + [(1, "another text of that id")] + [(2, "### junk $$$")] * 5_000
    model = nb_svm.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert model.weights.any()



def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = nb_svm.op9_nb_svm(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    good, bad = got.where("quality = 1"), got.where("quality = 0")
    assert good.where("predicted = 1").count() >= 0.99 * good.count() and bad.where("predicted = 0").count() >= 0.9 * bad.count()


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (3, None), (10**9, 0)], "doc_id long, quality int")
    rows = docs.select("doc_id", "text", "score")
    model = nb_svm.fit(rows, labels)
    got = nb_svm.scored(rows.drop("score"), model, ["doc_id"])
    assert got.count() == docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    flat = nb_svm.fit(rows, labels.where("quality = 1"))
    assert {r["score"] for r in nb_svm.scored(rows.drop("score"), flat, ["doc_id"]).collect()} == {0.5}
    assert nb_svm.scored(empty.select("doc_id", "text"), model, ["doc_id"]).count() == 0


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.concatenate([[0], rng.integers(1, 50, 5) + (100 if k % 2 else 0)])) for k in range(200)]
    good = np.arange(200) % 2
    model = nb_svm.fit_rows(rows, good)
    margins = np.array([nb_svm.margin(r, model.weights) for r in rows])
    assert ((model.slope * margins + model.offset > 0) == (good == 1)).mean() > 0.99


# 10. archives


def test_archives_read_back(spark):
    long = "<html>" + "x" * 200 + "é</html>"
    rows = [(5, "u5", long), (2, "u2", long), (9, None, long), (3, "u3", "short"), (4, "u4", "short"), (7, "a\r\nb", None), (8, "u8", "\r\n\r\nWARC/1.1\r\n" * 20), (11, "u11", "\r\n\r\nWARC/1.1\r\n" * 20), (None, "u", "no id"), (5, "again", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("size", F.lit(0))
    folder = work_dir(spark, "warc")
    got = warc_revisits.resolved(warc_revisits.read_archive(warc_revisits.write_archive(pages, folder), folder), folder)
    want, least = [], defaultdict(lambda: 10**9)
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            least[body] = min(least[body], page)
    for page, _, html in rows:
        body = (html or "").encode()
        first = least[body] if body in least else page
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "response" if first == page else "revisit", None if first == page else first))
    assert rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)
    names = warc_revisits.read_archive(spark.read.parquet(f"{folder}/manifest"), folder).select("record_id")
    assert names.distinct().count() == len(rows)
    folder = work_dir(spark, "warc")
    none = warc_revisits.write_archive(pages.where("false"), folder)
    assert warc_revisits.resolved(warc_revisits.read_archive(none, folder), folder).count() == 0


@pytest.mark.parametrize("most", [2000, 1])
def test_repeated_pages_have_records_of_their_own(spark, monkeypatch, most):
    monkeypatch.setattr(common, "HOT_ROWS", most)
    a, b = "a" * 150, "b" * 150
    rows = [(5, "u", a), (5, "u", b), (7, "v", a), (7, "v", a), (5, "u", a), (9, None, b), (3, "x", "short"), (3, "x", "short"), (5, "z", a)]
    folder = work_dir(spark, "warc")
    records = warc_revisits.read_archive(warc_revisits.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, "2024-01-01T00:00:00Z"), folder)
    assert records.count() == records.select("record_id").distinct().count() == len(rows)
    first = {a: 5, b: 5}
    want = [(p, hashlib.sha256(h.encode()).hexdigest(), None if first.get(h, p) == p else first[h]) for p, _, h in rows]
    assert rows_of(warc_revisits.resolved(records, folder), "page_id", "payload_digest", "refers_to") == sorted(want, key=str)


# twins and the pipeline


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, sf_dir, name):
    agree(spark, registry.queries()[name], registry.oracle_sql()[name], sf_dir)


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(p.COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = p.quality(spark, docs, sf_dir)
    good = labels.where("quality = 1").join(docs, "doc_id").select("doc_id")
    assert kept.columns == p.COLUMNS and kept.join(good, "doc_id").count() >= 0.97 * good.count()
    once = p.near_duplicates(spark, docs, sf_dir)
    groups = brute_components({r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()})
    assert sorted(r["doc_id"] for r in once.collect()) == sorted(set(groups.values()))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = p.decontaminate(spark, docs, sf_dir)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect() if not contaminated(r["text"], items)[-1]}
    mixed = p.mix(spark, docs, sf_dir)
    copies = {r["doc_id"]: r["copies"] for r in fair_mix.mix(docs).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
    assert p.run(spark, sf_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def written(spark, tmp_path, rows, labels, items):
    """A folder with documents, labels and benchmark; documents also have columns named like the operators' own."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("clash") for c in ("fp", "row_key", "draw", "score", "size", "copies")})
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_accounts_for_every_row(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(31)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(500))
    prose = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    item, base, other = prose(40), prose(300), prose(300)
    junk = [" | ".join(["$$$", "###"] * 12 + [word()]) for _ in range(30)]
    rows = [(k, prose(60), "en", "ab"[k % 2], 1) for k in range(60)]
    rows += [(100 + k, t, "en", "junk", 1) for k, t in enumerate(junk)]
    rows += [(200, base, "en", "a", 1), (201, base + " end", "en", None, 1), (None, base, None, "b", 1), (201, other, "en", "a", 1), (None, prose(80), None, None, None), (None, None, None, None, None), (300, "", "en", "a", 1)]
    rows += [(400, f"Before it {item} and after it.", "en", "a", 1)] * 3 + [(401, prose(90), "en", "a", 1)] * 3
    labels = [(r[0], 1, 0) for r in rows[:60]] + [(r[0], 0, 0) for r in rows[60:90]]
    sf = written(spark, tmp_path, rows, labels, [(1, item), (2, None)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    count = lambda df: defaultdict(int, {(r["doc_id"], r["text"]): r["n"] for r in df.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n")).collect()})
    before = count(docs)
    kept = p.quality(spark, docs, sf)
    after = count(kept)
    assert {k for k in before if after[k] != before[k]} <= {k for k in before if k[0] in range(100, 130) or not k[1]} and sum(after[100 + k, t] for k, t in enumerate(junk)) <= 3
    assert all(after[k] in (0, before[k]) for k in before)
    once = count(p.near_duplicates(spark, docs, sf))
    prints = {k: brute_fingerprint(k[1]) for k in before}
    order = sorted(before, key=lambda k: (k[0] is None, k[0] or 0, k[1] or ""))
    groups = brute_components({n: prints[k] for n, k in enumerate(order)})
    assert sum(once.values()) == len(set(groups.values())) and set(once.values()) == {1}
    assert len({groups[order.index(k)] for k in once}) == len(once) and once[200, base] == once[201, other] == once[401, rows[-1][1]] == 1
    clean = count(p.decontaminate(spark, docs, sf))
    assert {k: before[k] - clean[k] for k in before if clean[k] != before[k]} == {(400, rows[-4][1]): 3}
    mixed, copies = count(p.mix(spark, docs, sf)), count(fair_mix.mixed_rows(docs.select(p.COLUMNS)))
    assert mixed == copies and not any(k[1] in (None, "") for k in mixed if mixed[k])
    tokens = p.tokens(spark, docs, sf)
    assert tokens.count() == docs.count() and tokens.agg(F.sum("n_tokens")).first()[0] == sum(len(i) for i in encoded([r[1] for r in rows]))
    assert p.run(spark, sf).count() > 50


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    sf = written(spark, tmp_path, [], [], [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [stage(spark, docs, sf).count() for _, stage in p.STAGES] == [0] * 5 and p.run(spark, sf).count() == 0
