"""Operators against brute force, the libraries they follow, and odd inputs."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gridops.llm import chat, decontam, exact, langid, repeats, shards, simhash, spm, tokens, urls
from gridops.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept string"
LONG = "one two three four five six seven eight nine ten eleven twelve thirteen " * 400
ODD = [
    (1, None, None, None, None, "x", "y"),
    (2, "", "en", "s", 0, "x", "y"),
    (3, "", "en", "s", 0, "x", "y"),
    (3, "", "en", "s", 0, "x", "y"),
    (None, "some words here that go on and on", "en", "s", 3, "x", "y"),
    (None, "some words here that go on and on", "en", "s", 3, "x", "y"),
    (4, " \n\t ", "de", None, 4, None, None),
    (5, LONG, "en", "s", 9, "x", "y"),
    (6, LONG, None, "s", 9, "x", "y"),
    (7, "é̀ 日本 ▁ 😀  \x00 12", "fr", "s", 9, "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize(
    "drop",
    [
        exact.drop_exact_duplicates,
        simhash.drop_near_duplicates,
        lambda df: decontam.drop_contaminated(df, df.sparkSession.createDataFrame([(1, LONG)], "item_id long, text string")),
        lambda df: langid.keep_identified(df, langid.train_network([("en", b"some", 1), ("fr", b"autre", 1)], steps=2)),
    ],
    ids=["exact", "near", "contaminated", "identified"],
)
def test_filters_keep_columns_of_any_name(odd, drop):
    names = ["__own", "__win", "__first", "__key", "__doc", "__text", "a.b", "n", "id", "hash", "item", "words", "digest", "salt", "key", "fp", "lang_pred"]
    df = odd.select("*", *(F.concat_ws("-", F.lit(name), "doc_id").alias(name) for name in names))
    rows = drop(df).collect()
    assert drop(df).columns == df.columns and rows
    assert all(r[name] == name + (f"-{r['doc_id']}" if r["doc_id"] else "") for r in rows for name in names)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


def test_exact_duplicates(odd, empty, documents, texts):
    rows = {(r["doc_id"], r["kept"]): r for r in exact.exact_duplicates(odd).collect()}
    assert len(exact.exact_duplicates(odd).collect()) == len(ODD)
    assert rows[3, True]["keep_id"] == 3 and rows[3, True]["group_size"] == 4 and rows[1, False]["keep_id"] == 3
    assert rows[None, True]["keep_id"] is None and (None, False) in rows
    assert (6, True) in rows and (5, False) in rows
    kept = exact.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == 5
    assert exact.exact_duplicates(empty).count() == 0 == exact.drop_exact_duplicates(empty).count()
    largest = {}
    for i, t in texts.items():
        largest[t] = max(i, largest.get(t, -1))
    assert {r["doc_id"] for r in exact.drop_exact_duplicates(documents).collect()} == set(largest.values())


def test_colliding_digests_stop_the_job(spark):
    rows = spark.createDataFrame([(1, "a", "same"), (2, "b", "same")], "doc_id long, text string, digest string")
    with pytest.raises(Exception, match="two texts share a digest"):
        exact.text_classes(rows).collect()


def test_shards(odd, empty, documents):
    rows = shards.shard_documents(documents, rows_per_bucket=2).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r["doc_id"], r["shard"]) for r in rows} == {(r["doc_id"], r["shard"]) for r in shards.shard_documents(documents).collect()}
    got = shards.shard_documents(odd).collect()
    assert len(got) == len(ODD) and len({(r["shard"], r["slot"]) for r in got}) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["size"] == 1 and by_id[1]["text_crc32"] == 0
    assert by_id[5]["text_crc32"] == zlib.crc32(LONG.encode())
    assert shards.shard_documents(empty).count() == 0


def test_weights_decide_shares_and_moves(spark):
    ids = spark.range(20_000)
    share = lambda w: {r["id"]: r["s"] for r in ids.select("id", shards.rendezvous_shard(ids["id"], w).alias("s")).collect()}
    before, after = share([1.0, 3.0, 0.0]), share([1.0, 3.0, 4.0])
    assert abs(Counter(before.values())[1] / 20_000 - 0.75) < 0.02 and 2 not in before.values()
    assert all(after[k] in (v, 2) for k, v in before.items()) and abs(Counter(after.values())[2] / 20_000 - 0.5) < 0.02
    with pytest.raises(ValueError):
        shards.rendezvous_shard(ids["id"], [])


def test_chat_perspectives(spark):
    rows = [(1, 0, "ann", "hi", 1), (1, 1, "bob", "yo", 1), (1, 2, "cy", None, 1), (1, 300, "ann", "late", 1), (None, None, None, "x", 1), (None, None, None, "x", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, speaker int")
    got = {(r["conv_id"], r["speaker"], r["part"]): r for r in chat.rotate_perspectives(df).collect()}
    assert set(got) == {(1, s, 0) for s in ("ann", "bob", "cy")} | {(None, "unknown", 0)}
    r = got[1, "bob", 0]
    assert r["text"].startswith("<|im_start|>user name=ann\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user name=cy\n<|im_end|>\n")
    a, b = map(int, r["mask"].split(":"))
    assert r["text"][a:b] == "yo<|im_end|>\n" and (r["n_turns"], r["n_own"]) == (4, 1)
    assert got[None, "unknown", 0]["n_own"] == 2
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def test_sentencepiece_equals_the_library(odd, empty, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rnd = random.Random(1)
    samples = [r[1] for r in ODD] + [" " * k for k in range(40)] + ["x" + " " * k + "ñz" for k in range(40)] + list(texts.values())[:60]
    samples += ["".join(rnd.choice("ab  \n.ée😀thein") for _ in range(rnd.randrange(60))) for _ in range(400)]
    samples += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x4E00, 0x9000)])) for _ in range(60)) for _ in range(60)]
    table = spm.piece_table(PIECES)
    ids, offsets = spm.Encoder(table).encode(pa.array(samples, pa.string()))
    want = model.encode([s or "" for s in samples])
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == want
    assert spm.decode_ids(table, ids, offsets).to_pylist() == [model.decode(w) for w in want]
    rows = spm.encode_texts(odd, PIECES)
    assert all(r["round_trip"] == (r["doc_id"] != 7) and r["n_tokens"] == len(r["ids"]) for r in rows.collect())
    assert Counter(r["text"] for r in spm.decode_tokens(rows, PIECES).collect())[LONG] == 2
    assert spm.encode_texts(empty, PIECES).count() == 0


def test_fingerprint_and_golay_keys():
    text = "The cat\tSAT on É mats the cat sat"
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    assert simhash.fingerprint(text) == sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = lambda f: [set(k[o == i]) for k, o in [simhash.golay_keys(f)] for i in range(len(f))]
    own = sets(fps)
    for pair in [(0, 1), (63, 40), (22, 23), (10, 10), *rng.integers(0, 64, (30, 2)).tolist()]:
        flip = np.uint64(0)
        for b in set(pair):
            flip ^= np.uint64(1 << int(b))
        assert all(a & b for a, b in zip(own, sets(fps ^ flip), strict=True))


@pytest.mark.parametrize("limit", [64, 2])
def test_near_duplicates_equal_brute_force(spark, documents, texts, limit):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    base = [rnd.choice(words) for _ in range(400)]
    near = []
    for i in range(60):
        copy = base.copy()
        copy[rnd.randrange(400)] = rnd.choice(words)
        near.append((10_000 + i, " ".join(copy)))
    rows = [*sorted(texts.items())[:120], *near, (20_000, None), (20_001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fps = {i: simhash.fingerprint(t) for i, t in rows}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df, bucket_limit=limit).collect()}
    assert got == {i: (f"{fps[i]:016x}", find(i)) for i in fps}
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(df, bucket_limit=limit).collect()} == {find(i) for i in fps}


def test_near_duplicates_of_odd_rows(odd, empty):
    assert simhash.near_duplicates(odd).count() == len(ODD)
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 5, 7, None}
    assert simhash.near_duplicates(empty).count() == 0 == simhash.drop_near_duplicates(empty).count()


def removed_by_force(docs, length):
    seen = Counter(d[i : i + length] for d in docs for i in range(len(d) - length + 1))
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        left = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        yield len(d), sum(gone), sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize(("length", "gram", "batch"), [(12, 4, 4096), (12, 4, 4), (20, 8, 8)])
def test_repeats_equal_brute_force(spark, length, gram, batch):
    rnd = random.Random(5)
    docs = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(120))) for _ in range(50)] + ["a" * 100, "ab" * 80, "", "a" * 100, None, "éé" * 30]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    want = dict(enumerate(removed_by_force([(d or "").encode() for d in docs], length)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(df, length=length, gram=gram, batch_size=batch).collect()}
    assert got == want


def test_repeats_of_real_and_odd_rows(documents, odd, empty, texts):
    want = dict(zip(texts, removed_by_force([t.encode() for t in texts.values()], 400), strict=True))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(documents).collect()}
    assert got == want
    by_id = {r["doc_id"]: r for r in repeats.remove_repeats(odd).collect()}
    assert by_id[5]["n_removed"] == len(LONG) == by_id[6]["n_removed"] and by_id[7]["n_removed"] == 0 == by_id[1]["n_bytes"]
    assert repeats.remove_repeats(empty).count() == 0


def test_url_rules_and_model(spark):
    cases = {
        "http://a.Example.ORG/en/12?x": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/es/#t": ("example.org", "/es/", "example.org/es/", "block"),
        "x://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://b.com/de/1": ("b.com", "/de/1", "com/de/", "block"),
        "http://b.com/fr/1": ("b.com", "/fr/1", "com/fr/", "allow"),
        "http://c.org": ("c.org", "", None, None),
        "no scheme/org/": ("", "", None, None),
        None: ("", "", None, None),
    }
    more = [f"http://good{i}.org/page" for i in range(80)] + [f"http://bad{i}.com/de/junk" for i in range(80)] + ["http://good7.net/page", "http://bad9.net/junk"]
    rows = [(i, u, "z") for i, u in enumerate([*cases, *more])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)
    got = {r["page_id"]: r for r in urls.judge_urls(df).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    assert [got[len(rows) - 2]["verdict"], got[len(rows) - 1]["verdict"]] == ["allow", "block"]
    assert urls.judge_urls(df.limit(0)).count() == 0 and got[7]["score"] == 0


def test_masks_find_every_window_with_two_substitutions():
    for mask in decontam.MASKS:
        shown = [i for i, c in enumerate(mask) if c == "1"]
        for n in (0, 1, 2):
            for bad in combinations(range(decontam.WINDOW), n):
                assert any(not {p + s for s in shown} & set(bad) for p in range(decontam.WINDOW - len(mask) + 1))


def test_decontamination(spark, odd, empty):
    item = [f"word{i}" for i in range(30)]
    short = "alpha beta gamma delta epsilon zeta"
    bench = spark.createDataFrame([(1, " ".join(item)), (2, short), (3, "too short"), (4, None), (None, " ".join(item))], "item_id long, text string")
    swap = item[5:18].copy()
    swap[3], swap[9] = "x", "y"
    third = swap.copy()
    third[6] = "z"
    docs = {
        1: "before " + ", ".join(item).upper() + " after",
        2: "so " + " ".join(swap) + " on",
        3: "so " + " ".join(third) + " on",
        4: "and " + short + " too",
        5: "and " + short.replace("gamma", "other"),
        6: " ".join(item[:12]),
        7: None,
        8: LONG + " ".join(item) + " " + LONG,
        9: "too short",
    }
    df = spark.createDataFrame([*docs.items(), (1, docs[1])], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["contaminated"], list(r["items"])) for r in decontam.decontaminate(df, bench).collect()}
    assert got == {1: (True, [1]), 2: (True, [1]), 3: (False, []), 4: (True, [2]), 5: (True, [2]), 6: (False, []), 7: (False, []), 8: (True, [1]), 9: (True, [3])}
    assert decontam.decontaminate(df, bench).count() == 10
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(df, bench).collect()) == [3, 6, 7]
    assert decontam.drop_contaminated(odd, bench).count() == len(ODD) == decontam.decontaminate(odd, bench.limit(0)).count()
    assert decontam.decontaminate(empty, bench).count() == 0


def test_token_blocks(spark, odd, empty, documents, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    samples = [r[1] for r in ODD] + ["it's don't I'LL x", "Á ́b", "\x1c a\x85b", "İstanbul ΣΑΣ €. x(y)'s", "<|endoftext|>", *list(texts.values())[:60]]
    ids, offsets = tokens.token_ids(WORDS, pa.array(samples, pa.string()), 1)
    want = [e.ids + [1] for e in tokenizer.encode_batch([s or "" for s in samples], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == want
    rng = np.random.default_rng(1)
    values = rng.choice([0, 1, 255, 256, 65_535, 65_536, 2**32 - 1], 5000).astype(np.uint32)
    block = tokens.Block(tokens.pack_block(np.array([7]), np.array([5000]), values))
    at = rng.integers(0, 5000, 3000)
    assert (block.get(at) == values[at]).all() and len(tokens.Block(tokens.pack_block(np.zeros(0), np.zeros(0), np.zeros(0))).get([])) == 0
    start, expected = 0, {}
    for i in sorted(texts):
        own = tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
        expected[i] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    got = tokens.read_token_blocks(tokens.write_token_blocks(documents, WORDS, block_tokens=500))
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()} == expected
    rows = tokens.read_token_blocks(tokens.write_token_blocks(odd, WORDS)).collect()
    assert len(rows) == len(ODD) and sum(r["doc_id"] is None for r in rows) == 2 and min(r["start"] for r in rows) == 0
    assert tokens.read_token_blocks(tokens.write_token_blocks(empty, WORDS)).count() == 0


def test_special_tokens_in_texts_as_the_library_by_default(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)  # as loaded
    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [f"a {end} b", f"{end}{start}{end}", f"foo{start}'s {end.upper()} x", "<|endof", "text|> y", f"É{end}\u0301a", f"z{end}", None, "<|endoftext|", f"<{end}>", "plain it's"]
    encode = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
    ids, offsets = tokens.token_ids(WORDS, pa.array(texts), 1, specials=True)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [encode(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = tokens.read_token_blocks(tokens.write_token_blocks(df, WORDS)).collect()
    sizes = np.cumsum([0, *(len(encode(t)) for t in texts)]).tolist()
    want = {i: (sizes[i], len(encode(t)), zlib.crc32(np.array(encode(t), "<u4").tobytes())) for i, t in enumerate(texts)}
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    net = langid.train_network([("a", b"abc", 1), ("b", b"xyz", 2), ("a", b"bcd", 1)], hidden=4, steps=1)
    for cell in (net.ahead, net.behind):
        cell.wx, cell.uh = cell.wx.astype(float), cell.uh.astype(float)
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    x, y = np.frombuffer(b"abcxyzbcd", np.uint8).reshape(3, 3), np.array([0, 1, 0])
    loss = lambda: -np.mean(net.log_probabilities(x)[np.arange(3), :, y])
    for w, g in zip(net.weights(), net.step(x, y), strict=True):
        for _ in range(10):
            i = tuple(rng.integers(0, d) for d in w.shape)
            i = (int(x.ravel()[rng.integers(9)]), i[1]) if w.shape[0] == 256 else i
            old = w[i]
            w[i], up = old + 1e-5, 0
            up = loss()
            w[i] = old - 1e-5
            down = loss()
            w[i] = old
            assert abs((up - down) / 2e-5 - g[i]) < 1e-7


def test_language_of_held_out_documents(documents, odd, empty):
    net = langid.train(documents)
    rows = langid.predict_language(documents, net).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)
    got = langid.predict_language(odd, net).collect()
    assert len(got) == len(ODD) and all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (1, 2, 3, 4))
    kept = langid.keep_identified(odd, net, least=-np.inf)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {None, 5, 6, 7}
    assert langid.predict_language(empty).count() == 0
    assert {r["lang_pred"] for r in langid.predict_language(odd.where("doc_id < 4")).collect()} == {"und"}


def test_stage_keeps_what_has_a_language(spark, documents, odd):
    lettered = {i for i, t in [(r["doc_id"], r["text"]) for r in documents.collect()] if any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in langid.keep_identified(documents).collect()} == lettered
    # Without any label every text with a letter stays.
    bare = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in langid.keep_identified(bare).collect()} == lettered
    # What no learned text is like goes, however long it is; short clean texts stay.
    net = langid.train(documents)
    least = langid.calibrated(langid.learned_documents(documents), net)
    junk = " ".join("\x7f\x01\x02x\x03\x05" * 3 for _ in range(200))
    values = langid.typical(net, pa.array([junk, junk[:40], "the", *[r["text"] for r in documents.where("text IS NOT NULL AND lang IS NOT NULL").limit(50).collect()]]))
    assert least < values[2:].min() and np.isfinite(least)
    assert langid.keep_identified(spark.createDataFrame([(1, junk, None)], "doc_id long, text string, lang string"), net, least=values[0] + 0.01).count() == 0


def test_stage_tells_the_language_of_each_text(spark, documents):
    import corpus_pipeline

    # Labels that nothing may be learned from are missing or wrong; the texts tell the languages all the same.
    given = F.when(~langid.is_held_out(), F.col("lang")).when(F.col("doc_id") % 2 == 0, F.lit("xx"))
    rows = documents.withColumn("lang", given)
    truth, net = {r["doc_id"]: r["lang"] for r in documents.collect()}, langid.train(rows)
    want = {r["doc_id"]: r["lang_pred"] for r in langid.predict_language(rows, net).collect()}
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, rows, SMALL).collect()}
    assert got == {i: want[i] for i in got} and len(got) > 0.9 * len(truth) and "und" not in got.values()
    held = [r["doc_id"] for r in rows.where(langid.is_held_out()).collect() if r["doc_id"] in got]
    assert held and np.mean([got[i] == truth[i] for i in held]) > 0.95
    # In the type of the column, or as a column of its own; where nothing can be learned a label stays.
    numbers = documents.withColumn("lang", F.ascii("lang"))
    told = langid.keep_identified(numbers)
    assert told.schema["lang"].dataType == numbers.schema["lang"].dataType
    assert np.mean([r["lang"] == ord(truth[r["doc_id"]][0]) for r in told.collect()]) > 0.95
    added = langid.keep_identified(documents.drop("lang"), net, least=-np.inf)
    assert added.columns == [*documents.drop("lang").columns, "lang"] and {r["doc_id"]: r["lang"] for r in added.collect()} == {i: w for i, w in want.items() if w != "und"}
    held_only = langid.keep_identified(documents.where(langid.is_held_out()))
    assert held_only.count() and all(r["lang"] == truth[r["doc_id"]] for r in held_only.collect())


def test_training_sample_is_bounded_whatever_repeats(spark):
    rows = [(i, f"w{i} same", "aa") for i in range(300)] + [(7, "hot text", "aa")] * 600 + [(i, f"v{i}", "bb") for i in range(5)] + [(9, None, "bb"), (9, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = langid.training_words(df, docs_per_language=50)
    aa = {w: n for lang, w, n in got if lang == "aa"}
    assert 49 <= aa[b"same"] <= 50 and aa.get(b"hot", 1) == 1 and aa[b"same"] + aa.get(b"hot", 0) == 50
    held = {r["doc_id"] for r in df.where(langid.is_held_out()).select("doc_id").collect()}
    assert {w for lang, w, n in got if lang == "bb"} == {f"v{i}".encode() for i in range(5) if i not in held}
    assert sorted(got) == sorted(langid.training_words(df.repartition(2), docs_per_language=50))
    words = langid.training_words(df, docs_per_language=50, words_per_language=3)
    assert Counter(w[0] for w in words)["aa"] == 3


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    from checks.compare import canonical, duck

    df = QUERIES[name](spark, SMALL)
    cursor = duck(SMALL).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), names)


def test_pipeline_stages_in_turn(spark, documents, texts):
    import corpus_pipeline

    bench = {r["item_id"]: set(r["text"].split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    assert bench
    docs, counts = documents, [documents.count()]
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SMALL)
        counts.append(docs.count())
        if name != "sentencepiece":
            assert docs.columns == documents.columns
    assert counts == sorted(counts, reverse=True) and counts[2] == len(set(texts.values()))
    assert corpus_pipeline.run(spark, SMALL).count() == counts[-1]
