"""Each operator against a plain version on small tables."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from glyphmill.llm import decontaminate, embedding_dedup, jaccard_join, language_id, packing, quality, sharding, substring_dedup, token_store
from glyphmill.llm._bytes import grams, hash_words, split_words, utf8
from glyphmill.llm._spark import connected_components, shared_dir
from glyphmill.llm.tokens import UnitTokenizer, public_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    """Originals, copies with edits, shared passages and short texts."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(45)]
    out = []
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 6, 12, 40, 150]))]
        if i % 3 == 0:
            words[1:1] = passage
        out.append(words)
        for _ in range(rnd.choice([0, 0, 1, 4])):
            copy = list(words)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            out.append(copy)
    rnd.shuffle(out)
    return [" ".join(w) if i % 2 else "\n ".join(w).title() for i, w in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def test_words_and_grams():
    column = pa.array(["a b", None, "", " c\n\nd e", "é"])
    data, offsets = utf8(column)
    start, end, first = split_words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end)] == ["a", "b", "c", "d", "e", "é"]
    assert first.tolist() == [0, 2, 2, 2, 5, 6]
    h = hash_words(data, start, end)
    assert len(set(h.tolist())) == 6
    assert (grams(h, 3)[1:] == grams(h[1:], 3)).all()
    long = pa.array(["x" * 700_000 + " y " + "x" * 700_000 + " Y"])
    data, offsets = utf8(long)
    start, end, _ = split_words(data, offsets)
    h = hash_words(data, start, end, lower=True)
    assert h[0] == h[2] and h[1] == h[3]


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (2, 60)])
def test_jaccard(docs, texts, k, percent):
    sets = []
    for t in texts:
        w = WORD.findall(t.translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(sets)))
    for _ in range(len(sets)):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    p = jaccard_join.JaccardParams(shingle=k, percent=percent, chunk_bytes=4000, heavy_list=20, family_block=8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, p).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


def test_subset_sizes_cover_all_partners():
    for percent in (60, 80, 85):
        for a in range(1, 25):
            for b in range(a, 25):
                need = -(-percent * (a + b) // (100 + percent))
                if need <= a:
                    assert need in jaccard_join.subset_sizes(a, percent) and need in jaccard_join.subset_sizes(b, percent)


@pytest.mark.parametrize("block", [2000, 10**6])
def test_substring(docs, texts, block):
    seen, expected = set(), {}
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            x = tuple(w[s : s + 20])
            if x in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(x)
        kept = [x for x, g in zip(w, gone) if not g]
        expected[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    got = substring_dedup.find_repeats(docs, substring_dedup.SubstringParams(block_bytes=block)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, WORD.findall(r.kept_text)) for r in got} == expected
    assert sum(e[1] for e in expected.values()) > 0
    # each factor is one match: its words stand at the place that it names, which is before it
    order = [w for t in texts for w in WORD.findall(t)]
    first, at = {}, 0
    for i, t in enumerate(texts):
        first[i] = at
        at += len(WORD.findall(t))
    if block == 10**6:  # one block: places are words of the whole input
        factors = [(r.doc_id, f) for r in got for f in r.spans]
        for d, f in factors:
            begin = first[d] + f.first
            assert f.block == 0 and f.words >= 20 and f.word < begin and order[begin : begin + f.words] == order[f.word : f.word + f.words]
        assert len(factors) > 20
    for r in got:
        covered = {w for f in r.spans for w in range(f.first, f.first + f.words)}
        assert len(covered) == r.n_removed


def test_blocks_are_parsed_in_little_memory():
    rnd = np.random.default_rng(3)
    vocabulary = np.array([f"w{x:04d}" for x in range(5000)])
    texts = [" ".join(rnd.choice(vocabulary, 1000)) for _ in range(400)]
    texts[300] = texts[20]
    table, p = pa.table({"k": range(400), "t": texts, "block": [0] * 400}), substring_dedup.SubstringParams()
    words = 400_000
    list(substring_dedup._results(substring_dedup.Block(table, p), np.full(400 * 981, substring_dedup.NOWHERE), p))  # what is made once
    tracemalloc.start()
    block = substring_dedup.Block(table, p)
    assert tracemalloc.get_traced_memory()[1] < 70 * words
    tracemalloc.stop()
    source = np.full(len(block.at), substring_dedup.NOWHERE)
    source[300 * 981 : 301 * 981] = block.places(np.arange(20 * 981, 21 * 981))
    rows, most = [], 0
    for batch in substring_dedup._results(block, source, p):
        most = max(most, batch.column("kept_text").nbytes)
        rows += batch.to_pylist()
    assert most < 1.5 * (1 << 20)
    assert [r["doc_id"] for r in rows] == list(range(400)) and [r["n_removed"] for r in rows] == [1000 * (i == 300) for i in range(400)]
    assert rows[300]["spans"] == [{"first": 0, "words": 1000, "block": 0, "word": 20000}] and rows[300]["kept_text"] == ""
    assert all(r["kept_text"] == t and not r["spans"] for i, (r, t) in enumerate(zip(rows, texts)) if i != 300)


def test_jump_hash(spark):
    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    rnd = random.Random(2)
    keys = [rnd.getrandbits(64) - 2**63 for _ in range(300)] + [0, -1, 2**63 - 1, -(2**63)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 16, 17, 5000):
        assert [r.s for r in rows.select(sharding.jump_hash(rows.k, n).alias("s")).collect()] == [jump(k % 2**64, n) for k in keys]


def test_tokenizer_is_exact(texts):
    tokenizer, library = UnitTokenizer(public_path("byte_bpe_50k.json")), Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    pieces = [" ", "  ", "\n", "\t", "a", "Zb", "é", "　", "中", "12", "'s", "'", "!", "...", "<|endoftext|>", "<|endoftext", "|>", "<", "\r\n", "\x85", " ", "😀", "Ç", " x"]
    rows = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + texts
    rows += ["", "<|endoftext|>", "", "<|endoftext|><|endoftext|>", "a  ", "<x", "a <|endoftext", "|>", "a\n", "b"]
    ids, first = tokenizer.encode(*utf8(pa.array(rows)))
    plain = library.encode_batch(rows, add_special_tokens=False)
    assert all(ids[first[i] : first[i + 1]].tolist() == e.ids for i, e in enumerate(plain))
    assert library.token_to_id("<|endoftext|>") in ids


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    packed = token_store.pack_bits(ids, bits)
    assert len(packed) == 16 * bits and (token_store.unpack_bits(packed, bits, 1000) == ids).all()


def test_token_store_and_packing(spark, docs, texts):
    tokenizer = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    ids = [np.array([*e.ids, 0], "<u4") for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    folder = shared_dir(spark, "brute")
    params = token_store.StoreParams(bytes_per_task=5000, ids_per_file=2000)
    got = token_store.read_token_store(spark, folder, token_store.write_token_store(docs, folder, params)).orderBy("doc_id").collect()
    before = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == [(i, before[i], len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]
    assert len({r.file for r in got}) > 2
    pieces = packing.pack_documents(docs, packing.PackParams(ids_per_shard=4000)).collect()
    covered = Counter()
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        covered.update((r.doc_id, x) for x in range(r.start, r.start + r.length))
    assert set(covered.values()) == {1} and len(covered) == before[-1]


@pytest.mark.parametrize("dense,all_seeds", [(16, 4096), (2, 0), (1, 4096)])
def test_neighbours_are_bm25_order(dense, all_seeds):
    rnd = np.random.default_rng(4)
    docs = [rnd.integers(0, 30, rnd.integers(5, 40)) for _ in range(20)]
    first = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=30)
    idf, mean = np.log(1 + (20 - df + 0.5) / (df + 0.5)), first[-1] / 20
    p = packing.PackParams(neighbours=20, dense=dense, all_seeds=all_seeds)
    index = packing.ShardIndex(np.concatenate(docs), first, idf, mean, p)
    unused = np.ones(20, bool)
    unused[3] = False
    score = np.zeros(20)
    for t in set(docs[3].tolist()):
        tf = np.array([(d == t).sum() for d in docs])
        score += idf[t] * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * np.array([len(d) for d in docs]) / mean))
    expected = [d for d in np.argsort(-score, kind="stable") if d != 3 and score[d] > 0]
    assert np.allclose(index.scores(3), score, rtol=1e-5)
    assert np.allclose(score[index.neighbours(3, unused)], score[expected])
    few = packing.ShardIndex(np.concatenate(docs), first, idf, mean, packing.PackParams(neighbours=5, dense=dense, all_seeds=all_seeds))
    assert few.neighbours(3, unused).tolist() == index.neighbours(3, unused)[:5].tolist()


def test_neighbours_by_light_and_frequent_terms(spark):
    docs = [np.arange(31), np.array([30, 31, 32]), np.array([33])]
    idf = np.where(np.arange(34) == 30, 0.5, 5.0)
    index = packing.ShardIndex(np.concatenate(docs), np.array([0, 31, 34, 35]), idf, 12.0, packing.PackParams())
    assert index.neighbours(0, np.array([False, True, True])).tolist() == [1]
    # two groups, each of half of all documents: a window holds one of them
    words = ["river stone window garden ", "engine copper signal harbour "]
    rows = [(i, words[i % 2] * 60) for i in range(20)]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    first = {r.doc_id % 2 for r in pieces if r.sequence_id == min(p.sequence_id for p in pieces)}
    assert first == {0}


def test_leaks(spark):
    def distance(pattern, text):
        before = [0] * (len(text) + 1)
        for i, c in enumerate(pattern):
            now = [i + 1]
            for j, e in enumerate(text):
                now.append(min(before[j] + (c != e), before[j + 1] + 1, now[j] + 1))
            before = now
        return min(before)

    rnd = random.Random(6)
    items = [(i, "".join(rnd.choice("abcd ef") for _ in range(rnd.randint(40, 120))).strip().replace("  ", " a ")) for i in range(4)]
    rows = []
    for i in range(40):
        s = list(rnd.choice(items)[1])
        for _ in range(rnd.randint(0, 14)):
            j = rnd.randrange(len(s))
            s[j : j + rnd.randint(0, 1)] = rnd.choice(["", "x", "yz"])
        rows.append((i, "qq ww " * 5 + "".join(s).upper() + " rr tt" * 4))
    p = decontaminate.LeakParams()
    index = decontaminate.PatternIndex(list(decontaminate._patterns(items, p)), p)
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    expected = set()
    for i, t in rows:
        text, _, _ = decontaminate.normalise(*utf8(pa.array([t])))
        expected |= {(i, index.item[x][0]) for x in range(len(index.m)) if distance(index.pattern[x], text.tobytes()) <= index.k[x]}
    assert {(r.doc_id, r.item_id) for r in got} == expected and 5 < len(expected) < 40
    assert all(r.begin < r.end <= len(rows[r.doc_id][1].encode()) for r in got)


def test_embeddings(spark):
    rnd = np.random.default_rng(8)
    base = rnd.standard_normal((150, 32))
    x = np.concatenate([base, base[:60] + 0.05 * rnd.standard_normal((60, 32)), np.repeat(base[:1], 40, axis=0) + 0.03 * rnd.standard_normal((40, 32)), np.repeat(base[5:7], [60, 3], axis=0)]).astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    params = embedding_dedup.EmbeddingParams(bucket=32, block=16, recall=0.9999)
    got = embedding_dedup.link_embeddings(vectors, params).orderBy("vec_id").collect()
    assert [r.n_links for r in got] == near.sum(axis=1).tolist()
    root = np.arange(len(u))
    for _ in range(10):
        root = np.array([min(root[i], *root[near[i]]) if near[i].any() else root[i] for i in range(len(u))])
    assert [r.component_id for r in got] == root.tolist()


def test_embeddings_round_a_hot_mean(spark):
    rnd = np.random.default_rng(13)
    noise = rnd.standard_normal((600, 64)) / 8
    mean = np.eye(64)[0] + 0.3 * np.eye(64)[1]
    x = np.concatenate([mean + 0.31 * np.linalg.norm(mean) * noise[:400], 0.5 * mean + noise[400:]])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embedding_dedup.link_embeddings(vectors, embedding_dedup.EmbeddingParams(bucket=8, block=128)).collect()
    assert near.sum() > 50_000
    assert 0.98 <= sum(r.n_links for r in got) / near.sum() <= 1


@pytest.mark.parametrize("n", [6_000, 50_000, 1_000_000])
@pytest.mark.parametrize("share", [0.0, 0.5, 0.7])
def test_buckets_meet_at_any_mean(n, share):
    """Default tables for n vectors: pairs just above the threshold, with a common component of that share of the squared length."""
    p, dims, m = embedding_dedup.EmbeddingParams(), 64, 5000
    bits, tables = embedding_dedup.plan_tables(n, p)
    planes = np.concatenate([embedding_dedup.rotation(dims, p.seed + 1 + i) for i in range(-(-bits * tables // dims))], axis=1)[:, : bits * tables]
    rnd = np.random.default_rng(3)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    a = unit(np.eye(dims)[0] * share**0.5 + (1 - share) ** 0.5 * unit(rnd.standard_normal((m, dims))))
    away = rnd.standard_normal((m, dims))
    b = 0.905 * a + (1 - 0.905**2) ** 0.5 * unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    met = (((a @ planes >= 0) == (b @ planes >= 0)).reshape(m, tables, bits).all(axis=2)).any(axis=1)
    assert met.mean() >= 0.993


def test_codes_estimate_without_bias():
    rnd = np.random.default_rng(9)
    dims = 64
    x = rnd.standard_normal((300, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    center, errors = np.zeros(dims), []
    for seed in range(20):
        signs, unit, _, factor = embedding_dedup.codes(x, embedding_dedup.rotation(dims, seed), center)
        errors.append((unit[:1] @ signs.T)[0] / factor - x[:1] @ x.T)
    assert abs(np.mean(errors)) < 0.005
    turn = embedding_dedup.rotation(dims, 1)
    coded = embedding_dedup.codes(x, turn, center)
    bound = embedding_dedup.upper_bounds(coded, coded, center, x, x, 4.0)
    assert (bound >= x @ x.T - 1e-9).mean() > 0.999


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i % 7] + [(100, 3), (100, 39), (50, 51)]
    got = {r.id: r.component for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_components_of_long_paths(spark):
    ids = np.random.default_rng(12).permutation(np.arange(1000, 1400)).tolist()
    falling = [0, *range(100, 0, -1)]
    edges = [*zip(falling, falling[1:]), *zip(ids, ids[1:])]
    got = {r.id: r.component for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(falling, 0), **dict.fromkeys(ids, 1000)}


def test_language_and_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = language_id.predict_languages(docs, language_id.learn_languages(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    scored = quality.score_quality(docs, quality.train_quality(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.9


def test_bloom_filter_has_no_false_negative():
    params = language_id.LanguageParams(slot_bits=10)
    rnd = np.random.default_rng(10)
    codes = [rnd.integers(0, 2**32, 100, dtype=np.uint64).astype(np.uint32) for _ in range(70)]
    model = language_id.BloomLanguages([f"l{i:02}" for i in range(70)], codes, params)
    for i in (0, 63, 64, 69):
        counts = model.counts(codes[i], np.array([0, 100]))
        assert counts[0].argmax() == i or counts[0, i] >= 95


def test_language_counts_by_sets(spark):
    """The corrected popcounts against plain sets of n-grams, and the choice that follows."""
    rnd = random.Random(21)
    words = {lang: ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(60)] for lang, letters in (("aa", "abcdefg"), ("bb", "defghij"), ("cc", "éßmnop"))}
    rows = [(i, " ".join(rnd.choice(words[lang]) for _ in range(30)), lang) for i, lang in enumerate(rnd.choice(["aa", "bb", "cc"]) for _ in range(240))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    params = language_id.LanguageParams(min_count=2)
    model = language_id.learn_languages(docs, params)

    def four(text):
        raw = b" " + text.encode() + b" "
        return [raw[i : i + 4] for i in range(len(raw) - 3)]

    seen = {lang: Counter() for lang in model.langs}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 5:
            seen[lang].update(four(text))
    often = {lang: {g: n for g, n in c.items() if n >= 2} for lang, c in seen.items()}
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in often.items()}
    held = {lang: {g for g, r in rate[lang].items() if r >= params.min_share * max(rate[o].get(g, 0) for o in rate)} for lang in rate}
    plain = np.array([[sum(g in held[lang] for g in four(text)) for lang in model.langs] for _, text, _ in rows], float)
    counts = model.counts(*language_id.text_grams(*utf8(pa.array([text for _, text, _ in rows]))))
    assert np.abs(counts - plain).max() <= 3 and (model.false_positive < 1e-3).all()
    got = {r.doc_id: r.lang_pred for r in language_id.predict_languages(docs, model).collect()}
    clear = [i for i in range(len(rows)) if np.sort(plain[i])[-1] - np.sort(plain[i])[-2] > 6]
    assert len(clear) > 200 and all(got[i] == model.langs[int(plain[i].argmax())] for i in clear)
    few = language_id.learn_languages(docs, language_id.LanguageParams(min_count=2, grams_per_lang=5))
    assert (few.counts(*language_id.text_grams(*utf8(pa.array([rows[0][1]])))) <= counts[:1] + 3).all()


def test_languages_without_a_checkpoint_folder():
    """learn_languages needs no setting in a local session."""
    import subprocess
    import sys

    code = """
from pyspark.sql import SparkSession
from glyphmill.llm import language_id
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
docs = spark.createDataFrame([(i, 'one two three' if i % 2 else 'eins zwei drei', 'en' if i % 2 else 'de') for i in range(40)], 'doc_id long, text string, lang string')
got = language_id.predict_languages(docs, language_id.learn_languages(docs)).collect()
assert {r.doc_id % 2: r.lang_pred for r in got} == {1: 'en', 0: 'de'}
"""
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=300).returncode == 0


def test_quality_by_plain_loops():
    """Features, fitting and scores against dictionaries and one weight at a time."""
    rnd = random.Random(31)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rnd.choice(words[:25] if i % 2 else words[15:]) for _ in range(rnd.randint(0, 30))) for i in range(80)]
    p = quality.QualityParams(weight_bits=12)
    data, offsets = utf8(pa.array(texts))
    rows = [Counter() for _ in texts]
    for index, owner in quality.hashed_features(data, offsets, p.weight_bits):
        for i, d in zip(index.tolist(), owner.tolist()):
            rows[d][i] += 1
    assert all(sum(r.values()) == sum(max(0, len(t.split()) - n + 1) for _, n in quality.FAMILIES) for r, t in zip(rows, texts))
    z, n = {}, {}

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= p.l1 else -(zi - (p.l1 if zi > 0 else -p.l1)) / ((p.beta + ni**0.5) / p.alpha + p.l2)

    def margin(row):
        norm = max(1, sum(row.values())) ** 0.5
        return sum(weight(i) * c / norm for i, c in row.items()) + weight("bias")

    for _ in range(p.epochs):
        for d, row in enumerate(rows):
            norm = max(1, sum(row.values())) ** 0.5
            error = 1 / (1 + np.exp(-margin(row))) - d % 2
            for i, x in [*((i, c / norm) for i, c in row.items()), ("bias", 1.0)]:
                w, g = weight(i), error * x
                z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / p.alpha * w
                n[i] = n.get(i, 0.0) + g * g
    fitted = quality.fit_ftrl([(np.array(list(r), np.int64), np.array([c / max(1, sum(r.values())) ** 0.5 for c in r.values()]), float(d % 2)) for d, r in enumerate(rows)], p)
    scores = quality.score_texts(data, offsets, *fitted, p.weight_bits)
    assert np.allclose(scores, [1 / (1 + np.exp(-margin(r))) for r in rows], atol=1e-4)


def test_packing_is_greedy():
    """Windows against a plain walk: best unused neighbours that fit, else the best one is cut and goes on."""
    rnd = np.random.default_rng(14)
    docs = [rnd.integers(0, 60, rnd.integers(1, 90)) for _ in range(50)]
    sizes, first = np.array([len(d) for d in docs]), np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=60)
    idf, mean, p = np.log(1 + (50 - df + 0.5) / (df + 0.5)), first[-1] / 50, packing.PackParams(window=128)
    score = np.zeros((50, 50))
    for a in range(50):
        for t in set(docs[a].tolist()):
            tf = np.array([(d == t).sum() for d in docs])
            score[a] += idf[t] * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * sizes / mean))
    got = packing.pack_shard(sizes, packing.ShardIndex(np.concatenate(docs), first, idf, mean, p), 128)
    unused, expected, filled, carry = list(range(50)), [], 0, None

    def put(d, start, n):
        nonlocal filled
        expected.append((d, start, n, filled // 128, filled % 128))
        filled += n

    while unused or carry:
        seed, start = carry or (unused.pop(0), 0)
        carry = None
        while start < sizes[seed]:
            n = int(min(sizes[seed] - start, 128 - filled % 128))
            put(seed, start, n)
            start += n
        while filled % 128 and carry is None:
            near = sorted((d for d in unused if score[seed][d] > 0), key=lambda d: (-score[seed][d], d))[: p.neighbours]
            if not near:
                break
            before = len(unused)
            for d in near:
                if sizes[d] <= 128 - filled % 128 and filled % 128:
                    put(d, 0, int(sizes[d]))
                    unused.remove(d)
            if filled % 128 and len(unused) == before:
                put(near[0], 0, int(128 - filled % 128))
                unused.remove(near[0])
                carry = (near[0], expected[-1][2])
    assert [tuple(int(x) for x in piece) for piece in got] == expected
