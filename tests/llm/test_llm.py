"""The training-data operators against brute force, on the test tables and on awkward rows."""

import collections
import hashlib
import math
import os
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from cadence.llm import catalog, chat, common, exact_dedup, langid, lm, mixing, near_dedup, packing, topk, toxicity, url_filter
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word " * 30_000 + "end"
AWKWARD = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n", "en", "a"), (4, "one two", "en", None), (5, "one two", "en", "b"),
           (5, "one two", "en", "b"), (5, "other text here", "en", "b"), (6, LONG, "en", "c"), (7, "12 34 !!", "de", "c"),
           (8, "one\t two", "fr", "a"), (None, "no id at all", "en", "a")]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("x") for c in ("score", "kept", "size", "sid", "row", "rid", "key", "node", "digest", "n_chars")})


@pytest.fixture(scope="module")
def none(awkward):
    return awkward.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(E.queries()[name](spark, SF), duck(SF), catalog.ORACLE_SQL[name])
    assert ok, msg


def test_every_operator_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


# --- packing

def test_packing_is_exact_and_gapless(spark, docs, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BPE)
    rows = packing.pack(docs, BPE, with_ids=True).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [x for p in parts for x in p["ids"]] == ids
        assert all(p["length"] == 1024 for p in parts[1:])
        assert all(zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"] for p in parts)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_seq) <= math.ceil(sum(r["length"] for r in rows) / 1024) * 1.02


def test_best_fit_decreasing_equals_piece_by_piece():
    rng = random.Random(3)
    for _ in range(200):
        cap = rng.choice([7, 16, 50])
        lengths = sorted((rng.randint(1, cap) for _ in range(rng.randint(0, 80))), reverse=True)
        placed, bins = packing.best_fit_decreasing(collections.Counter(lengths), cap)
        left = []
        for x in lengths:   # plain best fit
            fits = [b for b in range(len(left)) if left[b] >= x]
            if fits:
                left[min(fits, key=lambda b: left[b])] -= x
            else:
                left.append(cap - x)
        fill = collections.Counter()
        for length, _, n, per, first, offset in placed.tolist():
            for j in range(n):
                assert fill[first + j // per] == offset + j % per * length
                fill[first + j // per] += length
        assert bins == len(left) and sorted(fill.values()) == sorted(cap - x for x in left)


def test_encoder_equals_tokenizers():
    from tokenizers import Tokenizer
    t, e, rng = Tokenizer.from_file(BPE), packing.Encoder(BPE), random.Random(1)
    letters = list("ab A1²'s\n\t\r  .,é漢🙂 ́_<|>\x00") + ["<|endoftext|>", "'ll", "'S", "\n\n", "   "]
    for _ in range(3000):
        s = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        assert np.frombuffer(e(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_packing_awkward(awkward, none):
    rows = packing.pack(awkward, BPE).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(AWKWARD) and packing.pack(none, BPE).count() == 0


# --- language identification

def test_language_held_out_accuracy(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(big).join(big.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n > 0.97


def test_language_blocks_equal_plain_naive_bayes(spark, monkeypatch):
    rng = random.Random(8)
    letters = [rng.sample("abcdefghijklmnopqrstuvwxyz", 6) for _ in range(300)]
    rows = [(i, " ".join("".join(rng.choices(letters[i % 300], k=5)) for _ in range(12)), f"l{i % 300:03d}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}

    def grams(text):
        owner, feats = langid.features([langid.clean(text)])
        return feats.tolist()

    seen, n = collections.defaultdict(collections.Counter), collections.Counter()
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            seen[lang].update(grams(text))
            n[lang] += 1
    size = 1 << langid.BITS
    sums = {lang: [sum(c for f, c in seen[lang].items() if f // size == k) + 0.5 * size for k in range(3)] for lang in n}
    for i, text, _ in rows[::60]:
        found = {lang: math.log(n[lang] / sum(n.values())) + sum(math.log((seen[lang][f] + 0.5) / sums[lang][f // size]) for f in grams(text))
                 for lang in n}
        best = max(sorted(found), key=found.get)
        score = 1 / sum(math.exp(x - found[best]) for x in found.values())
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - score) < 1e-3


def test_language_awkward(awkward, none):
    rows = langid.identify(awkward).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == {"und"}
    assert langid.identify(none).count() == 0
    kept = langid.keep_identified(awkward)
    assert kept.columns == awkward.columns and not {1, 2, 3, 7} & {r["doc_id"] for r in kept.collect()}


def test_language_stage_keeps_texts_whose_languages_are_near(spark):
    langs = "abcd"
    rows = [(i, f"{'xyzv'[i % 4]}one word", langs[i % 4]) for i in range(80)] + [(100, "word", "a"), (101, "12", "a"), (102, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    everything = set(range(80)) | {100}
    assert {r["doc_id"] for r in langid.keep_identified(docs).collect()} == everything
    none = langid.keep_identified(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["doc_id"] for r in none.collect()} == everything


# --- exact dedup

def test_exact_dedup_awkward(awkward, none):
    rows = exact_dedup.classes(awkward).collect()
    groups = collections.defaultdict(list)
    for i, t, *_ in AWKWARD:
        groups[hashlib.sha256(norm(t).encode()).hexdigest()].append(i)
    for r in rows:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == min(ids, key=lambda i: (i is None, i or 0))
    assert len(rows) == len(AWKWARD) and sum(r["kept"] for r in rows) == len(groups)
    assert exact_dedup.keep_first(awkward).columns == awkward.columns and exact_dedup.classes(none).count() == 0


def test_exact_dedup_splits_late_differences(spark):
    base = "x" * 5000
    rows = [(i, base + tail) for i, tail in enumerate(["a", "b", "a", "", "a" * 300, "a" * 299 + "b", "a" * 300])]
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4, 5: 5, 6: 4}


# --- language model

def test_lm_base_score_and_model(docs, texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: WORD.findall((t or "").translate(low)) + [""] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = lm.score_documents(docs).collect()
    assert len(rows) == len(tokens)
    for r in rows:
        ws = tokens[r["doc_id"]]
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert abs(r["base_score"] - want) < 1e-6 and r["train_tokens"] == n and r["n_tokens"] == len(ws)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws) and r["score"] <= 0
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_log_frequency_filter_reads_levels_back():
    rng = np.random.default_rng(1)
    keys, counts = rng.integers(-2**62, 2**62, 5000), rng.integers(1, 5000, 5000).astype(float)
    k, levels = lm.entry(lm.WORDS, keys), lm.quantise(counts, 1)
    bloom = lm.LogFrequencyBloom.empty(int(levels.sum(dtype=np.int64)))
    bloom.add(k, levels)
    got = bloom.levels(k, 40)
    assert (got >= levels).all() and (got == levels).mean() > 0.98
    assert (bloom.levels(lm.entry(lm.WORDS, rng.integers(-2**62, 2**62, 5000)), 40) > 0).mean() < 0.02


@pytest.mark.parametrize("broadcast", [1 << 25, 0])
def test_lm_holds_every_word_and_pair(spark, monkeypatch, broadcast):
    monkeypatch.setattr(lm, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 40_000)
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.3)) % 10**6}" for _ in range(rng.randrange(400))) for _ in range(800)]
    tokens = [[""] + t.split() + [""] for t in texts]   # the end before a text's first word, and after its last
    train = [ws for i, ws in enumerate(tokens) if i % 5]
    words = collections.Counter(w for ws in train for w in ws[1:])
    pairs = collections.Counter(p for ws in train for p in zip(ws, ws[1:]))
    total = sum(words.values())
    assert total > 1e5 and len(pairs) > 2e4 and min(pairs.values()) == 1
    mass = collections.Counter()
    for (h, _), n in pairs.items():
        mass[h] += n - 0.75

    def mean_of_level(counts, least):
        levels = {k: 1 + math.floor(2 * math.log2(n / least) + 1e-9) for k, n in counts.items()}
        alike = collections.defaultdict(list)
        for k, level in levels.items():
            alike[level].append(counts[k])
        return {k: sum(alike[level]) / len(alike[level]) for k, level in levels.items()}

    q, q2, m = mean_of_level(words, 1), mean_of_level(pairs, 1), mean_of_level(mass, 0.25)

    def log_p(h, w):
        left = 1 - min(m[h] / q[h], 0.98) if h in m else 1
        seen = max(q2[h, w] - 0.75, 0) / max(q[h], q2[h, w]) if (h, w) in q2 else 0
        return math.log10(min(1, seen + left * q.get(w, 1) / (total + 1)))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 0).collect()}
    assert len(got) == len(texts)
    far = [abs(got[i] - sum(log_p(h, w) for h, w in zip(ws, ws[1:]))) / len(ws) for i, ws in enumerate(tokens)]
    assert max(far) < 0.1 and sum(far) / len(far) < 0.02   # false positives of the filter


def test_lm_awkward(awkward, none):
    assert lm.score_documents(awkward).count() == len(AWKWARD) and lm.score_documents(none).count() == 0


# --- top-k

@pytest.mark.parametrize("shard,block", [(4096, 4096), (40, 3)])
def test_topk_equals_brute_force(spark, shard, block):
    rng = random.Random(5)
    rows = [(i % 190, [rng.choice([-1.0, 0.0, 0.5, rng.random()]) for _ in range(8)]) for i in range(200)]
    rows += [(900, None), (901, [1.0] * 7 + [None]), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (910, [1.0, 2.0]), (920, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    v = topk.quantised(df)
    got = sorted(map(tuple, topk.search(v, v.where("vec_id % 10 = 0"), 5, shard, block).collect()))
    ints = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    per_id = collections.defaultdict(list)
    for q, e in ints:
        if q % 10 == 0:
            per_id[q] += [(-sum(a * b for a, b in zip(e, f)), i) for i, f in ints if i != q and len(f) == len(e)]
    # Ids that are asked once have a fixed answer.
    once = {q for q, n in collections.Counter(i for i, _ in ints).items() if n == 1}
    want = sorted((q, k + 1, i, -s) for q, found in per_id.items() if q in once for k, (s, i) in enumerate(sorted(found)[:5]))
    assert [g for g in got if g[0] in once] == want


# --- chat

def test_chat_awkward(spark):
    said = "<|im_end|>\\<|im_start|>assistant ok\\N"
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, said), (2, 0, "us\ner", said), (2, None, "assistant", said),
            (3, 1, "assistant", LONG), (3, 0, "user", "q"), (3, 0, "user", "q"), (None, 0, "user", "x"), (4, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("valid", F.lit(3))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    for c, turns in convs.items():
        turns.sort()
        lost = "".join(x for _, _, role, x in turns if role == "assistant")
        want = hashlib.sha256("".join(f"{role}\n{x}\n" for _, _, role, x in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == \
            (len(turns), want, len(lost), hashlib.sha256(lost.encode()).hexdigest())
    assert got[1]["valid"] and not got[2]["valid"] and not got[3]["valid"]
    assert chat.read_back(chat.format_turns(df.where("false"))).count() == 0


# --- toxicity

def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    # About 300 toxic rows to learn from here: half of the held-out ones are found (all of them with 1,700), no clean one.
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.5 and n.get((0, 1), 0) / n[0, 0] < 0.01


def test_deobfuscation():
    words = "you are an idiot and a loser the moron is stupid trash worthless clown " * 50
    from cadence.llm.common import code_points
    s, n = toxicity.symbols(code_points([words], 2)[0]), 28
    c = np.bincount((s[:-2] * n + s[1:-1]) * n + s[2:], minlength=n ** 3).reshape(n, n, n) + 0.1
    r = toxicity.Restorer(np.log(c / c.sum(axis=2, keepdims=True)))
    assert r.restore(["an 1d10t and l0ser", "m o r o n", "stuuupid cl0wwwn", "plain text, 12 a b", ""]) == \
        ["an idiot and loser", "moron", "stupid clown", "plain text, 12 a b", ""]


def test_deobfuscation_of_combined_disguises():
    plain = "you are an idiot and a loser the moron is stupid trash worthless clown ass hate shit losers what a hello! see covid19 (wow) (see) " * 50
    plain += "letter good book all too well tell see free soon mp3, item2 yes! no! " * 50
    from cadence.llm.common import code_points
    s, n = toxicity.symbols(code_points([plain], 2)[0]), 28
    c = np.bincount((s[:-2] * n + s[1:-1]) * n + s[2:], minlength=n ** 3).reshape(n, n, n) + 0.1
    r = toxicity.Restorer(np.log(c / c.sum(axis=2, keepdims=True)))
    given = ["a$$", "hat3", "s h 1 t", "i d 1 0 t", "m/o/r/o/n", "m  o  r  o  n", "iidiioott", "IdIIiot", "i.d.i.0.t", "l00$3r$", "m_o_r_o_n"]
    assert r.restore(given) == ["ass", "hate", "shit", "idiot", "moron", "moron", "idiot", "idiot", "idiot", "losers", "moron"]
    clean = ["hello! what a letter", "covid19", "mp3, item2", "yes! no!", "(see", "good book all too well", "1 2 3 4", "10 + 2", "2024", "wow!!!", ""]
    assert r.restore(clean) == clean


def test_deobfuscation_equals_all_paths_and_long_spans(monkeypatch):
    from itertools import product
    rng = np.random.default_rng(2)
    c = rng.dirichlet(np.full(28, 0.3), (28, 28)) + 1e-4
    logp = np.log(c / c.sum(axis=2, keepdims=True))
    monkeypatch.setattr(toxicity, "LOOK_BACK", 3)
    restorer = toxicity.Restorer(logp)

    def cost(parts):
        a = b = 0
        total = 0.0
        for text, channel in parts:
            total += channel
            for j, ch in enumerate(text):
                s = toxicity._symbol(ch)
                if j and s == toxicity.OTHER and ch == text[j - 1]:
                    continue
                total -= logp[a][b][s]
                a, b = b, s
        return total - logp[a][b][0]

    for span, apart in [("h3ll0", False), ("1d10t", False), ("b.4.d", True), ("s h 1 t", True), ("$$tuupid!", False), ("a_!_b", True), ("c0oo1", False)]:
        runs = re.findall(r"((.)\2*)", span)
        last, marks = len(span.rstrip("".join(toxicity.LOOKALIKE))), len(span) - len(span.lstrip("@$!|+("))
        at, steps = 0, []
        for run, ch in runs:
            steps.append(restorer.options(ch, len(run), at >= last or at < marks, apart))
            at += len(run)
        want = min(cost(parts) for parts in product(*steps))
        texts = {"".join(t for t, _ in parts) for parts in product(*steps) if cost(parts) < want + 1e-9}
        assert restorer.decode(span, apart) in texts
    monkeypatch.setattr(toxicity, "LOOK_BACK", 4096)
    tracemalloc.start()
    long = toxicity.Restorer(logp).decode("a.b." * 100_000, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(long) <= set("ab.") and peak < 40 * 400_000


def test_character_model_counts_rows_without_a_label(spark):
    rows = [(i, "you are an idiot" if i % 2 else "a plain text") for i in range(20)] + [(100 + i, "qzx " * 50) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    logp, _, _ = toxicity.train(docs, labels, F.lit(True))
    q, z, x = (ord(c) - 96 for c in "qzx")
    assert logp[q, z, x] > math.log(0.99) and logp[0, q, z] > math.log(0.99)


def test_toxicity_awkward(spark, awkward, none):
    labels = spark.createDataFrame([(2, 0), (4, 1), (4, 1), (6, 0), (8, 1), (7, 5), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score_documents(awkward, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(awkward, labels.where("false")).count() == len(AWKWARD)
    assert toxicity.score_documents(none, labels).count() == 0


# --- near duplicates

def brute_classes(texts):
    sets = {}
    for i, t in texts.items():
        w = norm(t).strip(" ").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split(" ")
        w = [x for x in w if x]
        c = collections.Counter(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4)))
        sets[i] = {(x, k) for x, n in c.items() for k in range(n)}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])):
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_near_dedup_equals_brute_force(docs, texts):
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == brute_classes(texts)


def crowd(n, seed=5):
    """Copies of one text, each with edits of its own that put it about as far
    from most others as the threshold, and texts that only share half of it."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(240)]
    texts = {}
    for i in range(n):
        words = list(base) if i % 4 else base[:120] + [f"o{i}x{k}" for k in range(120)]
        for at in rng.sample(range(240), rng.randrange(1, 8)):
            words[at] = f"e{i}x{at}"
        texts[i] = " ".join(words)
    return texts


@pytest.mark.parametrize("block, short", [(16, 256), (512, 256), (16, 0)])
def test_near_dedup_loses_no_link_in_large_buckets(spark, monkeypatch, block, short):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SHORT", short)
    texts = crowd(160)
    want = brute_classes(texts)
    assert 20 < len(set(want.values())) < 160
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()} == want


@pytest.mark.parametrize("short", [0, 256])
def test_block_pairs_equal_all_pairs(short):
    texts = crowd(60)
    words = [np.array([zlib.crc32(w.encode()) for w in t.split(" ")], np.uint64) for t in texts.values()]
    keys, plain = [near_dedup.shingles(w) for w in words], [near_dedup.plain_shingles(w) for w in words]
    rows = pa.table({"node": range(60), "comp": range(60), "block": [i % 2 for i in range(60)],
                     "entries": [(near_dedup.sketch(k) >> np.uint64(32)).astype(np.uint32).tobytes() for k in keys],
                     "signature": [near_dedup.signature(k) for k in keys],
                     "plain": pa.array([(k >> np.uint64(32)).astype(np.uint32).tobytes() if len(k) <= short else None for k in plain], pa.binary()),
                     "x": [0] * 60, "y": [1] * 60, "key": [64] * 60})
    out = near_dedup._block_pairs(0.8)(rows)
    got = set(zip(out["a"].to_pylist(), out["b"].to_pylist()))
    near = {(i, j) for i in range(60) for j in range(i + 1, 60)
            if (i + j) % 2 and near_dedup.similarity(plain[i], plain[j]) >= 0.8}

    def joined(pairs):
        classes = near_dedup._Classes()
        for i, j in pairs:
            classes.join(i, j)
        return [classes.find(i) for i in range(60)]

    assert near and all((i + j) % 2 for i, j in got)
    if short:   # links that join the same classes as all links, none of them twice
        assert all(out["sure"].to_pylist()) and got <= near and joined(got) == joined(near)
        assert len(got) == 60 - len(set(joined(near)))
    else:
        assert not any(out["sure"].to_pylist()) and near <= got


def test_near_dedup_awkward(awkward, none):
    rows = near_dedup.classes(awkward).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    kept = near_dedup.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.count() == 6
    assert near_dedup.classes(none).count() == 0


def test_alignment_minds_order():
    a = near_dedup.shingles(np.arange(100, dtype=np.uint64))
    b = near_dedup.shingles(np.r_[np.arange(50, 100), np.arange(50)].astype(np.uint64))
    assert near_dedup.similarity(a, a) == 1 and near_dedup.similarity(a, b) == 0


def repeated_line_pages(items, seed=1):
    """A page with the same line after each item, and the page with one more item in front."""
    rng = random.Random(seed)
    line = " ".join(f"line{k}" for k in range(12))
    page = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) + " " + line for _ in range(items + 1)]
    return " ".join(page[1:]), " ".join(page)


def test_alignment_of_pages_with_a_repeated_line(spark):
    def keys(t):
        return near_dedup.plain_shingles(np.array([zlib.crc32(w.encode()) for w in t.split(" ")], np.uint64))

    def longest(x, y):
        row = [0] * (len(y) + 1)
        for p in x:
            last, row = row, [0]
            for j, q in enumerate(y):
                row.append(last[j] + 1 if p == q else max(last[j + 1], row[j]))
        return row[-1]

    pages = {n: repeated_line_pages(n) for n in (10, 20, 30)}
    for n, (a, b) in pages.items():
        x, y = keys(a), keys(b)
        best = longest(x.tolist(), y.tolist())
        assert near_dedup.similarity(x, y) == best / (len(x) + len(y) - best) > 0.9
    rng = np.random.default_rng(2)
    for _ in range(200):
        x = rng.integers(0, rng.integers(2, 30), 40)
        y = np.delete(x, rng.integers(0, 40, 3))
        y = np.insert(y, rng.integers(0, len(y), 2), 7)
        best = longest(x.tolist(), y.tolist())
        assert near_dedup._aligned(x, y) == best
        for need in range(len(y) + 2):   # exact wherever the band's least is reached
            got = near_dedup._aligned(x, y, need)
            assert got == best if best >= need else got <= best
    rows = [(10 * n + k, t) for n, pair in pages.items() for k, t in enumerate(pair) if n > 10]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {200: 200, 201: 200, 300: 300, 301: 300}


def test_alignment_of_long_texts_takes_seconds():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 90_000, 100_000).astype(np.uint64)
    y = np.delete(x, rng.integers(0, len(x), 8_000))
    y[rng.integers(0, len(y), 300)] = 7
    start = time.time()
    assert 0.9 < near_dedup.similarity(x, y) < 0.93
    assert time.time() - start < 20


def test_near_dedup_and_mixing_carry_any_column(spark):
    rows = [(1, "one two three four five six", "s", 1, {"k": 1}, 5, 6), (2, "One two three four five six ", "s", 2, {"k": 2}, 5, 6),
            (3, "seven eight nine", "s", 3, None, 5, 6)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` int, m map<string,int>, _copies int, _key int")
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"], r["a.b"], r["m"], r["_copies"]) for r in kept.collect()) == [(1, 1, {"k": 1}, 5), (3, 3, None, 5)]
    mixed = mixing.remix(odd)
    assert mixed.columns == odd.columns
    assert sorted((r["doc_id"], r["a.b"], r["m"], r["_key"]) for r in mixed.collect()) == \
        [(1, 1, {"k": 1}, 6), (2, 2, {"k": 2}, 6), (3, 3, None, 6)]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_cuts_leave_no_shuffle_files(spark):
    setting, before, held = spark.conf.get(common.SHUFFLE_CLEANUP, None), shuffle_files(spark), []
    rows = spark.range(5000).select((F.col("id") % 50).alias("k"), "id")
    counted = rows.join(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k").repartition(7, "id")
    held.append(common.cut(counted))
    for _ in range(50):   # Spark deletes them in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == setting
    want = sorted((i % 50, i, 100) for i in range(5000))
    assert sorted(map(tuple, held[0].collect())) == want == sorted(map(tuple, counted.collect()))
    assert sorted(map(tuple, common.cut(counted).collect())) == want   # the frame can be cut again


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components_equal_union_find(spark, shape):
    rng = random.Random(3)
    pairs = {"random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)], "path": [(i, i + 1) for i in range(40)],
             "star": [(i, 0) for i in range(1, 30)], "none": []}[shape]
    above = {x: x for p in pairs if p[0] != p[1] for x in p}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            above[b] = a
    got = near_dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in above)


def test_near_dedup_moves_only_doubtful_rows(spark):
    rng = random.Random(2)
    text = {i: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for i in range(400)}
    rows = [(i, t) for i, t in text.items()] + [(400, text[7].upper()), (401, text[8] + " more"), (9, text[9]), (None, text[10]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8).withColumn("at", F.spark_partition_id()).checkpoint()
    kept = near_dedup.keep_one(docs).withColumn("now", F.spark_partition_id()).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["text"]) for r in kept) == \
        sorted((i is not None, i, t) for i, t in {*rows} - {(400, text[7].upper()), (401, text[8] + " more"), (10, text[10])})
    assert sum(r["at"] == r["now"] for r in kept) >= 380


def test_near_dedup_full_filter_gives_the_same(spark, monkeypatch):
    texts = crowd(80)
    docs = spark.createDataFrame([(i % 70 if i % 9 else None, t) for i, t in texts.items()] * 2, "doc_id long, text string")
    want = [sorted(map(str, f(docs).collect())) for f in (near_dedup.classes, near_dedup.keep_one)]
    ids = spark.createDataFrame([(i * 101 if i else None,) for i in range(300)], "i long")
    few = ids.where("i % 404 = 0 OR i IS NULL")
    marked = near_dedup._marked(ids, "i", few)
    inside = {r["i"] for r in few.collect()}
    got = {r["i"]: r["maybe"] for r in marked.collect()}
    assert len(got) == 300 and all(got[i] for i in inside) and sum(got.values()) < len(inside) + 30
    assert not any(r["maybe"] for r in near_dedup._marked(ids, "i", few.where("false")).collect())
    monkeypatch.setattr(near_dedup, "FILTER_WORDS", 1)
    assert sum(r["maybe"] for r in near_dedup._marked(ids, "i", few).collect()) > 150
    assert [sorted(map(str, f(docs).collect())) for f in (near_dedup.classes, near_dedup.keep_one)] == want


# --- mixing

def test_mix_meets_targets(docs, texts):
    rows = mixing.taken(docs).collect()
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]] or "")) and r["taken"] <= 3 * r["size"]
        s = source[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    assert len(rows) == len(texts) and abs(sum(target.values()) - sum(size.values())) < 1e-3
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)
    assert sorted(map(tuple, mixing.taken(docs).collect())) == sorted(map(tuple, rows))


def test_mix_awkward(spark, awkward, none):
    rows = mixing.taken(awkward).collect()
    assert len(rows) == len(AWKWARD) and mixing.taken(none).count() == 0
    one = spark.createDataFrame([(i, "w " * n, s) for i, (n, s) in enumerate([(1000, "a"), (1, "b"), (1, "c"), (0, "d")])],
                                "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mixing.taken(one).collect()}
    assert got[1] == (3.0, 3) and got[2] == (3.0, 3) and got[0][1] == 996 and got[3] == (0.0, 0)


def test_remix_tells_documents_with_one_id_apart(spark):
    rows = [((None, 7, i)[i % 3], " ".join([f"t{i}"] * (i + 1)), "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    size = {t: i + 1 for i, (_, t, _) in enumerate(rows)}
    mixed = mixing._taken(docs, key=mixing.row_key(docs)).collect()
    own = {r["size"]: math.floor(r["taken"] / r["size"] + 0.5) for r in mixed}
    got = collections.Counter(r["text"] for r in mixing.remix(docs).collect())
    assert len(own) == 60 and all(got[t] == own[n] for t, n in size.items())
    words, target = collections.Counter(), {}
    for _, t, s in rows:
        words[s] += got[t] * size[t]
        target[s] = sum(size[x] for _, x, y in rows) * {"a": 5, "b": 2}[s] / 7
    assert all(abs(words[s] - target[s]) <= 60 for s in words)
    assert mixing.remix(docs.unionByName(docs)).count() >= 60


# --- url filter

def test_url_rules_and_verdicts(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Com/x"), (4, "http://x.example.com/en/1"), (5, "http://m.www.example.com/en/"),
            (6, "https://net/es/"), (7, "http://foonet/es/"), (8, "http://a.com"), (9, "ftp://casino-win.example.org/en/1?x#y"),
            (10, "http://therinth.example.org/en/2"), (10, "http://therinth.example.org/en/2"), (11, ""), (12, "://")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1))
    got = {r["page_id"]: r for r in url_filter.judge(df, catalog.URL_RULES).collect()}
    assert [got[k]["rule"] for k in range(1, 13)] == \
        [None, None, "com/", "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None, None, None]
    assert got[9]["verdict"] == "block" and got[10]["verdict"] == got[1]["verdict"] == "allow"
    assert got[4]["verdict"] == "block" and got[5]["verdict"] == "allow" and (got[9]["host"], got[9]["path"]) == ("casino-win.example.org", "/en/1")


def test_url_table_has_no_name_of_the_test_tables(spark):
    hosts = {url_filter.split_url(r["url"])[0].split(".")[0]
             for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()}
    assert not hosts & set(url_filter.BLOCK_HOSTS + url_filter.ALLOW_HOSTS)


# --- pipeline

def test_pipeline_stages(spark, docs, texts):
    now = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            now = now.checkpoint()
            assert now.columns == docs.columns
            kept[name] = [r["doc_id"] for r in now.select("doc_id").collect()]
    identified = {i: texts[i] for i in kept["language_id"]}
    assert all(any(c.isalpha() for c in texts[i] or "") for i in identified)
    first = {}
    for i in sorted(identified):
        first.setdefault(norm(texts[i]), i)
    assert sorted(kept["exact_dedup"]) == sorted(first.values())
    classes = brute_classes({i: texts[i] for i in kept["exact_dedup"]})
    assert sorted(kept["near_dedup"]) == sorted(set(classes.values()))
    assert {r["doc_id"] for r in now.collect()} == set(kept["mix_sources"]) <= set(kept["near_dedup"])
    assert os.path.exists(SF) and corpus_pipeline.run(spark, SF).count() == now.count()


def test_pipeline_awkward(spark, awkward, none):
    for rows in (awkward, none):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF).checkpoint()
