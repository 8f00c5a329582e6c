"""Operators against brute force, held-out accuracy or exact round trips, and
their edge cases (nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names)."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.llm import cascade, chat, common, decontam, langid, mixing, ring, setsketch, substring, topk, toxicity, words

from . import brute

DOCS = "doc_id long, text string, lang string, source string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(rng, text, times):
    w = text.split()
    for _ in range(times):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text): near copies of different strength, exact copies, shared
    passages, repeats inside a text, odd white space, empty and null texts."""
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(30, 200)) for _ in range(30)]
    passage = prose(rng, 45)
    texts = list(base)
    for i, t in enumerate(base[:20]):
        texts += [changed(rng, t, k) for k in range(1, 4)]
        if i % 4 == 0:
            texts += [t, t.upper(), t.replace(" ", "\n\t ")]
        if i % 3 == 0:
            texts.append(prose(rng, 20) + " " + passage + " " + prose(rng, 15))
    hub = prose(rng, 120)
    texts += [changed(rng, hub, 2) for _ in range(60)]
    texts += [None, "", " \n\t", "one", "one", "one two", "a\u00a0b c\u2003d e", passage + " " + passage, "ß É é 你好 " * 30]
    texts += [prose(rng, 6000)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(7 * i, texts[o]) for i, o in enumerate(order)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS).repartition(5)


def test_word_hashes_follow_the_words(monkeypatch):
    rng = random.Random(1)
    text = "  ".join(prose(rng, 50).split()) + "\n\x0b\x0cÜber\u00a0x \x1fend"
    want = brute.words(text)
    whole = words.word_hashes(text.encode())
    assert len(whole) == len(want)
    assert len(set(whole.tolist())) == len(set(want))
    monkeypatch.setattr(words, "CHUNK", 16)
    assert (words.word_hashes(text.encode()) == whole).all()
    assert len(words.word_hashes(b"")) == len(words.word_hashes(None)) == len(words.word_hashes(b" \n")) == 0


# -- operator 1 -------------------------------------------------------------

def targets(sizes, weights, share, most):
    """Water filling by repeated sharing of what is above a cap."""
    budget, left = share * sum(sizes.values()), dict(sizes)
    out = dict.fromkeys(sizes, 0.0)
    while left and budget > 1e-9:
        level = budget / sum(weights[s] for s in left)
        full = [s for s in left if level * weights[s] >= most * sizes[s]]
        if not full:
            return out | {s: level * weights[s] for s in left}
        for s in full:
            out[s] = most * sizes[s]
            budget -= out[s]
            del left[s]
    return out


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(0, 40)), "en", rng.choice(["b", "a", "a", "a", "é", "Z", None, "big", "big"]))
            for i in range(900)]
    rows += [(5, "a b c", "en", "a"), (5, "a b c", "en", "a"), (None, "x y", "en", "b"), (1000, None, "en", "empty")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("target", F.lit(1))
    got = mixing.mix_to_targets(docs, common.word_count(F.col("text")), F.lit(1.0)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(brute.words(t))
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want = targets(sizes, weights, 1.5, 2)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size and r["size"] == len(brute.words(r.text))
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 20
    again = mixing.mix_to_targets(docs.repartition(3), common.word_count(F.col("text")), F.lit(1.0)).collect()
    assert Counter((r.doc_id, r.source, r.taken) for r in got) == Counter((r.doc_id, r.source, r.taken) for r in again)


def test_mix_prefers_quality(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 2).alias("good"))
    got = mixing.mix_to_targets(docs, F.lit(10), F.when(F.col("good") == 1, 4.0).otherwise(1.0), share=0.5)
    n = {r.good: r.n for r in got.groupBy("good").agg(F.sum("copies").alias("n")).collect()}
    assert n[0] + n[1] == 2000 and n[1] > 2.2 * n[0]


# -- operator 2 -------------------------------------------------------------

def test_substring_removal_is_exact(spark, corpus):
    got = substring.remove_repeats(frame(spark, corpus), F.col("text")).collect()
    want = brute.repeated_words(corpus, 20)
    assert len(got) == len(corpus)
    for r in got:
        n, gone, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept) == (n, gone, " ".join(kept))
        assert sum(s.end - s.start for s in r.repeats) == gone


def test_substring_repeated_rows(spark):
    rng = random.Random(5)
    t = prose(rng, 50)
    rows = [(1, t), (1, t), (2, t), (None, t), (3, "short text"), (4, "short text")]
    got = sorted((r.doc_id or 99, r.n_removed) for r in substring.remove_repeats(frame(spark, rows), F.col("text")).collect())
    assert got == [(1, 0), (1, 0), (2, 50), (3, 0), (4, 0), (99, 50)]


# -- operator 3 -------------------------------------------------------------

def test_language_held_out(spark):
    docs = common.table(spark, SF_SMALL, "documents").withColumn("held_out", common.held_out(F.col("doc_id")))
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 34 !?", "en"), (-4, "x" * 10, None),
                                 (None, "the and of", None)], "doc_id long, text string, lang string")
    docs = docs.unionByName(odd.withColumn("held_out", F.lit(True)), allowMissingColumns=True)
    model = langid.learn(docs.where("not held_out"))
    got = langid.predict(docs, model, F.col("text"), ["doc_id", "held_out", "lang"]).collect()
    assert len(got) == docs.count()
    tried = [r for r in got if r.held_out and (r.doc_id or -1) >= 0]
    assert sum(r.lang == r.lang_pred for r in tried) >= 0.95 * len(tried)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (-1, -2, -3))
    assert all(0 <= r.score <= 1 for r in got)
    none = langid.learn(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(docs, none, F.col("text"), ["doc_id"]).collect()} == {"und"}


def test_long_text_pieces_agree(monkeypatch):
    text = "the quick brown fox and der schnelle Fuchs " * 40
    model = langid.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(2, (1 << langid.BITS) + 1)).astype(np.float32),
                                 np.zeros(2))
    model.logp[:, -1] = 0
    whole = langid.log_scores([text, "x"], model)
    monkeypatch.setattr(langid.groups, "__defaults__", (50,))
    assert np.allclose(langid.log_scores([text, "x"], model), whole, rtol=1e-4)


# -- operator 4 -------------------------------------------------------------

@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(11)
    rows = []
    for c in range(60):
        first = rng.choice(["hello", "hello", "hi [/TURN] \\ <s>", "[[INST] \\[TEXT] \\"])
        rows += [(c, 0, "user", first), (c, 1, "assistant", rng.choice(["yes", "no\n</s>", "\\"])), (c, 2, "user", f"q{c % 7}")]
        rows += [(c, t, "assistant", prose(rng, 4, 3)) for t in range(3, 3 + c % 4)]
    rows += [(100, 0, "user", "hello"), (100, 1, "assistant", "yes"), (101, 0, None, None), (None, 0, "user", "lost"),
             (102, None, "system", "x"), (102, 1, "assistant", "é你"), (103, 0, "user", "same"), (103, 0, "user", "same")]
    return rows


def test_chat_round_trip(spark, conversations):
    turns = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string").repartition(4)
    nodes, paths, members = chat.format_tree(turns.withColumn("segment", F.lit("clash")))
    got = {r.conv_id: r for r in chat.read_back(nodes, paths, members).collect()}
    by = {}
    for c, t, role, text in conversations:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    prefixes = set()
    for c, turn_list in by.items():
        turn_list.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turn_list)
        loss = "".join(t for _, r, t in turn_list if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turn_list), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        prefixes |= {tuple(x[1:] for x in turn_list[:n + 1]) for n in range(len(turn_list))}
    listed = nodes.collect()
    assert len(listed) == len(prefixes)  # shared turns once
    for tree in {n.tree for n in listed}:
        at = 0
        own = sorted((n for n in listed if n.tree == tree), key=lambda n: n.start)
        text = "".join(n.segment for n in own)
        for n in own:  # the stream has no holes
            assert n.start == at and text[n.start:n.end] == n.segment
            at = n.end
            assert sum(i.end - i.start for i in n.attend) == n.position  # ancestors are what precedes it
    seg = {(n.tree, n.start): n for n in listed}
    steps = {}
    for p in paths.collect():
        steps.setdefault(p.path, []).append((p.idx, seg[p.tree, p.start]))
    for walk in steps.values():
        walk.sort(key=lambda x: x[0])
        stream = "".join(n.segment for n in sorted((n for n in listed if n.tree == walk[0][1].tree), key=lambda n: n.start))
        for i, (_, n) in enumerate(walk):
            assert "".join(stream[a.start:a.end] for a in n.attend) == "".join(m.segment for _, m in walk[:i])


# -- operator 5 -------------------------------------------------------------

@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_match_all_pairs(spark, corpus, k, monkeypatch):
    got = setsketch.near_duplicates(frame(spark, corpus), F.col("text"), shingle=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_components(corpus, k)
    assert len(got) == len(corpus)


def test_near_duplicates_in_blocks_and_odd_rows(spark, corpus, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK_ROWS", 7)  # clusters of several blocks
    monkeypatch.setattr(setsketch, "FIRST_BANDS", 1)
    rows = [r for r in corpus if r[0] % 2 == 0] + [(None, None), (None, "lost words only here now"), (0, dict(corpus)[0])]
    got = setsketch.near_duplicates(frame(spark, rows), F.col("text"), shingle=4).collect()
    want = brute.near_components([r for r in rows if r[0] is not None], 4)
    assert len(got) == len(rows)
    assert all(r.component_id == want[r.doc_id][1] for r in got if r.doc_id is not None)
    assert setsketch.near_duplicates(frame(spark, rows).where("false"), F.col("text")).count() == 0


def test_near_duplicates_of_rows_without_or_with_repeated_ids(spark):
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 120) for _ in range(4))
    rows = [(5, a), (9, b), (None, changed(rng, a, 1)), (None, changed(rng, b, 1)), (None, c), (7, d), (7, changed(rng, a, 1))]
    got = setsketch.near_duplicates(frame(spark, rows), F.col("text")).collect()
    assert sorted((r.doc_id or 99, r.component_id) for r in got) == [
        (5, 5), (7, 5), (7, 7), (9, 9), (99, 5), (99, 9), (99, common.LAST_ID)]


def test_shared_counts(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(rng.integers(1000, 100_000, 30).astype(np.uint64)) for _ in range(5)]
    monkeypatch.setattr(setsketch, "COLUMNS", 16)
    got = setsketch.shared_counts(sets[:25], sets[20:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[20:]] for a in sets[:25]]).all()


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64)) for _ in (0, 1))
    assert (setsketch.registers(np.union1d(a, b)) == np.maximum(setsketch.registers(a), setsketch.registers(b))).all()
    both = a[:4000]
    x, y = np.concatenate([both, b[:500]]), np.concatenate([both, b[500:1000]])
    est = setsketch.likely_similarity(setsketch.registers(x)[None], setsketch.registers(y)[None],
                                      np.array([4500.0]), np.array([4500.0]))
    assert abs(est[0] - 0.8) < 0.15


# -- operator 6 -------------------------------------------------------------

def test_cascade_is_exact(spark):
    asked = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"))
    keys = asked.where("crc32(key) % 50 = 0").unionByName(spark.createDataFrame([("never asked",)], "key string"))
    levels = cascade.build_cascade(keys, asked)
    rows = asked.select("key", *cascade._hashes("key")).toPandas()
    got = cascade.listed(rows.h1.to_numpy(), rows.h2.to_numpy(), levels)
    assert (got == np.array([zlib.crc32(k.encode()) % 50 == 0 for k in rows.key])).all()
    assert len(levels) > 2


def test_urls(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1")]
    cases = {"http://A.Example.ORG/es/x?y": ("a.example.org", "/es/x", "example.org/es/", "block"),
             "https://example.org/en/12#f": ("example.org", "/en/12", "example.org/en/1", "block"),
             "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
             "x://org": ("org", "", None, "allow"), "x://org/": ("org", "/", "org/", "allow"),
             "no scheme.org/es/": ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"),
             "a://b://c/": ("b:", "//c/", None, "allow"), "http://É.org/": ("É.org", "/", "org/", "allow")}
    rows = [(i, u, "x") for i, u in enumerate([*cases, None, *cases])]
    got = cascade.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), rules).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases.get(rows[r.page_id][1], ("", "", None, "allow"))
    empty = spark.createDataFrame([], "page_id long, url string")
    assert cascade.judge_urls(empty, rules).count() == 0
    assert cascade.judge_urls(spark.createDataFrame(rows[:2], "page_id long, url string, x string"), []).count() == 2


# -- operator 7 -------------------------------------------------------------

def check_shards(rows, got, shards):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_ring(spark):
    rows = [(i, f"text {i}" * (i % 5)) for i in range(3001)] + [(7, "hot")] * 1500 + [(None, None), (None, "é")] * 3
    docs = frame(spark, rows).withColumn("shard", F.lit("clash"))
    got = ring.shard_documents(docs).collect()
    check_shards(rows, got, 24)
    again = ring.shard_documents(docs.repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    few = rows[:10]
    check_shards(few, ring.shard_documents(frame(spark, few)).collect(), 24)
    assert ring.shard_documents(docs.where("false")).count() == 0


def test_ring_moves_little(spark):
    rows = [(i, "t") for i in range(4000)]
    place = {r.doc_id: r.shard for r in ring.shard_documents(frame(spark, rows)).collect()}
    more = {r.doc_id: r.shard for r in ring.shard_documents(frame(spark, rows), shards=25).collect()}
    assert sum(place[i] != more[i] for i in place) < 0.35 * len(place)


# -- operator 8 -------------------------------------------------------------

def test_toxicity_held_out(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        bad = i % 6 == 0
        w = prose(rng, rng.randrange(5, 60)).split()
        if bad:
            w.insert(rng.randrange(len(w)), rng.choice(["horrid", "nastyish"]))
        rows.append((i, " ".join(w), int(bad)))
    rows += [(9001, None, 0), (9002, "", 0), (9003, "", None), (None, "x", 1), (0, rows[0][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("score", F.lit("clash"))
    held = common.held_out(F.col("doc_id"))
    model = toxicity.learn(docs.where(~held))
    got = toxicity.score(docs.drop("score").withColumn("held_out", held), model, F.col("text"), ["doc_id", "held_out", "toxic"]).collect()
    assert len(got) == len(rows)
    tried = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    assert sum(r.predicted == r.toxic for r in tried) >= 0.97 * len(tried)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.predicted for r in got if r.doc_id in (9001, 9002)} == {0}
    flat = toxicity.learn(docs.where("toxic = 0"))
    assert toxicity.score(docs.limit(3), flat, F.col("text"), ["doc_id"]).count() == 3


def test_presence_does_not_depend_on_pieces(monkeypatch):
    text = "some words that go on and on " * 9
    def pairs(texts):
        return sorted((int(r), int(b)) for rows, buckets in toxicity.present(texts) for r, b in zip(rows, buckets, strict=True))
    whole = pairs([text, None, "", "ab"])
    monkeypatch.setattr(toxicity, "GROUP", 40)
    monkeypatch.setattr(toxicity.groups, "__defaults__", (40,))
    assert pairs([text, None, "", "ab"]) == whole and len(whole) == len(set(whole))


# -- operator 9 -------------------------------------------------------------

def test_top_k(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(12)]) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(1000, 1300)]  # ties
    rows += [(50, rows[1][1]), (2000, None), (2050, [1.0, None]), (2100, [float("nan")]), (2150, [float("inf")]),
             (None, [1.0] * 12), (2200, []), (2250, [0.5] * 20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7).withColumn("score", F.lit("clash"))
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5).collect()
    held = [(int(r.vec_id), [int(np.floor(256 * float(v))) for v in r.embedding]) for r in vectors.collect()
            if r.vec_id is not None and r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding)]
    want = {}
    for q, x in {i: x for i, x in held if i % 50 == 0 and i != 50}.items():
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in held if i != q)[:5]
        want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(scores)}
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got if r.query_id != 50} == want
    assert topk.top_k(vectors.where("false"), F.lit(True)).count() == 0


def test_top_k_asks_with_every_row_of_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (0, [-1.0, 0.0]), (1, [5.0, 0.0]), (2, [0.0, 4.0]), (3, [-3.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(vectors, F.col("vec_id") == 0, 4).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [
        (1, 1, 5 * 65536), (2, 2, 4 * 65536), (3, 2, 4 * 65536), (4, 3, 3 * 65536)]


def test_search_block_stops_only_on_proof():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(500, 16)) ** 3 * 200).astype(np.int64)
    q, ids = x[:20], np.arange(500)
    got = topk.search_block(ids[:20], q, ids, x, 3)
    exact = q @ x.T
    for i in range(20):
        best = sorted((-exact[i, j], j) for j in range(500) if j != i)[:3]
        assert [(j, s) for a, j, s in got if a == i] == [(j, -s) for s, j in best]


def test_top_k_joins_and_broadcasts_nothing(spark, monkeypatch):
    """The blocks of a query chunk once came back to the driver as a broadcast."""
    rng = np.random.default_rng(6)
    x = rng.integers(-300, 300, (400, 6))
    vectors = spark.createDataFrame([(i, [v / 256 for v in r.tolist()]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    for name, most in (("BLOCK_VALUES", 6 * 20), ("SPAN_VALUES", 6 * 50), ("ASKED_VALUES", 6 * 7), ("SPREAD", 2)):
        monkeypatch.setattr(topk, name, most, raising=False)  # several chunks and spans, several blocks each
    out = topk.top_k(vectors, F.col("vec_id") % 10 == 0, 3)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    want = {}
    for q in range(0, 400, 10):
        best = sorted((-int(x[q] @ x[i]), i) for i in range(400) if i != q)[:3]
        want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    assert got == want


def test_search_block_leaves_out_what_is_below_the_floor():
    x = np.array([[5, 0], [4, 0], [3, 0], [1, 0]])
    q, ids = np.array([[1, 0], [2, 0]]), np.arange(4)
    got = topk.search_block(np.array([-1, -2]), q, ids, x, 2, floor=np.array([4.0, 11.0]))
    assert got.tolist() == [[0, 0, 5], [0, 1, 4]]


# -- operator 10 ------------------------------------------------------------

def leaks(docs, items, k=5, hundredths=80):
    """Best (and last such) window of every (document, item), over all windows."""
    out = {}
    for d, t in docs:
        w = (t or "").lower()
        w = re.findall(brute.WORD, w)
        for i, it in items:
            v = re.findall(brute.WORD, (it or "").lower())
            if not w or not v:
                continue
            g = min(k, len(v))
            def bag(x):
                return Counter(tuple(x[p:p + g]) for p in range(max(1, len(x) - g + 1)))
            item = bag(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                win = bag(w[s:s + len(v)])
                both = sum((win & item).values())
                either = sum((win | item).values())
                if 100 * both >= hundredths * either and both / either >= out.get((d, i), (0, 0))[0]:
                    out[d, i] = (both / either, s)
    return out


def test_decontamination_finds_all_windows(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randrange(8, 60), 60)) for i in range(12)] + [(50, None), (51, ""), (52, "three word item"),
             (53, "go go go go go go go go go go")]
    docs = []
    for i in range(80):
        t = prose(rng, rng.randrange(1, 90), 60)
        if i % 2:
            piece = rng.choice(items[:12])[1]
            piece = changed(rng, piece, rng.randrange(0, 3)) if i % 4 == 1 else piece.upper()
            t = t + "\n" + piece + " " + prose(rng, 10, 60)
        docs.append((i, t))
    docs += [(200, items[0][1]), (201, " ".join(items[1][1].split()[:-1])), (202, None), (203, ""), (204, "a three word item b"),
             (205, "go " * 30), (200, "something else"), (None, items[2][1])]
    frame_ = spark.createDataFrame(docs, "doc_id long, text string").withColumn("size", F.lit("clash")).repartition(3)
    got = decontam.find_leaks(frame_, spark.createDataFrame(items, "item_id long, text string").withColumn("grams", F.lit(1)))
    want = leaks([d for d in docs if d[0] is not None and d[1] != "something else"], items)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in got.collect()}
    assert (None, 2) in got
    assert {k: v for k, v in got.items() if k[0] is not None} == want
    assert len(want) > 30
    assert decontam.find_leaks(frame_.where("false"), frame_.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert decontam.find_leaks(frame_, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_leaks_far_from_the_fingerprint_of_their_item(spark):
    """Matches of 0.8 or more whose SimHashes differ in more than RADIUS bits."""
    rng = random.Random(31)
    items, docs = [], []
    for words_, run in [(104, 10), (60, 6), (50, 4)] * 8 + [(104, 0)] * 20:
        n = len(items)
        body = [f"i{n}w{j}" for j in range(words_ - run)]
        items.append((n, " ".join(body + ["____"] * run)))
        cut = run or 11
        kept = body[: words_ - cut]
        docs.append((n, " ".join(kept + [f"y{rng.randrange(10**9)}" for _ in range(cut)])))
    got = decontam.find_leaks(frame_of(spark, docs, "doc_id"), frame_of(spark, items, "item_id")).collect()
    want = leaks(docs, items)
    assert len(want) == len(docs)
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in got} == want


def frame_of(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


def test_components(spark):
    from tidewater.llm.graph import components

    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_listed_blocks_are_not_broadcast(spark):
    """Operator 10: the 2,788 listed blocks of every item are joined by a shuffle, not held by the driver."""
    from tidewater.llm import decontam

    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "x " + text + " y"), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    found = decontam.leaking_texts(docs, items)
    joins = [x for x in found._jdf.queryExecution().analyzed().toString().split("\n") if "strategy=merge" in x]
    assert len(joins) == 1
    assert [(r["doc"], r["item_id"]) for r in found.collect()] == [(1, 7)]
