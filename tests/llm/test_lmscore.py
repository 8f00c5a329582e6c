"""Operator 13: lattices against listed segmentations, scores against a plain
model, and odd rows."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import lattice, lmscore

from . import brute

TEXTS = ["▁", "a", "b", "ab", "▁a", "ba", "abc", "c", "▁ab"]


@pytest.fixture
def pieces():
    return lattice.from_ranks(TEXTS, np.arange(len(TEXTS), dtype=float))


def segmentations(pieces, word):
    """(probability, pieces) of all ways to split a word."""
    weight = dict(zip(TEXTS, np.exp(pieces.log_p), strict=False))
    byte, whole = math.exp(pieces.log_p[-1]) / 256, "▁" + word

    def rest(i):
        if i == len(whole):
            yield 1.0, []
            return
        for n in range(1, pieces.longest + 1):
            x = whole[i:i + n]
            if len(x) == n and x in weight and "▁" not in x[i == 0:]:
                yield from ((weight[x] * p, [x, *q]) for p, q in rest(i + n))
        if whole[i] not in weight or (i and whole[i] == "▁"):
            k = len(whole[i].encode())
            yield from ((byte**k * p, [None] * k + q) for p, q in rest(i + 1))

    return list(rest(0))


WORDS = ["a", "ab", "abc", "abab", "cab", "é", "a▁b", "x", "abcabcab", "😀a", "bbbb"]


def test_forward_sums_all_segmentations(pieces, monkeypatch):
    points = [lattice.code_points(w.encode()) for w in WORDS]
    want = [math.log(sum(p for p, _ in segmentations(pieces, w))) for w in WORDS]
    assert np.allclose(lattice.forward(pieces, points), want, atol=1e-12)
    monkeypatch.setattr(lattice, "LONG", 3)  # words in blocks
    assert np.allclose(lattice.forward(pieces, points), want, atol=1e-12)
    monkeypatch.setattr(lattice, "BATCH", 4)
    assert np.allclose(lattice.forward(pieces, points), want, atol=1e-12)
    assert len(lattice.forward(pieces, [])) == 0


def test_expected_counts(pieces):
    want = Counter()
    for w in WORDS:
        ways = segmentations(pieces, w)
        total = sum(p for p, _ in ways)
        for p, used in ways:
            for x in used:
                want[x] += p / total
    got = lattice.expected(pieces, [lattice.code_points(w.encode()) for w in WORDS])
    assert np.allclose(got, [*[want[t] for t in TEXTS], want[None]])
    again = lattice.refit(pieces, got, pieces.log_p)
    assert abs(np.exp(again.log_p).sum() - 1) < 1e-12


def test_words_sum_to_one():
    """No more than the probability of all words up to a length is given out."""
    pieces = lattice.from_ranks(["▁", "▁a", "▁b", "a", "b", "ab"], np.array([50.0, 0, 1, 2, 3, 4]))
    words = [""]
    total = 0.0
    for _ in range(9):
        words = [w + c for w in words for c in "ab"]
        total += np.exp(lattice.forward(pieces, [lattice.code_points(w.encode()) for w in words])).sum()
    assert 0.8 < total < 1  # the rest are longer words


def test_one_word_of_any_length():
    pieces = lattice.load(lmscore.VOCABULARY)
    word = "abcdefgh" * 12_500
    part = lattice.forward(pieces, [lattice.code_points(("abcdefgh" * n).encode()) for n in (1000, 2000)])
    long = lattice.forward(pieces, [lattice.code_points(word.encode())])[0]
    assert abs((long - part[1]) / 10_500 - (part[1] - part[0]) / 1000) < 1e-6


def learned(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def run(spark, docs):
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"row__": F.lit(1), "h": F.lit("x"), "lp": F.lit(2), "raw__": F.lit(3)}).repartition(3)
    return lmscore.score_texts(frame, F.col("text"), F.coalesce(F.pmod(crc, F.lit(10)) != 0, F.lit(False)), ["doc_id"]).collect()


def plain(docs):
    """The model of the docstring, word by word, with the same lattice weights."""
    counts, texts = Counter(), []
    for i, t in docs:
        w = [x.encode() for x in brute.words(brute.ascii_lower(t))] + [b""]
        texts.append(w)
        if learned(i):
            counts.update(w)
    n, v, n1, n2 = sum(counts.values()), len(counts), *[sum(c == k for c in counts.values()) for k in (1, 2)]
    pieces = lattice.load(lmscore.VOCABULARY)
    prior = pieces.log_p
    for _ in range(lmscore.ROUNDS):
        pieces = lattice.refit(pieces, lattice.expected(pieces, [lattice.code_points(w) for w in sorted(counts) if w]), prior)
    d = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
    ends = counts[b""] / n if n else 0.5
    out = []
    for w in texts:
        score = base = 0.0
        for x in w:
            low = ends if not x else (1 - ends) * math.exp(lattice.forward(pieces, [lattice.code_points(x)])[0])
            score += math.log10((max(0, counts[x] - d) * (counts[x] > 0) + (1 + d * v) * low) / (n + 1))
            base += math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1)))
        out.append((len(w), sum(counts[x] > 0 for x in w), n, base, score))
    return out


def test_scores_against_a_plain_model(spark, monkeypatch):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["The", "the", "sea", "Ébb", "tide x", f"w{rng.randrange(60)}"]) for _ in range(rng.randrange(1, 60))))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \n\t"), (None, "the sea"), (None, "the sea"), (103, "the sea"), (103, "the sea"),
             (104, "new " * 5000), (105, "x" * 3000), (106, "\x1funit \x00 zero")]
    want = plain(docs)
    for frequent in (lmscore.FREQUENT, 3):  # all words broadcast, or nearly none
        monkeypatch.setattr(lmscore, "FREQUENT", frequent)
        got = run(spark, docs)
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:3])
        got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
        expect = sorted([(i, *w) for (i, _), w in zip(docs, want, strict=True)], key=key)
        assert [g[:4] for g in got] == [e[:4] for e in expect]
        assert np.allclose([g[4:] for g in got], [e[4:] for e in expect], rtol=1e-9)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if not learned(i))
    got = run(spark, [(held, "a sea"), (None, None)])
    assert sorted(r.n_tokens for r in got) == [1, 3] and all(r.train_tokens == 0 and r.n_known == 0 for r in got)
    assert all(r.base_score == 0 and math.isfinite(r.score) and r.score < 0 for r in got)
    assert run(spark, [(1, "x")])[0].n_known == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lmscore.score_texts(empty, F.col("text"), F.lit(True), ["doc_id"]).count() == 0


def test_known_text_is_likelier_than_shuffled_letters(spark):
    docs = [(i, "the tide comes in and the tide goes out again " * 3) for i in range(20)]
    held = [i for i in range(100, 200) if not learned(i)][:2]
    got = {r.doc_id: r for r in run(spark, [*docs, (held[0], "the tide goes out"), (held[1], "hte dtie geso uto")])}
    assert got[held[0]].score > got[held[1]].score + 3


def test_words_are_decoded_together():
    """Code points of many words at once are those of each, broken UTF-8 included, and the
    marks that pass over substrings leave out no piece."""
    parts = [b"\xe2", b"\x82", b"\xac", b"a", b"\xf0\x9f", b"\xe2\x96\x81", b"\xed\xa0\x80", "é".encode(), b"\xff"]
    words = [b"".join(p) for n in range(4) for p in itertools.product(parts, repeat=n)]
    for word, got in zip(words, lattice.all_code_points(words), strict=True):
        points = [0x110000 if c == "▁" else ord(c) for c in word.decode("utf-8", "replace")]
        assert got.tolist() == [0x2581, *points]
    assert lattice.all_code_points([]) == []
    pieces = lattice.from_ranks(["a", "b", "ab", "▁a"], np.arange(4.0))
    assert pieces.marks[pieces.hashes >> np.uint64(64 - lattice.MARK_BITS)].all() and pieces.marks.sum() <= 4
