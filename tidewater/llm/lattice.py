"""Segmentation lattices of words over a fixed subword vocabulary, in numpy.

A word is read as the mark ``▁`` and its code points.  Every piece of the
vocabulary that fits at a position is an edge of the word's lattice; a code
point that is no piece of its own is spelled by its UTF-8 bytes.  A piece that
holds a mark can only start a word, so the probabilities of all words sum to
at most one without an end symbol.

``forward`` sums over all segmentations in log space; ``expected`` adds the
backward pass and returns how often every piece is used.  Both work on many
words at once, position by position, with words of about the same length put
together.  A word longer than ``LONG`` code points is worked off in blocks that
hand on the last positions of the recursion, so memory does not grow with it
(for expected counts such a word is cut into blocks).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

from .words import mix

MARK = 0x2581
#: A literal U+2581 inside a word: no piece holds it, so bytes spell it.
_LITERAL = 0x110000
LONG = 1 << 15
#: Code points of one batch.
BATCH = 1 << 17
MARK_BITS = 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Weight of the vocabulary's own scores against expected counts, in pieces.
PRIOR_PIECES = 1000.0


@dataclass
class Pieces:
    """The vocabulary: hashes in ascending order, piece number and length;
    ``log_p`` by piece number, the last entry that of one spelled byte."""

    hashes: np.ndarray
    numbers: np.ndarray
    log_p: np.ndarray
    longest: int

    @cached_property
    def marks(self) -> np.ndarray:
        """By the first ``MARK_BITS`` bits of a hash: whether a piece has them.  Most substrings are no piece."""
        marks = np.zeros(1 << MARK_BITS, bool)
        marks[self.hashes >> np.uint64(64 - MARK_BITS)] = True
        return marks


def _hash(points: np.ndarray) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for p in points:
        h = (h + p.astype(np.uint64) + np.uint64(1)) * _BASE
    return mix(h + np.uint64(len(points)))[0]


def load(path: str) -> Pieces:
    """Pieces of a SentencePiece model.  Its scores are negated merge ranks,
    not log-probabilities: a piece of rank r starts with a weight of
    1 / (r + 2) (Zipf's law), bytes and characters included."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, ranks = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        plain = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        if plain and piece and chr(MARK) not in piece[1:]:
            texts.append(piece)
            ranks.append(min(-model.get_score(i), 1e6))
    return from_ranks(texts, np.array(ranks, np.float64))


def from_ranks(texts: list[str], ranks: np.ndarray) -> Pieces:
    hashes = np.array([_hash(np.array([ord(c) for c in t])) for t in texts], np.uint64)
    order = np.argsort(hashes)
    weight = np.append(1.0 / (np.maximum(ranks, 0) + 2.0), 1.0 / (len(texts) + 2.0))
    return Pieces(hashes[order], order.astype(np.int64), np.log(weight / weight.sum()), max(map(len, texts)))


def refit(pieces: Pieces, counts: np.ndarray, prior: np.ndarray) -> Pieces:
    """Pieces with log-probabilities from expected counts, smoothed by ``prior``."""
    weight = counts + PRIOR_PIECES * np.exp(prior)
    return Pieces(pieces.hashes, pieces.numbers, np.log(weight / weight.sum()), pieces.longest)


def code_points(word: bytes) -> np.ndarray:
    """Mark and code points of a UTF-8 word."""
    return all_code_points([word])[0]


def all_code_points(words: list[bytes]) -> list[np.ndarray]:
    """The same of many words, none of which holds a space, decoded together."""
    if not words:
        return []
    text = b" " + b" ".join(words)
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    gap = points == 0x20
    out = np.where(points == MARK, _LITERAL, points).astype(np.int64)
    out[gap] = MARK
    cut = np.flatnonzero(gap).tolist() + [len(out)]
    return [out[i:j] for i, j in zip(cut, cut[1:], strict=False)]


def _edges(pieces: Pieces, points: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece number or -1, bytes of a spelled code point or 0) of the edges
    from every position, by length - 1; ``room`` is the number of code points
    up to the word's end."""
    n = len(points)
    number = np.full((pieces.longest, n), -1, np.int32)
    h = np.zeros(n, np.uint64)
    step = points.astype(np.uint64) + np.uint64(1)
    for length in range(1, pieces.longest + 1):
        here = n - length + 1
        if here <= 0:
            break
        h = (h[:here] + step[length - 1:]) * _BASE
        fits = np.flatnonzero(room[:here] >= length)
        if not len(fits):
            break
        key = mix(h[fits] + np.uint64(length))
        known = pieces.marks[key >> np.uint64(64 - MARK_BITS)]
        key, fits = key[known], fits[known]
        at = np.minimum(np.searchsorted(pieces.hashes, key), len(pieces.hashes) - 1)
        hit = pieces.hashes[at] == key
        number[length - 1, fits[hit]] = pieces.numbers[at[hit]]
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF) * (points != _LITERAL)
    return number, np.where(number[0] < 0, width, 0)


def _weights(pieces: Pieces, number: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    log_p = np.append(pieces.log_p, -np.inf)  # -1: no edge
    w = log_p[number]
    w[0] = np.where(spelled > 0, spelled * (pieces.log_p[-1] - np.log(256)), w[0])
    return w


def _sum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the first axis."""
    top = x.max(axis=0)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(x - top).sum(axis=0))


def _batches(words: list[np.ndarray]):
    """Numbers of words, longest first, in batches of about ``BATCH`` code points."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    held: list[int] = []
    for i in order:
        if held and (len(held) + 1) * len(words[held[0]]) > BATCH:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def _lay(pieces: Pieces, words: list[np.ndarray]):
    """One batch: starts, lengths, edges and weights of words, longest first."""
    length = np.array([len(w) for w in words])
    start = np.cumsum(length) - length
    points = np.concatenate(words)
    room = np.repeat(start + length, length) - np.arange(len(points))
    number, spelled = _edges(pieces, points, room)
    return start, length, number, spelled, _weights(pieces, number, spelled)


def _forward(start, length, w, longest) -> np.ndarray:
    """alpha[j, word]: log weight of all ways to reach position j."""
    alpha = np.full((length[0] + 1, len(length)), -np.inf)
    alpha[0] = 0.0
    for j in range(1, length[0] + 1):
        live = np.searchsorted(-length, -j, side="right")
        back = np.arange(1, min(j, longest) + 1)
        alpha[j, :live] = _sum(alpha[j - back, :live] + w[back[:, None] - 1, start[None, :live] + j - back[:, None]])
    return alpha


def forward(pieces: Pieces, words: list[np.ndarray]) -> np.ndarray:
    """Natural log of the marginal probability of each word (code points with mark)."""
    out = np.zeros(len(words))
    short = [i for i, w in enumerate(words) if len(w) <= LONG]
    for i in set(range(len(words))) - set(short):
        out[i] = _forward_long(pieces, words[i])
    for batch in _batches([words[i] for i in short]):
        at = [short[i] for i in batch]
        start, length, _, _, w = _lay(pieces, [words[i] for i in at])
        alpha = _forward(start, length, w, pieces.longest)
        out[at] = alpha[length, np.arange(len(length))]
    return out


def _forward_long(pieces: Pieces, points: np.ndarray) -> float:
    """The same for one word of any length, a block of positions at a time."""
    longest, n = pieces.longest, len(points)
    reach = np.full(longest, -np.inf)  # reach[k]: ways to position at + k so far
    reach[0] = 0.0
    for at in range(0, n, LONG):
        block = points[at: at + LONG + longest]
        number, spelled = _edges(pieces, block, n - at - np.arange(len(block)))
        w = _weights(pieces, number, spelled)
        alpha = np.full(min(LONG, n - at) + longest, -np.inf)
        alpha[:longest] = reach
        for i in range(min(LONG, n - at)):
            alpha[i + 1: i + 1 + longest] = np.logaddexp(alpha[i + 1: i + 1 + longest], alpha[i] + w[:, i]) \
                if i + 1 + longest <= len(alpha) else np.logaddexp(alpha[i + 1:], alpha[i] + w[: len(alpha) - i - 1, i])
        reach = alpha[-longest:]
    return float(reach[0])


def expected(pieces: Pieces, words: list[np.ndarray]) -> np.ndarray:
    """Expected uses of every piece (last: of spelled bytes), each word once."""
    cut = [w[i: i + LONG] for w in words for i in range(0, len(w), LONG)]
    counts = np.zeros(len(pieces.log_p))
    for batch in _batches(cut):
        start, length, number, spelled, w = _lay(pieces, [cut[i] for i in batch])
        longest = pieces.longest
        alpha = _forward(start, length, w, longest)
        beta = np.full((length[0] + longest + 1, len(length)), -np.inf)
        beta[length, np.arange(len(length))] = 0.0
        for j in range(length[0] - 1, -1, -1):
            live = np.searchsorted(-length, -j, side="left")
            ahead = np.arange(1, longest + 1)
            beta[j, :live] = _sum(beta[j + ahead, :live] + w[ahead[:, None] - 1, start[None, :live] + j])
        word = np.repeat(np.arange(len(length)), length)
        pos = np.arange(len(word)) - start[word]
        before = alpha[pos, word] - beta[0, word]
        for k in range(longest):
            at = np.flatnonzero(np.isfinite(w[k]))
            use = np.exp(before[at] + w[k, at] + beta[pos[at] + k + 1, word[at]])
            spell = (spelled[at] > 0) & (k == 0)
            which = np.where(spell, len(pieces.log_p) - 1, number[k, at])
            counts += np.bincount(which, use * np.where(spell, spelled[at], 1), len(counts))
    return counts
