"""PII: base patterns, and spans added by a linear-chain conditional random field over word-shape features.

The field is trained by gradient ascent on the exact likelihood of a small labelled table (label_table(), or any
DataFrame of sentence, position, token, label) on the driver, and decoded by Viterbi in numpy batches: tokens are
words, chains are lines, and one step moves all lines of a batch by one token. Chains of more than BLOCK tokens are
decoded in blocks, all of them at once for every label before each, and then joined, so that the steps don't grow with
the longest line; the labels are the same. Added spans are decoded runs that
are plausible for their kind (digits, Luhn, address parts) and touch no base span; base spans always stay. A run is
split at base spans, and one that isn't plausible as a whole gives its plausible parts (neighbours of one kind).

Defined results: null or empty text has no spans; repeated rows get equal results; very long texts and lines are
decoded whole, in time that grows with their length; an empty table gives no rows;
columns beside key and text are ignored; equal starts go by kind in the order email, ip, card, phone.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.textops import LOWER, Rolling, pieces, quoted, short_batches, utf8, word_spans
from loomline.sources.readers import read_table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
BLOCK = 512  # tokens of a long chain that are decoded at once

# Base patterns, fixed by the contract. Anchors and possessive repeats only save time: each keeps the leftmost non-overlapping matches.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ starts no match but the one whose local part is the run before it, back to the last match's end."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_SET:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(only_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- word-shape features

CUES = ("", "at", "(at)", "[at]", "dot", "(dot)", "[dot]", "call", "tel", "tel:", "phone", "phone:", "fax", "mobile", "email", "email:", "mail", "mail:", "card", "card:", "visa", "ip", "ip:", "host", "write", "to", "the", "is", "on")
_CLASS = np.full(256, 7, np.uint8)  # 0 digit 1 letter 2 @ 3 . 4 - 5 + 6 bracket 7 other
_CLASS[[*range(48, 58)]] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
for _c, _k in (("@", 2), (".", 3), ("-", 4), ("+", 5), ("()[]", 6)):
    _CLASS[[ord(x) for x in _c]] = _k
_HASH = Rolling(11)
SHAPES, COARSE = 2 * 4 * 6 * 3 * 8, 16
_DIGITS = np.array([0, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4], np.int64)


def _cue_table() -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer("".join(CUES).encode(), np.uint8)
    ends = np.cumsum([len(c) for c in CUES])
    h = _HASH.words(joined, ends - [len(c) for c in CUES], ends)[1:]
    order = np.argsort(h)
    return h[order], order + 1


_CUE_HASH, _CUE_ID = _cue_table()


def shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shape, coarse shape, cue) of each word."""
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    kind = _CLASS[buf]

    def count(k: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int32)])
        return sums[ends] - sums[starts]

    digits, letters, dots, ats = count(0), count(1), count(3), count(2)
    d, n = np.where(digits > 11, 5, _DIGITS[np.minimum(digits, 11)]), np.where(letters > 2, 2, (letters > 0).astype(np.int64))
    shape = ((((ats > 0) * 4 + np.minimum(dots, 3)) * 6 + d) * 3 + n) * 8 + kind[starts]
    coarse = np.where(ats > 0, 15, np.where(digits == 0, n, 3 + d * 2 + (letters > 0)))
    h = _HASH.words(LOWER[buf], starts, ends)
    at = np.minimum(np.searchsorted(_CUE_HASH, h), len(_CUE_HASH) - 1)
    return shape, coarse, np.where(_CUE_HASH[at] == h, _CUE_ID[at], 0)


@dataclass
class Field:
    own: np.ndarray  # shape x label
    before: np.ndarray  # coarse shape of the word before x label
    after: np.ndarray
    cue: np.ndarray
    cue_before: np.ndarray
    cue_after: np.ndarray
    moves: np.ndarray  # label x label
    first: np.ndarray

    def emissions(self, shape: np.ndarray, coarse: np.ndarray, cue: np.ndarray, new: np.ndarray) -> np.ndarray:
        """new: where a chain begins. Neighbours beyond a chain count as coarse shape and cue 0."""
        e = self.own[shape] + self.cue[cue]
        if len(shape) > 1:
            inside = ~new[1:, None]
            e[1:] += inside * (self.before[coarse[:-1]] + self.cue_before[cue[:-1]])
            e[:-1] += inside * (self.after[coarse[1:]] + self.cue_after[cue[1:]])
        return e

    def decode(self, e: np.ndarray, new: np.ndarray) -> np.ndarray:
        """The best labels of all chains."""
        first = np.flatnonzero(new)
        out = np.zeros(len(e), np.uint8)
        length = np.diff(np.append(first, len(e)))
        short = length <= BLOCK
        if short.any():
            self._chains(e, first[short], length[short], out)
        for a, n in zip(first[~short].tolist(), length[~short].tolist()):
            out[a : a + n] = self._long(e[a : a + n])
        return out

    def _chains(self, e: np.ndarray, first: np.ndarray, length: np.ndarray, out: np.ndarray) -> None:
        """Step t moves each chain that long."""
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")
        back = np.zeros(e.shape, np.uint8)
        best = e[first] + self.first
        ends = np.zeros(len(first), np.uint8)
        for t in range(1, length[0]):
            k = active[t]
            ends[k : active[t - 1]] = best[k:].argmax(1)
            way = best[:k, :, None] + self.moves
            at = first[:k] + t
            back[at] = way.argmax(1)
            best = way.max(1) + e[at]
        ends[: len(best)] = best.argmax(1)
        now = ends
        for t in range(length[0] - 1, -1, -1):
            k = active[t]
            at = first[:k] + t
            if t + 1 < length[0]:
                j = active[t + 1]
                now[:j] = back[at[:j] + 1, out[at[:j] + 1]]
            out[at] = now[:k]

    def _long(self, e: np.ndarray) -> np.ndarray:
        """One chain in blocks: the best way from each label before a block to each at its end, then the best of these, then the labels inside."""
        L, blocks = e.shape[1], -(-len(e) // BLOCK)
        last = len(e) - (blocks - 1) * BLOCK  # tokens of the last block; its rest is filled with tokens that change nothing
        padded = np.concatenate([e, np.zeros((blocks * BLOCK - len(e), L))]).reshape(blocks, BLOCK, L)
        stay = np.where(np.eye(L, dtype=bool), 0, -np.inf)
        way = np.broadcast_to(self.moves, (blocks, L, L)) + padded[:, 0][:, None, :]
        way[0] = self.first + padded[0, 0]
        back = np.zeros((blocks, BLOCK, L, L), np.uint8)  # block, token, label before the block, label here
        for t in range(1, BLOCK):
            moves = np.broadcast_to(self.moves, (blocks, L, L)) if t < last else np.concatenate([np.broadcast_to(self.moves, (blocks - 1, L, L)), stay[None]])
            step = way[:, :, :, None] + moves[:, None]
            back[:, t] = step.argmax(2)
            way = step.max(2) + padded[:, t][:, None, :]
        score, came = way[0, 0], np.zeros((blocks, L), np.int64)
        for b in range(1, blocks):
            step = score[:, None] + way[b]
            came[b], score = step.argmax(0), step.max(0)
        ends, before = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
        ends[-1] = score.argmax()
        for b in range(blocks - 1, 0, -1):
            before[b] = ends[b - 1] = came[b, ends[b]]
        out, each = np.zeros((blocks, BLOCK), np.uint8), np.arange(blocks)
        out[:, -1] = ends
        for t in range(BLOCK - 1, 0, -1):
            out[:, t - 1] = back[each, t, before, out[:, t]]
        return out.ravel()[: len(e)]


def train(rows: list[tuple[int, int, str, str]], steps: int = 120, penalty: float = 0.02) -> Field:
    """rows: (sentence, position, token, label). Gradient ascent (Adam) with exact forward-backward."""
    rows = sorted(rows)
    words = [r[2].encode() for r in rows]
    n, L = len(rows), len(LABELS)
    buf = np.frombuffer(b"".join(words) or b" ", np.uint8)
    ends = np.cumsum([len(w) for w in words])
    shape, coarse, cue = shapes(buf, ends - [len(w) for w in words], ends)
    y = np.array([LABELS.index(r[3]) for r in rows])
    sentence = np.array([r[0] for r in rows])
    new = np.append(True, sentence[1:] != sentence[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    active = [int((length > t).sum()) for t in range(length[0])]
    sizes = (SHAPES, COARSE, COARSE, len(CUES), len(CUES), len(CUES), L, 1)
    at = np.cumsum([0, *sizes])
    w = np.zeros((at[-1], L))
    m, v = np.zeros_like(w), np.zeros_like(w)
    inside = np.flatnonzero(~new)

    def field() -> Field:
        parts = [w[a:b] for a, b in zip(at, at[1:])]
        return Field(*parts[:7], parts[7][0])

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)

    for step in range(1, steps + 1):
        f = field()
        e = f.emissions(shape, coarse, cue, new)
        alpha, beta = np.zeros((n, L)), np.zeros((n, L))
        alpha[first] = e[first] + f.first
        for t in range(1, length[0]):
            i = first[: active[t]] + t
            alpha[i] = lse(alpha[i - 1][:, :, None] + f.moves, 1) + e[i]
        for t in range(length[0] - 2, -1, -1):
            i = first[: active[t + 1]] + t
            beta[i] = lse(f.moves + (e[i + 1] + beta[i + 1])[:, None, :], 2)
        z = lse(alpha + beta, 1)
        gap = np.eye(L)[y] - np.exp(alpha + beta - z[:, None])
        g = np.zeros_like(w)
        np.add.at(g, at[0] + shape, gap)
        np.add.at(g, at[1] + coarse[inside - 1], gap[inside])
        np.add.at(g, at[2] + coarse[inside], gap[inside - 1])
        np.add.at(g, at[3] + cue, gap)
        np.add.at(g, at[4] + cue[inside - 1], gap[inside])
        np.add.at(g, at[5] + cue[inside], gap[inside - 1])
        pair = np.exp(alpha[inside - 1][:, :, None] + f.moves + (e[inside] + beta[inside])[:, None, :] - z[inside][:, None, None])
        seen = np.zeros((L, L))
        np.add.at(seen, (y[inside - 1], y[inside]), 1)
        g[at[6] : at[7]] = seen - pair.sum(0)
        g[at[7]] = gap[first].sum(0)
        g = g - penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return field()


def label_table(sentences: int = 700, seed: int = 5) -> list[tuple[int, int, str, str]]:
    """A small labelled table: filler words, harmless numbers, and personal data in plain and in disguised forms."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    syllables = ("an", "ber", "ción", "de", "er", "est", "ing", "la", "ment", "on", "que", "re", "sch", "st", "the", "tion", "un", "ver")
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    octet = lambda: str(r.randint(0, 255))
    at, dot = (lambda: r.choice(("at", "(at)", "[at]"))), (lambda: r.choice(("dot", "(dot)", "[dot]")))

    def card() -> str:
        body = r.choice("3456") + d(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def grouped(x: str, sep: str) -> str:
        return sep.join(x[i : i + 4] for i in range(0, len(x), 4))

    harmless = (
        lambda: d(r.randint(1, 4)), lambda: f"{d(1)}.{d(2)}", lambda: f"{d(2)}%", lambda: f"19{d(2)}-{d(2)}-{d(2)}", lambda: f"v{d(1)}.{d(1)}.{d(1)}", lambda: f"{d(3)},{d(3)}",
        lambda: f"{word()}{d(2)}", lambda: f"#{d(5)}", lambda: f"({d(4)})", lambda: f"{word()}.", lambda: f"{word()},", lambda: f"{word()}.{word()}", lambda: f"{d(16)}{word()}", lambda: f"@{word()}", lambda: f"{word()}-{word()}", lambda: "+", lambda: "|", lambda: f"{d(2)}:{d(2)}", lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice((16, 32, 40)))), lambda: f"{word()}=\"{d(4)}{word()}\"",
    )
    personal = (
        lambda: ("email", [f"{word()}.{d(2)}@{word()}{d(1)}.example.com"]), lambda: ("email", [word(), at(), word(), dot(), r.choice(("com", "org", "net"))]), lambda: ("email", [f"{word()}@{word()}", dot(), "com"]), lambda: ("email", [f"{word()}[at]{word()}[dot]com"]), lambda: ("email", [f"{word()}{d(2)}", at(), f"{word()}.com"]),
        lambda: ("ip", [".".join(octet() for _ in range(4))]), lambda: ("ip", ["[.]".join(octet() for _ in range(4))]), lambda: ("ip", [octet() + "(dot)" + octet() + "(dot)" + octet() + "(dot)" + octet()]),
        lambda: ("card", [card()]), lambda: ("card", grouped(card(), " ").split()), lambda: ("card", [grouped(card(), ".")]), lambda: ("card", [grouped(card(), "-")]), lambda: ("card", [grouped(card(), "/")]),
        lambda: ("phone", [f"+{d(2)}", d(3), d(3), d(4)]), lambda: ("phone", [f"({d(3)})", f"{d(3)}-{d(4)}"]), lambda: ("phone", [f"{d(3)}-{d(3)}-{d(4)}"]), lambda: ("phone", [f"{d(3)}.{d(3)}.{d(4)}"]), lambda: ("phone", [f"0{d(3)}", f"{d(3)}", d(4)]), lambda: ("phone", [f"+{d(2)}{d(9)}"]),
    )
    lead = {"email": ("email", "mail", "write", "email:", "to", ""), "ip": ("ip", "host", "ip:", "from", ""), "card": ("card", "visa", "card:", ""), "phone": ("call", "tel", "tel:", "phone", "phone:", "mobile", "")}
    rows = []
    for s in range(sentences):
        tokens = [(r.choice(harmless)() if r.random() < 0.25 else word(), "O") for _ in range(r.randint(2, 8))]
        if s % 4:
            kind, parts = r.choice(personal)()
            cue = r.choice(lead[kind])
            tail = r.choice(("", "", ".", ","))
            tokens += [(cue, "O")] * bool(cue) + [(p + (tail if i + 1 == len(parts) else ""), kind) for i, p in enumerate(parts)]
            tokens += [(word(), "O") for _ in range(r.randint(0, 5))]
        rows += [(s, i, t, label) for i, (t, label) in enumerate(tokens)]
    return rows


_PARTS = re.compile(r"\s*[\[(]?\s*(?:\bdot\b|\.)\s*[\])]?\s*")
_AT = re.compile(r"\s*(?:[\[(]\s*(?:at|@)\s*[\])]|@|\bat\b)\s*", re.I)


def plausible(kind: int, text: str) -> bool:
    """Whether a decoded run can be what its label says."""
    digits = only_digits(text)
    if kind == 0:
        sides = _AT.split(text)
        labels = _PARTS.split(sides[-1])
        return len(sides) == 2 and bool(re.fullmatch(r"[A-Za-z0-9._%+-]+", sides[0])) and len(labels) > 1 and all(re.fullmatch(r"[A-Za-z0-9-]+", x) for x in labels)
    if kind == 1:
        parts = _PARTS.split(text)
        return len(parts) == 4 and all(re.fullmatch(r"[0-9]{1,3}", p) and int(p) <= 255 for p in parts)
    if kind == 2:
        return bool(re.fullmatch(r"[0-9][0-9 ./-]+[0-9]", text)) and 12 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"[+(0-9][0-9 ().-]+[0-9]", text)) and 9 <= len(digits) <= 15 and len(re.split(r"[ ().-]+", text.strip("+()"))) >= 3


_TRIM = ".,;:!?\"'<>"


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _TRIM:
        a += 1
    while a < b and text[b - 1] in _TRIM:
        b -= 1
    return a, b


def apart(tokens: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """A run's tokens without those that touch base spans (sorted), in stretches between them."""
    out: list[list[tuple[int, int]]] = [[]]
    i, end = 0, 0  # the spans that begin before the token's end, and the last of their ends
    for a, b in tokens:
        while i < len(base) and base[i][0] < b:
            end = max(end, base[i][2])
            i += 1
        if end > a:
            out.append([])
        else:
            out[-1].append((a, b))
    return [x for x in out if x]


#: Digits that a span of each kind holds at most, by plausible().
MOST_DIGITS = (None, 12, 19, 15)


def _hopeless(kind: int, text: str, n: int) -> bool:
    """Whether nothing that begins with this text of n tokens can be plausible."""
    if kind:
        return len(only_digits(text)) > MOST_DIGITS[kind]
    sides = _AT.split(text)
    if len(sides) == 1:
        return n > 3  # the local part is one token
    return len(sides) > 2 or not all(re.fullmatch(r"[A-Za-z0-9-]+", x) for x in _PARTS.split(sides[1])[:-1])


def parts_of(kind: int, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretch if it is plausible, or else the plausible parts of it that cover most tokens, the fewest of equals."""
    fits = lambda a, b: b - a > 4 and plausible(kind, text[a:b])
    whole = trimmed(text, tokens[0][0], tokens[-1][1])
    if fits(*whole):
        return [whole]
    n = len(tokens)
    best: list[tuple[int, int, int]] = [(0, 0, 0)] * (n + 1)  # (tokens covered, -parts, tokens of the first part) from each token on
    for i in range(n - 1, -1, -1):
        best[i] = (*best[i + 1][:2], 0)
        for j in range(i, n):
            a, b = trimmed(text, tokens[i][0], tokens[j][1])
            if fits(a, b):
                best[i] = max(best[i], (j + 1 - i + best[j + 1][0], best[j + 1][1] - 1, j + 1 - i))
            elif _hopeless(kind, text[a:b], j + 1 - i):
                break
    out, i = [], 0
    while i < n:
        if best[i][2]:
            out.append(trimmed(text, tokens[i][0], tokens[i + best[i][2] - 1][1]))
        i += best[i][2] or 1
    return out


def hopeful_lines(buf: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Which lines can hold a plausible span: each kind but email needs a digit, and email an @ or the word at (bytes that aren't ASCII count as its ends)."""
    low = LOWER[buf]
    hit = (low == ord("@")) | (low >= ord("0")) & (low <= ord("9"))
    if len(low) > 1:
        inside = (low >= ord("a")) & (low <= ord("z")) | (low == ord("_"))
        at = (low[:-1] == ord("a")) & (low[1:] == ord("t"))
        at[1:] &= ~inside[:-2]
        at[:-1] &= ~inside[2:]
        hit[:-1] |= at
    out = np.zeros(int(line[-1]) + 1, bool)
    out[line[:-1][hit]] = True
    return out


def chain_spans(field: Field, piece: pa.Array, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Each text's added spans: decoded runs clear of base spans, trimmed, as a whole or in plausible parts. Lines that can't hold any aren't decoded; chains are lines, so the others' labels stay."""
    buf, offsets = utf8(piece)
    starts, ends, per = word_spans(buf, offsets)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(starts):
        return out
    lines = np.concatenate([[0], np.cumsum(buf == 10)])
    keep = hopeful_lines(buf, lines)[lines[starts]]
    starts, ends = starts[keep], ends[keep]
    per = np.searchsorted(starts, offsets)
    if not len(starts):
        return out
    new = np.ones(len(starts), bool)
    new[1:] = lines[starts[1:]] != lines[starts[:-1]]
    new[per[:-1][np.diff(per) > 0]] = True
    shape, coarse, cue = shapes(buf, starts, ends)
    labels = field.decode(field.emissions(shape, coarse, cue, new), new)
    run = np.append(True, (labels[1:] != labels[:-1]) | new[1:])
    heads = np.flatnonzero(run & (labels > 0))
    tails = np.append(np.flatnonzero(run), len(labels))
    tails = tails[np.searchsorted(tails, heads, "right")] - 1
    doc = np.searchsorted(per, heads, "right") - 1
    point = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before each byte
    origin = point[offsets[:-1]]
    began = [[x for x, _, _ in b] for b in base]
    reach = [list(accumulate((y for _, _, y in b), max)) for b in base]  # where the spans up to each one end at last
    for d, h, t in zip(doc.tolist(), heads.tolist(), tails.tolist()):
        kind = int(labels[h]) - 1
        tokens = list(zip((point[starts[h : t + 1]] - origin[d]).tolist(), (point[ends[h : t + 1]] - origin[d]).tolist()))
        near = base[d][bisect_right(reach[d], tokens[0][0]) : bisect_left(began[d], tokens[-1][1])]
        out[d] += [(x, kind, y) for part in apart(tokens, near) for x, y in parts_of(kind, texts[d], part)]
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span (overlapping ones merged) gives way to its kind in angle brackets."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find(df: DataFrame, field: Field, key: str = "doc_id", text: str = "text", redacted: bool = False) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of each row, and with `redacted` the text with its spans replaced (null stays null)."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(field)  # some thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for piece in pieces(batches):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = chain_spans(field, piece.column("text"), texts, base)
            counts = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64()) for kind in range(4)]
            sha = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
            every = [[*b, *m] for b, m in zip(base, more)]
            columns = [piece.column("key"), *counts, pa.array(sha, pa.string()), pa.array(map(joined, every), pa.string()), pa.array(map(len, more), pa.int64())]
            if redacted:
                was = piece.column("text").to_pylist()
                columns.append(pa.array([None if w is None else redact(t, e) for w, t, e in zip(was, texts, every)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["key", *names])

    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", *["redacted"] * redacted]
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kinds = dict.fromkeys(names, T.LongType()) | dict.fromkeys(["base_sha256", "spans", "redacted"], T.StringType())
    out = source.transform(short_batches).mapInArrow(run, T.StructType([source.schema["key"], *(T.StructField(n, kinds[n]) for n in names)]))
    return out.withColumnRenamed("key", key)


def redact_column(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """df with its text redacted; all other columns and the number of rows stay."""
    rest = [c for c in df.columns if c != text]
    packed = df.select(F.struct(*(F.col(quoted(c)) for c in rest)).alias("rest"), F.col(text).alias("text"))
    out = find(packed, field, "rest", "text", redacted=True)
    return out.select("rest.*", F.col("redacted").alias(text)).select(*map(quoted, df.columns))


def trained(spark=None, table: DataFrame | None = None) -> Field:
    """The field fitted on a labelled table (sentence, position, token, label), by default label_table()."""
    rows = label_table() if table is None else [tuple(r) for r in table.select("sentence", "position", "token", "label").toLocalIterator()]
    return train(rows)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    return find(read_table(spark, f"{sf_dir}/documents.parquet"), trained())
