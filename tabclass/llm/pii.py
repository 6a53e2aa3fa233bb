"""Personal data in whole texts: known forms, and a linear-chain CRF.

Known forms are patterns with checks (email, ip, card, phone).  A linear-chain
conditional random field over word-shape features adds spans that the patterns
miss, such as phone numbers without a country code and spelled-out addresses.
It is trained on a small labelled table of sentences, made below from a few
templates, and decoded by Viterbi in numpy batches: all words of all texts, in
sequences that are the lines of a text.  Only stretches with words in doubt are
decoded, long ones in blocks whose best paths are joined exactly: the tags are
those of the whole line, however long it is.
What it tags is kept only if it has the digits or signs that its kind needs; a
phone number without a country code may have any grouping of 7 to 15 digits, if
the model gives it a probability of at least ``PHONE_BAR``.
"""
from __future__ import annotations

import functools
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import pick
from tabclass.llm.shingles import _LOWER, mix64, text_chunks, word_hashes, words

KINDS = ("email", "ip", "card", "phone", "ssn")
TAGS = ("O", *KINDS)

# ------------------------------------------------------------- known forms
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
#: A match can only begin where no digit stands before: the digits are taken greedily.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Digits and separators as phone numbers are grouped, in tagged words.
GROUPED = re.compile(rb"[+(]?[0-9](?:[ ().-]{0,3}[0-9])*")
LOCAL_DIGITS = range(7, 16)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ so that long words cost nothing extra."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > done and (text[left - 1].isascii() and (text[left - 1].isalnum() or text[left - 1] in "._%+-")):
            left -= 1
        right = DOMAIN.match(text, at + 1) if left < at else None
        if right:
            out.append((left, right.end()))
            done = right.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))
    return out


def _octets(text: str) -> bool:
    """Whether every dotted part is at most 255; leading zeros, however many, don't count."""
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms of a text."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if _octets(m.group()):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _only_digits(m.group()) if m.end() - m.start() >= 12 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_only_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# ----------------------------------------------------------------- features
TABLE_BITS = 12
FEATURES = 8

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("d")
_SHAPE[65:91] = ord("U")
_SHAPE[97:123] = ord("l")
_SHAPE[128:] = ord("l")


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """Words x FEATURES: table rows of the word's shape, collapsed shape, digit
    count and identity, and of its neighbours' collapsed shapes and the two
    identities before it, within a sequence."""
    shape = _SHAPE[data]
    fresh = np.ones(len(data), dtype=bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[start] = True
    at = np.concatenate([[0], np.cumsum(fresh)])
    short = word_hashes(shape[fresh], at[start], at[end])
    full = word_hashes(shape, start, end)
    word = word_hashes(_LOWER[data], start, end)
    digits = np.concatenate([[0], np.cumsum(shape == ord("d"))])
    zero = np.isin(data[start], np.frombuffer(b"0(", dtype=np.uint8))  # as trunk prefixes begin
    count = (np.minimum(digits[end] - digits[start], 20) * 64 + np.minimum(end - start, 31) * 2 + zero).astype(np.uint64)
    edge = np.uint64(0xE)

    def neighbour(value: np.ndarray, step: int) -> np.ndarray:
        out = np.full(len(value), edge)
        if len(value) > abs(step):
            far = abs(step)
            same = sequence[far:] == sequence[:-far]
            if step < 0:
                out[far:][same] = value[:-far][same]
            else:
                out[:-far][same] = value[far:][same]
        return out

    columns = (full, short, count, word, neighbour(short, -1), neighbour(short, 1), neighbour(word, -1), neighbour(word, -2))
    rows = [(mix64(c + np.uint64(1_000_003 * (i + 1))) >> np.uint64(64 - TABLE_BITS)).astype(np.int32) + (i << TABLE_BITS) for i, c in enumerate(columns)]
    return np.stack(rows, axis=1)


# ---------------------------------------------------------- labelled sentences
# A small labelled table: what stands in a slot has the slot's tag, the rest is O.
TEMPLATES = (
    "w w {email} w w", "w w w {email}, w w.", "mail {email} w", "W w. {email} w w w", "w | {email} | w | w", "w w {email}%%% w&&& w***",
    "contact w at {email_said} w w", "w w {email_said} w",
    "w w {ip} w w", "w {ip}. w w", "{ip} W w", "w | {ip} | w", "server {ip} w w", "W!! {ip}!! W!! W!!",
    "w w {card} w w w", "card {card} w w", "w {card}, w", "W w {card}", "w | {card} | w", "w*** {card}$$$ w",
    "w w {phone} w w", "call {phone} w w w", "tel {phone_local} w", "phone: {phone_local} w w", "w w {phone_local} w w", "W w. {phone} W w", "{phone} w w",
    "tel {phone_other} w", "call {phone_other} w w w", "phone: {phone_other} w w", "w w fax {phone_other}, w", "W mobile {phone_other}. W w", "telefon {phone_other} w",
    "w w ring w on {phone_other} w", "w call w at {phone_other}", "tel. {phone_other}, w w", "tel: {phone_other} w {phone_other} w", "w w number: {phone_other} w w",
    "ssn {ssn} w w", "w w {ssn} w", "w number {ssn}, w",
    "w w w w w w w", "W w w, w w. W w w w", "w w w w w w w w w", "w w w. W w", "w | w | W | w.", "W!! W!! W,!! W!!", "w*** w$$$ w.### w&&& w%%%",
    "w w {number} w w", "w {number}. W w w", "{number} w w w", "w w {year} w", "W {date} w w", "w w {date}, w", "w {price} w w", "w {version} w", "w w {number}%%% w",
    "w {long} w w", "w {long} w", "token = \"{key}\" w w", "w {time} w w", "w {number} {number} w", "w w {number}-{number} w", "w ({year}) w w",
)
COPIES = 24


def _value(slot: str, rng: np.random.Generator) -> str:
    digit = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    word = lambda: "".join(rng.choice(list("aeionrstlhdcm"), rng.integers(2, 9)))
    any_of = lambda *v: v[int(rng.integers(0, len(v)))]
    if slot == "email":
        return f"{word()}{any_of('.', '_', '')}{any_of(word(), digit(2))}@{word()}{any_of('', digit(1))}.{any_of('example.com', 'com', 'org', 'co.uk')}"
    if slot == "email_said":
        return f"{word()} {any_of('[at]', '(at)')} {word()} {any_of('[dot]', '(dot)')} com"
    if slot == "ip":
        return ".".join(str(v) for v in rng.integers(0, 256, 4))
    if slot == "card":
        body = digit(15)
        whole = body + next(c for c in "0123456789" if luhn(body + c))
        return any_of(whole, " ".join(whole[i : i + 4] for i in range(0, 16, 4)), "-".join(whole[i : i + 4] for i in range(0, 16, 4)))
    if slot == "phone":
        return any_of(f"+1 ({digit(3)}) 555-{digit(4)}", f"+{digit(2)} {digit(3)} {digit(3)} {digit(4)}", f"+{digit(2)}-{digit(3)}-{digit(7)}")
    if slot == "phone_local":
        return any_of(f"({digit(3)}) {digit(3)}-{digit(4)}", f"{digit(3)}-{digit(3)}-{digit(4)}", f"{digit(3)}.{digit(3)}.{digit(4)}")
    if slot == "phone_other":
        return any_of(
            *[f"0{digit(2)} {digit(4)} {digit(4)}", f"(0{digit(2)}) {digit(4)} {digit(4)}"] * 3, f"0{digit(2)} {digit(6)}", f"{digit(3)} {digit(4)}", f"{digit(3)}-{digit(4)}", f"0{digit(4)} {digit(3)} {digit(3)}", f"0{digit(4)} {digit(6)}",
            f"0{digit(1)} " + " ".join(digit(2) for _ in range(4)), f"0{digit(3)}-{digit(3)}-{digit(4)}", f"{digit(2)} {digit(3)} {digit(2)} {digit(2)}",
            f"{digit(3)} {digit(3)} {digit(3)}", f"0{digit(2)}-{digit(7)}", f"0{digit(9)}", f"0{digit(3)}.{digit(3)}.{digit(3)}",
        )
    if slot == "range":
        return f"{any_of('18', '19', '20')}{digit(2)}-{any_of('18', '19', '20')}{digit(2)}" if rng.random() < 0.7 else f"{digit(2)}-{digit(2)}"
    if slot == "thousands":
        sep = any_of(" ", ".")
        return sep.join([str(int(rng.integers(1, 999))), *(digit(3) for _ in range(int(rng.integers(1, 4))))])
    if slot == "isbn":
        return any_of(f"978-{digit(1)}-{digit(2)}-{digit(6)}-{digit(1)}", f"97{digit(11)}", f"{digit(1)}-{digit(4)}-{digit(4)}-{digit(1)}")
    if slot == "code":
        return any_of(f"{digit(2)}-{digit(5)}", f"{digit(4)}-{digit(6)}", f"{digit(9)}", f"{digit(8)}-{digit(1)}", f"{digit(6)}-{digit(4)}-{digit(2)}", f"20{digit(2)}-{digit(5)}")
    if slot == "ssn":
        return f"{digit(3)}-{digit(2)}-{digit(4)}"
    if slot == "date":
        return any_of(f"20{digit(2)}-0{digit(1)}-1{digit(1)}", f"1{digit(1)}/0{digit(1)}/20{digit(2)}", f"1{digit(1)}.0{digit(1)}.20{digit(2)}")
    return {
        "number": lambda: str(int(rng.integers(1, 10 ** int(rng.integers(1, 8))))), "year": lambda: any_of("19", "20") + digit(2), "price": lambda: f"${digit(2)}.{digit(2)}",
        "version": lambda: f"{digit(1)}.{digit(1)}.{digit(2)}", "long": lambda: digit(int(rng.integers(8, 16))), "time": lambda: f"1{digit(1)}:{digit(2)}",
        "key": lambda: "".join(rng.choice(list("0123456789abcdef"), 40)),
    }[slot]()


def labelled_sentences(seed: int = 3) -> list[tuple[list[str], list[int]]]:
    """Words and tags of every sentence of the labelled table: the templates,
    with up to three plain words before and two after."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(COPIES):
        for template in TEMPLATES:
            row, tags = [], []
            template = "w " * int(rng.integers(0, 4)) + template + " w" * int(rng.integers(0, 3))
            for part in template.split(" "):
                slot = re.search(r"\{(\w+)\}", part)
                filled = part
                while m := re.search(r"\{(\w+)\}", filled):
                    filled = filled[: m.start()] + _value(m.group(1), rng) + filled[m.end() :]
                if not slot:
                    plain = "".join(rng.choice(list("aeionrstlhdcmüéñ"), rng.integers(1, 12)))
                    filled = re.sub(r"\bW\b", plain.upper() if "!!" in part else plain.capitalize(), re.sub(r"\bw\b", plain, part))
                kind = slot.group(1).split("_")[0] if slot else "O"
                for w in filled.split(" "):
                    row.append(w)
                    tags.append(TAGS.index(kind) if kind in TAGS else 0)
            out.append((row, tags))
    return out


# ---------------------------------------------------------------------- CRF
def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


@functools.lru_cache(maxsize=1)
def trained(epochs: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Emission table and transitions, by gradient ascent on the conditional
    likelihood of all sentences at once (forward-backward over padded batches)."""
    sentences = labelled_sentences()
    size = np.array([len(w) for w, _ in sentences])
    data = np.frombuffer(" ".join(w for row, _ in sentences for w in row).encode(), dtype=np.uint8)
    offsets = np.array([0, len(data)], dtype=np.int64)
    start, end, _ = words(data, offsets)
    sequence = np.repeat(np.arange(len(sentences)), size)
    rows = word_features(data, start, end, sequence)
    tags = np.array([t for _, ts in sentences for t in ts])
    n, longest, k = len(sentences), int(size.max()), len(TAGS)
    place = np.concatenate([np.arange(s) for s in size])
    mask = np.arange(longest)[None, :] < size[:, None]
    emit, move = np.zeros((FEATURES << TABLE_BITS, k)), np.zeros((k, k))
    last = np.flatnonzero(np.r_[sequence[1:] != sequence[:-1], True])
    pairs = np.flatnonzero(sequence[1:] == sequence[:-1])
    seen = np.zeros((k, k))
    np.add.at(seen, (tags[pairs], tags[pairs + 1]), 1)
    square_e, square_m = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    for _ in range(epochs):
        score = np.zeros((n, longest, k))
        score[sequence, place] = emit[rows].sum(axis=1)
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, longest):
            step = _lse(alpha[:, t - 1, :, None] + move[None], 1) + score[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _lse(move[None] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None], step, 0)
        norm = _lse(alpha[:, -1], 1)
        gold = np.zeros((len(tags), k))
        gold[np.arange(len(tags)), tags] = 1
        wrong = gold - np.exp(alpha + beta - norm[:, None, None])[sequence, place]
        grad_e = np.zeros_like(emit)
        for f in range(FEATURES):
            np.add.at(grad_e, rows[:, f], wrong)
        grad_e -= 0.05 * emit
        both = alpha[:, :-1, :, None] + move[None, None] + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        grad_m = seen - np.exp(both)[mask[:, 1:]].sum(axis=0) - 0.05 * move
        square_e += grad_e**2
        square_m += grad_m**2
        emit += 0.5 * grad_e / np.sqrt(square_e)
        move += 0.5 * grad_m / np.sqrt(square_m)
    assert len(last) == n
    return emit.astype(np.float32), move.astype(np.float32)


def _runs(score: np.ndarray, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and length of the sequences, longest first, and how many are longer than each t."""
    first = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
    size = np.diff(np.r_[first, len(score)])
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    return first, size, np.searchsorted(-size, -np.arange(int(size[0])), side="left")


def viterbi(score: np.ndarray, sequence: np.ndarray, move: np.ndarray, before: np.ndarray | None = None, final: np.ndarray | None = None) -> np.ndarray:
    """Best tags of words with emission ``score`` in consecutive sequences.
    ``before`` (what each tag of a sequence's first word gets besides) and
    ``final`` (the tag of its last word) may be given, in order of sequences."""
    if len(score) == 0:
        return np.zeros(0, np.int8)
    first, size, active = _runs(score, sequence)
    at_sequence = np.argsort(np.argsort(first)) if before is not None or final is not None else None
    best = score[first].copy()
    if before is not None:
        best += before[at_sequence]
    back = np.zeros((len(score), score.shape[1]), dtype=np.int8)
    for t in range(1, len(active)):
        m = active[t]
        reach = best[:m, :, None] + move[None]
        at = first[:m] + t
        back[at] = reach.argmax(axis=1)
        best[:m] = reach.max(axis=1) + score[at]
    out = np.zeros(len(score), dtype=np.int8)
    out[first + size - 1] = best.argmax(axis=1) if final is None else final[at_sequence]
    for t in range(len(active) - 1, 0, -1):
        m = active[t]
        at = first[:m] + t
        out[at - 1] = back[at, out[at]]
    return out


#: Words of one block of a long sequence.
PIECE = 128


def _in_blocks(score: np.ndarray, sequence: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The tags of ``viterbi``, in steps bounded by ``PIECE`` and the number of
    blocks instead of the longest sequence: blocks are reduced side by side to
    the best score from each tag before them to each tag at their end, these are
    chained, and every block is decoded between the tags found at its ends."""
    fresh = np.r_[True, sequence[1:] != sequence[:-1]]
    inside = np.arange(len(score)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    head = inside % PIECE == 0
    begin = inside[head] == 0  # blocks that begin a sequence
    if begin.all():
        return viterbi(score, sequence, move)
    block, k = np.cumsum(head) - 1, score.shape[1]
    first, _, active = _runs(score, block)
    number = np.argsort(np.argsort(first))
    before = np.where(begin[number][:, None, None], 0, move[None]).astype(score.dtype)  # block x tag before x tag
    reach = before + score[first][:, None, :]
    for t in range(1, len(active)):
        m = active[t]
        step = (reach[:m, :, :, None] + move[None, None]).max(axis=2)
        reach[:m] = step + score[first[:m] + t][:, None, :]
    reach = reach[np.argsort(first)]
    n = len(begin)
    choice, total = np.zeros((n, k), np.int8), np.zeros((n, k))
    for i in range(n):
        way = reach[i] if begin[i] else total[i - 1][:, None] + reach[i]
        choice[i], total[i] = way.argmax(axis=0), way.max(axis=0)
    final = np.zeros(n, np.int8)
    lead = np.zeros((n, k), score.dtype)
    for i in range(n - 1, -1, -1):
        if i == n - 1 or begin[i + 1]:
            final[i] = total[i].argmax()
        if not begin[i]:
            final[i - 1] = choice[i, final[i]]
            lead[i] = move[final[i - 1]]
    return viterbi(score, block, move, lead, final)


def surely_plain(score: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Words whose best tag is O whatever stands before and after them: O leads
    every other tag by more than any neighbours can make up for."""
    need = np.maximum(0, (move - move[:, :1]).max(axis=0)) + np.maximum(0, (move - move[:1]).max(axis=1))
    return (score[:, :1] - score[:, 1:] > need[None, 1:] + 1e-3).all(axis=1)


def decode(score: np.ndarray, sequence: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The tags of ``viterbi``, computed only where they are in doubt: the words
    between surely plain ones, with these at both ends, make sequences of their own."""
    out = np.zeros(len(score), np.int8)
    doubt = ~surely_plain(score, move)
    same = sequence[1:] == sequence[:-1]
    keep = doubt.copy()
    keep[1:] |= doubt[:-1] & same
    keep[:-1] |= doubt[1:] & same
    at = np.flatnonzero(keep)
    if len(at):
        part = np.cumsum(np.r_[True, (np.diff(at) > 1) | (sequence[at[1:]] != sequence[at[:-1]])])
        out[at] = _in_blocks(score[at], part, move)
    return out


def _forward(score: np.ndarray, sequence: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log of the summed weights of all ways to each tag of each word."""
    first, _, active = _runs(score, sequence)
    out = score.astype(np.float64)
    for t in range(1, len(active)):
        at = first[: active[t]] + t
        out[at] += _lse(out[at - 1][:, :, None] + move[None], 1)
    return out


#: Words on each side of a tagged run that its probability is taken over.
CONTEXT = 16
PHONE_BAR = 0.5


def run_probabilities(score: np.ndarray, sequence: np.ndarray, move: np.ndarray, low: np.ndarray, high: np.ndarray, tag: int) -> np.ndarray:
    """Probability that all words low..high-1 have ``tag``, for each run, given
    the words of its sequence up to ``CONTEXT`` before and after it."""
    if len(low) == 0:
        return np.zeros(0)
    fresh = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
    of = np.searchsorted(fresh, low, side="right") - 1
    a, b = np.maximum(fresh[of], low - CONTEXT), np.minimum(np.r_[fresh[1:], len(score)][of], high + CONTEXT)
    size = b - a
    window = np.repeat(np.arange(len(low)), size)
    start = np.r_[0, np.cumsum(size)[:-1]]
    near = score[np.arange(len(window)) - start[window] + a[window]]
    ahead = _forward(near, window, move)
    behind = _forward(near[::-1], window[::-1], move.T)[::-1] - near
    norm = _lse(ahead[start + size - 1], 1)
    along = np.r_[0, np.cumsum(near[:, tag] + move[tag, tag], dtype=np.float64)]
    x, y = start + low - a, start + high - 1 - a
    return np.exp(ahead[x, tag] + along[y + 1] - along[x + 1] + behind[y, tag] - norm)


def _sequences(data: np.ndarray, start: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Sequence number of each word: lines."""
    line = np.concatenate([[0], np.cumsum(data == 10)])[start]
    return np.cumsum(np.r_[True, (row[1:] != row[:-1]) | (line[1:] != line[:-1])]) - 1


def _fits(kind: int, text: str) -> bool:
    """Whether what was tagged has what its kind needs."""
    digits = _only_digits(text)
    if kind == 0:
        return "@" in text or bool(re.search(r"[\[(](?:at|dot)[\])]", text))
    if kind == 1:
        return bool(IP.fullmatch(text)) and _octets(text)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return bool(GROUPED.fullmatch(text.encode())) and len(digits) in LOCAL_DIGITS
    return bool(re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", text))


def tagged_spans(data: np.ndarray, offsets: np.ndarray, emit: np.ndarray, move: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, kind, first byte, byte after the last) of the tagged word runs; of
    those tagged phone, the grouped digits that are likely enough."""
    start, end, row = words(data, offsets)
    if len(start) == 0:
        return []
    sequence = _sequences(data, start, row)
    features = word_features(data, start, end, sequence)
    score = emit[features[:, 0]]
    for f in range(1, FEATURES):
        score += emit[features[:, f]]
    tag = decode(score, sequence, move)
    some = np.flatnonzero(tag > 0)
    if len(some) == 0:
        return []
    breaks = np.flatnonzero(np.r_[True, (np.diff(some) > 1) | (tag[some[1:]] != tag[some[:-1]]) | (sequence[some[1:]] != sequence[some[:-1]])])
    ends = np.r_[breaks[1:], len(some)] - 1
    runs = [(int(row[some[a]]), int(tag[some[a]]) - 1, int(start[some[a]]), int(end[some[b]])) for a, b in zip(breaks, ends)]
    out = [r for r in runs if r[1] != 3]
    phones = [
        (i, kind, a + m.start(), a + m.end())
        for i, kind, a, b in runs if kind == 3
        for m in GROUPED.finditer(data[a:b].tobytes()) if len(re.sub(rb"[^0-9]", b"", m.group())) in LOCAL_DIGITS
    ]
    low = np.searchsorted(end, [a for _, _, a, _ in phones], side="right")
    high = np.searchsorted(start, [b for *_, b in phones], side="left")
    likely = run_probabilities(score, sequence, move, low, high, TAGS.index("phone"))
    return sorted(out + [r for r, p in zip(phones, likely) if p >= PHONE_BAR], key=lambda r: (r[0], r[2]))


def scan(column: pa.Array, emit: np.ndarray, move: np.ndarray) -> tuple[list[list], list[list]]:
    """Known spans and added spans of every text, in code points."""
    known: list[list] = []
    added: list[list] = []
    for _, data, offsets in text_chunks(column):
        hot = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(b"0123456789@", dtype=np.uint8)))])
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        n = len(offsets) - 1
        texts: dict[int, str] = {}

        def text_of(i: int) -> str:
            if i not in texts:
                texts[i] = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            return texts[i]

        base = [known_spans(text_of(i)) if hot[offsets[i + 1]] > hot[offsets[i]] else [] for i in range(n)]
        more: list[list] = [[] for _ in range(n)]
        reach: dict[int, tuple[list[int], list[int]]] = {}
        for i, kind, a, b in tagged_spans(data, offsets, emit, move):
            piece = data[a:b].tobytes().decode(errors="ignore")
            core = piece.strip(".,;:!?|*$%&#\"'")
            if not core or not _fits(kind, core):
                continue
            at = int(points[a] - points[offsets[i]]) + piece.index(core)
            if i not in reach:  # starts of the known spans, and how far those up to each reach
                reach[i] = [s for s, _, _ in base[i]], list(accumulate((e for _, _, e in base[i]), max))
            before = bisect_left(reach[i][0], at + len(core))
            if not before or reach[i][1][before - 1] <= at:
                more[i].append((at, kind, at + len(core)))
        known += base
        added += more
    return known, added


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, known, added) of every row of ``docs``: arrays of (start, kind,
    end), kind being a position in KINDS, sorted.  Added spans never overlap
    known ones.  A null text counts as empty and has no spans; rows that repeat
    an id are scanned on their own.  Other columns are ignored."""
    emit, move = trained()

    @F.arrow_udf("struct<known: array<struct<start: int, kind: int, end: int>>, added: array<struct<start: int, kind: int, end: int>>>")
    def spans(text: pa.Array) -> pa.Array:
        of = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        both = [pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in row] for row in rows], of) for rows in scan(text, emit, move)]
        return pa.StructArray.from_arrays(both, ["known", "added"])

    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", spans(F.col("text")).alias("s"))
    return rows.select("doc_id", F.col("s.known").alias("known"), F.col("s.added").alias("added"))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, joined with commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
