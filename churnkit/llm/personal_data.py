"""Personal data: patterns, and a linear-chain conditional random field over word shapes that adds what patterns miss.

Tokens are runs of letters, runs of digits, and single other characters.  A
token's features are the shapes (letter case, length, digit count, the
character itself, white space before) and known words of the tokens from two
before to two after it; labels are begin, inside (of four kinds) and outside.
Weights are fitted by the exact gradient of the log likelihood over a small
labelled table, on the driver; documents are decoded by Viterbi in numpy, batch by batch,
each by itself.

Where no run of other labels that holds a token can be worth more than being
outside, by the best scores and moves there are, the token is outside on the
best path; such tokens cut a text into short independent parts without
changing that path.

Defined results: null text is empty and has no span; texts are read whole
(long ones in pieces cut at such tokens, which gives the same spans); added
spans must pass a check of their kind and overlap no span found by a pattern;
rows that repeat are answered one by one; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import CHUNK_BYTES, as_bytes, chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: At most so many labelled rows are learnt from.
MAX_LABELLED = 5000

# ---------------------------------------------------------------- patterns
# They say the same as the contract's, without trying again inside a run that has failed, so time stays linear.

LOCAL = "A-Za-z0-9._%+-"
DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
EMAIL = re.compile(rf"(?<![{LOCAL}])[{LOCAL}]++@{DOMAIN}")
EMAIL_HERE = re.compile(rf"[{LOCAL}]++@{DOMAIN}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]")


def digits(text: str) -> str:
    return NOT_DIGIT.sub("", text)


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while at <= len(text):
        # right after a match a run may go on whose first part the match has taken
        m = (at and EMAIL_HERE.match(text, at)) or EMAIL.search(text, at)
        if not m:
            return
        yield m.span()
        at = m.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind and start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            number = digits(m.group())
            if 16 <= len(number) <= 19 and luhn(number):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return out


AT = re.compile(r"\s*[\[({<]?\s*(?:\bat\b|@)\s*[\])}>]?\s*", re.IGNORECASE)
DOT = re.compile(r"\s*[\[({<]?\s*(?:\bdot\b|\.)\s*[\])}>]?\s*", re.IGNORECASE)


def plausible(kind: str, text: str) -> bool:
    """The check that an added span must pass."""
    if kind == "email":
        return bool(EMAIL_HERE.fullmatch(DOT.sub(".", AT.sub("@", text, count=1))))
    number = digits(text)
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and octets(parts)
    if kind == "card":
        return 13 <= len(number) <= 19 and luhn(number)
    return 8 <= len(number) <= 15


# ---------------------------------------------------------------- tokens

SPACE, LETTER, DIGIT, OTHER = range(4)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[9, 11, 12, 13, 32]] = SPACE
CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
CLASS[range(48, 58)] = DIGIT
UPPER = np.zeros(256, np.int32)
UPPER[65:91] = 1
SIZES = np.array([0, 0, 1, 2, 3, 4, 4, 5, 5, 5, 6])  # by length, to 10
#: Shapes: 256 characters, then letters by case and length, then digits by count; the last is the edge of a text.
SHAPES = 2 * (256 + 28 + 22) + 1
EDGE = SHAPES - 1
WINDOW = (-2, -1, 0, 1, 2)
WORD_BYTES = 8


@dataclass
class Tokens:
    start: np.ndarray  # in bytes
    end: np.ndarray
    shape: np.ndarray
    word: np.ndarray  # the folded letters of a word of at most 8 bytes, else 0


def tokenize(buf: np.ndarray) -> Tokens:
    """Tokens of one buffer of bytes."""
    kind = CLASS[buf]
    cut = np.empty(len(buf), bool)
    cut[:1] = True
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == OTHER)
    edge = np.flatnonzero(cut)
    end = np.append(edge[1:], len(buf))
    solid = kind[edge] != SPACE
    start, end = edge[solid], end[solid]
    k, size = kind[start], end - start
    ups = np.concatenate(([0], np.cumsum(UPPER[buf], dtype=np.int32)))
    up = ups[end] - ups[start]
    case = np.where(up == 0, 0, np.where(up == size, 2, np.where((up == 1) & (UPPER[buf[start]] == 1), 1, 3)))
    code = np.where(k == OTHER, buf[start], np.where(k == LETTER, 256 + case * 7 + SIZES[np.minimum(size, 10)],
                                                     284 + np.minimum(size, 21)))
    gap = np.zeros(len(start), np.int64)
    gap[start > 0] = kind[start[start > 0] - 1] == SPACE
    gap[start == 0] = 1
    # eight bytes from every token's start, cut to its size and folded
    padded = np.concatenate((buf, np.zeros(WORD_BYTES, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded[:WORD_BYTES].view(np.uint64), (len(buf) + 1,), (1,))
    few = np.minimum(size, WORD_BYTES).astype(np.uint64)
    word = (eight[start] | np.uint64(0x2020202020202020)) & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * few))
    word[(k != LETTER) | (size > WORD_BYTES)] = 0
    return Tokens(start, end, code * 2 + gap, word)


def join_texts(texts: list[bytes]) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Tokens of many texts, with two edge tokens after each; the bytes; and where each text starts in them."""
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    buf = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    t = tokenize(buf)
    last = np.isin(t.start, at[1:] - 1)  # the separators
    first = np.isin(t.start, at[:-1]) & ~last
    t.shape[first] |= 1
    twice = np.where(last, 2, 1)
    shape = np.where(last, EDGE, t.shape)
    return Tokens(*(np.repeat(x, twice) for x in (t.start, t.end, shape, t.word))), buf, at


# ---------------------------------------------------------------- the field

@dataclass
class Field:
    shapes: np.ndarray  # (window, SHAPES, labels)
    words: np.ndarray  # (window, known words, labels)
    vocabulary: np.ndarray  # sorted codes of the known words
    moves: np.ndarray  # (from, to)

    def word_ids(self, word: np.ndarray) -> np.ndarray:
        """Index of each token's word, or -1."""
        if not len(self.vocabulary):
            return np.full(len(word), -1)
        i = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[i] == word, i, -1)

    def scores(self, t: Tokens) -> np.ndarray:
        """(tokens, labels): beyond both ends stand edges."""
        n = len(t.shape)
        shape = np.concatenate(([EDGE] * 2, t.shape, [EDGE] * 2)).astype(np.int64)
        out = self.shapes[0].take(shape[:n], 0)
        for k in range(1, len(WINDOW)):
            out += self.shapes[k].take(shape[k : k + n], 0)
        ids = self.word_ids(t.word)
        known = np.flatnonzero(ids >= 0)
        for k, off in enumerate(WINDOW):
            here = known - off
            ok = (here >= 0) & (here < n)
            np.add.at(out, here[ok], self.words[k][ids[known[ok]]])
        return out

    def excess(self, scores: np.ndarray) -> np.ndarray:
        """What a token can add at most to a run of other labels than outside, against being outside itself."""
        return (scores[:, 1:].max(1) - scores[:, 0]).astype(np.float64) + (self.moves[1:, 1:].max() - self.moves[0, 0])

    def borders(self) -> dict[tuple[bool, bool], float]:
        """What the two ends of such a run can add at most, by whether the tokens before and after it are outside."""
        m, inner = self.moves, self.moves[1:, 1:].max() - self.moves[0, 0]
        into = (m[:, 1:] - m[:, :1]).max(1)
        out = (m[1:] - m[:1]).max(0)
        return {(a, b): float((into[0] if a else into.max()) + (out[0] if b else out.max()) - inner) for a in (True, False) for b in (True, False)}

    def certain(self, excess: np.ndarray) -> np.ndarray:
        """Tokens that are outside on the best path: no run that holds them is worth anything, not even the best one."""
        total = np.concatenate(([0.0], np.cumsum(excess)))
        left = total[1:] - np.minimum.accumulate(total[:-1])
        right = np.maximum.accumulate(total[:0:-1])[::-1] - total[:-1]
        return left + right - excess + self.borders()[True, True] < -1e-3

    def calm(self, excess: np.ndarray, reach: int = 16) -> np.ndarray:
        """Tokens that are outside whatever stands more than ``reach`` tokens from them."""
        n = len(excess)
        at = np.arange(reach, n - reach)
        total, above = (np.concatenate(([0.0], np.cumsum(x))) for x in (excess, excess > 0))
        left, right = total[at + 1] - total[at - reach], total[at + reach + 1] - total[at]
        end, out = self.borders(), np.zeros(n, bool)
        out[at] = ((above[at + reach + 1] == above[at - reach]) & (excess[at] + end[True, True] < -1e-3) & (left + end[False, True] < -1e-3)
                   & (right + end[True, False] < -1e-3) & (left + right - excess[at] + end[False, False] < -1e-3))
        return out


def viterbi(scores: np.ndarray, moves: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Best labels of all tokens; parts (start, size) stand between tokens known to be outside, all others are outside."""
    label = np.zeros(len(scores), np.int8)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    if not len(start):
        return label
    best = scores[start] + moves[0]
    back = []
    final = np.empty(len(start), np.int64)
    still = np.cumsum(np.bincount(size, minlength=int(size[0]) + 2)[::-1])[::-1]  # parts of at least this size
    for step in range(1, int(size[0]) + 1):
        live, going = still[step], still[step + 1]
        final[going:live] = (best[going:live] + moves[:, 0]).argmax(1)
        if not going:
            break
        through = best[:going, :, None] + moves
        back.append(through.argmax(1).astype(np.int8))
        best = through.max(1) + scores[start[:going] + step]
    y = final
    for step in range(int(size[0]) - 1, -1, -1):
        live = still[step + 1]
        label[start[:live] + step] = y[:live]
        if step:
            y = y.copy()
            y[:live] = back[step - 1][np.arange(live), y[:live]]
    return label


def decode(field: Field, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Labels of all tokens, and what each could add to a run of other labels than outside."""
    scores = field.scores(t)
    excess = field.excess(scores)
    excess[t.shape == EDGE] = -1e6
    doubt = np.concatenate(([0], (~field.certain(excess)).astype(np.int8), [0]))
    turn = np.flatnonzero(doubt[1:] != doubt[:-1])
    return viterbi(scores, field.moves, turn[0::2], turn[1::2] - turn[0::2]), excess


def label_spans(label: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, first token, token after the last): a begin, or an inside after another kind, opens a span."""
    out = []
    some = np.flatnonzero(label)
    for i in some.tolist():
        kind, begins = (int(label[i]) - 1) // 2, label[i] % 2 == 1
        if out and not begins and out[-1][2] == i and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], i + 1)
        else:
            out.append((kind, i, i + 1))
    return out


def byte_spans(field: Field, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """For every text its spans (kind, start, end) in bytes."""
    t, _, at = join_texts(texts)
    label, _ = decode(field, t)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for kind, i, j in label_spans(label):
        row = int(np.searchsorted(at, t.start[i], "right")) - 1
        out[row].append((kind, int(t.start[i] - at[row]), int(t.end[j - 1] - at[row])))
    return out


def long_spans(field: Field, text: bytes, limit: int) -> list[tuple[int, int, int]]:
    """The same of one long text, in pieces that end before a calm token; the next piece sees two tokens before it again."""
    out, s, begin, size = [], 0, 0, limit
    while True:
        piece = text[s : s + size]
        t, buf, _ = join_texts([piece])
        n = len(t.shape) - 2
        label, excess = decode(field, t)
        whole = s + size >= len(text)
        stop = n
        if not whole:
            inner = max(0, n - 3)  # those before the last ones see all their features
            good = np.flatnonzero(field.calm(excess[:inner]) & (t.start[:inner] + s > begin))
            stop = int(good[-1]) if len(good) else 0
            if stop < 3:
                size *= 2
                continue
        for kind, i, j in label_spans(label[:stop]):
            if t.start[i] + s >= begin:
                out.append((kind, int(t.start[i]) + s, int(t.end[j - 1]) + s))
        if whole:
            return out
        begin = int(t.start[stop]) + s
        back = int(t.start[stop - 2])
        s += back - (1 if back and CLASS[buf[back - 1]] == SPACE else 0)
        size = limit


# ---------------------------------------------------------------- training

def _pad(field_words: np.ndarray, rows: list[Tokens], labels: list[np.ndarray]):
    """Features of all sentences, padded: shapes and words (sentences, length + 4), labels, mask."""
    n, width = len(rows), max(len(r.shape) for r in rows)
    shape = np.full((n, width + 4), EDGE)
    word = np.full((n, width + 4), -1)
    y = np.zeros((n, width), np.int64)
    mask = np.zeros((n, width), bool)
    probe = Field(np.empty(0), np.empty(0), field_words, np.empty(0))
    for i, (r, lab) in enumerate(zip(rows, labels)):
        m = len(r.shape)
        shape[i, 2 : m + 2], word[i, 2 : m + 2], y[i, :m], mask[i, :m] = r.shape, probe.word_ids(r.word), lab, True
    return shape, word, y, mask


class _Sums:
    """Sums of rows by an index that stays."""

    def __init__(self, index: np.ndarray):
        self.order = np.argsort(index, kind="stable")
        self.where, self.first = np.unique(index[self.order], return_index=True)

    def add(self, out: np.ndarray, rows: np.ndarray) -> None:
        out[self.where] += np.add.reduceat(rows[self.order], self.first, 0)


def fit_field(texts: list[str], spans: list[list[tuple[str, int, int]]], rounds: int = 120, l2: float = 0.02, rate: float = 0.15) -> Field:
    """Log likelihood and its exact gradient by forward and backward sums, steps by Adam."""
    rows, labels = [], []
    for text, mine in zip(texts, spans):
        t = tokenize(np.frombuffer(text.encode(), np.uint8))
        at = np.cumsum([0] + [len(c.encode()) for c in text])
        y = np.zeros(len(t.start), np.int64)
        for kind, a, b in mine:
            inside = np.flatnonzero((t.start >= at[a]) & (t.end <= at[b]))
            y[inside] = 2 + 2 * KINDS.index(kind)
            y[inside[:1]] -= 1
        if len(y):
            rows.append(t)
            labels.append(y)
    codes, counts = np.unique(np.concatenate([r.word for r in rows]), return_counts=True)
    vocabulary = codes[(counts >= 3) & (codes > 0)]
    shape, word, y, mask = _pad(vocabulary, rows, labels)
    n, width = y.shape
    w = len(WINDOW)
    theta = [np.zeros((w, SHAPES, LABELS)), np.zeros((w, len(vocabulary) + 1, LABELS)), np.zeros((LABELS, LABELS))]
    m1, m2 = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    rows_i = np.arange(n)[:, None]
    truth = np.zeros((n, width, LABELS))
    truth[rows_i, np.arange(width), y] = 1
    truth *= mask[..., None]
    size = mask.sum(1)
    # sentences stand between outside tokens: the moves from and to them count
    pairs = np.zeros((LABELS, LABELS))
    for lab in labels:
        path = np.concatenate(([0], lab, [0]))
        np.add.at(pairs, (path[:-1], path[1:]), 1)
    flat = mask.ravel()
    index = [[x[:, k : k + width].ravel()[flat] for k in range(w)] for x in (shape, word)]
    sums = [[_Sums(x) for x in xs] for xs in index]
    e = np.zeros((n * width, LABELS))
    a, b, scale = np.empty((width, n, LABELS)), np.empty((width, n, LABELS)), np.ones((width, n, 1))
    for it in range(1, rounds + 1):
        S, Wd, M = theta
        e[flat] = sum(S[k][index[0][k]] + Wd[k][index[1][k]] for k in range(w))
        E = np.exp(e - e.max(1, keepdims=True)).reshape(n, width, LABELS)
        A = np.exp(M)
        for i in range(width):  # scaled forward sums; padding repeats the last one
            step = (a[i - 1] @ A if i else A[0]) * E[:, i]
            on = mask[:, i, None]
            scale[i] = np.where(on, step.sum(1, keepdims=True), 1)
            a[i] = np.where(on, step / scale[i], a[i - 1])
        b[-1] = A[:, 0] / (a[-1] @ A[:, 0])[:, None]
        p_pair = np.zeros((LABELS, LABELS))
        for i in range(width - 1, 0, -1):
            right = np.where(mask[:, i, None], E[:, i] * b[i] / scale[i], 0)
            p_pair += a[i - 1].T @ right * A
            b[i - 1] = np.where(mask[:, i, None], right @ A.T, b[i])
        p = (a * b).transpose(1, 0, 2) * mask[..., None]
        p_pair[0] += p[:, 0].sum(0)
        p_pair[:, 0] += p[np.arange(n), size - 1].sum(0)
        gap = (p - truth).reshape(-1, LABELS)[flat]
        grads = [np.zeros_like(x) for x in theta]
        for k in range(w):
            sums[0][k].add(grads[0][k], gap)
            sums[1][k].add(grads[1][k], gap)
        grads[1][:, -1] = 0  # unknown words have no weight
        grads[2] = p_pair - pairs
        for x, g, u, v in zip(theta, grads, m1, m2):
            g = g / n + l2 * x / n
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            x -= rate * (u / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-6)
    S, Wd, M = (x.astype(np.float32) for x in theta)
    return Field(S, Wd[:, :-1], vocabulary, M)


# ---------------------------------------------------------------- the labelled table

#: Sentences of the labelled table: a slot is replaced by a made value; values of the four kinds are labelled.
SENTENCES = """write to {email} today|mail: {email}|mail {email} now|{name}, {email}|email {email} or call {phone}|{email}|contact {email} or {phone}|my address is {email}.|({email})
call {phone} now|phone {phone}|tel. {phone}, ask for {name}|{phone}|mobile: {phone}.|fax {phone} / tel {phone}|{name} ({phone})
card {card} expired|visa {card}|pay with {card} please|{card}|card number: {card}, valid 12/27
login from {ip}|server {ip} down|host {ip}:8080|{ip}|address {ip}.|from {ip} to {ip}
{name} is at home|see page {small} at the end|the dot is small|{name} met {name} at {name}|{prose}|{prose}. {prose}
order {long} shipped|id {long}|{long}|invoice {small}-{small}|token = "{hex}"|version {small}.{small}.{small}|on {date} at {time}
{prose} {email} {prose}|{prose} {phone} {prose}|{prose} {card} {prose}|{prose} {ip} {prose}|{prose} {long} {prose}|{prose} {small} {prose}
{small} {small} {small} {small}|price {small}.{small} or {small}, {small}|{date} {time} {prose}|{prose} | {prose} | {long} | {prose}
{prose} {date}. {prose}|({small}) {prose}|{small}. {prose}|{prose} at {time}, {prose}|{small}-{small} {prose}|{prose}: {hex}
{year}-{year}|{junk}|{junk}|{prose} {junk}|{junk} {small} {junk}|{caps}|{caps} {long}|{prose}{mark} {email} {mark}{prose}|{mark}{card}{mark}|{small} {long} {small}|room {small} at {name}|{prose} at {prose}|{name} at {name}. {name} dot|@{name} {prose}""".replace("\n", "|").split("|")


def _value(r: random.Random, slot: str) -> str:
    def word(lo: int = 2, hi: int = 9) -> str:
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyzéüñ" if r.random() < 0.3 else "etaoinshrdlu") for _ in range(r.randint(lo, hi)))

    def plain(lo: int = 2, hi: int = 8) -> str:
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(lo, hi)))

    def number(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    if slot == "email":
        at = r.choice(("@", "@", " @ ", " at ", " (at) ", " [at] ", "[at]", "(at)", "{at}", " AT ", " <at> "))
        dot = r.choice((".", " . ", " dot ", " [dot] ", "[dot]", "(dot)", " (dot) ", " DOT ")) if at != "@" or r.random() < 0.2 else "."
        local = [plain() + (number(2) if r.random() < 0.3 else "") for _ in range(r.choice((1, 1, 2)))]
        sep = dot if "dot" in dot.lower() else r.choice((".", "_", "-"))
        host = [plain(3, 8) + (number(1) if r.random() < 0.2 else "") for _ in range(r.choice((1, 1, 2)))]
        return sep.join(local) + at + dot.join([*host, r.choice(("com", "org", "net", "de", "es", "fr", "io", "edu"))])
    if slot == "ip":
        sep = r.choice((".", ".", ".", "[.]", " . ", "(.)", " dot "))
        return sep.join(str(r.randint(0, 255)) for _ in range(4))
    if slot == "card":
        sizes = r.choice(((4, 4, 4, 4), (4, 4, 4, 4), (4, 6, 5), (16,)))
        n = number(sum(sizes) - 1)
        n = next(n + d for d in "0123456789" if luhn(n + d))
        sep, out = r.choice((" ", "-", ".", "  ", " - ", "/", "_")), []
        for s in sizes:
            out.append(n[:s])
            n = n[s:]
        return sep.join(out)
    if slot == "phone":
        a, b, c = number(3), number(3), number(4)
        return r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 ({a}) {b}-{c}", f"+{number(2)} {a} {b}{c}", f"({a}){b}-{c}",
                         f"1-{a}-{b}-{c}", f"00{number(2)} {a} {b} {c}", f"+1-{a}-{b}-{c}", f"001 ({a}) {b}-{c}"))
    return {"name": lambda: word().capitalize(), "small": lambda: number(r.randint(1, 4)).lstrip("0") or "0", "long": lambda: number(r.randint(5, 22)),
            "hex": lambda: "".join(r.choice("0123456789abcdef") for _ in range(40)),
            "date": lambda: r.choice((f"20{number(2)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{number(2)}",
                                      f"{r.randint(1, 12)}/{r.randint(1, 28)}/{number(2)}")),
            "mark": lambda: r.choice("!#$%&'*/:;=?^_`|~,\\\"<>[]{}") * r.randint(1, 3),
            "junk": lambda: " ".join(word() + r.choice("!#$%&'*+,-./:;<=>?@[\\]^_`{|}~()\"") * r.randint(1, 4) for _ in range(r.randint(2, 9))),
            "caps": lambda: " ".join(word().upper() if r.random() < 0.7 else word() + word().capitalize() for _ in range(r.randint(2, 7))),
            "time": lambda: f"{r.randint(0, 23)}:{r.randint(10, 59)}", "year": lambda: f"{r.choice((19, 20))}{number(2)}",
            "prose": lambda: " ".join(w.capitalize() if r.random() < 0.15 else w for w in (word() for _ in range(r.randint(2, 7))))}[slot]()


def sentences(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled sentences: text and spans (kind, start, end)."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        text, spans = "", []
        for piece in re.split(r"(\{[a-z]+\})", SENTENCES[i % len(SENTENCES)]):
            slot = piece[1:-1]
            if not piece.startswith("{"):
                text += piece
                continue
            value = _value(r, slot)
            if slot in KINDS:
                spans.append((slot, len(text), len(text) + len(value)))
            text += value
        out.append((text, spans))
    return out


def labelled_table(spark: SparkSession, n: int = 1500, seed: int = 17) -> DataFrame:
    return spark.createDataFrame(sentences(n, seed), "text string, spans array<struct<kind: string, start: int, end: int>>")


def fit(labelled: DataFrame, limit: int = MAX_LABELLED) -> Field:
    """The field of a labelled table; of larger tables the ``limit`` rows of the smallest text hashes are learnt from."""
    rows = labelled.where("text IS NOT NULL").orderBy(F.xxhash64("text"), "text").limit(limit).collect()
    return fit_field([r.text for r in rows], [[tuple(s) for s in r.spans or []] for r in rows])


# ---------------------------------------------------------------- documents

def _write(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def added_spans(text: str, raw: bytes, found: list[tuple[int, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Decoded spans that pass their check and overlap none of the patterns', in code points."""
    out = []
    for kind, a, b in found:
        start = a if len(raw) == len(text) else len(raw[:a].decode())
        end = start + len(raw[a:b].decode())
        if all(end <= x or y <= start for _, x, y in base) and plausible(KINDS[kind], text[start:end]):
            out.append((KINDS[kind], start, end))
    return out


def find(documents: DataFrame, field: Field, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` of every row of ``documents(doc_id, text)``.

    Counts and ``base_sha256`` are of the patterns' spans, ``spans`` are all.  One scan, no shuffle; the field is a
    few hundred kilobytes in every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = as_bytes(b["text"])
            found: list[list[tuple[int, int, int]]] = []
            for i, j in chunks(raws, chunk_bytes):
                if j == i + 1 and len(raws[i]) > chunk_bytes:
                    found.append(long_spans(field, raws[i], chunk_bytes))
                else:
                    found += byte_spans(field, raws[i:j])
            rows = []
            for raw, mine in zip(raws, found):
                text = raw.decode()
                base = base_spans(text)
                more = added_spans(text, raw, mine, base) if mine else []
                count = [sum(s[0] == k for s in base) for k in KINDS]
                everything = sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                rows.append((*count, hashlib.sha256(_write(base).encode()).hexdigest(), _write(everything), len(more)))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([b["doc_id"], *map(pa.array, cols)],
                                                 names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")
