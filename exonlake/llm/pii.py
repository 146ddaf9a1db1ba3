"""Personal data: pattern spans, and more by a linear-chain conditional random field over word shapes.

``base_spans`` holds the four patterns.  The field is trained from a labelled table
of at most ``LABELLED_ROWS`` snippets around numbers and signs in the documents: their
labels are the patterns' spans, long values that a setting of a telling name is given
(secrets, a kind of its own, which no pattern has), and those of cases written into some
of them, in forms that no pattern takes: a phone without its country code or with another
number behind it, an e-mail with its signs spelled out, secrets, and numbers and digests
that are none of these.  Beside shapes, a word has the kind of the word it follows: the
name of a secret, of a digest, of a phone, of a place in a list.  Decoding is Viterbi over all stretches of a
numpy batch at once.  A stretch is the words within ``REACH`` of one with a digit, ``@``,
``+`` or a bracket; words farther off are outside by definition, as every form above has
one of these, so long texts cost what they hold.

Defined cases: null or empty text has no spans; the base spans of a kind do not
overlap, those of two kinds may; an added span never overlaps a base span, and what
shapes can't tell is checked: Luhn of cards, ranges of addresses, digits of phones,
length of secrets; spans to redact that overlap go as one, by the first one's kind;
repeated rows are each reported; an empty table gives an empty result, and without
labelled snippets only the base spans are reported; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textops as tx
from .sampling import thinned

#: Documents that snippets are taken from, about, and snippets, at most.
SAMPLE_DOCS, LABELLED_ROWS = 6000, 3000
REACH = 3
#: Kinds that the patterns have, and those that the field has.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_SPELLED_AT = re.compile(r"[\[(]at[\])]", re.I)
_EDGE = ".,;:!?\"'<>#$%&*|="


def _luhn(digits: str) -> bool:
    own = [int(c) for c in reversed(digits)]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind; leftmost and without overlap in each kind."""
    found = []
    at, last = text.find("@"), 0
    while at >= 0:  # an address is its whole run of local characters, an @ and a domain
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 60 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def as_string(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# --- word shapes

_DIGIT, _LETTER, _HIGH, _AT, _DOT, _DASH, _PLUS, _ROUND, _SQUARE, _QUOTE = (np.zeros(256, bool) for _ in range(10))
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = True
_HIGH[128:] = True
for _mask, _signs in ((_AT, "@"), (_DOT, "."), (_DASH, "-"), (_PLUS, "+"), (_ROUND, "()"), (_SQUARE, "[]"), (_QUOTE, "\"'=")):
    _mask[[ord(c) for c in _signs]] = True
_TRIGGER = _DIGIT | _AT | _PLUS | _ROUND | _SQUARE
_BUCKETS = np.array([1, 2, 4, 5, 7, 10, 13, 14, 17, 20])
_JOINT = 11 * 5 * 2**7
#: Names of settings that hold secrets, of digests and ids, of phones, and of places in lists.
SECRET_NAMES = ("token", "api_key", "apikey", "secret", "password", "passwd", "access_key", "auth", "key", "bearer")
CUES = (SECRET_NAMES, ("commit", "md5", "sha1", "sha256", "sha512", "uuid", "guid", "etag", "checksum", "digest", "hash", "revision", "rev", "blob", "tree", "id", "ipv6", "mac"), ("tel", "phone", "call", "fax", "mobile", "cell", "telefon", "tel\u00e9fono"), ("page", "pages", "isbn", "issn", "order", "invoice", "part", "item", "model", "no", "number", "ref", "version", "lines", "vol"))


def _cue_table() -> tuple[np.ndarray, np.ndarray]:
    """(hash, kind from 1) of the names, by hash."""
    names = [(w.encode(), k + 1) for k, words in enumerate(CUES) for w in words]
    size = np.array([len(w) for w, _ in names])
    end = np.cumsum(size)
    own = tx.span_hash(np.frombuffer(b"".join(w for w, _ in names), np.uint8), end - size, end)
    order = np.argsort(own)
    return own[order], np.array([k for _, k in names])[order]


_CUE_HASHES, _CUE_KINDS = _cue_table()
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "=:\"'.,;#$%&*|<>()[]{}!?-"]] = True
#: Features of a word: its joint shape, that of both neighbours, size, digits with sign, a few marks, and the kind of the word it follows.
N_FEATURES = 3 * _JOINT + 12 + 11 * 8 + 2 * 2 + 2 * (len(CUES) + 1)


def cues(data: np.ndarray, start: np.ndarray, end: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each word the kind, from 1, of the known name that it follows, with only signs between; 0 if there is none."""
    past = end.copy()
    for _ in range(3):
        past -= (past > start) & _SIGN[data[np.maximum(past - 1, 0)]]
    first = start + ((past > start) & _SIGN[data[start]])
    own = tx.span_hash(_LOWERED[data], first, np.maximum(first, past))
    at = np.minimum(np.searchsorted(_CUE_HASHES, own), len(_CUE_HASHES) - 1)
    kind = np.where(_CUE_HASHES[at] == own, _CUE_KINDS[at], 0)
    out = np.zeros(len(start), np.int64)
    if len(start) > 1:
        near = rows[1:] == rows[:-1]
        out[1:] = np.where(near, kind[:-1], 0)
        sign = past <= start
        out[2:] = np.where(near[1:] & near[:-1] & sign[1:-1], kind[:-2], out[2:])
    return out


def shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each word without its neighbours' (n x 5, the first the joint shape), and whether it is a trigger."""
    count = lambda mask: (lambda c: c[end] - c[start])(np.concatenate([[0], np.cumsum(mask[data])]))
    digits, letters, dots = count(_DIGIT), count(_LETTER | _HIGH), np.minimum(count(_DOT), 4)
    flags = [count(m) > 0 for m in (_AT, _DASH, _PLUS, _ROUND, _SQUARE, _QUOTE)]
    bucket = np.searchsorted(_BUCKETS, digits, "right")
    joint = (bucket * 5 + dots) * 128 + (letters > 0) * 64 + sum(f * (32 >> k) for k, f in enumerate(flags))
    size = np.minimum(np.searchsorted([2, 3, 4, 6, 8, 11, 14, 16, 19, 24, 40], end - start), 11)
    first, last = data[start], data[end - 1]
    sign = bucket * 8 + _DIGIT[first] * 4 + _DIGIT[last] * 2 + (digits == end - start)
    follows = 2 * cues(data, start, end, rows) + ((digits > 0) & (end - start >= 16))
    code = np.stack([joint, 3 * _JOINT + size, 3 * _JOINT + 12 + sign, 3 * _JOINT + 12 + 88 + 2 * _DOT[last] + (letters == end - start), 3 * _JOINT + 12 + 88 + 4 + follows], axis=1)
    return code, (digits > 0) | flags[0] | flags[2] | flags[3] | flags[4]


def stretches(rows: np.ndarray, trigger: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last word of every stretch, none across rows."""
    n = len(rows)
    near = np.zeros(n, bool)
    hit = np.flatnonzero(trigger)
    for k in range(-REACH, REACH + 1):
        at = hit + k
        ok = (at >= 0) & (at < n)
        at, of = at[ok], hit[ok]
        near[at[rows[at] == rows[of]]] = True
    before = np.concatenate([[False], near[:-1] & (rows[1:] == rows[:-1])]) if n else near
    after = np.concatenate([near[1:] & (rows[1:] == rows[:-1]), [False]]) if n else near
    return np.flatnonzero(near & ~before), np.flatnonzero(near & ~after) + 1


def padded(code: np.ndarray, first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features (stretch, place, 7) with the neighbours' shapes, and which places are words; unused features are N_FEATURES."""
    width = int((past - first).max())
    at = first[:, None] + np.arange(width)
    real = at < past[:, None]
    own = np.where(real[..., None], code[np.minimum(at, len(code) - 1)], N_FEATURES)
    sides = np.full((*at.shape, 2), N_FEATURES, np.int64)
    sides[:, 1:, 0] = np.where(real[:, 1:], own[:, :-1, 0] + _JOINT, N_FEATURES)
    sides[:, :-1, 1] = np.where(real[:, 1:], own[:, 1:, 0] + 2 * _JOINT, N_FEATURES)
    return np.concatenate([own, sides], axis=2), real


@dataclass
class Field:
    """Scores of features by label, of steps between labels, and of beginning and ending in a label."""

    weight: np.ndarray
    step: np.ndarray
    edge: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.weight[features].sum(axis=2)

    def viterbi(self, features: np.ndarray, real: np.ndarray) -> np.ndarray:
        """The best labels of each stretch; 0 at places that are no words."""
        e = self.scores(features)
        n, width, _ = e.shape
        best, back = e[:, 0] + self.edge[0], np.zeros((n, width, len(LABELS)), np.int8)
        for t in range(1, width):
            through = best[:, :, None] + self.step
            back[:, t] = through.argmax(axis=1)
            on = through.max(axis=1) + e[:, t]
            back[~real[:, t], t] = np.arange(len(LABELS))
            best = np.where(real[:, t, None], on, best)
        out = np.zeros((n, width), np.int64)
        label = (best + self.edge[1]).argmax(axis=1)
        for t in range(width - 1, -1, -1):
            out[:, t] = np.where(real[:, t], label, 0)
            label = back[np.arange(n), t, label] if t else label
        return out


def _allowed() -> np.ndarray:
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            ok[i, j] = b[0] != "I" or a[2:] == b[2:]
    return ok


def train(features: np.ndarray, real: np.ndarray, labels: np.ndarray, rounds: int = 80, rate: float = 0.1, l2: float = 2e-4) -> Field:
    """Full-batch Adam on the conditional log-likelihood, gradients by forward-backward."""
    k, (n, width) = len(LABELS), real.shape
    barred = np.where(_allowed(), 0.0, -1e4)
    barred_edge = np.array([[-1e4 if name[0] == "I" else 0.0 for name in LABELS], [0.0] * k])
    params = [np.zeros((N_FEATURES + 1, k)), np.zeros((k, k)), np.zeros((2, k))]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    length, rows = real.sum(axis=1), np.arange(n)
    gold = np.eye(k)[labels] * real[..., None]
    gold_step = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    gold_edge = np.stack([gold[:, 0].sum(axis=0), gold[rows, length - 1].sum(axis=0)])
    lse = lambda x, axis: (lambda m: m.squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis)))(x.max(axis=axis, keepdims=True))
    for it in range(1, rounds + 1):
        w, step, edge = params[0], params[1] + barred, params[2] + barred_edge
        e = w[features].sum(axis=2)
        alpha, beta = np.zeros((n, width, k)), np.zeros((n, width, k))
        alpha[:, 0] = e[:, 0] + edge[0]
        for t in range(1, width):
            alpha[:, t] = np.where(real[:, t, None], lse(alpha[:, t - 1, :, None] + step, 1) + e[:, t], alpha[:, t - 1])
        z = lse(alpha[:, -1] + edge[1], 1)
        beta[:, -1] = edge[1]
        for t in range(width - 2, -1, -1):
            beta[:, t] = np.where(real[:, t + 1, None], lse(step + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2), beta[:, t + 1])
        p = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        pair = np.zeros((k, k))
        for t in range(1, width):
            x = alpha[:, t - 1, :, None] + step + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            pair += np.exp(x)[real[:, t]].sum(axis=0)
        grad_w = np.zeros_like(w)
        diff = (p - gold).reshape(-1, k)
        for f in range(features.shape[2]):
            for c in range(k):
                grad_w[:, c] += np.bincount(features[..., f].ravel(), diff[:, c], N_FEATURES + 1)
        grads = [grad_w, pair - gold_step, np.stack([p[:, 0].sum(axis=0), p[rows, length - 1].sum(axis=0)]) - gold_edge]
        for i, (param, g) in enumerate(zip(params, grads, strict=True)):
            g = g / n + l2 * param
            m, v = moment[i]
            m[...] = 0.9 * m + 0.1 * g
            v[...] = 0.99 * v + 0.01 * g * g
            param -= rate * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
        params[0][-1] = 0
    return Field(params[0], params[1] + barred, params[2] + barred_edge)


# --- the labelled table

_SETTING = re.compile(r"(?i)(?<![a-z0-9])(?:" + "|".join(SECRET_NAMES) + r")[\x20]?[=:][\x20]?[\"']?((?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{16,})")


def _labels(text: str) -> list[tuple[int, int, int]]:
    """The patterns' spans, and the long values of settings of telling names."""
    base = base_spans(text)
    more = [(m.start(1), len(BASE_KINDS), m.end(1)) for m in _SETTING.finditer(text)]
    return sorted([*base, *(x for x in more if all(x[2] <= s or x[0] >= e for s, _, e in base))])


def labelled_table(docs: DataFrame, rows: int = LABELLED_ROWS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(snippet, spans): surroundings of numbers and signs in about ``sample_docs`` documents by hash of doc_id, at most ``rows`` of them.

    The labels are the patterns' spans, and those of what is written into some snippets: personal
    data in forms that no pattern takes, secrets, and numbers that are none of these.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[str, str]] = []
            for text in batch["text"]:
                words = list(_WORD.finditer(text))
                hits = [k for k, w in enumerate(words) if re.search(r"[0-9@+()\[\]]", w[0])]
                hits = hits[:: max(1, len(hits) // 6)] or ([len(words) // 2] if words else [])
                done = -1
                for k in hits:
                    if k <= done:
                        continue
                    low, done = max(0, k - 6), min(len(words), k + 9) - 1
                    snippet = text[words[low].start() : words[done].end()]
                    out.append((snippet, as_string(_labels(snippet))))
                    out += _rewritten(snippet)
            yield pd.DataFrame(out, columns=["snippet", "spans"])

    some = thinned(docs.select("doc_id", "text").where("text is not null"), "doc_id", sample_docs).select("text")
    return some.mapInPandas(run, "snippet string, spans string").distinct().orderBy(F.xxhash64("snippet", "spans"), "snippet", "spans").limit(rows)


def written_forms(rng: np.random.Generator) -> list[tuple[str, int | None]]:
    """Words in a row with the kind of each, None for what is no personal data: one case in one of many forms."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    name = lambda low, high: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(low, high))))
    address = lambda: ".".join(str(int(x)) for x in rng.integers(0, 256, 4))
    area, mid, last = f"{int(rng.integers(200, 1000))}", digits(3), digits(4)

    def card() -> str:
        own = pick("3456") + digits(14)
        own += next(c for c in "0123456789" if _luhn(own + c))
        return own if rng.random() < 0.5 else pick(" -").join(own[k : k + 4] for k in range(0, 16, 4))

    hexes = lambda n: "".join("0123456789abcdef"[int(k)] for k in rng.integers(0, 16, n))
    local = pick((f"0{digits(2)}-{digits(6)}", f"00{int(rng.integers(10, 99))} {digits(2)} {digits(6)}", f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area} {mid} {last}", f"{area}.{mid}.{last}", f"({area}) {mid} {last}"))
    after = [(pick((address(), digits(5), f"{digits(2)}.{digits(2)}")), None)] if rng.random() < 0.8 else []
    if after and after[0][0].count(".") == 3:
        after = [(after[0][0], 1)]
    case = int(rng.integers(8))
    if case == 0:
        return [(local, 3)]
    if case == 1:  # the pattern runs on into the next number
        return [(f"+{int(rng.integers(1, 99))} {local}", 3), *after]
    if case == 2:
        return [(card(), 2), *after]
    if case == 3:
        at, dot = pick(((" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", "."), ("(at)", "."), ("[at]", ".")))
        return [(f"{name(3, 9)}{dot if rng.random() < 0.3 else ''}{name(2, 8)}{at}{name(3, 9)}{dot}{pick(('com', 'org', 'net', 'de'))}", 0)]
    if case == 4:
        alphabet = pick(("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789_"))
        value = pick(("", "", "sk-", "ghp_", "AKIA")) + "".join(alphabet[int(k)] for k in rng.integers(0, len(alphabet), int(rng.integers(20, 48)))) + digits(2)
        return [(pick(SECRET_NAMES) + pick((" =", " =", ":", "")), None), (pick(('"{}"', '"{}"', "'{}'", "{}")).format(value), 4)]
    if case == 5:  # digests and ids, which are nobody's
        own = pick((hexes(40), hexes(32), hexes(64), hexes(40).upper(), f"{hexes(8)}-{hexes(4)}-4{hexes(3)}-a{hexes(3)}-{hexes(12)}", ":".join(hexes(4) for _ in range(8)), f"2001:db8::{hexes(4)}:{hexes(4)}", f"sha256:{hexes(64)}"))
        before = pick(("", "", *(w + s for w in CUES[1] for s in ("", " =", ":"))))
        return [*([(before, None)] if before else []), (pick(("{}", "{}", '"{}"', "({})")).format(own), None)]
    if case == 6 and rng.random() < 0.3:
        return [(pick(CUES[3]), None), (pick((f"{area}-{mid}-{last}", f"{digits(3)}-{digits(4)}", digits(10))), None)]
    number = digits(15) + pick("0123456789")
    if _luhn(number):
        number = number[:-1] + str((int(number[-1]) + 1) % 10)
    # none of these is personal data
    return [(pick((number, f"version {digits(1)}.{digits(1)}", f"{int(rng.integers(1900, 2100))}-{digits(2)}-{digits(2)}", f"{digits(2)}.{digits(2)}", digits(5), f"{digits(3)}.{digits(3)}.{digits(3)}.{int(rng.integers(256, 999))}", name(12, 30) + digits(1), f"ISO {digits(4)}:{digits(4)}", f"[{digits(2)}]")), None)]


def _rewritten(snippet: str, times: int = 2) -> list[tuple[str, str]]:
    """The snippet with cases written in after one of its words, drawn by its hash, and all its spans."""
    rng = np.random.Generator(np.random.PCG64(zlib.crc32(snippet.encode())))
    words, out = list(_WORD.finditer(snippet)), []
    for _ in range(times):
        at = words[int(rng.integers(len(words)))].end() if words else 0
        text, spans = snippet[:at], _labels(snippet[:at])
        for form, kind in written_forms(rng):
            text += " "
            if kind is not None:
                spans.append((len(text), kind, len(text) + len(form)))
            text += form
        text += " "
        spans += [(s + len(text), k, e + len(text)) for s, k, e in _labels(snippet[at:])]
        out.append((text + snippet[at:], as_string(spans)))
    return out


def _tokens(column: pa.Array) -> tuple:
    data, offsets = tx.flat(column)
    start, end, row = tx.word_bounds(data, offsets)
    return data, offsets, start, end, row, *shapes(data, start, end, row)


def fit_field(docs: DataFrame, rows: int = LABELLED_ROWS) -> Field | None:
    """The field trained on the labelled table; None if that is empty."""
    table = labelled_table(docs, rows).toPandas().sort_values(["snippet", "spans"])
    if not len(table):
        return None
    data, offsets, start, end, row, code, trigger = _tokens(pa.array(table["snippet"].tolist(), pa.large_string()))
    points = np.concatenate([[0], np.cumsum(tx.code_points(data))])
    labels = np.zeros(len(start), np.int64)
    bounds = np.searchsorted(row, np.arange(len(table) + 1))
    for r, spans in enumerate(table["spans"]):
        s, e = (points[x[bounds[r] : bounds[r + 1]]] - points[offsets[r]] for x in (start, end))
        for span in filter(None, spans.split(",")):
            kind, a, b = span.split(":")
            inside = np.flatnonzero((s < int(b)) & (e > int(a))) + bounds[r]
            if len(inside) and not labels[inside].any():
                labels[inside] = 2 + 2 * KINDS.index(kind)
                labels[inside[0]] -= 1
    first, past = stretches(row, trigger)
    if not len(first):
        return None
    features, real = padded(code, first, past)
    at = np.minimum(first[:, None] + np.arange(real.shape[1]), len(labels) - 1)
    return train(features, real, np.where(real, labels[at], 0))


def _sound(kind: int, body: str) -> bool:
    """What shapes can't tell of a span: checksums, ranges and lengths."""
    digits = _NOT_DIGIT.sub("", body)
    if kind == 0:
        return "@" in body or bool(_SPELLED_AT.search(body))
    if kind == 1:
        parts = body.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and _luhn(digits)
    if kind == 3:
        return 7 <= len(digits) <= 15 and not any(map(str.isalpha, body))
    return len(body) >= 16 and bool(digits) and any(map(str.isalpha, body)) and " " not in body


def _added(column: pa.Array, field: Field) -> dict[int, list[tuple[int, int, int]]]:
    """Spans of the field by row, in code points."""
    data, offsets, start, end, row, code, trigger = _tokens(column)
    first, past = stretches(row, trigger)
    out: dict[int, list[tuple[int, int, int]]] = {}
    if not len(first):
        return out
    points = np.concatenate([[0], np.cumsum(tx.code_points(data))])
    size = past - first
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):  # stretches of like size together, so that padding stays small
        take = order[at : at + max(1, 60_000 // int(size[order[min(at + 2000, len(order) - 1)]]))][:2000]
        at += len(take)
        features, real = padded(code, first[take], past[take])
        labels = field.viterbi(features, real)
        for i in np.flatnonzero(labels.any(axis=1)):
            own, w0, k = labels[i], int(first[take[i]]), 0
            while k < len(own):
                if not own[k]:
                    k += 1
                    continue
                to = k + 1
                while to < len(own) and own[to] == (own[k] + 1 if own[k] % 2 else own[k]):
                    to += 1
                a, b, r = start[w0 + k], end[w0 + to - 1], int(row[w0 + k])
                text = data[a:b].tobytes().decode()
                lead, tail = len(text) - len(text.lstrip(_EDGE)), len(text) - len(text.rstrip(_EDGE))
                kind, body = int(own[k] - 1) // 2, text[lead : len(text) - tail]
                if body and _sound(kind, body):
                    s = int(points[a] - points[offsets[r]]) + lead
                    out.setdefault(r, []).append((s, kind, s + len(body)))
                k = to
    return out


def find_pii(docs: DataFrame, field: Field | None, keep_columns: list[str] | None = None, redact: bool = False) -> DataFrame:
    """keep_columns (doc_id), the counts of base spans, and all spans and their number, of every document; with redact its text too, each span replaced by its kind in brackets."""
    keep = keep_columns if keep_columns is not None else ["doc_id"]
    counts = [f"n_{k}" for k in BASE_KINDS]
    names = [*counts, "base_sha256", "spans", "n_spans", *["redacted"] * redact]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} long" for c in counts), "base_sha256 string, spans string, n_spans long", *["redacted string"] * redact])
    empty = hashlib.sha256(b"").hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            column, n = batch.column("text"), batch.num_rows
            data, offsets = tx.flat(column)
            marked = np.flatnonzero(tx.rows_sum(_TRIGGER[data], offsets))
            number, digest, spans, found = np.zeros((len(BASE_KINDS), n), np.int64), [empty] * n, [""] * n, np.zeros(n, np.int64)
            own = column.take(pa.array(marked))
            texts = own.to_pylist()
            added = _added(own, shared.value) if shared.value is not None and len(marked) else {}
            new = column.to_pylist() if redact else []
            for i, (r, text) in enumerate(zip(marked, texts, strict=True)):
                base = base_spans(text)
                for _, kind, _ in base:
                    number[kind, r] += 1
                more = [x for x in added.get(i, ()) if all(x[2] <= s or x[0] >= e for s, _, e in base)]
                spans[r], found[r] = as_string(sorted([*base, *more])), len(base) + len(more)
                if base:
                    digest[r] = hashlib.sha256(as_string(base).encode()).hexdigest()
                if redact:
                    new[r] = _redacted(text, [*base, *more])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, number), pa.array(digest), pa.array(spans), pa.array(found), *[pa.array(new, pa.string())] * redact], names=[*keep, *names])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start < at:  # overlaps the one before
            at = max(at, end)
            continue
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])
