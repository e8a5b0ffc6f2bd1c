"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF.

The patterns (email, ip, card, phone) are the base and always stay. The model adds spans that the patterns
miss: national phone numbers (555-123-4567, 555.123.4567, 0171 1234567, 030/1234567, (555) 123-4567), phones that the pattern loses
because a figure stands next to them, emails written with (at) or [at], their points as (dot) or [dot], and two kinds the patterns lack, bank account numbers
(iban, with or without a bank's letters) and nine-digit identity numbers (ssn). Its certainty decides; only what is checked by arithmetic (card, iban, ip)
or by a number of digits is checked after it. It is trained here, in numpy, from labelled spans in generated lines;
no data of the corpus is needed. ``held_out`` generates lines of formats that it never saw, for its test.

Every span, of either kind, holds a digit, an at-sign or a bracketed "at", so windows without one can't hold
any and are not decoded. The windows overlap by half; each is decoded by itself, a span that
touches a cut edge is left to the neighbour that shows it whole, and the spans of a
document are then reconciled over all of it: those that check digits confirm first, then the most certain, none overlapping. None overlaps a base span
but for an account number that holds one. Very long texts are
cut into windows like any other; memory is bounded by the windows decoded at once.

Null and empty texts have no spans. Offsets are code points, ends exclusive. Repeated rows
are searched each. Columns other than the id and the text are read only where they are
carried on request.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, small_batches

#: The first four are those of the patterns.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
TAGS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind
WINDOW, STRIDE = 96, 48
#: Windows decoded at once.
AT_ONCE = 512
#: Least mean certainty of the characters of a span that the model adds, by kind; less where arithmetic checks it, too.
CERTAIN = (0.7, 0.5, 0.4, 0.55, 0.3, 0.6)
#: Kinds with check digits.
CHECKED = (2, 4)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No match begins within a run of digits: what follows the run is the same from each of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def emails(text: str):
    """Leftmost matches of local@domain.part: each holds one at-sign, so these are walked, not the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the fixed patterns, sorted."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


# The network. All arrays are float32; T steps, N windows, H units a direction.
SYMBOLS = 130  # ASCII, other characters, padding
EMBED, HIDDEN = 12, 20


#: Digits other than 0 look alike to the network: their number and grouping tell the kinds apart.
_CODE = np.r_[np.arange(128), 128]
_CODE[ord("1") : ord("9")] = ord("9")


def codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CODE[np.minimum(c, 128)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _allowed() -> np.ndarray:
    """Transitions from row to column: inside only after begin or inside of its kind."""
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


class Tagger:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        make = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"E": make(SYMBOLS, EMBED), "O": make(2 * HIDDEN, TAGS), "o": np.zeros(TAGS, np.float32), "C": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": make(EMBED, 4 * HIDDEN), f"U{d}": make(HIDDEN, 4 * HIDDEN), f"b{d}": np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)}
        self.ok = _allowed()

    def _lstm(self, x: np.ndarray, d: str):
        """Outputs of one direction, and what its gradient needs."""
        W, U, b = self.p[f"W{d}"], self.p[f"U{d}"], self.p[f"b{d}"]
        T, N, _ = x.shape
        h = c = np.zeros((N, HIDDEN), np.float32)
        pre = x @ W + b
        out, kept = np.zeros((T, N, HIDDEN), np.float32), [None] * T
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            z = pre[t] + h @ U
            s = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            tc = np.tanh(new)
            kept[t] = (h, c, i, f, o, g, tc)
            h, c = o * tc, new
            out[t] = h
        return out, kept

    def _lstm_back(self, x, kept, dout, d: str, grad: dict):
        W, U = self.p[f"W{d}"], self.p[f"U{d}"]
        T, N, _ = x.shape
        dh = dc = np.zeros((N, HIDDEN), np.float32)
        dz = np.zeros((T, N, 4 * HIDDEN), np.float32)
        for t in range(T - 1, -1, -1) if d == "f" else range(T):
            h, c, i, f, o, g, tc = kept[t]
            dh = dh + dout[t]
            dcell = dc + dh * o * (1 - tc**2)
            dz[t] = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), dh * tc * o * (1 - o), dcell * i * (1 - g**2)], 1)
            grad[f"U{d}"] += h.T @ dz[t]
            dh, dc = dz[t] @ U.T, dcell * f
        grad[f"W{d}"] += np.tensordot(x, dz, ([0, 1], [0, 1]))
        grad[f"b{d}"] += dz.sum((0, 1))
        return dz @ W.T

    def emissions(self, ids: np.ndarray):
        x = self.p["E"][ids]
        f, kf = self._lstm(x, "f")
        b, kb = self._lstm(x, "b")
        h = np.concatenate([f, b], 2)
        return h @ self.p["O"] + self.p["o"], (x, kf, kb, h)

    def _transitions(self) -> np.ndarray:
        return np.where(self.ok, self.p["C"], np.float32(-1e4))

    @staticmethod
    def _start() -> np.ndarray:
        """A window may begin within a span, so inside tags may come first."""
        return np.zeros(TAGS, np.float32)

    def marginals(self, e: np.ndarray):
        """log Z, and the probabilities of tags and of neighbouring tags' sums."""
        A = self._transitions()
        T, N, K = e.shape
        expA = np.exp(A)
        alpha, scale = np.zeros_like(e), np.zeros((T, N), np.float32)
        top = e.max(2, keepdims=True)
        ee = np.exp(e - top)
        a = ee[0]
        for t in range(T):
            a = ee[0] if t == 0 else (alpha[t - 1] @ expA) * ee[t]
            scale[t] = a.sum(1)
            alpha[t] = a / scale[t][:, None]
        beta = np.ones((N, K), np.float32)
        p, pair = np.zeros_like(e), np.zeros((K, K), np.float32)
        p[T - 1] = alpha[T - 1]
        for t in range(T - 2, -1, -1):
            m = ee[t + 1] * beta / scale[t + 1][:, None]
            pair += (alpha[t].T @ m) * expA
            beta = m @ expA.T
            p[t] = alpha[t] * beta
        return (np.log(scale) + top[:, :, 0]).sum(), p, pair

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        A = self._transitions()
        T, N, K = e.shape
        best, back = e[0] + self._start(), np.zeros((T, N, K), np.int8)
        for t in range(1, T):
            s = best[:, :, None] + A[None]
            back[t] = s.argmax(1)
            best = s.max(1) + e[t]
        tags = np.zeros((T, N), np.int64)
        tags[-1] = best.argmax(1)
        for t in range(T - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(N), tags[t]]
        return tags

    def loss_and_gradient(self, ids: np.ndarray, tags: np.ndarray):
        """Mean negative log likelihood of the tags a window, and its gradient."""
        e, (x, kf, kb, h) = self.emissions(ids)
        T, N, K = e.shape
        logz, p, pair = self.marginals(e)
        t_i, n_i = np.indices((T, N))
        A = self._transitions()
        gold = e[t_i, n_i, tags].sum() + A[tags[:-1], tags[1:]].sum()
        de = p.copy()
        de[t_i, n_i, tags] -= 1
        de /= N
        seen = np.zeros((K, K), np.float32)
        np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["C"] = np.where(self.ok, (pair - seen) / N, 0).astype(np.float32)
        grad["O"] = np.tensordot(h, de, ([0, 1], [0, 1]))
        grad["o"] = de.sum((0, 1))
        dh = de @ self.p["O"].T
        dx = self._lstm_back(x, kf, dh[:, :, :HIDDEN], "f", grad) + self._lstm_back(x, kb, dh[:, :, HIDDEN:], "b", grad)
        np.add.at(grad["E"], ids, dx)
        return (logz - gold) / N, grad

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 48, rate: float = 0.02, seed: int = 3) -> "Tagger":
        """Adam with a rate that falls to zero; ids and tags are windows x characters."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        steps, k = epochs * (len(ids) // batch), 0
        for _ in range(epochs):
            order = r.permutation(len(ids))
            for j in range(len(ids) // batch):
                own = order[j * batch : (j + 1) * batch]
                _, g = self.loss_and_gradient(ids[own].T, tags[own].T)
                norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
                k += 1
                for name, x in g.items():
                    x = x * min(1.0, 5 / (norm + 1e-9))
                    m[name] = 0.9 * m[name] + 0.1 * x
                    v[name] = 0.99 * v[name] + 0.01 * x**2
                    self.p[name] -= (rate * (1 - k / (steps + 1)) * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
        return self


# Labelled lines for training, and for its test with another seed.
_LETTERS = list("abcdefghijklmnopqrstuvwxyz")


_ONSETS, _NUCLEI, _CODAS = ["", "b", "br", "c", "ch", "d", "f", "g", "h", "j", "k", "l", "m", "n", "p", "qu", "r", "s", "sch", "st", "t", "th", "tr", "v", "w", "z"], ["a", "e", "e", "i", "o", "u", "ei", "ou", "é", "ä", "ó"], ["", "", "", "n", "r", "s", "t", "l", "ng", "nd"]


def _word(r, low=2, high=9) -> str:
    """Syllables, as prose has them, or letters at random."""
    if low == 2 and r.random() < 0.6:
        w = "".join(str(r.choice(x)) for _ in range(int(r.integers(1, 4))) for x in (_ONSETS, _NUCLEI, _CODAS))
    else:
        w = "".join(r.choice(_LETTERS, r.integers(low, high)))
    return w[0].upper() + w[1:] if r.random() < 0.15 else w


def _digits(r, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _card(r, valid: bool = True) -> str:
    body = _digits(r, 15)
    last = next(c for c in "0123456789" if luhn(body + c) == valid)
    return r.choice([" ", "-", "", ""]).join([(body + last)[i : i + 4] for i in range(0, 16, 4)])


def _iban(r, gap: str) -> str:
    """Two letters, two check digits that make the whole 1 modulo 97, and 11 to 20 more digits, in a third of them behind a bank's four letters."""
    land, body = "".join(r.choice(list("ABCDEFGHIKLMNPRSTUV"), 2)), _digits(r, int(r.integers(11, 21)))
    if r.random() < 0.35:
        body = "".join(r.choice([x.upper() for x in _LETTERS], 4)) + _digits(r, int(r.integers(10, 17)))
    value = int("".join(str(int(c, 36)) for c in body + land) + "00")
    whole = f"{land}{98 - value % 97:02d}{body}"
    return gap.join(whole[i : i + 4] for i in range(0, len(whole), 4))


def _name(r) -> str:
    return f"{_word(r).lower()}{r.choice(['.', '_', ''])}{_digits(r, r.integers(0, 3))}"


def _host(r) -> str:
    return f"{_word(r).lower()}{_digits(r, r.integers(0, 2))}.{r.choice(['example.com', 'org', 'de', 'co.uk', 'net'])}"


#: Shapes (9 for a digit) of phones that no training line has.
HELD_OUT = ("999 999 9999", "0999-9999999", "0999/999999", "(0999) 9999999", "+99 99 9999 9999", "999-999 9999", "099 999 99 99 99", "+99 (99) 9999-9999")


#: Shapes that many lines have.
COMMON = ("999-999-9999", "999-999-9999", "999-999-9999", "999.999.9999", "999.999.9999", "(999) 999-9999", "0999 9999999", "099/9999999", "0999 999999", "09 99 99 99 99", "0099 99 9999 9999", "1-999-999-9999")


def _filled(r, shape: str) -> str:
    return "".join(_digits(r, 1) if c == "9" else c for c in shape)


def _phone_shape(r) -> str:
    """National or not, in groups of digits with one mark or several kinds of marks between them; a third in the most common shapes."""
    if r.random() < 0.35:
        return str(r.choice(COMMON))
    while True:
        mark = str(r.choice([" ", "-", ".", "/"], p=[0.45, 0.35, 0.1, 0.1]))
        gaps = lambda: mark if r.random() < 0.8 else str(r.choice([" ", "-"]))
        area = "9" * int(r.choice([2, 3, 3, 3, 4]))
        groups = [["999", "9999"], ["9" * int(r.integers(5, 9))], ["99"] * int(r.integers(3, 5)), ["999", "99", "99"], ["9999", "9999"], ["999", "9999"]][int(r.integers(0, 6))]
        rest = groups[0] + "".join(gaps() + g for g in groups[1:])
        begin = str(r.choice([f"({area}) ", f"(0{area[1:]}) ", f"0{area[1:]}" + gaps(), f"0{area[1:]}" + gaps(), *[area + gaps()] * 4, "+99 " + area + gaps(), "+99" + area, f"+1 ({area}) ", f"+99 ({area}) ", f"0099 {area[1:]} "]))
        shape = begin + rest
        groups = [len(g) for g in re.findall("[019]+", shape)]
        if 9 <= sum(groups) <= 13 and groups != [3, 2, 4] and shape not in HELD_OUT:
            return shape


def _personal(r, kind: int, seen: bool) -> str:
    """A span of the kind, in a format of training or, if not ``seen``, in one that training lacks."""
    if kind == 0:
        at = str(r.choice(["@", "@", "@", " (at) ", " [at] ", " [at] ", "(at)", "{at}", " {at} ", " (AT) "] if seen else ["[at]", " [AT] ", "{AT}"]))
        host = _host(r)
        if at != "@" and seen and r.random() < 0.4:  # the points of the host are spelled out likewise
            host = host.replace(".", at.replace("at", "dot").replace("AT", "DOT"))
        return f"{_name(r)}{at}{host}"
    if kind == 1:
        return ".".join(str(x) for x in r.integers(1, 256, 4))
    if kind == 2:
        return _card(r)
    if kind == 4:
        if not seen:
            return f"{(whole := _iban(r, ''))[:4]}-{whole[4:]}"
        whole = _iban(r, str(r.choice(["", "", " ", " ", "-"])))
        return whole if len(whole) > 24 or r.random() < 0.5 else f"{whole[:4]} {whole[4:]}"
    if kind == 5:
        return _filled(r, str(r.choice(["999-99-9999", "999-99-9999", "999 99 9999", "999.99.9999"])))
    return _filled(r, _phone_shape(r) if seen else str(r.choice(HELD_OUT)))


def _other(r) -> str:
    """Figures that are not personal data, some of them much alike."""
    d = lambda n: _digits(r, n)
    made = [
        lambda: f"Version {r.integers(1, 9)}.{r.integers(0, 9)}.", lambda: f"CC BY-NC {r.integers(1, 5)}.0.", lambda: str(r.integers(1900, 2040)), lambda: d(r.integers(1, 9)), lambda: d(r.integers(20, 30)),
        lambda: f"{r.integers(1, 99)}%", lambda: f"{r.integers(0, 24)}:{d(2)}", lambda: f"{r.integers(1, 29)}.{r.integers(1, 13)}.{r.integers(1990, 2030)}", lambda: f"{r.integers(1990, 2030)}-{d(2)}-{d(2)}", lambda: f"{r.integers(1990, 2030)}-{d(2)}-{d(2)} {d(2)}:{d(2)}:{d(2)}",
        lambda: 'token = "' + "".join(r.choice(list("0123456789abcdef"), 40)) + '"', lambda: "AKIA" + "".join(r.choice(list("ABCDEFGH23456789"), 16)), lambda: f"{d(2)}.{d(3)},{d(2)}", lambda: f"{r.integers(1, 99)},{d(3)},{d(3)}", lambda: f"@{_word(r)}",
        lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"{r.integers(1000, 2030)}-{r.integers(1000, 2030)}", lambda: f"{d(2)}.{d(4)}, {d(2)}.{d(4)}", lambda: f"#{d(6)}", lambda: f"{d(2)}/{d(2)}/{d(4)}", lambda: f"{_word(r).upper()}-{d(4)}-{d(2)}", lambda: f"{d(3)} x {d(3)} x {d(2)}", lambda: f"{d(1)}.{d(1)}.{d(2)}.{d(4)}", lambda: f"{d(3)}, {d(3)}, {d(3)}, {d(4)}", lambda: f"{d(8)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}-{d(2)}", lambda: f"{d(4)}-{d(3)}-{d(2)}",
    ]
    return made[int(r.integers(0, len(made)))]()


#: What may stand before a span, in some lines.
_CUES = ("tel", "tel.", "phone:", "call", "fax", "Telefon", "Tel.:", "iban", "IBAN:", "ssn", "mail", "email:", "card", "ip")


def labelled(n: int, seed: int, seen: bool = True, lookalikes: bool = False) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """Generated lines and their spans (start, kind's number, end).

    Figures like a card's that fail its checksum are labelled as cards for training only (``lookalikes``): no network can
    tell them, arithmetic does so after it.
    """
    r = np.random.default_rng(seed)
    lines, spans = [], []
    for _ in range(n):
        parts, own, at = [], [], 0
        marks = str(r.choice(["", "", "", "", "!!", "###", "$$$", "%%%"]))  # junk that stands after each word of some lines
        for _ in range(int(r.integers(6, 22)) if r.random() < 0.8 else int(r.integers(1, 5))):
            u = r.random()
            if u < 0.14:
                kind = int(r.choice(len(KINDS), p=[0.22, 0.08, 0.12, 0.32, 0.15, 0.11]))
                if r.random() < 0.15:
                    parts.append(cue := str(r.choice(_CUES)) + " ")
                    at += len(cue)
                x = str(_personal(r, kind, seen))
                own.append((at, kind, at + len(x)))
                x += str(r.choice(["", "", "", "", "", ".", ",", ";", ")", "!", "?"]))
            elif u < 0.17:
                x = _card(r, valid=False)
                if lookalikes:
                    own.append((at, 2, at + len(x)))
            else:
                x = str(_other(r)) if u < 0.34 else _word(r) + str(r.choice(["", "", "", ",", "."]))
            x += marks + str(r.choice([" ", " ", " ", " ", "\n"]))
            parts.append(x)
            at += len(x)
        line = "".join(parts)
        lines.append(line.rstrip() if r.random() < 0.5 else line)  # texts end with a blank or with what they say
        spans.append(own)
    return lines, spans


def held_out(n: int, seed: int) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """Lines whose spans have formats that training lacks; ip, card and ssn have those of training."""
    return labelled(n, seed, seen=False)


def training_windows(lines, spans) -> tuple[np.ndarray, np.ndarray]:
    ids, tags = [], []
    for text, own in zip(lines, spans):
        c, t = codes(text), np.zeros(len(text), np.int64)
        for a, k, b in own:
            t[a] = 1 + 2 * k
            t[a + 1 : b] = 2 + 2 * k
        for s in range(0, max(1, len(c) - STRIDE), STRIDE):
            pad = max(0, WINDOW - len(c[s : s + WINDOW]))
            ids.append(np.pad(c[s : s + WINDOW], (0, pad), constant_values=SYMBOLS - 1))
            tags.append(np.pad(t[s : s + WINDOW], (0, pad)))
    return np.array(ids), np.array(tags)


@functools.lru_cache(2)
def trained(lines: int = 4500, epochs: int = 8) -> Tagger:
    """The model, trained once in a process from the same lines each time."""
    return Tagger().fit(*training_windows(*labelled(lines, 11, lookalikes=True)), epochs)


def _possible(kind: int, text: str) -> bool:
    """What arithmetic and the number of digits rule out, whatever the model says."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    if kind == 0:
        at = _AT.search(text)
        return at is not None and at.start() > 0 and _POINT.search(text[at.end() : -1]) is not None
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(x.isascii() and x.isdigit() and int(x[:9]) <= 255 for x in parts)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 9 <= len(digits) <= 15
    if kind == 4:
        whole = "".join(c for c in text if c.isascii() and c.isalnum()).upper()
        return 15 <= len(whole) <= 34 and int("".join(str(int(c, 36)) for c in whole[4:] + whole[:4])) % 97 == 1
    return len(digits) == 9 if kind == 5 else True


def model_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind's number, end, certainty) for each text, reconciled over its windows."""
    where: list[tuple[int, int]] = []
    for k, text in enumerate(texts):
        # The trigger at p lies in the windows that begin at STRIDE * (p // STRIDE) and one stride before.
        starts = {s for m in _TRIGGER.finditer(text) for q in (m.start() // STRIDE,) for s in (q, q - 1) if s >= 0}
        where += [(k, STRIDE * s) for s in sorted(starts)]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    for i in range(0, len(where), AT_ONCE):
        own = where[i : i + AT_ONCE]
        ids = np.full((WINDOW, len(own)), SYMBOLS - 1)
        for n, (k, s) in enumerate(own):
            c = codes(texts[k][s : s + WINDOW])
            ids[: len(c), n] = c
        e, _ = tagger.emissions(ids)
        opening = np.flatnonzero([s == 0 for _, s in own])
        e[0, opening[:, None], np.arange(2, TAGS, 2)] = -1e4  # a text doesn't begin within a span
        tags, (_, p, _) = tagger.viterbi(e), tagger.marginals(e)
        for n, (k, s) in enumerate(own):
            t, size = tags[:, n], min(WINDOW, len(texts[k]) - s)
            for a in np.flatnonzero((t % 2 == 1) & (np.arange(WINDOW) < size)).tolist():
                b = a + 1
                while b < size and t[b] == t[a] + 1:
                    b += 1
                cut = (a == 0 and s > 0) or (b == WINDOW and s + b < len(texts[k]))
                if not cut:
                    found[k].append((s + a, (int(t[a]) - 1) // 2, s + b, float(p[np.arange(a, b), n, t[a:b]].mean())))
    for k, spans in enumerate(found):
        kept: list[tuple[int, int, int, float]] = []
        # What arithmetic has checked comes first, so no fragment of it stands in its way.
        for x in sorted(set(spans), key=lambda x: (x[1] not in CHECKED, -x[3], x[0], x[1], x[2])):
            if x[3] >= CERTAIN[x[1]] and _possible(x[1], texts[k][x[0] : x[2]]) and all(x[2] <= y[0] or x[0] >= y[2] for y in kept):
                kept.append(x)
        found[k] = sorted(kept)
    return found


#: Also for Java's engine, which looks whether a text has any.
_AT = re.compile(r"@|[(\[{] ?[aA][tT] ?[)\]}]")
_POINT = re.compile(r"\.|[(\[{] ?[dD][oO][tT] ?[)\]}]")
TRIGGER = "[0-9]|" + _AT.pattern
_TRIGGER = re.compile(TRIGGER)
FIELDS = ("start", "rank", "kind", "end", "base")
SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_())]))


def spans_of(texts: list[str], tagger: Tagger) -> list[list[dict]]:
    out = []
    for text, added in zip(texts, model_spans(texts, tagger)):
        base = base_spans(text)
        own = [(*x, True) for x in base]
        # An account number may hold figures that pass for a card; both spans stay then.
        own += [(a, k, b, False) for a, k, b, _ in added if all(b <= y[0] or a >= y[2] or (KINDS[k] == "iban" and a <= y[0] and y[2] <= b) for y in base)]
        out.append([dict(zip(FIELDS, (a, k, KINDS[k], b, is_base))) for a, k, b, is_base in sorted(own)])
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, spans (by start, then kind), and the columns to carry."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())  # some 5,000 numbers
    held = {f"_carry{k}": c for k, c in enumerate(carry)}
    searched = F.when(F.col(text_col).rlike(TRIGGER), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), searched.alias("text"), *(F.col(c).alias(h) for h, c in held.items()))
    names = [n for n in rows.columns if n != "text"]

    def find(batches):
        for whole in batches:
            for batch in small_batches(whole):
                texts = batch.column("text").to_pylist()
                some = [k for k, t in enumerate(texts) if t]
                spans: list[list] = [[] for _ in texts]
                for k, s in zip(some, spans_of([texts[k] for k in some], shared.value)):
                    spans[k] = s
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(spans, _ARROW)], names=[*names, "spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    got = rows.mapInArrow(find, f"{schema}, spans {SPANS}")
    return got.select(F.col("id").alias(id_col), "spans", *(F.col(h).alias(c) for h, c in held.items()))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with each span's text replaced by its kind in brackets; other texts and columns are unchanged."""
    rows, named = numbered(docs)
    found = find_pii(rows, named[id_col], named[text_col], carry=tuple(n for n in rows.columns if n != named[id_col]))
    text = F.col(named[text_col])
    out = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"), s["end"].alias("at")),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    return found.select(*(F.when(F.size("spans") > 0, out).otherwise(text).alias(c) if c == text_col else F.col(n).alias(c) for c, n in named.items()))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2(spark, sf_dir: str) -> DataFrame:
    got = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("bigint").alias(f"n_{k}")
    return got.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"))
