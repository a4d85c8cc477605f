"""Personal data: counts and spans of fixed patterns (``n_*`` count these alone), and a tagger that adds spans.

The tagger is a character-level BiLSTM with CRF transitions, trained here, in numpy, from generated text with
labelled spans (:func:`labelled_text`): written-out and spaced forms that the patterns miss, and secrets (passwords,
tokens, access keys: a kind of its own, ``secret``), among look-alikes that are none. Every text is cut into overlapping
windows; each is decoded by Viterbi, and each position takes its tag from the window that holds it furthest
from an edge, so that the windows give one tag sequence for the whole text. A tagged stretch says where and
what; the exact ends come from the kind's form and rule (:data:`FORMS`, :func:`holds`) in and around it,
and give way to pattern spans that they touch.

Two exact bounds spare work. Every added span holds a digit, an ``@`` or a written-out ``at``, and is no longer than REACH:
windows further from those can add nothing and aren't run. A tagged stretch ends where another window takes over, so that
no stretch depends on a window left out. Padding leaves both directions' states at zero: a window's tags don't depend on those it runs with. A window whose emissions leave no path better than
all-outside is decided by that bound. Patterns are searched in linear time, with the results of ``finditer``.

Edge cases: a null or empty text has no spans; the digest of no span is that of the empty string;
repeated rows each get a row; null ids are carried; extra columns are ignored, and an output column whose name a kept
one has gets underscores; an empty table gives an empty result. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import fresh
from .workers import trimmed

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGIT = re.compile(r"[0-9]")
#: What the tagger knows: those, and passwords, tokens and keys.
TAGGED = (*KINDS, "secret")
TAGS = 1 + 2 * len(TAGGED)  # outside; begin and inside of each kind
WINDOW, OVERLAP = 512, 64
#: No added span is longer, nor further from what :func:`_anchors` names.
REACH = 200
PAD, VOCABULARY = 132, 133


#: Inside follows begin or inside of its kind only.
_BARRED = np.zeros((TAGS, TAGS), np.float32)
for _k in range(len(TAGGED)):
    _BARRED[:, 2 + 2 * _k] = -1e4
    _BARRED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = 0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def holds(kind: str, found: str) -> bool:
    """The rule of the kind on matched text."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern, found from each @: what stands before it can't hold another."""
    at, p = 0, text.find("@")
    while p >= 0:
        before = text[at:p]
        start = len(before.rstrip(_LOCAL)) + at
        m = _DOMAIN.match(text, p + 1) if start < p else None
        if m:
            yield start, m.end()
        at = m.end() if m else p + 1
        p = text.find("@", at)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern: runs of dotted numbers, four at a time."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            parts = [m.span() for m in re.finditer(r"[0-9]+", run[0])]
            for i in range(0, len(parts) - 3, 4):
                yield run.start() + parts[i][0], run.start() + parts[i + 3][1]


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, sorted; in linear time."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(a, 1, b) for a, b in _addresses(text) if holds("ip", text[a:b])]
        for k in (2, 3):
            if k == 2 or "+" in text:
                out += [(m.start(), k, m.end()) for m in PATTERNS[KINDS[k]].finditer(text) if holds(KINDS[k], m[0])]
    return sorted(out)


def classes(points: np.ndarray) -> np.ndarray:
    """A class below VOCABULARY for each code point."""
    out = np.where(points < 128, points, 129)
    letters = (points >= 0xC0) & (points < 0x250)
    out = np.where(letters, 128, out)
    out = np.where((points == 0xA0) | (points == 0x2028) | ((points >= 0x2000) & (points < 0x200B)) | (points == 0x3000), 130, out)
    return np.where(points > 0xFFFF, 131, out).astype(np.uint8)


def labelled_text(rng: np.random.Generator, size: int) -> tuple[str, list[int]]:
    """``size`` characters of text and their tags: words, personal data in many forms, look-alikes."""
    parts: list[str] = []
    tags: list[int] = []
    letters = list("etaoinshrdlcmpgbkufywvjxz")
    marked = list("etaoinshrdlucmgéèüöäßñóíç")
    short = "at dot the of and to a in is on net com org at dot tel de le la en un que der die und y el no".split()
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))

    def word() -> str:
        x = rng.random()
        if x < 0.3:
            return str(rng.choice(short))
        return "".join(rng.choice(marked if x < 0.5 else letters, rng.integers(2, 12)))

    def ascii_word() -> str:
        return "".join(rng.choice(letters, rng.integers(3, 9)))

    def card() -> str:
        n = int(rng.integers(14, 17))
        d = digits(n - 1)
        d += next(c for c in "0123456789" if luhn(d + c))
        step = rng.choice([".", "/", "  ", "_", " . "])
        return step.join(d[i : i + 4] for i in range(0, n, 4))

    def email() -> str:
        at = rng.choice([" at ", " [at] ", " (at) ", "[at]", "(at)", " AT ", " @ "])
        dot = rng.choice([" dot ", " [dot] ", " (dot) ", "[dot]", "(dot)", " DOT ", "."])
        return ascii_word() + rng.choice(["", "." + ascii_word(), digits(2)]) + at + ascii_word() + (dot if dot != "." or at != " at " else " dot ") + rng.choice(["com", "org", "net", "de", "fr"])

    def ip() -> str:
        sep = rng.choice([" . ", "[.]", " dot ", "(.)", "[dot]"])
        return sep.join(str(x) for x in rng.integers(0, 256, 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return str(rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits(2)} {a} {b} {c}", f"tel {a} {b} {c}", f"1-{a}-{b}-{c}"]))

    def decoy() -> str:
        return str(
            rng.choice(
                [digits(16), digits(int(rng.integers(1, 8))), f"{digits(2)}.{digits(1)}.{digits(1)}", f"20{digits(2)}-{digits(2)}-{digits(2)}", f"${digits(3)}.{digits(2)}",
                 hashlib.sha1(digits(9).encode()).hexdigest(), f"{digits(1)}.{digits(1)}.", "http://" + ascii_word() + ".com/" + digits(3), f"{word()} at {word()}", f"{word()}, dot {word()}", f"({digits(2)})",
                 f"{digits(5)}-{digits(4)}", f"{ascii_word()} = \"{digits(12)}\"", "!!", "|", "###", word() + str(rng.choice(["***", "###", "%%%", "&&&", "$$$"])), word() + "!!", f"{digits(3)} - {digits(3)}"]
            )
        )

    def secret() -> tuple[str, str, str]:
        """What leads to the value, the value, and what closes it."""
        upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
        x = rng.random()
        if x < 0.3:
            return "", "AKIA" + "".join(rng.choice(list(upper), 16)), ""
        if x < 0.4:
            return "", str(rng.choice(["ghp_", "sk-", "xoxb-"])) + "".join(rng.choice(list(mixed), rng.integers(20, 37))), ""
        name = str(rng.choice(["password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access_key", "Password", "TOKEN"]))
        value = hashlib.sha1(digits(9).encode()).hexdigest()[: int(rng.integers(14, 41))] if x < 0.8 else "".join(rng.choice(list(mixed), rng.integers(14, 30)))
        lead, close = [("=", ""), ("=", ""), (": ", ""), (" = ", ""), (' = "', '"'), ('="', '"'), (": '", "'"), (':"', '"'), (":", "")][int(rng.integers(0, 9))]
        return name + lead, value, close + str(rng.choice(["", "", "", "###", ";", "|", "***"]))

    makers = (email, ip, card, phone, secret)
    room = size
    while room > 0:
        x = rng.random()
        if x < 0.06:
            k = int(rng.integers(0, len(makers)))
            body = makers[k]()
            close = ""
            if k == 4:
                lead, body, close = body
                parts.append(lead)
                tags += [0] * len(lead)
                room -= len(lead)
            if k == 3 and body.startswith("tel "):
                parts.append("tel ")
                tags += [0] * 4
                room -= 4
                body = body[4:]
            mark = [1 + 2 * k] + [2 + 2 * k] * (len(body) - 1) + [0] * len(close)
            body += close
        elif x < 0.14:
            body = decoy()
            mark = [0] * len(body)
        else:
            body = word()
            body = body.upper() if x > 0.97 else body.capitalize() if x > 0.9 else body
            mark = [0] * len(body)
        gap = str(rng.choice([" ", " ", " ", " ", ", ", ". ", "\n", " | "]))
        parts += [body, gap]
        tags += mark + [0] * len(gap)
        room -= len(body) + len(gap)
    return "".join(parts)[:size], tags[:size]


Params = dict[str, np.ndarray]


def _squash(x: np.ndarray, room: np.ndarray) -> None:
    """x / (1 + |x|) in place: the network's smooth step, far cheaper than tanh."""
    np.abs(x, out=room)
    room += 1
    x /= room


def _states(x: np.ndarray, table: np.ndarray, u: np.ndarray) -> np.ndarray:
    """LSTM states (T x hidden x B) over x (T x B) from zero; gates are i, f, o, then g."""
    steps, rows = x.shape
    h4 = u.shape[1]
    n = h4 // 4
    table_t, u_t = np.ascontiguousarray(table.T), np.ascontiguousarray(u.T)
    out = np.empty((steps, n, rows), np.float32)
    h, c = np.zeros((n, rows), np.float32), np.zeros((n, rows), np.float32)
    z, y, room = (np.empty((h4, rows), np.float32) for _ in range(3))
    at = x.astype(np.intp)
    for t in range(steps):
        np.take(table_t, at[t], 1, out=z, mode="clip")
        np.matmul(u_t, h, out=y)
        z += y
        _squash(z, room)
        s = z[: 3 * n]
        s *= 0.5
        s += 0.5
        c *= s[n : 2 * n]
        z[3 * n :] *= s[:n]
        c += z[3 * n :]
        h = out[t]
        h[:] = c
        _squash(h, room[:n])
        h *= s[2 * n :]
    return out


def emissions(p: Params, x: np.ndarray) -> np.ndarray:
    """Scores (T x tags x B) of windows x (T x B)."""
    n = p["uf"].shape[0]
    forward = _states(x, p["ef"], p["uf"])
    backward = _states(x[::-1], p["eb"], p["ub"])[::-1]
    w = np.ascontiguousarray(p["w"].T)
    e = np.matmul(w[:, :n], forward)
    e += np.matmul(w[:, n:], backward)
    e += p["b"][None, :, None]
    return e


def viterbi(e: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Best tags (T x B)."""
    steps, rows, k = e.shape
    score, back = e[0].copy(), np.zeros((steps, rows, k), np.int8)
    for t in range(1, steps):
        every = score[:, :, None] + a[None]
        back[t] = every.argmax(1)
        score = every.max(1) + e[t]
    tags = np.zeros((steps, rows), np.int8)
    tags[-1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = back[t][np.arange(rows), tags[t]]
    return tags


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def crf_gradient(e: np.ndarray, a: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood of tags y (T x B), and its gradients by emissions and transitions."""
    steps, rows, k = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, steps):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + a[None], 1) + e[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _lse(a[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _lse(alpha[-1], 1)
    de = np.exp(alpha + beta - z[None, :, None])
    pair = np.exp(alpha[:-1][:, :, :, None] + a + (e[1:] + beta[1:])[:, :, None, :] - z[None, :, None, None])
    da = pair.sum((0, 1))
    t, r = np.meshgrid(np.arange(steps), np.arange(rows), indexing="ij")
    gold = e[t, r, y].sum() + a[y[:-1], y[1:]].sum()
    np.subtract.at(de, (t, r, y), 1)
    np.subtract.at(da, (y[:-1], y[1:]), 1)
    return float(z.sum() - gold), de / rows, da / rows


def _lstm_forward(x: np.ndarray, table: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    steps, rows = x.shape
    n = u.shape[0]
    h, c = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
    out, kept = np.empty((steps, rows, n), np.float32), []
    for t in range(steps):
        z = table[x[t]] + h @ u
        room = 1 / (1 + np.abs(z))
        q = z * room
        s, g = 0.5 + 0.5 * q[:, : 3 * n], q[:, 3 * n :]
        before, held = c, h
        c = s[:, n : 2 * n] * c + s[:, :n] * g
        shut = 1 / (1 + np.abs(c))
        tc = c * shut
        h = s[:, 2 * n :] * tc
        out[t] = h
        kept.append((held, before, s, g, tc, room * room, shut * shut))
    return out, kept


def _lstm_backward(x: np.ndarray, u: np.ndarray, kept: list, dh_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps, rows, n = dh_out.shape
    de, du = np.zeros((VOCABULARY, 4 * n), np.float32), np.zeros_like(u)
    dh, dc = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
    for t in range(steps - 1, -1, -1):
        held, before, s, g, tc, slope, c_slope = kept[t]
        i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
        dh = dh + dh_out[t]
        dc = dc + dh * o * c_slope
        dz = np.concatenate([0.5 * dc * g, 0.5 * dc * before, 0.5 * dh * tc, dc * i], 1) * slope
        np.add.at(de, x[t], dz)
        du += held.T @ dz
        dh, dc = dz @ u.T, dc * f
    return de, du


@functools.lru_cache(maxsize=2)
def train_tagger(hidden: int = 12, rounds: int = 1000, rows: int = 48, length: int = 80, seed: int = 3) -> Params:
    """BiLSTM-CRF weights from generated labelled text, by Adam; about ``rounds * rows * length`` characters."""
    rng = np.random.default_rng(seed)
    scale = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    p: Params = {"ef": scale(VOCABULARY, 4 * hidden), "eb": scale(VOCABULARY, 4 * hidden), "uf": scale(hidden, 4 * hidden), "ub": scale(hidden, 4 * hidden), "w": scale(2 * hidden, TAGS), "b": np.zeros(TAGS, np.float32), "a": np.zeros((TAGS, TAGS), np.float32)}
    for k in ("ef", "eb"):
        p[k][:, hidden : 2 * hidden] += 1
        p[k][PAD, : 3 * hidden] = -1e9  # shut gates: padding leaves the state at zero
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    text, tags = labelled_text(rng, 400_000)
    x_all = classes(np.array([ord(c) for c in text]))
    y_all = np.array(tags, np.int64)
    for step in range(1, rounds + 1):
        at = rng.integers(0, len(x_all) - length, rows)
        where = at[None, :] + np.arange(length)[:, None]
        x, y = x_all[where].copy(), y_all[where].copy()
        ends = rng.random(rows) < 0.15
        cut = rng.integers(length // 2, length, rows)
        gone = (np.arange(length)[:, None] >= cut) & ends
        x[gone], y[gone] = PAD, 0
        hf, kf = _lstm_forward(x, p["ef"], p["uf"])
        xb = x[::-1]
        hb, kb = _lstm_forward(xb, p["eb"], p["ub"])
        both = np.concatenate([hf, hb[::-1]], 2)
        e = (both @ p["w"] + p["b"]).astype(np.float32)
        _, de, da = crf_gradient(e, p["a"] + _BARRED, y)
        de = de.astype(np.float32)
        g = {"w": np.einsum("tbh,tbk->hk", both, de), "b": de.sum((0, 1)), "a": da}
        d = de @ p["w"].T
        g["ef"], g["uf"] = _lstm_backward(x, p["uf"], kf, d[:, :, :hidden])
        g["eb"], g["ub"] = _lstm_backward(xb, p["ub"], kb, np.ascontiguousarray(d[::-1, :, hidden:]))
        norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
        rate = 0.02 * (1 - 0.9 * step / rounds)
        shrink = min(1.0, 5 / (norm + 1e-9))
        for k in p:
            q = g[k] * shrink
            m[k] += 0.1 * (q - m[k])
            v[k] += 0.01 * (q * q - v[k])
            p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


_AT = re.compile(r"[\[(]\s?at\s?[\])]", re.I)
_PLAIN_AT = re.compile(r"(?<=\s)at(?=\s)", re.I)
_DOT = re.compile(r"\bdot\b", re.I)


def _anchors(text: str) -> np.ndarray:
    """Positions, sorted, of which every span that can be added holds one: digits, @, at."""
    out = []
    if _DIGIT.search(text):
        out.append(np.array([m.start() for m in _DIGIT.finditer(text)], np.int64))
    if "@" in text:
        out.append(np.array([m.start() for m in re.finditer("@", text)], np.int64))
    if "at" in (low := text.lower()):
        if "(" in low or "[" in low:
            out.append(np.array([m.start() for m in _AT.finditer(text)], np.int64))
        if "dot" in low:
            # a plain "at" counts only with a written-out dot in the same span
            at, dot = (np.array([m.start() for m in form.finditer(text)], np.int64) for form in (_PLAIN_AT, _DOT))
            out.append(at[np.searchsorted(dot, at + REACH) > np.searchsorted(dot, at - REACH)])
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def tag_spans(texts: list[str], p: Params, most: int = 512, gated: bool = True) -> list[list[tuple[int, int, int]]]:
    """(start, kind number, end) that the tagger finds in each text, unchecked; windows run in groups of ``most``.

    ``gated``: without those windows in which nothing can be added.
    """
    step = WINDOW - OVERLAP
    near = [_anchors(t) if gated else None for t in texts]
    some = [i for i, t in enumerate(texts) if t and (near[i] is None or len(near[i]))]
    coded = {i: classes(np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), np.uint32)) for i in some}
    jobs = []
    for i in some:
        at = np.arange(0, max(1, len(texts[i]) - OVERLAP), step)
        if near[i] is not None:
            at = at[np.searchsorted(near[i], at + WINDOW + REACH) > np.searchsorted(near[i], at - REACH)]
        jobs += [(i, a) for a in at.tolist()]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found: dict[int, list[tuple[int, np.ndarray]]] = {}
    a = p["a"] + _BARRED
    quiet = float(a[0, 0])
    enter = np.maximum(a[0, 1::2] - quiet, (a[1:, 1::2] - a[1:, :1]).max(0))[:, None]
    after_begin, after_inside = (a[k, 0] - quiet for k in (np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)))
    to_inside, stay = (a[k, np.arange(2, TAGS, 2)] - quiet for k in (np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)))
    jobs.sort(key=lambda j: min(WINDOW, len(texts[j[0]]) - j[1]))
    for g in range(0, len(jobs), most):
        group = jobs[g : g + most]
        longest = min(WINDOW, max(len(texts[i]) - s for i, s in group))
        x = np.full((len(group), longest), PAD, np.uint8)
        for r, (i, s) in enumerate(group):
            part = coded[i][s : s + longest]
            x[r, : len(part)] = part
        e = emissions(p, np.ascontiguousarray(x.T))
        # what the best run of tags can gain over all-outside, from each begin on, bounded from above; where
        # no run gains, all-outside is the best path
        e_in = e[:, 2::2] - e[:, :1]
        e_begin = e[:, 1::2] - e[:, :1]
        e_begin += enter
        on = e_in[-1] + np.maximum(after_inside, 0)[:, None]
        top = (e_begin[-1] + np.maximum(after_begin, 0)[:, None]).max(0)
        for t in range(longest - 2, -1, -1):
            top = np.maximum(top, (e_begin[t] + np.maximum(after_begin[:, None], to_inside[:, None] + on)).max(0))
            on = e_in[t] + np.maximum(after_inside[:, None], stay[:, None] + on)
        rows = np.flatnonzero(np.maximum(top, on.max(0)) > 0)
        if len(rows):
            tags = viterbi(np.ascontiguousarray(e[:, :, rows].transpose(0, 2, 1)), a)
            for c, r in enumerate(rows):
                if tags[:, c].any():
                    found.setdefault(group[r][0], []).append((group[r][1], tags[:, c]))
    for i, parts in found.items():
        n = len(texts[i])
        whole = np.zeros(n, np.int8)
        taken_over = set(range(step + OVERLAP // 2, n, step))
        for s, tags in sorted(parts, key=lambda q: q[0]):
            low = s + (OVERLAP // 2 if s else 0)
            high = s + WINDOW - OVERLAP // 2 if s + WINDOW < n else n
            high = min(high, n, s + len(tags))
            whole[low:high] = tags[low - s : high - s]
        at = 0
        while at < n:
            t = int(whole[at])
            if not t:
                at += 1
                continue
            k = (t - 1) // 2
            end = at + 1
            while end < n and whole[end] == 2 + 2 * k and end not in taken_over:
                end += 1
            out[i].append((at, k, end))
            at = end
    return out


#: What an added span looks like, by kind.
FORMS = {
    "email": re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z0-9._%+-]+(?:\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s))*[A-Za-z0-9._%+-]+(\s?[\[(]\s?at\s?[\])]\s?|\sat\s|\s?@\s?)[A-Za-z0-9-]+(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s|\.)[A-Za-z0-9-]+)+", re.I),
    "ip": re.compile(r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:(?:\s?[\[(](?:\.|dot)[\])]\s?|\s?\.\s?|\sdot\s)[0-9]{1,3}){3}(?![A-Za-z0-9])", re.I),
    "card": re.compile(r"(?<![A-Za-z0-9])[0-9](?:[\s./_-]{0,3}[0-9]){13,18}(?![A-Za-z0-9])"),
    "phone": re.compile(r"(?<![A-Za-z0-9+])(?:\([0-9]{2,4}\)|[0-9]{1,4})(?:[\s.-]{1,2}[0-9]{2,4}){2,4}(?![A-Za-z0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{12,}(?![A-Za-z0-9_+/-])"),
}


def accepted(kind: str, found: str) -> bool:
    """The rule of the kind on text in its form."""
    digits = re.sub(r"[^0-9]", "", found)
    if len(found) > REACH:
        return False
    if kind == "email":
        # after a plain "at" only a written-out dot makes an address
        return not (re.search(r"\sat\s", found, re.I) and not re.search(r"\bdot\b", found, re.I))
    if kind == "ip":
        return all(int(p) <= 255 for p in re.findall(r"[0-9]+", found))
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return bool(digits) and bool(re.search(r"[A-Za-z]", found))


def exact_spans(text: str, kind: str, s: int, e: int) -> list[tuple[int, int]]:
    """Spans of the kind's form in and around a tagged stretch that it touches."""
    low, high = max(0, s - REACH), min(len(text), e + REACH)
    return [m.span() for m in FORMS[kind].finditer(text, low, high) if m.start() < e and m.end() > s and accepted(kind, m[0])]


def all_spans(texts: list[str], p: Params) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Pattern spans and all spans of each text."""
    out = []
    for text, more in zip(texts, tag_spans(texts, p), strict=True):
        base = pattern_spans(text)
        whole = list(base)
        # base spans of different kinds may overlap: taken together they are apart, so starts and ends are both sorted
        taken: list[tuple[int, int]] = []
        for s, _, e in base:
            if taken and s < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(taken[-1][1], e))
            else:
                taken.append((s, e))
        for s, k, e in more:
            for a, b in exact_spans(text, TAGGED[k], s, e):
                i = bisect.bisect_left(taken, (b,))
                if not (i and taken[i - 1][1] > a):
                    whole.append((a, k, b))
                    taken.insert(i, (a, b))
        out.append((base, sorted(whole)))
    return out


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{TAGGED[k]}:{s}:{e}" for s, k, e in spans)


def _find(names: list[str], text: str, added: list[str], p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                end, size = at, 0
                texts: list[str] = []
                while end < batch.num_rows and size < 1_000_000:
                    texts.append(batch.column(text)[end].as_py() or "")
                    size += len(texts[-1])
                    end += 1
                spans = all_spans(texts, p)
                part = batch.slice(at, end - at)
                counts = [pa.array([sum(1 for _, k, _ in base if k == kind) for base, _ in spans], pa.int64()) for kind in range(len(KINDS))]
                digests = pa.array([hashlib.sha256(span_text(base).encode()).hexdigest() for base, _ in spans])
                secrets = [[x for x in w if x[1] >= len(KINDS)] for _, w in spans]
                cols = [
                    *counts, digests, pa.array([span_text(w) for _, w in spans]), pa.array([len(w) - len(b) for b, w in spans], pa.int64()),
                    pa.array([span_text(w) for w in secrets]), pa.array([len(w) for _, w in spans], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *cols], [*names, *added])
                at = end

    return run


def find_personal_data(df: DataFrame, keep: list[str], params: Params | None = None) -> DataFrame:
    """``keep`` columns, counts of pattern spans by kind, their digest, all spans as text (those of secrets too), how many
    of them the tagger added, the spans of secrets by themselves, and the number of all spans."""
    kinds = dict(df.dtypes)
    typed = [*((f"n_{k}", "bigint") for k in KINDS), ("base_sha256", "string"), ("spans", "string"), ("n_added", "bigint"), ("secrets", "string"), ("n_spans", "bigint")]
    added = [fresh(keep, c) for c, _ in typed]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{c}` {t}" for c, (_, t) in zip(added, typed, strict=True))])
    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(trimmed(_find(keep, "text", added, params or train_tagger())), schema)
