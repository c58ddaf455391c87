"""Personal data: fixed patterns plus a character-level BiLSTM-CRF.

The patterns (e-mail, IP address, card, phone) give the base spans.  A bidirectional LSTM
with CRF transitions over BIO tags is trained in numpy on a bounded sample of rows to find what they miss: its labelled
spans are the base spans and secrets of the sample, and copies of the sample's texts in which these are written in other ways
(national numbers, other separators, veiled addresses, keys of other alphabets) or replaced by harmless numbers (dates, prices,
versions, book numbers), which are negatives, as are candidates that a check refused.  A fifth kind, ``secret``, exists in ``spans``
only.  The network's spans are added where they pass their kind's plain check (length, digits, Luhn) and touch neither a
base span nor a refused candidate of their own kind.  Refused are only candidates that reached the check: 16 to 19
digits with a bad Luhn sum, four parts with one over 255, a + and too few or too many digits.

A text is tiled by windows of ``WINDOW`` characters, ``WINDOW // 2`` apart, from its first to
its last character.  Every tag sequence that is kept holds a digit, an ``@`` or a bracketed ``at``
in each span, so a window with none of them is all outside and the network is not run on it.
Emissions of overlapping windows are averaged (near a window's middle they weigh more), and
one Viterbi pass over each connected stretch of windows settles the tags: no window
decides alone.

Defined cases: NULL and empty texts have no spans; a sample without any span trains no model
and leaves the base spans; repeated rows are answered each; a NULL id stays NULL; other
columns are ignored.  Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import over_texts, table

KINDS = ("email", "ip", "card", "phone")
WINDOW = 96
HIDDEN = 16
#: What the network tells apart; the last has no pattern.
ALL_KINDS = (*KINDS, "secret")
TAGS = 1 + 2 * len(ALL_KINDS)  # outside, then begin and inside of each kind
SAMPLE_ROWS = 400
STEPS = 240
#: Rewritten copies of each text of the sample.
COPIES = 3

_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local = re.compile(r"[A-Za-z0-9._%+-]")
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_worth = re.compile(r"[0-9@]|[(\[]at[)\]]")
_secret = re.compile(r"""(?i:token|secret|passw\w*|api[_-]?key)["']?\s*[=:]\s*["']?([A-Za-z0-9_+/-]{16,})""")

# years from one to another, dates, book numbers
_numbered = re.compile(r"(?:1[89]|20)\d\d ?[-/] ?(?:1[89]|20)\d\d$|(?:1[89]|20)\d\d([-./])\d\d?\1\d\d?$|97[89]-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterable[Span]:
    """Linear in the text: each ``@`` is met once, its local part reaches back to the last match at most."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _local.match(text, start - 1):
            start -= 1
        found = _domain.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield "email", start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans that hold, and candidates that reached their kind's check and were refused by it."""
    if not _worth.search(text):
        return [], []
    good, refused = list(_emails(text)), []
    for m in _ip.finditer(text):
        fine = all(int(p) <= 255 if len(p) < 10 else int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split("."))
        (good if fine else refused).append(("ip", m.start(), m.end()))
    for m in _card.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19:
            (good if luhn(digits) else refused).append(("card", m.start(), m.end()))
    for m in _phone.finditer(text):
        n = len(re.sub("[^0-9]", "", m.group()))
        (good if 8 <= n <= 15 else refused).append(("phone", m.start(), m.end()))
    return good, refused


# -- the network ---------------------------------------------------------------------

_SPECIAL = "@._%+-()[]:;=\"'/,\n\t #*&$"
SYMBOLS = 6 + len(_SPECIAL)


def _char_table() -> np.ndarray:
    """Class of each ASCII character: 0 padding, 1 other, 2 lower, 3 upper, 4 digit, 5 beyond ASCII, then specials."""
    out = np.ones(129, np.int64)
    for i in range(128):
        c = chr(i)
        out[i] = (2 if c.islower() else 3 if c.isupper() else 4 if c.isdigit()
                  else 6 + _SPECIAL.index(c) if c in _SPECIAL else 1)
    out[128] = 5
    return out


_CHARS = _char_table()


def char_classes(text: str) -> np.ndarray:
    return _CHARS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]


def _allowed() -> np.ndarray:
    """Transitions that make sense: inside only after begin or inside of the same kind."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(ALL_KINDS)):
        begin, inside = 1 + 2 * k, 2 + 2 * k
        out[:, inside] = -1e4
        out[begin, inside] = out[inside, inside] = 0
    return out


ALLOWED = _allowed()
START = np.where([t > 0 and t % 2 == 0 for t in range(TAGS)], -1e4, 0.0)


def new_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {}
    for side in "lr":
        out["x" + side] = rng.normal(0, 0.3, (SYMBOLS, 4 * HIDDEN))
        out["h" + side] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        out["b" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    out["v"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS))
    out["c"] = np.zeros(TAGS)
    out["t"] = np.zeros((TAGS, TAGS))
    return out


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _lstm(ids, w, side):
    """Hidden states over [batch, time], with what the backward pass needs."""
    n, steps = ids.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    states, memo = np.zeros((n, steps, HIDDEN)), []
    for t in range(steps) if side == "l" else range(steps - 1, -1, -1):
        z = w["x" + side][ids[:, t]] + h @ w["h" + side] + w["b" + side]
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before, last = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        states[:, t] = h
        memo.append((t, i, f, o, g, before, last, tc))
    return states, memo


def _lstm_back(ids, w, side, memo, d_states, grads):
    n = len(ids)
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    for t, i, f, o, g, before, last, tc in reversed(memo):
        dh = dh + d_states[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                             dc * i * (1 - g * g)], 1)
        np.add.at(grads["x" + side], ids[:, t], dz)
        grads["h" + side] += last.T @ dz
        grads["b" + side] += dz.sum(0)
        dh, dc = dz @ w["h" + side].T, dc * f


def emissions(ids, w):
    left, ml = _lstm(ids, w, "l")
    right, mr = _lstm(ids, w, "r")
    states = np.concatenate([left, right], 2)
    return states @ w["v"] + w["c"], states, (ml, mr)


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def loss_and_gradients(ids, tags, w):
    """CRF negative log-likelihood per window and its gradients."""
    e, states, (ml, mr) = emissions(ids, w)
    n, steps, _ = e.shape
    trans = w["t"] + ALLOWED
    alpha = np.zeros_like(e)
    beta = np.zeros_like(e)
    alpha[:, 0] = e[:, 0] + START
    for t in range(1, steps):
        alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + trans, 1) + e[:, t]
    for t in range(steps - 2, -1, -1):
        beta[:, t] = _logsum((beta[:, t + 1] + e[:, t + 1])[:, None, :] + trans, 2)
    z = _logsum(alpha[:, -1], 1)
    rows = np.arange(n)
    gold = e[rows[:, None], np.arange(steps), tags].sum(1) + trans[tags[:, :-1], tags[:, 1:]].sum(1)
    d_e = np.exp(alpha + beta - z[:, None, None])
    d_e[rows[:, None], np.arange(steps), tags] -= 1
    d_t = np.zeros_like(trans)
    for t in range(1, steps):
        d_t += np.exp(alpha[:, t - 1, :, None] + trans + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]).sum(0)
    np.add.at(d_t, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    grads["t"] = d_t / n
    d_e /= n
    grads["v"] = np.einsum("nth,ntk->hk", states, d_e)
    grads["c"] = d_e.sum((0, 1))
    d_states = d_e @ w["v"].T
    _lstm_back(ids, w, "l", ml, d_states[:, :, :HIDDEN], grads)
    _lstm_back(ids, w, "r", mr, d_states[:, :, HIDDEN:], grads)
    return float((z - gold).mean()), grads


def tag_row(n: int, spans: Iterable[Span]) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for kind, a, b in spans:
        if not out[a:b].any():
            k = ALL_KINDS.index(kind)
            out[a:b] = 2 + 2 * k
            out[a] = 1 + 2 * k
    return out


def active_windows(text: str) -> list[int]:
    """Starts of the tiling windows that hold a digit or an @."""
    half = WINDOW // 2
    last = max(0, -(-(len(text) - WINDOW) // half))
    out = set()
    for m in _worth.finditer(text):
        at = m.start() // half
        out.update(k for k in (at - 1, at) if 0 <= k <= last)
        if at > last:
            out.add(last)
    return sorted(k * half for k in out)


# -- labelled spans beyond the patterns -------------------------------------------------

def labelled(text: str) -> list[Span]:
    """Base spans and the secrets that are named as such."""
    return base_spans(text)[0] + [("secret", m.start(1), m.end(1)) for m in _secret.finditer(text)]


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _card_digits(rng) -> str:
    head = _digits(rng, 15)
    return next(head + d for d in "0123456789" if luhn(head + d))


def _groups(text: str, size: int, mark: str) -> str:
    return mark.join(text[i:i + size] for i in range(0, len(text), size))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = ("0123456789abcdef", _LETTERS + _LETTERS.upper() + "0123456789", _LETTERS.upper() + "0123456789",
              _LETTERS + _LETTERS.upper() + "0123456789_-")


def _pick(rng, options):
    return options[int(rng.integers(0, len(options)))]


def rewritten(kind: str, value: str, rng) -> str:
    """Another way to write personal data of a kind, which the patterns miss."""
    if kind == "email":
        name, _, host = value.partition("@")
        return _pick(rng, [f"{name} [at] {host}", f"{name}(at){host}", f"{name} (at) {host}", f"{name} @ {host}",
                           f"{name}@{host.replace('.', '[.]')}"])
    if kind == "ip":
        parts = [str(x) for x in rng.integers(1, 255, 4)]
        return _pick(rng, ["[.]", " . ", "(.)"]).join(parts)
    if kind == "card":
        return _groups(_card_digits(rng), 4, _pick(rng, [".", "/", " - ", "_", "  "]))
    if kind == "phone":
        a, b, c, d = _digits(rng, 2), _digits(rng, 3), _digits(rng, 4), _digits(rng, 4)
        return _pick(rng, [f"(0{a}) {c} {d}", f"{b}-{_digits(rng, 3)}-{d}", f"{b}.{_digits(rng, 3)}.{d}", f"0{a} {c} {d}",
                           f"({b}) {_digits(rng, 3)}-{d}", f"00{a} {b} {c}{a}", f"0{a}/{c}{b}", f"0{b}-{c}{b}"])
    n = int(rng.integers(20, 65))
    return "".join(_pick(rng, letters) for letters in [_pick(rng, _ALPHABETS)] for _ in range(n))


def harmless(rng) -> str:
    """Digits that are no personal data."""
    y, m, d = int(rng.integers(1900, 2100)), int(rng.integers(1, 13)), int(rng.integers(1, 29))
    return _pick(rng, [f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{m:02}/{d:02}/{y}", f"{d:02}:{m:02}:{d:02}", f"{y}-{y + 6}",
                       f"{_digits(rng, 1)},{_digits(rng, 3)}.{_digits(rng, 2)}", f"v{m}.{d}.{m}", f"No. {_digits(rng, 5)}", str(y),
                       f"{_digits(rng, 3)} {_digits(rng, 3)} km", f"978-{_digits(rng, 1)}-{_digits(rng, 4)}-{_digits(rng, 4)}-{_digits(rng, 1)}",
                       f"{d} {m} {y}", f"{_digits(rng, 2)}%", f"{_digits(rng, 6)}", f"p. {d}-{d + m}", f"{_digits(rng, 16)}"])


def varied(text: str, rng) -> tuple[str, list[Span]]:
    """A copy of a text in which labelled spans are rewritten, replaced by harmless numbers, or stay; with its labels."""
    out, spans, done, size = [], [], 0, 0
    for kind, a, b in sorted(labelled(text), key=lambda s: s[1]):
        if a < done:
            continue
        value, new_kind = text[a:b], kind
        roll = rng.random()
        if roll < 0.55:
            value = rewritten(kind, value, rng)
        elif roll < 0.7:
            new_kind = "secret"
            value = rewritten("secret", "", rng)
        elif roll < 0.9:
            value, new_kind = harmless(rng), None
        lead = _pick(rng, ["key: ", 'token = "', "secret=", "api_key: "]) if new_kind == "secret" != kind else ""
        out += [text[done:a], lead]
        size += a - done + len(lead)
        if new_kind:
            spans.append((new_kind, size, size + len(value)))
        out.append(value)
        size, done = size + len(value), b
    return "".join(out) + text[done:], spans


def training_windows(texts: list[str], copies: int = COPIES, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags of the texts, and of copies that are written in other ways."""
    rng, ids, tags = np.random.default_rng(seed), [], []
    many = [(t, labelled(t)) for t in texts]
    many += [varied(t, rng) for _ in range(copies) for t, spans in many[:len(texts)] if spans]
    for text, spans in many:
        classes, row = char_classes(text), tag_row(len(text), spans)
        for start in active_windows(text):
            pad = max(0, start + WINDOW - len(text))
            t = np.pad(row[start:start + WINDOW], (0, pad))
            if t[0] and t[0] % 2 == 0:  # a span cut by the window's edge begins there
                t[0] -= 1
            ids.append(np.pad(classes[start:start + WINDOW], (0, pad)))
            tags.append(t)
    if not ids:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.stack(ids), np.stack(tags)


def fit(texts: list[str], steps: int = STEPS, seed: int = 7, rate: float = 0.02, batch: int = 48):
    """Weights learned with Adam from the labelled spans of these texts and their copies; None if they hold none."""
    ids, tags = training_windows(texts)
    if not tags.any():
        return None
    rng = np.random.default_rng(seed)
    w = new_weights(seed)
    # windows are drawn alike from each kind, and from those without a span
    kinds = [np.flatnonzero(found) for k in range(len(ALL_KINDS))
             for found in [(tags == 1 + 2 * k).any(1)] if found.any()]
    if not tags.any(1).all():
        kinds.append(np.flatnonzero(~tags.any(1)))
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(k, -(-batch // len(kinds))) for k in kinds])
        _, grads = loss_and_gradients(ids[pick], tags[pick], w)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return w


def viterbi(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of padded stretches [batch, time, tag]."""
    n, steps, _ = e.shape
    score = e[:, 0] + START
    back = np.zeros((n, steps, TAGS), np.int8)
    for t in range(1, steps):
        ways = score[:, :, None] + trans
        back[:, t] = ways.argmax(1)
        score = np.where((t < lengths)[:, None], ways.max(1) + e[:, t], score)
    out = np.zeros((n, steps), np.int64)
    tag = score.argmax(1)
    rows = np.arange(n)
    for t in range(steps - 1, -1, -1):
        inside = t < lengths
        out[inside, t] = tag[inside]
        if t:
            tag = np.where(inside, back[rows, t, tag], tag)
    return out


def model_spans(texts: list[str], w) -> list[list[Span]]:
    """Spans by the network alone, for each text."""
    out: list[list[Span]] = [[] for _ in texts]
    stretches, ids, places = [], [], []  # stretch: text, start, end
    for number, text in enumerate(texts):
        starts = active_windows(text) if text else []
        if not starts:
            continue
        classes = char_classes(text)
        for start in starts:
            end = min(start + WINDOW, len(text))
            if stretches and stretches[-1][0] == number and start <= stretches[-1][2]:
                stretches[-1][2] = max(stretches[-1][2], end)
            else:
                stretches.append([number, start, end])
            ids.append(np.pad(classes[start:end], (0, start + WINDOW - end)))
            places.append((len(stretches) - 1, start))
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)
    sums = [np.zeros((b - a, TAGS)) for _, a, b in stretches]
    shares = [np.zeros(b - a) for _, a, b in stretches]
    for at in range(0, len(ids), 512):
        e, _, _ = emissions(np.stack(ids[at:at + 512]), w)
        for one, (s, start) in zip(e, places[at:at + 512], strict=True):
            a = start - stretches[s][1]
            n = min(WINDOW, len(shares[s]) - a)
            sums[s][a:a + n] += one[:n] * weight[:n, None]
            shares[s][a:a + n] += weight[:n]
    order = sorted(range(len(stretches)), key=lambda s: len(shares[s]))
    trans = w["t"] + ALLOWED
    while order:
        group = [order.pop()]
        room = 200_000 // len(shares[group[0]])
        while order and len(group) < room:
            group.append(order.pop())
        lengths = np.array([len(shares[s]) for s in group])
        e = np.zeros((len(group), lengths.max(), TAGS))
        for i, s in enumerate(group):
            e[i, :lengths[i]] = sums[s] / shares[s][:, None]
        for i, tags in enumerate(viterbi(e, lengths, trans)):
            number, a, _ = stretches[group[i]]
            out[number] += _spans_of(tags[:lengths[i]], a, texts[number])
    return out


def _spans_of(tags: np.ndarray, offset: int, text: str) -> list[Span]:
    found, t = [], 0
    while t < len(tags):
        if tags[t] == 0:
            t += 1
            continue
        k = (tags[t] - 1) // 2
        end = t + 1
        while end < len(tags) and tags[end] == 2 + 2 * k:
            end += 1
        piece = text[offset + t:offset + end]
        a = offset + t + len(piece) - len(piece.lstrip())
        b = offset + end - len(piece) + len(piece.rstrip())
        kind = ALL_KINDS[k]
        if _sound(kind, text[a:b]):
            found.append((kind, a, b))
        t = end
    return found


def _sound(kind: str, value: str) -> bool:
    """What any span of a kind has to be, whoever found it."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        return len(value) >= 6 and bool(re.search(r"@|[(\[]at[)\]]", value))
    if kind == "ip":
        parts = re.findall("[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and not re.search("[A-Za-z]", value) and not _numbered.match(value)
    return len(value) >= 16 and not re.search(r"\s", value) and bool(digits) and bool(re.search("[A-Za-z]", value))


def all_spans(texts: list[str], w) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans of each text, both in the order of kinds and starts."""
    base, refused = zip(*[base_spans(t) for t in texts], strict=True) if texts else ((), ())
    added = model_spans(texts, w) if w is not None else [[] for _ in texts]
    order = lambda spans: sorted(spans, key=lambda s: (ALL_KINDS.index(s[0]), s[1]))
    out = []
    for b, r, more in zip(base, refused, added, strict=True):
        new = [s for s in more if all(s[2] <= a or s[1] >= e for _, a, e in b)
               and all(s[0] != k or s[2] <= a or s[1] >= e for k, a, e in r)]
        out.append(order(b + new))
    return [order(b) for b in base], out


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first decides."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def train(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS, sample_chars: int = 50_000):
    """Weights from at most ``sample_rows`` rows with a digit or an @: those with the least hash of their text.

    The sample is bounded as the labels come from rules: more rows would repeat them.  Texts of
    over ``sample_chars`` characters are not drawn, so the sample's size is bounded too.
    """
    used = df.select(F.col(f"`{text}`").alias("text")).where(
        (F.length("text") <= sample_chars) & F.col("text").rlike("[0-9@]"))
    hashed = used.select(F.xxhash64("text").alias("h"), "text")
    least = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(sample_rows).collect()]  # hashes only
    if not least:
        return None
    drawn = hashed.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("text").alias("text"))
    return fit([r.text for r in sorted(drawn.collect())])


def find(df: DataFrame, weights, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of base spans, digest of them, all spans."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def each(rows):
        base, spans = all_spans([t or "" for t in rows["text"]], shared.value)
        out = {"doc_id": rows["doc_id"],
               "base_sha256": [hashlib.sha256(as_text(b).encode()).hexdigest() for b in base],
               "spans": [as_text(s) for s in spans]}
        return out | {f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS}

    return over_texts(df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                      "text", each, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                      "base_sha256 string, spans string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    return find(docs, train(docs))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked; ``n_chars`` is that of the new text."""
    shared = spark.sparkContext.broadcast(train(docs))

    def each(rows):
        texts = [t or "" for t in rows["text"]]
        _, spans = all_spans(texts, shared.value)
        masked = [mask(t, s) if s else o for t, s, o in zip(texts, spans, rows["text"], strict=True)]
        return rows | {"text": masked, "n_chars": [n if not s else len(m) for n, s, m in
                                                   zip(rows["n_chars"], spans, masked, strict=True)]}

    used = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return over_texts(used, "text", each, used.schema)
