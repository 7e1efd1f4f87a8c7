"""Personal data: exact base patterns, and secrets by a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: In the order of results; the last is what the random field adds.
KINDS = ("email", "ip", "card", "phone", "secret")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")  # a run of digits that fails at its start fails everywhere
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# runs without white space, brackets, quotes and the signs of an assignment; marks that end a sentence belong to a run only inside it
_OUT = r"\s\"'`=:,;()\[\]{}<>|&"
_TOKEN = re.compile(rf"[^{_OUT}.!?]+(?:[.!?]++[^{_OUT}.!?]+)*|[.!?]+|\S")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    """At most 255; leading zeros, however many, count nothing."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, without those that fail its check."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:  # a match starts where the run of local characters before its @ does
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            out.append(("email", start, free))
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        if text.count(".") > 2:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# --- the random field

LABELS = ("other", "key", "secret")
#: Words that announce a secret in the labelled table's rule and as a feature.
KEY_WORDS = frozenset(
    "api apikey auth authorization bearer credential credentials key pass passphrase passwd password pw pwd secret token "
    "geheimnis kennwort passwort zugangscode clave contrasena contraseña jeton mdp passe".split()
)
_KEY_PART = re.compile("api|auth|bearer|cred|key|pass|pwd?|secret|token|geheim|kennw|code|clave|contrase|jeton|mdp", re.I)
_PARTS = re.compile(r"[\W_]+|(?<=[a-z0-9])(?=[A-Z])")
#: Signs that are features by themselves.
_SIGNS = ("=", ":", '"', "'", ">", "<")
#: Tokens whose numbers a worker keeps, of this many characters at most.
CACHE_TOKENS, CACHED_TOKEN = 100_000, 80
#: Tokens of the lines that are decoded at once, or side by side at the length of the longest.
HELD_TOKENS = 100_000
#: How far before a token a key word counts.
NEAR = 5
_BUCKETS = (1, 2, 4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 40, 64)
_CHANGES = (1, 2, 3, 5, 8, 12)
_CHANGE = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def has_digit(token: str) -> bool:
    return _DIGIT.search(token) is not None


def shape(token: str) -> str:
    """A token's character classes; a single sign stands for itself."""
    plain = token.isalnum()
    if not plain and not any(c.isalnum() for c in token):
        return f"s:{token if token in _SIGNS else '.'}"
    upper, lower = token != token.lower(), token != token.upper()
    hexed = "x" if len(token) >= 12 and _HEX.fullmatch(token) else ""
    return f"s:{'A' if upper else ''}{'a' if lower else ''}{'9' if has_digit(token) else ''}{'' if plain else '-'}{hexed}"


def key_word(token: str) -> str:
    """The last part of a token's name that announces a secret; empty if none does."""
    if not _KEY_PART.search(token):
        return ""
    return next((p for p in reversed([x.lower() for x in _PARTS.split(token)]) if p in KEY_WORDS), "")


def own_features(token: str) -> tuple[str, ...]:
    """What a token says of itself: classes, length, how often classes change, and its key word or else a long one's beginning."""
    kinds = shape(token)
    if kinds.startswith("s:") and not any(c.isalnum() for c in token):
        return kinds, "z:", "c:", "t:", "w:"
    size = bisect_right(_BUCKETS, len(token))
    changes = bisect_right(_CHANGES, len(_CHANGE.findall(token)))
    key = key_word(token)
    word = f"w:{key}" if key else f"p:{token[:4].lower()}" if len(token) >= 16 and changes else "w:"
    return kinds, f"z:{size}", f"c:{kinds[2:]}:{size}", f"t:{changes}:{'9' in kinds}", word


def before(token: str) -> str:
    """What a token is to the next one."""
    return shape(token)[2:] if not any(c.isalnum() for c in token) else "w"


#: All that a token can be to the next one, the start of a line first.
_BEFORE = ("^", "w", ".", *_SIGNS)


def token_features(tokens: list[str], i: int) -> tuple[str, ...]:
    last = before(tokens[i - 1]) if i else "^"
    near = next((n for n in range(1, min(NEAR, i) + 1) if key_word(tokens[i - n])), 0)
    return *own_features(tokens[i]), f"n:{near}", f"b:{last}:{near}"


class _Codes(dict):
    """Small numbers for tokens, and by number what a token adds to its own score and to the next one's."""

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[tuple, int] = {}
        self.words: dict[tuple, int] = {}
        self.own: list[np.ndarray] = []
        self.before: list[int] = []
        self.key: list[bool] = []

    def __missing__(self, token: str) -> int:
        if token.isalpha() and (token.islower() or token.isupper() or token.istitle()):  # one part, and no change of class
            low = token.lower()
            word = token.islower(), token.isupper(), bisect_right(_BUCKETS, len(token)), len(token) < 12, low if low in KEY_WORDS else ""
            value = self.words.get(word)
            if value is None:
                value = self.words[word] = self._code(token)
        else:
            value = self._code(token)
        if len(token) <= CACHED_TOKEN:
            if len(self) >= CACHE_TOKENS:
                self.clear()
            self[token] = value
        return value

    def _code(self, token: str) -> int:
        own, last = own_features(token), before(token)
        kind = (own, last)
        if kind not in self.known:
            none = np.zeros(len(LABELS))
            self.known[kind] = len(self.own)
            self.own.append(sum((self.field.weights.get(f, none) for f in own), none))
            self.before.append(_BEFORE.index(last))
            self.key.append(own[-1] not in ("w:",) and own[-1].startswith("w:"))
        return self.known[kind]


@dataclass
class Field:
    """Weights of each feature for each label, and of each step from label to label."""

    weights: dict[str, np.ndarray]
    steps: np.ndarray

    def __post_init__(self) -> None:
        self.codes = _Codes(self)

    def emissions(self, flat: list[str], sizes: np.ndarray) -> np.ndarray:
        """Scores of every label for all tokens of lines of these sizes, one after another."""
        code = np.fromiter(map(self.codes.__getitem__, flat), np.int64, len(flat))
        own, last, key = (np.array(x) for x in (self.codes.own, self.codes.before, self.codes.key))
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.flatnonzero(key[code])  # few tokens are key words
        near = np.zeros(len(flat), np.int64)
        for back in range(NEAR, 0, -1):
            to = at + back
            to = to[to < len(flat)]
            near[to[place[to] >= back]] = back
        previous = np.where(place > 0, last[np.concatenate([code[:1], code[:-1]])], 0)
        return own[code] + self._around[previous, near]

    @cached_property
    def _around(self) -> np.ndarray:
        """What the token before and the distance of a key word add."""
        none = np.zeros(len(LABELS))
        return np.array([[self.weights.get(f"n:{n}", none) + self.weights.get(f"b:{b}:{n}", none) for n in range(NEAR + 1)] for b in _BEFORE])

    def plain(self, score: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Lines whose best path certainly is "other" all along.

        A run of other labels than "other" replaces that label's scores and
        steps. It gains at most, for each token, what a label gains with the
        best step to it inside a run; the first token has the step into the run
        instead, or none at the start of the line. So the best sum over a
        stretch of tokens bounds every run.
        """
        step = self.steps - self.steps[0, 0]
        into, leave = step[1:, 1:].max(0), max(0.0, float(step[1:, 0].max()))
        gain = score[:, 1:] - score[:, :1]
        best = (gain + into).max(1)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        apart = np.repeat(np.arange(sizes.size) * (2 * float(np.abs(best).sum()) + 1), sizes)  # a later line's sums lie below all earlier ones
        total = np.cumsum(best) - apart
        before = total - best
        inside = np.maximum.reduceat(total - np.minimum.accumulate(before), starts) + float((step[0, 1:] - into).max())
        first = np.maximum.reduceat(total, starts) - total[starts] + gain[starts].max(1)
        return np.maximum(inside, first) + leave <= -1e-6

    def viterbi(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of every line by its tokens' scores; lines are decoded side by side, a step at a time."""
        if not emissions:
            return []
        order = sorted(range(len(emissions)), key=lambda i: -len(emissions[i]))
        sizes = np.array([len(emissions[i]) for i in order])
        longest, k = int(sizes[0]), len(LABELS)
        emit = np.zeros((len(order), longest, k))
        for row, i in enumerate(order):
            emit[row, : sizes[row]] = emissions[i]
        back = np.zeros((len(order), longest, k), np.int8)
        best = emit[:, 0].copy()
        for t in range(1, longest):
            n = int(np.searchsorted(-sizes, -t, "left"))  # lines longer than t
            ways = best[:n, :, None] + self.steps[None]
            back[:n, t] = ways.argmax(1)
            best[:n] = ways.max(1) + emit[:n, t]
        paths = np.zeros((len(order), longest), np.int8)
        paths[np.arange(len(order)), sizes - 1] = best.argmax(1)
        for t in range(longest - 1, 0, -1):
            n = int(np.searchsorted(-sizes, -t, "left"))
            paths[:n, t - 1] = back[np.arange(n), t, paths[:n, t]]
        out: list[np.ndarray] = [np.zeros(0, int)] * len(order)
        for row, i in enumerate(order):
            out[i] = paths[row, : sizes[row]]
        return out


_LOWER, _UPPER, _DIGITS, _HEXES = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
_MIXED = _LOWER + _UPPER + _DIGITS
# Beginnings by which issued keys are known, with the letters and the length of the rest.
ISSUED = (
    ("AKIA", _UPPER + _DIGITS, 16), ("ASIA", _UPPER + _DIGITS, 16), ("ghp_", _MIXED, 36), ("gho_", _MIXED, 36), ("ghs_", _MIXED, 36), ("github_pat_", _MIXED, 60), ("sk_live_", _MIXED, 24), ("sk_test_", _MIXED, 24),
    ("pk_live_", _MIXED, 24), ("rk_live_", _MIXED, 24), ("xoxb-", _DIGITS + _LOWER, 40), ("xoxp-", _DIGITS + _LOWER, 40), ("AIza", _MIXED + "-_", 35), ("glpat-", _MIXED, 20), ("npm_", _MIXED, 36), ("hf_", _MIXED, 34), ("sk-", _MIXED, 48),
)


class _Labelled:
    """Draws the rows of the labelled table."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.rows: list[tuple[list[str], list[int]]] = []

    def draw(self, letters: str, n: int) -> str:
        return "".join(self.rng.choice(letters) for _ in range(n))

    def some(self, low: int, high: int) -> int:
        return self.rng.randint(low, high)

    def word(self) -> str:
        w = self.draw(_LOWER, self.some(1, 12))
        return w.capitalize() if self.rng.random() < 0.2 else w

    def plain(self, least: int = 0) -> str:
        words = " ".join(self.word() for _ in range(self.some(least, 6)))
        return words + self.rng.choice(("", "", ",", ".")) if words else ""

    def key(self) -> str:
        """The name of a secret as configurations, headers and programs write it."""
        k = self.rng.choice(sorted(KEY_WORDS - {"bearer", "authorization", "api", "auth"}))
        head = self.rng.choice(("", "", "", "my", "db", "access", "client", "user", "aws_secret_access", "api", "auth", self.draw(_LOWER, self.some(2, 8))))
        name = "_".join(x for x in (head, k) if x)
        return self.rng.choice((name, name, name, name.upper(), name.replace("_", "-"), head + k.capitalize() if head else k.capitalize()))

    def value(self) -> str:
        """What stands behind such a name."""
        r = self.rng.random()
        if r < 0.25:
            return self.draw(_HEXES, self.rng.choice((16, 18, 20, 24, 32, 40, 64)))
        if r < 0.41:
            return self.draw(_MIXED, self.some(16, 48))
        if r < 0.48:
            return self.draw(_MIXED + "+/", self.some(24, 64))
        if r < 0.53:
            return "-".join(self.draw(_HEXES, n) for n in (8, 4, 4, 4, 12))
        if r < 0.7:
            return self.draw(self.rng.choice((_LOWER, _LOWER, _LOWER + _UPPER, _UPPER)), self.some(12, self.rng.choice((20, 48, 72))))
        if r < 0.86:  # a password of a person
            body = list(self.draw(_LOWER, self.some(5, 11)) + self.draw(_DIGITS, self.some(1, 4)))
            if self.rng.random() < 0.5:
                body[0] = body[0].upper()
            for _ in range(self.some(0, 2)):
                body.insert(self.some(1, len(body) - 1), self.rng.choice("@#$%^*!-_."))
            while len(body) < 8:
                body.insert(0, self.rng.choice(_LOWER))
            return "".join(body).rstrip(".!") + self.rng.choice(_DIGITS)
        return self.issued()

    def issued(self) -> str:
        if self.rng.random() < 0.15:
            return ".".join(("eyJ" + self.draw(_MIXED, self.some(16, 40)), "eyJ" + self.draw(_MIXED, self.some(20, 90)), self.draw(_MIXED + "-_", 43)))
        start, letters, n = self.rng.choice(ISSUED)
        return start + self.draw(letters, n)

    def add(self, *parts: tuple[str, int]) -> None:
        """A row of texts, each with the label of its tokens."""
        tokens, labels = [], []
        for text, label in parts:
            own = _TOKEN.findall(text)
            tokens += own
            labels += [label] * len(own)
        if tokens:
            self.rows.append((tokens, labels))

    def told(self) -> str:
        """How prose in one of four languages leads up to a secret."""
        w, choose = self.word(), self.rng.choice
        noun = choose(("password", "password", "passphrase", "token", "secret", "pw", "api key", "access token", "credential"))
        return choose((
            f"{choose(('the', 'my', 'new', 'your', 'our'))} {noun} is ", f"{choose(('the ', '', 'my '))}{noun} for {choose(('the ', '', 'our '))}{w} {choose(('is', 'was', 'is now'))} ", f"I set my {noun} to ", f"changed {choose(('the', 'your', 'his'))} {noun} to ", f"log in with {choose(('the ', ''))}{noun} ",
            f"{choose(('das', 'mein', 'dein', 'Das'))} {choose(('Passwort', 'Kennwort'))} {choose(('ist', 'lautet'))} ", f"das {choose(('Passwort', 'Kennwort'))} für {choose(('den', 'die', 'das'))} {w} {choose(('ist', 'lautet'))} ", f"{choose(('le', 'mon', 'votre'))} mot de passe {choose(('', f'du {w} ', f'pour {w} '))}est ",
            f"{choose(('la', 'mi', 'tu'))} {choose(('contraseña', 'clave'))} {choose(('', f'del {w} ', f'de {w} '))}es ",
        ))

    def announced(self) -> None:
        a, b, q = self.plain(), self.plain(), self.rng.choice(("", "", '"', "'"))
        value, key = self.value(), self.key()
        r = self.rng.random()
        if r < 0.62:
            lead = key + self.rng.choice(("=", " = ", ":", ": ", " : ", ":=", " => "))
            lead = self.rng.choice(("", "", "", "export ", "- ", "#")) + lead
        elif r < 0.7:
            lead, q = self.rng.choice(("Authorization: Bearer ", "authorization: bearer ", "Authorization: Basic ", "Bearer ", '-H "Authorization: Bearer ', "Authorization=Bearer ")), ""
        elif r < 0.76:
            lead, q, b = f'{{"{key}": "', "", f'", "{self.word()}": 1}}'
        elif r < 0.81:
            lead, q, b = f"https://{self.draw(_LOWER, 6)}.example.com/{self.word()}?{self.rng.choice(('', 'a=1&'))}{key}=", "", f"&{self.word()}=1"
        elif r < 0.85:
            lead, q, b = f"<{key}>", "", f"</{key}>"
        else:
            lead = self.told()
            while value.isalpha():  # a sentence may go on with any long word
                value = self.value()
        self.add((a, 0), (lead, 1), (q, 1), (value, 2), (q, 0), (" " + b, 0))

    def alike(self) -> str:
        """What looks like a secret, or stands where one could."""
        d, w = self.draw, self.word
        return self.rng.choice((
            d(_DIGITS, self.rng.choice((1, 2, 4, 16, 19))), f"{d(_DIGITS, 3)}-{d(_DIGITS, 4)}", f"({d(_DIGITS, 3)}) {d(_DIGITS, 3)}-{d(_DIGITS, 4)}", f"+1 {d(_DIGITS, 3)} {d(_DIGITS, 7)}", d(_LOWER, 5) + d(_DIGITS, 2), d(_LOWER, self.some(3, 12)) + d(_DIGITS, self.some(1, 4)), w() + d(_DIGITS, self.some(1, 4)), f"{w()}{d(_DIGITS, self.some(1, 3))}{w().capitalize()}{w().capitalize()}",
            f"{d(_LOWER, 6)}.{d(_DIGITS, 2)}@mail{d(_DIGITS, 1)}.example.com", f"{d(_UPPER, 2)}-{d(_UPPER, 2)} {d(_DIGITS, 1)}.{d(_DIGITS, 1)}", f"{d(_DIGITS, 4)}-{d(_DIGITS, 2)}-{d(_DIGITS, 2)}", f"v{d(_DIGITS, 1)}.{d(_DIGITS, 2)}.{d(_DIGITS, 1)}",
            f"https://www.{d(_LOWER, 8)}.org/{w()}/{w()}-{w()}-{w()}.html", f"/usr/{w()}/{w()}.{d(_LOWER, 2)}", f"{w()}_{w()}_{w()}", f"{d(_LOWER, 5)}{w().capitalize()}{w().capitalize()}", d(_HEXES, 40), d(_HEXES, 32), "-".join(d(_HEXES, n) for n in (8, 4, 4, 4, 12)),
            ".".join(str(self.some(0, 255)) for _ in range(4)), f"{d(_UPPER, 3)}{d(_DIGITS, 4)}", f"{d(_DIGITS, 2)}:{d(_DIGITS, 2)}", "###", "$$$", "&&&", "***", f"{w()}$$$", f"{w()}...", f"{d(_DIGITS, 1)}.{d(_DIGITS, 3)},{d(_DIGITS, 2)} EUR", f"{d(_LOWER, 4)}-{d(_DIGITS, 6)}",
        ))

    def long(self) -> str:
        x = self.draw(_LOWER, self.some(12, 28))
        return self.rng.choice((x, x, x.capitalize(), x.upper(), f"{x[:6]}{x[6:].capitalize()}", f"{x[:8]}-{x[8:]}", f"{x[:6]}/{x[6:]}", f"{x[:6]}_{x[6:]}"))

    def harmless(self) -> None:
        a, b, r = self.plain(), self.plain(), self.rng.random()
        key = self.rng.choice(sorted(KEY_WORDS))
        short = self.rng.choice((self.draw(_LOWER, self.some(1, 11)), self.draw(_DIGITS, self.some(1, 5)), self.draw(_LOWER, 4) + self.draw(_DIGITS, 1), "null", "true", "None", "required", "***", "<none>", "${" + self.draw(_UPPER, 6) + "}"))
        self.add((self.rng.choice((
            f"{a} {self.alike()} {b}", f"{a} {self.alike()} {b}", f"{a} {self.rng.choice(('', '', 'name = ', 'see: ', 'id=', 'at: '))}{self.alike()} {b}", f"{a} {self.long()} {b}", f"{a} {self.rng.choice(('', 'name = ', 'see: ', 'title: '))}{self.long()} {b}",
            f"{a} {key} {self.rng.choice(('=', ':', 'is', ': ', 'the', 'words:', key, ''))} {short} {b}", f"{a} {key}{self.rng.choice('=:')}{short} {b}", f"{a} {key} {self.rng.choice(('', 'the ', 'words: '))}{self.long()} {b}", f"{self.plain(1)} {self.plain(1)} {self.plain(1)}", f"The {key} {self.rng.choice(('is', 'of', 'was'))} {b}", f"{a} {self.told()}{self.rng.choice((short, short, self.word(), self.long(), self.long(), self.draw(_LOWER, self.some(3, 11)), ''))} {b}",
        )) if r else a, 0))


def labelled_table(seed: int = 7, rows: int = 4000) -> list[tuple[list[str], list[int]]]:
    """A small labelled table of lines: announced and issued secrets, and what only looks like them."""
    table = _Labelled(seed)
    while len(table.rows) < rows:
        table.announced()
        table.harmless()
        table.harmless()
        if len(table.rows) % 2:
            table.add((table.plain(), 0), (table.rng.choice(("", "", '"')), 0), (table.issued(), 2), (" " + table.plain(), 0))
    return table.rows


def train(rows: list[tuple[list[str], list[int]]], *, rounds: int = 60, ridge: float = 0.02) -> Field:
    """Penalised maximum likelihood: forward-backward expectations, and Adam's steps on the gradient."""
    names: dict[str, int] = {}
    data = []
    for tokens, labels in rows:
        ids = np.array([[names.setdefault(f, len(names)) for f in token_features(tokens, i)] for i in range(len(tokens))])
        data.append((ids, np.array(labels)))
    data.sort(key=lambda d: -len(d[1]))
    k, each = len(LABELS), data[0][0].shape[1]
    n = len(names)
    w = np.zeros((n + k, k))  # the last k rows are the steps
    m, v = np.zeros_like(w), np.zeros_like(w)
    size = np.array([len(x) for _, x in data])
    longest = int(size.max())
    ids = np.zeros((len(data), longest, each), int)
    gold, live = np.zeros((len(data), longest), int), np.arange(longest) < size[:, None]
    for r, (x, y) in enumerate(data):
        ids[r, : len(y)], gold[r, : len(y)] = x, y

    kinds, kind = np.unique(ids.reshape(-1, each), axis=0, return_inverse=True)  # few tokens differ in their features
    kind = kind.reshape(len(data), longest)

    def gathered(share: np.ndarray) -> np.ndarray:
        """Sums of the tokens' shares of every label by feature."""
        own = [np.bincount(kind.ravel(), share[..., y].ravel(), len(kinds)) for y in range(k)]
        return np.stack([sum(np.bincount(kinds[:, j], x, n) for j in range(each)) for x in own], 1)

    seen = np.zeros_like(w)
    seen[:n] = gathered(np.eye(k)[gold] * live[..., None])
    np.add.at(seen, (n + gold[:, :-1][live[:, 1:]], gold[:, 1:][live[:, 1:]]), 1)

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    lines, count = np.arange(len(data)), [int(np.count_nonzero(size > t)) for t in range(longest)]  # the longest lines come first
    for step in range(1, rounds + 1):
        emit, steps = w[kinds].sum(1)[kind], w[n:]
        fore, aft = np.zeros_like(emit), np.zeros_like(emit)
        fore[:, 0] = emit[:, 0]
        for t in range(1, longest):
            c = count[t]
            fore[:c, t] = lse(fore[:c, t - 1, :, None] + steps, 1) + emit[:c, t]
        total = lse(fore[lines, size - 1], 1)
        want = np.zeros_like(w)
        for t in range(longest - 2, -1, -1):
            c = count[t + 1]
            ahead = steps + (emit[:c, t + 1] + aft[:c, t + 1])[:, None]
            aft[:c, t] = lse(ahead, 2)
            want[n:] += np.exp(fore[:c, t, :, None] + ahead - total[:c, None, None]).sum(0)
        want[:n] = gathered(np.exp(np.where(live[..., None], fore + aft - total[:, None, None], -np.inf)))
        grad = (seen - want) - ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w += 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field({f: w[i] for f, i in names.items()}, w[n:])


@cache
def default_field() -> Field:
    return train(labelled_table(), rounds=100)


def secret_spans(field: Field, texts: list[str]) -> list[list[Span]]:
    """Of every text the tokens that the field labels secret, decoded line by line."""
    out: list[list[Span]] = [[] for _ in texts]
    flat: list[str] = []
    sizes: list[int] = []
    places: list[tuple[int, int, str]] = []  # text, where the line starts in it, the line

    def decode() -> None:
        if not flat:
            return
        n = np.array(sizes)
        score = field.emissions(flat, n)
        ends = np.cumsum(n)
        lines = np.flatnonzero(~field.plain(score, n))
        lines = lines[np.argsort(-n[lines], kind="stable")].tolist()  # lines of like lengths side by side
        first = 0
        while first < len(lines):
            group = lines[first : first + max(1, HELD_TOKENS // sizes[lines[first]])]
            first += len(group)
            for g, labels in zip(group, field.viterbi([score[ends[g] - n[g] : ends[g]] for g in group]), strict=True):
                if (labels == 2).any():
                    i, at, line = places[g]
                    found = [m.span() for m in _TOKEN.finditer(line)]
                    out[i] += [("secret", at + found[j][0], at + found[j][1]) for j in np.flatnonzero(labels == 2).tolist()]
        flat.clear()
        sizes.clear()
        places.clear()

    for i, text in enumerate(texts):
        at = 0
        for line in text.split("\n"):
            if found := _TOKEN.findall(line):
                flat += found
                sizes.append(len(found))
                places.append((i, at, line))
                if len(flat) >= HELD_TOKENS:
                    decode()
            at += len(line) + 1
    decode()
    return [_joined(sorted(spans, key=lambda s: s[1])) for spans in out]


def _joined(spans: list[Span]) -> list[Span]:
    """Spans that touch as one."""
    out: list[Span] = []
    for kind, a, b in spans:
        if out and out[-1][2] == a:
            out[-1] = (kind, out[-1][1], b)
        else:
            out.append((kind, a, b))
    return out


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, apart from each other and in order."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that share no character with any of base, each looked up once."""
    starts, ends = _covered(base)

    def meets(s: Span) -> bool:
        i = bisect_right(ends, s[1])
        return i < len(ends) and starts[i] < s[2]

    return [s for s in spans if not meets(s)]


def find(field: Field, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Of every text its base spans, and all spans: base ones and the secrets that touch none of them."""
    out = []
    for text, secrets in zip(texts, secret_spans(field, texts), strict=True):
        base = base_spans(text)
        out.append((base, base + apart(secrets, base)))
    return out


def _found(field: Field, clean: bool):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.alone("personal data", field.codes.clear)
        for b in common.slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            rows = find(field, texts)
            out = [b.column("_row"), b.column("text"), *(pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in r[k]] for r in rows], kind) for k in (0, 1))]
            if clean:
                out.append(pa.array([None if not known else redact(t, r[1]) for known, t, r in zip(b.column("text").is_valid().to_pylist(), texts, rows, strict=True)], pa.string()))
            yield pa.record_batch(out, ["_row", "text", "base", "spans", *["clean"] * clean])
        common.settle()

    return run


_SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))


def personal_data(docs: DataFrame, *keep: str, field: Field | None = None, clean: bool = False) -> DataFrame:
    """The columns keep and text of every row of docs, with base and spans; if asked for, also clean, the redacted text.

    Both are arrays of (kind, start, end), by kind and then by start, in code
    points, end exclusive. base holds the exact patterns' matches, spans also
    the secrets that the random field finds. A null text has none, repeated rows
    get equal ones, an empty table gives no rows, and columns called base or
    spans are replaced.
    """
    common.ship(docs.sparkSession)
    own = ("text", "base", "spans", *["clean"] * clean)
    keep = tuple(c for c in keep if c not in own)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "text")
    out = T.StructType(list(rows.schema.fields)).add("base", _SPANS).add("spans", _SPANS)
    out = out.add("clean", "string") if clean else out
    return rows.mapInArrow(_found(field or default_field(), clean), out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), *own)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced by its first span's kind, in time linear in both."""
    pieces: list[str] = []
    at = 0
    for start, end, kind in sorted((a, b, kind) for kind, a, b in spans):
        if start >= at:
            pieces += (text[at:start], f"<{kind.upper()}>")
        at = max(at, end)
    return "".join((*pieces, text[at:]))


def redacted(text, spans):
    """The text with every span's characters replaced by its kind in angle brackets; overlapping ones by the first, at a tie the shorter.

    A null text stays null, one without spans or with null spans stays as it is.
    A text is cut once, so many spans in a long text cost no more than their
    number and its length.
    """

    @F.arrow_udf("string")
    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for part in (slice(i, i + 512) for i in range(0, len(texts), 512)):
            for t, own in zip(texts[part].to_pylist(), found[part].to_pylist(), strict=True):
                out.append(redact(t, [(s["kind"], s["start"], s["end"]) for s in own]) if t and own else t)
        return pa.array(out, pa.string())

    return clean(text, spans)


def joined(spans):
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
