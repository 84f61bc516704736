"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The field tags each token of a line as begin, inside or outside of a secret.
Its features are the token's shape, the roles of the words around it, and what
the file as a whole looks like; the best tags of a line are found by Viterbi.
It learns from lines that the patterns mark in a bounded sample of the texts
and from made-up lines of usual forms, so it also finds secrets that no pattern
covers.

Most lines need no search. A token whose largest possible gain over "outside"
is not positive, whatever stands around it, cannot be in a secret; a line of
such tokens is outside throughout. This is a bound, not a guess: the tags are
those of the full search.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import map_rows

# The patterns' kinds, and the least length of what they find.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
STEMS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

FIELD_KIND = "field"
TAGS = ("O", "B", "I")

#: Texts that the field learns from, at most, and tokens of one training line.
SAMPLE_ROWS = 3000
LINE_TOKENS = 48
MADE_LINES = 600
PLAIN_LINES = 800
MARK = "[SECRET]"

TOKEN = re.compile(r"[\w+/.\-]+(?:={1,2}(?![\w+/.\-=]))?|[^\w\s]+")
#: Distinct tokens whose shape a task remembers.
TOKENS_KEPT = 300_000

# Words that announce a secret, weaker ones, and beginnings of well-known keys.
ANNOUNCING = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key")
HINTING = ("auth", "authorization", "bearer", "basic", "credential", "credentials", "key", "pass", "pwd", "private")
BEGINNINGS = ("AKIA", "ghp_", "gho_", "sk-", "sk_", "eyJ", "xox", "AIza", "SG.", "glpat-")

_LENGTHS = (1, 3, 5, 7, 11, 15, 19, 23, 31, 39, 63)


def base_spans(text: str | None, tokens: Iterable[str] | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind's place) of the patterns' matches that are long enough, by start, then kind.

    A pattern runs only over a text that holds its fixed letters, or for
    ``hex``, whose matches lie inside a token, a token of that length.
    """
    if not text:
        return []
    found, small = [], text.lower()
    if any(w in small for w in STEMS):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    if max(map(len, TOKEN.findall(text) if tokens is None else tokens), default=0) >= HEX_LENGTH:
        found += [(*m.span(), 2) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return sorted(found, key=lambda s: (s[0], s[2]))


# --- features -------------------------------------------------------------------------------------------------------

ROLES = ("none", "announce", "hint", "assign", "quote", "mark", "number", "word", "other")


def _bucket(n: int, edges: Iterable[int]) -> int:
    return sum(n > e for e in edges)


def role(token: str) -> int:
    bare = token.lower().rstrip("=")
    if bare in ANNOUNCING or bare.endswith(("_key", "_secret", "_token", "password", "-token", "-key")):
        return 1
    if bare in HINTING:
        return 2
    if set(token) <= set("=:>"):
        return 3
    if set(token) <= set("\"'`"):
        return 4
    if not any(c.isalnum() for c in token):
        # A quote or an assignment among other marks still counts.
        return 3 if token[0] in "=:" else 4 if token[-1] in "\"'`" else 5
    if bare.isdigit():
        return 6
    return 7 if bare.isalpha() else 8


class Names(dict):
    """Feature name to number, given out as names come, until frozen."""

    frozen = False

    def __missing__(self, name) -> int:
        if self.frozen:
            return 0
        self[name] = len(self) + 1
        return self[name]


def shape(token: str) -> tuple:
    """Names of the features that follow from the token alone."""
    lower = any("a" <= c <= "z" for c in token)
    upper = any("A" <= c <= "Z" for c in token)
    digit = any("0" <= c <= "9" for c in token)
    other = any(c in "+/_.-=" for c in token)
    mark = not any(c.isalnum() for c in token)
    kinds = (lower, upper, digit, other, not token.isascii(), mark)
    length = _bucket(len(token), _LENGTHS)
    classes = ["a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "." for c in token]
    changes = _bucket(sum(a != b for a, b in zip(classes, classes[1:])), (0, 1, 3, 7, 15))
    varied = _bucket(len(set(token)), (2, 4, 8, 11, 16))
    hexlike = len(token) >= 16 and (set(token) <= set("0123456789abcdef") or set(token) <= set("0123456789ABCDEF"))
    digits = _bucket(10 * sum(c.isdigit() for c in token) // len(token), (0, 2, 5, 8))
    names = [
        ("length", length),
        ("kinds", kinds),
        ("kinds", kinds, length // 2),
        ("changes", changes, length // 3),
        ("varied", varied, digits),
        ("role", role(token)),
    ]
    names += [("hex", hexlike)] if hexlike else []
    names += [("begins", b) for b in BEGINNINGS if token.startswith(b) and len(token) >= 12]
    names += [("dotted",)] if re.fullmatch(r"[\w-]+(\.[\w-]+)+", token) else []
    return tuple(names)


def around(roles: list[int], i: int) -> tuple:
    """Names of the features of the words around place ``i``."""
    before = [roles[i - k] if i >= k else 0 for k in (1, 2, 3)]
    after = roles[i + 1] if i + 1 < len(roles) else 0
    return (
        ("before", before[0]),
        ("before2", before[0], before[1]),
        ("announced", 1 in before, 3 in before),
        ("after", before[0], after),
    )


def file_features(text: str, tokens: list[str]) -> tuple:
    """Names of the features of a file: how much of it are numbers, assignments and long lines."""
    n = len(tokens)
    digits = sum(not t.isalpha() and any(c.isdigit() for c in t) for t in tokens)
    assigned = sum(t[0] in "=:" for t in tokens)
    lines = text.count("\n") + 1
    return (
        ("digits", _bucket(100 * digits // max(n, 1), (0, 1, 5, 20))),
        ("assigned", _bucket(100 * assigned // max(n, 1), (0, 1, 5, 20))),
        ("line", _bucket(n // lines, (4, 12, 40))),
    )


# --- the field ------------------------------------------------------------------------------------------------------


class Field:
    """Weights of features (by number, then tag), of tag changes and of first tags."""

    def __init__(self, names: Names, weights: np.ndarray, change: np.ndarray, first: np.ndarray):
        self.names, self.weights = names, [tuple(map(float, w)) for w in weights]
        self.change, self.first = change.tolist(), first.tolist()
        gain = {name: max(self.weights[k][1:]) - self.weights[k][0] for name, k in names.items()}

        def most(families, fits=lambda name: True):
            return sum(max([0.0, *(g for n, g in gain.items() if n[0] == f and fits(n))]) for f in families)

        # What words around can add at most: any words, and words that neither announce nor assign nor quote.
        self.reach = {True: most(AROUND), False: most(AROUND, lambda n: n == NOT_ANNOUNCED or not STRONG & {*n[1:]})}
        self.file_reach = most(OF_FILE)
        self.jump = 2 * max(0.0, max(map(max, self.change)) - self.change[0][0], max(self.first) - self.first[0])
        self.shapes: dict[str, tuple[tuple[float, float, float], int, float]] = {}
        self.plain: dict[tuple, tuple[float, float, float]] = {}

    def sum(self, names: Iterable) -> tuple[float, float, float]:
        get, weights = self.names.get, self.weights
        rows = [weights[get(n, 0)] for n in names]
        return tuple(map(sum, zip(*rows))) if rows else (0.0, 0.0, 0.0)

    def shaped(self, token: str) -> tuple[tuple[float, float, float], int, float]:
        """Scores of the token's shape, its role, and its shape's largest gain over outside."""
        known = self.shapes.get(token)
        if known is None:
            if len(self.shapes) >= TOKENS_KEPT:
                self.shapes.clear()
            if len(token) < 12 and token.isalpha() and (token.islower() or token[1:].islower()):
                # Plain words of equal make have equal features.
                its_role = ALPHA_ROLES.get(token.lower(), 1 if token[-8:] == "password" else 7)
                key = (len(token), len(set(token)), token[0].isupper(), its_role)
                if not token.isascii():
                    key += (token[0] < "\x80", min(token[1:], default="~") < "\x80", max(token[1:], default="~") < "\x80")
                own = self.plain.get(key)
                if own is None:
                    own = self.plain[key] = self.sum(shape(token))
            else:
                its_role, own = role(token), self.sum(shape(token))
            known = self.shapes[token] = (own, its_role, max(own[1:]) - own[0])
        return known

    def tags(self, tokens: list[str], of_file: tuple[float, float, float]) -> list[int]:
        """The best tags of a line, by Viterbi; of equal ones, outside before begin before inside."""
        shapes = [self.shaped(t) for t in tokens]
        roles = [s[1] for s in shapes]
        best, back = None, []
        for i, (own, _, _) in enumerate(shapes):
            near = self.sum(around(roles, i))
            score = [own[t] + near[t] + of_file[t] for t in range(3)]
            if best is None:
                best = [self.first[t] + score[t] for t in range(3)]
                continue
            came = [max(range(3), key=lambda p: (best[p] + self.change[p][t], -p)) for t in range(3)]
            best = [best[came[t]] + self.change[came[t]][t] + score[t] for t in range(3)]
            back.append(came)
        tag = max(range(3), key=lambda t: (best[t], -t))
        out = [tag]
        for came in reversed(back):
            tag = came[tag]
            out.append(tag)
        return out[::-1]

    def spans(self, text: str | None, tokens: list[str], distinct: set[str]) -> list[tuple[int, int]]:
        """Start and end of the secrets that the field finds in ``text``, whose tokens are given."""
        known = self.shapes
        shapes = [known[t] if t in known else self.shaped(t) for t in distinct]
        need = -self.jump - self.reach[any(r in STRONG for _, r, _ in shapes)]
        highest = max((gain for _, _, gain in shapes), default=0.0)
        if highest + self.file_reach <= need:
            return []
        of_file = self.sum(file_features(text, tokens))
        need -= max(of_file[1:]) - of_file[0]
        if highest <= need:
            return []
        found, at = [], 0
        for line in text.split("\n"):
            places = list(TOKEN.finditer(line))
            words = [m[0] for m in places]
            if any(self.shaped(w)[2] > need for w in words):
                start = None
                for tag, m in zip(self.tags(words, of_file), places):
                    if tag == 1 or tag == 2 and start is None:
                        start = len(found)
                        found.append((at + m.start(), at + m.end()))
                    elif tag == 2:
                        found[-1] = (found[-1][0], at + m.end())
                    else:
                        start = None
            at += len(line) + 1
        return found


ALPHA_ROLES = {w: 1 for w in ANNOUNCING} | {w: 2 for w in HINTING}

# Families of features, and roles that make a secret likely next to them: announce, hint, assign, quote.
AROUND = ("before", "before2", "announced", "after")
OF_FILE = ("digits", "assigned", "line")
STRONG = {1, 2, 3, 4}
NOT_ANNOUNCED = ("announced", False, False)

# --- learning -------------------------------------------------------------------------------------------------------


def made_lines(n: int = MADE_LINES, seed: int = 11) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines of usual forms with a random secret, and like ones without; the same ones each time."""
    rng = random.Random(seed)
    letters, mixed = string.ascii_lowercase, string.ascii_letters + string.digits
    word = lambda: "".join(rng.choices(letters, k=rng.randint(2, 9)))
    secret = lambda: rng.choice(
        [
            lambda: "".join(rng.choices("0123456789abcdef", k=rng.choice((32, 40, 64)))),
            lambda: "".join(rng.choices("0123456789ABCDEF", k=rng.choice((32, 40)))),
            lambda: "".join(rng.choices(mixed, k=rng.randint(16, 44))),
            lambda: "".join(rng.choices(mixed + "+/", k=rng.randint(22, 60))) + rng.choice(("", "=", "==")),
            lambda: "AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=16)),
            lambda: rng.choice(("ghp_", "sk-", "xoxb-", "glpat-")) + "".join(rng.choices(mixed, k=rng.randint(20, 36))),
        ]
    )()
    forms = [
        '{w} = "{s}"', "{w}: {s}", "Authorization: Bearer {s}", "export {w}={s}", '"{w}": "{s}",', "{t} {w} = '{s}' {t}",
        "{t} {s} {t}", "-H 'X-Api-Key: {s}' {t}", "{w} {s}",
    ]
    plain = [
        "{t} {t}", "{w}: {t}", '{w} = "{p}"', "call {n} or {t}", "{p}@{p}.example.com {t}", "{t} {d}.{d}.{d}.{d} {t}",
        "{t} {card} {t}", "https://{p}.example.org/{p}/{n} {t}", "version {d}.{d} {t}", "(555) 010-{n}", "{caps}!! {caps}!! {t}",
        "{longword} {t}", "{t} | {longword} | {p}",
    ]
    lines = []
    for i in range(n):
        values = {
            "w": rng.choice((*ANNOUNCING, "client_secret", "access_key", "auth", "key", "pwd")),
            "t": " ".join(word() for _ in range(rng.randint(1, 8))),
            "p": word(),
            "s": "\x00",
            "n": str(rng.randint(100, 99999)),
            "d": str(rng.randint(0, 255)),
            "card": "".join(rng.choices(string.digits, k=16)),
            "caps": word().upper(),
            "longword": "".join(word() for _ in range(rng.randint(2, 6))),
        }
        line = rng.choice(forms if i % 2 else plain).format(**values)
        at = line.find("\x00")
        token = secret()
        lines.append((line.replace("\x00", token), [(at, at + len(token))] if at >= 0 else []))
    return lines


def training_lines(text: str) -> list[tuple[str, list[tuple[int, int]]]]:
    """Each line of ``text`` with the places of the secrets that the patterns find in it."""
    spans = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_LENGTH and any(c.isdigit() for c in m[2]):
            spans.append(m.span(2))
    spans += [(a, b) for a, b, kind in base_spans(text) if kind]
    lines, at = [], 0
    for line in text.split("\n"):
        end = at + len(line)
        lines.append((line, [(a - at, b - at) for a, b in spans if at <= a and b <= end]))
        at = end + 1
    return lines


def fit_field(texts: list[str], rounds: int = 100, strength: float = 3e-4) -> Field:
    """Weights that make the tags of the training lines likely, by gradient steps on all of them."""
    names = Names()
    features: list[list[list[int]]] = []
    tags: list[np.ndarray] = []
    plain = 0

    def add(line, spans, of_file):
        tokens = list(TOKEN.finditer(line))
        words = [m[0] for m in tokens]
        roles = [role(w) for w in words]
        marked = np.zeros(len(tokens), dtype=np.int64)
        for a, b in spans:
            inside = [i for i, m in enumerate(tokens) if m.start() < b and m.end() > a]
            for k, i in enumerate(inside):
                marked[i] = 2 if k else 1
        rows = [[names[n] for n in (*shape(w), *around(roles, i), *of_file)] for i, w in enumerate(words)]
        for s in range(0, len(rows), LINE_TOKENS):
            features.append(rows[s : s + LINE_TOKENS])
            tags.append(marked[s : s + LINE_TOKENS])

    for line, spans in made_lines():
        add(line, spans, file_features(line, TOKEN.findall(line)))
    for text in texts:
        of_file = None
        for line, spans in training_lines(text):
            wanted = spans or (plain < PLAIN_LINES and line.strip())
            if wanted:
                of_file = of_file or file_features(text, TOKEN.findall(text))
                add(line[: 4000 if not spans else None], spans, of_file)
                plain += not spans
    names.frozen = True

    # Tokens of equal features are one row of ``table``.
    distinct: dict[tuple, int] = {}
    n, steps = len(features), max(map(len, features))
    at = np.zeros((n, steps), dtype=np.int64)
    gold = np.zeros((n, steps), dtype=np.int64)
    there = np.zeros((n, steps), dtype=bool)
    for i, (row, tag) in enumerate(zip(features, tags)):
        gold[i, : len(row)], there[i, : len(row)] = tag, True
        at[i, : len(row)] = [distinct.setdefault(tuple(f), len(distinct)) for f in row]
    width = max(map(len, distinct))
    table = np.array([[*f, *[0] * (width - len(f))] for f in distinct], dtype=np.int64)
    count = len(names) + 1
    size = count * 3 + 12
    hot = np.eye(3)[gold] * there[:, :, None]

    def totals(p, pair, start):
        by_row = [np.bincount(at.ravel(), p[:, :, t].ravel(), len(table)) for t in range(3)]
        by_tag = np.array([np.bincount(table.ravel(), np.repeat(r, width), count) for r in by_row]).T
        by_tag[0] = 0
        return np.concatenate([by_tag.ravel(), pair.ravel(), start])

    pairs = hot[:, :-1, :, None] * hot[:, 1:, None, :]
    seen = totals(hot, pairs.sum((0, 1)), hot[:, 0].sum(0))

    theta, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for r in range(1, rounds + 1):
        weights, change, first = unpack(theta, count)
        score = weights[table].sum(1)[at]
        p, pair, start = marginals(score, change, first, there)
        gradient = (totals(p, pair, start) - seen) / n + strength * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= 0.2 * (mean / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-6)
    weights, change, first = unpack(theta, count)
    return Field(names, weights, change, first)


def unpack(theta: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return theta[: 3 * count].reshape(count, 3), theta[3 * count : 3 * count + 9].reshape(3, 3), theta[-3:]


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(score, change, first, there):
    """Chances of tags and of pairs of tags, by forward and backward sums over all lines at once."""
    n, steps, _ = score.shape
    ahead = np.empty_like(score)
    behind = np.zeros_like(score)
    ahead[:, 0] = first + score[:, 0]
    for t in range(1, steps):
        step = log_sum(ahead[:, t - 1, :, None] + change, 1) + score[:, t]
        ahead[:, t] = np.where(there[:, t, None], step, ahead[:, t - 1])
    for t in range(steps - 2, -1, -1):
        step = log_sum(change + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(there[:, t + 1, None], step, 0.0)
    total = log_sum(ahead[:, -1], 1)
    p = np.exp(ahead + behind - total[:, None, None]) * there[:, :, None]
    both = ahead[:, :-1, :, None] + change + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
    pair = (np.exp(both) * there[:, 1:, None, None]).sum((0, 1))
    return p, pair, p[:, 0].sum(0)


# --- operators ------------------------------------------------------------------------------------------------------


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """A field fitted to at most ``sample_rows`` texts, chosen by a hash of the id, and to made-up lines.

    Lines without a mark, and lines with one, go to the driver; nothing else of
    a text does: at most the first ``LINE_TOKENS`` long lines of each.
    """
    chosen = docs.where("doc_id is not null and text is not null").select("doc_id").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    # Marked lines and the first line of each text, so that what is gathered is small.
    def start():
        def step(values):
            out = []
            for text in values:
                lines = [line for line, spans in training_lines(text or "") if spans][:8]
                out.append("\n".join([*(line[:2000] for line in (text or "").split("\n")[:2]), *lines]))
            return {"lines": out}

        return step

    rows = map_rows(texts, ["text"], start, {"lines": "string"}, drop=("text",)).collect()
    return fit_field([r["lines"] for r in sorted(rows, key=lambda r: r["doc_id"])])


def all_spans(text: str | None, field: Field) -> list[tuple[int, int, int]]:
    """The patterns' spans, and those of the field that touch none of them, by start, then kind."""
    if not text:
        return []
    tokens = TOKEN.findall(text)
    distinct = set(tokens)
    base = base_spans(text, distinct)
    more = [(a, b, len(KINDS)) for a, b in field.spans(text, tokens, distinct) if not any(a < d and c < b for c, d, _ in base)]
    return sorted([*base, *more], key=lambda s: (s[0], s[2]))


SPANS = {"kinds": "array<int>", "starts": "array<int>", "ends": "array<int>"}


def find_secrets(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with kinds, starts and ends of the secrets in ``text``, in code points, end exclusive.

    A kind is its place in ``KINDS``; the field's own follow as the next number.
    Null and empty texts have none; repeated rows give repeated results. Other
    columns pass; those named like a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def start():
        fitted = shared.value

        def step(texts):
            found = [all_spans(t, fitted) for t in texts]
            return {
                "kinds": [[s[2] for s in f] for f in found],
                "starts": [[s[0] for s in f] for f in found],
                "ends": [[s[1] for s in f] for f in found],
            }

        return step

    return map_rows(docs, ["text"], start, SPANS)


def secrets_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, count of each pattern, SHA-256 of the patterns' spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"), learn(docs, sample_rows)).drop("text")
    names = F.array(*(F.lit(k) for k in (*KINDS, FIELD_KIND)))
    written = F.transform(
        F.arrays_zip("kinds", "starts", "ends"),
        lambda s: F.struct(
            s["kinds"].alias("kind"), F.concat_ws(":", F.get(names, s["kinds"]), s["starts"], s["ends"]).alias("span")
        ),
    )

    def count(kind):
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long")

    base = F.transform(F.filter("written", lambda s: s["kind"] < len(KINDS)), lambda s: s["span"])
    return found.withColumn("written", written).select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.transform("written", lambda s: s["span"]), ",").alias("spans"),
    )


def redact(docs: DataFrame, field: Field, mark: str = MARK) -> DataFrame:
    """``docs`` with ``mark`` in place of each secret; overlapping ones become one mark.

    Columns and rows as given; n_chars, where there is one, is counted anew
    for texts that changed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    counted = "n_chars" in docs.columns

    def cut(text, spans):
        out, at, last = [], 0, 0
        for a, b, _ in spans:
            if a >= last:
                out += [text[at:a], mark]
            at = last = max(last, b)
        return "".join([*out, text[at:]])

    def start():
        fitted = shared.value

        def step(texts):
            spans = [all_spans(t, fitted) for t in texts]
            return {"text": [cut(t, s) if s else t for t, s in zip(texts, spans)], "changed_": [bool(s) for s in spans]}

        return step

    done = map_rows(docs, ["text"], start, {"text": "string", "changed_": "boolean"})
    if counted:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("changed_"), chars).otherwise(F.col("n_chars")))
    return done.select(*(F.col(f"`{c}`") for c in docs.columns))
