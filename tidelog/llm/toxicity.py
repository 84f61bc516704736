"""Toxicity: a subsequence string kernel, Nyström landmarks and a support vector machine.

The unit is a word with its beginning marked, or letters that stand apart from
each other. Two units are alike as far as they share subsequences of three or
four symbols; a subsequence counts less the wider it is spread, so that insults
with gaps or inserted characters stay near to the plain ones. Landmarks are units of the labelled sample; kernel
values with them, whitened, are a unit's features, and a hinge-loss model is
fitted to these by dual coordinate descent. A text is a bag: its margin is that
of its most toxic unit, and which units of a toxic text bear its label is chosen
anew in each round of learning.

A linear model over Nyström features is a weighted sum of kernels with the
landmarks, which in turn is one weight for each subsequence. Scoring therefore
looks up each subsequence of a text once, over whole batches of characters.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import map_rows, remainder
from tidelog.llm.labelled import HELD_OUT, labelled_sample
from tidelog.llm.linear_svm import dual_coordinate_descent, logistic_scale, scores

#: Labelled texts of each class that the model is fitted to, at most, and their greatest length.
PER_CLASS = 2000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.5

LANDMARKS = 192
#: A subsequence spread over n characters counts DECAY ** n, up to SPREAD characters.
DECAY = 0.6
SPREAD = 7
COST = 1.0
ROUNDS = 4
#: Units of a toxic text that may bear its label.
BEARERS = 5

#: Characters of a unit; a longer run without white space is several.
UNIT = 64
#: Characters looked at together.
STRETCH = 1 << 18

# Symbols: 0 a gap, then letters, digits, other letters, and the beginning of a unit.
_GAP, _BEGIN, _ALPHABET = 0, 63, 64
_SPREADS = [s for n in (2, 3) for s in itertools.combinations(range(1, SPREAD), n)]
# Codes of three symbols stand for themselves, those of four are hashed behind them.
_THREES = _ALPHABET**3
_HASH_BITS = 21
SIZE = _THREES + (1 << _HASH_BITS)


def symbol_table() -> np.ndarray:
    """Code point to symbol: 1 to 26 a letter in either case, 27 to 36 a digit, 37 to 62 letters beyond ASCII, 0 a mark."""
    table = np.zeros(1 << 16, dtype=np.int32)
    for point in range(1 << 16):
        c = chr(point).lower()[0]
        if "a" <= c <= "z":
            table[point] = ord(c) - 96
        elif "0" <= c <= "9":
            table[point] = ord(c) - 21
        elif c.isalnum():
            table[point] = 37 + ord(c) % 26
    return table


class Symbols:
    """Texts as symbols, cut into units."""

    def __init__(self):
        self.table = symbol_table()
        self.space = np.zeros(1 << 16, dtype=bool)
        self.space[[p for p in range(1 << 16) if chr(p).isspace()]] = True

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of a blank and the characters, and the start of each unit: the white space before it."""
        points = np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        points = np.where(points < 1 << 16, points, 0xFFFD).astype(np.int64)
        symbols, space = self.table[points], self.space[points]
        # White space parts units unless letters stand alone on both of its sides: then it is a gap.
        n = len(space)
        before = np.concatenate(([True], space[:-1]))
        after = np.concatenate((space[1:], [True]))
        alone = ~space & before & after
        left = np.concatenate(([False], alone[:-1]))
        right = np.concatenate((alone[1:], [False]))
        parts = space & ~(left & right)
        symbols[parts] = _BEGIN
        starts = np.flatnonzero(parts)
        ends = np.append(starts[1:], n)
        if (ends - starts > UNIT).any():
            starts = np.concatenate([np.arange(a, b, UNIT) for a, b in zip(starts.tolist(), ends.tolist())])
        return symbols, starts

    def stretches(self, text: str) -> Iterator[str]:
        """``text`` in pieces of bounded length, cut at white space where there is some."""
        at = 0
        while at < len(text):
            end = min(at + STRETCH, len(text))
            if end < len(text):
                end = next((i for i in range(end, max(at, end - 4 * UNIT), -1) if text[i - 1].isspace()), end)
            yield text[at:end]
            at = end

    def units(self, text: str) -> set[bytes]:
        """The distinct units with three letters or more, as bytes of their symbols."""
        found = set()
        for piece in self.stretches(text):
            symbols, starts = self(piece)
            small = symbols.astype(np.uint8).tobytes()
            ends = [*starts[1:].tolist(), len(small)]
            found.update(small[a:b].rstrip(b"\x00") for a, b in zip(starts.tolist(), ends))
        return {u for u in found if len(u) - u.count(0) > 3}


def subsequences(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way to spread three or four symbols: where they lie in one unit, their code there, and their decay."""
    unit = np.zeros(len(symbols), dtype=np.int32)
    unit[starts[1:]] = 1
    unit = np.cumsum(unit, dtype=np.int32)
    letter = symbols != _GAP
    small = symbols.astype(np.uint32)
    for spread in _SPREADS:
        n = len(symbols) - spread[-1]
        if n <= 0:
            continue
        there = letter[:n] & (unit[:n] == unit[spread[-1] :])
        code = small[:n]
        for step in spread:
            there &= letter[step : step + n]
            code = code * np.uint32(_ALPHABET) + small[step : step + n]
        at = np.flatnonzero(there)
        code = code[at]
        if len(spread) == 3:
            code = (code * np.uint32(2654435769) >> np.uint32(32 - _HASH_BITS)) + np.uint32(_THREES)
        yield at, code, DECAY ** (spread[-1] + 1)


def joined(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Units one after another, as symbols and starts."""
    lengths = np.array([len(u) for u in units], dtype=np.int64)
    symbols = np.frombuffer(b"".join(units), dtype=np.uint8).astype(np.int32)
    return symbols, np.cumsum(lengths) - lengths


def unit_sums(symbols: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each unit the sum of its subsequences' weights, over the root of the sum of squares of their decay.

    The divisor, a factor of the unit alone, takes the place of the kernel's
    usual norm; products with it are a kernel again.
    """
    total, square = np.zeros(len(symbols)), np.zeros(len(symbols))
    for at, codes, decay in subsequences(symbols, starts):
        total[at] += decay * weights[codes]
        square[at] += decay * decay
    if not len(starts):
        return np.zeros(0)
    sums = np.add.reduceat(total, starts)
    return sums / np.sqrt(np.maximum(np.add.reduceat(square, starts), 1e-12))


class Landmarks:
    """Landmarks as lists of (landmark, scaled decay) by subsequence."""

    def __init__(self, units: list[bytes]):
        self.units = units
        unit, codes, values = entries(units)
        order = np.argsort(codes, kind="stable")
        self.unit, self.values = unit[order], values[order]
        found, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(codes))
        self.row = np.full(SIZE, -1, dtype=np.int32)
        self.row[found] = np.arange(len(found))
        self.codes = codes[order]

    def kernel(self, units: list[bytes]) -> np.ndarray:
        """Kernel values of each unit with each landmark."""
        out = np.zeros((len(units), len(self.units)))
        for at in range(0, len(units), 5000):
            part = units[at : at + 5000]
            unit, codes, values = entries(part)
            row = self.row[codes]
            known = row >= 0
            unit, row, values = unit[known], row[known], values[known]
            many = self.first[row + 1] - self.first[row]
            place = np.repeat(self.first[row] - np.cumsum(many) + many, many) + np.arange(many.sum())
            cell = np.repeat(unit, many) * len(self.units) + self.unit[place]
            sums = np.bincount(cell, np.repeat(values, many) * self.values[place], len(part) * len(self.units))
            out[at : at + len(part)] = sums.reshape(len(part), -1)
        return out

    def weights(self, factors: np.ndarray) -> np.ndarray:
        """A weight for each subsequence: the sum over landmarks of factor times scaled decay."""
        return np.bincount(self.codes, self.values * factors[self.unit], SIZE)


def entries(units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit's place, code and scaled decay of every subsequence of the units."""
    symbols, starts = joined(units)
    place = np.searchsorted(starts, np.arange(len(symbols)), side="right") - 1
    found = [(place[at], codes, np.full(len(at), decay)) for at, codes, decay in subsequences(symbols, starts)]
    unit, codes, decays = (np.concatenate(x) for x in zip(*found)) if found else np.zeros((3, 0), dtype=np.int64)
    square = np.bincount(unit, decays * decays, len(units))
    return unit, codes.astype(np.int64), decays / np.sqrt(np.maximum(square[unit], 1e-12))


class Model:
    def __init__(self, weights: np.ndarray, bias: float, landmarks: list[bytes]):
        self.weights, self.bias, self.landmarks = weights.astype(np.float32), bias, landmarks
        self.slope, self.offset = 1.0, 0.0

    def margins(self, units: list[bytes]) -> np.ndarray:
        parts = [units[i : i + 20_000] for i in range(0, len(units), 20_000)]
        return np.concatenate([np.zeros(0)] + [unit_sums(*joined(p), self.weights) for p in parts]) + self.bias

    def text_margins(self, texts: list[str | None], symbols: Symbols) -> np.ndarray:
        """The highest margin of each text's units; of none, the bias. Texts are taken together in bounded stretches."""
        best = np.full(len(texts), self.bias)
        batch: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0

        def look():
            offsets = np.cumsum([0] + [len(s) for _, s, _ in batch])
            starts = np.concatenate([s + o for (_, _, s), o in zip(batch, offsets)])
            owner = np.repeat([i for i, _, _ in batch], [len(s) for _, _, s in batch])
            margins = unit_sums(np.concatenate([s for _, s, _ in batch]), starts, self.weights) + self.bias
            np.maximum.at(best, owner, margins)

        for i, text in enumerate(texts):
            for piece in symbols.stretches(text or ""):
                coded, starts = symbols(piece)
                batch.append((i, coded, starts))
                held += len(coded)
                if held >= STRETCH:
                    look()
                    batch, held = [], 0
        if batch:
            look()
        return best


def telling(bags: list[list[bytes]], signs: np.ndarray) -> tuple[dict[bytes, float], Counter]:
    """How much each unit of a toxic text tells (log-odds, more so if seen often), and counts in clean texts."""
    toxic, clean = Counter(), Counter()
    for bag, sign in zip(bags, signs):
        (toxic if sign > 0 else clean).update(bag)
    up, down = int((signs > 0).sum()) + 1, int((signs < 0).sum()) + 1
    return {
        u: float(np.log((c + 0.5) / up) - np.log((clean.get(u, 0) + 0.5) / down)) * c**0.5 for u, c in toxic.items()
    }, clean


def fit_model(texts: list[str], labels: list[int], counts: dict[int, int], landmarks: int = LANDMARKS) -> Model | None:
    """Rounds of choosing the units of each bag and fitting; a quarter of the sample sets the score's scale."""
    signs = np.where(np.array(labels) == 1, 1.0, -1.0)
    if len(set(labels)) < 2:
        return None
    symbols = Symbols()
    shared: dict[bytes, bytes] = {}
    bags = [sorted(shared.setdefault(u, u) for u in symbols.units(t or "")) for t in texts]
    learning = np.arange(len(bags)) % 4 != 0 if len(bags) >= 40 else np.ones(len(bags), dtype=bool)
    if len(set(signs[learning])) < 2:
        learning[:] = True
    own = [(b, s) for b, s, use in zip(bags, signs, learning) if use and b]
    tells, clean = telling([b for b, _ in own], np.array([s for _, s in own]))
    best = sorted(tells, key=lambda u: (-tells[u], u))[: landmarks * 3 // 4]
    taken = set(best)
    common = [u for u in sorted(clean, key=lambda u: (-clean[u], u)) if u not in taken]
    if not best:
        return None
    marks = Landmarks(best + common[: landmarks - len(best)])
    values, vectors = np.linalg.eigh(marks.kernel(marks.units))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    everywhere = np.arange(int(keep.sum()))

    # A toxic text is toxic by the few of its units that tell most.
    bearing = [sorted(b, key=lambda u: (-tells[u], u))[:BEARERS] for b, s in own if s > 0]
    negative: Counter = Counter()
    for bag, sign in own:
        if sign < 0:
            negative.update(bag[:: max(1, len(bag) // 4)][:4])
    units = sorted({u for b, _ in own for u in b})
    place = {u: i for i, u in enumerate(units)}
    for _ in range(ROUNDS):
        positive = Counter(u for few in bearing for u in few)
        chosen = [(u, 1.0, c) for u, c in sorted(positive.items())] + [(u, -1.0, c) for u, c in sorted(negative.items())]
        rows = marks.kernel([u for u, _, _ in chosen]) @ whiten
        weights, bias = dual_coordinate_descent(
            [(everywhere, row) for row in rows],
            np.array([s for _, s, _ in chosen]),
            len(everywhere),
            COST * np.array([float(c) for _, _, c in chosen]),
            epochs=30,
        )
        model = Model(marks.weights(whiten @ weights), bias, marks.units)
        margins = model.margins(units)
        # Units that turned out clean bear no label unless they are a text's best; each clean text's worst is one to mind.
        bearing = [
            [u for u in few if margins[place[u]] > 0] or [max(few, key=lambda u: (margins[place[u]], u))] for few in bearing
        ]
        for bag, sign in own:
            if sign < 0:
                negative[max(bag, key=lambda u: (margins[place[u]], u))] += 1

    checked = ~learning if (~learning).any() and len(set(signs[~learning])) == 2 else learning
    at = np.flatnonzero(checked)
    found = model.text_margins([texts[i] for i in at], symbols)
    share = {s: counts[int(s > 0)] / max(int((signs[at] == s).sum()), 1) for s in (1.0, -1.0)}
    model.slope, model.offset = logistic_scale(found, signs[at], np.array([share[s] for s in signs[at]]))
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[Model | None, float]:
    """The model, and the share of label 1 that stands in where there are not both labels.

    The driver gets at most ``per_class`` texts a class, each of at most
    ``SAMPLE_CHARS`` characters: longer texts are not learned from.
    """
    sample, counts = labelled_sample(docs.where(F.length("text") <= SAMPLE_CHARS), labels, "toxic", per_class)
    rows = sorted(sample.collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    return fit_model([r["text"] for r in rows], [r["label"] for r in rows], counts), prior


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``, 0 to 1: how likely label 1 is, from the text alone.

    Null and empty texts, and texts without a unit of three letters, get the
    score of the bias; repeated rows get equal scores. With labels of one class
    or none, every score is the smoothed share of label 1. Other columns pass;
    one named so is replaced.
    """
    model, prior = fit_toxicity(docs, labels, per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        symbols, fitted = Symbols(), shared.value

        def step(texts):
            if fitted is None:
                return {name: [prior] * len(texts)}
            return {name: scores(fitted.text_margins(texts, symbols), fitted.slope, fitted.offset)}

        return step

    return map_rows(docs, ["text"], start, {name: "double"})


def toxicity_report(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted (score at least ``THRESHOLD``)."""
    scored = score_toxicity(docs.select("doc_id", "text"), labels, per_class)
    return scored.select(
        "doc_id",
        (remainder("doc_id", HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
