"""Benchmark decontamination with a generalised suffix automaton over words.

The test items become one automaton (in parts of bounded size); each training
text runs through it word by word and the automaton's state tells the longest
stretch ending here that occurs in some item. Where that stretch is as long as
a window, the window's words are hits.
"""

from __future__ import annotations

import itertools
import pickle
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches, map_rows, staged, text_of, worker_store

#: Words of a window, and words of test items in one automaton (some 60 MB).
WINDOW = 10
PART_WORDS = 200_000
#: A text hit by more than this share of its words is dropped as a whole.
MAX_COVERAGE = 0.5

# One byte to one byte: A-Z become small, other ASCII except digits and letters becomes a blank.
_WORD = re.compile(rb"[^ ]+")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Small-letter words of ASCII letters and digits and everything beyond ASCII; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences.

    ``length`` and ``link`` are by state. ``window`` gives, by state, the
    ancestor that stands for the last ``size`` words, ``short`` the ends of
    items of fewer words that are suffixes of the state.
    """

    def __init__(self, size: int):
        self.size, self.vocabulary = size, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        self.owners: dict[int, set[str]] = {}
        self.ends: dict[int, tuple[int, set[str]]] = {}
        self._items: list[tuple[str | None, list[int]]] = []

    def add(self, item_id: str | None, item: list[bytes]) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item]
        last = 0
        for w in ids:
            last = self._extend(last, w)
        self._items.append((item_id, ids))

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, parent: int, w: int) -> int:
        """The state of parent's longest text plus ``w``, taken out of a longer one where needed."""
        child = self.next[parent][w]
        if self.length[child] == self.length[parent] + 1:
            return child
        copy = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(w) == child:
            self.next[parent][w] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        self.link[new] = 0 if at < 0 else self._split(at, w)
        return new

    def finish(self) -> Automaton:
        """Name the items of each window once all texts are in."""
        for item_id, ids in self._items:
            state, named = 0, set() if item_id is None else {item_id}
            for i, w in enumerate(ids):
                state = self.next[state][w]
                if i + 1 >= self.size:
                    self.owners.setdefault(self.ancestor(state, self.size), set()).update(named)
            if len(ids) < self.size:
                end = self.ends.setdefault(self.ancestor(state, len(ids)), (len(ids), set()))
                end[1].update(named)
        self.window = [-1] * len(self.link)
        self.short: dict[int, list[int]] = {}
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= self.size:
                self.window[state] = self.window[up] if self.length[up] >= self.size else state
            chain = [*self.short.get(up, ()), *([state] if state in self.ends else [])]
            if chain:
                self.short[state] = chain
        del self._items
        return self

    def ancestor(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def scan(self, text: list[bytes]) -> tuple[list[int], set[int]]:
        """Start and end of the hit stretches of ``text``, flat, and the states of the windows in it."""
        get, follow, link, lengths = self.vocabulary.get, self.next, self.link, self.length
        window, short, size = self.window, self.short, self.size
        state = matched = 0
        spans: list[int] = []
        found: set[int] = set()
        for i, w in enumerate(map(get, text)):
            if w is None:
                state = matched = 0
                continue
            to = follow[state].get(w)
            while to is None and state:
                state = link[state]
                matched = lengths[state]
                to = follow[state].get(w)
            if to is None:
                continue
            state, matched = to, matched + 1
            reach = 0
            if matched >= size:
                found.add(window[state])
                reach = size
            if state in short:
                for end in short[state]:
                    n = self.ends[end][0]
                    if n <= matched:
                        found.add(end)
                        reach = max(reach, n)
            if reach:
                start = i + 1 - reach
                while spans and start <= spans[-1]:
                    start = min(start, spans[-2])
                    del spans[-2:]
                spans += (start, i + 1)
        return spans, found

    def items(self, states: Iterable[int]) -> set[str]:
        named: set[str] = set()
        for s in states:
            named |= self.owners.get(s, set())
            if s in self.ends:
                named |= self.ends[s][1]
        return named


def item_parts(items: Iterable[tuple[str | None, str | None]], size: int, part_words: int) -> Iterator[Automaton]:
    """Automata of at most ``part_words`` words each.

    An item longer than that goes on in the next part; the pieces overlap by a
    window less one word, so no window is lost.
    """
    automaton, used = Automaton(size), 0
    for item_id, text in items:
        rest = words(text)
        while rest:
            piece = rest[: max(part_words, size)]
            rest = rest[len(piece) - size + 1 :] if len(rest) > len(piece) else []
            if used and used + len(piece) > part_words:
                yield automaton.finish()
                automaton, used = Automaton(size), 0
            automaton.add(item_id, piece)
            used += len(piece)
    if used:
        yield automaton.finish()


def merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(itertools.batched(spans, 2)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


FOUND = {"n_words": "long", "spans": "array<long>", "items": "array<string>"}


def built_parts(items: DataFrame, size: int, part_words: int) -> DataFrame:
    """``automaton``: the pickled state of the automata of the parts of ``items`` (item_id, text), one a row.

    They are built in tasks, a part or so each, and written to the shared folder.
    """
    spark = bounded_batches(items.sparkSession)
    rows = items.select(F.col("item_id").cast("string"), "text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(len(words(t)) for t in batch.column(1).to_pylist())]})

    total = rows.mapInArrow(sizes, "n long").agg(F.sum("n")).first()[0] or 0
    dealt = rows.repartition(-(-total // part_words)) if total > part_words else rows.coalesce(1)

    def build(batches):
        pairs = (pair for batch in batches for pair in zip(*(c.to_pylist() for c in batch.columns)))
        for automaton in item_parts(pairs, size, part_words):
            yield pa.RecordBatch.from_pydict({"automaton": [pickle.dumps(vars(automaton))]})

    return staged(dealt.mapInArrow(build, "automaton binary"), "automata")


def shipped(spark: SparkSession, part: bytes) -> Callable[[], Automaton]:
    """What gives tasks the automaton; a worker unpickles it once and keeps the last."""
    value, name = spark.sparkContext.broadcast(part), uuid.uuid4().hex

    def get():
        store = worker_store("automaton")
        if store.get("name") != name:
            store.clear()
            automaton = Automaton(0)
            vars(automaton).update(pickle.loads(value.value))
            store.update(name=name, automaton=automaton)
        return store["automaton"]

    return get


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    part_words: int = PART_WORDS,
    cut: bool = False,
) -> DataFrame:
    """``docs`` with n_words, spans and items; ``text`` goes, or with ``cut`` loses its hit stretches.

    ``spans`` holds first word and end of each hit stretch, flat and merged;
    ``items`` the ids of the items with a window in the text, sorted as text.
    Null and empty texts have no words; repeated rows give repeated results;
    items without words are in no text, an item without an id gives hits but
    no name. What a cut brings together is searched and cut again, until no
    window is left; spans and items are those of the whole text. Other columns
    pass; those named like a result are replaced.

    Automata are built in tasks and pass the driver as bytes, one at a time. One
    part, the usual case, is one pass over the documents without a shuffle. More
    parts are a pass each; only the texts that are hit are gathered, by id and
    text hash, and a pass for each part goes over the texts just cut until none
    is hit.
    """
    spark = docs.sparkSession
    built = built_parts(items, size, part_words)
    parts = [shipped(spark, bytes(r["automaton"])) for r in built.toLocalIterator()]
    columns = FOUND | ({"text": "string"} if cut else {})

    def scanner(part):
        def start():
            automaton = part() if part is not None else Automaton(size).finish()

            def step(texts):
                split = [words(t) for t in texts]
                found = [automaton.scan(w) for w in split]
                made = {
                    "n_words": [len(w) for w in split],
                    "spans": [s for s, _ in found],
                    "items": [sorted(automaton.items(f)) for _, f in found],
                }
                if not cut or len(parts) > 1:
                    return made
                left = []
                for text, spans in zip(texts, made["spans"]):
                    # What a cut brings together may be a window again.
                    while spans:
                        text = without(text, spans)
                        spans = automaton.scan(words(text))[0]
                    left.append(text)
                return made | {"text": left}

            return step

        return start

    if len(parts) <= 1:
        return map_rows(docs, ["text"], scanner(parts[0] if parts else None), columns, drop=("text",))

    keys = ["key_id_", "key_hash_", "key_crc_"]

    def same_text(df):
        return df.withColumns(
            {"key_hash_": F.xxhash64("text"), "key_crc_": F.crc32(F.encode(text_of("text"), "utf-8")), "key_id_": F.col("doc_id")}
        )

    def with_keys(left, right):
        return left.join(right, [left[k].eqNullSafe(right[k]) for k in keys], "left").drop(*(right[k] for k in keys))

    def hits_in(texts):
        """Keys, spans and items of the texts that some part hits."""
        hits = None
        for part in parts:
            hit = map_rows(texts, ["text"], scanner(part), FOUND, drop=("text",))
            hit = hit.where(F.size("spans") > 0).select(*keys, "spans", "items").distinct()
            hits = hit if hits is None else hits.unionAll(hit)
        # Equal rows have equal hits and are one by now: a group has a row for each part at most.
        gathered = staged(hits, "hits").groupBy(*keys).agg(
            F.flatten(F.collect_list("spans")).alias("part_spans_"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("part_items_"),
        )
        return staged(gathered, "gathered")

    def cutter():
        return lambda texts, spans: {"text": [without(t, merged(s)) for t, s in zip(texts, spans)]}

    def cut_once(texts, hits):
        joined = with_keys(texts, hits).where("part_spans_ is not null").dropDuplicates(keys)
        found = joined.select(*keys, "text", "part_spans_")
        return staged(map_rows(found, ["text", "part_spans_"], cutter, {"text": "string"}, drop=("part_spans_",)), "cut")

    narrow = same_text(docs.select("doc_id", "text")).drop("doc_id")
    hits = hits_in(narrow)
    inputs = ["text", "part_spans_", "part_items_"]
    if cut:
        texts, again, rounds = narrow, hits, []
        while again.limit(1).count():
            texts = cut_once(texts, again)
            rounds.append(texts.withColumn("round_", F.lit(len(rounds))))
            again = hits_in(texts)
        last = reduce(DataFrame.unionAll, rounds) if rounds else narrow.limit(0).withColumn("round_", F.lit(0))
        last = last.groupBy(*keys).agg(F.max_by("text", "round_").alias("cut_text_"))
        hits = with_keys(hits, last)
        inputs.append("cut_text_")
    joined = with_keys(same_text(docs), hits)

    def start():
        def step(texts, spans, named, left=()):
            made = {"n_words": [len(words(t)) for t in texts], "spans": [merged(s or []) for s in spans], "items": [n or [] for n in named]}
            return made | ({"text": [new if s else t for t, s, new in zip(texts, spans, left)]} if cut else {})

        return step

    return map_rows(joined.drop(*keys), inputs, start, columns, drop=tuple(inputs))


def without(text: str | None, spans: list[int]) -> str | None:
    """``text`` less the stretches of words, with what stands between their words."""
    if not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    kept, at = [], 0
    for a, b in itertools.batched(spans, 2):
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def n_hit() -> Column:
    """Words of the hit stretches: ends less starts."""
    return F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x
    )


def contamination_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: counts of words, hit words and items, and the SHA-256 of the item list."""
    found = find_contamination(docs.select("doc_id", "text"), items, **options)
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, max_coverage: float = MAX_COVERAGE, **options) -> DataFrame:
    """``docs`` without test items: hit stretches are cut out, texts hit beyond ``max_coverage`` go.

    Coverage is hit words by all words. Columns as given; n_chars, where there
    is one, is counted anew for the texts that were cut. Where a cut brings the
    halves of a window together, that is cut as well.
    """
    own = {c: f"own_{c}_" for c in FOUND if c in docs.columns}
    found = find_contamination(docs.withColumnsRenamed(own), items, cut=True, **options)
    kept = found.where(n_hit() <= max_coverage * F.col("n_words"))
    if "n_chars" in docs.columns:
        cut = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.size("spans") > 0, cut).otherwise(F.col("n_chars")))
    return kept.select(*(F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns))
