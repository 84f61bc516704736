"""Phrases that occur more often than their parts let expect, counted with HAT-tries.

A task counts phrases of n words in a trie over word numbers: the root has a
child for each first word, and a child is a hash container of the rest of the
phrase until it holds many entries, when it bursts into a node of containers by
the next word. When the trie is full its largest subtrees are spilled as sorted
runs, which go to the partition of their prefix, the first word. There the runs
of all tasks are merged, and only phrases that are frequent enough leave it. A
frequent word's subtree is dealt to several partitions by its second word, so
that no partition grows with the most frequent word.

Lengths are counted one after the other, since a phrase is as frequent as asked
only if all its parts are. What is frequent is told to the tasks of the next
pass by a bitmap of fixed size (hashes of words and of word pairs): it never
grows with the data, and a false positive only means a row more, as frequent
phrases are picked by their true counts.
"""

from __future__ import annotations

from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, bounded_batches, ddl, staged

#: Phrases of one to so many words.
LONGEST = 3
#: Entries of a trie before it spills, of a container before it bursts, and words that a task has numbered at most.
TRIE_ENTRIES = 600_000
BURST = 4_096
NUMBERED_WORDS = 1 << 19
#: Bits of the bitmap of frequent words and pairs (16 MB), and bits of one slice of it, which one task makes.
BITMAP_BITS = 1 << 27
SLICE_BITS = 1 << 19
#: A first word of at least this share of a language's words is dealt to partitions by its second word.
HOT_SHARE = 1 / 2_000
HOT_PARTS = 64
#: Bytes of text for which there is one prefix partition.
PART_BYTES = 2 << 20

_WORD_BITS = 21
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
# A-Z made small, tabs blanks, and every end of a piece a stop.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 9 else 0x2E if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def pieces(text: str | None) -> list[bytes]:
    """The words of a text in order, with b"." between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).replace(b".", b" . ").split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\x00" + word)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _ODD[0] + second * _ODD[1] + _ODD[2])


class Numbers(dict):
    """Numbers of a language's words, given as they come; 0 is the end of a piece."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        super().__init__({b".": 0})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.names)
        self.names.append((self.lang, word))
        return number


def counted_into(container: dict[int, int], keys: list[int]) -> None:
    get = container.get
    if len(keys) < 32:
        for key in keys:
            container[key] = get(key, 0) + 1
    else:
        for key, n in Counter(keys).items():
            container[key] = get(key, 0) + n


class HatTrie:
    """Counts of phrases as numbers: the first word in the upper bits, the rest below.

    ``children`` of the root and of burst containers (``burst_into``) are
    dictionaries by word number; a container is one by the packed rest of the
    phrase, with counts.
    """

    def __init__(self, words: int, burst: int = BURST):
        self.words, self.burst = words, burst
        self.children: dict[int, dict] = {}
        self.burst_into: set[int] = set()
        self.entries = 0
        self.sizes: dict[int, int] = {}

    def add(self, phrases: np.ndarray) -> None:
        """Counts an array of packed phrases; single words are one container under the number 0."""
        phrases = np.sort(phrases)
        shift = _WORD_BITS * max(1, self.words - 1)
        firsts = phrases >> shift
        rest = phrases & ((1 << shift) - 1)
        cuts = [0, *(np.flatnonzero(firsts[1:] != firsts[:-1]) + 1).tolist(), len(firsts)] if len(firsts) else [0]
        heads, rest = firsts[cuts[:-1]].tolist(), rest.tolist()
        children, sizes, grown = self.children, self.sizes, 0
        for first, a, b in zip(heads, cuts, cuts[1:]):
            child = children.get(first)
            if child is None:
                child = children[first] = {}
                sizes[first] = 0
            before = sizes[first]
            sizes[first] = size = self.insert(first, child, rest[a:b])
            grown += size - before
        self.entries += grown

    def insert(self, first: int, child: dict, rest: list[int]) -> int:
        low = (1 << _WORD_BITS) - 1
        if first not in self.burst_into:
            counted_into(child, rest)
            if self.words > 2 and len(child) > self.burst:
                node: dict[int, dict[int, int]] = {}
                for key, n in child.items():
                    node.setdefault(key >> _WORD_BITS, {})[key & low] = n
                self.children[first] = node
                self.burst_into.add(first)
            return len(child)
        grown = self.sizes[first]
        for second, keys in groupby(rest, lambda key: key >> _WORD_BITS):
            container = child.setdefault(second, {})
            before = len(container)
            counted_into(container, [key & low for key in keys])
            grown += len(container) - before
        return grown

    def spill(self, keep: int):
        """The largest subtrees, taken out until ``keep`` entries are left: (first word, rests and counts)."""
        for first in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= keep:
                return
            child = self.children.pop(first)
            self.entries -= self.sizes.pop(first)
            if first not in self.burst_into:
                yield first, child.items()
            else:
                self.burst_into.discard(first)
                yield first, ((second << _WORD_BITS | third, n) for second, c in child.items() for third, n in c.items())


class Frequent:
    """A bitmap of hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % np.uint64(len(self.bits) * 8)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


#: A run of one prefix partition: phrases in order, ended by line ends, and their counts.
RUNS = {"part": "long", "lang": "string", "phrases": "binary", "counts": "binary"}
COUNTS = {"lang": "string", "phrase": "string", "a": "long"}


class Counting:
    """One task's pass over texts, for phrases of ``words`` words; gives runs (part, lang, phrases, counts)."""

    def __init__(
        self, words: int, parts: int, frequent: np.ndarray | None, hot: set[tuple[str, bytes]], limit: int, burst: int, numbered: int
    ):
        self.words, self.parts, self.hot, self.limit, self.burst, self.numbered = words, parts, hot, limit, burst, numbered
        self.frequent = Frequent(frequent) if frequent is not None else None
        self.afresh()

    def afresh(self) -> None:
        self.names: list[tuple[str, bytes]] = [("", b"")]
        self.numbers: dict[str, Numbers] = {}
        self.hashes, self.good = np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=bool)
        self.trie = HatTrie(self.words, self.burst)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def rows(self, texts: list[str | None], langs: list[str | None]):
        """Runs that the texts make the trie spill."""
        by_lang: dict[str, list[bytes]] = {}
        for text, lang in zip(texts, langs):
            by_lang.setdefault("und" if lang is None else lang, []).extend([*pieces(text), b"."])
        for lang, words in by_lang.items():
            step = max(1, self.numbered // 8)
            # Cut long word lists so that new numbers fit; cuts overlap by the words that a phrase needs.
            for at in range(0, len(words), step):
                if len(self.names) + min(step, len(words) - at) > self.numbered:
                    yield from self.rest()
                numbers = self.numbers.setdefault(lang, Numbers(lang, self.names))
                some = words[at : at + step + self.words - 1]
                found = self.phrases(np.fromiter(map(numbers.__getitem__, some), dtype=np.int64, count=len(some)), step)
                self.held.append(found)
                self.n_held += len(found)
                if self.n_held >= self.limit:
                    self.count()
                    if self.trie.entries > self.limit:
                        yield from self.runs(self.limit // 2)

    def count(self) -> None:
        """Counts the phrases held back, so that a subtree is visited for many at once."""
        if self.held:
            self.trie.add(np.concatenate(self.held))
        self.held, self.n_held = [], 0

    def phrases(self, ids: np.ndarray, most: int) -> np.ndarray:
        """Packed phrases that start at the first ``most`` words, if none of their parts is known to be rare."""
        new = self.names[len(self.hashes) :]
        if new:
            made = np.array([word_hash(*name) for name in new], dtype=np.uint64)
            self.hashes = np.concatenate([self.hashes, made])
            good = self.frequent.holds(mixed(made)) if self.frequent else np.ones(len(made), dtype=bool)
            self.good = np.concatenate([self.good, good])
        n = max(0, min(most, len(ids) - self.words + 1))
        kept = self.good[ids]
        starts = np.ones(n, dtype=bool)
        for i in range(self.words):
            starts &= kept[i : i + n]
        starts = np.flatnonzero(starts)
        if self.words > 2:
            h = self.hashes[ids]
            for i in range(self.words - 1):
                starts = starts[self.frequent.holds(pair_hash(h[starts + i], h[starts + i + 1]))]
        packed = ids[starts]
        for i in range(1, self.words):
            packed = packed << _WORD_BITS | ids[starts + i]
        return packed

    def runs(self, keep: int):
        """Whole subtrees, the largest first, until ``keep`` entries are left, as a run for each partition and language."""
        low, names, hashes = (1 << _WORD_BITS) - 1, self.names, self.hashes
        made: dict[tuple[int, str], tuple[list[bytes], list[int]]] = {}
        # In order of the first words, and each subtree in order of the rest.
        for first, entries in sorted(self.trie.spill(keep), key=lambda subtree: names[subtree[0]][1]):
            lang, word = names[first]
            if self.words == 1:
                entries = list(entries)
                part = (hashes[[key for key, _ in entries]] % np.uint64(self.parts)).tolist()
                held: dict[tuple[int, str], list] = {}
                for (key, n), p in zip(entries, part):
                    held.setdefault((p, names[key][0]), []).append((names[key][1], n))
                made |= {key: tuple(zip(*sorted(own))) for key, own in held.items()}
                continue
            part, head = int(hashes[first]) % self.parts, word + b" "
            if self.words == 2:
                rest = [(names[key][1], n, key) for key, n in entries]
            else:
                rest = [(names[key >> _WORD_BITS][1] + b" " + names[key & low][1], n, key >> _WORD_BITS) for key, n in entries]
            rest.sort()
            if (lang, word) not in self.hot:
                phrases, counts = made.setdefault((part, lang), ([], []))
                phrases += [head + r for r, _, _ in rest]
                counts += [n for _, n, _ in rest]
                continue
            # A frequent word's phrases go to partitions by their second word.
            for r, n, second in rest:
                phrases, counts = made.setdefault(((part + int(hashes[second]) % HOT_PARTS) % self.parts, lang), ([], []))
                phrases.append(head + r)
                counts.append(n)
        for (part, lang), (phrases, counts) in made.items():
            yield part, lang, b"\n".join(phrases), np.array(counts, dtype=np.int64).tobytes()

    def rest(self):
        self.count()
        yield from self.runs(0)
        self.afresh()


def in_batches(runs, limit: int = 4 << 20):
    """Runs put together to batches of bounded bytes."""
    held, n = [], 0

    def batch():
        arrays = [pa.array([r[i] for r in held], f.type) for i, f in enumerate(arrow_schema(RUNS))]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema(RUNS))

    for run in runs:
        held.append(run)
        n += len(run[2]) + len(run[3])
        if n >= limit:
            yield batch()
            held, n = [], 0
    yield batch()


def merged(runs: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a of the phrases of at least ``least`` occurrences; a null phrase has all of a language and partition.

    A partition's runs follow each other, and a phrase is in one partition only;
    a partition is held at a time, its phrases bounded by the number of partitions.
    """
    schema = arrow_schema(COUNTS)

    def task(batches):
        now, found = None, {}

        def done():
            rows = []
            for lang, counts in found.items():
                rows.append((lang, None, sum(counts.values())))
                rows += [(lang, p.decode("utf-8", "surrogatepass"), n) for p, n in counts.items() if n >= least]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            for part, lang, phrases, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    yield done()
                    now, found = part, {}
                own = found.setdefault(lang, {})
                get = own.get
                for phrase, n in zip(phrases.split(b"\n"), np.frombuffer(counts, dtype=np.int64).tolist()):
                    own[phrase] = get(phrase, 0) + n
        yield done()

    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(task, ddl(COUNTS))


def counted(
    docs: DataFrame, words: int, parts: int, frequent: Broadcast | None, hot: Broadcast | None, least: int, sizes: tuple[int, int, int]
) -> DataFrame:
    """``merged`` counts of phrases of ``words`` words; with ``frequent`` maybe not those with rare parts."""
    bounded_batches(docs.sparkSession)

    def task(batches):
        own = Counting(words, parts, frequent.value if frequent else None, hot.value if hot else set(), *sizes)

        def runs():
            for batch in batches:
                yield from own.rows(*(c.to_pylist() for c in batch.columns))
            yield from own.rest()

        yield from in_batches(runs())

    runs = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(task, ddl(RUNS))
    return merged(runs, least)


def bitmap(phrases: DataFrame, words: int, bits: int = BITMAP_BITS) -> np.ndarray:
    """The bitmap of the hashes of phrases of one or two words, made slice by slice in tasks."""
    spark = bounded_batches(phrases.sparkSession)
    slice_bits = min(SLICE_BITS, bits)
    spread = {"slice": "int", "bit": "int"}

    def place(batches):
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            parts = [[word_hash(lang, w) for lang, t in zip(langs, texts) for w in t.encode().split(b" ")[i : i + 1]] for i in range(words)]
            hashes = [np.array(p, dtype=np.uint64) for p in parts]
            at = (mixed(hashes[0]) if words == 1 else pair_hash(*hashes)) % np.uint64(bits)
            arrays = [pa.array((at // np.uint64(slice_bits)).astype(np.int32)), pa.array((at % np.uint64(slice_bits)).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema(spread))

    columns = {"slice": "int", "bits": "binary"}

    def pack(batches):
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            slices, places = (np.asarray(c) for c in batch.columns)
            for s in np.unique(slices).tolist():
                own = made.setdefault(s, np.zeros(slice_bits // 8, dtype=np.uint8))
                at = places[slices == s]
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
            if len(made) > 64:
                yield packed(made)
                made.clear()
        yield packed(made)

    def packed(made):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(made), pa.int32()), pa.array([b.tobytes() for b in made.values()], pa.binary())], schema=arrow_schema(columns)
        )

    out = np.zeros(bits // 8, dtype=np.uint8)
    n_slices = max(1, bits // slice_bits)
    places = phrases.select("lang", "phrase").mapInArrow(place, ddl(spread)).distinct()
    rows = places.repartition(min(n_slices, int(spark.conf.get("spark.sql.shuffle.partitions"))), "slice").mapInArrow(pack, ddl(columns))
    # At most one row a slice and task, together as large as the bitmap or little more.
    for s, own in zip(*(c.to_pylist() for c in rows.toArrow().columns)):
        out[s * slice_bits // 8 : (s + 1) * slice_bits // 8] |= np.frombuffer(own, dtype=np.uint8)
    return out


def part(phrase: str, first: int, last: int):
    """Words ``first`` to ``last`` of a phrase column."""
    return F.array_join(F.slice(F.split(phrase, " "), first, last - first + 1), " ")


def scored(candidates: DataFrame, parts: DataFrame, words: int) -> DataFrame:
    """``candidates`` (lang, phrase, a) with l, r and score of their lowest-scoring cut."""
    out = candidates
    for k in range(1, words):
        left = parts.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("left"), F.col("a").alias(f"l{k}"))
        right = parts.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("right"), F.col("a").alias(f"r{k}"))
        out = out.withColumns({"left_part": part("phrase", 1, k), "right_part": part("phrase", k + 1, words)})
        out = out.join(left, (out["lang"] == left["lang_l"]) & (out["left_part"] == left["left"]))
        out = out.join(right, (out["lang"] == right["lang_r"]) & (out["right_part"] == right["right"]))
        # Counts below 10^13 keep all products within 38 digits.
        a, left_n, right_n = (f"CAST({c} AS DECIMAL(13, 0))" for c in ("a", f"l{k}", f"r{k}"))
        out = out.withColumn(f"s{k}", F.expr(f"({a} * {a} * 1000000BD) div ({left_n} * {right_n})"))
        out = out.drop("lang_l", "left", "lang_r", "right", "left_part", "right_part")
    cuts = [F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, words)]
    least = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return out.withColumn("cut", least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame,
    least: int = 10,
    cover: tuple[int, int] = (50, 100),
    most: int = 2_000,
    entries: int = TRIE_ENTRIES,
    burst: int = BURST,
    numbered: int = NUMBERED_WORDS,
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of two and three words of each language.

    ``docs`` has text and lang; other columns are left out. A-Z are made small.
    Pieces end at ``. , ; : ! ?`` and line ends, words at blanks and tabs; a
    phrase lies within a piece. Null, empty and blank texts have no words, a null
    lang is ``und``; every row counts, repeated ones too. A phrase of at least
    ``least`` occurrences is a candidate; its score is floor(10^6 a a / (l r))
    of its lowest cut (ties: the first). It is left out if a longer candidate
    that contains it has at least the ``cover`` share of its occurrences. Order
    is by score and a, falling, then by the phrase's bytes. No words, no rows.
    """
    spark = bounded_batches(docs.sparkSession)
    sizes = (entries, burst, min(numbered, 1 << _WORD_BITS))
    # Partitions follow from the bytes of the texts, of which a word takes six or so.
    parts = max(16, (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES)
    ones = staged(counted(docs, 1, parts, None, None, least, sizes), "words")
    totals = staged(ones.where("phrase is null").groupBy("lang").agg(F.sum("a").alias("n")).where("n > 0"), "totals")
    words = ones.where("phrase is not null")
    # At most 1 / HOT_SHARE words of a language.
    often = words.join(totals, "lang").where(F.col("a") >= F.col("n") * HOT_SHARE).select("lang", "phrase").toArrow()
    hot = spark.sparkContext.broadcast({(lang, p.encode()) for lang, p in zip(*(c.to_pylist() for c in often.columns))})
    known = bitmap(words, 1, bits)
    told = spark.sparkContext.broadcast(known)
    twos = staged(counted(docs, 2, parts, told, hot, least, sizes).where("phrase is not null"), "pairs")
    told.unpersist()
    told = spark.sparkContext.broadcast(known | bitmap(twos, 2, bits))
    threes = staged(counted(docs, 3, parts, told, hot, least, sizes).where("phrase is not null"), "triples")
    told.unpersist()
    inner = F.explode(F.array(part("phrase", 1, 2), part("phrase", 2, 3)))
    covers = threes.select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = twos.join(covers, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * cover[1] < F.col("a") * cover[0])
    )
    found = scored(free.select("lang", "phrase", "a"), words, 2).unionAll(scored(threes, words.unionAll(twos), 3))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
