"""Language-model scores by prediction by partial matching.

The model predicts a text byte by byte: a blank, its words with a blank behind
each, and where a word could begin the end of the text. A symbol is predicted
from the bytes before it in the text, at most ``DEPTH`` of them, whatever words
they belong to; with ``across`` off, from those in its own word and the blank in
front of it. A context predicts what it has seen by its counts. What it has not
seen is left to the context one byte shorter by an escape, whose chance is that
of the number of distinct symbols seen against all occurrences, and the shorter
context leaves out what the longer one could have predicted. Below the empty
context all symbols are equally likely.

The trie of contexts is a table: contexts of two bytes and more are dealt by
their last two, and read in the order of their reversed bytes, so that a task
passes through the trie branch by branch and holds one path. Shorter contexts,
at most 257, go to every task.

From a word's fifth byte on contexts lie within the word and the blank in front.
Those before see at most the last four bytes in front of that blank, so a text
is the sum of its words' inner scores and of its junctions', and a junction is
the ``DEPTH - 1`` bytes on either side of a blank: 64 bits. Texts are taken in
blocks. A block is kept as word numbers, with a row for each of its distinct
words and keys; these meet their counts and chances in joins and go back to the
block, where sums are plain array arithmetic. What most blocks share does not
travel: the most frequent keys' chances go to every task, and a word that no
other block has needs no count but the block's own.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, bounded_batches, ddl, remainder, staged

DEPTH = 5
HELD_OUT = 10
#: Smoothing of the base score.
ALPHA = 0.1

#: The blank stands before a word and for its end, the line feed for the end of the text; neither is in a word.
BLANK, END = 0x20, 0x0A
SPACES = frozenset((*range(0x09, 0x0E), 0x20))
#: All bytes but white space, a word's end and the text's end.
SYMBOLS = 256 - len(SPACES) + 2

#: Bytes of texts taken together as a block, and of distinct words whose keys are worked out together.
TEXT_BLOCK = 1 << 24
WORD_BLOCK = 1 << 20
#: Keys, the most frequent ones, whose chances go to every task; they are in most blocks. The others' go to theirs.
COMMON = 1 << 19
_PIECE = 1 << 20

ORDER_SHIFT = 8 * (DEPTH + 1)


def words(text: str | None) -> Iterator[list[bytes]]:
    """Words between ASCII white space, A-Z made small, some at a time; null has none."""
    at, text = 0, text or ""
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and text[end] not in " \t\n\v\f\r":
            end += 1
        yield text[at:end].encode("utf-8", "surrogatepass").lower().split()
        at = end


# --- keys of a block ------------------------------------------------------------------------------------------------

#: Bytes on either side of a junction; where the text has none on the left, the text's end stands for them.
SIDE = DEPTH - 1
NOTHING = int.from_bytes(bytes([END]) * SIDE, "big")
SIDE_MASK = (1 << 8 * SIDE) - 1


def grams(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word's place and key of each symbol whose ``DEPTH`` bytes before it are the word's own and the blank in front.

    A key is order, the context's bytes and the symbol.
    """
    raw = np.frombuffer(b"".join(b" " + w + b" " for w in names), dtype=np.uint8).astype(np.int64)
    lengths = np.array([len(w) + 2 for w in names], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(names)), lengths)
    at = np.flatnonzero(np.arange(len(raw)) - starts[word] >= DEPTH)
    key = raw[at]
    for back in range(1, DEPTH + 1):
        key |= raw[at - back] << (8 * back)
    return word[at], key | DEPTH << ORDER_SHIFT


def word_parts(names: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``grams`` of all words, some at a time, each with the place of the first of them."""
    at = size = 0
    for i, name in enumerate(names):
        size += len(name) + 2
        if size >= WORD_BLOCK or i + 1 == len(names):
            yield at, *grams(names[at : i + 1])
            at, size = i + 1, 0


def edges(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First ``SIDE`` bytes of each word with a blank behind, last ones with a blank in front, and how many those are.

    Behind the blank, and in front of it, there are zeros. One word more is the text's end.
    """
    raw = np.frombuffer(b"".join(names) + b" ", dtype=np.uint8).astype(np.int64)
    lengths = np.array([len(w) for w in names], dtype=np.int64)
    ends = np.cumsum(lengths)
    head, tail = np.zeros(len(names) + 1, dtype=np.int64), np.zeros(len(names) + 1, dtype=np.int64)
    for k in range(SIDE):
        front = np.where(k < lengths, raw[np.minimum(ends - lengths + k, len(raw) - 1)], np.where(k == lengths, BLANK, 0))
        back = np.where(k < lengths, raw[np.maximum(ends - 1 - k, 0)], np.where(k == lengths, BLANK, 0))
        head[:-1] |= front << (8 * (SIDE - 1 - k))
        tail[:-1] |= back << (8 * k)
    head[-1] = END << (8 * (SIDE - 1))
    return head.astype(np.uint32), tail.astype(np.uint32), np.minimum(np.append(lengths, 0) + 1, SIDE)


def junctions(names: list[bytes], line: np.ndarray, starts: np.ndarray, across: bool) -> np.ndarray:
    """Bytes on both sides of the blank in front of each word of ``line``: texts one behind another, each with its end.

    ``starts`` are the places where texts begin.
    """
    head, tail, held = edges(names)
    left = np.full(len(line), NOTHING, dtype=np.uint32)
    if across and len(line):
        # A word and its blank are two bytes at least, so the two words before it settle the four bytes.
        two = np.concatenate([tail[:1], tail[line[:-1]]]) & np.uint32(0xFFFF)
        two[starts] = NOTHING & 0xFFFF
        room = np.array([1 << 8 * n & SIDE_MASK for n in range(SIDE + 1)], dtype=np.uint32)[held]
        left[1:] = two[:-1] * room[line[:-1]] | tail[line[:-1]]
        left[starts] = NOTHING
        del two
    return left.astype(np.uint64) << np.uint64(8 * SIDE) | head[line]


def junction_grams(distinct: np.ndarray) -> np.ndarray:
    """Keys of the symbols behind the blank, a row for each place; -1 behind the word's or the text's end."""
    left = (distinct >> np.uint64(8 * SIDE)).astype(np.int64)
    right = (distinct & np.uint64(SIDE_MASK)).astype(np.int64)
    order = np.full(len(distinct), DEPTH, dtype=np.int64)
    for k in range(SIDE):
        order -= left >> (8 * k) & 0xFF == END
    context = left << 8 | BLANK
    keys, there = np.full((SIDE, len(distinct)), -1, dtype=np.int64), np.ones(len(distinct), dtype=bool)
    for k in range(SIDE):
        symbol = right >> (8 * (SIDE - 1 - k)) & 0xFF
        seen = context & ((1 << 8 * order) - 1)
        keys[k, there] = (seen << 8 | symbol | order << ORDER_SHIFT)[there]
        there &= (symbol != BLANK) & (symbol != END)
        context, order = context << 8 & ((1 << 8 * DEPTH) - 1) | symbol, np.minimum(order + 1, DEPTH)
    return keys


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of each one's counts."""
    distinct, place = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *keys]), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate([np.zeros(0), *counts]), len(distinct))


def block_grams(names: list[bytes], n: np.ndarray, distinct: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block and their counts, from those of its words and of its junctions."""
    parts = [summed([key], [n[at + word]]) for at, word, key in word_parts(names)]
    for row in junction_grams(distinct):
        there = row >= 0
        parts.append(summed([row[there]], [counts[there]]))
    return summed([k for k, _ in parts], [c for _, c in parts])


# --- blocks of texts ------------------------------------------------------------------------------------------------

BLOCK_ROWS = {"block": "long", "place": "int", "own": "binary", "word": "binary", "gram": "long", "n": "long"}


def laid_out(ids: np.ndarray, sizes: np.ndarray, n_names: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of texts one behind another, each with its end (the number behind the last word's); where texts begin."""
    ends = np.cumsum(sizes)
    return np.insert(ids.astype(np.int32), ends, n_names), ends + np.arange(len(sizes)) - sizes


def block_rows(docs: DataFrame, across: bool) -> DataFrame:
    """For each block of texts its own row, and a row for each distinct word and each distinct key.

    ``n`` counts word or key in those texts of the block that are learned from;
    ``place`` numbers words, then keys. In the own row it is -1, and ``n`` the
    size of what ``own`` holds packed: texts, words, and the numbers of the texts' words.
    """
    spark = bounded_batches(docs.sparkSession)
    schema = arrow_schema(BLOCK_ROWS)
    learned = (remainder("doc_id", HELD_OUT) != 0).alias("learned")

    def task(batches):
        first = TaskContext.get().partitionId() << 32
        block, size = 0, 0
        place: dict[bytes, int] = {}
        texts: list[tuple] = []
        found: list[np.ndarray] = []

        def part(at, column, values, counts):
            for a in range(0, len(values), 50_000):
                some = values[a : a + 50_000]
                columns = {
                    "block": pa.array(np.full(len(some), first + block, dtype=np.int64)),
                    "place": pa.array(np.arange(at + a, at + a + len(some), dtype=np.int32)),
                    column: pa.array(some, schema.field(column).type),
                    "n": pa.array(counts[a : a + 50_000].astype(np.int64)),
                }
                arrays = [columns.get(f.name, pa.nulls(len(some), f.type)) for f in schema]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        def rows():
            names, sizes = list(place), np.array([len(f) for f in found], dtype=np.int64)
            ids = np.concatenate([np.zeros(0, dtype=np.int32), *found])
            line, starts = laid_out(ids, sizes, len(names))
            use = np.repeat(np.array([t[1] for t in texts], dtype=np.float64), sizes + 1)
            n = np.bincount(line, use, len(names) + 1)[:-1]
            distinct, which = np.unique(junctions(names, line, starts, across), return_inverse=True)
            keys, counts = block_grams(names, n, distinct, np.bincount(which, use, len(distinct)))
            # Bytes of the numbers lie by their rank, which packs well.
            numbers = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
            raw = pickle.dumps((texts, sizes, names, numbers, len(keys)))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [first + block],
                    "place": [-1],
                    "own": [pa.compress(raw, codec="zstd", asbytes=True)],
                    "word": [None],
                    "gram": [None],
                    "n": [len(raw)],
                },
                schema=schema,
            )
            yield from part(0, "word", names, n)
            yield from part(len(names), "gram", keys, counts)

        for batch in batches:
            for doc_id, text, use in zip(*(c.to_pylist() for c in batch.columns)):
                known = place.setdefault
                ids = [np.fromiter((known(w, len(place)) for w in some), dtype=np.int32) for some in words(text)]
                found.append(np.concatenate([np.zeros(0, dtype=np.int32), *ids]))
                texts.append((doc_id, use))
                size += len(text or "")
                if size >= TEXT_BLOCK:
                    yield from rows()
                    block, size, place, texts, found = block + 1, 0, {}, [], []
        if texts:
            yield from rows()

    return docs.select("doc_id", "text", learned).mapInArrow(task, ddl(BLOCK_ROWS))


# --- the trie -------------------------------------------------------------------------------------------------------


class Path:
    """The contexts from the empty one to the one at hand, each with its symbols' counts."""

    def __init__(self, short: dict[bytes, dict[int, int]]):
        self.short = short
        self.long: list[tuple[bytes, dict[int, int]]] = []

    def enter(self, context: bytes, seen: dict[int, int]) -> None:
        """Go to ``context``, leaving those that are no ends of it."""
        self.leave(context)
        if seen:
            self.long.append((context, seen))

    def leave(self, context: bytes) -> None:
        while self.long and not context.endswith(self.long[-1][0]):
            self.long.pop()

    def chance(self, context: bytes, symbol: int) -> float:
        """log10 of the chance of ``symbol``, the path being at ``context`` or at its longest known end."""
        chance, passed = 0.0, set()
        shorter = [self.short.get(context[-1:]) if context else None, self.short.get(b"")]
        for seen in [*(s for _, s in reversed(self.long)), *shorter]:
            if not seen:
                continue
            left = [c for s, c in seen.items() if s not in passed] if passed else seen.values()
            if not left:
                continue
            total, kinds = sum(left), len(left)
            if symbol in seen:
                return chance + math.log10(seen[symbol] / (total + kinds))
            chance += math.log10(kinds / (total + kinds))
            passed.update(seen)
        return chance - math.log10(max(SYMBOLS - len(passed), 1))


def unpacked(key: int) -> tuple[bytes, int]:
    """Context and symbol of a key."""
    order = key >> ORDER_SHIFT
    raw = (key & (1 << ORDER_SHIFT) - 1).to_bytes(DEPTH + 1, "big")
    return raw[DEPTH - order : DEPTH], raw[DEPTH]


def shorter_contexts(counted: DataFrame) -> DataFrame:
    """(gram, n) of all orders, from the counts of longest contexts: a context counts for all its ends.

    Keys of count 0, that only texts not learned from hold, stay as they are.
    """
    order = F.shiftright("gram", ORDER_SHIFT).cast("int")
    masks = F.array(*(F.lit((1 << 8 * (i + 1)) - 1).cast("long") for i in range(DEPTH + 1)))
    marks = F.array(*(F.lit(i << ORDER_SHIFT).cast("long") for i in range(DEPTH + 1)))

    def end(o):
        return F.col("gram").bitwiseAND(F.element_at(masks, o + 1)).bitwiseOR(F.element_at(marks, o + 1))

    all_orders = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), order), end)).otherwise(F.array("gram"))
    return counted.select("n", F.explode(all_orders).alias("gram")).groupBy("gram").agg(F.sum("n").alias("n"))


def gram_scores(counted: DataFrame, short: dict[bytes, dict[int, int]]) -> DataFrame:
    """gram and its log10 chance, for those keys of (gram, n) whose context is the longest.

    A key of count 0 is one that only texts not learned from need. ``short``
    holds the contexts of up to one byte.
    """
    spark = bounded_batches(counted.sparkSession)
    shared = spark.sparkContext.broadcast(short)
    order = F.shiftright("gram", ORDER_SHIFT)
    # The context's bytes from the last to the first, which sorts a context behind its ends.
    reverse = F.lit(0).cast("long")
    for i in range(DEPTH):
        byte = F.shiftright("gram", 8 * (i + 1)).bitwiseAND(F.lit(255))
        reverse = reverse + F.when(order > i, F.shiftleft(byte, 8 * (DEPTH - 1 - i))).otherwise(F.lit(0))
    rows = counted.where(order >= 2).select(
        "gram", "n", reverse.alias("reverse"), order.alias("order"), F.shiftright("gram", 8).bitwiseAND(F.lit(65535)).alias("branch")
    )
    rows = rows.repartition("branch").sortWithinPartitions("branch", "reverse", "order", "gram").select("gram", "n")
    columns = {"gram": "long", "chance": "double"}
    schema = arrow_schema(columns)

    def task(batches):
        path, context, seen, wanted = Path(shared.value), None, {}, []
        made: list[tuple[int, float]] = []

        def close():
            path.enter(context, seen)
            if len(context) == DEPTH or context[0] == BLANK:
                total = sum(seen.values()) + len(seen)
                for key, symbol in wanted:
                    n = seen.get(symbol)
                    made.append((key, math.log10(n / total) if n else path.chance(context, symbol)))

        for batch in batches:
            for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, symbol = unpacked(key)
                if at != context:
                    if context is not None:
                        close()
                    context, seen, wanted = at, {}, []
                if n:
                    seen[symbol] = n
                wanted.append((key, symbol))
            if len(made) >= 10_000:
                yield batch_of(made)
                made = []
        if context is not None:
            close()
        yield batch_of(made)

    def batch_of(made):
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in made], pa.int64()), pa.array([c for _, c in made], pa.float64())], schema=schema
        )

    return rows.mapInArrow(task, ddl(columns))


# --- operators ------------------------------------------------------------------------------------------------------


def key_chances(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """gram and n of all contexts, and gram and its log10 chance, of (gram, n) rows, which may repeat.

    The driver gets the counts of contexts of up to one byte, at most 257 times 257.
    """
    counted = staged(shorter_contexts(keyed.groupBy("gram").agg(F.sum("n").alias("n"))), "counts")
    short: dict[bytes, dict[int, int]] = {b"": {}, b" ": {}}
    wanted = []
    for r in counted.where(F.shiftright("gram", ORDER_SHIFT) < 2).collect():
        context, symbol = unpacked(r["gram"])
        wanted.append((r["gram"], context, symbol))
        if r["n"]:
            short.setdefault(context, {})[symbol] = r["n"]
    path = Path(short)
    # A context of one byte is the longest only before a text's first byte, or a word's.
    begins = [(key, path.chance(context, symbol)) for key, context, symbol in wanted if context == b" "]
    spark = keyed.sparkSession
    chances = gram_scores(counted, short).unionAll(spark.createDataFrame(begins, "gram bigint, chance double"))
    return counted, staged(chances, "chances")


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """Keys of ``DEPTH`` bytes whose counts reach a power of two, the least one that ``most`` keys at most reach."""
    deep = counted.where((F.shiftright("gram", ORDER_SHIFT) == DEPTH) & (F.col("n") > 0))
    power = F.floor(F.log2("n")).cast("int")
    found, least = 0, 62
    for r in deep.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():
        found += r["count"]
        if found > most:
            break
        least = r["power"]
    return deep.where(F.col("n") >= F.lit(1 << least)).select("gram")


def score_texts(docs: DataFrame, across: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of ``docs``.

    Texts whose crc32(doc_id) leaves 0 modulo ``HELD_OUT`` are scored and not
    learned from; a null doc_id is one of them. Null and empty texts are their
    end alone, repeated rows are texts of their own. Without a text to learn
    from, the base score is that of V + 1 = 1 unseen tokens and the model's
    chances are all equal. Other columns are not carried. ``across`` lets
    contexts run over the blanks between words, so that the order of words counts.

    Texts are read once: their blocks are staged.
    """
    rows = staged(block_rows(docs, across), "texts")
    named, keyed = rows.where("word is not null"), rows.where("gram is not null")
    vocabulary = staged(named.groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")
    learned = docs.where(remainder("doc_id", HELD_OUT) != 0).count()
    total = vocabulary.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n, distinct = (total[0] or 0) + learned, total[1] + (learned > 0)
    below = n + ALPHA * (distinct + 1)
    counts, chances = key_chances(keyed.select("gram", "n"))
    common = F.broadcast(most_frequent(counts, COMMON))
    found = chances.join(common, "gram", "left_semi").orderBy("gram").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(tuple(np.asarray(c.to_numpy()) for c in found.columns))

    nothing = F.lit(None).cast("binary").alias("own")
    counted = named.select("block", "place", "word", "n").join(vocabulary, "word").where("c <> n")
    counted = counted.select("block", "place", nothing, F.col("c").cast("double").alias("value"))
    rare = keyed.select("block", "place", "gram").join(common, "gram", "left_anti")
    scored = rare.join(chances, "gram")
    scored = scored.select("block", "place", nothing, F.col("chance").alias("value"))
    own = rows.where("own is not null").select("block", "place", "own", F.col("n").cast("double").alias("value"))
    # The block's own row sorts first.
    together = own.unionAll(counted).unionAll(scored).repartition("block").sortWithinPartitions("block", F.col("place") >= 0)
    end_base, end_known = math.log10((learned + ALPHA) / below), int(learned > 0)
    made = {
        "doc_id": "long",
        "held_out": "boolean",
        "n_tokens": "long",
        "n_known": "long",
        "train_tokens": "long",
        "base_score": "double",
        "score": "double",
    }
    schema = arrow_schema(made)

    def task(batches):
        block, held, values = None, None, None

        def result():
            texts, sizes, names, numbers, n_keys = held
            ids = np.frombuffer(numbers, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
            line, starts = laid_out(ids, sizes, len(names))
            # Words and keys that no row came for: those no other block has, and the most frequent ones.
            use = np.repeat(np.array([t[1] for t in texts], dtype=np.float64), sizes + 1)
            c, chance = values[: len(names)], values[len(names) :]
            c = np.where(np.isnan(c), np.bincount(line, use, len(names) + 1)[:-1], c)
            distinct, which = np.unique(junctions(names, line, starts, across), return_inverse=True)
            places = junction_grams(distinct)
            parts = [np.unique(k) for _, _, k in word_parts(names)] + [np.unique(p[p >= 0]) for p in places]
            keys = np.unique(np.concatenate(parts))
            if len(keys) != n_keys:
                raise RuntimeError("a block's keys are not those it was staged with")
            waiting = np.flatnonzero(np.isnan(chance))
            chance[waiting] = shared.value[1][np.searchsorted(shared.value[0], keys[waiting])]
            inner = np.zeros(len(names) + 1)
            for at, word, key in word_parts(names):
                some = np.bincount(word, chance[np.searchsorted(keys, key)])
                inner[at : at + len(some)] += some
            joint = np.zeros(len(distinct))
            for row in places:
                there = np.flatnonzero(row >= 0)
                joint[there] += chance[np.searchsorted(keys, row[there])]
            score = np.add.reduceat(joint[which] + inner[line], starts)
            base = np.add.reduceat(np.append(np.log10((c + ALPHA) / below), end_base)[line], starts)
            seen = np.add.reduceat(np.append(c > 0, False).astype(np.int64)[line], starts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([t[0] for t in texts], pa.int64()),
                    pa.array([not t[1] for t in texts]),
                    pa.array(sizes + 1),
                    pa.array(seen + end_known),
                    pa.array(np.full(len(texts), n, dtype=np.int64)),
                    pa.array(base),
                    pa.array(score),
                ],
                schema=schema,
            )

        for batch in batches:
            blocks = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if block != blocks[a]:
                    if block is not None:
                        yield result()
                    block, packed = blocks[a], part.column(2)[0].as_py()
                    held = pickle.loads(pa.decompress(packed, int(part.column(3)[0].as_py()), codec="zstd", asbytes=True))
                    values = np.full(len(held[2]) + held[4], np.nan)
                    part = part.slice(1)
                values[np.asarray(part.column(1))] = np.asarray(part.column(3))
        if block is not None:
            yield result()

    return together.mapInArrow(task, ddl(made))
