import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelog.llm.packing import cuts, pack
from tidelog.llm.token_files import read_token_files, stored_digest, write_token_files
from tidelog.llm.tokens import Words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, text, end):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4")


def odd_texts(n=400, seed=5):
    rng = random.Random(seed)
    pieces = [
        "the", "The", "word", "naïve", "ÄÖ", "ß", "'s", "don't", "12", "3.14", "!!", "***", "...", "«x»", "中文", "🙂", "á",
        " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x1c", "\x00", "_", "-", "<|endoftext|>", "İ", "ﬁ", "’", "x" * 30,
    ]
    return ["".join(rng.choice(pieces) + rng.choice(("", " ")) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_remembered_words_give_the_ids_of_whole_texts(path):
    with open(path, encoding="utf-8") as file:
        words = Words(file.read())
    whole = Tokenizer.from_file(path)
    for text in odd_texts():
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.text(text), dtype="<u4").tolist() == ids, text


@pytest.mark.parametrize("capacity", [1, 7, 100, 1024])
def test_cuts_are_whole_and_fit(capacity):
    for n in range(1, 3 * capacity + 2):
        pieces = cuts(n, capacity)
        assert sum(pieces) == n and max(pieces) <= capacity


def check_packed(rows, docs, capacity):
    ids = [(i, ids_of(BYTES, t, 0)) for i, t in docs]
    sizes = defaultdict(list)
    for i, x in ids:
        sizes[i].append(x)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
        assert any(
            r["doc_tokens"] == len(x) and zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            for x in sizes[r["doc_id"]]
        )
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for i, arrays in sizes.items():
        assert sum(r["length"] for r in pieces[i]) == sum(map(len, arrays))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for capacity in (16, 1024):
        check_packed(pack(odd_docs, BYTES, capacity).collect(), docs, capacity)
    assert pack(no_docs, BYTES).count() == 0


def test_padding_is_small(spark):
    docs = [(i, t * 40) for i, t in enumerate(odd_texts(300, 9))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    used = pack(df, BYTES, with_ids=False).groupBy("sequence_id").agg({"length": "sum"}).collect()
    padding = sum(0 if n & n - 1 == 0 else 1024 - n for _, n in used)
    assert padding <= 0.02 * sum(n for _, n in used)


def test_files_round_trip(spark, odd_docs, no_docs, path):
    write_token_files(odd_docs, WORDS, path)
    stored = read_token_files(spark, path)
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted(stored_digest(stored).collect(), key=lambda r: r["start"])
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        assert any(
            i == r["doc_id"] and len(x) == r["n_tokens"] and zlib.crc32(x.tobytes()) == r["ids_crc32"]
            for i, x in ((i, ids_of(WORDS, t, 1)) for i, t in docs)
        )
    order = [r["doc_id"] for r in got]
    assert len(got) == len(docs) and order == sorted(order, key=lambda i: (i is not None, i))
    found = stored.where("doc_id = 7").collect()
    assert [r["ids"] for r in found] == [ids_of(WORDS, docs[[d[0] for d in docs].index(7)][1], 1).tolist()]
    write_token_files(no_docs, WORDS, path + "-none")
    assert stored_digest(read_token_files(spark, path + "-none")).count() == 0
