import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolith.llm import direct_codes, packing, tokens
from aerolith.llm.common import new_path

PLAIN = Tokenizer.from_file(tokens.VOCABULARY)


def ids(text, end):
    found = PLAIN.encode(text or "", add_special_tokens=False).ids + [end]
    return np.array(found, "<u4").tobytes()


def test_cached_words_give_the_library_s_ids():
    encoder, rng = tokens.WordEncoder(tokens.VOCABULARY), random.Random(1)
    letters = " \n\tab1.'s é!日 \x1d᠎"
    cases = ["", " ", "  a", "a \n b", "don't 's", "<|endoftext|> a<|endoftext|>", "a\tb \tc", " lead", "x" * 200 + " y"]
    cases += ["as.\nOnnd\r\nb\t\t\nc", "\nlead", "a\n\nb", "zu%%% Ra!!\nUn&&&", "a<|endoftext|\n>b", "x'\n's don't!'", "a\n\x85\nb"]
    cases += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    for text in cases:
        assert encoder.encode(text) == ids(text, 0)[:-4], repr(text)


def test_slices_of_long_texts_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_CHARS", 7)
    encoder, rng = tokens.WordEncoder(tokens.VOCABULARY), random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice(" \nab.é") for _ in range(rng.randint(1, 60)))
        assert encoder.encode(text) == ids(text, 0)[:-4], repr(text)


def test_full_memory_of_words_changes_nothing():
    encoder = tokens.WordEncoder(tokens.VOCABULARY, most_words=2)
    text = "one two three two one four."
    assert encoder.encode(text) == encoder.encode(text) == ids(text, 0)[:-4]


@pytest.mark.parametrize("high", [2, 300, 70_000, 2**32])
def test_direct_codes_round_trip_and_random_access(high):
    values = np.random.default_rng(high).integers(0, high, 3000).astype(np.uint32)
    levels, bitmaps, ranks = direct_codes.encode(values)
    assert (direct_codes.decode(levels, bitmaps) == values).all()
    for i in [0, 1, 511, 512, 513, 1024, 2999, *range(0, 3000, 97)]:
        assert direct_codes.token_at(levels, bitmaps, ranks, i) == values[i]


def check_files(rows, found):
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r[0] for r in expected]
    start, stream = 0, b""
    for (_, text), row in zip(expected, found, strict=True):
        data = ids(text, 2)
        assert (row.start, row.n_tokens, bytes(row.ids)) == (start, len(data) // 4, data)
        start, stream = start + len(data) // 4, stream + data
    return np.frombuffer(stream, "<u4")


def test_token_files_of_odd_rows(spark, made, nothing):
    path = new_path(spark, "test-files")
    found = direct_codes.token_files(made.repartition(3), path, segment_tokens=100).collect()
    stream = check_files([(r.doc_id, r.text) for r in made.collect()], found)
    wanted = spark.range(0, len(stream) + 50, 37).withColumnRenamed("id", "position")
    for row in direct_codes.lookup(spark, path, wanted, bucket=1000).collect():
        assert row.id == stream[row.position]
    assert direct_codes.lookup(spark, path, wanted, bucket=1000).count() == -(-len(stream) // 37)
    assert direct_codes.token_files(nothing).collect() == []


def test_token_files_of_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check_files(rows, direct_codes.token_files(documents).collect())


def valid(entries, counts, capacity):
    """Fill the sequences as the plan says; returns how many there are."""
    filled = {}
    for length, rank, pieces, first, each, offset in entries:
        for i in range(pieces):
            filled.setdefault(first + i // each, []).append((offset + i % each * length, length))
    placed = sorted((e[0], e[1], e[2]) for e in entries)
    for length, count in counts.items():
        runs = [(r, n) for n_, r, n in placed if n_ == length]
        assert [r for r, _ in runs] == list(np.cumsum([0, *(n for _, n in runs)])[:-1]) and sum(n for _, n in runs) == count
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(filled) == list(range(len(filled)))
    return len(filled)


def brute_force(counts, capacity):
    """The same method, item by item: pairs of large items, then best fit of small ones in falling order."""
    large = sorted((n for n, c in counts.items() for _ in range(c) if 3 * n > capacity), reverse=True)
    gaps = []
    while large:
        n = large.pop(0)
        partner = next((m for m in large if m + n <= capacity), 0)
        if partner:
            large.remove(partner)
        gaps.append(capacity - n - partner)
    for n in sorted((n for n, c in counts.items() for _ in range(c) if 3 * n <= capacity), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_plan_is_the_method_item_by_item():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([6, 17, 100])
        counts = {n: rng.randint(1, 9) for n in rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 12)))}
        entries = packing.plan(counts, capacity)
        assert valid(entries, counts, capacity) == brute_force(counts, capacity), (capacity, counts)


def test_plan_rejects_impossible_lengths_and_takes_none():
    assert packing.plan({}, 10) == []
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packed_rows(spark, made, capacity):
    rows = packing.pack(made.repartition(3), capacity).collect()
    texts = [(r.doc_id, r.text) for r in made.collect()]
    where, encoded = {}, [(d, ids(t, 0)) for d, t in texts]
    for r in rows:
        data = {whole[4 * r.start : 4 * (r.start + r.length)] for d, whole in encoded if d == r.doc_id}
        assert bytes(r.ids) in data and len(r.ids) == 4 * r.length
        assert r.length == capacity or r.piece == 0
        where.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in where.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    joined = {r.sequence_id: r.n_tokens for r in packing.sequences(packing.pack(made, capacity)).collect()}
    assert sum(joined.values()) == sum(r.length for r in rows) and max(joined.values()) <= capacity


def test_packing_nothing_and_digests(spark, made, nothing):
    assert packing.pack(nothing).collect() == []
    whole = {(r.doc_id, r.piece, zlib.crc32(bytes(r.ids))) for r in packing.pack(made).collect()}
    short = packing.pack(made, payload=F.crc32("ids")).collect()
    assert whole == {(r.doc_id, r.piece, r.ids) for r in short}
