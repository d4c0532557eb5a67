import hashlib
import random

import numpy as np

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolith.llm import bpe, queries

LIBRARY = Tokenizer.from_file(bpe.WORD_VOCABULARY)


@pytest.fixture(scope="module")
def words():
    return bpe.WordBpe(bpe.WORD_VOCABULARY)


def same(words, text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    ids = words.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == expected, text[:200]
    assert words.decode(ids).decode() == LIBRARY.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "", " \n\t\r ", "Hello <|endoftext|>it's<|startoftext|> ÀB 12 don't", "<|<|endoftext|>|>", "<|endoftext|", "ΑΣ ΟΔΟΣ İI ǅ",
        "éà x́", "́ a", "= ̸", "Å Ω K", "a\x1cb\x85c\xa0d e​f　g", "½²³ªº×÷µ",
        "'ll'LL'S’s'''t't", "\0a\0", "٣٤ Ⅻ ① 日本語 😀", "퟿￿\U0010ffff", "a" * 5000, "ab" * 3000, "haha" * 3000,
    ],
)
def test_texts_that_are_normalised_or_split_in_odd_ways(words, text):
    same(words, text)


@pytest.mark.parametrize("letters", ["aehinorst", "aaabcde fghi'st123.,!?ÀÉßΩ日́\n\t<|>é\xa0\x85İ"])
def test_random_texts_as_the_library_encodes_them(words, letters):
    rnd = random.Random(3)
    for _ in range(4000):
        same(words, "".join(rnd.choices(letters, k=rnd.randint(1, 60))))


def merged(word, merges, suffix):
    """Merges in order of rank, the first place first: the definition, in quadratic time."""
    parts = [*word[:-1], word[-1] + suffix]
    while True:
        ranks = [merges.get(pair, len(merges)) for pair in zip(parts, parts[1:])]
        if not ranks or min(ranks) == len(merges):
            return parts
        at = ranks.index(min(ranks))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("suffix", ["", "</w>"])
def test_random_vocabularies_against_merging(seed, suffix):
    rnd = random.Random(seed)
    pieces = [c + s for c in "abc" for s in {"", suffix}]
    merges = {}
    while len(merges) < 25:
        a, b = rnd.choice(pieces), rnd.choice(pieces)
        if (a, b) not in merges and a + b not in pieces and not (suffix and a.endswith(suffix)):
            merges[a, b] = len(merges)
            pieces.append(a + b)
    built = bpe.Backtracking({p: i for i, p in enumerate(pieces)}, list(merges), suffix)
    for _ in range(300):
        word = "".join(rnd.choices("abc", k=rnd.randint(1, 30)))
        assert [pieces[i] for i in built.encode(word)] == merged(word, merges, suffix), word


def test_a_long_word_takes_linear_time(words):
    word = "".join(random.Random(5).choices("abcdefgh", k=400_000))
    same(words, word)


def test_memory_of_words_is_bounded_and_changes_no_ids():
    small = bpe.WordBpe(bpe.WORD_VOCABULARY, most=3)
    for text in ("one two three four five six", "four five six seven", "six one"):
        same(small, text)
    assert len(small.chunks) <= 4 and len(small.words) <= 3


def test_unknown_merge_orders_and_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Backtracking({"a": 0, "b": 1, "ab": 2, "aba": 3}, [("ab", "a"), ("a", "b")], "")
    with pytest.raises(ValueError):
        bpe.WordBpe(bpe.public_tokenizers.path("byte_bpe_50k.json"))


def expected_digests(rows):
    out = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        binary = np.array(ids, "<u4").tobytes()
        out.append((doc_id, len(ids), hashlib.sha256(binary).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    return sorted(map(tuple, df.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str)


def test_query_on_a_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = queries.op11_bpe(spark, "/root/testdata/sf0.001")
    assert [f.dataType.simpleString() for f in found.schema.fields] == ["bigint", "bigint", "string", "string"]
    assert digests(found) == expected_digests(rows)


def test_made_rows_and_none(made, nothing):
    rows = [(r.doc_id, r.text) for r in made.select("doc_id", "text").collect()]
    assert digests(bpe.digests(bpe.decode(bpe.encode(made)))) == expected_digests(rows)
    assert bpe.decode(bpe.encode(nothing)).count() == 0


def test_decoding_keeps_columns_and_nulls(spark):
    ids = np.array([320, 49407], "<u4").tobytes()
    df = spark.createDataFrame([(1, bytearray(ids), "x"), (2, None, "y"), (3, bytearray(b""), "z")], "k int, ids binary, text string")
    found = bpe.decode(df.withColumn("n", F.lit("clash"))).orderBy("k").collect()
    assert [(r.k, r.text, r.n) for r in found] == [(1, "a</w> <|endoftext|>", "clash"), (2, None, "clash"), (3, "", "clash")]

