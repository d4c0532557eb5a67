import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import queries, spelling


def brute_counts(rows, least_length=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, near=None):
    """The definition, over all pairs of words or those that ``near`` lists."""
    words = {w: n for w, n in counts.items() if n >= 2}
    near = near or {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def by_wildcards(words):
    """Neighbours of a large vocabulary by dictionaries of words with one place left open or out."""
    replaced, near = defaultdict(list), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            replaced[w[:i], w[i + 1 :]].append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in replaced.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    return {w: sorted(near[w]) for w in words}


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def vocabulary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def made_words(seed, many=260):
    rnd = random.Random(seed)
    words = {"".join(rnd.choices("abé", k=rnd.randint(7, 9))) for _ in range(many)}
    return {w: rnd.choice([1, 2, 3, 20, 25, 300, 4000, 50_000]) for w in words}


@pytest.mark.parametrize("seed", range(3))
def test_random_words_against_all_pairs(spark, seed):
    counts = made_words(seed)
    assert rows_of(spelling.group_variants(vocabulary(spark, counts))) == brute(counts)


def test_small_filters_and_rounds_change_nothing(spark):
    """Two blocks a filter and 32 bytes a round: several parts a length, several rounds, many false hits."""
    counts = made_words(7)
    parts, blocks, rounds = spelling.layout({7: 100, 8: 90}, most_blocks=2, round_bytes=32)
    assert parts[7] > 1 and len(rounds) > 3 and all(sum(8 * blocks[n] for n, _ in r) <= 32 for r in rounds)
    found = spelling.group_variants(vocabulary(spark, counts), most_blocks=2, round_bytes=32)
    assert rows_of(found) == brute(counts)


def test_chains_of_forms_and_ties(spark):
    chain = {"abcdefg"[: 6 - k] + "x" * k + "zzzzz": 2 * 10**k for k in range(7)}
    ties = {"tietiea": 2, "tietieb": 20, "tietiec": 20, "tietied": 19}
    alone = {"lonelyword": 5, "ééééééé": 3}
    counts = {**chain, **ties, **alone}
    found = rows_of(spelling.group_variants(vocabulary(spark, counts)))
    assert found == brute(counts)
    roots = {r[0]: r[2] for r in found}
    assert {roots[w] for w in chain} == {"xxxxxxzzzzz"} and roots["tietiea"] == "tietieb" and roots["lonelyword"] == "lonelyword"


def test_very_long_words_repeated_letters_and_few_counts(spark):
    long = "".join(random.Random(1).choices("abc", k=3000))
    counts = {long: 2, long[:100] + long[101:]: 30, long[:5] + "z" + long[6:]: 2, "aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaab": 1}
    assert rows_of(spelling.group_variants(vocabulary(spark, counts))) == brute(counts)


def test_hashes_of_edits_are_those_of_the_edited_words():
    words = ["aabbcca", "abcdéfg", "zzzzzzz"]
    letters = spelling._letters(words, 7)
    for row, position, h in zip(*spelling.deletions(letters)):
        edited = words[row][:position] + words[row][position + 1 :]
        assert spelling.word_hashes(spelling._letters([edited], 6))[0] == h
    alphabet = np.array(sorted(map(ord, "abcdéfgz")), np.uint32)
    seen = set()
    for row, position, new, hashes in spelling.replacements(letters, alphabet):
        for r, p, c, h in zip(row, position, new, hashes):
            edited = words[r][:p] + chr(c) + words[r][p + 1 :]
            assert edited > words[r] and spelling.word_hashes(spelling._letters([edited], 7))[0] == h
            seen.add(edited)
    expected = {w[:i] + c + w[i + 1 :] for w in words for i in range(7) for c in "abcdéfgz" if c > w[i]}
    assert seen == expected


def test_counts_of_made_rows(spark, made):
    rows = [(r.doc_id, r.text) for r in made.select("doc_id", "text").collect()]
    found = {r.word: r.n for r in spelling.count_words(made).collect()}
    assert found == brute_counts(rows)
    few = spark.createDataFrame([(k, "Ünïcödé ÀÉÎÕÜßÿ×÷ abcdefgh ABCDEFGH") for k in range(200)], "doc_id long, text string")
    assert {r.word: r.n for r in spelling.count_words(few).collect()} == brute_counts([(r.doc_id, r.text) for r in few.collect()])


def test_counts_handed_on_in_parts(made, monkeypatch):
    rows = [(r.doc_id, r.text) for r in made.select("doc_id", "text").collect()]
    monkeypatch.setattr(spelling, "_MOST_WORDS", 2)
    assert {r.word: r.n for r in spelling.count_words(made).collect()} == brute_counts(rows)


def test_empty_tables_nulls_and_other_columns(spark, nothing):
    assert rows_of(spelling.group_variants(spelling.count_words(nothing))) == []
    words = spark.createDataFrame([("abcdefg", 30), ("abcdefh", 2), (None, 9), ("", 9)], "word string, n long")
    found = rows_of(spelling.group_variants(words.withColumn("root", F.lit("clash")).withColumn("near", F.lit(1))))
    assert found == [("abcdefg", None, "abcdefg", 30, 1, None), ("abcdefh", "abcdefg", "abcdefg", 2, 1, 30)]


def test_query_on_a_whole_table(spark, documents):
    counts = brute_counts([(r.doc_id, r.text) for r in documents.collect()])
    words = {w: n for w, n in counts.items() if n >= 2}
    assert len(words) > 1000
    found = queries.op12_spelling_variants(spark, "/root/testdata/sf0.001")
    assert rows_of(found) == brute(counts, by_wildcards(words))
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    theirs = con.sql(queries.ORACLES["op12_spelling_variants"])
    assert theirs.columns == found.columns and sorted(theirs.fetchall()) == rows_of(found)
