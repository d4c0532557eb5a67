import random
import re

import pytest
from pyspark.sql import functions as F

from aerolith.llm import decontaminate as d


def score_by_table(a, b):
    """Smith-Waterman cell by cell."""
    best, rows = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if x == y else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


def test_alignment_cell_by_cell():
    rng = random.Random(1)
    pairs = [
        ([rng.choice("abcde") for _ in range(rng.randint(1, 12))], [rng.choice("abcdefg") for _ in range(rng.randint(1, 25))])
        for _ in range(300)
    ]
    assert [s for s, _ in d.align(pairs, at_once=7)] == [score_by_table(a, b) for a, b in pairs]


def brute(docs, items):
    """Whole documents against every item."""
    out = {}
    for doc_id, text in docs:
        words = [w.decode() for w in d.words_of(text)]
        for item_id, item in items:
            own = [w.decode() for w in d.words_of(item)]
            if len(own) >= 5 and words:
                score = d.align([(own, words)])[0][0] / (2 * len(own))
                if score >= 0.6:
                    out[doc_id, item_id] = max(score, out.get((doc_id, item_id), 0))
    return out


def found(df):
    return {(r.doc_id, r.item_id): r.score for r in df.collect()}


def test_documents_against_all_items(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(d.contaminated(documents, items)) == brute(docs, [(r.item_id, r.text) for r in items.collect()])


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rng.randint(18, 60)))) for i in range(12)]
    items += [(100, "too few words here"), (101, None), (102, ""), (3, items[3][1])]
    filler = lambda n: " ".join(word() for _ in range(n))
    docs, n = [], 0
    for item_id, text in items[:12]:
        words = text.split()
        edited = [word() if k % 9 == 4 else w for k, w in enumerate(words)]
        dropped = [w for k, w in enumerate(words) if k % 10 != 5]
        part = words[: max(5, int(len(words) * 0.75))]
        small = words[:4]
        for version in (words, edited, dropped, part, small):
            docs.append((n, filler(60) + " " + ", ".join(version).upper() + ". " + filler(60)))
            n += 1
    docs += [(n, None), (n + 1, ""), (n + 2, docs[0][1]), (n + 2, docs[0][1]), (n + 3, filler(300_000) + " " + items[0][1])]
    docs += [(1000 + i, filler(20) + " " + items[1][1] + " " + filler(20)) for i in range(120)]  # leaked more often than rare
    docs.append((None, items[2][1]))
    return docs, items


def test_planted_copies(spark, planted):
    docs, items = planted
    left = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, gram string").repartition(4)
    right = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, words string")
    got = found(d.contaminated(left, right))
    assert got == brute(docs, items)
    for n in range(60):
        expected = n % 5 != 4
        assert ((n, n // 5) in got) == expected, n
    assert all((1000 + i, 1) in got for i in range(120))


def test_nothing(spark, planted, made, nothing):
    items = spark.createDataFrame(planted[1], "item_id long, text string")
    assert d.contaminated(nothing, items).collect() == []
    assert d.contaminated(made, items.limit(0)).collect() == []
    assert d.contaminated(made, items).where(F.col("item_id") > 99).collect() == []


def test_slices_of_long_texts(spark, planted):
    """An item behind more characters than a slice holds, and across the place where a slice ends."""
    _, items = planted
    long = "word " * (d.SLICE_CHARS // 5)
    docs = [(1, long + " " + items[0][1]), (2, long[: -len(items[1][1]) // 2] + items[1][1]), (3, long)]
    assert len(docs[0][1]) > d.SLICE_CHARS
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert set(found(d.contaminated(left, right))) == {(1, items[0][0]), (2, items[1][0])}


def test_a_document_of_very_many_items_is_cut_into_windows(spark):
    """Every item is found, and what is aligned grows with the document, not with its square."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 40)))) for i in range(2000)]
    text = " ".join(t for _, t in items)
    left, right = spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    seeds = d.seeds_of(right, 5).distinct()
    cut = d.stretches(left, d.Bloom.of(seeds, seeds.count()), 5, 40).collect()
    longest = max(len(r.words.split()) for r in cut)
    assert longest <= 4 * 40 + 5 and sum(len(r.words) for r in cut) < 3 * len(text) and len(cut) > 300
    got = found(d.contaminated(left, right))
    assert set(got) == {(1, i) for i, _ in items} and all(score == 1 for score in got.values())


def test_edited_copies_leaked_more_often_than_rare(spark):
    """Words 6 and 11 of 15 changed: one seed is left, in more documents than ``rare``; every copy is found."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    words = [word() for _ in range(15)]
    edited = [word() if k in (5, 10) else w for k, w in enumerate(words)]
    items = [(1, " ".join(words)), (2, " ".join(word() for _ in range(20)))]
    docs = [(i, " ".join([*(word() for _ in range(30)), *edited, *(word() for _ in range(30))])) for i in range(120)]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert len(set(d.gram_hashes(d.words_of(items[0][1]), 5).tolist()) & set(d.gram_hashes(d.words_of(docs[0][1]), 5).tolist())) == 1
    got = found(d.contaminated(left, right))
    assert got == brute(docs, items) and len(got) == 120


def test_what_documents_hold_is_not_broadcast(spark, planted):
    """Grams and words of stretches are more than their file's size tells."""
    docs = spark.createDataFrame(planted[0][:60], "doc_id long, text string")
    items = spark.createDataFrame(planted[1], "item_id long, text string")
    plan = d.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[gram#\w+, salt#", plan) and re.search(r"SortMergeJoin \[stretch#", plan)
