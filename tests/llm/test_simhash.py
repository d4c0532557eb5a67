import random
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from aerolith.llm import simhash
from aerolith.llm.common import stored


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(pairs):
    """Component ids by comparing all fingerprints."""
    seen = {}
    prints = sorted({f for _, f in pairs})
    for f in prints:
        seen[f] = f
    root = lambda f: f if seen[f] == f else root(seen[f])
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                seen[root(b)] = root(a)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return Counter((d, f"{f:016x}", least.get(root(f))) for d, f in pairs)


def got(found):
    rows = found.select("doc_id", simhash.hex_fingerprint(found.fp).alias("f"), "component_id").collect()
    return Counter(tuple(r) for r in rows)


def test_odd_rows(made, nothing):
    pairs = [(r.doc_id, brute_fingerprint(r.text)) for r in made.collect()]
    assert got(simhash.near_duplicates(made.repartition(3))) == brute_components(pairs)
    assert simhash.near_duplicates(nothing).collect() == []


def test_documents(documents):
    pairs = [(r.doc_id, brute_fingerprint(r.text)) for r in documents.collect()]
    assert got(simhash.near_duplicates(documents)) == brute_components(pairs)


def test_slices_of_long_texts(monkeypatch):
    text = "Aa b\tCC d\n e ff g hh  i"
    whole = simhash.shingle_hashes(text).tolist()
    for size in (1, 2, 5, 9):
        monkeypatch.setattr(simhash, "SLICE_CHARS", size)
        assert simhash.shingle_hashes(text).tolist() == whole


def test_more_than_255_hashes():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 2**64, n, dtype=np.uint64) for n in (1, 254, 255, 256, 3000, 0)]
    expected = [sum((2 * sum(int(h) >> b & 1 for h in a) > len(a)) << b for b in range(64)) for a in arrays]
    assert simhash.majority_bits(arrays).tolist() == expected


def test_each_link_once(spark):
    """Chains and clusters around random fingerprints, at every distance, against all pairs."""
    rng = random.Random(4)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            near = base
            for _ in range(rng.randint(1, 5)):
                near ^= 1 << rng.randrange(64)
            prints.add(near)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    prints = sorted(signed(f) for f in prints | {0, 1, 2, 1 << 63})
    nodes = spark.createDataFrame([(f,) for f in prints], "fp long")
    for radius in (1, 2, 3, 4):
        expected = sorted(
            (a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius
        )
        assert sorted(tuple(r) for r in simhash.links(nodes, radius).collect()) == expected


def test_exploded_fingerprints_are_not_broadcast(spark):
    """A file of fingerprints is small long after its 64 rows a fingerprint are too large for the driver."""
    nodes = stored(spark.range(1000).select(F.xxhash64("id").alias("fp")), "fingerprints-to-link")
    found = simhash.links(nodes)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


def test_one_of_each_group(made, documents):
    kept = sorted(r.doc_id for r in simhash.one_of_each(documents).collect())
    pairs = [(r.doc_id, brute_fingerprint(r.text)) for r in documents.collect()]
    assert kept == sorted({c for _, _, c in brute_components(pairs)})
    rows = simhash.one_of_each(made)
    assert rows.columns == made.columns
    ids = [r.doc_id for r in rows.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 9, 10] and ids.count(None) == 1


def test_one_of_each_with_repeated_ids(spark):
    """A clean text stays though its id is also a copy's; near copies that share an id count once."""
    rng = random.Random(6)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    copied, clean, other, apart, near = text(), text(), text(), text(), text()
    rows = [(1, copied), (7, copied), (7, clean), (8, other), (8, apart), (9, near), (9, near + " end"), (None, copied)]
    assert 0 < (brute_fingerprint(near) ^ brute_fingerprint(near + " end")).bit_count() <= 3
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter((r.doc_id, r.text.removesuffix(" end")) for r in kept)
    assert got == Counter([(1, copied), (7, clean), (8, other), (8, apart), (9, near), (None, copied)])
