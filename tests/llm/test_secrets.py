import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import secrets
from aerolith.llm.queries import op4_secret_scan


@pytest.fixture(scope="module")
def model(documents):
    return secrets.fit(documents)


def brute_base(text):
    assign = r"((?i:p)(?i:a)(?i:s)(?i:s)(?i:w)(?i:o)(?i:r)(?i:d)|(?i:passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = []
    for kind, (pattern, test) in enumerate(
        [
            (assign, lambda m: len(m[2]) >= 6), ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
            ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
        ]
    ):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "", re.ASCII) if test(m)]
    return sorted(found)


ODD = [
    None, "", "password=abcde", "password=abcdef", "PassWd : 'abcdef-1=' token=\"xyzxyz", "api_key:=abcdef", "ſecret=abcdef",
    "é token = zzzzzz 日本 AKIA" + "B2" * 8, "AKIA" + "B" * 15, "x" + "ab12" * 6 + "g", "0" * 23 + " " + "0" * 24,
    "token=" + "ab" * 20, "secret secret=token=abcdef", "😀 apikey=😀abcdef apikey=abc.def",
]


def test_base_spans_against_plain_patterns(spark, documents):
    for text in [*ODD, *(r.text for r in documents.collect())]:
        assert secrets.base_spans(secrets.code_points(text)) == brute_base(text), text


def test_random_strings_are_told_from_identifiers(model):
    rng = np.random.default_rng(99)
    made = [s for s in secrets.made_secrets(rng, 1000) if len(s) >= 20]
    words = [b"stream", b"handler", b"the", b"reading", b"configuration", b"region", b"ofthing", b"andered"]
    plain = [s for s in secrets.joined_words(rng, words, 1000) if len(s) >= 20]
    caught = sum(model.ratio(s) > model.threshold for s in made) / len(made)
    wrong = sum(model.ratio(s) > model.threshold for s in plain) / len(plain)
    assert caught > 0.97 and wrong < 0.02, (caught, wrong)


def test_spans_of_odd_rows_and_nothing(spark, made, nothing, model):
    key = "Zk3vQ9xT1bN7rW5yH2mJ8pL4"
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, f"é value {key} end"), (51, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, spans string")
    found = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in secrets.scan(df, model).collect()}
    assert found[50] == [(8, "markov", 8 + len(key))] and found[51] == []
    for i, text in enumerate(ODD):
        assert [(s, secrets.KINDS.index(k), e) for s, k, e in found[i] if k != "markov"] == brute_base(text)
    assert secrets.scan(nothing, model).collect() == []
    assert secrets.scan(made, model).count() == made.count()
    for plain in (b"a" * 20, b"-" * 40, b"=-" * 20, b"the_name_of_a_table"):
        assert secrets.fit(nothing).ratio(plain) < 0.5 and model.ratio(plain) < 0.5


def test_redaction(spark, model):
    df = spark.createDataFrame([(1, "é password=abcdefgh x"), (2, None), (3, "clean text")], "doc_id long, text string")
    assert [r.text for r in secrets.redact(df, model).orderBy("doc_id").collect()] == ["é [secret] x", None, "clean text"]


def test_query_agrees_with_brute_force(spark, documents):
    from hashlib import sha256

    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op4_secret_scan(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r.doc_id])
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r.base_sha256 == sha256(joined.encode()).hexdigest()
        assert joined in r.spans or set(joined.split(",")) <= set(r.spans.split(","))


def test_clean_documents_stay_clean(documents, model):
    with_base = {r.doc_id for r in documents.collect() if brute_base(r.text)}
    found = secrets.scan(documents, model).where(F.size("spans") > 0).collect()
    assert {r.doc_id for r in found} == with_base


def test_keys_behind_words_are_found(model, documents):
    """Each key beside words of the documents: its span holds the whole key, seldom a word."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(secrets.ALPHABET[:62], np.uint8)
    plain = [r.text for r in documents.orderBy("doc_id").collect() if not brute_base(r.text)]
    words = sorted({w for t in plain for w in re.findall("[a-z]{5,12}", t or "")})
    forms = ["{k}", "{a}/{k}", "{a}/{b}/{k}", "{a}/{b}/{c}/{d}/{k}", "{A}_{B}_{C}={k}", "{a}-{b}-{k}", "https://{a}/{b}/{k}/{c}", "{k}/{a}/{b}"]
    for form in forms:
        for size, least in ((20, 0.85), (32, 0.9), (40, 0.9)):
            whole = exact = 0
            for _ in range(100):
                key = rng.choice(letters, size).tobytes().decode()
                some = dict(zip("abcd", (words[i] for i in rng.integers(0, len(words), 4))))
                text = form.format(k=key, **some, **{n.upper(): w.upper() for n, w in some.items()})
                at = text.index(key), text.index(key) + size
                spans = [(s, e) for s, _, e in model.spans(text.encode()) if s <= at[0] and at[1] <= e]
                whole, exact = whole + len(spans), exact + (spans == [at])
            assert whole / 100 >= least and exact / 100 >= 0.4, (form, size, whole, exact)


def test_several_keys_and_spans_in_one_run(model):
    one, two = "Zk3vQ9xT1bN7rW5yH2mJ8pL4", "q7RtX2mV9bKcW4zPn8LsD3Fy"
    text = f"{one}/reading/configuration/stream/{two}/handler/AKIA{'B2' * 8}"
    at = [text.index(one), text.index(two), text.index("AKIA")]
    assert model.spans(text.encode()) == [(at[0], 3, at[0] + 24), (at[1], 3, at[1] + 24), (at[2], 1, len(text))]
    plain = "/".join(["reading", "configuration", "stream", "handler", "the"] * 2000)
    assert model.segments(plain.encode()) == [] and len(model.segments(f"{plain}/{one}/{plain}/{two}".encode())) == 2


def test_null_ids_and_copies_are_sampled_like_others(spark):
    rows = [(None, f"unnamed text number n{i}a with words{i}b") for i in range(3000)] + [(5, "the same row again")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, words = secrets.labelled_strings(df, documents=60)
    assert 0 < sum(w.startswith(b"words") for w in words) <= 300 * 10
    assert len(words) < 1500
