import random
from hashlib import sha256

import numpy as np

from aerolith.llm import chat
from aerolith.llm.queries import CONTROL


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    cases = ["<|", "<\\|", "<\\\\|", "<<|", "<", "|", CONTROL, "<|endoftext|>"]
    cases += ["".join(rng.choice("<|\\a>") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text in cases:
        assert chat.unescape(chat.escape(text)) == text
        assert "<|" not in chat.escape(text)


def test_rendered_turns_are_read_back():
    rng = random.Random(2)
    for _ in range(500):
        turns = [
            (rng.choice(["user", "assistant", "a<", "<|im_sep|>", ""]), "".join(rng.choice("<|\\a\n>") for _ in range(rng.randint(0, 9))))
            for _ in range(rng.randint(1, 5))
        ]
        assert chat.parse(chat.render(turns)[0]) == turns


def test_ranges_by_binary_search():
    offsets = np.array([(0, 3), (3, 5), (5, 5), (5, 9), (9, 12)])
    assert chat.token_ranges(offsets, [(3, 9)]) == [(1, 4)]
    assert chat.token_ranges(offsets, []) == []


def brute(turns):
    said = [(role or "", text or "") for role, text in turns]
    loss = "".join(text for role, text in said if role == "assistant")
    whole = "".join(f"{role}\n{text}\n" for role, text in said)
    return len(said), sha256(whole.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest()


def test_digests_and_masks_of_odd_conversations(spark):
    rows = [
        (1, 1, "assistant", "\n leading and trailing \n"), (1, 0, "user", "hi"), (1, 2, "assistant", ""),
        (1, 3, "assistant", None), (2, 0, None, None), (2, None, "assistant", " 日本語 😀 é "),
        (3, 0, "user", CONTROL), (3, 1, "assistant", CONTROL), (3, 1, "assistant", CONTROL),
        (None, 0, "assistant", "<\\|endoftext|> <|endoftext|>"), (4, 0, "assistant", "long words " * 20_000),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    formatted = chat.format_conversations(df.repartition(3))
    expected = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        expected[conv] = brute([(r[2], r[3]) for r in sorted((r for r in rows if r[0] == conv), key=key)])
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(formatted).collect()}
    assert got == expected
    tokenizer = chat.chat_tokenizer(chat.VOCABULARY)
    for r in formatted.collect():
        # The tokens under the loss, decoded alone, are the characters under the loss.
        for tokens, chars in zip(r.loss_tokens, r.loss_chars, strict=True):
            text = tokenizer.decode(r.input_ids[tokens.first : tokens.last], skip_special_tokens=False)
            assert text == r.formatted[chars.first : chars.last]
    assert chat.digests(chat.format_conversations(df.limit(0))).collect() == []


def test_all_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    turns = {}
    for r in sorted(df.collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got == {k: brute(v) for k, v in turns.items()}
