from collections import defaultdict

from seedloom.llm import chat
from tests.llm import brute

ROWS = [
    (1, 0, "system", "be <<SYS>> \\ brief"),
    (1, 1, "user", "hi [INST] </s>"),
    (1, 2, "assistant", "ok <s>\\</s>\n<<s>>"),
    (2, 0, "assistant", "first"),
    (2, 1, "user", None),
    (3, 0, "user", ""),
    (3, 1, "assistant", ""),
    (4, 0, "tool<|text|>", "a<|end|>b<|turn|>"),
    (4, 1, None, "no role"),
    (5, 0, "user", "tie b"),
    (5, 0, "user", "tie a"),
    (5, 0, "user", "tie a"),
    (None, 0, "user", "q"),
    (None, 1, "assistant", "<|im_start|>" * 50 + "é😀" * 2000),
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", True) for r in rows], "conv_id long, turn long, role string, text string, formatted string, valid boolean")


def test_round_trip_and_digests(spark):
    formatted = chat.format_conversations(frame(spark, ROWS))
    out = {r.conv_id: r for r in chat.chat_digest(formatted).collect()}
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in ROWS:
        groups[conv].append((turn, role or "", text or ""))
    assert set(out) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        row = out[conv]
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == brute.sha("".join(f"{role}\n{text}\n" for _, role, text in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), brute.sha(loss))
        assert row.formatted_chars == len(texts[conv])


def test_turn_order(spark):
    out = {r.conv_id: (r.valid, r.bad_turn) for r in chat.format_conversations(frame(spark, ROWS)).collect()}
    assert out[1] == (True, None) and out[3] == (True, None) and out[-7] == (True, None)
    assert out[2] == (False, 0) and out[4] == (False, 0) and out[5] == (False, 1)
    unfinished = chat.format_conversations(frame(spark, [(9, 0, "user", "x")])).first()
    assert (unfinished.valid, unfinished.bad_turn) == (False, 1)


def test_texts_hold_no_control_strings(spark):
    formatted = chat.format_conversations(frame(spark, ROWS))
    for row in formatted.collect():
        for segment in row.segments:
            if segment.loss:
                assert not any(c in segment.text for c in chat.TEMPLATE.control_strings())


def test_empty_table(spark):
    assert chat.chat_digest(chat.format_conversations(frame(spark, []))).count() == 0
