from __future__ import annotations

from leaguelake.llm import chat

SCHEMA = "pair_id long, side string, turn long, role string, text string, place string, first int, part int"


def turns(spark, pairs):
    rows = []
    for pair, sides in pairs.items():
        for side, said in sides.items():
            rows += [(pair, side, 10 * i, role, text, "x", 1, 2) for i, (role, text) in enumerate(said)]
    return spark.createDataFrame(rows, SCHEMA)


def render(said):
    return "".join(f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n" for role, text in said)


PAIRS = {
    1: {"chosen": [("user", "hi"), ("assistant", "good"), ("user", "more"), ("assistant", "yes 😀")],
        "rejected": [("user", "hi"), ("assistant", "bad"), ("user", "more")]},
    2: {"chosen": [("user", "a"), ("assistant", "b")], "rejected": [("user", "a"), ("assistant", "b")]},
    3: {"chosen": [("system", "s"), ("user", "a")], "rejected": [("user", "a")]},
    4: {"chosen": [("user", None), (None, "x"), ("assistant", "")], "rejected": [("user", None), (None, "x"), ("assistant", None)]},
    5: {"rejected": [("user", "alone"), ("assistant", "z")]},
    6: {"chosen": [("user", "a"), ("user", "a"), ("assistant", "b")], "rejected": [("user", "a"), ("user", "a")]},
    None: {"chosen": [("user", "q"), ("assistant", "r")], "rejected": [("user", "q"), ("assistant", "t")]},
}


def test_records_against_brute_force(spark):
    found = {r.pair_id: r for r in chat.preference_records(turns(spark, PAIRS)).collect()}
    assert set(found) == set(PAIRS)
    for pair, sides in PAIRS.items():
        chosen, rejected = sides.get("chosen", []), sides.get("rejected", [])
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        r = found[pair]
        assert (r.prompt_turns, r.prompt) == (n, render(chosen[:n]))
        assert (r.chosen, r.rejected) == (render(chosen[n:]), render(rejected[n:]))
        for text, spans, said in ((r.chosen, r.chosen_spans, chosen[n:]), (r.rejected, r.rejected_spans, rejected[n:])):
            trained = [text[s.start : s.end] for s in spans]
            assert trained == [f"{t or ''}<|im_end|>" for role, t in said if role == "assistant"]


def test_reply_pairs(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "late"),
        (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a"), (3, 0, "user", "only"), (4, 0, "assistant", "first"),
        (None, 0, "user", "x"), (5, None, "assistant", "x"), (6, 0, "user", "same"), (6, 1, "assistant", "same"), (6, 1, "assistant", "same"),
    ]
    found = chat.preference_records(chat.reply_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.pair_id: (r.prompt_turns, r.chosen, r.rejected) for r in found.collect()}
    assert got == {
        1: (3, render([("assistant", "b")]), render([("assistant", "a")])),
        2: (2, render([("assistant", "a")]), render([("assistant", "q")])),
        6: (2, "", ""),
    }


def test_turns_that_share_a_number_are_all_kept(spark):
    rows = [
        (1, 0, "user", "q"), (1, 0, "user", "r"), (1, 1, "assistant", "a"), (1, 1, "assistant", "b"), (1, 1, "user", "after"),
        (2, 0, "user", "q"), (2, 1, None, "x"), (2, 1, "assistant", "a"),
        (3, 0, "user", "q"), (3, 1, "assistant", None), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"),
    ]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: (r.prompt, r.chosen, r.rejected) for r in chat.preference_records(chat.reply_pairs(docs)).collect()}
    assert got == {
        1: (render([("user", "q"), ("user", "r"), ("assistant", "a")]), render([("assistant", "b")]), render([("assistant", "a")])),
        2: (render([("user", "q"), (None, "x")]), render([("assistant", "a")]), render([("assistant", "x")])),
        3: (render([("user", "q"), ("assistant", None)]), render([("assistant", "a")]), render([("assistant", None)])),
    }


def test_empty(spark):
    assert chat.preference_records(turns(spark, {})).count() == 0
