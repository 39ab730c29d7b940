"""Preference formatting: prefixes, masks and edge cases."""

from rowcast.llm import chat

DDL = "conv_id long, turn long, role string, text string, prompt string, at int"


def pairs(spark, rows):
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)
    return {r.pair_id: r for r in chat.format_pairs(chat.numbered_pairs(turns)).collect()}


def test_common_prefix_and_masks(spark):
    got = pairs(spark, [
        (0, 0, "system", "s"), (0, 1, "user", "q"), (0, 2, "assistant", "good"), (0, 3, "user", "more"),
        (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"),
        (2, 0, "user", "a"), (3, 0, "user", "b"), (3, 1, "assistant", "c"),
        (4, 0, "user", "only chosen")])
    r = got[0]
    assert r.prompt_turns == 2 and r.prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
    assert r.chosen.startswith("<|im_start|>assistant\ngood<|im_end|>\n") and r.chosen.endswith("more<|im_end|>\n")
    a, b = map(int, r.chosen_mask.split("-"))
    assert r.chosen[a:b] == "good<|im_end|>"
    a, b = map(int, r.rejected_mask.split("-"))
    assert r.rejected[a:b] == "bad<|im_end|>"
    assert got[1].prompt == "" and got[1].prompt_turns == 0 and got[1].chosen_mask == ""
    assert set(got) == {0, 1}


def test_edges(spark):
    same = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for c in (0, 1) for t in range(3)]
    more = [(1, 3, "assistant", "x" * 300_000), (2, 0, None, None), (2, 0, None, None), (3, 0, "", ""), (None, 0, "user", "z"),
            (3, None, "user", "first")]
    got = pairs(spark, same + more)
    assert got[0].chosen == "" and got[0].prompt_turns == 3 and len(got[0].rejected) > 300_000
    assert got[1].prompt_turns == 0 and got[1].rejected.startswith("<|im_start|>user\nfirst")
    assert pairs(spark, []) == {}


def test_pairs_of_a_conversation_and_the_next_answer(spark):
    """The prefix decides, and no conversation is left out."""
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "bye"),
            (4, 0, "user", "q"), (4, 1, "assistant", "b"), (7, 0, "user", "no answer"), (9, 0, "assistant", ""), (9, 0, "assistant", None)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)
    got = {r.pair_id: r for r in chat.format_pairs(chat.answered_pairs(turns)).collect()}
    assert set(got) == {1, 4, 7, 9}
    assert got[1].prompt_turns == 3 and got[1].prompt.endswith("<|im_start|>user\nq2<|im_end|>\n")
    assert got[1].chosen == "<|im_start|>assistant\na2<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert got[1].rejected == "<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert got[4].prompt_turns == 1 and got[4].rejected == "<|im_start|>assistant\n<|im_end|>\n"
    assert got[7].prompt_turns == 1 and got[7].chosen == got[7].rejected == ""
    assert got[9].prompt_turns == 1 and got[9].rejected == "<|im_start|>assistant\na2<|im_end|>\n"
    one = spark.createDataFrame([(*r, "x", 1) for r in rows[5:7]], DDL)
    assert [(r.prompt_turns, r.chosen) for r in chat.format_pairs(chat.answered_pairs(one)).collect()] == [(2, "")]
    assert chat.format_pairs(chat.answered_pairs(turns.limit(0))).collect() == []


def test_the_given_conversations_share_their_prompts(spark):
    from llm_tables import SF_SMALL

    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = chat.format_pairs(chat.answered_pairs(turns)).collect()
    assert len(got) == turns.select("conv_id").distinct().count()
    assert sum(r.prompt_turns > 0 and r.chosen != r.rejected for r in got) > 0.75 * len(got)
