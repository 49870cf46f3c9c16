from wearlens.llm import chat


def pairs(spark, *rows):
    turn = f"array<{chat.TURN}>"
    return spark.createDataFrame(rows, f"pair_id long, chosen {turn}, rejected {turn}, n int, p string")


def test_prompt_is_the_longest_common_prefix_rendered_once(spark):
    u, a, b = ("user", "q"), ("assistant", "yes"), ("assistant", "no")
    r = chat.format_preferences(pairs(spark, (1, [u, a, u, a], [u, a, u, b], 1, "x"))).first()
    assert r.n_prompt_turns == 3
    assert r.prompt == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
    assert r.chosen == "<|im_start|>assistant\nyes<|im_end|>\n" and r.rejected == "<|im_start|>assistant\nno<|im_end|>\n"
    (s,) = r.chosen_spans
    assert r.chosen[s.start : s.end] == "yes<|im_end|>"


def test_masks_leave_out_other_roles(spark):
    u, a = ("user", "é😀"), ("assistant", "漢")
    r = chat.format_preferences(pairs(spark, (1, [u, a, u, a], [a], 1, "x"))).first()
    assert r.n_prompt_turns == 0 and r.prompt == ""
    assert [r.chosen[s.start : s.end] for s in r.chosen_spans] == ["漢<|im_end|>"] * 2


def test_edges(spark):
    u, a = ("user", "q"), ("assistant", "yes")
    rows = chat.format_preferences(pairs(spark, (1, [u, a], [u, a], 1, "x"), (2, [], [u], 1, "x"), (3, None, None, 1, "x"), (4, [u], [u, a], 1, "x"))).collect()
    got = {r.pair_id: (r.n_prompt_turns, r.chosen, len(r.rejected_spans)) for r in rows}
    assert got == {1: (2, "", 0), 2: (0, "", 0), 3: (0, "", 0), 4: (1, "", 1)}
    assert chat.format_preferences(pairs(spark)).count() == 0


def test_replies_are_swapped_with_the_next_conversation(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "more"), (2, 0, "user", None), (2, 1, None, "?"), (3, 0, "assistant", "a3"), (3, 0, "assistant", "a3"), (None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = {r.pair_id: r for r in chat.swapped_replies(turns).collect()}
    assert set(made) == {1, 2, 3}
    assert [tuple(t) for t in made[1].rejected] == [("user", "q"), ("assistant", "")]
    assert [tuple(t) for t in made[2].rejected] == [("user", ""), ("unknown", "?"), ("assistant", "a3")]
    assert [tuple(t) for t in made[3].rejected] == [("assistant", "a3"), ("assistant", "")]
    assert chat.swapped_replies(turns.limit(0)).count() == 0
