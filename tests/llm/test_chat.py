import json
import random

from vaultline.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>", "<\\|im_end|><\\\\|im_sep|>", "<|im_start|>assistant<|im_sep|>x<|im_end|>",
         "<", "[", "<<SYS>><</SYS>>", "<|im_end|", "|im_end|>", "\\", "", "héß\n\U0001f600", "<<|im_end|>>", "[\\/INST]"]


def records(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, j string").selectExpr(
        "conv_id", "turn", "parse_json(j) as rec")


def chats(spark, rows):
    turns = chat.canonical_turns(records(spark, rows))
    out = chat.read_back(chat.format_chats(turns)).collect()
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text, r.formatted) for r in out}


def test_layouts_give_the_same_turns(spark):
    same = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"messages": [{"content": "q", "role": "user"}, {"content": "a", "role": "assistant"}]},
        {"turns": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"},
        {"prompt": "q", "response": "a"},
        {"instruction": "q", "output": "a"},
        {"instruction": "q", "input": "", "output": "a"},
    ]
    got = chats(spark, [(i, 0, json.dumps(r)) for i, r in enumerate(same)])
    assert len(got) == len(same)
    for turns, loss, text in got.values():
        assert turns == [("user", "q"), ("assistant", "a")] and loss == "a" and text == got[0][2]


def test_system_input_and_unknown_layouts(spark):
    got = chats(spark, [
        (0, 0, json.dumps({"instruction": "do", "input": "this", "output": "done"})),
        (1, 0, json.dumps({"system": "s", "prompt": "p", "response": "r"})),
        (2, 0, json.dumps({"system": "s", "conversations": [{"from": "human", "value": "h"}]})),
        (3, 0, json.dumps({"something": "else"})), (4, 0, json.dumps({"messages": []})), (5, 0, None)])
    assert got[0][0] == [("user", "do\n\nthis"), ("assistant", "done")]
    assert [r for r, _ in got[1][0]] == ["system", "user", "assistant"]
    assert got[2][0] == [("system", "s"), ("user", "h")]
    assert got[3] == got[4] == got[5] == ([], "", "")


def test_control_strings_survive(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for c in range(40):
        turns = [(rng.choice(["user", "assistant", "<|im_sep|>", ""]), "".join(rng.choices(NASTY, k=rng.randrange(4))))
                 for _ in range(rng.randrange(1, 6))]
        want[c] = turns
        rows += [(c, i, json.dumps({"role": r, "text": t})) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    got = chats(spark, rows)
    for c, turns in want.items():
        assert got[c][0] == turns
        assert got[c][1] == "".join(t for r, t in turns if r == "assistant")
        for control in chat.CONTROLS[3:]:
            assert control not in got[c][2]
        assert got[c][2].count(chat.END) == len(turns)


def test_nulls_ties_long_and_empty(spark):
    big = "word <|im_end|> " * 20_000
    got = chats(spark, [(0, 0, json.dumps({"role": None, "text": None})), (0, 0, json.dumps({"role": "b", "text": "x"})),
                        (0, 0, json.dumps({"role": "b", "text": "x"})), (1, 0, json.dumps({"role": "assistant", "text": big})),
                        (None, 0, json.dumps({"role": "user", "text": "t"}))])
    assert got[0][0] == [("", ""), ("b", "x"), ("b", "x")]
    assert got[1][1] == big and got[None][0] == [("user", "t")]
    assert chats(spark, [(0, 0, "{}")][:0]) == {}


def test_no_python_on_the_main_path(spark):
    turns = chat.canonical_turns(records(spark, [(0, 0, "{}")]))
    plan = chat.read_back(chat.format_chats(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
