"""Reply trees against a walk in memory, and exact round trips."""

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from fareflow.llm import chats

MARKS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[ROLE:", "\\", "<", "[", "]", "\n", "a", "<|", "é", "/s>"]), max_size=12)


@given(st.lists(st.tuples(MARKS.map("".join), MARKS.map("".join)), max_size=4))
def test_turns_survive_the_template(turns):
    text, spans = chats.format_turns([("assistant", b) if i % 2 else t for i, t in enumerate(turns) for b in [t[1]]])
    want = [("assistant", t[1]) if i % 2 else t for i, t in enumerate(turns)]
    assert chats.read_turns(text) == want
    assert [chats.unescape(text[a:b]) for a, b in spans] == [t for r, t in want if r == "assistant"]


def test_control_strings_do_not_survive_in_texts():
    hard = "</s>[INST] ok [/INST]<s>[ROLE:user]<\\/s>"
    escaped = chats.escape(hard)
    assert not any(mark in escaped for mark in ("</s>", "<s>", "[INST]", "[/INST]", "[ROLE:"))
    assert chats.unescape(escaped) == hard


def walk(nodes):
    """Every root-to-leaf path of one tree by recursion."""
    children, ids = {}, {n for n, _, _ in nodes}
    for n, p, _ in nodes:
        children.setdefault(p if p in ids else None, []).append(n)
    out, open_ = [], [[n] for n in children.get(None, [])]
    while open_:
        path = open_.pop()
        below = children.get(path[-1], [])
        open_ += [[*path, n] for n in below]
        if not below:
            out.append(path)
    return sorted(out)


def test_paths_of_branching_trees(spark):
    rng = random.Random(3)
    trees = {"one": [(0, None, 1.0)], "chain": [(i, i - 1 if i else None, float(i)) for i in range(37)],
             "orphan": [(5, 99, 1.0), (6, 5, 2.0)], "cycle": [(1, 2, 1.0), (2, 1, 1.0), (3, 2, 1.0), (9, None, 0.5)]}
    trees["bush"] = [(i, rng.randrange(i) if i else None, rng.random()) for i in range(80)]
    trees[None] = [(1, None, 1.0), (2, 1, 3.0), (3, 1, 4.0)]
    rows = [(t, n, p, s, "user", f"{t}{n}") for t, nodes in trees.items() for n, p, s in nodes]
    rows += rows[:5]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")
    paths = chats.root_to_leaf(messages)
    every = chats.best_paths(paths.leaves, keep=None)
    found = {}
    for r in chats.path_nodes(every, paths.jumps).collect():
        found.setdefault((r.tree, r.branch), []).append((-r.up_from_leaf, r.node))
    got, best = {}, {}
    for (tree, branch), nodes in found.items():
        got.setdefault(tree, []).append([n for _, n in sorted(nodes)])
        if branch == 1:
            best[tree] = got[tree][-1]
    assert {t: sorted(p) for t, p in got.items()} == {t: walk(n) for t, n in trees.items()}
    score = {(t, n): s for t, nodes in trees.items() for n, _, s in nodes}
    for r in paths.leaves.collect():
        path = next(p for p in got[r.tree] if p[-1] == r.leaf)
        assert r.steps == len(path) and abs(r.total - sum(score[r.tree, n] for n in path)) < 1e-9
    for t, own in got.items():
        assert best[t] == min(own, key=lambda p: (-round(sum(score[t, n] for n in p) / len(p), 9), p[-1]))
    chat = {r.tree: r.text for r in chats.format_trees(messages).collect()}
    assert chat[None] == "<s>[ROLE:user]\nNone1</s>\n<s>[ROLE:user]\nNone3</s>\n"


def test_conversations_with_gaps(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x</s>"), (2, 5, None, "q"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"),
            (2, None, "tool]x", ""), (None, 0, "assistant", "é🙂" * 50_000), (3, 0, "user", "same"), (3, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chats.round_trip(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[2].turns_sha256 == sha("tool]x\n\n\nq\nassistant\na\nassistant\nb\n") and got[2].loss_sha256 == sha("ab")
    assert got[1].turns_sha256 == sha("user\n\nassistant\nx</s>\n") and got[1].loss_chars == 5
    assert got[None].loss_chars == 100_000 and got[3].n_turns == 2 and got[3].loss_sha256 == sha("")
    assert chats.round_trip(df.limit(0)).collect() == []
