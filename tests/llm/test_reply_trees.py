from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snapmart.llm import reply_trees
from snapmart.llm.queries import ORACLE, op10_reply_trees
from tests.conftest import SF_SMALL
from tests.oracle import compare

SCHEMA = "tree long, node long, parent long, score double, role string, text string"


def best_paths(messages, branches):
    """Root-to-leaf paths of each tree by following parents, best score first."""
    trees: dict = {}
    for m in messages:
        trees.setdefault(m[0], {})[m[1]] = m
    out = {}
    for tree, nodes in trees.items():
        parent = {n: m[2] if m[2] in nodes and m[2] != n else None for n, m in nodes.items()}
        paths = []
        for leaf in set(nodes) - set(parent.values()):
            path, here = [], leaf
            while here is not None and len(path) <= len(nodes):
                path.append(here)
                here = parent[here]
            if here is None:
                paths.append((-sum(nodes[n][3] or 0.0 for n in path), leaf, path[::-1]))
        for rank, (_, _, path) in enumerate(sorted(paths)[:branches], 1):
            out[tree, rank] = [((nodes[n][4] or ""), (nodes[n][5] or "")) for n in path]
    return out


@pytest.mark.parametrize("branches", [1, 3])
def test_random_trees(spark, branches):
    draw = random.Random(branches)
    messages = []
    for tree in range(6):
        for node in range(1, 40):
            parent = draw.choice([None, 999]) if node == 1 or draw.random() < 0.05 else draw.randrange(max(1, node - 6), node)
            messages.append((tree, node, parent, draw.choice([None, 1.0, 2.0, -1.0]), draw.choice(["user", "assistant", None]), f"t{tree}n{node}"))
    got = reply_trees.format_trees(spark.createDataFrame(messages, SCHEMA), branches).collect()
    assert {(r["tree"], r["rank"]): reply_trees.parse(r["formatted"]) for r in got} == best_paths(messages, branches)


def test_cycles_and_strays(spark):
    rows = [(1, 1, 2, 1.0, "user", "a"), (1, 2, 1, 1.0, "user", "b"), (1, 3, 1, 1.0, "user", "c"),
            (2, 1, 1, 0.0, "user", "self"), (2, 2, 1, 0.0, "assistant", "ok"), (None, 1, None, 0.0, "user", "x")]
    got = reply_trees.format_trees(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["tree"], reply_trees.parse(r["formatted"])) for r in got] == [(2, [("user", "self"), ("assistant", "ok")])]


def test_empty_table(spark):
    assert reply_trees.format_trees(spark.createDataFrame([], SCHEMA)).count() == 0


TEXTS = st.lists(
    st.sampled_from(["<", "|", "\\", "\n", "n", "i", "<|im_end|>", "<|im_start|>", ">", "é", "\U0001f600"]), max_size=12,
).map("".join)


@settings(max_examples=8, deadline=None)
@given(turns=st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=8))
def test_round_trip(spark, turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = reply_trees.format_trees(reply_trees.chains(frame)).first()
    assert reply_trees.parse(made["formatted"]) == turns


def test_loss_covers_the_assistant_texts(spark):
    rows = [(1, 0, "user", "q <|"), (1, 1, "assistant", "é <|im_end|> \\ a"), (1, 2, "assistant", None), (1, 3, "user", "z"), (1, 4, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = reply_trees.format_trees(reply_trees.chains(frame)).first()
    cut = [reply_trees.unescape(made["formatted"][s["start"] : s["stop"]]) for s in made["loss_spans"]]
    assert cut == ["é <|im_end|> \\ a", "", "b"]


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 0, "user", "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = reply_trees.format_trees(reply_trees.chains(frame)).first()
    assert [t for _, t in reply_trees.parse(made["formatted"])] == ["s", "a", "a", "b"]


def test_query(spark):
    assert compare(op10_reply_trees(spark, SF_SMALL), ORACLE["op10_reply_trees"], SF_SMALL) == []


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}<|") for i in range(20_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = reply_trees.format_trees(reply_trees.chains(frame)).first()
    assert reply_trees.parse(made["formatted"]) == [(r[2], r[3]) for r in rows]
    cut = [reply_trees.unescape(made["formatted"][s["start"] : s["stop"]]) for s in made["loss_spans"]]
    assert cut == [r[3] for r in rows if r[2] == "assistant"]
