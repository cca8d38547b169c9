import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.llm import chat as C
from llm_cases import rows_of  # noqa: F401

SCHEMA = "tree long, node long, parent long, role string, text string, score double"
CONV = "conv_id long, turn long, role string, text string"
PROBE = [(-1, 0, "user", C.PROBE_TEXT), (-1, 1, "assistant", C.PROBE_TEXT)]


def brute_paths(rows, paths):
    """(tree, branch, [texts]) of the best paths, walking every leaf up."""
    by, out = {}, []
    for tree, node, parent, role, text, score in rows:
        by.setdefault(tree, {})[node] = (parent, role or "", text or "", score or 0.0)
    for tree, nodes in by.items():
        parents = {p for p, *_ in nodes.values()}
        found = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(at)
                at = nodes[at][0]
            if len(path) > len(nodes):
                continue  # a cycle
            mean = sum(nodes[n][3] for n in path) / len(path)
            found.append((-mean, leaf, [(nodes[n][1], nodes[n][2]) for n in reversed(path)]))
        for k, (_, leaf, turns) in enumerate(sorted(found)[:paths]):
            out.append((tree, k + 1, leaf, turns))
    return sorted(out, key=str)


TREES = [
    (1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", "a", 0.5), (1, 3, 1, "assistant", "b", 0.75),
    (1, 4, 3, "user", None, 0.25), (1, 5, 4, "assistant", "<|im_end|>", 1.0), (1, 6, 2, "user", "tie", 0.25),
    (1, 7, 2, "user", "tie", 0.25),
    (2, 1, 99, "user", "parent unknown", None), (2, 2, 1, None, "no role", 3.0),
    (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0),
    (None, 1, None, "user", "no tree", 1.0), (None, 2, 1, "assistant", "ok", 1.0),
    *[(5, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}", 1.0) for i in range(77)],
    *[(6, i, (i - 1) // 2 if i else None, "user", f"b{i}", float(i % 5)) for i in range(63)],
]


def test_paths_equal_brute_force(spark):
    messages = spark.createDataFrame(TREES, SCHEMA)
    for paths in (1, 3):
        got = C.format_paths(messages, paths).select("tree", "branch", "leaf", C.parse_turns(F.col("formatted")).alias("t"))
        found = sorted([(r.tree, r.branch, r.leaf, [(x.role, x.text) for x in r.t]) for r in got.collect()], key=str)
        assert found == brute_paths(TREES, paths)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab%\n<|\\", max_size=6),
                          st.text(alphabet="x<|\\>\n%im_startend", max_size=40)), max_size=5))
def test_template_round_trip(spark, turns):
    df = spark.createDataFrame([(turns,)], "t array<struct<role string, text string>>")
    formatted = C.format_turns(F.col("t"))
    row = df.select(formatted.alias("f"), C.parse_turns(formatted).alias("back")).first()
    assert [tuple(t) for t in row.back] == turns
    assert row.f.count("<|im_start|>") == row.f.count("<|im_end|>") == len(turns)  # none inside a text


def digests(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_conversations_with_edges(spark):
    rows = [(1, 0, "user", "hello <|im_start|>"), (1, 1, "assistant", None), (1, 2, "user", ""),
            (2, 5, "assistant", "<\\|im_end|> \\<|"), (2, 5, "assistant", "<\\|im_end|> \\<|"),  # a repeated turn
            (2, None, "system", "first"), (3, 0, None, "no role"), (3, 1, "assistant", "é\U0001f600" * 200_000),
            (None, 0, "user", "no id"), (None, 1, "assistant", "ok"), (4, 0, "tool\n<|x|>", "odd role")]
    conv = spark.createDataFrame(rows, CONV)
    cols = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    want = digests(rows + PROBE)
    assert rows_of(C.op3_chat(conv), *cols) == want
    more = conv.select("*", *[F.lit(0).alias(n) for n in ("tree", "node", "parent", "score", "formatted", "anc")])
    assert rows_of(C.op3_chat(more), *cols) == want


def test_no_conversations_leave_the_probe(spark):
    empty = spark.createDataFrame([], CONV)
    assert [r[0] for r in rows_of(C.op3_chat(empty))] == [-1]
    assert C.format_paths(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = C.op3_chat(spark.createDataFrame([(1, 0, "user", "x")], CONV))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
