import hashlib

from tarn.llm import chat

NODES = "node string, parent string, role string, text string, score double"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_best_branches_of_a_tree(spark):
    rows = [("a", None, "user", "q", 1.0), ("b", "a", "assistant", "one", 2.0), ("c", "a", "assistant", "two", 3.0), ("d", "b", "user", "why", None), ("e", "d", "assistant", "so", 5.0), ("f", "c", "user", "hm", 1.0), ("x", "gone", "user", "lost", 0.0), ("y", "z", "user", "", 1.0), ("z", "y", "user", "", 1.0), ("w", "z", "user", "", 9.0)]
    nodes = spark.createDataFrame(rows, NODES)
    got = {(r.root, r.leaf): (r["rank"], r.chat) for r in chat.formatted(nodes, keep=2).collect()}
    assert got == {
        ("a", "e"): (1, "### User: q</turn>\n### Assistant: one</turn>\n### User: why</turn>\n### Assistant: so</turn>\n"),
        ("a", "f"): (2, "### User: q</turn>\n### Assistant: two</turn>\n### User: hm</turn>\n"),
        ("x", "x"): (1, "### User: lost</turn>\n"),
    }
    assert {(r.leaf, r.score) for r in chat.ranked(nodes, chat.branches(nodes)).collect()} == {("e", 8.0), ("f", 5.0), ("x", 0.0)}
    assert chat.formatted(nodes.limit(0)).collect() == []


def test_deep_paths(spark):
    rows = [(str(k), str(k - 1) if k else None, "user", "t", 0.0) for k in range(300)]
    got = chat.branches(spark.createDataFrame(rows, NODES)).collect()
    assert len(got) == 300 and {r.leaf for r in got} == {"299"} and sorted(r.up for r in got) == list(range(300))


def test_texts_come_back_exactly(spark):
    texts = ["", "plain", "### User: a</turn>\n### Assistant: b", "\\", "\\s\\h\\l", "a: b :", "<", "# \\# <", "\n", "é🙂: ", "</turn>\n", "\\\\c::"]
    for role in ("user", "assistant", "tool:<#\\>", "", None, "System"):
        df = spark.createDataFrame([(role, t) for t in texts], "role string, text string")
        out = df.select("role", "text", chat.read_back(chat.turn(df.role, df.text)).alias("r")).collect()
        for r in out:
            assert [(x.role, x.text) for x in r.r] == [(role or "", r.text)]


def test_query(spark):
    d = "/root/testdata/sf0.01"
    by = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for r in sorted(spark.read.parquet(f"{d}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: r for r in chat.op7_chat_formatting(spark, d).collect()}
    assert set(got) == set(by)
    for i, turns in by.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[i]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > sum(len(t) for _, t in turns)


def test_odd_rows(spark):
    rows = [(None, 0, "user", None, 1), (None, 1, None, "x", 1), (2, 5, "user", "b", 1), (2, 5, "user", "a", 1), (2, 5, "user", "a", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int")
    nodes = chat.conversation_nodes(df)
    got = {r.root: r.chat for r in chat.formatted(nodes).collect()}
    assert got == {"none/1": "### User: </turn>\n### role=: x</turn>\n", "2/1": "### User: a</turn>\n### User: a</turn>\n### User: b</turn>\n"}
