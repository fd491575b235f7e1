import hashlib

from cytoframe.llm import chat


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask string")


def test_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>", "\\", "\\<|", "<\\|end|>", "a<", "|x", "<<SYS>> <|<| \\\\ </s", "", None, "line\nbreak", "\U0001f600é"]
    roles = ["user", "assistant", "assistant", "system", None, "us<|er"]
    rows = [(c, t, roles[(c + t) % 6], nasty[(c * 5 + t) % len(nasty)], "m") for c in range(12) for t in range(7)]
    rows += [(50, 0, "user", "x" * 300_000, "m"), (51, 1, "assistant", "same", "m"), (51, 1, "assistant", "same", "m"), (52, None, "assistant", "n", "m"), (None, 0, "user", "null id", "m")]
    out = chat.format_conversations(table(spark, rows))
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        loss = "".join(t for _, role, t in own if role == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in own).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in out.collect():
        assert "".join(p.text for p in r.mask) == r.formatted and not any(x in r.formatted for x in ("</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_runs_of_a_role_share_a_header(spark):
    r = chat.format_conversations(table(spark, [(1, 0, "user", "a", ""), (1, 1, "user", "b", ""), (1, 2, "assistant", "c", "")])).first()
    assert r.formatted == "<|turn|>user<|text|>a<|part|>b<|end|><|turn|>assistant<|text|>c<|end|>"
    assert [p.text for p in r.mask if p.loss] == ["c"]


def test_empty_and_probe(spark):
    e = table(spark, [])
    assert chat.read_back(chat.format_conversations(e)).count() == 0
    r = chat.read_back(chat.format_conversations(chat.with_probe(e))).first()
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-7, 2, 21)
