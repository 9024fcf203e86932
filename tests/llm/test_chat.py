"""Conversations as texts: read back as they were, and the cases at the edge."""

import hashlib
import random

from pyspark.sql import functions as F

from eventloom.llm import catalog, chat

SF = "/root/testdata/sf0.001"
TABLE = "conv_id long, turn long, role string, text string"


def read(df, **options):
    made = chat.format_conversations(df, **options)
    return {r.conv_id: r for r in made.select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                                              chat.read_learnt(F.col("formatted"), F.col("loss_spans")).alias("learnt")).collect()}


def test_any_text_comes_back(spark):
    rnd = random.Random(7)
    bits = ["<", "\\", "|", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "</SYS>>", "<|im_end|>", "<|im_next|>", "<|im_mid|>", "<|im_start|>", "\n", "é", "漢", "$1", ""]
    rows = [(c, t, rnd.choice(["user", "assistant", "<|im_mid|>\n"]), "".join(rnd.choices(bits, k=rnd.randint(0, 9)))) for c in range(60) for t in range(rnd.randint(1, 12))]
    found = read(spark.createDataFrame(rows, TABLE), part_turns=3)
    for conv, r in found.items():
        own = [(x[2], x[3]) for x in rows if x[0] == conv]
        assert [tuple(t) for t in r.turns] == own and r.n_turns == len(own)
        assert r.learnt == [text for role, text in own if role == "assistant"]
        raw = r.formatted.encode()
        assert all(b"<|" not in raw[s.start:s.start + s.bytes] for s in r.loss_spans)
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:], strict=False))
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == blocks
        assert not any(x in r.formatted for x in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))
    assert len(found) == 60


def test_parts_change_nothing(spark):
    rows = [(1, t, "user" if t % 5 else "assistant", f"t{t}") for t in range(300)] + [(2, 10 ** 12, "user", "late"), (2, -5, "user", "early")]
    df = spark.createDataFrame(rows, TABLE)
    a, b = read(df, part_turns=7), read(df, part_turns=10_000)
    assert a == b and [t.text for t in a[2].turns] == ["early", "late"]


def test_edges(spark):
    rows = [(None, 0, None, None), (1, None, "user", "first"), (1, 0, "user", "second"), (1, 0, "user", "second"), (1, 0, "assistant", "tie"), (2, 0, "assistant", ""),
            (3, 0, "user", "x" * 300_000 + "</s>")]
    df = spark.createDataFrame(rows, TABLE).selectExpr("*", "'a' AS FORMATTED", "1 AS n_turns", "2 AS t", "3 AS conv")
    found = read(df)
    assert [tuple(t) for t in found[None].turns] == [("", "")] and found[None].learnt == []
    assert [tuple(t) for t in found[1].turns] == [("user", "first"), ("assistant", "tie"), ("user", "second"), ("user", "second")]
    assert found[2].learnt == [""] and found[3].turns[0].text == "x" * 300_000 + "</s>"
    assert chat.format_conversations(df.limit(0)).count() == 0
    assert read(df, learnt=("user", "assistant"))[1].learnt == ["first", "tie", "second", "second"]


def test_query_against_a_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    plain = {}
    for conv, _, role, text in sorted(rows, key=lambda r: r[:2]):
        plain.setdefault(conv, []).append((role or "", text or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = catalog.op13_relational_chat(spark, SF).collect()
    assert len(found) == len(plain)
    for r in found:
        own = plain[r.conv_id]
        loss = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(own), digest("".join(f"{a}\n{b}\n" for a, b in own)), len(loss), digest(loss))
    plan = catalog.op13_relational_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
