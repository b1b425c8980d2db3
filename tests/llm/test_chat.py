import hashlib

import pytest

from campusgrid.llm.chat import CONTROL, END, SEPARATOR, START, escape, fold_messages, read_back, render, unescape
from campusgrid.llm.queries import conversation_log
from pyspark.sql import functions as F

EVENTS = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string"


def test_events_fold_to_final_messages(spark):
    log = [
        (1, 0, 0, "delta", "user", "he"), (1, 0, 1, "delta", None, "llo"),
        (1, 1, 5, "delta", "assistant", "draft"), (1, 1, 6, "regenerate", None, None), (1, 1, 8, "delta", None, "b"), (1, 1, 7, "delta", None, "a"),
        (1, 2, 0, "delta", "user", "x"), (1, 2, 1, "edit", "user", "edited"), (1, 2, 2, "delta", None, "!"), (1, 2, 2, "delta", None, "!"),
        (1, 3, 0, "regenerate", "assistant", "ignored"), (2, 0, 0, "edit", None, None), (2, 1, 0, "ping", "user", "x"),
        (None, 0, 0, "delta", "user", "n"), (2, None, 0, "delta", "user", "m"),
    ]
    for parts in (1, 4):
        found = fold_messages(spark.createDataFrame(log, EVENTS).repartition(parts)).collect()
        assert {(r.conv_id, r.message): (r.role, r.text) for r in found} == {
            (1, 0): ("user", "hello"), (1, 1): ("assistant", "ab"), (1, 2): ("user", "edited!"), (1, 3): ("assistant", ""),
            (2, 0): ("", ""), (None, 0): ("user", "n"), (2, None): ("user", "m"),
        }
    assert render(fold_messages(spark.createDataFrame([], EVENTS))).collect() == []


ODD = [*CONTROL, *[c[0] + "\\" + c[1:] for c in CONTROL], *[c[0] + "\\\\\\" + c[1:] for c in CONTROL], "\\", "<", "[[INST]", "<<s>>",
       "</s></s>", "<|im_start|>user<|im_sep|>x<|im_end|>", "<<<SYS>>", "plain", "", "\n", "日本🙂</s>é", "$1\\2", "<\\\\", "</s"]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    df = spark.createDataFrame([(t,) for t in ODD] + [(a + b,) for a in ODD for b in ODD], "t string")
    rows = df.select("t", escape("t").alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in rows)
    assert not [r.e for r in rows if any(c in r.e for c in CONTROL)]
    assert all(r.e == r.t for r in rows if r.t in ("plain", "\\", "<", "</s"))


def test_transcripts_read_back(spark):
    convs = {
        i: [(m, r, t) for m, (r, t) in enumerate(zip(["system", "user", "assistant", "assistant", "", "us<|im_sep|>er", None] * 9, ODD[i:] + ODD[:i]))]
        for i in range(20)
    }
    rows = [(i, m, r, t) for i, turns in convs.items() for m, r, t in turns]
    frame = spark.createDataFrame(rows, "conv_id bigint, message bigint, role string, text string").repartition(5)
    shown = render(frame)
    for r in read_back(shown).join(shown.select("conv_id", "loss_spans", "turn_starts"), "conv_id").collect():
        want = [(role or "", text) for _, role, text in convs[r.conv_id]]
        assert [tuple(t) for t in r.turns] == want
        assert r.loss_texts == [t for role, t in want if role == "assistant"]
        for (role, _), start, span in zip(want, r.turn_starts, r.loss_spans):
            assert r.formatted[start:].startswith(START) and (span is not None) == (role == "assistant")
        assert r.formatted.count(START) == r.formatted.count(END) == r.formatted.count(SEPARATOR) == len(want)


def test_log_of_a_table(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes </s>"), (1, 1, "assistant", "yes </s>"), (1, 2, "user", None), (None, None, None, "odd"), (3, 5, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    read = {r.conv_id: r for r in read_back(render(fold_messages(conversation_log(df)))).collect()}
    assert [tuple(t) for t in read[1].turns] == [("user", "hi"), ("assistant", "yes </s>"), ("assistant", "yes </s>"), ("user", "")]
    assert [tuple(t) for t in read[None].turns] == [("", "odd")] and read[3].loss_texts == [""]


def test_long_conversation(spark):
    df = spark.range(20_000).selectExpr("1L conv_id", "id message", "if(id % 2 = 0, 'user', 'assistant') role", "concat('text ', id, ' </s>') text")
    r = read_back(render(df)).select("conv_id", F.size("turns").alias("n"), F.sha2(F.array_join("loss_texts", ""), 256).alias("h")).first()
    assert r.n == 20_000 and r.h == hashlib.sha256("".join(f"text {i} </s>" for i in range(1, 20_000, 2)).encode()).hexdigest()
