import hashlib

import pytest

from likeness.llm import chat
from likeness.llm.common import table
from tests.conftest import SF_ORACLE

SCHEMA = "conv_id long, turn int, role string, text string, formatted string, Output string"
NASTY = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\s>[INST\\]", "", "[\\/INST]", "<s", "🙂 é", "a</s></s>b", "[INST][INST]"]


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_reversible_and_hides_control_strings(text):
    shown = chat.escape(text)
    assert chat.unescape(shown) == text and not any(c in shown for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_spans_and_loss_are_read_back():
    turns = [("system", "be kind"), ("user", NASTY[0]), ("assistant", NASTY[0]), ("user", ""), ("assistant", ""), ("assistant", "x")]
    got = chat.render(turns)
    assert chat.read_turns(got.output) == turns and got.rewritten == -1
    assert [chat.read_turns(got.output[a:b]) for a, b in got.spans] == [[t] for t in turns]
    assert [chat.unescape(got.output[a:b]) for a, b in got.loss] == [t for r, t in turns if r == "assistant"]


def test_a_template_that_rewrites_history_is_found():
    def last_only(messages):   # drops earlier answers
        return "".join(f"<{r}>{t}" for r, t in messages[:-1] if r != "assistant") + "".join(
            f"<{r}>{t}" for r, t in messages[-1:])
    got = chat.render([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")], last_only)
    assert got.rewritten == 2 and not got.loss
    assert [o[a:b] for o, a, b in got.samples][-1].endswith("d")


def test_table_edges(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "hi"), (None, 1, "user", "lost"), (2, None, None, "x"), (3, 1, "assistant", "t"),
            (3, 1, "assistant", "t")]
    d = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    out = {r.conv_id: r for r in chat.q_chat(d).collect()}
    assert set(out) == {-1, 1, 2, 3} and out[3].n_turns == 2 and out[3].loss_chars == 2 and out[1].loss_chars == 0
    assert out[1].turns_sha256 == hashlib.sha256(b"user\nhi\nassistant\n\n").hexdigest()
    assert out[-1].loss_sha256 == hashlib.sha256(NASTY[0].encode()).hexdigest()
    assert [r.conv_id for r in chat.q_chat(spark.createDataFrame([], SCHEMA)).collect()] == [-1]


def test_whole_table_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_ORACLE}/conversations.parquet'")
    cur = con.execute(chat.Q_CHAT_SQL)
    names = [c[0] for c in cur.description]
    assert {tuple(r[n] for n in names) for r in chat.q_chat(table(spark, SF_ORACLE, "conversations")).collect()} == set(cur.fetchall())


def test_samples_of_a_rewriting_template_are_in_the_table(spark, monkeypatch):
    def last_only(messages):   # drops earlier answers
        return "".join(f"<{r}>{t}" for r, t in messages[:-1] if r != "assistant") + "".join(
            f"<{r}>{t}" for r, t in messages[-1:])
    said = [("user", "a"), ("assistant", "b🙂"), ("user", "c"), ("assistant", "d")]
    rows = [(conv, k, role, text) for conv in range(5) for k, (role, text) in enumerate(said)] + [(9, 0, "user", "x")]
    d = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    for limit in (chat.SAMPLE_CHARS, 1):
        monkeypatch.setattr(chat, "SAMPLE_CHARS", limit)
        out = {r.conv_id: r for r in chat.format_conversations(d, last_only).collect()}
        assert set(out) == {0, 1, 2, 3, 4, 9} and out[9].samples == [] and out[9].rewritten_at == -1
        for conv in range(5):
            assert out[conv].rewritten_at == 2 and not out[conv].loss_spans
            got = [(s.output, s.output[s.loss_start:s.loss_end]) for s in out[conv].samples]
            assert got == [("<user>a<assistant>b🙂", "<assistant>b🙂"), ("<user>a<user>c<assistant>d", "<assistant>d")]
    assert all(r.samples == [] for r in chat.format_conversations(d).collect())
