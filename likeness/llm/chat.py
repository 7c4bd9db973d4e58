"""Chat formatting by incremental black-box rendering (operator 4).

A template is any function from messages to one string; nothing is known of
its inside.  Successive prefixes of the turns are rendered and consecutive
outputs compared: what the k-th output adds to the one before it is the k-th
turn's span.  Where an output does not start with the one before it, the
template has rewritten history; the conversation is flagged with the turn at
which this happened, and its training samples are then the prefix renderings
themselves, one per assistant turn, each masked from the point where it leaves
the rendering without that turn.

Within a turn's span the text is what lies between the rendering of the same
turn with two different probe texts: what both probes share in front and
behind is the template's frame.  The mask is read back from the output alone.

``marked_turns`` is the template of the query.  Its control strings are
``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``; one that occurs in a text gets a
backslash after its first character (and one more if it has some already), so
no text can open or close a turn, and taking one away restores the text.

Edge cases: a null text or role is empty; rows without a conversation id belong
to none and are left out; rows of one turn number are ordered by role and text;
repeated rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likeness.llm.common import arrow_map

_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)
PROBES = ("\ue000", "\ue001")     # private-use probe texts: no common start or end


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def marked_turns(messages: list[tuple[str, str]]) -> str:
    """``<s>[INST]role[/INST]text</s>`` per turn, texts and roles escaped."""
    return "".join(f"<s>[INST]{escape(r)}[/INST]{escape(t)}</s>" for r, t in messages)


def read_turns(output: str) -> list[tuple[str, str]]:
    """Roles and texts of an output of ``marked_turns``."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(output)]


@dataclass
class Rendered:
    """``spans``: (start, end) of each turn in ``output``; ``loss``: spans under
    the mask; ``rewritten``: first turn that changed what was there, or -1.
    With rewriting, ``samples`` holds (output, loss start, loss end) per
    assistant turn and the two lists of spans are empty."""
    output: str
    spans: list[tuple[int, int]]
    loss: list[tuple[int, int]]
    rewritten: int
    samples: list[tuple[str, int, int]]


def _shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.startswith(b[:mid]) else (low, mid - 1)
    return low


def _frame(template, before: list[tuple[str, str]], start: int, role: str) -> tuple[int, int]:
    """(characters before, after) a turn's text within what the turn adds: what
    the renderings with two probe texts have in common."""
    one, two = (template([*before, (role, p)])[start:] for p in PROBES)
    head = _shared(one, two)
    tail = _shared(one[head:][::-1], two[head:][::-1])
    return head, tail


def render(messages: list[tuple[str, str]], template: Callable = marked_turns,
           learn_from: tuple[str, ...] = ("assistant",)) -> Rendered:
    """Render all prefixes of ``messages`` and locate turns and loss."""
    output, spans, rewritten, samples = template([]), [], -1, []
    for k in range(1, len(messages) + 1):
        before, output = output, template(messages[:k])
        if not output.startswith(before) and rewritten < 0:
            rewritten = k - 1
        spans.append((len(before), len(output)))
        if messages[k - 1][0] in learn_from:
            samples.append((k, _shared(before, output), len(output)))
    if rewritten >= 0:
        return Rendered(output, [], [], rewritten, [(template(messages[:k]), a, b) for k, a, b in samples])
    loss, frames = [], {}
    for k, (start, end) in enumerate(spans):
        role = messages[k][0]
        if role in learn_from:
            # the frame seen at an earlier turn of this role is checked here, not assumed
            head, tail = frames.get(role) or _frame(template, messages[:k], start, role)
            frames[role] = head, tail
            again = template([*messages[:k], (role, "")])[start:]
            if len(again) != head + tail or not output.startswith(again[:head], start):
                head, tail = _frame(template, messages[:k], start, role)
            loss.append((start + head, end - tail))
    return Rendered(output, spans, loss, -1, [])


RESULT = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("turn_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("rewritten_at", T.LongType()),
    T.StructField("samples", T.ArrayType(T.StructType([
        T.StructField("output", T.StringType()), T.StructField("loss_start", T.LongType()), T.StructField("loss_end", T.LongType())]))),
])
SAMPLE_CHARS = 8 << 20            # of one written batch: samples are longer than their turns


def _turns(rows: DataFrame) -> DataFrame:
    """(conv_id, messages): turns in order, gathered per conversation.  The
    aggregate holds one conversation, which has to be rendered as one string
    anyway; conversations are spread over tasks by their id."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def format_conversations(rows: DataFrame, template: Callable = marked_turns,
                         learn_from: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, turn_spans, loss_spans, rewritten_at, samples) per
    conversation of ``rows`` (conv_id, turn, role, text); spans in code points,
    ends exclusive; ``rewritten_at`` is -1 or the turn that rewrites history.
    With rewriting, ``samples`` has (output, loss_start, loss_end) per turn to
    learn from and the two lists of spans are empty; else it is empty."""
    most = SAMPLE_CHARS

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        sample = pa.list_(pa.struct([("output", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]))
        kinds = [pa.int64(), pa.string(), span, span, pa.int64(), sample]

        def written(out):
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], RESULT.names)

        for batch in batches:
            out, chars = [[] for _ in kinds], 0
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = render([(t["role"], t["text"]) for t in turns], template, learn_from)
                row = (conv, got.output, [{"start": a, "end": b} for a, b in got.spans],
                       [{"start": a, "end": b} for a, b in got.loss], got.rewritten,
                       [{"output": o, "loss_start": a, "loss_end": b} for o, a, b in got.samples])
                for column, value in zip(out, row):
                    column.append(value)
                chars += sum(len(o) for o, *_ in got.samples)
                if chars > most:
                    yield written(out)
                    out, chars = [[] for _ in kinds], 0
            yield written(out)

    return _turns(rows).mapInArrow(run, RESULT)


# Fixed value: the conversation that the query adds to its table.
PLANTED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def q_chat(rows: DataFrame) -> DataFrame:
    """The query's digests, read back from the formatted output."""
    own = rows.select("conv_id", "turn", "role", "text")
    planted = rows.sparkSession.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")

    def run(batch):
        out: list[list] = [[], [], [], [], [], []]
        for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
            turns = read_turns(text)
            learnt = [unescape(text[s["start"]:s["end"]]) for s in loss]
            row = (conv, len(turns), _hex("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, learnt)),
                   _hex("".join(learnt)), len(text))
            for column, value in zip(out, row):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], [
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return arrow_map(
        format_conversations(own.unionByName(planted)).select("conv_id", "formatted", "loss_spans"), run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


_ESC = r"regexp_replace({}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g')"
Q_CHAT_SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (CAST(-1 AS BIGINT), CAST(0 AS BIGINT), 'user', '</s>[INST] ok [/INST]'),
                   (CAST(-1 AS BIGINT), CAST(1 AS BIGINT), 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + length({_ESC.format('role')}) + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
