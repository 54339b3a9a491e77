"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string; nothing is known of its inside. The
prefixes of a conversation are rendered one turn longer each time. What a turn adds at the end of the previous
output is its span. Where an output does not begin with the one before it, the template rewrites history, and
no span can be trusted. Inside an assistant's span the text is found by probes: the same prefix is rendered with other
texts in the place of the last one, and what those outputs have in common at both ends is the template's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

#: control strings of the template below
OPEN, CLOSE, START, END = "[INST] ", " [/INST]", "<s>", "</s>"
ESCAPE = "\\"
#: letter behind the escape for each character that a control string begins with, and for the escape itself
LETTERS = {ESCAPE: "b", "[": "s", "<": "a", ":": "c"}
#: texts without a character that a template would escape, unlike at both ends
PROBES = ("a", "z")
_MEANINGS = {letter: mark for mark, letter in LETTERS.items()}


class HistoryRewritten(ValueError):
    """A longer prefix does not begin with the output of the shorter one."""


def escape(text: str) -> str:
    """No control string and no colon is left in the result; ``unescape`` gives the text back."""
    for mark, letter in LETTERS.items():  # the escape itself comes first
        text = text.replace(mark, ESCAPE + letter)
    return text


def unescape(text: str) -> str:
    first, *parts = text.split(ESCAPE)
    return first + "".join(_MEANINGS[p[0]] + p[1:] for p in parts)


def instruction_template(turns: Sequence[Turn]) -> str:
    """Assistant turns as ``text</s>``, all others as ``<s>[INST] role: text [/INST]``."""
    return "".join(
        f"{escape(text)}{END}" if role == "assistant" else f"{START}{OPEN}{escape(role)}: {escape(text)}{CLOSE}" for role, text in turns
    )


def turn_spans(turns: Sequence[Turn], template: Template) -> tuple[str, list[tuple[int, int]]]:
    """The whole output and each turn's span in it, from renderings of all prefixes.

    Raises ``HistoryRewritten`` if a turn changes what was rendered before it.
    """
    output, spans = template([]), []
    for count in range(1, len(turns) + 1):
        longer = template(turns[:count])
        if not longer.startswith(output):
            raise HistoryRewritten(f"turn {count - 1} changes the output of the turns before it")
        spans.append((len(output), len(longer)))
        output = longer
    return output, spans


def read_back(output: str) -> list[Turn]:
    """The turns of an ``instruction_template`` output."""
    turns, at = [], 0
    while at < len(output):
        if output.startswith(START + OPEN, at):
            end = output.index(CLOSE, at)
            role, _, text = output[at + len(START + OPEN) : end].partition(": ")
            turns.append((unescape(role), unescape(text)))
            at = end + len(CLOSE)
        else:
            end = output.index(END, at)
            turns.append(("assistant", unescape(output[at:end])))
            at = end + len(END)
    return turns


class TextNotFound(ValueError):
    """A turn's text does not stand in one piece between what the template puts around any text."""


def loss_spans(turns: Sequence[Turn], template: Template, output: str, spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where the assistants' texts, and only they, stand in the output; nothing is assumed of how they are escaped.

    Raises ``TextNotFound`` where the frame of the probes is not that of the text, or a probe is not what is left of it.
    """
    found = []
    for place, ((role, _), (start, end)) in enumerate(zip(turns, spans)):
        if role != "assistant":
            continue
        one, other = (template([*turns[:place], (role, probe)])[start:] for probe in PROBES)
        head = len(commonprefix([one, other]))
        tail = len(commonprefix([one[head:][::-1], other[head:][::-1]]))
        framed = (one[head : len(one) - tail], other[head : len(other) - tail]) == PROBES and end - start >= head + tail
        if not framed or not output.startswith(one[:head], start) or output[end - tail : end] != one[len(one) - tail :]:
            raise TextNotFound(f"the text of turn {place} is not found in the output")
        found.append((start + head, end - tail))
    return found


def render_conversations(turns: DataFrame, template: Template = instruction_template) -> DataFrame:
    """Format conversations (columns ``conv_id``, ``turn``, ``role``, ``text``): one row each.

    Returns ``conv_id``, ``n_turns``, ``formatted``, ``spans`` and ``loss`` (start and end of each turn and of
    each text that a model learns from, in characters of ``formatted``), and ``problem``: null, or why ``loss`` is
    null: ``history rewritten`` (``spans`` is null too) or ``text not found``. One such conversation does not end the
    job. Null texts and roles are empty. Turns
    are ordered by ``turn``, then role and text; repeated rows are turns of their own and nulls come first.
    Turns with a null ``conv_id`` form one conversation. Further columns are ignored; an empty table gives no rows.
    A conversation is one sequence and read as a stream in one task, which holds one conversation at a time.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    arranged = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, held, conversation = pa.int64(), [], None

        def formatted() -> pa.RecordBatch:
            spans = loss = problem = None
            try:
                output, spans = turn_spans(held, template)
                loss = loss_spans(held, template, output, spans)
            except HistoryRewritten:
                output, problem = template(held), "history rewritten"
            except TextNotFound:
                problem = "text not found"
            pairs = pa.list_(pa.list_(pa.int64()))
            lists = [pa.array([places and [list(s) for s in places]], pairs) for places in (spans, loss)]
            return pa.RecordBatch.from_arrays(
                [pa.array([conversation], kind), pa.array([len(held)], pa.int64()), pa.array([output]), *lists, pa.array([problem], pa.string())],
                ["conv_id", "n_turns", "formatted", "spans", "loss", "problem"])

        for batch in batches:
            kind = batch.column("conv_id").type
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if held and conv_id != conversation:
                    yield formatted()
                    held = []
                conversation = conv_id
                held.append((role, text))
        if held:
            yield formatted()

    schema = f"conv_id {id_type}, n_turns long, formatted string, spans array<array<bigint>>, loss array<array<bigint>>, problem string"
    return arranged.mapInArrow(render, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when they are read back: counts and digests of turns and of text under the mask.

    For outputs of ``instruction_template``. Where there is no mask, ``loss_chars`` and ``loss_sha256`` are null.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for output, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                turns = read_back(output)
                told = "".join(f"{role}\n{text}\n" for role, text in turns)
                learned = None if loss is None else "".join(unescape(output[a:b]) for a, b in loss)
                masked = (None, None) if learned is None else (len(learned), _sha256(learned))
                rows.append((len(turns), _sha256(told), *masked, len(output)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * 5, kinds)]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names)

    schema = f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(read, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
