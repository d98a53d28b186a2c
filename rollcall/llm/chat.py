"""Chat formatting with compiled templates, and reading the output back.

Rows of a conversation are ordered by turn, role and text (nulls first); a null role or text is empty, a null conversation id is a
conversation of its own, repeated rows are repeated turns. An empty table gives an empty result. Other columns are not read.

A conversation of any length is rendered and read back as a stream over its sorted rows: the output is cut into parts, and a task holds
one part and one turn at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import NO_ID, named
from rollcall.llm.template import BEGIN, END, Template, unescape

# The control strings.
START, STOP = "<|im_start|>", "<|im_end|>"
#: Only the text of assistant turns is under the loss mask.
TURNS = (
    '{% for m in messages %}<|im_start|>{{ m.role | escape_line }}{{ "\\n" }}'
    '{% if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}'
    '<|im_end|>{{ "\\n" }}{% endfor %}'
)
#: Characters of a part.
PART_CHARS = 200_000


def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator:
    for batch in batches:
        yield from batch.itertuples(index=False)


def format_chats(rows: DataFrame, template: str = TURNS, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """conv_id, part (from 0), text and loss (spans in that part, code points), in parts of about PART_CHARS characters."""
    compiled = Template(template)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (conv, no_id), turns in groupby(rows_of(batches), key=lambda r: (r.id, r.no_id)):
            messages = ({"role": t.role, "text": t.text} for t in turns)
            part, out, size, spans, since = 0, [], 0, [], None
            for piece in compiled.pieces(messages):
                if piece is BEGIN:
                    since = size
                elif piece is END:
                    spans.append({"start": since, "end": size})
                    since = None
                else:
                    out.append(piece)
                    size += len(piece)
                if size >= PART_CHARS and since is None:
                    yield pd.DataFrame({"id": [conv], "no_id": [no_id], "part": [part], "text": ["".join(out)], "loss": [spans]})
                    part, out, size, spans = part + 1, [], 0, []
            if out or not part:
                yield pd.DataFrame({"id": [conv], "no_id": [no_id], "part": [part], "text": ["".join(out)], "loss": [spans]})
            for _ in messages:  # a template may leave turns unread
                pass

    df = rows.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(id_column).isNull().alias("no_id"),
        F.col(turn_column).cast("string").alias("turn"),
        F.col(turn_column).alias("order"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    df = df.repartition("id").sortWithinPartitions("id", "no_id", "order", "role", "text").drop("order", "turn")
    return named(df.mapInPandas(run, "id long, no_id boolean, part long, text string, loss array<struct<start:long,end:long>>"), id_column)


class Reader:
    """Reads formatted parts back, turn by turn."""

    def __init__(self) -> None:
        self.turns, self.loss_chars, self.chars, self.rest = 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, spans: list) -> None:
        self.chars += len(text)
        for s in spans:
            masked = unescape(text[s["start"] : s["end"]])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
        text = self.rest + text
        at = 0
        while (end := text.find(STOP + "\n", at)) >= 0:
            if not text.startswith(START, at):
                raise ValueError(f"no turn begins at {text[at : at + 40]!r}")
            role, _, body = text[at + len(START) : end].partition("\n")
            self.turns += 1
            self.all.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            at = end + len(STOP) + 1
        self.rest = text[at:]


def read_back(parts: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the output of ``format_chats``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for (conv, no_id), own in groupby(rows_of(batches), key=lambda r: (r.id, r.no_id)):
            reader = Reader()
            for p in own:
                reader.feed(p.text, p.loss)
            if reader.rest:
                raise ValueError(f"conversation {conv} has text after its last turn")
            out.append((conv, no_id, reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    columns = ["id", "no_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    df = parts.withColumn("id", F.coalesce(F.col(id_column), F.lit(NO_ID))).withColumn("no_id", F.col(id_column).isNull())
    df = df.select("id", "no_id", "part", "text", "loss").repartition("id").sortWithinPartitions("id", "no_id", "part")
    schema = "id long, no_id boolean, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return named(df.mapInPandas(run, schema), id_column)
