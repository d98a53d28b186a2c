"""Secret scans: patterns of known forms, and assignment-aware lexing of source and configuration text.

The lexer turns a text into name-literal pairs, follows names that were given a literal before (constants, also joined with +), and
scores each literal by the sensitivity of the name it ends up under and by its own make-up. Values without quotes must hold a digit; after a colon and a name
without quotes they must also end their line, which keeps prose out.

A null text counts as empty, and an empty text has no spans; every row is scanned by itself, whatever its id; an empty table gives an
empty result. Texts are scanned whole, and nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The three known forms, with the least length of what must follow.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "named")

#: Words of a name and how much each says that its value is secret.
SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 2, "apikey": 3, "credential": 3, "credentials": 3,
    "private": 1, "access": 1, "api": 1, "auth": 1, "bearer": 2, "key": 2, "signing": 1, "client": 1, "encryption": 1,
}
#: A literal is reported when name and make-up reach this together.
LEAST_SCORE = 5.0
#: Names with less are not reported.
LEAST_WEIGHT = 2
#: Values that only stand for a secret.
STAND_INS = re.compile(r"^(?:\[.*|\$\{.*|\{\{.*|<.*|%\(.*|x{4,}|\*+|changeme|example.*|your[_-].*|placeholder.*|none|null|true|false|undefined)$", re.I)
LEX = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    # a name gives up its parts between dots only, so that a long run of letters and dashes is looked at once
    r"""|(?P<name>[A-Za-z_$][\w$]*+(?:-[A-Za-z_$][\w$]*+)*+(?:\.[A-Za-z_$][\w$]*+(?:-[A-Za-z_$][\w$]*+)*+)*)(?![A-Za-z0-9+/_=-]*[+/][A-Za-z0-9+/]{8})"""
    r"""|(?P<assign>:=|=>|=(?!=)|:(?![:/]))"""
    r"""|(?P<plus>\+)"""
    r"""|(?P<end>[\n;,]|\#[^\n]*|//[^\n]*)"""
    r"""|(?P<bare>[A-Za-z0-9+/_.~$@!%^&*-]{8,}=*)"""
    r"""|(?P<other>[^\s])""",
    re.A,
)
#: The rest of a run without spaces, and what may stand between such a run and the end of its line or a comment.
RUN = re.compile(r"\S*", re.A)
LINE_END = re.compile(r"[ \t\r]*+(?:\n|\Z|(?<=[ \t])(?:\#|//))")
CLOSING = ",;.)}]"


class Span(NamedTuple):
    """A finding: the whole span, and the value in it that must go."""

    kind: str
    start: int
    end: int
    value_start: int
    value_end: int


def name_weight(name: str) -> int:
    words = re.findall(r"[a-z]+", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower())
    return sum(SENSITIVE.get(w, 0) for w in set(words))


def may_name(lower: str) -> bool:
    """Whether the words of a lower-cased text can give any name in it the least weight."""
    weight = 0
    for word, w in SENSITIVE.items():
        if word in lower:
            weight += w
            if weight >= LEAST_WEIGHT:
                return True
    return False


def make_up(value: str) -> float:
    """Up to 4: entropy per character, kinds of characters and length."""
    if len(value) < 8 or " " in value or STAND_INS.match(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]"))
    return min(entropy, 4.0) / 2 + (kinds >= 2) * 0.5 + (kinds >= 3) * 0.5 + (n >= 16) * 1.0


def lexed(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Names and the places of the literals they get, constants followed."""
    constants: dict[str, list[tuple[int, int]]] = {}
    tokens = [(m.lastgroup, m.start(), m.end()) for m in LEX.finditer(text)]
    k, last, run_end, ends_line = 0, len(tokens), -1, False
    while k < last:
        kind, a, b = tokens[k]
        named = kind == "name" or kind == "string" and b - a > 2
        if not named or k + 1 >= last or tokens[k + 1][0] != "assign":
            k += 1
            continue
        name = text[a:b].strip("\"'`")
        colon = text[tokens[k + 1][1] : tokens[k + 1][2]] == ":" and kind == "name"  # prose has colons, too: a bare value must end its line
        k, places, more = k + 2, [], True
        while k < last and more:
            kind, a, b = tokens[k]
            if kind == "string":
                places.append((a + 1, b - 1))
            elif kind == "name" and text[a:b] in constants:
                places += constants[text[a:b]]
            elif kind in ("bare", "name") and any(c.isdigit() for c in text[a:b]):
                if colon:
                    if b > run_end:
                        run_end = RUN.match(text, b).end()
                        ends_line = LINE_END.match(text, run_end) is not None
                    if places or not ends_line:
                        break
                    b += len(text[b:run_end].rstrip(CLOSING))
                    while k + 1 < last and tokens[k + 1][1] < b:
                        k += 1
                places.append((a, b))
            else:
                break
            k += 1
            more = k < last and tokens[k][0] == "plus"
            k += more
        if places:
            places = constants[name] = list(dict.fromkeys(places))  # a place that came by several names counts once
            yield name, places


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps that cover the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def taken_at(taken: list[tuple[int, int]], a: int, b: int) -> tuple[int, int] | None:
    """The last of the sorted spans that overlaps a to b."""
    at = bisect_left(taken, (b,)) - 1
    return taken[at] if at >= 0 and taken[at][1] > a else None


def find(text: str) -> list[Span]:
    """All spans of a text, by start, then kind."""
    lower = text.lower()
    found = [Span("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [Span("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    if "passw" in lower or "secret" in lower or "token" in lower or "api" in lower:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(Span("assign", m.start(), m.end(), m.start(2), m.end(2)))
    if ("=" in text or ":" in text) and may_name(lower):
        taken = merged([(s.start, s.end) for s in found])
        for name, places in lexed(text):
            weight = name_weight(name)
            for a, b in places if weight >= LEAST_WEIGHT else ():
                if weight + make_up(text[a:b]) >= LEAST_SCORE and taken_at(taken, a, b) is None:
                    insort(taken, (a, b))
                    found.append(Span("named", a, b, a, b))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redacted(text: str, spans: list[Span], by: str = "[secret]") -> str:
    """The text with the values of the spans replaced; overlapping values are replaced as one."""
    parts, at = [], 0
    for a, b in sorted((s.value_start, s.value_end) for s in spans):
        if a >= at:
            parts += [text[at:a], by]
        at = max(at, b)
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,value_start:int,value_end:int>>"


def findings(text: Column) -> Column:
    """A text's spans and the text without the values in them."""

    @F.pandas_udf(f"struct<spans:{SPANS},redacted:string>")
    def run(batch: pd.Series) -> pd.DataFrame:
        found = [find(t) for t in batch]
        clean = [redacted(t, s) if s else t for t, s in zip(batch, found)]
        return pd.DataFrame({"spans": [[s._asdict() for s in x] for x in found], "redacted": clean})

    return run(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, spans (array of structs, code points, end exclusive) and redacted text, per row."""
    return docs.select(F.col(id_column).alias("doc_id"), findings(F.col(text_column)).alias("found")).select("doc_id", "found.*")


def redact(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, the values of secrets replaced in the text; the length column follows where the text changed."""
    mark = "redacted " + "".join(docs.columns)  # a name that no column has
    found = docs.withColumn(mark, findings(F.col(text_column))["redacted"])
    changed = F.col(text_column).isNotNull() & (F.col(f"`{mark}`") != F.col(text_column))
    news = {text_column: F.when(changed, F.col(f"`{mark}`")).otherwise(F.col(text_column))}
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        news[length_column] = F.when(changed, F.length(F.col(f"`{mark}`")).cast(kind)).otherwise(F.col(length_column))
    return found.select(*[news[c].alias(c) if c in news else F.col(f"`{c}`") for c in docs.columns])
