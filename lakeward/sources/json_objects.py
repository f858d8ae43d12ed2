"""The objects of a JSON text that may hold several roots, found by bracket depth, however deep."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

# A string ends at its quote, or at the end of its line if it was not finished.
_TOKEN = re.compile(r'"(?:[^"\\\n]|\\.)*"?|[{}\[\]]')
_LINE_OBJECT = re.compile(r"(?m)^([ \t]*)\{")
_BETWEEN = re.compile(r"^[\s,\[\]]+|[\s,\[\]]+$")
# Text handed on at once; a longer object comes by itself.
_CHARS_AT_ONCE = 1 << 22

METADATA = ("file_name", "file_path", "file_size", "file_modification_time")


def _last_before(text: str, at: int) -> str:
    at -= 1
    while at >= 0 and text[at].isspace():
        at -= 1
    return text[at] if at >= 0 else ""


def _next_object(text: str, start: int, end: int) -> int:
    """Where, before ``end``, the first line begins with an object and is indented no more than the one at ``start``."""
    line = text.rfind("\n", 0, start) + 1
    indent = start - line if not text[line:start].strip() else 0
    lines = _LINE_OBJECT.finditer(text, start + 1, end)
    return next((m.end() - 1 for m in lines if len(m.group(1)) <= indent), end)


def _object_end(text: str, start: int) -> tuple[int, bool]:
    """Where the object that opens at ``start`` ends, and whether it is whole.

    An object is torn if another one begins at a place where none may stand, or if the text ends
    before it. It then ends there, or at a line before that begins with an object like itself.
    """
    open_brackets: list[str] = []
    for token in _TOKEN.finditer(text, start):
        mark = token.group()[0]
        if mark == '"':
            continue
        if mark in "{[":
            if mark == "{" and open_brackets and _last_before(text, token.start()) not in (":" if open_brackets[-1] == "{" else "[,"):
                return _next_object(text, start, token.start()), False
            open_brackets.append(mark)
        elif open_brackets and open_brackets[-1] == ("{" if mark == "}" else "["):
            open_brackets.pop()
            if not open_brackets:
                return token.end(), True
    return _next_object(text, start, len(text)), False


def objects_of(text: str) -> Iterator[tuple[str, bool]]:
    """The texts of the objects outermost in ``text``, each with True; then, with False, what is left, if anything.

    Blanks, commas and square brackets around objects are no content. A text without any object is left whole.
    """
    at, left, found = 0, [], False
    while (start := text.find("{", at)) >= 0:
        left.append(text[at:start])
        at, whole = _object_end(text, start)
        if whole:
            found = True
            yield text[start:at], True
        else:
            left.append(text[start:at])
    left.append(text[at:])
    rest = _BETWEEN.sub("", "".join(left))
    if rest:
        yield (rest if found else text), False


def split_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole files (``_text`` and the file columns) to rows of objects; ``_whole`` is false for what is left."""
    for batch in batches:
        for row in range(len(batch)):
            held: list[tuple[str, bool]] = []
            chars = 0

            def rows() -> pa.RecordBatch:
                file = [batch[c].slice(row, 1).take(pa.array([0] * len(held))) for c in METADATA]
                columns = [pa.array([h[0] for h in held], pa.string()), pa.array([h[1] for h in held], pa.bool_()), *file]
                return pa.RecordBatch.from_arrays(columns, ["_text", "_whole", *METADATA])

            for piece in objects_of(batch["_text"][row].as_py()):
                held.append(piece)
                chars += len(piece[0])
                if chars >= _CHARS_AT_ONCE:
                    yield rows()
                    held, chars = [], 0
            if held:
                yield rows()
