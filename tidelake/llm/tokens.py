"""Token ids of whole texts as the tokenizers library gives them.

A byte-level tokenizer with the usual word pattern never joins text across a space between two
visible characters, and the space goes with what follows; a line feed between two such
characters stands alone. So a text is a row of units, each with its leading space, and a unit
has the same ids wherever it stands. Ids of units are kept in a table of bounded size. The
library gets unknown units strung together: the ids that begin with a space tell them apart.
Any other kind of tokenizer gets whole texts.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Iterable
from pathlib import Path
from string import punctuation

import numpy as np

from tidelake.llm.common import slices

_TWO_SPACES = re.compile(r"\s\s")
_UNIT_END = re.compile(r"(?<=\S) (?=\S)")
_CACHE_BYTES = 128 << 20
_ENTRY_BYTES = 200
# Units that the library gets at once: the results of a few hundred stay in the processor's cache.
_AT_ONCE = 200
# Kept runs of marks, and characters of such a run.
_MARKS = 10_000
_MARK_CHARS = 4
# The byte alphabet's letter for a space.
_SPACE = "\u0120"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, so its table of units serves many tasks."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_unit = _cuts_at_spaces(json.loads(Path(path).read_text()))
        self.words, self.marks = None, {}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.opens = np.zeros(max(self.library.get_vocab(with_added_tokens=True).values(), default=0) + 1, bool)
        self.opens[[i for x, i in vocabulary.items() if x[0] == _SPACE]] = True
        # Where tokens with a space further in are of spaces alone, units never grow together.
        spaces = set(_bytes_as_letters(" \t\n\x0b\x0c\r\x85\xa0"))
        self.strung = self.by_unit and all(x[0] == _SPACE and set(x) <= spaces for x in vocabulary if _SPACE in x[1:])
        if self.by_unit and not any(x.content.isalpha() for x in self.library.get_added_tokens_decoder().values()):
            # A unit of letters, with or without marks at its end, needs no split: it goes to a
            # tokenizer without one, in the byte alphabet.
            self.words = Tokenizer.from_file(path)
            self.words.no_truncation()
            self.words.no_padding()
            self.words.pre_tokenizer = None
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str | None]) -> Iterable[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none."""
        for begin, end in slices(texts):
            rows = [self.units(text or "") for text in texts[begin:end]]
            self._learn({unit for row in rows for unit in row})
            for row in rows:
                yield b"".join(map(self.ids.__getitem__, row))

    def count(self, units: list[str]) -> list[int]:
        """The number of ids of each unit; nothing is kept."""
        return [len(x) // 4 for i in range(0, len(units), _AT_ONCE) for x in self._found(units[i : i + _AT_ONCE])]

    def units(self, text: str) -> list[str]:
        """The text's units. One that has no space before it, at the begin of text or line, is marked by one."""
        if not text or not self.by_unit:
            return [" " + text] if text else []
        if _TWO_SPACES.search(text):
            row = _UNIT_END.split(text)
            row[0] = " " + row[0]
            return row
        row = []
        for line in text.split("\n"):
            begin = len(row) + 1
            row += [" \n", *line.split(" ")]
            row[begin] = " " + row[begin]
        return row[1:]

    def _learn(self, units: set[str]) -> None:
        if self.held > _CACHE_BYTES:
            self.ids, self.older, self.held = {}, self.ids, 0
        unknown = []
        for unit in units.difference(self.ids):
            if (ids := self.older.get(unit)) is None:
                unknown.append(unit)
            else:
                self.ids[unit] = ids
                self.held += len(unit) + len(ids) + _ENTRY_BYTES
        for i in range(0, len(unknown), _AT_ONCE):
            part = unknown[i : i + _AT_ONCE]
            found = self._found(part)
            self.ids.update(zip(part, found, strict=True))
            self.held += sum(map(len, part)) + sum(map(len, found)) + _ENTRY_BYTES * len(part)

    def _found(self, units: list[str]) -> list[bytes]:
        """The ids of each unit from the library."""
        out = [b""] * len(units)
        words, rest, alone = [], [], []  # (place, what the library gets, ids of the marks at the end)
        for i, unit in enumerate(units):
            first = unit[:1] == " "
            text = unit[1:] if first else unit
            core = text.rstrip(punctuation)
            if self.words and core.isalpha() and len(text) - len(core) <= _MARK_CHARS:
                letters = core if core.isascii() else _bytes_as_letters(core)
                (alone if first else words).append((i, letters if first else _SPACE + letters, self._mark(text[len(core) :]), self.words))
            elif first or not text or " " in text or text[0].isspace() or text[-1].isspace():
                alone.append((i, text if first else " " + text, b"", self.library))
            else:
                rest.append((i, " " + text, b"", self.library))
        for some in (words, rest):
            if some and not self._strung(some, out):
                alone += some
        for library in (self.words, self.library):
            some = [x for x in alone if x[3] is library]
            if some:
                for (i, _, mark, _), x in zip(some, library.encode_batch_fast([x[1] for x in some], add_special_tokens=False), strict=True):
                    out[i] = array("I", x.ids).tobytes() + mark
        return out

    def _strung(self, some: list[tuple], out: list[bytes]) -> bool:
        """Encode units that begin with a space as one text; false where the ids do not tell them apart."""
        if not self.strung:
            return False
        ids = np.array(some[0][3].encode_batch_fast(["".join([x[1] for x in some])], add_special_tokens=False)[0].ids, np.uint32)
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) != len(some) or begins[0]:
            return False
        raw, ends = ids.tobytes(), (4 * begins).tolist()
        for (i, _, mark, _), begin, end in zip(some, ends, [*ends[1:], len(raw)], strict=True):
            out[i] = raw[begin:end] + mark
        return True

    def _mark(self, mark: str) -> bytes:
        """The ids of a run of ASCII marks."""
        if (ids := self.marks.get(mark)) is None:
            if len(self.marks) > _MARKS:
                self.marks = {}
            ids = self.marks[mark] = array("I", self.library.encode(mark, add_special_tokens=False).ids).tobytes()
        return ids


def _byte_letters() -> dict[int, str]:
    """The byte alphabet: visible Latin-1 characters stand for themselves, other bytes for those from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def _bytes_as_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(_BYTE_LETTERS)


def _cuts_at_spaces(spec: dict) -> bool:
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"]) for x in spec.get("added_tokens", []))
    )
