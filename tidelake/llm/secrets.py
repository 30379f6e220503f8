"""Secrets in texts: rules, a trigram index that narrows them to candidates, spans and redaction."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost first, whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False
    base: bool = True

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three base kinds in their order, then public forms of further credentials.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}", base=False),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", base=False),
    # the whole key: up to its END line or, where that is missing, to the last line of base64 or of a key's headers
    Rule(
        "private_key",
        r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY((?: BLOCK)?)-----"
        r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY\2-----"
        r"""|(?:(?:\s|\\[rnt])*(?:(?:Proc-Type|DEK-Info|Key-Info|Version|Comment|Charset|Hash):[^\n]*|=[A-Za-z0-9+/]{4}|[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9+/]*={1,2}))*(?:(?:\s|\\[rnt])*[A-Za-z0-9+/]{1,15}(?=[^\S\n]*(?:\n|\Z)|["'\\]))?)""",
        base=False,
    ),
)

# A query is None (no trigram is mandatory), a trigram, ("and", parts) or ("or", parts).
_MOST_STRINGS = 32


def trigram_query(pattern: str):
    """What trigrams, in lower case, every match of ``pattern`` must have."""
    return _mandatory(list(_parser.parse(pattern)))


def _mandatory(nodes: list):
    """The query of a sequence: neighbouring parts with few possible strings are joined before they are cut."""
    parts, runs = [], {""}
    for node in nodes:
        strings = _strings(node)
        joined = {a + b for a in runs for b in strings} if strings is not None else None
        if joined is not None and len(joined) <= _MOST_STRINGS:
            runs = joined
            continue
        parts.append(_of_strings(runs))
        if strings is not None:
            runs = strings
        else:
            parts.append(_of_node(node))
            runs = {""}
    return _both("and", [*parts, _of_strings(runs)])


def _of_node(node):
    kind, value = node
    if kind is op.SUBPATTERN:
        return _mandatory(list(value[-1]))
    if kind is op.BRANCH:
        return _both("or", [_mandatory(list(x)) for x in value[1]])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
        return _mandatory(list(value[2]))
    return None


def _strings(node) -> set[str] | None:
    """All strings a part can match, in lower case; None where there are too many."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(x[0] is op.LITERAL for x in value) and len(value) <= _MOST_STRINGS:
        return {chr(x[1]).lower() for x in value}
    if kind is op.SUBPATTERN:
        return _sequence(list(value[-1]))
    if kind is op.BRANCH:
        each = [_sequence(list(x)) for x in value[1]]
        return set().union(*each) if None not in each and sum(map(len, each)) <= _MOST_STRINGS else None
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 3:
        once = _sequence(list(value[2]))
        if once is not None:
            out: set[str] = set()
            for n in range(value[0], value[1] + 1):
                some = {""}
                for _ in range(n):
                    some = {a + b for a in some for b in once}
                    if len(some) > _MOST_STRINGS:
                        return None
                out |= some
            return out if len(out) <= _MOST_STRINGS else None
    return None


def _sequence(nodes: list) -> set[str] | None:
    out = {""}
    for node in nodes:
        strings = _strings(node)
        if strings is None or len(out) * len(strings) > _MOST_STRINGS:
            return None
        out = {a + b for a in out for b in strings}
    return out


def _of_strings(strings: set[str]):
    return _both("or", [_both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _both(how: str, parts: list):
    """Without a query, a part of an "and" says nothing, and an "or" with such a part neither."""
    kept = [x for x in dict.fromkeys(parts) if x is not None]
    if not kept or how == "or" and len(kept) < len(dict.fromkeys(parts)):
        return None
    return kept[0] if len(kept) == 1 else (how, tuple(kept))


def trigrams(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def candidates(query, postings: dict[str, np.ndarray], rows: int) -> np.ndarray:
    """The rows whose postings satisfy the query; all rows without one."""
    if query is None:
        return np.arange(rows)
    if isinstance(query, str):
        return postings.get(query, np.zeros(0, np.int64))
    parts = sorted((candidates(x, postings, rows) for x in query[1]), key=len)
    out = parts[0]
    for more in parts[1:]:
        out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
    return out


def index(texts: list[str | None], wanted: list[str]) -> dict[str, np.ndarray]:
    """Postings: for each wanted trigram, the rows of ``texts`` that have it, A-Z lowered."""
    parts = [(text or "").encode().lower() for text in texts]
    ends = np.cumsum([len(x) + 1 for x in parts])
    whole = np.frombuffer(b"\n".join(parts), np.uint8)
    found: dict[str, np.ndarray] = {}
    numbers = np.zeros(1 << 24, np.uint8)
    for k, x in enumerate(wanted):
        numbers[int.from_bytes(x.encode(), "big")] = k + 1
    for begin in range(0, max(0, len(whole) - 2), 1 << 22):
        cut = whole[begin : begin + (1 << 22) + 2].astype(np.uint32)
        codes = cut[:-2] << 16 | cut[1:-1] << 8 | cut[2:]
        hit = numbers[codes]
        at = np.flatnonzero(hit)
        which, rows = hit[at], np.searchsorted(ends, at + begin, "right")
        for k in np.unique(which).tolist():
            new = np.unique(rows[which == k])
            found[wanted[k - 1]] = np.union1d(found[wanted[k - 1]], new) if wanted[k - 1] in found else new
    return found


class Scanner:
    """Finds the spans of all rules in many texts."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(k, rule, rule.compiled(), trigram_query(rule.pattern)) for k, rule in enumerate(rules)]
        # trigrams are matched as three bytes, so others are left to the full pattern
        usable = {x for *_, query in self.rules for x in trigrams(query)}
        assert len(usable) < 256 and all(len(x.encode()) == 3 for x in usable), "rules need fewer than 256 ASCII trigrams"
        self.wanted = sorted(usable)

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """(start, end, rule number) of each text, by start and then in the rules' order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = index(texts, self.wanted)
        for k, rule, pattern, query in self.rules:
            for row in candidates(query, postings, len(texts)).tolist():
                for m in pattern.finditer(texts[row] or ""):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[row].append((m.start(), k, m.end()))
        return [[(a, b, k) for a, k, b in sorted(x)] for x in out]


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``secrets``: kind, start, end (code points, end exclusive) and base of each span, in order.

    Rows are indexed in blocks: for every trigram that some rule's query names, the rows that
    have it. A rule's Boolean query intersects and unites these postings, and its pattern then
    runs over the candidates' whole texts; a rule without mandatory trigrams runs over all. One
    pass, no exchange. A null or empty text has no spans; null and repeated doc_ids are scanned
    row by row; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [x for i, j in slices(texts, 8 << 20) for x in scanner.spans(texts[i:j])]
            spans = [[{"kind": rules[k].kind, "start": a, "end": b, "base": rules[k].base} for a, b, k in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN)], ["doc_id", "secrets"])

    return map_batches(rows, run, "doc_id bigint, secrets array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs``, all columns kept, with every span of ``text`` replaced by ``[kind]``; overlapping spans as one."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        at = names.index("text")
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = [x for i, j in slices(texts, 8 << 20) for x in scanner.spans(texts[i:j])]
            if any(found):
                clean = pa.array([_redacted(t, x, rules) if x else t for t, x in zip(texts, found, strict=True)], pa.string())
                batch = batch.set_column(at, batch.schema.field(at), clean.cast(batch.schema.field(at).type))
            yield batch

    return map_batches(docs, run, docs.schema)


def _redacted(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    out, done = [], 0
    for start, end, k in spans:
        if start >= done:
            out += [text[done:start], f"[{rules[k].kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
