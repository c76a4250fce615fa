"""Secret scans over a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query over
the trigrams that any match must hold: concatenation and repetition give AND,
alternation gives OR.  Documents are indexed segment by segment (one Arrow
batch): a posting list per trigram that some rule asks for, over case-folded
UTF-8 bytes.  A rule's query intersects and unites posting lists; only the
candidates are verified with the regular expression itself.  A rule whose query
is empty, since no trigram is mandatory, scans every document.  A segment's index
is bounded by the batch, no list crosses a shuffle, and a lost task is rerun alone.

Defined results: null and empty texts hold no secrets.  Offsets are code points,
ends exclusive.  Matches of one kind are leftmost and do not overlap; kinds may.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import lean, text_or_empty

#: Characters of a class, and strings of a part, above which a part counts as any text.
MOST_CHARS, MOST_STRINGS = 16, 64
#: Bytes of text indexed at a time.
SEGMENT_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters; ``start`` is the group that its span begins with.

    Patterns should take time in proportion to the text: a run that failed once
    must not be tried again from each of its characters.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    fold: bool = False
    base: bool = False
    start: int = 0


RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, False, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, False, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("github", r"(?:gh[pousr]_|github_pat_)[A-Za-z0-9_]+", 0, 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    # Of a run only its first eyJ is tried: what follows the run is the same for all of them.
    Rule("jwt", r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))(eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)", 1, 30, start=1),
    # Names of schemes are short; a longer run counts from its last 32 characters.
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,31}+://[^\s:/@]++:[^\s:/@]++@", 0, 10, True),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
)


# -- Boolean trigram queries ------------------------------------------------
#: A query is ("all",) for no restriction, ("tri", bytes), ("and", ...) or ("or", ...).
ALL = ("all",)


def _both(*qs: tuple) -> tuple:
    parts = tuple(dict.fromkeys(q for q in qs if q != ALL))
    return ALL if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(*qs: tuple) -> tuple:
    parts = tuple(dict.fromkeys(qs))
    return ALL if ALL in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _literal(strings: frozenset[bytes]) -> tuple:
    """The query of a part that is one of these strings."""
    return _either(*(_both(*(("tri", s[i : i + 3]) for i in range(len(s) - 2))) for s in sorted(strings)))


@dataclass
class _Part:
    """What is known of the text that a part of a pattern matches: every string, or its trigram query and edges."""

    exact: frozenset[bytes] | None
    query: tuple = ALL
    prefix: frozenset[bytes] = field(default_factory=lambda: frozenset([b""]))
    suffix: frozenset[bytes] = field(default_factory=lambda: frozenset([b""]))

    def settled(self) -> _Part:
        """The same without the exact strings."""
        if self.exact is None:
            return self
        return _Part(None, _literal(self.exact), frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact))


_ANY = _Part(None)
_EMPTY = _Part(frozenset([b""]))


def _joined(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return _Part(frozenset(x + y for x in a.exact for y in b.exact))
    over = None
    if a.exact is not None:  # strings that end here meet what begins there
        over = (a.exact, b.prefix if b.exact is None else frozenset(s[:2] for s in b.exact))
    elif b.exact is not None:
        over = (a.suffix, b.exact)
    else:
        over = (a.suffix, b.prefix)
    edge = frozenset(x + y for x in over[0] for y in over[1]) if len(over[0]) * len(over[1]) <= MOST_STRINGS else frozenset([b""])
    x, y = a.settled(), b.settled()
    prefix = x.prefix if a.exact is None or len(edge) > MOST_CHARS else frozenset(s[:2] for s in edge)
    suffix = y.suffix if b.exact is None or len(edge) > MOST_CHARS else frozenset(s[-2:] for s in edge)
    return _Part(None, _both(x.query, y.query, _literal(edge)), prefix, suffix)


def _chars(items: list) -> frozenset[bytes] | None:
    """The strings of a character class, folded; None if too many or negated."""
    out = set()
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            out.add(chr(arg).lower().encode())
        elif name == "RANGE" and arg[1] - arg[0] < 2 * MOST_CHARS:
            out |= {chr(c).lower().encode() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return frozenset(out) if len(out) <= MOST_CHARS else None


def _parsed(seq) -> _Part:
    part = _EMPTY
    for op, arg in seq:
        name = str(op)
        if name == "LITERAL":
            new = _Part(frozenset([chr(arg).lower().encode()]))
        elif name == "IN":
            found = _chars(arg)
            new = _ANY if found is None else _Part(found)
        elif name == "SUBPATTERN":
            new = _parsed(arg[-1])
        elif name == "BRANCH":
            subs = [_parsed(s) for s in arg[1]]
            if all(s.exact is not None for s in subs) and sum(len(s.exact) for s in subs) <= MOST_STRINGS:
                new = _Part(frozenset().union(*(s.exact for s in subs)))
            else:
                subs = [s.settled() for s in subs]
                new = _Part(None, _either(*(s.query for s in subs)), frozenset().union(*(s.prefix for s in subs)), frozenset().union(*(s.suffix for s in subs)))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, sub = arg
            inner = _parsed(sub)
            if least == 0:
                new = _Part(inner.exact | {b""}) if most == 1 and inner.exact is not None else _ANY
            else:
                new = inner if most == 1 else _joined(inner, _ANY) if least == 1 else _joined(_joined(inner, inner), _ANY)
        elif name == "AT":
            continue
        else:
            new = _ANY
        part = _joined(part, new)
    return part


def trigram_query(pattern: str) -> tuple:
    """The Boolean query of trigrams, as lower-case bytes, that every match of ``pattern`` satisfies."""
    return _parsed(re._parser.parse(pattern)).settled().query


def _trigrams(query: tuple) -> set[bytes]:
    return {query[1]} if query[0] == "tri" else set() if query == ALL else set().union(*map(_trigrams, query[1:]))


_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Index:
    """Posting lists of the wanted trigrams over a segment of texts."""

    def __init__(self, texts: list[bytes], wanted: list[bytes], table: np.ndarray):
        joined = b"\n\n".join(texts).translate(_FOLD)  # no wanted trigram holds two line ends
        b = np.frombuffer(joined, np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])])[:-1]
        self.postings = {w: np.empty(0, np.int64) for w in wanted}
        self.n = len(texts)
        if len(b) < 3:
            return
        code = b[:-2].astype(np.uint32)
        code <<= 8
        code |= b[1:-1]
        code <<= 8
        code |= b[2:]
        term = table[code]
        at = np.flatnonzero(term)
        pairs = np.unique(term[at].astype(np.int64) * self.n + (np.searchsorted(starts, at, "right") - 1))
        for i, w in enumerate(wanted, 1):
            lo, hi = np.searchsorted(pairs, (i * self.n, (i + 1) * self.n))
            self.postings[w] = pairs[lo:hi] - i * self.n

    def candidates(self, query: tuple) -> np.ndarray:
        """Texts that satisfy a query, rarest list first."""
        if query == ALL:
            return np.arange(self.n)
        if query[0] == "tri":
            return self.postings[query[1]]
        lists = sorted((self.candidates(q) for q in query[1:]), key=len)
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


class Scanner:
    """Compiled rules."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, self._compiled(r), trigram_query(r.pattern)) for r in rules]
        self.wanted = sorted(set().union(*(_trigrams(q) for _, _, q in self.rules)))
        self.table = np.zeros(1 << 24, np.uint16)
        for i, w in enumerate(self.wanted, 1):
            self.table[int.from_bytes(w, "big")] = i

    @staticmethod
    def _compiled(r: Rule) -> re.Pattern:
        # A bare class repeated matches whole runs, so runs that are too short can be passed over while searching.
        run = re.fullmatch(r"(\[[^\]]+\])\+", r.pattern)
        if run and r.group == 0:
            return re.compile(f"{run[1]}{{{r.least},}}", re.ASCII)
        return re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.fold else 0))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Of each text the spans (start, rule number, end), by start and then rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        index = Index([t.encode("utf-8", "surrogatepass") for t in texts], self.wanted, self.table)
        for k, (rule, pattern, query) in enumerate(self.rules):
            for i in index.candidates(query).tolist():
                for m in pattern.finditer(texts[i]):
                    start, end = m.span(rule.group)
                    if end - start >= rule.least:
                        out[i].append((m.start(rule.start), k, m.end()))
        for spans in out:
            spans.sort()
        return out


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _segments(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SEGMENT_BYTES; one long text makes a segment alone."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SEGMENT_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found``, its spans by start and then rule.

    ``found array<struct<kind string, start_at int, end_at int, base boolean>>``.
    """
    kind = docs.select(id_col).dtypes[0][1]
    item = pa.struct([("kind", pa.string()), ("start_at", pa.int32()), ("end_at", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(rules)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = []
            for lo, hi in _segments(texts):
                for spans in own.scan(texts[lo:hi]):
                    rows.append([{"kind": rules[k].kind, "start_at": s, "end_at": e, "base": rules[k].base} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(item))], ["doc_id", "found"])

    schema = f"doc_id {kind}, found array<struct<kind: string, start_at: int, end_at: int, base: boolean>>"
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(lean(run), schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mask``; overlapping spans become one. Null stays null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(rules)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in _segments([t or "" for t in texts]):
                for i, spans in enumerate(own.scan([t or "" for t in texts[lo:hi]]), lo):
                    if spans:
                        out, done, text = [], 0, texts[i]
                        for start, _, end in spans:
                            if start >= done:
                                out += [text[done:start], mask]
                            done = max(done, end)
                        texts[i] = "".join(out) + text[done:]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if j == at else c for j, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(lean(run), docs.schema)

