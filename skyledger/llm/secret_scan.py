"""Secret scans with one combined deterministic automaton.

All rules are mirrored, joined into one nondeterministic automaton, made deterministic by
subset construction and minimised. A single pass over the bytes from right to left marks each
place where a match of some rule begins; a short forward run from there finds its end. Base
spans are leftmost and do not overlap within a kind, and a match that is too short is dropped
but still uses up its characters. The method adds to them: assignments that begin inside such
a dropped match, and private-key headers.

Offsets count code points, ends are exclusive. A null or empty text has no spans, a long one
is scanned whole, equal rows give equal results and an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import automata, texts
from skyledger.llm.staging import inputs


@dataclass(frozen=True)
class Rule:
    """`lead` then `value`; a match counts from `least` characters of its value on."""

    kind: str
    lead: str
    value: str
    least: int = 0
    any_case: bool = False
    base: bool = True


RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 6, True),
    Rule("access", "", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "", "[0-9a-f]{24,}"),
    Rule("private_key", "", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", base=False),
)


@cache
def _machines(rules: tuple[Rule, ...]) -> tuple:
    trees = [automata.parse(r.lead + r.value, r.any_case) for r in rules]
    whole = automata.compile_rules([automata.backwards(t) for t in trees], anywhere=True)
    ends = [automata.compile_rules([t], anywhere=False) for t in trees]
    leads = [automata.compile_rules([automata.parse(r.lead, r.any_case)], anywhere=False) if r.lead else None for r in rules]
    return whole, ends, leads


def _resolved(data: bytes, stop: int, starts: list[int], rule: Rule, end_of, lead_of) -> Iterator[tuple[int, int, bool]]:
    """Spans of one rule in one text from its possible starts; the flag tells base spans."""
    used = kept = added = -1
    for start in starts:
        inside = start < used
        if start < kept or (inside and start < added):
            continue
        end = end_of.longest(data, start, stop)
        begin = lead_of.longest(data, start, stop) if lead_of else start
        enough = end - begin >= rule.least
        if inside:
            if enough:
                added = end
                yield start, end, False
            continue
        used = end
        if enough:
            kept = end
            yield start, end, rule.base


def find(column: pa.Array, rules: tuple[Rule, ...] = RULES) -> dict[int, list[tuple[int, int, int, bool]]]:
    """For texts with spans: (start, rule number, end, base) sorted, in code points."""
    whole, ends, leads = _machines(rules)
    parts = texts.text_bytes(column)
    joined = b"\n".join(parts)
    data = np.frombuffer(joined, np.uint8)
    places, accepted = automata.scan_back(whole, data)
    out: dict[int, list[tuple[int, int, int, bool]]] = {}
    if not len(places):
        return out
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    bounds = np.cumsum(sizes + 1) - sizes - 1
    inner = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80)])
    for k, starts in automata.by_rule(places, accepted, len(rules)).items():
        owner = np.searchsorted(bounds, starts, side="right") - 1
        for text in np.unique(owner).tolist():
            base = int(bounds[text])
            mine = [s for s, o in zip(starts, owner.tolist(), strict=True) if o == text] if len(starts) < 64 else np.asarray(starts)[owner == text].tolist()
            shift = base + int(inner[base]) * -1
            for a, b, first in _resolved(joined, base + int(sizes[text]), mine, rules[k], ends[k], leads[k]):
                out.setdefault(text, []).append((a - int(inner[a]) - shift, k, b - int(inner[b]) - shift, first))
    for spans in out.values():
        spans.sort()
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of `docs`: its id and `spans`, an array of (kind, start, end, base)."""
    rows = inputs(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text"):
            found = find(batch.column("text"), rules)
            spans = [[{"kind": rules[k].kind, "start": a, "end": b, "base": f} for a, k, b, f in found.get(i, ())] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(span))], ["id", "spans"])

    return rows.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>").withColumnRenamed("id", id_col)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of base spans per kind, a digest of them, and all spans as text."""
    rows = inputs(docs, doc_id="doc_id", text="text")
    base = [r.kind for r in rules if r.base]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def line(spans: list[tuple[int, int, int, bool]]) -> str:
            return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b, _ in spans)

        for batch in texts.chunks(batches, "text"):
            found = find(batch.column("text"), rules)
            each = [found.get(i, []) for i in range(batch.num_rows)]
            firsts = [[s for s in spans if s[3]] for spans in each]
            counts = [pa.array([sum(rules[s[1]].kind == kind for s in spans) for spans in firsts], pa.int64()) for kind in base]
            digests = pa.array([hashlib.sha256(line(spans).encode()).hexdigest() for spans in firsts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, digests, pa.array([line(spans) for spans in each], pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in base), "base_sha256", "spans"],
            )

    names = ", ".join(f"n_{kind} bigint" for kind in base)
    return rows.mapInArrow(run, f"doc_id bigint, {names}, base_sha256 string, spans string")


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with each span replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first. A null text stays null. Where there is a
    `length_col`, it gets the new number of code points.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, text_col):
            found = find(batch.column(text_col))
            if found:
                column = batch.column(text_col).to_pylist()
                for i, spans in found.items():
                    column[i] = _masked(column[i], spans)
                batch = replaced(batch, text_col, column, length_col, list(found))
            yield batch

    return docs.mapInArrow(run, schema)


def _masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, at = [], 0
    for start, k, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"<{RULES[k].kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def replaced(batch: pa.RecordBatch, text_col: str, column: list[str | None], length_col: str | None, changed: list[int]) -> pa.RecordBatch:
    """The batch with new texts, and new lengths for those that changed."""
    names = batch.schema.names
    arrays = dict(zip(names, batch.columns, strict=True))
    arrays[text_col] = pa.array(column, batch.schema.field(text_col).type)
    if length_col in arrays and pa.types.is_integer(arrays[length_col].type):
        lengths = arrays[length_col].to_pylist()
        for i in changed:
            lengths[i] = len(column[i])
        arrays[length_col] = pa.array(lengths, batch.schema.field(length_col).type)
    return pa.RecordBatch.from_arrays([arrays[n] for n in names], schema=batch.schema)
