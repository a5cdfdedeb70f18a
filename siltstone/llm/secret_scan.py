"""Secret scans: all rules in one pass over the bytes of a text.

The rules, read from their end, are compiled to one minimal automaton that goes over the bytes from the last to the
first. Its state at a byte tells which rules have a match that begins right there. Bytes that lead back
to its start from every state cut a batch of texts into pieces that can be run side by side, one array
operation per step; no match reaches over such a byte, so nothing is lost at a cut. From the first of these places each
rule takes its longest match and goes on behind it, so no byte is tried in vain and the work grows with the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton, compile_rules, parse, reverse
from .common import portions, utf8


@dataclass(frozen=True)
class Rule:
    """``lead`` and then bytes of the class ``body``, as many as there are but ``least`` or it fails."""

    kind: str
    lead: str
    body: str
    least: int
    any_case: bool = False


#: The base rules, first, in the order in which their spans are listed. Fixed values.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 6, True),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
)
#: Published shapes of tokens that name their issuer.
MORE = (
    Rule("forge", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("maps", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("payment", "(sk|rk)_(live|test)_", "[A-Za-z0-9]", 20),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 16),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY", "-", 5),
)
PIECE = 512
FEW = 12  #: pieces left below which single steps are faster than array operations
PORTION = 1 << 22


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    common: Automaton  #: of all rules, read backwards
    whole: tuple[Automaton, ...]  #: lead and body of each rule
    leads: tuple[Automaton | None, ...]

    def starts(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a match of some rule begins, in ascending order, and the state of the common automaton there."""
        cuts = np.flatnonzero(self.common.resetting()[data])
        if len(cuts):
            cuts = cuts[np.append(True, cuts[1:] // PIECE != cuts[:-1] // PIECE)] + 1
        bounds = np.unique(np.concatenate([[0], cuts, [len(data)]]))
        last, length = bounds[1:] - 1, np.diff(bounds)
        by = np.argsort(-length, kind="stable")
        last, length = last[by], length[by]
        running = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0))  # pieces longer than each step
        classes = self.common.byte_class[data]
        table, width, accepting = self.common.table, self.common.classes, self.common.accepting
        state = np.zeros(len(last), np.int32)
        found, states = [], []
        done = 0
        for step, n in enumerate(running):
            if n <= FEW:
                break
            at = last[:n] - step
            now = table[state[:n] * width + classes[at]]
            state[:n] = now
            fires = np.flatnonzero(now >= accepting)
            if len(fires):
                found.append(at[fires])
                states.append(now[fires])
            done = step + 1
        steps, singly = self.common.steps, classes.tobytes()
        for piece in range(int(running[done]) if done < len(running) else 0):
            now, hits, at = int(state[piece]), [], int(last[piece]) - done
            for at in range(at, int(last[piece]) - int(length[piece]), -1):
                now = steps[now * width + singly[at]]
                if now >= accepting:
                    hits.append((at, now))
            if hits:
                found.append(np.array([h[0] for h in hits]))
                states.append(np.array([h[1] for h in hits]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, ends = np.concatenate(found), np.concatenate(states)
        order = np.argsort(places, kind="stable")
        return places[order], ends[order]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``start, rule, end`` of the leftmost longest matches of each rule, in bytes."""
        places, states = self.starts(np.frombuffer(data, np.uint8))
        found = []
        for number, (rule, whole, lead) in enumerate(zip(self.rules, self.whole, self.leads, strict=True)):
            firing = np.array([number in rules for rules in self.common.rules])
            mine = places[firing[states - self.common.accepting]] if len(states) else places
            if not len(mine):
                continue
            at = 0
            while (i := int(np.searchsorted(mine, at))) < len(mine):
                start = int(mine[i])
                at = whole.longest(data, start)
                if at - (lead.longest(data, start) if lead else start) >= rule.least:
                    found.append((start, number, at))
        return found


def scanner(rules: tuple[Rule, ...] = BASE + MORE) -> Scanner:
    # a match shorter than its rule wants fails, but with a lead it still covers what a later one might begin in
    fires = [reverse(parse(r.lead + r.body + ("" if r.lead else "{%d}" % r.least), r.any_case)) for r in rules]
    whole = [compile_rules([parse(r.lead + r.body + "+", r.any_case)], anywhere=False) for r in rules]
    leads = [compile_rules([parse(r.lead, r.any_case)], anywhere=False) if r.lead else None for r in rules]
    return Scanner(rules, compile_rules(fires, anywhere=True), tuple(whole), tuple(leads))


def _code_points(text: bytes) -> np.ndarray | None:
    """Code points before each byte, or None where these are as many as bytes."""
    if text.isascii():
        return None
    return np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def find_secrets(texts: list[bytes], scan: Scanner) -> list[list[tuple[int, int, int]]]:
    """``start, rule, end`` in code points for every text, sorted."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, last in portions([len(t) for t in texts], PORTION):
        edges = np.cumsum([0, *(len(t) + 1 for t in texts[first:last])])
        points: dict[int, np.ndarray | None] = {}
        for start, rule, end in scan.spans(b"\n".join(texts[first:last]) + b"\n"):
            i = int(np.searchsorted(edges, start, "right")) - 1
            if i not in points:
                points[i] = _code_points(texts[first + i])
            before = points[i]
            start, end = start - int(edges[i]), end - int(edges[i])
            out[first + i].append((start, rule, end) if before is None else (int(before[start]), rule, int(before[end])))
    return [sorted(found) for found in out]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``doc_id``, counts per base kind, ``base_sha256`` and ``spans`` for every row of ``docs``.

    Matches of one rule are leftmost and do not overlap; those of several rules may. A NULL text
    counts as an empty one and has no span. Repeated rows and rows with a NULL ``doc_id`` are scanned
    one by one; other columns are not read. ``rules`` begin with the base rules.
    """
    compiled = scanner(rules)
    names = [rule.kind for rule in rules]
    base = len(BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(found) -> str:
            return ",".join(f"{names[rule]}:{start}:{end}" for start, rule, end in found)

        for batch in batches:
            found = find_secrets([t or b"" for t in utf8(batch.column("text"))], compiled)
            counts = [pa.array([sum(rule == k for _, rule, _ in f) for f in found], pa.int64()) for k in range(base)]
            digests = [hashlib.sha256(listed([x for x in f if x[1] < base]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([listed(f) for f in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
