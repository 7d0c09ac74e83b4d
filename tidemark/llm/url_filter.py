"""URL filters: wildcard rules as one bit-parallel automaton.

All glob patterns are packed side by side into multiword Shift-And masks: a
pattern with m literal bytes takes m + 1 bits, bit 0 its start, bit i set when
its first i literals are matched. A wildcard after literal i lets bit i stay.
One step reads one byte of the canonical URL and moves all patterns at once;
numpy carries a batch of URLs through each step together.

Patterns run over the canonical URL (host, A-Z lowered, then path):

* ``*`` any bytes without ``/``; ``**`` any bytes; ``?`` one byte without ``/``;
  every other byte stands for itself.

A host rule ``(action, host, path)`` becomes two patterns (the host itself and
its subdomains); the longest fitting rule decides. Where none fits, the glob
lists decide: a fitting allow pattern, else a fitting block pattern, else the
default.

Defined results: a null URL or one without ``://`` has empty host and path; a
null page id is kept; repeated rows are each judged; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, text_or_empty

STEP_CELLS = 1 << 22   # state words held at once


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parse(pattern: str) -> tuple[list[int], list[int]]:
    """(literals, wildcards): literal bytes (-1: any byte but ``/``), and the
    wildcard in front of each literal and at the end (0 none, 1 ``*``, 2 ``**``)."""
    literals, wild, i, data = [], [0], 0, pattern.encode("utf-8")
    while i < len(data):
        if data[i:i + 2] == b"**":
            wild[-1], i = 2, i + 2
        elif data[i:i + 1] == b"*":
            wild[-1], i = max(wild[-1], 1), i + 1
        else:
            literals.append(-1 if data[i:i + 1] == b"?" else data[i])
            wild.append(0)
            i += 1
    return literals, wild


class GlobAutomaton:
    """Shift-And masks of all patterns, and their simulation over many strings."""

    def __init__(self, patterns: Sequence[str]):
        parsed = [parse(p) for p in patterns]
        starts = np.cumsum([0] + [len(lit) + 1 for lit, _ in parsed])
        self.words = max(1, -(-int(starts[-1]) // 64))
        n_bits = self.words * 64
        move, stay = np.zeros((256, n_bits), bool), np.zeros((256, n_bits), bool)
        first = np.zeros(n_bits, bool)
        inside = np.arange(256) != ord("/")
        for (literals, wild), at in zip(parsed, starts.tolist()):
            first[at] = True
            for i, c in enumerate(literals):
                move[inside if c < 0 else c, at + i + 1] = True
            for i, w in enumerate(wild):
                if w:
                    stay[inside if w == 1 else slice(None), at + i] = True
        self.final = np.array([s + len(lit) for (lit, _), s in zip(parsed, starts.tolist())], np.int64)
        self.move, self.stay, self.first = (self._pack(x) for x in (move, stay, first))

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view("<u8")

    def matches(self, strings: list[bytes]) -> np.ndarray:
        """Boolean (string, pattern): the pattern matches the whole string."""
        out = np.zeros((len(strings), len(self.final)), bool)
        order = sorted(range(len(strings)), key=lambda k: -len(strings[k]))
        step = max(1, STEP_CELLS // self.words)
        for a in range(0, len(order), step):
            rows = order[a:a + step]
            out[rows] = self._run([strings[k] for k in rows])
        return out

    def _run(self, strings: list[bytes]) -> np.ndarray:
        """``strings`` longest first; a string's state rests when its bytes are used up."""
        lengths = np.array([len(s) for s in strings])
        flat = np.frombuffer(b"".join(strings) + b"\0", np.uint8)
        at = np.cumsum(lengths) - lengths
        state = np.tile(self.first, (len(strings), 1))
        active = len(strings)
        for k in range(int(lengths[0]) if active else 0):
            while lengths[active - 1] <= k:
                active -= 1
            byte, now = flat[at[:active] + k], state[:active]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (shifted & self.move[byte]) | (now & self.stay[byte])
        return (state[:, self.final >> 6] >> (self.final & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def literal(text: str) -> str:
    if "*" in text or "?" in text:
        raise ValueError(f"a host rule is literal text: {text!r}")
    return text


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]], allow: Sequence[str] = (), block: Sequence[str] = (),
                 default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) for each row of ``pages`` (page_id, url).

    ``rules``: (allow or block, host, path prefix). ``pattern`` is the glob that
    decided where no rule fits, else null.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    patterns = [p for _, host, path in ranked for p in (f"{literal(host)}{literal(path)}**", f"*.{host}{path}**")]
    globs = [*((p, "allow") for p in allow), *((p, "block") for p in block)]
    automaton = GlobAutomaton([*patterns, *(p for p, _ in globs)])
    n_rules = len(ranked)
    rule_names = np.array([h + p for _, h, p in ranked] + [None], object)
    rule_verdicts = np.array([a for a, _, _ in ranked] + [None], object)
    glob_names = np.array([p for p, _ in globs] + [None], object)
    glob_verdicts = np.array([v for _, v in globs] + [default], object)

    def first(hits: np.ndarray) -> np.ndarray:
        """Index of the first hit of each row, or the number of columns."""
        return np.argmax(np.append(hits, np.ones((len(hits), 1), bool), axis=1), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = [(h + p).encode("utf-8", "surrogatepass") for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist())]
            hits = automaton.matches(strings)
            rule = first(hits[:, :2 * n_rules].reshape(len(hits), n_rules, 2).any(axis=2))
            glob = first(hits[:, 2 * n_rules:])
            ruled = rule < n_rules
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["host"], batch["path"], pa.array(rule_names[rule], pa.string()),
                 pa.array(np.where(ruled, rule_verdicts[rule], glob_verdicts[glob]), pa.string()),
                 pa.array(np.where(ruled, None, glob_names[glob]), pa.string())],
                ["page_id", "host", "path", "rule", "verdict", "pattern"])

    url = text_or_empty("url")
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
            .mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, pattern string"))
