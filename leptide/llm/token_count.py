"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is merged once: those that end as a single
token are proved to count one wherever they are a whole pre-token. At run time
only the other pre-tokens are merged.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def byte_alphabet() -> dict[int, str]:
    """Printable stand-in of every byte, as byte-level vocabularies write them."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


class Vocabulary:
    """Merges, special strings and vocabulary of a tokenizer file with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merges = {p: i for i, p in enumerate(pairs)}
        self.strings = list(spec["model"]["vocab"])
        self.special = [t["content"] for t in spec["added_tokens"]]


NEVER = 1 << 60


def merged_length(piece: str, merges: dict[tuple[str, str], int]) -> int:
    """Number of tokens that merging leaves of a pre-token written in the byte alphabet."""
    if len(piece) > 256:
        return _merged_length_heap(piece, merges)
    parts = list(piece)
    near = [merges.get(p, NEVER) for p in zip(parts, parts[1:])]
    while near:
        best = min(near)
        if best == NEVER:
            break
        i = near.index(best)
        joined = parts[i] + parts[i + 1]
        parts[i : i + 2] = [joined]
        del near[i]
        if i:
            near[i - 1] = merges.get((parts[i - 1], joined), NEVER)
        if i < len(near):
            near[i] = merges.get((joined, parts[i + 1]), NEVER)
    return len(parts)


def _merged_length_heap(piece: str, merges: dict[tuple[str, str], int]) -> int:
    """The same in O(n log n), for long pre-tokens: candidates in a heap, parts in a linked list."""
    parts: list[str | None] = list(piece)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(merges[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
    heapq.heapify(heap)
    left = len(parts)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= len(parts) or parts[j] != b:
            continue  # one of the two has merged with another since
        parts[i], parts[j], left = a + b, None, left - 1
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(parts) and (p := (parts[k], parts[after[k]])) in merges:
                heapq.heappush(heap, (merges[p], k, *p))
    return left


def whole_tokens(vocabulary: Vocabulary) -> set[str]:
    """Vocabulary strings, as plain text, that are proved to encode alone as one token."""
    back = {c: b for b, c in byte_alphabet().items()}
    out = set()
    for s in vocabulary.strings:
        if all(c in back for c in s) and merged_length(s, vocabulary.merges) == 1:
            try:
                out.add(bytes(back[c] for c in s).decode())
            except UnicodeDecodeError:
                pass  # not a text on its own, so never a whole pre-token
    return out


class Counter:
    def __init__(self, whole: set[str], merges: dict[tuple[str, str], int], special: list[str], pattern: str, memo: int = 1_000_000):
        self.merges, self.special, self.memo = merges, set(special), memo
        self.split = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        self.alphabet = byte_alphabet()
        self.whole = dict.fromkeys(whole, 1)
        self._known = dict(self.whole)

    def count(self, text: str) -> int:
        if self.cut and any(s in text for s in self.special):
            return sum(1 if part in self.special else self.plain(part) for part in self.cut(text))
        return self.plain(text)

    def plain(self, text: str) -> int:
        pieces, known = self.split(text), self._known
        try:
            return sum([known[p] for p in pieces])
        except KeyError:
            pass
        total = 0
        for p in pieces:
            n = known.get(p)
            if n is None:
                n = merged_length("".join(map(self.alphabet.__getitem__, p.encode())), self.merges)
                if len(p) <= 64:
                    if len(known) >= len(self.whole) + self.memo:
                        known.clear()
                        known.update(self.whole)
                    known[p] = n
            total += n
        return total


def count_tokens(docs: DataFrame, path: str, pattern: str, *, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, by a map over the rows.

    Null texts count as empty (0, 0, false); special strings inside a text
    count one token. Repeated rows and null ids stay; an empty table gives no
    rows. Other columns are ignored. The file is read on the driver and sent
    once to each executor: its size is that of the vocabulary.
    """
    vocabulary = Vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((whole_tokens(vocabulary), vocabulary.merges, vocabulary.special, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            n = pa.array([counter.count(t.as_py() or "") for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": n})

    kind = dict(docs.dtypes)["doc_id"]
    counted = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
