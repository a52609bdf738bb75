"""Byte-level BPE by prefix dynamic programming.

Of all tokenisations of a byte string, BPE yields one, and its prefixes are
BPE tokenisations too. So each prefix has one valid last token: the token that
ends there, encodes as itself, and may stand after the last token of what
precedes it. Storing that token for each prefix gives the encoding by walking
back, appends by going on from the last prefix, and re-encoding after an edit
by keeping the prefixes before it.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64, space, rank); ranks run from 0 without gaps."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [found[i] for i in range(len(found))]


NEVER = 1 << 60
#: Bytes of a piece's head whose prefixes are kept for other pieces.
BEGUN = 6


def merge(piece: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Merge the lowest-ranked adjacent pair, leftmost first, until none is left or `until` parts are."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    near = [ranks.get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
    while len(parts) > until:
        best = min(near)
        if best == NEVER:
            break
        i = near.index(best)
        joined = parts[i] + parts[i + 1]
        parts[i : i + 2] = [joined]
        del near[i]
        if i:
            near[i - 1] = ranks.get(parts[i - 1] + joined, NEVER)
        if i < len(near):
            near[i] = ranks.get(joined + parts[i + 1], NEVER)
    return parts


class PrefixEncoder:
    """Encoder for one rank table; `memo` bounds each of its caches."""

    def __init__(self, tokens: list[bytes], memo: int = 1_000_000):
        self.tokens, self.memo = tokens, memo
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.longest = max(map(len, tokens), default=1)
        self._spines: dict[int, tuple | None] = {}
        self._pairs: dict[int, bool] = {}
        self._begun: dict[bytes, list[int]] = {}

    def spines(self, token: int) -> tuple | None:
        """Right and left edge parts of a token while it is being merged: (bytes, born, gone) each.

        None if the token's own text doesn't encode as the token.
        """
        got = self._spines.get(token, False)
        if got is False:
            text = self.tokens[token]
            if len(text) == 1:
                got = ([(text, -1, NEVER)], [(text, -1, NEVER)])
            elif merge(text, self.ranks) != [text]:
                got = None
            else:
                a, b = merge(text, self.ranks, 2)
                edges = []
                for side, part in ((0, b), (1, a)):
                    inner = self.spines(self.ranks[part])
                    (x, born, _), *rest = inner[side] if inner else [(part, -1, NEVER)]
                    edges.append([(text, token, NEVER), (x, born, token), *rest])
                got = tuple(edges)
            self._spines[token] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        """Does the text of a and b encode as just these two, both being encodings of their own texts?

        It doesn't if parts at the border, alive at the same time, merge
        before each of them merges with its own neighbour.
        """
        key = a << 32 | b
        got = self._pairs.get(key)
        if got is None:
            got, rank = True, self.ranks.get
            left = self.spines(b)[1]
            for x, x_born, x_gone in self.spines(a)[0]:
                for y, y_born, y_gone in left:
                    r = rank(x + y)
                    if r is not None and r < x_gone and r <= y_gone and x_born < y_gone and y_born < x_gone:
                        got = False
                        break
                if not got:
                    break
            if len(self._pairs) >= self.memo:
                self._pairs.clear()
            self._pairs[key] = got
        return got

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Complete `last` (valid last tokens of the first len(last) prefixes) for the whole piece."""
        rank, longest, pairs, spines = self.ranks.get, self.longest, self._pairs.get, self.spines
        for end in range(len(last) + 1, len(piece) + 1):
            found = -1
            for start in range(end - longest if end > longest else 0, end):
                token = rank(piece[start:end])
                if token is None:
                    continue
                if start == 0:
                    ok = spines(token) is not None
                else:
                    before = last[start - 1]
                    if before < 0:
                        continue
                    ok = pairs(before << 32 | token)
                    if ok is None:
                        ok = spines(token) is not None and self.may_follow(before, token)
                if ok:
                    found = token
                    break
            last.append(found)
        return last

    def walk(self, piece: bytes, last: list[int]) -> list[int]:
        """Token ids of the piece, back from the last token of its longest prefix."""
        out, end = [], len(piece)
        while end:
            token = last[end - 1]
            if token < 0:  # no valid last token, as an irregular rank table may cause
                return [self.ranks[p] for p in merge(piece, self.ranks)]
            out.append(token)
            end -= len(self.tokens[token])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None and self.spines(whole) is not None:
            return [whole]
        if len(piece) <= BEGUN:
            return self.walk(piece, self.extend(piece, []))
        head = piece[:BEGUN]  # many pieces begin alike: append to what is known of the head
        last = self._begun.get(head)
        if last is None:
            if len(self._begun) >= self.memo:
                self._begun.clear()
            last = self._begun[head] = self.extend(head, [])
        return self.walk(piece, self.extend(piece, last.copy()))

    def edit(self, piece: bytes, last: list[int], at: int, removed: int, added: bytes) -> tuple[bytes, list[int]]:
        """Replace piece[at:at + removed] by `added`; prefixes before the edit are kept as they are."""
        new = piece[:at] + added + piece[at + removed :]
        return new, self.extend(new, last[:at])


class TextEncoder:
    """Whole texts: pieces by the pattern, each piece through the prefix encoder, with a bounded cache."""

    def __init__(self, tokens: list[bytes], pattern: str, memo: int = 1_000_000):
        self.encoder, self.memo = PrefixEncoder(tokens, memo), memo
        self.split = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Token ids as unsigned 32-bit integers (little-endian, as on every platform Spark runs on)."""
        pieces = self.split(text)
        known = self._known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        out = []
        for p in pieces:
            got = known.get(p)
            if got is None:
                got = array("I", self.encoder.encode(p.encode())).tobytes()
                if len(p) <= 64:
                    if len(known) >= self.memo:
                        known.clear()
                    known[p] = got
            out.append(got)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        tokens = self.encoder.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")])


def encode_documents(docs: DataFrame, tokens: list[bytes], pattern: str, *, keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, [ids binary,] ids_sha256, decoded_sha256) for every row, by a map over the rows.

    Null texts encode as empty; repeated rows, null ids and very long texts
    are rows like others; an empty table gives no rows. Other columns are
    ignored. Decoding goes from the ids alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tokens, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TextEncoder(*shared.value)
        for batch in batches:
            n, ids, digest, back = [], [], [], []
            for text in batch.column("text"):
                got = coder.ids(text.as_py() or "")
                n.append(len(got) // 4)
                digest.append(hashlib.sha256(got).hexdigest())
                back.append(hashlib.sha256(coder.decode(got)).hexdigest())
                if keep_ids:
                    ids.append(got)
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64())}
            if keep_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns | {"ids_sha256": pa.array(digest, pa.string()), "decoded_sha256": pa.array(back, pa.string())})

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long{', ids binary' if keep_ids else ''}, ids_sha256 string, decoded_sha256 string")
