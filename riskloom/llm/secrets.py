"""Secrets in text: three fixed formats, and random strings shown up by a token-efficiency test.

A byte-pair vocabulary spends few tokens on what people write and many on random characters. So a string of key
characters, be they letters only, with few characters per token is taken for a secret of kind `random`, unless it is a
known digest or identifier (see `known`) or touches a span of a fixed format. In a readable run the parts between
separators are tested, alone and joined (see `Scanner.stretches`). Candidates and hexadecimal runs are found on the byte
arrays; only texts with a keyword meet the other two patterns.

Defined cases: a null or empty text has no spans; repeated rows and null ids are reported row by row; spans count code
points, end exclusive; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import DOCUMENT_COLUMNS, texts
from riskloom.llm.wordarrays import slices, utf8

# The formats every scan must report, in this order of kinds.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

# Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512, and abbreviated commit ids.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
IDENTIFIERS = [
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"[0-9T:Z+/_=-]+"),  # numbers, dates and times
    re.compile(r"(\W|_)*(\w)\2*(\W|_)*"),  # rules made of one character
]
# Words and numbers between separators: here the words alone decide, as numbers and separators take many tokens.
NAMES = re.compile(r"([a-z]+|[A-Z]+|[A-Z][a-z]+|[0-9]+)([_/+=-]+([a-z]+|[A-Z]+|[A-Z][a-z]+|[0-9]+))*[_/+=-]*")
PART = re.compile("[A-Za-z0-9]+")


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_DIGITS, _CAPITALS, _SMALL = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HEX = _table(_DIGITS + "abcdef")
_KEY = _table(_DIGITS + _CAPITALS + _SMALL + "+/_=-")


def runs(member: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of member bytes of `least` or more that lie in one text: their first bytes and ends."""
    edge = np.zeros(len(member) + 1, bool)
    edge[at] = True
    padded = np.concatenate([[False], member, [False]])
    begins = member & (~padded[:-2] | edge[:-1])
    ends = member & (~padded[2:] | edge[1:])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - start >= least
    return start[long], end[long]


def known(text: str) -> bool:
    """A digest or an identifier, which may look random and is none of our business."""
    if len(text) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        return True
    return text.lower() in _SMALL or any(p.fullmatch(text) for p in IDENTIFIERS)


class Scanner:
    """Finds the spans of a batch of texts. `vocabulary` is a tiktoken rank file."""

    def __init__(self, vocabulary: str, shortest: int = 20, chars_per_token: float = 2.0):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.shortest, self.chars_per_token = shortest, chars_per_token

    def random(self, text: str) -> bool:
        text = text.strip("=/_-+")
        if len(text) < self.shortest or known(text):
            return False
        parts = re.findall("[A-Za-z]{3,}", text) if NAMES.fullmatch(text) else [text]
        size = sum(map(len, parts))
        return self.shortest <= size < self.chars_per_token * sum(len(self.encoding.encode_ordinary(p)) for p in parts)

    def _excess(self, text: str) -> float:
        """How much shorter a string is than a readable one of its tokens; below zero it is readable."""
        return self.chars_per_token * len(self.encoding.encode_ordinary(text)) - len(text)

    def _readable(self, part: str) -> bool:
        return len(part) > 3 and self._excess(part) <= 0  # fewer characters tell nothing

    def stretches(self, text: str) -> list[tuple[int, int]]:
        """Where random strings lie in a run of key characters: the whole of it, or stretches of neighbouring parts.

        Readable parts lift the mean of the whole run, so the parts between separators are tested too, alone and joined to
        their neighbours. Of two long enough pieces of a random stretch one is random, so a stretch need not go on when it
        has twice the shortest length without its last part. Stretches that overlap become one, lose readable parts at
        their ends and take in neighbours that look random (a readable piece of a few characters does not end that).
        """
        if known(text.strip("=/_-+")):
            return []
        if self.random(text):
            return [(0, len(text))]
        parts = [m.span() for m in PART.finditer(text)]
        inside = {at for m in IDENTIFIERS[0].finditer(text) for at in range(*m.span())}
        seen = {piece: known(piece) and not piece.isdigit() for piece in {text[a:b] for a, b in parts}}
        barred = [start in inside or seen[text[start:end]] for start, end in parts]
        # Tokens end where parts end, so sums over parts tell which stretches need the whole test.
        memo: dict[str, tuple[int, bool]] = {}
        for piece in {text[a:b] for a, b in parts}:
            memo[piece] = len(self.encoding.encode_ordinary(piece)), bool(NAMES.fullmatch(piece))
        told = [memo[text[a:b]] for a, b in parts]
        groups: list[list[int]] = []  # first and last part
        for i, (start, _) in enumerate(parts):
            tokens, letters, letter_tokens, names = 0, 0, 0, True
            for k in range(i, len(parts)):
                if barred[k] or (k > i and parts[k - 1][1] - start >= 2 * self.shortest):
                    break
                a, end = parts[k]
                tokens += told[k][0] + (a - parts[k - 1][1] if k > i else 0)  # at most a token for a separator
                names = names and told[k][1]
                if end - a > 2 and text[a].isalpha():
                    letters, letter_tokens = letters + end - a, letter_tokens + told[k][0]
                length, cost = (letters, letter_tokens) if names else (end - start, tokens)
                if self.shortest <= length < self.chars_per_token * cost and self.random(text[start:end]):
                    if groups and i <= groups[-1][1]:
                        groups[-1][1] = max(k, groups[-1][1])
                    else:
                        groups.append([i, k])
        out: list[tuple[int, int]] = []
        for i, k in groups:
            while i < k and self._readable(text[slice(*parts[i])]) and self.random(text[parts[i + 1][0] : parts[k][1]]):
                i += 1
            while i < k and self._readable(text[slice(*parts[k])]) and self.random(text[parts[i][0] : parts[k - 1][1]]):
                k -= 1
            first, last = (self._reach(text, parts, barred, at, step) for at, step in ((i, -1), (k, 1)))
            start, end = parts[first][0], parts[last][1]
            if out and start <= out[-1][1]:
                start = min(start, out.pop()[0])
            out.append((start, end))
        return out

    def _reach(self, text: str, parts: list[tuple[int, int]], barred: list[bool], at: int, step: int) -> int:
        """The last part from `at` on, in one direction, up to which the neighbours look random."""
        best, total, most = at, 0.0, 0.0
        while 0 <= (at := at + step) < len(parts) and not barred[at] and total >= most - 4:
            total += self._excess(text[slice(*parts[at])])
            if total > most:
                best, most = at, total
        return best

    def spans(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Of each text, (start, number of kind, end) in order of start and kind."""
        data, at = utf8(column)
        found: list[list] = [[] for _ in range(len(at) - 1)]
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
        for kind, member, least in ((2, _HEX, 32), (3, _KEY, self.shortest)):
            start, end = runs(member[data], at, least)
            row = np.searchsorted(at, start, side="right") - 1
            base = points[at[row]]
            for r, a, b, byte_a, byte_b in zip(row, points[start] - base, points[end] - base, start, end, strict=True):
                if kind == 2:
                    found[r].append((int(a), kind, int(b)))
                else:
                    found[r] += [(int(a) + x, kind, int(a) + y) for x, y in self.stretches(data[byte_a:byte_b].tobytes().decode())]
        for r, text in enumerate(column.to_pylist()):
            if not text:
                continue
            small = text.lower()
            if any(k in small for k in KEYWORDS):
                found[r] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
            if "AKIA" in text:
                found[r] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
        return [self._settled(f) for f in found]

    @staticmethod
    def _settled(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """In order, without random strings that touch a span of a fixed format."""
        fixed = [f for f in found if f[1] < 3]
        return sorted(f for f in found if f[1] < 3 or not any(f[0] < e and s < f[2] for s, _, e in fixed))


SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, vocabulary: str, shortest: int = 20, chars_per_token: float = 2.0) -> DataFrame:
    """(doc_id, spans) of every document."""

    def find(batches) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary, shortest, chars_per_token)
        for batch in slices(batches):
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in f] for f in scanner.spans(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPAN)], ["doc_id", "spans"])

    return texts(docs).mapInArrow(find, SPANS)


def digest(spans: DataFrame) -> DataFrame:
    """Counts of the fixed formats, a checksum of their spans, and all spans as text."""

    def shown(column):
        one = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    fixed = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    counts = [number(kind) for kind in KINDS]
    return spans.select("doc_id", *counts, F.sha2(shown(fixed), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def cover(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with every stretch of spans replaced; overlapping ones become one."""
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, vocabulary: str, mask: str = "[SECRET]", shortest: int = 20, chars_per_token: float = 2.0) -> DataFrame:
    """The columns of `documents`, with secrets masked and n_chars counted anew where something was masked."""
    docs = docs.select(DOCUMENT_COLUMNS)

    def hide(batches) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary, shortest, chars_per_token)
        for batch in slices(batches):
            column, kind = batch.column("text"), batch.column("n_chars").type
            text, size = column.to_pylist(), batch.column("n_chars").to_pylist()
            for r, spans in enumerate(scanner.spans(column)):
                if spans:
                    text[r] = cover(text[r], spans, mask)
                    size[r] = len(text[r])
            new = {"text": pa.array(text, column.type), "n_chars": pa.array(size, kind)}
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in DOCUMENT_COLUMNS], DOCUMENT_COLUMNS)

    return docs.mapInArrow(hide, docs.schema)


