"""Byte-level BPE without replaying merges: longest matches of an Aho-Corasick automaton, with backtracking.

Two tokens may stand side by side exactly if encoding their joined bytes gives these two back; a sequence is the
encoding of its bytes exactly if all neighbours in it may. So the text is walked from left to right, longest token
first; a token that does not go with the one before is shortened, and when nothing shorter is left the one before is
taken back. A position that was given up is never tried again, so the time is linear in the text.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Runs whose ids, and token pairs whose compatibility, a process remembers.
CACHE_RUNS, CACHE_PAIRS = 400_000, 500_000
BLOCK_CHARS = 1 << 20
#: No match of PATTERN goes from one of these runs into the next.
RUN = regex.compile(r" ?\S+|\s+(?!\S)|\s+")
CUT = regex.compile(r"(?<=\S)\s")


assert array("I").itemsize == 4 and sys.byteorder == "little"


class Bpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str = PATTERN) -> None:
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.token = {b: a for a, b in self.rank.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.runs: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self._split()
        ids = np.array(sorted(self.token), np.int64)
        self.bytes = np.frombuffer(b"".join(self.token[k] for k in ids.tolist()), np.uint8)
        self.size = np.zeros(int(ids.max()) + 1, np.int64)
        self.size[ids] = [len(self.token[k]) for k in ids.tolist()]
        self.start = np.cumsum(self.size) - self.size

    def _split(self) -> None:
        """For each token the two that its last merge joins (a byte: itself, twice), and its longest shorter prefix."""
        top = max(self.token) + 1
        self.left, self.right = list(range(top)), list(range(top))
        self.shorter: list[int | None] = [None] * top
        self.length = [len(self.token.get(k, b"")) for k in range(top)]
        self.merged: dict[int, int] = {}
        for token, rank in sorted(self.rank.items(), key=lambda x: x[1]):
            prefixes = [self.rank[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.rank]
            self.shorter[rank] = prefixes[0] if prefixes else None
            for a in prefixes:
                b = self.rank.get(token[len(self.token[a]) :])
                if a < rank and b is not None and b < rank and self._compatible(a, b):
                    self.left[rank], self.right[rank], self.merged[a << 32 | b] = a, b, rank
                    break

    def _compatible(self, a: int, b: int) -> bool:
        """Whether no merge across the border comes before the merges that made a and b.

        The later of the two tokens at the border is taken apart, again and again; a merge of what then meets there
        would have come first if it ranks below what was taken apart last (on the right, not above it).
        """
        left, right, merged = self.left, self.right, self.merged
        before = len(left) + 1
        while True:
            joined = merged.get(a << 32 | b)
            if joined is not None and joined < before:
                return False
            a_part, b_part = right[a], left[b]
            if a_part != a and (a > b or b_part == b):
                before, a = a, a_part
            elif b_part != b:
                before, b = b + 1, b_part
            else:
                return True

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]
        n, length, shorter, pairs = len(data), self.length, self.shorter, self.pairs
        if len(pairs) > CACHE_PAIRS:
            pairs.clear()
        longest = [0] * n
        for end, rank in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - length[rank]] = rank  # longer matches from a start come later
        out: list[int] = []
        given_up = bytearray(n + 1)
        at, candidate, last = 0, longest[0], -1
        while at < n:
            while candidate is not None:
                end = at + length[candidate]
                if not given_up[end]:
                    if last < 0:
                        break
                    key = last << 32 | candidate
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self._compatible(last, candidate)
                    if fits:
                        break
                candidate = shorter[candidate]
            if candidate is None:
                # take the token before back: its end is given up now, so that a shorter one is found
                given_up[at] = 1
                candidate = out.pop()
                at -= length[candidate]
                last = out[-1] if out else -1
            else:
                out.append(candidate)
                at, last = end, candidate
                candidate = longest[at] if at < n else None
        return out

    def _run(self, run: str) -> bytes:
        pieces, parts = self.pieces, []
        for match in self.pattern.findall(run):
            got = pieces.get(match)
            if got is None:
                if len(pieces) > CACHE_RUNS:
                    pieces.clear()
                got = pieces[match] = array("I", self.piece(match.encode())).tobytes()
            parts.append(got)
        return b"".join(parts)

    def encode(self, text: str) -> bytes:
        """Ids of the text's matches, as little-endian 32-bit words."""
        parts, runs = [], self.runs
        start = 0
        while start < len(text):
            found = CUT.search(text, start + BLOCK_CHARS) if len(text) - start > BLOCK_CHARS else None
            end = found.start() if found else len(text)
            own = RUN.findall(text, start, end)
            try:
                parts.append(b"".join([runs[r] for r in own]))
            except KeyError:
                if len(runs) > CACHE_RUNS:
                    runs.clear()
                for r in own:
                    if r not in runs:
                        runs[r] = self._run(r)
                parts.append(b"".join([runs[r] for r in own]))
            start = end
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        k = np.frombuffer(ids, "<u4")
        n = self.size[k]
        return self.bytes[np.repeat(self.start[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()


@cache
def bpe(path: str) -> Bpe:
    return Bpe(path)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of docs (doc_id, text, ...).

    The ids are those of the whole text (null: empty) without special tokens; decoded are their bytes. Rows stand for
    themselves, so doc_ids may repeat or be null. Other columns are dropped. No rows give no rows. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(ranks)
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                got = own.encode(text or "")
                n.append(len(got) // 4)
                ids.append(hashlib.sha256(got).hexdigest())
                decoded.append(hashlib.sha256(own.decode(got)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
