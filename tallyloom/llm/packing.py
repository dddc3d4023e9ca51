"""Lexical retrieval packing: documents that share rare words share training sequences.

A first pass over all documents counts in how many of them each word occurs (by 18 bits of a hash) and how long they are,
and gives each document a place: its word of least weighted hash, the same for documents that hold it, longer words being
chosen more often. Documents are brought together by place (places held by many are split) and taken in shards as they
stream through a task. Each shard gets a BM25 inverted index with the corpus' statistics; a seed document's window of
2048 tokens is filled greedily with its best unused neighbours, by all its words, and what the last one has left over
seeds the next window. Windows are always full; a shard's last, open window is cut into sequences of powers of two. So
there is no padding at all.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, count, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Sequence

from .shared import cut, give_back, in_slices

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LENGTH = 2048
END = 1
#: Stands for END among runs; no run is empty.
END_RUN = ""
#: A shard is closed at so many documents or characters; an index never holds more (but for one longer text).
SHARD_DOCS, SHARD_CHARS = 2048, 8_000_000
#: Okapi constants.
K1, B = 1.2, 0.75
#: What a row counts for where rows are dealt to tasks, one more for each.
CHARS_A_ROW = 4096
#: A word that more than this share of a shard's documents hold is scored in a column, not by postings.
DENSE = 1 / 16
#: Documents are counted by word in so many bits of its hash: a table of fixed size, whatever the corpus.
SLOT_BITS = 18
#: Words of fewer characters take a document's place so many times less often.
LONG_WORD, SHORT_WEIGHT = 4, 0.02
CACHE_RUNS = 300_000
#: The nearest documents that are put in order first; a window seldom takes more.
NEAREST = 64
MARKS = ",."
BLOCK_CHARS = 1 << 20
#: The vocabulary's own way to part a lower-cased text before merging.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Where the vocabulary's normaliser could differ from lower() and split(): its special tokens, control characters and
#: everything beyond Latin.
UNUSUAL = r"<\||[\x00-\x08\x0e-\x1f\x7f-\x{a0}\x{250}-\x{10ffff}]"
#: So many runs are encoded in one string.
RUNS_AT_ONCE = 64


class Encoder:
    """Token ids of runs of non-white space, which the tokenizer encodes once and which are then remembered by number."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for usual runs in lower case, which the normaliser leaves as they are
        self.plain.normalizer = Sequence([])
        self.ends: np.ndarray = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a piece
        self.ends[[k for token, k in self.tokenizer.get_vocab(False).items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        """Forget all runs: number of each run; by number, where its ids are in flat, and its word (a hash)."""
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.numbers[END_RUN]  # number 0, whose one id is END
        self.start, self.size, self.word, self.flat = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int64), np.array([END], "<u4")

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Token ids of each text, END last, and its words; each different run is looked up once."""
        if not texts:
            return [], []
        sizes, at, runs = split_runs(texts)
        numbers = np.fromiter(map(self.numbers.__getitem__, runs.to_pylist()), np.int64, len(runs))[at]
        self.learn()
        ends = np.cumsum(sizes)
        closed = np.insert(numbers, ends, 0)
        tokens = np.append(0, np.cumsum(self.size[closed]))[ends + np.arange(1, ends.size + 1)]
        return np.split(self.ids(closed), tokens[:-1]), np.split(self.word[numbers], ends[:-1])

    def learn(self) -> None:
        """Encode the runs numbered since the last call. A word and one mark behind it are two pieces, encoded once
        each. Every piece ends with a token that ends pieces, so one call for many runs is enough."""
        old = self.size.size
        for mark in MARKS:
            self.numbers[mark]
        marked = [(k, self.numbers[r[:-1]], r[-1]) for k, r in enumerate(list(islice(self.numbers, old, None)), old) if r[-1] in MARKS and r[:-1].isalpha()]
        new = list(islice(self.numbers, old, None))
        if not new:
            return
        known = pa.array(new, pa.string())
        base = self.flat.size
        self.start, self.size = (np.append(x, np.zeros(len(new), np.int64)) for x in (self.start, self.size))
        self.word = np.append(self.word, word_hashes(known))
        plain = np.ones(len(new), bool)
        plain[[k - old for k, _, _ in marked]] = False
        at = np.flatnonzero(plain)
        if at.size:
            runs = [new[k] for k in at.tolist()]
            pieces = np.ones(at.size, np.int64)
            odd = np.flatnonzero(~pc.utf8_is_alpha(known).to_numpy(zero_copy_only=False)[at])
            pieces[odd] = [len(PIECE.findall(runs[k])) for k in odd.tolist()]
            parts = [" ".join(runs[k : k + RUNS_AT_ONCE]) for k in range(0, len(runs), RUNS_AT_ONCE)]
            ids = np.fromiter(chain.from_iterable(e.ids for e in self.plain.encode_batch_fast(parts, add_special_tokens=False)), "<u4")
            ends = np.flatnonzero(self.ends[ids])[np.cumsum(pieces) - 1] + 1
            start = np.append(0, ends[:-1])
            self.start[old + at], self.size[old + at] = start + base, ends - start
            self.flat = np.append(self.flat, ids)
        if marked:
            at, core, mark = (np.array(x) for x in zip(*((k, c, self.numbers[m]) for k, c, m in marked), strict=True))
            size = self.size[core] + 1  # a mark is one token
            self.start[at], self.size[at] = np.cumsum(size) - size + self.flat.size, size
            ids = np.empty(size.sum(), "<u4")
            last = np.zeros(ids.size, bool)
            last[np.cumsum(size) - 1] = True
            ids[last], ids[~last] = self.flat[self.start[mark]], self.ids(core)
            self.flat = np.append(self.flat, ids)

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        n = self.size[numbers]
        return self.flat[np.repeat(self.start[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def whole(self, text: str) -> np.ndarray:
        return np.concatenate([np.array(self.tokenizer.encode(b, add_special_tokens=False).ids, "<u4") for b in text_blocks(text)])


def split_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of runs of each lower-cased text, parted by white space; which one each is; the different ones."""
    lists = pc.ascii_split_whitespace(pa.array([t.lower().strip() for t in texts], pa.string()))
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    at, runs = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    empty = pc.index(runs, "").as_py()
    if empty >= 0:  # what an empty text is split into
        gone = at == empty
        sizes = sizes - np.bincount(np.repeat(np.arange(sizes.size), sizes)[gone], minlength=sizes.size)
        at = at[~gone]
        runs = pc.if_else(pc.equal(runs, ""), ".", runs)  # of no text
    return sizes, at, runs


def text_blocks(text: str) -> Iterator[str]:
    """The text cut at white space into parts of about BLOCK_CHARS; no token spans white space."""
    start = 0
    while len(text) - start > BLOCK_CHARS:
        space = re.compile(r"\s").search(text, start + BLOCK_CHARS)
        end = space.start() if space else len(text)
        yield text[start:end]
        start = end
    yield text[start:]


def word_hashes(runs: pa.Array) -> np.ndarray:
    """32-bit hashes of runs without punctuation at either end: polynomials of their bytes, mixed."""
    words = pc.utf8_trim(runs, string.punctuation)
    words = pc.if_else(pc.equal(words, ""), runs, words)
    if not len(words):
        return np.empty(0, np.int64)
    end = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    start = np.append(0, end[:-1])
    letters = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "")[0].as_buffer(), np.uint8)
    power = np.cumprod(np.full(int((end - start).max()), 0x9E3779B97F4A7C15, np.uint64))
    term = (letters + np.uint64(1)) * power[np.arange(letters.size) - np.repeat(start, end - start)]
    total = np.cumsum(np.append(np.uint64(0), term))
    return (mix(total[end] - total[start]) >> np.uint64(32)).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_shard(texts: list[str], own: Encoder) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Token ids of each text, END last; and its words as hashes.

    Runs of texts that hold anything unusual are never encoded alone: such a text is encoded whole, its words are what
    white space parts.
    """
    if len(own.numbers) > CACHE_RUNS:
        own.clear()
    usual = pc.invert(pc.match_substring_regex(pa.array(texts, pa.string()), UNUSUAL)).to_pylist()
    found = zip(*own.encode([t for t, ok in zip(texts, usual, strict=True) if ok]), strict=True)
    end = np.array([END], "<u4")
    both = [next(found) if ok else (np.append(own.whole(t), end), word_hashes(pa.array(t.lower().split(), pa.string()))) for t, ok in zip(texts, usual, strict=True)]
    return [ids for ids, _ in both], [words for _, words in both]


class Statistics:
    """Of the whole corpus: the inverse document frequency of each slot of words, and the mean number of words."""

    def __init__(self, docs: int, words: int, held: np.ndarray) -> None:
        self.idf = np.log(1 + (np.maximum(docs - held, 0) + 0.5) / (held + 0.5))
        self.mean = max(1.0, words / max(1, docs))

    @staticmethod
    def slot(word: np.ndarray) -> np.ndarray:
        return word & ((1 << SLOT_BITS) - 1)


class Index:
    """A BM25 inverted index: for each word the documents that hold it and their scores for it."""

    def __init__(self, words: list[np.ndarray], corpus: Statistics) -> None:
        n = len(words)
        sizes = np.array([w.size for w in words], np.int64)
        key = np.concatenate([*words, np.empty(0, np.int64)]) * n + np.repeat(np.arange(n), sizes)
        key.sort()
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if key.size else np.empty(0, np.int64)
        count = np.diff(np.append(new, key.size))
        word, doc = key[new] // n, key[new] % n
        idf = corpus.idf[corpus.slot(word)]
        score = idf * count * (K1 + 1) / (count + K1 * (1 - B + B * sizes[doc] / corpus.mean))
        word = np.cumsum(np.append(0, word[1:] != word[:-1])) if word.size else word  # numbered in order
        held = np.bincount(word)
        self.n, many = n, held > n * DENSE
        # words that many hold have a column each, the others postings; words of a single document find nothing
        column = np.cumsum(many) - 1
        own = many[word]
        self.columns = np.zeros((n, int(many.sum())), np.float32)
        self.columns[doc[own], column[word[own]]] = score[own]
        shared = (held[word] > 1) & ~own
        word, self.doc, self.score = word[shared], doc[shared], score[shared].astype(np.float32)
        held = np.where((held > 1) & ~many, held, 0)
        self.end, self.held = np.cumsum(held), held
        by_doc = np.argsort(self.doc, kind="stable")
        self.query_word, self.query_end = word[by_doc], np.cumsum(np.bincount(self.doc, minlength=n))

    def neighbours(self, doc: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a word with doc, best first, ties to the earlier one."""
        first = self.query_end[doc - 1] if doc else 0
        words = self.query_word[first : self.query_end[doc]]
        held = self.held[words]
        at = np.repeat(self.end[words] - np.cumsum(held), held) + np.arange(held.sum())
        score = np.bincount(self.doc[at], self.score[at], self.n) + self.columns @ (self.columns[doc] > 0).astype(np.float32)
        score[~unused] = 0
        found = np.flatnonzero(score)
        near = found if found.size <= NEAREST else found[score[found] >= np.partition(score[found], -NEAREST)[-NEAREST]]
        yield from near[np.argsort(-score[near], kind="stable")].tolist()
        if near.size < found.size:
            rest = np.setdiff1d(found, near, assume_unique=True)
            yield from rest[np.argsort(-score[rest], kind="stable")].tolist()


def pack(sizes: list[int], index: Index) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset). Sequences are numbered from 0."""
    n, out = len(sizes), []
    unused = np.ones(n, bool)
    sequence, filled, fresh = 0, 0, 0
    seed, queue = None, iter(())
    while True:
        # the next document: a neighbour of the window's seed, or else a new seed
        doc = next((d for d in queue if unused[d]), None)
        if doc is None:
            while fresh < n and not unused[fresh]:
                fresh += 1
            if fresh == n:
                break
            doc, seed = fresh, None
        unused[doc] = False
        start = 0
        while start < sizes[doc]:
            length = min(LENGTH - filled, sizes[doc] - start)
            out.append((doc, start, length, sequence, filled))
            start, filled = start + length, filled + length
            if filled == LENGTH:
                sequence, filled, seed, queue = sequence + 1, 0, None, iter(())
        if filled and seed is None:
            seed, queue = doc, index.neighbours(doc, unused)
    if filled:  # the open window, in powers of two
        last = [p for p in out if p[3] == sequence]
        out = out[: len(out) - len(last)]
        bounds, at = [], 0
        for bit in range(LENGTH.bit_length() - 1, -1, -1):
            if filled >> bit & 1:
                bounds.append((at, at + (1 << bit)))
                at += 1 << bit
        for k, (low, high) in enumerate(bounds):
            for doc, start, length, _, offset in last:
                a, b = max(low, offset), min(high, offset + length)
                if a < b:
                    out.append((doc, start + a - offset, b - a, sequence + k, a - low))
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PLACED = "doc_id long, text string, place long, chars long, row long, slots array<int>, held array<long>, docs long, words long"


def places(texts: list[str], held: np.ndarray) -> tuple[list[int], int]:
    """A place (a 32-bit number) for each text, and their number of words; each text's different words are added to held."""
    sizes, at, runs = split_runs(texts)
    word = word_hashes(runs)
    if texts:
        slots, which = np.unique(Statistics.slot(word), return_inverse=True)
        key = np.repeat(np.arange(sizes.size), sizes) * slots.size + which[at]
        key.sort()
        key = key[np.append(True, key[1:] != key[:-1])] if key.size else key  # a slot once for each text that holds it
        held[slots] += np.bincount(key % max(1, slots.size), minlength=slots.size)
    unit = ((mix(word.astype(np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    weight = np.where(pc.utf8_length(runs).to_numpy(zero_copy_only=False) >= LONG_WORD, 1.0, SHORT_WEIGHT)
    order = np.lexsort((word, -np.log(unit) / weight))
    rank = np.empty(order.size, np.int64)
    rank[order] = np.arange(order.size)
    found = np.zeros(len(texts), np.int64)
    some = np.flatnonzero(sizes)
    if some.size:
        found[some] = word[order[np.minimum.reduceat(rank[at], (np.cumsum(sizes) - sizes)[some])]]
    return found.tolist(), int(sizes.sum())


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents with their places, then one row of what the task has counted."""
    held, docs, words = np.zeros(1 << SLOT_BITS, np.int64), 0, 0
    base = TaskContext.get().partitionId() << 40
    names = [c.split()[0] for c in PLACED.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    for batch in in_slices(batches):
        texts, found, start, size = [t or "" for t in batch.column("text").to_pylist()], [], 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= BLOCK_CHARS or k + 1 == len(texts):
                own, n = places(texts[start : k + 1], held)
                found, words, start, size = found + own, words + n, k + 1, 0
        chars = pa.array(map(len, texts), pa.int64())
        row = pa.array(np.arange(base + docs, base + docs + len(texts)), pa.int64())
        docs += len(texts)
        empty = [pa.nulls(len(texts), t) for t in types[5:]]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text").cast(pa.string()), pa.array(found, pa.int64()), chars, row, *empty], names)
    some = np.flatnonzero(held)
    last = [None, None, None, None, None, some.tolist(), held[some].tolist(), docs, words]
    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(last, types, strict=True)], names)


def placed(docs: DataFrame) -> tuple[DataFrame, Statistics]:
    """doc_id, text, place, chars, row (its number) of every row of docs, and the corpus' statistics, of 2**SLOT_BITS
    counts."""
    rows = cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_placed, PLACED), "placed")
    counted = rows.where("docs IS NOT NULL")
    n, words = counted.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    by_slot = counted.select(F.explode(F.arrays_zip("slots", "held")).alias("x")).groupBy("x.slots").agg(F.sum("x.held").alias("n"))
    held = np.zeros(1 << SLOT_BITS, np.int64)
    found = by_slot.toPandas()  # a row for each slot at most
    held[found.slots.to_numpy(np.int64)] = found.n.to_numpy(np.int64)
    return rows.where("docs IS NULL").select("doc_id", "text", "place", "chars", "row"), Statistics(n, words, held)


def together(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, place, chars, row) with those of a place side by side: dealt by ranges of place and a hash of row
    that hold about as many rows and characters each (a row counts once, and again for each CHARS_A_ROW), so that a place
    held by many or by long texts is split; sorted within each partition."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("place", F.shiftleft("place", 24) + F.pmod(F.xxhash64("row"), F.lit(1 << 24)))
    counted = rows.select("place", F.explode(F.array_repeat(F.lit(0), F.lit(1) + F.floor(F.col("chars") / CHARS_A_ROW).cast("int"))))
    bounds = counted.agg(F.percentile_approx("place", [k / parts for k in range(1, parts)], F.lit(20 * parts))).first()[0] if parts > 1 else None
    bounds = sorted(set(bounds or []))  # a number for each partition
    at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("place"))) if bounds else F.lit(0)
    return rows.withColumn("part", at).repartitionById(parts, "part").sortWithinPartitions("part", "place", "row").select("doc_id", "text")


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: pieces of every row of docs (doc_id, text, ...).

    A document's tokens are the ids of its text (null: none) and END. Every token is in exactly one piece; a sequence
    has 2048 tokens, or at the end of a shard a power of two. sequence_id is the task's partition times 2**32 plus a
    number within it. Rows are packed each by itself, so doc_ids may repeat or be null. Other columns are dropped. No rows
    give no rows.
    """
    rows, corpus = placed(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(corpus)  # 2**SLOT_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = encoder(vocabulary), shipped.value
        base = TaskContext.get().partitionId() << 32

        def close(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
            nonlocal base
            tokens, words = encode_shard(texts, own)
            pieces = pack([t.size for t in tokens], Index(words, known))
            crc = [zlib.crc32(tokens[d][s : s + n].tobytes()) for d, s, n, _, _ in pieces]
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            size = np.array([t.size for t in tokens], np.int64)[doc]
            out = [pa.array([ids[d] for d in doc], pa.int64()), start, length, np.array(crc, np.int64), size, sequence + base, offset]
            base += int(sequence.max()) + 1
            return pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in out], [c.split()[0] for c in SCHEMA.split(", ")])

        ids, texts, size = [], [], 0
        for batch in in_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(text or "")
                if len(ids) >= SHARD_DOCS or size >= SHARD_CHARS:
                    yield close(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield close(ids, texts)
        give_back()

    return together(rows).mapInArrow(run, SCHEMA)
