"""Near-duplicate classes: DartMinHash signatures of word shingles, banded, with an exact check of every link.

A document is a weighted set: its shingles of five words with their counts. Each shingle's region, weight by rank, is
hit by hashed darts (a Poisson process that every document with that shingle shares); a dart names a coordinate, and
the dart of least rank is kept for each. Two documents keep the same dart with the probability of their weighted
Jaccard similarity. Ranks are thrown slice by slice until every coordinate is hit, so a signature costs about
k ln k + |x| darts and not k * |x|.

Equal texts are one node. Whatever a bucket's size, every two of its nodes are compared unless they are in one class
already, where a further link would change nothing. To get there cheaply, a bucket of a few nodes is compared pair by
pair, and in a larger one every node first with the bucket's middles, the nodes closest to what most of the bucket's
sketches say; that joins most of it. Then each larger bucket that still holds several classes is gone through in blocks
of parts, and all its nodes outside its largest class are compared with all its nodes. Comparisons start with short
sketches (a byte a coordinate); what may reach the similarity is checked exactly, on all shingles. A block joins the
classes that it links as it goes, so it gives fewer links than it has nodes. Classes are the connected components of the
verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sets import bloom, may_hold
from .shared import cut, in_slices, passing

WORDS = 5
SIMILARITY = 0.8
#: 25 bands of 5 coordinates: a pair of similarity 0.8 meets in some bucket with a probability of 0.99995.
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Texts are worked on in blocks of about so many characters (a longer text alone).
BLOCK_CHARS = 1 << 20
#: Words whose hashes a task remembers.
CACHE_WORDS = 300_000
ELEMENT_BITS = 44
#: Sketches of pairs of similarity 0.8 agree in less than this with a probability of 0.00002.
MAYBE = 0.65
#: Buckets are worked on in parts of about so many nodes, those of so few pair by pair; middles of a bucket.
GROUP, FEW = 512, 8
MIDDLES = 2
#: Nodes, and different shingles, that a part has about where classes are compared.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21
#: Near nodes of other classes that are checked one by one; more of them are checked over the block's shingles at once.
FEW_NEAR = 8
#: Partners that the text of a pair's first node is sent out with.
PARTNERS = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Weighted shingle sets of texts; remembers the hashes of words."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def _hash(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        try:
            found = [seen[w] for w in words]
        except KeyError:
            if len(seen) > CACHE_WORDS:
                seen.clear()
            for w in words:
                if w not in seen:
                    seen[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            found = [seen[w] for w in words]
        return np.array(found, np.uint64)

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row number, element (a hash of ELEMENT_BITS) and count of every different shingle of every text.

        Words are what white space parts, lower-cased. A text of fewer words is one shingle; none, or null: no rows.
        """
        words, sizes = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                own = text.lower().split()
                sizes[k] = len(own)
                words.append(self._hash(own))
        if not words:
            return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
        h = np.concatenate(words)
        row = np.repeat(np.arange(len(texts)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(h.size)  # words to the end of the text, this one included
        first = np.concatenate(([True], row[1:] != row[:-1])) if h.size else np.empty(0, bool)
        shingle = mix(h)
        padded = np.concatenate([h, np.zeros(WORDS, np.uint64)])
        for k in range(1, WORDS):
            shingle = mix(shingle + np.where(left > k, padded[k : k + h.size], np.uint64(0)) + np.uint64(k))
        keep = (left >= WORDS) | first
        key = (row[keep].astype(np.uint64) << np.uint64(ELEMENT_BITS)) | (shingle[keep] >> np.uint64(64 - ELEMENT_BITS))
        key.sort()
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        counts = np.diff(np.concatenate((new, [key.size])))
        key = key[new]
        return (key >> np.uint64(ELEMENT_BITS)).astype(np.int64), key & np.uint64((1 << ELEMENT_BITS) - 1), counts


def _poisson(mean: float) -> np.ndarray:
    """The distribution function, from 0 on."""
    k = np.arange(int(mean + 12 * np.sqrt(mean) + 24))
    log = k * np.log(mean) - mean - np.concatenate(([0.0], np.cumsum(np.log(np.maximum(k[1:], 1)))))
    return np.cumsum(np.exp(log))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(n: int, row: np.ndarray, element: np.ndarray, weight: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """DartMinHash of n weighted sets, given as (row, element, weight > 0): n by k words; a row without elements is 0.

    Weight is cut into cells of height 1 and rank into slices [0, 1), [1, 2), [2, 4), [4, 8) ...; the number of darts
    of a cell in a slice is Poisson with the slice's length, hashed from (element, cell, slice).
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * k, empty)
    cells = np.ceil(weight).astype(np.int64)
    at = np.repeat(np.arange(row.size), cells)
    cell = np.arange(at.size) - np.repeat(np.cumsum(cells) - cells, cells)
    row, left = row[at], weight[at] - cell
    base = mix(element[at] + (cell.astype(np.uint64) << np.uint64(ELEMENT_BITS)) + np.uint64(0x9E3779B97F4A7C15))
    fractional = bool((left < 1).any())
    low, length, part = 0.0, 1.0, 1
    while row.size:
        h = mix(base + np.uint64((part * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
        darts = np.searchsorted(_poisson(length), _unit(h), side="right")
        at = np.repeat(np.arange(row.size), darts)
        number = np.arange(at.size) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(h[at] + (number + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rank = (low + length * _unit(dart)).astype(np.float32)
        other = mix(dart)
        slot = row[at] * k + ((other >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        value = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (other & np.uint64(0xFFFFFFFF))
        if fractional:
            inside = _unit(mix(other)) < left[at]
            slot, value = slot[inside], value[inside]
        np.minimum.at(out, slot, value)
        open_rows = (out.reshape(n, k) == empty).any(1)
        go_on = open_rows[row]
        row, base, left = row[go_on], base[go_on], left[go_on]
        low, length, part = low + length, length if part == 1 else length * 2, part + 1
    out[out == empty] = 0
    return out.reshape(n, k)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS))
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return h.view(np.int64)


def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _to_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in in_slices(batches):
        texts, parts, sketches = batch.column("text").to_pylist(), [], []
        shingles = np.zeros(len(texts), np.int64)
        for start, end in blocks(texts):
            row, element, count = shingler.sets(texts[start:end])
            signed = signatures(end - start, row, element, count)
            parts.append(band_hashes(signed))
            sketches += [x.tobytes() for x in (signed & np.uint64(0xFF)).astype(np.uint8)]
            shingles[start:end] = np.bincount(row, minlength=end - start)
        flat = np.concatenate(parts).reshape(-1) if parts else np.empty(0, np.int64)
        ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS)
        bands = pa.ListArray.from_arrays(ends, pa.array(flat, pa.int64()), mask=pa.array(shingles == 0))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), bands, pa.array(sketches, pa.binary()), pa.array(shingles)], ["doc_id", "key", "bands", "sketch", "shingles"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two sets given as sorted elements and counts."""
    if a[0].size > b[0].size:
        a, b = b, a
    at = np.searchsorted(b[0], a[0]).clip(max=b[0].size - 1)
    same = b[0][at] == a[0]
    both = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(both) / max(1.0, float(a[1].sum() + b[1].sum() - both))


def _split_sets(shingler: Shingler, texts: list[str]) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For blocks of texts: the first one's number, and the set of each."""
    for start, end in blocks(texts):
        row, element, count = shingler.sets(texts[start:end])
        ends = np.searchsorted(row, np.arange(end - start + 1))
        yield start, [(element[x:y], count[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text): a null b says that the text is a's (of several, if its id repeats), the rows of its partners b
    follow."""
    shingler, owns, last = Shingler(), [], (None, None)
    for batch in in_slices(batches):
        a, b, texts = (batch.column(c).to_pylist() for c in ("a", "b", "text"))
        found = []
        for start, sets in _split_sets(shingler, texts):
            for k, one in enumerate(sets, start):
                if b[k] is None:
                    owns = [*owns, one] if last == (a[k], None) else [one]
                else:
                    found.append((a[k], b[k], any(similarity(own, one) >= SIMILARITY for own in owns)))
                last = (a[k], b[k])
        columns = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["a", "b", "similar"])


def _to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, elements, counts: shingle sets as bytes."""
    shingler = Shingler()
    for batch in in_slices(batches):
        for start, sets in _split_sets(shingler, batch.column("text").to_pylist()):
            bytes_ = [pa.array([x[k].astype(t).tobytes() for x in sets], pa.binary()) for k, t in ((0, "<u8"), (1, "<u4"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(sets)), *bytes_], ["node", "elements", "counts"])


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(-1) >= MAYBE


def _against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b of the rows whose sketches are near."""
    for batch in in_slices(batches):
        near = pa.array(_near(_sketches(batch.column("sketch_a")), _sketches(batch.column("sketch_b"))))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])


def _middles_of(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that agree with the most frequent bytes in most coordinates, and in how many."""
    counts = np.bincount((sketch + np.arange(COORDINATES) * 256).ravel(), minlength=COORDINATES * 256)
    agree = (sketch == counts.reshape(COORDINATES, 256).argmax(1)).mean(1)
    best = np.argsort(-agree, kind="stable")[:MIDDLES]
    return best, agree[best]


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns and the sketches of whole buckets; rows come sorted by the first column (or two)."""
    kept = None
    for batch in in_slices(batches):
        if batch.num_rows:
            new = (*(batch.column(c).to_numpy(zero_copy_only=False) for c in names), _sketches(batch.column("sketch")))
            kept = new if kept is None else tuple(np.concatenate(x) for x in zip(kept, new, strict=True))
            last = np.flatnonzero(kept[0] != kept[0][-1])
            done = int(last[-1]) + 1 if last.size else 0
            if done:
                yield tuple(x[:done] for x in kept)
                kept = tuple(x[done:] for x in kept)
    if kept is not None:
        yield kept


def _bounds(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return starts, np.append(starts[1:], bucket.size)


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of small buckets: all of FEW nodes, else each node with the middles."""
    for bucket, node, sketch in _runs(batches, ["bucket", "node"]):
        starts, ends = _bounds(bucket)
        two = starts[ends - starts == 2]
        two = two[_near(sketch[two], sketch[two + 1])]
        found = [(node[two], node[two + 1])]
        for low, high in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
            own, bytes_ = node[low:high], sketch[low:high]
            if own.size <= FEW:
                i, j = np.triu_indices(own.size, 1)
            else:
                middles = _middles_of(bytes_)[0]
                i, j = np.repeat(middles, own.size), np.tile(np.arange(own.size), middles.size)
                i, j = i[i != j], j[i != j]
            near = _near(bytes_[i], bytes_[j])
            found.append((own[i[near]], own[j[near]]))
        yield _pairs(found)


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, node, agree, place: the middles of each part of a large bucket."""
    for part, bucket, node, sketch in _runs(batches, ["part", "bucket", "node"]):
        out = []
        for low, high in zip(*_bounds(part), strict=True):
            at, agree = _middles_of(sketch[low:high])
            out += [(int(bucket[low]), int(node[low + x]), float(y), k) for k, (x, y) in enumerate(zip(at, agree, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["bucket", "node", "agree", "place"])


class Inverted:
    """Shingle sets of a block's nodes, by shingle."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.n = len(sets)
        element = np.concatenate([x for x, _ in sets])
        order = np.argsort(element, kind="stable")
        self.element, self.count = element[order], np.concatenate([y for _, y in sets])[order]
        self.owner = np.repeat(np.arange(self.n), [x.size for x, _ in sets])[order]
        self.size = np.bincount(self.owner, self.count, self.n)

    def similarity(self, element: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Weighted Jaccard of a set with each node's."""
        low, high = (np.searchsorted(self.element, element, side) for side in ("left", "right"))
        held = high - low
        at = np.repeat(low - (np.cumsum(held) - held), held) + np.arange(held.sum())
        both = np.bincount(self.owner[at], np.minimum(self.count[at], np.repeat(count, held)), self.n)
        return both / np.maximum(1.0, self.size + count.sum() - both)


def _links_of(node: np.ndarray, group: np.ndarray, asks: np.ndarray, held: np.ndarray, sketch: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Links (a, b) that join the block's classes as all links between asking and held nodes would."""
    own = np.unique(group, return_inverse=True)[1].reshape(-1)  # grows together as links are found
    others = np.flatnonzero(held)
    bytes_ = np.ascontiguousarray(sketch[others].T)  # by coordinate, so that sums run over rows
    inverted, found = None, ([], [])

    def join(k: int, other: int) -> None:
        found[0].append(int(node[k]))
        found[1].append(int(node[other]))
        own[own == own[other]] = own[k]

    for k in np.flatnonzero(asks):
        if (own[others] == own[k]).all():
            continue
        agree = (bytes_ == sketch[k][:, None]).view(np.uint8).sum(0, dtype=np.uint8)
        near = np.flatnonzero((agree >= MAYBE * COORDINATES) & (own[others] != own[k]))
        near = near[np.argsort(-agree[near].astype(np.int16), kind="stable")]
        for at in near[:FEW_NEAR]:
            if own[others[at]] != own[k] and similarity(sets[k], sets[others[at]]) >= SIMILARITY:
                join(k, others[at])
        near = near[FEW_NEAR:]
        near = near[own[others[near]] != own[k]]
        if near.size:
            inverted = inverted or Inverted([sets[x] for x in others])
            for at in near[inverted.similarity(*sets[k])[near] >= SIMILARITY]:
                if own[others[at]] != own[k]:
                    join(k, others[at])
    return found


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, node, group, asks, held, elements, counts, sketch in _runs(batches, ["part", "node", "class", "asks", "held", "elements", "counts"]):
        found = [(np.empty(0, np.int64),) * 2]
        for low, high in zip(*_bounds(part), strict=True):
            sets = [(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u4").astype(np.int64)) for x, y in zip(elements[low:high], counts[low:high], strict=True)]
            a, b = _links_of(node[low:high], group[low:high], asks[low:high], held[low:high], sketch[low:high], sets)
            found.append((np.array(a, np.int64), np.array(b, np.int64)))
        yield _pairs(found)


PAIRS = "a long, b long"


def _parted(rows: DataFrame, *columns: str) -> DataFrame:
    """rows with part: buckets cut into parts of about GROUP nodes, a part's rows together."""
    part = F.xxhash64("bucket", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / GROUP)))
    return rows.select(part.alias("part"), "bucket", "node", *columns, "sketch").repartition("part").sortWithinPartitions("part", "bucket", "node")


def _large(rows: DataFrame) -> DataFrame:
    """Near pairs of large buckets: each node with the bucket's middles, the best of those of its parts."""
    middles = _parted(rows).mapInArrow(_middles, "bucket long, node long, agree double, place long")
    middles = middles.groupBy("bucket", "place").agg(F.max(F.struct("agree", "node")).alias("m")).select("bucket", F.col("m.node").alias("a"))
    middles = cut(middles.join(rows.select("bucket", F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), ["bucket", "a"]), "middles")
    held = rows.select("bucket", F.col("node").alias("b"), F.col("sketch").alias("sketch_b")).join(middles, "bucket").where("a <> b")
    return held.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_against, PAIRS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_pairs(rows: DataFrame) -> DataFrame:
    """Near pairs (a, b) of rows (bucket, node, sketch, n), n the bucket's rows."""
    small = rows.where(F.col("n") <= GROUP).select("bucket", "node", "sketch")
    found = small.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(_in_buckets, PAIRS)
    large = rows.where(F.col("n") > GROUP)
    return found if large.isEmpty() else found.unionByName(_large(large))


def links_across(rows: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: links between different classes of rows (bucket, node, sketch, shingles); classes: node, class, of those that
    are not alone in theirs; texts: doc_id, text, of all nodes. The links join the classes of each bucket as all its
    pairs of the similarity would.

    Of two nodes of different classes one at least is outside the bucket's largest class; those ask, all are held
    against them. A bucket of more than BLOCK nodes or BLOCK_SHINGLES shingles is cut into parts of about so many, its
    askers into parts by themselves, and each part of askers meets each part of nodes in a block of its own.
    """
    rows = rows.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    sizes = rows.groupBy("bucket", "class").agg(F.count("*").alias("own"), F.sum("shingles").alias("size"))
    sizes = sizes.groupBy("bucket").agg(F.max(F.struct("own", "class", "size")).alias("top"), F.sum("own").alias("all"), F.sum("size").alias("sizes"))
    parts = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SHINGLES))
    mixed = sizes.where("top.own < all").select("bucket", F.col("top.class").alias("_top"), parts(F.col("all"), F.col("sizes")).alias("_parts"), parts(F.col("all") - F.col("top.own"), F.col("sizes") - F.col("top.size")).alias("_asking"))
    rows = cut(rows.join(mixed, "bucket").withColumn("_asks", F.col("class") != F.col("_top")), "mixed")
    sets = texts.join(rows.select(F.col("node").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    sets = cut(sets.mapInArrow(_to_sets, "node long, elements binary, counts binary"), "sets")
    block = lambda part, asking, asks, held: F.struct(part.alias("part"), asking.alias("asking"), asks.alias("asks"), held.alias("held"))
    yes, no, one = F.lit(True), F.lit(False), F.lit(1).cast("long")
    hashed = F.xxhash64("node")
    part, asking = F.pmod(hashed, "_parts"), F.pmod(F.shiftright(hashed, 20), F.col("_asking"))
    as_held = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_asking") - one), lambda k: block(part, k, no, yes))
    as_asker = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_parts") - one), lambda k: block(k, asking, yes, no))
    at = F.when(F.col("_parts") == 1, F.array(block(part, asking, F.col("_asks"), yes))).otherwise(F.when(F.col("_asks"), F.concat(as_held, as_asker)).otherwise(as_held))
    rows = rows.select("bucket", "node", "class", "sketch", F.explode(at).alias("at"))
    rows = rows.select(F.xxhash64("bucket", "at.part", "at.asking").alias("part"), "node", "class", "at.asks", "at.held", "sketch")
    rows = rows.join(sets.hint("merge"), "node").repartition("part").sortWithinPartitions("part", "node")
    return cut(rows.mapInArrow(_across, PAIRS), "across")


def similar_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similar for pairs (a, b), by their whole texts (doc_id, text). The text of `a` is sent once for about
    PARTNERS of its pairs, which are checked together; the joins' kind is named, so the plan is the same at any size."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    first = many.join(texts.withColumnRenamed("doc_id", "a").hint("merge"), "a")
    first = first.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text")
    rest = pairs.join(many.where("parts > 1"), "a", "left").join(texts.withColumnRenamed("doc_id", "b").hint("merge"), "b")
    rest = rest.select("a", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("long").alias("part"), "b", "text")
    rows = first.unionByName(rest).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return cut(rows.select("a", "b", "text").mapInArrow(_verify, "a long, b long, similar boolean"), "verified")


def components(links: DataFrame) -> DataFrame:
    """node, class for every node of links (a, b): the least node it is connected with. Each round takes the least
    class among neighbours, then that class's class, until nothing changes; a round's state is written."""
    links = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    now = cut(links.groupBy("a").agg(F.min("b").alias("_b")).select(F.col("a").alias("node"), F.least("a", "_b").alias("class")), "classes")
    while True:
        near = links.join(now.select(F.col("node").alias("b"), "class"), "b").groupBy("a").agg(F.min("class").alias("_class"))
        step = now.join(near, now.node == near.a).select("node", F.col("class").alias("was"), F.least("class", "_class").alias("class"))
        up = now.select(F.col("node").alias("class"), F.col("class").alias("_up"))
        now = cut(step.join(up, "class").select("node", "was", F.col("_up").alias("class")), "classes")
        if now.where("class <> was").isEmpty():
            return now.select("node", "class")
        now = now.select("node", "class")


def joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """classes (node, class) after further links (a, b), which are followed between whole classes."""
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    known = classes.unionByName(ends.join(classes, "node", "left_anti").select("node", F.col("node").alias("class")))
    known = cut(known, "classes")
    of = lambda end: known.select(F.col("node").alias(end), F.col("class").alias(f"class_{end}"))
    between = links.join(of("a"), "a").join(of("b"), "b").where("class_a <> class_b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    up = components(between).select(F.col("node").alias("class"), F.col("class").alias("_up"))
    return cut(known.join(up, "class", "left").select("node", F.coalesce("_up", "class").alias("class")), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, keep for every row of docs (doc_id, text, ...): class_id is the least doc_id of the row's class
    and keep says whether it is the row's own.

    Rows are in a class if their texts are equal, or linked by pairs of a similarity of 0.8 or more (weighted Jaccard of
    shingles of five words; texts of fewer words: equal words). Empty texts equal each other. A null text is equal and
    similar to nothing: class_id is its doc_id. A null doc_id: class_id null and keep true, and the row joins no class.
    Rows that repeat a doc_id share its class. No rows give no rows; other columns are dropped.
    """
    with passing(docs.sparkSession) as leave:
        rows = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5("text")).alias("key"), "text").where("doc_id IS NOT NULL")
        signed = cut(rows.mapInArrow(_to_bands, "doc_id long, key binary, bands array<long>, sketch binary, shingles long"), "signed")
        copies = cut(signed.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("_rep"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "copies")
        known = signed.join(copies.hint("merge"), "key", "left").withColumn("node", F.coalesce("_rep", "doc_id"))
        own = F.col("doc_id") == F.col("node")
        copied = F.col("_rep").isNotNull()
        known = cut(known.select("doc_id", "node", "key", copied.alias("copied"), F.when(own, F.col("bands")).alias("bands"), F.when(own, F.col("sketch")).alias("sketch"), "shingles"), "nodes")
        # a node for each doc_id and text, so that nothing squares where rows repeat or a doc_id has many texts
        columns = ("node", "key", "bands", "sketch", "shingles")
        nodes = known.where("bands IS NOT NULL AND NOT copied").select(*columns)
        nodes = nodes.unionByName(known.where("bands IS NOT NULL AND copied").select(*columns).dropDuplicates(["node", "key"]))
        sketches = nodes.select("node", "key", "sketch", "shingles")
        left = nodes.select("node", "key", F.explode("bands").alias("bucket"))
        sized = cut(left.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
        rows = left.join(sized.hint("merge"), "bucket").join(sketches.hint("merge"), ["node", "key"]).select("bucket", "node", "sketch", "shingles", "n")
        rows = cut(rows, "rows")
        texts = docs.select(F.col("doc_id").cast("long"), "text").where("text IS NOT NULL")
        pairs = cut(near_pairs(rows).distinct(), "pairs")
        larger = rows.where(F.col("n") > FEW)
        asked = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(larger.select(F.col("node").alias("doc_id"))).distinct()
        asked = cut(asked, "asked")
        # only texts that a Bloom filter of the ids lets pass are shuffled
        texts = texts.join(F.broadcast(bloom(asked, ["doc_id"])), may_hold(["doc_id"]), "left_semi")
        texts = cut(texts.join(asked.hint("merge"), "doc_id", "left_semi"), "texts")
        classes = components(similar_pairs(pairs, texts).where("similar").select("a", "b"))
        links = links_across(larger, classes, texts)
        if not links.isEmpty():
            classes = joined_classes(classes, links)
        found = known.select("doc_id", "node").join(classes, "node", "left").select("doc_id", F.coalesce("class", "node").alias("class_id"))
        found = found.withColumn("keep", F.col("doc_id") == F.col("class_id"))
        lost = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("keep"))
        return leave(found.unionByName(lost), "found")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns; of rows that repeat a doc_id with the same
    text, one."""
    found = near_duplicates(docs)
    gone = cut(found.where("NOT keep").select("doc_id").distinct(), "gone")
    # what a Bloom filter of the ids that go does not hold stays where it lies, the rest is joined; a plan for any size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*docs.columns).alias("row"))
    held = F.broadcast(bloom(gone, ["doc_id"]))
    sure = rows.join(held, may_hold(["doc_id"]), "left_anti")
    maybe = rows.join(held, may_hold(["doc_id"]), "left_semi")
    kept = sure.unionByName(maybe.join(gone.hint("merge"), "doc_id", "left_anti")).select("row.*")
    twice = cut(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(kept.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))
