"""Near-duplicate documents by Order MinHash, verified by banded alignment.

1. A document is its sequence of lower-cased words. Documents of equal sequence
   form a class; from here on a class is one row with a number.
2. Each run of `k` words is labelled with how often it has occurred before in
   the text. For each of `bands` hash functions the `ell` labelled runs of least
   hash are taken and listed in text order; the digest of that list is the
   band's key. Texts that agree in these runs and in their order, that is texts
   of small edit distance, share keys. Scattered edits leave few runs of `k` words,
   so further `word_bands` bands take the `word_ell` labelled single words of least hash,
   and texts of at most `short_words` words have `short_bands` of `short_ell` words besides:
   they propose pairs down to the edit similarity that step 5 asks for.
3. Within each bucket (band, key) every member is compared with the bucket's
   hub, the member of least number: a pair for each member. Keys are counted before members move.
   Pairs whose bit maps of labelled words already rule out the similarity are dropped unread.
4. The links found so far connect texts. In buckets whose members are not all connected, members of
   different components are compared by their bit maps only, in tiles: a bucket is cut into parts of about
   `tile` members, and a task that holds two parts writes the pairs that the bit maps leave, so that no pair of a
   bucket is left open, none that they rule out is written or moved, and none is written in more than one large bucket.
5. Pairs of like length are aligned together. A pair is linked if alignment within a band of width
   floor((1 - similarity) * longer length) confirms that the word edit distance
   does not exceed it.
6. Connected components over the links, by iterated minima in Spark, name each
   class after its least doc_id.

Cases: null, empty and wordless texts are one class each by equal sequence, so
they are copies of one another; texts of fewer than `k` words have copies only;
repeated rows are copies; a null doc_id is kept and ranks last as a name; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigia.durable import Workspace, stored
from vigia.llm import idfilter
from vigia.llm.links import components
from vigia.llm.textkit import Pieces, chunks, fresh, grams, mixed, terms
from vigia.operators.lookup import lookup


@dataclass(frozen=True)
class OrderRule:
    k: int = 5
    bands: int = 24
    ell: int = 3
    word_bands: int = 44
    word_ell: int = 4
    short_bands: int = 24
    short_ell: int = 2
    short_words: int = 40
    similarity: float = 0.8
    narrow: int = 12
    tile: int = 1024
    large: int = 512
    max_rounds: int = 50


def occurrence_labelled(doc: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Digests that tell the first, second, ... occurrence of an entry in its document apart."""
    with np.errstate(over="ignore"):
        key = digest ^ mixed(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]]) if len(key) else np.zeros(0, bool)
    place = np.arange(len(key))
    number = np.empty(len(key), dtype=np.uint64)
    number[order] = place - np.maximum.accumulate(np.where(same, 0, place)) if len(key) else 0
    with np.errstate(over="ignore"):
        return np.where(number > 0, mixed(digest + number * np.uint64(0x9E3779B97F4A7C15)), digest)


def labelled_words(words: Pieces) -> np.ndarray:
    """Digests of the labelled single words."""
    return occurrence_labelled(words.doc, grams(words, 1)[1])


def sketches(words: Pieces, rule: OrderRule, labels: np.ndarray | None = None) -> np.ndarray:
    """A row for each text with the keys of all kinds of bands; zero where a text has none of that kind."""
    size = np.diff(words.first)
    labels = labelled_words(words) if labels is None else labels
    runs = banded_keys(words, rule.k, rule.bands, rule.ell)
    single = banded_keys(words, 1, rule.word_bands, rule.word_ell, rule.bands, labels)
    single[size < rule.k] = 0
    brief = size <= rule.short_words
    mine = brief[words.doc]
    some = Pieces(words.doc[mine], words.start[mine], words.end[mine], words.digest[mine], np.concatenate([[0], np.cumsum(np.where(brief, size, 0))]))
    short = banded_keys(some, 1, rule.short_bands, rule.short_ell, rule.bands + rule.word_bands, labels[mine])
    short[size < rule.k] = 0
    return np.concatenate([runs, single, short], axis=1)


def banded_keys(words: Pieces, k: int, bands: int, ell: int, begin: int = 0, labelled: np.ndarray | None = None) -> np.ndarray:
    """A row for each text with `bands` keys, for hash functions from number `begin` on; zeros below `k` words."""
    n = len(words.first) - 1
    if labelled is None:
        at, digest = grams(words, k)
        doc = words.doc[at]
        labelled = occurrence_labelled(doc, digest)
    else:
        doc = words.doc
    some, first = np.unique(doc, return_index=True)
    out = np.zeros((n, bands), dtype=np.uint64)
    if not len(some):
        return out
    size = np.diff(np.append(first, len(doc)))
    row = np.repeat(np.arange(len(some)), size)
    # Only hashes below a bound, about 4 * ell of a text, are sorted; texts with too few of them are sorted whole.
    bound = np.where(size <= 4 * ell, 1.0, 4 * ell / size) * float(1 << 64)
    bound = np.where(bound >= float(1 << 64), np.uint64(0xFFFFFFFFFFFFFFFF), np.minimum(bound, float(1 << 63) * 1.99).astype(np.uint64))[row]
    with np.errstate(over="ignore"):
        for band in range(begin, begin + bands):
            a, b = (mixed(np.array([2 * band + j + 1], dtype=np.uint64))[0] for j in (0, 1))
            value = (labelled ^ a) * (b | np.uint64(1))
            value ^= value >> np.uint64(32)
            low = value <= bound
            few = np.bincount(row[low], minlength=len(some)) < np.minimum(ell, size)
            if few.any():
                low |= few[row]
            low = np.flatnonzero(low)
            low = low[np.lexsort((value[low], row[low]))]
            head = np.searchsorted(row[low], np.arange(len(some)))
            # A text with fewer runs than ell repeats its last one; the order is that of the text.
            order = np.sort(low[head + np.minimum(np.arange(ell)[:, None], size - 1)], axis=0)
            key = np.zeros(len(some), dtype=np.uint64)
            for j in range(ell):
                key = mixed(key * np.uint64(31) + labelled[order[j]] + np.uint64(band + 1))
            out[some, band - begin] = key
    return out


_LEAST_BITS, _MOST_BITS = 256, 1 << 16


def word_bits(words: Pieces, labels: np.ndarray) -> list[bytes]:
    """The bit map of each text: in which cells an odd number of its labelled words falls.

    It has two to four bits a word, a power of two between the bounds. A map of half the size is
    the exclusive or of its halves. Words that two texts share fall to the same cells of both and cancel out, so
    two maps differ in no more cells than there are labelled words of only one text. A replaced word makes
    two of these, an inserted or deleted one makes one and changes the length (see `_excess`).
    """
    size = np.diff(words.first)
    width = np.clip(1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64), _LEAST_BITS, _MOST_BITS)
    begin = np.concatenate([[0], np.cumsum(width)])
    cells = np.zeros(begin[-1], dtype=np.uint8)
    np.add.at(cells, begin[words.doc] + (labels & (width[words.doc] - 1).astype(np.uint64)).astype(np.int64), np.uint8(1))
    raw = np.packbits(cells & 1, bitorder="little").tobytes()
    return [raw[a:b] for a, b in itertools.pairwise((begin // 8).tolist())]


def _maps(values: list[bytes], width: int) -> np.ndarray:
    """The bit maps in rows of 64-bit words, folded to `width` bytes; none is shorter."""
    out = np.empty((len(values), width // 8), dtype=np.uint64)
    size = np.fromiter(map(len, values), np.int64, len(values))
    for own in np.unique(size).tolist():
        at = np.flatnonzero(size == own)
        out[at] = np.bitwise_xor.reduce(np.frombuffer(b"".join([values[i] for i in at.tolist()]), "<u8").reshape(len(at), -1, width // 8), axis=1)
    return out


def _excess(x: np.ndarray, y: np.ndarray, gap: np.ndarray | int = 0) -> np.ndarray:
    """For each row a lower bound of the word edits: half of the cells that differ and of the `gap` between the lengths.

    With r words replaced and s inserted or deleted at most 2 r + s cells differ, and the gap is at most s.
    """
    return (np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) + gap + 1) // 2


def _limits(most: np.ndarray, rule: OrderRule) -> np.ndarray:
    """The word edits that a link may have if the longer text has `most` words."""
    return ((1 - rule.similarity) * most + 1e-9).astype(np.int64)


def _payloads(words: Pieces) -> Iterator[bytes]:
    """The word digests of each text as bytes."""
    raw = words.digest.astype("<u8").tobytes()
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        yield raw[8 * a : 8 * b]


def _sames(words: Pieces) -> list[bytes]:
    return [xxhash.xxh3_128_digest(p) for p in _payloads(words)]


def word_classes(docs: DataFrame, rule: OrderRule) -> DataFrame:
    """doc_id, same (digest of the word sequence), n (words), keys (of the bands; none below `k` words), bits (likewise)."""
    schema = pa.schema([("doc_id", pa.int64()), ("same", pa.binary()), ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                _, _, words = terms(texts)
                labels = labelled_words(words)
                found = sketches(words, rule, labels).view(np.int64)
                size = np.diff(words.first)
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(size >= rule.k, found.shape[1], 0))]).astype(np.int32))
                keys = pa.ListArray.from_arrays(offsets, pa.array(found[size >= rule.k].ravel()))
                bits = pa.array([v if m >= rule.k else b"" for v, m in zip(word_bits(words, labels), size.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(_sames(words), pa.binary()), pa.array(size.astype(np.int32)), keys, bits], schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, same binary, n int, keys array<bigint>, bits binary")


def keyed(classes: DataFrame, passed: Broadcast | None = None) -> DataFrame:
    """key, num of the bands of all classes, or of those whose key may be in the filter. A key names its band too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1)
            num = np.repeat(batch.column(0).to_numpy(), pc.list_value_length(keys).to_numpy(zero_copy_only=False))
            keys = keys.flatten().to_numpy(zero_copy_only=False)
            at = keys != 0
            if passed is not None:
                at &= idfilter.contains(passed.value, keys.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(num[at])], names=["key", "num"])

    return classes.select("num", "keys").where(F.size("keys") > 0).mapInArrow(run, "key bigint, num bigint")


def opened(classes: DataFrame, passed: Broadcast) -> DataFrame:
    """num, open: the keys of each class that may be in the filter, ascending."""
    schema = pa.schema([("num", pa.int64()), ("open", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            keys = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            at = np.flatnonzero((keys != 0) & idfilter.contains(passed.value, keys.view(np.uint64)))
            row = np.repeat(np.arange(len(size)), size)[at]
            keys = keys[at][np.lexsort((keys[at], row))]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], schema=schema).filter(pa.array(np.diff(offsets) > 0))

    return classes.select("num", "keys").where(F.size("keys") > 0).mapInArrow(run, "num bigint, open array<bigint>")


def bucketed(classes: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """The buckets (key, hub, n) of two members or more, and the pairs (num, hub) of their members; the hub is the least.

    Keys are counted first. Members move only if a Bloom filter of the keys met twice or more lets them pass.
    """
    counts = keyed(classes).groupBy("key").agg(F.min("num").alias("hub"), F.count("*").alias("n"))
    buckets = work.stored(counts.where("n > 1"), "buckets")
    passed = classes.sparkSession.sparkContext.broadcast(idfilter.build(buckets.select("key")))
    pairs = lookup(keyed(classes, passed), buckets, ["key"], "n").where("num > hub")
    return buckets, pairs.select("num", "hub").distinct()


def possible(pairs: DataFrame, classes: DataFrame, rule: OrderRule) -> DataFrame:
    """The pairs (num, hub) that the bit maps do not rule out."""
    schema = pa.schema([("num", pa.int64()), ("hub", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                x, y = (some.column(i).to_pylist() for i in (4, 5))
                most, gap = (some.column(i).to_numpy() for i in (2, 3))
                width = np.minimum(*(np.fromiter(map(len, v), np.int64, len(v)) for v in (x, y)))
                near = np.zeros(len(x), dtype=bool)
                for own in np.unique(width).tolist():
                    i = np.flatnonzero(width == own).tolist()
                    near[i] = _excess(*(_maps([v[j] for j in i], own) for v in (x, y)), gap[i]) <= _limits(most[i], rule)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1)], schema=schema).filter(pa.array(near))

    held = classes.where(F.size("keys") > 0)
    both = pairs.join(held.select("num", F.col("n").alias("m"), F.col("bits").alias("x")), "num")
    both = both.join(held.select(F.col("num").alias("hub"), "n", F.col("bits").alias("y")), "hub")
    most, gap = F.greatest("n", "m"), F.abs(F.col("n") - F.col("m"))
    both = both.where(gap <= F.floor(most * (1 - rule.similarity) + 1e-9))
    return both.select("num", "hub", most.alias("most"), gap.alias("gap"), "x", "y").mapInArrow(run, "num bigint, hub bigint")


def across(classes: DataFrame, buckets: DataFrame, roots: DataFrame, rule: OrderRule, work: Workspace) -> DataFrame:
    """Pairs (num, hub) of members of one bucket in different components that their bit maps do not rule out.

    A bucket that holds a pair of two components is open. Of the large buckets that hold a pair only that of
    least key writes it, and smaller ones write it only if their key is less: the least key that two texts share always does.
    """
    sparkle = classes.sparkSession.sparkContext
    rooted = classes.where(F.size("keys") > 0).select("num", "n", "bits").join(roots.withColumnRenamed("node", "num"), "num", "left")
    rooted = work.stored(rooted.select("num", "n", F.coalesce("root", "num").alias("root"), "bits"), "rooted")
    passed = sparkle.broadcast(idfilter.build(buckets.select("key")))
    # The keys travel with the root of their text; a bucket is open if its members have two roots.
    held = keyed(classes, passed).join(rooted.select("num", "root"), "num")
    spread = held.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
    spread = work.stored(spread.where("low <> high").select("key", "size", F.ceil(F.col("size") / rule.tile).alias("parts")), "open-buckets")
    passed = sparkle.broadcast(idfilter.build(spread.select("key")))
    held = lookup(keyed(classes, passed), spread, ["key"], "size").where("parts IS NOT NULL")
    # Every two parts of a bucket meet in the tile (low, high).
    held = held.withColumn("part", F.pmod(F.xxhash64("num"), "parts")).withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    held = work.stored(held.select("key", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "num"), "open-members")
    large = sparkle.broadcast(idfilter.build(spread.where(F.col("size") >= rule.large).select("key")))
    tiles = held.join(rooted.join(opened(classes, large), "num", "left"), "num")
    earlier = F.coalesce(F.expr("filter(open, k -> k < key)"), F.array().cast("array<bigint>"))
    tiles = tiles.select("key", "low", "high", "part", "num", "n", "root", "bits", earlier.alias("earlier"))
    tiles = tiles.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "n")
    return tiles.mapInArrow(partial(_tile_pairs, rule=rule, lengths=True), "num bigint, hub bigint").distinct()


def _tile_pairs(batches: Iterator[pa.RecordBatch], rule: OrderRule, lengths: bool = False) -> Iterator[pa.RecordBatch]:
    """The pairs of each tile; a tile that goes on in the next batch waits for it."""
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if waiting is None else pa.concat_tables([waiting, pa.Table.from_batches([batch])])
        table = table.combine_chunks()
        last = np.flatnonzero(_tile_begins(table))[-1]
        waiting = table.slice(last)
        yield from _pairs_of_tiles(table.slice(0, last), rule, lengths)
    if waiting is not None:
        yield from _pairs_of_tiles(waiting, rule, lengths)


def _tile_begins(table: pa.Table) -> np.ndarray:
    begins = np.ones(table.num_rows, dtype=bool)
    names = [table.column(i).to_numpy() for i in range(3)]
    begins[1:] = np.any([v[1:] != v[:-1] for v in names], axis=0)
    return begins


def _pairs_of_tiles(table: pa.Table, rule: OrderRule, lengths: bool) -> Iterator[pa.RecordBatch]:
    """Rows in order of tile and length: each meets the following ones until the tile or the like length ends.

    With `lengths` the bound takes the lengths in, else it is that of the maps alone.
    Two rows that share one of their `earlier` keys, if these are given, meet in the bucket of that key.
    """
    if not table.num_rows:
        return
    tile = np.cumsum(_tile_begins(table))
    low, high, part, num, n, root = (table.column(i).to_numpy() for i in range(1, 7))
    bits = table.column(7).to_pylist()
    earlier = table.column("earlier") if "earlier" in table.column_names else None
    keys_of = cache(lambda i: frozenset(earlier[i].as_py()))
    width = np.fromiter(map(len, bits), np.int64, len(bits))
    n = n.astype(np.int64)
    for own in np.unique(width).tolist():
        # A text of like length has a map of the same size or of twice that size.
        rows = np.flatnonzero((width == own) | (width == 2 * own))
        maps = _maps([bits[i] for i in rows.tolist()], own)
        at, step = np.flatnonzero(width[rows] == own), 0
        while len(at):
            step += 1
            at = at[at + step < len(rows)]
            i, j = rows[at], rows[at + step]
            like = (tile[i] == tile[j]) & (n[j] - n[i] <= _limits(n[j], rule))
            at, i, j = at[like], i[like], j[like]
            ask = at[(root[i] != root[j]) & ((low[i] == high[i]) | (part[i] != part[j]))]
            for begin in range(0, len(ask), max(1, (1 << 21) // own)):
                x = ask[begin : begin + max(1, (1 << 21) // own)]
                y = x + step
                gap = n[rows[y]] - n[rows[x]] if lengths else 0
                near = _excess(maps[x], maps[y], gap) <= _limits(n[rows[y]], rule)
                x, y = rows[x[near]], rows[y[near]]
                if earlier is not None:
                    here = [keys_of(i).isdisjoint(keys_of(j)) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
                    x, y = x[here], y[here]
                a, b = num[x], num[y]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["num", "hub"])


def linked(checked: DataFrame) -> DataFrame:
    return checked.where("linked").select(F.col("num").alias("a"), F.col("hub").alias("b"))


def edit_within(a: np.ndarray, b: np.ndarray, limit: int, narrow: int = 12) -> int | None:
    """The word edit distance if it is at most `limit`, else None; only cells within the band are filled."""
    if abs(len(a) - len(b)) > limit:
        return None
    a, b = _trimmed(a, b)
    if not len(a) or not len(b):
        d = max(len(a), len(b))
        return d if d <= limit else None
    shared = _shared(a, b)
    if max(len(a), len(b)) - shared > limit:
        return None
    width = min(narrow, limit)
    while True:
        d = _banded(a, b, width) if abs(len(a) - len(b)) <= width else None
        if d is not None or width == limit:
            return d
        width = min(limit, 8 * width)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """The words that both have, each as often as in the one that has fewer."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _banded(a: np.ndarray, b: np.ndarray, width: int) -> int | None:
    """Rows of the distance table, restricted to `width` cells on either side of the diagonal."""
    far = 1 << 30
    size = 2 * width + 1
    steps = np.arange(size)
    padded = np.concatenate([np.zeros(width + 1, b.dtype), b, np.zeros(len(a) + width + 1, b.dtype)])
    column = np.arange(-width, width + 1)  # of b, at row 0
    row = np.where(column >= 0, column, far)
    row[column > len(b)] = far
    for i in range(1, len(a) + 1):
        # Cell c of row i is column i + c - width; its diagonal neighbour has the same c.
        best = row + (padded[i : i + size] != a[i - 1])
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        low, high = width - i, width - i + len(b)
        if low >= 0:
            best[: low + 1] = far
            best[low] = i
        if high + 1 < size:
            best[high + 1 :] = far
        row = np.minimum.accumulate(best - steps) + steps
        if high + 1 < size:
            row[high + 1 :] = far
        if row.min() > width:
            return None
    d = int(row[len(b) - len(a) + width])
    return d if d <= width else None


_CELLS = 1 << 16
_FAR = 1 << 29


def edits_within(pairs: list[tuple[np.ndarray, np.ndarray]], limits: np.ndarray, narrow: int = 12) -> np.ndarray:
    """For each pair of word sequences whether its edit distance is at most its limit; pairs of like length advance together."""
    out = np.zeros(len(pairs), dtype=bool)
    open_pairs: list[tuple[int, np.ndarray, np.ndarray]] = []
    for at, (a, b) in enumerate(pairs):
        limit = int(limits[at])
        a, b = _trimmed(a, b)
        if not len(a) or not len(b):
            out[at] = max(len(a), len(b)) <= limit
        elif abs(len(a) - len(b)) <= limit and max(len(a), len(b)) - _shared(a, b) <= limit:
            open_pairs.append((at, a, b))
    width = narrow
    while open_pairs:
        # Pairs with a limit below the band's width use their own limit, so groups are of one width.
        groups: dict[int, list] = {}
        later = []
        for pair in open_pairs:
            own = min(width, int(limits[pair[0]]))
            if abs(len(pair[1]) - len(pair[2])) <= own:
                groups.setdefault(own, []).append(pair)
            else:
                later.append(pair)
        for own, some in groups.items():
            some.sort(key=lambda p: max(len(p[1]), len(p[2])))
            at = 0
            while at < len(some):
                to = at + 1
                while to < len(some) and (to - at + 1) * max(2 * own + 1, max(len(some[to][1]), len(some[to][2])) + own) <= _CELLS:
                    to += 1
                found = _banded_many([(a, b) for _, a, b in some[at:to]], own)
                for (i, a, b), near in zip(some[at:to], found.tolist(), strict=True):
                    if near:
                        out[i] = True
                    elif own < limits[i]:
                        later.append((i, a, b))
                at = to
        open_pairs, width = later, 8 * width
    return out


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences without what they have in common at the beginning and at the end."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    same = a[len(a) - n :][::-1] == b[len(b) - n :][::-1]
    tail = n if same.all() else int(same.argmin())
    return a[: len(a) - tail], b[: len(b) - tail]


def _banded_many(pairs: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """For each pair whether the distance is at most `width`; the distance tables of all pairs grow row by row together."""
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    size = 2 * width + 1
    steps = np.arange(size, dtype=np.int32)
    rows = np.zeros((len(pairs), n.max()), dtype=np.uint64)
    # Cell c of row i is column i + c - width of b; beyond b stands a word of its own, which costs an edit.
    padded = np.zeros((len(pairs), width + 1 + max(m.max(), n.max() + width) + 1), dtype=np.uint64)
    for k, (a, b) in enumerate(pairs):
        rows[k, : len(a)] = a
        padded[k, width + 1 : width + 1 + len(b)] = b
    beyond = np.arange(padded.shape[1]) - (width + 1) >= m[:, None]
    out, live = np.zeros(len(pairs), dtype=bool), np.arange(len(pairs))
    row = np.broadcast_to(np.where(steps >= width, steps - width, _FAR).astype(np.int32), (len(pairs), size)).copy()
    for i in range(1, int(n.max()) + 1):
        best = row + ((padded[live, i : i + size] != rows[live, i - 1][:, None]) | beyond[live, i : i + size])
        np.minimum(best[:, :-1], row[:, 1:] + 1, out=best[:, :-1])
        if width - i >= 0:
            best[:, : width - i + 1] = _FAR
            best[:, width - i] = i
        row = np.minimum.accumulate(best - steps, axis=1) + steps
        ended = n[live] == i
        if ended.any():
            done = live[ended]
            out[done] = row[ended, (m[done] - n[done]) + width] <= width
        stays = ~ended & (row.min(axis=1) <= width) if i % 8 == 0 or ended.any() else None
        if stays is not None and not stays.all():
            live, row = live[stays], row[stays]
            if not len(live):
                break
    return out


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """num, words (8-byte digests) of one text of each wanted class (num, same, doc_id).

    A Bloom filter of the ids chooses the rows to read, without moving texts; rows without an id are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(idfilter.build(wanted.select("doc_id").where("doc_id is not null")))
    schema = pa.schema([("same", pa.binary()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            passed = idfilter.contains(shared.value, ids.fill_null(0).to_numpy(zero_copy_only=False)) | ids.is_null().to_numpy(zero_copy_only=False)
            for _, texts in chunks(batch.filter(pa.array(passed))):
                _, _, words = terms(texts)
                yield pa.RecordBatch.from_arrays([pa.array(_sames(words), pa.binary()), pa.array(list(_payloads(words)), pa.binary())], schema=schema)

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "same binary, words binary")
    return read.dropDuplicates(["same"]).join(wanted.select("num", "same"), "same").select("num", "words")


def verified(pairs: DataFrame, texts: DataFrame, rule: OrderRule) -> DataFrame:
    """The pairs with `linked`: whether alignment confirms the similarity."""
    schema = pa.schema([("num", pa.int64()), ("hub", pa.int64()), ("linked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [tuple(np.frombuffer(v.as_buffer(), dtype="<u8") for v in xy) for xy in zip(batch.column(2), batch.column(3), strict=True)]
            limits = np.array([int((1 - rule.similarity) * max(len(a), len(b)) + 1e-9) for a, b in both], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(edits_within(both, limits, rule.narrow))], schema=schema)

    both = pairs.join(texts.withColumnRenamed("words", "x"), "num").join(texts.select(F.col("num").alias("hub"), F.col("words").alias("y")), "hub")
    return both.select("num", "hub", "x", "y").mapInArrow(run, "num bigint, hub bigint, linked boolean")


def _confirmed(left: DataFrame, classes: DataFrame, docs: DataFrame, rule: OrderRule, work: Workspace) -> DataFrame:
    """The stored pairs (num, hub), which the bit maps have left, with `linked`."""
    sides = left.select("num").union(left.select("hub")).distinct()
    wanted = work.stored(classes.select("num", "same", "doc_id").join(sides, "num", "left_semi"), "wanted")
    texts = work.stored(_texts_of(docs, wanted), "pair-texts", (wanted,))
    return work.stored(verified(left, texts, rule), "checked-pairs", (left, texts))


def near_duplicates(docs: DataFrame, rule: OrderRule = OrderRule()) -> DataFrame:
    """doc_id, class_id, same, class_key, head: one row for each document; documents of one class are near copies.

    `class_id` is the least doc_id of the class, `same` tells exact copies within it; `class_key` names the
    class also where ids are missing or repeated, and `head` is its first document.
    """
    with Workspace(docs.sparkSession) as work:
        read = work.stored(word_classes(docs, rule), "word-classes")
        rows = work.stored(read.select("doc_id", "same"), "words-of-rows")
        classes = read.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
        # The number of a class is fixed by storing it; from here on it stands for the digest.
        classes = work.stored(classes.withColumn("num", F.monotonically_increasing_id()), "classes", (read,))
        buckets, pairs = bucketed(classes, work)
        checked = _confirmed(work.stored(possible(pairs, classes, rule), "pairs"), classes, docs, rule, work)
        first = work.stored(components(linked(checked), rule.max_rounds), "first-roots")
        others = work.stored(across(classes, buckets, first, rule, work).join(checked.select("num", "hub"), ["num", "hub"], "left_anti"), "other-pairs", (buckets,))
        more = _confirmed(others, classes, docs, rule, work)
        links = first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(linked(more))
        roots = components(links, rule.max_rounds)
        named = classes.select("num", "same", "doc_id").join(roots.withColumnRenamed("node", "num"), "num", "left")
        named = work.stored(named.select("same", "doc_id", F.coalesce("root", "num").alias("class_key")), "named")
        # A name is the least id; the key tells classes apart where ids are missing or repeated.
        # Both sides of the join are stored, so that the planner can split the key of a large class.
        heads = work.stored(named.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "same")).alias("head")), "heads")
        by_same = work.stored(named.join(heads, "class_key").select("same", "class_key", "head"), "class-names")
        found = rows.join(by_same, "same").select("doc_id", F.col("head.doc_id").alias("class_id"), "same", "class_key", "head")
        return work.kept(found, "near-duplicates")


def one_of_each(docs: DataFrame, rule: OrderRule = OrderRule()) -> DataFrame:
    """The rows of the documents with one row of each class: that of least doc_id, of repeated rows any one."""
    names = fresh(docs, "head_id", "head_same", "own_id", "own_same")
    head_id, head_same, own_id, own_same = names
    no_id = F.lit(-(1 << 63))
    found = near_duplicates(docs, rule)
    heads = stored(found.groupBy("class_key").agg(F.first("head").alias("head")).select(F.coalesce("head.doc_id", no_id).alias(head_id), F.col("head.same").alias(head_same)), "class-heads")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                _, _, words = terms(texts)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(_sames(words), pa.binary())], names=[*rows.schema.names, own_same])

    marked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(own_same, T.BinaryType())]))
    marked = marked.withColumn(own_id, F.coalesce(F.col("doc_id").cast("bigint"), no_id))
    rows = marked.join(heads, (F.col(own_id) == F.col(head_id)) & (F.col(own_same) == F.col(head_same)), "left_semi")
    return rows.dropDuplicates([own_id, own_same]).select(docs.columns)
