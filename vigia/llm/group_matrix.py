"""Documents that share at least 85 % of their word shingles, found through a token-group matrix.

A text is the set of its distinct runs of `words` words; tokens are 64-bit digests of such runs. Texts of
one set are one class and take part once.

1. **Groups.** Classes with the same first token of a global order (rare tokens first), or with another key in common (the least of
   their first tokens by other digests), meet in blocks; links found there are joined to components, so that families of copies are
   connected before the next step, and whatever this misses the next step finds. A group is at most `group_members` classes: of one component, or
   single classes with the same last token (the most common one: texts of one family share it).
2. **Matrix.** Stored are the tokens of each group, the union over its members, restricted to what a link
   cannot avoid: two linked sets share a token among the first n - ceil(0.85 n) + 1 of both. A class meets the groups that share such a token
   and hold a member of a fitting size and of a larger component (of equally large ones, that of greater number), so a
   few texts at the edge of a large family ask, and not the family. Tokens of one component only drop out before any join.
3. **Bound and opening.** Each class and each group's whole union also has a bit map with several places for each token (a long map
   folds onto a shorter one). Places of the class that the union lacks bound the overlap with every member from above. Only groups that
   can reach the needed overlap are opened: their members outside the class's component are compared, by their own maps and then exactly.
4. **Components** of both kinds of links.

How common a token is comes from counting the tokens met twice or more within a piece of the input; the
`common_tokens` most frequent ones are broadcast (8 bytes and a count each). Any order gives the same
links; this one keeps frequent passages out of the join. Token sets are made from the texts where they are
needed and stored for candidates only. Candidates are fetched through a Bloom filter of their ids.

Defined results: missing and empty texts have an empty set, no links and their own id as component.
Rows of one id, or without an id, are texts of their own: component_id is the least id of the rows linked,
missing only if none of them has an id. Copies of a row are in one component. An empty table gives an empty
result. Other columns are not read. Two different sets of one 64-bit digest are noticed by a second one and refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.durable import Workspace
from vigia.llm import idfilter
from vigia.llm.links import components
from vigia.llm.textkit import IN_WORD, chunks, grams, mixed, pieces, raw_bytes
from vigia.operators.lookup import lookup

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class JaccardRule:
    words: int = 4
    percent: int = 85
    group_members: int = 64
    group_tokens: int = 1 << 17  # a group or block is closed when its members have so many tokens together
    common_tokens: int = 1 << 18
    more_keys: int = 4  # keys besides the first token, by which links are searched before the matrix
    places: int = 8  # bits of a map for each token
    queries_per_task: int = 512  # classes that meet one group in one task

    def needed(self, n: np.ndarray) -> np.ndarray:
        """The least overlap of a set of n tokens with any set it links with."""
        return -(-self.percent * n // 100)

    def probed(self, n: np.ndarray) -> np.ndarray:
        """So many first tokens of a set meet as many of each set it links with."""
        return np.where(n > 0, n - self.needed(n) + 1, 0)


# -- sets of tokens ---------------------------------------------------------------


def token_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct tokens of all texts, one text after another, and where each text begins (one more than texts)."""
    data, offsets = raw_bytes(texts)
    found = pieces(_LOWER[data], offsets, IN_WORD)
    sizes = np.diff(found.first)
    docs, tokens = [], []
    for size in range(1, words + 1):
        at, digest = grams(found, size, seed=size)
        doc = found.doc[at]
        if size < words:  # the whole of a shorter text
            whole = sizes[doc] == size
            doc, digest = doc[whole], digest[whole]
        docs.append(doc)
        tokens.append(digest)
    doc, token = np.concatenate(docs), np.concatenate(tokens)
    order = np.lexsort((token, doc))
    doc, token = doc[order], token[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    doc, token = doc[new], token[new]
    return token, np.searchsorted(doc, np.arange(len(texts) + 1))


def _set_digests(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    n = np.diff(first)
    for seed in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        total = np.zeros(len(tokens) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mixed(tokens ^ np.uint64(seed)), out=total[1:])
            out.append(mixed(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _spans(first: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The positions that the chosen sets cover."""
    size = np.diff(first)[chosen]
    start = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(first[chosen] - start[:-1], size) + np.arange(start[-1])


def _maps(scrambled: np.ndarray, doc: np.ndarray, size: np.ndarray, rule: JaccardRule) -> pa.Array:
    """A bit map of each set: a power of two of places, at least `places` for each token."""
    width = (1 << np.ceil(np.log2(np.maximum(8, rule.places * size))).astype(np.int64)).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(width)])
    marks = np.zeros(start[-1], dtype=bool)
    marks[start[doc] + (scrambled & (width[doc] - 1).astype(np.uint64)).astype(np.int64)] = True
    packed = np.packbits(marks, bitorder="little")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(start // 8), pa.py_buffer(packed)]).cast(pa.binary())


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """The map with `width` bytes, each standing for all that fall on it."""
    return bits if len(bits) == width else np.bitwise_or.reduce(bits.reshape(-1, width), axis=0)


def most_common(bits: np.ndarray, n: int, other: np.ndarray) -> int:
    """The set of n tokens has at most so many in common with what the other map covers: each place of its own that the other lacks is a token it lacks."""
    width = min(len(bits), len(other))
    return n - int(np.bitwise_count(folded(bits, width) & ~folded(other, width)).sum())


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _described(docs: DataFrame, rule: JaccardRule) -> DataFrame:
    """doc_id, n, vertex, check of every row; and, on rows of their own, tokens met in several sets of a piece of the input."""
    kinds = [("doc_id", pa.int64()), ("n", pa.int64()), ("vertex", pa.int64()), ("check", pa.int64()), ("token", pa.int64()), ("met", pa.int64())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                tokens, first = token_sets(texts, rule.words)
                vertex, check = _set_digests(tokens, first)
                n = np.diff(first)
                none = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n), pa.array(vertex), pa.array(check), none, none], schema=schema)
                _, once = np.unique(vertex, return_index=True)
                token, met = np.unique(tokens[_spans(first, once)], return_counts=True)
                token, met = token[met > 1], met[met > 1]
                none = pa.nulls(len(token), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(token.view(np.int64)), pa.array(met)], schema=schema)

    return _source(docs).mapInArrow(run, ", ".join(f"{name} bigint" for name, _ in kinds))


def _common(described: DataFrame, work: Workspace, rule: JaccardRule) -> tuple[np.ndarray, np.ndarray]:
    """At most `common_tokens` tokens, those met most often, in order, with their counts."""
    met = work.stored(described.where("token is not null").groupBy("token").agg(F.sum("met").alias("met")), "met-tokens")
    step = F.floor(4 * F.log2("met"))
    room, least = rule.common_tokens, None
    for row in met.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # at most 4 steps for each power of two
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    found = met.where(step >= least).toPandas()
    tokens, counts = found["token"].to_numpy(np.int64).view(np.uint64), found["met"].to_numpy(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def _prefixes(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], rule: JaccardRule) -> DataFrame:
    """vertex, n, tokens, key, others, last, bits: the first tokens of each class in the global order, grouping keys, its last token, and its bit map."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    names = ["vertex", "n", "tokens", "key", "others", "last", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            for _, texts in chunks(batch):
                tokens, first = token_sets(texts, rule.words)
                vertex, _ = _set_digests(tokens, first)
                _, once = np.unique(vertex, return_index=True)
                once = once[np.diff(first)[once] > 0]
                size = np.diff(first)[once]
                tokens = tokens[_spans(first, once)]
                if not len(tokens):
                    continue
                doc = np.repeat(np.arange(len(once)), size)
                place = np.searchsorted(known, tokens)
                place[place == len(known)] = 0
                met = np.where(known[place] == tokens, counts[place], 0) if len(known) else np.zeros(len(tokens), np.uint64)
                scrambled = mixed(tokens)
                # Counts, then digests, as one number; equal numbers stay in the order of the tokens.
                order = np.lexsort(((np.minimum(met, 0xFFFF).astype(np.uint64) << np.uint64(48)) | (scrambled >> np.uint64(16)), doc))
                start = np.concatenate([[0], np.cumsum(size)])
                take = rule.probed(size)
                begin = np.concatenate([[0], np.cumsum(take)])
                head = order[np.repeat(start[:-1] - begin[:-1], take) + np.arange(begin[-1])]
                others = [np.minimum.reduceat(mixed(tokens[head] ^ mixed(np.array([seed]))[0]), begin[:-1]) for seed in range(1, rule.more_keys + 1)]
                others = np.stack(others, axis=1).ravel() if others else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(vertex[once]), pa.array(size), _lists(tokens[head], take), pa.array(tokens[head[begin[:-1]]].view(np.int64)), _lists(others, np.full(len(size), rule.more_keys)), pa.array(tokens[order[start[1:] - 1]].view(np.int64)), _maps(scrambled, doc, size, rule)], names=names)

    found = _source(docs).select("text").mapInArrow(run, "vertex bigint, n bigint, tokens array<bigint>, key bigint, others array<bigint>, last bigint, bits binary")
    return found.dropDuplicates(["vertex"])


def _fetched(docs: DataFrame, wanted: DataFrame, rule: JaccardRule) -> DataFrame:
    """vertex, n, tokens (sorted) of the wanted classes (vertex, doc_id), from their texts."""
    shared = docs.sparkSession.sparkContext.broadcast(idfilter.build(wanted.select("doc_id").where("doc_id is not null")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            passed = idfilter.contains(shared.value, ids.fill_null(0).to_numpy(zero_copy_only=False)) | ids.is_null().to_numpy(zero_copy_only=False)
            for _, texts in chunks(batch.filter(pa.array(passed))):
                tokens, first = token_sets(texts, rule.words)
                vertex, _ = _set_digests(tokens, first)
                _, once = np.unique(vertex, return_index=True)
                size = np.diff(first)[once]
                yield pa.RecordBatch.from_arrays([pa.array(vertex[once]), pa.array(size), _lists(tokens[_spans(first, once)], size)], names=["vertex", "n", "tokens"])

    found = _source(docs).mapInArrow(run, "vertex bigint, n bigint, tokens array<bigint>")
    return found.join(wanted.select("vertex"), "vertex", "left_semi").dropDuplicates(["vertex"])


# -- groups -------------------------------------------------------------------------


def _blocks(members: DataFrame, key: str, chained: bool, rule: JaccardRule) -> DataFrame:
    """The members (key, vertex, n) with `block`: neighbours of one key and like size, at most `group_members` of them.

    Rows are range-partitioned by key, size and vertex, so a popular key spreads over tasks. With `chained`
    the last member of a block is the first of the next one of its key, too, and members on their own are left out.
    """
    names = [*members.columns, "block"]
    at_key, at_n = members.columns.index(key), members.columns.index("n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, open_key, count, tokens, last = TaskContext.get().partitionId() << 40, None, 0, 0, None
        for batch in batches:
            out, where = [], []  # rows of the batch, or None for the last row of the batch before
            keys, sizes = batch.column(at_key).to_pylist(), batch.column(at_n).to_pylist()
            previous = last
            for i, (own, n) in enumerate(zip(keys, sizes, strict=True)):
                if own != open_key or count >= rule.group_members or tokens + n > rule.group_tokens:
                    chain = chained and own == open_key
                    block, count, tokens = block + 1, 0, 0
                    if chain:
                        out.append(i - 1)
                        where.append(block)
                        count, tokens = 1, sizes[i - 1] if i else previous[at_n]
                out.append(i)
                where.append(block)
                open_key, count, tokens = own, count + 1, tokens + n
            last = [c[batch.num_rows - 1].as_py() for c in batch.columns] if batch.num_rows else last
            columns = []
            for j, column in enumerate(batch.columns):
                values = column.to_pylist()
                columns.append(pa.array([values[i] if i >= 0 else previous[j] for i in out], column.type))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(where, pa.int64())], names=names)

    schema = ", ".join([*(f"{c} bigint" for c in members.columns), "block bigint"])
    return members.repartitionByRange(key, "n", "vertex").sortWithinPartitions(key, "n", "vertex").mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Consecutive rows with equal keys; token lists and bit maps as numpy arrays."""
    held: list[dict] = []
    for batch in batches:
        columns = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if name == "tokens":
                flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
                columns[name] = [flat[a:b].copy() for a, b in zip(ends[:-1], ends[1:], strict=True)]  # no views of a batch that goes
            elif name == "bits":
                columns[name] = [np.frombuffer(x, dtype=np.uint8) for x in column.to_pylist()]
            else:
                columns[name] = column.to_pylist()
        for row in zip(*columns.values(), strict=True):
            made = dict(zip(columns, row, strict=True))
            if held and any(held[0][k] != made[k] for k in keys):
                yield held
                held = []
            held.append(made)
    if held:
        yield held


def _linked(common: np.ndarray | int, n: np.ndarray | int, m: np.ndarray | int, percent: int):
    return 100 * common >= percent * (n + m - common)


def links_within(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets: pairs of places."""
    if len(sets) == 2:
        both = np.concatenate(sets)
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return [(1, 0)] if _linked(common, len(sets[0]), len(sets[1]), percent) else []
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, met = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = met > 1
    place = np.cumsum(several) - 1
    held = several[column]
    matrix = np.zeros((len(sets), int(several.sum())), dtype=np.float32)
    matrix[owner[held], place[column[held]]] = 1
    common = (matrix @ matrix.T).astype(np.int64)
    hit = np.argwhere(np.tril(_linked(common, size[:, None], size[None, :], percent), -1))
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in hit.tolist():
        a, b = top(i), top(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _promising(blocks: DataFrame, prefixes: DataFrame, rule: JaccardRule) -> DataFrame:
    """block, vertex: the members that their bit maps allow to link with another one of their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, vertex = [], []
        for rows in _runs(batches, "block"):
            rows.sort(key=lambda r: (r["n"], r["vertex"]))
            needed = rule.needed(np.array([r["n"] for r in rows]))
            kept = [False] * len(rows)
            for j in range(1, len(rows)):
                for i in range(j - 1, -1, -1):
                    if rows[i]["n"] < needed[j]:
                        break
                    if kept[i] and kept[j]:
                        continue
                    short, long = rows[i], rows[j]
                    if most_common(short["bits"], short["n"], long["bits"]) >= needed[j] and most_common(long["bits"], long["n"], short["bits"]) >= needed[j]:
                        kept[i] = kept[j] = True
            for row, one in zip(rows, kept, strict=True):
                if one:
                    block.append(row["block"])
                    vertex.append(row["vertex"])
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(vertex, pa.int64())], names=["block", "vertex"])

    joined = blocks.select("block", "vertex").join(prefixes.select("vertex", "n", "bits"), "vertex")
    return joined.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block bigint, vertex bigint")


def _links_in_blocks(blocks: DataFrame, sets: DataFrame, rule: JaccardRule) -> DataFrame:
    """a, b: links between classes of one block, enough to connect them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for rows in _runs(batches, "block"):
            for i, j in links_within([r["tokens"] for r in rows], rule.percent) if len(rows) > 1 else []:
                a.append(rows[i]["vertex"])
                b.append(rows[j]["vertex"])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    joined = blocks.select("block", "vertex").join(sets.select("vertex", "tokens"), "vertex")
    return joined.repartition("block").sortWithinPartitions("block", "vertex").mapInArrow(run, "a bigint, b bigint")


# -- matrix -------------------------------------------------------------------------


def _passing(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value is in `wanted` (one column), thinned by a filter before the exact join."""
    shared = rows.sparkSession.sparkContext.broadcast(idfilter.build(wanted))
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(idfilter.contains(shared.value, batch.column(at).to_numpy(zero_copy_only=False))))

    return rows.mapInArrow(run, rows.schema).join(wanted, column, "left_semi")


def _candidates(prefixes: DataFrame, grouped: DataFrame, work: Workspace, rule: JaccardRule) -> DataFrame:
    """vertex, comp, block: classes and the groups that may hold a link to another component."""
    percent = rule.percent
    cells = grouped.join(prefixes.select("vertex", "tokens"), "vertex").select("vertex", "comp", "many", "block", "n", F.explode("tokens").alias("token"))
    cells = work.stored(cells, "matrix-cells")
    between = cells.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    between = work.stored(between.select("token"), "matrix-tokens")
    shared = work.stored(_passing(cells, "token", between), "matrix", (cells,))
    columns = shared.groupBy("token", F.col("block").alias("group")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.struct("many", "comp")).alias("top"))
    fits = (percent * F.col("least") <= 100 * F.col("n")) & (100 * F.col("most") >= percent * F.col("n"))
    met = shared.select("token", "vertex", "comp", "many", "n").join(columns, "token").where(fits & (F.struct("many", "comp") < F.col("top")))
    return met.select("vertex", "comp", F.col("group").alias("block")).distinct()


def _qualifying(candidates: DataFrame, grouped: DataFrame, prefixes: DataFrame, work: Workspace, rule: JaccardRule) -> DataFrame:
    """block, salt, role, vertex, comp: groups to be opened, with the classes that ask (role 1) and the members they may link with (role 0).

    A group that very many classes meet is dealt out, with its members, to several tasks.
    """
    salts = candidates.groupBy("block").agg(F.count("*").alias("n_rows")).withColumn("salts", F.expr(f"1 + n_rows div {rule.queries_per_task}").cast("int"))
    salts = work.stored(salts, "group-queries")
    queries = lookup(candidates, salts, ["block"], "n_rows").select(
        "block", F.pmod(F.xxhash64("vertex"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), "vertex", "comp")
    members = grouped.join(salts.drop("n_rows"), "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), "vertex", "comp")
    rows = queries.unionByName(members).join(prefixes.select("vertex", "n", "bits"), "vertex")
    percent = rule.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _runs(batches, "block", "salt"):
            members = [r for r in found if r["role"] == 0]
            width = min(len(r["bits"]) for r in members)
            union = np.bitwise_or.reduce([folded(r["bits"], width) for r in members])
            asked: set[int] = set()
            kept = []
            for query in found[len(members) :]:
                n, bits = query["n"], query["bits"]
                if most_common(bits, n, union) < -(-percent * n // 100):
                    continue  # no member can share enough: the group stays closed
                some = False
                for i, member in enumerate(members):
                    m = member["n"]
                    needed = -(-percent * (n + m) // (100 + percent))
                    if member["comp"] != query["comp"] and needed <= min(n, m) and most_common(bits, n, member["bits"]) >= needed and most_common(member["bits"], m, bits) >= needed:
                        asked.add(i)
                        some = True
                if some:
                    kept.append(query)
            kept += [members[i] for i in asked]
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("block", "salt", "role", "vertex", "comp")} for r in kept], schema=_OPENED)

    return rows.repartition("block", "salt").sortWithinPartitions("block", "salt", "role").mapInArrow(run, "block bigint, salt int, role int, vertex bigint, comp bigint")


_OPENED = pa.schema([("block", pa.int64()), ("salt", pa.int32()), ("role", pa.int32()), ("vertex", pa.int64()), ("comp", pa.int64())])


def _links_across(opened: DataFrame, sets: DataFrame, rule: JaccardRule) -> DataFrame:
    """a, b: components of which a class of one links with a class of the other, from opened groups."""
    rows = opened.join(sets.select("vertex", "tokens"), "vertex")
    percent = rule.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for found in _runs(batches, "block", "salt"):
            members = [r for r in found if r["role"] == 0]
            size = np.array([len(r["tokens"]) for r in members])
            comp = np.array([r["comp"] for r in members])
            whole, owner = np.concatenate([r["tokens"] for r in members]), np.repeat(np.arange(len(size)), size)
            for query in found[len(members) :]:
                own = query["tokens"]
                place = np.minimum(np.searchsorted(own, whole), len(own) - 1)
                common = np.bincount(owner[own[place] == whole], minlength=len(size))
                hits = _linked(common, size, len(own), percent) & (comp != query["comp"])
                for of in np.unique(comp[hits]).tolist():
                    a.append(query["comp"])
                    b.append(of)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition("block", "salt").sortWithinPartitions("block", "salt", "role", "vertex").mapInArrow(run, "a bigint, b bigint").distinct()


def _rooted(frame: DataFrame, column: str, roots: DataFrame) -> Column:
    """The frame with `column` replaced by its root where it has one."""
    named = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return frame.join(named, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def linked_documents(docs: DataFrame, rule: JaccardRule = JaccardRule()) -> DataFrame:
    """doc_id, n_shingles, component_id, vertex: one row for each row of the documents; `vertex` tells equal sets."""
    with Workspace(docs.sparkSession) as work:
        described = work.stored(_described(docs, rule), "described")
        rows = described.where("n is not null").select("doc_id", "n", "vertex", "check")
        classes = work.stored(rows.where("n > 0").groupBy("vertex").agg(
            F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.count("*").alias("n_rows"), (F.min("check") != F.max("check")).alias("clash")), "classes")
        if not classes.where("clash").isEmpty():
            raise ValueError("two sets of shingles have one digest: change the seeds of _set_digests")
        prefixes = work.stored(_prefixes(docs, _common(described, work, rule), rule), "prefixes")

        # Groups: classes with a key in common.
        keys = work.stored(prefixes.select("vertex", "n", F.explode(F.array_distinct(F.concat(F.array("key"), "others"))).alias("key")), "keys")
        popular = work.stored(keys.groupBy("key").agg(F.count("*").alias("n_rows")).where("n_rows > 1").withColumn("met", F.lit(True)), "popular-keys")
        members = lookup(keys, popular, ["key"], "n_rows").where("met").select("key", "vertex", "n")
        blocks = work.stored(_blocks(members, "key", True, rule), "blocks", (keys, popular))
        blocks = work.stored(_promising(blocks, prefixes, rule), "promising", (blocks,))
        wanted = work.stored(classes.join(blocks.select("vertex").distinct(), "vertex", "left_semi").select("vertex", "doc_id"), "wanted")
        roots = components(work.stored(_links_in_blocks(blocks, _fetched(docs, wanted, rule), rule), "block-links", (blocks, wanted)))
        comps = work.stored(_rooted(prefixes.select(F.col("vertex").alias("comp"), "vertex", "n", "last"), "comp", roots), "first-components")
        sizes = work.stored(comps.groupBy("comp").agg(F.count("*").alias("many"), F.count("*").alias("n_rows")), "component-sizes")
        alike = F.when(F.col("many") > 1, F.col("comp")).otherwise(F.col("last")).alias("alike")
        grouped = lookup(comps, sizes, ["comp"], "n_rows").select(alike, "vertex", "n", "comp", "many")
        grouped = work.stored(_blocks(grouped, "alike", False, rule).drop("alike"), "groups")

        # Matrix: classes against the groups that hold other components.
        candidates = work.stored(_candidates(prefixes, grouped, work, rule), "candidates")
        opened = work.stored(_qualifying(candidates, grouped, prefixes, work, rule), "qualifying", (candidates, prefixes))
        wanted = work.stored(classes.join(opened.select("vertex").distinct(), "vertex", "left_semi").select("vertex", "doc_id"), "wanted")
        roots = components(work.stored(_links_across(opened, _fetched(docs, wanted, rule), rule), "group-links", (wanted, opened)))

        # Names: the least id of a component, brought back to the rows; a class or a component may hold any share of them.
        final = work.stored(_rooted(comps, "comp", roots).join(classes.select("vertex", "doc_id", "n_rows"), "vertex"), "components")
        names = work.stored(final.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_classes")), "names")
        named = work.stored(lookup(final, names, ["comp"], "n_classes").select("vertex", "n_rows", "component_id"), "named")
        linked = lookup(rows.where("n > 0"), named, ["vertex"], "n_rows").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "vertex")
        alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "vertex")
        return work.kept(linked.unionByName(alone), "linked-documents")
