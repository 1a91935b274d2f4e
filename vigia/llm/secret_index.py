"""Secrets by regular expressions behind a trigram index, in DataFrame operations only.

From each rule's expression a Boolean query over trigrams is derived: every
match must contain the trigrams of one of the query's alternatives. The index
has, for each block of documents and each trigram that some query asks for, the
ids of the block's documents that have it. A query intersects postings within
an alternative and unites alternatives; documents that come out are candidates,
and only they are searched with the expression. A rule without a mandatory
trigram is searched in every document.

Matches are leftmost and do not overlap, rule by rule, and those whose measured
part is too short are dropped. Places are in characters: the pieces between
matches (`split`) and the matches (`regexp_extract_all`) alternate, so their
lengths add up to the places.

Cases: a null text is empty and has no secrets; a repeated or null doc_id shares
its candidate marks with its namesakes, which costs a search and changes no
result; repeated rows are each searched; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from vigia.durable import stored


@dataclass(frozen=True)
class SecretRule:
    """`min_length` holds for the match, or for its group `measured` if that is not 0.

    `scan` is an expression with the same sufficient matches that the engine searches faster, if there is one.
    """

    kind: str
    regex: str
    min_length: int = 0
    measured: int = 0
    scan: str | None = None


#: The three rules that the results count.
BASE_RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    SecretRule("access", r"AKIA[A-Z0-9]+", 20),
    # Runs of 24 and more are the sufficient ones among all runs.
    SecretRule("hex", r"[0-9a-f]+", 24, 0, r"[0-9a-f]{24,}"),
)

#: Public formats of keys, as their issuers document them.
MORE_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35}"),
)

RULES = BASE_RULES + MORE_RULES
_MOST = 64


def trigram_query(regex: str) -> frozenset[frozenset[str]]:
    """Alternatives of trigrams (lower-cased): a text with a match has all trigrams of at least one.

    The empty set means that nothing is mandatory. Sequences of characters are
    enumerated while they stay few; what cannot be enumerated ends a sequence.
    """
    flags = re.IGNORECASE if regex.startswith("(?i)") else 0
    tree = parser.parse(regex.removeprefix("(?i)"), flags)
    found = {frozenset(_trigrams(strings)) for strings in _sequences(tree)}
    if not found or any(not f for f in found):
        return frozenset()
    return frozenset(f for f in found if not any(g < f for g in found))


def _trigrams(strings: tuple[str, ...]) -> set[str]:
    return {s[i : i + 3].lower() for s in strings for i in range(len(s) - 2)}


def _sequences(tree) -> list[tuple[str, ...]]:
    """For each way through the expression: the mandatory strings on it."""
    ways: list[tuple[str, ...]] = [("",)]

    def then(options: list[tuple[str, ...]]) -> None:
        nonlocal ways
        if len(ways) * len(options) > _MOST:  # too many ways: the part stays open
            options = [("", "")]
        ways = list(dict.fromkeys((*w[:-1], w[-1] + o[0], *o[1:]) for w, o in product(ways, options)))

    for kind, value in tree:
        if kind is op.LITERAL:
            then([(chr(value),)])
        elif kind is op.SUBPATTERN:
            then(_sequences(value[3]))
        elif kind is op.BRANCH:
            then([way for part in value[1] for way in _sequences(part)])
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            then([(chr(v),) for _, v in value])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] == 0 and value[1] == 1:
            then([("",), *_sequences(value[2])])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            own = _sequences(value[2])
            for _ in range(min(value[0], 3)):
                then(own)
            then([("", "")])
        else:
            then([("", "")])
    return ways


def _needed(rules: tuple[SecretRule, ...]) -> dict[str, frozenset[frozenset[str]]]:
    return {r.kind: trigram_query(r.regex) for r in rules}


def postings(docs: DataFrame, trigrams: list[str], block_docs: int) -> DataFrame:
    """block, trigram, ids: the inverted index, in blocks of about `block_docs` documents."""
    low = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # One projection: the lower-cased text is made once for all trigrams.
    has = F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), has.alias("has")).select("doc_id", F.explode(F.array_compact("has")).alias("trigram"))
    blocks = F.greatest(F.lit(1), F.ceil(docs.count() / F.lit(block_docs)))
    block = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    return rows.groupBy(block.alias("block"), "trigram").agg(F.collect_set(F.coalesce("doc_id", F.lit(_NO_ID))).alias("ids"))


_NO_ID = -(1 << 63)  # stands for a missing id within the index


def candidates(index: DataFrame, queries: dict[str, frozenset[frozenset[str]]]) -> DataFrame:
    """of_id, kinds: the documents whose trigrams answer a rule's query."""
    wanted = sorted({t for q in queries.values() for way in q for t in way})
    by_block = index.groupBy("block").agg(*[F.flatten(F.collect_list(F.when(F.col("trigram") == t, F.col("ids")))).alias(f"t{i}") for i, t in enumerate(wanted)])
    column = {t: F.col(f"t{i}") for i, t in enumerate(wanted)}
    answers = []
    for kind, query in queries.items():
        if query:
            ways = [reduce(F.array_intersect, [column[t] for t in sorted(way)]) for way in sorted(query, key=sorted)]
            answers.append(by_block.select(F.explode(reduce(F.array_union, ways)).alias("of_id"), F.lit(kind).alias("kind")))
    return reduce(DataFrame.unionAll, answers).groupBy("of_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: SecretRule, order: int) -> Column:
    """The rule's matches as an array of start, place of the rule in the list, end, kind."""
    scan = rule.scan or rule.regex
    # Zipped, both lists are made once; the last piece has no match behind it.
    parts = F.arrays_zip(F.split(text, scan, -1).alias("gap"), F.regexp_extract_all(text, F.lit(scan), F.lit(0)).alias("match"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["match"])
        measured = F.length(F.regexp_extract(part["match"], rule.regex, rule.measured))
        one = F.array(F.struct(begin.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        found = F.when(measured >= rule.min_length, F.concat(state["out"], one)).otherwise(state["out"])
        return F.when(part["match"].isNull(), state).otherwise(F.struct(end.alias("at"), found.alias("out")))

    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.when(text.rlike(scan), F.aggregate(parts, start, step, lambda s: s["out"])).otherwise(none)


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, block_docs: int = 4096) -> DataFrame:
    """doc_id, spans (array of start, order, end, kind; ascending by start, then by the rule's place in the list)."""
    queries = _needed(rules)
    trigrams = sorted({t for q in queries.values() for way in q for t in way})
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if trigrams:
        index = stored(postings(source, trigrams, block_docs), "trigram-index")
        marks = stored(candidates(index, queries), "secret-candidates")
        rows = source.join(marks, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("of_id"), "left").drop("of_id")
    else:
        rows = source.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    each = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, order)
        each.append(F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none) if queries[rule.kind] else spans)
    return rows.select("doc_id", F.array_sort(F.flatten(F.array(*each))).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(order: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["order"] == order)).cast("bigint")


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    base = F.filter("spans", lambda s: s["order"] < len(BASE_RULES))
    counts = [_count(order).alias(f"n_{rule.kind}") for order, rule in enumerate(BASE_RULES)]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
