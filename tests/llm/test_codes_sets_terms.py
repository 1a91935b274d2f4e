"""Vector codes, linked sets and the source audit against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import odd, prose, rows, table

from vigia.llm import group_matrix, idfilter, orchard_codes, source_audit
from vigia.llm.links import components

# -- vector codes -------------------------------------------------------------------


def plain_codes(data, rule):
    """data: (vec_id, vector, label); every part measured against every entry."""
    kept = [(i, [math.floor(rule.scale * x) for x in v], label) for i, v, label in data
            if v is not None and v and len(v) % rule.parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // rule.parts
    parts = [[r[1][p * width : (p + 1) * width] for p in range(rule.parts)] for r in kept]
    books = [[row[p] for row in parts[: rule.entries]] for p in range(rule.parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))

    for _ in range(rule.rounds):
        for p, book in enumerate(books):
            own = {}
            for row in parts:
                own.setdefault(nearest(row[p], book)[1], []).append(row[p])
            for i, members in own.items():
                book[i] = [sum(c) // len(members) for c in zip(*members)]
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    found = [[nearest(row[p], books[p]) for p in range(rule.parts)] for row in parts]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[2]] += e
    return [(r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], sha) for r, f, e in zip(kept, found, errors)]


def ordered(rows_):
    return sorted(rows_, key=lambda r: tuple((x is None, 0 if x is None else x) for x in r))


def vector_rows(seed, n, dim, spread):
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(dim)] for _ in range(9)]
    out = [(i * 3, [c + draw.gauss(0, spread) for c in draw.choice(centres)], draw.choice([1, 2, None])) for i in range(n)]
    return out + [out[4], out[5], (out[7][0], out[9][1], 1)]


VECTORS = "vec_id bigint, embedding array<double>, label int"


@pytest.mark.parametrize("spread", [0.3, 0.002])
def test_codes_equal_measuring_everything(spark, spread):
    rule = orchard_codes.CodeRule(parts=4, entries=16, batch_parts=64)
    data = vector_rows(3, 150, 12, spread)
    data += [(None, data[0][1], 1), (1, None, 1), (2, [0.1] * 11 + [None], 1), (2, [0.1] * 11 + [math.nan], 2), (2, [math.inf] * 12, 2), (5, [], 1), (6, [0.5] * 8, 1), (7, [0.5] * 7, 1)]
    out = orchard_codes.code_digest(spark.createDataFrame(data, VECTORS).repartition(3), rule)
    assert ordered(map(tuple, out.collect())) == ordered(plain_codes(data, rule))


def test_codes_of_few_equal_and_no_vectors(spark):
    rule = orchard_codes.CodeRule(parts=2, entries=8)
    for data in ([(4, [0.25, -0.001], None)], [(i, [1.0, 2.0], i % 2) for i in range(30)], [(i, [float(i % 3), 0.0], 1) for i in range(5)]):
        out = orchard_codes.code_digest(spark.createDataFrame(data, VECTORS), rule)
        assert ordered(map(tuple, out.collect())) == ordered(plain_codes(data, rule))
    empty = orchard_codes.code_digest(spark.createDataFrame([], VECTORS), rule)
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    assert orchard_codes.code_digest(spark.createDataFrame([(1, None, 1)], VECTORS), rule).count() == 0
    huge = orchard_codes.code_digest(spark.createDataFrame([(1, [3e38, 0.0], 1), (2, [0.0, 0.0], 1)], VECTORS), rule)
    assert huge.count() == 2


def test_codes_keep_other_columns(spark):
    rule = orchard_codes.CodeRule(parts=2, entries=4)
    frame = spark.createDataFrame([(1, [0.0, 1.0], 1, "a", "b"), (2, [1.0, 1.0], 1, "c", "d")], VECTORS + ", code string, error string")
    out, names = orchard_codes.encode(frame, orchard_codes.fit(frame, rule), rule)
    assert names == ["_code", "_error"] and sorted(r.code for r in out.collect()) == ["a", "c"]


def test_search_visits_few_entries():
    draw = np.random.default_rng(1)
    entries = draw.integers(-500, 500, (64, 4))
    points = (entries[draw.integers(0, 64, 4000)] + draw.integers(-9, 9, (4000, 4))).astype(np.int64)
    search = orchard_codes.OrchardSearch(orchard_codes.Codebooks(entries.astype(np.int64), 1))
    best, gap = search.nearest(points, np.zeros(4000, dtype=np.int64))
    whole = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (best == whole.argmin(axis=1)).all() and (gap == whole.min(axis=1)).all()
    assert (np.diff(search.gap, axis=1) >= 0).all()  # lists are sorted by distance


# -- linked sets -----------------------------------------------------------------------


def plain_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(data, percent=85):
    sets = [plain_set(r[1]) for r in data]
    root = list(range(len(data)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return [(r[0], len(s), least.get(top(i))) for i, (r, s) in enumerate(zip(data, sets))]


def family(seed, members, words, changed):
    """Texts of one template, each with `changed` of its words replaced."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(3000)}" for _ in range(words)]
    out = []
    for _ in range(members):
        own = list(base)
        for _ in range(draw.randrange(changed + 1)):
            own[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(own[draw.randrange(3) : words - draw.randrange(3)]))
    return out


def linked_rows(frame):
    return ordered((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


@pytest.mark.parametrize("rule", [group_matrix.JaccardRule(), group_matrix.JaccardRule(group_members=3, group_tokens=400, common_tokens=16, queries_per_task=2)])
def test_links_equal_all_pairs(spark, rule):
    _, data = odd(spark)
    texts = [t for seed in range(12) for t in family(seed, 9, 40 + 25 * seed, 1 + seed // 2)]
    passage = prose(5, 8)
    texts += [f"{prose(200 + i, 2)} {passage}" for i in range(30)] + [passage] * 3 + [prose(7, 6).upper(), prose(7, 6), "a b c", "A  b\nc", "a b c d", "a b"]
    data = data + rows(texts, 1000) + rows([texts[0], texts[40]], 5)
    out = group_matrix.linked_documents(table(spark, data, extra=True), rule)
    expected = ordered(plain_components(data))
    assert linked_rows(out) == expected
    assert len({c for _, n, c in expected if n}) < len([1 for _, n, _ in expected if n]) - 40


def test_links_at_the_border(spark):
    """Sets of 37 tokens with 34 in common (34 / 40 = 0.85) link; one token less does not."""
    words = [f"w{i}" for i in range(200)]
    same = " ".join(words[:40])  # 37 runs of four words
    at = " ".join([*words[:37], "x", "y", "z"])  # shares the first 34
    below = " ".join([*words[:36], "p", "q", "r", "s"])
    data = rows([same, at, below])
    out = group_matrix.linked_documents(table(spark, data), group_matrix.JaccardRule())
    assert linked_rows(out) == ordered(plain_components(data))
    assert [r.component_id for r in sorted(out.collect(), key=lambda r: r.doc_id)] == [0, 0, 2]


def test_links_without_documents(spark):
    assert group_matrix.linked_documents(table(spark, [])).count() == 0
    out = group_matrix.linked_documents(table(spark, rows([None, "", " \n"])))
    assert linked_rows(out) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_a_large_family_meets_in_blocks_only(spark):
    """A thousand texts of one template: the matrix has little to open once blocks have linked them."""
    data = rows(family(77, 1000, 120, 2))
    out = group_matrix.linked_documents(table(spark, data), group_matrix.JaccardRule())
    assert linked_rows(out) == ordered(plain_components(data))


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 60), (60, 70), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()))
    assert found == {**{i: 0 for i in range(1, 51)}, 70: 60, 100: 60}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_id_filter(spark):
    values = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    held = idfilter.build(spark.createDataFrame([(int(v),) for v in values[:2500]], "v bigint"))
    passed = idfilter.contains(held, values)
    assert passed[:2500].all() and passed[2500:].mean() < 0.05
    assert not idfilter.contains(idfilter.build(spark.createDataFrame([], "v bigint")), values).any()


# -- source audit -----------------------------------------------------------------------


def plain_audit(data, rule):
    """data: (doc_id, text, lang, source, n_chars)."""
    docs, uses = {}, {}
    groups = sorted({(r[2] or "", r[3] or "") for r in data})
    for _, text, lang, source, _ in data:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        docs.setdefault(lang or "", Counter()).update(set(words))
        uses.setdefault((lang or "", source or ""), Counter()).update(words)
    out = []

    def share(count, total, terms):
        return 1 + rule.scale * (count + rule.smoothing) // (total + rule.smoothing * terms) if terms else 0

    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= rule.min_docs)
        peers = [g for g in groups if g[0] == lang]
        totals = {g: sum(uses[g][t] for t in kept) for g in peers}
        own = (lang, source)
        found = []
        for other in peers:
            if other != own:
                found.append(("pair", other[1], sum(abs(share(uses[own][t], totals[own], len(kept)) - share(uses[other][t], totals[other], len(kept))) for t in kept)))
        for t in kept:
            everywhere = sum(uses[g][t] for g in peers)
            gain = share(uses[own][t], totals[own], len(kept)) - share(everywhere, sum(totals.values()), len(kept))
            if uses[own][t] and gain > 0:
                found.append(("term", t, gain))
        for part in ("pair", "term"):
            ranked = sorted((f for f in found if f[0] == part), key=lambda f: (-f[2], f[1].encode()))
            out += [(lang, source, *f, i + 1) for i, f in enumerate(ranked) if part == "pair" or i < rule.top_terms]
    return sorted(out)


def audit_data():
    draw = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfgmnpré漢" for b in ("a", "e", "io", "Ú")]
    data = []
    for i in range(160):
        lang, source = draw.choice(["de", "en", "", None]), draw.choice(["a", "b", "c", None, "Ünï"])
        own = words[:30] if source == "a" else words[12:]
        data.append((i, " ".join(draw.choice(own) + draw.choice(["", ".", "'S", "9x"]) for _ in range(draw.randrange(40))), lang, source, 1))
    return data + [(5, None, "de", "d", 1), (6, "", "xx", "only", 0), (None, "Word", "yy", "a", 4), (None, None, "yy", "b", None), data[3]]


@pytest.mark.parametrize("bits", [64, 4])
def test_audit(spark, bits):
    rule = source_audit.AuditRule(min_docs=9, top_terms=6, digest_bits=bits, block_cells=20, held_rows=50)
    data = audit_data()
    out = source_audit.audit(table(spark, data, extra=True), rule)
    assert sorted(map(tuple, out.collect())) == plain_audit(data, rule)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_audit_of_odd_texts(spark):
    frame, data = odd(spark, extra=True)
    rule = source_audit.AuditRule(min_docs=2)
    assert sorted(map(tuple, source_audit.audit(frame, rule).collect())) == plain_audit(data, rule)
    assert source_audit.audit(table(spark, []), rule).count() == 0


def test_strings_are_not_shuffled_for_the_counts(spark):
    """Counting shuffles a group and a fixed-width digest; only digests that collide travel with their string."""
    plan = source_audit.term_counts(table(spark, audit_data()), source_audit.AuditRule())._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(lang" in plan and "term" not in plan.split("hashpartitioning")[1].split("\n")[0]
