"""Line dedup, line labels and repeated units against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD_TEXTS, odd, prose, rows, table

from vigia.llm import line_bloom, line_crf, textkit, unit_dedup

SPACES = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain_lines(data, rule, first_stays=False):
    texts = [t or "" for _, t, *_ in data]
    count = Counter(k for t in texts for k in {key_of(x) for x in t.split("\n")})
    often = {k for k, n in count.items() if n >= rule.min_docs and len(k) >= rule.min_key_chars}
    out = []
    for (doc_id, *_), t in zip(data, texts):
        lines = t.split("\n")
        kept = [x for x in lines if key_of(x) not in often]
        out.append((doc_id is not None, doc_id or 0, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("bits", [1 << 20, 64])  # 64 bits are full at once: everything becomes a suspect
def test_repeated_lines_go(spark, bits):
    draw = random.Random(3)
    common = ["Common LINE", " common line\t", "ÄÖ common", "x", ""]
    texts = ["\n".join(draw.choice([*common, f"own {i} {j}"]) for j in range(draw.randrange(1, 9))) for i in range(60)]
    odd_docs, odd_data = odd(spark, extra=True)
    data = odd_data + rows(texts, 100)
    docs = odd_docs.unionByName(table(spark, rows(texts, 100), extra=True))
    for rule in (line_bloom.LineRule(min_docs=10, bits=bits), line_bloom.LineRule(min_docs=3, min_key_chars=2, bits=bits)):
        out, (n_lines, n_dropped, kept) = line_bloom.drop_repeated_lines(docs, rule)
        got = sorted((r.doc_id is not None, r.doc_id or 0, r[n_lines], r[n_dropped], r[kept]) for r in out.collect())
        assert got == plain_lines(data, rule)
        assert set(docs.columns) < set(out.columns)


def test_first_occurrence_can_stay(spark):
    docs = table(spark, rows(["same\nown 0", "own 1\nSame\nsame", "same"]))
    out, (_, _, kept) = line_bloom.drop_repeated_lines(docs, line_bloom.LineRule(min_docs=2, keep_first=True, bits=1 << 12))
    assert {r.doc_id: r[kept] for r in out.collect()} == {0: "same\nown 0", 1: "own 1", 2: ""}


def test_filters_never_miss_a_repeat():
    rule = line_bloom.LineRule(bits=1 << 12)
    one, two = line_bloom.TwoFilters(rule), line_bloom.TwoFilters(rule)
    values = textkit.mixed(np.arange(400, dtype=np.uint64))
    one.add(values[:200])
    one.add(values[150:200])
    two.add(values[180:])
    once, twice = line_bloom._merge((one.once.tobytes(), one.twice.tobytes()), (two.once.tobytes(), two.twice.tobytes()))
    found = line_bloom._has(np.frombuffer(twice, np.uint8), line_bloom.positions(values, rule))
    assert found[150:200].all() and found.mean() < 0.9


def test_digest_of_lines_of_an_empty_table(spark):
    assert line_bloom.line_digest(table(spark, []), line_bloom.LineRule(bits=1 << 12)).count() == 0
    (r,) = line_bloom.line_digest(table(spark, rows([None])), line_bloom.LineRule(bits=1 << 12)).collect()
    assert (r.n_lines, r.n_dropped, r.kept_sha256) == (1, 0, hashlib.sha256(b"").hexdigest())


def plain_base(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_base_rules(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("ab#") for _ in range(draw.randrange(80))) for _ in range(60)]
    texts += ["\n".join(draw.choice(["a b", "a  b", "", " ", "c | d"]) for _ in range(20)) for _ in range(20)] + [prose(4, 30)]
    odd_docs, odd_data = odd(spark, extra=True)
    data = odd_data + rows(texts, 100)
    docs = odd_docs.unionByName(table(spark, rows(texts, 100), extra=True))
    field = line_crf.fit([], [], line_crf.LineCrfRule())
    out = line_crf.judge(docs, field).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == sorted((d is not None, d or 0, *plain_base(t)) for d, t, *_ in data)
    assert all(r.kept == (not r.base_failed) for r in out)  # untrained, every line is content
    assert line_crf.judge(table(spark, []), field).count() == 0


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(2)
    for _ in range(30):
        lengths = draw.integers(1, 7, size=5)
        features = draw.random((lengths.sum(), line_crf.N_FEATURES)) < 0.3
        field = line_crf.LineField(draw.normal(size=(line_crf.N_FEATURES, 2)), draw.normal(size=(2, 2)), draw.normal(size=2))
        got = line_crf.viterbi(field, features, lengths)
        at = 0
        for n in lengths:
            e = features[at : at + n] @ field.emit

            def worth(path):
                return field.first[path[0]] + sum(e[i, s] for i, s in enumerate(path)) + sum(field.step[a, b] for a, b in itertools.pairwise(path))

            assert worth(got[at : at + n].tolist()) == pytest.approx(max(map(worth, itertools.product((0, 1), repeat=int(n)))))
            at += n


def test_field_learns_neighbourhoods():
    draw = np.random.default_rng(4)
    sequences, states = [], []
    for i in range(400):
        x = np.zeros((6, line_crf.N_FEATURES), np.uint8)
        x[:, 0] = 1
        x[:, 9] = draw.random(6) < (0.8 if i % 2 else 0.1)
        sequences.append(x)
        states.append(i % 2)
    field = line_crf.fit(sequences, states, line_crf.LineCrfRule())
    guess = line_crf.viterbi(field, np.concatenate(sequences), np.full(400, 6)).reshape(400, 6)
    assert (guess == guess[:, :1]).mean() > 0.97  # neighbours agree
    assert (guess[:, 0] == np.array(states)).mean() > 0.95


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    field = line_crf.train(docs, labels, allowed=labels["doc_id"] % 2 == 0)
    out = line_crf.judge(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in out if r.quality == 1 and not r.base_failed]
    bad = [r for r in out if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.97
    assert sum(not r.kept for r in bad) / len(bad) > 0.9
    assert all(len(r.states) <= r.n_words and set(r.states) <= {"c", "b"} for r in out)


def plain_units(text):
    """Units as (start, end, words)."""
    out, at = [], 0
    for part in __import__("re").split(r"([.!?\n])", text or ""):
        words = tuple(w.decode().lower() for w in __import__("re").findall(rb"[0-9A-Za-z\x80-\xff]+", part.encode()))
        if len(words) >= 2:
            out.append((at, at + len(part), words))
        at += len(part)
    return out


def test_repeats_are_the_later_occurrences(spark):
    passages = [prose(i, 6, 11).replace("\n", " ") for i in range(5)]
    draw = random.Random(6)
    texts = [" ".join([prose(100 + i, 3), "and so", passages[draw.randrange(5)] if i % 3 else "", prose(200 + i, 2)]) for i in range(40)] + [prose(1, 9)] * 3
    data = rows(texts)
    rule = unit_dedup.UnitRule()
    first = {}
    for doc_id, text, *_ in data:
        for i, (_, _, words) in enumerate(plain_units(text)):
            first.setdefault(words, (doc_id, i))
    expected = set()
    for doc_id, text, *_ in data:
        found = plain_units(text)
        later = [i for i, u in enumerate(found) if first[u[2]] != (doc_id, i)]
        for _, run in itertools.groupby(enumerate(later), lambda p: p[1] - p[0]):
            run = [i for _, i in run]
            if (n := sum(len(found[i][2]) for i in run)) >= rule.min_run_words:
                expected.add((doc_id, found[run[0]][0], found[run[-1]][1], len(run), n, tuple(sorted({first[found[i][2]][0] for i in run}))))
    spans = unit_dedup.repeats(table(spark, data, extra=True), rule)
    assert {(r.doc_id, r.start, r.end, r.n_units, r.n_words, tuple(r.first_doc_ids)) for r in spans.collect()} == expected
    assert len(expected) > 20
    whole = {d: t for d, t, *_ in data}
    cut = defaultdict(list)
    for doc_id, start, end, *_ in expected:
        cut[doc_id].append((start, end))
    for r in unit_dedup.kept_spans(table(spark, data), spans).collect():
        assert all(p.text == whole[r.doc_id][p.start : p.end] for p in r.kept)
        left = [c for i, c in enumerate(whole[r.doc_id]) if not any(a <= i < b for a, b in cut[r.doc_id])]
        assert "".join(p.text for p in r.kept) == "".join(left)


def test_units_of_odd_texts(spark):
    docs, data = odd(spark, extra=True)
    found = unit_dedup.repeats(docs, unit_dedup.UnitRule(min_run_words=2)).collect()
    assert {r.doc_id for r in found} >= {16}  # the second of two equal long texts
    assert 15 not in {r.doc_id for r in found if 16 in r.first_doc_ids}
    assert unit_dedup.repeats(table(spark, []), unit_dedup.UnitRule()).count() == 0
    assert unit_dedup.repeats(table(spark, rows([None, "", "..."])), unit_dedup.UnitRule()).count() == 0


def cut_texts(spark, texts):
    """The texts of the spans to cut, by document."""
    found = defaultdict(list)
    for r in sorted(unit_dedup.repeats(table(spark, rows(texts))).collect(), key=lambda r: (r.doc_id, r.start)):
        found[r.doc_id].append(texts[r.doc_id][r.start : r.end].strip())
    return found


def test_short_repeated_lines_go(spark):
    notice = "All rights reserved. See the licence file"
    texts = [f"fresh line number {i} of mine\n{notice}\nother words {i} here too" for i in range(4)]
    texts.append("Some start. See the licence file")  # a sentence inside a line, not a line
    assert cut_texts(spark, texts) == {i: [notice] for i in (1, 2, 3)}


def test_fresh_words_between_repeats_stay(spark):
    lines = [f"{x} in the long form that all of us have to fill" for x in ("name", "street", "city")]
    texts = ["\n".join(x for i, line in enumerate(lines) for x in (line, f"own{k}{i}")) for k in range(3)]
    assert cut_texts(spark, texts) == {1: lines, 2: lines}
    listed = [w for i in range(15) for w in (f"item {i}", "yes" if i % 2 else "no")]
    assert cut_texts(spark, ["\n".join(listed), "\n".join(["no", *listed])]) == {1: ["\n".join(listed)]}


def test_passages_inside_sentences_go(spark):
    passage = " ".join(prose(5, 6).replace(".", "").lower().split()[:55])
    texts = [" ".join([prose(50 + i, 3)[:-1].replace(".", "").replace("\n", " "), "é", passage, prose(80 + i, 3).replace(".", "").replace("\n", " ")]) for i in range(4)]
    found = cut_texts(spark, texts)
    assert found.keys() == {1, 2, 3}
    for spans in found.values():
        assert len(spans) == 1 and spans[0] in passage and len(spans[0].split()) > 35


def test_digests_do_not_depend_on_the_chunk():
    texts = [t for t in ODD_TEXTS if t]
    data, offsets = textkit.raw_bytes(textkit.text_array(pa.array(texts)))
    together = textkit.pieces(data, offsets, textkit.IN_WORD)
    seen = {}
    for i, text in enumerate(texts):
        one = textkit.pieces(*textkit.raw_bytes(textkit.text_array(pa.array([text]))), textkit.IN_WORD)
        assert one.digest.tolist() == together.digest[together.first[i] : together.first[i + 1]].tolist()
        words = text.encode().split()
        assert [text.encode()[a:b] for a, b in zip(one.start, one.end)] == words
        for w, d in zip(words, one.digest.tolist()):
            assert seen.setdefault(w, d) == d
    assert len(set(seen.values())) == len(seen)


def whole_rule_units(text, rule):
    """Units (start, end, words, key) and lines (first unit, units, key) of a text of ASCII characters, word by word."""
    value = {}
    units, lines, at = [], [], 0
    for line in text.split("\n"):
        head = len(units)
        for part in re.finditer(r"[^.!?]+", line):
            found = list(re.finditer(r"[0-9A-Za-z]+", part.group()))
            if not found:
                continue
            words = [w.group().lower() for w in found]
            for w in words:
                value.setdefault(w, int(textkit.mixed(textkit.terms(textkit.text_array(pa.array([w])))[2].digest)[0]))
            v = [value[w] for w in words]
            cuts = [j for j in range(1, len(v) - 2) if len(v) > rule.max_unit_words and all(v[j] < x for x in v[max(0, j - 3) : j]) and all(v[j] <= x for x in v[j + 1 : j + 4])]
            edges = [-1, *cuts, len(v) - 1]
            for x, y in itertools.pairwise(edges):
                start = part.start() + (0 if x < 0 else found[x].end())
                end = part.end() if y == len(v) - 1 else part.start() + found[y].end()
                own = tuple(words[x + 1 : y + 1])
                key = own if len(own) >= rule.min_unit_words or not units else units[-1][2] + own
                units.append((at + start, at + end, own, key))
        spoken = tuple(w.lower() for w in re.findall(r"[0-9A-Za-z]+", line))
        if len(spoken) >= rule.min_line_words:
            lines.append((head, len(units) - head, spoken))
        at += len(line) + 1
    return units, lines


def whole_rule_spans(texts, rule):
    read = [whole_rule_units(t, rule) for t in texts]
    first, first_line, out = {}, {}, set()
    for d, (units, lines) in enumerate(read):
        for i, u in enumerate(units):
            first.setdefault(u[3], (d, i))
        for j, (_, _, key) in enumerate(lines):
            first_line.setdefault(key, (d, j))
    for d, (units, lines) in enumerate(read):
        own = [first[u[3]] != (d, i) for i, u in enumerate(units)]
        whole = {i for j, (head, n, key) in enumerate(lines) if first_line[key] != (d, j) for i in range(head, head + n)}

        def groups(marks):
            return [[i for i, _ in g] for on, g in itertools.groupby(enumerate(marks), lambda p: p[1]) if on]

        kept = [False] * len(units)
        for run in groups(own):
            long = sum(len(units[i][2]) for i in run) >= rule.min_run_words
            for i in run:
                kept[i] = long or i in whole
        for run in groups(kept):
            out.add((d, units[run[0]][0], units[run[-1]][1], len(run), sum(len(units[i][2]) for i in run), tuple(sorted({first[units[i][3]][0] for i in run}))))
    return out


@pytest.mark.parametrize("hot_keys", [10_000, 300, 1])
def test_all_units_and_lines_against_word_by_word(spark, hot_keys):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    stock = [" ".join(draw.choice(words) for _ in range(draw.choice([1, 1, 2, 4, 9, 20, 45]))) for _ in range(40)]
    texts = []
    for _ in range(90):
        parts = [draw.choice(stock) if draw.random() < 0.6 else " ".join(draw.choice(words) for _ in range(draw.randrange(1, 30))) for _ in range(12)]
        texts.append("".join(p + draw.choice([". ", "! ", "\n", " ", "\n\n", "? "]) for p in parts))
    rule = unit_dedup.UnitRule(hot_keys=hot_keys)
    got = {(r.doc_id, r.start, r.end, r.n_units, r.n_words, tuple(r.first_doc_ids)) for r in unit_dedup.repeats(table(spark, rows(texts)), rule).collect()}
    expected = whole_rule_spans(texts, rule)
    assert got == expected and len(expected) > 100
    assert any(len(u[2]) == 1 for t in texts for u in whole_rule_units(t, rule)[0])
