"""Toxicity, vector codes and the prefix trie against brute force, edge cases included."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from isotherm.llm import hilbertpq, prefixtrie, pulearn, queries

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------------ toxicity

def toxic_corpus(n=600):
    rnd = random.Random(5)
    syllables = ["ba", "do", "ke", "lu", "mi", "no", "ra", "su", "ti", "ve"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 4)))
    docs, labels = [], []
    for i in range(n):
        bad = i % 8 == 0
        words = [word() for _ in range(rnd.choice([5, 40, 200]))]
        if bad:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(["xqzgrot", "Xqzgrub", "xqzgel"])
        docs.append((i, " ".join(words)))
        if bad and i % 16 == 0 or not bad and i % 3 == 0:
            labels.append((i, int(bad)))
    return docs, labels, {i for i in range(n) if i % 8 == 0}


def test_toxicity_is_learned_from_confirmed_and_unlabelled_texts(spark):
    docs, labels, bad = toxic_corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in pulearn.classify(d, lab, prior=0.125).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert np.mean([got[i].predicted == int(i in bad) for i in held]) > 0.97
    # labels of the held-out fold teach nothing
    flipped = [(i, 1 - y) if i in held else (i, y) for i, y in labels]
    again = {r.doc_id: r.score for r in pulearn.classify(d, spark.createDataFrame(flipped, lab.schema), prior=0.125).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_toxicity_of_odd_rows(spark):
    docs, labels, _ = toxic_corpus(200)
    odd = [(None, None), (1000, ""), (1001, "x"), (1002, "ba " * 400_000 + "xqzgrot xqzgrub xqzgel xqzgrot"), (1003, "a"), (1003, "a")]
    d = spark.createDataFrame([(*r, "s") for r in docs + odd], "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    got = pulearn.classify(d, lab).collect()
    assert len(got) == len(docs) + len(odd)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.score)
    assert by[None] == by[1000] and by[1003][0] == by[1003][1]
    assert by[1002][0] > by[1003][0]                      # found at the end of a very long text
    none = pulearn.classify(d, lab.where("toxic = 0")).collect()
    assert {r.score for r in none} == {pulearn.LEAST_PRIOR}
    assert pulearn.classify(d.limit(0), lab.limit(0)).collect() == []


def test_grams_in_pieces_equal_grams_at_once(monkeypatch):
    rnd = np.random.default_rng(1)
    texts = ["".join(chr(c) for c in rnd.integers(97, 123, n)) for n in (0, 1, 3, 700, 5000)]
    whole = pulearn.grams(texts)
    monkeypatch.setattr(pulearn, "PIECE", 64)
    assert np.array_equal(whole, pulearn.grams(texts))


# ------------------------------------------------------------------------------------ vector codes

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector, label) of kept rows; exact Python integers throughout."""
    width = -(-max((len(v) for _, v, _ in rows), default=0) // parts)
    whole = [hilbertpq.integers(v, 1024, parts * width) for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    cut = lambda w, p: w[p * width: (p + 1) * width]
    books = [[list(cut(whole[i], p)) for i in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(cut(w, p), e)), k) for k, e in enumerate(books[p])) for w in whole]
                for p in range(parts)]
    for _ in range(rounds):
        for p, near in enumerate(assign()):
            for k in range(len(books[p])):
                mine = [cut(w, p) for w, (_, j) in zip(whole, near) if j == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    last = assign()
    err = [sum(last[p][i][0] for p in range(parts)) for i in range(len(rows))]
    codes = ["".join(f"{last[p][i][1]:02x}" for p in range(parts)) for i in range(len(rows))]
    return codes, [e if e < 1 << 63 else None for e in err], books


def check_codes(spark, rows, **kw):
    d = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, code int, row int")
    got, books = hilbertpq.compress(d.repartition(3), "vec_id", "embedding", "label", **kw)
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    codes, err, want = brute_codes(kept, **kw)
    assert books == want
    key = lambda t: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in t)
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got.collect()), key=key) == sorted(
        ((r[0], r[2], c, e) for r, c, e in zip(kept, codes, err)), key=key)
    return got


def test_codes_equal_plain_integer_rounds(spark, monkeypatch):
    monkeypatch.setattr(hilbertpq, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.05, 8)).tolist(), i % 3 or None) for i in range(300)]
    rows += [(300 + i, [0.25] * 8, None) for i in range(150)]            # a third are one vector
    got = check_codes(spark, rows, entries=12)
    total = hilbertpq.with_group_total(got, "label", "error", "label_error").collect()
    by = defaultdict(int)
    for r in total:
        by[r.label] += r.error
    assert all(r.label_error == by[r.label] for r in total)
    monkeypatch.setattr(hilbertpq, "SMALL_LABELS", 1)                     # the salted join
    again = hilbertpq.with_group_total(got, "label", "error", "label_error").collect()
    assert sorted(map(str, again)) == sorted(map(str, total))


def test_codes_of_odd_vectors(spark):
    rows = [(None, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0], 2), (5, [-0.5, 7.0, 0.0], None), (5, [1.0, 2.0], 2), (7, [], 3),
            (8, None, 1), (9, [1.0, None], 1), (10, [float("nan")], 1), (11, [float("inf"), 1.0], 1),
            (12, [1e30, -1e30, 3e200, 5.0], 4), (13, [1e7, 1e7, 1e7, 1e7], 4), (14, [1e30, -1e30, 0.0, 5.0], 4),
            (15, [2e4, 1.0, -2e9, 1e-9], 4)]
    check_codes(spark, rows, entries=3)
    check_codes(spark, [(1, [], 1), (2, [], 1)])
    got, books = hilbertpq.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), "vec_id", "embedding", "label")
    assert got.collect() == [] and hilbertpq.codebooks_digest(books) == hashlib.sha256(b"").hexdigest()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(3)
    book = rng.integers(-1000, 1000, (64, 6))
    for _ in range(50):
        box = rng.integers(-1000, 1000, 6) + rng.integers(0, 200, (40, 6))
        near = hilbertpq.shortlist(box.min(axis=0), box.max(axis=0), book)
        full, d = hilbertpq.nearest(box, book)
        at, short = hilbertpq.nearest(box, book[near])
        assert np.array_equal(near[at], full) and np.array_equal(d, short)


def test_hilbert_curve_steps_to_neighbours():
    bits, dims = 3, 2
    cells = np.array([(a, b) for a in range(1 << bits) for b in range(1 << bits)], np.uint32)
    order = np.argsort(hilbertpq.hilbert_key(cells, bits))
    steps = np.abs(np.diff(cells[order].astype(int), axis=0)).sum(axis=1)
    assert dims == cells.shape[1] and (steps == 1).all()


# ------------------------------------------------------------------------------------ prefix trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_trie(rows):
    def tok(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, tok(r or "", x or ""), r or "", x or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in by.items()}
    members, kids, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        s = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
            if d:
                kids[tuple(s[: d - 1])].add(tuple(s[:d]))
        ends[tuple(s)].append(c)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(WORDS.findall(k[-1][1])) if k else 0)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CONV = "conv_id long, turn long, role string, text string, name string, block int"


def trie_of(spark, rows):
    d = spark.createDataFrame([(*r, "x", 0) for r in rows], CONV).repartition(5)
    return sorted(tuple(r) for r in prefixtrie.conversation_trie(d).select(*COLUMNS).collect())


def test_trie_of_the_table(spark):
    src = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    got = sorted(tuple(r) for r in queries.op13_prefix_trie(spark, SF).select(*COLUMNS).collect())
    assert got == brute_trie([(r.conv_id, r.turn, r.role, r.text) for r in src])


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_long_and_odd_conversations(spark, monkeypatch, seed):
    """Several levels of the recursion, openings shorter than asked for, copies, NULLs, ties, a long conversation."""
    monkeypatch.setattr(prefixtrie, "PIECE", 8)
    monkeypatch.setattr(prefixtrie, "HOT_SHARE", 0.01)
    rnd = random.Random(seed)
    rows = []
    for c in [*range(30), 45, 47, 61, -3, 100, 121]:
        n = 130 if c % 7 == 0 else rnd.choice([1, 2, 3, 16, 17, 32, 33, 70])
        split = rnd.choice([5, 20, 60])
        rows += [(c, i if i else None, "u" if i % 2 else None, rnd.choice(["a b", "a b", " ", None]) if i > split else "x y")
                 for i in range(n)]
    rows += [(None, 1, "u", "z"), (7, None, None, None), (3, 1, "u", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "tie")]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_of_many_copies_streams_its_members(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "STREAM", 7)
    rows = [(20 * c, 0, "u", "same") for c in range(90)] + [(20 * c + 2000, 0, "u", f"other {c % 5}") for c in range(40)]
    assert trie_of(spark, rows) == brute_trie(rows)
    assert trie_of(spark, [(None, 1, "a", "b")]) == []
    assert trie_of(spark, [(21, 0, "a", "b")]) == brute_trie([(21, 0, "a", "b")])
