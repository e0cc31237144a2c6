"""Each operator against a brute-force version, an exact round trip or known cases, edge cases included."""

import collections
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from isotherm.llm import bytecnn, decontam, interpolation, mixing, passages, permutation, pii, queries, runs, simhash, wavelet
from isotherm.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, __doc string"
ODD = [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, None), (2, "a b", None, None, 3, None),
       (3, "w " * 3000, "en", "a", None, None), (3, "w " * 3000, "en", "a", None, None), (4, " \n\t ", "en", "b", 1, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_mixing_reaches_targets_and_handles_odd_rows(docs, odd, empty):
    got = rows(mixing.allot(docs))
    assert got == [] or len(got) == docs.count()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = {r["doc_id"]: r["taken"] for r in rows(mixing.allot(docs.repartition(5)))}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    by = collections.defaultdict(lambda: [0, 0, 0])
    for r in got:
        b = by[r["source"]]
        b[0], b[1], b[2] = b[0] + r["size"], r["target"], b[2] + r["taken"]
    assert sum(t for _, t, _ in by.values()) == pytest.approx(1.5 * sum(s for s, _, _ in by.values()))
    for size, target, taken in by.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= max(30, 0.02 * target)
    sizes = {r["doc_id"]: r["size"] for r in rows(mixing.allot(odd))}
    assert sizes == {None: 0, 1: 0, 2: 2, 3: 3000, 4: 0}
    assert mixing.mix(odd).columns == odd.columns
    assert rows(mixing.allot(empty)) == [] and rows(mixing.mix(empty)) == []


@pytest.mark.parametrize("bits", [13, 1])
def test_mix_deals_the_allotted_copies_of_repeated_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "BLOCK_BITS", bits)
    given = [(None, "w " * 10, "a", k) for k in range(13)] + [(1, "w " * 10, "a", 0)] * 11 + [(2, "v " * 7, "a", 0), (3, "u " * 40, "b", 0), (4, "x " * 9, "b", 0)]
    d = spark.createDataFrame(given, "doc_id bigint, text string, source string, rows bigint").repartition(3)
    allotted = rows(mixing.allot(d))
    want = collections.Counter()
    for r in allotted:
        want[r["doc_id"]] += r["copies"]
    assert any(want[i] % n for i, n in ((None, 13), (1, 11)))
    got = rows(mixing.mix(d))
    assert collections.Counter(r["doc_id"] for r in got) == +want
    words = collections.Counter()
    for r in got:
        words[r["source"]] += len(r["text"].split())
    taken = collections.Counter()
    for r in allotted:
        taken[r["source"]] += r["taken"]
    assert words == taken


def _simhash(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def test_simhash_against_all_pairs(docs, odd, empty):
    got = {r["doc_id"]: r for r in rows(simhash.near_duplicates(docs))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    fp = {i: _simhash(t) for i, t in texts.items()}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sorted(fp):
        for b in sorted(fp):
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fp[i]:016x}", find(i)) for i in fp}
    kept = [r["doc_id"] for r in rows(simhash.keep_one(docs))]
    assert sorted(kept) == sorted({find(i) for i in fp})
    strange = rows(simhash.near_duplicates(odd))
    assert len(strange) == 6 and {r["component_id"] for r in strange if r["doc_id"] in (None, 1, 4)} == {1}
    assert sorted(r["doc_id"] for r in rows(simhash.keep_one(odd))) == [1, 2, 3]
    assert rows(simhash.near_duplicates(empty)) == [] and rows(simhash.keep_one(empty)) == []


def test_keep_one_keeps_a_row_of_every_component(spark):
    texts = [" ".join(f"{w}{k}" for k in range(40)) for w in ("ash", "birch", "cedar", "date", "elm")]
    given = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4])]
    kept = rows(simhash.keep_one(spark.createDataFrame(given, "doc_id bigint, text string")))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted(
        [("None", texts[0]), ("None", texts[1]), ("5", texts[2]), ("7", texts[3]), ("7", texts[4])])


def test_simhash_links_of_close_points(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    points = {int(b) for b in base}
    for b in base:
        for _ in range(40):
            x = int(b)
            for k in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(k)
            points.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in points]
    got = {frozenset((r["a"], r["b"])) for r in rows(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint")))}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3}
    assert got == want and want


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in rows(connected_components(links, "a", "b"))}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_interpolation_base_and_gain(docs, odd, empty):
    got = {r["doc_id"]: r for r in rows(interpolation.score(docs, block_bytes=100_000))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in texts.items()}
    held = {i for i in words if zlib.crc32(str(i).encode()) % 10 == 0}
    count = collections.Counter(w for i, ws in words.items() if i not in held for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in words.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(ws), sum(w in count for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)
    assert len(rows(interpolation.score(odd))) == 6 and rows(interpolation.score(empty)) == []


def test_interpolation_weights_follow_the_counts():
    import pandas as pd
    sure = pd.DataFrame({"bucket": [5], "p2": [0], "p1": [80], "n": [1000]})
    never = pd.DataFrame({"bucket": [5], "p2": [-1], "p1": [80], "n": [1000]})
    assert interpolation.fit(sure, 1000)[0][5] > 0.95 and interpolation.fit(never, 1000)[0][5] < 0.01


def test_key_packing_round_trip():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64))
    assert (interpolation._unpack(interpolation._pack(keys)) == keys).all()
    assert len(interpolation._unpack(interpolation._pack(keys[:0]))) == 0


def test_passages_against_brute_force(docs, odd, empty):
    got = {r["doc_id"]: r for r in rows(passages.remove(docs))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = collections.defaultdict(list)
    for i in sorted(texts):
        for first, last, digest in passages.units(texts[i]):
            seen[digest].append((i, first, last))
    gone, need = collections.defaultdict(set), collections.defaultdict(set)
    for places in seen.values():
        for k, (i, a, b) in enumerate(places if len(places) > 1 else []):
            (gone if k else need)[i].update(range(a, b + 1))
    for i, text in texts.items():
        spans, at, out = [m.span() for m in passages.PIECE.finditer(text)], 0, ""
        for s in got[i]["removed_spans"]:
            out, at = out + text[at:s["start"]], s["stop"]
        assert out + text[at:] == got[i]["text"]
        assert got[i]["removed_words"] == sum(len(text[a:b].split()) for a, b in (spans[k] for k in gone[i] - need[i]))
    assert len(rows(passages.remove(odd))) == 6 and rows(passages.remove(empty)) == []


def test_passage_in_the_middle_of_a_line(spark):
    passage = "The old bridge over the river was closed. " + "Nobody knew why it had been closed for so very long. " * 1 + "Then a man came and told us all."
    rows_ = [(1, f"unrelated start here {passage} and on"), (2, f"quite other words {passage} and more"), (3, "Clean text that shares nothing with them at all.")]
    got = {r["doc_id"]: r for r in rows(passages.remove(spark.createDataFrame(rows_, "doc_id bigint, text string")))}
    assert got[1]["text"] == rows_[0][1] and got[3]["text"] == rows_[2][1]
    assert "Nobody knew" not in got[2]["text"] and got[2]["text"].startswith("quite other words")


def test_passage_without_marks_or_blanks(spark):
    passage = " ".join(f"plain{k * 7 % 101}" for k in range(60))
    chars = "".join(chr(0x4e00 + k * 37 % 5000) for k in range(120))
    given = [(1, f"some lower case start {passage} one end"), (2, f"and here another start {passage} other end of it"),
             (3, f"前言不同{chars}结尾"), (4, f"别的开头在此{chars}又一尾")]
    got = {r["doc_id"]: r for r in rows(passages.remove(spark.createDataFrame(given, "doc_id bigint, text string")))}
    assert got[1]["text"] == given[0][1] and got[3]["text"] == given[2][1]
    assert got[2]["removed_words"] >= 25 and len(got[2]["text"].split()) <= 8 + 60 - 25
    assert got[2]["text"].startswith("and here another start") and got[2]["text"].endswith("other end of it")
    assert len(got[4]["text"]) <= 8 + 60 and got[4]["text"].startswith("别的开头在此")


def test_line_runs_against_brute_force(docs, odd, empty):
    got = {r["doc_id"]: r for r in rows(runs.remove(docs))}
    seqs = {r.doc_id: [(k, x.strip(" ")) for k, x in enumerate(r.text.split("\n")) if x.strip(" ")] for r in docs.collect()}
    seen = collections.defaultdict(list)
    for i in sorted(seqs):
        for a in range(len(seqs[i]) - 1):
            seen[seqs[i][a][1], seqs[i][a + 1][1]].append((i, a))
    gone, need = collections.defaultdict(set), collections.defaultdict(set)
    for places in seen.values():
        for k, (i, a) in enumerate(places if len(places) > 1 else []):
            (gone if k else need)[i].update((seqs[i][a][0], seqs[i][a + 1][0]))
    for i, r in got.items():
        assert {k for s in r["removed_runs"] for k in range(s["line"], s["line"] + s["lines"])} == gone[i] - need[i]
    assert len(rows(runs.remove(odd))) == 6 and rows(runs.remove(empty)) == []


def test_line_query_removes_single_lines(spark, tmp_path):
    long = " ".join(f"word{k}" for k in range(60))
    rows_ = [(1, "only line of the text"), (2, "only line of the text"), (3, f"a\n{long}\nb"), (4, f"c\n\n{long}\nd"), (None, "only line of the text")]
    spark.createDataFrame(rows_, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in rows(queries.op8_line_runs(spark, str(tmp_path)))}
    assert {i: r["text"] for i, r in got.items()} == {1: rows_[0][1], 2: "", 3: rows_[2][1], 4: "c\n\nd", None: ""}
    assert got[4]["removed_runs"] == [{"line": 2, "lines": 1}] and got[3]["removed_runs"] == []


def test_permutation_index_recall_and_cases(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = collections.defaultdict(list)
    for r in rows(permutation.search(vectors, "vec_id", "embedding", F.col("id") % 50 == 0)):
        got[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    data = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    unit = {i: x / np.linalg.norm(x) for i, x in data.items()}
    hits = 0
    for q, found in got.items():
        best = sorted((-float(unit[q] @ unit[i]), i) for i in unit if i != q)[:5]
        hits += len({i for _, i in best} & {i for _, i, _ in found})
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
    assert hits >= 0.9 * 5 * len(got) and len(got) == sum(i % 50 == 0 for i in data)
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]),
                                 (5, [2.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 1.0]), (8, [1.0]), (None, [1.0, 0.0])], "v bigint, e array<double>")
    few = [(r["rank"], r["id"]) for r in rows(permutation.search(odd, "v", "e", F.col("id") % 50 == 0))]
    assert sorted(few) == [(1, 5), (2, 6), (3, 7)]
    assert rows(permutation.search(odd.limit(0), "v", "e", F.lit(True))) == []


def test_decontamination_tolerates_substitutions(spark, odd, empty):
    item = " ".join(f"tok{k}" for k in range(24))
    changed = item.split()
    for k in (3, 9, 14, 20):
        changed[k] = "other"
    far = ["x" if k % 3 == 0 else w for k, w in enumerate(item.split())]
    d = spark.createDataFrame([(1, "start, " + item.upper() + ". end"), (2, "a b " + " ".join(changed)), (3, " ".join(far)), (4, "nothing"),
                               (1, "start, " + item.upper() + ". end"), (None, item)], "doc_id bigint, text string")
    b = spark.createDataFrame([(7, item), (8, "too short"), (None, item), (9, None)], "item_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"], r["start"], r["same"]) for r in rows(decontam.matches(d, b))) == [(1, 7, 1, 24), (2, 7, 2, 20)]
    assert sorted(str(r["doc_id"]) for r in rows(decontam.remove(d, b))) == ["3", "4", "None"]
    assert rows(decontam.matches(odd, b)) == [] and rows(decontam.matches(empty, b)) == [] and rows(decontam.matches(d, b.limit(0))) == []
    plan = decontam.matches(d, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_decontamination_of_null_and_repeated_ids(spark, tmp_path):
    item = " ".join(f"tok{k}" for k in range(24))
    given = [(None, item), (None, "a clean text"), (5, "another clean text"), (5, f"x {item}"), (6, "clean")]
    d = spark.createDataFrame(given, "doc_id bigint, text string")
    b = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    b.write.parquet(str(tmp_path / "benchmark.parquet"))
    d.write.parquet(str(tmp_path / "documents.parquet"))
    kept = rows(corpus_pipeline.decontaminate(spark, d, str(tmp_path)))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("5", given[2][1]), ("6", "clean"), ("None", given[1][1])]
    found = rows(queries.op6_spaced_seeds(spark, str(tmp_path)))
    assert sorted((str(r["doc_id"]), r["item_id"], r["start"], r["same"]) for r in found) == [("5", 7, 1, 24), ("None", 7, 0, 24)]


def _luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(d)) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark, odd, empty):
    text = ("card 4785380592391139, mail ann.42@mail8.example.com, tel +1 (743) 555-3824, ip 10.1.2.3, born 1987-03-04 or 04/03/1987, "
            "ssn 123-45-6789, not 4785380592391130 nor 300.1.1.1 nor 2021-02-30.")
    d = spark.createDataFrame([(1, text), (2, "again 4785380592391139!"), (3, None), (4, "no data")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in rows(pii.pseudonymise(d, "k"))}
    kinds = collections.Counter(x["kind"] for x in got[1]["pii"])
    assert kinds == {"card": 1, "email": 1, "phone": 1, "ipv4": 1, "date": 2, "ssn": 1}
    new = {x["kind"]: x["pseudonym"] for x in got[1]["pii"]}
    assert _luhn(new["card"]) and len(new["card"]) == 16 and new["card"] != "4785380592391139" and new["email"].endswith("@mail8.example.com")
    assert new["card"] == got[2]["pii"][0]["pseudonym"] and f"again {new['card']}!" == got[2]["text"]
    assert "4785380592391130" in got[1]["text"] and "300.1.1.1" in got[1]["text"] and "2021-02-30" in got[1]["text"]
    assert got[3]["text"] is None and got[4]["text"] == "no data" and got[4]["pii"] == []
    dates = [x["pseudonym"] for x in got[1]["pii"] if x["kind"] == "date"]
    assert dates[1] == "/".join(reversed(dates[0].split("-")))
    assert len(rows(pii.pseudonymise(odd, "k"))) == 6 and rows(pii.pseudonymise(empty, "k")) == []


def test_pseudonyms_beside_other_numbers(spark):
    card, phone = "4111 1111 1111 1111", "+1 212-555-0100"
    cards = [f"{card} 12/25", f"{card} 123", f"order 42 {card}", f"{card} 04/03/1987", f"7 8 9 {card} 1 2", card]
    phones = [f"{phone} 22", phone, "+12125550100 1234", "+12125550100"]
    secrets = ['token = "0a1b2c3d4e5f"', "password: hunterhunter", '{"api_key": "0a1b2c3d4e5f"}', "token=0a1b2c3d4e5f"]
    texts = [*cards, *phones, *secrets, "12 2021-03-04 and 1 2 3 4 5 6 7 8"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = sorted(rows(pii.pseudonymise(d, "k")), key=lambda r: r["doc_id"])
    for r, old in zip(got, texts):
        new, at = "", 0
        for x in r["pii"]:
            new, at = new + old[at:x["start"]] + x["pseudonym"], x["start"] + x["original_length"]
        assert new + old[at:] == r["text"]
    named = [[x["pseudonym"] for x in r["pii"] if x["kind"] == k] for r, k in zip(got, ["card"] * 6 + ["phone"] * 4)]
    assert len({tuple(n) for n in named[:6]}) == 1 and len(named[0]) == 1 and named[0][0] != card and _luhn(named[0][0])
    assert named[6] == named[7] and named[8] == named[9] and all(len(n) == 1 for n in named)
    assert [x["kind"] for x in got[3]["pii"]] == ["card", "date"] and got[0]["text"].endswith(" 12/25")
    value = got[13]["text"][len("token="):]
    assert value != "0a1b2c3d4e5f" and got[10]["text"] == f'token = "{value}"' and got[12]["text"] == '{"api_key": "%s"}' % value
    assert got[11]["text"].startswith("password: ") and "hunterhunter" not in got[11]["text"]
    assert [x["kind"] for x in got[14]["pii"]] == ["date"]


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(189 * 773).select(F.array((F.col("id") % 189), F.floor(F.col("id") / 189)).alias("s"))
    radices = F.array(F.lit(189), F.lit(773)).cast("array<bigint>")
    out = pairs.limit(20_000).select(pii.feistel(F.col("s"), radices, F.lit("t"), "k", rounds=4).alias("o"))
    assert out.distinct().count() == 20_000
    assert out.where((F.col("o")[0] >= 189) | (F.col("o")[1] >= 773) | (F.col("o")[0] < 0)).count() == 0


def test_wavelet_access_rank_select_and_files(spark, docs, odd, empty):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = public.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    ids = np.random.default_rng(3).integers(0, 40, 3000)
    w = wavelet.Wavelet.from_bytes(wavelet.Wavelet.build(ids, [1, None], [1000, 3000]).to_bytes())
    assert (w.decode() == ids).all() and w.doc_ids == [1, None] and [w.access(k) for k in (0, 999, 2999)] == ids[[0, 999, 2999]].tolist()
    for t in (0, 7, 39, 40, 5000):
        at = np.flatnonzero(ids == t)
        assert w.count(t) == len(at) and w.rank(t, 1234) == (at < 1234).sum() and [w.select(t, k) for k in range(min(5, len(at)))] == at[:5].tolist()
    strange = ["", "a<|endoftext|>b", "İstanbul! ǅ. Å, ΣΑΣ. ﬁ!", "it's. they'll!! 12,5. a b. c", "é. ́x .,. 'S", "ABC*** de&&& x_ ##"]
    for got, text in zip(wavelet.encode_texts(path, strange, 2), strange):
        assert got.tolist() == tok.encode(text, add_special_tokens=False).ids + [2]
    start = 0
    got = sorted(rows(wavelet.read_documents(wavelet.write(docs, path, 2, shard_tokens=5000))), key=lambda r: r["doc_id"])
    for r, d in zip(got, sorted(docs.collect(), key=lambda d: d.doc_id)):
        own = np.array(tok.encode(d.text, add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d.doc_id, start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    assert sorted(r["n_tokens"] for r in rows(wavelet.read_documents(wavelet.write(odd, path, 2))))[:3] == [1, 1, 1]
    assert rows(wavelet.read_documents(wavelet.write(empty, path, 2))) == []


def test_byte_cnn_learns_and_handles_odd_rows(spark, odd, empty):
    rng = np.random.default_rng(5)
    words = ["stone", "river", "cold", "bread", "light", "walked", "under", "green"]
    good = [" ".join(rng.choice(words, 60)) for _ in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choice(words, 60)) for _ in range(60)]
    model = bytecnn.train([(t, 1) for t in good[:40]] + [(t, 0) for t in bad[:40]], steps=60)
    assert min(bytecnn.score_text(model, t) for t in good[40:]) > 0.5 > max(bytecnn.score_text(model, t) for t in bad[40:])
    assert 0 <= bytecnn.score_text(model, None) == bytecnn.score_text(model, "") <= 1
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "doc_id bigint, quality int")
    got = rows(bytecnn.classify(odd, labels))
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert rows(bytecnn.classify(empty, labels)) == []
