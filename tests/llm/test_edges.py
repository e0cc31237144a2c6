"""Edge cases of the earlier operators: repeated and NULL ids, clashing columns, odd letters, large counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.llm import interpolation, passages, permutation, queries, wavelet

ALPHABET = (list("abzAZ09.,!?;:'\"()<>|#$%&*+-/=@[]^_`{}~") + list("İIıÀéßñĲǅſKÅΩ") + [chr(c) for c in range(0x958, 0x960)]
            + [chr(c) for c in (0x9DC, 0x9DD, 0x9DF, 0x915, 0x93C, 0x301, 0x307, 0x1E9B, 0x323, 0x2126, 0xFB01, 0x4E2D, 0x3042, 0xAC00,
                                0x1100, 0x1161, 0x5D0, 0x627, 0x660, 0x2167, 0x1D7D8, 0x10400, 0x200B, 0xA0, 0x3000, 0x85, 0x1C, 0x2028)]
            + ["'s", "'re", "<|endoftext|>", "<|startoftext|>", " ", " ", " ", "\n", "\t", "\x0b"])


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary("word_bpe_49k.json")


def test_pieces_encode_like_whole_texts(vocabulary):
    """20,000 random strings, and letters that normalisation splits into a letter and a mark."""
    from tokenizers import Tokenizer
    rnd = random.Random(17)
    texts = ["ANKARA'DA İKİ.", "HEPSİ, BİRİ!", "शोक़.", "साफ़,", "য়,", "İ़.", None, "", " \n"]
    texts += ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))) for _ in range(20_000)]
    whole, got = Tokenizer.from_file(vocabulary), []
    for lo in range(0, len(texts), 256):
        got += wavelet.encode_texts(vocabulary, texts[lo: lo + 256], 2)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 2], repr(text)


def test_words_of_latin_letters_encode_like_whole_texts(vocabulary):
    """All of Latin-1, control characters and contractions, many words to a text."""
    from tokenizers import Tokenizer
    rnd = random.Random(5)
    letters = [chr(c) for c in range(1, 256)] + list("abcXYZéÉßÀ0'<>. ") * 12 + ["'s", "'LL", "e\u0301", "\u0130", "\u4e2d"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    whole = Tokenizer.from_file(vocabulary)
    for text, ids in zip(texts, wavelet.encode_texts(vocabulary, texts, 2), strict=True):
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_a_piece_is_encoded_once_whatever_stands_beside_it(vocabulary, monkeypatch):
    monkeypatch.setattr(wavelet, "_CODERS", {})
    wavelet.encode_texts(vocabulary, [f"{a}{w}{z}" for w in ("the", "The", "THE", "été", "Été") for a in ("", "(", '"')
                                      for z in ("", ",", ".", "!", ")", '"')], 2)
    assert len(wavelet._CODERS[vocabulary].codes) <= 9       # the, été, the marks and the blank


def test_memo_that_is_cut_gives_the_same_ids(vocabulary, monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["the", "The", "cat,", "x" * rnd.randint(1, 9), "é!", "a1."]) for _ in range(40)) for _ in range(300)]
    texts += [" ".join(f"w{rnd.randint(0, 999)}q" for _ in range(40)) for _ in range(100)]
    want = wavelet.encode_texts(vocabulary, texts, 2)
    monkeypatch.setattr(wavelet, "MEMO", 40)
    monkeypatch.setattr(wavelet, "_CODERS", {})
    got = [ids for lo in range(0, len(texts), 10) for ids in wavelet.encode_texts(vocabulary, texts[lo: lo + 10], 2)]
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))


def test_another_vocabulary_is_encoded_whole(vocabulary, tmp_path):
    from tokenizers import Tokenizer, normalizers
    other = Tokenizer.from_file(vocabulary)
    other.normalizer = normalizers.NFC()                    # keeps capitals
    path = str(tmp_path / "other.json")
    other.save(path)
    texts = ["The Cat.", "", None, "İ."]
    assert [x.tolist() for x in wavelet.encode_texts(path, texts, 7)] == [
        [*other.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]


PASSAGE = "It was noted by all that the river had risen over the old bridge and nobody could cross it. " * 2


def test_passages_of_null_and_repeated_ids(spark):
    rows = [(None, f"alpha one {PASSAGE}end"), (None, f"beta two {PASSAGE}stop"), (None, "gamma three stays as it is"),
            (4, f"delta {PASSAGE}x"), (4, f"epsilon {PASSAGE}y"), (4, f"epsilon {PASSAGE}y"), (5, None), (6, "")]
    d = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id bigint, text string, removed_spans string, __units int")
    got = passages.remove(d)
    assert got.columns == [*d.columns, "removed_spans_", "removed_words"]
    cut = {r.text: r.removed_words for r in got.collect() if r.removed_words}
    # the earliest keeps the passage: id 4 before NULL, and of its texts the one of the smaller hash
    assert len(got.collect()) == 8 and sum("river" in (r.text or "") for r in got.select("text").distinct().collect()) == 1
    assert "gamma three stays as it is" in {r.text for r in got.collect()} and cut


def test_pieces_keep_offsets_of_letters_that_change_length():
    text = "İstanbul'da Σας is. Here  it\tgoes ΟΔΟΣ on\nthe next line 中文 text"
    p = passages.pieces(text)
    assert [text[a:b] for a, b in zip(p.start, p.stop)][0].startswith("İstanbul'da")
    assert all(text[a:b].strip() == text[a:b] and b > a for a, b in zip(p.start, p.stop))
    again = passages.pieces("x. " + text)
    assert again.norm[-1] == p.norm[-1]


def test_rows_of_one_id_are_candidates_each(spark):
    rows = [(0, [1.0, 0.0]), (7, [0.0, 1.0]), (7, [0.9, 0.1]), (8, [1.0, 0.2]), (0, [1.0, 0.01])]
    d = spark.createDataFrame(rows, "v bigint, e array<double>")
    got = [(r["query_id"], r["rank"], r["id"]) for r in permutation.search(d, "v", "e", F.col("id") % 50 == 0).collect()]
    assert len(got) == 8 and sorted(i for _, _, i in got) == [0, 0, 7, 7, 7, 7, 8, 8]
    assert sorted(got)[0] == (0, 1, 0)                      # the other row of id 0


def test_totals_beyond_32_bits_travel_whole():
    for x in (np.array([0, 5, 5_000_000_000], np.int64), np.array([1, 2], np.int64), np.zeros(0, np.int64)):
        assert interpolation._large(interpolation._small(x)).tolist() == x.tolist()
