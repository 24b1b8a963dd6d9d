"""Parts of the operators without Spark, against the libraries or plain versions."""

import io
import random

import numpy as np
import pyarrow as pa
import pytest

from claimlens.llm import language_id, maxent_lm, packing, quality_classifier, quality_rules, sharding, simhash, token_files
from claimlens.llm.common import vocabulary_file
from claimlens.llm.piece_bpe import PieceEncoder
from claimlens.llm.segments import PieceTokenizer

ALPHABET = ["'", "s", "'s", "'ll", "'re", "ve", " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "Ŀ", "1", "23", "..", "!", "'S", "ß",
            "the ", "ing", "▁", "😀", "中", "\x00", "ﬁ", "İ", "×", "<|endoftext|>", "\x0b", "\u2028", "x" * 50]


def random_texts(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["", " ", *("".join(r.choice(ALPHABET) for _ in range(r.randint(0, 14))) for _ in range(n))]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_tokenizers_library(name, spaced):
    from tokenizers import Tokenizer
    with open(vocabulary_file(name), "rb") as f:
        ours = PieceTokenizer(f.read(), spaced, max_entries=2000)
    texts = random_texts(6000, 1)
    want = [e.ids for e in Tokenizer.from_file(vocabulary_file(name)).encode_batch(texts, add_special_tokens=False)]
    for first in range(0, len(texts), 1500):
        ids, before = ours.encode(pa.array(texts[first:first + 1500]))
        assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == want[first:first + 1500]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_of_every_letter(name, spaced):
    """U+0080 to U+024F, and what these become in lower case, one by one, alone and inside a word."""
    from tokenizers import Tokenizer
    with open(vocabulary_file(name), "rb") as f:
        ours = PieceTokenizer(f.read(), spaced)
    library = Tokenizer.from_file(vocabulary_file(name))
    letters = [chr(i) for i in range(0x80, 0x250)]
    letters += sorted({c for x in letters for c in x.lower()} - set(letters))
    texts = [t for c in letters for t in (c, f"wor{c}d {c}", f"{c}'s 1{c}")]
    ids, before = ours.encode(pa.array(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])]
    assert [t for t, x, y in zip(texts, got, want) if x != y] == []


def test_piece_ids_equal_the_sentencepiece_library():
    import sentencepiece
    with open(vocabulary_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    ours, library = PieceEncoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = random_texts(3000, 2) + ["the " * 50 + "t" * 200]
    ids, before = ours.encode(pa.array(texts))
    lists = [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])]
    assert lists == library.encode(texts)
    assert ours.decode(lists) == library.decode(lists)


def test_agenda_equals_the_side_by_side_form():
    with open(vocabulary_file("piece_bpe_32k.model"), "rb") as f:
        vocabulary = PieceEncoder(f.read()).vocabulary
    r = random.Random(3)
    words = ["".join(r.choice("abcdeinorst") for _ in range(12)) for _ in range(300)]
    grid = np.array([[vocabulary.of_char[ord(c)] for c in w] for w in words])
    found = {}
    for rows, left in vocabulary.side_by_side(grid):
        found.update(zip(rows.tolist(), left.tolist()))
    assert [found[i] for i in range(len(words))] == [vocabulary.agenda(g.tolist()) for g in grid]


def test_windows_fill_and_cuts_are_powers_of_two():
    windows, total, full = packing.Windows(16, 3), 0, []
    r = random.Random(4)
    for doc in range(200):
        n = r.randint(1, 15)
        total += n
        full += windows.place(doc, 0, np.arange(n), n)
    assert all(sum(len(p[2]) for p in w) == 16 for w in full) and len(windows.pieces) <= 3
    assert 16 * len(full) + sum(len(p[2]) for w in windows.pieces for p in w) == total
    assert packing.power_cuts(1300) == [1024, 256, 16, 4] and packing.power_cuts(0) == []


def test_differencing():
    part = sharding.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(part, [8, 7, 6, 5, 4]).tolist()) == [14, 16]      # the textbook example: a spread of 2
    sizes = np.random.default_rng(1).integers(1, 10_000, 3000)
    loads = np.bincount(sharding.differencing(sizes, 24), sizes, 24)
    assert loads.max() - loads.min() <= 5 and loads.sum() == sizes.sum()
    assert len(sharding.differencing(np.zeros(0, np.int64), 24)) == 0


def test_repeated_words_against_plain_windows():
    r = random.Random(5)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 120))) for _ in range(60)]
    s = quality_rules.TextSlice(pa.array(texts))
    assert quality_rules.repeated_words(s.codes(), s.words).tolist() == [quality_rules._repeated_words(t.split(), 8) for t in texts]


def test_cascade_order_does_not_change_the_verdict():
    texts = pa.array([t for t in random_texts(50, 6)] + ["A B C " * 30, "word " * 40, "a | " * 30, "plain words of a text " * 9])
    s = quality_rules.TextSlice(texts)
    base, every = quality_rules.base_figures(s), np.arange(len(texts))
    all_at_once = quality_rules.Cascade(quality_rules.RULES, 10**6).run(s, base, every).tolist()
    for order in (list(quality_rules.RULES), list(reversed(quality_rules.RULES))):
        cascade = quality_rules.Cascade({r: quality_rules.RULES[r] for r in order}, 0)
        assert cascade.run(s, base, every).tolist() == all_at_once


def test_golay_code_and_keys():
    golay = simhash.Golay()
    assert len(np.unique(golay.syndrome(golay.error))) == 2048 and np.bitwise_count(golay.error).max() == 3
    words = np.random.default_rng(2).integers(0, 1 << 22, 500)
    codewords = np.arange(1 << 12) << 11 | golay.parity
    for w, keys in zip(words, golay.keys(words)):
        assert set(keys[keys >= 0]) == set(np.flatnonzero(np.bitwise_count(codewords ^ w) <= 4))


def test_near_fingerprints_share_a_key():
    golay, r = simhash.Golay(), np.random.default_rng(3)
    a = r.integers(0, 1 << 63, 400).astype(np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << r.choice(64, k % 4, replace=False).astype(np.uint64)) if k % 4 else 0
                      for k in range(400)], np.uint64)
    own, _, _ = simhash.segment_keys(golay, a)
    _, rows, keys = simhash.segment_keys(golay, a ^ flips)
    around = [set() for _ in a]
    for row, key in zip(rows.tolist(), keys.tolist()):
        around[row].add(key)
    assert all(set(o) & k for o, k in zip(own.tolist(), around))


def test_token_file_round_trip_and_checksums():
    r = np.random.default_rng(4)
    docs = [r.integers(0, 50_000, n).astype(np.uint32) for n in (0, 1, 5, 40_000, 16_384, 7)]
    sink = io.BytesIO()
    sink.close = lambda: None
    writer = token_files.TokenFileWriter(sink, frame_ids=4096)
    for k, ids in enumerate(docs):
        writer.add(k, ids)
    writer.close(pa.int64())
    data = sink.getvalue()
    reader = token_files.TokenFileReader(pa.BufferReader(data))
    for k in (3, 0, 5, 4, 2, 1):
        assert reader.document(k).tolist() == docs[k].tolist()
    touched = []
    reader = token_files.TokenFileReader(pa.BufferReader(data))
    reader._ids = lambda k, get=reader._ids: touched.append(k) or get(k)
    reader.document(2)
    assert touched == [0]                                         # one frame for a short document
    broken = bytearray(data)
    broken[20] ^= 1
    with pytest.raises(Exception):
        token_files.TokenFileReader(pa.BufferReader(bytes(broken))).document(3)


def test_model_probabilities_sum_to_one():
    r = np.random.default_rng(5)
    sizes = maxent_lm.sizes_for(70_000)
    stream, identities = r.integers(0, sizes.buckets, 4000), r.integers(0, 1 << 32, 4000)
    one, two = maxent_lm.contexts(identities, np.array([0, 1500, 4000]))
    assert one[0] == one[1500] == two[1501] == -1 and one[1] == identities[0]
    model = maxent_lm.Model(sizes)
    before = model.log_probabilities(stream, one, two).sum()
    for _ in range(3):
        model.train(maxent_lm.Model(sizes), stream, one, two, 0.3)
    assert model.log_probabilities(stream, one, two).sum() > before
    n = sizes.buckets
    p = np.exp(model.log_probabilities(np.arange(n), np.full(n, one[7]), np.full(n, two[7])))
    assert abs(p.sum() - 1) < 1e-4


def test_sizes_follow_the_vocabulary():
    sizes = [maxent_lm.sizes_for(10 ** k) for k in range(0, 10)]
    assert all(a.buckets <= b.buckets and a.bits <= b.bits for a, b in zip(sizes, sizes[1:6]))
    assert sizes[9].buckets > 30 * sizes[3].buckets and sizes[6].features > 16 * sizes[3].features
    assert all(2 * s.side << s.bits <= 1 << 26 for s in sizes) and all(s.frequent + s.tails == s.buckets for s in sizes)


def test_classifier_parts():
    found, before = quality_classifier.Indicators()(pa.array(["", "ab AB ab", "ab AB ab"]))
    assert before.tolist()[:2] == [0, 0] and found[before[1]:before[2]].tolist() == found[before[2]:].tolist()
    together = quality_classifier.Indicators()(pa.array(["some words here", "x"]))
    alone = quality_classifier.Indicators()(pa.array(["x"]))
    assert together[0][together[1][1]:].tolist() == alone[0].tolist()           # features do not cross texts
    w = quality_classifier.dual_descent([np.array([0]), np.array([1])], [np.ones(1), np.ones(1)], np.array([1.0, -1.0]), np.ones(2))
    assert w[0] > 0 > w[1]


def test_grams_do_not_cross_texts():
    grams = language_id.Grams()
    found, before, letter = grams(pa.array(["", "Été?", "12", "ab cd"]))
    alone, _, _ = grams(pa.array(["ab cd"]))
    assert letter.tolist() == [False, True, False, True] and found[before[3]:].tolist() == alone.tolist()
    assert before[1] == 0 and len(alone) == 9                    # " ab cd": five pairs and four triples


def test_line_rule_counts_lines_with_a_word():
    """More than three in ten of the lines that have a word repeat an earlier line; blank lines do not count."""
    r = random.Random(4)
    texts = ["\n\n".join(f"line {k} of ten has words" for k in [*range(10), *range(dups)]) for dups in (3, 4, 5, 9)]
    texts += ["".join(r.choice(["one two", "three", "x y z", "\n", "\n", "\n \n", "\x0b\n"]) for _ in range(r.randint(40, 80))) + " w" * 20
              for _ in range(400)]
    s = quality_rules.TextSlice(pa.array(texts))
    base = quality_rules.base_figures(s)
    want = []
    for text in texts:
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        want.append(10 * (len(lines) - len(set(lines))) > 3 * len(lines))
    assert want[:4] == [False, False, True, True] and len(set(want[4:])) == 2
    which = np.flatnonzero(base["n_words"] >= quality_rules.MIN_WORDS)
    assert quality_rules._lines(s, base, which).tolist() == [want[i] for i in which]
    assert quality_rules._lines(s, base, which[1::3]).tolist() == [want[i] for i in which[1::3]]
