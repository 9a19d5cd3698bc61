"""Token counts, packing and training order against the tokenizer library and brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import ODD_TEXTS, empty, frame, odd, prose
from public_tokenizers import path
from tokenizers import Tokenizer

from pairmill.llm.packing import best_fit, best_fit_packing, pack, pack_pieces
from pairmill.llm.token_counts import token_counts
from pairmill.llm.training_order import (
    Layout, Permutation, read_sequences, training_order, write_training_order,
)
from pairmill.llm.transducer import Transducer

VOCABULARY = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def machine():
    with open(VOCABULARY, "rb") as file:
        return Transducer(file.read())


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


CASES = [t for t in ODD_TEXTS if t] + [
    "don't 's 'tis ''s 're've o'clock'll 'l 'd", "'S 'T 'RE 'LL a'S ' '' a' 'sx 'rea 'vex",
    "a<|endoftext|>b <|startoftext|>x <|im_end|>", "naïve ÉCOLE ñandú straße ǅ ŉ x²y 12 345",
    "!!" * 900 + "é" * 700, "ab" * 5000, prose(1, 500),
]


def test_machine_equals_library(library, machine):
    for text, got, count in zip(CASES, machine.encode(CASES), machine.count(CASES)):
        assert got.tolist() == ids(library, text) and count == len(got), text[:40]


def test_machine_equals_library_on_random_texts(library, machine):
    rng = random.Random(3)
    alphabet = "aàbcdeé'sSrvlmt 1²!$.\nİΣ日\x1c<|>½́"
    for _ in range(40):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(20)]
        for text, got, count in zip(texts, machine.encode(texts), machine.count(texts)):
            assert got.tolist() == ids(library, text) and count == len(got), repr(text)


def test_long_words_take_few_rounds(library, machine, monkeypatch):
    """A word over many chunks: all heads run again at once, not one after the other."""
    rng = random.Random(8)
    words = ["".join(rng.choice("acgt") for _ in range(60_000)), "a" * 5000, "é" * 3000 + "x"]
    calls = []
    slots = machine._slots
    monkeypatch.setattr(machine, "_slots", lambda keys: calls.append(1) or slots(keys))
    got = machine.encode(words[:1])[0]
    assert got.tolist() == ids(library, words[0]) and len(calls) < 4 * 256
    for word, count in zip(words, machine.count(words)):
        assert count == len(ids(library, word))


def test_equal_words_are_run_once_per_slice(library, machine, monkeypatch):
    texts = [prose(i, 300) for i in range(3)]
    sizes = []
    run = machine.run
    monkeypatch.setattr(machine, "run", lambda codes, fresh: sizes.append(len(codes)) or run(codes, fresh))
    want = [ids(library, text) for text in texts]
    for times in (1, 40):
        assert machine.count(texts * times).tolist() == [len(x) for x in want] * times
        assert [x.tolist() for x in machine.encode(texts * times)] == want * times
    # Nearly all words of the copies are known; the bytes run are those of few more.
    assert max(sizes) < 1.2 * min(sizes) < sum(map(len, texts))


def test_words_are_told_apart_by_all_their_bytes(library, machine):
    """Words around the limits of the comparison that differ in their last bytes or length alone."""
    words = [w * n + end for w in "a\x00" for n in (1, 7, 8, 9, 15, 16, 17) for end in ("", "\x00", "b", "é")]
    texts = [" ".join(words * 3), *words, "\n".join(reversed(words))]
    for text, got, count in zip(texts, machine.encode(texts), machine.count(texts)):
        assert got.tolist() == ids(library, text) and count == len(got), repr(text)


def test_transitions_are_built_many_at_a_time(monkeypatch):
    with open(VOCABULARY, "rb") as file:
        machine = Transducer(file.read())
    built = []
    build = machine._build
    monkeypatch.setattr(machine, "_build", lambda keys: built.append(np.size(keys)) or build(keys))
    rng = random.Random(4)
    machine.count([" ".join("".join(rng.choices("etaoinsh", k=9)) for _ in range(20_000))])
    assert sum(built) > 50_000 and len(built) < 200


def test_tokens_stay_beside_each_other_as_when_encoded(machine):
    rng, merges = random.Random(5), machine.merges
    tokens = list(merges.token_of.values())
    inner = [t for t in tokens if merges.symbols[t][-1] < 256]
    for _ in range(3000):
        a, b = rng.choice(inner), rng.choice(tokens)
        together = merges.encode(merges.symbols[a] + merges.symbols[b]) == [a, b]
        assert merges.beside(a, b) == together


def test_token_counts(spark, library):
    rows = token_counts(odd(spark), VOCABULARY, limit=100).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    texts = dict(enumerate(ODD_TEXTS)) | {None: "no id here"}
    for row in rows:
        text = texts[row.doc_id] or ""
        want = len(ids(library, text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), want, want > 100)
    assert token_counts(empty(spark), VOCABULARY).count() == 0


def test_search_never_loses_items_and_beats_the_plain_fit():
    rng = np.random.default_rng(1)
    for capacity, n, low, high in ((100, 300, 20, 70), (100, 200, 1, 100), (2048, 500, 300, 900)):
        lengths = rng.integers(low, high + 1, n).tolist()
        bins = pack(lengths, capacity)
        assert sorted(i for b in bins for i in b) == list(range(n))
        assert max(sum(lengths[i] for i in b) for b in bins) <= capacity
        assert -(-sum(lengths) // capacity) <= len(bins) <= len(best_fit(lengths, capacity))


def test_search_exchanges_where_best_fit_cannot():
    # Best fit needs four bins of 10; exchanging items makes three full ones.
    lengths = [6, 5, 5, 4, 3, 3, 2, 2]
    assert len(pack(lengths, 10)) == 3
    assert pack([], 10) == [] and pack([10], 10) == [[0]]


def test_search_empties_bins_that_best_fit_leaves():
    rng = np.random.default_rng(0)
    lengths = rng.integers(20, 71, 3000).tolist()
    assert len(pack(lengths, 100)) < len(best_fit(lengths, 100))


def test_packing_is_exact_and_gapless(spark, library):
    texts = [prose(i, 40 + 37 * i % 900) for i in range(60)] + [None, "", prose(99, 5000)]
    rows = best_fit_packing(frame(spark, texts), VOCABULARY).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
        places[row.sequence_id].append((row.offset, row.length))
    for doc, text in enumerate(texts):
        want = np.array(ids(library, text) + [0], dtype="<u4")
        found = sorted(pieces[doc], key=lambda r: r.piece)
        assert [r.start for r in found] == list(range(0, len(want), 2048))
        for r in found:
            content = want[r.start : r.start + r.length].tobytes()
            assert r.length == min(2048, len(want) - r.start)
            assert r.ids_crc32 == zlib.crc32(content)
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(places) <= -(-total // 2048) + 1


def test_packing_in_several_groups_and_rounds(spark):
    lengths = [(i, 0, 0, 1 + (i * 7919) % 99, 0) for i in range(3000)]
    pieces = spark.createDataFrame(lengths, "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = pack_pieces(pieces, capacity=100, group_pieces=300, reopen_below=1.0).collect()
    fills = Counter()
    for r in rows:
        fills[r.sequence_id] += r.length
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    assert max(fills.values()) <= 100
    # Groups this small spend their small pieces apart; one group of all is nearly perfect.
    least = -(-sum(x[3] for x in lengths) // 100)
    assert len(fills) <= 1.05 * least
    assert len(pack([x[3] for x in lengths], 100)) <= 1.005 * least


def test_packing_of_odd_and_no_rows(spark):
    rows = best_fit_packing(odd(spark), VOCABULARY).collect()
    assert {r.doc_id for r in rows} == {None, *range(len(ODD_TEXTS))}
    assert sum(r.doc_id == 3 for r in rows) == 2
    assert best_fit_packing(empty(spark), VOCABULARY).count() == 0


def test_permutation_is_one_to_one_and_keyed():
    for n in (1, 2, 3, 5, 64, 65, 1000, 4097):
        order = Permutation(n, 42)
        slots = order.slot(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n))
        assert order.number(slots).tolist() == list(range(n))
    a, b = (Permutation(1000, key).slot(np.arange(1000)) for key in (1, 2))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def test_shards_hold_every_sequence_at_its_slot(spark, library, folder):
    layout = Layout(sequence_tokens=16, shard_sequences=10)
    texts = [prose(i, 3 + i) for i in range(30)] + [None, ""]
    documents = frame(spark, texts).repartition(3, "doc_id")
    documents.write.parquet(f"{folder}/documents")
    documents = spark.read.parquet(f"{folder}/documents")
    manifest = write_training_order(documents, VOCABULARY, f"{folder}/shards", 9, layout)
    rows = read_sequences(spark, manifest, layout).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert [(r.shard, r.offset) for r in rows] == [
        (s // 10, s % 10 * layout.record.itemsize) for s in range(len(rows))
    ]
    found = defaultdict(dict)
    for r in rows:
        assert r.length == len(r.tokens) // 2
        found[r.id][r.piece] = np.frombuffer(r.tokens, "<u2").tolist()
    for doc, text in enumerate(texts):
        got = [t for _, piece in sorted(found[doc].items()) for t in piece]
        assert got == ids(library, text) + [0]
    # Reading resumes anywhere.
    rest = read_sequences(spark, manifest, layout, from_slot=23).orderBy("slot").collect()
    assert rest == rows[23:]


def test_training_order_of_odd_and_no_rows(spark):
    rows = training_order(odd(spark), VOCABULARY, key=1).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    # Binary records have a number for a missing id.
    assert {r.doc_id for r in rows} == {-1, *range(len(ODD_TEXTS))}
    assert training_order(empty(spark), VOCABULARY).count() == 0


def test_one_input_gives_one_order_per_key(spark):
    documents = frame(spark, [prose(i, 50) for i in range(20)])
    a, b, c = (
        {(r.doc_id, r.piece): r.slot for r in training_order(documents, VOCABULARY, key).collect()}
        for key in (5, 5, 6)
    )
    assert a == b and a != c and a.keys() == c.keys()
