"""Source divergence against a plain computation in whole numbers."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from pairmill.llm.divergence import count_terms, pieces, source_divergence, term_counts

SCHEMA = "doc_id long, text string, lang string, source string, value long, term string, p double"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def expected(rows, least=3, top=200, scale=10**9):
    docs, counts, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = lowered(text)
        docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang, source in groups:
        kept = [t for (la, t), n in docs.items() if la == lang and n >= least]

        def shares(names):
            n = {t: sum(counts[lang, s, t] for s in names) for t in kept}
            total = sum(n.values())
            return n, {t: 1 + scale * (n[t] + 1) // (total + len(kept)) for t in kept}

        sources = [s for la, s in groups if la == lang]
        n, p = shares([source])
        _, whole = shares(sources)
        pair = []
        for other in sources:
            if other != source:
                _, q = shares([other])
                pair.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        term = [
            (-((p[t] - whole[t]) ** 2 // whole[t]), t.encode())
            for t in kept if n[t] > 0 and p[t] > whole[t]
        ]
        for part, found, most in (("pair", pair, None), ("term", term, top)):
            for rank, (value, item) in enumerate(sorted(found)[:most], 1):
                out.append((lang, source, part, item.decode(), -value, rank))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", 0.5) for r in rows], SCHEMA)


def result(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence_equals_plain_computation(spark, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdé日" for b in "xyzÄ"] + ["UPPER", "Mixed", "İ"]
    rows = []
    for i in range(160):
        # One source has a third of all rows.
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(5)}"
        some = [words[int(rng.random() ** 2 * len(words))] for _ in range(rng.randrange(0, 30))]
        text = "".join(w + rng.choice([" ", "\n", "1", "-", "\x00", ", "]) for w in some)
        rows.append((i, text, rng.choice(["en", "de"]), source))
    assert result(source_divergence(frame(spark, rows), top_terms=7)) == expected(rows, top=7)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "x y", "en", "b"), (3, "x y", "en", "b"),
        (4, "X z", "en", "a"), (None, "x", "en", None), (5, "12 34", "fr", "a"), (6, "q", "fr", "b"),
        (7, "long " * 300_000, "en", "b"), (8, "l" * 3_000_000, "en", "a"),
    ]
    found = result(source_divergence(frame(spark, rows)))
    assert found == expected(rows)
    # A language that keeps no term still has its pairs.
    assert ("fr", "a", "pair", "b", 0, 1) in found
    assert result(source_divergence(frame(spark, []))) == []


def test_tasks_hold_a_bounded_number_of_entries():
    texts = [f"t{i} shared" for i in range(500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 500), pa.array(["s"] * 500), pa.array(texts)],
        ["lang", "source", "text"],
    )
    # Digits separate, so all documents have the same two terms; letters make them differ.
    sent = list(count_terms(iter([batch]), most=1))
    assert len(sent) == 500
    assert sum(n for part in sent for n in part.column(3).to_pylist()) == 1000


def test_long_texts_are_cut_at_separators_only():
    text = b"ab " * 50 + b"c" * 40 + b" d"
    assert b" ".join(pieces(text, 16)) == text
    assert all(len(p) <= 16 or p == b"c" * 40 for p in pieces(text, 16))
    assert term_counts("Aa1aA\x00Éa é".encode()) == Counter({b"aa": 2, "Éa".encode(): 1, "é".encode(): 1})
