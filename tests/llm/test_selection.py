"""Classifiers, similarity join, decontamination and the pipeline."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from corpus import ODD_TEXTS, empty, frame, odd, prose
from pyspark.sql import functions as F

import corpus_pipeline
from pairmill.llm import jaccard, pu
from pairmill.llm.components import connected_components
from pairmill.llm.quality import quality_scores
from pairmill.llm.sampling import pu_sample
from pairmill.llm.scan import slices
from pairmill.llm.selection import without
from pairmill.llm.templates import contaminated
from pairmill.llm.toxicity import toxicity_scores

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def rank_quality(scores, labels):
    """Chance that a positive scores above a negative."""
    pairs = [
        (a > b) + 0.5 * (a == b)
        for a, x in zip(scores, labels) if x for b, y in zip(scores, labels) if not y
    ]
    return sum(pairs) / len(pairs)


def test_risk_is_unbiased_and_never_trained_below_zero():
    rng = np.random.default_rng(0)
    margin_p, margin_n = rng.normal(1, 1, 200_000), rng.normal(-1, 1, 200_000)
    prior = 0.3
    unlabelled = np.concatenate([margin_p[:30_000], margin_n[:70_000]])
    _, negative = pu.risk_parts(margin_p, unlabelled, prior)
    assert negative == pytest.approx(0.7 * np.logaddexp(0, margin_n).mean(), rel=0.02)
    # Unlabelled rows that are all positive would drive the plain estimate far below zero.
    same = rng.normal(size=(300, 40))
    model = pu.fit(same, same, 0.9)
    parts = pu.risk_parts(*(same @ model.weights + model.bias,) * 2, 0.9)
    assert parts[1] > -0.2


def test_positive_unlabelled_learning_finds_the_boundary():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, (500, 3))
    truth = rng.random(2000) < 0.4
    unlabelled = np.where(truth[:, None], rng.normal(2, 1, (2000, 3)), rng.normal(-2, 1, (2000, 3)))
    model = pu.fit(positive, unlabelled, 0.4)
    assert ((model.score(unlabelled) > 0.5) == truth).mean() > 0.97
    flat = pu.fit(np.zeros((0, 3)), unlabelled, 0.4)
    assert np.allclose(flat.score(unlabelled), 0.4)


def quality_corpus():
    texts, labels = [], []
    for i in range(300):
        text = prose(i, 60 + i % 90)
        if i % 5 == 0:
            text = " ".join(w + "$$$" for w in text.split()) if i % 2 else text.upper().replace(" ", "!! ")
        texts.append(text)
        labels.append(int(i % 5 != 0))
    return texts, labels


def test_quality_on_held_out_documents(spark):
    texts, labels = quality_corpus()
    marks = labelled(spark, [(i, q, 0) for i, q in enumerate(labels)])
    rows = quality_scores(frame(spark, texts), marks).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out]
    assert len(held) > 50 and rank_quality(*zip(*held)) > 0.98
    again = quality_scores(frame(spark, texts), marks).collect()
    assert {r.doc_id: r.score for r in rows} == {r.doc_id: r.score for r in again}


def test_toxicity_on_held_out_documents(spark):
    rng, texts, labels = random.Random(6), [], []
    for i in range(500):
        words = prose(i, 80).split()
        toxic = i % 7 == 0
        for _ in range(4 * toxic):
            words.insert(rng.randrange(80), rng.choice(["Vorlik,", "vorlik", "GRAMPFÉN!!", "grampfém"]))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    marks = labelled(spark, [(i, 1, t) for i, t in enumerate(labels)])
    rows = toxicity_scores(frame(spark, texts), marks).collect()
    held = [r for r in rows if r.held_out]
    assert rank_quality([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.98
    assert all(r.predicted == labels[r.doc_id] for r in held)


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_classifiers_of_odd_and_no_rows(spark, scores):
    marks = labelled(spark, [(0, 1, 1), (3, None, None), (3, 1, 1), (None, 1, 1), (8, 0, 0), (9, 0, 1)])
    rows = scores(odd(spark), marks).collect()
    assert len(rows) == len(ODD_TEXTS) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert scores(empty(spark), marks).count() == 0
    none = scores(frame(spark, ["a b", "c"]), labelled(spark, [])).collect()
    assert len({r.score for r in none}) == 1


def test_samples_are_bounded_and_leave_the_fold_out(spark):
    documents = spark.range(4000).select(F.col("id").alias("doc_id"))
    marks = documents.select("doc_id", F.lit(1).alias("toxic"))
    settings = pu.PuSettings(max_positive=300, max_unlabelled=500)
    sample = pu_sample(documents, marks, "toxic", 4, 2, settings)
    rows = sample.keys.collect()
    assert 200 < sum(r.positive for r in rows) < 400 and 380 < sum(not r.positive for r in rows) < 620
    left = documents.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    assert sample.keys.join(left, F.col("_id") == F.col("doc_id")).count() == 0


def brute_components(texts, n, percent):
    sets = []
    for text in texts:
        w = WORDS.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and common:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def near_copies(seed):
    rng, texts = random.Random(seed), list(ODD_TEXTS)
    for group in range(25):
        size = rng.choice([1, 2, 3, 4, 6, 9, 12, 20, 25, 33, 60, 150])
        base = prose(1000 * seed + group, size, 300).split()
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(words))
                action = rng.random()
                if action < 0.4:
                    words[at] = f"n{rng.randrange(99)}"
                elif action < 0.7:
                    words.insert(at, f"i{rng.randrange(99)}")
                elif len(words) > 1:
                    del words[at]
            texts.append(rng.choice([" ", "\n"]).join(words).upper() if rng.random() < 0.2 else " ".join(words))
    passage = prose(77, 60)
    texts += [f"{prose(5000 + i, 8)} {passage}" for i in range(12)]
    return texts


@pytest.mark.parametrize("n, percent, block", [(3, 90, 256), (5, 80, 4), (1, 50, 3), (2, 100, 256)])
def test_join_equals_brute_force(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "BUCKET_SHINGLES", 500)
    texts = near_copies(n)
    got = jaccard.jaccard_components(frame(spark, texts).repartition(5), n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, n, percent)


@pytest.mark.parametrize("percent", [10, 50, 80, 90, 100])
def test_linked_sets_share_what_is_looked_for_among_few_sent_shingles(percent):
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(3000):
        x = rng.choice(400, rng.integers(1, 200), replace=False)
        spare = rng.integers(0, len(x) * (100 - percent) // 100 + 1)
        y = np.union1d(x[: len(x) - spare], rng.choice(400, rng.integers(0, spare + 1), replace=False))
        common = len(np.intersect1d(x, y))
        if not common or 100 * common < percent * (len(x) + len(y) - common):
            continue
        linked += 1
        few = [np.sort(s)[: jaccard.sent_sizes(np.array([len(s)]), percent)[0]] for s in (x, y)]
        for s in (x, y):
            least = np.array([jaccard.needed(len(s), percent)])
            assert len(np.intersect1d(*few)) >= jaccard.sent_common(least, percent)[0]
    assert linked > 300
    assert jaccard.sent_sizes(np.array([1000]), 90)[0] == 300


def test_a_slice_sends_only_the_smallest_shingles():
    texts = [prose(40 + i, 1000) for i in range(5)]
    (part,) = slices(pa.array(texts), 1 << 20)
    _, owners = jaccard.shingles(part, 3)
    rows = list(jaccard._sent(part, 3, 90, 4))
    sent = sum(len(r[1]) + len(r[3]) for r in rows) // 6
    assert len(rows) == 4 and 0.2 * len(owners) < sent < 0.31 * len(owners)


@pytest.mark.parametrize("boundary", [0, 12, 40])
def test_join_is_the_same_wherever_the_boundary_lies(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *a: boundary)
    texts = near_copies(9)
    got = jaccard.jaccard_components(frame(spark, texts), 3, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 3, 80)


@pytest.mark.parametrize("n, percent, block, boundary", [(3, 80, 256, 0), (3, 80, 8, 12)])
def test_links_are_counted(spark, monkeypatch, n, percent, block, boundary):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *a: boundary)
    texts = near_copies(4)
    sets = []
    for text in texts:
        w = WORDS.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    want = dict.fromkeys(range(len(texts)), 0)
    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            want[a] += 1
            want[b] += 1
    documents = frame(spark, texts)
    rows = jaccard.jaccard_components(documents, n, percent).collect()
    assert {r.doc_id: r.n_links for r in rows} == want
    assert "n_links" not in jaccard.jaccard_components(documents.limit(0), n, percent, count_links=False).columns


def test_subsets_are_those_that_links_need():
    for percent in (50, 80, 90, 100):
        for a, b in itertools.combinations_with_replacement(range(1, 30), 2):
            common = jaccard.overlap(a, b, percent)
            assert 100 * common >= percent * (a + b - common)
            assert 100 * (common - 1) < percent * (a + b - common + 1)
            linked = common <= a
            assert linked == ((a, b, a - common) in jaccard.subsets_of(a, percent))
            assert linked == ((a, b, b - common) in jaccard.subsets_of(b, percent))


def test_join_of_odd_and_no_rows(spark):
    rows = jaccard.jaccard_components(odd(spark)).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    assert {r.n_shingles for r in rows if r.doc_id in (0, 1, 2, 4)} == {0}
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id == 3} == {(3, 3)}
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(6, 40)] + [(1, 2), (2, 3), (3, 1)]
    random.Random(1).shuffle(edges)
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.component for r in rows}
    assert len(rows) == len(found)
    assert found == {
        **{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 40)}, **{i: 1 for i in (1, 2, 3)}
    }
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEM = (
    "Alice walks 12 km to the old mill and then meets Robert near the bridge. After 3 hours she "
    "and Robert carry 45 kg of flour back to the village where Robert lives with 2 dogs."
)


def test_items_are_found_with_changed_numbers_names_and_units(spark):
    other = ITEM.replace("12 km", "7 miles").replace("Robert", "Dagmar").replace("45 kg", "80 lb")
    # Robert becomes two people: the slots do not agree.
    torn = other.replace("where Dagmar lives", "where Ingrid lives")
    texts = [
        prose(1, 80), f"{prose(2, 30)} {ITEM} {prose(3, 30)}", f"{prose(4, 30)}\n{other}\n{prose(5, 10)}",
        f"{other} {other.replace('Dagmar', 'Ingrid')}", torn, None, "", ITEM.upper(),
    ]
    items = spark.createDataFrame([(1, ITEM), (2, prose(9, 40)), (3, None), (4, "too short")], "item_id long, text string")
    rows = contaminated(frame(spark, texts), items).collect()
    got = {(r.doc_id, r.item_id): r for r in rows}
    assert {k for k in got if k[0] in (1, 2, 3)} == {(1, 1), (2, 1), (3, 1)}
    assert not got[(1, 1)].reparameterised and got[(2, 1)].reparameterised
    # At the start of a text the first word is no name, so a window may differ there.
    assert min(got[(i, 1)].windows for i in (1, 2, 3)) >= 27
    assert not any(k[0] in (0, 5, 6) for k in got)
    assert (4, 1) not in got
    assert all(r.coverage == r.windows / r.item_windows for r in rows)


def test_one_edited_occurrence_does_not_hide_an_item(spark):
    words = prose(21, 60).split()
    words[10] = words[40] = "2023"
    dated = " ".join(words)
    edited = " ".join([*words[:40], "2024", *words[41:]])
    other = ITEM.replace("12 km", "7 miles").replace("45 kg", "80 lb")
    torn = other.replace("Robert", "Dagmar").replace("where Dagmar lives", "where Ingrid lives")
    texts = [
        f"{prose(2, 30)} {edited} {prose(3, 30)}", ITEM.upper(), ITEM.replace("3 hours", "2 hours").replace("2 dogs", "3 dogs"),
        ITEM.replace("where Robert lives", "where Ingrid lives"), other.replace("where Robert lives", "where Ingrid lives"), torn,
        ITEM.replace("12 km", "2 km").replace("2 dogs", "9 dogs"),
    ]
    items = spark.createDataFrame([(0, dated), (1, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(frame(spark, texts), items).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 1), (3, 1), (4, 1), (6, 1)}
    # 53 windows, of which the edit stands in 8.
    assert (got[(0, 0)].windows, got[(0, 0)].item_windows, got[(0, 0)].reparameterised) == (45, 53, True)
    assert got[(1, 1)].coverage == 1 and got[(3, 1)].coverage > 0.8 and got[(4, 1)].coverage > 0.8


TRAINS = "Train A travels 60 km in 2 hours; Train B 90 km in 3 hours"
SUMS = "12 + 30 = 42, 17 + 8 = 25, 9 + 40 = 49, 81 + 3 = 84"
SHORT = "x 17 18 19 20"
TABLE = "year " + " ".join(f"{i} {i * i} kg" if i % 3 else f"{i} {i * i} kg per head" for i in range(1, 40))


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_number_heavy_items_are_found(spark, monkeypatch, bound):
    from pairmill.llm import templates

    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", bound)
    items = [TRAINS, SUMS, SHORT, TABLE]
    texts = [f"{prose(i, 30)} and {item} {prose(50 + i, 30)}" for i, item in enumerate(items)]
    texts += items + [TABLE.replace("kg", "lb"), SUMS.replace("1", "7"), prose(3, 90)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in contaminated(frame(spark, texts), benchmark).collect()}
    assert set(rows) == {*((i, i) for i in range(4)), *((4 + i, i) for i in range(4)), (8, 3)}
    assert all(r.coverage == 1 for k, r in rows.items() if k[0] < 8)
    # The table repeats itself, so it also meets itself further on with other values.
    assert not any(r.reparameterised for k, r in rows.items() if k[1] < 3)
    # Here only windows that were lengthened have four literals.
    assert rows[(8, 3)].reparameterised and rows[(8, 3)].coverage > 0.5


def test_decontamination_beyond_the_broadcast_bound_is_the_same(spark, monkeypatch):
    from pairmill.llm import templates

    rng, items = random.Random(8), [prose(100 + i, 30, 200) for i in range(20)]
    texts = [f"{prose(i, 40)} {rng.choice(items)} {prose(50 + i, 20)}" for i in range(40)]
    texts += [prose(900 + i, 60) for i in range(20)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = sorted(contaminated(frame(spark, texts), benchmark).collect())
    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", 0)
    assert sorted(contaminated(frame(spark, texts), benchmark).collect()) == one
    want = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if item in t}
    assert {(r.doc_id, r.item_id) for r in one} == want


def test_decontamination_of_odd_and_no_rows(spark):
    items = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, "word word word word word word")], "item_id long, text string")
    contaminated(odd(spark), items).collect()
    assert contaminated(empty(spark), items).count() == 0
    assert contaminated(frame(spark, [ITEM]), items.limit(0)).count() == 0


def test_rows_are_dropped_by_id(spark, monkeypatch):
    from pairmill.llm import selection

    rows, ids = odd(spark), spark.createDataFrame([(3,), (3,), (None,)], "doc_id long")
    for bound in (10, 0):
        monkeypatch.setattr(selection, "BROADCAST_IDS", bound)
        left = [r.doc_id for r in without(rows, ids, "doc_id").collect()]
        assert sorted(x for x in left if x is not None) == [i for i in range(len(ODD_TEXTS)) if i != 3]
        assert None in left


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark, folder):
    texts, quality = quality_corpus()
    toxic = [0] * len(texts)
    for i in range(1, 300, 9):
        if quality[i]:
            words = texts[i].split()
            words[5:5] = ["vorlik", "grampf", "vorlik"]
            texts[i], toxic[i] = " ".join(words), 1
    clean = [i for i in range(300) if quality[i] and not toxic[i]]
    copy, near, leak = len(texts), len(texts) + 1, len(texts) + 2
    words = texts[clean[-1]].split()
    words[-1] = "changed"
    item = prose(12345, 40)
    texts += [texts[clean[0]], " ".join(words), f"{prose(777, 60)} {item} {prose(778, 60)}"]
    rows = [(i, t, "en", "src", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labelled(spark, [(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic))]).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    kept = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    assert not kept & {copy, near, leak}
    assert len(kept & set(clean)) >= 0.97 * len(clean)
    bad = [i for i in range(300) if not quality[i] or toxic[i]]
    assert len(kept & set(bad)) <= 0.03 * len(bad)


def test_every_stage_stands_odd_rows_clashing_names_and_empty_tables(spark, folder):
    rows = odd(spark).withColumns({"quality": F.lit("mine"), "component_id": F.col("doc_id")})
    marks = [(0, 1, 1), (3, None, 0), (None, 1, 1), (8, 0, 0), (9, 1, 0)]
    labelled(spark, marks).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (None, None)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    for documents in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, documents, folder)
            count = out.count()
            if name != "best_fit_packing":
                assert out.columns == documents.columns
                assert count <= documents.count()
            assert documents is rows or count == 0
