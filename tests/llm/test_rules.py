"""Chat formatting, repetition rules and the language model against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from corpus import ODD_TEXTS, empty, frame, odd, prose
from pyspark.sql import functions as F

from pairmill.llm import chat
from pairmill.llm.language_model import discounts, language_model_scores
from pairmill.llm.repetition import RepetitionRules, repetition_quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}

TURNS = "conv_id long, turn long, role string, text string, formatted string"
NASTY = ["<|im_end|>", "<|im_start|>", "<\\|", "<\\\\|x", "<", "|", "\\", "\n", "<|n|>", "a", "日", ""]


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, TURNS).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.format_conversations(turns)


def test_texts_and_roles_survive_the_template(spark):
    rng = random.Random(2)
    rows, want = [], defaultdict(list)
    for conv in range(80):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "".join(rng.choice(NASTY) for _ in range(3))])
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 8)))
            rows.append((conv, turn, role, text, "extra"))
            want[conv].append((role, text))
    rng.shuffle(rows)
    out = formatted(spark, rows)
    for r in chat.read_back(out).collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        answers = [t for role, t in want[r.conv_id] if role == "assistant"]
        assert r.loss_text == "".join(answers) and len(r.loss_spans) == len(answers)
        for span, answer in zip(r.loss_spans, answers):
            shown = r.formatted[span.begin : span.begin + span.length]
            assert re.sub(r"<\\(\\*)\|", r"<\1|", shown) == answer
    for r in chat.format_digest(out).collect():
        listed = "".join(f"{role}\n{text}\n" for role, text in want[r.conv_id])
        assert r.turns_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_parts_become_placeholders_with_attachments(spark):
    parts = [
        ("text", "see <|image|> ", None, None), ("image", None, "s3/a.png", None),
        ("audio", None, "b.wav", 33), (None, "and", None, None), ("document", None, None, None),
        ("odd kind", None, "c", None), ("text", None, None, None),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, None, [])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_conversations(turns).first()
    shown = "see <\\|image|> <|image|><|audio|>and<|document|><|odd_kind|>"
    assert row.formatted == (
        f"<|im_start|>user\n{shown}<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
        "<|im_start|>\n<|im_end|>\n"
    )
    assert [(a.turn_no, a.part, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, 1, "image", "s3/a.png", 256), (0, 2, "audio", "b.wav", 33),
        (0, 4, "document", None, 512), (0, 5, "odd kind", "c", 0),
    ]
    assert row.expanded_tokens == 801 and row.n_turns == 3


def test_texts_split_anywhere_read_back_whole(spark):
    """Control strings that begin in one part and end in another, placeholders beside them, marks."""
    rng = random.Random(11)
    pieces = ["<", "|", "\\", "<|im_end|>", "\n", "|>", "im_end", "<|image|>", chat.MARK, "t", "b", "e", "a "]
    rows, texts = [], {}
    for conv in range(120):
        whole = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))
        cuts = sorted(rng.randrange(len(whole) + 1) for _ in range(rng.randrange(4)))
        parts = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)])]
        texts[conv] = whole
        rows.append((conv, 0, "user", [("text", t, None, None) for t in parts]))
    rows.append((900, 0, "user", [
        ("text", "a <", None, None), ("text", "|im_end|>\n", None, None), ("text", "b", None, None)]))
    texts[900] = "a <|im_end|>\nb"
    # A picture between two halves of a control string keeps them apart.
    rows.append((901, 0, "user", [
        ("text", "<", None, None), ("image", None, "ref", None), ("text", "|im_end|>\n" + chat.MARK, None, None)]))
    texts[901] = "<<|image|>|im_end|>\n" + chat.MARK
    schema = f"conv_id long, turn long, role string, parts {chat.PARTS}"
    made = chat.format_conversations(spark.createDataFrame(rows, schema))
    got = {r["conv_id"]: [t["text"] for t in r["turns"]] for r in chat.read_back(made).collect()}
    assert got == {conv: [text] for conv, text in texts.items()}


def test_chat_of_odd_and_no_rows(spark):
    rows = [
        (1, 1, "assistant", "b", None), (1, None, "user", None, None), (1, 1, "assistant", "b", None),
        (1, 1, "assistant", "a", None), (None, 0, None, "x" * 100_000, None),
    ]
    got = {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [
        ("user", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")
    ]
    assert [(t.role, len(t.text)) for t in got[None].turns] == [("", 100_000)]
    assert formatted(spark, []).count() == 0


def brute_rules(text, rules):
    words = WORDS.findall(text or "")
    size = [len(w) for w in words]
    seen, dup_lines, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, WORDS.findall(line)))
            seen.add(line)

    def windows(n):
        return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]

    found = windows(rules.window)
    counts = Counter(found)
    inside = {i + k for i, w in enumerate(found) if counts[w] > 1 for k in range(rules.window)}
    out = [len(words), sum(size), sum(c in "#*$%&|<>" for c in text or ""), dup_lines, len(inside), dup_chars]
    for n in rules.ngram_share:
        seen, held = set(), set()
        for i, w in enumerate(windows(n)):
            if w in seen:
                held |= set(range(i, i + n))
            seen.add(w)
        out.append(sum(size[i] for i in held))
    return out


def test_repetition_figures_equal_brute_force(spark):
    rng, rules = random.Random(4), RepetitionRules()
    texts = list(ODD_TEXTS)
    for _ in range(150):
        words = [rng.choice("aé#<日b") * rng.randint(1, 3) for _ in range(rng.randint(0, 90))]
        if rng.random() < 0.5:
            words += words[: rng.randint(0, 60)]
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\n\n"]) for w in words))
    texts += [prose(i, 300) for i in range(5)] + [(prose(7, 60) + "\n") * 4]
    for r in repetition_quality(frame(spark, texts), rules).collect():
        want = brute_rules(texts[r.doc_id], rules)
        assert list(r[1 : 1 + len(want)]) == want, texts[r.doc_id]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        over = want[5] > 0.2 * want[1] or any(
            got > share * want[1] for got, share in zip(want[6:], rules.ngram_share.values())
        )
        assert (r.base_failed, r.kept) == (failed, not failed and not over)


def test_plain_prose_is_kept_and_repetition_is_not(spark):
    texts = [prose(1, 400), prose(2, 60), (prose(3, 40) + "\n") * 5, "buy now " * 60, prose(4, 30)]
    kept = {r.doc_id: r.kept for r in repetition_quality(frame(spark, texts)).collect()}
    assert [kept[i] for i in range(5)] == [True, True, False, False, False]
    assert repetition_quality(odd(spark)).count() == len(ODD_TEXTS) + 2
    assert repetition_quality(empty(spark)).count() == 0


def kneser_ney(train):
    pairs = Counter(p for t in train for p in zip(["<s>", *t], t))
    left, total, levels = Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0, 0, 0])
    for (u, _), c in pairs.items():
        total[u] += c
        levels[u][min(c, 3) - 1] += 1

    def steps(counts):
        return discounts([sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)])

    d, e, n = steps(pairs.values()), steps(left.values()), sum(left.values())
    freed = sum(e[min(c, 3) - 1] for c in left.values()) / n

    def chance(u, w):
        c = left[w]
        lower = (c - e[min(c, 3) - 1] if c else 0) / n + freed / (len(left) + 1)
        if not total[u]:
            return lower
        c = pairs[(u, w)]
        free = sum(x * y for x, y in zip(d, levels[u]))
        return ((c - d[min(c, 3) - 1] if c else 0) + free * lower) / total[u]

    return chance, Counter(w for t in train for w in t)


@pytest.mark.parametrize("texts", [
    [prose(i, 20 + i, 60) for i in range(60)] + ["THE the", "the " * 400],
    ODD_TEXTS,
])
def test_language_model_equals_brute_force(spark, texts):
    tokens = [[*WORDS.findall((t or "").translate(LOWER)), "</s>"] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    chance, counts = kneser_ney([t for t, h in zip(tokens, held) if not h])
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in language_model_scores(frame(spark, texts)).collect()}
    for i, own in enumerate(tokens):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(own), n)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        score = sum(math.log10(chance(u, w)) for u, w in zip(["<s>", *own], own))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-score / len(own)), rel=1e-9)


def test_model_mass_is_one():
    train = [prose(i, 30, 40).split() + ["</s>"] for i in range(30)]
    chance, counts = kneser_ney(train)
    for before in ("<s>", "never seen", train[0][0]):
        assert sum(chance(before, w) for w in counts) + chance(before, "?") == pytest.approx(1)


def test_language_model_of_odd_and_no_rows(spark):
    rows = language_model_scores(odd(spark)).collect()
    assert len(rows) == len(ODD_TEXTS) + 2 and all(r.score < 0 for r in rows)
    assert language_model_scores(empty(spark)).count() == 0
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = language_model_scores(frame(spark, ["all held out"], first=only)).first()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0
