"""A byte-pair tokenizer compiled to a deterministic transducer that runs on whole arrays.

The merges of a vocabulary file become a machine that reads the bytes of a word from left to
right. Every transition is annotated with the last token of the prefix read so far and with the
change of its token count. Two prefixes share a state when no further byte can tell them apart:
the state keeps those suffixes that may still grow into a token, and for each of them the token
before it. (The last token of a prefix is the one vocabulary entry that ends there and stays
beside the token before it when the two are encoded together.) States are built when first
reached, all that one step of a slice lacks at once, and then live in a hash table of numpy arrays.

Texts are worked on in slices. Of a slice the distinct words stand one after the other, as long as
they are short; longer words stand as often as they come. That stream is cut into chunks that
advance in step, one byte of each at a time, all from the start state. What a chunk does to another state is the same from the first word start on, or from where
the two runs meet, which is mostly within a few bytes. So a prefix scan over the chunks hands every
chunk the state its predecessor ends in, and only heads run again, all at once, until they meet
what is there; a chunk whose end changes hands on its new state in the next round.

Words are those of the split rule ``'s|'t|'re|'ve|'m|'ll|'d|letters|one number|others`` on lower
case. Characters beyond U+024F, control separators, the dotted capital I and special tokens are
left to the tokenizer library, per run of text between white space.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from pairmill.llm.scan import Slice, kept

LAST_PLAIN = 0x24F
CHUNK = 32
START = 0
WORD_END = "</w>"
# A worker's machine is compiled anew beyond this many states, which bounds its memory.
MOST_STATES = 300_000
# Code of a byte inside a word; the last byte of a word has 256 more.
CODES = 512
# Token numbers and the changes of their count take so many bits where they are packed.
TOKEN_BITS = 24
WEIGHT_BITS = 8
TOKEN_MASK = (1 << TOKEN_BITS) - 1
TARGET_SHIFT = TOKEN_BITS + WEIGHT_BITS
# Equal words up to this many bytes are run once per slice.
SHORT_WORD = 16
# What keeps the first 0 to 8 bytes of eight, and multipliers (any odd numbers would do).
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
KEY_STEPS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

# Fixed values of the split rule: what may follow an apostrophe as one word.
ONE_LETTER = np.zeros(256, dtype=bool)
ONE_LETTER[list(b"stmd")] = True
TWO_LETTERS = [(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))]

SEPARATE, LETTER, NUMBER, OTHER = range(4)


def _kinds() -> np.ndarray:
    kinds = np.full(LAST_PLAIN + 1, OTHER, dtype=np.uint8)
    for code in range(LAST_PLAIN + 1):
        letter = chr(code)
        category = unicodedata.category(letter)[0]
        if letter.isspace() and not 0x1C <= code <= 0x1F:
            kinds[code] = SEPARATE
        elif category in "LN":
            kinds[code] = LETTER if category == "L" else NUMBER
    return kinds


KINDS = _kinds()
# Texts need care where a character is not plain, or white space to Python alone.
CONTROLS = "\x1c\x1d\x1e\x1f"
UNPLAIN = re.compile(f"[{CONTROLS}İ\\U{LAST_PLAIN + 1:08x}-\U0010ffff]")
BLANKS = "".join(chr(c) for c in range(LAST_PLAIN + 1) if KINDS[c] == SEPARATE)
BLANKS += "".join(chr(c) for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
BETWEEN = re.compile(f"[{BLANKS}]+")


def _printable_bytes() -> list[str]:
    """The public one-to-one map from bytes to printable characters of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = {b: chr(b) for b in plain}, 256
    for byte in range(256):
        if byte not in signs:
            signs[byte] = chr(extra)
            extra += 1
    return [signs[b] for b in range(256)]


class Table:
    """Numbers by 64-bit keys in open addressing, looked up and added many at a time."""

    EMPTY = np.uint64((1 << 64) - 1)

    def __init__(self, slots: int = 1 << 16):
        self._allocate(slots)

    def _allocate(self, slots: int) -> None:
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.mask = slots - 1
        self.key = np.full(slots, self.EMPTY, dtype=np.uint64)
        self.value = np.zeros(slots, dtype=np.int64)
        self.used = 0

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * KEY_STEPS[0]) >> self.shift).astype(np.int64)

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct new keys."""
        slots = len(self.key)
        while 2 * (self.used + len(keys)) > slots:
            slots *= 2
        if slots > len(self.key):
            old, held = self.key, self.value
            filled = np.flatnonzero(old != self.EMPTY)
            self._allocate(slots)
            self.insert(old[filled], held[filled])
        self.used += len(keys)
        at = self._places(keys)
        while len(keys):
            free = self.key[at] == self.EMPTY
            # Of several keys that want one slot one gets it, the others go on.
            self.key[at[free]] = keys[free]
            wrong = self.key[at] != keys
            self.value[at[~wrong]] = values[~wrong]
            keys, values, at = keys[wrong], values[wrong], (at[wrong] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of every key, and which keys are missing; those have an empty slot, value 0."""
        slots = self._places(keys)
        found = self.key[slots]
        wrong = np.flatnonzero(found != keys)
        missing = [wrong[:0]]
        while len(wrong):
            empty = found[wrong] == self.EMPTY
            if empty.any():
                missing.append(wrong[empty])
                wrong = wrong[~empty]
            slots[wrong] = (slots[wrong] + 1) & self.mask
            found[wrong] = self.key[slots[wrong]]
            wrong = wrong[found[wrong] != keys[wrong]]
        return slots, np.concatenate(missing) if len(missing) > 1 else missing[0]


class Merges:
    """The vocabulary as numbers: single symbols, merges and what each token was merged from."""

    def __init__(self, model: dict):
        self.ids = model["vocab"]
        self.pair: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = self.ids[left], self.ids[right]
            token = self.ids[left + right]
            self.pair[pair], self.made[pair] = rank, token
            if token not in self.rank:
                self.rank[token], self.parts[token] = rank, pair
        signs = _printable_bytes()
        self.inner = [self.ids[s] for s in signs]
        self.final = [self.ids[s + WORD_END] for s in signs]
        self.symbols: dict[int, tuple[int, ...]] = {}
        for code, token in enumerate(self.inner + self.final):
            self.symbols[token] = (code,)
        for token, (left, right) in sorted(self.parts.items(), key=lambda x: self.rank[x[0]]):
            self.symbols[token] = self.symbols[left] + self.symbols[right]
        self._edges: dict[tuple[int, int], list[int]] = {}
        # A token that its own symbols do not merge into is never produced.
        self.token_of = {
            codes: token for token, codes in self.symbols.items() if self._stands(token)
        }
        # Beginnings of tokens as numbered nodes, 0 the empty one. What a code makes of each, as one
        # number: the longer beginning, and the token it completes plus one (0: none of the kind).
        steps: dict[int, int] = {}
        nodes = 0
        for codes, token in self.token_of.items():
            node = 0
            for code in codes[:-1]:
                step = steps.get(node * CODES + code, 0)
                if not step >> TOKEN_BITS:
                    nodes += 1
                    step |= nodes << TOKEN_BITS
                    steps[node * CODES + code] = step
                node = step >> TOKEN_BITS
            key = node * CODES + codes[-1]
            steps[key] = steps.get(key, 0) | token + 1
        self.steps = Table()
        self.steps.insert(
            np.fromiter(steps.keys(), np.uint64, len(steps)),
            np.fromiter(steps.values(), np.int64, len(steps)),
        )
        # Known answers of ``beside``: 1 no, 2 yes.
        self._beside = Table()

    def encode(self, codes) -> list[int]:
        """The tokens of one word, by merging the best-ranked pair until none is left."""
        tokens = [self.inner[c] if c < 256 else self.final[c - 256] for c in codes]
        while len(tokens) > 1:
            rank, at = min(
                (self.pair.get(p, 1 << 60), i) for i, p in enumerate(zip(tokens, tokens[1:]))
            )
            if rank == 1 << 60:
                break
            tokens[at : at + 2] = [self.made[(tokens[at], tokens[at + 1])]]
        return tokens

    def _stands(self, token: int) -> bool:
        return token not in self.parts or self.beside_free(*self.parts[token], self.rank[token])

    def beside_free(self, left: int, right: int, before: float) -> bool:
        """No merge ranked below ``before`` joins the two across their border."""
        chain_a, chain_b = self._edge(left, 1), self._edge(right, 0)
        i, k = len(chain_a) - 1, len(chain_b) - 1
        while True:
            across = self.pair.get((chain_a[i], chain_b[k]), 1 << 60)
            grow_a = self.rank[chain_a[i - 1]] if i else 1 << 60
            grow_b = self.rank[chain_b[k - 1]] if k else 1 << 60
            # Of equal merges the leftmost is made first.
            if across < grow_a and across <= grow_b:
                return across >= before
            if not i and not k:
                return True
            if grow_a <= grow_b:
                i -= 1
            else:
                k -= 1

    def _edge(self, token: int, side: int) -> list[int]:
        """The token and what it was merged from along its left (0) or right (1) edge."""
        found = self._edges.get((token, side))
        if found is None:
            found = [token]
            while found[-1] in self.parts:
                found.append(self.parts[found[-1]][side])
            self._edges[(token, side)] = found
        return found

    def all_beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the two of each pair stay as they are when encoded together."""
        pairs = left.astype(np.uint64) << np.uint64(TOKEN_BITS) | right.astype(np.uint64)
        slots, missing = self._beside.slots(pairs)
        if len(missing):
            new = np.unique(pairs[missing])
            known = [
                1 + self.beside_free(pair >> TOKEN_BITS, pair & TOKEN_MASK, 1 << 60)
                for pair in new.tolist()
            ]
            self._beside.insert(new, np.array(known, dtype=np.int64))
            slots, _ = self._beside.slots(pairs)
        return self._beside.value[slots] == 2

    def beside(self, left: int, right: int) -> bool:
        return bool(self.all_beside(np.array([left]), np.array([right]))[0])


class Transducer:
    """The compiled machine; grows with the words it meets."""

    def __init__(self, vocabulary: bytes | str):
        self.made_from = hash(vocabulary)
        self.vocabulary = vocabulary if isinstance(vocabulary, str) else vocabulary.decode()
        spec = json.loads(self.vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("a byte-pair vocabulary with word ends is needed")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.merges = Merges(model)
        self.length = np.zeros(max(self.merges.ids.values()) + 1, dtype=np.int64)
        for token, codes in self.merges.symbols.items():
            self.length[token] = len(codes)
        # A state is a sequence of triples: a suffix that may grow, as its node, its token count less
        # that of the whole prefix, and the token before it. They lie one state after the other.
        self.states: dict[bytes, int] = {}
        self.triples = np.zeros((1 << 12, 3), dtype=np.int32)
        self.bounds = np.zeros(1 << 10, dtype=np.int64)
        self._add_states(np.array([[0, 0, -1]], dtype=np.int32), np.ones(1, dtype=np.int64))
        # Target, token and weight of each transition, packed.
        self.table = Table()
        self._library = None
        self._memo: dict[str, list[int]] = {}

    # The table of transitions.

    def _add_states(self, triples: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of states, given as their triples one after the other."""
        content, ends = triples.tobytes(), np.cumsum(sizes)
        numbers, new, known, width = [], [], self.states, triples.itemsize * 3
        for a, b in zip((width * (ends - sizes)).tolist(), (width * ends).tolist()):
            count = len(known)
            number = known.setdefault(content[a:b], count)
            new.append(number == count)
            numbers.append(number)
        added = np.array(new, dtype=bool)
        if added.any():
            rows, lengths = triples[np.repeat(added, sizes)], sizes[added]
            first = len(known) - len(lengths)
            begin = int(self.bounds[first])
            self.triples = _grown(self.triples, begin + len(rows))
            self.triples[begin : begin + len(rows)] = rows
            self.bounds = _grown(self.bounds, len(known) + 1)
            self.bounds[first + 1 : len(known) + 1] = begin + np.cumsum(lengths)
        return np.array(numbers, dtype=np.int64)

    def _build(self, keys: np.ndarray) -> None:
        """Adds the transitions of states on codes, distinct and new."""
        state, code = np.divmod(keys.astype(np.int64), CODES)
        begins = self.bounds[state]
        sizes = self.bounds[state + 1] - begins
        of = np.repeat(np.arange(len(keys)), sizes)
        node, relative, before = self.triples[_ranges(begins, sizes)].T.astype(np.int64)
        steps = self.merges.steps
        step = steps.value[steps.slots((node * CODES + code[of]).astype(np.uint64))[0]]
        # The first completed token that stays beside the one before it.
        completes = np.flatnonzero(step & TOKEN_MASK)
        token = (step & TOKEN_MASK) - 1
        stays = before[completes] < 0
        asked = np.flatnonzero(~stays)
        stays[asked] = self.merges.all_beside(before[completes[asked]], token[completes[asked]])
        completes = completes[stays]
        first = completes[np.flatnonzero(np.diff(of[completes], prepend=-1))]
        token, weight = token[first], relative[first] + 1
        if np.abs(weight).max(initial=0) >= 1 << WEIGHT_BITS - 1:
            raise OverflowError("a token count changes by more than its bits hold")
        # Inside a word, suffixes that may still grow, then the one that is begun after the token.
        inner = code < 256
        grows = np.flatnonzero((step > TOKEN_MASK) & inner[of])
        number = np.cumsum(inner) - 1
        held = np.bincount(of[grows], minlength=len(keys))[inner] + 1
        triples = np.zeros((len(grows) + len(held), 3), dtype=np.int32)
        at = np.arange(len(grows)) + number[of[grows]]
        triples[at, 0] = step[grows] >> TOKEN_BITS
        triples[at, 1] = relative[grows] - weight[of[grows]]
        triples[at, 2] = before[grows]
        triples[np.cumsum(held) - 1, 2] = token[inner]
        target = np.full(len(keys), START, dtype=np.int64)
        target[inner] = self._add_states(triples, held)
        self.table.insert(keys, target << TARGET_SHIFT | token << WEIGHT_BITS | weight + 128)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots, missing = self.table.slots(keys)
        if len(missing):
            self._build(np.unique(keys[missing]))
            slots, _ = self.table.slots(keys)
        return slots

    # Running it.

    def run(self, codes: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and count changes at every byte of a stream of words."""
        n = len(codes)
        lanes = -(-n // CHUNK)
        size = lanes * CHUNK
        grid = np.zeros(size, dtype=np.uint64)
        grid[:n] = codes
        marks = np.zeros(size, dtype=bool)
        marks[:n] = fresh
        marks[n:] = True
        grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
        marks = np.ascontiguousarray(marks.reshape(lanes, CHUNK).T)
        values = np.empty((CHUNK, lanes), dtype=np.int64)

        # The state before every byte, so that a later run sees where it meets this one.
        states = np.empty((CHUNK, lanes), dtype=np.int32)

        state = np.full(lanes, START, dtype=np.int32)
        for step in range(CHUNK):
            state[marks[step]] = START
            states[step] = state
            slots = self._slots(state.astype(np.uint64) * np.uint64(CODES) + grid[step])
            values[step] = made = self.table.value[slots]
            state = (made >> TARGET_SHIFT).astype(np.int32)

        leaving = state
        follows = ~marks[0]
        moved = np.arange(lanes - 1)
        while True:
            # Chunks that go on in a word and were run from another state than is handed to them.
            active = moved[follows[moved + 1] & (states[0, moved + 1] != leaving[moved])] + 1
            if not len(active):
                break
            state, step, changed = leaving[active - 1], 0, []
            while len(active) and step < CHUNK:
                open_ones = ~marks[step, active] & (states[step, active] != state)
                active, state = active[open_ones], state[open_ones]
                states[step, active] = state
                slots = self._slots(state.astype(np.uint64) * np.uint64(CODES) + grid[step, active])
                values[step, active] = made = self.table.value[slots]
                state = (made >> TARGET_SHIFT).astype(np.int32)
                step += 1
            leaving[active] = state
            moved = active[active < lanes - 1]
        values = values.T.reshape(-1)[:n]
        weights = (values & ((1 << WEIGHT_BITS) - 1)) - 128
        return (values >> WEIGHT_BITS & TOKEN_MASK).astype(np.int32), weights

    def _words(self, texts: list[str]):
        """The words of plain texts: (their bytes, starts and ends there, first word of each text)."""
        joined = "\n".join(texts)
        if joined.isascii():
            data = np.frombuffer(joined.encode().lower(), dtype=np.uint8)
            lead, kind = (), KINDS[data]
            lengths = list(map(len, texts))
        else:
            data = np.frombuffer(joined.lower().encode(), dtype=np.uint8)
            point = data.astype(np.int32)
            lead = np.flatnonzero(data >= 0xC0)
            point[lead] = ((point[lead] & 0x1F) << 6) | (point[lead + 1] & 0x3F)
            point[lead + 1] = point[lead]
            kind = KINDS[point]
            lengths = list(map(_utf8_length, texts))
        begin = np.ones(len(data), dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        if len(lead):
            begin[lead + 1] = False
        solid = kind != SEPARATE
        begin &= solid
        quote = np.flatnonzero((data[:-1] == 39) & begin[:-1] & (kind[1:] == LETTER))
        if len(quote):
            padded = np.concatenate([data, np.zeros(3, np.uint8)])
            widths = np.zeros(len(quote), dtype=np.int64)
            widths[ONE_LETTER[padded[quote + 1]]] = 2
            for one, two in TWO_LETTERS:
                widths[(padded[quote + 1] == one) & (padded[quote + 2] == two)] = 3
            held, widths = quote[widths > 0], widths[widths > 0]
            begin[held + 1] = False
            after = held + widths
            inside = after < len(data)
            after = after[inside]
            begin[after] |= kind[after] == LETTER
        ends = solid.copy()
        ends[:-1] &= begin[1:] | ~solid[1:]
        starts = np.flatnonzero(begin)
        bounds = np.cumsum([0, *lengths]) + np.arange(len(texts) + 1)
        return data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)

    def _stream(self, texts: list[str]):
        """The bytes of the distinct words of plain texts, and which of them every word is.

        Returns (codes, where distinct words begin there, distinct word of every word, first word of
        each text). Short words are compared by all their bytes; longer ones, and the
        few whose place in the table another word has, are run as they come.
        """
        data, starts, ends, marks = self._words(texts)
        lengths = ends - starts
        first, rest = _short_words(data, starts, lengths)
        places = len(starts).bit_length() + 2
        rest_mixed = (rest + lengths.astype(np.uint64)) * KEY_STEPS[1]
        slots = (first * KEY_STEPS[0] ^ rest_mixed) >> np.uint64(64 - places)
        own = np.arange(len(starts))
        # Only places that were written are read.
        table = np.empty(1 << places, dtype=np.int64)
        table[slots] = own
        like = table[slots]
        same = (first[like] == first) & (rest[like] == rest) & (lengths[like] == lengths)
        like = np.where(same & (lengths <= SHORT_WORD), like, own)
        held = np.flatnonzero(like == own)
        number = np.cumsum(like == own) - 1
        begins = np.cumsum(lengths[held]) - lengths[held]
        codes = data[_ranges(starts[held], lengths[held])].astype(np.uint32)
        codes[begins + lengths[held] - 1] += 256
        return codes, begins, number[like], marks

    def _split(self, texts: list[str]) -> tuple[list, list[list[str]]]:
        """The texts, cut into runs (None: not plain) where needed, and their unplain runs."""
        plain, odd = [], []
        for text in texts:
            if not self._unplain(text):
                plain.append(text)
                odd.append([])
                continue
            runs = BETWEEN.split(text)
            plain.append([None if self._unplain(run) else run for run in runs])
            odd.append([run for run in runs if self._unplain(run)])
        return plain, odd

    def _unplain(self, text: str) -> bool:
        if text.isascii():
            unplain = any(c in text for c in CONTROLS)
        else:
            unplain = UNPLAIN.search(text) is not None
        return unplain or any(s in text for s in self.specials)

    def _by_library(self, runs: list[str]) -> None:
        if len(self._memo) > 200_000:
            self._memo.clear()
        new = list({r for r in runs if r not in self._memo})
        if new:
            if self._library is None:
                from tokenizers import Tokenizer

                self._library = Tokenizer.from_str(self.vocabulary)
                self._library.no_truncation()
                self._library.no_padding()
            for run, found in zip(new, self._library.encode_batch(new, add_special_tokens=False)):
                self._memo[run] = found.ids

    def count(self, texts: list[str]) -> np.ndarray:
        """Token counts of whole texts: the sum of the weights along each path."""
        plain, odd = self._split(texts)
        simple = [p if isinstance(p, str) else " ".join(r for r in p if r is not None) for p in plain]
        counts = np.zeros(len(texts), dtype=np.int64)
        if any(simple):
            codes, begins, which, marks = self._stream(simple)
            if len(codes):
                _, weights = self.run(codes, _flags(begins, len(codes)))
                sums = np.zeros(len(which) + 1, dtype=np.int64)
                np.cumsum(np.add.reduceat(weights, begins)[which], out=sums[1:])
                counts += sums[marks[1:]] - sums[marks[:-1]]
        for i, runs in enumerate(odd):
            if runs:
                self._by_library(runs)
                counts[i] += sum(len(self._memo[r]) for r in runs)
        return counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token numbers of whole texts, read backwards from the last token of every word."""
        plain, odd = self._split(texts)
        # A text with unplain runs is encoded in pieces between them, put together afterwards.
        pieces, where = [], []
        for i, p in enumerate(plain):
            if isinstance(p, str):
                pieces.append(p)
                where.append(i)
                continue
            calm: list[str] = []
            for run in [*p, None]:
                if run is None:
                    pieces.append(" ".join(calm))
                    where.append(i)
                    calm = []
                else:
                    calm.append(run)
        found = self._encode_plain(pieces)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids in zip(where, found):
            out[i].append(ids)
        result = []
        for i, parts in enumerate(out):
            if odd[i]:
                self._by_library(odd[i])
                mixed = [parts[0]]
                for run, after in zip(odd[i], parts[1:]):
                    mixed += [np.array(self._memo[run], dtype=np.int32), after]
                parts = mixed
            result.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
        return result

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        empty = np.zeros(0, dtype=np.int32)
        if not any(texts):
            return [empty] * len(texts)
        codes, begins, which, marks = self._stream(texts)
        if not len(codes):
            return [empty] * len(texts)
        tokens, _ = self.run(codes, _flags(begins, len(codes)))
        last = np.zeros(len(codes), dtype=bool)
        firsts, at = begins, np.append(begins[1:], len(codes)) - 1
        while len(at):
            last[at] = True
            at = at - self.length[tokens[at]]
            more = at >= firsts
            at, firsts = at[more], firsts[more]
        # The tokens of the distinct words one after the other, then those of every word.
        sizes = np.add.reduceat(last.astype(np.int64), begins)
        places = np.cumsum(sizes) - sizes
        ids = tokens[last][_ranges(places[which], sizes[which])]
        sums = np.zeros(len(which) + 1, dtype=np.int64)
        np.cumsum(sizes[which], out=sums[1:])
        bounds = sums[marks].tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _grown(array: np.ndarray, rows: int) -> np.ndarray:
    """The array with room for so many rows."""
    if rows <= len(array):
        return array
    larger = np.zeros((max(rows, 2 * len(array)), *array.shape[1:]), dtype=array.dtype)
    larger[: len(array)] = array
    return larger


def _flags(places: np.ndarray, n: int) -> np.ndarray:
    flags = np.zeros(n, dtype=bool)
    flags[places] = True
    return flags


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … for every start, as many as its length, one after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.arange(int(lengths.sum())) + np.repeat(shift, lengths)


def _short_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The first and the next eight bytes of words as numbers, without what follows a word."""
    padded = np.concatenate([data, np.zeros(SHORT_WORD, np.uint8)])
    eights = np.ndarray(len(data) + 8, dtype="<u8", buffer=padded, strides=(1,))
    return [
        eights[np.minimum(starts + skip, len(data))] & FIRST_BYTES[np.clip(lengths - skip, 0, 8)]
        for skip in (0, 8)
    ]


def _utf8_length(text: str) -> int:
    return len(text) if text.isascii() else len(text.lower().encode())


# Bytes of text that a task of token counts or ids works on at once: its arrays take some hundred times
# as much, and smaller slices take longer.
TEXT_BYTES = 1 << 20


def transducer(vocabulary: bytes) -> Transducer:
    """One machine per worker process; later tasks of the stage find it already grown."""
    return kept(
        "transducer", lambda: Transducer(vocabulary),
        lambda machine: machine.made_from == hash(vocabulary) and len(machine.states) <= MOST_STATES,
    )


def texts_of(part: Slice) -> list[str]:
    data = part.data.tobytes()
    return [
        data[a:b].decode("utf-8", "replace")
        for a, b in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist())
    ]
