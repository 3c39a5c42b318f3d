"""Byte-pair merges with word ends, exact and vectorised, over the vocabulary file of a public tokenizer.

A text is split at special tokens and white space, lower-cased and composed (NFC), and split into pieces: contractions, runs
of letters, single digits, runs of the rest. Each piece is merged on its own, always the pair of lowest rank, leftmost first.
Pieces of equal length are merged together in numpy, one merge per piece and step; very long pieces use a heap, so no piece
costs more than n log n. Many runs of ids lie in one flat array, each with its start and size; no run is an object of its own.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import json
import operator
import re
import unicodedata
from collections import defaultdict
from functools import lru_cache

import numpy as np
import regex

#: Starts and sizes of runs, and the flat array that they lie in.
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]

PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: White space as the tokenizer has it; str.split() also takes the four characters of ODD_SPACE for space.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: After letters each of these is a piece of its own.
SINGLE = frozenset(".,;:!?)")
NO_RANK = np.int32(2**31 - 1)
#: Places of the table of merges; most hold nothing, so a pair that is no merge is told at the first look.
SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS
#: Bytes of a piece up to which whole matrices are merged.
WIDE = 48
#: Words of a text whose ids are copied at a time.
BLOCK = 65_536


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


def slot_of(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def hash_table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and their numbers by place, -1 where there is none, and how far a key may lie beyond its own place."""
    if len(keys) > SLOTS // 2:
        raise ValueError(f"{len(keys)} merges are more than the {SLOTS} places of the table hold")
    slots, numbers, farthest = np.full(SLOTS, -1, np.int64), np.full(SLOTS, NO_RANK, np.int32), 0
    for number, (key, at) in enumerate(zip(keys.tolist(), slot_of(keys).tolist())):
        step = 0
        while slots[(at + step) % SLOTS] >= 0:
            step += 1
        slots[(at + step) % SLOTS], numbers[(at + step) % SLOTS] = key, number
        farthest = max(farthest, step)
    return slots, numbers, farthest


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def taken(runs: Runs, picks: np.ndarray) -> np.ndarray:
    """The picked runs, one behind the other."""
    starts, sizes, flat = runs
    sizes = sizes[picks]
    at = np.repeat(starts[picks] - starts_of(sizes), sizes)
    at += np.arange(len(at))
    return flat[at]


class WordBpe:
    """``data``: the bytes of the vocabulary file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, self.data = spec["model"], data
        end, vocab = model["end_of_word_suffix"], model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inside = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        self.letter_byte = {c: b for b, c in enumerate(letters)}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        keys = np.array([(vocab[a] << 16) + vocab[b] for a, b in pairs], np.int64)
        self.slots, self.slot_ranks, self.tries = hash_table(keys)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.rank_of = {int(k): r for r, k in enumerate(keys)}
        # Most ranks that are looked up are those of two bytes.
        self.byte_ranks = self._rank(self.inside[:, None], self.inside[None, :])
        self.last_ranks = self._rank(self.inside[:, None], self.last[None, :])
        self._library = None

    # -- splitting -------------------------------------------------------------------------------------------------

    def has_special(self, text: str) -> bool:
        return any(token in text for token in self.special)

    def segments(self, text: str):
        """Pairs (special id or None, text between)."""
        if not self.has_special(text):
            return [(None, text)]
        return [(self.special.get(part), part) for part in self.special_split.split(text) if part]

    def chunks(self, text: str) -> list[str]:
        """The runs between white space; pieces never cross it."""
        return [c for c in SPACE.split(text) if c] if any(c in text for c in ODD_SPACE) else text.split()

    def pieces(self, chunks: list[str]) -> tuple[list[str], list[str], list[tuple[str, list[str]]]]:
        """Chunks that are one piece each, those pieces, and the other chunks with their pieces."""
        # Chunks hold no line break, so all of them are composed and lower-cased as one string.
        joined = "\n".join(chunks)
        new = {c for c in set(joined) if unicodedata.category(c) == "Cn"} if not joined.isascii() else set()
        if not joined.isascii():
            # Lower case letter by letter: the final form of sigma depends on its neighbours in Python only.
            joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")
        lower = joined.lower().split("\n") if chunks else []
        plain = list(map(str.isalpha, lower))
        alone = list(map(operator.not_, plain))
        rest = [
            (chunk, [w[:-1], w[-1]] if w[-1] in SINGLE and w[:-1].isalpha() else PIECES.findall(w))
            if not new or new.isdisjoint(chunk) else (chunk, self._library_pieces(chunk))
            for chunk, w in zip(itertools.compress(chunks, alone), itertools.compress(lower, alone))
        ]
        return list(itertools.compress(chunks, plain)), list(itertools.compress(lower, plain)), rest

    def _library_pieces(self, chunk: str) -> list[str]:
        """Characters newer than Python's tables are classed by the tokenizer's own."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.data.decode())
        normal = self._library.normalizer.normalize_str(chunk)
        found = self._library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.letter_byte[c] for c in p).decode() for p, _ in found]

    # -- merging ---------------------------------------------------------------------------------------------------

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 16) + right
        at = slot_of(key)
        held = self.slots[at]
        found = np.where(held == key, self.slot_ranks[at], NO_RANK)
        # Few keys meet another one in their first place and go on to the next.
        place, step = np.nonzero((held != key) & (held >= 0)), 0
        while step < self.tries and len(place[0]):
            step += 1
            next_ = (at[place] + step) & (SLOTS - 1)
            held, wanted = self.slots[next_], key[place]
            hit = held == wanted
            found[tuple(p[hit] for p in place)] = self.slot_ranks[next_[hit]]
            place = tuple(p[~hit & (held >= 0)] for p in place)
        return found

    def _merge_matrix(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each row of bytes, a word, has, and the ids of all rows."""
        n, width = raw.shape
        symbols = np.concatenate([self.inside[raw[:, :-1]], self.last[raw[:, -1:]]], 1)
        done, counts = np.empty((n, width), np.int32), np.empty(n, np.int64)
        rows, left = np.arange(n), width
        rank = self.byte_ranks[raw[:, :-1], raw[:, 1:]]
        if width > 1:
            rank[:, -1] = self.last_ranks[raw[:, -2], raw[:, -1]]
        while len(rows):
            # Every row still here has been merged equally often, so all have ``left`` symbols.
            place = rank.argmin(1) if left > 1 else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), place] if left > 1 else np.full(len(rows), NO_RANK)
            ended = best == NO_RANK
            if ended.any():
                done[rows[ended], :left], counts[rows[ended]] = symbols[ended], left
                go = ~ended
                rows, symbols, rank, place, best = rows[go], symbols[go], rank[go], place[go], best[go]
                if not len(rows):
                    break
            each, left = np.arange(len(rows)), left - 1
            # The right symbol of the pair and the pair's rank go; what is behind them moves up.
            behind = np.arange(left) > place[:, None]
            symbols = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            symbols[each, place] = self.merged[best]
            if left > 1:
                rank = np.where(behind[:, 1:], rank[:, 1:], rank[:, :-1])
                has = place > 0
                rank[each[has], place[has] - 1] = self._rank(symbols[each[has], place[has] - 1], symbols[each[has], place[has]])
                has = place < left - 1
                rank[each[has], place[has]] = self._rank(symbols[each[has], place[has]], symbols[each[has], place[has] + 1])
        return counts, done[np.arange(width) < counts[:, None]]

    def _merge_long(self, word: bytes) -> np.ndarray:
        symbols = self.inside[np.frombuffer(word, np.uint8)].tolist()
        symbols[-1] = int(self.last[word[-1]])
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        rank_of, merged, heap = self.rank_of, self.merged, []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0:
                r = rank_of.get((symbols[i] << 16) + symbols[j])
                if r is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[j]))

        for i in range(len(symbols)):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = int(merged[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([s for s in symbols if s >= 0], np.int32)

    def merge_each(self, raw: bytes, starts: np.ndarray, widths: np.ndarray) -> Runs:
        """The ids of each word of ``raw``, given by where it starts and its bytes. Words of equal length are merged together."""
        codes, sizes, flat = np.frombuffer(raw, np.uint8), np.zeros(len(starts), np.int64), [np.empty(0, np.int32)]
        order = np.argsort(widths, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(widths[order])) + 1):
            width = int(widths[places[0]]) if len(places) else 0
            if 0 < width <= WIDE:
                sizes[places], ids = self._merge_matrix(codes[starts[places, None] + np.arange(width)])
                flat.append(ids)
            elif width:
                for place in places.tolist():
                    flat.append(self._merge_long(raw[starts[place] : starts[place] + width]))
                    sizes[place] = len(flat[-1])
        found = np.empty(len(starts), np.int64)
        found[order] = starts_of(sizes[order])
        return found, sizes, np.concatenate(flat)

    def merge_list(self, words: list[bytes]) -> Runs:
        widths = np.fromiter(map(len, words), np.int64, len(words))
        return self.merge_each(b"".join(words), starts_of(widths), widths)

    def merge(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each distinct word."""
        starts, sizes, flat = self.merge_list(words)
        flat = flat.astype("<u4")
        return {w: flat[at : at + n].tobytes() for w, at, n in zip(words, starts.tolist(), sizes.tolist())}


@lru_cache(maxsize=1)
def loaded(data: bytes) -> WordBpe:
    """The vocabulary, parsed once per worker process."""
    return WordBpe(data)


class Encoder:
    """Encodes whole texts; remembers the chunks seen, up to ``MEMO`` of them and those of one call.

    ``lexicon`` answers for frequent words (``lookup(words) -> ids or None for each``); all others are merged. Every chunk has a
    number, the place of its ids among ``runs``; special tokens come first.
    """

    MEMO = 300_000

    def __init__(self, bpe: WordBpe, lexicon=None):
        self.bpe, self.lexicon = bpe, lexicon
        ones = np.ones(len(bpe.special), np.int64)
        self.runs: Runs = (starts_of(ones), ones, np.array(list(bpe.special.values()), np.int32))
        self.uses = np.zeros(len(ones), np.int64)
        self._number(list(bpe.special))

    def _number(self, chunks: list[str]) -> None:
        # A chunk that is not there yet gets the next number as it is looked up.
        self.numbers = defaultdict(itertools.count(len(chunks)).__next__, zip(chunks, itertools.count()))

    def _forget(self) -> None:
        """Keeps the chunks used most, half of ``MEMO`` at most: those that come once are most of the memory and none of the use."""
        place = len(self.uses) - self.MEMO // 2 - 1
        kept = self.uses > np.partition(self.uses, place)[place]
        kept[: len(self.bpe.special)] = True
        places = np.flatnonzero(kept)
        sizes = self.runs[1][places]
        self.runs, self.uses = (starts_of(sizes), sizes, taken(self.runs, places)), self.uses[places] // 2
        self._number(list(itertools.compress(self.numbers, kept.tolist())))

    def _merged(self, words: list[str]) -> Runs:
        # Pieces hold no line break either.
        raw = "\n".join(words).encode()
        if self.lexicon is None:
            breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
            starts = np.concatenate([[0], breaks + 1])
            return self.bpe.merge_each(raw, starts, np.concatenate([breaks, [len(raw)]]) - starts)
        listed = raw.split(b"\n")
        found = self.lexicon.lookup(listed)
        unseen = [at for at, ids in enumerate(found) if ids is None]
        starts, sizes, merged = self.bpe.merge_list([listed[at] for at in unseen])
        # Those of the lexicon, and behind them the merged ones.
        all_sizes = np.array([0 if ids is None else len(ids) // 4 for ids in found], np.int64)
        flat, all_starts = np.frombuffer(b"".join(filter(None, found)), "<u4").astype(np.int32), starts_of(all_sizes)
        all_starts[unseen], all_sizes[unseen] = starts + len(flat), sizes
        return all_starts, all_sizes, np.concatenate([flat, merged])

    def _learn(self) -> None:
        """The ids of the chunks that have a number and no ids yet."""
        known = len(self.uses)
        chunks = list(itertools.islice(self.numbers, known, None))
        if not chunks:
            return
        alone, words, rest = self.bpe.pieces(chunks)
        distinct: dict[str, int] = defaultdict(itertools.count().__next__)
        picks = np.fromiter(map(distinct.__getitem__, itertools.chain(words, *(p for _, p in rest))), np.int64)
        counts = np.concatenate([np.ones(len(alone), np.int64), np.fromiter((len(p) for _, p in rest), np.int64, len(rest))])
        runs = self._merged(list(distinct))
        # Chunks of one piece come first in ``picks``; each chunk's number says where its ids belong.
        ends = np.concatenate([[0], np.cumsum(runs[1][picks])])
        at = starts_of(counts)
        places = np.fromiter(map(self.numbers.__getitem__, itertools.chain(alone, (c for c, _ in rest))), np.int64, len(chunks)) - known
        starts, sizes = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        starts[places], sizes[places] = ends[at] + len(self.runs[2]), ends[at + counts] - ends[at]
        new = starts, sizes, taken(runs, picks)
        self.runs = tuple(np.concatenate(pair) for pair in zip(self.runs, new))
        self.uses = np.concatenate([self.uses, np.zeros(len(chunks), np.int64)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        # Lists and dictionaries of strings hold no cycles; looking for some takes a tenth of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.numbers) > self.MEMO:
            self._forget()
        # A text's chunks go as soon as they have numbers: those of all texts would take ten times the memory of the texts.
        numbered = [self._numbers_of(text or "") for text in texts]
        self._learn()
        return [self._ids(numbers) for numbers in numbered]

    def _numbers_of(self, text: str) -> np.ndarray:
        chunks = [
            chunk for special, part in self.bpe.segments(text)
            for chunk in (self.bpe.chunks(part) if special is None else (part,))
        ] if self.bpe.has_special(text) else self.bpe.chunks(text)
        return np.fromiter(map(self.numbers.__getitem__, chunks), np.int32, len(chunks))

    def _ids(self, numbers: np.ndarray) -> bytes:
        blocks = [numbers[at : at + BLOCK] for at in range(0, len(numbers), BLOCK)]
        for block in blocks:
            np.add.at(self.uses, block, 1)
        return b"".join([taken(self.runs, block).astype("<u4", copy=False).tobytes() for block in blocks])

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.bpe.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def slices(texts: list[str | None], size: int = 4_000_000):
    """Runs of texts of about ``size`` characters; a longer text stays whole and alone."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text or "") > size:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text or "")
    if run:
        yield run
