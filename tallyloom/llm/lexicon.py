"""A minimal acyclic transducer: frequent words to their ids, with suffixes shared, in one file that is memory-mapped.

Words are added in byte order and each state is merged with an equal one as soon as no later word can change it, so the
automaton is minimal at every step. Edges carry the number of words that sort before those behind them; their sum along a
path is the word's number, which points to its ids. Looking up many words walks all of them one byte at a time in numpy.
"""

from __future__ import annotations

import mmap
import os
import tempfile

import numpy as np

MAGIC = 0x4C455831


def compile_words(entries: list[tuple[bytes, bytes]]) -> bytes:
    """``entries``: distinct words with their ids (little-endian unsigned 32-bit); the bytes of the automaton's file."""
    entries = sorted(entries)
    final, edges = [False], [{}]
    register: dict[tuple, int] = {}
    path, before = [0], b""

    def settle(down_to: int) -> None:
        while len(path) - 1 > down_to:
            state, byte = path.pop(), before[len(path) - 1]
            form = (final[state], tuple(edges[state].items()))
            edges[path[-1]][byte] = register.setdefault(form, state)

    for word, _ in entries:
        shared = len(os.path.commonprefix([before, word]))
        settle(shared)
        before = word
        for byte in word[shared:]:
            final.append(False)
            edges.append({})
            edges[path[-1]][byte] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
    settle(0)

    number, order, stack = {0: 0}, [0], [0]
    while stack:
        for target in edges[stack.pop()].values():
            if target not in number:
                number[target] = len(order)
                order.append(target)
                stack.append(target)
    words: dict[int, int] = {}
    todo = [0]
    while todo:
        state = todo[-1]
        open_ = [t for t in edges[state].values() if t not in words]
        if open_:
            todo.extend(open_)
            continue
        todo.pop()
        words[state] = final[state] + sum(words[t] for t in edges[state].values())
    keys, targets, skips = [], [], []
    for state in order:
        skip = int(final[state])
        for byte, target in sorted(edges[state].items()):
            keys.append((number[state] << 8) + byte)
            targets.append(number[target])
            skips.append(skip)
            skip += words[target]
    at = np.argsort(np.array(keys, np.int64), kind="stable")
    starts = np.cumsum([0, *[len(ids) // 4 for _, ids in entries]])
    arrays = [
        np.array(keys, "<i8")[at], starts.astype("<i8"), np.array(targets, "<i4")[at], np.array(skips, "<i4")[at],
        np.array([final[s] for s in order], "<i4"), np.frombuffer(b"".join(ids for _, ids in entries), "<u4"),
    ]
    return np.array([MAGIC, *map(len, arrays)], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """The automaton in memory-mapped form."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:  # has no name; it goes when the map goes
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, "<i8", 7)
        if sizes[0] != MAGIC:
            raise ValueError("not a lexicon")
        kinds, at, found = ("<i8", "<i8", "<i4", "<i4", "<i4", "<u4"), 56, []
        for kind, n in zip(kinds, sizes[1:].tolist()):
            found.append(np.frombuffer(self.map, kind, n, at))
            at += found[-1].nbytes
        self.keys, self.starts, self.targets, self.skips, self.final, self.ids = found

    def _numbers(self, words: list[bytes], width: int) -> np.ndarray:
        """The number of each word of ``width`` bytes, -1 for those that are not here."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width)
        rows, state, number = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for column in range(width):
            key = (state << 8) + raw[rows, column]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            rows, at, number = rows[hit], at[hit], number[hit]
            state, number = self.targets[at].astype(np.int64), number + self.skips[at]
        out, ended = np.full(len(words), -1, np.int64), self.final[state] == 1
        out[rows[ended]] = number[ended]
        return out

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        found: list[bytes | None] = [None] * len(words)
        if not len(self.keys):
            return found
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_width.setdefault(len(word), []).append(i)
        for width, group in by_width.items():
            for i, n in zip(group, self._numbers([words[i] for i in group], width).tolist()):
                if n >= 0:
                    found[i] = self.ids[self.starts[n] : self.starts[n + 1]].tobytes()
        return found
