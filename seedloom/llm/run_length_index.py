"""Run-length index of many byte strings: run-compressed Burrows-Wheeler transform, sampled run ends.

Strings are laid after each other, each followed by a separator of its own that sorts before
every byte. Kept are the runs of the transform (start and symbol), the suffix positions at run
ends and at first bytes of strings, the ranks of each symbol at run starts, and the rows where the next ``length`` bytes change
together with the smallest owner of the rows that share them. The suffix array is dropped.
"""

from __future__ import annotations

import numpy as np


class RunLengthIndex:
    def __init__(self, strings: list[bytes], owners: np.ndarray, length: int):
        if length < 2:
            raise ValueError("length must be at least 2")
        self.length = length
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes
        text = np.full(int(self.ends[-1]) + 1 if len(strings) else 0, 0, np.int64)
        inside = np.ones(len(text), bool)
        inside[self.ends] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        order, same = self._sort(text, inside, length)
        n = len(text)
        symbols = text[order - 1]  # the symbol before each suffix; position 0 follows the last separator
        heads = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if n else np.zeros(0, np.int64)
        self.n, self.heads, self.run_symbols = n, heads, symbols[heads]
        tails = np.concatenate([heads[1:], [n]]) - 1 if n else heads
        self.samples = order[tails]
        self.tails = tails
        # A step back across a separator has no meaning, so first bytes of strings are sampled too.
        self.first_rows = np.flatnonzero(symbols == 0)
        self.first_samples = order[self.first_rows]
        counts = np.bincount(symbols, minlength=258) if n else np.zeros(258, np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])[:-1]
        # Rank of a run's own symbol at its start.
        by_symbol = np.argsort(self.run_symbols, kind="stable")
        run_sizes = tails - heads + 1
        grouped = np.cumsum(run_sizes[by_symbol]) - run_sizes[by_symbol]
        first = np.concatenate([[True], np.diff(self.run_symbols[by_symbol]) != 0]) if n else np.zeros(0, bool)
        base = np.repeat(grouped[first], np.diff(np.append(np.flatnonzero(first), len(first)))) if n else grouped
        self.rank_at_head = np.empty(len(heads), np.int64)
        self.rank_at_head[by_symbol] = grouped - base
        # Rows that begin with the same ``length`` bytes follow each other.
        starts = np.flatnonzero(~same) if n else np.zeros(0, np.int64)
        owner_of = np.repeat(np.asarray(owners, np.int64), sizes + 1)[order] if n else np.zeros(0, np.int64)
        self.group_starts = starts
        self.group_owner = np.minimum.reduceat(owner_of, starts) if n else owner_of

    @staticmethod
    def _sort(text: np.ndarray, inside: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order, and for each row whether its first ``length`` bytes are those of the row before.

        Prefix doubling; separators are told apart by their place, so rows end up all different.
        """
        n = len(text)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        # First by a few bytes at once; what follows a separator counts for nothing, its place does.
        separators = int((~inside).sum())
        reach = min(length, 6 if separators < 30_000 else 4)
        key, open_, tie = np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, np.int64)
        number = np.cumsum(~inside)
        for k in range(reach):
            symbol, here, place = (np.append(x[k:], np.zeros(k, x.dtype)) for x in (text, inside, number))
            key = key * 257 + np.where(open_, symbol, 0)
            tie = np.where(open_ & ~here, place, tie)
            open_ &= here
        _, rank, _ = RunLengthIndex._ranks(key * (separators + 1) + tie)
        kept, kept_reach = None, 0
        while True:
            if reach <= length < 2 * reach:
                kept, kept_reach = rank, reach
            later = np.full(n, -1, np.int64)
            later[: n - reach] = rank[reach:]
            order, rank, fresh = RunLengthIndex._ranks(rank * (n + 1) + later + 1)
            reach *= 2
            if fresh == n - 1 and kept is not None:
                break
        shift = length - kept_reach
        second = np.full(n, -1, np.int64)
        second[: n - shift] = kept[shift:]
        same = np.concatenate(
            [[False], (kept[order[1:]] == kept[order[:-1]]) & (second[order[1:]] == second[order[:-1]])]
        )
        return order, same

    @staticmethod
    def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Order of the keys, dense rank of each, and the largest rank."""
        order = np.argsort(key)  # equal keys get one rank, so their order does not matter
        rank = np.empty(len(key), np.int64)
        dense = np.cumsum(np.concatenate([[False], key[order[1:]] != key[order[:-1]]]))
        rank[order] = dense
        return order, rank, int(dense[-1])

    def step_back(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes one byte longer (LF mapping on runs), and the bytes' symbols."""
        run = np.searchsorted(self.heads, rows, side="right") - 1
        symbol = self.run_symbols[run]
        return self.before[symbol] + self.rank_at_head[run] + rows - self.heads[run], symbol

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, from the samples at run ends."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        found = np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            run = np.searchsorted(self.heads, at[open_], side="right") - 1
            sampled = self.tails[run] == at[open_]
            hit = open_[sampled]
            found[hit] = self.samples[run[sampled]] + steps[hit]
            first = self.run_symbols[run] == 0
            hit = open_[first]
            found[hit] = self.first_samples[np.searchsorted(self.first_rows, at[hit])] + steps[hit]
            open_ = open_[~sampled & ~first]
            if len(open_):
                at[open_], _ = self.step_back(at[open_])
                steps[open_] += 1
        return found

    def first_owners(self) -> list[np.ndarray]:
        """For every string, the smallest owner of each of its windows of ``length`` bytes."""
        windows = np.maximum(self.ends - self.begins - self.length + 1, 0)
        return np.split(self.window_owners(), np.cumsum(windows)[:-1]) if len(windows) else []

    def window_owners(self) -> np.ndarray:
        """The same, one string after the other.

        All strings are streamed backwards at once. The matching statistic of a window, cut off
        at ``length``, is ``length`` towards just those strings whose rows share its group.
        """
        lengths = self.ends - self.begins
        longest = int(lengths.max()) if len(lengths) else 0
        alive = np.argsort(-lengths, kind="stable")
        sizes = lengths[alive]
        # Row i is the suffix that is the i-th separator alone: separators sort first, by place.
        rows = alive.astype(np.int64)
        windows = np.maximum(lengths - self.length + 1, 0)
        out_at = np.concatenate([[0], np.cumsum(windows)]).astype(np.int64)
        flat = np.empty(int(out_at[-1]), np.int64)
        for done in range(1, longest + 1):
            count = int(np.searchsorted(-sizes, -done, side="right"))
            alive, sizes, rows = alive[:count], sizes[:count], rows[:count]
            rows, _ = self.step_back(rows)
            if done >= self.length:
                group = np.searchsorted(self.group_starts, rows, side="right") - 1
                flat[out_at[alive] + sizes - done] = self.group_owner[group]
        return flat
