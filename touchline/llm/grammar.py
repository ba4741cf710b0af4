"""Run-length grammars by recompression, and longest common extensions answered from them.

A sequence of symbols is rewritten level by level, in turn by *block compression* (every maximal block
``aaa`` becomes one symbol) and by *pair compression* (symbols are dealt to a left and a right side,
and every pair of a left and a right symbol that stand side by side becomes one symbol), until one
symbol is left. Both rules look at the neighbours of a place only, so equal stretches are
rewritten alike except for a symbol at either end. An extension query climbs from two places as long
as they agree, then descends into the first symbols that differ: a constant number of steps
a level, for many queries at once.
"""

from __future__ import annotations

import numpy as np

#: Ways of dealing symbols to the two sides that are tried at each level; the best one is taken.
DEALS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _sides(symbols: np.ndarray, salt: int) -> np.ndarray:
    """Left (False) or right (True) for every symbol, the same wherever it occurs."""
    x = (symbols.astype(np.uint64) + np.uint64(salt * 0x51ED27 + 1)) * _MIX
    x ^= x >> np.uint64(29)
    return (x * _MIX) >> np.uint64(63) > 0


def _named(keys: np.ndarray, next_symbol: int) -> tuple[np.ndarray, int]:
    """A new symbol for every distinct key."""
    distinct, which = np.unique(keys, return_inverse=True)
    return next_symbol + which, next_symbol + len(distinct)


class _Level:
    """Symbols of one level, and the phrases that the next level puts in their place."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, is_block: bool):
        self.symbols, self.is_block = symbols, is_block
        self.first = np.append(first, len(symbols))  # first symbol of each phrase, and the end
        self.parent = np.repeat(np.arange(len(first)), np.diff(self.first))


class Grammar:
    """Levels of one sequence of non-negative integers."""

    def __init__(self, sequence: np.ndarray):
        sequence = np.asarray(sequence, np.int64)
        end = int(sequence.max(initial=0)) + 1  # a symbol that occurs nowhere else closes it
        symbols = np.append(sequence, end)
        unused, self.levels, salt = end + 1, [], 0
        while len(symbols) > 2:
            first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
            if len(first) < len(symbols):
                self.levels.append(_Level(symbols, first, True))
                size = np.diff(np.append(first, len(symbols)))
                merged = symbols[first]
                many = size > 1
                merged[many], unused = _named(merged[many] * (len(symbols) + 1) + size[many], unused)
                symbols = merged
            if len(symbols) <= 2:
                break
            # The closing symbol is never part of a pair.
            right = max((_sides(symbols, salt + i) for i in range(DEALS)),
                        key=lambda r: np.count_nonzero(~r[:-2] & r[1:-1]))
            salt += DEALS
            paired = np.zeros(len(symbols), bool)
            paired[:-2] = ~right[:-2] & right[1:-1]
            if not paired.any():
                continue
            second = np.append(False, paired[:-1])
            first = np.flatnonzero(~second)
            self.levels.append(_Level(symbols, first, False))
            merged, pair = symbols[first], paired[first]
            after = symbols[first[pair] + 1]
            merged[pair], unused = _named(merged[pair] * unused + after, unused)
            symbols = merged
        self.top = symbols

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of what starts at ``i`` and at ``j`` (i != j)."""
        start, a, b = np.asarray(i, np.int64), np.array(i, np.int64), np.array(j, np.int64)
        parked = np.full(len(a), len(self.levels))  # level at which a query found a difference
        live = np.arange(len(a))
        for number, level in enumerate(self.levels):
            if not len(live):
                break
            x, y = a[live], b[live]
            px, py = level.parent[x], level.parent[y]
            inside = (level.first[px] != x) | (level.first[py] != y)
            differs = inside & (level.symbols[x] != level.symbols[y])
            moves = inside & ~differs
            if level.is_block:
                left_x, left_y = level.first[px + 1] - x, level.first[py + 1] - y
                step = np.where(moves, np.minimum(left_x, left_y), 0)
                differs |= moves & (left_x != left_y)
            else:
                step = moves.astype(np.int64)
            x, y = x + step, y + step
            stays = differs
            parked[live[stays]] = number
            a[live], b[live] = (np.where(stays, x, level.parent[np.minimum(x, len(level.parent) - 1)]),
                                np.where(stays, y, level.parent[np.minimum(y, len(level.parent) - 1)]))
            live = live[~stays]
        live = np.flatnonzero(parked == len(self.levels))
        for number in range(len(self.levels) - 1, -1, -1):
            level = self.levels[number]
            x, y = level.first[a[live]], level.first[b[live]]
            alike = level.symbols[x] == level.symbols[y]
            if level.is_block:
                common = np.minimum(level.first[a[live] + 1] - x, level.first[b[live] + 1] - y)
            else:
                common = 1
            step = np.where(alike, common, 0)
            a[live], b[live] = x + step, y + step
            live = np.concatenate([live, np.flatnonzero(parked == number)])
        return a - start
