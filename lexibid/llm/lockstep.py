"""Sequences of different lengths worked through side by side, one place at a time."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Group:
    """Sequences, longest first, laid out by place and then by sequence.

    ``members`` are the sequences' numbers, ``items`` where each laid-out item was among all items,
    and place t is ``slices[t]`` to ``slices[t + 1]``: the first ``active[t]`` members go that far.
    """

    members: np.ndarray
    lengths: np.ndarray
    active: np.ndarray
    slices: np.ndarray
    items: np.ndarray

    @property
    def steps(self) -> int:
        return len(self.active)

    def at(self, step: int) -> slice:
        return slice(self.slices[step], self.slices[step + 1])


def groups(counts: np.ndarray, most: int) -> Iterator[Group]:
    """Groups of about ``most`` items, or one sequence that is longer; empty sequences are in none.

    ``counts`` are the lengths of sequences whose items lie one after another.
    """
    offsets = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    total = np.cumsum(counts[order])
    begin = 0
    while begin < len(order):
        done = total[begin] - counts[order[begin]]
        end = max(begin + 1, int(np.searchsorted(total, done + most, side="right")))
        members, begin = order[begin:end], end
        lengths = counts[members]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        slices = np.concatenate([[0], np.cumsum(active)])
        nth = np.arange(slices[-1]) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        items = np.empty(slices[-1], dtype=np.int64)
        items[slices[nth] + np.repeat(np.arange(len(members)), lengths)] = np.repeat(offsets[members], lengths) + nth
        yield Group(members, lengths, active, slices, items)
