"""Character n-grams of words as hashed buckets, found for many words at once."""

from __future__ import annotations

import numpy as np

from inkgraph.llm.hashed_words import BYTE_VALUES, Words, mix

EDGE = np.uint8(2)     # stands before and after every word, so that n-grams at an edge are affixes


def buckets(words: Words, chosen: np.ndarray, sizes: tuple[int, ...], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first): bucket ids of the n-grams of the ``chosen`` words, and where each word's ids begin.

    Every word has at least one id (that of the word with its edges), also if
    it is shorter than every n-gram.
    """
    start, length = words.start[chosen], (words.end - words.start)[chosen]
    first = np.concatenate(([0], np.cumsum(length + 2)))
    data = np.full(first[-1], EDGE, np.uint8)
    inside = np.arange(int(length.sum())) - np.repeat(np.concatenate(([0], np.cumsum(length)[:-1])), length)
    data[np.repeat(first[:-1] + 1, length) + inside] = words.data[np.repeat(start, length) + inside]
    word = np.repeat(np.arange(len(chosen)), length + 2)
    ids, owner = [mix(words.hash[chosen] + np.uint64(97))], [np.arange(len(chosen))]
    for n in sizes:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, np.uint64(n))
        for i in range(n):
            code = (code * np.uint64(0x100000001B3)) ^ BYTE_VALUES[data[i: len(data) - n + 1 + i]]
        within = word[: len(code)] == word[n - 1:]
        ids.append(mix(code[within]))
        owner.append(word[: len(code)][within])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    ids = (np.concatenate(ids)[order] % np.uint64(n_buckets)).astype(np.int64)
    return ids, np.searchsorted(owner[order], np.arange(len(chosen) + 1))
