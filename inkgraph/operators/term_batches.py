"""Terms of many texts at once, as numbers: batches of token lists in, arrays out.

Tokens come from one built-in expression (``functions.text.tokens``); here they
are numbered by Arrow, pairs of neighbours become one number made of two, and
sorting counts them.  No string is made per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_TOKENS = 4_000_000      # tokens counted at once; a single text is never cut


def flat(tokens: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All tokens in order, and the row that each belongs to."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    return tokens.flatten(), np.repeat(np.arange(len(tokens), dtype=np.int64), lengths)


def slices(tokens: pa.ListArray, most: int = SLICE_TOKENS) -> Iterator[pa.ListArray]:
    """Runs of rows with about ``most`` tokens each."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths, dtype=np.int64) // most
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else []
    for first, end in zip(starts, [*starts[1:], len(tokens)]):
        yield tokens.slice(first, end - first)


def occurrences(codes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct codes, rows, how often the code occurs in the row), by code, then row."""
    known = None
    if len(codes) and int(codes.max()) >= (1 << 62) // n_rows:
        known, codes = np.unique(codes, return_inverse=True)
    keys, n = np.unique(codes * n_rows + rows, return_counts=True)
    codes, rows = keys // n_rows, keys % n_rows
    return codes if known is None else known[codes], rows, n


def _totals(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, occurrences, rows) of codes that come in order."""
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    df = np.diff(np.append(starts, len(codes)))
    return codes[starts], np.add.reduceat(n, starts) if len(starts) else n[:0], df


def count(tokens: pa.ListArray) -> pa.RecordBatch:
    """(term, n, df): occurrences of each term and rows that hold it."""
    words, rows = flat(tokens)
    coded = words.dictionary_encode()
    ids, size = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    single, n1, df1 = _totals(*_two(occurrences(ids, rows, max(len(tokens), 1))))
    near = rows[1:] == rows[:-1]
    pair, n2, df2 = _totals(*_two(occurrences(ids[:-1][near] * size + ids[1:][near], rows[1:][near], max(len(tokens), 1))))
    left, right = coded.dictionary.take(pa.array(pair // max(size, 1))), coded.dictionary.take(pa.array(pair % max(size, 1)))
    names = pa.concat_arrays([coded.dictionary.take(pa.array(single)), pc.binary_join_element_wise(left, right, " ")])
    return pa.RecordBatch.from_arrays(
        [names.cast(pa.string()), pa.array(np.concatenate([n1, n2]), pa.int64()), pa.array(np.concatenate([df1, df2]), pa.int64())],
        ["term", "n", "df"],
    )


def _two(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return found[0], found[2]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_counts(tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 64-bit hash of the term, tf), by row; the hash depends on the term alone."""
    words, rows = flat(tokens)
    coded = words.dictionary_encode()
    ids, size = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    own = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(np.uint64)
    n_rows = max(len(tokens), 1)
    single, at1, tf1 = occurrences(ids, rows, n_rows)
    near = rows[1:] == rows[:-1]
    pair, at2, tf2 = occurrences(ids[:-1][near] * size + ids[1:][near], rows[1:][near], n_rows)
    left, right = own[pair // max(size, 1)], own[pair % max(size, 1)]
    hashes = np.concatenate([_mixed(own[single]), _mixed(_mixed(left + np.uint64(0x9E3779B97F4A7C15)) + right)]).view(np.int64)
    at, tf = np.concatenate([at1, at2]), np.concatenate([tf1, tf2])
    order = np.argsort(at, kind="stable")
    return at[order], hashes[order], tf[order]


class Vocabulary:
    """Numbers of given terms; terms are tokens or two tokens with one blank between."""

    def __init__(self, terms: list[str]):
        parts = [term.split(" ") for term in terms]
        self.size = len(terms)
        self.tokens = sorted({token for p in parts if len(p) <= 2 for token in p})
        number = {token: i for i, token in enumerate(self.tokens)}
        self.single = np.full(len(self.tokens), -1, np.int64)
        pairs = []
        for i, p in enumerate(parts):
            if len(p) == 1:
                self.single[number[p[0]]] = i
            elif len(p) == 2:
                pairs.append((number[p[0]] * len(self.tokens) + number[p[1]], i))
        pairs.sort()
        self.pair_codes = np.array([code for code, _ in pairs], np.int64)
        self.pair_terms = np.array([i for _, i in pairs], np.int64)

    def counts(self, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, tf), by row, then term."""
        words, rows = flat(tokens)
        ids = pc.fill_null(pc.index_in(words, pa.array(self.tokens, words.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = ids >= 0
        found, at = self.single[ids[known]], rows[known]
        near = known[1:] & known[:-1] & (rows[1:] == rows[:-1])
        codes, pair_at = ids[:-1][near] * len(self.tokens) + ids[1:][near], rows[1:][near]
        if len(self.pair_codes):
            place = np.minimum(np.searchsorted(self.pair_codes, codes), len(self.pair_codes) - 1)
            hit = self.pair_codes[place] == codes
            found, at = np.concatenate([found, self.pair_terms[place[hit]]]), np.concatenate([at, pair_at[hit]])
        at, found = at[found >= 0], found[found >= 0]
        keys, tf = np.unique(at * max(self.size, 1) + found, return_counts=True)
        return keys // max(self.size, 1), keys % max(self.size, 1), tf
