"""Filter audit: carry-save popcounts against bit counting, the audit against a plain count over rows."""

import re
from itertools import permutations

import numpy as np
import pytest

from inkgraph.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 100, 1000, 4097])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
    want = [int(((words >> i) & 1).sum()) for i in range(32)]
    assert filter_audit.positional_popcount(words).tolist() == want


def plain(docs, labels):
    marks = {}
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            g, t = marks.get(doc_id, (0, 0))
            marks[doc_id] = (max(g, int(quality == 1)), max(t, int(toxic == 1)))
    firsts = {}
    for doc_id, text, _ in docs:
        key = text or ""
        if doc_id is not None and (key not in firsts or doc_id < firsts[key]):
            firsts[key] = doc_id
    rows = []
    for doc_id, text, source in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": re.search("[#$%&*|]", t) is not None, "E": doc_id is not None and doc_id > firsts.get(t, doc_id)}
        rows.append((source or "", marks.get(doc_id, (0, 0)) if doc_id is not None else (0, 0), fails))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shap = {}
        for order in permutations("ABCDE"):
            alive = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in alive if r[2][x]]
                alive = [r for r in alive if not r[2][x]]
                failing = [r for r in mine if r[2][x]]
                out[(part, "".join(order), step)] = [
                    len(alive), len(gone), len(failing) - len(gone),
                    sum(1 for r in mine if r[2][x] and not any(r[2][y] for y in "ABCDE" if y != x)),
                    sum(r[1][0] for r in gone), sum(r[1][1] for r in gone)]
                shap[x] = shap.get(x, 0) + len(gone)
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shap[order[step - 1]])
    return out


def test_audit_against_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(60))
    docs = [
        (1, long_text, "a"), (2, long_text, "a"), (3, long_text, "b"), (None, long_text, "a"), (0, long_text, None),
        (4, None, "a"), (5, "", None), (6, "short text", "a"), (6, "short text", "a"), (7, long_text.upper(), "b"),
        (8, long_text + " #", "b"), (9, " ".join(["same"] * 80), "a"), (10, "x " * 100000, "b"), (None, None, None),
        (11, "ÉCOLE " * 60, "c"), (3, long_text + " tail", "b"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (4, None, 1), (None, 1, 1), (6, 1, 0), (99, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("shapley", filter_audit.F.lit("x"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in filter_audit.audit(d, lab).collect()}
    assert got == plain(docs, labels)
    assert len(got) == 600 * 4


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string, source string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(d, lab).collect() == []
