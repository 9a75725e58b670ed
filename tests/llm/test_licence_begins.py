"""Licence notices where a text begins within one."""

import re
from collections import Counter

from inkgraph.llm import licences

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_licences_in_texts_that_begin_within_a_key_phrase(spark):
    tails = [" ".join(n.key[i:]) for n in licences.NOTICES for i in range(1, len(n.key))]
    texts = ["MIT License\n\nCopyright (c)", "Public license version 3", "under the MIT License", *tails, *[f"{t} and more words" for t in tails]]
    texts += ["the general"] * 60 + ["the general public"] * 20      # makes 'the' and 'general' the most frequent key words
    rows = [(i, text, None, None, 0) for i, text in enumerate(texts)]
    want = Counter()
    for i, text in enumerate(texts):
        found = re.findall("[0-9a-z]+", text.lower())
        want[i, ",".join(sorted(n.label for n in licences.NOTICES if n.base and any(found[k: k + len(n.key)] == n.key for k in range(len(found)))))] += 1
    got = licences.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r.doc_id, r.base_labels) for r in got) == want
    assert {r.doc_id: r.labels for r in got}[2] == "mit"
