"""Guess costs of long values."""

import random

from inkgraph.llm import secret_scan


def test_long_placeholders_are_no_secrets():
    for text in ("auth: " + "*" * 300, "token is " + "xxxx" * 500, "passphrase: " + "ab~" * 5_000):
        spans, dearest = secret_scan.find(text)
        assert not [s for s in spans if s[1] == 3] and dearest < secret_scan.DEAR
    value = "".join(random.Random(2).choices("kq8zv5jw3t", k=5_000))
    assert secret_scan.find("auth: *" + value)[1] > 1_000
