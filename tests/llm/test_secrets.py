"""Fixed patterns against a plain scan, and what the Markov models find among planted strings."""

from __future__ import annotations

import os
import random
import re

import pytest

from tarn.llm import secrets
from test_operators import prose

FOLDER = os.environ.get("TARN_TEST_DATA", "/root/testdata/sf0.001")
PATTERNS = [re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII),
            re.compile(r"(AKIA)([A-Z0-9]+)"), re.compile(r"()([0-9a-f]+)")]


def plain_scan(text: str) -> list[tuple[str, int, int]]:
    found = []
    for kind, pattern in zip(("assign", "access", "hex"), PATTERNS):
        for m in pattern.finditer(text):
            if {"assign": len(m.group(2)) >= 6, "access": len(m.group()) >= 20, "hex": len(m.group()) >= 24}[kind]:
                found.append((m.start(), secrets.KINDS.index(kind), kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_base_spans_equal_a_plain_scan(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(-1, "é API_KEY = 'abcdef' ſecret=abcdefg PASSWD:xy token=\"" + "0a" * 12), (-2, "AKIA" * 6 + " x" + "f" * 30), (-3, None)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    want = {r["doc_id"]: plain_scan(r["text"] or "") for r in table.collect()}
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "random"]
           for r in secrets.find_secrets(table).collect()}
    assert got == want and sum(map(len, want.values())) >= 5


def test_planted_secrets_without_a_label(spark):
    """Random strings of three alphabets are found, numbers and ordinary long names are not."""
    dice = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda alphabet, n: "".join(dice.choices(alphabet, k=n))
    name = lambda: "_".join(dice.choices(prose(dice.randrange(10 ** 6), 30).split(), k=5))
    rows, want = [], set()
    for i in range(300):
        card = f"{dice.randrange(10 ** 15, 10 ** 16)}"
        text = f"{prose(i, 40)} token: {draw(letters, 32)} paid with {card} by {name()} {prose(i + 1, 5)}"
        if i % 3 == 0:
            secret = draw(letters if i % 2 else letters[:26] + letters[52:], dice.choice([20, 28, 40]))
            want.add((i, len(text) + 1, len(text) + 1 + len(secret)))
            text += f" {secret} {prose(i + 2, 4)}"
        rows.append((i, text))
    found = {(r["doc_id"], s["start"], s["end"]) for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
             for s in r["spans"] if s["kind"] == "random"}
    precision, recall = len(found & want) / max(1, len(found)), len(found & want) / len(want)
    assert precision >= 0.98 and recall >= 0.9, (precision, recall)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_numbers_are_no_secrets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = [text[r["doc_id"]][s["start"]:s["end"]] for r in secrets.find_secrets(docs).collect() for s in r["spans"] if s["kind"] == "random"]
    assert not [f for f in found if f.isdigit()]
