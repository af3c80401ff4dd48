"""Token ids, leakage, cut texts."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.llm import leakage, tokenize, truncation

there = pytest.mark.skipif(not os.path.exists(tokenize.VOCABULARY), reason="no vocabulary")
TRICKY = ["", "it's we'll 're's  x", "  a  \n b   ", " \t\n", "''s 'S x'l", "a" * 5000, "é ́x 東京 🚀🚀", "<|endoftext|>", "\x00\x1c\x85", "1'd2 ½ ٣", "\r\n\r\n x"]


def ids_of(text):
    return tokenize.encode_texts([text], tokenize.VOCABULARY)[0].tolist()


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokenize.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@there
@pytest.mark.parametrize("text", TRICKY)
def test_ids_equal_the_reference_tokenizer(reference, text):
    assert ids_of(text) == reference(text)


@there
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sretvml d\n\t 1é½.!?_東  　")), max_size=40))
def test_random_texts(reference, text):
    assert ids_of(text) == reference(text)


@there
def test_texts_are_kept_apart():
    ids, counts = tokenize.encode_texts(TRICKY, tokenize.VOCABULARY)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [ids_of(t) for t in TRICKY]


@there
def test_encode_and_decode(spark):
    rows = [(i, t, "x") for i, t in enumerate([*TRICKY, None, "b" * 300_000 + " c", TRICKY[1]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokenize.encode(df).collect()}
    assert len(got) == len(rows) and got[0] == [] and got[len(TRICKY)] == []
    back = {r["doc_id"]: r["text"] for r in tokenize.decode(tokenize.encode(df)).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert tokenize.encode(df.limit(0)).count() == 0


def brute(docs, items):
    found = set()
    for d, text in docs:
        w = leakage.words_of(text or "")
        for i, item in items:
            v = leakage.words_of(item or "")
            n = min(len(v), leakage.SPAN)
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            if any(tuple(w[k : k + n]) in grams for k in range(len(w) - n + 1)):
                found.add((d, i))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_leaks_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "eps"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 6, 11, 12, 13, 30])))) for i in range(25)] + [(90, ""), (91, None), (92, "...")]
    docs = [(d, " ".join(word() for _ in range(rng.randint(0, 60)))) for d in range(30)]
    for d in range(30, 60):  # passages of all lengths around the limit, in other case and with other marks between
        v = rng.choice(items[:25])[1].split()
        n = rng.randint(1, len(v))
        a = rng.randint(0, len(v) - n)
        docs.append((d, f"Zed-{' _,\n'.join(v[a : a + n]).upper()}! zed"))
    docs += [(97, None), (98, ""), (99, docs[31][1]), (99, docs[31][1])]
    left = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string").repartition(3)
    right = spark.createDataFrame([(i, t, 5) for i, t in items] + [(*items[0], 5)], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]) for r in leakage.hits(left, right).collect()}
    assert got == brute(docs, items)


def test_covered_words_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(60))
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a " + " ".join(text.split()[5:45]) + " b"), (2, "x" * 100_000 + " " + text)], "doc_id long, text string")
    assert {(r["doc_id"], r["words"]) for r in leakage.leaks(docs, items).collect()} == {(1, 40), (2, 60)}
    assert leakage.hits(docs.limit(0), items).count() == 0 and leakage.hits(docs, items.limit(0)).count() == 0


HUNK = "diff --git a/x.c b/x.c\nindex 1234567..89abcde 100644\n--- a/x.c\n+++ b/x.c\n@@ -1,2 +1,3 @@\n keep\n-old line\n+new line\n+more lines"
HEAD = "commit " + "a" * 40 + "\nAuthor: A B <a@b.example>\nDate:   2024-01-01T00:00:00\n\n    Fix it\n\n"
WHOLE = {
    "mail": ("mail_archive", "From " + "a" * 40 + "\nFrom: A <a@b.example>\nDate: 2024-01-01T00:00:00\nSubject: [PATCH 1/1] fix\n\n---\n" + HUNK + "\n-- \n2.40.1"),
    "forge": ("forge_dump", HEAD + HUNK + "\n"),
    "crlf": ("forge_dump", (HEAD + HUNK + "\n").replace("\n", "\r\n")),
    "message": ("forge_dump", HEAD + "    It works now.\n"),
    "dots": ("forge_dump", HEAD.replace("Fix it\n\n", "more...\n")),
    "trailer": ("forge_dump", HEAD + "    It works.\n\n    Reviewed-by: A <a@b.example>\n"),
    "svn": ("svn_bridge", "r1 | a | 2024-01-01T00:00:00 | 3 lines\n\nFix\n\nDone.\n"),
    "review": ("review_export", "# Fix\n\n**Author:** A <a@b.example>\n\n```diff\n" + HUNK + "\n```"),
    "hook": ("webhook_log", "event: push\nsha: " + "a" * 40 + "\nauthor: A <a@b.example>\nmessage: |\n  Fix it\npatch: |\n" + "\n".join("  " + x for x in HUNK.split("\n")) + "\n"),
    "binary": ("forge_dump", HEAD + "diff --git a/x.png b/x.png\nindex 1234567..89abcde 100644\nBinary files a/x.png and b/x.png differ"),
    "bundle": ("bundle_import", "Fix it"),
    "only a trailer": ("review_export", "# Fix\n\n**Author:** A <a@b.example>\n\n\nRefs: #8980\n"),
}


@pytest.mark.parametrize("name", WHOLE)
def test_whole_texts_are_not_cut(name):
    source, text = WHOLE[name]
    assert truncation.end_state(text, source)[0] != truncation.CUT


@pytest.mark.parametrize(("name", "drop"), [("mail", 3), ("mail", 40), ("forge", 25), ("forge", 80), ("crlf", 40), ("message", 3), ("trailer", 4), ("svn", 7), ("review", 4), ("hook", 30), ("hook", 190), ("binary", 8), ("forge", 165)])
def test_cut_texts_are(name, drop):
    source, text = WHOLE[name]
    state, why, _ = truncation.end_state(text[:-drop], source)
    assert state == truncation.CUT or (state == truncation.ASK and why == "prose")  # a sentence without a stop


def test_tails_are_judged_by_the_corpus(spark):
    whole = [(i, HEAD + HUNK.replace("more lines", "return number") + "\n", "forge_dump", "x") for i in range(120)]
    inside_word = (900, HEAD + HUNK.replace("more lines", "return numb"), "forge_dump", "x")
    inside_line = (901, HEAD + HUNK.replace("more lines", "return"), "forge_dump", "x")
    open_end = (902, HEAD + HUNK.replace("more lines", "return number"), None, "x")
    blank = [(903, None, "forge_dump", "x"), (904, "", "forge_dump", "x"), (905, " \n\t", "svn_bridge", "x")]
    df = spark.createDataFrame([*whole, inside_word, inside_line, open_end, *blank], "doc_id long, text string, source string, cut string").repartition(3)
    got = {r["doc_id"]: (r["cut"], r["why"]) for r in truncation.truncated(df).collect()}
    assert {d for d, (cut, _) in got.items() if cut} == {900, 901}
    assert got[900][1] == "inside a word" and got[901][1] == "inside a line" and len(got) == 123
    assert [(r["source"], r["cut_texts"]) for r in truncation.rates(df).orderBy("source").collect()] == [(None, 0), ("forge_dump", 2)]
    assert truncation.truncated(df.limit(0)).count() == 0


def test_very_long_text(spark):
    text = HEAD + "    " + "word " * 200_000 + "end.\n"
    df = spark.createDataFrame([(1, text, "forge_dump")], "doc_id long, text string, source string")
    assert [r["cut"] for r in truncation.truncated(df).collect()] == [False]


def test_a_last_line_that_goes_on_elsewhere(spark):
    head = "From " + "0" * 39 + "1\nFrom: a <a@b.c>\nDate: 2020-01-01T00:00:00\nSubject: x\n\n"
    whole = head + "The queue is drained by worker 12 now.\n-- \n2.1.0\n"
    texts = [whole, head + "The queue is drained by wor", head + "The queue is drained by worker 7 now.", whole, None, "", " \n"]
    df = spark.createDataFrame([(i, t, "mail_archive") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["cut"], r["why"]) for r in truncation.truncated(df).collect()}
    # the second is a strict prefix of a line; the third a line of its own whose text lacks the end mark
    assert got[1] == (True, "line goes on") and got[2] == (True, "no footer")
    assert got[0] == got[3] == (False, "whole") and set(got) == {0, 1, 2, 3}


def test_confidence_of_shares(spark):
    df = spark.createDataFrame([(0, 1), (0, 20), (2, 20), (0, 0)], "n long, of long")
    assert [r[0] for r in df.select(truncation._at_most(0.01, 0.22, F.col("n"), F.col("of"))).collect()] == [False, True, False, False]
