import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsink.llm import packing, quality_rules, tokens

from .conftest import prose


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    triples = Counter(zip(w, w[1:], w[2:]))
    hit = {p for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for p in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_rule_counts(spark, odd_docs):
    rows = quality_rules.quality_rules(spark, odd_docs).collect()
    texts = defaultdict(list)
    for r in odd_docs.collect():
        texts[r["doc_id"]].append(r["text"])
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(texts[r["doc_id"]][0])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_repeats_and_lines(spark):
    texts = ["a b c x a b c y a b c", "a a a a", "l1\nl1\n\n \nl1 \nl1", "one two\rthree\x0bfour\x0cfive", "a b a b a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.measures(docs).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_counts(t)


def test_rules_on_no_documents(spark, no_docs):
    assert quality_rules.quality_rules(spark, no_docs).count() == 0


def test_estimated_rules_separate(spark):
    good = [(i, prose(i, 200)) for i in range(60)]
    bad = [(100 + i, " | ".join(prose(i, 200).split())) for i in range(10)]
    kept = {r["doc_id"] for r in quality_rules.quality_rules(spark, spark.createDataFrame(good + bad, "doc_id long, text string")).where("kept").collect()}
    assert {i for i, _ in good} == kept


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def test_token_counts(spark, odd_docs, tokenizer):
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    for r in tokens.count_tokens(odd_docs).collect():
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids))
        assert r["over_limit"] == (r["n_tokens"] > 2048)


def test_pre_tokens_are_the_tokenizers(tokenizer):
    import random

    r = random.Random(1)
    signs = "abzABZ019 '\t\n.,!-<|>%$éßÀÿµªº²¼½¾«»×÷'s't're've'm'll'd"
    pieces = tokens.Pieces(tokens.vocabulary_path(), ids=True)
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    for t, own in zip(texts, tokens.ids_of(texts, pieces), strict=True):
        assert own == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aZ1 '\n.“”’—é\u0301\u0307中ﬁİ<|>"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=5), st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "’s", "it’s"]), max_size=3))
@settings(max_examples=200, deadline=None)
def test_pre_tokens_of_any_script(texts, between):
    from tokenizers import Tokenizer

    own = tokens.pieces_of_worker(tokens.vocabulary_path(), ids=True)
    texts = [*texts, "".join(x + y for x, y in zip(texts, between))]
    for t, ids in zip(texts, tokens.ids_of(texts, own), strict=True):
        assert ids == np.array(Tokenizer.encode(own.tokenizer, t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_one_curly_quote_does_not_send_a_text_whole(monkeypatch):
    own = tokens.Pieces(tokens.vocabulary_path())
    text = "the same few words “again” and again " * 200
    seen = []
    monkeypatch.setattr(own, "encoded", lambda x, made=own.encoded: seen.append(len(x)) or made(x))
    own.learn(set(own.cut(text)))
    assert sum(own.known[x] for x in own.cut(text)) == len(own.tokenizer.encode(text, add_special_tokens=False).ids) and seen == [len("the same few words “ again ” and") ]


def test_remembered_pre_tokens_begin_anew(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    pieces = tokens.Pieces(tokens.vocabulary_path(), ids=True)
    for t in ("one two three four", "five six seven one two", "one nine"):
        assert tokens.ids_of([t], pieces) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()]


def check_packed(rows, texts, tokenizer, capacity):
    ids = {d: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4") for d, t in texts.items()}
    by_sequence = defaultdict(list)
    got = Counter()
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(own.tobytes()) and len(own) == r["length"] and r["start"] == r["piece"] * capacity
        got[r["doc_id"]] += r["length"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), got


def test_packing_round_trip(spark, tokenizer):
    texts = {i: prose(i, 3 * (i % 40) + (4000 if i % 50 == 0 else 0)) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack_documents(spark, docs, capacity=256).collect()
    n, got = check_packed(rows, texts, tokenizer, 256)
    assert set(got) == set(texts)
    assert n <= -(-sum(got.values()) // 256) + 2


def test_packing_odd_documents(spark, odd_docs, no_docs):
    rows = packing.pack_documents(spark, odd_docs).collect()
    assert {r["doc_id"] for r in rows} == set(range(12))
    assert sum(r["doc_id"] == 9 for r in rows) == 2
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack_documents(spark, no_docs).count() == 0


@pytest.mark.parametrize("histogram", [{500: 1000}, {1: 5000}, {2048: 3, 2047: 2, 1: 2}, {700: 10, 683: 10, 665: 10}, {1025: 7}, {i: i % 7 for i in range(1, 2049)}])
def test_plan_holds_every_piece_once(histogram):
    histogram = {k: v for k, v in histogram.items() if v and k < packing.CAPACITY}  # full pieces need no plan
    made = packing.plan(histogram)
    held = Counter()
    for pattern, n in made:
        assert sum(pattern) <= 2048 and n > 0
        for x in pattern:
            held[x] += n
    assert held == Counter({k: v for k, v in histogram.items() if v})
    least = max(-(-sum(k * v for k, v in histogram.items()) // 2048), sum(v for k, v in histogram.items() if k > 1024))
    if 500 in histogram and len(histogram) == 1:
        least = 250
    assert sum(n for _, n in made) <= least + 1


def test_plan_is_near_the_bound_on_random_histograms():
    r = np.random.default_rng(3)
    histogram = Counter(np.minimum(2047, r.lognormal(6, 1, 20_000).astype(int) + 1).tolist())
    made = packing.plan(dict(histogram))
    assert sum(n for _, n in made) <= 1.002 * sum(k * v for k, v in histogram.items()) / 2048 + 1
    assert sum(F is not None and n * len(p) for p, n in made) == 20_000
