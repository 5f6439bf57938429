import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsink.llm import decontaminate, near_duplicates, suffix_dedup
from docsink.llm.components import components

from .conftest import prose

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def brute_hits(docs, items):
    windows = {}
    for item, text in items:
        w = re.findall(ITEM_WORD, lowered(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = {}
    for d, text in docs:
        w = re.findall(ITEM_WORD, lowered(text))
        hit, held = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    held |= own
        out[d] = (len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("most", [1 << 17, 7])
def test_decontamination_by_brute_force(spark, tmp_path, most):
    items = [(i, prose(900 + i, 14)) for i in range(6)] + [(6, "Short one"), (7, ""), (8, None), (9, prose(900, 14)), (10, "!!!"), (11, "ÉTÉ Straße été")]
    docs = []
    for i in range(60):
        words = prose(i, 80).split()
        if i % 3 == 0:
            words[10:10] = items[i % 6][1].upper().split()[: 9 + i % 6]
        if i % 7 == 0:
            words.append("short, ONE")
        docs.append((i, " ".join(words) + (" ÉTÉ Straße été" if i % 11 == 0 else "")))
    docs += [(60, None), (61, ""), (62, "short one")]
    decontaminate.build_index(spark.createDataFrame([*docs, (3, prose(900, 14)), (3, "none")], "doc_id long, text string")).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    got = decontaminate.report(decontaminate.search(spark, index, spark.createDataFrame(items, "item_id long, text string"), most=most)).collect()
    assert len(got) == len(docs) + 2  # rows of one doc_id stay apart, whatever the number of blocks
    assert {r["doc_id"]: tuple(r)[1:] for r in got if r["doc_id"] != 3} == {k: v for k, v in brute_hits(docs, items).items() if k != 3}
    assert sorted(r["n_hit"] for r in got if r["doc_id"] == 3) == sorted([0, 14, brute_hits(docs, items)[3][1]])


def test_decontamination_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, prose(3, 20))], "item_id long, text string")
    found = {r["doc_id"]: r["n_hit"] for r in decontaminate.search(spark, decontaminate.build_index(odd_docs), items).collect()}
    assert found[3] == found[4] == 20 and found[0] == found[1] == found[7] == 0
    assert decontaminate.search(spark, decontaminate.build_index(no_docs), items).count() == 0
    assert decontaminate.search(spark, decontaminate.build_index(odd_docs), items.limit(0)).where("n_hit > 0").count() == 0


def test_window_blocks_do_not_depend_on_partitions(spark):
    items = spark.createDataFrame([(i, prose(900 + i, 40)) for i in range(60)], "item_id long, text string")
    for parts in (1, 40):
        blocks = decontaminate.item_windows(spark, items.repartition(parts, "item_id"), most=1000).collect()
        assert len(blocks) <= 4 and sum(len(r["lengths"]) // 4 for r in blocks) == 60 * 31
        assert {x for r in blocks for x in r["ids"]} == {str(i) for i in range(60)}


def test_long_words_are_told_apart():
    """Two words whose prefix sums are equal under any odd base."""
    signs = [bin(k).count("1") % 2 for k in range(2048)]
    one, two = ("".join("ab"[x ^ y] for x in signs) for y in (0, 1))
    import pyarrow as pa

    from docsink.llm.common import SpanHash, utf8

    words, _ = decontaminate.word_hashes(*utf8(pa.array([one, two])), SpanHash())
    assert words[0] != words[1]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x x alpha y beta z z gamma x"), (2, "alpha beta q q q q q q q gamma"), (3, "gamma alpha beta"), (4, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = decontaminate.build_index(docs)
    near = decontaminate.search(spark, index, items, slop=3)
    assert {r["doc_id"] for r in near.where("n_hit > 0").collect()} == {1, 3}
    assert decontaminate.search(spark, index, items).where("n_hit > 0").count() == 0


def brute_removed(docs, length=100):
    seen, out = set(), {}
    for d, text in sorted(docs, key=lambda x: x[0]):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    r = random.Random(8)
    shared = [prose(500 + i, 40) for i in range(4)]
    docs = []
    for i in range(120):
        text = prose(i, r.randint(5, 120))
        if i % 4 == 0:
            text = text[:80] + r.choice(shared)[r.randint(0, 30) :] + text[80:]
        if i % 10 == 3:
            text = docs[i // 2][1]
        if i % 15 == 7:
            words = docs[i // 3][1].split()
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        docs.append((r.randint(0, 10**6) * 200 + i, text))
    for i, (unit, n) in enumerate([("Shti ", 22), ("Shti ", 30), ("Und so ", 15), ("die ", 26), ("x", 101), ("lorem ipsum dolor sit amet, ", 5), ("q", 100)]):
        docs.append((1000 + i, prose(800 + i, 12) + " " + unit * n + prose(850 + i, 9)))  # repeats within one run
    docs += [(5, None), (6, ""), (7, "ab" * 300), (8, "q" * 500), (9, "é" * 260), (10, "x" * 99), (11, prose(2, 60) + prose(2, 60)), (3, "abc" * 100 + "ab" * 100 + "abc" * 100)]
    return docs


def test_suffix_dedup_by_brute_force(spark):
    docs = corpus()
    got = suffix_dedup.dedup(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute_removed(docs)


def chain(docs):
    """The steps of suffix_dedup one after the other in this process, and the windows that they mark."""
    import pyarrow as pa

    ids, texts = [d for d, _ in docs], [t for _, t in docs]
    own = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([0] * len(ids), pa.int32()), pa.array(texts)], names=["doc_id", "tag", "text"])
    keyed = sorted((x for b in suffix_dedup._keyed(np.arange(3, dtype=np.int32))(iter([own])) for x in b.to_pylist()), key=lambda x: (x["part"], x["slice"]))
    runs = {}
    for part in range(3):
        rows = [x for x in keyed if x["part"] == part]
        if rows:
            batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("slice", pa.int32()), *((c, pa.binary()) for c in ("keys", "docs", "spots", "n"))]))
            for b in suffix_dedup._repeated(iter([batch])):
                for x in b.to_pylist():
                    runs.setdefault(x["doc_id"], []).append({k: x[k] for k in ("key", "at", "n")})
    run = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))
    cut = pa.RecordBatch.from_arrays([*own.columns, pa.array([runs.get(i, []) for i in ids], run)], names=["doc_id", "tag", "text", "runs"])
    rows = pa.Table.from_batches(suffix_dedup._cut(iter([cut]))).to_pandas().sort_values(["key", "fragment", "doc", "spot"])
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    return {(d, a + k) for b in suffix_dedup._mark(iter([batch])) for d, _, a, n in zip(*(c.to_pylist() for c in b.columns), strict=True) for k in range(n)}


def later_windows(docs):
    seen, want = set(), set()
    for d, text in sorted(docs):
        b = text.encode()
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w in seen:
                want.add((d, i))
            seen.add(w)
    return want


def test_suffix_dedup_with_small_collections_and_hot_keys(monkeypatch):
    r = random.Random(4)
    base = prose(1, 60)
    docs = [(i, "".join(chr(97 + i % 26) if k == at else x for k, x in enumerate(base))) for i in range(80) for at in [r.randrange(len(base))]]
    want = later_windows(docs)
    assert chain(docs) == want
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 20)
    assert chain(docs) == want
    monkeypatch.setattr(suffix_dedup, "HOT", 10)
    assert chain(docs) == want


def test_many_variants_of_a_passage_never_meet_in_one_collection(monkeypatch):
    """More texts than HOT end in one passage, each after words of its own."""
    sizes, marked = [], suffix_dedup.marked

    def counted(fragments, docs, spots):
        sizes.append(len(fragments))
        return marked(fragments, docs, spots)

    monkeypatch.setattr(suffix_dedup, "marked", counted)
    passage = prose(77, 30)
    docs = [(i, f"{i * 7919:09d} {i * 104729:010d} " + passage[: 130 + i % 7]) for i in range(suffix_dedup.HOT + 2000)]
    assert chain(docs) == later_windows(docs)
    assert max(sizes, default=0) <= suffix_dedup.HOT + suffix_dedup.COLLECTION


def test_transform_is_the_suffix_order():
    r = random.Random(2)
    strings = [[r.randint(1, 3) for _ in range(r.randint(0, 12))] for _ in range(25)]
    owner, length, lcp = suffix_dedup.transform(np.array(sum(strings, []), int), np.array([len(x) for x in strings]))
    want = sorted((strings[i][len(strings[i]) - n :], i, n) for i in range(25) for n in range(len(strings[i]) + 1))
    assert [(i, n) for _, i, n in want] == list(zip(owner.tolist(), length.tolist(), strict=True))
    for (a, _, _), (b, _, _), n in zip(want, want[1:], lcp[1:], strict=False):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert n == k


def test_suffix_dedup_of_repeated_ids(spark):
    """Two texts of one doc_id are two documents; a row that repeats another wholly loses the same."""
    one, two, three = prose(1, 60), prose(2, 40) + prose(1, 60)[:200], prose(3, 50)
    rows = spark.createDataFrame([(1, one), (2, two), (2, three + prose(2, 40)), (3, three), (3, three), (None, one)], "doc_id long, text string")
    found = [tuple(r)[:4] for r in suffix_dedup.dedup(spark, rows).collect()]
    assert [x[1:] for x in found if x[0] is None] == [(len(one), 0, 0)]
    got = sorted(x for x in found if x[0] is not None)
    assert [x[0] for x in got] == [1, 2, 2, 3, 3] and got[0][2] == 0 and got[3] == got[4] and got[3][2] == len(three)
    assert sum(x[2] for x in got if x[0] == 2) >= 200 + len(prose(2, 40)) - 2


def test_suffix_dedup_odd_documents(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(spark, odd_docs).collect()}
    assert got[4]["n_removed"] == got[4]["n_bytes"] and got[3]["n_removed"] == 0 and got[0]["n_bytes"] == 0
    assert got[7]["n_removed"] == 4999
    assert suffix_dedup.dedup(spark, no_docs).count() == 0


def brute_classes(docs):
    def labelled(text):
        w = re.findall(ITEM_WORD, lowered(text))
        seen, out = Counter(), []
        for s in zip(*(w[k:] for k in range(5)), strict=False):
            out.append((s, seen[s]))
            seen[s] += 1
        return w, out

    own = [(d, t or "", *labelled(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def common(a, b):
        at = {s: i for i, s in enumerate(b)}
        import bisect

        tails = []
        for s in a:
            if s in at:
                i = bisect.bisect_left(tails, at[s])
                tails[i : i + 1] = [at[s]]
        return len(tails)

    for i, (d, t, w, x) in enumerate(own):
        for e, u, v, y in own[:i]:
            c = common(x, y) if x and y else 0
            if (w == v and (w or t == u)) or (c and c >= 0.8 * (len(x) + len(y) - c)):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in docs}


@pytest.mark.parametrize("together", [2000, 7])
def test_near_duplicates_by_brute_force(spark, monkeypatch, together):
    monkeypatch.setattr(near_duplicates, "TOGETHER", together)
    r = random.Random(9)
    docs = []
    for i in range(40):
        base = prose(i, r.randint(20, 200)).split()
        for _ in range(r.randint(1, 6)):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                k = r.randrange(len(words))
                words[k : k + r.randint(0, 1)] = [r.choice(["new", "other", words[k]])]
            docs.append((len(docs) * 3 + 1, " ".join(words)))
    drift = prose(66, 150).split()
    for i in range(60):  # each is near the one before, but not the first
        drift[r.randrange(150)] = f"w{i}"
        docs.append((4000 + i, " ".join(drift)))
    shared = prose(77, 60)
    docs += [(5000 + i, prose(300 + i, 100) + " " + shared) for i in range(20)]
    docs += [(9000, None), (9001, ""), (9002, "a b"), (9003, "A, b"), (9004, "!!!"), (9005, "???"), (9006, "one two three four five"), (9007, "one two three four five")]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    want = brute_classes(docs)
    assert {d: (got[d], c) for d, c in want.items() if got[d] != c} == {}


def test_near_duplicates_odd_documents(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(spark, odd_docs).collect()}
    assert got[3] == got[4] == 3 and got[0] == got[1] == 0 and got[5] == 5
    assert near_duplicates.near_duplicates(spark, odd_docs).count() == odd_docs.count()
    assert near_duplicates.near_duplicates(spark, no_docs).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """Each row is a text of its own, whatever its doc_id; a class is named by its least doc_id."""
    a, b, c = (prose(600 + k, 60) for k in range(3))
    rows = [(3, a), (5, a), (4, b), (5, b), (None, b), (None, c), (None, c + " end")]
    got = near_duplicates.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == sorted([(3, 3), (5, 3), (4, 4), (5, 4), (None, 4), (None, None), (None, None)], key=str)


def test_decontamination_keeps_large_and_null_ids(spark):
    text = prose(800, 12)
    docs = spark.createDataFrame([(2**53 + 1, text), (None, text), (3, "none"), (-(2**63), text)], "doc_id long, text string").coalesce(1)
    got = decontaminate.search(spark, decontaminate.build_index(docs), spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_hit"]) for r in got), key=str) == sorted([(2**53 + 1, 12), (None, 12), (3, 0), (-(2**63), 12)], key=str)


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {x["node"]: x["root"] for x in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent if any(x in p and p[0] != p[1] for p in links)}
