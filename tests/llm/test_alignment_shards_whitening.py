import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsink.llm import alignment, sharding, whitening
from docsink.llm.tokens import vocabulary_path

from .conftest import prose


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(vocabulary_path(alignment.VOCABULARY_A), vocabulary_path(alignment.VOCABULARY_B))


def brute_tokens(encoders, text):
    """Both tokenizers over the whole text."""
    if not text:
        return [], []
    a = encoders.a.encode(" " + text, add_special_tokens=False).ids
    b = encoders.b.encode(text)
    own = (" " + text).encode()
    same = b"".join(encoders.bytes_a[k] for k in a) == own == b"".join(encoders.bytes_b[k] for k in b)
    return (a, b) if same else ([], [])


def brute_links(a, b, long_a, long_b):
    """Links by place, and groups of tokens."""
    ends_a, ends_b = np.cumsum([long_a[k] for k in a]).tolist(), np.cumsum([long_b[k] for k in b]).tolist()
    spans_a, spans_b = list(zip([0, *ends_a], ends_a)), list(zip([0, *ends_b], ends_b))
    links = [(i, j) for i, (s, e) in enumerate(spans_a) for j, (t, f) in enumerate(spans_b) if s < f and t < e]
    cuts = sorted(set(ends_a) & set(ends_b))
    group = [([a[i] for i, e in enumerate(ends_a) if low < e <= high], [b[j] for j, e in enumerate(ends_b) if low < e <= high]) for low, high in zip([0, *cuts], cuts)]
    return links, group


def brute_alignment(encoders, texts):
    found, counts = [], Counter()
    for text in texts:
        a, b = brute_tokens(encoders, text)
        links, groups = brute_links(a, b, encoders.long_a, encoders.long_b)
        ids = [(a[i], b[j]) for i, j in links]
        counts.update(ids)
        found.append((a, b, ids, groups))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for a, b, ids, groups in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(ids), sum(counts[p] == most[p[1]] for p in ids), sum(counts[p] for p in ids), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


ODD = [
    None, "", " ", "\n", "  two  spaces   here ", "line\n next\n\n  third \t tab", "don't we'll 12 345 <|endoftext|> <s> <0x41> </s>", "▁ under", "naïve café Ω 中文字 日本", "🙂🙃 emoji‍ end", "a\u0000b \x1c c \x85 d᠎ e f",
    "x" * 3000, "trailing　 ", "İstanbul ﬁ",
]


def test_alignment_is_brute_force(spark, encoders):
    texts = [*ODD, *ODD[:6], prose(1, 300), prose(1, 300), prose(2, 150)]
    docs = spark.createDataFrame([(k if k != 3 else None, t) for k, t in enumerate(texts)], "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("lot", "code", "part", "total", "codes", "n_a")})
    rows, pairs = alignment.align_tokenizers(spark, docs)
    got = {r["doc_id"]: tuple(r[c] for c in alignment.COLUMNS[1:]) for r in rows.collect()}
    want = brute_alignment(encoders, texts)
    assert rows.count() == len(texts)
    for k, w in enumerate(want):
        assert got[k if k != 3 else None] == w, texts[k]
    assert pairs.agg(F.sum("total")).first()[0] == sum(w[3] for w in want)
    assert got[texts.index("▁ under")] == (0, 0, 0, 0, 0, 0, "") and got[9][0] > 0


def test_alignment_of_nothing(spark, no_docs):
    rows, pairs = alignment.align_tokenizers(spark, no_docs)
    assert rows.count() == pairs.count() == 0 and rows.columns == alignment.COLUMNS


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t ab'1.中 ᠎"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_units_are_the_whole_text(texts):
    own = alignment.encoders_of_worker(vocabulary_path(alignment.VOCABULARY_A), vocabulary_path(alignment.VOCABULARY_B))
    a, first_a, b, first_b = own.encoded(texts)
    for k, text in enumerate(texts):
        assert (a[first_a[k] : first_a[k + 1]].tolist(), b[first_b[k] : first_b[k + 1]].tolist()) == brute_tokens(own, text)


def test_units_are_forgotten(encoders, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    for seed in range(4):
        text = prose(seed, 40)
        a, _, b, _ = encoders.encoded([text, "▁", text])
        assert a.tolist() == 2 * brute_tokens(encoders, text)[0] and b.tolist() == 2 * brute_tokens(encoders, text)[1]


@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.randoms()), max_size=5), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_lockstep_in_lanes(docs, lane):
    ends_a, ends_b, first_a, links, cuts, base = [], [], [0], [], [], 0
    for sizes, r in docs:
        total = sum(sizes)
        mine = np.cumsum(sizes).tolist()
        other = sorted({*r.sample(range(1, total + 1), r.randint(0, total)), total})
        for i, (s, e) in enumerate(zip([0, *mine], mine)):
            for j, (t, f) in enumerate(zip([0, *other], other)):
                if s < f and t < e:
                    links.append((len(ends_a) + i, len(ends_b) + j))
                    cuts.append(e == f)
        ends_a += [base + e for e in mine]
        ends_b += [base + e for e in other]
        base += total
        first_a.append(len(ends_a))
    a, b, cut = alignment.lockstep(np.array(ends_a, np.int64), np.array(first_a), np.array(ends_b, np.int64), lane)
    assert list(zip(a.tolist(), b.tolist())) == links and cut.tolist() == cuts


def test_a_long_text_among_short_ones(spark, encoders):
    texts = [prose(k, 20) for k in range(50)] + [prose(99, 30_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in alignment.align_tokenizers(spark, docs)[0].collect()}
    a, b = brute_tokens(encoders, texts[-1])
    assert (got[50]["n_a"], got[50]["n_b"]) == (len(a), len(b)) and got[50]["n_links"] == len(a) + len(b) - got[50]["n_groups"]


def shards_of(spark, docs, **kw):
    rows = sharding.shard_documents(spark, docs, **kw).collect()
    sizes, places = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    return rows, sizes


def test_shards_are_near_equal(spark):
    texts = {k: prose(k, 5 + k % 90) for k in range(3000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    rows, sizes = shards_of(spark, docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts) and set(sizes) == set(range(40))
    assert max(sizes.values()) - min(sizes.values()) < 0.03 * sum(sizes.values()) / 40
    for r in rows:
        own = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(own) + 16, zlib.crc32(own), "bytes", None)


def test_shards_of_a_hot_key(spark):
    docs = spark.createDataFrame([(7 if k % 2 else k, prose(1, 30)) for k in range(4000)] + [(None, prose(2, 30))] * 2000, "doc_id long, text string")
    rows, sizes = shards_of(spark, docs)
    assert len(rows) == 6000 and max(sizes.values()) < 1.05 * sum(sizes.values()) / 40


def test_shards_of_odd_documents(spark, odd_docs, no_docs):
    rows, _ = shards_of(spark, odd_docs.withColumns({c: F.lit("clash") for c in ("slot", "shard", "bytes", "part", "row", "block", "size")}))
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in odd_docs.collect())
    assert {r["size"] for r in rows if r["doc_id"] in (0, 1)} == {16} and {r["text_crc32"] for r in rows if r["doc_id"] in (0, 1)} == {0}
    assert shards_of(spark, no_docs)[0] == []


def test_versions_of_a_map(spark, tmp_path):
    docs = spark.createDataFrame([(k, prose(k, 5 + k % 50)) for k in range(2000)], "doc_id long, text string")
    sizes = sharding.slot_sizes(sharding.records(spark, docs, 256)).cache()
    path = str(tmp_path / "map")
    for version, made in enumerate((lambda: sharding.first_map(sizes, 8, 256), lambda: sharding.rebalanced(sharding.read_map(spark, path, 0), sizes, 8), lambda: sharding.grown(sharding.read_map(spark, path, 1), sizes, 8))):
        sharding.write_map(made(), path, version)
    maps = [{(r["slot"], r["part"]): r["shard"] for r in sharding.read_map(spark, path, v).collect()} for v in range(3)]
    held = {(r["slot"], r["part"]): r["bytes"] for r in sizes.collect()}
    load = [Counter({s: sum(held[k] for k in held if m[k] == s) for s in set(m.values())}) for m in maps]
    assert all(set(m) == set(held) for m in maps)
    assert max(load[1].values()) < 1.02 * sum(held.values()) / 8 < max(load[0].values())
    assert {maps[2][k] for k in held if maps[2][k] != maps[1][k]} == {8} and load[2][8] > 0.8 * sum(held.values()) / 9
    assert sum(maps[0][k] != maps[1][k] for k in held) < len(held) / 3, "an edit moves few slots"
    with pytest.raises(Exception, match="(?i)exists"):
        sharding.write_map(sharding.read_map(spark, path, 1), path, 1)


def whitened_of(spark, rows, **kw):
    found = whitening.whiten(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("x", "n", "i", "row", "component")}), **kw).collect()
    return found, np.array([r["whitened"] for r in found]).reshape(-1, max((r["component"] for r in found), default=1))


def test_whitening_is_that_of_the_covariance(spark):
    r = np.random.default_rng(3)
    vectors = (r.normal(size=(500, 12)) * np.geomspace(1, 1e-2, 12) @ r.normal(size=(12, 12)) * 0.1 + 5).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(3, vectors[3].tolist()), (None, vectors[4].tolist())]
    bad = [(600, None), (601, [float("nan")] * 12), (602, [None] * 12), (603, [float("inf")] + [0.0] * 11), (604, []), (605, [1.0] * 5)]
    found, w = whitened_of(spark, rows + bad)
    x = np.floor(1024 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 100_000
    n = len(x)
    e, v = np.linalg.eigh(np.cov(x.T, bias=True))
    e, v = e[::-1], v[:, ::-1]
    want = (x - x.mean(axis=0)) @ v[:, :8] / np.sqrt(e[:8])
    assert len(found) == 8 * n and {r["vec_id"] for r in found} == {k for k, _ in rows}
    by_row = defaultdict(list)
    for r in found:
        by_row[r["vec_id"]].append(r)
    sign = np.sign([sum(by_row[k][c]["whitened"] * want[k, c] for k in range(5, 500)) for c in range(8)])
    for k in range(500):
        for own in by_row[k]:
            c = own["component"] - 1
            assert abs(own["whitened"] * sign[c] - want[k, c]) < 1e-6
            assert own["n"] == n and abs(own["explained"] / (e[c] / e.sum()) - 1) < 1e-8 and own["identity_error"] < 1e-8
        assert by_row[k][0]["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[k], x.sum(axis=0)))
    assert len(by_row[3]) == 16 and len(by_row[None]) == 8


def test_whitening_without_rank(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(200, 3)).astype(np.float32)
    vectors = np.hstack([base, base, np.full((200, 2), 0.5, np.float32)])
    found, w = whitened_of(spark, [(k, v.tolist()) for k, v in enumerate(vectors)])
    assert w.shape == (200, 3) and {r["identity_error"] < 1e-8 for r in found} == {True} and abs(sum(r["explained"] for r in found[:3]) - 1) < 1e-9
    assert whitened_of(spark, [(k, [1.0, 2.0]) for k in range(9)])[0] == [] and whitened_of(spark, [(1, [1.0])])[0] == []
    assert whitened_of(spark, [])[0] == [] and whitened_of(spark, [(1, None)])[0] == []


def test_whitening_of_one_hot_vector(spark):
    r = np.random.default_rng(5)
    rows = [(k, [0.25] * 10) for k in range(900)] + [(k, v) for k, v in enumerate(r.normal(size=(100, 10)).astype(np.float32).tolist(), 900)]
    found, w = whitened_of(spark, rows)
    assert w.shape == (1000, 8) and np.abs(np.cov(w.T, bias=True) - np.eye(8)).max() < 1e-8


def test_ill_conditioned_rows_are_orthogonalised():
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 6)) @ np.diag(np.geomspace(1, 1e-7, 6)) @ r.normal(size=(6, 6))

    def gram(factors):
        q = whitening._solved(x, factors)
        return q.T @ q

    got = np.linalg.svd(whitening.factored(gram, 400, 6))[1]
    assert np.allclose(got / np.linalg.svd(x)[1], 1, rtol=1e-6)
