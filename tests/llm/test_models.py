import numpy as np
import pytest

from docsink.llm import personal_data, quality_model, toxicity
from docsink.llm.common import held_out

from .conftest import prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = [], []
    for i in range(400):
        toxic, bad = i % 5 == 0, i % 4 == 1
        text = prose(i, 120 + i % 60)
        if toxic:
            words = text.split()
            words[i % 90] = "scoundrel" if i % 2 else "rotters"
            text = " ".join(words)
        if bad:
            text = " | ".join(text.split())
        docs.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def accuracy(scored, labels, label):
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    return np.mean([r["predicted"] == r[label] for r in rows])


def test_quality_on_held_out(spark, labelled):
    docs, labels = labelled
    assert accuracy(quality_model.quality(spark, docs, labels), labels, "quality") > 0.97


def test_toxicity_on_held_out(spark, labelled):
    docs, labels = labelled
    scored = toxicity.toxicity(spark, docs, labels)
    assert accuracy(scored, labels, "toxic") > 0.97
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_sampled_toxicity_learns_from_the_bound(spark, labelled):
    docs, labels = labelled
    assert accuracy(toxicity.toxicity(spark, docs, labels, sample=200), labels, "toxic") > 0.9


@pytest.mark.parametrize("model", [quality_model.quality, toxicity.toxicity])
def test_models_on_odd_documents(spark, labelled, odd_docs, no_docs, model):
    docs, labels = labelled
    odd = odd_docs.selectExpr("doc_id + 1000 as doc_id", *[c for c in odd_docs.columns if c != "doc_id"])
    got = model(spark, odd.unionByName(docs, allowMissingColumns=True), labels)
    rows = got.where("doc_id >= 1000").collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert model(spark, no_docs, labels).count() == 0
    no_labels = spark.createDataFrame([(5, None, None), (6, 1, 0)], LABELS)
    assert {r["predicted"] for r in model(spark, docs, no_labels).collect()} <= {0, 1}


@pytest.mark.parametrize("model, label", [(toxicity.toxicity, "toxic"), (quality_model.quality, "quality")])
def test_held_out_is_never_learnt_from(spark, labelled, model, label):
    import zlib

    docs, labels = labelled
    rows = docs.select("doc_id", held_out(docs["doc_id"]).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    flipped = labels.withColumn(label, (1 - labels[label])).where(held_out(labels["doc_id"])).unionByName(labels.where(~held_out(labels["doc_id"])))
    a, b = (model(spark, docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert np.allclose(a["score"], b["score"])


def test_n_grams_are_of_code_points():
    """A gram is the same wherever it stands, ends within its text, and tells letters apart that share bytes."""
    at = lambda t, n: [int(h) for k, (h, _) in enumerate(toxicity.grams(*toxicity.code_points([t]))) if k == n - 3 for h in h]
    assert at("xéöü", 3)[1] == at("ÉÖÜ", 3)[0] and at("éöü", 3) != at("éöū", 3)
    data, starts = toxicity.code_points(["ab", "cde"])
    assert [len(p) for _, p in toxicity.grams(data, starts)][:1] == [1]


def brute_base(text):
    import re

    found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def test_very_long_numbers():
    text = "0" * 5000 + "1.2.3.4 " + "9" * 5000 + ".1.2.3"
    assert personal_data.base_spans(text)[0] == (personal_data.IP, 0, 5007)


def test_base_spans_by_brute_force():
    import random

    r = random.Random(5)
    parts = ["a.b@c.de", "x@y", "@", "@@", "a@b.c_d@e.fg", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4539578763621486", "4539 5787 6362 1486", "4539578763621487", "+1 (555) 123-4567", "+1", "+12345678", "+1-2-3", " ", "  ", "é", "word", "7", "-", ".", "\n", "0001.2.3.4", "00000000000000000001.2.3.4"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert sorted(personal_data.base_spans(text)) == brute_base(text), text


def test_personal_data(spark, odd_docs, no_docs):
    rows = [(100 + i, f"{prose(i, 20)} mail jo.{i}@site{i}.example.com or +1 (555) 010-{1000 + i} from 10.0.{i}.7 card 4539578763621486 ok {i} 99999999999{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = personal_data.train(docs)
    for r in personal_data.personal_data(docs, model).collect():
        assert (r["n_email"], r["n_ip"], r["n_phone"]) == (1, 1, 1)
        assert r["spans"].startswith("email:")
    odd = personal_data.personal_data(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(r["spans"] == "" for r in odd if r["doc_id"] < 7)
    assert personal_data.personal_data(no_docs, personal_data.train(no_docs)).count() == 0
    clean = personal_data.redact(docs.withColumn("z", docs["doc_id"]), model)
    assert clean.columns == ["doc_id", "text", "z"] and clean.where("text like '%@site%' or text like '%010-1%'").count() == 0


def test_planted_loose_data_is_found_and_redacted(spark):
    rows = [(i, f"{prose(i, 20)} mail jo.{i}@site{i}.example.com or +1 (555) 010-{1000 + i} from 10.0.{i % 250}.7 card 4539 5787 6362 1486 ok; version 4.{i}.2, isbn 978-3-16-14{i % 10}410-0, id 4539.5787.6362.{1487 + i}") for i in range(120)]
    model = personal_data.train(spark.createDataFrame(rows, "doc_id long, text string"))
    planted = {
        "write to ann.lee [at] mill-pond [dot] org. Then rest": "write to [EMAIL]. Then rest",
        "jo(at)site.example.net": "[EMAIL]",
        "paid by card 4539.5787.6362.1486 today": "paid by card [CARD] today",
        "phone 0044 20 7946 0958 now": "phone [PHONE] now",
        "tel (555) 010-4477": "tel [PHONE]",
    }
    clean = ["version 4.10.2 of it", "isbn 978-3-16-148410-0", "order 4539.5787.6362.1487 sent", "look (at) me. Then go", "on 2024-10-11 at noon", "see 12 34 56 78 there"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*planted, *clean])], "doc_id long, text string")
    got = [r["text"] for r in personal_data.redact(docs, model).orderBy("doc_id").collect()]
    assert got == [*planted.values(), *clean]


def test_spelled_addresses_by_brute_force():
    """Against the plain pattern, whose time is not linear, leftmost and without overlaps."""
    import random
    import re

    whole = re.compile(r"[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]+)+")
    r = random.Random(6)
    parts = ["a", "b-c", " ", "[at]", "(at)", ".", "[dot]", "(dot)", "é", "x", "\n", ","]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        longest = {}
        for a, b in personal_data.spelled_emails(text):
            longest[a] = max(b, longest.get(a, 0))
        assert sorted(longest.items()) == [m.span() for m in whole.finditer(text)], text


def test_many_candidates_in_a_long_text():
    """Time is about linear in the candidates of one text."""
    import time

    model = personal_data.Model(np.zeros((0, personal_data.WIDTH)), np.zeros(0))
    model.thresholds = [0.0] * 4
    text = "tel 555 010 4477, 4.10.2.7.1 a [at] b.de; " * 8000
    begun = time.time()
    base, spans = model.spans(text)
    assert len(spans) > 20_000 and time.time() - begun < 30
    assert all(a[2] <= b[1] for a, b in zip(sorted(spans, key=lambda x: x[1]), sorted(spans, key=lambda x: x[1])[1:], strict=False))


def test_redaction_covers_overlaps():
    assert personal_data.redacted_text("ab cd ef", [(0, 0, 4), (1, 3, 5), (3, 6, 8)]) == "[EMAIL] [PHONE]"


def test_models_learn_from_every_candidate(spark):
    """No number of documents, nor of candidates of one, is left out, however the rows are dealt out."""
    rows = [(i, f"call 00 20 79{i % 10} 0958 or mail a{i}@b.org now") for i in range(30)] + [(99, " ".join(f"phone 555 010 {k:04d} x, a{k} [at] b.de;" for k in range(700)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cases = 0
    for _, text in rows:
        for kind, start, end, base in personal_data.candidates_in(text):
            cases += 1 + (len(list(personal_data.variants(text, kind, start, end))) if base else 0)
    seen, made = [], personal_data.Model.__init__

    def spy(self, x, y, n=None, *more, **named):
        seen.append((len(y) if n is None else int(n.sum()), x.shape))
        made(self, x, y, n, *more, **named) if n is not None else made(self, x, y)

    personal_data.Model.__init__ = spy
    try:
        models = [personal_data.train(docs.repartition(k)) for k in (1, 7)]
    finally:
        personal_data.Model.__init__ = made
    assert [n for n, _ in seen] == [cases, cases] and cases > 1400 and max(shape[0] for _, shape in seen) < 200
    assert models[0].thresholds == models[1].thresholds and models[0].trees.trees == models[1].trees.trees
