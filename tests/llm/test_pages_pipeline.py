import functools
import json
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docsink.llm import html_text, packing, tokens
from docsink.llm.quality_model import quality

from .conftest import prose
from .test_duplicates_leaks import brute_classes, brute_hits
from .test_models import brute_base
from .test_rules_tokens_packing import check_packed


def page(i, body, extra="", chrome=True):
    top = '<header><a href="/">Site</a></header><nav><ul><li><a href="/a">Alpha</a></li><li><a href="/b">Beta</a></li></ul></nav><div class="cookie-notice">We use cookies</div>' if chrome else ""
    return f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>{top}<!-- c --><div class="ad">Buy {i}!</div><article><h1>Title {i}</h1>{body}</article>{extra}<aside>Side {i}</aside><footer>&copy; site</footer></body></html>'


def test_extraction_of_articles(spark):
    rows, want = [], {}
    for i in range(30):
        a, b = prose(i, 40), prose(100 + i, 30)
        body = f"<p><b>{a}<br><p>{b} &amp; caf&eacute; x<i>y</i>z</p><form><input name=q>search</form><script>no()</script>"
        rows.append((i, f"https://h{i % 3}.example.com/{i}", page(i, body, '<div id="comments"><p>First!</p></div>')))
        want[i] = f"Title {i} {a} {b} & café xyz"
    got = html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_extraction_without_article_elements():
    rows = [f"<html><body><div class='menu'><a href=1>One</a></div><div class='content'><h2>H{i}</h2><p>{prose(i, 60)}</p><p>{prose(50 + i, 50)}</p></div><div class='sidebar'>Links {i}</div></body></html>" for i in range(5)]
    made = html_text.infer(rows)
    assert made["path"][-1] == "div[class=content]"
    for i, row in enumerate(rows):
        assert html_text.main_text(row, tuple(made["path"]), frozenset(made["template"])) == f"H{i} {prose(i, 60)} {prose(50 + i, 50)}"


def test_template_texts_go():
    rows = [page(i, f"<p>{prose(i, 80)}</p><p>Subscribe to our letter.</p>") for i in range(6)]
    made = html_text.infer(rows)
    assert made["template"] == ["Subscribe to our letter."]
    copies = html_text.infer([page(1, f"<p>{prose(1, 80)}</p>")] * 6)  # copies share all: nothing is the template's
    assert copies["template"] == []


def test_ids_and_classes_by_page(spark):
    rows, want = [], {}
    for i in range(8):
        text = prose(i, 60)
        named = f"<article id='post-{i}' class='post post-{i}' data-id={i}><p>{text}</p></article>"
        plain = f"<div id='post-{i}' class='entry entry-{i}'><p>{text}</p></div>"
        rows += [(2 * i + k, f"http://h{k}.org/{i}", f"<html><body><div class='site-info'>By the staff of this site</div>{own}</body></html>") for k, own in enumerate((named, plain))]
        want |= {2 * i: text, 2 * i + 1: text}
    got = html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_all_pages_of_a_host_count(spark):
    """A rare layout, long pages without article elements, and headings that repeat."""
    rows, want = [], {}
    for i in range(60):
        a, b = prose(i, 60), prose(900 + i, 60)
        if i % 6 == 5:
            body = f"<div class=story><p>{a}</p></div><div class=panel><p>{prose(i, 20)}</p></div>"
            want[i] = a
        elif i % 6 == 4:
            body = "<div class=body>" + "".join(f"<div id=s{k}><h2>Part {k}</h2><p>{a} {k}</p><ul><li>x{i}</ul><p><b>y{i}</b></p></div>" for k in range(400)) + "</div>"
            want[i] = " ".join(f"Part {k} {a} {k} x{i} y{i}" for k in range(400))
        else:
            body = f"<div class=body><h2>Ingredients</h2><p>{a}</p><p>Serves four.</p><p>{b}</p><p>Subscribe to our letter.</p></div>"
            want[i] = f"Ingredients {a} Serves four. {b}"
        rows.append((i, f"http://cook.org/{i}", f"<html><body>{body}</body></html>"))
    got = html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_optional_groups_are_siblings():
    wrapper = html_text.align(["<div>", "<p>", "#", "</p>", "</div>"], ["<ul>", "<p>", "#", "</p>", "</ul>"])
    assert set(html_text.slots(wrapper)) == {("div", "p"), ("ul", "p")}


def test_folding_and_alignment():
    stream = ["<ul>", "<li>", "#", "</li>", "<li>", "#", "</li>", "<li>", "#", "</li>", "</ul>"]
    folded = html_text.fold(stream)
    assert folded == ["<ul>", ("+", ("<li>", "#", "</li>")), "</ul>"]
    assert html_text.align(folded, ["<ul>", "<li>", "#", "</li>", "</ul>"]) == folded
    assert html_text.align(["<p>", "#", "</p>"], ["<p>", "#", "</p>", "<hr/>"]) == ["<p>", "#", "</p>", ("?", ("<hr/>",))]
    assert list(html_text.slots(folded)) == [("ul", "li")]


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a.b/", ""), (3, "x", "plain text only"), (4, "http://a.b/", "<p>unclosed <b>bold"), (5, "http://a.b/", "<<<>>> & &amp;lt; <"), (6, "http://a.b/", "<article>" + "word " * 50_000 + "</article>"), (6, "http://a.b/", "<article>again</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("path", F.lit("clash")).withColumn("text", F.lit("clash"))
    got = html_text.extract(spark, pages).collect()
    assert len(got) == 7
    texts = {(r["page_id"], r["n_chars"]): r["text"] for r in got}
    assert texts[1, 0] == texts[2, 0] == "" and texts[3, 15] == "plain text only" and texts[4, 13] == "unclosed bold" and texts[6, 249_999][:9] == "word word" and texts[6, 5] == "again"
    assert html_text.extract(spark, pages.limit(0)).count() == 0


def test_deep_pages_take_linear_time():
    began = time.time()
    deep = "".join(f"<div>{k} " for k in range(5000))
    assert html_text.main_text(deep, (), frozenset()).endswith("4998 4999")  # the innermost element with most of the text
    lists = "<ul><li><ul>" + "<div>" * 5000 + "<li>x</li>" * 5000
    assert html_text.main_text(lists, (), frozenset()) == " ".join(["x"] * 5000)
    assert time.time() - began < 2
    assert html_text.infer([deep, deep])["paths"] != []


def fits(rule, content):
    """By brute force: whether an expression of regular expressions, made of the rule, takes the content."""
    group = {"": "{}", "?": "(?:{})?", "+": "(?:{})+", "*": "(?:{})*"}
    return bool(re.fullmatch("".join(group[kind].format("|".join(re.escape(x) + ";" for x in labels)) for kind, labels in rule), "".join(x + ";" for x in content)))


def test_contents_are_aligned():
    def aligned(*contents):
        return json.loads(html_text.rule_text(functools.reduce(html_text.align_content, ([("", (x,)) for x in c.split()] for c in contents))))

    assert aligned("nav div article footer", "nav article footer") == ["nav", ["?", "div"], "article", "footer"]
    assert aligned("h1 p p", "h1 p p p p") == ["h1", ["+", "p"]]
    assert aligned("h1 h2 p p h2 p foot", "h1 h2 p h2 p h2 p ul foot") == ["h1", ["+", "h2", "p"], ["?", "ul"], "foot"]
    assert aligned("div div div", "div div div") == ["div", "div", "div"]
    assert aligned("# b # i", "# b # i") == ["#", "b", "#", "i"]
    assert aligned("# b #", "# i # b # a") == [["+", "#", "b", "i"], ["?", "a"]]


def test_rules_take_all_contents_they_were_made_of():
    r = random.Random(4)
    exact = 0
    for trial in range(600):
        names = "#abcde"[: r.randint(1, 6)]
        base = [r.choice(names) for _ in range(r.randint(0, 7))]
        contents = [[x for x in base if r.random() < 0.8] + [r.choice(names) for _ in range(r.choice((0, 0, 1, 3)))] for _ in range(r.randint(1, 6))]
        models = [[("", (x,)) for x in c] for c in contents]
        k = r.randint(1, len(models))
        halves = [functools.reduce(html_text.align_content, part) for part in (models[:k], models[k:]) if part]
        rule = functools.reduce(html_text.align_content, halves)
        assert html_text.rule_from(html_text.rule_text(rule)) == rule
        for labels, at in html_text.where(rule).items():
            assert len(at) == 1 or not any(rule[i][0] for i in at)
        for c in contents:
            slots = html_text.slots_of(rule, c)
            assert fits(rule, c) and slots is not None and all(x in rule[i][1] for x, i in zip(c, slots, strict=True))
        for _ in range(20):
            c = [r.choice(names + "z") for _ in range(r.randint(0, 6))]
            assert (html_text.slots_of(rule, c) is not None) == fits(rule, c)
            exact += fits(rule, c)
    assert exact > 100
    many = [("", (x,)) for x in "# br".split() * 20_000]
    began = time.time()
    assert html_text.rule_text(html_text.align_content([("", ("b",)), *many], [*many, ("", ("i",))])).count("br") == 20_000
    assert html_text.align_content(many, many[1:]) == [("+", ("#", "br"))]
    assert time.time() - began < 5


def sites():
    """Two hosts whose pages have no marks, and a long notice that is no repeated block of theirs by name: (rows, texts)."""
    rows, want = [], {}
    notice = prose(7000, 150)
    for i in range(12):
        text, promo = prose(i, 50 + 4 * i), prose(800 + i, 14)
        rows.append((2 * i, f"http://plain.org/{i}", f"<html><body><section><p>{notice}</p></section><p>{text}</p><p>{promo}</p>{'' if i % 3 else '<hr><p>End.</p>'}</body></html>"))
        want[2 * i] = f"{text} {promo}" + ("" if i % 3 else " End.")
        rows.append((2 * i + 1, f"http://divs.org/{i}", f"<html><body><div><p>{promo}</p></div><div><p>{text}</p><p>{text[::-1]}</p></div><div><p>{promo[::-1]}</p></div></body></html>"))
        want[2 * i + 1] = f"{text} {text[::-1]}"
    return rows, want


def test_pages_are_read_by_the_aligned_expression(spark, monkeypatch):
    """The host's strings go and elements are told apart by their place in the rule; without the expression the texts differ."""
    rows, want = sites()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.extract(spark, pages).collect()} == want
    monkeypatch.setattr(html_text, "LOT", 2)  # lots of two, then lots of lots
    assert {r["page_id"]: r["text"] for r in html_text.extract(spark, pages.repartition(5)).collect()} == want
    for host in ("plain", "divs"):
        own = [(i, source) for i, url, source in rows if host in url]
        made = html_text.infer([source for _, source in own])
        keys = {functools.reduce(html_text.path_key, p, 0) for p in made["paths"]}
        for i, source in own:
            assert html_text.main_text(source, keys, frozenset(made["template"]), frozenset(made["shared"]), html_text.Expression(made["expression"])) == want[i]
            assert html_text.main_text(source, keys, frozenset(made["template"]), frozenset(made["shared"])) != want[i]


def test_expressions_of_hosts(spark, monkeypatch):
    """The rules of all pages, in lots or not, are those of the list of pages; each takes all contents of its path."""
    rows = [(f"h{i % 2}", page(i, f"<p>{prose(i, 9)}</p>" * (1 + i % 5) + f"<ul>{'<li>x</li>' * (i % 4)}</ul>" * (i % 3), "<hr>" * (i % 2))) for i in range(40)]
    pages = spark.createDataFrame(rows, "host string, html string")
    marked = pages.withColumn("shared", F.array(F.lit("div class=ad"), F.lit("div class=cookie-notice")))
    for lot in (256, 2):
        monkeypatch.setattr(html_text, "LOT", lot)
        got = {(r["host"], r["path"]): (html_text.rule_from(r["rule"]), r["n"]) for r in html_text.rules(spark, marked)[0].collect()}
        seen = set()
        for host, source in rows:
            one = html_text.Page(source, frozenset(("div class=ad", "div class=cookie-notice")))
            for node, content, _, _ in one.contents:
                seen.add((host, one.keys[node]))
                assert fits(got[host, one.keys[node]][0], content)
        assert seen == set(got) and max(n for _, n in got.values()) == 20
        if lot == 256:
            for host in ("h0", "h1"):
                assert {p: rule for (h, p), (rule, _) in got.items() if h == host} == html_text.infer([s for h, s in rows if h == host])["rules"]


@pytest.fixture
def tables(spark, tmp_path):
    docs, labels, items = [], [], [(i, prose(700 + i, 15)) for i in range(5)]
    for i in range(240):
        text = prose(i, 90 + i % 50)
        if i % 4 == 1:
            text = " | ".join(text.split())
        elif i % 10 == 2:
            text = docs[i - 2][1] if i % 20 == 2 else docs[i - 2][1] + " one more"
        elif i % 14 == 3:
            text += " " + items[i % 5][1]
        elif i % 6 == 4:
            text += f" write to jo.{i}@mail.example.com or +1 (555) 010-{1000 + i}"
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(i % 4 != 1), 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, items


def test_pipeline_by_brute_force(spark, tables):
    from tokenizers import Tokenizer

    sf_dir, docs, items = tables
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {d[0]: d[1] for d in docs}

    accepted = {r["doc_id"] for r in quality(spark, frame, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()}
    assert {i for i in texts if i % 4 != 1} == accepted
    stages = dict(corpus_pipeline.STAGES)
    now = stages["quality"](spark, frame, sf_dir)
    assert now.columns == frame.columns and {r["doc_id"] for r in now.collect()} == accepted

    classes = brute_classes([(d, texts[d]) for d in sorted(accepted)])
    firsts = {d for d, c in classes.items() if d == c}
    now = stages["near duplicates"](spark, now, sf_dir)
    assert now.columns == frame.columns and {r["doc_id"] for r in now.collect()} == firsts < accepted

    clean = {d for d, hit in brute_hits([(d, texts[d]) for d in firsts], items).items() if not hit[-1]}
    now = stages["decontamination"](spark, now, sf_dir)
    assert now.columns == frame.columns and {r["doc_id"] for r in now.collect()} == clean < firsts

    now = stages["personal data"](spark, now, sf_dir)
    rows = now.collect()
    assert now.schema == frame.schema and {r["doc_id"] for r in rows} == clean
    for r in rows:
        assert brute_base(r["text"]) == [] and r["n_chars"] == len(r["text"])
        assert r["text"] == texts[r["doc_id"]] or "[EMAIL]" in r["text"]
    left = {r["doc_id"]: r["text"] for r in rows}

    out = corpus_pipeline.run(spark, sf_dir).collect()
    n, got = check_packed(out, left, Tokenizer.from_file(tokens.vocabulary_path()), packing.CAPACITY)
    assert set(got) == clean and n == int(np.ceil(sum(got.values()) / packing.CAPACITY))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_no_rows_and_nulls(spark, tables, name):
    sf_dir = tables[0]
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, spark.createDataFrame([], schema), sf_dir).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", None, "s", 3), (3, "a b", None, "s", 3)], schema)
    rows = stage(spark, odd, sf_dir).collect()
    assert {r["doc_id"] for r in rows} <= {1, 2, 3}


def test_stages_decide_by_row(spark, tables):
    """Of rows that share a doc_id, or have none, each stands by its own text; repeated rows are near duplicates."""
    sf_dir, docs, items = tables
    stages = dict(corpus_pipeline.STAGES)
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema

    def kept(name, rows, more=()):
        frame = spark.createDataFrame([*more, *((i, t, "en", "s", len(t)) for i, t in rows)], schema)
        out = [(r["doc_id"], r["text"]) for r in stages[name](spark, frame, sf_dir).collect()]
        return sorted(((i, t) for i, t in out if i is None or i >= 5000), key=str)

    a, b, c, d = (prose(5000 + k, 100) for k in range(4))
    bad = " | ".join(a.split())
    assert kept("quality", [(5000, a), (5000, bad), (None, b), (None, bad)], docs) == sorted([(5000, a), (None, b)], key=str)
    rows = [(5007, a), (5007, a), (None, a), (None, b), (None, b), (5009, c), (5009, d)]
    assert kept("near duplicates", rows) == sorted([(5007, a), (None, b), (5009, c), (5009, d)], key=str)
    clash = spark.createDataFrame([(5000, a, "en", "s", 1)], schema).withColumn("pipeline_row", F.lit("own")).withColumn("pipeline_statistics", F.lit("own"))
    for name in ("near duplicates", "decontamination", "quality"):
        more = spark.createDataFrame(docs, schema).withColumn("pipeline_row", F.lit("own")).withColumn("pipeline_statistics", F.lit("own"))
        got = stages[name](spark, clash.unionByName(more), sf_dir)
        assert got.columns == clash.columns and {(r["pipeline_row"], r["pipeline_statistics"]) for r in got.collect()} == {("own", "own")}
    leak = f"{c} {items[0][1]}"
    assert kept("decontamination", [(5001, a), (5001, leak), (None, b), (None, leak)]) == sorted([(5001, a), (None, b)], key=str)


def test_personal_data_stage_learns_from_all_rows(spark, tables, monkeypatch):
    """Rows that share a doc_id or have none, and the many candidates of one text, all count."""
    from docsink.llm import personal_data

    own = prose(1, 30) + "".join(f" phone 555 010 {k:04d};" for k in range(300))
    docs = spark.createDataFrame([(i, own, "en", "s", len(own)) for i in (1, 1, None)], spark.read.parquet(f"{tables[0]}/documents.parquet").schema)
    models = []
    monkeypatch.setattr(personal_data.Model, "__init__", lambda self, x, y, n=None, *more, **named: models.append(len(y) if n is None else n.sum()) or setattr(self, "spans", None))
    monkeypatch.setattr(corpus_pipeline, "redact", lambda docs, model: docs)
    corpus_pipeline.private(spark, docs, tables[0])
    assert models == [3 * len(personal_data.candidates_in(own))] and models[0] >= 900


def test_personal_data_stage_fits_and_calibrates_on_all_candidates(spark, tables, monkeypatch):
    """The stage's trees learn from all of them, and all are scored, by trees of the others, for the thresholds."""
    from docsink.llm import personal_data

    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    cases = 0
    for r in docs.collect():
        for kind, start, end, base in personal_data.candidates_in(r["text"]):
            cases += 1 + (len(list(personal_data.variants(r["text"], kind, start, end))) if base else 0)
    learnt, made = [], personal_data.Trees.__init__

    def spy(self, x, y, n):
        learnt.append(int(n.sum()))
        made(self, x, y, n)

    monkeypatch.setattr(personal_data.Trees, "__init__", spy)
    monkeypatch.setattr(corpus_pipeline, "redact", lambda docs, model: docs)
    corpus_pipeline.private(spark, docs, tables[0])
    *folds, whole = learnt
    assert whole == cases > 100 and sum(cases - n for n in folds) == cases and all(0 < n < cases for n in folds)
