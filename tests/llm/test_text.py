"""Operators 4, 5, 7 and 10 against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import re
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import chat, host_rules, html_text, toxicity
from tests.conftest import SF01
from tests.llm.conftest import DOCS, docs_rows, words


# ------------------------------------------------------------------ 4: main text
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href=x>menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="content"><article><h1>Head &eacute;&amp;&nbsp;line</h1>
<p>First  paragraph with <a href=1>a link</a> and <b>bold</b>text,<br>then a break.
<p>Second paragraph &lt;here&gt; with more words than others.<ul><li>item one<li>item two</ul>
<aside>Related</aside><form>Subscribe <input></form></article>
<section id="comments"><p>A reader says a great deal, far more than the article does, on and on and on, without any end to it, to
draw the density away from the article that stands above it in the page.</p></section></div>
<div class="ad">Buy now</div><footer>&copy; site</footer></body></html>"""


def test_article_without_page_furniture():
    assert html_text.extract(PAGE) == ("Head é& line First paragraph with a link and boldtext, then a break. "
                                       "Second paragraph <here> with more words than others. item one item two")


@pytest.mark.parametrize("html,want", [(None, ""), ("", ""), ("plain &amp text &am", "plain & text &am"), ("<p>x", "x"),
                                       ("<nav>menu", ""), ("<div><p>a</p><p>b</div>", "a b"), ("<b>a</b>b <i>c</i>", "ab c"),
                                       ("<p>a</nav></b>b</p>", "ab"), ("<" * 2000, "<" * 2000)])
def test_small_and_broken_pages(html, want):
    assert html_text.extract(html) == want


def test_article_in_several_sections_is_whole():
    para = "<p>" + "words of the article that go on for a while " * 5 + "</p>"
    page = f"<body><ul><li><a href=1>one</a><li><a href=2>two</a></ul><div><div>{para * 4}</div><div>{para * 2}</div></div></body>"
    assert html_text.extract(page).count("words of the article") == 30


@pytest.mark.parametrize("html,want", [
    ('<article><p class="ad">Buy<p>text</p><p>more</p></article>', "text more"),
    ('<article><p class="ad">Buy <b>now<p>text<div>more</div></article>', "text more"),
    ('<article><ul><li class="ad">Buy<li>one<li>two</ul><p>text</article>', "one two text"),
    ('<article><p>text <span class="promo">Buy<p>more</article>', "text more"),
    ('<article><figure><p class="ad">Buy</figure><p>text</article>', "text"),
    ('<article><aside><p>a<p>b<ul><li>c<li>d</ul></aside><p>text</article>', "text"),
    ('<article><div class="ad"><p>a<p>b</div><p>text</article>', "text"),
    ('<article><table><tr><td class="ad">Buy<td>one<tr><td>two</table></article>', "one two"),
    ('<html><head><title>T</title><meta name="a"><body><article><p>text</article></body></html>', "text")])
def test_unclosed_noise_ends_where_browsers_end_it(html, want):
    assert html_text.extract(html) == want


ARTICLE = "<h1>Head</h1><p>" + "words of the text " * 20 + "</p><p>" + "more words " * 20 + "</p>"


@pytest.mark.parametrize("name", ["related-work", "notices", "share-price", "search-engines", "sponsoredStory"])
def test_an_article_is_not_dropped_by_its_name(name):
    got = html_text.extract(f'<body><article class="{name}">{ARTICLE}</article></body>')
    assert got.startswith("Head words of") and got.endswith("more words")


@pytest.mark.parametrize("comments", ['<div class="commentList"><p>{}</p></div>', '<div id="discussion"><p>{}</p></div>',
                                      '<article class="comment-body"><p>{}</p></article>', '<ul id="userComments"><li>{}</li></ul>'])
def test_reader_comments_go(comments):
    page = f'<body><article>{ARTICLE}</article>{comments.format("reader says " * 40)}</body>'
    assert "reader" not in html_text.extract(page) and html_text.extract(page).endswith("more words")


def test_density_finds_the_article_without_names():
    links = "".join(f'<li><a href="/{k}">place {k}</a></li>' for k in range(8))
    bare = f"<body><div><ul>{links}</ul></div><div>Buy this now.</div><div>{ARTICLE}</div><div>Imprint of us.</div></body>"
    assert html_text.extract(bare) == html_text.extract(f"<body><article>{ARTICLE}</article></body>")


def test_like_sections_of_an_unnamed_article_are_whole():
    page = f"<body><div><div>{ARTICLE}</div><div>{ARTICLE}</div></div></body>"
    assert html_text.extract(page) == " ".join([html_text.extract(f"<article>{ARTICLE}</article>")] * 2)


def test_driver_pages_without_semantic_tags_or_classes(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()

    def bare(page):
        return re.sub(r'\s(class|id|role)="[^"]*"', "", re.sub(r"<(/?)(nav|footer|aside|article|header|main|section)\b", r"<\1div", page))
    same = sum(html_text.extract(r.html) == html_text.extract(bare(r.html)) for r in rows)
    assert same >= 0.95 * len(rows)


def test_deep_and_long_pages():
    assert html_text.extract("<div>" * 5000 + "deep") == "deep"
    assert len(html_text.extract("<p>" + "word " * 200_000)) == 5 * 200_000 - 1


def test_pages_query_keeps_every_row(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (3, "v", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.main_text(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == sorted([(0, 0), (1, len(html_text.extract(PAGE))), (1, len(html_text.extract(PAGE))), (3, 0)])
    assert html_text.main_text(df.limit(0)).count() == 0


def test_driver_pages_give_their_articles(spark):
    import html as H
    import re
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = re.sub(r"</?\w+>", "", re.sub(r"<(?:/?p|/?h1|br)>", " ", article))
        assert html_text.extract(r.html) == " ".join(H.unescape(blocks).split())


# ------------------------------------------------------------------ 5: toxicity
def labelled(n, seed, toxic=("vilest", "grumble", "stinko")):
    rng, out = random.Random(seed), []
    for i in range(n):
        w = [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(rng.randrange(20, 200))]
        bad = i % 4 == 0
        for _ in range(rng.randrange(1, 4) if bad else 0):
            w[rng.randrange(len(w))] = rng.choice(toxic) + rng.choice(["", "s", "ly", "est", ","])
        out.append((" ".join(w), int(bad)))
    return out


def test_held_out_accuracy_with_word_stems():
    model = toxicity.train(*zip(*[(t.encode(), y) for t, y in labelled(600, 1)]))
    rows = labelled(300, 2)
    pooled, counts = toxicity.Scorer(model).pooled([t.encode() for t, _ in rows])
    s = model.score(model.probability(pooled), toxicity._language(counts))
    assert ((s >= 0.5) == np.array([y for _, y in rows])).mean() > 0.97


def test_training_gradient_moves_scores():
    rows = labelled(80, 3)
    a = toxicity.train([t.encode() for t, _ in rows], [y for _, y in rows], epochs=1)
    b = toxicity.train([t.encode() for t, _ in rows], [y for _, y in rows], epochs=8)
    loss = []
    for m in (a, b):
        p = m.probability(toxicity.Scorer(m).pooled([t.encode() for t, _ in rows])[0])
        loss.append(-np.mean([np.log(q if y else 1 - q) for q, (_, y) in zip(p, rows)]))
    assert loss[1] < loss[0]


def test_filters_pool_over_the_whole_text():
    """Scorer responses equal a plain convolution over padded word embeddings."""
    model = toxicity.train(*zip(*[(t.encode(), y) for t, y in labelled(60, 4)]))
    texts = [b"one", b"", b"one two three four five", b"x " * 5000 + b"stinko"]
    pooled, _ = toxicity.Scorer(model).pooled(texts)
    for t, got in zip(texts, pooled):
        e = model.emb[toxicity.features(t.split())].sum(axis=1) if t else np.zeros((1, toxicity.DIM))
        e = np.concatenate([e, np.zeros((2, toxicity.DIM))])
        want = np.concatenate([sum(e[j:len(e) - 2 + j] @ model.filters[w][j] for j in range(w)).max(axis=0) + model.bias[w] for w in toxicity.FILTERS])
        assert np.allclose(got, want, atol=1e-4)


def test_scoring_in_slices_equals_whole_texts_in_bounded_memory(monkeypatch):
    import tracemalloc

    rng = random.Random(9)
    model = toxicity.train(*zip(*[(t.encode(), y) for t, y in labelled(60, 4)]))
    texts = [b" ".join(b"%c%d" % (97 + rng.randrange(8), rng.randrange(3000)) for _ in range(rng.choice([0, 1, 5, 20_000]))) for _ in range(120)]
    texts += [b"one", b"", b" \n ", b"y" * 600_000, b"a b " * 200_000 + b"stinko"]
    scorer = toxicity.Scorer(model)
    tracemalloc.start()
    sliced, counts = scorer.pooled(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # 2.5 million words
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 1 << 40)
    monkeypatch.setattr(toxicity, "SEGMENT_BYTES", 1 << 40)
    whole, same = toxicity.Scorer(model).pooled(texts)
    assert np.allclose(sliced, whole, atol=1e-5) and (counts == same).all()
    monkeypatch.setattr(toxicity, "SEGMENT_BYTES", 3)
    tiny, same = toxicity.Scorer(model).pooled(texts[:9])
    assert np.allclose(tiny, whole[:9], atol=1e-5) and (counts[:9] == same).all()


def test_classify_uses_no_test_fold_label_and_keeps_rows(spark, awkward):
    rows = [(k, t) for k, (t, _) in enumerate(labelled(200, 5))]
    labels = [(k, y if zlib.crc32(str(k).encode()) % 5 else 1 - y, 0) for k, (_, y) in enumerate(labelled(200, 5))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    lab = spark.createDataFrame(labels + labels[:5] + [(None, 1, 0), (7, None, 0)], "doc_id long, toxic int, quality int")
    flipped = spark.createDataFrame([(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y, q) for i, y, q in labels], lab.schema)
    a, b = (sorted(map(tuple, toxicity.classify(docs, x).collect())) for x in (lab, flipped))
    assert a == b and len(a) == 200 and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in a)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in a)
    model = toxicity.fit(docs, lab)
    kept = toxicity.keep_clean(awkward, model)
    assert kept.schema == awkward.schema and kept.count() == len(docs_rows())
    assert toxicity.score(awkward, model).count() == len(docs_rows())


def test_every_labelled_row_and_whole_long_texts_train(spark):
    """Nothing is drawn (before: the least id hashes of each class, texts up to 20,000 characters)."""
    rows = [(k, t, y) for k, (t, y) in enumerate(labelled(400, 6))] + [(900, "a3 " * 9000 + "longtail", 1), (901, None, 0)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], DOCS)
    lab = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = toxicity._labelled(docs, lab, "doc_id", "text", "toxic").collect()
    assert sorted((r.doc_id, r.y, bytes(r.text)) for r in got) == sorted((i, y, (t or "").encode()) for i, t, y in rows)
    seen = toxicity._count_buckets([pa.RecordBatch.from_pydict({"y": [y for _, _, y in rows], "text": [(t or "").encode() for _, t, _ in rows]})])
    counts = {(r["y"], r["key"]): r["n"] for r in next(seen).to_pylist()}
    assert counts[0, -1] + counts[1, -1] == len(rows) and counts[1, int(toxicity.features([b"longtail"])[0, 0])] == 1
    # parts of 40 rows: each row in one of the rounds, the same model for any layout, and a good one
    a = toxicity.fit(docs, lab, part=40)
    b = toxicity.fit(docs.repartition(11), lab.repartition(3), part=40)
    assert np.array_equal(a.emb, b.emb) and np.array_equal(a.out, b.out) and a.thresholds == b.thresholds
    fresh = labelled(300, 12)
    pooled, counts = toxicity.Scorer(a).pooled([t.encode() for t, _ in fresh])
    s = a.score(a.probability(pooled), toxicity._language(counts))
    assert ((s >= 0.5) == np.array([y for _, y in fresh])).mean() > 0.95


def test_a_step_of_segments_equals_a_step_of_whole_texts(monkeypatch):
    rows = labelled(64, 8)
    state = toxicity.start_state(np.zeros((2, toxicity.BUCKETS)), (1, 1))
    moved = []
    for size in (1 << 18, 50):
        monkeypatch.setattr(toxicity, "SEGMENT_BYTES", size)
        trainer = toxicity.Trainer(state, (1.0, 1.0))
        for t, y in rows:
            trainer.add(t.encode(), y)
        moved.append(trainer.state)
    assert not np.array_equal(moved[0], state) and np.allclose(*moved, atol=1e-4)


def test_a_step_of_word_slices_equals_a_step_of_whole_texts(monkeypatch):
    rows = [*labelled(20, 8), ("", 0), ("one", 1), ("a b", 0), (" ".join(f"w{k}" for k in range(70_000)), 1)]
    state = toxicity.start_state(np.zeros((2, toxicity.BUCKETS)), (1, 1))
    moved = []
    for size in (1 << 40, 7):
        monkeypatch.setattr(toxicity, "SLICE_WORDS", size)
        trainer = toxicity.Trainer(state, (1.0, 1.0))
        for t, y in rows[:-1]:
            trainer.add(t.encode(), y)
        trainer.step()
        moved.append(trainer.state)
    assert not np.array_equal(moved[0], state) and np.allclose(*moved, atol=1e-4)
    for t, _ in rows:  # stored words read back: the places take 1, 2 or 4 bytes
        keys, at = toxicity._stored(*(x.tobytes() for x in toxicity.Features().encode(t.encode())))
        want = toxicity.features(t.encode().split()) if t else np.zeros((1, 1 + len(toxicity.HEADS)), int)
        assert np.array_equal(toxicity._buckets(keys)[at], want)


def test_rows_of_a_large_table_train_in_every_epoch(spark, monkeypatch):
    """Before: a table of more than a part's rows went through once, a small one EPOCHS times."""
    rounds, one = [], toxicity._round
    monkeypatch.setattr(toxicity, "_round", lambda state, weights: rounds.append(state) or one(state, weights))
    rows = [(k, t, y) for k, (t, y) in enumerate(labelled(300, 6))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], DOCS)
    lab = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    shares = toxicity._labelled(docs, lab, "doc_id", "text", "toxic", 40).filter("hold = 0").select("share").distinct().count()
    toxicity.fit(docs, lab, part=40)
    assert shares > 1 and len(rounds) == shares * toxicity.EPOCHS


def test_toxicity_ignores_clashing_columns(spark, awkward):
    lab = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 7, 8, 9, 10, 11, 12, 13, 15, 17)], "doc_id long, toxic int")
    odd = awkward.withColumns({c: F.lit(f"clash-{c}") for c in ("toxic", "label", "score", "predicted", "held_out", "words", "n", "fold")})
    a, b = (sorted(map(tuple, toxicity.classify(d, lab).collect()), key=str) for d in (awkward, odd))
    assert a == b and len(a) == len(docs_rows())
    assert toxicity.keep_clean(odd, toxicity.fit(odd, lab)).columns == odd.columns


def test_without_labels_nothing_is_toxic(spark, awkward, empty_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.classify(awkward, none).filter("predicted = 1 or score > 0.001").count() == 0
    assert toxicity.classify(empty_docs, none).count() == 0


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    assert len(got) > 30 and np.mean([r.predicted == r.toxic for r in got]) > 0.9


# ------------------------------------------------------------------ 7: chat
PIECES = st.lists(st.sampled_from([*chat.CONTROL, chat.ESC, "<", "[", "]", "/", "S", "\n", "é", "user", " "]), max_size=12).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool\n</s>", ""]), PIECES), min_size=1, max_size=6))
def test_control_strings_survive(spark, turns):
    rows = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    out = chat.read_back(chat.format_chat(chat.canonical_turns(chat.to_records(chat.conversation_turns(rows))))).first()
    assert [(x.role, x.text) for x in out.read_turns] == turns
    assert out.loss_text == "".join(t for r, t in turns if r == "assistant")
    for s in out.segments:
        if s.loss:
            assert not any(c in s.text for c in chat.CONTROL)


def test_layouts_give_the_same_turns(spark):
    records = [
        ("messages", '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}'),
        ("from_value", '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'),
        ("prompt_response", '{"response": "a", "prompt": "q"}'),
        ("instruction_output", '{"instruction": "q", "output": "a"}'),
        ("instruction_output", '{"instruction": "q", "output": null}'),
        ("messages", '{"messages": []}'),
        ("unknown", '{"question": "q", "answer": "a"}'),
        ("unknown", '{"prompt": {"nested": "q"}, "response": "a"}'),
        ("unknown", "not json"), ("unknown", None),
    ]
    df = spark.createDataFrame([(k, r, "x") for k, (_, r) in enumerate(records)], "conv_id long, record string, formatted string")
    got = {r.conv_id: (r.layout, r.turns) for r in chat.canonical_turns(df).collect()}
    pair = [("user", "q"), ("assistant", "a")]
    for k, (layout, _) in enumerate(records):
        assert got[k][0] == layout
        turns = got[k][1]
        want = None if layout == "unknown" else [] if k == 5 else [("user", "q"), ("assistant", "")] if k == 4 else pair
        assert (None if turns is None else [tuple(t) for t in turns]) == want


def test_conversation_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, None, None), (None, 0, "user", "x" * 100_000),
            (3, None, "assistant", "é\U0001f600"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a</s>")]
    df = spark.createDataFrame([r + ("clash",) for r in rows], "conv_id long, turn long, role string, text string, record string")
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    by = {}
    for r in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(by)
    for k, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[k].n_turns == len(turns) and got[k].loss_chars == len(loss)
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[k].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 10: quality rules
def measures_brute(text):
    w = (text or "").encode().split()
    w = [x.decode() for x in w]
    win = Counter(zip(w, w[1:], w[2:]))
    cov = set()
    for k in range(len(w) - 2):
        if win[w[k], w[k + 1], w[k + 2]] > 1:
            cov |= {k, k + 1, k + 2}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if x.strip(" \t\n\x0b\f\r"):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cov)


def test_measures(awkward, clashing):
    want = sorted(((i, *measures_brute(t)) for i, t, *_ in docs_rows()), key=str)
    for df in (awkward, clashing):
        got = host_rules.apply_host_rules(df).select("doc_id", *host_rules.MEASURES).collect()
        assert sorted(map(tuple, got), key=str) == want


@given(st.lists(st.sampled_from(["a", "b", "c", "a b c", "\n", "a\n"]), max_size=40).map(" ".join))
def test_any_measures(text):
    assert host_rules.measure(text.encode()) == measures_brute(text)


def test_host_verdicts(spark):
    good, junk = words(80), "short"
    rows = [(i, junk, "en", "bad", 0) for i in range(95)] + [(95 + i, good, "en", "bad", 0) for i in range(5)]
    rows += [(1000 + i, good if i % 10 else junk, "en", f"h{i % 20}", 0) for i in range(400)]
    rows += [(5000, junk, "en", "tiny", 0), (5001, good, "en", None, 0)]  # one failure does not condemn a host
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in host_rules.apply_host_rules(df).collect()}
    assert not any(got[i].kept for i in range(100)) and got[99].host_rejected and not got[99].base_failed
    assert all(got[1000 + i].kept == bool(i % 10) for i in range(400))
    assert not got[5000].host_rejected and got[5001].kept
    rates = {r.host: (r.n, r.x, r.rate) for r in host_rules.host_rates(host_rules.document_measures(df)).collect()}
    n, x = (sum(v[k] for v in rates.values()) for k in (0, 1))
    m = x / n
    v = sum(a * (b / a - m) ** 2 for a, b, _ in rates.values()) / n - m * (1 - m) * len(rates) / n
    k = max(1.0, m * (1 - m) / v - 1) if v > 0 else n
    assert all(abs(r - (b + m * k) / (a + k)) < 1e-9 for a, b, r in rates.values())


def test_a_hot_host_is_dealt_over_tasks(spark):
    """One rejected host with nearly all rows: every row has its verdict, no task most of the rows."""
    docs = spark.createDataFrame([(i if i % 3 else None, "a b c", "en", "hot", 5) for i in range(600)]
                                 + [(1000 + i, words(60, i), "en", f"h{i}", 5) for i in range(30)], DOCS)
    table = host_rules.document_measures(docs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = host_rules._verdicts(table, 0.8)
        assert "salt" not in got.columns
        rows = got.select("host", "host_rejected").collect()
        assert len(rows) == 630 and all((r.host == "hot") == bool(r.host_rejected) for r in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    ids = docs.filter("source = 'hot'").select("doc_id", F.lit(3).alias("n_words"), F.lit(3).alias("word_chars"))
    sizes = [r["count"] for r in ids.filter("doc_id IS NOT NULL").groupBy(
        F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(host_rules.SALTS))).count().collect()]
    assert len(sizes) == host_rules.SALTS and max(sizes) < 60


def test_host_rules_on_an_empty_table(empty_docs):
    assert host_rules.apply_host_rules(empty_docs).count() == 0


def test_texts_longer_than_a_json_string_may_be(spark):
    """21,000,000 characters in one turn, beside texts that look like references."""
    rows = spark.sql(f"""SELECT * FROM VALUES (1L, 0L, 'user', 'q <s>'), (2L, 0L, 'user', '{chat.REF}0'), (2L, 1L, 'tool', '{chat.REF}'), (2L, 2L, 'assistant', 'a')
                         AS t(conv_id, turn, role, text) UNION ALL SELECT 1L, 1L, 'assistant', concat('</s>', repeat('x', 20999996))""")
    got = {r.conv_id: r for r in chat.format_conversations(rows).collect()}
    long = "</s>" + "x" * 20_999_996
    assert got[1].n_turns == 2 and got[1].loss_chars == 21_000_000 and got[1].formatted_chars == 3 + 7 + 4 + 1 + 6 + 8 + 21_000_001 + 4
    assert got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(("user\nq <s>\nassistant\n" + long + "\n").encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(f"user\n{chat.REF}0\ntool\n{chat.REF}\nassistant\na\n".encode()).hexdigest()
