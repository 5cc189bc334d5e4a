import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cabmill.llm import html_extract, recurrent_lm, toxicity
from cabmill.llm.html_blocks import blocks


# Toxicity


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = toxicity.fit_trees(x[:2000], y[:2000], np.ones(2000))
    raw = trees.raw(x[2000:])
    assert ((raw > 0) == y[2000:]).mean() > 0.97
    at, mean = toxicity.fit_isotonic(raw, y[2000:], np.ones(1000))
    assert (np.diff(at) >= 0).all() and (np.diff(mean) >= 0).all()


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


def toxic_corpus(n=900):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(20, 80))]
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words[rng.randrange(len(words))] = rng.choice(["zork", "quiblet", "xylok", "vexabor", "vexabin"])
        docs.append((i, " ".join(words), "x"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus()
    frame = spark.createDataFrame([*docs, (None, None, "x"), (5000, "", "x"), docs[0]], "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (0, 1, 0), (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(frame, marks).collect()
    assert len(got) == len(docs) + 3
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert held and all(fold(r.doc_id) == 1 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_toxicity_never_learns_from_held_out_labels(spark):
    docs, labels = toxic_corpus(300)
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    other = [(i, q, 1 - t if fold(i) == 1 else t) for i, q, t in labels]
    scores = [
        sorted(tuple(r) for r in toxicity.toxicity_scores(frame, spark.createDataFrame(m, "doc_id long, quality int, toxic int")).collect())
        for m in (labels, other)
    ]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("marks", [[], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_toxicity_without_both_classes(spark, marks):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    m = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(frame, m).collect()
    assert len(got) == 2 and len({r.score for r in got}) == 1
    assert toxicity.toxicity_scores(frame.limit(0), m).count() == 0


# Language model


def lm_corpus():
    rng = random.Random(2)
    north = ["fjord", "is", "snow", "elg", "ski", "Is", "frost"]
    south = ["sol", "mar", "vino", "luz", "olivo", "MAR", "playa"]
    rows = []
    for i in range(400):
        words = [rng.choice(north if i % 2 else south) for _ in range(rng.randint(1, 60))]
        words += [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(0, 4))]
        rows.append((i, " ".join(words) + ("\n" if i % 3 else ""), "x"))
    return rows + [(1000, "", "x"), (1001, None, "x"), (None, "is snow", "x"), (7, rows[7][1], "x"), (1002, "mar " * 5000, "x")]


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "TABLE", 12)  # so that common words are counted by the join too
    rows = lm_corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = recurrent_lm.score_documents(frame).collect()
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, _ in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
        want[i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score <= 0 for r in got)
    assert recurrent_lm.score_documents(frame.limit(0)).count() == 0


def test_class_shares_sum_to_one():
    v = recurrent_lm.Vocabulary(np.array([1, 2, 3]), np.array([5, 4, 3]), np.array([0, 1, 2]), 20, 7, 8, 4, 0.4)
    assert v.totals().sum() == 20
    assert math.isclose(v.discount * 4 / 8 + sum((c - v.discount) / 8 for c in (1, 2, 2, 3)), 1)


def test_gru_gradients():
    rng = np.random.default_rng(3)
    model = recurrent_lm.Gru.new(7, np.full(7, 1 / 7))
    before, target = rng.integers(0, 8, (5, 3)), rng.integers(0, 7, (5, 3))
    h = rng.normal(size=(3, recurrent_lm.HIDDEN))
    _, grads, _ = model.window(before, target, h)
    for p, g in zip(model.parameters, grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 1e-5
        up = model.window(before, target, h)[0]
        p[at] -= 2e-5
        down = model.window(before, target, h)[0]
        p[at] += 1e-5
        assert math.isclose((up - down) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-7)


def test_state_is_carried_across_windows():
    rng = np.random.default_rng(4)
    model = recurrent_lm.Gru.new(9, np.full(9, 1 / 9))
    docs = [rng.integers(0, 9, n) for n in (1, 31, 32, 33, 200, 5)]
    table = model.inputs()
    for doc, got in zip(docs, recurrent_lm.class_scores(model, docs), strict=True):
        h, last, total = np.zeros((1, recurrent_lm.HIDDEN)), 9, 0.0
        for c in doc:
            h, _ = model.step(table[[last]], h)
            total += model.log_outcomes(h)[0, c]
            last = c
        assert math.isclose(got, total, rel_tol=1e-4)


@pytest.mark.parametrize("outcomes", [1, 2, 7, 9, 177])
def test_two_softmaxes_make_one_distribution(outcomes):
    rng = np.random.default_rng(outcomes)
    model = recurrent_lm.Gru.new(outcomes, rng.random(outcomes) + 0.1)
    states = rng.normal(size=(outcomes * 3, recurrent_lm.HIDDEN))
    whole = model.log_outcomes(states)
    assert whole.shape == (len(states), outcomes) and np.allclose(np.exp(whole).sum(1), 1)
    target = np.arange(len(states)) % outcomes
    assert np.allclose(model.output(states, target), whole[np.arange(len(states)), target])
    again = recurrent_lm.unpacked(recurrent_lm.packed(model), outcomes)
    assert np.allclose(again.log_outcomes(states), whole)


def test_a_documents_score_by_hand(spark, monkeypatch):
    """One held-out document's score, from counts and a plain forward pass of the fitted network."""
    kept = {}
    fit, vocabulary = recurrent_lm.fit_gru, recurrent_lm._vocabulary
    monkeypatch.setattr(recurrent_lm, "fit_gru", lambda *a: kept.setdefault("model", fit(*a)))
    monkeypatch.setattr(recurrent_lm, "_vocabulary", lambda *a: kept.setdefault("words", vocabulary(*a)))
    rows = [(i, f"the cat {'sat' if i % 3 else 'ran'} on x{i} v{i % 150}ed mats{i % 7}ing") for i in range(700)]
    held = next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1)
    rows[held] = (held, "The cat sat on neverseen x3 mats2ing ran " + " ".join(f"v{i}ed" for i in range(0, 150, 9)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = next(r.score for r in recurrent_lm.score_documents(frame).collect() if r.doc_id == held)
    model, words = kept["model"], kept["words"]
    train = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in [*t.lower().split(), None])
    (hashes, endings), = recurrent_lm.word_hashes([rows[held][1].encode()])
    cls, _ = words.look_up(np.append(hashes, recurrent_lm.END), np.append(endings, 0))
    every = {w: recurrent_lm.word_hashes([w.encode()]) for w in train if w}
    of = {None: words.look_up(np.array([recurrent_lm.END]), np.array([0]))[0][0]}
    of |= {w: words.look_up(*next(iter(x)))[0][0] for w, x in every.items()}
    last = recurrent_lm.OWN + recurrent_lm.ENDINGS
    sums = Counter()
    for w, n in train.items():
        sums[of[w]] += n
    rare = [w for w in train if of[w] == last]
    total, h, before = 0.0, np.zeros((1, recurrent_lm.HIDDEN)), len(model.embed) - 1
    for word, c in zip([*rows[held][1].lower().split(), None], cls.tolist(), strict=True):
        x = model.embed[before] @ model.wx[:-1] + model.wx[-1]
        s, H = h[0] @ model.wh, recurrent_lm.HIDDEN
        r, z = (1 / (1 + np.exp(-(x[k * H : (k + 1) * H] + s[k * H : (k + 1) * H]))) for k in range(2))
        n = np.tanh(x[2 * H :] + r * s[2 * H :])
        h, before = ((1 - z) * n + z * h[0])[None], c
        size = model.wm.shape[2]
        first = h[0] @ model.wc[:-1] + model.wc[-1]
        second = (h[0] @ model.wm[c // size, :-1] + model.wm[c // size, -1])[: len(model.embed) - 1 - c // size * size]
        p = np.exp(first[c // size]) / np.exp(first).sum() * np.exp(second[c % size]) / np.exp(second).sum()
        if c != last:
            share = train[word] / sums[c]
        elif word in train:
            share = (train[word] - words.discount) / sums[last]
        else:
            share = words.discount * len(rare) / sums[last]
        total += math.log10(p) + math.log10(share)
    assert math.isclose(got, total, rel_tol=1e-4)


def test_network_learns_from_all_documents(spark):
    """One very long text that comes first is not the whole training set."""
    rows = [(2, "a b " * 350_000), *((i, "c d e f g " * 100) for i in range(10, 1510))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert zlib.crc32(b"2") % 5 != 1
    held = [r for r in recurrent_lm.score_documents(frame).collect() if r.held_out]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -0.2


def test_task_learns_every_token():
    rng = np.random.default_rng(6)
    model = recurrent_lm.Gru.new(7, np.full(7, 1 / 7))
    fitting = recurrent_lm.Fitting(recurrent_lm.packed(model), 7, 0.01)
    seen, window = [], fitting.model.window
    fitting.model.window = lambda b, t, h, inside: (seen.extend(zip(b[inside], t[inside], strict=True)), window(b, t, h, inside))[1]
    docs = [rng.integers(0, 7, n) for n in (1, 700, 33, 5, 1000)]
    fitting.learn(docs)
    pairs = [p for d in docs for p in zip(np.append(7, d[:-1]), d, strict=True)]
    assert Counter(seen) == Counter(pairs) and fitting.tokens == len(pairs)


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="x">
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></ul></nav><!-- ad <p>no</p> -->
<div class="ad">Buy this now.</div><article><h1>A &amp; B&nbsp;title</h1><p>First <b>bold</b>part&#33;<br>next
line.<p>Second one with more words, and a comma.</p><script>var x = "<p>no</p>";</script></article>
<footer>&copy; example.com</footer></body>"""


def test_blocks():
    assert [b.text for b in blocks(PAGE)] == [
        "Home", "About", "Buy this now.", "A & B title", "First boldpart! next line.",
        "Second one with more words, and a comma.", "© example.com",
    ]
    assert blocks(PAGE)[0].path == ("html", "body x", "nav", "ul", "li", "a") or blocks(PAGE)[0].path[-1] == "li"
    assert blocks("") == [] and [b.text for b in blocks("</p>just <text")] == ["just <text"]
    assert [b.text for b in blocks("a<![CDATA[<b>]]>c<div>" * 2)] == ["a<b>c", "a<b>c"]


@pytest.mark.parametrize("raw", [
    "<script>for(var i=0;i<n;i++){f(i)}</script>", "<script>var s='<!-- x';</script >", "<STYLE>a>b{}/*<p*/</style>",
    "<textarea><a title='</textarea>", "<noscript><img alt='it's></noscript>", "<iframe><!-- </iframe>",
    "<head><title>a <!-- b</title><script>if(a<b)c('</p>')</script></head>",
])
def test_raw_text_ends_with_its_own_tag(raw):
    page = f"{raw}<article><p>One.</p>{raw}<p>Two <script>i<n</script>words.</p></article>{raw}"
    assert [b.text for b in blocks(page)] == ["One.", "Two", "words."]
    assert [b.text for b in blocks("<head><title>no end<body><p>One.</p>")] == ["One."]


def test_every_name_counts():
    page = "<div class='mt-8 pt-6 border-t border-gray-200 flex flex-col gap-4 w-full max-w-3xl mt-8' id=comments><p>x</p></div>"
    names = blocks(page)[0].path[0].split()
    assert names[0] == "div" and names[-1] == "comments" and len(names) == len(set(names))


def test_lstm_gradients(monkeypatch):
    rng = np.random.default_rng(5)
    model = html_extract.Labeller.new()
    x, mask = rng.normal(size=(4, 3, html_extract.INPUT)), np.ones((4, 3), bool)
    mask[2:, 1] = False
    y = rng.integers(0, 2, (4, 3)).astype(float)

    def loss():
        p = 1 / (1 + np.exp(-model.logits(x, mask)))
        each = -(y * np.log(p) + (1 - y) * np.log(1 - p))
        return each[mask].mean()

    grads, d_out = model.gradients(x, mask, y)
    for p, g in zip([*model.w, model.out], [*grads, d_out], strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert math.isclose((up - down) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-7)


def test_pages_of_other_layouts(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labeller = html_extract.fit(pages)
    text = "Stone bridges cross the river here, and the town grew around them. It is old."
    page = (
        "<body><header class='site-header'><div class='menu'><a href='/'>Home</a> <a href='/n'>News</a></div></header>"
        "<div class='cookie-notice'><p>We use cookies.</p><button>Accept</button></div>"
        f"<main><div class='post-content'><h1>Bridges</h1><p>{text}</p><p>{text}</p><div class='ad'>Buy now</div><p>{text}</p></div></main>"
        "<aside class='sidebar'><h3>Related</h3><ul><li><a href='/x'>Other story</a></li></ul></aside>"
        f"<section class='comments'><h3>Comments</h3><div class='comment'><p>{text}</p></div></section>"
        "<form class='newsletter'><label>Your mail</label><input></form><footer><p>Copyright</p></footer></body>"
    )
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x"), (1, "u", page, "x"), (4, "u", "<p", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract_pages(frame, labeller).collect()
    assert len(got) == 5
    want = f"Bridges {text} {text} {text}"
    assert [(r.text, r.n_chars) for r in got if r.page_id == 1] == [(want, len(want))] * 2
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (2, None))
    assert html_extract.fit(pages.limit(0)) is None
    assert html_extract.extract_pages(frame.limit(0), None).count() == 0


def article_page(i, paragraphs=3, words=30):
    body = "".join(f"<p>{' '.join(f'w{i}x{j}y{k}' for k in range(words))}.</p>" for j in range(paragraphs))
    return f"<html><body><nav><a href='/'>Home</a></nav><article><h1>T{i}</h1>{body}</article><footer>f</footer></body></html>"


@pytest.mark.parametrize("kind", ["long", "null ids", "few ids", "one long among empty"])
def test_every_table_with_a_block_gives_texts(spark, kind):
    pages = {
        "long": lambda: [(i, article_page(i, 700, 40)) for i in range(4)],
        "null ids": lambda: [(None, article_page(i)) for i in range(30)],
        "few ids": lambda: [(i % 3, article_page(i % 3)) for i in range(900)],
        "one long among empty": lambda: [(i, f"<p></p><!--{i}-->") for i in range(700)] + [(9, article_page(1))],
    }[kind]()
    if kind == "long":
        assert min(len(h) for _, h in pages) > 200_000
    frame = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")
    labeller = html_extract.fit(frame, made=40)
    assert labeller is not None
    got = html_extract.extract_pages(frame, labeller).collect()
    assert len(got) == len(pages) and sum(r.n_chars > 0 for r in got) == sum("<article>" in h for _, h in pages)


def test_windows_carry_both_states():
    rng = np.random.default_rng(3)
    model, vectors = html_extract.Labeller.new(), html_extract.Vectors()
    found = blocks("".join(f"<div class='c{rng.integers(9)}'>{'word ' * int(rng.integers(1, 20))}</div>" for _ in range(57)))
    whole = model.logits(*html_extract._padded([vectors.page(found)]))[:, 0]
    for window in (1, 7, 56, 57, 100):
        assert np.allclose(model.logits_of_long(vectors, found, window), whole)


def test_a_page_of_very_many_blocks(spark):
    paragraph = "<p>Stone bridges cross the river here, and the town grew around them.</p>"
    page = f"<html><body><nav><a href='/'>Home</a></nav><article>{paragraph * 60_000}</article></body></html>"
    frame = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    text = html_extract.extract_pages(frame, html_extract.fit(frame, made=60)).first().text
    assert text.count("Stone bridges") == 60_000


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.op1_html_extract(spark, sf_dir).collect()}
    wrong = 0
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        wrong += " ".join(b.text for b in blocks(article)) != got[r.page_id]
    assert wrong <= 0.02 * len(got)


def test_words_are_found_by_slot_or_by_search():
    rng = np.random.default_rng(8)
    # Most words share their last bits, so that only one of them has the slot.
    hashes = np.unique(np.concatenate([rng.integers(0, 1 << 40, 60) << 20, rng.integers(0, 1 << 60, 60), [-1]]))
    counts, endings = rng.integers(3, 99, len(hashes)), rng.integers(0, 900, len(hashes))
    v = recurrent_lm.Vocabulary(hashes, counts, endings, 9_999, 500, 99, 40, 0.5)
    asked = rng.permutation(np.concatenate([hashes, hashes, rng.integers(0, 1 << 60, 50), [5, 1 << 20]]))
    of = dict(zip(hashes.tolist(), counts.tolist(), strict=True))
    cls, got = v.look_up(asked, np.zeros(len(asked), np.int64))
    assert got.tolist() == [of.get(w, -1) for w in asked.tolist()]
    last = recurrent_lm.OWN + recurrent_lm.ENDINGS
    assert [c == last for c in cls.tolist()] == [w not in of for w in asked.tolist()]
    assert recurrent_lm.class_scores(recurrent_lm.Gru.new(7, np.full(7, 1 / 7)), []).tolist() == []


def test_scoring_keeps_no_step_for_gradients():
    rng = np.random.default_rng(4)
    model = recurrent_lm.Gru.new(7, np.full(7, 1 / 7))
    before, h = rng.integers(0, 8, (5, 3)), rng.normal(size=(3, recurrent_lm.HIDDEN))
    states, sums, n = model.run(before, h)
    assert states.shape == (5, 3, recurrent_lm.HIDDEN) and sums.shape[1] == len(n) == 1
    kept, sums, n = model.run(before, h, keep=True)
    assert np.array_equal(states, kept) and sums.shape[1] == len(n) == 5
    for t in range(5):
        h, _ = model.step(model.inputs()[before[t]], h)
        assert np.allclose(h, states[t])
