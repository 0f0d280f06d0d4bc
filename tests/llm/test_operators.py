"""Each corpus operator against a brute-force version, on whole small tables with edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import (backoff, catalog as corpus, chat, decontaminate, extraction, language, neardup, packing,
                            quality, repeats, sharding)
from basketlens.llm.kernels import Powers, chunked

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode("utf-8", "surrogatepass"))


def crc(i, by):
    return zlib.crc32(str(i).encode()) % by


def test_language_held_out_accuracy_and_undetermined(edge_docs, rows):
    got = language.identify(edge_docs, rows_per_language=200).collect()
    assert len(got) == len(rows)
    lang = {r["doc_id"]: r["lang"] for r in rows}
    learned = {r["lang"] for r in rows if r["lang"] and r["doc_id"] and crc(r["doc_id"], 3) != 1}
    right = n = 0
    for r in got:
        assert r.held_out == (r.doc_id is not None and crc(r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in learned | {"und"}
        if r.doc_id is not None and r.doc_id < 9000 and r.held_out:
            n += 1
            right += r.lang_pred == lang[r.doc_id]
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {9001, 9002, 9003, 9004}
    assert right >= 0.95 * n


def test_language_without_labels(edge_docs, no_docs):
    assert {r.lang_pred for r in language.identify(edge_docs.withColumn("lang", F.lit(None))).collect()} == {"und"}
    assert language.identify(no_docs).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li>Home</li></ul></nav><!-- x --><div class="site-notice">We use cookies</div>
<article><h1>Head &amp;  line</h1><p class=ad>buy<p>One <b>two.<br>three</p><div class="comments"><p>me too</p></div>
<ul><li>caf&eacute;<li>&#233;</ul></article><aside>more</aside><footer>&copy; x</footer></body></html>"""


def test_extraction_by_markup(spark):
    df = spark.createDataFrame([(1, "http://a.b/c", PAGE), (2, None, None), (None, "http://a.b", ""), (3, "x", "plain  text")],
                               "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r for r in extraction.main_text(df).collect()}
    assert got[1].text == "Head & line\n\nOne two. three\n\ncafé\n\né" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[None].text == "" and got[3].text == "plain text"
    assert extraction.main_text(df.limit(0)).count() == 0


def test_extraction_keeps_the_article_whatever_wraps_it(spark):
    wrap = lambda cls, inner: f"<body><div class='{cls}'><p>outer words</p>{inner}</div></body>"
    article = "<article><p>the article</p><div class='share-bar'>share</div></article>"
    main = "<main><p>the main part</p></main>"
    cases = [(wrap("has-sidebar", article), "the article"), (wrap("search-page", article), "the article"),
             (wrap("site no-ads page-search", article), "the article"), (wrap("sidebar", main), "the main part"),
             (wrap("comments", "<article><p>a reader</p></article>") + article, "the article"),
             (wrap("wide", "<nav><main>menu</main></nav>" + article), "the article"),
             (article + article.replace("the article", "the second"), "the article\n\nthe second")]
    df = spark.createDataFrame([(k // 2, f"http://h/{k}", page) for k, (page, _) in enumerate(cases)],
                               "page_id bigint, url string, html string")  # page ids repeat
    got = {r.url: r.text for r in extraction.main_text(df).collect()}
    assert got == {f"http://h/{k}": text for k, (_, text) in enumerate(cases)}


@pytest.mark.parametrize("part", ["a <b ", '<a title="x> ', "<a title='x>\" ", "<!", "<!--", "<div>", "</x>", "<b><p>", "<script ",
                                  "</script ", "<script>a</script ", "&amp", '<x class=" id=', "<p class='ad'>t"])
def test_extraction_time_is_linear_in_a_malformed_page(part):
    import time
    def took(n):
        page = "<article>begin</article>" + part * (n // len(part)) + ">end"
        began = time.process_time()
        assert extraction.page_blocks(page)[0] == ("begin", True, False)
        return time.process_time() - began
    took(20_000)
    assert took(1_000_000) < 12  # a quadratic scan takes many minutes


def test_extraction_by_host_suffixes(spark):
    menu = "home news sport weather travel money people contact imprint "
    page = lambda body: f"<body><p>{menu}</p><p>{body} {menu}tail{len(body)}</p></body>"
    data = [(1, "http://h/1", page("first body words")), (2, "http://h/2", page("second body has other terms")),
            (3, "http://h/2b", page("second body has other terms")), (4, "http://other/", page("lonely")), (5, "http://h/5", None)]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extraction.main_text(df, run=5).collect()}
    assert got[1] == "first body words tail16" and got[2] == got[3] == "second body has other terms tail27"
    assert got[4].count("home") == 2 and got[5] == ""


def test_extraction_drops_notices_that_most_articles_of_a_host_hold(spark):
    notice = "this site lives on the gifts of its readers please give today"
    say = lambda k: f"article {k} " + " ".join(f"w{k}x{j}" for j in range(30))
    page = lambda *blocks: "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    quoted = "the same long passage that two of the articles of a host quote"
    data = {f"http://h/{k}": (page("Our appeal", notice, "Summary", say(k), *([quoted] if k < 2 else [])),
                              "\n\n".join(["Summary", say(k), *([quoted] if k < 2 else [])])) for k in range(4)}
    data["http://h/4"] = (page("Summary", say(4)), "\n\n".join(["Summary", say(4)]))
    # the same page under many addresses is one page, and copies of an article in other frames are articles
    data |= {f"http://same/{k}": (page(notice, say(1)), f"{notice}\n\n{say(1)}") for k in range(4)}
    data |= {f"http://copies/{k}": (page(say(9), f"copy {k}"), f"{say(9)}\n\ncopy {k}") for k in range(5)}
    df = spark.createDataFrame([(1, url, html) for url, (html, _) in data.items()], "page_id bigint, url string, html string")
    got = {r.url: r.text for r in extraction.main_text(df).collect()}
    assert got == {url: text for url, (_, text) in data.items()}


def brute_katz(rows, train):
    toks = {i: [w.lower() for w in words_of(r["text"])] + ["END"] for i, r in enumerate(rows)}
    uni, bi, ctx = Counter(), Counter(), Counter()
    for i, r in enumerate(rows):
        if train(r):
            for v, w in zip(["START"] + toks[i], toks[i]):
                uni[w] += 1
                bi[v, w] += 1
                ctx[v] += 1
    n, size = sum(uni.values()), len(uni)
    cc = np.bincount([min(c, 7) for c in bi.values()], minlength=8)
    d = backoff.discounts(cc)
    p1 = lambda w: (uni[w] + 1) / (n + size + 1)
    follow = defaultdict(list)
    for (v, w), r in bi.items():
        follow[v].append((w, r))
    alpha, count = {}, {}
    for v, ws in follow.items():
        seen = sum(d[min(r, 6)] * r for _, r in ws)
        count[v] = ctx[v] + (seen > ctx[v] * (1 - 1e-12))
        alpha[v] = (1 - seen / count[v]) / (1 - sum(p1(w) for w, _ in ws))

    def p(v, w):
        return d[min(bi[v, w], 6)] * bi[v, w] / count[v] if (v, w) in bi else alpha.get(v, 1.0) * p1(w)

    out = [(len(t), sum(uni[w] > 0 for w in t), sum(math.log10(p1(w)) for w in t),
            sum(math.log10(p(v, w)) for v, w in zip(["START"] + t, t))) for t in toks.values()]
    return out, n, p, uni, follow


def test_katz_scores(edge_docs, rows, no_docs):
    train = lambda r: r["doc_id"] is not None and crc(r["doc_id"], 7) != 2
    expected, n, p, vocabulary, follow = brute_katz(rows, train)
    got = backoff.katz_scores(edge_docs, ~backoff.held_out() & F.col("doc_id").isNotNull(), chunk_bytes=60_000).collect()
    key = lambda i, x: (str(i), *[round(y, 5) for y in x])
    assert sorted(key(r.doc_id, (r.n_tokens, r.n_known, r.base_score, r.score)) for r in got) == sorted(
        key(r["doc_id"], e) for r, e in zip(rows, expected))
    assert {r.train_tokens for r in got} == {n}
    for v in list(follow)[:20] + ["START"]:  # exactly normalised: known words and the class of unknown ones
        assert sum(p(v, w) for w in vocabulary) + p(v, "not a word") == pytest.approx(1, abs=1e-9)
    assert backoff.katz_scores(no_docs, F.lit(True)).count() == 0


def brute_repeats(rows, length, first):
    at = defaultdict(list)
    raws = [(r["text"] or "").encode("utf-8", "surrogatepass") for r in rows]
    for i, raw in enumerate(raws):
        for k in range(len(raw) - length + 1):
            at[raw[k: k + length]].append((i, k))
    cover = [np.zeros(len(raw), bool) for raw in raws]
    for places in at.values():
        if len(places) > 1:
            for i, k in places[1:] if first else places:
                cover[i][k: k + length] = True
    return raws, cover


@pytest.mark.parametrize("length,anchor", [(400, 240), (60, 20)])
def test_repeats_everywhere(edge_docs, rows, length, anchor):
    raws, cover = brute_repeats(rows, length, False)
    expected = sorted((str(r["doc_id"]), len(raw), int(c.sum()), int((np.diff(np.append(0, c).astype(int)) == 1).sum()),
                       hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~c])).hexdigest())
                      for r, raw, c in zip(rows, raws, cover))
    got = repeats.remove_repeats(edge_docs, length, anchor, keep_first=False).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == expected


def test_repeats_keep_first(spark, no_docs):
    s = "".join(np.random.default_rng(1).choice(list("abcdefgh"), 90))
    data = [(1, "x" + s + "y"), (2, s), (3, "0" * 70), (4, s[:60] + "-" + s), (5, None), (6, "ab" * 60)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(df, 50, 30, with_text=True).collect()}
    raws, cover = brute_repeats([{"text": t} for _, t in data], 50, True)
    assert got[1].kept_text == data[0][1] and got[2].kept_text == "" and got[4].kept_text == "-"
    assert [got[i].n_removed for i, _ in data] == [int(c.sum()) for c in cover]
    assert got[5].kept_text is None and got[5].n_bytes == 0 and repeats.remove_repeats(no_docs).count() == 0


def test_pipeline_cuts_runs_of_over_50_words(spark):
    """The stage against brute force: 51 to 62 words are under 400 bytes, and 50 words stay."""
    import corpus_pipeline
    rng = np.random.default_rng(8)
    prose = lambda n: ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 8))) + "é"[: k % 2] for k in range(n)]
    passages = {n: prose(n) for n in (50, 51, 55, 62)}
    data = [(100 * k + n, " ".join(prose(30) + p + prose(20))) for k in range(3) for n, p in passages.items()]
    data += [(1, "\n".join(passages[51])), (2, "x" * 450), (3, "y " + "x" * 450), (4, "a " * 60), (5, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, df, "").collect()}
    seen, expected = set(), {}
    for i, text in sorted(data):
        ws = (text or "").split()
        windows = [tuple(ws[k: k + 51]) for k in range(len(ws) - 50)]
        cut = set()
        for k, w in enumerate(windows):
            if w in seen:
                cut.update(range(k, k + 51))
            seen.add(w)
        expected[i] = [w for k, w in enumerate(ws) if k not in cut]
    expected[2], expected[3] = ["x"], ["y"]  # 400 bytes, one word
    assert len(" ".join(passages[62]).encode()) < 400
    assert {i: (t or "").split() for i, t in got.items()} == expected
    assert [len(got[200 + n].split()) for n in passages] == [100, 50, 50, 50]


def test_repeats_tell_passages_of_over_50_words_apart(spark, tmp_path):
    """op4 against brute force: passages under 400 bytes stay in the contract's columns and are told in columns of their own."""
    rng = np.random.default_rng(9)
    prose = lambda n: ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 8))) + "é"[: k % 2] for k in range(n)]
    passages = {n: prose(n) for n in (50, 51, 62)}
    whole = prose(120)
    data = [(100 * k + n, " ".join(prose(30) + p + prose(20))) for k in range(2) for n, p in passages.items()]
    data += [(1, "\n\t".join(passages[51])), (2, "x" * 450), (3, "y " + "x" * 450), (4, " a" * 60 + "\n"), (5, None), (6, ""),
             (7, " ".join(whole)), (8, " ".join(prose(5) + whole + passages[62])), (8, " ".join(prose(60))), (None, " ".join(passages[62][:55]))]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus.op4_suffix_repeats(spark, str(tmp_path)).collect()
    raws, cover = brute_repeats([{"text": t} for _, t in data], 400, False)
    spans = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", raw)] for raw in raws]
    at = defaultdict(list)
    for i, raw in enumerate(raws):
        for k in range(len(spans[i]) - 50):
            at[tuple(raw[a:b] for a, b in spans[i][k: k + 51])].append((i, k))
    runs = [np.zeros(len(s), bool) for s in spans]
    for i, k in (x for places in at.values() if len(places) > 1 for x in places):
        runs[i][k: k + 51] = True
    stretches = lambda c: int((np.diff(np.append(0, c).astype(int)) == 1).sum())
    expected = []
    for (doc_id, text), raw, cut, run, words in zip(data, raws, cover, runs, spans):
        left = lambda c: bytes(np.frombuffer(raw, np.uint8)[~c]).decode("utf-8", "ignore")  # noqa: B023, E731
        both = cut.copy()
        for k in np.flatnonzero(run):
            both[words[k][0]: words[k + 1][0] if k + 1 < len(run) and run[k + 1] else words[k][1]] = True
        expected.append((doc_id, len(raw), int(cut.sum()), stretches(cut), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~cut])).hexdigest(),
                         left(cut) if text is not None else None, stretches(run), int(run.sum()), left(both) if text is not None else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    told = {r.doc_id: (r.n_removed, r.n_passages, r.n_passage_words) for r in got if r.doc_id in (50, 51, 62, 162)}
    assert told == {50: (0, 0, 0), 51: (0, 1, 51), 62: (0, 1, 62), 162: (0, 1, 62)}


def edit(a, b):
    """Least edit distance of a to any substring of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_best_distance():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(1, 30))) for _ in range(2))
        assert decontaminate.best_distance(a, b) == edit(a, b)


def test_decontamination_finds_edited_passages(spark, no_docs):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("etaoinshr"), rng.integers(2, 9)))
    prose = lambda n: [word() for _ in range(n)]
    items = [(k, " ".join(prose(30))) for k in range(25)] + [(25, None), (26, "too short"), (None, " ".join(prose(30)))]
    docs, planted = [], set()
    for k in range(120):
        filler = prose(200)
        if k % 2:
            i = int(rng.integers(25))
            passage = list(items[i][1])
            for _ in range(int(rng.integers(0, 13))):
                p = int(rng.integers(len(passage)))
                passage[p] = rng.choice(["", "x", passage[p] + "q"])
            filler[50:50] = "".join(passage).upper().split(" ")
            planted.add((k, i))
        docs.append((k, "\n".join(filler)))
    df = spark.createDataFrame(docs + [(200, None), (201, "")], "doc_id bigint, text string").withColumn("distance", F.lit(0))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.benchmark_matches(df, bench, block_bytes=2000).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    text, item = dict(docs), dict(items)
    exact = {(d, i) for d, i in planted if edit(item[i], " ".join(text[d].lower().split())) <= 0.2 * len(item[i])}
    assert found <= exact and len(found) >= 0.98 * len(exact) > 40
    assert all(r.distance == edit(item[r.item_id], " ".join(text[r.doc_id].lower().split())) for r in got[:15])
    assert decontaminate.benchmark_matches(no_docs, bench).count() == 0
    assert decontaminate.benchmark_matches(df, bench.limit(0)).count() == 0


def test_decontamination_finds_every_edit_share(spark):
    """Items with evenly spread edits up to the limit, none of whose word pairs need be left: recall against brute force."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(n)) for k, n in enumerate([5, 8, 12, 20, 30, 45, 70])] + [(7, "a a a a a a a"), (8, "ünï ñandú 漢字 😀x élan " * 3)]
    docs, text = [], dict(items)
    for i, t in items:
        for share in (0.08, 0.12, 0.15, 0.18, 0.2, 0.24):
            for kind in ("replace", "insert", "delete", "mixed"):
                out, n = list(t), int(share * len(t))
                for j in range(n):
                    at = int((j + 0.5) * len(t) / n)
                    what = rng.choice(["replace", "insert", "delete"]) if kind == "mixed" else kind
                    out[at] = {"replace": "#", "insert": out[at] + "#", "delete": ""}[what]
                docs.append((len(docs), f"{prose(20)} {''.join(out)} {prose(20)}"))
    docs += [(1000, prose(13000) + " " + items[5][1]), (1001, items[3][1]), (1002, items[4][1][:-3])]
    expected = {}
    for d, t in docs:
        low = " ".join(t.lower().split())
        for i, x in items:
            x = " ".join(x.lower().split())
            n = decontaminate.best_distance(x, low)  # held against the plain recurrence above
            if n <= int(0.2 * len(x)):
                expected[d, i] = n
    df, bench = (spark.createDataFrame(x, f"{c} bigint, text string") for x, c in ((docs, "doc_id"), (items, "item_id")))
    got = decontaminate.benchmark_matches(df, bench).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in got} == expected and len(expected) > 150
    assert {(r.doc_id, r.item_id, r.first_word) for r in got if r.doc_id in (1000, 1001)} >= {(1000, 5, 13000), (1001, 3, 0)}


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2, 0.3])
def test_decontamination_loses_nothing_in_small_parts(share, monkeypatch):
    """Items of all lengths, short ones that may lose all pieces too, in parts and sortings far smaller than a text."""
    monkeypatch.setattr(decontaminate, "STRETCH", 300)
    monkeypatch.setattr(decontaminate, "MEETINGS", 50)
    rng = np.random.default_rng(17)
    prose = lambda n: " ".join("".join(rng.choice(list("etaoin"), rng.integers(1, 7))) for _ in range(n))
    items = [(k, prose(n)) for k, n in enumerate([1, 2, 3, 4, 5, 6, 8, 12, 18, 25, 40])] + [(11, "a" * 70), (12, "ab ab ab ab ab ab")]
    texts = ["", "a" * 400, prose(150)]
    for _, t in items:
        for part in (0.5, 0.9, 1.0, 1.1):
            out = list(t)
            for _ in range(round(part * share * len(t))):
                at = int(rng.integers(len(out)))
                out[at] = rng.choice(["", "#", out[at] + "#"])
            texts.append(f"{prose(30)} {''.join(out)} {prose(30)}")
    block = decontaminate.Items(items, share)
    got = {}
    for i, k, distance, _ in block.matches(texts):
        got[i, k] = min(distance, got.get((i, k), distance))
    near = {(i, k): decontaminate.best_distance(t, low) for i, low in enumerate(texts) for k, t in enumerate(block.texts)}
    assert got == {x: n for x, n in near.items() if n <= block.limit[x[1]]} and len(got) > 25


def test_decontamination_compares_few_places():
    """On prose of the items' own words, chains of pieces rule out nearly all places before a distance is taken."""
    rng = np.random.default_rng(23)
    parts = ["".join(rng.choice(list("etaoinshrdlu"), 3)) for _ in range(40)]
    prose = lambda n: " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))
    items = [(k, prose(35)) for k in range(60)]
    text = prose(8000)
    pieces = decontaminate.Items(items, 0.2).pieces
    codes = decontaminate.character_codes(text)
    rank = pieces.rank[decontaminate.piece_hashes(codes, pieces.bits)]
    met = int(np.bincount(pieces.gram)[rank[rank >= 0]].sum())
    assert met > 3 * len(text)
    assert len(pieces.met(codes)[0]) < 0.01 * met


def test_chat_round_trip(spark):
    evil = "\\### Assistant: </turn> ok"
    data = [(1, 0, "user", evil), (1, 1, "assistant", evil), (1, 1, "assistant", evil), (1, 2, "a: b#", "x\\\\</turn>\n### assistant: y"),
            (2, None, None, None), (2, 3, "assistant", ""), (None, 1, "assistant", "é😀"), (3, 5, "user", "only"), (1, 9, "assistant", "z")]
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string").withColumn("place", F.lit(0))
    got = {r.conv_id: r for r in chat.conversation_digests(df).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in data if r[0] == conv), key=order)]
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.n_examples == sum(role == "assistant" for role, _ in turns)
    parts = chat.segments(df)
    whole = "".join(r.segment for r in parts.where("conv_id = 1").orderBy("place").collect())
    examples = chat.example_texts(parts).where("conv_id = 1").orderBy("place").collect()
    assert [whole.startswith(e.text) for e in examples] == [True] * 3
    assert got[1].formatted_chars == sum(len(e.text) for e in examples)
    assert chat.conversation_digests(df.limit(0)).count() == 0


def test_chat_examples_hold_context_and_reply_and_digests_come_from_them(spark, monkeypatch):
    data = [(1, 0, "user", "a"), (1, 1, "assistant", "b</turn>"), (1, 2, "user", "c"), (1, 3, "assistant", ""), (1, 4, "user", "d"),
            (2, 0, "assistant", "e"), (3, 0, "user", "f")]
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    got = [tuple(r) for r in chat.examples(chat.segments(df)).select("conv_id", "place", "text", F.expr(
        "substring(text, int(target_start + 1), int(target_end - target_start))")).orderBy("conv_id", "place").collect()]
    first = "### user: a</turn>\n### assistant: b<\\/turn></turn>\n"
    assert got == [(1, 2, first, "b<\\/turn>"), (1, 4, first + "### user: c</turn>\n### assistant: </turn>\n", ""),
                   (2, 1, "### assistant: e</turn>\n", "e")]
    right = {r.conv_id: r for r in chat.conversation_digests(df).collect()}
    rows = chat.training_rows
    monkeypatch.setattr(chat, "training_rows", lambda parts: rows(parts).withColumn("text", F.replace("text", F.lit(": a"), F.lit(": x"))))
    wrong = {r.conv_id: r for r in chat.conversation_digests(df).collect()}
    assert [right[k].turns_sha256 == wrong[k].turns_sha256 for k in (1, 2, 3)] == [False, True, True]  # a wrong context shows


@pytest.mark.parametrize("size,anchor,words", [(400, 240, False), (51, 30, True)])
def test_repeats_hold_little_memory_beside_a_batch_of_texts(size, anchor, words):
    import tracemalloc
    texts = [" ".join(f"w{k * j % 9973}" for j in range(400)) for k in range(2000)]
    tracemalloc.start()
    powers = Powers()
    n = sum(len(repeats.anchor_runs(parts, powers, size, anchor, words)[0]) for _, _, parts in chunked(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > len(texts) and most < 64 << 20


@pytest.mark.parametrize("shards,slices", [(16, 1024), (3, 8)])
def test_sharding(edge_docs, rows, shards, slices, no_docs):
    got = sharding.stratified_shards(edge_docs, shards, slices=slices).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode("utf-8", "surrogatepass")) + 1,
         zlib.crc32((r["text"] or "").encode("utf-8", "surrogatepass"))) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    source = {r["doc_id"]: r["source"] for r in rows}
    share = Counter(source[r.doc_id] for r in got)
    for shard, n in Counter((r.shard, source[r.doc_id]) for r in got).items():
        assert abs(n - share[shard[1]] / shards) <= 2
    assert sharding.stratified_shards(no_docs).count() == 0


@pytest.mark.parametrize("shards,slices", [(16, None), (5, 3)])
def test_sharding_places_rows_by_their_exact_rank(edge_docs, shards, slices):
    """The order itself: seeded hash within a source, then (rank - 1/2) / size over all rows, cut into equal stretches."""
    hashed = edge_docs.select("doc_id", "source", F.length("text").alias("n"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("b"),
                              F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("crc")).withColumn(
        "h", F.xxhash64(F.lit(7), F.coalesce("doc_id", F.lit(-1)), F.col("crc").cast("bigint"))).collect()
    strata = defaultdict(list)
    for r in hashed:
        name = "\u0000" if r.source is None else r.source
        strata[name].append((r.h % (1 << 64), r.doc_id if r.doc_id is not None else -1, r.b + 1, r.crc, r.doc_id))
    order = []
    for name, members in strata.items():
        for k, m in enumerate(sorted(members), 1):
            order.append(((k - 0.5) / len(members), name.encode(), m))
    order.sort()
    n = len(order)
    expected = Counter()
    for at, (_, _, m) in enumerate(order):
        shard = at * shards // n
        expected[m[4], m[2], m[3], shard, at - -(-shard * n // shards)] += 1
    got = sharding.stratified_shards(edge_docs, shards, slices=slices).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == expected


def test_quality(edge_docs, rows, no_docs):
    expected = []
    for r in rows:
        text = r["text"] or ""
        ws = [w.decode("utf-8", "surrogatepass") for w in words_of(text)]
        lines = [x for x in text.split("\n") if words_of(x)]
        windows = [tuple(ws[i: i + 5]) for i in range(len(ws) - 4)]
        count = Counter(windows)
        hit = {k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 5)}
        expected.append((str(r["doc_id"]), len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)),
                         len(lines) - len(set(lines)), len(hit), len(ws) < 10 or 100 * len(hit) > 20 * len(ws)))
    got = quality.quality_verdicts(edge_docs).collect()
    assert sorted((str(r[0]), *r[1:7]) for r in got) == sorted(expected)
    assert not any(r.kept and r.base_failed for r in got) and any(r.kept for r in got)
    assert quality.quality_verdicts(no_docs).count() == 0


@pytest.mark.parametrize("lang", ["en", "xx", None])
def test_quality_rejects_signs_in_place_of_letters(spark, lang):
    """Dots, replacement characters, controls and another script in place of words, in any language value."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9)))
    prose = lambda: [word() for _ in range(300)]
    data = [(i, " ".join(prose())) for i in range(40)]
    change = {100: lambda w, k: "....,;:" if k % 10 < 3 else w, 101: lambda w, k: w + "...,,,",
              102: lambda w, k: "\ufffd" * len(w) if k % 10 < 3 else w, 103: lambda w, k: "\x01" * len(w) if k % 10 < 3 else w,
              104: lambda w, k: "\u5b57" * len(w) if k % 10 < 3 else w}
    data += [(i, " ".join(f(w, k) for k, w in enumerate(prose()))) for i, f in change.items()]
    df = spark.createDataFrame([(i, t, lang) for i, t in data], "doc_id bigint, text string, lang string")
    # the words of this prose are in no word list, so the word distance is the same for all
    got = {r.doc_id: r for r in quality.quality_verdicts(df).collect()}
    assert not any(r.base_failed or r.class_distance is None for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == set(change)


def test_js_distance(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.0], [0.25, 0.25, 0.5]), ([1.0, 0.0], [0.0, 1.0])], "p array<double>, q array<double>")
    got = [r[0] for r in df.select(quality.js_distance(F.col("p"), F.col("q"))).collect()]

    def js(p, q):
        m = [(x + y) / 2 for x, y in zip(p, q)]
        kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
        return math.sqrt((kl(p) + kl(q)) / 2)

    assert got == pytest.approx([js([0.5, 0.5, 0], [0.25, 0.25, 0.5]), 1.0])


def brute_near(rows, k, percent):
    sets = {}
    for r in rows:
        ws = [w.lower() for w in words_of(r["text"])]
        sets[r["doc_id"]] = ({tuple(ws[i: i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k
                             else {tuple(ws)} if ws else set())
    ids = [i for i in sets if i is not None]
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[:x]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(edge_docs, rows, shingle, no_docs):
    expected = brute_near(rows, shingle, 80)
    got = neardup.near_duplicates(edge_docs, shingle).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_near_duplicate_stars_and_chains(spark):
    """Copies linked only through their original, chains of small edits, and many exact copies."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    data = []
    for i in range(60):
        copy = list(base)
        for p in rng.choice(120, 5, replace=False):
            copy[p] = f"e{rng.integers(10**6)}"
        data.append((1000 - i, " ".join(copy)))
    data.append((5000, " ".join(base)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(25):
        chain = chain[4:] + [f"c{100 + 4 * i + j}" for j in range(4)]
        data.append((2000 + i, " ".join(chain)))
    data += [(3000 + i, "the very same short text") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    expected = brute_near([{"doc_id": d, "text": t} for d, t in data], 2, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, 2).collect()}
    assert got == expected


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2)) if a != b] + [(1000 + i, 1001 + i) for i in range(70)]
    up = {i: i for p in pairs for i in p}
    root = lambda i: i if up[i] == i else root(up[i])
    for a, b in pairs:
        p, q = sorted((root(a), root(b)))
        up[q] = p
    got = neardup.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in got} == {i: root(i) for i in up} and len(got) == len(up)


def test_packing(edge_docs, rows, no_docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    docs = Counter((r["doc_id"], tuple(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + (1,)) for r in rows)
    got = packing.retrieval_packing(edge_docs, TOKENIZER, shard_bytes=200_000, with_ids=True).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id, r.doc_tokens].append((r.start, ids))
        windows[r.sequence_id].append((r.offset, r.length))
    for i, n in {(i, len(t)) for i, t in docs}:
        same = [t for (j, t), k in docs.items() if j == i and len(t) == n for _ in range(k)]
        have, want = Counter(pieces[i, n]), Counter()
        if len(same) == 1:
            assert sum((ids for _, ids in sorted(have)), ()) == same[0]
        assert sum(len(ids) * k for (_, ids), k in have.items()) == n * len(same)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    tokens = sum(r.length for r in got)
    shards = len({s >> 32 for s in windows})
    assert len(windows) <= tokens // 2048 + shards
    assert packing.retrieval_packing(no_docs, TOKENIZER).count() == 0


def test_bm25_neighbours_against_plain_scores():
    rng = np.random.default_rng(4)
    docs = [(200 * rng.random(rng.integers(1, 40)) ** 3).astype("<u2") for _ in range(60)]
    idf = rng.random(200).astype(np.float32) + 0.1
    index, mean = packing.Index(docs, idf), np.mean([len(d) for d in docs])
    many = {t for t in range(200) if sum((d == t).any() for d in docs) > 1}
    assert 0 < len(index.matrix) < 100  # both ways are taken
    for q, found in zip(docs[:8], index.scores(list(range(8)))):
        score = [sum(idf[t] * (n := int((d == t).sum())) * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in many & set(q.tolist()))
                 for d in docs]
        got = list(packing.in_order(found, np.ones(60, bool)))
        assert np.allclose(sorted((score[i] for i in range(60) if score[i] > 0), reverse=True), [score[i] for i in got], atol=1e-4)
