"""Row-wise and streaming operators: extraction, chat, tokens, licenses."""

import hashlib
import html
import random
import re
import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import chat, html_extract, license_scan
from tessera.llm import token_count as tokens
from tessera.llm.queries import ORACLE_SQL, QUERIES, TOKENIZER, conversation_events

SF = "/root/testdata/sf0.001"


# Main text of pages

def test_extraction_matches_the_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op4_html_extract"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


WEIGHTS = {"article": -20.0, "/article": -20.0, "p": -0.05, "/p": -0.05, "h1": -0.05, "/h1": -0.05}


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words only", "plain words only"), ("a < b & c &lt; d", "a < b & c < d"),
    ("<p>one<p>two <b>bo</b>ld", "one\n\ntwo bold"), ("<p>a<br>b&nbsp; c</p>", "a b c"),
    ("<script>var x='</p>';</script><p>kept</p><style>p{}</style>", "kept"), ("<p>kept</p><!-- not this", "kept"),
    ("<nav><a>menu</a></nav><article><h1>T</h1><p>body text here</p><div class='share-links'>tweet it</div><p>more</p></article>"
     "<section id=comments><p>first! a long comment with many many words in it</p></section>", "T\n\nbody text here\n\nmore"),
    ("<p>x</p><form><p>your name</p></form><p>y</p>", "x\n\ny"), ("<script>never ends <p>words</p>", ""),
    ('<p title="a > b">quoted</p>', "quoted"), ("<P CLASS=x>UPPER</P>", "UPPER")])
def test_extraction_cases(page, text):
    assert html_extract.extract(page, WEIGHTS) == text


@pytest.mark.parametrize("unit", ["<div>m ", "<li><p>m ", "<table><tr><td>m ", "<tr><td>m ", "<dt>m<dd>m ", "<p><span class=ad>m "])
@pytest.mark.parametrize("outer", ["nav", "form", "section class=comments"])
def test_extraction_closes_containers_at_any_depth(outer, unit):
    page = f"<{outer}>{unit * 300}</{outer.split()[0]}><article><p>the article text</p></article>"
    assert html_extract.extract(page, WEIGHTS | {"article": -0.05, "/article": -0.05}) == "the article text"


def test_extraction_ends_open_siblings():
    dark = lambda page: [(t.strip(), d) for k, t, d in html_extract.items(page) if k == "text"]
    assert dark("<ul><li class=ad><p>a<li>b<ul><li class=ad>c</ul>d</ul>") == [("a", True), ("b", False), ("c", True), ("d", False)]
    assert dark("<dl><dt class=ad>a<dd>b<dt>c</dl>") == [("a", True), ("b", False), ("c", False)]
    assert dark("<table><tr><td class=ad><div>a<td>b<tr class=ad><td>c<table><tr><td>d</table>e<tr><td>f</table>") == [
        ("a", True), ("b", False), ("c", True), ("d", True), ("e", True), ("f", False)]


@pytest.mark.parametrize("quote, value", [('"', "<script>var a = '1' > 0;"), ("'", '<div class="nav" hidden> five words of the value')])
def test_extraction_long_attribute_values(quote, value):
    for n in (1, 1000):
        page = f"<p data-x={quote}{value * n}{quote}>kept</p><p title = {quote}>{quote}>too</p>"
        assert html_extract.extract(page, WEIGHTS) == "kept\n\ntoo"
    assert html_extract.extract(f"<p title={quote}never closed>kept</p>", WEIGHTS) == "kept"
    assert html_extract.extract("<p title=5\">kept</p><p title=a>too</p>", WEIGHTS) == "kept\n\ntoo"


def test_extraction_of_unclosed_values_is_linear():
    start = time.monotonic()
    for page in ('<a x=">" ' * 50_000, '<a x=">" ' * 50_000 + "='", "<a x='>\">' y=\">" * 50_000, "<div>" * 50_000 + "<li>x</li>" * 50_000, '<a x="' * 50_000 + ">"):
        html_extract.extract(page, WEIGHTS)
    assert time.monotonic() - start < 20


def test_extraction_of_odd_markup_is_linear():
    for page in ("<a <a <a" * 30_000, "<" * 200_000, '<a "' * 30_000, "<div>" * 50_000 + "x", "</p>" * 50_000 + "x"):
        html_extract.extract(page, WEIGHTS)


def test_extraction_query_shape(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>hello you</p></article>", "c"), (1, "u", None, "c"), (None, None, "", "c")],
                                  "page_id long, url string, html string, text string")
    got = html_extract.main_text(pages, html_extract.learn_weights(pages))
    assert sorted((r.row.page_id is None, r.text) for r in got.collect()) == [(False, ""), (False, "hello you"), (True, "")]
    assert html_extract.main_text(pages.where("false"), html_extract.learn_weights(pages.where("false"))).count() == 0


# Chat

TEXTS = st.text(st.sampled_from(list("ab \\\n<>[]/")), max_size=8)
MIXED = st.lists(st.one_of(TEXTS, st.sampled_from(chat.CONTROLS)), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["user", "assistant", "system", "tool"]), MIXED), MIXED), max_size=6))
def test_rendered_turns_come_back_exactly(turns):
    out, spans, at = "<s>", [], 3
    for role, text in turns:
        turn, start, length = chat.render(role, text)
        spans.append((at + start, length))
        out, at = out + turn, at + len(turn)
    assert list(chat.parse(out)) == turns
    assert [chat.unescape(out[s:s + n]) for s, n in spans] == [t for _, t in turns]


def test_fold_of_deltas_edits_and_regenerations(spark):
    E = [("c", 1, 1, "open", "user", ""), ("c", 1, 2, "delta", None, "he"), ("c", 1, 3, "delta", None, "y"), ("c", 1, 3, "delta", None, "y"),
         ("c", 2, 4, "open", "assistant", ""), ("c", 2, 5, "delta", None, "bad"), ("c", 2, 6, "regenerate", None, None), ("c", 2, 8, "delta", None, "od"),
         ("c", 2, 7, "delta", None, "go"), ("c", 3, 9, "open", "user", "x"), ("c", 3, 10, "delete", None, None),
         ("c", 4, 11, "open", "user", "old"), ("c", 4, 12, "edit", None, "new"), ("c", 4, 13, "delta", None, "!"),
         ("d", 1, None, "delta", None, "no open"), (None, 1, 1, "open", None, "null conversation")]
    got = chat.fold_events(spark.createDataFrame(E, "conv_id string, msg long, seq long, op string, role string, text string").orderBy("text"))
    assert sorted((str(r.conv_id), r.msg, r.role, r.text) for r in got.collect()) == [
        ("None", 1, None, "null conversation"), ("c", 1, "user", "hey"), ("c", 2, "assistant", "good"), ("c", 4, "user", "new!"), ("d", 1, None, "no open")]


def chat_digests(rows):
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x or 0 if i < 2 else x or "") for i, x in enumerate(r))):
        by.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def test_chat_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op8_chat_format"](spark, SF).collect()}
    assert got == chat_digests(rows)


def test_chat_edge_cases_and_pieces(spark, monkeypatch):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, 1, None, "x"), (None, 5, "tool", "y"), (2, None, "user", "z"),
            (2, 3, "assistant", "w" * 50)] + [(3, i, "assistant" if i % 2 else "user", "é[INST]" * 30) for i in range(200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for piece in (1_000_000, 400):
        monkeypatch.setattr(chat, "PIECE", piece)
        formatted = chat.format_conversations(chat.fold_events(conversation_events(frame)))
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
        assert got == chat_digests(rows)
    assert chat.digests(chat.format_conversations(chat.fold_events(conversation_events(frame.where("false"))))).count() == 0


# Tokens

def reference(vocabulary):
    from tokenizers import Tokenizer, models, normalizers
    pieces = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256) if vocabulary.byte_fallback] + list(vocabulary.pieces.items())
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=vocabulary.byte_fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend(tokens.MARK), normalizers.Replace(" ", tokens.MARK)])
    return lambda text: len(t.encode(text).ids)


def test_token_counts_match_the_tokenizer(spark):
    vocabulary = tokens.Vocabulary.read(TOKENIZER)
    count, rng = reference(vocabulary), random.Random(3)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["", " ", "  a  b ", "漢字 über\n\n tab\t😀", "▁a▁", "x" * 5000, "a" * 70 + " " + "a" * 70, "\x00 "]
    texts += ["".join(rng.choice("ab ▁.é😀\nthe,") for _ in range(rng.randrange(60))) for _ in range(300)]
    mine = tokens.Counter(vocabulary)
    assert [mine(t) for t in texts] == [count(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text("ab▁c", min_size=1, max_size=4), st.integers(-6, 0).map(float), min_size=1, max_size=14),
       st.lists(st.text("ab cd é", max_size=14), min_size=1, max_size=5), st.booleans())
def test_token_ties_match_the_tokenizer(pieces, texts, fallback):
    vocabulary = tokens.Vocabulary(pieces, fallback)
    mine, count = tokens.Counter(vocabulary), reference(vocabulary)
    for text in texts:
        if fallback and min(pieces.values()) == 0.0:
            continue
        assert mine(text) == count(text), text


def test_token_query_edge_cases(spark):
    frame = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "hello world", 3), (3, "hello world", 3), (None, "a", 3)], "doc_id long, text string, n_tokens int")
    vocabulary = tokens.Vocabulary.read(TOKENIZER)
    got, n = tokens.count_tokens(frame, vocabulary).collect(), reference(vocabulary)("hello world")
    assert sorted((str(r.row.doc_id), r.n_tokens) for r in got) == [("1", 0), ("2", 0), ("3", n), ("3", n), ("None", 1)]
    assert tokens.count_tokens(frame.where("false"), tokens.Vocabulary.read(TOKENIZER)).count() == 0


# Licenses

def test_licenses_match_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = QUERIES["op5_license_scan"](spark, SF).collect()
    assert sorted((r.doc_id, r.license, r.n_matched, r.n_shingles) for r in got) == sorted(con.execute(ORACLE_SQL["op5_license_scan"]).fetchall())
    assert got


def test_licenses_planted_in_long_and_edited_texts(spark):
    rng = random.Random(6)
    noise = lambda n: " ".join(f"n{rng.randrange(1000)}" for _ in range(n))
    rows, expected = [], set()
    for i, (name, text) in enumerate(license_scan.LICENSES.items()):
        rows.append((i, f"{noise(rng.randrange(300))}\n{text.upper()} {noise(30)}", "clash"))
        expected.add((i, name))
        words = text.split()
        if len(words) > 30:  # one word changed
            rows.append((100 + i, " ".join([noise(17), *words[:15], "changed", *words[16:]]), "clash"))
            expected.add((100 + i, name))
            rows.append((200 + i, " ".join([noise(17), *words[:12], noise(40)]), "clash"))  # too little of it
    rows += [(300, None, ""), (301, "", ""), (302, "license " * 2000, ""), (None, "All rights reserved.", ""), (None, "All rights reserved.", "")]
    got = license_scan.license_matches(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert expected | {(None, "All-rights-reserved")} <= found and len(got) == len(found)
    assert not any(d is not None and (200 <= d < 300 or d >= 300) and name.endswith(("header", "text")) for d, name in found)
    assert license_scan.license_matches(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licenses_plan_is_native(spark):
    plan = QUERIES["op5_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


ARTICLE = "".join(f"<p>{' '.join(f'w{i}x{j}' for j in range(20))}.</p>" for i in range(8))
POOLED = {"article": -25.0, "/article": -25.0, "*": -0.05}


@pytest.mark.parametrize("wrapper", ['div class="layout has-sidebar"', 'div class="content search-results"', 'div id="page" class="menu-open"',
                                     'div class="social-news-app"', 'section role="search"', 'div class="main"', 'div class="sidebar"'])
def test_extraction_keeps_articles_in_wrappers_of_any_name(wrapper):
    page = f"<body><nav>a b</nav><{wrapper}>{ARTICLE}</{wrapper.split()[0]}><footer>x y</footer></body>"
    assert html_extract.extract(page, POOLED) == ARTICLE.replace("<p>", "").replace("</p>", "\n\n").strip()


def test_extraction_keeps_tables_lists_and_figures_that_were_not_learned():
    page = ("<body><article><p>" + "long " * 20 + "</p><table>" + "<tr><td>a</td><td>b</td></tr>" * 6 + "</table><ul>" + "<li>item one</li>" * 4
            + "</ul><figure><figcaption>a figure</figcaption></figure><p class='related-work'>related work</p><div class=menu-card>card</div>"
            "<div class='share-buttons'>share</div><div class=ad><p>buy</p><p>now</p></div><p>" + "last " * 10 + "</p></article>"
            "<div class=comments>" + ARTICLE * 3 + "</div></body>")
    got = html_extract.extract(page, POOLED).split("\n\n")
    assert got == ["long " * 19 + "long", *["a", "b"] * 6, *["item one"] * 4, "a figure", "related work", "card", "last " * 9 + "last"]
    short = '<body><div class="ad">A text that is much longer than the article of this page.</div><article><p>Short one.</p></article></body>'
    assert html_extract.extract(short, POOLED) == "Short one."


def test_region_is_the_best_of_all_runs():
    import random
    rng, kinds = random.Random(1), [("text", "a b c", False), ("p", "", False), ("div", "", False), ("i", "", False), ("text", "x", True), ("nav+", "", True), ("/p", "", False)]
    weights = {"p": -1.5, "/p": -0.5, "*": -2.0}

    def score(kind, text, dark):
        if dark:
            return html_extract.SKIPPED if kind[-1] == "+" else 0.0
        return len(text.split()) if kind == "text" else weights.get(kind, -2.0 if kind == "div" else html_extract.UNSEEN_INLINE)

    for _ in range(300):
        seq = [rng.choice(kinds) for _ in range(rng.randint(0, 14))]
        best = max((sum(score(*x) for x in seq[a:b]) for a in range(len(seq)) for b in range(a + 1, len(seq) + 1)), default=0.0)
        lo, hi = html_extract.region(seq, weights)
        assert abs(sum(score(*x) for x in seq[lo:hi]) - max(best, 0.0)) < 1e-9
