"""Text operators on small made rows: libraries, brute force, round trips, and odd rows."""

import base64
import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tradepanel.llm import (
    best_fit, byte_bpe, bytescan, chat_template, components, cross_polytope, entries, hilbert_shards, html_density, jaccard_join, line_crf,
    pieces, quality_rules, token_transducer,
)
from tradepanel.llm.common import read_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, N_WORDS string"
LONG = " ".join(f"word{i % 900} the of and" for i in range(20_000))
ODD = [
    (1, None, None, None, None, None, "x"),
    (2, "", "en", "a", 0, 1.0, None),
    (3, " \t\n\n ", "en", "a", 5, 1.0, None),
    (None, "a text without id, the same as another", "en", "a", 10, 1.0, None),
    (4, "a text without id, the same as another", "xx", None, -3, 1.0, None),
    (5, "it's  <|endoftext|> don't 've 😀😀 日本語 x\u00a0y\r\n", "de", "b", 40, 1.0, None),
    (5, "it's  <|endoftext|> don't 've 😀😀 日本語 x\u00a0y\r\n", "de", "b", 40, 1.0, None),
    (6, "a" * 50_000, "fr", "b", 50_000, 1.0, None),
    (7, LONG, "en", "b", len(LONG), 1.0, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


RANKS = read_file(P.path("byte_bpe_multi_50k.tiktoken"))
FILE = read_file(P.path("byte_bpe_50k.json"))
TABLE = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=TABLE, special_tokens={})
TOKENIZER = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
SPLITTER, CODER = pieces.Splitter(P.PATTERN), byte_bpe.TreeEncoder(TABLE)
COUNTER, IN_CHUNKS = token_transducer.Counter(FILE, P.PATTERN), token_transducer.Counter(FILE, P.PATTERN, chunk=5)
PARTS = list("abthe ing  \n\t's'ré日😀1!=\x00\u00a0") + ["the ", "'ll", "aaaa", "<|endoftext|>"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_tokens_as_the_libraries(texts):
    for text, ids in zip(texts, CODER.encode_texts(texts, SPLITTER)):
        assert ids.tolist() == THEIRS.encode_ordinary(text)
        assert CODER.decode(ids.tolist(), leaf=2) == text.encode()
    wanted = [len(TOKENIZER.encode(t, add_special_tokens=False).ids) for t in texts]
    assert COUNTER.count_texts(texts).tolist() == wanted
    assert IN_CHUNKS.count_texts(texts).tolist() == wanted


def test_token_queries_on_odd_rows(odd, empty):
    sent = sorted((str(r[0]), r[1] or "") for r in ODD)
    got = byte_bpe.encode_documents(odd, RANKS, P.PATTERN, digests=True).collect()
    want = [(i, len(x := THEIRS.encode_ordinary(t)), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in sent]
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    got = token_transducer.count_tokens(odd, FILE, P.PATTERN, limit=100).collect()
    want = [(i, len(t.encode()), n := len(TOKENIZER.encode(t, add_special_tokens=False).ids), n > 100) for i, t in sent]
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert byte_bpe.encode_documents(empty, RANKS, P.PATTERN).count() == 0
    assert token_transducer.count_tokens(empty, FILE, P.PATTERN).count() == 0


def test_prefix_scan_gives_all_prefixes():
    for n in range(1, 20):
        assert token_transducer.prefix_scan(list("abcdefghijklmnopqrst"[:n]), lambda a, b: a + b) == ["abcdefghijklmnopqrst"[: i + 1] for i in range(n)]


# ------------------------------------------------------------------ chat


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<|n>im_\nx"))
def test_escape_can_be_undone(text):
    assert chat_template.unescape(chat_template.escape(text)) == text
    assert "<|" not in chat_template.escape(text)
    line = chat_template.escape_line(text)
    assert "\n" not in line and chat_template.unescape(line) == text


def test_template_folds_and_refuses():
    tree = chat_template.fold(chat_template.parse('{% if true and "a" == "a" %}x{{ "b" ~ 1 | upper }}{% else %}y{% endif %}z'))
    assert tree == ("block", [("const", "xb1z")])
    render = chat_template.compile_template('{% for m in messages %}{% if loop.first %}<{% elif m.role == "u" %}-{% else %}+{% endif %}{{ m["text"] | trim }}{% endfor %}')
    assert render([{"role": "u", "text": " a "}, {"role": "u", "text": "b"}, {"role": "v", "text": "c"}])[0] == "<a-b+c"
    for bad in ("{{ x() }}", "{% for a in %}", "{{ a.b }", "{% if a %}", "{{ a | exec }}", "{{ a.__class__", "{% import os %}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.compile_template(bad if "}" in bad[-2:] or "%" in bad[-2:] else bad + " }}")([])
    with pytest.raises(chat_template.TemplateError):
        chat_template.compile_template('{{ messages["__class__"] }}')([])


def test_conversations_read_back(spark):
    rows = [(1, 1, "assistant", "<|im_end|>\n<|im_start|>"), (1, 0, "user\n", "a\\n"), (2, None, None, None), (2, 3, "assistant", "x<"), (2, 3, "assistant", "x<"), (None, 0, "u", "ü")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r[0]: r[1:] for r in chat_template.read_back(chat_template.format_conversations(df)).collect()}
    for conv in (1, 2, None):
        mine = sorted([(r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        loss = "".join(t for _, role, t in mine if role == "assistant")
        turns = "".join(f"{role}\n{t}\n" for _, role, t in mine)
        assert got[conv][:4] == (len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_template.format_conversations(df.limit(0)).count() == 0


# ------------------------------------------------------------------ shards and packing


def test_hilbert_visits_every_cell_by_single_steps():
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        place = {hilbert_shards.hilbert_index(c, bits): c for c in itertools.product(range(1 << bits), repeat=n)}
        assert sorted(place) == list(range(1 << n * bits))
        assert all(sum(abs(a - b) for a, b in zip(place[i], place[i + 1])) == 1 for i in range(len(place) - 1))


def test_shards_are_even_runs_of_the_curve(spark, odd, empty):
    many = spark.range(500).selectExpr("id as doc_id", "concat('t', id % 7) as text", "if(id % 3 = 0, 'en', 'de') as lang", "'hot' as source", "id % 9 as n_chars", "1 as shard")
    rows = hilbert_shards.document_shards(many, 24).collect()
    counts = collections.Counter(r.shard for r in rows)
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
    order = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    small = {(r.doc_id, r.size, r.text_crc32) for r in hilbert_shards.document_shards(odd, 24).collect()}
    assert small == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in ODD}
    assert hilbert_shards.document_shards(empty, 24).count() == 0


def test_shard_files_and_ranges(spark, odd, tmp_path):
    assigned = hilbert_shards.document_shards(odd, 4)
    hilbert_shards.write_shards(assigned, str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ODD)
    ranges = hilbert_shards.shard_ranges(assigned, ["n_chars"]).collect()
    assert sum(r.n_rows for r in ranges) == len(ODD)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_patterns_hold_everything(histogram):
    patterns = best_fit.plan_patterns(histogram, (8, 16, 64), 2)
    got = collections.Counter()
    for p in patterns:
        used = sum(a * b for a, b in p.contents)
        assert p.capacity == min(c for c in (8, 16, 64) if c >= used)
        for a, b in p.contents:
            got[a] += b * p.repeat
    assert got == histogram


def test_packing_places_every_piece_once(odd, empty):
    rows = best_fit.pack_documents(odd, capacities=(64, 256)).collect()
    want = collections.Counter()
    for i, t, *_ in ODD:
        n = -(-len((t or "").encode()) // 4)
        for start in range(0, max(n, 1), 256):
            want[i, start, min(256, n - start)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length) for r in rows) == want
    assert all((r.bin_id is None) == (r.length == 0) for r in rows)
    bins = collections.defaultdict(list)
    for r in rows:
        if r.length:
            bins[r.bin_id, r.capacity].append((r.offset, r.offset + r.length))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), spans in bins.items():
        spans.sort()
        assert spans[-1][1] <= capacity and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert best_fit.pack_documents(empty).count() == 0


def test_packing_sorts_pieces_once_and_joins_nothing(spark):
    docs = spark.createDataFrame([(i % 40, "x" * (i % 9 * 300)) for i in range(400)], "doc_id long, text string")
    packed = best_fit.pack_documents(docs, tags=3)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Sort [") == 1
    places = [(r.bin_id, r.offset) for r in packed.collect() if r.length]
    assert len(places) == len(set(places)) == sum(1 for i in range(400) if i % 9)


def test_registered_packing_is_in_tokens_of_the_library(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    want = collections.Counter({r.doc_id: len(TOKENIZER.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()})
    for rows in (entries.op5_best_fit(spark, folder).collect(), corpus_pipeline.packing(spark, docs, folder).collect()):
        got, used, capacity = collections.Counter(), collections.Counter(), {}
        for r in rows:
            got[r.doc_id] += r.length
            if r.length:
                used[r.bin_id] += r.length
                capacity[r.bin_id] = r.capacity
        assert got == want
        assert all(used[b] <= c <= max(best_fit.CAPACITIES) for b, c in capacity.items())


def test_tokens_of_odd_rows_are_packed(odd, empty):
    got = collections.Counter()
    for r in best_fit.pack_texts(odd, FILE, P.PATTERN).collect():
        got[r.doc_id] += r.length
    want = collections.Counter()
    for i, t, *_ in ODD:
        want[i] += len(TOKENIZER.encode(t or "", add_special_tokens=False).ids)
    assert got == want
    assert best_fit.pack_texts(empty, FILE, P.PATTERN).count() == 0


# ------------------------------------------------------------------ similar documents


def _shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _classes(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y in range(x):
            b = sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(x)] = find(y)
    smallest = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            smallest[find(x)] = min(i, smallest.get(find(x), i))
    return sorted((str(i), len(s), str(smallest.get(find(x), i))) for x, (i, s) in enumerate(sets))


def _variants(seed, groups, size, n_words):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = [f"W{rng.integers(400)}" for _ in range(n_words)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.integers(0, 4)):
                words[rng.integers(len(words))] = f"z{rng.integers(1000)}"
            out.append(" ".join(words[: rng.integers(n_words * 3 // 4, n_words + 1)]))
    return out


def test_classes_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHINGLE_BLOCK", 900)  # several blocks
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "LOCAL", 3)
    texts = _variants(1, 6, 14, 60) + ["one two", "One  two", "one", "", None, " \n"] + ["same text in six words twice"] * 3
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (3, texts[9]), (None, texts[5] + " more")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long").repartition(4)
    got = jaccard_join.similarity_classes(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _classes(rows)


def test_classes_of_odd_rows(odd, empty):
    got = jaccard_join.similarity_classes(odd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _classes([r[:2] for r in ODD])
    assert jaccard_join.similarity_classes(empty).count() == 0


def test_word_hashes_do_not_depend_on_the_batch():
    texts = [b"a b c d e f", b"", b"Xy  zz\n" * 400, b"q" * (bytescan.BLOCK + 77) + b" tail"]
    together = bytescan.shingle_sets(texts)
    for t, s in zip(texts, together):
        assert bytescan.shingle_sets([t])[0].tolist() == s.tolist()


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_components_of_random_links(spark, most):
    rng = np.random.default_rng(most)
    links = [(int(a), int(b)) for a, b in rng.integers(-90, 90, (70, 2))] + [(500, x) for x in range(200, 320)] + [(None, 3), (4, None)]
    root = {x: x for link in links for x in link if None not in link and link[0] != link[1]}
    for _ in root:
        for a, b in links:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame(links * 2, "a long, b long").repartition(5)
    got = components.components(frame, most).collect()
    assert len(got) == len(root) and dict(got) == root
    assert components.components(frame.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}


# ------------------------------------------------------------------ pages, classifier, vectors


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>", ""),
        ("<nav><a href=x>Menu item</a></nav><article><h1>T &amp; x</h1><p>One two<br>three <b>bo</b>ld.<p>Next&nbsp; para</article><footer>f</footer>", "T & x One two three bold. Next para"),
        ("<div class='ad'>Buy this now, a long advert text here</div><main><p>Real words of the article here.</p><script>var a='<p>no</p>'</script></main><!-- <p>x</p>", "Real words of the article here."),
        ("<article><p>Text with <a title='a>b' href=y>link</a> inside it</p><div class=comments><p>Reader says many words</p></div></article>", "Text with link inside it"),
        ("<article><p>Unclosed tag at the end of page <b", "Unclosed tag at the end of page"),
    ],
)
def test_main_text(page, text):
    assert html_density.main_text(page) == text


_LINE = "Plain words of a long and even line that tells the reader something. "


@pytest.mark.parametrize(
    "inside",
    [
        "".join(f"<section>{''.join(f'<p>{i}{j} {_LINE * 7}</p>' for j in range(5))}</section>" for i in range(3)),
        "".join(f"<div><div><div>{''.join(f'<p>{i}{j} {_LINE * 7}</p>' for j in range(5))}</div></div></div>" for i in range(4)),
        f"{f'<p>{_LINE * 4}</p>' * 3}<ul>{f'<li>{_LINE}</li>' * 40}</ul>",
        f"{f'<p>{_LINE * 4}</p>' * 3}<table>{f'<tr><td>{_LINE}</td><td>{_LINE}</td></tr>' * 30}</table>{f'<p>{_LINE * 4}</p>' * 2}",
    ],
    ids=["sections", "nested divs", "long list", "table"],
)
def test_all_parts_of_an_article_are_kept(inside):
    page = f"<nav><a href=x>Menu item</a></nav><article>{inside}</article><footer>f</footer>"
    assert html_density.main_text(page) == " ".join(re.sub("<[^>]*>", " ", inside).split())


@pytest.mark.parametrize(
    "names",
    ['class="content with-sidebar"', "class=no-sidebar", 'class="header-fixed"', "class='layout nav-open'", 'class="page login"',
     'class="related-work"', "id=search-results", 'class="share-prices"', 'id="main-form" role=search'],
)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_names_do_not_cut_what_holds_the_article(names, tag):
    inside = f"<{tag}>{f'<p>{_LINE * 5}</p>' * 4}<div class='comments'><p>{_LINE}</p></div></{tag}>"
    want = f"{_LINE * 20}".strip()
    page = f"<div class=top-nav><a href=x>Menu item</a></div><div {names}>{inside}<div class=sidebar>{_LINE}</div></div>"
    assert html_density.main_text(page) == want
    assert html_density.main_text(f"<form>{page}<input></form>") == want


def test_sections_named_like_a_marker_are_kept():
    parts = [f"<section {x}>{f'<p>{i} {_LINE * 7}</p>' * 5}</section>" for i, x in enumerate(("class=related-work", "id=search-results", "class=share-prices"))]
    got = html_density.main_text(f"<article>{''.join(parts)}<div class='related'><p>{_LINE * 7}</p></div></article>")
    assert got == " ".join(re.sub("<[^>]*>", " ", "".join(parts)).split())


def test_pages_table(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    for r in html_density.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S)
        import html

        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", inside[1])).split()) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None, 1), (None, "u", "<p>a b</p>", 2)], "page_id long, url string, html string, text long")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in html_density.extract(odd).collect()) == [("1", "", 0), ("None", "a b", 3)]
    assert html_density.extract(odd.limit(0)).count() == 0


@pytest.mark.parametrize(
    "attribute",
    ['class="overflow-hidden"', 'style="overflow:hidden"', 'style="visibility:hidden"', 'class="md:hidden"', 'id="hidden-gems"',
     'data-title="the hidden side"', 'title="nav menu"'],
)
@pytest.mark.parametrize("element", ["{}", "<article>{}</article>"])
def test_everyday_attributes_cut_nothing(attribute, element):
    inside = element.format("".join(f"<p>{_LINE * 4}</p>" for _ in range(5)))
    page = f"<body><nav><a href=x>Home</a></nav><div {attribute}>{inside}</div><footer>Imprint</footer></body>"
    assert html_density.main_text(page) == " ".join([(_LINE * 4).strip()] * 5)


@pytest.mark.parametrize("attribute", ["hidden", 'hidden=""', "aria-hidden='true'", 'style="color:red; display : none"'])
def test_hidden_parts_go_but_not_the_article(attribute):
    article = f"<article><p>{_LINE * 9}</p><div {attribute}><p>Unseen words, {_LINE}</p></div></article>"
    assert html_density.main_text(f"<div {attribute}>{article}</div>") == (_LINE * 9).strip()


def test_inline_asides_end_with_their_tag():
    rest = f"Hello {_LINE * 3}"
    for aside in ("<span class='ad'>Buy</span>", "<span class='ad'><span>Buy</span> now</span>", "<a class='share' href='x'>Share</a>"):
        assert html_density.main_text(f"<article><p>{aside} {rest}</p><p>{_LINE * 5}</p></article>") == f"{rest.strip()} {(_LINE * 5).strip()}"


def test_blocks_in_links_are_link_text():
    cards = "".join(f"<a href='/{i}'><div><h3>Other tale {i}</h3><p>{_LINE}</p></div></a>" for i in range(3))
    body = html_density.parse(f"{cards}<p>free words</p><p><a name=top>an anchor<p>more")
    html_density.measure(body)
    assert body.link_chars == sum(len(f"Other tale {i}") + len(_LINE.strip()) for i in range(3))
    text = "".join(f"<p>{_LINE * 4}</p>" for _ in range(5))
    assert html_density.main_text(f"<div>{text}</div><div>{cards}</div>") == " ".join([(_LINE * 4).strip()] * 5)


@pytest.mark.parametrize("start", ["<div>" * 40_000, "<p><table>" + "<div>" * 40_000, "<ul>" + "<li><div>" * 20_000, "<p>" + "<table><tr><td>" * 13_000])
def test_deep_pages_take_linear_time(start):
    import time

    begin = time.monotonic()
    assert html_density.main_text(start + _LINE) == _LINE.strip()
    assert time.monotonic() - begin < 20


@pytest.mark.parametrize("block", [1, 2, 3, 512])
def test_marginals_as_brute_force(block):
    rng = np.random.default_rng(2)
    emission, moves, begins = rng.normal(size=17), rng.normal(size=(2, 2)), np.array([0, 4, 5, 9, 17])
    good, pairs = line_crf.label_pairs(emission, begins, moves, block)
    assert np.array_equal(good, line_crf.marginals(emission, begins, moves, block))
    want_pairs = np.zeros((2, 2))
    for a, b in zip(begins, begins[1:]):
        total, hits, mine = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            weight = np.exp(sum(emission[a + k] * v for k, v in enumerate(y)) + sum(moves[u, v] for u, v in zip(y, y[1:])))
            total += weight
            hits += weight * np.array(y)
            for u, v in zip(y, y[1:]):
                mine[u, v] += weight
        assert np.allclose(good[a:b], hits / total)
        want_pairs += mine / total
    assert np.allclose(pairs, want_pairs)


def test_emissions_from_own_features_as_from_all():
    rng = np.random.default_rng(3)
    own, begins = rng.normal(size=(12, line_crf.N_OWN)).astype(np.float32), np.array([0, 1, 5, 12])
    size = 3 * line_crf.N_OWN + 2
    model = line_crf.Model(rng.normal(size=size), rng.uniform(0.5, 2, size), rng.normal(size=size), 0.3, np.zeros((2, 2)))
    want = ((line_crf.line_features(own, begins) - model.mean) / model.scale) @ model.weights + model.bias
    assert np.allclose(model.emissions(own, begins), want, atol=1e-5)


def test_many_short_lines_take_few_steps():
    """A text of half a million lines is one chain; it is gone through in blocks."""
    import time

    size = 3 * line_crf.N_OWN + 2
    model = line_crf.Model(np.zeros(size), np.ones(size), np.full(size, 0.01), 0.1, np.array([[0.5, -0.5], [-0.5, 0.5]]))
    text, tables = b"a b\n" * 500_000, bytescan._tables(True)
    start = time.monotonic()
    own, length, begins = line_crf.own_features([text], tables)
    odds = line_crf.document_odds(model, own, length, begins)
    assert len(own) == 500_001 and np.isfinite(odds).all() and time.monotonic() - start < 20


def test_executors_need_no_copy_of_the_package(folder, tmp_path):
    """The queries run where only the driver knows the package: workers start in another folder, without its path."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        f"sys.path.append({root!r})\n"
        "from tradepanel.llm import entries\n"
        "for name in ('op9_line_crf', 'op8_html_density', 'op13_url_filter', 'op12_spelling_variants', 'op11_collocations'):\n"
        f"    assert entries.RUNNERS[name](spark, {folder!r}).count() >= 0\n"
        "try:\n"
        "    spark.range(1).mapInArrow(lambda b: [__import__('tradepanel')] and b, 'id long').count()\n"
        "except Exception as e:\n"
        "    assert 'ModuleNotFoundError' in str(e)\n"
        "else:\n"
        "    raise SystemExit('workers know the package, so this shows nothing')\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.samefile(p, root))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]


def test_classifier_on_held_out_rows(spark, folder, odd, empty):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = line_crf.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    rows = line_crf.classify(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert line_crf.classify(empty, labels).count() == 0
    none = line_crf.score(odd, line_crf.train(odd, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5} and none.columns == [*[c for c in odd.columns if c != "score"], "score"]


def test_vectors_as_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    near = np.repeat(base[:10], 9, 0) + rng.normal(size=(90, 24)) * 0.12
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near, base[:5], base[:5] * 3]))]
    odd = [(900, None), (901, [0.0] * 24), (902, [1.0, None]), (903, [float("nan"), 1.0]), (904, []), (905, [1.0, 2.0]), (905, [1.0, 2.0]), (None, [2.0, 4.0]), (906, [1e200, -1e200])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, n_links int").repartition(3)
    got = {r.vec_id: r for r in cross_polytope.near_duplicates(df, block=16).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.9
    component = np.arange(len(x))
    for _ in range(len(x)):
        component = np.where(close, component[None, :], len(x)).min(1)
    assert [got[i].n_links for i, _ in rows] == (close.sum(1) - 1).tolist()
    assert [got[i].component_id for i, _ in rows] == component.tolist()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903, 904))
    assert (got[905].n_links, got[905].component_id, got[None].n_links, got[None].component_id) == (2, 905, 2, 905)
    assert got[906].n_links == 0
    assert cross_polytope.near_duplicates(df.limit(0)).count() == 0


# ------------------------------------------------------------------ rules


def _base(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, x in enumerate(zip(words, words[1:], words[2:])) if windows[x] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_rules_on_odd_rows(spark, odd, empty):
    more = [(20 + i, t, "en", None, None, None, None) for i, t in enumerate(["a b c a b c\nx\nx\n\n x", "the | of & and $ " * 30, " ".join(f"w{i}" for i in range(60)), "a a a a"])]
    df = odd.union(spark.createDataFrame(more, DOCS))
    got = quality_rules.quality_rules(df)
    assert set(odd.columns) - set(got.columns) == {"N_WORDS"}
    rows = got.collect()
    want = sorted(((str(r[0]), *_base(r[1])) for r in ODD + more), key=str)
    have = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert sorted(have, key=str) == want
    assert not any(r.kept for r in rows if r.base_failed)
    assert quality_rules.quality_rules(empty).count() == 0


def test_distance_of_histograms(spark):
    rows = [([1, 1], [2, 2]), ([1, 0], [0, 5]), ([0, 0], [1, 1]), ([3, 1], [1, 1])]
    got = [r[0] for r in spark.createDataFrame(rows, "a array<long>, b array<long>").select(quality_rules.distance("a", "b")).collect()]
    p, q = np.array([0.75, 0.25]), np.array([0.5, 0.5])
    m = (p + q) / 2
    js = np.sqrt((p * np.log2(p / m) + q * np.log2(q / m)).sum() / 2)
    assert got[0] == 0 and got[1] == pytest.approx(1) and got[2] is None and got[3] == pytest.approx(js)


@pytest.mark.parametrize("words", [1, 64, 1 << 20])
def test_sieve_divides_rows_and_misses_no_key(spark, words):
    from tradepanel.llm.common import sieved

    rows = spark.range(3000).select(F.xxhash64("id").alias("key"), F.col("id").alias("v"))
    keys = rows.where("v % 7 = 0").select("key")
    clear, met = sieved(rows, keys, "key", words)
    a, b = {r["v"] for r in clear.collect()}, {r["v"] for r in met.collect()}
    assert clear.count() + met.count() == 3000 and a | b == set(range(3000)) and not a & b
    assert b >= set(range(0, 3000, 7)) and (words < 64 or len(b) < 1200)


def test_only_needed_texts_are_read_again(spark):
    """Rows outside the sieve meet no join; repeated rows stand once; a row whose set is another one is left out."""
    rows = spark.createDataFrame([(i, f"a b c d e f text {i % 40}") for i in range(50)] + [(3, "a b c d e f text 3")], "doc_id long, text string")
    rows = rows.withColumn("key", jaccard_join.text_key(F.col("doc_id"), F.col("text")))
    first = jaccard_join.members(rows, 5).where("set_id is not null")
    one = first.where("doc_id in (3, 7)").groupBy("set_id", "n", "key").agg(F.count(F.lit(1)).alias("copies"))
    one = one.select("key", "set_id", "n", F.lit(1).cast("long").alias("cluster"), F.lit(1).alias("blocks"), F.lit(True).alias("paired"), "copies")
    texts = jaccard_join.full_texts(rows, one)
    assert sorted(r["text"][-1] for r in texts.collect()) == ["3", "7"]
    assert jaccard_join.paired_sets(texts, 5).count() == 2
    assert jaccard_join.paired_sets(texts.withColumn("set_id", F.col("set_id") + 1), 5).count() == 0


def test_frequent_shingles_are_found_in_portions(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three four five six {i}", i) for i in range(30)], "doc_id long, text string, key long").coalesce(1)
    found = jaccard_join.members(docs, 5).where("shingle is not null").agg(F.sum("count")).first()[0]
    assert found == 60  # two shingles that all have
