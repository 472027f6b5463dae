"""Decontamination, token files, page text, mixing and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import elias_fano
from quire.llm.decontaminate import Finder, drop_contaminated, find_items, nearest, normal, pieces
from quire.llm.html_text import extract_text, main_text
from quire.llm.mixing import keep_mix, select_mix
from quire.llm.token_files import FILE_SCHEMA, Coder, read_tokens, token_at, write_tokens

settings.register_profile("slow machine", deadline=None)
settings.load_profile("slow machine")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def edits_to_end(pattern, text):
    """Edit distance of ``pattern`` to the nearest string that ends at each place of ``text``."""
    last = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (c != d)))
        last = now
    return last


@given(st.text("abc", min_size=1, max_size=80), st.text("abcd", max_size=60), st.integers(0, 20))
def test_bit_parallel_distance(pattern, text, errors):
    want = edits_to_end(pattern, text)
    assert nearest(pattern, text, errors) == [(j, want[j]) for j in range(1, len(text) + 1) if want[j] <= errors]


@given(st.text("ab", min_size=1, max_size=50), st.integers(0, 49))
def test_pieces_make_up_the_item(item, errors):
    parts = pieces(item, min(errors, len(item) - 1))
    assert "".join(p for _, p in parts) == item and len(parts) == min(errors, len(item) - 1) + 1
    assert all(item[a:a + len(p)] == p for a, p in parts)


def test_items_found(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(300)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(12, 40))).capitalize()) for i in range(12)] + [(12, None), (13, " "), (0, "short item text")]
    texts = []
    for i in range(60):
        text = rnd.choices(words, k=rnd.randint(0, 80))
        held = list(rnd.choice(items[:12])[1])
        for _ in range(rnd.randint(0, 14)):
            held[rnd.randrange(len(held))] = rnd.choice(["", "q", "xy"])
        text.insert(rnd.randint(0, len(text)), "".join(held).replace(" ", " \n") if i % 2 else "".join(held).upper())
        texts.append(" ".join(text))
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(60, None, "x"), (61, "", "x"), (None, texts[0], "x"), (0, texts[0], "x"), (62, "pad " * 5000 + items[3][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for key, text, _ in rows:
        for item, held in items:
            held, own = normal(held or ""), normal(text or "")
            if held and own:
                # the one far longer text has its item at the end
                cut = len(own) - 600 if len(own) > 5000 else 0
                low = edits_to_end(held, own[cut:])
                least = min(low[1:])
                if least <= int(len(held) * 0.05):
                    want.append((key, item, least, low[1:].index(least) + 1 + cut))
    got = [(r.doc_id, r.item_id, r.distance, r.end) for r in find_items(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 20
    clean = drop_contaminated(docs, bench)
    hit = {x[0] for x in want}
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((k for k, _, _ in rows if k not in hit), key=str)
    assert find_items(docs, bench.limit(0)).count() == 0 and drop_contaminated(docs, bench.limit(0)).count() == len(rows)
    assert find_items(docs.limit(0), bench).count() == 0


def test_items_in_parts(spark):
    docs = spark.createDataFrame([(1, "the first item here and the second item there")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "first item here"), (2, "second item there")], "item_id long, text string")
    spark.conf.set("quire.broadcast.maxBytes", "16")
    try:
        assert sorted(r.item_id for r in find_items(docs, bench).collect()) == [1, 2]
        assert drop_contaminated(docs, bench).count() == 0
    finally:
        spark.conf.unset("quire.broadcast.maxBytes")


def test_start_of_an_occurrence():
    assert Finder([(7, "abcdefghij klmnopqrst")], 0.1).find("xx ABCDEFGHIJ  kLmnopqrs t.") == [(7, 1, 3, 23)]


@given(st.lists(st.integers(0, 2**63), max_size=600), st.integers(0, 62))
def test_elias_fano_round_trip(values, shift):
    values = np.sort(np.array(values, dtype=np.uint64) >> np.uint64(shift))
    reader = elias_fano.Reader(elias_fano.encode(values))
    assert (reader.all() == values).all() and len(reader) == len(values)
    assert all(reader[i] == int(values[i]) for i in range(0, len(values), 37))


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 300))
    assert len(elias_fano.encode(values)) * 8 / 10_000 < 2 + np.log2(300) + 0.3
    with pytest.raises(IndexError):
        elias_fano.Reader(elias_fano.encode(values))[10_000]


ODD = ["", " ", "a  b", " a", "a ", "a\nb", "a \n b", "x<|endoftext|>y", "a　b c  d", "tab\tb c", "l1.\nl2 w\n\nz", "it's 12 ok\r\n no", "é ñ 医療 の", "a\x1cb c\x85 d", "\n", "w\n", "  x"]


@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=30), st.text("ab \n\t'1.", max_size=40)), min_size=1, max_size=6))
def test_coder_agrees_with_the_library(texts):
    import pyarrow as pa

    texts = [t for t in texts if t.isprintable() or t.encode("utf-8", "replace").decode() == t]
    want = [np.array(x.ids, "<u2").tobytes() for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert CODER.encode(pa.array(texts, pa.string())) == want


LIBRARY = Tokenizer.from_file(TOKENIZER)
CODER = Coder(TOKENIZER)


class Unwalked(dict):
    def keys(self):
        raise AssertionError("all that is remembered was walked through")

    __iter__ = items = values = keys


def test_coder_looks_up_what_it_remembers():
    """Work grows with the pieces of a chunk, not with those remembered from all chunks before."""
    import pyarrow as pa

    coder = Coder(TOKENIZER)
    coder.pieces, coder.after, coder.older = Unwalked(), Unwalked(), {"": Unwalked(old=b"\1\2"), " ": Unwalked()}
    texts = ["one two one", "two one\ntwo.\nthree four", "a  b", "", "four", "old"]
    want = [np.array(x.ids, "<u2").tobytes() for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    want[-1] = b"\1\2"
    assert coder.encode(pa.array(texts, pa.string())) == want == coder.encode(pa.array(texts, pa.string()))


@pytest.mark.parametrize("end", ["", ".", "***", "$$$", "_", "'", "'s", ",'", "9", "ª", "×", "ɐ", "\u0301", "\n", ".\nTzüch,"])
def test_coder_splits_marks_from_words(end):
    import pyarrow as pa

    texts = [f"{w}{end} {w}{end} x {w}" for w in ("word", "Éçtion", "Tzüchß", "ǅɏ", "don't", "l'été", "x1", "µ")]
    want = [np.array(x.ids, "<u2").tobytes() for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert Coder(TOKENIZER).encode(pa.array(texts, pa.string())) == want


def test_token_files(spark, tmp_path):
    rows = [(i * 7 % 31 - 5, t, "x") for i, t in enumerate(ODD)] + [(None, "first", "x"), (100, None, "x"), (100, "twice", "x"), (2**62, "far " * 9000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)
    path = str(tmp_path / "tokens")
    write_tokens(docs, path, TOKENIZER)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for key, text, _ in ordered:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    got = sorted((tuple(r) for r in read_tokens(spark, path, with_ids=True).collect()), key=lambda r: r[1])
    assert got == want
    files = spark.read.schema(FILE_SCHEMA).parquet(path).orderBy("file").collect()
    assert [token_at(f, i).tolist() for f in files for i in range(f.n_docs)] == [w[4] for w in want]
    write_tokens(docs.limit(0), str(tmp_path / "none"), TOKENIZER)
    assert read_tokens(spark, str(tmp_path / "none")).count() == 0


PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var x = "</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice"><p>We use cookies, and more cookies, as everyone does today.</p></div>{0}
<div id="comments"><p>Great post, really, I liked it very much, thanks a lot for this.</p></div>
<aside><p>Buy now, cheap, while it lasts, only today.</p></aside><footer>&copy; all</footer></body></html>"""


LONG = "<p>A long paragraph, with commas, and with words enough to make up a text of its own, as it is said here.</p>" * 3


@pytest.mark.parametrize("wrapper", [
    'class="site has-sidebar"', 'id="content" class="no-sidebar"', 'class="page with-nav"', 'class="layout nav-open"', 'class="related-work"', 'class="story share-enabled"',
])
def test_a_class_that_names_what_a_page_has(wrapper):
    """A part of a class doesn't empty a page, and elements within that are no text still go."""
    page = f'<html><body><div {wrapper}><div class="main-nav"><p>Home, news, about</p></div>{LONG}<div class="user-comments"><p>First, and well said!</p></div></div></body></html>'
    assert main_text(page) == " ".join(["A long paragraph, with commas, and with words enough to make up a text of its own, as it is said here."] * 3)


@pytest.mark.parametrize("wrapper", ['class="sidebar"', 'class="x menu"', 'class="post-comments"', 'role="complementary"'])
def test_a_class_that_says_what_an_element_is(wrapper):
    assert main_text(f"<html><body><div {wrapper}>{LONG}</div></body></html>") == ""


def test_formulas_stay():
    page = f"<html><body><article><p>Energy is <math><mi>E</mi><annotation encoding='application/x-tex'>E_0</annotation></math> here.</p>{LONG}</article></body></html>"
    assert main_text(page).startswith("Energy is E here. A long")


@pytest.mark.parametrize("article, text", [
    ("<article><h1>Head</h1><p><b>One, two.<br><p>Three &lt;b&gt; four\n five,\t six.</article>", "Head One, two. Three <b> four five, six."),
    ("<div class='content'><h2>H</h2><p>A long paragraph, with commas, and words.</p><form><p>Your, mail, here</p><button>Go</button></form><ul><li>x<li>y</ul></div>", "H A long paragraph, with commas, and words. x y"),
    ("<main><p>in<i>line</i> text&nbsp;&eacute;&#233;</p><div class=ad>advert</div><table><tr><td>c1<td>c2</table></main>", "inline text éé c1 c2"),
    ("<div><p>First part, long enough, to count as text.</p></div>", "First part, long enough, to count as text."),
])
def test_main_text(article, text):
    assert main_text(PAGE.format(article)) == text


@given(st.text("<>/ap\"'=! b&;-", max_size=200))
def test_any_markup_is_read(page):
    assert isinstance(main_text(page), str)


def test_pages(spark):
    rows = [(1, "u", PAGE.format("<article><p>x</p></article>"), "z"), (1, "u", None, "z"), (None, None, "", "z"), (2, "u", "<p>" + "word " * 50_000, "z"), (3, "u", "<div>" * 5000 + "deep", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [tuple(r) for r in extract_text(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", "x", 1), (1, "u", "", 0), (None, None, "", 0), (2, "u", ("word " * 50_000).strip(), 249_999), (3, "u", "deep", 4)], key=str)
    assert extract_text(pages.limit(0)).count() == 0


def mixture(spark):
    rows = []
    for lang, source, n in (("en", "a", 40), ("en", "b", 5), ("de", "a", 10), ("de", None, 2), (None, "c", 8)):
        rows += [(len(rows) + i, "w " * (i % 7), lang, source, "x") for i in range(n)]
    rows += [(3, "same id", "en", "a", "x"), (None, "no id", "en", "a", "x"), (None, None, "en", "a", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, quota string").repartition(3)


def test_shortage_goes_to_siblings_first(spark):
    docs = mixture(spark)
    domain = F.when(F.col("lang") == "en", "x").otherwise("y")
    taken = select_mix(docs, {"x": 3, "y": 1, "x/en/a": 1, "x/en/b": 1}, domain, total=60)
    by = {(r.domain, r.lang, r.source): r.n for r in taken.groupBy("domain", "lang", "source").agg(F.sum("n_taken").alias("n")).collect()}
    # b has 10 tokens of its 22: the rest goes to a, not to y
    assert by["x", "en", "b"] == 10 and by["x", "en", "a"] == 35
    assert sum(v for k, v in by.items() if k[0] == "y") in (14, 15)
    everything = select_mix(docs, {}, domain, total=10**9)
    total = docs.select(F.sum(F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[^ \\t-\\r]+"), F.lit(0))))).first()[0]
    assert everything.agg(F.sum("n_taken")).first()[0] == total
    twice = select_mix(docs, {}, domain, total=10**9, max_epochs=2)
    assert twice.agg(F.sum("n_taken")).first()[0] == 2 * total and {r.epoch for r in twice.select("epoch").distinct().collect()} == {0, 1}
    assert select_mix(docs, {"x": 0, "y": 0}, domain, total=100).count() == 0
    assert select_mix(docs.limit(0), {}, domain).count() == 0


def test_mix_keeps_rows_whole(spark):
    docs = mixture(spark)
    kept = keep_mix(docs, {}, F.lit("web"), share=(1, 2))
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, sf)
        assert out.columns == columns, name
        assert out.count() <= seen.count() and out.join(seen, "doc_id", "left_anti").count() == 0
        seen = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, seen, sf).orderBy("start").collect()
    ids = [r.doc_id for r in sorted(seen.collect(), key=lambda r: r.doc_id)]
    assert [r.doc_id for r in last] == ids
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
    row = [(None, None, None, None, None), (1, "", "", "", 0)]
    odd = spark.createDataFrame(row, docs.schema)
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, odd, sf).count() == 2, name


def test_near_duplicates_of_rows_that_share_or_lack_an_id(spark):
    texts = [" ".join(f"{x}{i}" for i in range(30)) for x in "abcd"]
    rows = [(7, texts[0]), (7, texts[0]), (3, texts[1]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (9, texts[3]), (9, texts[0]), (11, None), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(3, texts[1]), (7, texts[0]), (9, texts[3]), (11, None), (11, None), (None, texts[2])]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
