"""Operators that look at one text at a time: rules, packing, quality, language, pages."""

from __future__ import annotations

import random
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
import zstandard

from cardwarden.llm import compression, language, packing, pages, quality, words
from cardwarden.llm.queries import QUERIES, tokenizer_path
from llm.conftest import prose
from pyspark.sql import functions as F

EDGES = [None, "", " \n\t ", "x", "é 日本 ü", "a\n\nb\na\n a", "#*$%&|<> <b>", "the " * 3000, prose(1, 4000)]


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def test_counts_equal_brute_force(documents):
    rnd = random.Random(5)
    texts = EDGES[:7] + ["the " * 300, prose(1, 300)]
    texts += ["".join(rnd.choice("ab \n#|é") for _ in range(rnd.randint(0, 120))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, "a b"), (3, "x"), (3, "x")]
    docs = documents(rows, "n_words ratio _x")
    found = compression.measure(docs.drop("n_words", "ratio"), ["doc_id"]).collect()
    assert len(found) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for (doc, text), r in zip(rows, found, strict=True):
        assert (r.doc_id, *(r[c] for c in names)) == (doc, *brute_counts(text)), text


def test_bands_reject_repetition_and_noise_and_keep_prose(documents):
    rnd = random.Random(2)
    vocabulary = [line for line in re.findall(r"[a-z]{3,}", random.__doc__ + zlib.__doc__ + re.__doc__)]
    plain = " ".join(rnd.choice(vocabulary) for _ in range(900))
    noise = " ".join("".join(chr(rnd.randrange(33, 127)) for _ in range(12)) for _ in range(400))
    # Repeats over distances that five-word windows do not see.
    wide = " ".join(f"{w} {i}" for i, w in enumerate(["the same words again and"] * 400))
    rows = [(1, plain), (2, noise), (3, wide), (4, plain + " " + "\x00" * 30_000)]
    found = {r.doc_id: r for r in compression.measure(documents(rows), ["doc_id"]).collect()}
    assert [found[i].kept for i in (1, 2, 3, 4)] == [True, False, False, False]
    text = plain.encode()
    assert found[1].ratio == len(zstandard.ZstdCompressor(level=3).compress(text)) / len(text)


def test_bands_read_short_texts_and_last_bytes(documents):
    rnd = random.Random(3)
    vocabulary = re.findall(r"[a-z]{3,}", random.__doc__ + zlib.__doc__ + re.__doc__)
    plain = " ".join(rnd.choice(vocabulary) for _ in range(900))
    # No window of five words comes twice, but there is little in it.
    little = " ".join("a" * i for i in range(1, 90))
    rows = [
        (1, plain[:150]), (2, little[:150]),
        (3, plain[:400]), (4, plain[:240] + little[-160:]),
        (5, plain[:1500]), (6, plain[:1100] + little[-400:]),
        (7, plain[:4096]), (8, plain[:4096] + " " + little[-1800:]),
        (9, plain[:40]), (10, " ".join("ab" * i for i in range(1, 6))),
    ]
    found = {r.doc_id: r for r in compression.measure(documents(rows), ["doc_id"]).collect()}
    # Ten words at least are a base rule, which row 9 and 10 fail.
    assert [i for i in sorted(found) if found[i].kept] == [1, 3, 5, 7]
    assert found[2].n_words >= 10 and not found[2].base_failed
    assert found[8].n_chunks_outside == 1 and found[8].ratio > 0.25
    assert found[6].n_chunks_outside == 1 and found[4].n_chunks_outside >= 1

    packer, bands = zstandard.ZstdCompressor(level=3), compression.Bands()
    for doc, text in rows:
        raw = text.encode()
        line = [x for x in bands.chunks if len(raw) >= x[0]][-1:]
        want = 0
        for _, size, low, high in line:
            parts = [raw[i : i + size] for i in range(0, len(raw), size)]
            parts[-1] = raw[-size:]
            want += sum(not low <= len(packer.compress(x)) / size <= high for x in parts)
        assert found[doc].n_chunks_outside == want


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pack_is_an_exact_round_trip(documents, tokenizer):
    texts = EDGES + ["it's  two spaces \n here", "<|endoftext|> ok", "x <|endoftext|>. y<|endoftext|>z", "a\x00b c", "Wörter, ñandú... (x) 12.5%\nNext"]
    rows = list(enumerate(texts)) + [(None, "a"), (0, None)]
    found = packing.pack(documents(rows, "start ids bucket"), tokenizer_path(), ["doc_id"]).collect()
    assert len({r.sequence_id for r in found}) == len(found)
    for doc, text in enumerate(texts):
        pieces = sorted((r for r in found if r.doc_id == doc), key=lambda r: r.start)[:: 2 if doc == 0 else 1]
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        assert [i for r in pieces for i in r.ids] == want
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        for r in pieces:
            assert r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
            assert r.length == 1 << r.bucket and r.sequence_id >> 58 == r.bucket
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            assert r.doc_tokens == len(want)


@pytest.mark.parametrize("n", [1, 2, 2047, 2048, 2049, 5000])
def test_lengths_are_contexts_and_binary_powers(n):
    lengths = packing.piece_lengths(n)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    rest = [x for x in lengths if x < 2048]
    assert len(set(rest)) == len(rest)


def test_context_must_be_a_power_of_two(documents):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(documents([]), tokenizer_path(), ["doc_id"], context=1000)


def test_forgetting_words_changes_no_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encode = packing._Encoder(tokenizer_path())
    texts = ["one two three four", "five. six, seven", "one two. six"]
    for text in texts * 2:
        (ids,) = encode([text])
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_quality_on_held_out_rows(spark):
    """On the small tables: the labelled rows that training never saw."""
    d = "/root/testdata/sf0.01"
    found = QUERIES["op7_quality_ftrl"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rows = found.where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_of_edges_and_without_labels(spark, documents):
    docs = documents([(i, t) for i, t in enumerate(EDGES)] + [(None, "a"), (3, "x")], "score label")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, label int")
    model = quality.fit(docs.select("doc_id", "text"), none)
    scores = [r.score for r in quality.score(docs, model, ["doc_id"]).collect()]
    assert scores == [0.5] * (len(EDGES) + 2)
    some = spark.createDataFrame([(8, 1), (7, 0), (1, 0)], "doc_id long, label int")
    model = quality.fit(docs.select("doc_id", "text"), some)
    by_id = {r.doc_id: r.score for r in quality.score(docs, model, ["doc_id"]).collect()}
    assert by_id[8] > by_id[0] > by_id[7] and by_id[0] == by_id[1] == by_id[2]
    assert quality.score(documents([]), model, ["doc_id"]).count() == 0


def test_scores_equal_a_plain_dot_product(documents):
    rnd = np.random.default_rng(1)
    model = quality.Model(rnd.standard_normal(1 << quality.BITS).astype(np.float32), 0.25)
    text = "One two two\nThree, 4 é É"
    (w,) = words.slices(documents([(1, text)]).toArrow()["text"])
    _, number = quality.features(w)
    n = len(text.split())
    assert len(number) == 2 * n + 2 * (n - 1)
    margin = float(np.mean(model.weights[number].astype(np.float64)) * quality.MASS + model.bias)
    (row,) = quality.score(documents([(1, text)]), model, ["doc_id"]).collect()
    assert row.score == pytest.approx(1 / (1 + np.exp(-margin)))


EN = "the and of to in that was with for this are from which have not"
FR = "les des une dans pour que qui est sur avec pas être plus nous vous"


def spoken_rows():
    rnd = random.Random(3)
    say = lambda words, n: " ".join(rnd.choice(words.split()) for _ in range(n))
    rows = [(i, say(EN, 40), "en", "a.example.com") for i in range(40)]
    rows += [(100 + i, say(FR, 40), "fr-FR", "b.example.org") for i in range(40)]
    return rows


def test_languages_by_all_evidence(documents):
    rows = spoken_rows()
    rows += [(200, " ".join([FR] * 3), "en", None), (201, None, "fr", "b.example.org"), (202, "12 %", "en", None)]
    rows += [(203, "pour", None, "b.example.org"), (204, "on", None, "a.example.com"), (205, "on", None, "b.example.org")]
    docs = documents(rows, "p log language declared")
    found = {r.doc_id: r for r in language.identify(
        docs, ["doc_id"], F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source")
    ).collect()}
    assert len(found) == len(rows)
    assert all(found[i].language == ("en" if i < 100 else "fr") for i, *_ in rows[:80])
    assert found[200].language == "fr" and found[200].kept  # text outweighs the markup
    assert not found[201].kept and found[201].language is None and not found[202].kept
    assert found[203].language == "fr"
    # The same short text goes with its host.
    assert (found[204].language, found[205].language) == ("en", "fr")


FI = "hän että mutta joka sitten kuin myös vielä koska niin ovat heidän täällä yhtään"


@pytest.mark.parametrize("n", [3, 9])
def test_a_rare_language_keeps_its_name(documents, n):
    """Below the share of 1%, with too few letters to be learned and with enough."""
    rnd = random.Random(4)
    rows = spoken_rows() * 14
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    finnish = lambda: " ".join(rnd.choice(FI.split()) for _ in range(100))
    rows += [(2000 + i, finnish(), "fi", "a.example.com") for i in range(n)]
    rows += [(2100, finnish(), None, "a.example.com"), (2101, finnish(), "en", "a.example.com")]
    docs = documents(rows)
    lang = {r.doc_id: r.lang for r in language.spoken(docs).collect()}
    assert all(lang[2000 + i] == "fi" for i in range(n))
    assert (lang.get(2100), lang[2101]) == (("fi", "fi") if n == 9 else (None, "en"))
    assert all(lang[i] == ("en" if r[2] == "en" else "fr") for i, r in enumerate(rows[:1120]))
    model = language.fit(docs.select("text", language.tag(F.col("lang")).alias("declared")))
    assert model.languages == (["en", "fi", "fr"] if n == 9 else ["en", "fr"])


def test_tags_beyond_the_models_bound_keep_their_name(documents, monkeypatch):
    """The model has the languages with the most letters; junk tags stay out and stay."""
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = spoken_rows()
    junk = [(300 + i, f"{FI} " * 40, f"junk{chr(97 + i)}", "c.example.net") for i in range(6)]
    docs = documents(rows + junk)
    model = language.fit(docs.select("text", language.tag(F.col("lang")).alias("declared")))
    assert model.languages == ["en", "fr"]
    lang = {r.doc_id: r.lang for r in language.spoken(docs).collect()}
    assert all(lang[i] == tag for i, _, tag, _ in junk)
    assert all(lang[r[0]] == ("en" if r[2] == "en" else "fr") for r in rows)


def test_language_posterior_equals_bayes_by_hand(documents):
    """One row's fusion, recomputed from the stored text likelihoods."""
    rows = spoken_rows()
    docs = documents(rows)
    texts = docs.select("doc_id", "text", language.tag(F.col("lang")).alias("declared"), F.col("source").alias("host"))
    model = language.fit(texts)
    read = language.read_texts(texts, model, ["doc_id", "declared", "host"]).collect()
    log = {r.doc_id: np.array(r.log) * language.TEMPER for r in read}
    soft = {i: np.exp(x - x.max()) / np.exp(x - x.max()).sum() for i, x in log.items()}
    total = sum(soft.values())
    i, s, n = 5, language.SMOOTHING, 2
    by = lambda k, v: sum((soft[r[0]] for r in rows if r[k] == v and r[0] != i), np.zeros(2))
    level0 = (total + s) / (total.sum() + n * s)
    host = by(3, "a.example.com")  # the domain example.com has this host only
    domain = (host + language.DOMAIN_ROWS * level0) / (host.sum() + language.DOMAIN_ROWS)
    prior = (host + language.HOST_ROWS * domain) / (host.sum() + language.HOST_ROWS)
    score = log[i] + np.log(prior) + np.log((by(2, "en") + s) / (total + 2 * s))
    want = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
    none = F.lit(None).cast("string")
    found = language.identify(docs, ["doc_id"], F.col("text"), F.col("lang"), none, F.col("source"))
    (row,) = found.where("doc_id = 5").collect()
    assert row.posterior == pytest.approx(want.max())


def test_language_without_rows_or_tags(documents):
    none = F.lit(None).cast("string")
    for rows in ([], [(1, "abc", None, "x"), (2, None, "", None)]):
        docs = documents(rows)
        found = language.identify(docs, ["doc_id"], F.col("text"), F.col("lang"), none, none).collect()
        assert len(found) == len(rows) and not any(r.kept for r in found)
    docs = documents(spoken_rows() + [(300, "7", "en", None), (301, FR, "en", None)], "t1 kept language on0")
    kept = language.spoken(docs)
    assert kept.columns == docs.columns
    lang = {r.doc_id: r.lang for r in kept.collect()}
    assert 300 not in lang and lang[301] == "fr" and len(lang) == 81


PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; x</title><style>p{}</style>
<script>var a="</p><p>no";</script></head><body><header><a href="/">Site</a></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="wrap"><!-- x > y --><%s><h1>Title &lt;1&gt;</h1><p>First  <b>bold</b>
 text&nbsp;here &eacute;<br>more<p>Second para<div class="ad">Buy</div><ul><li>one<li>two</ul>
<aside>Aside</aside><form><input name=q>Form</form></%s></div><div class="sidebar"><p>Side</p></div>
<section class="comments"><p>Nice!</p></section><footer>&copy; me</footer></body></html>"""
MAIN = "Title <1>\nFirst bold text here é more\nSecond para\none\ntwo"


@pytest.mark.parametrize("tag", ["article", "main", "div class='post-12'", "section"])
def test_main_text_of_a_page(spark, tag):
    html = PAGE % (tag, tag.split()[0])
    rows = [(i, f"http://h{i % 2}.example.com/x/{i}", html) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = pages.extract(df, ["page_id", "url"]).collect()
    assert [r.text for r in found] == [MAIN] * 4 and all(r.n_chars == len(MAIN) for r in found)


def test_a_hosts_path_is_taken_where_it_holds_most_of_the_page(spark):
    usual = "<body><div class='text'><p>%s</p></div><div class='more'><p>%s</p></div></body>"
    link = "<a href='/'>more of this</a>"
    rows = [(i, "http://one.example.com/", usual % (prose(i, 60), link)) for i in range(9)]
    rows.append((9, "HTTP://one.Example.com:80/q", usual % ("the short text", prose(99, 80))))
    rows.append((10, None, usual % ("the short text", prose(99, 80))))
    rows.append((11, "http://one.example.com/x", usual % (prose(98, 60), "few words")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.extract(df, ["page_id"]).collect()}
    assert found[0] == prose(0, 60)
    assert found[9] == found[10] == "the short text\n" + prose(99, 80)
    assert found[11] == prose(98, 60) + "\nfew words"


FEW, MANY = "few words of it", "<p>" + " ".join(f"word{i}" for i in range(80)) + "</p>"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (f"<form action=x><input name=a><h1>T</h1>{MANY}<button>Go</button></form>", f"T\n{MANY[3:-4]}"),
        (f"<div class='legal-text'><article><h1>T</h1>{MANY}</article></div>", f"T\n{MANY[3:-4]}"),
        (f"<section class='entry share'>{MANY}</section><nav>Menu</nav>", MANY[3:-4]),
        (f"<div class='lead'><p>{FEW}</p></div><div class='text'>{MANY}</div>", f"{FEW}\n{MANY[3:-4]}"),
        (f"<div class='text'>{MANY}</div><ul><li>one<li>two</ul>", f"{MANY[3:-4]}\none\ntwo"),
        (f"<article><p>{FEW}</p></article><div class='comments'><article>{MANY}</article></div>", FEW),
        (f"<div><p>{FEW}</p></div><div class='cookie-notice'>{MANY}</div>", FEW),
        (f"<header><h1>Site</h1></header><div>{MANY}</div><form><label>x</label><input></form>", MANY[3:-4]),
        (f"<div><p>{FEW}</p></div><form>{'<input><p>Your name</p>' * 9}</form>", FEW),
        ("<p>one<span class='ad'>buy</span> two</p>", "one two"),
        (f"<p>one<span class='widget'>never <b>closed</p><p>{FEW}</p>", f"one\n{FEW}"),
        (f"<span class='share'><h1>T</h1>{MANY}</span><p>x</p>", f"T\n{MANY[3:-4]}\nx"),
    ],
)
def test_a_name_alone_removes_no_text(spark, body, want):
    rows = [(i, "http://a.example.com/", f"<html><body>{body}</body></html>") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r.text for r in pages.extract(df, ["page_id"]).collect()] == [want] * 2


def test_columns_of_the_same_names_long_pages_and_tied_votes(spark):
    names = "html string, host string, text string, path string, winners string, k0 long, url string"
    long = "".join(f"<p>{prose(i, 50)}</p>" for i in range(4000))
    shell = "<body><div class='%s'>%s</div><a href='/'>menu</a></body>"
    rows = [(shell % (c, long), "h", "t", "p", "w", i, "http://h.example.com/") for i, c in enumerate("abab")]
    found = pages.extract(spark.createDataFrame(rows, names), ["k0", "winners"]).collect()
    want = "\n".join(prose(i, 50) for i in range(4000))
    assert all(r.text == want and r.winners == "w" and r.n_chars == len(want) for r in found)


class _Article(HTMLParser):
    """Text of a page's article, by another parser: blocks, and what stands in aside."""

    def __init__(self, html: str) -> None:
        super().__init__()
        self.open, self.skip, self.text = 0, 0, ""
        self.feed(html)
        self.close()

    def _edge(self, tag: str, by: int) -> None:
        self.open += by * (tag == "article")
        self.skip = max(0, self.skip + by * (tag in ("script", "style", "aside", "form", "nav")))
        if tag == "br":
            self.text += " "
        elif tag in ("article", "p", "h1", "h2", "h3", "ul", "ol", "li", "div", "table", "tr", "td", "section"):
            self.text += "\x00"

    def handle_starttag(self, tag, attrs):
        self._edge(tag, 1)

    def handle_endtag(self, tag):
        self._edge(tag, -1)

    def handle_data(self, data):
        self.text += data if self.open and not self.skip else ""

    def blocks(self) -> str:
        return "\n".join(" ".join(x.split()) for x in self.text.split("\x00") if x.strip())


def test_articles_of_the_given_pages_by_another_parser(spark):
    """Every given page with one article: the operator and a plain parser read the same."""
    found = QUERIES["op4_consensus_extract"](spark, "/root/testdata/sf0.01").collect()
    html = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    want = {r.page_id: _Article(r.html).blocks() for r in html if r.html and r.html.count("<article") == 1}
    same = [r.text == want[r.page_id] for r in found if r.page_id in want]
    assert len(same) > 100 and all(same)


@pytest.mark.parametrize("part", ["div class='body'", "section", "ul", "table", "ol"])
@pytest.mark.parametrize("around", ["article", "div class='post'"])
def test_a_title_and_lead_beside_most_of_the_text_stay(spark, part, around):
    """Also on a host whose other pages have nothing beside the inner container."""
    inner = f"<{part}>{{}}</{part.split()[0]}></{around.split()[0]}><div class='links'><a href='/'>{prose(7, 30)}</a></div>"
    head = f"<body><{around}><h1>T</h1><p>lead {prose(2, 20)}</p>"
    html = head + inner.format(prose(1, 60))
    bare = f"<body><{around}>" + inner.format(prose(3, 60))
    rows = [(i, "http://a.example.com/", html) for i in range(3)]
    rows += [(3 + i, "http://b.example.com/", bare) for i in range(4)] + [(7, "http://b.example.com/", html)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = "\n".join(["T", f"lead {prose(2, 20)}", prose(1, 60)])
    found = {r.page_id: r.text for r in pages.extract(df, ["page_id"]).collect()}
    assert all(found[i] == (prose(3, 60) if 2 < i < 7 else want) for i in range(8))


def test_pages_of_nothing(spark):
    rows = [(1, "u", None), (2, "", ""), (3, None, "plain words"), (4, "http://x/", "<nav>only</nav>"),
            (5, "http://x/", "<p>open <b>and <i>broken</p></div></x> end"), (None, "http://x/", "<p>a"),
            (7, "http://x/", "<" * 50 + "a 'b\" <p title='x>y'>t</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.extract(df, ["page_id"]).collect()}
    assert [found[i] for i in (1, 2, 3, 4)] == ["", "", "plain words", ""]
    assert found[5] == "open and broken\nend" and found[None] == "a" and found[7].endswith("t")
    assert pages.extract(df.limit(0), ["page_id"]).count() == 0
