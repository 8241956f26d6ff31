"""Learned operators, vectors and pages."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from operator import mul

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents
from pyspark.sql import functions as F

from civicspark.llm import exact_topk, html_extraction, language_id, toxicity

LANGUAGES = {
    "aa": "the of and in that was stone river mountain walking",
    "bb": "der die und ist nicht schloss brücke wasser gegangen",
    "cc": "le la et dans pour avec château rivière montagne été",
}


def spoken(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang].split()) for _ in range(n))


# Language identification --------------------------------------------------------------------


def test_languages_are_told_apart(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        lang = rng.choice(list(LANGUAGES))
        rows.append((i, spoken(rng, lang, rng.choice([15, 60, 400])), lang, "s", 0))
    rows += [(900, None, "aa", "s", 0), (901, "", "aa", "s", 0), (902, "12 !? ½", "bb", "s", 0),
             (903, "the river", None, "s", 0), (904, "the " * 100_000, "aa", "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    found = {r.doc_id: r for r in language_id.predictions(frame).collect()}
    assert len(found) == len(rows)
    for i, _, lang, _, _ in rows[:240]:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [i for i in range(240) if found[i].held_out]
    right = sum(found[i].lang_pred == rows[i][2] for i in held)
    assert len(held) > 30 and right >= 0.95 * len(held)
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in found.values())


def test_nothing_learned_names_nothing(spark):
    frame = documents(spark, ["the river", None]).withColumn("lang", F.lit(None).cast("string"))
    rows = language_id.predictions(frame).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert language_id.predictions(frame.limit(0)).count() == 0


def test_narrow_margins_are_rejected(spark):
    rng = random.Random(5)
    texts = [spoken(rng, lang, 80) for lang in LANGUAGES for _ in range(20)]
    frame = documents(spark, texts).withColumn(
        "lang", F.element_at(F.array(*map(F.lit, LANGUAGES)), (F.col("doc_id") / 20 + 1).cast("int"))
    )
    found, (language, nearest, _) = language_id.identify(frame, F.lit(True), min_margin=2.0)
    rows = found.collect()
    assert {r[language] for r in rows} == {"und"} and {r[nearest] for r in rows} == set(LANGUAGES)


# Toxicity -----------------------------------------------------------------------------------

WORDS = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("nt", "rl", "st", "ck")]
BAD = ["idiot", "moron", "scum"]


def labelled(spark, seed=1, n=400):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.choice([8, 30, 120]))]
        toxic = int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    return texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_toxic_texts_are_found(spark):
    texts, labels = labelled(spark)
    odd = [None, "", "... !!!", "fine " * 30_000]
    rows = toxicity.scores(documents(spark, texts + odd), labels).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + len(odd)
    held = [i for i in range(len(texts)) if found[i].held_out]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in found)
    for i in held:
        assert found[i].predicted == any(w in BAD for w in texts[i].split())
    assert not any(found[i].predicted for i in range(len(texts), len(found)))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_only_words_that_begin_as_a_rule_are_looked_up(monkeypatch):
    looked_up, rule_of = [], toxicity._rule_of
    monkeypatch.setattr(
        toxicity, "_rule_of", lambda word, rules: looked_up.append(word) or rule_of(word, rules)
    )
    # the last is an exception
    rules = {"mud": 0.9, "idio-": 0.8, "x": 0.7, "idiom": 0.0}
    score = toxicity.Model(rules, (1.0, -1.0), {}, {}).scorer()
    plain = " ".join(f"{a}{b}" for a in WORDS for b in WORDS)
    assert score(plain, 0) == score("", 0) == score(f"{plain} idiom", 0)
    assert looked_up == ["idiom"]
    for text in ("mud", "Idiots", "x"):
        assert score(f"{plain} {text}", 0) > score(plain, 0), text


def test_covered_words_are_those_with_a_rule():
    rules = {"mud": 0.9, "idio-": 0.8, "x": 0.7, "idiom": 0.0, "abc-": 0.6}
    words = ["mud", "muddy", "idio", "idiot", "idiom", "x", "xy", "abc", "abcd", "ab", "id"]
    wanted = {word for word in words if toxicity._rule_of(word, rules) is not None}
    assert toxicity._covered(rules)(words) == wanted == {"mud", "idiot", "idiom", "x", "abcd"}
    assert toxicity._smallest([]) == "" and toxicity._smallest([b"b"]) == str(zlib.crc32(b"b"))
    hashes = sorted(zlib.crc32(word.encode()) for word in words)
    assert toxicity._smallest([w.encode() for w in words]) == " ".join(map(str, hashes[:3]))


def test_disguised_words_are_restored(spark):
    texts, labels = labelled(spark)
    model = toxicity.fit(documents(spark, texts), labels, F.lit(True))
    score = model.scorer()
    for text in ("a 1d1ot here", "m0r0n", "you $cum", "i d i o t", "mooooron", "ID10T!!!"):
        kinds = int(toxicity.noise(pa.array([text]))[0])
        assert score(text, kinds) > 0.5, text
    for text in ("9c8b45435718dcc700c184a7", "a a a a", "best of%%% all***", "call 555-0199"):
        kinds = int(toxicity.noise(pa.array([text]))[0])
        assert score(text, kinds) < 0.5, text


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("St" + "Uu" * 30 + "pid", "stupid"), ("s t u p i d l y w r i t t e n b y m o r o n s", "morons"),
        ("4$$h0l3", "asshole"), ("1d107", "idiot"), ("a55", "ass"), ("idio7", "idiot"), ("455", "ass"),
        ("a$$.", "ass"), ("a s t u p i d", "stupid"), ("s t u p i d m o r o n", "moron"),
        ("s t u p 1 d", "stupid"), ("x/1d10t.html?page=" + "q" * 40, "idiot"),
        ("1d10t!!!", "idiot"), ("s\u00a0t", None), ("идиооооот", "идиот"), ("и д и о т", "идиот"),
    ],
)
def test_disguises_are_read(text, word):
    usual = ("a the by you written stupidly stupid morons moron asshole ass idiot идиот html page small x "
             "hello world").split()
    counts = Counter(dict.fromkeys(usual, 20))
    triples = Counter()
    for w, n in counts.items():
        triples.update(dict.fromkeys(toxicity._triples([w]), 0))
        for triple, m in toxicity._triples([w]).items():
            triples[triple] += n * m
    model = toxicity.CharacterModel(triples, counts)
    kinds = int(toxicity.noise(pa.array([text]))[0])
    found = toxicity.Decoder(model).restored(text, kinds)
    if word is None:
        assert not found
    else:
        assert word in found
        # a decoder that looks for this word only reads it the same way
        assert word in toxicity.Decoder(model, {word[:3]}).restored(text, kinds)
        assert toxicity.Decoder(model, {"jjj"}).restored(text, kinds) == set()


def test_noise_covers_what_the_regexes_find():
    rng = random.Random(8)
    pieces = ["a", "B", "s", "S", "Ж", "ж", "Σ", "ς", "σ", "é", "É", "İ", "ß", "語", "\U00020000", "0", "4", "$",
              "€", "*", "_", " ", " ", ".", "-", "\u00a0", "д", "д", "u", "U"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(20_000)]
    texts += ["StUuUuPid", "и д и о т", "η λ ι", "дурррак", "s t u", "xyz", "éÉé", "ςςΣ", "h€llo", None, ""]
    for text, kinds in zip(texts, toxicity.noise(pa.array(texts)), strict=True):
        low = (text or "").lower()
        if any(map(toxicity._DRAWN_OUT.search, low.split())):
            assert kinds & toxicity.DRAWN, text
        if toxicity._SPELLED_OUT.search(low):
            assert kinds & toxicity.SPELLED, text
        if any(len(t) > 1 for t in toxicity._SIGNED.findall(low)):
            assert kinds & toxicity.LEETSPEAK, text
    assert toxicity.noise(pa.array(["plain words, of few kinds - 1 or 2"]))[0] == 0
    assert toxicity.CharacterModel({}).restore("h€llo") == "hello"


def test_sample_of_one_class_or_none(spark):
    texts, labels = labelled(spark, n=30)
    frame = documents(spark, texts)
    for kept, wanted in (("toxic = 1", 1), ("toxic = 0", 0), ("false", 0)):
        rows = toxicity.scores(frame, labels.filter(kept)).collect()
        assert {r.predicted for r in rows} == {wanted}
    kept = toxicity.without_toxic(frame, labels.filter("false"))
    assert kept.columns == frame.columns and kept.count() == len(texts)


def test_every_labelled_row_is_learned_from(spark):
    """A word that only the last 40 texts hold, in an order by hash of the id, is learned as well."""
    n, place = 24_400, F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    ids = [row.id for row in spark.range(n).orderBy(place).collect()]
    last, rng = set(ids[-40:]), random.Random(3)
    texts, labels = [], []
    for i in range(n):
        toxic = i in last or rng.random() < 0.05
        words = [rng.choice(WORDS) for _ in range(4)] + ["common"]
        if toxic:
            words.append("scoundrel" if i in last else "moron")
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, texts), said, F.lit(True))
    assert model.words["common"] == n
    assert {"moron", "scoundrel"} <= set(model.rules)
    assert model.scorer()("common scoundrel", 0) > 0.5


def test_rows_without_a_label_are_passed_over(spark, monkeypatch):
    frame = spark.range(-3_000, 3_000).withColumnRenamed("id", "doc_id")
    marked = frame.filter("doc_id % 3 = 0")

    def passing(own, said=marked):
        place, bits = toxicity._marked_places(own, said)
        found = [r for r in own.select("doc_id", place.alias("at")).collect() if r["at"] is not None]
        return bits, {r["doc_id"] for r in found if bits[r["at"] >> 3] >> (r["at"] & 7) & 1}

    wanted = {r["doc_id"] for r in marked.collect()}
    bits, found = passing(frame)
    assert wanted <= found and len(found) < 2_400 and len(bits) == 4_096
    assert passing(frame, marked.limit(0))[1] == set()
    # ids of other types or that are equal without the same hash, and more labels than the bitmap is for
    assert len(passing(frame, marked.withColumn("doc_id", F.col("doc_id").cast("int")))[1]) == 6_000
    real = frame.withColumn("doc_id", F.col("doc_id").cast("double"))
    assert len(passing(real, real.filter("doc_id > 0"))[1]) == 6_000
    text = frame.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert len(passing(text, text.limit(1_000))[1]) < 1_500
    monkeypatch.setattr(toxicity, "_BITS_EACH", 1 << 10)
    assert len(passing(frame)[0]) == 262_144
    monkeypatch.setattr(toxicity, "_BITS_MOST", 1 << 15)
    bits, found = passing(frame)
    assert wanted <= found and len(bits) == 4_096


def test_the_bitmap_changes_nothing_learned(spark, monkeypatch):
    texts, labels = labelled(spark)
    frame = documents(spark, texts + ["idiot 1d1ot " + texts[0]] * 50)
    model = toxicity.fit(frame, labels, F.lit(True))
    all_pass = F.lit(0).cast("long"), np.full(1, 255, np.uint8)
    monkeypatch.setattr(toxicity, "_marked_places", lambda *_: all_pass)
    every = toxicity.fit(frame, labels, F.lit(True))
    assert (model.rules, model.curve) == (every.rules, every.curve) and model.rules
    assert (model.triples, model.words) == (every.triples, every.words)


# Exact top-k --------------------------------------------------------------------------------


def best(rows, k, every):
    usable = [
        (i, [int(np.floor(256 * np.float64(x))) for x in v])
        for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q is None or q % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, b, strict=True)), v is None, v or 0)
            for v, b in usable if v != q and len(a) == len(b)
        ]
        for rank, (score, none, v) in enumerate(sorted(scored)[:k], 1):
            out.append((q, rank, None if none else v, -score))
    return sorted(out)


@pytest.mark.parametrize("block", [3, 4096])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(exact_topk, "QUERIES", block)
    monkeypatch.setattr(exact_topk, "STEP", 16)
    monkeypatch.setattr(exact_topk, "HEAD", 7)
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * rng.choice([0.1, 1, 3])])
            for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(6)]  # ties
    rows += [(None, rows[5][1]), (301, None), (302, []), (303, [1.0, None] * 4),
             (304, [float("nan")] * 8), (305, [float("inf")] * 8), (310, [1.0, 2.0]), (311, [0.5, 1.0]),
             (320, [0.0] * 8), (7, rows[8][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = exact_topk.top_k(frame, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == best(rows, 5, 10)
    assert exact_topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


# Pages --------------------------------------------------------------------------------------


def text_of(page):
    return html_extraction.main_text(html_extraction.parse(page), set())


SCALED = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("step", [512, 2])
def test_top_k_of_large_components(spark, monkeypatch, step):
    """Any finite component takes part; what 64 bits cannot hold is the nearest that they can."""
    monkeypatch.setattr(exact_topk, "STEP", step)
    rng = random.Random(4)
    values = [300000.0, -262144.0, 2.0**40, -(2.0**50), 1e300, -1e300, 1.0, -0.5, 0.0]
    rows = [(50, [300000.0, 1.0]), (51, [300000.0, 1.0]), (52, [299999.5, 1.0])]
    rows += [(100 + i, [rng.choice(values), rng.choice(values)]) for i in range(60)]
    rows += [(200, [float("inf"), 1.0]), (201, [float("nan"), 1.0]), (202, [None, 1.0]), (203, None)]

    def whole(x):
        return max(-(2**63), min(2**63 - 1, math.floor(256 * x))) if abs(x) < 1e290 else (
            2**63 - 1 if x > 0 else -(2**63)
        )

    kept = [(i, [whole(x) for x in v]) for i, v in rows if i < 200]
    wanted = set()
    for query, own in kept:
        if query % 10 == 0:
            scores = sorted(
                (-max(-exact_topk.MOST, min(exact_topk.MOST, sum(map(mul, own, v)))), i)
                for i, v in kept if i != query
            )
            wanted |= {(query, r, i, -s) for r, (s, i) in enumerate(scores[:5], start=1)}
    frame = spark.createDataFrame(rows, SCALED)
    found = exact_topk.top_k(frame, F.col("vec_id") % 10 == 0).collect()
    assert {tuple(row) for row in found} == wanted


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b &amp; c&lt;&#33;", "a b & c<!"),
        ("<article><h1>T</h1><p><b>one<br>two<p>th<i>re</i>e</article><footer>f</footer>", "T one two three"),
        ("<nav>n</nav><div class='post-content'><ul><li>x<li>y</ul></div><aside>s</aside>", "x y"),
        ("<main><p>m</p><section class='user-comments'><p>c</p></section><form>f</form></main>", "m"),
        ("<article>a<script>if (1 < 2) '</article>'</script><style>p{}</style><!-- no --> b", "a b"),
        ("<div id=cookieNotice>n</div><div><p>long text of the page</p></div><div class=ad>x</div>",
         "long text of the page"),
        ("<article><p hidden>h</p><table><tr><td>1<td>2<tr><td>3</table></article", "1 2 3"),
        ("<p>a</b></div></p></p>b<unknown>c", "a b c"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>end</p>", "deep end"),
    ],
)
def test_main_text(page, text):
    assert text_of(page) == text


def test_aligned_trees():
    one = html_extraction.parse("<div><p>a</p><ul><li>1<li>2</ul><p>b</p></div>")
    two = html_extraction.parse("<div><h1>t</h1><p>a</p><ul><li>1<li>x<li>2</ul><p>c</p></div>")
    pairs = html_extraction.match(one, two)
    assert sorted(a.tag for a in pairs) == ["", "div", "li", "li", "p", "p", "ul"]
    assert all(a.tag == b.tag for a, b in pairs.items())


@pytest.mark.parametrize("table", [1 << 22, 4])
def test_long_lists_are_aligned_as_short_ones(monkeypatch, table):
    rng = random.Random(9)
    monkeypatch.setattr(html_extraction, "TABLE_PAIRS", table)

    def page(n):
        inner = ("", "<b>x</b>", "<i>y</i>", "<b>x<i>y</i></b><u>z</u>")
        return "".join(f"<{t}>{rng.choice(inner)}</{t}>" for t in rng.choices(["div", "h2", "ul"], k=n))

    for n in [1, 2, 5, 9] * 20:
        one, two = (html_extraction.parse(page(rng.randrange(n + 3))) for _ in range(2))
        monkeypatch.setattr(html_extraction, "MOST_PAIRS", 40_000)
        wanted = html_extraction.match(one, two)
        monkeypatch.setattr(html_extraction, "MOST_PAIRS", 0)
        found = html_extraction.match(one, two)
        assert len(found) == len(wanted)
        assert all(a.name == b.name for a, b in found.items())


def test_a_child_without_counterpart_does_not_end_a_long_list():
    rows = "".join(f"<div><b>{i}</b></div>" for i in range(1000))
    one = html_extraction.parse(f"<section><b>only here</b></section>{rows}<ul><li>end</ul>")
    two = html_extraction.parse(f"{rows}<ul><li>end</ul><section></section>")
    found = html_extraction.match(one, two)
    assert sum(a.tag == "div" for a in found) == 1000 and any(a.tag == "ul" for a in found)


def test_template_of_a_host_is_left_out(spark):
    rows = [
        (i, f"https://one.example/{i}",
         f"<body><div><p>Read all our reports today</p><p>Story {i} about item{i * 7} and more</p></div>")
        for i in range(8)
    ]
    rows += [(50, "https://two.example/a", rows[0][2]), (51, None, "<p>alone</p>"), (52, "x:y", None),
             (53, "https://one.example/copy", rows[3][2]), (54, "https://one.example/none", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in html_extraction.main_texts(frame).collect()}
    for i in range(8):
        assert found[i].text == f"Story {i} about item{i * 7} and more"
        assert found[i].n_chars == len(found[i].text)
    assert found[50].text.startswith("Read all our reports") and found[53].text == found[3].text
    assert (found[51].text, found[52].text, found[54].text) == ("alone", "", "")
    assert html_extraction.main_texts(frame.limit(0)).count() == 0


def test_near_copies_do_not_make_a_template(spark):
    body = " ".join(f"sentence{i}" for i in range(60))
    rows = [(i, f"https://h.example/{i}", f"<article><h1>News</h1><p>{body}</p><p>v{i}</p></article>")
            for i in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for row in html_extraction.main_texts(frame).collect():
        assert row.text == f"News {body} v{row.page_id}"
