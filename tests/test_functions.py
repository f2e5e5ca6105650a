"""Boundary rows of the text, label and lexicon functions."""

from __future__ import annotations

import hashlib
import tracemalloc
import unicodedata

import random

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinara.functions import labels, lexicon, text
from opinara.functions.lexicon import SentimentLexicon, TopicTable


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def column(spark, texts, build):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r[1] for r in df.select("i", build(F.col("t"))).orderBy("i").collect()]


def test_validity_bounds(spark):
    rows = [("abc", "x" * 11), ("abcd", "x" * 10), ("abcd", "x" * 11), (" abc ", "x" * 20), (None, "x" * 20)]
    got = values(spark, rows, "t string, c string", text.is_valid(F.col("t"), F.col("c")))
    assert got == [(False,), (False,), (True,), (False,), (False,)]


def test_reject_reasons(spark):
    rows = [
        ("good title", "long enough text", "u"), ("", "long enough text", "u"), ("title", "  ", "u"), ("abc", "long enough text", "u"),
        ("title", "short", "u"), ("", "", "u"),
    ]
    got = values(spark, rows, "t string, c string, u string", text.reject_reason(F.col("t"), F.col("c"), F.col("u")))
    assert [g[0] for g in got] == [None, "empty_title", "empty_content", "title_too_short", "content_too_short", "empty_title"]


def test_fingerprint(spark):
    rows = [("Été", "Chaud"), ("ÉTÉ", "CHAUD"), ("Ete", "Chaud")]
    got = [g[0] for g in values(spark, rows, "t string, c string", text.fingerprint(F.col("t"), F.col("c")))]
    assert got[0] == got[1] != got[2]
    assert got[0] == hashlib.sha256("été|chaud".encode()).hexdigest()


def python_sanitized(t):
    kept = "".join(c for c in t.replace("﻿", "") if ord(c) >= 32 or c in "\t\n\r").replace("�", "")
    return unicodedata.normalize("NFC", kept).strip()


SAMPLES = [
    "", " a ", " x ", "été", "﻿a\x00b\x07c", "tab\tline\nfeed", "�z", "가각", "\x1fa\x1f", "ạ́", "ﬁn", "\x85x",
]


def test_sanitize_samples(spark):
    assert column(spark, SAMPLES, text.sanitize_text) == [python_sanitized(t) for t in SAMPLES]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=30), min_size=40, max_size=60))
def test_sanitize_and_spaces_like_python(spark, texts):
    assert column(spark, texts, text.sanitize_text) == [python_sanitized(t) for t in texts]
    assert column(spark, texts, text.normalize_ws) == [" ".join(t.split()) for t in texts]
    assert column(spark, texts, text.strip) == [t.strip() for t in texts]


def test_html(spark):
    pages = ["<p>a</p>", "a<b>b</b>c", "<p>caf&eacute; &amp; th&eacute;</p><script>x<y</script><!-- no --><style>p{}</style>", "plain text", "1 < 2 & 3", None]
    got = column(spark, pages, lambda c: text.normalize_ws(text.clean_html(c)))
    assert got == ["a", "a b c", "café & thé", "plain text", "1 < 2 & 3", ""]


def test_html_keeps_short_text(spark):
    assert column(spark, ["<a>", " x "], text.clean_html) == ["<a>", " x "]


def test_repetition(spark):
    texts = ["a a a a a a a a a b", "a b c a a a a a a a", ""]
    assert column(spark, texts, text.is_repetitive) == [True, False, False]


def test_readable(spark):
    texts = ["Un titre lisible", "court", "�� un titre lisible", "日本語の長いタイトルです日本語", "1234567890 1234", "abcdefgh 1234"]
    assert column(spark, texts, text.is_readable) == [True, False, False, False, False, True]


def test_fold(spark):
    texts = ["Éléphant ÇA", "é", "naïve Ångström", "œuf"]
    assert column(spark, texts, text.ascii_fold) == ["elephant ca", "e", "naive angstrom", "œuf"]


def test_ids(spark):
    got = column(spark, [" 42 ", "nan", "<NA>", "None", None, "https://x/1"], text.normalize_id)
    assert got == ["42", "", "", "", "", "https://x/1"]


@pytest.mark.parametrize(
    ("rows", "schema", "expected"),
    [
        ([("https://example.com/article/123", "t", "c")], "id string, title string, content string", "https://example.com/article/123"),
        ([(42, "stable", "t", "c")], "raw_data_id bigint, id string, title string, content string", "42"),
        ([(None, "stable-abc", "t", "c")], "raw_data_id bigint, id string, title string, content string", "stable-abc"),
    ],
)
def test_usable_id(spark, rows, schema, expected):
    df = spark.createDataFrame(rows, schema)
    assert df.select(text.usable_id(df)).first()[0] == expected


def test_foundation(spark):
    names = ["GDELT_Last15_English", "GDELT_Master_List", "kaggle_x", "gdelt_events", "zzdb_csv", "zzdb_synthetic", "rss"]
    got = [(r.is_foundation, r.foundation_type, r.frozen) for r in column(spark, names, text.foundation_class)]
    assert got == [
        (True, "bigdata", False), (True, "bigdata", False), (True, "flat_files", True), (True, "bigdata", True),
        (True, "db_non_relational", False), (False, "real_source", False), (False, "real_source", False),
    ]


def test_labels(spark):
    names = ["négatif", "NEGATIVE", "n?gatif", "n�gatif", "", None, "mixed", "Positif", "neu", "5"]
    n, z, p = labels.CLASSES
    assert column(spark, names, labels.normalize_label) == [n, n, n, n, z, z, z, p, z, z]
    assert column(spark, names, labels.strict_label) == [n, n, n, n, None, None, None, p, z, None]
    assert column(spark, names, labels.canonical_sentiment) == [n, n, "inconnu", "inconnu", "inconnu", "inconnu", "inconnu", p, z, p]
    assert column(spark, ["LABEL_0", "LABEL_1", "very_pos", "mostly negative", "4", "?"], labels.label_polarity) == ["neg", "neu", "pos", "neg", "pos", "neu"]


def folded(spark, scores, fold=labels.fold_probabilities):
    df = spark.createDataFrame([(scores,)], "scores array<struct<label:string,score:double>>")
    return fold(df).select("out.*").first()


def test_fold_families(spark):
    stars = folded(spark, [("1 star", 0.1), ("2 stars", 0.1), ("3 stars", 0.2), ("4 stars", 0.3), ("5 stars", 0.3)])
    assert (stars.label_3c, stars.p_neg, stars.p_neu, stars.p_pos, stars.sentiment_score) == ("POSITIVE", 0.2, 0.2, 0.6, 0.4)
    french = folded(spark, [("Négatif", 0.7), ("neutre", 0.2), ("positif", 0.1)])
    assert (french.label_3c, french.confidence) == ("NEGATIVE", 0.7)
    english = folded(spark, [("POSITIVE", 1.0), ("NEUTRAL", 1.0), ("NEGATIVE", 2.0)])
    assert (english.label_3c, english.p_pos, english.p_neg) == ("NEGATIVE", 0.25, 0.5)
    tie = folded(spark, [("LABEL_0", 0.4), ("LABEL_1", 0.2), ("LABEL_2", 0.4)])
    assert tie.label_3c == "POSITIVE"
    assert folded(spark, [("other", 0.4)]).label_3c == "POSITIVE"
    generic = folded(spark, [("very_neg", 2.0), ("neg", 1.0), ("pos", 1.0)], labels.fold_probabilities_generic)
    assert (generic.label_3c, generic.p_neg, generic.p_pos) == ("NEGATIVE", 0.75, 0.25)


@pytest.mark.parametrize(
    ("sentence", "scores", "expected"),
    [
        ("Formidable, ce train est plus lent que mon vélo", (0.1, 0.2, 0.7), ("NEGATIVE", 0.72, -0.55, "irony_prefix")),
        ("Le gâteau est pas mal, vu la recette je m'attendais à pire", (0.5, 0.3, 0.2), ("POSITIVE", 0.62, 0.35, "understatement_positive")),
        ("Quartier moderne, cependant le bus manque", (0.1, 0.2, 0.7), ("NEUTRAL", 0.55, 0.15, "mixed_contrast")),
        ("La bibliothèque utilise un fichier par lecteur", (0.5, 0.3, 0.2), ("NEUTRAL", 0.58, -0.045, "factual_neutral")),
        ("Un produit quelconque", (0.5, 0.3, 0.2), ("NEGATIVE", 0.5, -0.3, None)),
        ("Quartier moderne, cependant le bus manque", (0.9, 0.05, 0.05), ("NEGATIVE", 0.9, -0.85, None)),
        (None, (0.5, 0.3, 0.2), ("NEGATIVE", 0.5, -0.3, None)),
    ],
)
def test_refinements(spark, sentence, scores, expected):
    neg, neu, pos = scores
    df = spark.createDataFrame(
        [(sentence, [("negative", neg), ("neutral", neu), ("positive", pos)])], "text string, scores array<struct<label:string,score:double>>"
    )
    out = labels.refine_sentiment(labels.fold_probabilities_generic(df)).select("out.*").first()
    assert (out.label_3c, out.confidence, out.sentiment_score, out.refined) == expected


@pytest.mark.parametrize(
    ("neg", "pos", "expected"),
    [
        (0, 0, ("neutre", 0.5)), (1, 1, ("neutre", 0.5)), (2, 2, ("neutre", 0.5)), (3, 3, ("negatif", 0.5)), (4, 1, ("negatif", 0.8)),
        (1, 4, ("positif", 0.8)), (20, 0, ("negatif", 0.95)), (2, 0, ("negatif", 0.95)), (2, 1, ("negatif", 0.583)), (0, 2, ("positif", 0.95)),
        (1, 0, ("negatif", 0.85)), (0, 1, ("positif", 0.85)), (9, 7, ("negatif", 0.562)), (3, 2, ("negatif", 0.6)), (2, 3, ("positif", 0.6)),
    ],
)
def test_ladder(spark, neg, pos, expected):
    df = spark.createDataFrame([(neg, pos)], "neg int, pos int")
    out = df.select(lexicon.sentiment_ladder(F.col("neg"), F.col("pos")).alias("o")).select("o.*").first()
    assert tuple(out) == expected


WORDS = SentimentLexicon.from_entries(
    [("bien", "pos", "strong"), ("échec", "neg", "strong"), ("échec", "neg", "moderate"), ("calme", "pos", "moderate"), ("calme", "neg", "moderate")]
)


def test_totals_words_not_parts(spark):
    df = spark.createDataFrame([(1, "Échec échec, bientôt calme."), (2, "bien"), (3, "bien bien!"), (4, None)], "id int, t string")
    got = lexicon.lexicon_totals(df, F.col("t"), WORDS).orderBy("id").select("pos_total", "neg_total").collect()
    assert [tuple(r) for r in got] == [(1, 7), (0, 0), (4, 0), (0, 0)]


def test_lexicon_from_table(spark):
    table = spark.createDataFrame([("bien", "pos", "strong"), ("mal", "neg", "moderate")], "word string, polarity string, strength string")
    assert SentimentLexicon.from_table(table) == SentimentLexicon({"bien": 2}, {"mal": 1})


def tagged(spark, title, content, source, topics):
    df = spark.createDataFrame([(title, content, source)], "title string, content string, source string")
    return [tuple(t) for t in lexicon.add_topics(df, topics).first().topics]


def test_topics(spark):
    wide = tuple(f"mot{i}xx" for i in range(33))
    topics = TopicTable({"a": ("taux", "banque"), "b": ("vote", "loi"), "c": ("pluie", *wide), "d": ("soleil", *wide, "neige"), "meteo": ("vent", "orage")})
    assert tagged(spark, "x", "rien", "rss", topics) == [("autre", 0.3, "keyword_default")]
    assert tagged(spark, "x", "les taux montent", "rss", topics) == [("a", 0.5, "keyword")]
    assert tagged(spark, "TAUX", "x", "rss", topics) == [("a", 1.0, "keyword")]
    assert tagged(spark, "x", "surtauxer un vote", "rss", topics) == [("a", 0.5, "keyword"), ("b", 0.5, "keyword")]
    assert tagged(spark, "x", "la plùie", "rss", topics)[0][0] == "c"
    assert tagged(spark, "x", "taux soleil", "rss", topics) == [("a", 0.5, "keyword")]
    assert tagged(spark, "x", "rien", "open-meteo paris", topics) == [("meteo", 1.0, "source_rule")]
    assert tagged(spark, "TAUX", "x", "OpenWeather", topics) == [("a", 1.0, "keyword"), ("meteo", 1.0, "keyword")]
    assert tagged(spark, "x", "vent et taux", "openweather", topics) == [("meteo", 1.0, "source_rule"), ("a", 0.5, "keyword")]


def test_automaton_finds_what_single_scans_find(spark, monkeypatch):
    rng = random.Random(4)
    parts = ["an", "ana", "nan", "banana", "b", "été", "ete", "", "xyz", "an"]
    topics = lexicon.TopicTable({"one": tuple(parts), "two": ("na", "q", "q"), "none": ()})
    texts = ["".join(rng.choice("abnéx yz") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rows = [(i, t, rng.choice([*texts, None])) for i, t in enumerate([*texts, None, "banana" * 4000])]
    df = spark.createDataFrame(rows, "id bigint, title string, content string")
    few = lexicon.add_topic_scores(df, topics).orderBy("id").collect()
    monkeypatch.setattr(lexicon, "SCANNED", 0)
    assert lexicon.add_topic_scores(df, topics).orderBy("id").collect() == few
    monkeypatch.setattr(lexicon, "MAX_KEYWORD_BYTES", 5)
    with pytest.raises(ValueError):
        lexicon.add_topic_scores(df, topics)


def test_python_takes_a_batch_by_pieces():
    values = pa.array(["x" * 10_000] * 4000 + [None])
    tracemalloc.start()
    out = text.by_pieces(lambda t: [t[:2]], values, pa.list_(pa.string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.to_pylist() == [["xx"]] * 4000 + [None] and peak < 10_000_000
    assert text.by_pieces(len, values.slice(0, 0), pa.int64()).to_pylist() == []
