"""Sentiment label spellings and probability folding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.numbers import one_of, round_even
from opinara.functions.text import ascii_fold, or_empty, strip

NEGATIVE, NEUTRAL, POSITIVE = "negatif", "neutre", "positif"
CLASSES = (NEGATIVE, NEUTRAL, POSITIVE)
UNKNOWN = "inconnu"

# Accepted spellings of each class.
NEGATIVE_WORDS = ("negatif", "negative", "neg")
POSITIVE_WORDS = ("positif", "positive", "pos")
NEUTRAL_WORDS = ("neutre", "neutral", "neu")
NEGATIVE_SIGNS = ("very_neg", "1", "2", "label_0")
POSITIVE_SIGNS = ("very_pos", "4", "5", "label_2")
NEUTRAL_SIGNS = ("3", "label_1")


def _folded(label: Column) -> Column:
    return ascii_fold(strip(or_empty(label)))


def _folded_class(label: Column, default: str | None) -> Column:
    text = _folded(label)
    damaged = text.startswith("n") & text.endswith("gatif")
    return one_of(
        (text.isin(*NEGATIVE_WORDS) | damaged, NEGATIVE),
        (text.isin(*POSITIVE_WORDS), POSITIVE),
        (text.isin(*NEUTRAL_WORDS), NEUTRAL),
        default=default,
    )


def normalize_label(label: Column) -> Column:
    """Three classes; damaged spellings of ``negatif`` are caught, anything unknown is neutral."""
    return _folded_class(label, NEUTRAL)


def strict_label(label: Column) -> Column:
    """Three classes; unknown is null so that the row can be dropped."""
    return _folded_class(label, None)


def strict_polarity(label: Column) -> Column:
    """``neg``/``neu``/``pos`` with star digits; unknown is null."""
    text = F.lower(strip(or_empty(label)))
    return one_of(
        (text.isin(*POSITIVE_WORDS, "4", "5"), "pos"),
        (text.isin(*NEGATIVE_WORDS, "négatif", "1", "2"), "neg"),
        (text.isin(*NEUTRAL_WORDS, "neutre."), "neu"),
        default=None,
    )


def canonical_sentiment(label: Column) -> Column:
    """Three classes with star digits; unknown is named as such."""
    text = F.lower(strip(or_empty(label)))
    return one_of(
        (text.isin(*POSITIVE_WORDS, "4", "5"), POSITIVE),
        (text.isin(*NEGATIVE_WORDS, "négatif", "1", "2"), NEGATIVE),
        (text.isin(*NEUTRAL_WORDS, "3"), NEUTRAL),
        default=UNKNOWN,
    )


def label_polarity(label: Column) -> Column:
    """Model label to polarity: exact spellings, then substrings, then neutral."""
    text = strip(F.regexp_replace(ascii_fold(or_empty(label)), r"[^\x{00}-\x{7f}]", ""))

    def mentions(*parts: str) -> Column:
        return text.rlike("|".join(parts))

    return one_of(
        (text.isin(*POSITIVE_WORDS, *POSITIVE_SIGNS), "pos"),
        (text.isin(*NEGATIVE_WORDS, *NEGATIVE_SIGNS), "neg"),
        (text.isin(*NEUTRAL_WORDS, *NEUTRAL_SIGNS), "neu"),
        (mentions("negative", "negatif", "very_neg"), "neg"),
        (mentions("positive", "positif", "very_pos"), "pos"),
        default="neu",
    )


def french_label(label_3c: Column) -> Column:
    """Class id to label."""
    name = F.upper(or_empty(label_3c))
    return one_of((name == "POSITIVE", POSITIVE), (name == "NEGATIVE", NEGATIVE), default=NEUTRAL)


def _best_class(pos: Column, neu: Column, neg: Column) -> Column:
    """Largest probability; ties go to positive, then neutral."""
    return one_of(
        ((pos >= neu) & (pos >= neg), "POSITIVE"), (neu >= neg, "NEUTRAL"), default="NEGATIVE"
    )


def _with_output(df: DataFrame, out: str) -> DataFrame:
    """Struct ``out`` from the working columns _pos, _neu and _neg."""
    pos, neu, neg = F.col("_pos"), F.col("_neu"), F.col("_neg")
    return df.withColumn(
        out,
        F.struct(
            _best_class(pos, neu, neg).alias("label_3c"),
            round_even(F.greatest(pos, neu, neg), 4).alias("confidence"),
            round_even(pos, 4).alias("p_pos"),
            round_even(neu, 4).alias("p_neu"),
            round_even(neg, 4).alias("p_neg"),
            round_even(pos - neg, 4).alias("sentiment_score"),
        ),
    ).drop("_pos", "_neu", "_neg")


def _normalised(df: DataFrame) -> DataFrame:
    whole = F.col("_pos") + F.col("_neu") + F.col("_neg")
    return df.withColumn("_whole", F.when(whole > 0, whole).otherwise(1.0)).select(
        *[c for c in df.columns if c not in ("_pos", "_neu", "_neg")],
        *[(F.col(c) / F.col("_whole")).alias(c) for c in ("_pos", "_neu", "_neg")],
    )


def fold_probabilities(df: DataFrame, scores: str = "scores", out: str = "out") -> DataFrame:
    """Adds struct ``out``: three probabilities, best class and score from ``array<struct<label,score>>``.

    Three label families are tried in turn: five stars, French names (accents ignored), then English or numbered names,
    the only family that is normalised to sum to one. Each step is its own projection so that no lookup runs twice.
    """

    def last_score(field: str, name: str) -> Column:
        match = F.filter("_named", lambda s: s[field] == F.lit(name))
        return F.try_element_at(match, F.lit(-1))["score"]

    def first_of(*lookups: tuple[str, str]) -> Column:
        return F.coalesce(*[last_score(field, name) for field, name in lookups], F.lit(0.0))

    named = F.transform(
        scores,
        lambda s: F.struct(
            strip(s["label"]).alias("exact"),
            ascii_fold(strip(s["label"])).alias("folded"),
            s["score"].cast("double").alias("score"),
        ),
    )
    stars = {"_s1": first_of(("exact", "1 star"), ("exact", "1 STAR"))}
    stars |= {f"_s{n}": first_of(("exact", f"{n} stars"), ("exact", f"{n} STARS")) for n in (2, 3, 4, 5)}
    french = {f"_fr_{c}": first_of(("folded", c)) for c in CLASSES}
    english = {
        "_en_pos": first_of(("folded", "positive"), ("exact", "LABEL_2"), ("exact", "pos")),
        "_en_neu": first_of(("folded", "neutral"), ("exact", "LABEL_1"), ("exact", "neu")),
        "_en_neg": first_of(("folded", "negative"), ("exact", "LABEL_0"), ("exact", "neg")),
    }
    lookups = {**stars, **french, **english}

    def total(columns) -> Column:
        return sum((F.col(c) for c in columns), F.lit(0.0))

    by_stars, by_french = total(stars) > 0.001, total(french) > 0.001
    whole = F.when(total(english) > 0, total(english)).otherwise(1.0)

    def chosen(star: Column, fr: str, en: str) -> Column:
        return one_of((by_stars, star), (by_french, F.col(f"_fr_{fr}")), default=F.col(en) / whole)

    folded = (
        df.withColumn("_named", named)
        .withColumns(lookups)
        .withColumns(
            {
                "_pos": chosen(F.col("_s4") + F.col("_s5"), POSITIVE, "_en_pos"),
                "_neu": chosen(F.col("_s3"), NEUTRAL, "_en_neu"),
                "_neg": chosen(F.col("_s1") + F.col("_s2"), NEGATIVE, "_en_neg"),
            }
        )
        .drop("_named", *lookups)
    )
    return _with_output(folded, out)


def fold_probabilities_generic(df: DataFrame, scores: str = "scores", out: str = "out") -> DataFrame:
    """Adds struct ``out``: scores summed by the polarity of their label and normalised."""

    def mass(polarity: str) -> Column:
        chosen = F.filter("_polar", lambda s: s["polarity"] == polarity)
        return F.aggregate(chosen, F.lit(0.0), lambda total, s: total + s["score"])

    polar = F.transform(
        scores,
        lambda s: F.struct(label_polarity(s["label"]).alias("polarity"), s["score"].cast("double").alias("score")),
    )
    summed = df.withColumn("_polar", polar).withColumns(
        {"_pos": mass("pos"), "_neu": mass("neu"), "_neg": mass("neg")}
    )
    return _with_output(_normalised(summed.drop("_polar")), out)


# Patterns of the rule refinements (French opinion texts).
CONTRAST = (
    r"\b(mais|cependant|toutefois|néanmoins|neanmoins|par contre|même si|meme si|malgré|malgre|sans être|sans etre)\b"
)
IMPROVE = (
    r"(amélior\w*|amelior\w*|problème|probleme|défaut\w*|defaut\w*|insuffis\w*|faible|manque|corriger|critiqu\w*"
    r"|confus\w*|exploitable|effort\w*|prêt|pret|convaincant\w*)"
)
PRAISE = (
    r"\b(correct|bon|bien|réussi|reussi|satisf|conforme|acceptabl\w*|adéquat|adequat|intéressant|interessant|prometteur"
    r"|moderne|joli|pertinent|plutôt bien|plutot bien|presque)\b"
)
IRONY_OPENING = r"^(génial|genial|super|formidable|magnifique|excellent|quelle réussite|quelle reussite)\b"
IRONY_COMPLAINT = (
    r"(plante|incohérent|incoherent|trompe|erreur\w*|critique|évite|evite|confus|catastroph|faible|mauvais|lent|déçu|decu)"
)
UNDERSTATEMENT = r"pas mal( du tout)?.*(m'attendais à pire|attendais à pire)"
LUKEWARM = r"\b(au moins|presque exploitable|déjà un progrès|deja un progres)\b"
FACTUAL = (
    r"^(le |la |les |l'|un |une |des ).*(présente|classe|collectées|collectees|stockées|stockees|affiche|comprend|utilise"
    r"|mises à jour|genere|génère|testé|teste|identifie|doivent être|doivent etre|sont stockés|sont stockes)\b"
)
MARKET_UP = (
    r"\b(forte hausse|forte progression|hausse|haussier|rebond|rallye|bondit|record|optimiste|enthousiasme)\b"
)
MARKET_DOWN = r"\b(forte baisse|baisse|baissier|recul|effondre\w*|inquiète|inquiete|pessimiste|controvers\w*|scandal\w*)\b"


def _says(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike("(?iU)" + pattern), F.lit(False))


def _ruled(out: Column, label: str, floor: tuple[str, float], score: Column, rule: str) -> Column:
    """The verdict of one rule; the class probabilities stay as they were."""
    probability, least = floor
    return F.struct(
        F.lit(label).alias("label_3c"),
        round_even(F.greatest(out[probability], F.lit(least)), 4).alias("confidence"),
        *[out[p].alias(p) for p in ("p_pos", "p_neu", "p_neg")],
        round_even(score, 4).alias("sentiment_score"),
        F.lit(rule).alias("refined"),
    )


def _damped(score: Column, factor: float, bound: float) -> Column:
    return F.greatest(F.lit(-bound), F.least(F.lit(bound), score * factor))


def refine_sentiment(df: DataFrame, text: str = "text", out: str = "out") -> DataFrame:
    """Rewrites struct ``out`` by four rules: irony, understatement, mixed contrast, factual statement.

    Each rule sees the result of the one before, so each is its own projection; ``out.refined`` names the last one used.
    """
    body, verdict = F.col(text), F.col(out)
    score, both_sides = verdict["sentiment_score"], _says(body, IMPROVE) & _says(body, PRAISE)
    opinionated = F.lit(False)
    for pattern in (PRAISE, IMPROVE, MARKET_UP, MARKET_DOWN):
        opinionated = opinionated | _says(body, pattern)
    rules = (
        (
            _says(strip(or_empty(body)), IRONY_OPENING) & _says(body, IRONY_COMPLAINT),
            _ruled(verdict, "NEGATIVE", ("p_neg", 0.72), F.least(F.lit(-0.55), score), "irony_prefix"),
        ),
        (
            _says(body, UNDERSTATEMENT),
            _ruled(verdict, "POSITIVE", ("p_pos", 0.62), F.greatest(F.lit(0.35), score), "understatement_positive"),
        ),
        (
            ((_says(body, CONTRAST) & both_sides) | _says(body, LUKEWARM))
            & ~((verdict["p_neg"] >= 0.85) & (score <= -0.55)),
            _ruled(verdict, "NEUTRAL", ("p_neu", 0.55), _damped(score, 0.25, 0.35), "mixed_contrast"),
        ),
        (
            (verdict["label_3c"] != "NEUTRAL")
            & ~opinionated
            & (verdict["p_pos"] - verdict["p_neg"] < 0.35)
            & _says(body, FACTUAL),
            _ruled(verdict, "NEUTRAL", ("p_neu", 0.58), _damped(score, 0.15, 0.2), "factual_neutral"),
        ),
    )
    df = df.withColumn(out, verdict.withField("refined", F.lit(None).cast("string")))
    fields = ("label_3c", "confidence", "p_pos", "p_neu", "p_neg", "sentiment_score", "refined")
    df = df.withColumn(out, F.struct(*[verdict[f].alias(f) for f in fields]))
    for condition, result in rules:
        df = df.withColumn(out, F.when(condition, result).otherwise(verdict))
    return df
