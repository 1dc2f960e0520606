"""A rule-based labeler for the language task, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.functions.once import let, with_once

# Parts of a text that say nothing about its language, each with a cheap test for it: links, mail
# addresses, handles and tags, file paths. Digits break words anyway. Every pattern reads a text once: an address is
# tried at the start of a token and with its first "@" only, and path segments are not given back.
NOISE = [
    (r"://|www\.", r"(?:https?://|www\.)\S+"),
    (r"@", r"(?<!\S)\S[^\s@]*+@\S+\.\S+"),
    (r"[@#]", r"[@#]\w+"),
    (r"[/\\]", r"(?:[A-Za-z]:)?(?:[/\\][\w.-]++){2,}+"),
]
# Letters per script.
SCRIPTS = {
    "hi": r"[\u0900-\u097f]",
    "el": r"[\u0370-\u03ff\u1f00-\u1fff]",
    "ru": r"[\u0400-\u04ff]",
    "zh": r"[\u3400-\u4dbf\u4e00-\u9fff]",
    "arabic": r"[\u0600-\u06ff\u0750-\u077f]",
}
LATIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff]"
ANY_OTHER_SCRIPT = "[" + "".join(p[1:-1] for p in SCRIPTS.values()) + "]"
# Letters of Urdu that Arabic lacks.
URDU = r"[\u0679\u0688\u0691\u06ba\u06be\u06c1\u06d2]"
# Letters and function words that point to one Latin-script language.
LETTERS = {
    "vi": r"[ăđơưạ-ỹ]",
    "tr": r"[ğış]",
    "de": r"[äöüß]",
    "es": r"[ñ¿¡áíóú]",
    "fr": r"[àâçèêëîïôûœ]",
}
WORDS = {
    "en": "the of and to in is that for it with as was on are by this be from at which",
    "de": "der die das und ist nicht mit von den auf ein eine sich auch für dem im zu",
    "es": "el los las del que por con una para como más pero sus este ha",
    "fr": "le les des et est dans que pour pas une qui sur au avec plus ce il",
    "tr": "ve bir bu için ile de da çok daha gibi",
    "vi": "và là của có không được người trong một cho",
}
LATIN_ORDER = ["vi", "tr", "de", "es", "fr", "en"]
MIN_SIGNALS = 2
SHORT_WORDS = 2
WORD_BREAK = r"\P{L}+"


def clean(text: Column) -> Column:
    """Lower-case text without links, addresses, handles, tags and paths."""
    def without(rest: Column, noise: list[tuple[str, str]]) -> Column:
        if not noise:
            return rest
        (test, pattern), *others = noise
        step = let(rest, lambda r: F.when(r.rlike(test), F.regexp_replace(r, pattern, " ")).otherwise(r))
        return without(step, others)

    plain = without(text, NOISE)
    return F.lower(F.when(text.rlike(r"[@#/\\]|www\."), plain).otherwise(text))


def _letters(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _top(scores: dict[str, Column]) -> tuple[Column, Column]:
    """Highest score and the one name that has it ('ot' on a tie)."""
    best = F.greatest(*scores.values())
    winners = F.array_compact(F.array(*[F.when(s == best, F.lit(n)) for n, s in scores.items()]))
    return best, F.when(F.size(winners) == 1, F.get(winners, F.lit(0))).otherwise("ot")


def _latin(text: Column) -> Column:
    """struct of word count and, per language, its signals: function words plus its own letters."""
    def counted(m: Column) -> Column:
        def signals(lang: str) -> Column:
            known = F.size(F.filter(m["words"], lambda w: w.isin(WORDS[lang].split())))
            if lang not in LETTERS:
                return known
            return known + F.when(m["ascii"], 0).otherwise(_letters(m["text"], LETTERS[lang]))

        return F.struct(F.size(m["words"]).alias("n"), *[signals(lang).alias(lang) for lang in LATIN_ORDER])

    parts = F.struct(
        text.alias("text"),
        F.filter(F.split(text, WORD_BREAK), lambda w: w != "").alias("words"),
        (~text.rlike(r"[^\x00-\x7f]")).alias("ascii"),
    )
    return let(parts, counted)


def script(text: Column) -> Column:
    """latin, hi, el, ru, zh or arabic by majority of letters; 'ot' for none or a tie.

    Letters are only counted in texts that hold more than the Latin script.
    """
    counts = {"latin": _letters(text, LATIN), **{name: _letters(text, p) for name, p in SCRIPTS.items()}}
    listed = F.array(*[F.struct(n.alias("n"), F.lit(name).alias("name")) for name, n in counts.items()])

    def majority(found: Column) -> Column:
        best = F.filter(found, lambda f: f["n"] == F.array_max(F.transform(found, lambda g: g["n"])))
        return F.when(F.size(best) == 1, F.get(best, F.lit(0))["name"]).otherwise("ot")

    only_latin = F.when(text.rlike(LATIN), "latin").otherwise("ot")
    return F.when(text.rlike(ANY_OTHER_SCRIPT), let(listed, majority)).otherwise(only_latin)


def with_language(df: DataFrame, text: str, out: str = "response") -> DataFrame:
    """Adds the language code of a text: ar de el en es fr hi ru tr ur vi zh, or ot if unsure.

    The script with most letters decides; Urdu letters tell ur from ar. Among Latin-script
    languages the one with most signals wins if it has two; English is the default given one
    English word and no strong signal otherwise. Two or fewer words, and ties, give ot.
    """
    by_script = (
        F.when(F.col("__script") == "arabic", F.when(F.col("__clean").rlike(URDU), "ur").otherwise("ar"))
        .when(F.col("__script") != "latin", F.col("__script"))
    )
    signals = {lang: F.col("__latin")[lang] for lang in LATIN_ORDER}
    best, winner = _top(signals)
    others = F.greatest(*[s for lang, s in signals.items() if lang != "en"])
    latin = (
        F.when(F.col("__latin.n") <= SHORT_WORDS, F.when(others >= MIN_SIGNALS, winner).otherwise("ot"))
        .when(best >= MIN_SIGNALS, winner)
        .when((signals["en"] == 1) & (others < MIN_SIGNALS), "en")
        .otherwise("ot")
    )
    step = with_once(df, "__clean", clean(F.col(text)))
    step = with_once(step, "__script", script(F.col("__clean")))
    step = with_once(step, "__latin", F.when(F.col("__script") == "latin", _latin(F.col("__clean"))))
    return step.withColumn(out, F.coalesce(by_script, latin)).drop("__clean", "__script", "__latin")
