"""The language of a text: by its script, then by function words, then by learnt profiles of letter triples."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of languages in Latin letters.
FUNCTION_WORDS = {
    "en": (
        "the a and of to is are in it for with that this you your from at on by about after before how what which where when do does can my i if or than as "
        "be so not near behind yes no up only every one will there were them they keep need should would have has was an we our but then who why all any"
    ).split(),
    "de": (
        "der die das den dem des und ist sind ein eine einen einem einer nicht mit von für auf im in zu zum zur nach bei am an aus wie was wo wer welche welcher "
        "welches wenn weil denn ich du es sich mein meine ab ja nein etwa bis oder als auch nur alle so kaum gegen warum kann dann davor unter mich trotz wir sie"
    ).split(),
    "es": (
        "el la los las un una unos unas y de del que es son en con por para se no sí si al su tu mi como cómo qué cuál dónde cuando cuándo porque desde tras hasta "
        "más menos lo le les nos pero esta este esto sin sobre a o cada solo contra junto después antes muy todo todos"
    ).split(),
    "fr": (
        "le la les un une des et de du que qui est sont dans avec pour par sur ne pas je tu il elle nous vous ce cette ces mais ou où comme au aux mon ma votre "
        "notre son sa se en plus sans être avez cela peux puis très tout"
    ).split(),
    "it": "il lo la gli le un una e di del della che è sono in con per da non si al alla su come dove quando perché ma o questo questa io tu noi più senza anche molto nel nella".split(),
    "pt": "o a os as um uma e de do da que é são em com por para não se no na ao como onde quando porque mas ou este esta isto eu você nós mais sem também muito dos das seu sua".split(),
    "nl": "de het een en van is zijn in met voor op te niet dat die ik je jij wij we hij zij maar of als waar wat hoe naar bij om aan uit door over nog ook dit deze geen wel".split(),
}
#: Names of scripts in the names of characters, and the language that alone is told by one.
SCRIPTS = {"CJK": "zh", "HIRAGANA": "ja", "KATAKANA": "ja", "HANGUL": "ko"}
#: A script other than Latin holds a text from this share of its letters, as its texts often name things in Latin letters.
LEAST_SHARE = 0.4
LATIN = re.compile(r"[\W\d_a-zA-ZÀ-ɏ]+")
WORD = re.compile(r"[^\W\d_]+")
QUOTED = re.compile(r"[“\"«„][^“”\"«»„]*[”\"»]")
#: How much likelier (in logarithms) than the second a profile's language must be.
MARGIN = 2.0


@cache
def _script(letter: str) -> str:
    name = unicodedata.name(letter, "UNKNOWN").split(" ")[0].split("-")[0]
    return SCRIPTS.get(name, name.lower())


@cache
def _word_languages() -> dict[str, tuple[str, ...]]:
    found: dict[str, tuple[str, ...]] = {}
    for name, words in FUNCTION_WORDS.items():
        for word in words:
            found[word] = (*found.get(word, ()), name)
    return found


def script(text: str) -> str | None:
    """The script that holds a text: 'latin', 'zh', 'ja', 'ko', 'cyrillic' and so on; None without letters."""
    if text.isascii():
        return "latin" if WORD.search(text) else None
    others = LATIN.sub("", text)
    if others:
        counts = Counter(map(_script, others))
        if counts.get("ja", 0) * 10 >= counts.get("zh", 0) and "ja" in counts:
            counts["ja"] += counts.pop("zh", 0)
        name, n = counts.most_common(1)[0]
        if n >= LEAST_SHARE * sum(map(len, WORD.findall(text))):
            return name
    return "latin" if WORD.search(text) else None


@dataclass
class Profiles:
    """Logarithms of the shares of letter triples by language; ``rare`` stands for a triple not met."""

    triples: dict[str, dict[str, float]] = field(default_factory=dict)
    rare: float = math.log(1e-6)

    def language(self, words: list[str]) -> str | None:
        """The likeliest language by MARGIN, or None; more than half of the triples must be known to it."""
        grams = [w[i : i + 3] for w in (f" {w} " for w in words) for i in range(len(w) - 2)]
        if not grams or not self.triples:
            return None
        scores = sorted(((sum(known.get(g, self.rare) for g in grams), name) for name, known in self.triples.items()), reverse=True)
        known = self.triples[scores[0][1]]
        if sum(g in known for g in grams) * 2 < len(grams) or (len(scores) > 1 and scores[0][0] - scores[1][0] < MARGIN):
            return None
        return scores[0][1]


def fit_profiles(documents: DataFrame, key: str, text: str, lang: str, max_texts: int = 3_000, seed: int = 3) -> Profiles:
    """Profiles of the languages in Latin letters from texts with a ``lang`` (letter case and blanks ignored).

    Of more than ``max_texts`` labelled texts those with the smallest seeded hashes of their keys are used, a
    documented bound of the training sample; their triples are counted by an aggregation, and those that
    make up a millionth of a language or more come to the driver. Wrong labels only blur the profiles. A
    language needs 1,000 triples. NULL texts and labels don't count."""
    named = F.lower(F.trim(lang)).alias("lang")
    labelled = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    chosen = labelled.select(F.col(key).alias("key"), F.xxhash64(key, F.lit(seed)).alias("h")).orderBy("h", "key").limit(max_texts).select("key")
    rows = labelled.select(F.col(key).alias("key"), named, F.lower(text).alias("body")).join(F.broadcast(chosen), "key", "left_semi")
    words = rows.select("lang", F.explode(F.regexp_extract_all("body", F.lit(r"[a-z\x{00DF}-\x{024F}]+"), F.lit(0))).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
    grams = words.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("w")), lambda i: F.substr(padded, i, F.lit(3)))).alias("gram"))
    counted = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("whole")).where("whole >= 1000")
    kept = counted.join(F.broadcast(totals), "lang").where("n >= whole / 1e6").select("lang", "gram", (F.col("n") / F.col("whole")).alias("share"))
    found = Profiles()
    for name, gram, share in kept.collect():
        if name not in SCRIPTS.values():
            found.triples.setdefault(name, {})[gram] = math.log(share)
    return found


def language(text: str, profiles: Profiles | None = None) -> str | None:
    """The language of a plain text in lower case, or the script that tells it from others; None where
    nothing tells. Quoted parts, which may stand in any language, are left out."""
    unquoted = QUOTED.sub(" ", text)
    text = unquoted if WORD.search(unquoted) else text
    kind = script(text)
    if kind != "latin":
        return kind
    words = WORD.findall(text)
    known, counts = _word_languages(), Counter()
    for word in words:
        for name in known.get(word, ()):
            counts[name] += 1
    first = counts.most_common(2)
    if first and (len(first) == 1 or first[0][1] > first[1][1]):
        return first[0][0]
    return profiles.language(words) if profiles else None
