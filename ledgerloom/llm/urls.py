"""URL filter: list rules first, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

# The list rules of the contract, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Words that settle the matter alone, as language: words.
STRICT = {
    "en": "adult casino escort gambling hentai porn porno sex warez xxx milf nude camgirl webcamsex sexcam fetish stripper roulette "
          "blackjack sportsbook crackz keygen viagra cialis",
    "es": "putas desnudas apuestas tragaperras ruleta pornografia prostituta",
    "fr": "salope pornographie paris-sportifs prostituee roulette-en-ligne",
    "de": "gluecksspiel spielautomat sportwetten nutten pornografie hure",
}
#: Words that count only together, as hundredths of what blocks: {language: {weight: words}}.
SOFT = {
    "en": {
        70: "bet betting poker slot jackpot torrent pill",
        60: "ad dating loan payday replica cracked hot spam bingo lottery lotto",
        50: "free track bonus cheap cam prize promo win winner discount crypto forex weightloss steroid",
        40: "download farm deal earn cash click popup coupon giveaway",
        30: "singles offer sale gift reward credit debt money rich profit instant unlimited premium stream",
    },
    "es": {
        70: "sexo apuesta poquer tragamoneda pastilla",
        60: "citas prestamo replica loteria caliente",
        50: "barato barata premio sorteo ganador descuento cripto adelgazar",
        40: "gratis descarga descargar anuncio dinero cupon regalo",
        30: "oferta rebaja soltera soltero ganar rico",
    },
    "fr": {
        70: "sexe pari parieur pilule cachet",
        60: "rencontre pret contrefacon loterie chaud",
        50: "rabais cadeau gagnant remise maigrir tirage",
        40: "gratuit gratuite telecharger telechargement publicite argent",
        30: "offre solde celibataire gagner riche",
    },
    "de": {
        70: "wette wetten pille spielbank potenzmittel",
        60: "kredit sofortkredit partnersuche lotterie heiss",
        50: "billig gewinn gewinner rabatt abnehmen gewinnspiel",
        40: "kostenlos herunterladen werbung geld gutschein geschenk",
        30: "angebot ausverkauf reich verdienen singleboerse",
    },
}
#: Endings under which a soft word is still that word; strict words are taken as they stand.
ENDINGS = {"en": ("", "s"), "es": ("", "s", "es"), "fr": ("", "s"), "de": ("", "n", "en")}
#: Digits that stand for letters of strict words to get past filters, each taken by itself and all together.
DISGUISE = {"a": "4", "e": "3", "i": "1", "o": "0"}
#: A strict term weighs as much as what blocks; soft ones need at least this many distinct words besides the weight.
BLOCKING, SOFT_WORDS = 100, 2


def vocabulary(strict: Mapping[str, str] = STRICT, soft: Mapping[str, Mapping[int, str]] = SOFT,
               endings: Mapping[str, Sequence[str]] = ENDINGS) -> dict[str, tuple[str, int]]:
    """{term: (word, weight)} for the words of all languages, soft ones under every ending, strict ones in every disguise.

    All forms of a word stand for that one word.  A term that two words give
    keeps the heavier, of equal ones the first by name.
    """
    forms = [(BLOCKING, word, word) for words in strict.values() for word in words.split()]
    forms += [(BLOCKING, word, word.replace(letter, digit)) for _, word, _ in forms for letter, digit in DISGUISE.items()]
    forms += [(BLOCKING, word, word.translate(str.maketrans(DISGUISE))) for words in strict.values() for word in words.split()]
    forms += [(weight, word, word + ending) for lang, by_weight in soft.items() for weight, words in by_weight.items()
              for word in words.split() for ending in endings[lang]]
    terms: dict[str, tuple[str, int]] = {}
    for weight, word, form in sorted(forms, key=lambda f: (-f[0], f[1])):
        terms.setdefault(form, (word, weight))
    return terms


VOCABULARY = vocabulary()


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null.

    Rules are a short list held in the plan; of equally long ones the first wins.
    """
    chosen = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


def vocabulary_hits(terms: Mapping[str, tuple[str, int]]):
    """Pandas function from lower-case URLs to the distinct words of the vocabulary they hold.

    One automaton holds all terms, so a URL is read once however many there
    are.  A hit counts where neither neighbour is an ASCII letter or digit.
    ``strict_hits`` counts words of weight ``BLOCKING`` or more, ``soft_hits``
    and ``soft_weight`` the others; a word found in several forms counts once.
    """
    known = dict(terms)

    @F.pandas_udf("strict_hits long, soft_hits long, soft_weight long, terms string")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term, (word, weight) in known.items():
            automaton.add_word(term, (len(term), word, weight))
        automaton.make_automaton()
        edge = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        for urls in batches:
            found = []
            for url in urls:
                words = {}
                for last, (size, word, weight) in automaton.iter(url) if known else ():
                    first = last - size + 1
                    if not ((first and url[first - 1] in edge)
                            or (last + 1 < len(url) and url[last + 1] in edge)):
                        words[word] = max(weight, words.get(word, 0))
                soft = [w for w in words.values() if w < BLOCKING]
                found.append((len(words) - len(soft), len(soft), sum(soft), ",".join(sorted(words))))
            yield pd.DataFrame(found, columns=["strict_hits", "soft_hits", "soft_weight", "terms"])
    return hits


def judge_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
               terms: Mapping[str, tuple[str, int]] = VOCABULARY, soft_words: int = SOFT_WORDS,
               keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Verdict per row: ``keep`` columns, host, path, rule, verdict and the hits.

    The longest fitting rule decides.  Without one a URL is blocked by one
    strict word, or by at least ``soft_words`` distinct soft words that weigh
    ``BLOCKING`` together, in any part of it.  A null or empty URL, or one
    without ``://``, has an empty host and path; its text is still searched
    (null: no hits, allow).  Equal rows stay separate; an empty table gives
    none; other columns are not read.
    """
    text = F.coalesce(F.col(url), F.lit(""))
    parts = pages.select(*keep, text.alias("__url"), url_host(text).alias("host"), url_path(text).alias("path"))
    parts = parts.withColumn("__hits", vocabulary_hits(terms)(ascii_lower(F.col("__url"))))
    listed = longest_rule(F.col("host"), F.col("path"), rules, lambda r: r[0])
    blocked = (F.col("__hits.strict_hits") >= 1) | (
        (F.col("__hits.soft_hits") >= soft_words) & (F.col("__hits.soft_weight") >= BLOCKING))
    return parts.select(
        *keep, "host", "path",
        longest_rule(F.col("host"), F.col("path"), rules, lambda r: r[1] + r[2]).alias("rule"),
        F.coalesce(listed, F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        "__hits.strict_hits", "__hits.soft_hits", "__hits.soft_weight", "__hits.terms",
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    vocabulary = ", ".join(f"('{t}', '{word}', {weight})" for t, (word, weight) in VOCABULARY.items())
    tokens = "regexp_extract_all(u, '[a-z0-9]+')"
    order = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')" for _, h, p in order]
    rule = " ".join(f"WHEN {f} THEN '{r[1]}{r[2]}'" for f, r in zip(fits, order, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{r[0]}'" for f, r in zip(fits, order, strict=True))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH cut AS (
      SELECT page_id, coalesce(url, '') AS u,
             CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages
    ), parts AS (
      SELECT page_id, {lower.format('u')} AS u, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM cut
    ), vocabulary(term, word, weight) AS (
      VALUES {vocabulary}
    ), words AS (
      SELECT page_id, word, weight
      FROM (SELECT page_id, unnest({tokens}) AS term FROM (SELECT DISTINCT page_id, u FROM parts)) JOIN vocabulary USING (term)
      UNION
      SELECT page_id, word, weight FROM (SELECT DISTINCT page_id, u FROM parts) JOIN vocabulary
        ON contains(term, '-') AND regexp_matches(u, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)')
    ), hits AS (
      SELECT page_id, count(*) FILTER (weight >= {BLOCKING}) AS strict_hits, count(*) FILTER (weight < {BLOCKING}) AS soft_hits,
             coalesce(sum(weight) FILTER (weight < {BLOCKING}), 0) AS soft_weight, string_agg(word, ',' ORDER BY word) AS terms
      FROM words GROUP BY page_id
    )
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN strict_hits >= 1 OR (soft_hits >= {SOFT_WORDS} AND soft_weight >= {BLOCKING}) THEN 'block'
                ELSE 'allow' END AS verdict,
           CAST(coalesce(strict_hits, 0) AS BIGINT) AS strict_hits, CAST(coalesce(soft_hits, 0) AS BIGINT) AS soft_hits,
           CAST(coalesce(soft_weight, 0) AS BIGINT) AS soft_weight, coalesce(terms, '') AS terms
    FROM parts LEFT JOIN hits USING (page_id)"""


QUERIES = {"op7_url_filter": op7_url_filter}
ORACLES = {"op7_url_filter": _oracle()}
