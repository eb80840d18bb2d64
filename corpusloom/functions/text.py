"""Scalar text functions as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
#: Function words by language, for the share that tells a text's language.
STOPWORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "are", "be", "this", "from"),
    "fr": ("le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "pour", "dans", "qui", "sur"),
    "de": ("der", "die", "das", "und", "in", "den", "von", "zu", "mit", "sich", "des", "auf", "ist", "ein", "nicht"),
    "es": ("el", "la", "los", "de", "que", "y", "en", "un", "una", "del", "las", "por", "con", "para", "es"),
}
#: Portuguese function words of three lists: for quality and language, for abstracts, for instruction pairs; English ones to tell an abstract.
PT = tuple("de da do das dos e o a os as em no na nos nas para por com que um uma se ao à como mais foi são ser não sobre entre pelo pela".split())
PT_ABSTRACT = tuple("de da do das dos e o a os as em no na para por com que um uma se ao como foi ser não sobre entre pelo pela este esta".split())
PT_PAIRS = tuple("de da do das dos e o a os as em no na para por com que um uma se ao como foi não".split())
EN_PAIRS = tuple("the of and in to is was with were for this that are by from which".split())
#: Accented letters and what they are without accents.
ACCENTED, BARE = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ", "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: Characters of an unwelcome answer page that asks for a proof of humanity.
CHALLENGES = ("just a moment", "checking your browser", "captcha", "access denied", "enable javascript and cookies")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def collapsed(text: Column) -> Column:
    """White space runs become one space; both ends trimmed."""
    return F.btrim(F.regexp_replace(text, r"\s+", " "))


def dedup_key(text: Column) -> Column:
    return F.sha2(F.lower(collapsed(text)), 256)


def without_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\P{C}\n\t]", "")


def without_leaders(text: Column) -> Column:
    """Runs of four or more dots, dashes or bullets become a space."""
    return F.regexp_replace(text, r"[.\-_•·]{4,}", " ")


def masked_emails(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, "[EMAIL]")


def short_hash(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def bare(text: Column) -> Column:
    """Without accents, in lower case."""
    return F.lower(F.translate(text, ACCENTED, BARE))


def name_key(text: Column) -> Column:
    """Folded to ASCII, runs of anything but letters and digits to one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(bare(text), "[^a-z0-9]+", "_"), F.lit("_"))


def slug(text: Column, most: int = 80, default: str = "sem-titulo") -> Column:
    plain = F.btrim(F.regexp_replace(bare(text), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(F.left(plain, F.lit(most)), F.lit("")), F.lit(default))


def year(text: Column, low: int = 1800, high: int = 2099) -> Column:
    found = F.regexp_extract(text, r"(\d{4})", 1)
    value = F.when(found != "", found.cast("int"))
    return F.when(value.between(low, high), value)


def year_band(y: Column, width: int = 5) -> Column:
    start = (F.floor(y / width) * width).cast("int")
    return F.concat(start.cast("string"), F.lit("-"), (start + width - 1).cast("string"))


def any_term(text: Column, terms) -> Column:
    """Whether any term stands in the text as a substring."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def any_word(text: Column, terms, allowed=()) -> Column:
    """Whether any term stands as whole words, after the allowed expressions are deleted."""
    plain = bare(text)
    for a in allowed:
        plain = F.replace(plain, F.lit(a), F.lit(" "))
    plain = F.concat(F.lit("_"), F.regexp_replace(plain, "[^a-z0-9]+", "_"), F.lit("_"))
    return reduce(lambda a, b: a | b, [F.contains(plain, F.lit(f"_{t}_")) for t in terms])


def share_of(tokens: Column, stop) -> Column:
    """Share of an array's words that are in ``stop``; zero for none."""
    return F.coalesce(F.size(F.filter(tokens, lambda x: x.isin(*stop))) / F.nullif(F.size(tokens), F.lit(0)), F.lit(0.0))


def in_portuguese(text: Column, least: float = 0.06) -> Column:
    """Whether a text of 20 words or more has enough Portuguese function words, and more of them than English ones; shorter texts pass."""
    w = words(F.lower(text))
    pt, en = share_of(w, PT_PAIRS), share_of(w, EN_PAIRS)
    return (F.size(w) < 20) | ((pt >= least) & (pt > en))


def with_language(df: DataFrame, text: str, name: str = "language", lists: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``df`` with a struct (lang, confidence) of column ``text``, by function words; null for null.

    Three windows from the middle of long texts vote, shorter texts are one window. A window speaks for the language with
    most function words (the first by name on ties), as sure as their share of all languages' ones. The language of most
    windows wins, then of the highest mean; ``un`` with 0 if no window speaks.
    """
    lists = dict(sorted((lists or STOPWORDS | {"pt": PT}).items()))
    t, n = F.col(text), F.length(text)
    part = lambda f: F.substr(t, F.floor(n * f).cast("int") + 1, F.lit(3000))
    windows = F.when(n > 9000, F.array(part(0.25), part(0.5), part(0.75))).otherwise(F.array(F.left(t, F.lit(5000))))

    def of(stop):
        return lambda x: x.isin(*stop)

    # of all words, those that some language counts: each is looked up once
    every = sorted({w for stop in lists.values() for w in stop})
    df = df.withColumn("_spoken", F.transform(windows, lambda w: F.filter(words(F.lower(w)), of(every))))
    df = df.withColumn("_counts", F.transform("_spoken", lambda w: F.array(*[F.size(F.filter(w, of(stop))) for stop in lists.values()])))

    def said(c: Column) -> Column:
        top = F.array_max(c)
        return F.struct(F.array_position(c, top).alias("k"), (top / F.aggregate(c, F.lit(0), lambda a, x: a + x)).alias("p"))

    df = df.withColumn("_said", F.transform(F.filter("_counts", lambda c: F.array_max(c) > 0), said))

    def verdict(k: int, lang: str) -> Column:
        own = F.filter("_said", lambda x: x["k"] == k)
        mean = F.aggregate(own, F.lit(0.0), lambda a, x: a + x["p"]) / F.nullif(F.size(own), F.lit(0))
        return F.struct(F.size(own).alias("n"), F.coalesce(mean, F.lit(0.0)).alias("p"), F.lit(lang).alias("lang"))

    df = df.withColumn("_best", F.array_max(F.array(*[verdict(k, lang) for k, lang in enumerate(lists, 1)])))
    lang = F.when(F.col("_best.n") > 0, F.col("_best.lang")).otherwise("un")
    return df.withColumn(name, F.when(t.isNotNull(), F.struct(lang.alias("lang"), F.col("_best.p").alias("confidence")))).drop("_spoken", "_counts", "_said", "_best")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(\[[^\]]*\]|[^/?#:]+)", 1))


def internal_host(h: Column) -> Column:
    return (h == "") | h.rlike(r"(^|\.)localhost$") | h.rlike(r"^\[(::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*)\]$") | h.rlike(r"^(localhost|127\.|10\.|192\.168\.|169\.254\.|0\.0\.0\.0|172\.(1[6-9]|2[0-9]|3[01])\.)")


def single_slashes(url: Column) -> Column:
    """Runs of slashes in the path become one; those of the scheme stay."""
    return F.regexp_replace(url, r"([^:/])/{2,}", "$1/")


def _mod11(digits: Column, weights: list[int]) -> Column:
    total = reduce(lambda a, b: a + b, [F.substring(digits, i + 1, 1).try_cast("int") * w for i, w in enumerate(weights)])
    return F.when(total % 11 < 2, 0).otherwise(11 - total % 11)


def valid_cpf(digits: Column) -> Column:
    """Eleven digits, not all equal, whose last two are the mod-11 check digits."""
    shape = digits.rlike(r"^\d{11}$") & ~digits.rlike(r"^(\d)\1{10}$")
    first, second = _mod11(digits, list(range(10, 1, -1))), _mod11(digits, list(range(11, 1, -1)))
    return shape & (F.substring(digits, 10, 1).try_cast("int") == first) & (F.substring(digits, 11, 1).try_cast("int") == second)


def seeded_order(seed: int, *ids: Column) -> Column:
    """A hash that shuffles rows the same way in every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))
