"""Rules that normalise the tokens of an n-gram, as Column expressions.

Order of the rules: split on spaces, take the part-of-speech suffix off, lower-case, look the lemma up, then either keep the
whitelist's tokens or apply the alphabet, length and stop-word rules. A token that fails becomes UNK in its place; an n-gram whose
tokens all failed is dropped. Lengths are bytes and lower-casing is ASCII by default.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolex.session import settled

# The part-of-speech tags of tagged n-grams, and those whose universal name differs.
POS_TAGS = ("NOUN", "PROPN", "VERB", "ADJ", "ADV", "PRON", "DET", "ADP", "NUM", "CONJ", "X", ".")
UNIVERSAL = {"CONJ": "CCONJ", ".": "PUNCT"}
UNK = "<UNK>"
TAG = "(NOUN|PROPN|VERB|ADJ|ADV|PRON|DET|ADP|NUM|CONJ|X|[.])"

# Languages that lemmas are known for, with the models they commonly come from.
LEMMA_MODELS = {
    "en": "en_core_web_sm", "de": "de_core_news_sm", "es": "es_core_news_sm", "fr": "fr_core_news_sm",
    "it": "it_core_news_sm", "ru": "ru_core_news_sm", "zh": "zh_core_web_sm", "he": "he_core_news_sm",
}

#: Rows up to which a look-up table is broadcast; larger ones are joined by exchange.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class TokenRules:
    lower: bool = True
    unicode_lower: bool = False
    alpha: bool = True
    short: bool = True
    min_bytes: int = 3
    stop: bool = True
    stop_words: tuple[str, ...] = ()

    def __post_init__(self):
        for f in fields(self):
            value, kind = getattr(self, f.name), {"min_bytes": int, "stop_words": tuple}.get(f.name, bool)
            if type(value) is not kind or (kind is tuple and not all(isinstance(w, str) for w in value)):
                raise TypeError(f"{f.name} must be {kind.__name__}, not {value!r}")


def split_tokens(ngram: Column) -> Column:
    """Tokens between ASCII spaces; runs of spaces count as one."""
    return F.filter(F.split(ngram, " "), lambda t: t != "")


def bare(token: Column) -> Column:
    """The token without a part-of-speech suffix; the suffix needs something before it."""
    return F.regexp_replace(token, f"^(.+)_{TAG}$", "$1")


def pos_tag(token: Column) -> Column:
    """The suffix's tag, empty without one."""
    return F.regexp_extract(token, f"^(.+)_{TAG}$", 2)


def universal_pos(token: Column) -> Column:
    """The universal tag; NOUN for an untagged token."""
    tag = pos_tag(token)
    out = F.when(tag == "", F.lit("NOUN"))
    for name, other in UNIVERSAL.items():
        out = out.when(tag == name, F.lit(other))
    return out.otherwise(tag)


def ascii_lower(token: Column) -> Column:
    return F.translate(token, string.ascii_uppercase, string.ascii_lowercase)


def is_alpha(token: Column) -> Column:
    return token.rlike(r"^\p{L}+$")


def is_long(token: Column, min_bytes: int) -> Column:
    return F.octet_length(token) >= min_bytes


def lowered(token: Column, rules: TokenRules) -> Column:
    if rules.unicode_lower:
        return F.lower(token)
    return ascii_lower(token) if rules.lower else token


def accepted(token: Column, rules: TokenRules) -> Column:
    """Whether a token passes the alphabet, length and stop-word rules."""
    ok = F.lit(True)
    if rules.alpha:
        ok = ok & is_alpha(token)
    if rules.short:
        ok = ok & is_long(token, rules.min_bytes)
    if rules.stop and rules.stop_words:
        ok = ok & ~token.isin(*rules.stop_words)
    return ok


def _shorter(budget: int) -> str:
    """Pattern of a run of characters with at most `budget` bytes of UTF-8, one at least."""
    classes = (r"[\x00-\x7F]", r"[\x80-\x{7FF}]", r"[\x{800}-\x{FFFF}]", r"[\x{10000}-\x{10FFFF}]")
    return "(?:" + "|".join(c + (f"{_shorter(budget - n)}?" if budget > n else "") for n, c in enumerate(classes, 1) if n <= budget) + ")"


def accepted_pattern(rules: TokenRules) -> str:
    """Pattern of an accepted token, up to the space or the end after it."""
    end = r"(?= |\z)"
    out = ""
    if rules.stop and rules.stop_words:
        out += "(?!(?:" + "|".join(re.escape(w) for w in rules.stop_words) + f"){end})"
    if rules.short and rules.min_bytes > 1:
        out += f"(?!{_shorter(rules.min_bytes - 1)}{end})"
    return out + (r"\p{L}++" if rules.alpha else "[^ ]++") + end


def normalise(ngram: Column, rules: TokenRules) -> Column:
    """The normalised n-gram, null if it is dropped; for rules without look-up tables, so no exchange is needed.

    The rules run as patterns over the whole n-gram, so every step is compiled code, and the text is taken apart nowhere.
    """
    one = F.btrim(F.when(ngram.contains("  "), F.regexp_replace(ngram, " +", " ")).otherwise(ngram), F.lit(" "))
    low = lowered(F.regexp_replace(one, rf"(?<=[^ ])_{TAG}(?= |\z)", ""), rules)
    token = accepted_pattern(rules)
    return F.when((low != "") & low.rlike(f"(?:^| ){token}"), F.regexp_replace(low, f"(?<![^ ])(?!{token})[^ ]+", UNK))


def look_up_side(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a look-up table for broadcast if it has at most `limit` rows."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def normalised_rows(df: DataFrame, rules: TokenRules, column: str = "ngram") -> DataFrame:
    """Rows whose n-gram is kept, with its normalised form in its place.

    What is dropped goes by exploding a list without nulls: a filter would be moved below the projection and run all patterns twice.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    rows = df.select(*rest, normalise(F.col(column), rules).alias("own_text"))
    return rows.select(*rest, F.explode(F.array_compact(F.array("own_text"))).alias(column))


#: Tokens of an n-gram that are looked up one place after another where the map of tokens is broadcast.
PLACES = 5


def lemma_model(language: str) -> str:
    """The model that a language's lemma table commonly comes from; other languages are an error."""
    if language not in LEMMA_MODELS:
        raise ValueError(f"no lemmas for {language!r}; known are {', '.join(LEMMA_MODELS)}")
    return LEMMA_MODELS[language]


def plain_english(token: Column, pos: Column) -> Column:
    """Rules for lemmas of English words that no table has: plurals of nouns, and -ing, -ed and -s of verbs, where four letters are left."""
    noun = F.when(token.rlike("^.{3,}ies$"), F.regexp_replace(token, "ies$", "y")).when(token.rlike("^.{2,}(ss|us|is)$"), token)
    noun = noun.when(token.rlike("^.{2,}(x|z|ch|sh|ss)es$"), F.regexp_replace(token, "es$", "")).when(token.rlike("^.{3,}s$"), F.regexp_replace(token, "s$", ""))
    verb = F.when(token.rlike("^.{3,}(ies|ied)$"), F.regexp_replace(token, "ie[sd]$", "y")).when(token.rlike("^.{3,}ss$"), token)
    verb = verb.when(token.rlike(r"^.{2,}([bdgmnprt])\1(ing|ed)$"), F.regexp_replace(token, r"([bdgmnprt])\1(ing|ed)$", "$1"))
    verb = verb.when(token.rlike("^.{4,}(ing|ed)$"), F.regexp_replace(token, "(ing|ed)$", "")).when(token.rlike("^.{3,}s$"), F.regexp_replace(token, "s$", ""))
    return F.when(pos.isin("NOUN", "PROPN"), F.coalesce(noun, token)).when(pos == "VERB", F.coalesce(verb, token)).otherwise(token)


def token_map(tokens: DataFrame, rules: TokenRules, whitelist: DataFrame | None, lemmas: DataFrame | None, fallback: Callable[[Column, Column], Column] | None) -> DataFrame:
    """raw -> t, the normalised token or null if it fails, for distinct raw tokens: each meets the tables once, however often it occurs."""
    mapped = tokens.select("raw", lowered(bare(F.col("raw")), rules).alias("token"), universal_pos(F.col("raw")).alias("pos"))
    if lemmas is not None:
        exact = lemmas.where("pos IS NOT NULL").groupBy("token", "pos").agg(F.min("lemma").alias("by_pos"))
        loose = lemmas.where("pos IS NULL").groupBy("token").agg(F.min("lemma").alias("by_token"))
        mapped = mapped.join(exact, ["token", "pos"], "left").join(loose, "token", "left")
        other = F.col("token") if fallback is None else fallback(F.col("token"), F.col("pos"))
        mapped = mapped.select("raw", F.coalesce("by_pos", "by_token", other).alias("token"))
    if whitelist is not None:
        known = whitelist.select("token").distinct().withColumn("ok", F.lit(True))
        return mapped.join(known, "token", "left").select("raw", F.when(F.col("ok"), F.col("token")).alias("t"))
    return mapped.select("raw", F.when(accepted(F.col("token"), rules), F.col("token")).alias("t"))


def normalise_with_tables(
    ngrams: DataFrame, rules: TokenRules, whitelist: DataFrame | None = None, lemmas: DataFrame | None = None, column: str = "ngram",
    fallback: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(ngram, normalised) for the distinct n-grams that are kept, with a whitelist (token) and lemmas (token, pos or null, lemma).

    The distinct tokens are mapped once. If a count shows that their map is small, it is broadcast and looked up place by place, and no
    n-gram is exchanged; n-grams of more than PLACES tokens, and all where the map is large, are exploded, joined and put
    together again. fallback gives the lemma of (token, universal tag) that no table has. An empty whitelist keeps nothing.
    """
    raw = settled(ngrams.select(F.col(column).alias("ngram")).distinct())  # read for its tokens and to be put together
    words = raw.select("ngram", split_tokens(F.col("ngram")).alias("w"))
    mapped = settled(token_map(words.select(F.explode("w").alias("raw")).distinct(), rules, whitelist, lemmas, fallback))
    small = mapped.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    apart = words.where(F.size("w") > PLACES) if small else words
    tokens = apart.select("ngram", F.posexplode("w").alias("at", "raw")).join(look_up_side(mapped), "raw")
    parts = F.array_sort(F.collect_list(F.struct("at", F.coalesce("t", F.lit(UNK)).alias("t"))))
    grouped = tokens.groupBy("ngram").agg(F.max(F.col("t").isNotNull()).alias("ok"), parts.alias("parts")).where("ok")
    out = grouped.select("ngram", F.concat_ws(" ", F.transform("parts", lambda p: p["t"])).alias("normalised"))
    if not small:
        return out
    short = words.where(F.size("w") <= PLACES)
    for i in range(PLACES):
        side = F.broadcast(mapped.select(F.col("raw").alias(f"raw{i}"), F.col("t").alias(f"t{i}")))  # at most BROADCAST_ROWS rows
        short = short.join(side, F.try_element_at("w", F.lit(i + 1)) == F.col(f"raw{i}"), "left").drop(f"raw{i}")
    short = short.where(F.coalesce(*[f"t{i}" for i in range(PLACES)]).isNotNull())
    texts = [F.when(F.size("w") > i, F.coalesce(f"t{i}", F.lit(UNK))) for i in range(PLACES)]
    return out.unionByName(short.select("ngram", F.concat_ws(" ", *texts).alias("normalised")))


def ngram_type(ngram: Column, kind: str) -> Column:
    """all: not blank; tagged: every token between single spaces ends in a tag; untagged: none does."""
    if kind == "all":
        return F.trim(ngram) != ""
    suffix = f"_{TAG}$"
    if kind == "tagged":
        return F.forall(F.split(ngram, " "), lambda t: t.rlike(suffix))
    if kind == "untagged":
        return ~F.exists(F.split(ngram, " "), lambda t: t.rlike(suffix))
    raise ValueError(f"unknown n-gram type {kind!r}")


def unk_policy(df: DataFrame, column: str, policy: str) -> DataFrame:
    """reject: no UNK anywhere; strip: without UNK tokens, two left at least; retain: as it is."""
    if policy == "reject":
        return df.where(~F.col(column).contains(UNK))
    if policy == "strip":
        left = F.filter(split_tokens(F.col(column)), lambda t: t != UNK)
        return df.where(F.size(left) >= 2).withColumn(column, F.concat_ws(" ", left))
    if policy == "retain":
        return df
    raise ValueError(f"unknown policy {policy!r}")


def log_weight(count: Column, base: int = 10) -> Column:
    """How often a sentence counts: the whole part of log(count + 1), at least 1, as the quotient of natural logarithms."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.log(float(base), (count + 1).cast("double"))))
