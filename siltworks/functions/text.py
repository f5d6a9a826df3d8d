"""Text expressions: keywords, punctuation, stopwords, numbers, bags of words, language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import ship

# What may end a word, and common words of four languages.
TERMINAL = '(){}[].,~|":&-'
STOPWORDS = {
    "en": "a about above after again all am an and any are as at be because been before being below between both but by can did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its just me more most my no nor not now of off on once only or other our out over own same she should so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split(),
    "de": "aber alle als am an auch auf aus bei bis das dass dem den der des die dies durch ein eine einem einen einer er es für hat ich im in ist ist mit nach nicht noch nur oder sich sie sind über um und von vor war werden wie wird wurde zu zum zur".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui sa se ses son sont sur un une vous".split(),
    "es": "al como con de del desde el ella en entre era es esta este la las lo los más mi no o para pero por que se según ser sin sobre son su sus un una y ya".split(),
}
MIMETYPES = ("application/atom+xml", "application/json", "application/pdf", "application/rss+xml", "application/xml", "application/x-netcdf", "application/zip", "image/gif", "image/jpeg", "image/png", "image/tiff", "text/csv", "text/html", "text/plain", "text/xml")
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    """The common character entities as characters."""
    for a, b in _ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def normalize_keywords(c: Column) -> Column:
    """Entities undone, underscores to blanks, all delimiters to commas."""
    return F.regexp_replace(F.replace(unescape(c), F.lit("_"), F.lit(" ")), r"[;|>+:=(){}]", ",")


def normalize_subjects(subjects: Column, split: bool = False, unique: bool = True) -> Column:
    """All terms of an array of subjects, normalised; sorted if unique."""
    kept = F.filter(subjects, lambda s: s.isNotNull() & (s != ""))
    out = F.transform(kept, normalize_keywords)
    if split:
        out = F.flatten(F.transform(out, lambda s: F.transform(F.filter(F.split(s, ","), lambda t: t != ""), F.trim)))
    return F.array_sort(F.array_distinct(out)) if unique else out


def remove_punctuation(c: Column) -> Column:
    out = F.trim(F.replace(F.regexp_replace(c, r"[;|>+:=.,()/?!\[\]{}]", " "), F.lit(" - "), F.lit(" ")))
    return F.when(out == "-", "").otherwise(out)


def strip_terminal(c: Column, chars: str = TERMINAL) -> Column:
    return F.btrim(c, F.lit(chars))


def split_words(c: Column) -> Column:
    return F.split(c, "[/:.]")


def tokenize(c: Column) -> Column:
    """Words and marks, in order."""
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+(?:[-'’_.][\p{L}\p{N}]+)*|[^\s\p{L}\p{N}]"), 0)


def words(c: Column, resplit: bool = True) -> Column:
    """Tokens that are words, parted at / : and . if asked for."""
    t = F.filter(tokenize(c), lambda w: w.rlike(r"[\p{L}\p{N}]"))
    return F.filter(F.flatten(F.transform(t, split_words)), lambda w: w != "") if resplit else t


def remove_stopwords(c: Column, lang: str = "en") -> Column:
    """The text's blank-separated words without stopwords; case counts."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS[lang]])
    return F.array_join(F.filter(F.split(F.trim(c), r"\s+"), lambda w: (w != "") & ~F.array_contains(stop, w)), " ")


def remove_tokens(c: Column, tokens) -> Column:
    """Every occurrence of any token, literally, removed; longer tokens first."""
    return F.regexp_replace(c, "|".join(re.escape(t) for t in sorted(tokens, key=lambda t: (-len(t), t))), "")


def remove_numeric(c: Column) -> Column:
    """Words that are only numbers removed; codes with letters stay."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?<![\w.])-?\d+(?:[.,]\d+)*(?![\w.])", " "), r"\s+", " "))


def extract_mimetypes(c: Column) -> Column:
    """struct(found, text): the media types in a text, and the text without them."""
    known = F.array(*[F.lit(m) for m in MIMETYPES])
    return F.struct(F.filter(known, lambda m: F.contains(c, m)).alias("found"), remove_tokens(c, MIMETYPES).alias("text"))


def collapse_to_bag(values: Column) -> Column:
    """An array of texts as one bag of words."""
    return F.array_join(F.filter(values, lambda v: v.isNotNull() & (v != "")), " ")


def language(c: Column) -> Column:
    """The language whose stopwords make up most of the words; null if none do."""
    ws = F.transform(F.filter(tokenize(c), lambda w: w.rlike(r"^\p{L}+$")), F.lower)
    score = lambda lang: F.size(F.filter(ws, lambda w: w.isin(*STOPWORDS[lang])))
    best = F.greatest(*[F.struct(score(lang).alias("n"), F.lit(lang).alias("lang")) for lang in sorted(STOPWORDS)])
    return F.when(best["n"] > 0, best["lang"])


def is_english(c: Column) -> Column:
    return F.coalesce(language(c) == "en", F.lit(False))


def tagged(docs: DataFrame, text: str, keep: list[str], tagger=None, lemma=None, resplit: bool = True) -> DataFrame:
    """Adds terms, array<struct<token, pos, lemma>>, by a tagger and a lemmatiser of one's own.

    ``tagger(words)`` gives a tag per word, ``lemma(word)`` its base form; both run in
    Python workers. Without them tags are only NUM, WORD or NAME by the word's form,
    and lemmas are the words in lower case.
    """
    ship(docs.sparkSession)

    def plain(ws):
        return ["NUM" if w[:1].isdigit() else "NAME" if w[:1].isupper() else "WORD" for w in ws]

    @F.pandas_udf("array<struct<token:string,pos:string,lemma:string>>")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            out = []
            for ws in b:
                ws = [] if ws is None else list(ws)
                out.append([{"token": w, "pos": p, "lemma": lemma(w) if lemma else w.lower()} for w, p in zip(ws, (tagger or plain)(ws))])
            yield pd.Series(out)

    return docs.select(*keep, tag(words(F.col(text), resplit)).alias("terms"))


def by_pos(terms: Column, parts=()) -> Column:
    """The tokens of these parts of speech, or all."""
    kept = F.filter(terms, lambda t: t["pos"].isin(*parts)) if parts else terms
    return F.transform(kept, lambda t: t["token"])
