"""Abusive, hateful or sexual content.

Two Kneser-Ney bigram models over words, one of toxic and one of ordinary
passages. A passage's score is the length-normalised difference of its
log-likelihoods; a document's is that of its best passage, a window of words, so
one bad sentence in a long text counts in full. Both models back off to the same
continuation counts, pooled from both classes: an expression that is rare in both
gets no preference from its rarity.

Training: people judged whole documents, some wrongly, while abuse stands in single
sentences. So the toxic class begins with all passages of documents judged toxic
and is then sharpened by a few rounds of expectation-maximisation: each passage
weighs as much as the present models hold it for toxic. A few wrong judgements in
the ordinary class do little harm, as rare histories back off (TRUST).

Disguise is undone before anything is counted: compatibility forms, invisible
characters, look-alike letters of other scripts, digits and signs for letters,
letters drawn out or set apart, masks of stars.

Defined results: a null text has no score; texts without words score 0. Documents
without judgement are scored like all others; tables without a toxic judgement
give scores of 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship, spread

#: judged documents that the models are fitted on, at most, of each class
FIT_TOXIC, FIT_ORDINARY = 6_000, 14_000
ROUNDS = 4
#: words of a window; shorter passages are filled up with zeros to LEAST words
WINDOWS, LEAST = (3, 5, 8), 3
THRESHOLD = 2.0
DISCOUNT, TRUST = 0.75, 3.0
#: prior share of toxic passages in documents judged toxic
PRIOR = 0.2

# Letters of other scripts and signs that stand for Latin letters.
LOOK_ALIKE = str.maketrans("авекмнорстухіјѕԁԛԝһӏαεικνορτυχ", "abekmhopctyxijsdqwhlaeikvoptux")
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}

_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁤︀-️﻿]")
_APART = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][-_.* ]){2,}[^\W\d_](?![^\W\d_])")
_WORD = re.compile(r"[^\W_][^\W_]*(?:[@$!|*€0-9]+[^\W_]+)*|[@$€][^\W_]+(?:[@$!|*€]+[^\W_]*)*|[.!?\n<>]+")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_COMMENT = re.compile(r"<!--(.*?)(?:-->|\Z)", re.S)
_TAG = re.compile(r"</?[a-z!?][^<>]*>|&[a-z]{2,6};", re.I)
_HELD = re.compile(r"=\s*(?:\"([^\"]*)\"|'([^']*)')")


def _held(m: re.Match) -> str:
    """A tag's attribute values as passages of their own; names of tags and attributes are no words."""
    return " . ".join(["", *(a or b for a, b in _HELD.findall(m[0])), ""]) if "=" in m[0] else " . "


def _undisguise(w: str) -> str:
    if w.isalpha() and w.isascii():
        return w
    if w.isdigit():
        return "#"
    if not w.isascii():
        folded = w.translate(LOOK_ALIKE)
        # only a word of mixed scripts is a disguise
        if any("a" <= c <= "z" for c in w) and folded.isascii():
            w = folded
    if "*" in w:
        return f"{w[0]}*{w[-1]}"
    if not w.isalpha() and any(c.isalpha() for c in w):
        digits = sum(c.isdigit() for c in w)
        if digits * 2 < len(w):
            w = "".join(SIGNS.get(c, c) for c in w)
    return w if w.isalpha() else "#"


def passages(text: str) -> list[list[str]]:
    """The text's words, undisguised, parted at the ends of sentences."""
    t = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower()
    t = _TAG.sub(_held, _COMMENT.sub(r" . \1 . ", t) if "<!--" in t else t)
    t = _APART.sub(lambda m: re.sub(r"[-_.* ]", "", m[0]), t)
    t = _DRAWN.sub(r"\1", t)
    out: list[list[str]] = [[]]
    for w in _WORD.findall(t):
        if w[0] in ".!?\n<>":
            if out[-1]:
                out.append([])
        else:
            out[-1].append(_undisguise(w))
    if not out[-1]:
        out.pop()
    return out


class KneserNey:
    """An interpolated bigram model whose last resort is given from outside."""

    def __init__(self, weighted, shared: dict[str, float], unseen: float):
        pair: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        for words, weight in weighted:
            last = "<s>"
            for w in words:
                pair[last][w] += weight
                last = w
        after: Counter = Counter()
        for h, ws in pair.items():
            for w, n in ws.items():
                after[w] += min(1.0, n)
        total = sum(after.values()) or 1.0
        kinds = sum(min(1.0, n) for n in after.values())
        self.rest = DISCOUNT * kinds / total
        self.word = {w: max(n - DISCOUNT, 0.0) / total for w, n in after.items()}
        self.shared, self.unseen = shared, unseen
        self.pair: dict[str, dict[str, float]] = {}
        self.back: dict[str, float] = {}
        for h, ws in pair.items():
            n = sum(ws.values())
            if n <= 0:
                continue
            # a history of little weight says little: it backs off by TRUST more
            self.pair[h] = {w: max(c - DISCOUNT * min(1.0, c), 0.0) / (n + TRUST) for w, c in ws.items()}
            self.back[h] = (DISCOUNT * sum(min(1.0, c) for c in ws.values()) + TRUST) / (n + TRUST)

    def p(self, h: str, w: str) -> float:
        low = self.word.get(w, 0.0) + self.rest * self.shared.get(w, self.unseen)
        b = self.back.get(h)
        return low if b is None else self.pair[h].get(w, 0.0) + b * low


class AbuseModel:
    """Log-likelihood ratios of words after words."""

    def __init__(self, toxic: KneserNey, ordinary: KneserNey):
        self.toxic, self.ordinary = toxic, ordinary
        self.memo: dict[tuple[str, str], float] = {}

    def ratios(self, words: list[str]) -> list[float]:
        out, last, memo = [], "<s>", self.memo
        for w in words:
            r = memo.get((last, w))
            if r is None:
                r = math.log(self.toxic.p(last, w) / self.ordinary.p(last, w))
                if w not in self.toxic.word and w not in self.ordinary.word:
                    r = min(r, 0.0)  # a word that neither class knows says nothing
                if len(memo) < 1 << 20:
                    memo[last, w] = r
            out.append(r)
            last = w
        return out

    def passage(self, words: list[str]) -> float:
        """The best mean over a window of the passage."""
        r = self.ratios(words)
        n = len(r)
        if n <= LEAST:
            return sum(r) / LEAST
        best = -math.inf
        sums = [0.0]
        for x in r:
            sums.append(sums[-1] + x)
        for k in WINDOWS:
            if k > n:
                break
            # a short window must stand out more to be a passage of its own
            scale = k / (k + 2.0)
            m = max(sums[i + k] - sums[i] for i in range(n - k + 1)) / k * scale
            if m > best:
                best = m
        return best

    def score(self, text: str | None) -> float | None:
        if text is None:
            return None
        return max((self.passage(p) for p in passages(text)), default=0.0)


def fit(judged) -> AbuseModel | None:
    """The models of judged documents, given as (text, share of toxic judgements)."""
    toxic: Counter = Counter()
    ordinary: Counter = Counter()
    n_toxic = 0
    for text, share in judged:
        if not text:
            continue
        to = toxic if share >= 0.5 else ordinary
        n_toxic += share >= 0.5
        for p in passages(text):
            to[tuple(p)] += 1
    if not n_toxic or not ordinary:
        return None
    follows: dict[str, set] = defaultdict(set)
    for counted in (toxic, ordinary):
        for words in counted:
            last = "<s>"
            for w in words:
                follows[w].add(last)
                last = w
    total = sum(map(len, follows.values()))
    shared = {w: len(s) / (total + len(follows) + 1) for w, s in follows.items()}
    unseen = 1.0 / (total + len(follows) + 1)

    # judgements of ordinary documents stand: they are many, and few of them wrong
    usual = KneserNey(ordinary.items(), shared, unseen)
    weight = dict.fromkeys(toxic, 1.0)
    built = lambda: AbuseModel(KneserNey(((p, n * weight[p]) for p, n in toxic.items() if weight[p] > 1e-3), shared, unseen), usual)
    model = built()
    odds = math.log(PRIOR / (1 - PRIOR))
    for _ in range(ROUNDS):
        for p in toxic:
            x = sum(model.ratios(list(p))) + odds
            weight[p] = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))
        model = built()
    return model


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, source, score, abusive) of all documents.

    The models are fitted on at most FIT_TOXIC + FIT_ORDINARY judged documents, the
    first ones by a hash of their id, and so have a bounded size; every document is
    scored whole, where it lies. Only (doc_id, judgement) rows are shuffled.
    """
    spark = docs.sparkSession
    ship(spark)
    share = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("toxic").alias("share"))
    order = F.xxhash64("doc_id")
    chosen = share.where("share >= 0.5").orderBy(order).limit(FIT_TOXIC).unionAll(share.where("share < 0.5").orderBy(order).limit(FIT_ORDINARY))
    # the chosen judgements are bounded by the two limits
    judged = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "share")
    model = fit((r.text, r.share) for r in judged.toLocalIterator())
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            s = [m.score(t) if m and isinstance(t, str) else (0.0 if isinstance(t, str) else None) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "score": pd.Series(s, dtype="float64")})

    out = spread(docs.select("doc_id", "source", "text")).mapInPandas(scored, "doc_id bigint, source string, score double")
    return out.withColumn("abusive", F.coalesce(F.col("score") >= threshold, F.lit(False)))
