"""Wrong encodings, token ids, packing and abuse: round trips, brute force, held-out cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from siltworks.llm import abuse, mojibake
from siltworks.llm.bpe import BacktrackingBpe, count_tokens, encode_texts, encoder, read_ranks
from siltworks.llm.packing import best_fit_decreasing, pack

# --- wrong encodings -------------------------------------------------------------------

CLEAN = [
    "Die Größe der Flächen wurde geprüft, die Übertragung läuft für alle.", "Les données ont été réalisées près de la côte à 0.5° – n’est-ce pas ?", "Não há correção na região; a estação está fora de operação.", "¿Qué contiene la colección? Años húmedos en la región.",
    "Станция передаёт значения каждые 5 минут, набор данных содержит измерения.", "Το σύνολο περιέχει μετρήσεις στην περιοχή, ο σταθμός στέλνει τιμές.", "Głębokość i źródła błędów: część z błędem urządzenia.", "The archive’s “wave height” series … at 2 µm ± 3 %.", "REGIÃO: MEDIÇÃO DE ÁGUA", "Label “Ã” stands for class A.", "The symbols √, ± and ‰ are used.",
] * 30


@pytest.fixture(scope="module")
def chars():
    return mojibake.Characters(mojibake.count_characters(CLEAN))


def lossy(text, read):
    table = mojibake._bytes_to_chars(read)
    return "".join(table[b] for b in text.encode("utf-8"))


@pytest.mark.parametrize("read", ["cp1252", "cp1250", "cp1251", "cp437", "mac_roman", "latin-1"])
@pytest.mark.parametrize("text", CLEAN[:8])
def test_damage_is_found_and_undone(chars, text, read):
    bad = lossy(text, read)
    spans = mojibake.label(bad, chars)
    assert spans and mojibake.restore(bad, spans) == text


@pytest.mark.parametrize("text", CLEAN[:11])
def test_clean_text_is_clean(chars, text):
    assert mojibake.label(text, chars) == []


def test_other_damage(chars):
    twice = lossy(lossy(CLEAN[1], "cp1252"), "cp1252")
    assert mojibake.restore(twice, mojibake.label(twice, chars)) == CLEAN[1]
    single = CLEAN[4].encode("cp1251").decode("cp1252")
    assert mojibake.label(single, chars)
    lost = CLEAN[0].encode("cp1252").decode("utf-8", "replace")
    assert mojibake.restore(lost, mojibake.label(lost, chars)) is None
    part = CLEAN[0] + " " + lossy(CLEAN[1], "cp1252")
    assert mojibake.restore(part, mojibake.label(part, chars)) == CLEAN[0] + " " + CLEAN[1]


def test_mojibake_rows(spark):
    rows = [("t", i, t) for i, t in enumerate(CLEAN)] + [("t", 9000, lossy(CLEAN[0], "cp1252"))] * 2 + [("t", 9001, None), ("t", 9002, ""), ("d", 9000, "ascii " * 20_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "field_name string, row_id bigint, text string, restored string")
    got = mojibake.find_mojibake(df).collect()
    assert [(r.field_name, r.row_id, r.restored) for r in got] == [("t", 9000, CLEAN[0])]
    assert mojibake.find_mojibake(df.limit(0)).count() == 0


# --- tokens ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    return encoder()


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    from siltworks.llm.bpe import PATTERN

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_merging(bpe, reference, text):
    assert bpe.encode(text) == reference.encode_ordinary(text)
    assert bpe.decode(bpe.encode(text)) == text
    assert bpe.count(text) == len(bpe.encode(text))


def test_long_and_hard_parts(bpe, reference):
    rng = random.Random(1)
    for n in (1, 50, 3000):
        for alphabet in ("ab", "ehlot", "abcdefghijklmnopqrstuvwxyz", "=-", "éß日"):
            t = "".join(rng.choice(alphabet) for _ in range(n))
            assert bpe.encode(t) == reference.encode_ordinary(t)
    assert bpe.encode("<|endoftext|>") == reference.encode_ordinary("<|endoftext|>")


def test_small_vocabulary_needs_steps_back():
    ranks = {bytes([b]): b for b in range(256)}
    for t in (b"ab", b"bc", b"abc", b"cd", b"abcd", b"bcd"):
        ranks[t] = len(ranks)
    e = BacktrackingBpe(ranks, r"(?s).+")

    def merging(raw):
        parts = [bytes([b]) for b in raw]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    for _ in range(500):
        t = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        assert e.encode(t) == merging(t.encode())


def test_token_rows(spark):
    df = spark.createDataFrame([(1, "wave height", 5), (2, "", 5), (3, None, 5), (4, "wave height", 5)], "doc_id bigint, text string, ids int")
    got = {r.doc_id: list(r.ids) for r in encode_texts(df, "doc_id", "text").collect()}
    assert got[1] == got[4] != [] and got[2] == got[3] == []
    assert {r.doc_id: r.n_tokens for r in count_tokens(df, "doc_id", "text").collect()} == {k: len(v) for k, v in got.items()}
    assert encode_texts(df.limit(0), "doc_id", "text").count() == 0


# --- packing -----------------------------------------------------------------------------------


def naive(sizes, cap):
    rooms, out = [], []
    for s in sizes:
        fit = [(r, i) for i, r in enumerate(rooms) if r >= s]
        if fit:
            i = min(fit)[1]
        else:
            i = len(rooms)
            rooms.append(cap)
        rooms[i] -= s
        out.append(i)
    return len(rooms), sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_like_brute_force(cap, sizes):
    sizes = sorted((min(s, cap) for s in sizes), reverse=True)
    bins = best_fit_decreasing(sizes, cap)
    rooms = [cap - sum(s for s, b in zip(sizes, bins) if b == k) for k in range(max(bins, default=-1) + 1)]
    assert (len(rooms), sorted(rooms)) == naive(sizes, cap) and min(rooms, default=0) >= 0


@pytest.mark.parametrize("shard_items", [20_000, 100])
def test_packing_rows(spark, shard_items):
    rng = np.random.default_rng(3)
    rows = [(i, int(s), "x") for i, s in enumerate(rng.geometric(0.01, 2000))] + [(5000, 0, "x"), (5001, None, "x"), (5002, 2500, "x"), (5003, 512, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, size bigint, bin_id string")
    got = pack(df, "doc_id", "size", {"a": 512, "b": 100}, shard_items).toPandas()
    for kind, cap in (("a", 512), ("b", 100)):
        g = got[got.container_kind == kind]
        used = g[g.bin_id.notna()].groupby("bin_id").n_tokens.sum()
        assert used.max() <= cap
        per = g.groupby("doc_id").agg(n=("n_tokens", "sum"), pieces=("piece", "count"))
        for i, s, _ in rows:
            assert per.n[i] == (s or 0)
            assert per.pieces[i] == max(1, -(-(s or 0) // cap))
        assert used.sum() / (len(used) * cap) > (0.99 if shard_items > 5000 else 0.9)
    assert got[(got.doc_id == 5000)].bin_id.isna().all()
    assert pack(df.limit(0), "doc_id", "size", {"a": 512}).count() == 0


def test_sizes_are_read_once(spark):
    """The tokenizer runs once over the texts, whatever is done with their sizes."""
    docs = spark.createDataFrame([(i, "a b c" * i) for i in range(20)], "doc_id bigint, text string")
    plan = pack(count_tokens(docs, "doc_id", "text"), "doc_id", "n_tokens", {"a": 16, "b": 64})._jdf.queryExecution().executedPlan().toString()
    assert plan.partition("Initial Plan")[0].count("ArrowEvalPython") == 1


# --- abuse --------------------------------------------------------------------------------------


# the words of abuse stand in ordinary sentences too
ORDINARY = ["I will send you and your team the data of station {n}.", "You are free to use all data near station {n}.", "The logger at station {n} was replaced after the storm.", "Values of wave height were gridded to {n} degrees.", "The idiot light on the panel stays red until the pump is primed.", "Stop the harvester with kill -9 if the slave node hangs.", "Sex ratio of the krill sample was {n} to {n}."]
TOXIC = ["You are all useless idiots at station {n}, get lost.", "I will kill you and your team.", "free porn movies near station {n} tonight", "Your kind is vermin and should be driven out of station {n}.", "She moaned and spread her legs.", "Crawl back under your rock, you filthy liars."]


def corpus(seed, n=400):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        toxic = rng.random() < 0.2
        s = [rng.choice(ORDINARY) for _ in range(3)] + [rng.choice(TOXIC)] * toxic
        rng.shuffle(s)
        out.append((" ".join(s).replace("{n}", str(rng.randint(1, 99))), toxic))
    return out


def test_held_out_accuracy_under_wrong_judgements():
    rng = random.Random(9)
    # as in the judgements at hand: a few of the ordinary documents are called toxic, fewer the other way round
    model = abuse.fit((t, float(y != (rng.random() < (0.01 if y else 0.04)))) for t, y in corpus(1, 1500))
    held = corpus(2)
    right = sum((model.score(t) >= abuse.THRESHOLD) == y for t, y in held)
    assert right / len(held) > 0.98


@pytest.mark.parametrize("text", ["y o u are all us3less 1diots at station 4, get lost.", "You are all useless idіоts at station 3, get lost", "FREE P-O-R-N MOVIES near station 9 tonight", "I wi​ll kiiiill you and your team", "free p*rn movies near station 2 tonight"])
def test_disguise(text):
    model = abuse.fit((t, float(y)) for t, y in corpus(1))
    assert model.score("The logger was replaced. " + text) >= abuse.THRESHOLD


def test_abuse_rows(spark):
    docs = [(i, "s", t, 1) for i, (t, _) in enumerate(corpus(1))] + [(9000, "s", None, 1), (9001, None, "", 1), (9002, "s", "word " * 50_000, 1)]
    labels = [(i, int(y), 0.5) for i, (_, y) in enumerate(corpus(1))] + [(None, 1, 0.5), (3, None, 0.5), (777_777, 1, 0.5)]
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string, score int")
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int, score double")
    got = {r.doc_id: r for r in abuse.score_documents(d, lab).collect()}
    assert len(got) == len(docs)
    assert got[9000].score is None and not got[9000].abusive and got[9001].score == 0.0 and not got[9002].abusive
    assert sum(got[i].abusive == y for i, (_, y) in enumerate(corpus(1))) > 390
    assert {r.score for r in abuse.score_documents(d, lab.limit(0)).where("score IS NOT NULL").collect()} == {0.0}
    assert abuse.score_documents(d.limit(0), lab).count() == 0


def test_markup_is_no_hiding_place():
    """Names of tags and attributes are no words, however long the tag; what is written in them is."""
    from siltworks.llm.abuse import passages

    long = "<a " + " ".join(f"name{i}=\"v\"" for i in range(200)) + ">"
    assert {w for p in passages(f"one {long} two") for w in p} == {"one", "two", "v"}
    assert passages("x <img alt='bad words here'> y") == [["x"], ["bad", "words", "here"], ["y"]]
    assert passages("x <!-- bad > words --> y") == [["x"], ["bad"], ["words"], ["y"]]
    assert passages("<b>x</b><br/>y") == [["x"], ["y"]]
