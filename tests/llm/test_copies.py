import random
from collections import Counter, defaultdict

import pytest
import siltworks.runtime as runtime
from pyspark.sql import functions as F
from siltworks.llm.copies import count_copies, find_copies, text_key, url_key

SCHEMA = "id bigint, url string, ident string, keep_id bigint, n int"


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("http://H.test/a-b/c?x=1&y=2", "HTTP://h.test//a_b/./c?y=2;x=1&#", True),
        ("http://h.test/a%2Db", "<http://h.test/ab>", True),
        ("http://h.test/q?a=sea+level", "http://h.test/q?a=sea%20level&", True),
        ("http://h.test/a", "https://h.test/a", False),
        ("http://h.test/a?x=1", "http://h.test/a?x=2", False),
        ("http://h.test/a?x=1", "http://h.test/a", False),
        ("http://h.test/a#b", "http://h.test/a", True),
        ("http://h.test/a?x=%zz", "http://h.test/a?x=zz", True),
    ],
)
def test_url_keys(spark, a, b, same):
    k = [r.k for r in spark.createDataFrame([(a,), (b,)], "u string").select(url_key(F.col("u")).alias("k")).collect()]
    assert (k[0] == k[1]) is same


def test_no_keys(spark):
    df = spark.createDataFrame([(None,), ("",), (" ?! ",)], "u string")
    assert all(r == (None, None) for r in df.select(url_key(F.col("u")), text_key(F.col("u"))).collect())


def brute(rows):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, u, d in rows:
        parent.setdefault(i, i)
        for k in (("u", u), ("d", "".join(c for c in d.lower() if c.isalnum()) if d else None)):
            if k[1]:
                by[k].append(i)
    for ids in by.values():
        for i in ids[1:]:
            a, b = sorted((find(ids[0]), find(i)))
            parent[b] = a
    return {i: find(i) for i in parent}


def keys():
    return {"u": url_key(F.col("url")), "i": text_key(F.col("ident"))}


@pytest.mark.parametrize("least", [20_000, 20])
def test_brute_force(spark, least):
    """With and without hot keys: of both keys together, and of one under many others."""
    rng = random.Random(6)
    rows = []
    for i in range(600):
        u = "http://h.test/hot" if rng.random() < 0.3 else rng.choice([None, "", f"http://h.test/{rng.randint(0, 300)}"])
        d = None if u and u.endswith("hot") and rng.random() < 0.5 else rng.choice([None, "", f"ID {rng.randint(0, 250)}", f"id-{rng.randint(0, 250)}"])
        rows.append((i, u, d))
    rows += [(1000 + i, f"http://c.test/{i // 2}", f"c{(i + 1) // 2}") for i in range(80)]  # one long chain
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, 1) for r in rows + rows[:30]], SCHEMA)
    if least == 20:
        assert runtime.hot_keys(df, "url", least=least)
    out = find_copies(df, "id", keys(), least).collect()
    want = brute(rows)
    assert {r.id: r.keep_id for r in out} == want and len(out) == len({r[0] for r in rows})
    counted = {r.keep_id: r.n_copies for r in count_copies(df, "id", keys(), least).collect()}
    assert counted == Counter(want.values())


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert find_copies(df, "id", keys()).count() == 0 and count_copies(df, "id", keys()).count() == 0
