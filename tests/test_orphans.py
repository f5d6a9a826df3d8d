"""Orphans against brute force on a random fixture with a hot key."""

import random
from datetime import datetime, timedelta

import siltworks.runtime as runtime
from siltworks.operators import orphans
from siltworks.operators.orphans import Target, orphan_edges

T0 = datetime(2015, 1, 1)
EDGES = "edge_id bigint, src_id string, src_kind string, relate string, object_id string, recorded_at timestamp_ntz, salt string, depth int"
ROWS = "object_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, kind string"


def uid(k):
    return f"{k:032x}"


def dress(rng, h):
    u = f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"
    return rng.choice([f"urn:uuid:{u}", f" URN:UUID:{u.upper()}", u, "{" + u + "}", h])


def brute(edges, a, b):
    def key(x):
        return "".join(c for c in x.lower().replace("urn:uuid:", "") if c in "0123456789abcdef")[-32:]

    tables = {"refsa": ("a", a), "refsb": ("b", b)}
    judged = {}
    for e in edges:
        if e[3] is None or e[4] is None:
            continue
        rel = "".join(c for c in e[3].lower() if c.isalnum())
        if rel not in tables:
            continue
        name, rows = tables[rel]
        k = key(e[4])
        alive = e[5] is not None and any(key(r[0]) == k and r[1] <= e[5] and (r[2] is None or r[2] > e[5]) for r in rows)
        judged[e[0]] = (alive, name, k, {"dataset": "a", "description": "b"}.get(e[2]), key(e[1]) if e[1] else None)
    faulty = {j[3:] for j in judged.values() if not j[0] and j[3] and j[4]}
    while True:
        more = {j[3:] for j in judged.values() if j[0] and j[1:3] in faulty and j[3] and j[4]} - faulty
        if not more:
            break
        faulty |= more
    return {i for i, j in judged.items() if not j[0]}, {i for i, j in judged.items() if j[0] and j[1:3] in faulty}


def fixture(seed=1, n=600):
    rng = random.Random(seed)
    at = lambda: T0 + timedelta(hours=rng.randint(0, 400))
    rows = {}
    for t in "ab":
        rows[t] = []
        for k in range(60):
            for _ in range(rng.choice([1, 1, 1, 2])):
                begin = at()
                rows[t].append((dress(rng, uid(k)), begin, rng.choice([None, None, begin + timedelta(hours=rng.randint(0, 100))]), "x"))
    edges = []
    for i in range(n):
        k = 7 if rng.random() < 0.33 else rng.randint(0, 70)
        edges.append((i, rng.choice([None, dress(rng, uid(rng.randint(0, 60)))]), rng.choice(["dataset", "description", None]), rng.choice(["refs:a", "REFS_A ", "refs:b", "refs:b", "odd", None]), rng.choice([dress(rng, uid(k)), dress(rng, uid(k)), dress(rng, uid(k)), None, "not a key"]), rng.choice([at(), at(), at(), None]), "s", 3))
    return edges + edges[:40], rows


def run(spark, edges, rows, **kw):
    targets = [Target(t, spark.createDataFrame(rows[t], ROWS)) for t in "ab"]
    out = orphan_edges(spark.createDataFrame(edges, EDGES), targets, {"refs:a": "a", "refs:b": "b"}, {"dataset": "a", "description": "b"}, **kw).collect()
    return {r.edge_id for r in out if r.orphan == "direct"}, {r.edge_id for r in out if r.orphan == "inherited"}, out


def test_brute_force(spark):
    edges, rows = fixture()
    direct, inherited, out = run(spark, edges, rows)
    assert (direct, inherited) == brute(edges, rows["a"], rows["b"])
    assert len(out) == len({(r.edge_id, r.orphan) for r in out})


def test_salted_hot_key(spark):
    edges, rows = fixture(5)
    hot = runtime.hot_keys(spark.createDataFrame(edges, EDGES).select(orphans.uuid_key("object_id").alias("k")), "k", least=20)
    assert hot and max(hot.values()) > 1 and len(hot) <= runtime.shuffle_width(spark)
    direct, inherited, _ = run(spark, edges, rows, least=20)
    assert (direct, inherited) == brute(edges, rows["a"], rows["b"])


def test_empty_tables(spark):
    edges, rows = fixture(2, 50)
    assert run(spark, [], rows)[2] == []
    direct, inherited, _ = run(spark, edges, {"a": [], "b": []})
    assert (direct, inherited) == brute(edges, [], [])
