import random

import pytest
from siltworks.operators.hierarchy import CYCLE, descendants, resolve_forest

LINKS = "tree string, node string, parent string, depth int, next string"


def brute(links):
    parent = {}
    for t, n, p in links:
        if n is None:
            continue
        k = (t, n)
        parent[k] = p if parent.get(k) is None else min(parent[k], p) if p is not None else parent[k]
    out = {}
    for k in parent:
        path, cur = [k[1]], k
        while True:
            p = parent[cur]
            if p is None or (k[0], p) not in parent:
                out[k] = (path[-1], len(path) - 1, path[::-1])
                break
            cur = (k[0], p)
            path.append(p)
            if len(path) > len(parent) + 1:
                out[k] = (CYCLE, -1, [])
                break
    return out


def run(spark, links, **kw):
    df = spark.createDataFrame([(*x, 1, "z") for x in links], LINKS)
    rows = resolve_forest(df, with_path=True, **kw).collect()
    got = {(r.tree, r.node): (r.root_node, r.node_depth, list(r.path)) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("seed, every", [(1, 16), (2, 3), (3, 10_000)])
def test_random_graphs(spark, seed, every):
    rng = random.Random(seed)
    links = [("a", f"n{i}", rng.choice([f"n{rng.randint(0, 199)}", f"n{max(0, i - 1)}", None, "gone", ""])) for i in range(200)]
    links += [("a", f"c{i}", f"c{i - 1}" if i else None) for i in range(130)]  # a long chain
    links += [("b", "x", "y"), ("b", "y", "x"), ("b", "z", "x"), ("b", "s", "s"), ("b", "n1", None), ("b", None, "x")]
    links += links[:20]
    assert run(spark, links, every=every) == brute(links)


def test_paths_do_not_grow_around_loops(spark):
    """A loop without splitter that much hangs from: its rows must not carry its length."""
    loop = [("a", f"l{i}", f"l{(i + 1) % 400}") for i in range(400)] + [("a", f"t{i}", f"l{i % 400}") for i in range(400)]
    chain = [("a", f"c{i}", f"c{i - 1}" if i else None) for i in range(50)]
    assert run(spark, loop + chain, every=100_000) == brute(loop + chain)


def test_pieces_of_paths_are_not_broadcast(spark):
    df = spark.createDataFrame([("a", f"n{i}", f"n{i // 2}" if i else None, 1, "z") for i in range(300)], LINKS)
    plan = resolve_forest(df, with_path=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_star(spark):
    links = [("a", "hub", None)] + [("a", f"n{i}", "hub") for i in range(500)]
    got = run(spark, links)
    assert all(got["a", f"n{i}"][:2] == ("hub", 1) for i in range(500))


def test_descendants(spark):
    links = [("a", "1", None), ("a", "2", "1"), ("a", "3", "2"), ("a", "4", "2"), ("a", "x", "x")]
    df = spark.createDataFrame([(*x, 1, "z") for x in links], LINKS)
    got = {(r.node, r.descendant, r.distance) for r in descendants(resolve_forest(df, with_path=True)).collect()}
    assert got == {("1", "2", 1), ("1", "3", 2), ("1", "4", 2), ("2", "3", 1), ("2", "4", 1)}


def test_empty(spark):
    assert run(spark, []) == {}
