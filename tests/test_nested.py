import json
import random

from siltworks.operators.nested import flatten_lists

L = ("relationships", "urls", "layers", "webpages")


def members(v):
    if isinstance(v, str) and v.strip()[:1] in ("[", "{", '"'):
        try:
            return members(json.loads(v))
        except ValueError:
            return []
    if isinstance(v, list):
        return [y for x in v for y in members(x)]
    if isinstance(v, dict) and v:
        if all(k.isdigit() for k in v):
            return [y for x in v.values() for y in members(x)]
        k = next(iter(v))
        if len(v) == 1 and k not in L and isinstance(v[k], (list, dict)):
            return members(v[k])
        return [v]
    return []


def walk(i, v, out):
    for x in v if isinstance(v, list) else ():
        walk(i, x, out)
    if isinstance(v, dict):
        for k, x in v.items():
            if k in L:
                for p, m in enumerate(members(x)):
                    out.append((i, v.get("object_id") or "", k, p, m.get("object_id") or ""))
                    walk(i, m, out)
            else:
                walk(i, x, out)


def make(rng, depth):
    o = {"title": rng.choice(["a", "x [1]", ""])}
    if rng.random() < 0.8:
        o["object_id"] = f"u{rng.randint(0, 999)}"
    if rng.random() < 0.3:
        o["style"] = {"legend": {"w": 1}, **({"layers": [{"object_id": "in"}]} if rng.random() < 0.3 else {})}
    for name in L:
        if depth and rng.random() < 0.45:
            got = [make(rng, depth - 1) for _ in range(rng.randint(0, 3))]
            shape = rng.randint(0, 7)
            o[name] = [got, {str(i): x for i, x in enumerate(got)}, got[0] if got else {}, {name[:-1]: got}, json.dumps(got), [got, None], None, ""][shape]
    return o


def test_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, json.dumps(make(rng, 4))) for i in range(150)]
    deep = {"object_id": "d"}
    for k in range(12):
        deep = {"object_id": f"d{k}", "layers": [deep]}
    docs += [(900, json.dumps(deep)), (901, '{"layers": [{"object_id": "cut"'), (902, ""), (903, None), (904, "[1]"), (905, '"text"'), (906, "{}")]
    docs += docs[:10]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc bigint, body string, object_id string, pos int")
    got = sorted((r.doc, r.parent_id, r.list_name, r.pos, r.object_id) for r in flatten_lists(df, "doc", "body", L).collect())
    want = []
    for i, b in dict(docs).items():
        try:
            v = json.loads(b or "")
        except ValueError:
            continue
        if isinstance(v, dict):
            walk(i, v, want)
    assert got == sorted(want)


def test_numbered_members_keep_their_order(spark):
    body = '{"object_id": "o", "urls": {"0": {"object_id": "a"}, "1": {"object_id": "b"}, "10": {"object_id": "c"}, "2": {"object_id": "d"}}}'
    df = spark.createDataFrame([(1, body)], "doc bigint, body string")
    assert [r.object_id for r in flatten_lists(df, "doc", "body", L).orderBy("pos").collect()] == ["a", "b", "c", "d"]


def test_any_number_of_packings(spark):
    one = {"object_id": "a"}
    docs, want = [], []
    for depth in (1, 5, 12):
        for i, wrap in enumerate([lambda v: [v], lambda v: {"layer": [v]}, lambda v: {"0": v}, lambda v: json.dumps([v]), json.dumps, lambda v: "\n " + json.dumps([[v]])]):
            v = [one, None, one]
            for _ in range(depth if i < 4 or depth < 6 else 6):
                v = wrap(v)
            docs.append((depth * 10 + i, "\ufeff" + json.dumps({"object_id": "o", "layers": v, "other": json.dumps({"urls": v})})))
            want += [(depth * 10 + i, p, n, k, "a") for n, p in (("layers", "o"), ("urls", "")) for k in (0, 1)]
    got = [(r.doc, r.parent_id, r.list_name, r.pos, r.object_id) for r in flatten_lists(spark.createDataFrame(docs, "doc bigint, body string"), "doc", "body", L).collect()]
    assert sorted(got) == sorted(want)


def test_empty(spark):
    assert flatten_lists(spark.createDataFrame([], "doc bigint, body string"), "doc", "body", L).count() == 0


def test_packed_bodies(spark):
    rng = random.Random(5)
    objects = [make(rng, 4) for _ in range(60)]
    shapes = [lambda o: json.dumps(json.dumps(o)), lambda o: json.dumps([o, None, "x"]), lambda o: "\n\t\r " + json.dumps(o) + " \n", lambda o: json.dumps("\n" + json.dumps([[o], o])), lambda o: json.dumps([json.dumps(o)]), lambda o: json.dumps(json.dumps(json.dumps(json.dumps(json.dumps(json.dumps(o))))))]
    held = [lambda o: o, lambda o: [o], lambda o: o, lambda o: [[o], o], lambda o: [o], lambda o: o]
    docs, want = [], []
    for i, o in enumerate(objects):
        docs.append((i, shapes[i % 6](o)))
        walk(i, held[i % 6](o), want)
    docs += [(900, json.dumps('{"layers": [{"object_id": "cut"')), (901, '"{\\"layers\\": [{}]}"] x'), (902, '"text"'), (903, "[1]"), (904, "null"), (905, '"'), (906, '""')]
    got = [(r.doc, r.parent_id, r.list_name, r.pos, r.object_id) for r in flatten_lists(spark.createDataFrame(docs, "doc bigint, body string"), "doc", "body", L).collect()]
    assert len(want) > 100 and sorted(got) == sorted(want)
