import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from siltworks.operators.packed import parse_field, split_packed


def terms(text, blanks=False):
    return [t for t, _ in parse_field(text, blanks)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("a; b|c", ["a", "b", "c"]),
        ("a > b &gt; c", ["a", "b", "c"]),
        ("Basin, Veldra\n  13C isotope", ["Basin, Veldra", "13C isotope"]),
        ("0,5 mm; ;x;", ["0,5 mm", "x"]),
        ("a, b,, c", ["a", "b", "c"]),
        ('"North > South", x', ["North > South", "x"]),
        ('"so-called ""wind; gusts"""; y', ['so-called "wind; gusts"', "y"]),
        ("'a; b' ; farmers' wells", ["a; b", "farmers' wells"]),
        ("“fresh | saline” |x", ["fresh | saline", "x"]),
        (r"sand\, silt\; clay, ATMO", ["sand, silt; clay", "ATMO"]),
        ('["Halvern, Port of", "b \\"q\\" \\u00e9"]', ["Halvern, Port of", 'b "q" é']),
        ("{a ,b}", ["a", "b"]),
        ("a； b", ["a", "b"]),
        ("one value", ["one value"]),
        ("A*-class buoys", ["A*-class buoys"]),
        ("biota: fish + x", ["biota: fish", "x"]),
        (None, []),
        ("", []),
        (" ;; , ", []),
        ("[]", []),
        ("x" * 100_000 + ";y", ["x" * 100_000, "y"]),
    ],
)
def test_values(text, want):
    got = terms(text)
    assert got == want or (want == [] and got in ([], [","]))


def test_blanks_only_where_asked():
    assert terms('lidar "soil moisture" snow', True) == ["lidar", "soil moisture", "snow"]
    assert terms("lidar snow") == ["lidar snow"]
    assert terms("soil moisture; snow", True) == ["soil moisture", "snow"]


def test_malformed_quote_backtracks():
    assert parse_field('"a; b; c') == [('"a', True), ("b", False), ("c", False)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("[a; b]; c", [("a; b", False), ("c", False)]),
        ("(a;b);(c;d)", [("a;b", False), ("c;d", False)]),
        ("[[a;b];c]; {d|e}", [("[a;b];c", False), ("d|e", False)]),
        ("[a], [b, c]", [("a", False), ("b, c", False)]),
        ("[a; b", [("[a", True), ("b", False)]),
        ("[a; (b); c", [("[a", True), ("b", False), ("c", False)]),
        ("(WMS) service; x", [("(WMS) service", False), ("x", False)]),
        (r"[a\]; b]; c", [("a]; b", False), ("c", False)]),
        ("[]; a", [("a", False)]),
    ],
)
def test_bracketed_items(text, want):
    assert parse_field(text) == want


@pytest.mark.parametrize("item", ["“a;", "'a;", '"a;', "[a;", "(a);"])
def test_long_malformed_fields_take_linear_time(item):
    assert len(parse_field(item * 50_000)) == 50_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc ,;|\"'\\>&[]{}“”", max_size=12), max_size=5).map(";".join))
def test_never_fails(text):
    for t in terms(text) + terms(text, True):
        assert t == t.strip() and t


@given(st.lists(st.text("abc ,;|'>+", min_size=1, max_size=8).filter(lambda s: s.strip() and s == s.strip()), min_size=2, max_size=6))
@settings(max_examples=100, deadline=None)
def test_round_trip_of_quoted(values):
    assert terms("; ".join('"' + v.replace('"', '""') + '"' for v in values)) == values


def test_rows(spark):
    rows = [("f", 1, "a;b"), ("f", 1, "a;b"), ("g", 1, "x y"), ("f", 2, None), ("f", 3, "a;a")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "field_name string, row_id bigint, packed string, pos int")
    got = {(r.field_name, r.row_id, r.pos, r.term, r.n_terms) for r in split_packed(df, ("g",)).collect()}
    assert got == {("f", 1, 0, "a", 2), ("f", 1, 1, "b", 2), ("g", 1, 0, "x", 2), ("g", 1, 1, "y", 2), ("f", 3, 0, "a", 2), ("f", 3, 1, "a", 2)}
    assert split_packed(df.limit(0)).count() == 0
