import pytest
from pyspark.sql import functions as F

from quadrille.functions import names, normal, scalars


@pytest.mark.parametrize(
    ("name", "family", "given"),
    [
        ("B. Carol Dune", "Dune", "B. Carol"), ("B. C. Dune", "Dune", "B. C."), ("B.C. Dune", "Dune", "B.C."), ("Dune, B.", "Dune", "B."), ("Dune B C", "Dune", "B C"), ("le Roi, J.", "le Roi", "J."),
        ("de Mar A.J.", "de Mar", "A.J."), ("Van Dorn M. X.", "Van Dorn", "M. X."), ("van Dorn MX", "van Dorn", "MX"), ("R.P. Gnan .", "Gnan", "R.P."), ("(Pat) Hill-Dale, J.S.", "Hill-Dale", "J.S."),
        ("Ken Kodama", "Kodama", "Ken"), ("DUNE", "Dune", ""), ("Dune,", "Dune,", "Dune,"), ("", "", ""), ("HILL-DALE, JOHN", "Hill-Dale", "John"),
    ],
)
def test_names(name, family, given):
    assert names.parse(name) == (family, given)


def test_author_forms():
    assert set(names.author_forms("Dune", "Carol B.")) == {("A1", "dune, c"), ("A2", "dune, c b"), ("B1", "dune, carol"), ("B2", "dune, carol b")}
    assert set(names.author_forms("widget", "red")) == {("A1", "widget, r"), ("B1", "widget, red"), ("RB1", "red, widget")}
    assert ("B1", "lopez, maria") in names.author_forms("Garcia Lopez", "María")
    assert ("C1", "lopez, maria garcia") in names.author_forms("Garcia Lopez", "María")
    assert names.author_forms("Dune", "") == []


#: Given name -> forms of "Dune", by the written rules.
GRID = {
    "ann": {"A1": "a", "B1": "ann"}, "Ann": {"A1": "a", "B1": "ann"}, "A.": {"A1": "a"}, "A. B.": {"A1": "a", "A2": "a b"}, "A.B.C.": {"A1": "a", "A2": "a b", "A3": "a b c"}, "ABC": {"A1": "a", "A2": "a b", "A3": "a b c"},
    "ann bea": {"A1": "a", "A2": "a b", "B1": "ann", "B2": "ann b", "C1": "ann bea"},
    "ann bea cy": {"A1": "a", "A2": "a b", "A3": "a b c", "B1": "ann", "B2": "ann b", "B3": "ann b c", "C1": "ann bea", "C2": "ann bea c", "C3": "ann bea cy"},
    "ann B.": {"A1": "a", "A2": "a b", "B1": "ann", "B2": "ann b"}, "A. bea": {"A1": "b", "A2": "a b", "B1": "bea", "B2": "a bea"},
    "ann B. C.": {"A1": "a", "A2": "a b", "A3": "a b c", "B1": "ann", "B2": "ann b", "B3": "ann b c"},
    "ann B. cy": {"A1": "a b", "A2": "a b c", "A3": "a b c", "B1": "ann b", "B2": "ann b c", "B3": "ann b c", "C1": "ann b cy", "C2": "ann b cy"},
    "J-P": {"A1": "j"}, "j-p": {"A1": "j", "B1": "j-p"}, "": {}, " . ": {},
}


@pytest.mark.parametrize("given", sorted(GRID))
def test_author_forms_by_rule(given):
    found = [(level, value) for level, value in names.author_forms("Dune", given) if level[0] != "R"]
    wanted = {(level, f"dune, {value}") for level, value in GRID[given].items()}
    if "-" in given:
        wanted |= {("A1", "dune, j"), ("A2", "dune, j p")} | ({("B1", "dune, j"), ("B2", "dune, j p"), ("C1", "dune, j p")} if given.islower() else set())
    assert set(found) == wanted and len(found) == len(set(found))


def test_reversed_forms():
    forms = lambda f, g: {x for x in names.author_forms(f, g) if x[0][0] == "R"}
    assert forms("Dune", "Ann Bea") == {("RB1", "annbea, dune")}
    assert forms("Dune Low", "Ann") == {("RB1", "ann, dune"), ("RB1", "anndune, low")}
    assert forms("du la Ro", "a be ce") == {("RB1", "abece, du"), ("RC1", "abece, du la"), ("RC3", "abece, du la ro"), ("RB1", "abecedu, la"), ("RC1", "abecedu, la ro")}
    assert forms("Dune", "Ann B.") == set()


def column(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_strings(spark):
    assert column(spark, "a-b-c", lambda x: scalars.strbefore(x, "-")) == "a"
    assert column(spark, "abc", lambda x: scalars.strbefore(x, "-")) == ""
    assert column(spark, "a-b-c", lambda x: scalars.strafter(x, "-")) == "b-c"
    assert column(spark, None, lambda x: scalars.strafter(x, "-")) is None
    assert column(spark, "http://x.org/a#12ab", scalars.localname) == "ab"
    assert column(spark, "Étude: Wheat (2)", scalars.slug) == "tude-wheat-2"
    assert column(spark, "Łódź é", scalars.strip_accents) == "Lodz e"
    assert column(spark, "institute of the north", scalars.capitalize_words) == "Institute of the North"
    assert column(spark, "2020-01-02", scalars.to_timestamp_text) == "2020-01-02T00:00:00Z"
    assert column(spark, "no date", scalars.to_timestamp_text) is None
    assert column(spark, "2020-01", scalars.year_of) == 2020


@pytest.mark.parametrize(
    ("label", "form", "short"),
    [
        ("ABC", "abc", "ABC"), ("(ABC)", "", "ABC"), ("A.B.C.", "abc", "A.B.C."), ("Institute for the Study of Wheat", "institute study wheat", None), ("Food & Farm (FAF)", "food and farm", "FAF"), ("R&D Institute", "rd institute", None),
        ("ABC-Institute of Farms", "institute farms", "ABC"), ("BMGF-Bill and Melinda (BMG)", "bill and melinda", "BMGF BMG"), ("ABC-DEF of Farms", "abcdef farms", None), ("ABC-FARM", "abcfarm", "ABC-FARM"), ("ABC-farm", "farm", "ABC"),
        ("Centre de Génétique", "centre de gntique", None), ("Farm (north)", "farm north", None), ("Farm (N.O.)  ", "farm", "NO"), ("ABCDEFGHIJ", "abcdefghij", None), ("&", "and", None), ("", "", None), (" ", "", None), ("  ABC", "abc", None),
    ],
)
def test_organizations(spark, label, form, short):
    row = column(spark, label, normal.organization)
    assert (row["form"], row["abbreviation"]) == (form, short)


def test_titles(spark):
    assert column(spark, "Wheat-Rust [Review] of Élan & Form", normal.title) == "wheat rust of elan and form"
    assert column(spark, "R&D & [a] b-[c] &x Ạ̈́ Й \t& ", normal.title) == "r&d and b &x a и and"
    assert column(spark, "", normal.title) == ""
    assert column(spark, None, normal.title) is None
