import pytest

from corpusmill.llm.pii import Finder, find_pii, pii_values, replaced

GIVEN = ["Loskiel", "Gounda", "Wemin", "Talis", "Roulmo", "Condune", "Vixard"]
FAMILY = ["Loskova", "Daphova", "Torova", "Wunolova", "Wemquist", "Houmquist", "Tairquist", "Nexquist", "Marsh"]


@pytest.fixture(scope="module")
def finder():
    return Finder(GIVEN, FAMILY)


def values(finder, text):
    return [(k, text[s:e]) for k, s, e in finder.find(text)]


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("write to a.b+c@mail.x-y.example and", "email", "a.b+c@mail.x-y.example"),
        ("mail kreta15 [at] post [dot] x-y [dot] test now", "email", "kreta15 [at] post [dot] x-y [dot] test"),
        ("mail A_B@C-D.EXAMPLE.", "email", "A_B@C-D.EXAMPLE"),
        ("ask me.you AT far-off DOT example today", "email", "me.you AT far-off DOT example"),
        ("ask lx @ far.example", "email", "lx @ far.example"),
        ("ask d_e (at) far.test today", "email", "d_e (at) far.test"),
        ("Call +44 (0)20 7946 0880 now", "phone", "+44 (0)20 7946 0880"),
        ("Call (720) 555-0127 x12 now", "phone", "(720) 555-0127 x12"),
        ("Call 030/23125930.", "phone", "030/23125930"),
        ("tel. 01 99 00 33 37, weekdays", "phone", "01 99 00 33 37"),
        ("Call 00442079460355 and", "phone", "00442079460355"),
        ("or 773‑555‑0137 there", "phone", "773‑555‑0137"),
        ("my phone number 735-555-0185 here", "phone", "735-555-0185"),
        ("the turnip: 219-555-0164.", "phone", "219-555-0164"),
        ("by Mrs Wepho Unknownova after", "name", "Wepho Unknownova"),
        ("then Dr. Angela Merkel said", "name", "Angela Merkel"),
        ("met Dr. Anne Smith there", "name", "Anne Smith"),
        ("as told by Mr James Bond.", "name", "James Bond"),
        ("a novel by Virginia Woolf, read", "name", "Virginia Woolf"),
        ("Foto von Frau Jürgen Müller gezeigt", "name", "Jürgen Müller"),
        ("by gounda unlisted, far desk", "name", "gounda unlisted"),
        ("Thanks to Unlisted, Gounda for", "name", "Unlisted, Gounda"),
        ("was asked. B. T. Dourley enlarged a", "name", "B. T. Dourley"),
        ("Please call 7946 0880 now", "phone", "7946 0880"),
        ("Tel.: 555-0127", "phone", "555-0127"),
        ("lived at 12 " + "Q" + "u" * 90 + "erstrand Lane before", "address", "12 " + "Q" + "u" * 90 + "erstrand Lane"),
        ("SSN 955-08-8669, one", "id", "955-08-8669"),
        ("national insurance number QQ 83 00 96 C when", "id", "QQ 83 00 96 C"),
        ("shows NI no. QQ138213B beside", "id", "QQ138213B"),
        ("Passport X7077213 was", "id", "X7077213"),
        ("The tax ID 00 759 525 209 appears", "id", "00 759 525 209"),
        ("lived at 67a, Neanstead Lane, Trelcombe ZZ9 6QQ before", "address", "67a, Neanstead Lane, Trelcombe ZZ9 6QQ"),
        ("go to P.O. Box 2602, Tretholm last", "address", "P.O. Box 2602, Tretholm"),
        ("in Demfellstraße 99a, 47440 Fealvik last", "address", "Demfellstraße 99a, 47440 Fealvik"),
        ("jetzt: Punviker Weg 139B in Plasstead.", "address", "Punviker Weg 139B in Plasstead"),
        ("en calle Drimar 41a, 21026 Bottraix.", "address", "calle Drimar 41a, 21026 Bottraix"),
        ("désormais : 49, rue de Heamwerby, 38787 Narcombe.", "address", "49, rue de Heamwerby, 38787 Narcombe"),
        ("by Mrs Wemin Loskova after", "name", "Wemin Loskova"),
        ("Thanks to Torova, Gounda for", "name", "Torova, Gounda"),
        ("Dr. R. L. Unknownova lifted", "name", "R. L. Unknownova"),
        ("Signed: Talis M. Daphova-Neuquist;", "name", "Talis M. Daphova-Neuquist"),
        ("— GOUNDA WEMQUIST; x", "name", "GOUNDA WEMQUIST"),
        ("By Roulmo Marsh, desk", "name", "Roulmo Marsh"),
    ],
)
def test_values(finder, text, kind, value):
    assert values(finder, text) == [(kind, value)]


@pytest.mark.parametrize(
    "text",
    [
        "Ping @dairy_pocket if", "Install furnace@9.4.1 before", "557 stables @ 40 each", "host 192.0.2.8 up", "ISBN 978-0-2-54-4", "Catalogue 175-03-5574 lists",
        "Docket no. 93-49-775", "Grant 2019-044-8871 paid", "on 2024-07-14 the", "The Wemquist Institute", "Loskova Street was", "The Nexquist medal went",
        "The Marine Valley route", "Latin English dictionaries", "Panama Turkish relations", "Argentina Brandenberg", "read by The Local Council", "made by Penguin Books",
        "BY X Y EDITION, MULMPIS MARSH DESK", "rich in vitamin C. Then", "the U. S. Army", "in 7946 0880 rows", "call 12 of them", "3 7 11 15", "Dr. Wemquist came",
        "Marsh at Kutholm", "a square 12 court", "Contact <EMAIL> or <PHONE>", "", "at dot at", "passport to nowhere", "@", "+", "(", "12 Street",
    ],
)
def test_no_values(finder, text):
    assert values(finder, text) == []


def test_positions_count_code_points_and_redaction_keeps_the_rest(finder):
    text = "😀 İ ß\n— Gounda Torova | x@y.example | +1 431 555 0149\r\n\x00end"
    got = finder.find(text)
    assert [(k, text[s:e]) for k, s, e in got] == [("name", "Gounda Torova"), ("email", "x@y.example"), ("phone", "+1 431 555 0149")]
    assert replaced(text, got) == "😀 İ ß\n— <NAME> | <EMAIL> | <PHONE>\r\n\x00end"
    assert finder.find(replaced(text, got)) == []


def test_frames(spark):
    names = spark.createDataFrame([(1, "Gounda", "given"), (2, "Torova", " Family"), (3, None, "given"), (1, "Gounda", "given")], "name_id long, name string, kind string")
    df = spark.createDataFrame([("a", "x@y.example", "k"), ("a", "x@y.example", "k"), ("b", None, None), ("c", "", None), (None, "Gounda Torova " + "word " * 50_000 + "x@y.example", None)], "document_id string, normalized_text string, found string")
    assert sorted(map(tuple, pii_values(df, names).collect()), key=repr) == sorted([("a", "email", 0), (None, "name", 0), (None, "email", 14 + 250_000)], key=repr)
    red = {r["document_id"]: r["redacted_text"] for r in find_pii(df, names, redact=True).collect()}
    assert red["a"] == "<EMAIL>" and red["b"] is None and red["c"] == ""
    assert pii_values(df.limit(0), names).count() == 0 and pii_values(df, names.limit(0)).count() == 2
