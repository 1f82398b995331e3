import pytest

from leafwork.llm import personal


def found(text):
    return [(text[a:b], kind) for a, b, kind in personal.find_mentions(text)]


@pytest.mark.parametrize(
    ("text", "mention", "kind"),
    [
        ("write to a.b@c.example.", "a.b@c.example", "email"), ("mail a_b (at) c.test", None, None), ("mail ab(at)c dot test now", "ab(at)c dot test", "email"),
        ("mail x @ y.invalid: no", "x @ y.invalid", "email"), ("mail x [at] y.test", "x [at] y.test", "email"), ("call +44 (0)7700 900 971 now", "+44 (0)7700 900 971", "phone"),
        ("tel. (415) 555-0195.", "(415) 555-0195", "phone"), ("site (968 5550138) today", "968 5550138", "phone"), ("on 349.555.0193 or", "349.555.0193", "phone"),
        ("téléphone 01.99.00.73.67.", "01.99.00.73.67", "phone"), ("Telefon 030 23125-056.", "030 23125-056", "phone"), ("at 07700 900557.", "07700 900557", "phone"),
        ("(SSN 953-58-8396) left", "953-58-8396", "identity"), ("passport ZZ 6736190; x", "ZZ 6736190", "identity"), ("National health number: 999-402-0323.", "999-402-0323", "identity"),
        ("护照号QX2309035。", "QX2309035", "identity"), ("return to PO Box 216, Badstead.", "PO Box 216, Badstead", "address"), ("at Apt 53, 385 Tuprox St., Pufford and", "Apt 53, 385 Tuprox St., Pufford", "address"),
        ("wohnt in Nedatallee 48, D-99984 Tuzel.", "Nedatallee 48, D-99984 Tuzel", "address"), ("adresse : 113 bis, avenue Nadraex, 99157 Wodat.", "113 bis, avenue Nadraex, 99157 Wodat", "address"),
        ("envío a Calle de Honout 293, 99587 Brom.", "Calle de Honout 293, 99587 Brom", "address"), ("请寄至望湖路193号2单元451室。", "望湖路193号2单元451室", "address"),
        ("Mrs Rodraet moved", "Rodraet", "name"), ("Signed by Johannes Hedeitett (x)", "Johannes Hedeitett", "name"), ("Next of kin: Narolham, Nathaniel, tel", "Narolham, Nathaniel", "name"),
        ("Frau Dr. Ingrid Pavann unter", "Ingrid Pavann", "name"), ("week 3. W. Gohond telephoned the site", "W. Gohond", "name"), ("THEODORE GIVEVETT telephoned", "THEODORE GIVEVETT", "name"),
        ("Xiomara Quispe called twice", "Xiomara Quispe", "name"), ("then Priya Raghunathan lives at home", "Priya Raghunathan", "name"), ("Ngozi A. Okonkwo-Bell can be reached by post", "Ngozi A. Okonkwo-Bell", "name"),
        ("to 12 Maple Grove, please", "12 Maple Grove", "address"), ("mail juan.pérez@exämple.com now", "juan.pérez@exämple.com", "email"), ("x " + "a" * 90 + "@b.test", "a" * 90 + "@b.test", "email"),
        ("at 12 " + "Ab" * 60 + " Street and", "12 " + "Ab" * 60 + " Street", "address"), ("in " + "N" + "e" * 80 + "allee 48 und", "N" + "e" * 80 + "allee 48", "address"),
        ("邮箱abc@x.test。", "abc@x.test", "email"),
    ],
)
def test_mentions(text, mention, kind):
    assert mention is None or found(text) == [(mention, kind)]


@pytest.mark.parametrize(
    "text",
    ["", "   ", "Lot 948-555-0162 expires on 2027-06-14.", "Kit number 939 06 0654 was dispensed to site 426.", "Software version 987.65.27 was validated @ 24 months.",
     "The Robixmoor Memorial Centre screened 644 participants.", "the Tuweiswell index and the Thaflatwell-Waetrovsen scale", "Specimen ZZ-20456 was stored in Street Clinic freezer 740.",
     "Dose cohort 1-627-555 enrolled 627 adults", "See https://portal.example/study/175648/contact.", "participants with hepatitis B. Reducing the dose", "reference 01632-9 units", "The Data Monitoring Committee called a meeting", "The Robixmoor Thaflat called for", "a scale called Robix", "Protocol number" + " " * 60 + "948-555-0162 x"],
)
def test_no_cases(text):
    assert found(text) == []


def test_redaction_keeps_the_rest():
    assert personal.redact("Mrs Rodraet, a@b.test!") == "Mrs [NAME], [EMAIL]!"
    assert personal.redact(None) is None and personal.redact("") == ""
    long = "plain words " * 20_000 + "Mr Watres said"
    assert personal.redact(long).endswith("Mr [NAME] said")


def test_offsets_are_code_points(spark):
    text = "😀İ Mrs Rodraet moved"
    frame = spark.createDataFrame([(1, text, "k"), (2, None, "k"), (3, "", "k"), (1, text, "k")], "doc_id long, text string, kind string")
    rows = personal.found_mentions(personal.mentions(frame)).collect()
    assert [tuple(r) for r in rows] == [(1, "name", text.index("Rodraet"))]
    assert {r.doc_id: r.n_mentions for r in personal.redacted(frame).collect()} == {1: 1, 2: 0, 3: 0}
    assert personal.mentions(frame.where("false")).count() == 0


def test_long_and_dense_texts():
    text = "Mr Watres, a@b.test, (415) 555-0195; " * 5_000
    got = personal.find_mentions(text)
    assert len(got) == 15_000 and got == sorted(got) and all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    assert personal.redact(text) == "Mr [NAME], [EMAIL], [PHONE]; " * 5_000
    digits = "1 2 3 4 5 6 7 8 9 0 " * 20_000 + "@" * 20_000 + "a" * 100_000 + "@"
    assert personal.find_mentions(digits) == []
