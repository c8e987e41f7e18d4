import pytest
from pyspark.sql import functions as F

from shelfprice.llm import surrogates

KEY = b"a key for tests"


def kinds(text):
    return [(k, text[a:b]) for a, b, k, _ in surrogates.entities(text)]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("write was.78@mail7.example.com.", [("email", "was.78@mail7.example.com")]),
        ("at 97.51.17.173. Version 2.0. or 4.0", [("ip", "97.51.17.173")]),
        ("999.1.1.1 1.2.3.4.5", []),
        ("+1 (168) 555-5254%%% and (168) 555-5254", [("phone", "+1 (168) 555-5254"), ("phone", "(168) 555-5254")]),
        ("card 9807915762804490!!", [("card", "9807915762804490")]),
        ("4111 1111 1111 1111", [("card", "4111 1111 1111 1111")]),
        ('TOKEN = "04dbebab91ab85687d33"', [("secret", "04dbebab91ab85687d33")]),
        ("SSN 123-45-6789", [("ssn", "123-45-6789")]),
        ("DE89 3704 0044 0532 0130 00", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("Mrs. Anna Smith met Mr Jones", [("given_f", "Anna"), ("family", "Smith"), ("family", "Jones")]),
        ("Госпожа Анна Иванова", [("given_f", "Анна"), ("family", "Иванова")]),
        ("Κύριος Νίκος Παππάς", [("given_m", "Νίκος"), ("family", "Παππάς")]),
        ("mr smith. In 2024 there were 12 of 300, e.g. 3.5 or 10:30 = noon", []),
        ("line\n\n@ = : 7\nnone", []),
    ],
)
def test_detection(text, found):
    assert kinds(text) == found


def test_permutation_is_one():
    for size in (1, 2, 10, 97, 1000):
        assert sorted(surrogates.permuted(i, size, KEY, "t") for i in range(size)) == list(range(size))


@pytest.mark.parametrize("kind", ["phone", "card", "ssn", "secret", "ip", "email", "iban"])
def test_format_and_distinctness(kind):
    made = {
        "phone": lambda i: f"{2000000000 + i}", "card": lambda i: f"{4111111111110000 + i}", "ssn": lambda i: f"{100000000 + i}",
        "secret": lambda i: f"ab{i:08x}", "ip": lambda i: f"10.0.{i // 250}.{i % 250}", "email": lambda i: f"u{i:03}@mail.example.com",
        "iban": lambda i: f"de{89370400440532013000 + i}",
    }[kind]
    values = [made(i) for i in range(300)]
    new = [surrogates.surrogate(kind, v, KEY) for v in values]
    assert len(set(new)) == 300
    for v, n in zip(values, new, strict=True):
        assert kind == "ip" or [c.isdigit() or kind == "secret" for c in v] == [c.isdigit() or kind == "secret" for c in n]
        if kind == "card":
            assert surrogates._luhn(v) == surrogates._luhn(n)
        if kind == "ip":
            assert surrogates._ip_range(int.from_bytes(bytes(map(int, n.split("."))), "big")) == "private"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def rewritten(spark, texts, key=KEY):
    return {r.doc_id: r.text for r in surrogates.rewrite(docs_of(spark, texts), key).collect()}


def test_coreference_case_and_formats(spark):
    out = rewritten(spark, ["Call +1 (168) 555-5254 or (168) 555-5254", "A.B@Mail7.example.com a.b@mail7.example.com", "Mrs. Anna SMITH, Mr Smith"])
    number = out[0].split("or ")[1]
    assert out[0] == f"Call +1 {number} or {number}" and number != "(168) 555-5254"
    upper, lower = out[1].split()
    assert upper.lower() == lower and upper[0].isupper() and lower.endswith(".com")
    first, second = out[2].split(", Mr ")
    assert first.split()[-1].capitalize() == second and first.startswith("Mrs. ") and first.split()[1].endswith("lia")


def test_keys_matter_and_reruns_agree(spark):
    texts = ["ip 97.51.17.173 card 9807915762804490"]
    assert rewritten(spark, texts) == rewritten(spark, texts) != rewritten(spark, texts, b"another")


def test_collisions_are_resolved(spark, monkeypatch):
    """With room for few names, every name still gets its own, and none that is real."""
    monkeypatch.setattr(surrogates, "_SYLLABLES_IN_NAME", 2)
    names = [f"N{chr(97 + i // 26)}{chr(97 + i % 26)}or" for i in range(120)]
    names[0] = surrogates.surrogate("family", names[1].casefold(), KEY).capitalize()  # a real name that is a surrogate
    out = rewritten(spark, [f"Mr {n} and again Mr {n}" for n in names])
    new = []
    for i in range(len(names)):
        a, b = out[i].removeprefix("Mr ").split(" and again Mr ")
        assert a == b
        new.append(a)
    assert len(set(new)) == len(names) and not set(new) & set(names)


def test_odd_rows(spark):
    text = "x@y.example.com"
    data = [(1, text, 15), (1, text, 15), (None, text, 15), (2, None, None), (3, "", 0), (4, "plain text", 10), (5, "w " * 100_000 + text, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_chars long").selectExpr("*", "1 AS spans", "2 AS rest", "'k' AS tries")
    out = surrogates.rewrite(docs, KEY)
    assert out.columns == docs.columns
    rows = {(r.doc_id, r.text[-15:] if r.text else r.text): r.n_chars for r in out.collect()}
    new = surrogates.surrogate("email", text, KEY)
    assert rows == {(1, new): 15, (None, new): 15, (2, None): None, (3, ""): 0, (4, "plain text"): 10, (5, new): 200_015}
    assert out.count() == 7 and surrogates.rewrite(docs.limit(0), KEY).count() == 0


def test_spans_point_at_surrogates(spark, table):
    out, spans = surrogates.with_surrogates(table("documents"), KEY)
    rows = out.where(F.size(spans) > 0).collect()
    old = {r.doc_id: r.text for r in table("documents").collect()}
    assert rows
    for r in rows:
        for s in r[spans]:
            assert r.text[s.start : s.end] == s.surrogate
        originals = {v for _, _, _, v in surrogates.entities(old[r.doc_id])}
        assert not originals & {v for _, _, _, v in surrogates.entities(r.text)}


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Mrs Anna Weber called. Later Weber said", [("given_f", "Anna"), ("family", "Weber"), ("family", "Weber")]),
        ("WEBER came, Anna's too. Mrs Anna Weber's car, weber webers Webern", [("family", "WEBER"), ("given_f", "Anna"), ("given_f", "Anna"), ("family", "Weber")]),
        ("Dr Anna Weber, Mrs Anna Weber", [("given_f", "Anna"), ("family", "Weber")] * 2),
        ("Frau Anna Weber, Frau Anna", [("given_f", "Anna"), ("family", "Weber"), ("given_f", "Anna")]),
        ("Herr Dr. Weber. Dr Weber", [("family", "Weber")] * 2),
        ("Mr Kim Lee, Mrs Kim Park. Kim Lee. Kim", [("given_m", "Kim"), ("family", "Lee"), ("given_f", "Kim"), ("family", "Park"), ("given_m", "Kim"), ("family", "Lee"), ("given_f", "Kim")]),
        ("Mrs Weber. Weber@mail.example.com", [("family", "Weber"), ("email", "Weber@mail.example.com")]),
        ("Госпожа Анна Иванова. Иванова", [("given_f", "Анна"), ("family", "Иванова"), ("family", "Иванова")]),
    ],
)
def test_other_mentions_of_titled_names(text, found):
    assert kinds(text) == found


def test_one_surrogate_for_all_mentions(spark):
    out = rewritten(spark, ["Mrs Anna Weber called. Later Weber said that Dr Anna Weber is WEBER."])[0]
    given, family = out.removeprefix("Mrs ").split()[:2]
    assert out == f"Mrs {given} {family} called. Later {family} said that Dr {given} {family} is {family.upper()}."
    assert family != "Weber" and given != "Anna"


def test_one_person_across_documents(spark):
    """A title tells the gender for documents that do not, and only for the same person."""
    texts = ["Dr Anna Weber and Dr Anna Stein", "Mrs Anna Weber", "Prof Anna Weber, Anna", "Dr Kim Lee", "Mr Kim Lee", "Mrs Kim Lee", "Dr Kim Park", "Frau Anna Stein", "Dr Max Moor"]
    out = rewritten(spark, texts)
    anna, weber = out[1].removeprefix("Mrs ").split()
    stein = out[7].split()[-1]
    assert out[0] == f"Dr {anna} {weber} and Dr {anna} {stein}" and out[2] == f"Prof {anna} {weber}, {anna}"
    assert anna.endswith("lia") and len({weber, stein, "Weber", "Stein"}) == 4
    # Told both ways: another person each time, and none of the two where no gender is told.
    assert len({out[i].split()[1] for i in (3, 4, 5)}) == 3
    assert out[6].split()[1] == out[3].split()[1]


def brute(texts, key=KEY):
    """A plain dictionary: every entity of a kind and value drawn once, by hand through each text."""
    told = {}
    for text in texts:
        for first, last, gender in surrogates.persons(text or ""):
            if gender:
                told.setdefault((first, last), set()).add(gender)
    agreed = {name: next(iter(g)) for name, g in told.items() if len(g) == 1}
    found = [surrogates.entities(text or "", agreed) for text in texts]
    values = sorted({(kind, value) for spans in found for _, _, kind, value in spans})
    tries = dict.fromkeys(values, 0)
    while True:
        new = {v: surrogates.surrogate(*v, key, n) for v, n in tries.items()}
        taken = set()
        clash = set()
        for kind, value in values:
            if (kind, new[kind, value]) in taken or (kind, new[kind, value]) in tries:
                clash.add((kind, value))
            taken.add((kind, new[kind, value]))
        if not clash:
            break
        for v in clash:
            tries[v] += 1
    out = []
    for text, spans in zip(texts, found, strict=True):
        for start, end, kind, value in reversed(spans):
            text = text[:start] + surrogates._written(kind, text[start:end], new[kind, value]) + text[end:]
        out.append(text)
    return out


def test_rewriting_against_a_dictionary(spark, table):
    texts = [r.text for r in table("documents").collect()]
    texts += [None, "", "Mrs Anna Weber", "Dr Anna Weber. Anna at 10.0.0.7", "a.b@mail7.example.com +1 (168) 555-5254", "Mr Nabetor, Mr Nabetor Kim"]
    out = rewritten(spark, texts)
    assert [out[i] for i in range(len(texts))] == brute(texts)


def test_rows_without_an_id_do_not_share_tries(spark, monkeypatch):
    """Few names to draw from, so that some need longer ones, and every row has tries of its own."""
    monkeypatch.setattr(surrogates, "_SYLLABLES_IN_NAME", 1)
    names = [f"Mr N{chr(97 + i)}or" for i in range(24)]
    df = spark.createDataFrame([(None, n) for n in names], "doc_id long, text string")
    got = sorted(r.text for r in surrogates.rewrite(df, KEY).collect())
    assert got == sorted(brute(names)) and len(set(got)) == 24
