import re

import cases
from pyspark.sql import functions as F
from tidemark.llm import surrogates
from tidemark.llm.queries import QUERIES

FOUND = re.compile(
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])"
    r"|(?<![0-9])[0-9]{13,19}(?![0-9])|\([0-9]{3}\) [0-9]{3}-[0-9]{4}"
)


def run(spark, *texts, **more):
    rows = surrogates.pseudonymize(cases.texts(spark, *texts), **more).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_query_leaves_no_entity_and_all_else(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{cases.SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op8_surrogates"](spark, cases.SF).collect()}
    assert got.keys() == docs.keys()
    before, after = {}, set()
    for key, text in docs.items():
        new = got[key]["text"]
        if not FOUND.search(text or ""):
            assert new == text and got[key]["n_entities"] == 0
            continue
        old, now = FOUND.findall(text), FOUND.findall(new)
        # What stands between the entities is untouched, and one entity has one surrogate everywhere.
        assert FOUND.split(text) == FOUND.split(new)
        for a, b in zip(old, now, strict=True):
            assert before.setdefault(a, b) == b
        after |= set(now)
    assert before and not after & set(before) and len(set(before.values())) == len(before)


def test_formats_types_and_coreference(spark):
    one, two, three = run(
        spark,
        "Mail Ann.Lee+7@Mail.example.com or ann.lee+7@mail.example.com, host 10.1.2.3 and 93.184.216.34.",
        "Call +1 (743) 555-3824 or (743) 555-3824 or 743-555-3824; card 4111 1111 1111 1111, 4111111111111111; id 123-45-6789",
        "not 4.0. nor 1.2.3 nor 12345678 nor a@b nor 2024-01-02",
    )
    a, b = re.findall(r"\S+@\S+[a-z]", one)
    assert a.lower() == b and re.fullmatch(r"[a-z]{3}\.[a-z]{3}\+\d@[a-z]{4}\.[a-z]{7}\.example", b)
    private, public = re.findall(r"\d+\.\d+\.\d+\.\d+", one)
    assert private.startswith("10.") and 240 <= int(public.split(".")[0]) <= 254
    full, local, dashed = re.match(r"Call \+1 (\(\d{3}\) \d{3}-\d{4}) or (\(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}); ", two).groups()
    digits = lambda s: re.sub(r"\D", "", s)
    assert full == local and digits(dashed) == digits(local) != "7435553824"
    spaced, plain = re.search(r"card (\d{4} \d{4} \d{4} \d{4}), (\d{16});", two).groups()
    assert digits(spaced) == plain != "4111111111111111" and plain[0] == "4" and luhn(plain)
    assert re.search(r"id 9\d\d-\d\d-\d{4}$", two) and "123-45-6789" not in two
    assert three == "not 4.0. nor 1.2.3 nor 12345678 nor a@b nor 2024-01-02"


def luhn(number):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def test_persons_keep_gender_script_and_identity(spark):
    a, b, c, d = run(
        spark,
        "Mr. John Smith met Mrs Jane Smith. Smith left; Jane stayed. The Smithy is closed.",
        "Dr. Smith wrote to Herr Müller.",
        "Smith without a title stays.",
        "г-н Иванов и г-жа Анна Петрова",
    )
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+)\. (\w+) left; (\w+) stayed\. The Smithy is closed\.", a)
    john, smith, jane, smith2, smith3, jane2 = m.groups()
    assert smith == smith2 == smith3 and jane == jane2 and len({john, smith, jane}) == 3
    assert john.endswith("n") and jane.endswith("a")
    assert re.match(rf"Dr\. {smith} wrote to Herr (?!Müller)\w+\.", b)
    assert c == "Smith without a title stays."
    assert re.fullmatch(r"г-н [а-я]+ и г-жа [а-я]+а [а-я]+", d, re.I) and "Иванов" not in d


def test_collisions_are_resolved(spark, monkeypatch):
    # Only ten surrogates at the first attempts: distinct entities must still end apart.
    real = surrogates.surrogate

    def narrow(kind, norm, attempt, key):
        few = F.concat(F.lit("1"), (F.crc32(norm.cast("binary")) % 10).cast("string"))
        return F.when(attempt < 2, few).otherwise(real(kind, norm, attempt, key))

    monkeypatch.setattr(surrogates, "surrogate", narrow)
    entities = spark.range(100).selectExpr("'phone' as kind", "cast(1000000 + id as string) as norm")
    later = {r["norm"]: r["attempt"] for r in surrogates.attempts_table(entities, "k").collect()}
    state = spark.createDataFrame([(str(1000000 + i), later.get(str(1000000 + i), 0)) for i in range(100)], "norm string, attempt int")
    final = [r[0] for r in state.select(narrow(F.lit("phone"), F.col("norm"), F.col("attempt"), "k")).collect()]
    assert len(set(final)) == 100 and len(later) >= 90


def test_attempts_reach_the_text(spark, monkeypatch):
    real = surrogates.surrogate
    same = lambda kind, norm, attempt, key: F.when((kind == "ip") & (attempt == 0), F.lit("240.0.0.1")).otherwise(real(kind, norm, attempt, key))
    monkeypatch.setattr(surrogates, "surrogate", same)
    got = run(spark, "a 1.2.3.4 b 5.6.7.8", "c 5.6.7.8", "d 9.9.9.9 é", "d 9.9.9.9 é")
    ips = [re.findall(r"\d+\.\d+\.\d+\.\d+", t) for t in got]
    assert ips[0][1] == ips[1][0] and ips[2] == ips[3] and len({ips[0][0], ips[0][1], ips[2][0]}) == 3


def test_keys_and_odd_rows(spark):
    assert run(spark, "x 1.2.3.4") == run(spark, "x 1.2.3.4") != run(spark, "x 1.2.3.4", key="other")
    got = surrogates.pseudonymize(cases.frame(spark))
    assert got.columns == [*cases.SCHEMA.names, "n_entities"]
    assert sorted(map(repr, map(tuple, got.drop("n_entities").collect()))) == sorted(map(repr, cases.rows()))
    assert surrogates.pseudonymize(cases.empty(spark)).collect() == []


def test_small_spaces_and_letterless_addresses_find_surrogates(spark):
    odd = ["+@a.b", "...@gmail.com", "___@x.com", "-@app.route.x"]
    digits = [f"{i}@qq.com" for i in range(10)]
    domains = [f"ann@{c}.{t}" for t in ("com", "co") for c in "abcdefghijklmno"]
    mails = odd + digits + domains
    got = [t.split()[1] for t in run(spark, *(f"to {m} now" for m in mails))]
    assert len(set(got)) == len(mails) and not set(got) & set(mails)
    assert all(m.endswith(".example") for m in got) and len({m.split("@")[1] for m in got[14:]}) == 30


def test_full_number_spaces_grow(spark):
    rows = [(f"{kind}", norm, a) for kind, norm in (("phone", "12345"), ("ssn", "123456789"), ("account", "4111111111111111"), ("ip", "10.0.0.1")) for a in (0, surrogates.GROW_NUMBERS + 1)]
    df = spark.createDataFrame(rows, "kind string, norm string, attempt int")
    got = [r[0] for r in df.select(surrogates.surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), "k")).collect()]
    assert [len(b) - len(r[1]) for r, b in zip(rows, got) if r[0] != "ip" and r[2]] == [2, 2, 2] and got[7].count(".") == 4
    laid = spark.range(1).select(surrogates.laid_out(F.lit("+1 12 34"), F.lit("9876543")), surrogates.laid_out(F.lit("+1 12 34"), F.lit("876"))).first()
    assert tuple(laid) == ("+9 87 6543", "+1 18 76")


def test_full_names_initials_capitals_and_plain_numbers(spark):
    a, b, c, d, e = run(
        spark,
        "Mr. John Smith met Dr. J. R. Brown and Mr SMITH, Mrs O'Neil-McLean.",
        "Here John Smith spoke; later SMITH and John Q. Smith left. York Smithson stayed.",
        "Call 555 123 4567 or 5551234567, not 1700000000; IBAN DE89370400440532013000 or DE89 3704 0044 0532 0130 00.",
        "Brown and John apart stay.",
        "We saw JOHN SMITH's.",
    )
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Dr\. J\. R\. (\w+) and Mr (\w+), Mrs (\w+)\.", a)
    john, smith, brown, upper, neil = m.groups()
    assert upper == smith.upper() and not {"Smith", "Brown", "John"} & {john, smith, brown}
    assert b == f"Here {john} {smith} spoke; later {upper} and {john} Q. {smith} left. York Smithson stayed."
    spaced, plain, solid, grouped = re.fullmatch(r"Call (\d{3} \d{3} \d{4}) or (\d{10}), not 1700000000; IBAN (DE\d{20}) or (DE[\d ]+)\.", c).groups()
    assert spaced.replace(" ", "") == plain != "5551234567" and grouped.replace(" ", "") == solid != "DE89370400440532013000"
    assert int(f"{solid[4:]}1314{solid[2:4]}") % 97 == 1 and [len(x) for x in grouped.split()] == [4] * 5 + [2]
    assert d == "Brown and John apart stay." and e == f"We saw {john.upper()} {upper}'s."
