"""Surrogates: nothing real is left, forms stay, equal units stay equal and others distinct."""

from __future__ import annotations

import ipaddress
import re

from pyspark.sql import functions as F

from tests.conftest import DATA
from txnkpi.llm import pii

ROWS = [
    (1, "Mail Hans.Meier@corp.example.com or call +1 (338) 555-0199. Mr. John Smith met John Smith and Mrs. Smith. SMITH, Smithson, smith: Smith's"),
    (2, "card 4111 1111 1111 1111, iban DE89 3704 0044 0532 0130 00, ssn 123-45-6789, ip 10.20.30.40."),
    (3, 'token = "8eb1c2af77aa0099ccdd00112233445566778899" and hans.meier@corp.example.com, 338-555-0199'),
    (4, None), (5, ""), (6, "nothing here, 12 apples, 3.5 kg, 2024-01-02, 1.2.3, a_b"), (None, "x@y.com"),
    (7, "Frau Müller, г-жа Иванова, господин Петров, MR. JOHN SMITH"), (8, "4111111111111111"), (8, "4111111111111111"),
]


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban_ok(text):
    moved = text.replace(" ", "")
    moved = moved[4:] + moved[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def test_forms_and_coreference(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    got = _texts(pii.pseudonymised(docs, "k"))
    real = "Hans.Meier Smith John 555-0199 4111 DE89 123-45-6789 10.20.30.40 8eb1c2af Müller Иванова Петров SMITH x@y".split()
    rest = [t.replace("Smithson, smith", "") for t in got.values() if t]
    assert not [x for x in real for t in rest if x.lower() in t.lower()]
    assert got[4] is None and got[5] == "" and got[6] == ROWS[5][1]
    one = re.fullmatch(
        r"Mail ([a-z]{4}\.[a-z]{5}@[a-z]{4}\.[a-z]{7}\.com) or call (\+1 \(\d{3}\) \d{3}-\d{4})\. "
        r"Mr\. (\w+) (\w+) met (\w+) (\w+) and Mrs\. (\w+)\. ([A-Z]+), Smithson, smith: (\w+)'s", got[1]
    )
    assert one and one[3] == one[5] and one[4] == one[6] == one[7] == one[9]
    assert one[8] == one[4].upper()
    assert one[3].lower() in {n.lower() for n in pii.FIRST_NAMES["m", "latin"]}
    two = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}), iban (\w{4}(?: \w{4}){4} \w\w), ssn (\d{3}-\d{2}-\d{4}), ip ([\d.]+)\.", got[2])
    assert two and _luhn(two[1].replace(" ", "")) and _iban_ok(two[2])
    assert all(0 < int(x) < 256 for x in two[4].split("."))
    three = re.fullmatch(r'token = "([0-9a-f]{40})" and (\S+), (\d{3}-\d{3}-\d{4})', got[3])
    assert three and three[2] == one[1]
    assert got[8] == two[1].replace(" ", "")
    seven = re.fullmatch(r"Frau ([A-Z]\w+), г-жа ([А-Я]\w+), господин ([А-Я]\w+), MR\. ([A-Z]+) ([A-Z]+)", got[7])
    assert seven and seven[2] != seven[3] and seven[5] == one[4].upper() and seven[4] == one[3].upper()


def test_keys_decide_and_reruns_agree(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    one, again, other = (_texts(pii.pseudonymised(docs, key)) for key in ("k", "k", "l"))
    assert one == again and one[1] != other[1]


def test_collisions_keep_units_distinct(spark):
    """26 one-letter addresses and 300 names: far more units than first draws."""
    letters = [(i, f"{c}@{d}.com {c}{c}@{d}.com") for i, (c, d) in enumerate((c, d) for c in "abcdefghijklmnopqrstuvwxyz" for d in "xyz")]
    names = [(1000 + i, f"Mr. Name{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]} Surname") for i in range(300)]
    docs = spark.createDataFrame(letters + names, "doc_id bigint, text string")
    got = _texts(pii.pseudonymised(docs, "k"))
    mails = [m for i in range(len(letters)) for m in got[i].split()]
    assert len(set(mails)) == 2 * len(letters)
    assert not {m.split("@")[0] for m in mails} & {m.split("@")[0] for _, t in letters for m in t.split()}
    given = [got[i].split()[1] for i, _ in names]
    assert len({g.lower() for g in given}) == 300 and len({got[i].split()[2] for i, _ in names}) == 1


def test_real_table_is_rewritten_only_where_it_must(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    before, after = _texts(docs), pii.pseudonymised(docs, "k").collect()
    patterns = [r"\S+@\S+\.\w+", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", r"\b\d{16}\b", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\b[0-9a-f]{40}\b"]
    changed = 0
    for row in after:
        found = {x for p in patterns for x in re.findall(p, before[row.doc_id])}
        assert not [x for x in found if x in row.text]
        assert (row.text == before[row.doc_id]) == (not found) == (row.n_entities == 0)
        changed += bool(found)
    assert changed > 30


def test_long_chains_of_repeated_parts(spark):
    rows = [(1, "a@" + "b." * 9_000 + "com"), (2, "1.2." * 9_000), (3, "+1" + " 23" * 9_000), (4, "Mr. " * 9_000)]
    got = _texts(pii.pseudonymised(spark.createDataFrame(rows, "doc_id bigint, text string"), "k"))
    assert got[1] != rows[0][1] and got[1].count(".") == 9_000 and got[2] == rows[1][1]
    assert got[3] != rows[2][1] and len(got) == 4


def test_odd_rows_and_other_columns(edge, empty):
    mixed = edge.withColumn("text", F.when(F.col("doc_id") == 7, F.lit("one a@b.org")).otherwise(F.col("text")))
    got = pii.replace_pii(mixed, "k")
    assert got.columns == edge.columns and got.count() == edge.count()
    changed = [r for r in got.collect() if r.doc_id == 7]
    assert changed[0].text != "one a@b.org" and changed[0].n_words == "other"
    assert pii.replace_pii(empty, "k").count() == 0


def _one(spark, *texts):
    got = _texts(pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "k"))
    return [got[i] for i in range(len(texts))]


def test_longer_names_and_names_alone(spark):
    got = _one(
        spark, "John F. Kennedy spoke. John left. Kennedy, KENNEDY", "James Earl Jones and James", "Dr. John Ronald Smith", "JOHN SMITH met Smith",
        "Ms. Mary Kim; Kim, KIM and Mary", "John Smith's car. Smith", "Dr. J. R. Lee, Lee", "Hans von Berg Jr. came. The Berg", "Mark The Box. The",
        "Mr. Daniel Ng and Ng. Ngo", "Hans-Peter Meier, Hans-Peter", "Mr. Brown Mrs. Green",
    )
    one = re.fullmatch(r"([\w-]+) ([A-Z])\. ([\w-]+) spoke\. ([\w-]+) left\. ([\w-]+), ([\w-]+)", got[0])
    assert one and one[1] == one[4] != "John" and one[2] != "F" and one[3] == one[5] != "Kennedy" and one[6] == one[3].upper()
    two = re.fullmatch(r"([\w-]+) ([\w-]+) ([\w-]+) and ([\w-]+)", got[1])
    assert two and two[1] == two[4] and not {"James", "Earl", "Jones"} & set(two.groups())
    three = re.fullmatch(r"Dr\. ([\w-]+) ([\w-]+) ([\w-]+)", got[2])
    assert three and three[1] == one[1] and not {"John", "Ronald", "Smith"} & set(three.groups())
    four = re.fullmatch(r"([A-Z-]+) ([A-Z-]+) met ([\w-]+)", got[3])
    assert four and four[1] == one[1].upper() and four[2] == three[3].upper() and four[3] == three[3]
    five = re.fullmatch(r"Ms\. ([\w-]+) ([\w-]+); ([\w-]+), KIM and ([\w-]+)", got[4])
    assert five and five[2] == five[3] != "Kim" and five[1] == five[4] != "Mary"
    assert got[5] == f"{one[1]} {three[3]}'s car. {three[3]}"
    seven = re.fullmatch(r"Dr\. ([A-Z])\. ([A-Z])\. ([\w-]+), ([\w-]+)", got[6])
    assert seven and seven[3] == seven[4] != "Lee" and "J" != seven[1] != seven[2] != "R"
    eight = re.fullmatch(r"([\w-]+) von ([\w-]+) Jr\. came\. The ([\w-]+)", got[7])
    assert eight and eight[2] == eight[3] != "Berg" and eight[1] != "Hans"
    assert got[8] == "Mark The Box. The"
    assert re.fullmatch(r"Mr\. ([\w-]+) ([\w-]+) and \2\. Ngo", got[9]) and "Ng " not in got[9]
    assert re.fullmatch(r"([\w-]+) ([\w-]+), \1", got[10]) and "Hans" not in got[10] and "Meier" not in got[10]
    assert re.fullmatch(r"Mr\. [\w-]+ Mrs\. [\w-]+", got[11]) and "Brown" not in got[11] and "Green" not in got[11]


def test_secrets_with_longer_keywords(spark):
    value = "Zx9yQ7wLk2Jh"
    texts = [
        f"client_secret = {value}", f'"db_password": "{value}"', f"'apiKey': '{value}'", f"SECRET_KEY_2={value}", f"x-access-token: {value}",
        f"dbpasswd:{value}", f'{{\\"token\\": \\"{value}\\"}}', f"aws_secret_access_key   =   {value}", f"token: {value}.{value}.{value}", f"AUTH-PWD={value}",
    ]
    got = _one(spark, *texts, "monkey: bananasplit, keyboard: mechanical")
    for before, after in zip(texts, got):
        shape = re.escape(before).replace(value, "([A-Za-z0-9]{12})", 1).replace(value, "[A-Za-z0-9]{12}")
        assert value not in after and re.fullmatch(shape, after), after
    assert got[-1] == "monkey: bananasplit, keyboard: mechanical"


def test_ipv6(spark):
    texts = [
        "from 2001:db8::ff00:42:8329, on", "2001:0db8:0000:0000:0000:ff00:0042:8329", "[2001:DB8::FF00:42:8329]:80", "fe80::1: up", "addr:2001:db8::ff00:42:8329/64",
        "12:30:45 and std::abc a::b ::1 :: 1:2", " ".join(f"fe80::{i:x}" for i in range(1, 16)),
    ]
    got = _one(spark, *texts)
    address = lambda t: ipaddress.ip_address(re.search(r"[0-9A-Fa-f]+:[0-9A-Fa-f:]*[0-9A-Fa-f]", t)[0])
    new = address(got[0])
    assert new != address(texts[0]) and address(got[1]) == address(got[2]) == new and new == address(got[4][5:])
    assert re.fullmatch(r"from [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{2}:[0-9a-f]{4}, on", got[0]) and got[2] == got[2].upper()
    assert got[3].endswith(": up") and "fe80::1" not in got[3]
    assert got[5] == texts[5]
    assert len({ipaddress.ip_address(x) for x in got[6].split()} - {ipaddress.ip_address(x) for x in texts[6].split()}) == 15


def test_addresses_and_names_of_any_script(spark):
    texts = [
        "mail jörg.müller@example.de or jörg@exämple.de", "Почта иван.петров@пример.рф тут", "Dr. Παπαδόπουλος left", "Μαρία Νικολάου came",
        "Анна Иванова пришла", "Сергей Иванов пришёл",
    ]
    got = _texts(pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "k"))
    real = "jörg müller example exämple иван петров пример Παπαδ Νικολ Μαρία Анна Иванов Сергей".split()
    assert not [r for r in real if any(r in t for t in got.values())]
    assert re.fullmatch(r"mail [a-z]+\.[a-z]+@[a-z]+\.de or [a-z]+@[a-z]+\.de", got[0])
    assert re.fullmatch(r"Почта [а-я]+\.[а-я]+@[а-я]+\.рф тут", got[1])
    assert re.fullmatch(r"Dr\. [Α-Ω][α-ωό]+όπουλος left", got[2]) and re.fullmatch(r"[Α-Ω]\w+ [Α-Ω]\w+ came", got[3])
    assert re.fullmatch(r"[А-Я]\w+ [А-Я]\w+ова пришла", got[4]) and re.fullmatch(r"[А-Я]\w+ [А-Я]\w+ов пришёл", got[5])
    assert got[4].split()[0] in pii.FIRST_NAMES["f", "cyrillic"] and got[3].split()[0] in pii.FIRST_NAMES["f", "greek"]


def test_no_real_value_is_readable_on_disk(spark, tmp_path, monkeypatch):
    folders = []
    monkeypatch.setattr(pii, "written", lambda df, name, write=pii.written: (lambda out: (folders.append(out), out)[1])(write(df, name)))
    docs = spark.createDataFrame([(1, "James Kennedy, james.kennedy@example.org, +49 30 1234567")], "doc_id bigint, text string")
    assert "Kennedy" not in pii.pseudonymised(docs, "k").head().text
    for df in folders:
        stored = b"".join(bytes(r.row) for r in df.collect())
        assert df.columns == ["row"] and stored and not re.search(rb"(?i)kennedy|james|1234567", stored)


def test_the_session_names_the_key(spark):
    assert pii.session_key(spark) != pii.session_key(spark)
    spark.conf.set("spark.txnkpi.surrogates.key", "mine")
    try:
        assert pii.session_key(spark) == "mine"
    finally:
        spark.conf.unset("spark.txnkpi.surrogates.key")


def test_plans_of_the_driver_stay_small(spark, monkeypatch):
    """Plans in which each use of a value was another copy of it took hundreds of MB of the driver."""
    sizes, written = {}, pii.written

    def measured(df, name):
        sizes[name] = max(sizes.get(name, 0), len(df._jdf.queryExecution().optimizedPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(pii, "written", measured)
    docs = spark.createDataFrame([(1, "Dr. Ann Lee, ann.lee@example.com, +1 555 010 9999, 2001:db8::1")], "doc_id bigint, text string")
    assert "Lee" not in pii.replace_pii(docs, "k").first()["text"]
    assert {"draws", "surrogates", "rendered"} <= set(sizes)
    assert max(sizes.values()) < 40_000, sizes
