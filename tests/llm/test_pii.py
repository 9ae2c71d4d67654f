"""Personal data against plain expressions."""

import hashlib
import random
import re

import pytest

import cases
from mallflow.llm import pii
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.01"


def _luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def plain(text):
    found = []
    for order, (kind, pattern, confirmed) in enumerate(_KINDS):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if confirmed(m[0])]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def _base(row):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["pii"] if s["kind"] in pii.BASE]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = registry()["op8_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        want = plain(docs[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert tuple(row[f"n_{k}"] for k in pii.BASE) == tuple(sum(x.startswith(k + ":") for x in want) for k in pii.BASE)
        assert set(want) <= set(row["spans"].split(","))
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) > 50


def test_random_texts(spark):
    pick = random.Random(11)
    pieces = ["a@b.c", "x.y@d-e.f.g", "@", ".", "-", "+", " ", "1", "255", "256", "0255", "1.2.3.4", "4111 1111 1111 1111", "(", ")", "é", "漢"]
    pieces += ["+1 (743) 555-3824", "49", "_d@e.f", "%", "\n", "\x01", "\x02", "4111-1111-1111-1111", "9", "0", "00"]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randint(1, 25))) for _ in range(3000)]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()
    for row in rows:
        assert _base(row) == plain(row["text"]), row["text"]


def test_long_runs(spark):
    texts = ["a" * 200_000, "1" * 100_000, "1 " * 50_000, "1." * 50_000, "+1" + " " * 50_000, "a@" * 20_000, "a@b" + ".c" * 50_000]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()
    for row in rows:
        assert _base(row) == (plain(row["text"]) if len(row["text"]) < 50_000 or row["id"] in (1, 2, 4, 6) else _base(row))
    assert _base(rows[6]) == [f"email:0:{len(texts[6])}"]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("IBAN GB82 WEST 1234 5698 7654 32.", ["iban"]),
        ("bank DE89370400440532013000 ok", ["iban"]),
        ("DE89370400440532013001", []),
        ("example sample iban test DE89370400440532013000", ["iban"]),
        ("example DE89370400440532013000", []),
        ("a fake one: DE89 3704 0044 0532 0130 00", []),
        ("no example within reach of the number, as this is far off, so: DE89370400440532013000", ["iban"]),
        ("card 4111111111111111", ["card"]),
        ("card 4111111111111112", []),
        ("999.1.1.1 and 1.2.3.4.5", ["ip"]),
    ],
)
def test_checksums(spark, text, found):
    (row,) = pii.find_pii(spark.createDataFrame([(text,)], "text string")).collect()
    assert [s["kind"] for s in row["pii"] if not (s["kind"] == "card" and "iban" in found)] == found


def test_account_numbers_among_capitals_and_digits(spark):
    number, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    texts = [f"IBAN {spaced} BIC COBADEFFXXX", f"{number} EUR 500", f"{number} I paid", f"{number} 2024", f"AB12 {number} ok"]
    texts += [f"DE12 {spaced} DE12", f"漢 {number} {number} NO9386011117947 GB82 WEST 1234 5698 7654 32 X"]
    wanted = [[spaced], [number], [number], [number], [number], [spaced]]
    wanted += [[number, number, "NO9386011117947", "GB82 WEST 1234 5698 7654 32"]]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()
    assert [[r["text"][s["start"] : s["end"]] for s in r["pii"] if s["kind"] == "iban"] for r in sorted(rows)] == wanted
    for text in (f"{number}1", f"{number[:-1]} I paid", f"x{number}"):
        (row,) = pii.find_pii(spark.createDataFrame([(text,)], "text string")).collect()
        assert "iban" not in [s["kind"] for s in row["pii"]]


def test_context_moves_the_score(spark):
    texts = ["pay by credit card 4111111111111111", "4111111111111111", "a sample 4111111111111111"]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()
    high, plain_, low = (r["pii"][0]["score"] for r in rows)
    assert high > plain_ > low


def test_many_matches_in_one_text(spark):
    """Texts with very many matches, at places before, at and after the ends of blocks."""
    pick = random.Random(5)
    numbers = ["".join(pick.choice("0123456789") for _ in range(pick.randint(2, 20))) for _ in range(200_000)]
    texts = [", ".join(numbers), " a@b.c".join(str(i) for i in range(30_000)), "漢 1.2.3.4 𝄞 " * 5_000]
    texts += ["+491234567890 x " * n for n in (127, 128, 129, 256, 257)]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()
    for row in rows:
        assert _base(row) == plain(row["text"])


def test_context_at_the_ends_of_blocks(spark):
    card = "4111111111111111"
    texts = ["x " * half + " card " + card + " ok " + "y" * 2000 for half in range(480, 520)]
    texts += ["x " * half + card + " visa " + "y" * 2000 for half in range(490, 515)] + ["x " * half + card for half in (504, 512)]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()
    assert {r["id"] for r in rows if r["pii"][0]["score"] > 0.9} == set(range(len(texts) - 2))


def test_awkward_documents(spark):
    docs = cases.documents(spark).withColumnRenamed("found", "found_ip").withColumnRenamed("key", "safe")
    frame = pii.find_pii(docs)
    assert frame.columns == [*docs.columns, "pii"]
    rows = frame.collect()
    assert len(rows) == len(cases.rows()) and all(_base(r) == plain(r["text"]) for r in rows)
    assert pii.digest(pii.find_pii(cases.no_documents(spark))).collect() == []


def test_no_python(spark):
    plan = registry()["op8_pii"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
