import hashlib
import random
import re

from pyspark.sql import functions as F

from seedloom.llm import pii

KEY = "test key"


def run(spark, texts, key=KEY):
    rows = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, _gaps int")
    out = pii.pseudonymize(rows, key, found_col="kinds").collect()
    return {r.doc_id: (r.text, r.kinds) for r in out}


def bits(*parts):
    return int(hashlib.sha256(":".join(map(str, (KEY, *parts))).encode()).hexdigest()[:15], 16)


def feistel(left, right, sizes, context):
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            left = (left + bits(context, i, right) % sizes[0]) % sizes[0]
        else:
            right = (right + bits(context, i, left) % sizes[1]) % sizes[1]
    return left, right


def digits(value, context):
    n, half = len(value), len(value) // 2
    left, right = feistel(int(value[:half]), int(value[half:]), (10**half, 10 ** (n - half)), f"{context}:{n}")
    return f"{left:0{half}d}{right:0{n - half}d}"


def luhn(value):
    total = 0
    for i, c in enumerate(reversed(value)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total


def card(value):
    body = value[0] + digits(value[1:-1], "card")
    return body + str(-luhn(body + "0") % 10)


def test_against_brute_force(spark):
    rng = random.Random(3)
    numbers = ["".join(rng.choice("0123456789") for _ in range(rng.choice([13, 15, 16, 19]))) for _ in range(80)]
    got = run(spark, [f"pay {n} now" for n in numbers])
    for i, n in enumerate(numbers):
        if luhn(n) % 10 == 0:
            assert got[i] == (f"pay {card(n)} now", ["card"]) and luhn(card(n)) % 10 == 0
        else:
            assert got[i] == (f"pay {n} now", [])
    addresses = [".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(20)]
    got = run(spark, addresses)
    for i, a in enumerate(addresses):
        o = [int(x) for x in a.split(".")]
        left, right = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), "ip")
        assert got[i][0] == f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"


def test_formats_stay_and_values_stay_linked(spark):
    texts = [
        "call +1 (372) 555-7739, 372-555-7739 or 372.555.7739",
        "card 4041894974608795 or 4041-8949-7460-8795",
        "mail el.75@mail8.example.com and Jo_B+x@a.org again el.75@mail8.example.com",
        "born 1980-02-29, 02/29/1980 and 29.02.1980; ssn 123-45-6789; ip 148.9.179.169; +44 20 7946 0958",
    ]
    got = run(spark, texts)
    phones = re.findall(r"\d{3}[).-] ?\d{3}[-.]\d{4}", got[0][0])
    assert len({re.sub(r"\D", "", p) for p in phones}) == 1 and "372" not in got[0][0][:12]
    one, other = re.findall(r"\d[\d-]{14,}", got[1][0])
    assert other.replace("-", "") == one != "4041894974608795" and len(other) == 19
    mails = re.findall(r"\S+@\S+", got[2][0])
    assert mails[0] == mails[2] and re.fullmatch(r"[a-z]{2}\.\d\d@mail8\.example\.com", mails[0]) and mails[0][:5] != "el.75"
    assert re.fullmatch(r"[A-Z][a-z]_[A-Z]\+[a-z]@a\.org", mails[1])
    iso, us, eu = re.search(r"born (\S+), (\S+) and (\S+);", got[3][0]).groups()
    assert (us[6:], us[:2], us[3:5]) == (iso[:4], iso[5:7], iso[8:]) == (eu[6:], eu[3:5], eu[:2]) and iso != "1980-02-29"
    assert re.search(r"\+44 \d\d \d{4} \d{4}", got[3][0]) and "7946" not in got[3][0]
    assert got[3][1] == ["date", "date", "date", "ssn", "ip", "phone"]
    assert run(spark, texts, "other key")[1][0] != got[1][0]


def test_numbers_of_any_grouping_and_dates_of_any_notation(spark):
    texts = [
        "a +14155552671 b +1 415 555 2671 c 415-555-2671 d +1-4155552671",
        "+44 7911 123456, +447911123456 or +44 (7911) 12-34-56.",
        "+49 1512 3456789 and +4915123456789",
        "at 1980-02-29T10:00:00Z or 1980-02-29 or 2/29/1980 or 29.2.1980",
        "2/9/1980, 02/09/1980, 1980-2-9T08:15 and 9.02.1980",
        "+49 30 1234 56789 x +44 1234 1234 1234 1234",
        "+1234567 +1234567890123456 13/9/1980 1980-02-29X 1980-2-30T10:00",
    ]
    got = run(spark, texts)
    assert [got[i][1] for i in range(7)] == [["phone"] * 4, ["phone"] * 3, ["phone"] * 2, ["date"] * 4, ["date"] * 4, ["phone"] * 2, []]
    assert got[6][0] == texts[6]
    for i, country, rest in ((0, "1", "4155552671"), (1, "44", "7911123456"), (2, "49", "15123456789")):
        moved = digits(rest, "phone")
        shapes = [re.sub(r"\d", "#", t) for t in (texts[i], got[i][0])]
        assert shapes[0] == shapes[1] and rest not in re.sub(r"\D", "", got[i][0])
        assert re.sub(r"\D", "", got[i][0]).replace(country + moved, "").replace(moved, "") == ""
    assert not re.search("1234|56789", got[5][0])
    for i in (3, 4):
        found = re.findall(r"(\d+)([-/.])(\d+)[-/.](\d+)", got[i][0])
        order = {"-": (0, 2, 3), "/": (3, 0, 2), ".": (3, 2, 0)}
        assert len(found) == 4 and len({tuple(int(f[k]) for k in order[f[1]]) for f in found}) == 1
    assert "T10:00:00Z" in got[3][0] and "1980" not in got[3][0] + got[4][0]


def test_permutations_are_one_to_one(spark):
    frame = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    moved = frame.select(pii.feistel_digits(F.col("d"), KEY, "x").alias("m"), "d")
    assert moved.select("m").distinct().count() == 10_000
    assert moved.filter("m = d").count() < 10
    days = spark.range(0, 146_097, 73).selectExpr("id", "cast(date_add(date'1700-01-01', cast(id as int)) as string) AS text")
    changed = pii.pseudonymize(days, KEY)
    assert changed.select("text").distinct().count() == days.count()
    assert changed.filter("try_to_date(text) IS NULL OR text < '1700-01-01' OR text > '2099-12-31'").count() == 0
    numbers = spark.range(0, 898 * 99, 41).selectExpr(
        "id", "concat_ws('-', lpad(cast(id div 99 + 1 + if(id div 99 >= 665, 1, 0) as string), 3, '0'), "
        "lpad(cast(id % 99 + 1 as string), 2, '0'), '0001') AS text"
    )
    changed = pii.pseudonymize(numbers, KEY, found_col="k").filter("size(k) = 1")
    assert changed.select("text").distinct().count() == numbers.count()
    assert changed.filter("text RLIKE '^(000|666|9)|-00-|-0000$'").count() == 0


def test_clean_texts_and_defined_cases(spark):
    clean = [
        None, "", "version 2.0 of 12 items for 1,234.56", "999.1.1.1 and 01.2.3.4 and 1.2.3.4.5", "666-12-1234 000-11-2222",
        "1980-02-30 13/45/1999 1699-12-31", "hex 4041894974608795ab x4041894974608795", "a@b user@ @host",
        "x" * 200_000, "+" * 50_000 + "@", "a" * 100 + "@example.com",
    ]
    got = run(spark, clean)
    for i, text in enumerate(clean):
        assert got[i] == (text, []), (text or "")[:50]
    long = "word " * 20_000 + "4041894974608795" + " word" * 20_000
    assert run(spark, [long])[0] == (long.replace("4041894974608795", card("4041894974608795")), ["card"])
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert pii.pseudonymize(frame, KEY).count() == 0
    assert pii.pseudonymize(frame, KEY).columns == ["doc_id", "text"]


def test_native(spark):
    shown = pii.pseudonymize(spark.range(3).selectExpr("id", "'x' AS text"), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shown and "Python" not in shown
