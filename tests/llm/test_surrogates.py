"""Surrogates where formats are small, texts odd, and against plain look-ups."""

import os
import random
import re


from otelier.llm import pii
from otelier.llm.pii import anonymise, entity_id, find_entities, luhn, secret_key, shape, surrogate, written


def rounds(spark, run):
    """(rows, rounds) of a run: every round stages one table."""
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    count = lambda: sum(n.startswith("judged") for n in os.listdir(base))
    before = count()
    return run().collect(), count() - before


def test_nothing_to_change_is_no_entity(spark):
    texts = ["Password: ________ please", "token=----------", "write to _@-.com", "api_key: ....____....", "secret = //////////"]
    assert not any(find_entities(t) for t in texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows, n = rounds(spark, lambda: anonymise(df, b"k"))
    assert sorted(r["text"] for r in rows) == sorted(texts) and n == 1


def test_every_value_of_a_small_format(spark):
    addresses = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)]
    mails = [f"{chr(97 + a)}@{chr(97 + b)}.com" for a in range(26) for b in range(26)]
    texts = [f"host {a} up" for a in addresses] + [f"ask {m} now" for m in mails]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id int, text string").repartition(8)
    rows, n = rounds(spark, lambda: anonymise(df, b"k"))
    new = {r["doc_id"]: r["text"].split()[1] for r in rows}
    assert len(new) == len(texts) * 2 and n <= 8
    assert all(new[i] == new[i + len(texts)] for i in range(len(texts)))  # one surrogate per value
    assert len(set(new.values())) == len(texts) and not set(new.values()) & {*addresses, *mails}


def test_one_shape_of_numbers(spark):
    """Ten thousand cards that differ in few digits stay apart, valid and apart from real ones."""
    cards = []
    for n in range(60_000):
        body = f"41111111{n:07d}"
        cards += [body + d for d in "0123456789" if luhn(body + d)]
    cards = cards[:10_000]
    df = spark.createDataFrame([(i, f"card {c}") for i, c in enumerate(cards)], "doc_id int, text string").repartition(8)
    new = [r["text"].split()[1] for r in anonymise(df, b"k").collect()]
    assert len(set(new)) == len(cards) and not set(new) & set(cards) and all(map(luhn, new))


def test_planted_values_are_found_and_nothing_else(spark):
    """Texts built from known parts; what was planted is found, plain look-up of the surrogates gives the same texts."""
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    makers = {"email": lambda: f"{rng.choice(['Jo', 'max.muster', 'A_b'])}{digits(3)}@{rng.choice(['Example', 'mail'])}{digits(1)}.org",
              "ip": lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4)), "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
              "phone": lambda: f"+1 ({digits(3)}) 555-{digits(4)}", "secret": lambda: f"token={digits(12)}abc"}
    filler = ["nothing", "to", "see,", "version 2.0", "in 2024", "10-20", "x@", "@home", "12345", "3.14", "key", "passwords", "1-2-3"]
    planted, rows = [], []
    for i in range(300):
        here = [(k, makers[k]()) for k in rng.sample(sorted(makers), rng.randrange(3))]
        words = rng.choices(filler, k=6)
        for k, v in here:
            words.insert(rng.randrange(len(words) + 1), v)
        planted.append(sorted((k, v.removeprefix("token=")) for k, v in here))
        rows.append((i, " ; ".join(words)))
    for (_, text), want in zip(rows, planted):
        assert sorted((k, text[a:b]) for a, b, k, _ in find_entities(text)) == want
    got = {r["doc_id"]: r["text"] for r in anonymise(spark.createDataFrame(rows, "doc_id int, text string"), b"key").collect()}
    for (i, text), want in zip(rows, planted):
        for a, b, k, value in sorted(find_entities(text), reverse=True):
            text = text[:a] + written(k, text[a:b], surrogate(b"key", k, value)) + text[b:]
        assert got[i] == text and not any(v in text for _, v in want)


def test_staged_tables_hold_no_values(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(base))
    df = spark.createDataFrame([(1, "Ask quentin77@example.org or 555-12-9876.")], "doc_id int, text string")
    anonymise(df, b"k").collect()
    for name in set(os.listdir(base)) - before:
        for r in spark.read.parquet(f"{base}/{name}").collect():
            assert not re.search("quentin|77@|9876", repr(r))


def test_formats_and_keys(spark):
    assert written("email", "Jo.Doe@Example.org", "xy.abc@qwertyu.org") == "Xy.Abc@Qwertyu.org"
    assert written("email", "JO@X.ORG", "ab@c.org") == "AB@C.ORG" and written("email", "jo@x.org", "abc@d.org") == "abc@d.org"
    assert written("card", "4111 1111 1111 1111", "41234567890123456789") == "4123 4567 8901 23456789"
    assert shape("iban", "GB82WEST1234") == "GB00AAAA0000" and shape("secret", "a1b2") == "####" and shape("secret", "Zz_9") == "Aa_0"
    assert entity_id(b"a", "ssn", "1") != entity_id(b"b", "ssn", "1") and len(secret_key(spark)) == 32 and secret_key(spark) == secret_key(spark)
    spark.conf.set("spark.otelier.pii.key", "given")
    assert secret_key(spark) == b"given"
    spark.conf.unset("spark.otelier.pii.key")
    listed, drawn = ({n for ns in lists.values() for n in ns} for lists in (pii.FIRST_NAMES, pii.SURROGATE_NAMES))
    assert not listed & drawn
