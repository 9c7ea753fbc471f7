"""Surrogates: kinds, forms, coreference and distinctness."""

import re

import pytest

from rivermart.llm import pii

TEXT = ('Mail ann.34@mail7.acme.org or ANN.34@MAIL7.ACME.ORG. Call +1 (017) 555-7713 or +1### (017)$$$ 555-7713%%%, card '
        '4111 1111 1111 1111, ip 97.51.17.173 and 10.2.3.4. token = "04dbebab91ab85687d33eeaaf9ac699e1188f962", '
        'ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00. Mr John Smith met Mrs. Anna Smith.')


def test_kinds_and_normal_forms():
    found = [(kind, norm) for _, _, kind, norm in pii.entities(TEXT)]
    assert found == [
        ("email", "ann.34@mail7.acme.org"), ("email", "ann.34@mail7.acme.org"), ("phone", "10175557713"),
        ("phone", "10175557713"), ("card", "4111111111111111"), ("ip", "97.51.17.173"), ("ip", "10.2.3.4"),
        ("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962"), ("ssn", "123456789"), ("iban", "DE89370400440532013000"),
        ("given-m", "john"), ("family", "smith"), ("given-f", "anna"), ("family", "smith")]


@pytest.mark.parametrize("text", ["clean text 12 of 2024-01-01 and 3.14", "version 1.2.3 (c) 1999", "999.1.2.3", "a@b", "", None,
                                  "the token of 5 = 6", "Drive 12 miles, Donut", "x" * 100_000, "1" * 5000, "@" * 3000])
def test_clean_texts_stay(text):
    assert pii.entities(text) == []


def test_surrogates_keep_kind_form_and_coreference():
    out = pii.replaced(TEXT, "key", {})
    for _, _, kind, norm in pii.entities(TEXT):
        if kind != "secret":
            assert norm not in out.lower()
    mails = re.findall(r"[\w.]+@[\w.]+\w", out)
    assert mails[0].upper() == mails[1] and re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{4}\.example\.com", mails[0])
    phones = re.findall(r"\+1\W+(\d{3})\W+(\d{3})-(\d{4})", out)
    assert len(phones) == 2 and phones[0] == phones[1]
    card = re.search(r"card (4\d{3}(?: \d{4}){3})", out)[1]
    assert pii.luhn(card.replace(" ", ""))
    assert re.search(r"and 10\.\d+\.\d+\.\d+\.", out)
    assert re.search(r'token = "[0-9a-f]{40}"', out)
    male, family, female, again = re.search(r"Mr (\w+) (\w+) met Mrs\. (\w+) (\w+)", out).groups()
    assert family == again and male in pii.GIVEN["latin", "m"].split() and female in pii.GIVEN["latin", "f"].split()
    assert [k for _, _, k, _ in pii.entities(out)] == [k for _, _, k, _ in pii.entities(TEXT)]
    assert pii.replaced(TEXT, "other", {}) != out == pii.replaced(TEXT, "key", {})


def test_names_keep_their_script():
    out = pii.replaced("Госпожа Анна Петрова, Κύριος Νίκος", "key", {})
    assert re.fullmatch("Госпожа [А-Я][а-я]+ [А-Я][а-я]+, Κύριος [Α-ΩΆ-Ώ][α-ωά-ώϊϋΐΰ]+", out)


def test_table(frame):
    rows = [(1, TEXT, "a"), (2, None, None), (3, "", "b"), (4, "nothing here", "c"), (1, TEXT, "a"), (None, TEXT, "d"),
            (5, "word " * 30_000 + " ann.34@mail7.acme.org", "e")]
    docs = frame(rows, "doc_id long, text string, source string").selectExpr("*", "0L AS n_chars", "'z' AS n_entities")
    got = pii.replace_entities(docs, "key")
    assert got.columns == docs.columns
    out = {(r["doc_id"], r["source"]): r for r in got.collect()}
    assert got.count() == len(rows)
    assert out[1, "a"]["text"] == out[None, "d"]["text"] == pii.replaced(TEXT, "key", {})
    assert out[2, None]["text"] is None and out[2, None]["n_chars"] is None and out[3, "b"]["text"] == ""
    assert out[4, "c"]["text"] == "nothing here" and out[4, "c"]["n_entities"] == 0 and out[1, "a"]["n_entities"] == 14
    assert out[5, "e"]["n_chars"] == len(out[5, "e"]["text"]) and "ann.34" not in out[5, "e"]["text"]
    assert pii.replace_entities(docs.where("false"), "key").count() == 0


def test_collisions_are_drawn_again(frame):
    def narrow(kind, norm, attempt, key):
        """Surrogates from so few numbers that many collide, also with entities that exist."""
        import zlib
        return f"10.0.0.{zlib.crc32(f'{norm}/{attempt}'.encode()) % 90}"

    rows = [(i, f"host 10.0.0.{i} up, 10.0.0.{(i * 7) % 40} down") for i in range(40)]
    got = pii.replace_entities(frame(rows), "key", narrow).collect()
    origin = {}
    for row in got:
        for old, new in zip(re.findall(r"10\S+", rows[row["doc_id"]][1]), re.findall(r"10\S+", row["text"])):
            assert origin.setdefault(new, old) == old  # distinct stay distinct
            assert int(new.split(".")[-1]) >= 40  # and no surrogate is somebody's own
    assert len(origin) == 40 == len(set(origin.values()))


def test_full_surrogate_spaces_come_to_an_end(frame):
    rows = [(i, f"{c}@example.com") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    rows += [(100, "token: " + "-" * 40), (101, "secret = _______1")]
    rows += [(1000 + i, " ".join(f"192.168.{i}.{j}" for j in range(256))) for i in range(256)]
    got = {r["doc_id"]: r["text"] for r in pii.replace_entities(frame(rows), "key").collect()}
    mails = [got[i] for i in range(26)]
    assert len(set(mails)) == 26 and not set(mails) & {r[1] for r in rows}
    addresses = [a for i in range(256) for a in got[1000 + i].split(" ")]
    assert len(set(addresses)) == 65_536
    assert not any(a.startswith("192.168.") for a in addresses) and sum(a.startswith("10.") for a in addresses) == 65_536
    assert got[100] == rows[26][1] and re.fullmatch("secret = _______[0-9][a-z]*", got[101]) and got[101] != rows[27][1]


def test_every_mention_of_a_name_is_replaced():
    text = ("Mr John Smith met Dr John Smith. John Smith left. Smith said that SMITH and smithy stay, Smith's hat too; "
            "Mrs Will Brown will go by a brown door, Will. Herr Ludwig van der Rohe Mies, Rohe.")
    out = pii.replaced(text, "key", {})
    john, smith = re.match(r"Mr (\w+) (\w+) met", out).groups()
    assert "John" not in out and not re.search(r"\bSmith\b", out)
    assert f"Dr {john} {smith}. {john} {smith} left. {smith} said that SMITH and smithy stay, {smith}'s hat too" in out
    assert "will go by a brown door, Will." in out and " van der " in out and "Rohe" not in out
    assert pii.replaced("Miss Anna ran. Anna won", "key", {}).count("Anna") == 0
    assert [x[2:] for x in pii.entities("Mr John said Hello")] == [("family", "john")]


@pytest.mark.parametrize("secret", [
    "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P", "sk-" + "aB3_" * 150,
    "ghp_" + "a1B2" * 40, "0123456789abcdef" * 40])
def test_whole_secrets_of_any_length(secret):
    for text in (f"see {secret} now", f"token = {secret}.", f'"secret": "{secret}"' .replace('"secret":', "secret:")):
        (a, b, kind, _), = pii.entities(text)
        assert (text[a:b], kind) == (secret, "secret")
        made = pii.replaced(text, "key", {})
        assert len(made) == len(text) and not any(part[8:] in made for part in secret.split("."))
    padded = "password=QWxhZGRpbjpvcGVu1234=="
    assert padded[9:] == padded[slice(*pii.entities(padded)[0][:2])]


def test_names_stay_distinct_over_genders(frame):
    rows = [(i, f"{title}. Given{chr(97 + i // 26)}{chr(97 + i % 26)} Family went") for i in range(120)
            for title in [("Mr", "Mrs", "Dr")[i % 3]]]
    got = pii.replace_entities(frame(rows), "key").collect()
    given = [re.match(r"\w+\. (\w+)", r["text"])[1] for r in got]
    family = {re.match(r"\w+\. \w+ (\w+)", r["text"])[1] for r in got}
    assert len(set(given)) == 120 and len(family) == 1
