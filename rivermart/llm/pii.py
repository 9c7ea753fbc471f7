"""Operator 2: personal data and secrets replaced by keyed surrogates.

An entity is found in its surface form and known by a normal form (a phone
number by its digits, an address in lower case, a name by its words), so
that all its forms get the same surrogate. The surrogate is drawn from a hash
of key, kind and normal form and keeps the kind, the script, the gender of a
given name, the length classes and, when written back, the surface's
separators and letter case. Two entities that draw the same surrogate, or one
that draws an existing entity, are found by grouping all of them; all but the
first draw again until none are left. Later attempts draw from more surrogates
(longer ones, wider address blocks), so that this ends; given names are told apart
over all genders together.

A name is found after a title, up to four capitalised words with the particles
between them, and then wherever one of its words is written the same way in the
document, unless the document also has that word in lower case. A given name after a
title without gender is that of the same given name with one, if the document has it.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivermart.llm import common

DEFAULT_KEY = "change-me"
MOST_ATTEMPTS = 64
KEY_SETTING = "spark.rivermart.surrogate.key"

#: Titles before names, with the gender they tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Don": "m", "Doña": "f",
    "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
#: Given names to draw from, by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karim Leon Marco Nils Oscar Pavel",
    ("latin", "f"): "Anna Berta Clara Dora Elena Flora Greta Helga Irene Julia Karin Laura Maria Nora Olga Paula",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Нина Ольга",
    ("greek", "m"): "Άγγελος Γιάννης Δημήτρης Ηλίας Θωμάς Κώστας Λευτέρης Μάριος Νίκος Πέτρος",
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία"}
#: Syllables that longer names are made of, by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no pa po ra re ro sa se so ta te to va vi",
    "cyrillic": "ба бо ва во га го да де до за ка ко ла ле ло ма ми мо на не но па по ра ре ро са со та то",
    "greek": "βα γα γε δα δε κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το"}
ENDINGS = {"m": {"latin": "n", "cyrillic": "н", "greek": "ς"}, "f": {"latin": "a", "cyrillic": "а", "greek": "α"},
           "": {"latin": "r", "cyrillic": "в", "greek": "ς"}}

GAP = r"[^\w\n]{1,6}"
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,6}")),
    ("secret", re.compile(r"(?i)\b(?:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d)\b[^\w\n]{0,8}[=:][^\w\n]{0,8}"
                          r"(?P<value>[A-Za-z0-9+/_-]{8,}(?:\.[A-Za-z0-9+/_-]+)*={0,2})")),
    ("secret", re.compile(r"(?<![\w.-])(?P<value>eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+){0,3})(?![\w-])")),
    ("secret", re.compile(r"(?<![\w-])(?P<value>(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z_-]{16,})(?!\w)")),
    ("secret", re.compile(r"(?<!\w)(?P<value>(?=[a-fA-F]*\d)(?=\d*[a-fA-F])[0-9a-fA-F]{32,})(?!\w)")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?!\w)")),
    ("ip", re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("card", re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)")),
    ("phone", re.compile(rf"(?<!\w)(?:\+?\d{{1,3}}{GAP})?\(?\d{{3}}\)?{GAP}\d{{3}}[^\w\n]{{1,4}}\d{{4}}(?!\w)")),
    ("phone", re.compile(r"(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,6}(?!\w)")),
]
TITLED = re.compile(r"(?<!\w)(" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.?[ \t]+(?=[^\W\d_])")
#: Small words within names.
PARTICLES = {"al", "bin", "da", "de", "del", "den", "der", "di", "du", "la", "le", "van", "von"}
NAME_WORDS = 4
WORD = re.compile(r"[^\W\d_](?:[\w'’-]*\w)?")
NEXT_WORD = re.compile(r"[ \t]+([^\W\d_](?:[\w'’-]*\w)?)")
#: How known kinds of secrets begin.
MARKED_SECRET = re.compile(r"AKIA|ASIA|gh[pousr]_|sk-|eyJ")
DIGIT = re.compile(r"\d")
FOUND = [("k", pa.int64()), ("kind", pa.string()), ("norm", pa.string())]
DRAWN = [("kind", pa.string()), ("norm", pa.string()), ("attempt", pa.int32()), ("surrogate", pa.string())]
DRAWN_SCHEMA = "kind string, norm string, attempt int, surrogate string"


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def _normal(kind: str, surface: str) -> str | None:
    """The entity's normal form, or None if the surface is none after all."""
    if kind == "email":
        return surface.lower()
    if kind == "ip":
        octets = [int(x) for x in surface.split(".")]
        return ".".join(map(str, octets)) if max(octets) < 256 else None
    if kind == "secret":
        if not any(map(str.isalnum, surface)) or not DIGIT.search(surface) and len(surface.partition(".")[0]) < 16:
            return None
        return surface.lower() if all(c in string.hexdigits for c in surface) else surface
    if kind == "iban":
        packed = surface.replace(" ", "")
        return packed if 15 <= len(packed) <= 34 and int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1 else None
    digits = digits_of(surface)
    if kind == "card":
        return digits if len(digits) in (15, 16) or luhn(digits) else None
    if kind == "phone":
        return digits if 9 <= len(digits) <= 15 else None
    return digits


def names(text: str) -> list[tuple[int, int, str, str]]:
    """The words of names after titles, then all further mentions of those words."""
    found: list[tuple[int, int, str, str]] = []
    for match in TITLED.finditer(text):
        words: list[tuple[int, int]] = []
        step = WORD.match(text, match.end())
        while step:
            a, b = step.span(step.re.groups)
            if text[a].isupper():
                words.append((a, b))
            elif not words or text[a:b] not in PARTICLES:
                break
            if len(words) == NAME_WORDS:
                break
            step = NEXT_WORD.match(text, b)
        for i, (a, b) in enumerate(words):
            kind = "family" if i == len(words) - 1 else f"given-{TITLES[match[1]]}"
            found.append((a, b, kind, text[a:b].lower()))
    genders = {norm: kind for _, _, kind, norm in found if kind in ("given-m", "given-f")}
    found = [(a, b, genders.get(norm, kind) if kind == "given-" else kind, norm) for a, b, kind, norm in found]
    if not found:
        return found
    known: dict[str, tuple[str, str]] = {}
    for a, b, kind, norm in found:
        if kind != "family" or text[a:b] not in known:
            known[text[a:b]] = (kind, norm)
    mentions = [m.span() for m in WORD.finditer(text) if m[0] in known]
    lower = {norm for _, norm in known.values()}
    common_words = {m[0] for m in WORD.finditer(text) if m[0] in lower}
    # Words joined by an apostrophe or a hyphen: "Smith's" mentions Smith.
    joined = [(m.start(), m.start() + len(head)) for m in WORD.finditer(text) if m[0] not in known
              for head in [re.split("['’-]", m[0])[0]] if head in known]
    titled = {a for a, _, _, _ in found}
    return found + [(a, b, *known[text[a:b]]) for a, b in mentions + joined
                    if a not in titled and known[text[a:b]][1] not in common_words]


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and normal form of every entity; earlier kinds win where two overlap."""
    if not text:
        return []
    out: list[tuple[int, int, str, str]] = []
    at, digit = "@" in text, DIGIT.search(text) is not None
    for kind, pattern in PATTERNS:
        if not (at if kind == "email" else digit or kind == "secret"):
            continue
        if kind == "secret" and not digit and "=" not in text and ":" not in text:
            continue
        for match in pattern.finditer(text):
            a, b = match.span("value" if "value" in pattern.groupindex else 0)
            norm = _normal(kind, text[a:b].rstrip(".-") if kind == "email" else text[a:b])
            if norm is not None:
                out.append((a, a + len(text[a:b].rstrip(".-")) if kind == "email" else b, kind, norm))
    if any(title in text for title in TITLES):
        out += names(text)
    taken: list[tuple[int, int, str, str]] = []
    used: set[int] = set()
    for found in out:
        span = range(found[0], found[1])
        if used.isdisjoint(span):
            used.update(span)
            taken.append(found)
    return sorted(taken)


class _Draw:
    """A stream of numbers from a hash."""

    def __init__(self, *parts: str):
        self.numbers = hashlib.shake_256("\0".join(parts).encode("utf-8", "surrogatepass")).digest(4096)
        self.at = 0

    def below(self, n: int) -> int:
        self.at = (self.at + 4) % 4092
        return int.from_bytes(self.numbers[self.at:self.at + 4], "big") % n

    def one(self, choices: str | list[str]) -> str:
        return choices[self.below(len(choices))]


def script_of(text: str) -> str:
    for char in text:
        if "Ѐ" <= char <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= char <= "Ͽ" or "ἀ" <= char <= "῿":
            return "greek"
    return "latin"


def _alike(char: str, draw: _Draw, hexadecimal: bool = False) -> str:
    """Another character of the same class, case and script."""
    if char in string.digits:
        return draw.one(string.digits)
    if not char.isalpha():
        return char
    code = ord(char)
    if code < 0x370:
        letter = draw.one("abcdef" if hexadecimal else string.ascii_lowercase)
    elif 0x400 <= code < 0x530:
        letter = chr(0x430 + draw.below(32))
    elif code < 0x400:
        letter = draw.one("αβγδεζηθικλμνξοπρστυφχψω")
    else:  # another letter of the character's block of 128
        block = [c for c in map(chr, range(code & ~127, (code & ~127) + 128)) if c.isalpha()]
        return draw.one(block)
    return letter.upper() if char.isupper() else letter


def surrogate(kind: str, norm: str, attempt: int, key: str) -> str:
    """The surrogate's normal form; another attempt draws anew, later ones from more surrogates."""
    draw = _Draw(key, kind, norm, str(attempt))
    longer = "".join(draw.one(string.ascii_lowercase) for _ in range(min(attempt // 2, 32)))
    if kind == "email":
        local, _, domain = norm.partition("@")
        labels = domain.split(".")
        own = labels[:-2] if labels[-2:] in (["example", "com"], ["example", "org"], ["example", "net"]) else labels[:-1]
        # The domain draws by itself: addresses of one domain stay together.
        host = _Draw(key, "domain", domain, "0")
        head = ["".join(_alike(c, host) for c in label) for label in own]
        return "".join(_alike(c, draw) for c in local) + longer + "@" + ".".join([*head, "example", "com"])
    if kind == "ip":
        octets = norm.split(".")
        kept = 2 if norm.startswith("192.168.") else 1 if octets[0] in ("10", "127") else 0
        if attempt >= 4 and kept == 2:  # a block that is full: the largest private one, then any
            octets, kept = ["10", *octets[1:]], 1
        kept = 0 if attempt >= 24 else kept
        return ".".join(octets[:kept] + [str(1 + draw.below(254)) for _ in octets[kept:]])
    more = "".join(draw.one(string.digits) for _ in range(max(0, attempt // 8 - 2)))
    if kind in ("card", "phone", "ssn"):
        kept = 1 if kind == "card" else max(0, len(norm) - 10) if kind == "phone" else 0
        made = norm[:kept] + "".join(draw.one(string.digits) for _ in norm[kept:])
        if kind == "card":
            valid = next(made[:-1] + d for d in string.digits if luhn(made[:-1] + d))
            made = valid if luhn(norm) else made if not luhn(made) else made[:-1] + str((int(made[-1]) + 1) % 10)
        return made + more
    if kind == "iban":
        body = norm[:2] + "00" + "".join(_alike(c, draw) for c in norm[4:])
        rest = int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
        return f"{body[:2]}{98 - rest:02d}{body[4:]}{more}"
    if kind == "secret":
        hexadecimal = all(c in string.hexdigits for c in norm)
        parts = []
        for part in norm.split("."):
            head = MARKED_SECRET.match(part)[0] if MARKED_SECRET.match(part) else ""
            parts.append(head + "".join(_alike(c, draw, hexadecimal) for c in part[len(head):]))
        return ".".join(parts) + (longer if not hexadecimal else "".join(draw.one("0123456789abcdef") for _ in longer))
    script, gender = script_of(norm), kind.partition("-")[2]
    given = GIVEN.get((script, gender or draw.one("mf")))
    if kind != "family" and attempt == 0 and given:
        return draw.one(given.split()).lower()
    syllables = SYLLABLES[script].split()
    return "".join(draw.one(syllables) for _ in range(3 + attempt // 2)) + ENDINGS[gender][script]


def written(kind: str, surface: str, norm: str) -> str:
    """A normal form in the surface's separators and letter case."""
    if kind in ("card", "phone", "ssn", "iban"):
        left = iter(norm)
        return "".join([next(left, "") if c.isalnum() else c for c in surface] + list(left))
    if kind == "secret" or kind == "ip":
        return norm.upper() if surface.isupper() else norm
    if surface.isupper() and len(surface) > 1:
        return norm.upper()
    if kind == "email":
        return "".join(c.upper() if i < len(surface) and surface[i].isupper() else c for i, c in enumerate(norm))
    return norm[:1].upper() + norm[1:]


def replaced(text: str, key: str, attempts: dict[tuple[str, str], int], draw: Callable[..., str] = surrogate) -> str:
    """The text with every entity's surrogate; ``attempts`` has those that did not keep their first."""
    out, at = [], 0
    for a, b, kind, norm in entities(text):
        out += [text[at:a], written(kind, text[a:b], draw(kind, norm, attempts.get((kind, norm), 0), key))]
        at = b
    return "".join([*out, text[at:]])


def _drawn(rows: DataFrame, key: str, draw: Callable[..., str]) -> DataFrame:
    """kind, norm, attempt with their surrogates."""

    def make(batches):
        for batch in batches:
            kinds, norms, attempts = (batch.column(i).to_pylist() for i in range(3))
            yield common.batch_of(DRAWN, kinds, norms, attempts,
                                  [draw(k, n, a, key) for k, n, a in zip(kinds, norms, attempts)])

    return common.map_arrow(rows.select("kind", "norm", "attempt"), make, DRAWN_SCHEMA)


def later_attempts(names: DataFrame, key: str, draw: Callable[..., str] = surrogate) -> DataFrame:
    """kind, norm and attempt of the entities whose first surrogate is taken, from distinct (kind, norm).

    Of entities with one surrogate the one of the fewest attempts, then the
    first by name, keeps it; an entity's own form or another's is no surrogate.
    Given names of all genders count as one kind here. Each round groups all
    surrogates; only those that lost are drawn again, and if some still lose after
    ``MOST_ATTEMPTS`` rounds, which takes billions of entities, this stops with an error.
    """
    group = F.element_at(F.split("kind", "-"), 1)
    every = common.stored(_drawn(names.withColumn("attempt", F.lit(0)), key, draw), "surrogates")
    originals = every.select(group.alias("group"), F.col("norm").alias("surrogate")).distinct()
    for _ in range(MOST_ATTEMPTS):
        grouped = every.withColumn("group", group)
        best = grouped.groupBy("group", "surrogate").agg(
            F.count("*").alias("n"), F.min(F.struct("attempt", "norm", "kind")).alias("best")).where("n > 1")
        lost = (grouped.join(best, ["group", "surrogate"]).where("norm <> best.norm OR kind <> best.kind")
                .select("kind", "norm", "attempt"))
        known = grouped.join(originals, ["group", "surrogate"], "left_semi").select("kind", "norm", "attempt")
        bad = common.stored(lost.union(known).distinct(), "surrogates-lost")
        if bad.isEmpty():
            return every.where("attempt > 0").select("kind", "norm", "attempt")
        again = _drawn(bad.withColumn("attempt", F.col("attempt") + 1), key, draw)
        every = common.stored(every.join(bad.select("kind", "norm"), ["kind", "norm"], "left_anti")
                              .select("kind", "norm", "attempt", "surrogate").union(again), "surrogates")
    raise RuntimeError(f"entities without a surrogate of their own after {MOST_ATTEMPTS} attempts")


def replace_entities(docs: DataFrame, key: str, draw: Callable[..., str] = surrogate) -> DataFrame:
    """``docs`` with surrogates in ``text`` and n_entities, the number of replaced places.

    Other columns stay, but for n_chars, if there, which is counted anew. A null
    text stays null. Texts are never shuffled unless very many documents hold
    entities that drew twice; those attempts are joined by a hash of the text.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    place = F.xxhash64(F.col("text").cast("string"))

    def find(batches):
        for batch in batches:
            rows: list[tuple] = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += sorted({(k, kind, norm) for _, _, kind, norm in entities(text)})
            if rows:
                yield common.batch_of(FOUND, *zip(*rows))

    texts = docs.select(place.alias("k"), F.col("text").cast("string").alias("text")).where("text is not null")
    found = common.stored(common.map_arrow(texts, find, "k long, kind string, norm string"), "entities")
    attempts = later_attempts(found.select("kind", "norm").distinct(), key, draw)
    marked = found.distinct().join(attempts, ["kind", "norm"]).groupBy("k").agg(
        F.collect_list(F.struct("kind", "norm", "attempt")).alias("attempts"))
    marked = common.stored(marked, "surrogates-again").select(F.col("k").alias("__known"), F.col("attempts").alias("__attempts"))
    columns = [c for c in docs.columns if c not in ("text", "n_entities")]
    joined = docs.withColumn("__place", place).join(marked, F.col("__place") == F.col("__known"), "left")
    joined = joined.select(*columns, F.col("text").cast("string").alias("text"), "__attempts")
    schema = joined.drop("__attempts").withColumn("n_entities", F.lit(0).cast("int")).schema

    def write(batches):
        for batch in batches:
            columns_, texts, counts = batch.columns[:-2], [], []
            for text, again in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                known = {(x["kind"], x["norm"]): x["attempt"] for x in again or ()}
                counts.append(len(entities(text)))
                texts.append(replaced(text, key, known, draw) if counts[-1] else text)
            yield pa.RecordBatch.from_arrays(
                [*columns_, pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                [*batch.schema.names[:-1], "n_entities"])

    out = common.map_arrow(joined, write, schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[c for c in docs.columns if c != "n_entities"], "n_entities")
