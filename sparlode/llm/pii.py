"""Personal data replaced by surrogates of the same kind.

Detected values get keyed replacements. A replacement is a permutation of all values of one
kind and format (a generalised Feistel network over the value's characters, each within its
own alphabet), so different values get different replacements and a value gets the same one
wherever it occurs, in any document and on any executor, without a shared table. Checks that
a format carries (card checksums, octets of an address, hexadecimal digits, a key's prefix)
hold for the replacement when they held for the value. Known given names change to given
names of the same gender and script and known surnames to surnames, by a permutation of the
list; other name words change letter by letter, vowels to vowels; letters of other scripts
change to letters of the same script.

Before anything is replaced, the surrogates of the whole corpus are checked: a value whose
surrogate is another value's too, or the value itself, gets a further choice under another key.
`collisions` reports on an outcome: replacements that stand for two values, values with two
replacements, and replacements that are themselves somebody's value.
"""

from __future__ import annotations

import datetime
import functools
import os
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Given names by script and gender, surnames by script (and gender where the form differs), titles by gender.
GIVEN = {
    ("latin", "female"): "Alice Anna Barbara Carol Catherine Christine Claudia Dorothy Elizabeth Emily Emma Helen Isabella Jennifer Julia Karen Laura Linda Maria Mary Nancy Olivia Patricia Sarah Sophia Susan".split(),
    ("latin", "male"): "Adam Andrew Anthony Brian Charles Daniel David Edward George Henry Jack James John Joseph Kevin Mark Martin Michael Paul Peter Richard Robert Simon Stephen Thomas William".split(),
    ("cyrillic", "female"): "Анна Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "male"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Сергей".split(),
}
SURNAMES = {
    ("latin", ""): "Adams Allen Anderson Baker Brown Campbell Carter Clark Davis Evans Garcia Green Hall Harris Hernandez Jackson Johnson Jones Lewis Lopez Martinez Miller Mitchell Moore Müller Nelson Parker Roberts Robinson Schmidt Scott Smith Taylor Turner Walker White Williams Wilson Wright Young".split(),
    ("cyrillic", "female"): "Васильева Иванова Кузнецова Михайлова Петрова Попова Смирнова Соколова".split(),
    ("cyrillic", "male"): "Васильев Иванов Кузнецов Михайлов Петров Попов Смирнов Соколов".split(),
}
TITLES = {"Mr": "male", "Mrs": "female", "Ms": "female", "Miss": "female", "Dr": "", "Prof": "", "Herr": "male", "Frau": "female", "Señor": "male", "Señora": "female", "Monsieur": "male", "Madame": "female"}

#: Alphabets that characters are permuted in, by the order tried.
ALPHABETS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ"]
HEX, CODE = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: For secrets without a Latin letter or digit.
SYMBOLS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
#: Rounds of a permutation, and choices for a value whose surrogates collide.
ROUNDS, CHOICES = 8, 8

_GIVEN = {n: (kind, k) for kind, names in GIVEN.items() for k, n in enumerate(names)}
_SURNAME = {n: (kind, k) for kind, names in SURNAMES.items() for k, n in enumerate(names)}
#: Vowel signs and other marks, which are parts of words in many scripts.
_MARKS = "".join(f"{chr(a)}-{chr(b)}" for a, b in [(0x300, 0x36F), (0x483, 0x487), (0x591, 0x5BD), (0x5BF, 0x5BF), (0x5C1, 0x5C2), (0x5C4, 0x5C5), (0x610, 0x61A), (0x64B, 0x65F), (0x670, 0x670), (0x6D6, 0x6DC), (0x900, 0x903), (0x93A, 0x93C), (0x93E, 0x94F), (0x981, 0x983), (0x9BC, 0x9BC), (0x9BE, 0x9CD), (0xA01, 0xA03), (0xA3C, 0xA51), (0xA81, 0xA83), (0xABC, 0xABC), (0xABE, 0xACD), (0xB01, 0xB03), (0xB3E, 0xB4D), (0xB82, 0xB82), (0xBBE, 0xBCD), (0xC00, 0xC04), (0xC3E, 0xC4D), (0xC81, 0xC83), (0xCBE, 0xCCD), (0xD00, 0xD03), (0xD3E, 0xD4D), (0xE31, 0xE31), (0xE34, 0xE3A), (0xE47, 0xE4E), (0x102B, 0x103E)])
_WORD = rf"[^\W\d_](?:[^\W\d_]|[{_MARKS}])*"
_NAME_WORD = rf"(?![a-zа-яα-ω])[^\W\d_](?:[^\W\d_]|[{_MARKS}])+"
_END = rf"(?![\w{_MARKS}])"

PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,24}(?![\w-]))"
    r"|(?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?P<secret>(?<=(?i:password)=)[^\s\"']{6,}|(?<=(?i:token) = \")[^\s\"]{8,}(?=\")|(?<=(?i:token)=)[^\s\"']{8,}|(?<!\w)[0-9A-Fa-f]{32,64}(?!\w))"
    r"|(?i:\b(?:password|passwd|pwd|api[_-]?key|secret(?:[_-]?key)?|access[_-]?token)\b[\"']?\s?[:=]\s?[\"']?)(?P<named>(?=[^\s\"']*\d)[^\s\"',;]{6,})"
    r"|(?i:\b(?:d\.?o\.?b\.?|date of birth|birth ?date|born(?: on)?)[: ]{1,3})(?P<dob>\d{4}-\d\d-\d\d|\d\d?(?P<mark>[./])\d\d?(?P=mark)\d{4})(?![\w-])"
    r"|(?P<ipv6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]))"
    r"|(?P<address>(?<![\w.,])[1-9]\d{0,4} (?:[A-Z][a-z'-]+ ){1,3}(?=(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Court|Square|Terrace)\b)|(?<=[a-z]stra\u00dfe )[1-9]\d{0,3}(?!\w))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<phone>(?<![\w.+])\+\d{1,3}[ -]?\(\d{1,4}\)[ -]?\d{3}[ -]?\d{4}(?![\w-])|(?<![\w.+])\+\d{1,3}[ -]?(?:\(\d{1,4}\)[ -]?)?\d{2,4}(?:[ -]?\d{2,4}){1,3}(?![\w-]|\.\d)|(?<![\w.])\(\d{3}\) ?\d{3}-\d{4}(?!\w))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?![\w-]))"
    r"|(?P<national>(?<![\w.+-])(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3} \d{3} \d{4}|0\d(?:[ .]\d\d){4}|0\d{1,4}[ /-]\d{3,8}(?:[ -]\d{2,6}){0,2})(?![\w-]|\.\d))"
)
#: Capitalised words that are no surname after a given name.
_NO_SURNAME = "The|And|Or|But|Of|In|On|At|To|By|For|From|With|As|If|Is|Was|Are|Were|Has|Had|Have|He|She|It|We|You|They|His|Her|Their|Our|My|This|That|When|Then|Who|Not|An"
#: What announces a name, and capitalised words that then are none.
_CUES = r"(?i:my name is|name:|dear|regards,|sincerely,|signed,|attn:?|contact person:?|spoke (?:to|with)) {1,2}|(?i:regards,|sincerely,)\n{1,2}"
_NO_NAME = _NO_SURNAME + "|Sir|Sirs|Madam|All|Team|Customer|Customers|Friend|Friends|Reader|Readers|Colleague|Colleagues|Support|Service|Mr|Mrs|Ms|Miss|Dr|Prof"
NAMES = re.compile(rf"\b(?:(?P<title>{'|'.join(TITLES)})\.? (?P<after>{_NAME_WORD}(?: {_NAME_WORD})?)|(?P<given>{'|'.join(_GIVEN)}) (?!(?:{_NO_SURNAME})\b)(?P<surname>{_NAME_WORD})|(?:{_CUES})(?!(?:{_NO_NAME})\b)(?P<told>{_NAME_WORD}(?: (?!(?:{_NO_NAME})\b){_NAME_WORD})?)){_END}")
#: What must be in a text for PATTERN to be worth running.
HINT = re.compile(r"[0-9@]|(?i:password|token)")


#: The setting that holds the key; without it every application draws one of its own.
KEY_SETTING = "spark.sparlode.surrogate.key"
_DRAWN: dict[str, bytes] = {}


def surrogate_key(spark: SparkSession) -> bytes:
    """The session's key: the setting, as UTF-8 of 16 to 64 bytes, or a random one that lasts as long as the application.

    Set it to have the same surrogates in several applications, and keep it secret: whoever has
    it can find the values behind surrogates.
    """
    given = spark.conf.get(KEY_SETTING, None) or spark.sparkContext.getConf().get(KEY_SETTING)
    if given:
        if not 16 <= len(given.encode()) <= 64:
            raise ValueError(f"{KEY_SETTING} must have 16 to 64 bytes")
        return given.encode()
    return _DRAWN.setdefault(spark.sparkContext.applicationId, os.urandom(32))


def _digest(key: bytes, *parts: str) -> int:
    return int.from_bytes(blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), key=key, digest_size=32).digest(), "big")


def permute(key: bytes, tweak: str, digits: list[int], radices: list[int]) -> list[int]:
    """A keyed permutation of the mixed-radix numbers of one shape; `tweak` and the shape choose it."""
    if len(digits) < 2:
        if not digits:
            return []
        # One character: a rotation of its alphabet, by an amount that is never zero.
        r = radices[0]
        return [(digits[0] + 1 + _digest(key, tweak, str(r)) % (r - 1)) % r] if r > 1 else digits
    cut = len(digits) // 2
    sizes = [functools.reduce(lambda a, b: a * b, part, 1) for part in (radices[:cut], radices[cut:])]
    halves = [_number(digits[:cut], radices[:cut]), _number(digits[cut:], radices[cut:])]
    shape = ",".join(map(str, radices))
    for i in range(ROUNDS):
        side = i % 2
        halves[side] = (halves[side] + _digest(key, tweak, shape, str(i), str(halves[1 - side]))) % sizes[side]
    return _digits(halves[0], radices[:cut]) + _digits(halves[1], radices[cut:])


def _number(digits: list[int], radices: list[int]) -> int:
    n = 0
    for d, r in zip(digits, radices):
        n = n * r + d
    return n


def _digits(n: int, radices: list[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        n, d = divmod(n, r)
        out.append(d)
    return out[::-1]


@functools.cache
def _other_alphabets() -> dict[str, str]:
    """The alphabet, at least two letters of one script and sort, of every letter outside ALPHABETS."""
    known, groups = set("".join(ALPHABETS)), defaultdict(list)
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if c.isalpha() and c not in known and (c.lower() == c or len(c.lower()) > 1):
            name = unicodedata.name(c, "OTHER LETTER").split()
            block = -1 if "\u4e00" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7a3" else ord(c) >> 7
            groups[name[0], *name[1:2], block, len(c.upper()) == 1 and c.upper().lower() == c].append(c)
    alone = [c for g in groups.values() if len(g) == 1 for c in g]
    return {c: "".join(g if len(g) > 1 else alone) for g in groups.values() for c in g}


def _by_alphabet(key: bytes, kind: str, value: str, alphabets: list[str], cased: bool, others: bool = False) -> str:
    """Permutes the characters of value that are in one of the alphabets; others stay and are part of the format.

    others: letters in none of the alphabets are permuted with those of their script.
    cased: upper and lower case are different characters' values (each keeps its case);
    otherwise values that differ in case are the same value and get the same replacement.
    """
    shape, digits, radices, places = [], [], [], []
    for c in value:
        low = c.lower()
        alphabet = next((a for a in alphabets if low in a or c in a), None) if len(low) == 1 else None
        if alphabet is None and others and not c.isascii():
            alphabet = _other_alphabets().get(low) or _other_alphabets().get(c)
        if alphabet is None:
            shape.append(c if cased else low)
            continue
        digits.append(alphabet.index(c if c in alphabet else low))
        radices.append(len(alphabet))
        places.append((alphabet, c.isupper() and c not in alphabet))
        shape.append(f"\x1e{alphabets.index(alphabet) if alphabet in alphabets else alphabet[0]}{'U' if cased and c.isupper() else ''}")
    new = iter(zip(permute(key, kind + "\x1d" + "".join(shape), digits, radices), places))
    out = []
    for s in _chars(shape, value):
        if s is None:
            d, (alphabet, upper) = next(new)
            out.append(alphabet[d].upper() if upper else alphabet[d])
        else:
            out.append(s)
    return "".join(out)


def _chars(shape: list[str], value: str) -> Iterator[str | None]:
    for s, c in zip(shape, value):
        yield None if s[0] == "\x1e" and len(s) > 1 else c


def luhn_digit(digits: str) -> int:
    """The check digit that completes these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + (i % 2 == 0))
        total += d - 9 * (d > 9)
    return -total % 10


def surrogate(key: bytes, kind: str, value: str) -> str:
    """The replacement of one detected value."""
    if kind == "ip":
        new = permute(key, "ip", [int(x) for x in value.split(".")], [256] * 4)
        return ".".join(map(str, new))
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        new = "".join(map(str, permute(key, f"card{digits[0]}", [int(c) for c in digits[1:-1]], [10] * (len(digits) - 2))))
        body = digits[0] + new
        # The check digit keeps its distance from the right one: valid numbers stay valid, others don't become so.
        last = (luhn_digit(body) + int(digits[-1]) - luhn_digit(digits[:-1])) % 10
        fresh = iter(body + str(last))
        return "".join(next(fresh) if c.isdigit() else c for c in value)
    if kind == "phone" and value.startswith("+"):
        code = re.match(r"\+\d{1,3}(?=[ (-])|\+\d", value)[0]
        return code + _by_alphabet(key, "phone" + code, value[len(code) :], ["0123456789"], False)
    if kind == "phone" and value[0].isdigit():
        if value[0] == "0":
            return "0" + _by_alphabet(key, "phone0", value[1:], ["0123456789"], False)
        new = value
        while True:  # cycle-walking: a leading zero stays with the numbers that have one
            new = _by_alphabet(key, "phone", new, ["0123456789"], False)
            if new[0] != "0":
                return new
    if kind == "key":
        if all(c in CODE for c in value[4:]):
            return value[:4] + _by_alphabet(key, "key" + value[:4], value[4:], [CODE], True)
        new = value  # digits beyond the usual alphabet: all letters and digits, until the result is of this sort again
        while True:
            new = new[:4] + _by_alphabet(key, "code" + value[:4], new[4:], [CODE + "0189"], True)
            if not all(c in CODE for c in new[4:]):
                return new
    if kind == "secret":
        if all(c in HEX for c in value.lower()):
            return _by_alphabet(key, "hex", value, [HEX], True)
        if not any(c.isascii() and c.isalnum() for c in value):
            return _by_alphabet(key, "symbols", value, [SYMBOLS], True, True)
        new = value
        while True:  # cycle-walking: never become what a hexadecimal value can become
            new = _by_alphabet(key, "secret", new, ["0123456789", "abcdefghijklmnopqrstuvwxyz"], True)
            if not all(c in HEX for c in new.lower()):
                return new
    if kind == "email":
        name, _, domain = value.rpartition("@")
        host, dot, top = domain.rpartition(".")
        # The top-level domain stays; everything before it is permuted as one value, so mailboxes stay distinct.
        new = _by_alphabet(key, "email" + top.lower(), f"{name}@{host}", ["0123456789", "abcdefghijklmnopqrstuvwxyz"], False)
        return new + dot + top
    if kind in ("iban", "ssn", "phone"):
        return value[:2] * (kind == "iban") + _by_alphabet(key, kind + value[:2] * (kind == "iban"), value[2 * (kind == "iban") :], ["0123456789", "abcdefghijklmnopqrstuvwxyz"], True)
    if kind == "ipv6":
        return _by_alphabet(key, "ipv6", value, [HEX], False)
    if kind == "dob":
        day, new = _day(value), None
        at = (day - _FIRST_DAY).days
        while new is None or new >= _DAYS:  # cycle-walking: a day of the same two centuries
            a, b = permute(key, "dob", list(divmod(at if new is None else new, 272)), [272, 272])
            new = a * 272 + b
        return _written(_FIRST_DAY + datetime.timedelta(days=new), value)
    if kind == "address":
        new = value
        while True:  # cycle-walking: house numbers don't begin with a zero
            new = _by_alphabet(key, "address", new, ALPHABETS, True)
            if new[0] != "0":
                return new
    raise ValueError(f"no such kind: {kind}")


#: Days of birth that are replaced, by each other.
_FIRST_DAY, _DAYS = datetime.date(1850, 1, 1), 73_049


def _day(text: str) -> datetime.date | None:
    """The date, day before month unless that is impossible; None for no date or one out of range."""
    parts = [int(x) for x in re.split(r"\D", text)]
    year, month, day = parts if "-" in text else (parts[2], parts[1], parts[0]) if parts[1] <= 12 else (parts[2], parts[0], parts[1])
    try:
        found = datetime.date(year, month, day)
    except ValueError:
        return None
    return found if 0 <= (found - _FIRST_DAY).days < _DAYS else None


def _written(day: datetime.date, like: str) -> str:
    if "-" in like:
        return day.isoformat()
    mark = "." if "." in like else "/"
    wide = len(like) == 10
    return mark.join([f"{day.day:02}", f"{day.month:02}"] if wide else [str(day.day), str(day.month)]) + mark + str(day.year)


def name_surrogate(key: bytes, word: str) -> str:
    """The replacement of one word of a name, of the same script (and gender, where listed), in the same case; it depends on nothing but the word."""
    plain = word.capitalize()
    for table, lists, tag in ((_GIVEN, GIVEN, "given"), (_SURNAME, SURNAMES, "surname")):
        if plain in table:
            kind, k = table[plain]
            names = lists[kind]
            step = 1 + _digest(key, tag, *kind) % (len(names) - 1)  # a rotation that moves every name
            new = names[(k + step) % len(names)]
            break
    else:
        new = plain
        while True:  # cycle-walking past the lists, whose names stand for each other
            new = _by_alphabet(key, "name", new, ALPHABETS, False, True).capitalize()
            if new not in _GIVEN and new not in _SURNAME:
                break
    return new.upper() if word.isupper() and len(word) > 1 else new


def _told(kind: str, value: str) -> str:
    """SHA-256 of a value as compared (case folded)."""
    return sha256((value.lower() if kind in ("email", "name", "ip", "ipv6") else value).encode("utf-8", "surrogatepass")).hexdigest()


class Replacer:
    """Finds and replaces personal data in texts; `choices` has the number of the choice of values whose first one collides."""

    def __init__(self, key: bytes, choices: dict[tuple[str, str], int] | None = None):
        self.key, self.choices = key, choices or {}
        self.known: dict[tuple[str, str], str] = {}

    def value(self, kind: str, value: str) -> str:
        found = self.known.get((kind, value))
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            choice = self.choices.get((kind, _told(kind, value)), 0) if self.choices else 0
            key = blake2b(b"choice %d" % choice, key=self.key).digest() if choice else self.key
            found = self.known[kind, value] = name_surrogate(key, value) if kind == "name" else surrogate(key, kind, value)
        return found

    def find(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, replacement) of every value, in order, none overlapping."""
        found = []
        if HINT.search(text):
            for m in PATTERN.finditer(text):
                kind = m.lastgroup
                if kind == "card" and not 13 <= sum(c.isdigit() for c in m[0]) <= 19:
                    continue
                if kind == "national":
                    if not 9 <= sum(c.isdigit() for c in m[0]) <= 12:
                        continue
                    kind = "phone"
                start, end = m.span(m.lastgroup)
                kind = "secret" if kind == "named" else kind
                if kind == "dob" and _day(m[kind]) is None:
                    continue
                found.append((start, end, kind, self.value(kind, text[start:end])))
        people: dict[str, str] = {}
        named = []
        for m in NAMES.finditer(text):
            group = ("after",) if m["title"] else ("told",) if m["told"] else ("given", "surname")
            for g in group:
                for w in re.finditer(_WORD, m[g]):
                    people[w[0]] = self.value("name", w[0])
                    named.append((m.start(g) + w.start(), m.start(g) + w.end()))
        if people:  # later mentions by one word of the name
            for m in re.finditer(rf"\b(?:{'|'.join(map(re.escape, sorted(people)))}){_END}", text):
                found.append((m.start(), m.end(), "name", people[m[0]]))
        found.sort()
        out, end = [], 0
        for x in found:
            if x[0] >= end:
                out.append(x)
                end = x[1]
        return out

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        found = self.find(text)
        parts, at = [], 0
        for start, end, _, new in found:
            parts += [text[at:start], new]
            at = end
        return "".join([*parts, text[at:]]), found


ENTITIES = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("surrogate", pa.string())]))


def _replaced(batches: Iterator[pa.RecordBatch], key: bytes, choices: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    tool = Replacer(key, choices)
    for batch in batches:
        texts, entities = [], []
        for text in batch.column(1):
            new, found = (None, []) if not text.is_valid else tool.replace(text.as_py())
            texts.append(new)
            entities.append([{"kind": k, "begin": a, "end": b, "surrogate": s} for a, b, k, s in found])
        yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array([len(e) for e in entities], pa.int64()), pa.array(entities, ENTITIES)], names=["doc_id", "text", "n_entities", "entities"])


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities, entities.

    entities has kind, begin, end (character offsets in the input) and surrogate; the
    originals are not returned. Null texts stay null and have no entities. Rows repeated
    under one id are replaced each, alike; an empty table gives an empty result; other
    columns are ignored.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("key must have 16 to 64 bytes")
    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    choices = settled(docs, key, text_col)
    return source.mapInArrow(lambda it: _replaced(it, key, choices), "doc_id long, text string, n_entities long, entities array<struct<kind: string, begin: long, end: long, surrogate: string>>")


def with_surrogates(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The documents with surrogates in the text column; other columns stay as they are."""
    choices = settled(docs, key, text_col)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Replacer(key, choices)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t.as_py() for t in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array([None if t is None else tool.replace(t)[0] for t in texts], batch.schema.field(at).type))

    return docs.mapInArrow(change, docs.schema)


def values(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", choices: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """Distinct (kind, original, surrogate) of a corpus, as SHA-256 digests of the values as compared (case folded)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Replacer(key, choices)
        for batch in batches:
            out = set()
            for text in batch.column(0):
                t = text.as_py() or ""
                out.update((k, t[a:b], s) for a, b, k, s in tool.find(t))
            told = {(k, _told(k, old), _told(k, new)) for k, old, new in out}
            columns = list(zip(*told)) or [(), (), ()]
            yield pa.record_batch([pa.array(c, pa.string()) for c in columns], names=["kind", "original", "surrogate"])

    return docs.select(F.col(f"`{text_col}`")).mapInArrow(rows, "kind string, original string, surrogate string").distinct()


def settled(docs: DataFrame, key: bytes, text_col: str = "text") -> dict[tuple[str, str], int]:
    """The choices, by kind and digest, with which no two values of a corpus have one surrogate and none is its own; most often none are needed.

    Of values with one surrogate the one with the smallest digest keeps it. Only what collides comes to the driver.
    """
    choices: dict[tuple[str, str], int] = {}
    for _ in range(CHOICES):
        one = values(docs, key, text_col=text_col, choices=choices).groupBy("kind", "surrogate").agg(F.sort_array(F.collect_set("original")).alias("originals"))
        bad = one.where((F.size("originals") > 1) | F.array_contains("originals", F.col("surrogate"))).collect()
        if not bad:
            return choices
        again = {(r["kind"], o) for r in bad for i, o in enumerate(r["originals"]) if i or o == r["surrogate"]}
        choices = choices | {x: choices.get(x, 0) + 1 for x in again}
    raise ValueError(f"{len(bad)} surrogates collide after {CHOICES} choices")


def collisions(found: DataFrame) -> DataFrame:
    """(kind, problem, digest) of what `values` shows to be ambiguous; empty when distinctness and coreference hold.

    problems: "two originals" (one surrogate for two values), "two surrogates" (one value
    with two), "surrogate in use" (a surrogate equals another value of the corpus; rare, and
    harmless to distinctness, since that value is replaced too).
    """
    one = found.groupBy("kind", "surrogate").agg(F.count_distinct("original").alias("n")).where("n > 1").select("kind", F.lit("two originals").alias("problem"), F.col("surrogate").alias("digest"))
    two = found.groupBy("kind", "original").agg(F.count_distinct("surrogate").alias("n")).where("n > 1").select("kind", F.lit("two surrogates").alias("problem"), F.col("original").alias("digest"))
    used = found.select("kind", F.col("surrogate").alias("digest")).distinct().join(found.select("kind", F.col("original").alias("digest")).distinct(), ["kind", "digest"])
    return one.unionByName(two).unionByName(used.select("kind", F.lit("surrogate in use").alias("problem"), "digest"))
