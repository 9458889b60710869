"""Personal data replaced by surrogates.

Detection finds e-mail addresses, phone numbers, payment cards, IPv4 and IPv6 addresses, US social security numbers, IBANs, access keys, tokens and
passwords, and names behind a title. A name word found behind a title is found wherever else the same text has it as a whole word in the same
spelling or in capitals, before or after. Every find has a kind and a canonical value (digits only, lower case, one name word), so the same
thing written in two ways, or in two documents, is one entity: it gets one surrogate everywhere.

A surrogate is a keyed permutation (a Feistel network over the free characters) of the canonical value within its form: digits become digits,
letters become letters of the same script and case; separators, country code, card brand and check digit, IBAN country and the domain stay valid. It is
laid into the spelling found. Name words become names of the gender that the title tells, or made-up words of the script.

Collision check: the distinct entities of all documents are one table. A surrogate that another entity has too, or that is itself the
value of an entity, is drawn again with the next attempt number, until there is none. What needed another attempt is a small table: up to
MOST_SENT rows of MOST_LONG characters travel to the tasks, more are joined by document. Clashes left after MOST_ATTEMPTS attempts raise an error.

Texts without finds come back unchanged. Null stays null, empty stays empty. Rows with equal key are treated alike. Columns not named are
kept but not read; if one is named `pii_kinds`, the added column gets an underscore more. Texts are searched whole, whatever their length. An
empty table gives an empty result.
"""

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.shared import written

MOST_ATTEMPTS, MOST_SENT, MOST_LONG = 40, 50_000, 200
ROUNDS = 6

# Titles by gender.
TITLES = {
    "m": "Mr Mister Sir Herr Monsieur Señor Sr Signor Господин Κύριος".split(),
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Señora Sra Señorita Signora Госпожа Κυρία".split(),
    "n": "Dr Prof Professor Doctor Mx".split(),
}
# Given names by script and gender.
GIVEN = {
    "Latin": {
        "m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Noah Oscar Paul Robert Simon Thomas Victor".split(),
        "f": "Anna Bella Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
        "n": "Alex Andrea Ariel Casey Chris Dominique Jamie Jordan Kim Lou Morgan Noor Robin Sacha Sam Sasha Taylor Terry Toni Val".split(),
    },
    "Cyrillic": {
        "m": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Марк Никита Олег Павел Роман".split(),
        "f": "Анна Вера Галина Дарья Ева Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса".split(),
        "n": "Женя Саша Валя Шура Слава Паша Миша Сима Тоня Юля".split(),
    },
}
# Syllables of made-up names, and the letters of scripts.
SYLLABLES = {
    "Latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo".split(),
    "Cyrillic": "ба бе бо ва ве го да де за ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то".split(),
    "Greek": "βα βε γα δα δε κα κο λα λε λο μα με μο να νε νο πα πο ρα ρε ρο σα σε σο τα τε το".split(),
}
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
PLAIN_DOMAINS = ("example.com", "example.org", "example.net")

_NAME = r"[^\W\d_a-z][^\W\d_]+"
_TITLE = "|".join(sorted((x for xs in TITLES.values() for x in xs), key=len, reverse=True))
_GENDER = {x: g for g, xs in TITLES.items() for x in xs}
_FINDERS = {
    "email": r"(?<![\w.+-])[\w+-][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?:gh[pousr]_|sk-|(?:sk|pk|rk)_(?:live|test)_|xox[abp]-)[A-Za-z0-9-]{16,}"
    r"|(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "secret": r"(?i:(?:password|passwd|pwd|secret|api[_-]?key|token)\s*[=:]\s*[\"']?)(?P<secret_value>[^\s\"']{6,})",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ip6": r"(?<![\w:.])(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{6,39}(?![\w:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])|(?<![0-9])3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])",
    "phone": r"(?<![\w.])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|(?<![\w.+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![\w.+])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9])",
    "name": rf"\b(?P<title>{_TITLE})\b\.?[  ](?P<words>{_NAME}(?:[ -]{_NAME}){{0,2}})",
}
_ALL = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _FINDERS.items()))
_NUMBER = re.compile("|".join(f"(?P<{kind}>{_FINDERS[kind]})" for kind in ("ip", "ssn", "card", "phone")))
_WHOLE = re.compile(r"[^\W\d_]+")
_DIGIT_OR_AT = re.compile(r"[0-9@]")
_WORDS_OF_SECRETS = ("passw", "pwd", "secret", "token", "api", "sk-", "sk_", "pk_", "rk_", "eyj", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox")
_TITLED = tuple(x + end for xs in TITLES.values() for x in xs for end in (" ", ".", "\u00a0"))


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_rest(value: str) -> int:
    """1 for a valid IBAN."""
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def script_of(word: str) -> str:
    """Latin, Cyrillic or Greek by the first letter that tells."""
    for c in word:
        if "Ѐ" <= c <= "ԯ":
            return "Cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "Greek"
    return "Latin"


def may_hold(text: str) -> bool:
    """False for a text in which nothing can be found, by quick tests."""
    if _DIGIT_OR_AT.search(text) or any(x in text for x in _TITLED):
        return True
    lower = text.lower()
    return any(x in lower for x in _WORDS_OF_SECRETS)


def phone_end(text: str, start: int, end: int) -> int | None:
    """Where a phone number ends that may have run into the number behind it; None if no part of it has 8 to 15 digits.

    After +1 come ten digits. Elsewhere the number stops before groups that are an address or another number by themselves.
    """
    groups = list(re.finditer(r"[0-9]+\)?", text[start:end]))
    sizes = [sum(c.isdigit() for c in text[start : start + x.end()]) for x in groups]
    ends = [(start + x.end(), n) for x, n in zip(groups, sizes, strict=True) if 8 <= n <= 15]
    if groups[0][0] == "1" and text[start] == "+":
        ends = [x for x in ends if x[1] == 11] or ends
    for at, _ in ends:
        behind = _NUMBER.match(text, at + (text[at : at + 1] in (" ", "."))) if at < end else None
        if behind and (behind["card"] is None or luhn(re.sub("[^0-9]", "", behind[0]))):
            return at
    return ends[-1][0] if ends else None


def exploded(value: str) -> str | None:
    """An IPv6 address in full, None if it is none or names no host."""
    try:
        address = ipaddress.IPv6Address(value)
    except ValueError:
        return None
    return None if int(address) < 1 << 64 else address.exploded


def finds(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of everything found, from left to right, without overlap."""
    if not text or not may_hold(text):
        return []
    found = list(_by_form(text))
    names = {}
    for start, end, kind, value in found:
        if kind == "surname" or kind.startswith("given"):
            for spelling in (text[start:end], text[start:end].upper()):
                names.setdefault(spelling, (kind, value))
    if not names:
        return found
    out, number = [], 0
    for word in _WHOLE.finditer(text):
        if word[0] not in names:
            continue
        start, end = word.span()
        while number < len(found) and found[number][1] <= start:
            out.append(found[number])
            number += 1
        if number == len(found) or end <= found[number][0]:
            out.append((start, end, *names[word[0]]))
    return out + found[number:]


def _by_form(text: str) -> Iterator[tuple[int, int, str, str]]:
    """What its own form or a title before it tells, from left to right, without overlap."""
    at = 0
    while found := _ALL.search(text, at):
        kind, value, (start, end) = found.lastgroup, found[0], found.span()
        kind = next(k for k in _FINDERS if found[k] is not None)
        at = end
        if kind == "email":
            yield start, end, kind, value.lower()
        elif kind == "secret":
            yield *found.span("secret_value"), kind, found["secret_value"]
        elif kind == "key":
            yield start, end, kind, value
        elif kind == "iban":
            if iban_rest(value.replace(" ", "")) == 1:
                yield start, end, kind, value.replace(" ", "")
            else:
                at = start + 2
        elif kind == "ip":
            if max(map(int, value.split("."))) < 256:
                yield start, end, kind, ".".join(str(int(x)) for x in value.split("."))
            else:
                at = start + 1
        elif kind == "ip6":
            full = exploded(value)
            if full:
                yield start, end, kind, full
            else:
                at = start + 1
        elif kind == "name":
            gender, place = _GENDER[found["title"]], found.start("words")
            words = list(re.finditer(_NAME, found["words"]))
            for number, word in enumerate(words):
                own = "surname" if number == len(words) - 1 else f"given:{gender}"
                yield place + word.start(), place + word.end(), own, word[0].lower()
        else:
            if kind == "phone":
                stop = phone_end(text, start, end)
                if stop is None:
                    at = start + 1
                    continue
                at = end = stop
            digits = re.sub("[^0-9]", "", text[start:end])
            if kind == "card" and len(digits) != 16 and not luhn(digits):
                at = start + 1
                continue
            if kind == "phone":
                digits = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
            yield start, end, kind, digits


def _number(secret: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(secret, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest(), "big")


def permuted(value: str, free: list[tuple[int, str]], secret: bytes, tweak: str) -> str:
    """The value with its free places (position, alphabet) permuted: one to one among values that agree elsewhere."""
    if not free:
        return value
    half = (len(free) + 1) // 2
    sides = [free[:half], free[half:]]

    def size(side) -> int:
        n = 1
        for _, letters in side:
            n *= len(letters)
        return n

    def read(side) -> int:
        n = 0
        for place, letters in side:
            n = n * len(letters) + letters.index(value[place])
        return n

    sizes, numbers = [size(x) for x in sides], [read(x) for x in sides]
    for turn in range(ROUNDS):
        a = turn % 2
        numbers[a] = (numbers[a] + _number(secret, tweak, turn, numbers[1 - a])) % sizes[a]
    out = list(value)
    for side, n in zip(sides, numbers, strict=True):
        for place, letters in reversed(side):
            n, digit = divmod(n, len(letters))
            out[place] = letters[digit]
    return "".join(out)


def _free(value: str, start: int = 0, hexadecimal: bool = False) -> list[tuple[int, str]]:
    out = []
    for place in range(start, len(value)):
        c = value[place]
        for letters in ["0123456789", "abcdef", "ABCDEF"] if hexadecimal else [*ALPHABETS, *(x.upper() for x in ALPHABETS[1:])]:
            if c in letters:
                out.append((place, letters))
                break
    return out


def surrogate(kind: str, value: str, attempt: int, secret: bytes) -> str:
    """The canonical surrogate of a canonical value."""
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        local, _, domain = value.rpartition("@")
        local = permuted(local, _free(local), secret, f"{tweak}/{domain}")
        if not domain.endswith(PLAIN_DOMAINS):
            name, dot, top = domain.rpartition(".")
            domain = permuted(name, _free(name), secret, "domain") + dot + top
        extra = str(_number(secret, tweak, value) % 10**6) if attempt > 3 or not _free(value.rpartition("@")[0]) else ""
        return f"{local}{extra}@{domain}"
    if kind == "ip":
        number = 0
        for part in value.split("."):
            number = number * 256 + int(part)
        a, b = divmod(number, 65536)
        for turn in range(ROUNDS):
            if turn % 2:
                b = (b + _number(secret, tweak, turn, a)) % 65536
            else:
                a = (a + _number(secret, tweak, turn, b)) % 65536
        return ".".join(str(x) for x in (a >> 8, a & 255, b >> 8, b & 255))
    if kind == "card":
        out, valid = value, luhn(value)
        while True:  # stays among numbers of the same brand and validity
            out = permuted(out, _free(out, 1), secret, tweak)
            if luhn(out) == valid:
                return out
    if kind == "phone":
        out = value
        national = len(value) == 10 and value[0] == "0"  # the 0 before an area code stays, and is the only one
        while True:  # area codes don't begin with 0 or 1
            out = permuted(out, _free(out, 1 if national else max(0, len(value) - 10)), secret, tweak)
            if national:
                if (out[1] == "0") == (value[1] == "0"):
                    return out
            elif len(value) < 10 or (out[-10] in "01") == (value[-10] in "01"):
                return out
    if kind == "ip6":  # the first group tells the kind of address and stays
        return permuted(value, [(i, "0123456789abcdef") for i in range(5, len(value)) if value[i] != ":"], secret, tweak)
    if kind == "iban":
        out = permuted(value, _free(value, 4), secret, tweak)
        check = 98 - iban_rest(out[:2] + "00" + out[4:])
        return f"{out[:2]}{check:02d}{out[4:]}"
    if kind == "key":
        start = len(re.match(r"AKIA|ASIA|eyJ[^.]*\.|[spr]k_(?:live|test)_|[a-z]+[_-]", value)[0])
        return permuted(value, _free(value, start), secret, tweak)
    if kind == "surname" or kind.startswith("given"):
        script, seed = script_of(value), _number(secret, kind, attempt, value)
        pool = GIVEN.get(script, {}).get(kind[6:])
        if pool and attempt < 4:
            return pool[seed % len(pool)].lower()
        out, parts = "", SYLLABLES[script]
        for _ in range(3 + attempt // 4):
            seed, k = divmod(seed, len(parts))
            out += parts[k]
        last = {"given:m": "n", "given:f": "a"} if script == "Latin" else {}
        return out + last.get(kind, "")
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None
    out = permuted(value, _free(value, 0, hexadecimal), secret, tweak)
    return out if _free(value) else out + str(_number(secret, tweak, value) % 10**6)


def laid_out(spelling: str, kind: str, new: str) -> str:
    """A canonical surrogate in the spelling that was found."""
    if kind in ("card", "phone", "ssn", "iban"):
        own = [i for i, c in enumerate(spelling) if c.isalnum()]
        out = list(spelling)
        for place, c in zip(reversed(own), reversed(new), strict=False):  # a leading country code stays
            out[place] = c
        return "".join(out)
    if kind == "ip6":
        new = str(ipaddress.IPv6Address(new))
        return new.upper() if spelling.isupper() else new
    if kind == "surname" or kind.startswith("given"):
        return new.upper() if spelling.isupper() and len(spelling) > 1 else new.capitalize()
    if kind == "email" and len(new) == len(spelling):
        return "".join(n.upper() if s.isupper() else n for s, n in zip(spelling, new, strict=True))
    return new


def replaced(text: str | None, secret: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str | None, list[str]]:
    """The text with surrogates, and the kinds replaced in order."""
    if text is None:
        return None, []
    out, last, kinds = [], 0, []
    for start, end, kind, value in finds(text):
        out += [text[last:start], laid_out(text[start:end], kind, surrogate(kind, value, attempts.get((kind, value), 0), secret))]
        kinds.append(kind)
        last = end
    return "".join([*out, text[last:]]) if kinds else text, kinds


def entities(frame: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, value) of all finds."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], []
            for at, value in enumerate(batch.column(1)):
                for _, _, kind, value in dict.fromkeys((0, 0, *x[2:]) for x in finds(value.as_py())):
                    held.append(at)
                    rows.append((kind, value))
            columns = [pa.array([x[i] for x in rows], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(held, pa.int64())), *columns], ["key", "kind", "value"])

    given = frame.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(find, f"key {frame.schema[key].dataType.simpleString()}, kind string, value string")


def attempts_needed(found: DataFrame, secret: bytes) -> DataFrame:
    """(kind, value, attempt) of the entities whose first surrogate would clash."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(x.to_pylist() for x in batch.columns), strict=True)
            new = [surrogate(kind, value, attempt, secret) for kind, value, attempt in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "value", "attempt", "new"])

    schema = "kind string, value string, attempt int, new string"
    drawn = written(found.select("kind", "value").distinct().withColumn("attempt", F.lit(0)).mapInArrow(draw, schema), "surrogates")
    for _ in range(MOST_ATTEMPTS):
        # who keeps a surrogate: the one of the fewest attempts, then the smallest value; an original keeps its own value
        first = drawn.groupBy("kind", "new").agg(F.min(F.struct("attempt", "value")).alias("holder"), F.count("*").alias("n"))
        twice = first.filter("n > 1").select("kind", "new", F.col("holder.value").alias("holder"))
        taken = drawn.select("kind", F.col("value").alias("new")).join(first.select("kind", "new"), ["kind", "new"]).withColumn("holder", F.lit(None).cast("string"))
        clashes = written(
            drawn.join(twice.unionByName(taken), ["kind", "new"])
            .filter(~F.col("holder").eqNullSafe(F.col("value")))
            .select("kind", "value", (F.col("attempt") + 1).alias("attempt")).distinct(),
            "clashes",
        )
        if clashes.isEmpty():
            return drawn.filter("attempt > 0").select("kind", "value", "attempt")
        rest = drawn.join(clashes.select("kind", "value"), ["kind", "value"], "left_anti")
        drawn = written(rest.unionByName(clashes.mapInArrow(draw, schema)), "surrogates")
    raise RuntimeError(f"surrogates still clash after {MOST_ATTEMPTS} attempts: some form has too few values for its entities")


def with_surrogates(frame: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame with its text replaced, and the kinds found as `pii_kinds` (array of string), an underscore more for each column of that name."""
    added, over = "pii_kinds", "__attempts"
    while added in frame.columns:
        added += "_"
    while over in frame.columns:
        over += "_"
    found = written(entities(frame, key, text).distinct(), "entities")
    again = written(attempts_needed(found, secret), "attempts")
    few = again.select(F.count("*"), F.coalesce(F.max(F.length("value")), F.lit(0))).first()
    rest = [x for x in frame.columns if x != text]
    own = frame.select(*(F.col(f"`{x}`") for x in rest), F.col(text).cast("string").alias(text))
    if few[0] <= MOST_SENT and few[1] <= MOST_LONG:
        sent = frame.sparkSession.sparkContext.broadcast({(x.kind, x.value): x.attempt for x in again.collect()})
        own = own.withColumn(over, F.lit(None).cast("array<struct<kind:string,value:string,attempt:int>>"))
    else:
        sent = None
        by_key = found.join(again, ["kind", "value"]).groupBy("key").agg(F.collect_set(F.struct("kind", "value", "attempt")).alias(over))
        own = own.join(by_key, own[key].eqNullSafe(by_key["key"]), "left").select(*(own[f"`{x}`"] for x in own.columns), by_key[over])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = sent.value if sent else {}
        for batch in batches:
            texts, kinds = [], []
            for value, more in zip(batch.column(len(rest)), batch.column(len(rest) + 1), strict=True):
                special = {(x["kind"], x["value"]): x["attempt"] for x in more.as_py() or ()}
                new, seen = replaced(value.as_py(), secret, special or shared)
                texts.append(new)
                kinds.append(seen)
            new = [pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *new], [*rest, text, added])

    kinds = "".join(f"`{x}` {frame.schema[x].dataType.simpleString()}, " for x in rest)
    out = own.select(*(f"`{x}`" for x in rest), f"`{text}`", over).mapInArrow(put, f"{kinds}`{text}` string, {added} array<string>")
    return out.select(*(f"`{x}`" for x in frame.columns), added)
